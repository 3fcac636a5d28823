import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from paperloom.llm import token_tables as own


def texts():
    rng = random.Random(6)
    alphabet = ["a", "the", " ", " ", " ", "\n", "'s", "é", "1", "23", ".", ",", "  ", "\t", " ", " ", "ß", "😀", "#", "\x1c", "\x85", "<|endoftext|>"]
    some = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 25))) for _ in range(1200)]
    some += [" ".join(rng.choice(["It's", "of,", "foo.\nBar", "don't!", "x1y2", "日本", "...", "a b"]) for _ in range(12)) for _ in range(200)]
    return some + ["", " ", "a", "a b", "\n a", "\n  a b", "a" * 5000]


def test_same_ids_as_the_library():
    library = Tokenizer.from_file(own.tokenizer_path())
    code, data = own.Tokens(own.tokenizer_path()), texts()
    for text, got in zip(data, code.encode(data)):
        assert got.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_tables(spark, tmp_path):
    library = Tokenizer.from_file(own.tokenizer_path())
    rng, data = random.Random(1), texts()
    rows = [(rng.randrange(-500, 10**6), t) for t in data] + [(None, "none"), (7, None), (7, "again")]
    folder = f"file://{tmp_path}/t"
    manifest = own.write_tables(spark.createDataFrame(rows, "doc_id long, text string"), own.tokenizer_path(), folder)
    got = own.digests(own.read_tables(manifest)).orderBy("start").collect()
    ids = {}
    for doc_id, text in rows:
        ids.setdefault(doc_id, []).append([*library.encode(text or "", add_special_tokens=False).ids, 2])
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))
    start = 0
    for r in got:
        crc = [zlib.crc32(np.array(i, "<u4").tobytes()) for i in ids[r.doc_id]]
        assert r.start == start and r.ids_crc32 in crc
        start += r.n_tokens
    shards = [own.ShardReader(r.path) for r in manifest.collect()]
    for doc_id in [None, 7, rows[3][0], 10**7]:
        found = [i.tolist() for s in shards for i in s.get(doc_id)]
        assert sorted(found) == sorted(ids.get(doc_id, []))
    empty = own.write_tables(spark.createDataFrame([], "doc_id long, text string"), own.tokenizer_path(), f"{folder}2")
    assert own.read_tables(empty).count() == 0


def test_many_blocks(tmp_path):
    path = tmp_path / "x.sst"
    with open(path, "wb") as file:
        writer = own.ShardWriter(file, 4)
        for i in range(4000):
            writer.add(own.key_of(i * 3), np.arange(i % 300, dtype=np.uint32))
        writer.close()
    reader = own.ShardReader(f"file://{path}")
    assert len(reader.blocks) > 5 and reader.n_docs == 4000
    assert [own.id_of(k) for k, _, _ in reader] == [i * 3 for i in range(4000)]
    assert all(len(reader.get(i * 3)[0]) == i % 300 for i in range(0, 4000, 17)) and reader.get(4) == []


def test_chunks_are_learned_once_and_forgotten_ones_again(monkeypatch):
    """150,000 held chunks were too few for a task's words: most were learned several times."""
    path = own.tokenizer_path()
    code, learned = own.Tokens(path, 2), []
    chunks = code.chunks
    monkeypatch.setattr(code, "chunks", lambda new: learned.extend(new) or chunks(new))
    texts = [" ".join(f"w{k}x" for k in range(low, low + 10_000)) for low in range(0, 200_000, 10_000)]
    first = [ids.tolist() for ids in code.encode(texts)]
    assert [ids.tolist() for t in texts for ids in code.encode([t])] == first and len(learned) == len(set(learned))
    monkeypatch.setattr(own, "CACHE_CHUNKS", 20)
    code = own.Tokens(path, 2)
    odd = ["", " ", "a", "a ", "\n a", "a\n b", "x </s> y", "a\x85 b", "é  ü", " ".join(f"v{k}" for k in range(60)), "a b c", "<|endoftext|> a b"] * 3
    assert [ids.tolist() for t in odd for ids in code.encode([t])] == [[*ids, 2] for ids in code.whole(odd)]
