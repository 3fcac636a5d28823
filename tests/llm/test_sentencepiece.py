import random

import pytest
import sentencepiece

from paperloom.llm import sentencepiece as own


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=own.model_path())


@pytest.fixture(scope="module")
def code():
    return own.Encoder(own.model_path())


def check(library, code, texts):
    flat, ends = code.encode(texts)
    start = 0
    got = code.pieces.decode(flat, ends)
    for text, end, back in zip(texts, ends.tolist(), got):
        want = library.encode(text)
        assert flat[start:end].tolist() == want, repr(text)
        assert back == library.decode(want), repr(text)
        start = end


def test_edge_texts(library, code):
    check(library, code, ["", " ", "  ", " " * 37 + "x" + " " * 70, "a\nb\t c", "\x00x", "a▁b", "▁", "é", "é", "<s>a</s>", "<0x0A>", "😀👍🏽", "a" * 3000, "ab" * 999, "the the", "xyxyxyx", "\r\n\r\n", "　x", "�", "\x1f"])


def test_random_texts(library, code):
    rng = random.Random(5)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    some = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 30))) for _ in range(1500)]
    some += ["".join(rng.choice("ab ") for _ in range(rng.randint(1, 60))) for _ in range(800)]
    some += ["".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 40))) for _ in range(800)]
    some += ["".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x2000, 0xD7FF), rng.randint(0x1F300, 0x1FAFF)])) for _ in range(20)) for _ in range(500)]
    check(library, code, some)


def test_decode_of_stray_bytes(library, code):
    import numpy as np

    for ids in ([3 + 0xE2, 3 + 0x82], [3 + 0xC3, 264, 3 + 0xA9], [3 + 0xF0, 3 + 0x9F, 3 + 0x98, 3 + 0x80], [0, 5], [1, 264, 2]):
        assert code.pieces.decode(np.array(ids), np.array([len(ids)])) == [library.decode(ids)], ids


def test_columns(spark, library):
    rows = [(1, None, "x", 9), (2, "", "y", 9), (3, "Of eran  oring", None, 9), (3, "Of eran  oring", None, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int")
    out = {r.doc_id: r for r in own.encode(df, own.model_path(), decoded="decoded").collect()}
    assert out[1].ids == out[2].ids == [] and out[1].decoded == ""
    assert out[3].ids == library.encode("Of eran  oring") and out[3].decoded == "Of eran  oring"
    assert own.decode(own.encode(df, own.model_path()), own.model_path()).filter("doc_id = 3").first().decoded == "Of eran  oring"
    assert own.encode(df.limit(0), own.model_path()).count() == 0
