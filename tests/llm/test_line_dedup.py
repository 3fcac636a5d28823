import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from paperloom.llm import graph, line_dedup, similar


def brute(rows, size=5, least=5):
    """doc_id -> places to drop, from all pairs of lines."""
    lines = {}
    for doc_id, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            if x := line.strip(" \t\n\v\f\r"):
                lines[(doc_id, k)] = x
    sets = {x: {x[i : i + size] for i in range(len(x) - size + 1)} if len(x) >= least else None for x in lines.values()}
    texts = sorted(sets)
    links = [
        (a, b)
        for i, a in enumerate(texts)
        for b in texts[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    parent, first, drop = graph.union_find(links), {}, {}
    for at, x in sorted(lines.items()):
        if first.setdefault(parent.get(x, x), at) != at:
            drop.setdefault(at[0], []).append(at[1])
    return drop


def rows():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgho") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    pool = [" ".join(rng.choice(words) for _ in range(rng.choice([2, 5, 20, 60]))) for _ in range(60)]
    out = []
    for doc_id in range(70):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(pool) if rng.random() < 0.5 else " ".join(rng.choice(words) for _ in range(25))
            if rng.random() < 0.4:
                line = line.replace(rng.choice(line.split()), "edited", 1)
            lines.append(rng.choice(["", "  "]) + line)
        out.append((doc_id, "\n".join(lines)))
    return out + [(100, None), (101, ""), (102, "\n \n"), (103, "é" * 30 + "\n" + "é" * 30), (104, "short\nshort\nshort"), (105, out[0][1])]


def test_against_brute_force(spark):
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: r.dropped for r in line_dedup.duplicate_lines(df).filter(F.size("dropped") > 0).collect()}
    assert got == brute(data)
    longer = line_dedup.duplicate_lines(df, shingle=12, least=24).filter(F.size("dropped") > 0).collect()
    assert {r.doc_id: r.dropped for r in longer} == brute(data, 12, 24)


def test_texts(spark):
    long = "this is a line that is long enough for shingles of characters"
    data = [(1, f"a\n{long}\n\nb", "n"), (2, f"{long}!\nc", "d"), (None, long, "z"), (3, None, "q"), (2, f"{long}!\nc", "d")]
    df = spark.createDataFrame(data, "doc_id long, text string, dropped string")
    out = line_dedup.dedup_lines(df).select("doc_id", "text", "n_lines").collect()
    assert sorted(map(str, out)) == sorted(
        map(str, [
            type(out[0])(doc_id=1, text=f"a\n{long}\n\nb", n_lines=3), type(out[0])(doc_id=2, text="c", n_lines=2), type(out[0])(doc_id=2, text="c", n_lines=2),
            type(out[0])(doc_id=3, text=None, n_lines=0), type(out[0])(doc_id=None, text=long, n_lines=0),
        ])
    )
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_one_edit_inside_ordinary_lines(spark):
    """One changed character or word inside lines of 40 to 90 characters."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5))
    data, dropped = [], {}
    for k in range(60):
        line = " ".join(word() for _ in range(7 + k % 9))
        at = len(line) // 2
        data += [(2 * k, line), (2 * k + 1, line[:at] + "#" + line[at + 1 :])]
        dropped |= {2 * k: "", 2 * k + 1: "0"}
    data += [(500, "abcdefghijklmnopqrst"), (501, "abcdefghijklmnopqrsx"), (502, "abcd"), (503, "abce"), (504, "abcd")]
    dropped |= {500: "", 501: "0", 502: "", 503: "", 504: "0"}
    df = spark.createDataFrame(data, "doc_id long, text string")
    out = line_dedup.dedup_lines(df).collect()
    assert {r.doc_id: ",".join(map(str, r.dropped)) for r in out} == dropped


def test_bands_miss_few_pairs_at_the_threshold():
    """20,000 pairs that share 75 percent of their union: about 6 are missed."""
    rng = np.random.default_rng(12)
    n, shared, own = 20_000, 60, 10
    x = rng.integers(0, 2**63, (n, shared + 2 * own)).astype(np.uint64)
    size = np.full(n, shared + own)
    t = line_dedup.BANDS * line_dedup.ROWS
    a, b = (similar.bands_of(similar.sketches(half.ravel(), size, t), line_dedup.ROWS) for half in (x[:, : shared + own], np.c_[x[:, :shared], x[:, shared + own :]]))
    assert (~(a == b).any(axis=1)).sum() <= 20


def test_short_lines_against_brute_force(spark):
    """The query's own shingles; lines of 5 to 60 characters among them, shared ids, extra columns of clashing names."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7)))
    pool = [" ".join(word() for _ in range(rng.randint(1, 10))) for _ in range(60)]
    data = []
    for doc_id in range(80):
        lines = []
        for _ in range(rng.randint(0, 5)):
            line = rng.choice(pool)
            at = rng.randrange(len(line))
            lines.append(line[:at] + rng.choice(["", "#", line[at]]) + line[at + 1 :] if rng.random() < 0.5 else line)
        data.append((doc_id - 40, "\n".join(lines)))
    data.append((200, pool[0] * 4000 + "\n" + pool[0] * 4000 + "x"))
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in data], "doc_id long, text string, n_lines int, place int, at int")
    got = {r.doc_id: r.dropped for r in line_dedup.dedup_lines(df.repartition(5)).filter(F.size("dropped") > 0).collect()}
    assert got == brute(data, 5, 5)


def test_ids_near_and_far_apart(spark):
    """Places are numbered by a long where ids lie close together, by a decimal elsewhere; the first line is kept either way."""
    line = "one of many lines that stand in more than one document"
    for ids in ([7, 8, 9], [-(2**63), 0, 2**63 - 1], [2**63 - 3, 2**63 - 2, 2**63 - 1], [-(2**63), 1 - 2**63, 2**32 - 1 - 2**63], [0, 1, 2**32]):
        data = [(ids[2], f"{line}\n{line}!"), (ids[0], f"\n{line}\nb"), (ids[1], f"b\n \n{line}?")]
        df = spark.createDataFrame(data, "doc_id long, text string")
        assert {r.doc_id: r.dropped for r in line_dedup.duplicate_lines(df).collect()} == {ids[0]: [], ids[1]: [0, 2], ids[2]: [0, 1]}


def test_place_numbers_are_longs_where_ids_allow(spark):
    df = spark.createDataFrame([(2**40, "a"), (2**40 + 1, "b")], "doc_id long, text string")
    at, doc_of, place_of = line_dedup._order(df)
    made = df.select(at(F.col("doc_id"), F.lit(2**31 - 1)).alias("at"))
    assert dict(made.dtypes)["at"] == "bigint"
    assert sorted(map(tuple, made.select(doc_of(F.col("at")), place_of(F.col("at"))).collect())) == [(2**40, 2**31 - 1), (2**40 + 1, 2**31 - 1)]


def test_documents_that_cross_batches():
    """The rows of a document may end one batch, fill others and go on in further ones."""
    pack = lambda *places: np.array(places, np.int32).tobytes()
    rows = [(1, pack(0, 2), None), (1, None, 0), (2, None, 5), (2, pack(5, 6, 7), None), (2, pack(7, 9), None), (2, None, 9), (3, pack(), None), (4, pack(1), None), (4, None, 1)]
    kind = pa.schema([("doc_id", pa.int64()), ("places", pa.binary()), ("kept", pa.int32())])
    for step in (1, 2, 3, 4, 9):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[k : k + step]), kind)], schema=kind) for k in range(0, len(rows), step)]
        out = [r for b in line_dedup._left_out(iter(batches)) for r in b.to_pylist()]
        assert [tuple(r.values()) for r in out] == [(1, 2, [2]), (2, 4, [6, 7]), (4, 1, [])]


def test_a_key_of_two_is_one_row():
    """Two lines that alone share a key leave one row without key; more members leave one row each, with it."""
    rng = np.random.default_rng(3)
    bands = rng.integers(0, 2**62, (5, 1)).astype(np.int64)
    bands[1], bands[3:] = bands[0], bands[2]
    made = []
    for k in range(5):
        made += list(similar._dealt(lambda b: (b.column(0).to_numpy(), bands[b.column(0).to_numpy()]), 16)([pa.RecordBatch.from_arrays([pa.array([k])], names=["id"])]))
    table = pa.Table.from_batches(made).sort_by("bucket")
    out = [tuple(r.values()) for b in similar._met(iter(table.combine_chunks().to_batches())) for r in b.to_pylist()]
    assert [(i, a) for k, i, a in out if k is None] == [(1, 0)]
    assert sorted((i, a if a is not None else -1) for k, i, a in out if k is not None) == [(2, -1), (3, 2), (4, 2)]


def test_sketches_are_the_same_in_any_pieces_and_company():
    """Short and long sets, repeated elements and empty sets; every bin of others is filled, and equal ones are as many as the similarity says."""
    rng = np.random.default_rng(4)
    size = rng.choice([0, 1, 2, 7, 30, 64, 65, 300, 1200], 400)
    flat = rng.integers(0, 2**63, int(size.sum())).astype(np.uint64)
    sets = np.split(flat, np.cumsum(size)[:-1])
    whole = similar.sketches(flat, size, 240)
    for step in (1, 7, 400):
        some = ((np.concatenate(sets[k : k + step]), size[k : k + step]) for k in range(0, len(sets), step))
        assert (similar.sketches_of(some, 240) == whole).all()
    twice = similar.sketches(np.concatenate([np.r_[x, x[::-1]] for x in sets]), 2 * size, 240)
    assert (twice == whole).all() and ((whole == similar._EMPTY).any(axis=1) == (size == 0)).all()
    for shared, own in ((6, 1), (60, 10), (240, 40)):
        x = rng.integers(0, 2**63, (4000, shared + 2 * own)).astype(np.uint64)
        a, b = (similar.sketches(half.ravel(), np.full(4000, shared + own), 240) for half in (x[:, : shared + own], np.c_[x[:, :shared], x[:, shared + own :]]))
        assert abs((a == b).mean() - 0.75) < 0.005


def test_places_of_lines_with_a_word():
    rng = random.Random(4)
    texts = ["".join(rng.choice("aé \t\n\n漢\r\v") for _ in range(rng.choice([0, 1, 2, 5, 30]))) for _ in range(500)] + ["", "\n", "x", ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    for some in (batch, batch.slice(7, 100), batch.slice(500), batch.slice(500, 1), batch.slice(0, 0)):
        out = [r["places"] for y in line_dedup._places_of(iter([some])) for r in y.to_pylist()]
        assert out == [np.array([k for k, line in enumerate(t.split("\n")) if line.strip(" \t\n\v\f\r")], np.int32).tobytes() for t in some.column(1).to_pylist()]


def test_a_row_that_goes_wins_over_one_that_is_kept():
    kind = pa.schema([("doc_id", pa.int64()), ("places", pa.binary()), ("kept", pa.int32())])
    rows = [(1, np.array([0, 2, 3], np.int32).tobytes(), None), (1, None, -2), (1, None, 0), (1, None, 3), (2, None, -2 - 5), (2, np.array([5], np.int32).tobytes(), None), (2, None, 5)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)
    assert [tuple(r.values()) for b in line_dedup._left_out(iter([batch])) for r in b.to_pylist()] == [(1, 3, [0, 2]), (2, 1, [5])]
