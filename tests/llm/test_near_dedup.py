import random

import numpy as np
import pyarrow as pa
import pytest

from paperloom.llm import graph, near_dedup, similar


def brute(rows):
    """doc_id -> (set size, least doc_id reachable), from all pairs."""
    sets = {}
    for doc_id, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
        sets[doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    ids = sorted(sets)
    links = [
        (a, b)
        for i, a in enumerate(ids)
        for b in ids[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    parent = graph.union_find(links)
    return {d: (len(sets[d]), parent.get(d, d)) for d in ids}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 30, 120, 400]))]
        for k in range(rng.choice([1, 2, 3, 25])):
            rows.append(edited(rng, base, rng.choice([0, 0, 1, 2, 4])))
    # a chain: each link is near, its ends are not
    chain = [f"c{i}" for i in range(100)]
    for k in range(8):
        rows.append(" ".join(chain))
        chain = chain[5:] + [f"d{k}{i}" for i in range(5)]
    rows += ["", None, "  \n", "One two", "one  TWO", "one two three", "É é", "é é", "a b c d e", "a b c d e f"]
    rng.shuffle(rows)
    return [(7 * i + 1, t) for i, t in enumerate(rows)]


def test_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", __import__("pyspark").sql.functions.lit("x"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df).collect()}
    assert got == brute(rows)


def test_large_group_with_common_passage(spark):
    """Documents that share half of their words: many common buckets, few links."""
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(150)]
    rows = [(i, " ".join(passage + [f"q{rng.randrange(10**9)}" for _ in range(60)])) for i in range(120)]
    rows += [(500 + i, edited(rng, rows[i][1].split(), 3)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df).collect()}
    assert got == brute(rows)


def test_edge_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_duplicates(empty).count() == 0
    rows = [(5, "a b c d e f g h"), (5, "a b c d e f g h"), (None, "a b c d e f g h"), (9, "a b c d e f g h"), (2, None)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == [
        ("2", "2", True), ("5", "5", True), ("5", "5", True), ("9", "5", False), ("None", "None", True),
    ]


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    for n in (3, 40, 2000):
        a = rng.integers(0, 2**63, 4 * n).astype(np.uint64)
        x, y = a[: 3 * n], a[n:]
        s = similar.sketches(np.concatenate([x, y]), np.array([3 * n, 3 * n]), 1024)
        assert not (s == similar._EMPTY).any()
        assert abs((s[0] == s[1]).mean() - 0.5) < 0.08


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(200, 260)] + [(rng.randrange(100), rng.randrange(100)) for _ in range(70)] + [(300, x) for x in range(301, 400)]
    got = {r.id: r.comp for r in graph.components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    want = graph.union_find(links)
    assert got == {k: v for k, v in want.items() if k in got} and {k for k, v in want.items() if k != v} <= set(got)


def test_rows_that_share_an_id_are_one_document(spark):
    rng = random.Random(6)
    a, b, c, d = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(4))
    rows = [(1, a), (2, a + " x"), (2, b), (3, b + " y"), (4, c), (5, d), (5, c + " z"), (6, d), (7, "lone words of its own here"), (2, b)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted({(r.doc_id, r.component_id) for r in got}) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 4), (7, 7)] and len(got) == len(rows)


def test_very_long_texts(spark):
    rng = random.Random(7)
    long = [f"w{rng.randrange(10**7)}" for _ in range(60_000)]
    rows = [(1, " ".join(long)), (2, edited(rng, long, 500)), (3, " ".join(long[:30_000]))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_open_bucket_of_many(spark):
    """More members of one bucket than a block holds, of many components, of which few are linked."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(300)]
    rows = [(i, " ".join(passage + [f"q{rng.randrange(10**9)}" for _ in range(110)])) for i in range(1300)]
    rows += [(2000 + i, edited(rng, rows[i][1].split(), 5)) for i in range(0, 1300, 13)]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == i for i in range(1300)) and all(got[2000 + i] == i for i in range(0, 1300, 13))


def test_sizes_and_partners_against_sets():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(60)]
    repeats = [np.r_[x, x[: len(x) // 2]] for x in sets]
    assert similar.distinct_sizes(np.concatenate(repeats), np.array(list(map(len, repeats)))).tolist() == [len(x) for x in sets]
    got = {k: near.tolist() for k, near in similar.partners(sets[:25], sets[25:], 50)}
    each = [set(x.tolist()) for x in sets]
    alike = lambda x, y: 100 * len(x & y) >= 50 * len(x | y)
    assert got == {i: [j for j in range(35) if alike(each[i], each[25 + j])] for i in range(25)} and any(got.values())
    sizes = np.array([len(x) for x in sets])
    assert all(similar.sizes_allow(sizes[i], sizes[i + 1], 50) for i in range(59) if alike(each[i], each[i + 1]))


@pytest.mark.parametrize("held", [1, 500, 10**6])
@pytest.mark.parametrize("sides", [(0, 0), (1, 4)])
def test_dense_block_against_brute_force(monkeypatch, held, sides):
    """All pairs of a block, in pieces of any size: the components of its links are those of all links."""
    monkeypatch.setattr(similar, "HELD", held)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, edited(rng, base if i % 3 else base[:50], rng.choice([1, 2, 3, 6]))) for i in range(50)]
    side = [rng.choice(sides) for _ in rows]
    comp = [i if i % 7 else 0 for i, _ in rows]
    block = pa.RecordBatch.from_pydict({
        "key": [3] * 50, "i": pa.array([sides[0]] * 50, pa.int32()), "j": pa.array([sides[1]] * 50, pa.int32()), "side": pa.array(side, pa.int32()),
        "id": [i for i, _ in rows], "comp": comp, "text": [t.encode() for _, t in rows],
    })
    links = [tuple(r.values()) for out in similar._linked(near_dedup.hashes, 75)(iter([block])) for r in out.to_pylist()]
    words = [t.split() for _, t in rows]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in words]
    near = {(i, j) for i in range(50) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and {side[i], side[j]} == set(sides)}
    assert near and {(max(x), min(x)) for x in links} <= near and len(links) < 50
    known = [(i, comp[i]) for i in range(50)]
    assert graph.union_find(known + links) == graph.union_find(known + list(near))
