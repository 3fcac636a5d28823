import hashlib
import math
import random

import numpy as np
import pytest

from paperloom.llm import vector_codes as V


def brute(rows, parts, entries, rounds):
    """(id, label, code, error) by comparing every part with every entry, in Python integers."""
    kept = []
    for i, vector, label in rows:
        if vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((i, [math.floor(x * 256) for x in vector], label))
    sized = [k for k in sorted((k for k in kept if k[0] is not None), key=lambda k: k[:2]) if len(k[1]) and len(k[1]) % parts == 0 and all(abs(x) < V.LIMIT for x in k[1])]
    size = len(sized[0][1])
    able = lambda q: len(q) == size and all(abs(x) < V.LIMIT for x in q)
    width = size // parts
    cut = lambda q: [tuple(q[p * width : (p + 1) * width]) for p in range(parts)]
    first = [cut(k[1]) for k in sized if len(k[1]) == size][:entries]
    books = [[f[p] for f in first] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, q, _ in kept:
                if able(q):
                    members.setdefault(near(cut(q)[p], books[p])[1], []).append(cut(q)[p])
            books[p] = [tuple(sum(x) // len(members[k]) for x in zip(*members[k])) if k in members else e for k, e in enumerate(books[p])]
    out = []
    for i, q, label in kept:
        found = [near(x, books[p]) for p, x in enumerate(cut(q))] if able(q) else None
        out.append((i, label, found and "".join(f"{k:02x}" for _, k in found), found and sum(d for d, _ in found)))
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def table(n=300, size=8):
    rng = random.Random(5)
    rows = [(i, [rng.choice([rng.gauss(0, 1), rng.gauss(3, 0.01), 0.0, -0.001]) for _ in range(size)], rng.choice([None, 1, 2, 2, 2])) for i in range(n)]
    rows += [(1000 + i, rows[7][1], 2) for i in range(100)]  # a frequent vector
    rows += [(7, rows[8][1], 1), (7, rows[8][1], 1), (None, rows[9][1], None), (2000, None, 3), (2001, [float("nan")] * size, 3), (2002, [float("inf")] + [0.0] * (size - 1), 3)]
    rows += [(2003, [None] + [0.0] * (size - 1), 4), (-5, [0.5] * (size + 1), 4), (2005, [], 4), (2006, [1e9] * size, 5), (2007, [65535.99] + [0.0] * (size - 1), 5), (2008, [-1e4] * size, None)]
    return rows


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize(("parts", "entries", "rounds"), [(2, 16, 2), (4, 64, 1), (8, 3, 3)])
def test_against_brute_force(spark, parts, entries, rounds):
    rows = table()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA + ", code string, vector string").repartition(3)
    out, books = V.compress(df, parts, entries, rounds)
    want, digest = brute(rows, parts, entries, rounds)
    got = out.collect()
    assert sorted((str(r.vec_id), str(r.label), str(r.code), str(r.error)) for r in got) == sorted(tuple(map(str, w)) for w in want)
    assert books.digest() == digest
    sums = {}
    for _, label, _, error in want:
        sums.setdefault(label, []).append(error)
    sums = {k: sum(e for e in v if e is not None) if any(e is not None for e in v) else None for k, v in sums.items()}
    assert {r.label: r.label_error for r in got} == sums and sums[4] is None
    back = {r.vec_id: r.decoded for r in V.decode(out.filter("vec_id BETWEEN 10 AND 20"), books).collect()}
    for i, vector in back.items():
        error = sum((math.floor(x * 256) - 256 * y) ** 2 for x, y in zip(rows[i][1], vector))
        assert error == next(w[3] for w in want if w[0] == i)


def test_annuli_equal_full_search_and_skip_entries():
    rng = np.random.default_rng(1)
    for width, spread in ((1, 5), (4, 60), (4, 2**24 - 1), (16, 300)):
        entries = rng.integers(-spread, spread, (64, width)) * rng.integers(0, 2, (64, 1))
        points = np.r_[rng.integers(-spread, spread, (3000, width)), entries, entries[:1] * 0]
        book = V.Annuli(entries)
        which, best = book.nearest(points)
        squares = ((points[:, None] - entries[None]) ** 2).sum(2)
        assert (best == squares.min(1)).all() and (which == squares.argmin(1)).all()
    entries = rng.normal(0, 200, (64, 2)).astype(np.int64)
    book = V.Annuli(entries)
    points = np.repeat(entries, 50, 0) + rng.integers(-3, 3, (3200, 2))
    book.nearest(points)
    assert book.compared < 0.3 * len(points) * 64


def test_empty_and_unusable(spark):
    df = spark.createDataFrame(table()[:20], SCHEMA)
    out, books = V.compress(df.limit(0))
    assert books is None and out.count() == 0 and out.columns == ["vec_id", "label", "code", "error", "label_error"]
    out, books = V.compress(df)  # 8 components in 16 parts
    assert books is None and out.count() == 20 and out.filter("code IS NOT NULL").count() == 0
    with pytest.raises(ValueError, match="hex"):
        V.train(df, entries=300)


def test_query_on_few_vectors(spark, tmp_path):
    rows = [(i, [float(x) for x in np.random.default_rng(i).normal(size=32)], i % 2) for i in range(5)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.vec_id: r for r in V.op11_vector_codes(spark, str(tmp_path)).collect()}
    assert {i: r.code for i, r in got.items()} == {i: f"{i:02x}" * 16 for i in range(5)} and all(r.error == r.label_error == 0 for r in got.values())
