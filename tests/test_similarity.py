"""Inverted lists against brute force."""

import numpy as np
from pyspark.sql import functions as F

from paperloom.operators import similarity
from paperloom.plans import registry


def test_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 8))
    rows = [(i, (centres[i % 20] + rng.normal(size=8) * 0.2).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[i][1]) for i in range(30)] + [(2000, None), (2001, [0.0] * 8), (2002, [float("nan")] * 8), (2003, [None] * 8)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(3)
    good = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if i < 2000}
    queries = df.filter("id % 50 = 0")

    def nearest(i):
        return [j for _, j in sorted((-round(float(good[i] @ v), 9), j) for j, v in good.items())[:5]]

    want = {i: nearest(i) for i in good if i % 50 == 0}
    monkeypatch.setattr(similarity, "BLOCK", 5)
    index = similarity.build(df)

    def found(probes):
        out = {}
        for r in similarity.search(index, queries, 5, probes).orderBy("query", "rank").collect():
            out.setdefault(r.query, []).append(r.id)
        return out

    assert found(None) == want and found(10**6) == want
    got = found(6)
    assert sum(len(set(got[i]) & set(w)) for i, w in want.items()) >= 0.9 * 5 * len(want)
    assert index.rows.count() == len(good) and index.rows.select("list").distinct().count() > 10
    assert similarity.search(index, queries.limit(0), 5).count() == 0
    assert similarity.search(similarity.build(df.limit(0)), queries, 5).count() == 0


def test_recall_on_the_tables(spark):
    for sf in ("0.001", "0.01"):
        exact = registry.similar_vectors(spark, f"/root/testdata/sf{sf}")
        listed = registry.similar_vectors_index(spark, f"/root/testdata/sf{sf}")
        n = exact.count()
        assert n == listed.count() and exact.join(listed, ["query", "id"]).count() >= 0.9 * n
        assert exact.agg(F.max("rank")).first()[0] == registry.NEAREST
