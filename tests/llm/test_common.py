import random

import pytest

from paperloom.llm import common


@pytest.mark.parametrize("most", [common.MOST_BITMAPS, 0])
def test_among_gives_the_rows_of_the_ids_once(spark, monkeypatch, most):
    """Ids at the borders of bitmaps, great, negative and repeated ones; both ways."""
    monkeypatch.setattr(common, "MOST_BITMAPS", most)
    rng = random.Random(5)
    ids = [0, 1, 2, 8, 32767, 32768, 32769, 65536, 2**33, 2**33 + 7, 2**62, -1, -32768, *(rng.randrange(100_000) for _ in range(2_000))]
    some = [i for i in ids if rng.random() < 0.5]
    df = spark.createDataFrame([(i, f"t{i}", None) for i in ids], "id long, text string, `ids.of` string")
    picked = common.among(df, spark.createDataFrame([(i,) for i in some * 2], "id long"))
    assert picked.columns == df.columns
    assert sorted(r[0] for r in picked.collect()) == sorted(i for i in ids if i in set(some))
    none = spark.createDataFrame([], "id long")
    assert common.among(df, none).isEmpty() and common.among(df.filter("false"), df.select("id")).isEmpty()


def test_among_shuffles_no_rows(spark):
    df = spark.range(1000).selectExpr("id", "repeat('x', 100) AS text")
    plan = common.among(df, spark.range(10))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_among_copies_no_bitmap_for_a_row(spark):
    """Bits are looked up in an array, which is read where it lies; a binary column would be copied for each row."""
    plan = common.among(spark.range(1000), spark.range(10))._jdf.queryExecution().analyzed().toString()
    assert "conv(" not in plan and "substr" not in plan
