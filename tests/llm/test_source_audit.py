import random
import re
from collections import Counter

import pytest

from paperloom.llm import source_audit as A


def brute(rows, top, min_docs=3):
    """All shares of all terms, and sorts."""
    text = lambda r: "".join(c.lower() if c.isascii() else c for c in r[0] or "")
    docs = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text(r)), r[1] or "", r[2] or "") for r in rows]
    out = []
    for lang in {d[1] for d in docs}:
        own = [d for d in docs if d[1] == lang]
        seen = Counter(t for d in own for t in set(d[0]))
        kept = {t for t in seen if seen[t] >= min_docs}
        count = {s: Counter(t for d in own if d[2] == s for t in d[0] if t in kept) for s in {d[2] for d in own}}
        whole = sum(count.values(), Counter())
        share = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))
        p = {s: {t: share(c, t) for t in kept} for s, c in count.items()}
        q = {t: share(whole, t) for t in kept}
        cost = lambda a, b: (a - b) ** 2 // b
        for s in count:
            pairs = [(sum(cost(p[s][t], p[o][t]) for t in kept), o) for o in count if o != s]
            terms = [(cost(p[s][t], q[t]), t) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[: top if part == "term" else None]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def documents():
    rng = random.Random(12)
    words = ["the", "The", "été", "日本", "x", "naïve", "a" * 300, "zz", "ÀÉ", "😀", "ß"] + [f"{a}{b}{c}" for a in "abc" for b in "dé" for c in "fghij"]
    rows = [(rng.choice([" ", "-", "1"]).join(rng.choices(words, k=rng.choice([0, 3, 40]))), rng.choice(["en", "fr", None]), rng.choice(["s0", "s0", "s0", "s1", "s2", None, "é"])) for _ in range(200)]
    rows += [(None, None, None), ("", "xx", "only"), ("one two", "yy", "a"), ("one two", "yy", "b"), ("the " * 50_000, "en", "s0"), (rows[0][0], "en", "s0"), (rows[0][0], "en", "s0")]
    return rows


SCHEMA = "text string, lang string, source string"


@pytest.mark.parametrize("limits", [{}, {"MAX_SOURCES": 0, "HELD": 20, "PAIRS": 50, "SLICE": 100}])
@pytest.mark.parametrize("top", [3, 200])
def test_against_brute_force(spark, monkeypatch, limits, top):
    """All held by every task, and nothing broadcast with a flush after every few rows."""
    for k, v in limits.items():
        monkeypatch.setattr(A, k, v)
    rows = documents()
    df = spark.createDataFrame([(*r, "g", 1, "p") for r in rows], SCHEMA + ", `group` string, term int, p string").repartition(3)
    got = A.audit(df, top)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_empty(spark):
    assert A.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_radix_select(spark, tmp_path):
    """Thresholds in every digit, ties that differ late, terms that begin others."""
    rng = random.Random(1)
    rows = []
    for group in range(8):
        terms = {"p" * rng.choice([0, 1, 40, 200]) + "".join(rng.choices("aé日", k=rng.randint(1, 6))) for _ in range(300)} | {"p" * k for k in range(1, 60)}
        values = [[7], [0, 1], range(10), [2**62, 2**62 - 1, 2**62 - 2**17], [2**40 + i for i in range(300)], [i << 33 for i in range(300)], [rng.getrandbits(63) for _ in range(300)], [5] * 50 + [6]][group]
        rows += [(group, t, rng.choice(values)) for t in terms]
    rows += [(9, "b", 1), (9, "a", 1)]
    spark.createDataFrame(rows, "`group` long, term string, value long").repartition(3).write.parquet(f"{tmp_path}/rows")
    table = spark.read.parquet(f"{tmp_path}/rows")
    for k in (1, 50, 200):
        want = []
        for group in {r[0] for r in rows}:
            want += sorted((r for r in rows if r[0] == group), key=lambda r: (-r[2], r[1].encode()))[:k]
        assert sorted(tuple(r) for r in A.top_by_radix(table, k).collect()) == sorted(want)


def test_shares_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    n, words, kept = 10**15, 10**17 + 7, 10**9
    got = spark.range(1).select(A.share(F.lit(n), F.lit(words), F.lit(kept)).alias("p")).first().p
    assert got == 1 + 10**9 * (n + 1) // (words + kept)
