import random
import re

import pytest
from pyspark.sql import functions as F

from paperloom.llm import decontaminate


def fold(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, n):
    """(id, n_words, n_hit, items, contaminated) of every document, by all windows at all places."""
    windows = {(str(i), tuple(w[k : k + n])) for i, t in items if i is not None and (w := fold(t)) for k in range(max(1, len(w) - n + 1))}
    out = []
    for d, text in docs:
        w, hit, names = fold(text), set(), set()
        for item, x in windows:
            for at in range(len(w) - len(x) + 1):
                if tuple(w[at : at + len(x)]) == x:
                    hit |= set(range(at, at + len(x)))
                    names.add(item)
        out.append((str(d), len(w), len(hit), tuple(sorted(names)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def tables():
    rng = random.Random(14)
    word = lambda: rng.choice(["The", "cat", "é", "x1", "Straße", "of", "on", "日本", "a", "b"])
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 4, 9, 12])))) for i in range(25)]
    items += [(3, items[4][1]), (30, items[4][1]), (31, "cat"), (None, "x1 x1"), (32, None), (33, " ,.! "), (34, "Only one here, and nowhere else!")]
    docs = []
    for i in range(120):
        parts = [word() for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(items)[1] or "")
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(parts)))
    return docs + [(200, None), (201, ""), (202, "..."), (None, items[1][1]), (7, docs[7][1]), (7, docs[8][1]), (300, items[2][1] + " dog" * 30000)], items


@pytest.mark.parametrize("limits", [{}, {"max_windows": 3}, {"max_windows": 3, "max_words": 2}])
def test_against_brute_force(spark, limits):
    """Windows held by every task, and joined, with and without the words held."""
    docs, items = tables()
    df = spark.createDataFrame([(*r, "k", 1, 2) for r in docs], "doc_id long, text string, items string, decontaminate_row int, _bytes int").repartition(4)
    out = decontaminate.decontaminate(df, spark.createDataFrame(items, "item_id long, text string"), 5, **limits)
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r.items), r.contaminated) for r in out.collect())
    assert got == brute(docs, items, 5) and any(g[-1] for g in got)
    assert out.filter("decontaminate_row = 1 AND _bytes = 2").count() == len(docs)
    spans = {(r.doc_id, tuple((s.start, s.stop) for s in r.hit_spans)) for r in out.collect()}
    assert all(a < b for _, x in spans for a, b in x) and all(x[1] < y[0] for _, s in spans for x, y in zip(s, s[1:]))


def test_empty_tables(spark):
    docs, items = (spark.createDataFrame(x[:9], f"{i} long, text string") for x, i in zip(tables(), ("doc_id", "item_id")))
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0
    none = decontaminate.decontaminate(docs, items.limit(0))
    assert none.count() == 9 and none.filter("contaminated OR n_hit > 0").count() == 0 and none.agg(F.sum("n_words")).first()[0] > 0
