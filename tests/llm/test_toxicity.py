import random

from paperloom.llm import toxicity


def naive(values):
    """Maximal scoring segments: recursively the best segment, then those on each side."""
    def cut(lo, hi):
        best = None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += values[j]
                if total > 1e-9 and (best is None or total > best[2] + 1e-9):
                    best = (i, j, total)
        return [] if best is None else cut(lo, best[0]) + [best] + cut(best[1] + 1, hi)

    return cut(0, len(values))


def test_segments_against_naive():
    rng = random.Random(3)
    for _ in range(150):
        values = [rng.choice([-0.25, -0.25, -0.25, rng.uniform(0.1, 2)]) for _ in range(rng.randint(0, 40))]
        at = [i for i, v in enumerate(values) if v > 0]
        got = toxicity.segments(at, [values[i] for i in at], 0.25)
        want = naive(values)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert all(abs(x[2] - y[2]) < 1e-6 for x, y in zip(got, want))


def tables(spark, n=1500):
    rng = random.Random(7)
    plain, bad = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}ab" for i in range(400)], ["vileone", "viletwo", "grimword", "nastyone"]
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.2
        words = [rng.choice(plain) for _ in range(rng.randint(20, 200))]
        for _ in range(rng.randint(2, 6) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        docs.append((i, " ".join(words), "keep"))
        if rng.random() < 0.8:
            labels.append((i, int(toxic)))
    docs += [(n + 1, None, "x"), (n + 2, "", "x"), (n + 3, "vileone " * 3000, "x"), (None, "viletwo grimword", "x")]
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels + [(None, 1), (10**7, 1)], "doc_id long, toxic int"), dict(labels)


def test_held_out_accuracy(spark):
    docs, labels, truth = tables(spark)
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    import zlib

    held = [r for r in got if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = sum((r.score >= 0.5) == bool(truth[r.doc_id]) for r in held)
    assert len(held) > 150 and right >= 0.97 * len(held)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1503].score > 0.5 and by_id[1501].score == by_id[1502].score < 0.5 and by_id[1503].passages


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels, _ = tables(spark, 300)
    from pyspark.sql import functions as F

    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda l: [(r.doc_id, round(r.score, 12)) for r in toxicity.score(docs, toxicity.fit(docs, l)).collect()]
    assert score(labels) == score(turned)


def test_one_class_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0)):
        got = toxicity.score(docs, toxicity.fit(docs, some)).collect()
        assert len(got) == 2 and all(r.score < 0.5 for r in got)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, labels)).count() == 0


def test_scores_by_hand(spark):
    """Each document's score and passages from the model by the naive search for segments; extra columns stay."""
    import math
    import re

    docs, labels, _ = tables(spark, 400)
    model = toxicity.fit(docs, labels)
    short = docs.filter("length(text) < 700 OR text IS NULL").selectExpr("*", "1 AS toxicity_text", "2 AS passages")
    got = toxicity.score(short, model).collect()
    assert len(got) > 100 and model.words
    for r in got:
        words = re.findall(r"[^\W\d_]+", (r.text or "").lower())
        values = [model.words.get(w, model.stems.get(w[:6], 0.0) if len(w) >= 6 else 0.0) for w in words]
        found = naive([v or -toxicity.DRIFT for v in values])
        nats = [model.scale * s - math.log(len(words)) - model.log_k for _, _, s in found]
        x = [1, max(-6.0, min(max(nats, default=-6.0), 20.0)), math.log1p(sum(v for v in nats if v > 0)), sum(s for _, _, s in found) / math.sqrt(len(words) + 10), bool(found)]
        z = sum(a * b for a, b in zip(x, model.weights))
        assert abs(r.score - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-6 and r.toxicity_text == 1
        assert [(p.start, p.stop) for p in r.passages] == [(a, b + 1) for (a, b, _), v in zip(found, nats) if v > 0]
