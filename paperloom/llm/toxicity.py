"""Operator 8: toxic passages by maximum-scoring segments.

Token log-odds: from labelled documents, the odds that a document with a word
is toxic, against the odds of any document. A Dirichlet prior pulls a word to
the rate of the words that share its first letters, and those to the overall
rate, so rare and unseen words get what their stem supports.

Segments: each word adds its log-odds, any other word takes DRIFT away. One
linear scan finds all maximal scoring segments of a text.

Calibration: by extreme-value theory the best segment of n ordinary words
scores about (ln n + ln K) / lambda; lambda solves sum p e^(lambda s) = 1 over
the word scores of clean documents and K fits their best segments. What a
segment has beyond that, in nats, is its significance. A logistic fit of a
document's significances on labelled rows held out from the counts gives the
score.

Labels of rows with crc32(doc_id as text) mod 5 = 0 are never read. The fit
uses a sample of at most max_rows labelled rows (a hash of doc_id picks them).
The model holds every word and stem that LEAST_DOCS documents of that sample
have and that says enough, so the sample bounds it; scores read the text only.

Defined results: null and empty texts score as texts without toxic words do;
equal texts score alike; labels without a document, or null, are left out, and
of several labels for a document the largest counts. Without toxic or clean
labels every score is the overall rate.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stash, table

_WORD = re.compile(r"[^\W\d_]+")
STEM = 6
DRIFT = 0.25
#: Weight of the prior, in documents; bounds of a log-odds score; the least evidence kept.
PRIOR, MOST, LEAST_SCORE, LEAST_DOCS = 5.0, 6.0, 0.7, 4
FOLDS = 5
CACHE_WORDS = 200_000


@dataclass
class Model:
    """Scores of words and stems, and the calibration."""

    words: dict[str, float]
    stems: dict[str, float]
    rate: float
    scale: float = 1.0  # lambda
    log_k: float = 0.0
    weights: list[float] = field(default_factory=list)


class _Scores(dict):
    """Word to score, by the word itself or else its stem."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > CACHE_WORDS:
            self.clear()
        model = self.model
        value = model.words.get(word)
        if value is None:
            value = model.stems.get(word[:STEM], 0.0) if len(word) >= STEM else 0.0
        self[word] = value
        return value


def segments(at: list[int], score: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score), in order.

    at and score give the words that add; every word between them takes drift.
    """
    found: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum after
    total, last = 0.0, -1
    for place, s in zip(at, score):
        total -= drift * (place - last - 1)
        now = (place, place, total, total + s)
        total, last = now[3], place
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= now[2]:
                j -= 1
            if j < 0 or found[j][3] >= now[3]:
                found.append(now)
                break
            now = (found[j][0], now[1], found[j][2], now[3])
            del found[j:]
    return [(a, b, after - before) for a, b, before, after in found]


def _scored(text: str | None, scores: _Scores) -> tuple[int, list[tuple[int, int, float]], np.ndarray]:
    words = _WORD.findall(text.lower()) if text else []
    if not words:
        return 0, [], np.empty(0)
    each = np.fromiter(map(scores.__getitem__, words), np.float64, len(words))
    at = np.flatnonzero(each)
    return len(words), segments(at.tolist(), each[at].tolist(), DRIFT) if len(at) else [], each[at]


def _features(n: int, found: list[tuple[int, int, float]], model: Model) -> list[float]:
    """Significance of the best segment, of all significant ones, and what all segments score by length."""
    nats = [model.scale * s - math.log(n) - model.log_k for _, _, s in found]
    best = max(nats, default=-6.0)
    high = sum(x for x in nats if x > 0)
    return [1.0, max(-6.0, min(best, 20.0)), math.log1p(high), sum(s for _, _, s in found) / math.sqrt(n + 10.0), float(bool(found))]


def toxic_share(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """A sample (text, toxic, part) of labelled rows outside the held-out fold, stored; part is 1 to 4."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    labels = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(fold != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = int(min(1.0, max_rows / max(1, labels.count())) * 1_000_000)
    picked = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1_000_000)) < share
    # the picked labels are about max_rows rows of two numbers, whatever the input
    rows = docs.select("doc_id", "text").filter((fold != 0) & picked).join(F.broadcast(labels.filter(picked)), "doc_id")
    return stash(rows.select(F.coalesce("text", F.lit("")).alias("text"), (F.col("toxic") > 0).alias("toxic"), fold.alias("part")), "labelled")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = set(_WORD.findall(text.lower()))
            for token in words | {"^" + w[:STEM] for w in words if len(w) >= STEM} | {""}:
                pair = seen[token]
                pair[0] += toxic
                pair[1] += 1
    columns = [pa.array(seen), pa.array([p[0] for p in seen.values()], pa.int64()), pa.array([p[1] for p in seen.values()], pa.int64())]
    if seen:
        yield pa.RecordBatch.from_arrays(columns, names=["token", "toxic", "n"])


def log_odds(rows: DataFrame) -> Model | None:
    """The model's words and stems from (text, toxic); None without both classes.

    What is collected is bounded by the sample: a term stands for LEAST_DOCS documents or more.
    """
    counts = rows.mapInArrow(_count, "token string, toxic long, n long").groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    counts = stash(counts, "tokens")
    both = counts.filter("token = ''").first()
    if both is None or not 0 < both.toxic < both.n:
        return None
    rate = both.toxic / both.n
    logit = lambda p: F.log(p / (1 - p))
    smooth = lambda toxic, n, mean: (toxic + PRIOR * mean) / (n + PRIOR)
    tokens = counts.filter("token != ''")
    stem = tokens.filter("token LIKE '^%'").select(
        F.expr("substring(token, 2)").alias("stem"), F.col("toxic").alias("st"), F.col("n").alias("sn")
    )
    stem = stem.withColumn("mean", smooth(F.col("st"), F.col("sn"), F.lit(rate)))
    bound: Column = F.lit(math.log(rate / (1 - rate)))
    score = lambda p: F.least(F.lit(MOST), logit(p) - bound)
    stems = stem.filter(F.col("sn") >= LEAST_DOCS).select(F.concat(F.lit("^"), "stem").alias("token"), score(F.col("mean")).alias("s"))
    words = tokens.filter(f"n >= {LEAST_DOCS} AND token NOT LIKE '^%'").withColumn("stem", F.expr(f"substring(token, 1, {STEM})"))
    words = words.join(stem.select("stem", "mean"), "stem", "left")
    words = words.select("token", score(smooth(F.col("toxic"), F.col("n"), F.coalesce("mean", F.lit(rate)))).alias("s"), "mean")
    # a word that says less than the least is kept as nought where its stem would speak for it
    quiet = F.when(F.col("s") >= LEAST_SCORE, F.col("s")).otherwise(0.0)
    loud = (F.col("s") >= LEAST_SCORE) | (score(F.col("mean")) >= LEAST_SCORE)
    words = words.filter(loud).select("token", quiet.alias("s"))
    kept = stems.filter(F.col("s") >= LEAST_SCORE).select("token", "s").union(words).collect()
    return Model(
        {r.token: r.s for r in kept if not r.token.startswith("^")}, {r.token[1:]: r.s for r in kept if r.token.startswith("^")}, rate
    )


def _karlin(words: float, bins: dict[float, float]) -> float:
    """lambda: the positive root of sum p e^(lambda s) = 1 over word scores; words that add nothing take DRIFT."""
    rest = max(0.0, 1.0 - sum(bins.values()) / words)
    excess = lambda x: rest * math.exp(-x * DRIFT) + sum(c / words * math.exp(x * s) for s, c in bins.items()) - 1.0
    low, high = 1e-4, 1e-4
    if excess(low) >= 0:
        return low
    while excess(high) < 0 and high < 8:
        low, high = high, high * 1.5
    for _ in range(40):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def _logistic(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Weights of a lightly damped logistic fit, by Newton's method."""
    w, damp = np.zeros(x.shape[1]), np.diag([1e-6] + [0.1] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + damp @ w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + damp, slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def calibrate(model: Model, rows: DataFrame) -> Model:
    """Fits lambda, K and the logistic weights on labelled rows that the counts have not seen; at most max_rows of them."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _Scores(shared.value)
        for batch in batches:
            out = []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                n, found, each = _scored(text, scores)
                value, count = np.unique(np.round(each, 1), return_counts=True)
                out.append({"toxic": toxic, "n": n, "segments": [s for _, _, s in found], "value": value.tolist(), "count": count.tolist()})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("toxic", pa.bool_()), ("n", pa.int64()), ("segments", pa.list_(pa.float64())), ("value", pa.list_(pa.float64())), ("count", pa.list_(pa.int64()))]))

    made = rows.mapInArrow(run, "toxic boolean, n long, segments array<double>, value array<double>, count array<long>").collect()
    clean, bins = [r for r in made if not r.toxic and r.n], defaultdict(float)
    for r in clean:
        for v, c in zip(r.value, r["count"]):
            bins[v] += c
    if not clean or len(clean) == len(made):
        model.weights = [math.log(model.rate / (1 - model.rate)), 0, 0, 0, 0]
        return model
    model.scale = _karlin(float(sum(r.n for r in clean)), bins)
    best = [model.scale * max(r.segments) - math.log(r.n) for r in clean if r.segments]
    model.log_k = float(np.mean(best)) - 0.5772 if best else 0.0
    x = np.array([_features(r.n, [(0, 0, s) for s in r.segments], model) for r in made])
    model.weights = _logistic(x, np.array([float(r.toxic) for r in made]))
    return model


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 40_000) -> Model:
    """A model from labelled rows; three parts give the counts, the fourth the calibration."""
    rows = toxic_share(docs, labels, max_rows)
    model = log_odds(rows.filter("part != 4").select("text", "toxic"))
    if model is None:
        seen = rows.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
        rate = min(max(seen, 1e-3), 1 - 1e-3)
        return Model({}, {}, rate, weights=[math.log(rate / (1 - rate)), 0, 0, 0, 0])
    return calibrate(model, rows.filter("part = 4").select("text", "toxic"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score, and passages: the significant segments (start and stop word, nats)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = ["score", "passages"]
    docs = docs.drop(*own)
    kept, place = docs.schema.fields, docs.columns.index("text")
    passage = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("nats", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scores, weights = _Scores(model), np.array(model.weights)
        for batch in batches:
            result, passages = [], []
            for text in batch.column(place).cast(pa.string()).to_pylist():
                n, found, _ = _scored(text, scores)
                x = float(weights @ _features(n, found, model))
                result.append(1 / (1 + math.exp(-max(-30.0, min(30.0, x)))))
                nats = [(a, b + 1, model.scale * s - math.log(n) - model.log_k) for a, b, s in found]
                passages.append([{"start": a, "stop": b, "nats": v} for a, b, v in nats if v > 0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(result, pa.float64()), pa.array(passages, passage)], names=[*batch.schema.names, *own])

    spelled = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "score double", "passages array<struct<start:int,stop:int,nats:double>>"])
    return docs.mapInArrow(run, spelled)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == 0
    return score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages")
    )
