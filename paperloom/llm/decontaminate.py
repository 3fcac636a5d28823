"""Operator 6: benchmark decontamination by a prefix-filtered join.

An item is cut into windows of `window` words (a shorter item is one window). A
window can only occur in a document that holds its rarest word, so that one
word is its necessary prefix: word frequencies are counted over all documents,
the words of each window are ordered by rarity, and documents meet windows only
at prefix words. Bounds on the position (the window must fit before and after
it) come next; a candidate is then confirmed word for word.

Frequencies are counted once for all windows. Up to MAX_WINDOWS windows go to
the tasks and documents stream past them in place, without a shuffle, so hot
sources or passages cost no more than their own words. More windows are joined
with the words of documents on the prefix word, and what meets is confirmed on
the document's words.

Defined results: null and empty texts have no words, no hits and are clean;
items without words or without an id match nothing; rows that share an item_id
are one item; repeated documents are judged alike.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lower_ascii, stash, table

WINDOW = 13
#: A document is contaminated if hits are this share of its words or more.
MIN_PERCENT = 5
#: Windows, and distinct words, that are sent to every task; with more, tables are joined.
MAX_WINDOWS, MAX_WORDS = 100_000, 1_000_000
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: UTF-8 bytes to themselves if part of a word, A-Z to a-z, the rest to blanks.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_SPANS, _ROW = "array<struct<start:int,stop:int>>", "decontaminate_row"
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])
_FOUND = [T.StructField("n_words", T.LongType()), T.StructField("hit_spans", T.ArrayType(_SPAN)), T.StructField("items", T.ArrayType(T.StringType()))]


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item, words): the distinct windows of each item."""
    w = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(ITEM_WORD), F.lit(0))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1))
    return (
        items.select(F.col("item_id").cast("string").alias("item"), w.alias("w"))
        .filter(F.col("item").isNotNull() & (F.size("w") > 0))
        .withColumn("words", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))))
        .select("item", "words")
        .distinct()
    )


def _doc_words() -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce("text", F.lit(""))), F.lit(ITEM_WORD), F.lit(0))


def word_frequencies(docs: DataFrame, vocabulary: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """(word, n): in how many documents each word of a vocabulary (word), of distinct words, occurs; all documents count."""
    if vocabulary.count() > max_words:
        return docs.select(F.explode(F.array_distinct(_doc_words())).alias("word")).join(vocabulary, "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))
    shared = docs.sparkSession.sparkContext.broadcast({r.word.encode() for r in vocabulary.collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[bytes, int] = defaultdict(int)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for word in shared.value.intersection(words_of(text)):
                    count[word] += 1
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in count], pa.string()), pa.array(count.values(), pa.int64())], names=["word", "n"])

    partial = docs.select(F.col("text").cast("binary")).mapInArrow(run, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def prefixes(windows: DataFrame, df: DataFrame) -> DataFrame:
    """(word, place, words, item): windows (item, words) by their rarest word and its place; ties go to the word that sorts first."""
    each = windows.select("words").distinct().select("words", F.posexplode("words").alias("place", "word"))
    rank = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "place")
    rarest = each.join(df, "word", "left").groupBy("words").agg(F.min(rank).alias("m"))
    return rarest.select("words", "m.word", "m.place").join(windows, "words").select("word", "place", "words", "item")


def prefix_index(rows: list) -> dict[bytes, list]:
    """Rarest word to [(its place in the window, window, items)]."""
    items: dict[tuple, list[str]] = defaultdict(list)
    for r in rows:
        items[(r.word, r.place, tuple(r.words))].append(r.item)
    index: dict[bytes, list] = defaultdict(list)
    for (word, place, words), names in items.items():
        index[word.encode()].append((place, [w.encode() for w in words], names))
    return dict(index)


def match(words: list[bytes], index: dict[bytes, list], seen: set[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Where windows occur, as disjoint spans of words, and their items."""
    spans: list[tuple[int, int]] = []
    names: set[str] = set()
    for at, word in enumerate(words):
        if word in seen:
            for place, window, items in index[word]:
                start, stop = at - place, at - place + len(window)
                if start >= 0 and stop <= len(words) and words[start:stop] == window:
                    spans.append((start, stop))
                    names.update(items)
    return merge(spans), names


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def scan(docs: DataFrame, index: dict[bytes, list]) -> DataFrame:
    """docs with n_words, hit_spans and items, by an index of windows that every task holds."""
    shared = docs.sparkSession.sparkContext.broadcast((index, set(index)))
    schema = T.StructType([*docs.schema.fields, *_FOUND])
    column = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, known = shared.value
        for batch in batches:
            n_words, all_spans, all_items = [], [], []
            for text in batch.column(column).cast(pa.binary()).to_pylist():
                words = words_of(text)
                seen = known.intersection(words)
                spans, names = match(words, index, seen) if seen else ([], set())
                n_words.append(len(words))
                all_spans.append([{"start": a, "stop": b} for a, b in spans])
                all_items.append(sorted(names))
            new = [pa.array(n_words, pa.int64()), pa.array(all_spans, _ARROW_SPANS), pa.array(all_items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=schema.names)

    return docs.mapInArrow(run, schema)


def join_windows(docs: DataFrame, index: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """docs with n_words, hit_spans and items, by joins: of words with prefix words, and of what meets with the document again."""
    rows = stash(docs.select(F.monotonically_increasing_id().alias(_ROW), F.struct(*[f"`{c}`" for c in docs.columns]).alias("doc")), "rows")
    own = rows.select(_ROW, F.col("doc.text").alias("text")).select(_ROW, _doc_words().alias("w"))
    spots = own.select(_ROW, F.size("w").alias("n"), F.posexplode("w").alias("p", "word"))
    known = index.select("word").distinct()
    if known.count() <= max_words:
        spots = spots.join(F.broadcast(known), "word", "left_semi")
    start = F.col("p") - F.col("place")
    met = spots.join(index, "word").select(_ROW, "n", start.alias("start"), (start + F.size("words")).alias("stop"), "words", "item")
    met = met.filter("start >= 0 AND stop <= n").join(own, _ROW)
    hits = met.filter(F.slice("w", F.col("start") + 1, F.size("words")) == F.col("words"))
    per = hits.groupBy(_ROW).agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"), F.sort_array(F.collect_set("item")).alias("items"))
    merged = F.aggregate("spans", F.array().cast(_SPANS), _with_span)
    out = rows.join(per.select(_ROW, merged.alias("hit_spans"), "items"), _ROW, "left")
    none = {"hit_spans": F.array().cast(_SPANS), "items": F.array().cast("array<string>")}
    n_words = F.size(F.regexp_extract_all(lower_ascii(F.coalesce("doc.text", F.lit(""))), F.lit(ITEM_WORD), F.lit(0))).cast("long")
    return out.select(*[F.col(f"doc.`{c}`") for c in docs.columns], n_words.alias("n_words"), *[F.coalesce(c, n).alias(c) for c, n in none.items()])


def _with_span(spans: Column, x: Column) -> Column:
    last = F.element_at(spans, -1)
    longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"))
    apart = (F.size(spans) == 0) | (x["start"] > F.coalesce(F.try_element_at(spans, F.lit(-1))["stop"], F.lit(-1)))
    return F.when(apart, F.concat(spans, F.array(x))).otherwise(F.concat(F.slice(spans, 1, F.size(spans) - 1), F.array(longer)))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_windows: int = MAX_WINDOWS, max_words: int = MAX_WORDS) -> DataFrame:
    """docs with n_words, n_hit, hit_spans (in words), items (sorted as strings) and contaminated added."""
    docs = docs.drop("n_words", "n_hit", "hit_spans", "items", "contaminated")
    windows = stash(item_windows(items.select("item_id", "text"), window), "windows")
    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    index = stash(prefixes(windows, word_frequencies(docs.select("text"), vocabulary, max_words)), "prefixes")
    if index.count() <= max_windows:
        out = scan(docs, prefix_index(index.collect()))
    else:
        out = join_windows(docs, index, max_words)
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return out.withColumn("n_hit", hit).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 100 >= F.col("n_words") * MIN_PERCENT))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


SQL = r"""
WITH low AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
item AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
),
win AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[p : p + 12], ' ') AS key
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS p FROM item WHERE len(w) > 0)
),
size AS (SELECT DISTINCT n FROM win),
spot AS (
  SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') AS key
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM low, size WHERE len(w) >= n)
),
hit AS (SELECT doc_id, p, spot.n, item FROM spot JOIN win ON spot.n = win.n AND spot.key = win.key),
pos AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
names AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM low LEFT JOIN pos USING (doc_id) LEFT JOIN names USING (doc_id)
"""
