"""Operator 9: near-duplicate documents by fast similarity sketches.

Documents whose sets of five-word shingles share 75 percent or more of their
union are linked; a component keeps its smallest doc_id. Documents with equal
sets form one class first, so thousands of copies cost one sketch in the steps
that follow. See similar.py for sketches, bands and the confirmation of links on
full sets (of 64-bit shingle hashes), and graph.py for components.

Defined results: null texts and texts without words have an empty set and stay
alone; rows without doc_id stay alone too, with a null component; rows that
share a doc_id are one document, linked with whatever one of their texts is
linked with, and each has the size of its own set; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import among, stash, table
from .similar import bands_of, mix, near_components, sketches

SHINGLE, PERCENT = 5, 75
#: 32 bands of 6 coordinates: a pair at 75 percent is missed once in 500 times, at 80 once in 16,000.
BANDS, ROWS = 32, 6
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Word to 64-bit hash; forgets all when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def _hashes_of(text: bytes | None) -> np.ndarray:
    """The hashes of the five-word shingles of a UTF-8 text, with repeats."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    one = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = len(words) - SHINGLE + 1
    all_ = one[:n]
    for k in range(1, SHINGLE):
        all_ = all_ * _STEP + one[k : k + n]
    return mix(all_)


def hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    each = [_hashes_of(t) for t in texts]
    return np.concatenate(each), np.array([len(x) for x in each], np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for start in range(0, whole.num_rows, 512):
            batch = whole.slice(start, 512)
            sets = [np.unique(_hashes_of(t)) for t in batch.column(1).to_pylist()]
            size = np.array([len(s) for s in sets], np.int64)
            bands = bands_of(sketches(np.concatenate(sets), size, BANDS * ROWS), ROWS)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(size),
                    pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()),
                    pa.array([b.tobytes() for b in bands], pa.binary()),
                ],
                names=["doc_id", "text", "n_shingles", "set_key", "bands"],
            )


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    bands = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
    return batch.column("id").to_numpy(), bands.reshape(batch.num_rows, BANDS)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of docs."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    made = docs.mapInArrow(_sketch, "doc_id long, text binary, n_shingles long, set_key binary, bands binary")
    made = stash(made.withColumn("row", F.monotonically_increasing_id()), "sketches")
    linked = made.filter("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", "set_key", "row")
    # a class is known by the least of its rows
    classes = stash(linked.groupBy("set_key").agg(F.min("row").alias("id"), F.min("doc_id").alias("first")), "classes")
    nodes = stash(among(made.select(F.col("row").alias("id"), "bands"), classes), "nodes")
    # rows of one doc_id are one document, so their classes belong together
    several = linked.groupBy("doc_id").agg(F.min("set_key").alias("set_key"), F.max("set_key").alias("other")).filter("set_key != other")
    several = linked.join(several.select("doc_id", F.col("set_key").alias("one")), "doc_id").select("one", "set_key").distinct()
    key = classes.select("id", "set_key")
    more = several.join(key.withColumnsRenamed({"id": "a", "set_key": "one"}), "one").join(key.withColumnRenamed("id", "b"), "set_key").select("a", "b")
    comp = near_components(nodes, BANDS, ROWS, _read, made.select(F.col("row").alias("id"), "text"), hashes, PERCENT, more)
    both = classes.join(comp, "id", "left")
    least = both.filter("comp IS NOT NULL").groupBy("comp").agg(F.min("first").alias("least"))
    of_class = both.join(least, "comp", "left").select("set_key", F.coalesce("least", "first").alias("component"))
    found = made.select("doc_id", "n_shingles", "set_key").join(of_class, "set_key", "left")
    own = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id", "n_shingles", own.alias("component_id"), (F.col("doc_id").isNull() | (own == F.col("doc_id"))).alias("kept")
    )


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
