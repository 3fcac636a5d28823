"""Collections: catalog tables of text, JSON metadata and vectors.

A vector column is an array of floats tagged vector=true in its metadata, with
its declared dimension and format where they are known.

A collection is partitioned by a bucket of its rows' source, so that deleting or
replacing a document reads and rewrites the buckets of its source and leaves the
files of all others as they are. What is to be written is stored in the run's
folder first; the table changes by one job that swaps the touched partitions
when it commits. One writer at a time changes a collection.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.functions.text import json_text
from paperloom.model import COLLECTION_NAME
from paperloom.storage import stored

#: () -> texts -> vectors; the outer call runs once per task
EmbedderFactory = Callable[[], Callable[[list[str]], list[list[float]]]]


#: Fixed value: what stands for a table's missing comment.
NO_COMMENT = "(no table comment)"
#: Partitions of a collection.
BUCKETS = 64
#: Texts that are embedded by one call.
AT_ONCE = 1000


def safe_name(name: str) -> str:
    """A collection's name, stripped and in upper case; an error unless it is a letter and then letters, digits, _, $ or #."""
    name = (name or "").strip().upper()
    if not re.fullmatch(COLLECTION_NAME, name):
        raise ValueError(f"not a collection name: {name!r}")
    return name


def _quoted(name: str) -> str:
    return f"`{safe_name(name)}`"


def require_member(value, allowed) -> None:
    if value not in allowed:
        raise ValueError(f"{value!r} is not one of {list(allowed)}")


def is_vector(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.FloatType | T.DoubleType) and bool(field.metadata.get("vector"))


def list_collections(spark: SparkSession) -> DataFrame:
    """(name) of the tables of the current schema that have a vector column, in order. Reads the catalog, no data."""
    tables = [t.name for t in spark.catalog.listTables() if not t.isTemporary and re.fullmatch(COLLECTION_NAME, t.name)]
    names = sorted({t.upper() for t in tables if any(map(is_vector, spark.table(f"`{t}`").schema.fields))})
    return spark.createDataFrame([(n,) for n in names], "name STRING")


def sources(collection: DataFrame) -> DataFrame:
    """collection with source, the scalar at $.source of its metadata."""
    return collection.withColumn("source", json_text(F.col("metadata"), "$.source"))


def list_documents(collection: DataFrame) -> DataFrame:
    """(document): distinct sources in order; rows without one give one null, last."""
    return sources(collection).select(F.col("source").alias("document")).distinct().orderBy(F.asc_nulls_last("document"))


def inspect(collection: DataFrame) -> DataFrame:
    """(document, n_chunks) per source in order; rows without a source are left out."""
    per = sources(collection).filter("source IS NOT NULL").groupBy(F.col("source").alias("document")).agg(F.count("*").alias("n_chunks"))
    return per.orderBy("document")


def inspect_totals(collection: DataFrame) -> DataFrame:
    """(documents, chunks) over all sources."""
    return inspect(collection).agg(F.count("*").alias("documents"), F.coalesce(F.sum("n_chunks"), F.lit(0)).alias("chunks"))


def analyze(collection: DataFrame, mode: str = "declared") -> DataFrame:
    """(metric, value, n): the records, and counts by dimension and by format of each vector column, added up.

    declared takes dimension and format from the column's metadata and counts
    null vectors too; actual takes the size of each vector and skips nulls.
    """
    require_member(mode, ("declared", "actual"))
    vectors = [f for f in collection.schema.fields if is_vector(f) or (mode == "actual" and isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.FloatType | T.DoubleType))]
    records = collection.agg(F.count("*").alias("n")).select(F.lit("records").alias("metric"), F.lit("").alias("value"), "n")
    if not vectors:
        return records
    kinds = {"float": "FLOAT32", "double": "FLOAT64"}

    def facts(f: T.StructField):
        form = f.metadata.get("format", kinds[f.dataType.elementType.simpleString()])
        dimension = F.lit(str(f.metadata.get("dimension", "*"))) if mode == "declared" else F.size(F.col(f"`{f.name}`")).cast("string")
        there = F.lit(True) if mode == "declared" else F.col(f"`{f.name}`").isNotNull()
        return F.when(there, F.array(F.struct(F.lit("dimension").alias("metric"), dimension.alias("value")), F.struct(F.lit("format").alias("metric"), F.lit(form).alias("value"))))

    every = F.flatten(F.filter(F.array(*map(facts, vectors)), lambda x: x.isNotNull()))
    counted = collection.select(F.explode(every).alias("f")).groupBy("f.metric", "f.value").agg(F.count("*").alias("n"))
    return records.unionByName(counted)


def without_documents(collection: DataFrame, names: DataFrame) -> DataFrame:
    """collection without the rows whose source is in names (document). Rows without a source stay."""
    names = names.select(F.col("document").alias("_gone")).filter("_gone IS NOT NULL").distinct()
    found = sources(collection)
    return found.join(names, found["source"] == names["_gone"], "left_anti").select(*collection.columns)


def bucket_of(source: Column) -> Column:
    """The partition of a source's rows; rows without a source have one too."""
    return F.pmod(F.xxhash64(F.coalesce(source, F.lit(""))), F.lit(BUCKETS)).cast("int")


def _bucketed(rows: DataFrame) -> DataFrame:
    """rows with their bucket, dealt out so that each bucket is few files, and a large one several."""
    return rows.withColumn("bucket", bucket_of(json_text(F.col("metadata"), "$.source"))).hint("rebalance", "bucket")


def _counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """rows, whose number is known once they are written as they are; a plan may drop what lies below a join."""
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("n")), seen


def is_bucketed(spark: SparkSession, name: str) -> bool:
    return "bucket" in [c.name for c in spark.catalog.listColumns(_quoted(name)) if c.isPartition]


def delete_documents(spark: SparkSession, name: str, documents: list[str]) -> int:
    """Deletes the rows of some documents in one step; returns how many there were."""
    return _without(spark, name, spark.createDataFrame([(d,) for d in documents], "document STRING"), None)


def _without(spark: SparkSession, name: str, names: DataFrame, added: DataFrame | None) -> int:
    """Takes the rows of the documents names (document) out, and puts the stored rows added in; returns how many it took out."""
    safe = safe_name(name)
    if not is_bucketed(spark, safe):
        return _rewritten(spark, safe, names, added)
    table = spark.table(_quoted(safe))
    touched = sorted(r.bucket for r in names.select(bucket_of(F.col("document")).alias("bucket")).distinct().collect())
    if not touched:
        return 0
    old = table.filter(F.col("bucket").isin(touched))
    kept = stored(without_documents(old, names), "kept-rows")
    # both counts read file footers only
    removed = old.count() - kept.count()
    rows = kept if added is None else kept.unionByName(added, allowMissingColumns=True)
    full = {r.bucket for r in rows.select("bucket").distinct().collect()}
    if full:
        with _dynamic(spark):
            rows.select(*table.columns).hint("rebalance", "bucket").write.mode("overwrite").insertInto(_quoted(safe))
    for bucket in set(touched) - full:
        _drop_bucket(spark, safe, bucket)
    spark.catalog.refreshTable(_quoted(safe))
    return removed


@contextmanager
def _dynamic(spark: SparkSession) -> Iterator[None]:
    """In here, an overwrite replaces the partitions that it has rows for, and no others. insertInto takes this from the session only."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _drop_bucket(spark: SparkSession, safe: str, bucket: int) -> None:
    """A bucket whose last row goes has nothing to overwrite it with."""
    if spark.conf.get("spark.sql.catalogImplementation") == "hive":
        spark.sql(f"ALTER TABLE {_quoted(safe)} DROP IF EXISTS PARTITION (bucket={bucket})")
        return
    where = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(safe)}").filter("col_name = 'Location'").first().data_type
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{where}/bucket={bucket}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _rewritten(spark: SparkSession, safe: str, names: DataFrame, added: DataFrame | None) -> int:
    """The same for a table without buckets: what stays is written whole to a new table, which then takes the old one's name."""
    new = _new_name(safe)
    old = spark.table(_quoted(safe))
    kept = stored(without_documents(old, names), "kept-rows")
    removed = old.count() - kept.count()
    rows = kept if added is None else kept.unionByName(added.drop("bucket"), allowMissingColumns=True)
    rows.write.saveAsTable(f"`{new}`")
    _swap(spark, safe, new)
    return removed


def _new_name(name: str) -> str:
    """A name that no collection can have."""
    return f"_{safe_name(name)}_{uuid.uuid4().hex[:8]}"


def _swap(spark: SparkSession, safe: str, new: str) -> None:
    """A new table, which is whole, takes the place of another and its comment.

    The old table is renamed before it is dropped, so a failure at any point
    leaves all its rows under one name or the other.
    """
    comment, old = table_comment(spark, safe), _new_name(safe)
    spark.sql(f"ALTER TABLE {_quoted(safe)} RENAME TO `{old}`")
    spark.sql(f"ALTER TABLE `{new}` RENAME TO {_quoted(safe)}")
    if comment:
        set_table_comment(spark, safe, comment)
    spark.sql(f"DROP TABLE `{old}`")


def drop_collection(spark: SparkSession, name: str) -> None:
    """Drops a collection; one that is missing is an error."""
    spark.sql(f"DROP TABLE {_quoted(name)}")
    spark.sql(f"DROP TABLE IF EXISTS `{_ledger(name)}`")


def table_comment(spark: SparkSession, name: str) -> str:
    """A table's comment, or the empty string if it has none or is missing. The name is stripped and in upper case."""
    quoted = "`" + (name or "").strip().upper().replace("`", "``") + "`"
    if quoted == "``" or not spark.catalog.tableExists(quoted):
        return ""
    return spark.catalog.getTable(quoted).description or ""


def set_table_comment(spark: SparkSession, name: str, comment: str) -> None:
    text = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {_quoted(name)} IS '{text}'")


def describe_table(spark: SparkSession, name: str) -> str:
    """What is printed of a table: its comment, or that it has none."""
    return table_comment(spark, name) or NO_COMMENT


def hash_embedder(dimension: int = 64) -> EmbedderFactory:
    """A deterministic stand-in for an embedding model: signed word hashes, scaled to length one."""

    def factory():
        def embed(texts: list[str]) -> list[list[float]]:
            out = np.zeros((len(texts), dimension), np.float32)
            for row, text in zip(out, texts):
                for word in text.split():
                    h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
                    row[h % dimension] += 1 if h >> 63 else -1
                row /= max(float(np.linalg.norm(row)), 1e-9)
            return out.tolist()

        return embed

    return factory


def embed(chunks: DataFrame, factory: EmbedderFactory, dimension: int | None = None) -> DataFrame:
    """Rows of a collection from chunks (text, metadata map): id, text, metadata as JSON, embedding."""

    @F.pandas_udf("array<float>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for texts in batches:
            # vectors of a whole batch, as lists, take several times the room of its texts
            for k in range(0, len(texts), AT_ONCE):
                yield pd.Series(model(texts.iloc[k : k + AT_ONCE].tolist()), dtype=object)

    tag = {"vector": True, "format": "FLOAT32"} | ({"dimension": dimension} if dimension else {})
    return chunks.select(
        F.uuid().alias("id"), "text", F.to_json("metadata").alias("metadata"), vectors.asNondeterministic()(F.col("text")).alias("embedding", metadata=tag)
    )


def _ledger(name: str) -> str:
    """The table of a collection's named batches: (batch, done)."""
    return f"_{safe_name(name)}_BATCHES"


def _begun(spark: SparkSession, name: str, batch: str) -> bool | None:
    """Whether a batch is done; None if it was never begun."""
    if not spark.catalog.tableExists(f"`{_ledger(name)}`"):
        return None
    spark.catalog.refreshTable(f"`{_ledger(name)}`")
    return spark.table(f"`{_ledger(name)}`").filter(F.col("batch") == batch).agg(F.max("done")).first()[0]


def _note(spark: SparkSession, name: str, batch: str, done: bool) -> None:
    spark.createDataFrame([(batch, done)], "batch STRING, done BOOLEAN").coalesce(1).write.mode("append").saveAsTable(f"`{_ledger(name)}`")


def load(
    spark: SparkSession, name: str, chunks: DataFrame, factory: EmbedderFactory, dimension: int | None = None, replace: bool = False, batch: str | None = None
) -> int:
    """Adds chunks to a collection and makes it if need be; returns how many it added. Without chunks nothing happens.

    Chunks are embedded once, into the run's folder, and counted as they are
    written. Chunks loaded twice are there twice, unless replace takes out the
    rows of the sources that are loaded: their buckets are then rewritten, no
    others. A batch, known by its name, is added once only, however often it is
    loaded: a small table notes it before and after. Only where a run broke off
    in between is the collection itself asked whether the batch is there.
    """
    safe = safe_name(name)
    there = spark.catalog.tableExists(_quoted(safe))
    begun = _begun(spark, safe, batch) if batch else None
    if there:
        spark.catalog.refreshTable(_quoted(safe))
    if begun or (begun is False and there and not spark.table(_quoted(safe)).filter(F.col("batch") == batch).isEmpty()):
        if not begun:
            _note(spark, safe, batch, True)
        return 0
    made, seen = _counted(_bucketed(embed(chunks, factory, dimension).withColumn("batch", F.lit(batch).cast("string"))))
    made = stored(made, "embedded")
    count = seen.get["n"]
    if not count:
        return 0
    if batch:
        _note(spark, safe, batch, False)
    if not there:
        made.write.partitionBy("bucket").saveAsTable(_quoted(safe))
    elif replace:
        _without(spark, safe, sources(made).select(F.col("source").alias("document")).distinct(), made)
    else:
        own = spark.table(_quoted(safe)).columns
        added = made.select(*[c for c in made.columns if c in own])
        (added.write.partitionBy("bucket") if is_bucketed(spark, safe) else added.write).mode("append").saveAsTable(_quoted(safe))
    if batch:
        _note(spark, safe, batch, True)
    return count


def most_similar(collection: DataFrame, vector: list[float], k: int) -> DataFrame:
    """The k rows nearest to a vector by cosine, exact; ties by id."""
    query = F.array(*[F.lit(float(x)) for x in vector])
    dot = F.aggregate(F.zip_with("embedding", query, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    return collection.withColumn("similarity", dot / norm / float(np.linalg.norm(vector))).orderBy(F.desc("similarity"), "id").limit(k)
