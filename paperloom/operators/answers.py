"""Model answers that are asked for once: a ledger keyed by image, prompt and model.

An answer's key is a digest of the image's bytes, the prompt and the model's id.
Equal images are one question, whatever page they are on; what the ledger has is
not asked again. What is missing is stored and then asked in runs of a bounded
number of questions, each appended to the ledger as it ends, so a job that is
killed loses one run of answers and no more.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.storage import new_folder, stored

#: () -> (image, prompt) -> answer; the outer call runs once per task
ModelFactory = Callable[[], Callable[[bytes, str], str]]
LEDGER = "key STRING, model_id STRING, answer STRING"
#: Questions of one run.
RUN = 10_000


def question(image: Column, prompt: str, model_id: str) -> Column:
    """The key of a question; null for a page without an image."""
    parts = [F.sha2(image, 256), F.lit(prompt), F.lit(model_id)]
    return F.when(image.isNotNull(), F.sha2(F.concat_ws("\x00", *parts), 256))


def _ledger_rows(spark: SparkSession, path: str) -> DataFrame:
    """(key, answer) of all that a ledger has now; empty if there is none yet.

    The condition holds for every key. Without it Spark takes two reads of one folder for the same, though files were added in between.
    """
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], "key STRING, answer STRING")
    return spark.read.schema(LEDGER).parquet(path).filter(F.col("key") != F.lit(f"read {uuid.uuid4().hex}")).select("key", "answer")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(key, answer) of a ledger, one row for a key; empty if there is none yet."""
    # two jobs at once may have asked the same
    return _ledger_rows(spark, path).groupBy("key").agg(F.min("answer").alias("answer"))


def asked(image: Column, factory: ModelFactory, prompt: str) -> Column:
    """The model's stripped answers for images; none without an image."""

    @F.pandas_udf("string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for images in batches:
            if images.isna().any():
                raise RuntimeError("the model needs the image of the page")
            yield images.map(lambda image: str(model(image, prompt)).strip())

    return ask.asNondeterministic()(image)


def ask_missing(frame: DataFrame, factory: ModelFactory, prompt: str, model_id: str, ledger: str, prepare: Callable[[Column], Column] | None = None, run: int = RUN) -> DataFrame:
    """Asks what the ledger lacks for the images of frame, a stored table; returns the keys of all, stored."""
    spark = frame.sparkSession
    key = F.coalesce(question(F.col("image"), prompt, model_id), F.lit(""))
    given = F.when(F.col("image").isNull(), F.raise_error(F.lit("the model needs the image of the page")).cast("binary")).otherwise(F.col("image"))
    keys = stored(frame.select(key.alias("key")).distinct(), "keys")
    missing = stored(keys.join(_ledger_rows(spark, ledger), "key", "left_anti"), "missing")
    n = missing.count()
    if not n:
        return keys
    runs, share = -(-n // run), spark.sparkContext.defaultParallelism
    # images travel once: all of a key are in one slot, and a run is so many slots, each a file at most
    slot = F.pmod(F.xxhash64("key"), F.lit(runs * share)).cast("int").alias("slot")
    images = frame.select(key.alias("key"), given.alias("image")).select(slot, "key", "image").repartition("slot")
    dealt = images.join(missing.select(slot, "key"), ["slot", "key"], "left_semi").dropDuplicates(["slot", "key"])
    todo = new_folder(spark, "questions")
    dealt.select("key", "image", F.floor(F.col("slot") / share).cast("int").alias("run")).write.partitionBy("run").parquet(todo)
    open_ = spark.read.schema("key STRING, image BINARY, run INT").parquet(todo)
    for number in range(runs):
        now = open_.filter(F.col("run") == number)
        if 4 * now.rdd.getNumPartitions() < 3 * share:
            # a call takes long: every core gets its share of a run's questions
            now = now.repartition(share, "key")
        image = prepare(F.col("image")) if prepare else F.col("image")
        answers = now.select("key", F.lit(model_id).alias("model_id"), asked(image, factory, prompt).alias("answer"))
        answers.write.mode("append").parquet(ledger)
    return keys


def looked_up(frame: DataFrame, keys: DataFrame, key: Column, ledger: str, out: str) -> DataFrame:
    """frame with the ledger's answer to its question as out; the ledger must have all of keys.

    The key becomes a column before anything is joined, so an image that nobody reads afterwards doesn't travel.
    """
    rows = _ledger_rows(frame.sparkSession, ledger)
    found = rows.select("key").join(keys, "key", "left_semi").agg(F.count("*").alias("rows"), F.countDistinct("key").alias("keys")).first()
    if found.keys != keys.count():
        raise RuntimeError("the ledger lacks answers that were asked for")
    if found.rows > found.keys or rows.count() > 2 * found.rows:
        # two jobs at once asked the same, or most of the ledger is not asked for
        rows = stored(rows.join(keys, "key", "left_semi").groupBy("key").agg(F.min("answer").alias("answer")), "answers")
    rows = rows.withColumnsRenamed({"key": "_answered_key", "answer": out})
    return frame.withColumn("_asked_key", key).join(rows, F.col("_asked_key") == F.col("_answered_key"), "left").drop("_answered_key", "_asked_key")


def answered(frame: DataFrame, factory: ModelFactory, prompt: str, model_id: str, ledger: str, out: str, prepare: Callable[[Column], Column] | None = None, run: int = RUN) -> DataFrame:
    """frame, a stored table with an image column, with the answer for each image as out; the ledger has them all afterwards.

    prepare makes of an image what the model takes; it is done for questions only. A page without an image is an error.
    """
    keys = ask_missing(frame, factory, prompt, model_id, ledger, prepare, run)
    return looked_up(frame, keys, question(F.col("image"), prompt, model_id), ledger, out)
