"""What the operators of this subpackage share: tables, words, shared storage."""

from __future__ import annotations

import gc
import re
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but blank and the controls TAB to CR.
WORD = r"[^\x20\x09-\x0D]+"

_folders: dict[str, str] = {}
_local = threading.local()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def computed_once(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with columns computed before any later filter on them.

    A filter on a column made of nested lambdas would else be pushed below the
    projections that make it and spell each of them out at every use.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    row, own = F.struct(*[F.col(f"`{c}`") for c in columns]), unused(df, "computed")
    held = df.select(*rest, F.explode(F.array(row)).alias(own))
    return held.select(*rest, *[F.col(f"{own}.`{c}`").alias(c) for c in columns])


def unused(df: DataFrame, name: str) -> str:
    """A name that starts as no column of df does, for columns that go again."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name += "_"
    return name


def broadcast_if(df: DataFrame, most: int) -> DataFrame:
    """df, a stored table, marked for broadcast if it has no more than so many rows; as it is otherwise."""
    return F.broadcast(df) if df.count() <= most else df


#: Bitmaps of 4 KB, one for 32,768 ids, that a task may hold: 64 MB.
MOST_BITMAPS = 16_384


def among(df: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of df whose id (long) is in ids, a table with repeats allowed.

    Ids travel to the tasks as one bit for each id of a range that holds any, so
    that df, which may carry whole texts, is not shuffled. Where ranges are more
    than MOST_BITMAPS the two are joined on id instead.
    """
    columns, bucket, bits = [F.col(f"`{c}`") for c in df.columns], unused(df, "ids_of"), unused(df, "ids_bits")
    place = F.bitmap_bit_position("id")
    dealt = ids.select("id").repartition(F.bitmap_bucket_number("id"))
    maps = dealt.groupBy(F.bitmap_bucket_number("id").alias(bucket)).agg(F.bitmap_construct_agg(place).alias(bits))
    # as 512 longs: a binary would be copied whole for each row that looks a bit up
    eight = lambda i: F.conv(F.hex(F.substr(bits, i * 8 + 1, F.lit(8))), 16, -10).cast("long")
    maps = stash(maps.select(bucket, F.transform(F.sequence(F.lit(0), F.lit(511)), eight).alias(bits)), "ids")
    if maps.count() > MOST_BITMAPS:
        return df.join(ids.select("id").distinct(), "id", "left_semi").select(*columns)
    # the first of eight bytes is a long's highest
    byte, bit = F.shiftright(place, 3) % 8, place % 8
    met = df.join(F.broadcast(maps), F.bitmap_bucket_number("id") == F.col(bucket))
    return met.filter(F.getbit(F.get(bits, F.shiftright(place, 6).cast("int")), (56 - 8 * byte + bit).cast("int")) == 1).select(*columns)


def setting(spark: SparkSession, key: str) -> str | None:
    return spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application that driver and executors all see, gone when the application's JVM ends.

    It lies in spark.checkpoint.dir. Only where that is unset and everything runs
    in one process, as in tests, a temporary folder takes its place.
    """
    app = spark.sparkContext.applicationId
    if app not in _folders:
        root = setting(spark, "spark.checkpoint.dir")
        if not root and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = root.rstrip("/") if root else f"file://{tempfile.mkdtemp(prefix='paperloom-')}"
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/paperloom-{app}")
        system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        system.mkdirs(where)
        system.deleteOnExit(where)
        _folders[app] = f"{root}/paperloom-{app}"
    return _folders[app]


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def settled(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What make gives, stashed; the tables that make itself has stashed are deleted then."""
    made: list[str] = []
    _local.made = [*getattr(_local, "made", []), made]
    try:
        out = stash(make(), label)
    finally:
        _local.made = _local.made[:-1]
    spark = out.sparkSession
    for path in made[:-1]:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    return out


def stash(df: DataFrame, label: str, tidy: bool = False) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back.

    This cuts lineage: later steps, retries and lost executors read the files
    and never repeat the work. tidy first lets Spark drop the shuffle files behind
    earlier tables: it does when the driver finds them unused, and a driver with
    little garbage of its own seldom looks.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, label)
    if tidy:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    df.write.option("compression", "zstd").parquet(path)
    for made in getattr(_local, "made", []):
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)
