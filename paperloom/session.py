"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.chunkBase64String.enabled": "false",
    # conditions on pages and documents reach the page source
    "spark.sql.python.filterPushdown.enabled": "true",
    # page images are large: a batch ends at so many bytes, however few rows that is
    "spark.sql.execution.arrow.maxBytesPerBatch": "32m",
}


def new_session(app: str = "paperloom", **settings: str) -> SparkSession:
    return SparkSession.builder.appName(app).config(map=SETTINGS | settings).getOrCreate()


def connection_report(spark: SparkSession, secret_keys: tuple[str, ...] = ("password", "secret", "token"), keep: int = 2):
    """(key, value) of the session's settings as a DataFrame; values of secret keys are masked."""
    from pyspark.sql import functions as F

    from paperloom.functions.text import mask_secret

    conf = spark.sql("SET").select("key", "value")
    secret = F.lower("key").rlike("|".join(secret_keys))
    return conf.select("key", F.when(secret, mask_secret(F.col("value"), keep)).otherwise(F.col("value")).alias("value"))


def check_connection(spark: SparkSession) -> tuple[bool, str]:
    """Whether the session answers; never raises."""
    try:
        spark.sql("SELECT 1").collect()
    except Exception as error:  # noqa: BLE001
        return False, str(error)
    return True, "connection ok"
