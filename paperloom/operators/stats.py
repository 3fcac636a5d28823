"""Statistics over texts and streams of tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def length_stats(texts: DataFrame, text: str = "text") -> DataFrame:
    """(mean, std, p75) of text lengths, rounded half to even; population deviation, linear percentile.

    Without rows this is an error, as a mean of nothing is.
    """
    length = F.length(text)

    def whole(value: Column) -> Column:
        found = F.bround(value).cast("long")
        return F.when(F.count("*") > 0, found).otherwise(F.raise_error(F.lit("no texts")).cast("long"))

    return texts.agg(
        whole(F.avg(length)).alias("mean"), whole(F.stddev_pop(length)).alias("std"), whole(F.percentile(length, 0.75)).alias("p75")
    )


def joined_stream(tokens: DataFrame) -> DataFrame:
    """One row per request of (request_id, seq, content, add_kw, resp_meta): text, n_chars, last_reason, last_meta.

    Empty pieces are skipped. The reason of a piece is add_kw if it says
    something, else resp_meta; the last one that says something counts.
    """
    said = F.coalesce(F.nullif("add_kw", F.lit("")), F.nullif("resp_meta", F.lit("")))
    meta = F.nullif("resp_meta", F.lit(""))
    tokens = tokens.withColumns({"_said": said, "_meta": meta, "_piece": F.nullif("content", F.lit(""))})
    return tokens.groupBy("request_id").agg(
        F.coalesce(F.expr("listagg(_piece, '') WITHIN GROUP (ORDER BY seq)"), F.lit("")).alias("text"),
        F.coalesce(F.sum(F.length("_piece")), F.lit(0)).alias("n_chars"),
        F.expr("max_by(_said, seq) FILTER (WHERE _said IS NOT NULL)").alias("last_reason"),
        F.expr("max_by(_meta, seq) FILTER (WHERE _meta IS NOT NULL)").alias("last_meta"),
    )
