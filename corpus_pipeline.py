"""The corpus pipeline: five stages from raw documents to encoded ones.

Each stage reads what the one before has written and applies one operator of
paperloom.llm to all of it:

1. quality rules: lines that fail go, rejected documents go
2. line dedup: of similar lines one stays; a document whose every line goes is
   a copy of lines kept elsewhere and goes too
3. near duplicates: one document of each group stays; rows without doc_id stay
4. decontamination: documents contaminated by benchmark items go
5. SentencePiece: every document's ids, counted and digested

The first four return the columns of documents, with text and n_chars as they
are then; extra columns of documents are carried along, whatever their names.

Defined results: a null or empty text fails the quality rules, so it goes there;
the other stages alone keep such rows. Rows without doc_id are never compared
with others: line dedup leaves their lines, the near stage keeps them, the rest
judges them by their text. Rows that repeat a doc_id are one document to line
dedup, which keeps the first of equal places, and single texts to the near
stage, which keeps one row of a group. Ties go to the least doc_id and then
place. Empty tables give empty results with the same columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import common, decontaminate, line_dedup, near_dedup, quality_rules, sentencepiece


#: The columns that an operator does not read, as one, so that none of its own meets one of theirs.
OTHERS = "corpus_pipeline_other_columns"


def _apart(docs: DataFrame) -> DataFrame:
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others, F.lit(0).alias(OTHERS)).alias(OTHERS))


def _as_documents(frame: DataFrame, columns: list[str], lengths: bool = False) -> DataFrame:
    def own(c: str) -> Column:
        if c in ("doc_id", "text"):
            return F.col(c)
        return F.length("text").cast("long").alias(c) if lengths and c == "n_chars" else F.col(f"{OTHERS}.`{c}`").alias(c)

    return frame.select(*map(own, columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(_apart(docs)).filter("kept").withColumn("text", F.col("clean_text"))
    return _as_documents(judged, docs.columns, lengths=True)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(_apart(docs)).filter((F.size("dropped") == 0) | (F.size("dropped") < F.col("n_lines")))
    return _as_documents(out, docs.columns, lengths=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, and every row without doc_id.

    Each row is judged by its own text: further rows of a doc_id get ids past all others here. Where ids are so
    great that none are left, all rows get new ones in the same order.
    """
    rows = common.stash(_apart(docs).withColumn("_row", F.monotonically_increasing_id()), "rows")
    own = F.col("doc_id").cast("long")
    shared = rows.filter("doc_id IS NOT NULL").groupBy(own.alias("_shared")).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    shared = shared.filter("_n > 1").drop("_n")
    most = rows.agg(F.max(own), F.max("_row")).first()
    top, last = most[0] or 0, most[1] or 0
    again = F.col("_first").isNotNull() & (F.col("_row") != F.col("_first"))
    rows = rows.join(shared, own == F.col("_shared"), "left")
    if top + 1 + last < 2**63:
        rows = rows.withColumn("_id", F.when(again, F.lit(top) + 1 + F.col("_row")).otherwise(own))
    else:
        places = rows.filter("doc_id IS NOT NULL").select("_row", own.alias("_own"), again.alias("_again"))
        places = places.repartitionByRange("_again", "_own", "_row").sortWithinPartitions("_again", "_own", "_row")
        places = common.stash(places.select(F.col("_row").alias("_placed"), F.monotonically_increasing_id().alias("_id")), "places")
        rows = rows.join(places, F.col("_row") == F.col("_placed"), "left").drop("_placed")
    judged = near_dedup.near_duplicates(rows.select(F.col("_id").alias("doc_id"), "text"))
    kept = judged.filter("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_id"))
    return _as_documents(rows.join(kept, "_id", "left_semi").unionByName(rows.filter("doc_id IS NULL")), docs.columns)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = common.table(spark, sf_dir, "benchmark")
    return _as_documents(decontaminate.decontaminate(_apart(docs), items).filter(~F.col("contaminated")), docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece.digests(docs, sentencepiece.model_path())


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near dedup", near_duplicates),
    ("decontamination", clean_of_benchmark),
    ("sentencepiece", tokens),
]

#: Similarity components can't be stated in SQL; tests/llm/test_pipeline.py holds run() against a brute-force version and stages to known results.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written to the shared folder and read by the next."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
