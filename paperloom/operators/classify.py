"""Documents as text, scanned or mixed, from sampled pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import collapse as collapsed
from paperloom.model import MIXED, SCANNED_PDF, TEXT_PDF, ClassifyConfig
from paperloom.storage import stored


#: Documents whose page counts are broadcast; with more they are joined.
MAX_DOCS = 500_000


def sample_pages(pages: DataFrame, cfg: ClassifyConfig = ClassifyConfig()) -> DataFrame:
    """The sampled rows of (doc, page_idx, ...): every stride-th page, at most sample_pages of them.

    Pages are counted first, by doc alone, so texts stay where they are, and
    what is done with the result is done for sampled pages only.
    """
    counts = pages.filter("doc IS NOT NULL").groupBy("doc").agg(F.count("*").alias("_n"))
    counts = stored(counts, "page-counts")
    counts = F.broadcast(counts) if counts.count() <= MAX_DOCS else counts
    stride = F.greatest(F.lit(1), F.floor(F.col("_n") / F.least(F.lit(cfg.sample_pages), F.col("_n"))))
    place = F.col("page_idx") / stride
    return pages.join(counts, "doc").filter((F.col("page_idx") % stride == 0) & (place < cfg.sample_pages)).drop("_n")


def reason(chars: Column, text_pages: Column, ratio: Column) -> Column:
    # bround: half to even on the exact double, as formatting elsewhere does
    return F.format_string("text_chars=%d, text_pages=%d, image_ratio=%.2f", chars, text_pages, F.bround(ratio, 2))


def classify(signals: DataFrame, cfg: ClassifyConfig = ClassifyConfig()) -> DataFrame:
    """(doc, label, reason) from sampled signals (doc, page_idx, text, has_image[, error]).

    A row without page_idx stands for a document without pages, or with its
    error for one that can't be read. Texts have their white space collapsed.
    """
    error = F.max("error") if "error" in signals.columns else F.lit(None).cast("string")
    length, page = F.length(F.coalesce("text", F.lit(""))), F.col("page_idx").isNotNull()
    facts = signals.groupBy("doc").agg(
        F.count_if(page).alias("pages"),
        F.coalesce(F.sum(F.when(page, length)), F.lit(0)).alias("chars"),
        F.count_if(page & (length >= cfg.min_text_chars_page)).alias("text_pages"),
        F.count_if(page & F.coalesce("has_image", F.lit(False))).alias("image_pages"),
        error.alias("error"),
    )
    facts = facts.withColumn("ratio", F.col("image_pages") / F.greatest(F.lit(1), "pages"))
    has_text = (F.col("chars") >= cfg.min_text_chars_doc) | (F.col("text_pages") > 0)
    some_images, many = F.col("image_pages") > 0, F.col("ratio") >= cfg.scanned_ratio
    unread = F.col("error").isNotNull() | (F.col("pages") == 0)
    label = (
        F.when(unread, MIXED)
        .when(F.col("chars") >= cfg.strong_text_chars, TEXT_PDF)
        .when(has_text & (~some_images | ~many), TEXT_PDF)
        .when(~has_text & some_images & many, SCANNED_PDF)
        .otherwise(MIXED)
    )
    why = (
        F.when(F.col("error").isNotNull(), F.concat(F.lit("read_error="), "error"))
        .when(F.col("pages") == 0, "zero_pages")
        .otherwise(reason(F.col("chars"), F.col("text_pages"), F.col("ratio")))
    )
    return facts.select("doc", label.alias("label"), why.alias("reason"))


def classify_files(files: DataFrame, signals: Callable[[DataFrame], DataFrame], cache: DataFrame | None = None, cfg: ClassifyConfig = ClassifyConfig()) -> DataFrame:
    """(doc, digest, label, reason) of files (path, content). What is in cache (digest, label, reason) is not read again.

    signals makes the signals of files, as page_signals does. The result's digest, label and reason are the next cache.
    Files are hashed once and their digests stored; bytes are read again for new files only.
    """
    digests = stored(files.select("path", F.sha2("content", 256).alias("digest")), "digests")
    cached = None if cache is None else cache.select("digest", "label", "reason").dropDuplicates(["digest"])
    new = digests if cached is None else digests.join(cached.select("digest"), "digest", "left_anti")
    labels = classify(signals(files if cached is None else files.join(new.select("path"), "path", "left_semi")), cfg)
    made = labels.join(new.withColumnRenamed("path", "doc"), "doc").select("doc", "digest", "label", "reason")
    if cached is None:
        return made
    return made.unionByName(digests.withColumnRenamed("path", "doc").join(cached, "digest").select("doc", "digest", "label", "reason"))


def report_lines(labels: DataFrame, verbose: bool = False, mixed_as_scanned: bool = False) -> DataFrame:
    """(doc, line): what a run prints. With verbose the reason is shown and mixed_as_scanned has no effect."""
    plain = F.when(F.col("label") == MIXED, F.concat(F.lit("MIXED/UNKNOWN| "), "doc")).otherwise(F.concat(F.rpad("label", 13, " "), F.lit("| "), "doc"))
    lines = F.array(plain)
    if mixed_as_scanned:
        again = F.concat(F.rpad(F.lit(SCANNED_PDF), 13, " "), F.lit("| "), "doc")
        lines = F.when(F.col("label") == MIXED, F.array(plain, again)).otherwise(lines)
    if verbose:
        full = F.concat(F.rpad("label", 12, " "), F.lit("| "), "doc", F.lit(" | "), "reason")
        lines = F.when(F.coalesce("reason", F.lit("")) != "", F.array(full)).otherwise(lines)
    return labels.select("doc", F.explode(lines).alias("line"))
