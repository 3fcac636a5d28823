"""From a folder of files to their artefacts, in one call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.model import ClassifyConfig, ExtractConfig
from paperloom.operators import classify, extract
from paperloom.sources import file_sink, page_source
from paperloom.storage import new_folder, stored


def classify_folder(spark: SparkSession, path: str, reader: str, cfg: ClassifyConfig = ClassifyConfig(), **options) -> DataFrame:
    """(doc, label, reason) of the files below path, from sampled pages; one that can't be read has its error as its reason."""
    pages = page_source.scan(spark, path, reader, on_error="note", sample=cfg.sample_pages, **options)
    signals = pages.select("doc", (F.col("page_no") - 1).alias("page_idx"), classify.collapsed(F.col("text")).alias("text"), "has_image", "error")
    return classify.classify(signals, cfg)


def convert_folder(
    spark: SparkSession, path: str, reader: str, out: str, cfg: ExtractConfig = ExtractConfig(), factory: extract.ModelFactory | None = None,
    imaging: extract.Imaging | None = None, classes: ClassifyConfig = ClassifyConfig(), folder: str | None = None, **options,
) -> DataFrame:
    """Writes the artefact of each file below path to out; returns (doc, label, value).

    Files are classified unless cfg names their type or a mode that needs none,
    pages are read from the text layer, rendered if images are needed, tested for
    being blank, asked of the model where that is their route, and joined to
    artefacts in order. Images are written to images_dir, or out/images, if cfg
    says so. folder keeps the model's answers between runs. A file whose pages
    can't be read fails the run; nothing is written to out then.
    """
    folder = folder or new_folder(spark, "convert")
    limit = (lambda df: df.filter(F.col("page_no") <= cfg.max_pages)) if cfg.max_pages is not None else (lambda df: df)
    pages = limit(page_source.scan(spark, path, reader, **options)).select("doc", "page_no", "text")
    if extract.needs_images(cfg):
        images = limit(page_source.scan(spark, path, reader, what="images", dpi=cfg.dpi, **options))
        images = stored(images, "images", folder)
        if cfg.save_images:
            file_sink.write_image_files(images, cfg.images_dir or f"{out}/images")
        pages = extract.align(pages, images.select("doc", "page_no", "image"))
    if cfg.pdf_type is None and cfg.mode == extract.AUTO:
        labels = stored(classify_folder(spark, path, reader, classes, **options).select("doc", "label"), "labels", folder)
        pages = pages.join(labels, "doc", "left")
    else:
        pages = pages.withColumn("label", F.lit(cfg.pdf_type).cast("string"))
    texts = extract.extract_pages(pages, cfg, factory, folder, imaging)
    labelled = texts.join(stored(pages.select("doc", "label").distinct(), "types", folder), "doc")
    made = stored(extract.assemble(labelled, cfg, F.col("label"), ["label"]), "artefacts", folder)
    file_sink.write_artefact_files(made, out)
    return made
