"""Text of pages by the cheapest source that will do, and artefacts of documents.

A page is routed first: blank, text layer, or vision model. Each route is a
branch of its own, so the model sees the pages of its branch and no others;
a Python function inside a conditional would run for every row.
"""

from __future__ import annotations

import io
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import prompts
from paperloom.functions import text as T
from paperloom.model import AUTO, LAYER, VISION, ExtractConfig
from paperloom.operators.answers import ModelFactory, ask_missing, looked_up, question
from paperloom.storage import new_folder, stored

BLANK_ROUTE, LAYER_ROUTE, MODEL_ROUTE = "blank", "layer", "model"


@dataclass(frozen=True)
class Imaging:
    """How page images are read: as pictures with PIL's interface, and as arrays of grey levels. None takes PIL."""

    open_image: Callable[[bytes], object] | None = None
    grey: Callable[[bytes], object] | None = None


def needs_images(cfg: ExtractConfig) -> bool:
    """Whether a run reads page images at all."""
    return cfg.save_images or cfg.describe_figures or cfg.mode != LAYER


def needs_model(cfg: ExtractConfig, mode: str | None) -> bool:
    """Whether a run may call the model; with per-document modes it may."""
    return cfg.describe_figures or mode != LAYER


def align(texts: DataFrame | None, images: DataFrame | None, max_pages: int | None = None) -> DataFrame:
    """Texts and images of the same pages of a document; one side alone stands as it is."""
    if texts is None and images is None:
        raise ValueError("no pages: neither texts nor images are given")
    limit = (lambda df: df.filter(F.col("page_no") <= max_pages)) if max_pages is not None else (lambda df: df)
    if texts is None or images is None:
        return limit(images if texts is None else texts)
    return limit(texts).join(limit(images), ["doc", "page_no"], "inner")


def nonwhite_ratio(image: Column, cfg: ExtractConfig, decode: Callable[[bytes], "object"] | None = None) -> Column:
    """Share of grey pixels darker than the threshold, in the middle 80 percent of each side if asked for.

    decode gives a two-dimensional array of grey levels; by default it reads
    PNG and JPEG with PIL. An image without pixels is an error.
    """
    crop, threshold = cfg.center_crop, cfg.white_threshold

    @F.pandas_udf("double")
    def ratio(images: pd.Series) -> pd.Series:
        def one(data):
            import numpy as np

            if data is None:
                return None
            grey = np.asarray(decode(data) if decode else _grey(data))
            if crop:
                h, w = grey.shape
                grey = grey[int(h * 0.1) : int(h * 0.9), int(w * 0.1) : int(w * 0.9)]
            if not grey.size:
                raise ZeroDivisionError("image without pixels")
            return float((grey < threshold).mean())

        return images.map(one)

    return ratio(image)


def prepared_image(image: Column, cfg: ExtractConfig, open_image: Callable[[bytes], "object"] | None = None) -> Column:
    """An image as the model takes it: RGB, no side over max_side, JPEG of the set quality. Null stays null.

    open_image gives an image as PIL's do (mode, size, convert, resize, save); by default it is PIL's own.
    """
    side, quality = cfg.max_side, cfg.jpeg_quality

    @F.pandas_udf("binary")
    def prepare(images: pd.Series) -> pd.Series:
        def one(data):
            if data is None:
                return None
            picture = open_image(data) if open_image else _picture(data)
            picture = picture if picture.mode == "RGB" else picture.convert("RGB")
            width, height = picture.size
            if max(width, height) > side:
                scale = side / max(width, height)
                picture = picture.resize((max(1, int(width * scale)), max(1, int(height * scale))))
            out = io.BytesIO()
            picture.save(out, format="JPEG", quality=quality)
            return out.getvalue()

        return images.map(one)

    return prepare(image)


def _picture(data: bytes):
    from PIL import Image

    return Image.open(io.BytesIO(data))


def _grey(data: bytes):
    return _picture(data).convert("L")


def routes(pages: DataFrame, cfg: ExtractConfig = ExtractConfig()) -> DataFrame:
    """pages (doc, page_no, text, nonwhite_ratio[, label]) with mode and route added.

    A blank image wins over good text, but counts only where the model may be
    called at all. nonwhite_ratio is null for a page without an image.
    """
    label = F.lit(cfg.pdf_type) if cfg.pdf_type or "label" not in pages.columns else F.col("label")
    pages = pages.withColumn("mode", T.effective_mode(F.lit(cfg.mode), label))
    may_call = F.lit(cfg.describe_figures) | (F.col("mode") != LAYER)
    blank = may_call & F.coalesce(F.col("nonwhite_ratio") < cfg.min_nonwhite_ratio, F.lit(False))
    layer = (F.col("mode") == LAYER) | ((F.col("mode") == AUTO) & T.has_enough_text(F.col("text"), cfg.min_text_chars_page))
    return pages.withColumn("route", F.when(blank, BLANK_ROUTE).when(layer, LAYER_ROUTE).otherwise(MODEL_ROUTE))


def with_blank_ratio(pages: DataFrame, cfg: ExtractConfig, imaging: Imaging) -> DataFrame:
    """pages with the nonwhite_ratio of their image, where it can matter; null elsewhere."""
    label = F.lit(cfg.pdf_type) if cfg.pdf_type or "label" not in pages.columns else F.col("label")
    may_call = F.lit(cfg.describe_figures) | (T.effective_mode(F.lit(cfg.mode), label) != LAYER)
    return pages.withColumn("nonwhite_ratio", nonwhite_ratio(F.when(may_call, F.col("image")), cfg, imaging.grey))


def extract_pages(pages: DataFrame, cfg: ExtractConfig, factory: ModelFactory | None = None, folder: str | None = None, imaging: Imaging | None = None) -> DataFrame:
    """(doc, page_no, mode, page_text) of pages that have an image column if the model may be called.

    Pages are routed and written to a folder, which driver and executors share,
    once for all branches; nothing reads them anew. Answers go to the ledger in
    the folder: a second run with the same folder asks only what is not there.
    Without a folder one of this run is taken. With imaging, images are tested
    for being blank and prepared for the model; without, they are taken as they
    are, and pages may have a nonwhite_ratio already.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "extract")
    if "route" not in pages.columns:
        if "nonwhite_ratio" not in pages.columns:
            usable = imaging is not None and "image" in pages.columns
            pages = with_blank_ratio(pages, cfg, imaging) if usable else pages.withColumn("nonwhite_ratio", F.lit(None).cast("double"))
        pages = routes(pages, cfg)
    pages = stored(pages, "routed", folder)
    prepare = (lambda image: prepared_image(image, cfg, imaging.open_image)) if imaging else None

    ledger = f"{folder}/ledger"

    def ask(frame: DataFrame, prompt: str) -> DataFrame:
        return ask_missing(frame, factory, prompt, cfg.model_id, ledger, prepare)

    if cfg.describe_figures and factory is not None:
        pages = pages.withColumn("_figures_key", question(F.col("image"), prompts.figures_prompt(), cfg.model_id))
    blank = pages.filter(F.col("route") == BLANK_ROUTE).withColumn("page_text", F.lit(cfg.blank_placeholder))
    layer = pages.filter(F.col("route") == LAYER_ROUTE).withColumn("page_text", F.coalesce("text", F.lit("")))
    model = pages.filter(F.col("route") == MODEL_ROUTE)
    if factory is None:
        if needs_model(cfg, cfg.mode if cfg.mode != AUTO else None):
            model = model.withColumn("page_text", F.raise_error(F.lit("this page needs a model and none is given")).cast("string"))
        else:
            model = model.withColumn("page_text", F.lit(""))
    else:
        prompt = prompts.text_prompt(cfg.extra_prompt)
        model = looked_up(model, ask(model, prompt), question(F.col("image"), prompt, cfg.model_id), ledger, "page_text")
    filled = layer.unionByName(model)
    if cfg.describe_figures:
        if factory is None:
            raise ValueError("figures need a model")
        # images are asked from the stored pages, and only texts are joined
        asked = ask(pages.filter(F.col("route") != BLANK_ROUTE), prompts.figures_prompt())
        filled = looked_up(filled, asked, F.col("_figures_key"), ledger, "_figures")
        filled = filled.withColumn("page_text", T.with_figures(F.col("page_text"), F.col("_figures"))).drop("_figures")
    return filled.select("doc", "page_no", "mode", "page_text").unionByName(blank.select("doc", "page_no", "mode", "page_text"))


def assemble(texts: DataFrame, cfg: ExtractConfig, label: Column | None = None, keep: list[str] | None = None) -> DataFrame:
    """(doc, value), and label if it is to be kept: the artefact of each document of (doc, page_no, mode, page_text), pages in order.

    Lines up one document's text at a time, as the artefact itself does.
    """
    block = T.page_block(F.col("page_no"), F.col("page_text"))
    label = F.lit(cfg.pdf_type).cast("string") if label is None else label
    texts = texts.select("doc", "page_no", F.col("mode").alias("_mode"), label.alias("_label"), block.alias("_block"))
    whole = texts.groupBy("doc").agg(
        F.expr("listagg(_block, '') WITHIN GROUP (ORDER BY page_no)").alias("blocks"),
        F.count("*").alias("pages"),
        F.min("_mode").alias("mode"),
        F.min("_label").alias("label"),
    )
    head = T.artefact_header(
        T.base_name(F.col("doc")), F.lit(cfg.dpi), F.lit(cfg.model_id), F.col("mode"), F.col("label"), F.lit(cfg.describe_figures)
    )
    return whole.select("doc", *(keep or []), T.artefact(head, F.col("blocks"), F.col("pages")).alias("value"))


def stub_model(image: bytes, prompt: str) -> str:
    """A deterministic model for tests: the image's bytes as text; figures only where there are an even number of them."""
    if prompt == prompts.figures_prompt():
        return "NONE" if len(image) % 2 else f"- figure of {len(image)} bytes"
    return f"[{VISION}] " + bytes(image).decode("utf-8", "replace")
