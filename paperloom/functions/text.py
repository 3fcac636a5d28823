"""Text functions on columns; white space is Python's throughout."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.model import AUTO, BEGIN_LINE, BODY, END_LINE, LAYER, LINE_BREAK, SCANNED_PDF, SOURCE_LINE, TEXT_PDF, VISION, WS, WS_CLASS


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WS))


def right_strip(text: Column) -> Column:
    return F.rtrim(text, F.lit(WS))


def collapse(text: Column) -> Column:
    """Each run of white space to one blank, none at the ends."""
    return strip(F.regexp_replace(text, f"[{WS_CLASS}]+", " "))


def squeeze_blanks(text: Column) -> Column:
    """Runs of two blanks or tabs and more to one blank; line breaks and single tabs stay."""
    return F.regexp_replace(text, r"[ \t]{2,}", " ")


def non_space_length(text: Column) -> Column:
    return F.length(F.translate(text, WS, ""))


@cache
def _digits() -> tuple[str, str]:
    """The decimal digits of all other scripts, each script's ten in a row, and their ASCII counterparts."""
    zeros = [c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.decimal(c, 1) == 0]
    return "".join(chr(ord(zero) + k) for zero in zeros for k in range(10)), "0123456789" * len(zeros)


def ascii_digits(number: Column) -> Column:
    """Decimal digits of any script as 0 to 9."""
    return F.translate(number, *_digits())


def has_enough_text(text: Column, least: int) -> Column:
    return F.coalesce((text != "") & (non_space_length(text) >= least), F.lit(False))


def page_block(page_no: Column, text: Column) -> Column:
    """A page's text with the footer that ends it."""
    return F.concat(right_strip(F.coalesce(text, F.lit(""))), F.lit("\n\n--- PAGE "), page_no.cast("string"), F.lit(" ---\n\n"))


def with_figures(text: Column, figures: Column) -> Column:
    """text, and below it the figures unless they are blank or say that there are none."""
    clean = strip(F.coalesce(figures, F.lit("")))
    nothing = (clean == "") | (F.upper(clean) == "NONE")
    return F.when(nothing, text).otherwise(F.concat(right_strip(text), F.lit("\n\n[FIGURES]\n"), clean, F.lit("\n")))


def effective_mode(mode: Column, label: Column) -> Column:
    """An explicit mode, or what the type of a document asks for."""
    return F.when(mode != AUTO, mode).when(label == TEXT_PDF, LAYER).when(label == SCANNED_PDF, VISION).otherwise(AUTO)


def artefact_header(name: Column, dpi: Column, model: Column, mode: Column, label: Column, figures: Column) -> Column:
    """The header lines; a missing type reads None, flags read True or False."""
    fields = [
        ("SOURCE PDF", name),
        ("DPI", dpi.cast("string")),
        ("MODEL_ID", model),
        ("TEXT_MODE", mode),
        ("INPUT_PDF_TYPE", F.coalesce(label, F.lit("None"))),
        ("DESCRIBE_FIGURES", F.initcap(figures.cast("string"))),
    ]
    return F.concat(*[part for key, value in fields for part in (F.lit(f"{key}: "), value, F.lit("\n"))])


def artefact(header: Column, blocks: Column, pages: Column) -> Column:
    """Header, begin mark, page blocks, end mark and the number of pages."""
    return F.concat(header, F.lit(BEGIN_LINE), blocks, F.lit(END_LINE), F.lit("TOTAL PAGES: "), pages.cast("string"), F.lit("\n"))


def artefact_body(text: Column) -> Column:
    """What stands between the marks, stripped; without both marks the text as it is."""
    return F.when(text.rlike(BODY), strip(F.regexp_extract(text, BODY, 1))).otherwise(text)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_name(path: Column) -> Column:
    """The last component, also of a path that ends in a slash."""
    return F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)


def source_of_artefact(text: Column) -> Column:
    """The file name in the source line among the first 50 lines; null if there is none."""
    head = F.array_join(F.slice(F.split(text, LINE_BREAK, 51), 1, 50), "\n")
    named = strip(F.regexp_extract(head, SOURCE_LINE, 1))
    return F.when(named != "", file_name(named))


def chunk_metadata(source: Column, page_label: Column) -> Column:
    return F.create_map(F.lit("source"), source, F.lit("page_label"), page_label, F.lit("extraction"), F.lit("ocr"))


def chunk_header(source: Column) -> Column:
    return F.concat(F.lit("---\nsource_file: "), source, F.lit("\n---\n\n"))


def model_provider(model: Column) -> Column:
    """The part of a model id before its first dot, lower case; unknown without one."""
    prefix = F.lower(strip(F.substring_index(model, ".", 1)))
    return F.when(F.coalesce(F.instr(model, "."), F.lit(0)) == 0, "unknown").when(prefix == "", "unknown").otherwise(prefix)


def token_limit_name(model: Column) -> Column:
    """The name under which a provider takes its limit of output tokens."""
    provider = model_provider(model)
    return F.when(provider == "openai", "max_completion_tokens").when(provider == "gemini", "max_output_tokens").otherwise("max_tokens")


def mask_secret(value: Column, keep: int = 2) -> Column:
    stars = lambda n: F.repeat(F.lit("*"), n)
    return (
        F.when(value.isNull(), "")
        .when(F.length(value) <= keep, stars(F.length(value)))
        .otherwise(F.concat(F.left(value, F.lit(keep)), stars(F.length(value) - keep)))
    )


def data_url(data: Column, kind: Column) -> Column:
    """A base64 data URL of PNG or JPEG bytes; other kinds are an error.

    Needs spark.sql.chunkBase64String.enabled=false for data over 57 bytes;
    line breaks are taken out in any case.
    """
    mime = F.upper(kind)
    known = F.when(mime == "PNG", "image/png").when(mime.isin("JPEG", "JPG"), "image/jpeg").otherwise(F.raise_error(F.lit("unsupported image format")))
    return F.concat(F.lit("data:"), known, F.lit(";base64,"), F.regexp_replace(F.base64(data), "[\r\n]", ""))


def json_text(json: Column, path: str) -> Column:
    """The scalar at a path as text; null for objects, arrays and what is no JSON."""
    value = F.get_json_object(json, path)
    shape = F.schema_of_variant(F.try_variant_get(F.try_parse_json(json), path, "variant"))
    return F.when(~F.coalesce(shape, F.lit("")).rlike("^(OBJECT|ARRAY)"), value)
