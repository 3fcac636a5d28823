"""From artefacts to chunks with the page they come from."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions import splitter
from paperloom.functions import text as T
from paperloom.model import FOOTER
from paperloom.storage import stored


def parse_pages(artefacts: DataFrame) -> DataFrame:
    """(source, pos, page_num, page_text) from (source, text).

    A footer ends its page; what follows the last one is dropped, so a text
    without footers has no pages. A page number beyond 64 bits is left out.
    """
    body = F.regexp_replace(T.artefact_body(F.col("text")), "\r\n", "\n")
    cut = artefacts.select("source", body.alias("_body"))
    numbers = F.transform(F.regexp_extract_all("_body", F.lit(FOOTER), F.lit(1)), T.ascii_digits)
    cut = cut.select("source", numbers.alias("_n"), F.split("_body", FOOTER, -1).alias("_t"))
    page = F.transform("_n", lambda n, i: F.struct(n.alias("n"), F.get(F.col("_t"), i).alias("t")))
    return (
        cut.select("source", F.posexplode(page).alias("pos", "_p"))
        .select("source", "pos", F.col("_p.n").try_cast("long").alias("page_num"), T.strip(F.col("_p.t")).alias("page_text"))
        .filter(F.col("page_num").isNotNull())
    )


#: Pages of a source whose chunks are added up together; the sums of such blocks are then added up by source.
BLOCK = 10_000
#: Pages whose first numbers are broadcast; with more they are joined.
MAX_PAGES = 500_000


def first_numbers(pages: DataFrame) -> DataFrame:
    """(page, base): how many chunks the pages before each page of (page, source, pos, n) have.

    A running sum in two steps over numbers alone: within blocks of pages, and
    over the blocks of a source. So no source, however large, is sorted as one.
    """
    blocks = pages.withColumn("block", F.floor(F.col("pos") / BLOCK))
    inside = Window.partitionBy("source", "block").orderBy("pos", "page")
    held = blocks.withColumn("inside", F.sum("n").over(inside) - F.col("n"))
    sums = blocks.groupBy("source", "block").agg(F.sum("n").alias("n"))
    before = sums.select("source", "block", (F.sum("n").over(Window.partitionBy("source").orderBy("block")) - F.col("n")).alias("before"))
    return held.join(before, (held["source"].eqNullSafe(before["source"])) & (held["block"].eqNullSafe(before["block"]))).select("page", (F.col("inside") + F.col("before")).alias("base"))


def chunk_pages(pages: DataFrame, size: int = 1500, overlap: int = 100, header: bool = True) -> DataFrame:
    """Chunks of (source, pos, page_num, page_text): text, source_name, page_label, chunk_index, metadata.

    Empty pieces are dropped before the header is put on and the index counted,
    which runs over all pages of a source in order. Pages are split once, into a
    stored table; numbering reads how many chunks they have, not the chunks.
    Pages of one source and place are numbered in no given order.
    """
    split = splitter.chunks(T.squeeze_blanks(F.col("page_text")), size, overlap)
    pieces = F.filter(F.transform(split, T.strip), lambda t: t != "")
    held = pages.select(F.monotonically_increasing_id().alias("page"), "source", "pos", F.col("page_num").cast("string").alias("page_label"), pieces.alias("pieces"))
    held = stored(held.filter(F.size("pieces") > 0), "chunks")
    numbers = first_numbers(held.select("page", "source", "pos", F.size("pieces").cast("long").alias("n")))
    if held.count() <= MAX_PAGES:
        numbers = F.broadcast(numbers)
    found = held.join(numbers, "page").select("source", "page_label", "base", F.posexplode("pieces").alias("piece", "piece_text"))
    text = F.concat(T.chunk_header(F.col("source")), "piece_text") if header else F.col("piece_text")
    index = (F.col("base") + F.col("piece")).cast("int")
    return found.select(
        text.alias("text"), F.col("source").alias("source_name"), "page_label", index.alias("chunk_index"), T.chunk_metadata(F.col("source"), F.col("page_label")).alias("metadata")
    )


def chunk_artefacts(artefacts: DataFrame, size: int = 1500, overlap: int = 100, header: bool = True) -> DataFrame:
    return chunk_pages(parse_pages(artefacts), size, overlap, header)


def stored_documents(chunks: DataFrame) -> DataFrame:
    """(page_content, metadata); the index is not stored."""
    return chunks.select(F.col("text").alias("page_content"), "metadata")
