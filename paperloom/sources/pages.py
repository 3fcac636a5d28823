"""Where pages come from: files, page readers that plug in, images and artefacts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.text import collapse, file_name, source_of_artefact, strip
from paperloom.model import ClassifyConfig, IMAGES, PAGES, SIGNALS

#: bytes, 0-based page numbers wanted (None: all) -> (page number, text, whether it has images)
TextReader = Callable[[bytes, range | list[int] | None], Iterable[tuple[int, str | None, bool]]]
#: bytes, dots per inch, most pages -> (0-based page number, width, height, image bytes)
Renderer = Callable[[bytes, int, int | None], Iterable[tuple[int, int, int, bytes]]]
#: bytes -> number of pages
PageCounter = Callable[[bytes], int]


def scan_files(spark: SparkSession, folder: str, recursive: bool = False, pattern: str = "*.pdf") -> DataFrame:
    """(path, modificationTime, length, content) of the files of a folder, in no order. A folder that is missing is an error.

    A partition holds files up to spark.sql.files.maxPartitionBytes, or one larger
    file, so what a reader below is given at once is bounded by that. list_files
    gives the order, without the bytes.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    return reader.load(folder)


def list_files(files: DataFrame) -> DataFrame:
    """(path, length) of files by path; their bytes are neither read nor sorted."""
    return files.select("path", "length").orderBy("path")


def page_texts(files: DataFrame, reader: TextReader, max_pages: int | None = None) -> DataFrame:
    """(doc, page_no, text) of each page, from 1, stripped; the limit goes to the reader. A file that can't be read fails."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                wanted = None if max_pages is None else range(max_pages)
                rows = [(path, number + 1, text or "") for number, text, _ in reader(content, wanted)]
                yield pd.DataFrame(rows, columns=["doc", "page_no", "text"])

    return files.select("path", "content").mapInPandas(run, PAGES).withColumn("text", strip(F.col("text")))


def page_signals(files: DataFrame, count: PageCounter, reader: TextReader, cfg: ClassifyConfig = ClassifyConfig()) -> DataFrame:
    """(doc, page_idx, text, has_image, error): sampled pages only. A document that can't be read is one row with the error's
    name, one without pages one row with neither."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows: list[tuple] = []
            for path, content in zip(frame["path"], frame["content"]):
                try:
                    pages = count(content)
                    n = min(cfg.sample_pages, pages)
                    wanted = list(range(0, pages, max(1, pages // n)))[:n] if pages else []
                    found = [(path, i, text or "", has, None) for i, text, has in reader(content, wanted)] if wanted else []
                    rows += found or [(path, None, None, None, None)]
                except Exception as error:  # noqa: BLE001
                    rows.append((path, None, None, None, type(error).__name__))
            yield pd.DataFrame(rows, columns=["doc", "page_idx", "text", "has_image", "error"])

    out = files.select("path", "content").mapInPandas(run, SIGNALS + ", error STRING")
    return out.withColumn("text", collapse(F.col("text")))


def page_images(files: DataFrame, render: Renderer, dpi: int = 200, max_pages: int | None = None) -> DataFrame:
    """(doc, page_no, width, height, image), one page at a time."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                for number, width, height, image in render(content, dpi, max_pages):
                    yield pd.DataFrame([(path, number + 1, width, height, image)], columns=["doc", "page_no", "width", "height", "image"])

    return files.select("path", "content").mapInPandas(run, IMAGES)


def read_artefacts(spark: SparkSession, path: str, source_name: str | None = None) -> DataFrame:
    """(source, text) of text artefacts: the given name, or the one in the header, or that of the file. Stray bytes are replaced."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.make_valid_utf8("value").alias("text"))
    named = F.coalesce(F.nullif(F.lit(source_name), F.lit("")), source_of_artefact(F.col("text")), file_name(F.col("file")))
    return raw.select(named.alias("source"), "text")


def pypdf_reader(content: bytes, wanted=None) -> Iterator[tuple[int, str | None, bool]]:
    """A TextReader by the pypdf library, if it is installed. A page whose text can't be read is empty."""
    import io

    from pypdf import PdfReader

    pages = PdfReader(io.BytesIO(content)).pages
    for i in range(len(pages)) if wanted is None else (w for w in wanted if w < len(pages)):
        try:
            text = pages[i].extract_text()
        except Exception:  # noqa: BLE001
            text = ""
        yield i, text, has_image(pages[i])


def has_image(page) -> bool:
    """Whether any of a page's objects is an image; one that can't be read is passed over."""
    try:
        objects = page["/Resources"]["/XObject"].get_object()
    except Exception:  # noqa: BLE001
        return False
    for name in objects:
        try:
            if objects[name].get_object().get("/Subtype") == "/Image":
                return True
        except Exception:  # noqa: BLE001, S112
            continue
    return False


def pypdf_count(content: bytes) -> int:
    import io

    from pypdf import PdfReader

    return len(PdfReader(io.BytesIO(content)).pages)
