"""Pages of documents as a data source that reads parts of files in parallel.

    spark.dataSource.register(DocumentPages)
    spark.read.format("document_pages").option("path", ...).option("reader", "module:object").load()

A file up to task_bytes is read by one task, with others if they are small. A
larger one is read by as many tasks as it has task_bytes: of k tasks the j-th
takes every k-th page from the j-th on. So nothing need be known of a file but
its size when tasks are planned, the shares are even however many pages it has,
and a reader that seeks reads its own pages only.

Conditions on page_no and doc go to the source: files that are not wanted are
not opened, and a task none of whose pages can be wanted is not planned. Needs
spark.sql.python.filterPushdown.enabled, which scan turns on.
"""

from __future__ import annotations

import fnmatch
import importlib
import io
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import BinaryIO, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual,
)

TEXTS = "doc STRING, page_no INT, text STRING, has_image BOOLEAN, error STRING"
IMAGES = "doc STRING, page_no INT, width INT, height INT, image BINARY"
TEXT_BATCH = pa.schema({"doc": pa.string(), "page_no": pa.int32(), "text": pa.string(), "has_image": pa.bool_(), "error": pa.string()})
IMAGE_BATCH = pa.schema({"doc": pa.string(), "page_no": pa.int32(), "width": pa.int32(), "height": pa.int32(), "image": pa.binary()})
#: What is done about a page, or a whole file, that can't be read: fail; or note the error's name, with an empty text.
FAIL, NOTE = "fail", "note"
BATCH_BYTES = 8_000_000


class PageReader(Protocol):
    """What a document format plugs in. source is an open file that seeks; pages count from 0."""

    def count(self, source: BinaryIO) -> int: ...

    def text(self, source: BinaryIO, page: int) -> str | None: ...

    def has_image(self, source: BinaryIO, page: int) -> bool: ...

    def image(self, source: BinaryIO, page: int, dpi: int) -> tuple[int, int, bytes]: ...


@dataclass
class Wanted:
    """The pages, from 1, and documents that conditions leave."""

    low: int = 1
    high: float = math.inf
    pages: frozenset[int] | None = None
    docs: frozenset[str] | None = None

    def take(self, f: Filter) -> bool:
        """Whether the condition is wholly taken over."""
        column = getattr(f, "attribute", None)
        if column == ("doc",) and isinstance(f, EqualTo | EqualNullSafe | In):
            values = f.value if isinstance(f, In) else [f.value]
            self.docs = frozenset(values) if self.docs is None else self.docs & frozenset(values)
        elif column == ("page_no",) and isinstance(f, EqualTo | EqualNullSafe | In):
            values = frozenset(f.value if isinstance(f, In) else [f.value])
            self.pages = values if self.pages is None else self.pages & values
        elif column == ("page_no",) and isinstance(f, LessThan | LessThanOrEqual):
            self.high = min(self.high, f.value - isinstance(f, LessThan))
        elif column == ("page_no",) and isinstance(f, GreaterThan | GreaterThanOrEqual):
            self.low = max(self.low, f.value + isinstance(f, GreaterThan))
        else:
            # doc and page_no are never null
            return column in (("doc",), ("page_no",)) and isinstance(f, IsNotNull)
        return True

    def has(self, page_no: int) -> bool:
        return self.low <= page_no <= self.high and (self.pages is None or page_no in self.pages)

    def any_of(self, share: int, shares: int) -> bool:
        """Whether a page of share, share + shares, ... (from 0) can be wanted."""
        if self.pages is not None:
            return any(p is not None and p > share and (p - 1 - share) % shares == 0 and self.has(p) for p in self.pages)
        first = share + 1 + max(0, -(-(self.low - 1 - share) // shares)) * shares
        return first <= self.high


@dataclass
class Share(InputPartition):
    """(file, which share, of how many) that one task reads."""

    files: list[tuple[str, int, int]] = field(default_factory=list)

    def __init__(self, files: list[tuple[str, int, int]]):
        super().__init__(None)
        self.files = files


class DocumentPages(DataSource):
    """Options: path; reader (module:object); what (texts, images); pattern; recursive; task_bytes; sample (pages of a file, evenly spread); dpi; on_error (fail, note)."""

    @classmethod
    def name(cls) -> str:
        return "document_pages"

    def schema(self) -> str:
        return IMAGES if self.options.get("what", "texts") == "images" else TEXTS

    def reader(self, schema) -> PageScan:
        return PageScan(dict(self.options))


class PageScan(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.plug_in = options["path"], options["reader"]
        self.images = options.get("what", "texts") == "images"
        self.pattern, self.recursive = options.get("pattern", "*.pdf"), options.get("recursive", "false").lower() == "true"
        self.task_bytes, self.dpi = int(options.get("task_bytes", 64_000_000)), int(options.get("dpi", 200))
        self.sample = int(options["sample"]) if "sample" in options else None
        self.on_error = options.get("on_error", FAIL)
        if self.on_error not in (FAIL, NOTE):
            raise ValueError(f"on_error must be {FAIL} or {NOTE}")
        self.wanted = Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        yield from (f for f in filters if not self.wanted.take(f))

    def partitions(self) -> list[Share]:
        shares, small, held = [], [], 0
        for path, size in self.files():
            k = max(1, -(-size // self.task_bytes))
            if k > 1:
                shares += [Share([(path, j, k)]) for j in range(k) if self.wanted.any_of(j, k)]
            elif self.wanted.any_of(0, 1):
                if small and held + size > self.task_bytes:
                    shares.append(Share(small))
                    small, held = [], 0
                small.append((path, 0, 1))
                held += size
        return shares + ([Share(small)] if small else []) or [Share([])]

    def files(self) -> list[tuple[str, int]]:
        """(path, size) in order of path. A folder that is missing is an error."""
        from pyarrow.fs import FileSelector, FileSystem, FileType

        system, root = FileSystem.from_uri(self.path)
        found = system.get_file_info(FileSelector(root, recursive=self.recursive))
        kept = [(i.path, i.size) for i in found if i.type == FileType.File and fnmatch.fnmatchcase(i.base_name, self.pattern)]
        return sorted(k for k in kept if self.wanted.docs is None or k[0] in self.wanted.docs)

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        schema = IMAGE_BATCH if self.images else TEXT_BATCH
        system, _ = FileSystem.from_uri(self.path)
        rows, held = [], 0
        for path, share, shares in partition.files:
            for row in self.pages(system, path, share, shares):
                rows.append(row)
                held += len(row[4 if self.images else 2] or "") + 100
                if held > BATCH_BYTES:
                    yield _batch(rows, schema)
                    rows, held = [], 0
        if rows:
            yield _batch(rows, schema)

    def pages(self, system, path: str, share: int, shares: int) -> Iterator[tuple]:
        reader = plugged(self.plug_in)
        try:
            with system.open_input_file(path) as source:
                count = reader.count(source)
                if not count and self.on_error == NOTE and not self.images and share == 0:
                    yield path, None, None, None, None
                places = range(count)
                if self.sample is not None:
                    n = min(self.sample, count)
                    places = range(0, count, max(1, count // n))[:n] if n else range(0)
                for k in range(share, len(places), shares) if self.sample is not None else range(share, count, shares):
                    page = places[k]
                    if self.wanted.has(page + 1):
                        yield (path, page + 1, *self.page(reader, source, page))
        except Exception as error:  # noqa: BLE001
            if self.on_error == FAIL or self.images:
                raise
            if share == 0:
                yield path, None, None, None, type(error).__name__

    def page(self, reader: PageReader, source: BinaryIO, page: int) -> tuple:
        if self.images:
            return reader.image(source, page, self.dpi)
        try:
            return (reader.text(source, page) or "").strip(), reader.has_image(source, page), None
        except Exception:  # noqa: BLE001
            if self.on_error == FAIL:
                raise
            return "", False, None


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def plugged(name: str) -> PageReader:
    """The reader at module:object, made if it is a class."""
    module, _, attribute = name.partition(":")
    found = getattr(importlib.import_module(module), attribute)
    return found() if isinstance(found, type) else found


def scan(spark: SparkSession, path: str, reader: str, **options: str | int | bool) -> DataFrame:
    """Pages of the files below path: texts, or with what="images" images. Turns the session's pushdown to Python sources on, without which the source can't be read."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DocumentPages)
    return spark.read.format("document_pages").options(path=path, reader=reader, **options).load()


class ArtefactReader:
    """Pages of text artefacts, by their footers; a page's number here is its place."""

    def __init__(self):
        self.source, self.found = None, []

    def _pages(self, source: BinaryIO) -> list[str]:
        from paperloom.functions.artefacts import pages

        if source is not self.source:
            source.seek(0)
            self.source, self.found = source, [text for _, text in pages(source.read().decode("utf-8", "replace"))]
        return self.found

    def count(self, source: BinaryIO) -> int:
        return len(self._pages(source))

    def text(self, source: BinaryIO, page: int) -> str:
        return self._pages(source)[page]

    def has_image(self, source: BinaryIO, page: int) -> bool:
        return False


class PypdfReader:
    """PDF files by the pypdf library, where it is installed."""

    def __init__(self):
        self.source, self.document = None, None

    def _pages(self, source: BinaryIO):
        from pypdf import PdfReader

        if source is not self.source:
            self.source, self.document = source, PdfReader(source if source.seekable() else io.BytesIO(source.read()))
        return self.document.pages

    def count(self, source: BinaryIO) -> int:
        return len(self._pages(source))

    def text(self, source: BinaryIO, page: int) -> str | None:
        return self._pages(source)[page].extract_text()

    def has_image(self, source: BinaryIO, page: int) -> bool:
        from paperloom.sources.pages import has_image

        return has_image(self._pages(source)[page])
