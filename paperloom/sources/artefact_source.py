"""Pages of text artefacts that are larger than a task should read.

A data source cuts each file into byte ranges. A range is the lines that begin
in it; a page's footer, and the marks around the body, may go over several lines
and so over a border. All of them are made of white space, -, =, numbers and
four words, so a line with anything else is part of none. A task looks from the
last such line before its range to the first after it: what it finds in between
is what one search of the whole text would find. It gives out the marks that
begin in its range, and the text between marks.

Where a page begins and ends is then a running count of footers over rows
without texts; texts are joined to it by place and put together by page.
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from paperloom.functions.text import file_name, source_of_artefact, strip
from paperloom.model import BEGIN_MARK, END_MARK, FOOTER_LINE, WS_CLASS
from paperloom.storage import stored

PARTS = "doc STRING, kind STRING, at LONG, word LONG, fin LONG, number LONG, text STRING"
_KIND = pa.schema({"doc": pa.string(), "kind": pa.string(), "at": pa.int64(), "word": pa.int64(), "fin": pa.int64(), "number": pa.int64(), "text": pa.string()})
TEXT, FOOT, BEGIN, END, HEAD = "text", "foot", "begin", "end", "head"
HEAD_LINES, STEP = 50, 65536
#: Bytes of ranges that one task reads one after the other, and tasks for each core where there are fewer bytes.
TASK_BYTES, PER_CORE = 32_000_000, 2
_MARKS = {k: re.compile(p, re.IGNORECASE | re.MULTILINE) for k, p in ((FOOT, FOOTER_LINE), (BEGIN, BEGIN_MARK), (END, END_MARK))}
_WORD = {FOOT: re.compile("---"), BEGIN: re.compile("BEGIN", re.IGNORECASE), END: re.compile("END", re.IGNORECASE)}
#: A line that may be part of a mark.
_PART = re.compile(rf"(?:[{WS_CLASS}=-]|\d|PAGE|BEGIN|END|TEXT)*", re.IGNORECASE)


@dataclass
class Ranges(InputPartition):
    files: list[tuple[str, int, int]]

    def __init__(self, files: list[tuple[str, int, int]]):
        super().__init__(None)
        self.files = files


class ArtefactParts(DataSource):
    """Options: path, pattern, split_bytes; tasks, the number to deal ranges out to, of TASK_BYTES at most. Without it each range is a task."""

    @classmethod
    def name(cls) -> str:
        return "artefact_parts"

    def schema(self) -> str:
        return PARTS

    def reader(self, schema) -> PartScan:
        return PartScan(dict(self.options))


class PartScan(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.pattern, self.split = options["path"], options.get("pattern", "*.txt"), int(options.get("split_bytes", 32_000_000))
        self.tasks = int(options.get("tasks", 0))

    def partitions(self) -> list[Ranges]:
        from pyarrow.fs import FileSelector, FileSystem, FileType

        system, root = FileSystem.from_uri(self.path)
        ranges = []
        for info in sorted(system.get_file_info(FileSelector(root)), key=lambda i: i.path):
            if info.type == FileType.File and fnmatch.fnmatchcase(info.base_name, self.pattern):
                # a file without bytes has a head
                ranges += [(info.path, a, min(info.size, a + self.split)) for a in range(0, max(info.size, 1), self.split)]
        # a range bounds what is held at once; a task costs too much for one small range
        share = self.split
        if self.tasks:
            share = max(share, min(TASK_BYTES, -(-sum(b - a for _, a, b in ranges) // self.tasks)))
        out, own, held = [], [], 0
        for one in ranges:
            if own and held + one[2] - one[1] > share:
                out.append(Ranges(own))
                own, held = [], 0
            own.append(one)
            held += one[2] - one[1]
        return out + [Ranges(own)]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        system, _ = FileSystem.from_uri(self.path)
        for path, low, high in partition.files:
            with system.open_input_file(path) as source:
                rows = list(parts(source, low, high))
            if rows:
                columns = zip(*((path, *r) for r in rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _KIND)], schema=_KIND)


def _plain(line: bytes) -> bool:
    """Whether a line can't be part of a mark."""
    return not _PART.fullmatch(line.decode("utf-8", "surrogateescape").rstrip("\n"))


def _line_start(source, at: int) -> int:
    """Where the first line begins that begins at a place or later."""
    if at == 0:
        return 0
    source.seek(at - 1)
    while block := source.read(STEP):
        if (k := block.find(b"\n")) >= 0:
            return source.tell() - len(block) + k + 1
    return source.tell()


def _plain_before(source, at: int) -> int:
    """The end of the last plain line before a line's start; 0 if there is none."""
    low, held = at, b""
    while low:
        step = min(STEP, low)
        source.seek(low - step)
        held, low = source.read(step) + held, low - step
        lines = held.split(b"\n")[:-1]
        end = at
        # the first of them may have begun before
        for k in range(len(lines) - 1, 0 if low else -1, -1):
            if _plain(lines[k]):
                return end
            end -= len(lines[k]) + 1
    return 0


def _plain_after(source, at: int) -> int:
    """The start of the first plain line from a line's start on; the end of the file if there is none."""
    source.seek(at)
    held = b""
    while block := source.read(STEP):
        held += block
        *lines, held = held.split(b"\n")
        for line in lines:
            if _plain(line):
                return at
            at += len(line) + 1
    return at if held and _plain(held) else at + len(held)


def _places(text: str, characters: set[int], first: int) -> dict[int, int]:
    """Where characters of a text stand in bytes, if it begins at first; each byte is counted once, however many there are."""
    places, done, at = {}, 0, first
    for k in sorted(characters):
        at += len(text[done:k].encode("utf-8", "surrogateescape"))
        places[k], done = at, k
    return places


def parts(source, low: int, high: int) -> Iterator[tuple]:
    """(kind, at, word, fin, number, text) of the lines that begin in [low, high), in bytes of the file."""
    start, stop = _line_start(source, low), _line_start(source, high)
    if low == 0:
        source.seek(0)
        head, lines = b"", 0
        while lines <= HEAD_LINES and (block := source.read(STEP)):
            head += block
            lines = len(head.decode("utf-8", "replace").splitlines())
        yield HEAD, -1, -1, -1, None, head.decode("utf-8", "replace")
    if start >= stop:
        return
    first = _plain_before(source, start)
    last = _plain_after(source, stop)
    source.seek(first)
    data = source.read(last - first)
    text = data.decode("utf-8", "surrogateescape")
    marks = []
    for kind, pattern in _MARKS.items():
        for m in pattern.finditer(text):
            marks.append((m.start(), m.end(), _WORD[kind].search(text, m.start()).start(), kind, m[1] if kind == FOOT else None))
    place = _places(text, {k for m in marks for k in m[:3]}, first)
    found = [(place[a], place[b], place[w], kind, number) for a, b, w, kind, number in marks]
    found.sort(key=lambda x: (x[0], x[3] != FOOT))
    done = start
    piece = lambda a, b: data[a - first : b - first].decode("utf-8", "replace")
    for at, fin, word, kind, number in found:
        # marks of two kinds share white space at most; what a footer has is no text
        if at > done:
            yield TEXT, done, done, min(at, stop), None, piece(done, min(at, stop))
        if start <= at < stop:
            yield kind, at, word, fin, int(number) if number and int(number) < 2**63 else None, piece(max(at, done), fin) if kind != FOOT else None
        done = max(done, fin)
        if done >= stop:
            break
    if done < stop:
        yield TEXT, done, done, stop, None, piece(done, stop)


def artefact_pages(spark: SparkSession, path: str, source_name: str | None = None, **options: str | int) -> DataFrame:
    """(source, pos, page_num, page_text) of the artefacts below path, as chunk.parse_pages gives of their whole texts."""
    spark.dataSource.register(ArtefactParts)
    tasks = {"tasks": PER_CORE * spark.sparkContext.defaultParallelism} | options
    every = stored(spark.read.format("artefact_parts").options(path=path, **tasks).load(), "parts")
    head = every.filter(F.col("kind") == HEAD)
    named = F.coalesce(F.nullif(F.lit(source_name), F.lit("")), source_of_artefact(F.col("text")), file_name(F.col("doc")))
    sources = head.select("doc", named.alias("source"))
    marks = every.filter(F.col("kind").isin(BEGIN, END)).select("doc", "kind", "at", "word", "fin")
    opens = marks.filter(F.col("kind") == BEGIN).groupBy("doc").agg(F.min("fin").alias("open"))
    ends = marks.filter(F.col("kind") == END).join(opens, "doc").filter(F.col("word") >= F.col("open"))
    body = ends.groupBy("doc").agg(F.min("open").alias("open"), F.min(F.greatest("at", "open")).alias("shut"))
    rows = every.filter(F.col("kind") != HEAD).select("doc", "kind", "at", "number").join(body, "doc", "left")
    # a footer counts by where it begins; a text or mark within the body is text
    inside = F.col("open").isNull() | ((F.col("at") >= F.col("open")) & (F.col("at") < F.col("shut")))
    feet = F.count_if(F.col("kind") == FOOT)
    order = Window.partitionBy("doc").orderBy("at", F.col("kind") == FOOT)
    rows = rows.filter(inside).withColumn("pos", feet.over(order.rowsBetween(Window.unboundedPreceding, -1)).cast("int"))
    pages = rows.filter(F.col("kind") == FOOT).select("doc", "pos", F.col("number").alias("page_num"))
    texts = every.filter(~F.col("kind").isin(FOOT, HEAD)).select("doc", "at", "kind", "text")
    placed = texts.join(rows.filter(F.col("kind") != FOOT).select("doc", "at", "kind", "pos"), ["doc", "at", "kind"])
    whole = placed.groupBy("doc", "pos").agg(F.expr("listagg(text, '') WITHIN GROUP (ORDER BY at)").alias("text"))
    text = strip(F.regexp_replace(F.coalesce("text", F.lit("")), "\r\n", "\n"))
    found = pages.filter("page_num IS NOT NULL").join(whole, ["doc", "pos"], "left").join(sources, "doc")
    return found.select("source", F.col("pos"), "page_num", text.alias("page_text"))
