"""Files for artefacts and page images, all of a run's or none of them.

    spark.dataSource.register(DocumentFiles)
    df.write.format("document_files").option("path", ...).mode("append").save()

Tasks write below <path>/.staged-<run>, each attempt in a folder of its own; only
when all have ended are files moved to their place, and the folder goes. A task
that fails, or that runs twice, leaves nothing. What reaches the driver of a task
is the name of its folder.

A document's files stand under its base name and a digest of its whole name, so
documents of one base name keep their own. Files that are there already are
replaced one by one.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Files moved at once when a run commits.
MOVERS = 16


@dataclass
class Staged(WriterCommitMessage):
    folder: str
    files: int


class DocumentFiles(DataSource):
    """Writes (name, content): a path below the option path, and its bytes."""

    @classmethod
    def name(cls) -> str:
        return "document_files"

    def writer(self, schema: StructType, overwrite: bool) -> FileWriter:
        if {f.name for f in schema.fields} != {"name", "content"}:
            raise ValueError("files are written from the columns name and content")
        return FileWriter(self.options["path"])


class FileWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.run = path, f".staged-{uuid.uuid4().hex[:12]}"

    def _place(self):
        from pyarrow.fs import FileSystem

        system, root = FileSystem.from_uri(self.path)
        return system, root.rstrip("/")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Staged:
        system, root = self._place()
        folder, made, n = f"{root}/{self.run}/{uuid.uuid4().hex[:12]}", set(), 0
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content")):
                if (parent := f"{folder}/{name}".rpartition("/")[0]) not in made:
                    system.create_dir(parent, recursive=True)
                    made.add(parent)
                with system.open_output_stream(f"{folder}/{name}") as out:
                    out.write(content.as_buffer())
                n += 1
        return Staged(folder, n)

    def commit(self, messages: list[Staged | None]) -> None:
        from pyarrow.fs import FileSelector, FileType

        system, root = self._place()
        made: set[str] = set()

        def move(source: str, target: str) -> None:
            system.move(source, target)

        with ThreadPoolExecutor(MOVERS) as pool:
            for message in messages:
                if message is None or not message.files:
                    continue
                moves = []
                for info in system.get_file_info(FileSelector(message.folder, recursive=True)):
                    if info.type == FileType.File:
                        target = root + info.path[len(message.folder) :]
                        if (parent := target.rpartition("/")[0]) not in made:
                            system.create_dir(parent, recursive=True)
                            made.add(parent)
                        moves.append(pool.submit(move, info.path, target))
                for m in moves:
                    m.result()
        self._clear(system, root)

    def abort(self, messages: list[Staged | None]) -> None:
        """Clears what was staged, again while tasks that are being ended still write."""
        for _ in range(10):
            self._clear(*self._place())
            time.sleep(0.3)
            if not self._there(*self._place()):
                break

    def _there(self, system, root: str) -> bool:
        from pyarrow.fs import FileType

        return system.get_file_info(f"{root}/{self.run}").type != FileType.NotFound

    def _clear(self, system, root: str) -> None:
        if self._there(system, root):
            system.delete_dir(f"{root}/{self.run}")


def own_name(doc: Column) -> Column:
    """The name of a document's files: its base name and a digest of all of it."""
    base = F.substring_index(F.rtrim(doc, F.lit("/")), "/", -1)
    return F.concat(base, F.lit("-"), F.left(F.sha2(doc, 256), F.lit(12)))


def own_name_of(doc: str) -> str:
    return doc.rstrip("/").rpartition("/")[2] + "-" + hashlib.sha256(doc.encode()).hexdigest()[:12]


def write_files(files: DataFrame, path: str) -> None:
    """(name, content) below path; a name that is not below it is an error."""
    safe = F.when(F.concat(F.lit("/"), "name", F.lit("/")).contains("/../") | F.col("name").startswith("/"), F.raise_error(F.lit("a name leaves the folder")))
    files.sparkSession.dataSource.register(DocumentFiles)
    files.select(F.coalesce(safe.cast("string"), F.col("name")).alias("name"), "content").write.format("document_files").option("path", path).mode("append").save()


def write_artefact_files(artefacts: DataFrame, path: str) -> None:
    """Each (doc, value) as a UTF-8 file, exactly the text."""
    write_files(artefacts.select(F.concat(own_name(F.col("doc")), F.lit(".txt")).alias("name"), F.encode("value", "utf-8").alias("content")), path)


def write_image_files(images: DataFrame, path: str) -> None:
    """Each (doc, page_no, image) as <document>/page_0001.png."""
    name = F.concat(own_name(F.col("doc")), F.format_string("/page_%04d.png", "page_no"))
    write_files(images.select(name.alias("name"), F.col("image").alias("content")), path)
