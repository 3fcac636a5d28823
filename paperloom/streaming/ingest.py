"""Continuous ingestion: new files to chunks to a collection, a micro-batch at a time.

Chunk numbering and artefacts are per document and a file arrives whole, so
each micro-batch runs the batch functions unchanged. Files of documents and
text artefacts are two ways in; both end in one step that adds a micro-batch to
the collection once, however often it runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paperloom.functions.text import file_name, source_of_artefact
from paperloom.model import ClassifyConfig, ExtractConfig
from paperloom.operators import chunk, classify, collection, extract
from paperloom.sources import pages
from paperloom.storage import stored


def stream_artefacts(spark: SparkSession, folder: str) -> DataFrame:
    """(source, text) of artefact files as they appear in a folder."""
    raw = spark.readStream.schema("value STRING").text(folder, wholetext=True)
    text = F.make_valid_utf8("value")
    return raw.select(F.coalesce(source_of_artefact(text), file_name(F.col("_metadata.file_path"))).alias("source"), text.alias("text"))


@dataclass(frozen=True)
class Plugs:
    """What reads documents, answers questions about pages and embeds chunks."""

    reader: pages.TextReader
    count: pages.PageCounter
    embedder: collection.EmbedderFactory
    render: pages.Renderer | None = None
    model: extract.ModelFactory | None = None
    imaging: extract.Imaging | None = None


def stream_files(spark: SparkSession, folder: str, pattern: str = "*.pdf", files_a_batch: int = 100) -> DataFrame:
    """(path, modificationTime, length, content) of files as they appear in a folder."""
    schema = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_a_batch).load(folder)


def artefacts_of(files: DataFrame, plugs: Plugs, cfg: ExtractConfig, folder: str, classes: ClassifyConfig = ClassifyConfig()) -> DataFrame:
    """(source, text): the artefacts of files (path, content), classified, routed and joined. folder keeps the model's answers."""
    texts = pages.page_texts(files, plugs.reader, cfg.max_pages)
    labels = classify.classify(pages.page_signals(files, plugs.count, plugs.reader, classes), classes)
    labels = stored(labels.select("doc", "label"), "labels")
    if plugs.render is not None and extract.needs_images(cfg):
        texts = extract.align(texts, pages.page_images(files, plugs.render, cfg.dpi, cfg.max_pages).select("doc", "page_no", "image"))
    done = extract.extract_pages(texts.join(labels, "doc"), cfg, plugs.model, folder, plugs.imaging)
    made = extract.assemble(done.join(labels, "doc"), cfg, F.col("label"))
    return made.select(file_name(F.col("doc")).alias("source"), F.col("value").alias("text"))


def ingest_files(
    files: DataFrame, name: str, plugs: Plugs, checkpoint: str, cfg: ExtractConfig = ExtractConfig(), size: int = 1500, overlap: int = 100
) -> StreamingQuery:
    """Starts loading the documents of a stream of files into a collection until all that is there is done.

    A batch that runs again asks the model nothing that it has answered, and
    adds nothing that is there.
    """

    def load(batch: DataFrame, number: int) -> None:
        # a batch's files are read once from the source
        held = stored(batch.select("path", "content"), "files")
        made = artefacts_of(held, plugs, cfg, f"{checkpoint}/answers")
        _add(batch.sparkSession, name, chunk.chunk_artefacts(made, size, overlap), plugs.embedder, f"{checkpoint}:{number}")

    return files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _add(spark: SparkSession, name: str, chunks: DataFrame, factory: collection.EmbedderFactory, batch: str) -> None:
    """Adds a micro-batch under its name; to a collection made without such names, in place of the sources that it has."""
    name = collection.safe_name(name)
    named = not spark.catalog.tableExists(f"`{name}`") or "batch" in spark.table(f"`{name}`").columns
    collection.load(spark, name, chunks, factory, replace=not named, batch=batch if named else None)


def ingest(artefacts: DataFrame, name: str, factory: collection.EmbedderFactory, checkpoint: str, size: int = 1500, overlap: int = 100) -> StreamingQuery:
    """Starts loading artefacts into a collection until all that is there is done.

    Each micro-batch is appended under its name, which is made of the checkpoint
    and its number; one that runs again is there already and adds nothing, so
    chunks don't double. A collection that was made without such names gets the
    sources of a batch replaced instead.
    """
    name = collection.safe_name(name)

    def load(batch: DataFrame, number: int) -> None:
        _add(batch.sparkSession, name, chunk.chunk_artefacts(batch, size, overlap), factory, f"{checkpoint}:{number}")

    return artefacts.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
