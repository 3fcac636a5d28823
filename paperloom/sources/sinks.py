"""Where results go: artefacts as text, page images as files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame


def write_artefacts(artefacts: DataFrame, path: str) -> None:
    """Each document's artefact as one row of (doc, value), replaced as a whole."""
    artefacts.select("doc", "value").write.mode("overwrite").parquet(path)


def write_page_images(images: DataFrame, folder: str, whole_path: bool = True) -> DataFrame:
    """Writes image bytes as <folder>/<document>/page_0001.png through the folder's file system; returns (doc, page_no, file).

    <document> is the base name of doc; with whole_path a digest of the path stands before it, so that documents
    of one base name keep their own images. Nothing is written until the result is evaluated. A task that runs
    again writes the same files.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        system, root = FileSystem.from_uri(folder)
        for frame in frames:
            files = []
            for doc, page_no, image in zip(frame["doc"], frame["page_no"], frame["image"]):
                own = hashlib.sha256(doc.encode()).hexdigest()[:16] + "/" if whole_path else ""
                name = f"{root}/{own}{doc.rstrip('/').rpartition('/')[2]}/page_{page_no:04d}.png"
                system.create_dir(name.rpartition("/")[0], recursive=True)
                with system.open_output_stream(name) as out:
                    out.write(image)
                files.append(name)
            yield pd.DataFrame({"doc": frame["doc"], "page_no": frame["page_no"], "file": files})

    return images.select("doc", "page_no", "image").mapInPandas(run, "doc STRING, page_no INT, file STRING")
