"""Nearest vectors of a collection: inverted lists, and the exact answer beside them.

Centroids are fitted to a bounded sample of vectors by k-means under cosine;
every vector is stored in the list of its nearest centroid. A search looks into
the lists whose centroids are nearest to a query, and ranks what it finds there
by the vectors themselves. With as many probes as lists it is exact.

Queries come in blocks, which each task holds while its rows stream by; a task
gives on the best k rows of each query that it has seen, and the best of these
are the result. So no list is held by one task, and no pair leaves one unless it
may be among the best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.storage import stored

#: Vectors that centroids are fitted to, rounds of fitting, and queries of a block.
SAMPLE, ROUNDS, BLOCK = 20_000, 8, 20_000
#: Similarities are compared to so many places, so that the order of sums does not decide.
PLACES = 9


@dataclass(frozen=True)
class Index:
    """rows: id, vector of length one, list; centroids: one row for each list."""

    rows: DataFrame
    centroids: np.ndarray


def _usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector) of vectors without null or non-finite components that are not all 0, scaled to length one."""
    x = F.col(vector).cast("array<double>")
    fine = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v))
    rows = vectors.filter(fine).select(F.col(key).alias("id"), x.alias("vector"), norm.alias("norm")).filter("norm > 0")
    return rows.select("id", F.transform("vector", lambda v: v / F.col("norm")).alias("vector"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def fitted(sample: np.ndarray, lists: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of length one, from vectors of length one; starts are rows at even distances."""
    lists = min(lists, len(sample))
    centroids = sample[np.linspace(0, len(sample) - 1, lists).astype(int)]
    for _ in range(rounds):
        at = (sample @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, at, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norm > 0, sums / np.maximum(norm, 1e-300), centroids)
    return centroids


def build(vectors: DataFrame, key: str = "id", vector: str = "embedding", lists: int | None = None, sample: int = SAMPLE) -> Index:
    """An index over all usable vectors of one size. lists is by default the root of their number."""
    rows = stored(_usable(vectors, key, vector), "vectors")
    n = rows.count()
    lists = lists or max(1, int(n**0.5))
    # which rows: by a hash of their ids, so every run fits the same
    some = rows.orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(sample).select("vector").collect()
    centroids = fitted(np.array([r.vector for r in some], float), lists) if some else np.empty((0, 0))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = (_matrix(batch) @ centroids.T).argmax(1) if batch.num_rows else np.empty(0, np.int64)
            yield batch.append_column("list", pa.array(at, pa.int32()))

    kind = rows.schema["id"].dataType.simpleString()
    held = rows.mapInArrow(placed, f"id {kind}, vector array<double>, list int")
    # lists lie together, so that row groups without a probed list are passed over
    return Index(stored(held.repartitionByRange("list", F.xxhash64(F.col("id").cast("string"))).sortWithinPartitions("list"), "lists"), centroids)


def search(index: Index, queries: DataFrame, k: int, probes: int | None = None, key: str = "id", vector: str = "embedding") -> DataFrame:
    """(query, id, rank, similarity) of the k rows nearest to each query by cosine, ties to the lesser id. probes None is exact."""
    usable = stored(_usable(queries, key, vector).withColumn("block", F.monotonically_increasing_id()), "queries")
    kinds = {"query": usable.schema["id"].dataType.simpleString(), "id": index.rows.schema["id"].dataType.simpleString()}
    shape = f"query {kinds['query']}, id {kinds['id']}, similarity double"
    blocks = -(-usable.count() // BLOCK) or 1
    found = None
    for number in range(blocks):
        block = usable.filter(F.pmod(F.xxhash64("block"), F.lit(blocks)) == number).select("id", "vector").collect()
        near = _nearest(index, block, k, probes, shape)
        found = near if found is None else found.unionByName(near)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("similarity"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query", "id", "rank", "similarity")


def _nearest(index: Index, block: list, k: int, probes: int | None, shape: str) -> DataFrame:
    """The best k rows of each task for each query of a block."""
    names = [r.id for r in block]
    vectors = np.array([r.vector for r in block], float).reshape(len(block), len(block[0].vector) if block else 1)
    lists = len(index.centroids)
    every = probes is None or probes >= lists
    rows = index.rows
    if every or not names:
        wanted = {}
    else:
        order = np.argpartition(-(vectors @ index.centroids.T), probes - 1, axis=1)[:, :probes]
        wanted = {int(x): np.flatnonzero((order == x).any(1)) for x in np.unique(order)}
        rows = rows.filter(F.col("list").isin(list(wanted)))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple]] = [[] for _ in names]
        for batch in batches:
            if not batch.num_rows or not names:
                continue
            ids, matrix, of = batch.column("id").to_pylist(), _matrix(batch), batch.column("list").to_numpy()
            for number in [None] if every else np.unique(of):
                own = np.arange(len(ids)) if every else np.flatnonzero(of == number)
                asks = np.arange(len(names)) if every else wanted.get(int(number), np.empty(0, np.int64))
                for some in np.array_split(asks, -(-len(asks) * len(own) // 2_000_000) or 1):
                    near = np.round(vectors[some] @ matrix[own].T, PLACES)
                    # rows as good as the k-th are all looked at, for ties
                    least = np.partition(near, max(0, near.shape[1] - k), axis=1)[:, max(0, near.shape[1] - k)] if near.size else np.empty(0)
                    for q, line, bound in zip(some.tolist(), near, least):
                        at = np.flatnonzero(line >= bound)
                        held[q] = sorted([*held[q], *((-float(line[j]), ids[own[j]]) for j in at)])[:k]
        out = [(names[q], i, -s) for q, rows in enumerate(held) for s, i in rows]
        yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], t) for c, t in enumerate(types)], ["query", "id", "similarity"])

    types = [_arrow(x) for x in shape.replace(",", "").split(" ")[1::2]]
    return rows.mapInArrow(best, shape)


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}[kind]
