"""Connected components of a table of links, by distributed union-find.

Each partition first joins its own links with a local union-find, which leaves
a forest with the same components. Rounds of large and small stars then hook
every node to smaller ones until all nodes point at the least of their
component. Each round is written to the shared folder, so lineage stays short
and a lost executor costs one round. Only counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash


def union_find(links: list[tuple], parent: dict | None = None) -> dict:
    """Node to parent, with each root the least node of its component."""
    parent = {} if parent is None else parent

    def root(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict = {}
    kind = None
    for batch in batches:
        kind = batch.schema
        parent = union_find(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())), parent)
    if parent:
        links = [(x, r) for x, r in parent.items() if x != r]
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in links], kind.field(i).type) for i in (0, 1)], schema=kind)


def components(links: DataFrame, max_rounds: int = 60, native: bool = False) -> DataFrame:
    """(id, comp) for every node of links (a, b); comp is the least node that it reaches.

    native leaves the local union-find out, so that only DataFrame functions run; the rounds are the same.
    """
    e = links.select("a", "b").filter(F.col("a") != F.col("b"))
    e = stash(e.distinct() if native else e.mapInArrow(_forest, e.schema), "forest")
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        e = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        met = e.join(least, "a")
        e = met.select("a", F.col("m").alias("b")).union(met.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")))
        e = stash(e.distinct(), "stars")
        # settled once every node points at one root: no root points on, no node at two
        up, root = F.lit(1).alias("up"), F.lit(1).alias("root")
        nodes = e.select("a", up, F.lit(0).alias("root")).union(e.select("b", F.lit(0), root).distinct())
        if nodes.groupBy("a").agg(F.sum("up").alias("up"), F.max("root").alias("root")).filter("up + root > 1").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct()
    return e.select(F.col("a").alias("id"), F.col("b").alias("comp")).union(roots)
