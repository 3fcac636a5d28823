"""Operator 11: vectors as short codes, entries found by annular norm pruning.

A vector becomes integers floor(256 * x) and is cut into equal parts; each part
position has a codebook, and a part's code is its nearest entry. Codebooks start
from the vectors of the least ids and are moved to the means of their parts for
a few rounds.

The nearest entry is found without looking at all of them. Entries are sorted by
norm. As | |v| - |e| | never exceeds the distance of v and e, an entry can only
win if its norm lies in the annulus |v| +- the best distance so far. The entry
of the nearest norm gives a first distance, its neighbours a better one; binary
search finds the interval of norms that this allows, bounds included, and just
these entries are compared, in whole numbers. Square roots are rounded outwards,
so rounding can only let in an entry too many.

Each task sums its parts by entry before anything is shuffled, so what moves in
a round is one row for each component of the codebooks and task; the codebooks
(entries x dimension numbers) are all that reaches the driver. Equal vectors,
however many, are just more terms of a sum.

Defined results: vectors that are null or hold null or non-finite components are
dropped. The dimension is that of the least kept vec_id whose size is a positive
multiple of the parts. A kept vector of another size, or with a component of
65536 or more, whose squares could leave 64 bits, stays with null code and error
and has no part in the codebooks. A null vec_id never starts an entry, but its
vector is coded and counts in the means. Rows that repeat a vec_id are rows of
their own, ordered by their integers. With fewer kept vectors than entries the
codebooks are as many entries shorter. Columns other than the id, the vector and
the label are left out. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if, stash, table

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components as integers stay below this in size, so that sums of squares fit 64 bits.
LIMIT = 2**24
#: Labels whose sums are broadcast; with more they are joined.
MAX_LABELS = 100_000
#: Points and entries compared at once.
BLOCK = 500_000
#: Entries around that of the nearest norm that are tried before the interval is fixed.
FIRST = 2


@dataclass(frozen=True)
class Codebooks:
    """entries[part][k] is the k-th entry of a part position, a tuple of integers."""

    entries: tuple[tuple[tuple[int, ...], ...], ...]

    @property
    def dimension(self) -> int:
        return sum(len(part[0]) for part in self.entries)

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(x) for part in self.entries for entry in part for x in entry).encode()).hexdigest()


class Annuli:
    """One part's entries by norm."""

    def __init__(self, entries: np.ndarray):
        norms = np.sqrt((entries * entries).sum(1).astype(np.float64))
        self.order = np.argsort(norms, kind="stable")
        self.norms, self.entries = norms[self.order], entries[self.order]
        self.compared = 0

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of each point's nearest entry, the lower of equal ones, and the squared distance."""
        norm, last = np.sqrt((points * points).sum(1).astype(np.float64)), len(self.norms) - 1
        at = np.clip(np.searchsorted(self.norms, norm), 0, last)
        best = self._squares(points, at)
        for step in range(-FIRST, FIRST):
            best = np.minimum(best, self._squares(points, np.clip(at + step, 0, last))) if step else best
        reach = np.sqrt(best.astype(np.float64)) * (1 + 1e-9) + norm * 1e-9
        low, high = np.searchsorted(self.norms, norm - reach, "left"), np.searchsorted(self.norms, norm + reach, "right")
        which = np.empty(len(points), np.int64)
        ends = np.cumsum(high - low)
        start = 0
        while start < len(points):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + BLOCK, "right")))
            which[start:stop], best[start:stop] = self._annulus(points[start:stop], low[start:stop], high[start:stop])
            start = stop
        return which, best

    def _squares(self, points: np.ndarray, at: np.ndarray) -> np.ndarray:
        self.compared += len(at)
        apart = points - self.entries[at]
        return np.einsum("ij,ij->i", apart, apart)

    def _annulus(self, points: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every entry from low to high of each point is compared with it."""
        n = high - low
        first = np.cumsum(n) - n
        rows = np.repeat(np.arange(len(points)), n)
        at = np.arange(len(rows)) - np.repeat(first - low, n)
        squares = self._squares(points[rows], at)
        best = np.minimum.reduceat(squares, first)
        tied = np.where(squares == best[rows], self.order[at], len(self.order))
        return np.minimum.reduceat(tied, first), best


def _parts(batch: pa.RecordBatch, books: list[Annuli]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each part position: the points of the batch's vectors, their entries and squared distances."""
    vectors = batch.column("vector")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(vectors), len(books), -1)
    for part, book in enumerate(books):
        points = np.ascontiguousarray(flat[:, part])
        yield points, *book.nearest(points)


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector of integers, codable) of the vectors that are kept."""
    x = F.col("embedding").cast("array<double>")
    usable = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    small = F.forall(x, lambda v: F.abs(v) < LIMIT / SCALE)
    cut = F.when(small, F.transform(x, lambda v: F.floor(v * SCALE)))
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    return vectors.filter(usable).select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), cut.alias("vector"))


def _codable(vectors: DataFrame, dimension: int) -> DataFrame:
    return vectors.filter((F.size("vector") == dimension) & F.col("vector").isNotNull())


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of (vec_id, vector); None if no vector can be cut into the parts."""
    if not 0 < entries <= 256:
        raise ValueError("a code of two hex digits needs 1 to 256 entries")
    size = F.size("vector")
    first = vectors.filter("vec_id IS NOT NULL").filter((size > 0) & (size % parts == 0)).orderBy("vec_id", "vector").select(size.alias("n")).first()
    if first is None:
        return None
    width = first.n // parts
    usable = _codable(vectors, first.n)
    starts = [r.vector for r in usable.filter("vec_id IS NOT NULL").orderBy("vec_id", "vector").limit(entries).select("vector").collect()]
    books = np.array(starts, np.int64).reshape(len(starts), parts, width).swapaxes(0, 1)
    for _ in range(rounds):
        books = _moved(usable.select("vector"), books)
    return Codebooks(tuple(tuple(tuple(int(x) for x in entry) for entry in part) for part in books))


def _moved(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks with every entry that is in use at the mean of its parts, rounded down."""
    parts, count, width = books.shape

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        annuli = [Annuli(b) for b in books]
        n, total = np.zeros((parts, count), np.int64), np.zeros((parts, count, width), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            for part, (points, which, _) in enumerate(_parts(batch, annuli)):
                n[part] += np.bincount(which, minlength=count)
                for k in range(width):
                    # whole numbers below 2^24: sums of a batch are exact as doubles
                    total[part, :, k] += np.bincount(which, points[:, k].astype(np.float64), count).astype(np.int64)
        part, entry, place = (a.ravel() for a in np.indices((parts, count, width)))
        used = np.repeat(n.ravel() > 0, width)
        columns = [part, entry, place, np.repeat(n.ravel(), width), total.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c[used], pa.int64()) for c in columns], ["part", "entry", "place", "n", "total"])

    sums = vectors.mapInArrow(summed, "part long, entry long, place long, n long, total long")
    sums = sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    moved = books.copy()
    for r in sums.collect():
        moved[r.part, r.entry, r.place] = int(r.total) // r.n
    return moved


def encode(vectors: DataFrame, books: Codebooks | None) -> DataFrame:
    """(vec_id, label, code, error) of (vec_id, label, vector): two hex digits for each part, and the squared distance to what they stand for."""
    size = -1 if books is None else books.dimension
    arrays = [] if books is None else [np.array(part, np.int64) for part in books.entries]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        annuli = [Annuli(a) for a in arrays]
        for batch in batches:
            codes, errors = np.empty((batch.num_rows, len(annuli)), np.uint8), np.zeros(batch.num_rows, np.int64)
            for part, (_, which, squares) in enumerate(_parts(batch, annuli) if batch.num_rows else ()):
                codes[:, part] = which
                errors += squares
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(errors)], ["vec_id", "label", "code", "error"])

    kind = vectors.schema["label"].dataType.simpleString()
    able = F.coalesce((F.size("vector") == size) & F.col("vector").isNotNull(), F.lit(False))
    done = vectors.filter(able).mapInArrow(coded, f"vec_id long, label {kind}, code string, error long")
    return done.unionByName(vectors.filter(~able).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")))


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """codes with the vector that each code stands for, as doubles."""
    entries = F.array(*[F.array(*[F.array(*[F.lit(x / SCALE) for x in entry]) for entry in part]) for part in books.entries])
    place = lambda i: F.conv(F.substring("code", 2 * i + 1, 2), 16, 10).cast("int") + 1
    part = [F.element_at(F.element_at(entries, i + 1), place(i)) for i in range(len(books.entries))]
    return codes.withColumn("decoded", F.when(F.col("code").isNotNull(), F.concat(*part)))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """(vec_id, label, code, error, label_error) of (vec_id, embedding, label), and the codebooks. label_error adds up the errors of a label, nulls together."""
    whole = stash(whole_numbers(vectors), "whole-numbers")
    books = train(whole, parts, entries, rounds)
    coded = stash(encode(whole, books), "codes")
    totals = stash(coded.groupBy(F.col("label").alias("same_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    return coded.join(broadcast_if(totals, MAX_LABELS), F.col("label").eqNullSafe(F.col("same_label")), "left").drop("same_label"), books


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole embeddings table as codes of 16 parts and 64 entries, after two rounds."""
    out, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    digest = (books or Codebooks(())).digest()
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql() -> str:
    """Two rounds and the last assignment, spelled out."""
    steps = [
        f"""v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})::BIGINT) AS q FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""p AS MATERIALIZED (SELECT vec_id, label, part, i, q[part * (len(q) // {PARTS}) + i + 1] AS x
          FROM (SELECT *, unnest(range({PARTS})) AS part FROM v), LATERAL (SELECT unnest(range(len(q) // {PARTS})) AS i))""",
        f"f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM v ORDER BY vec_id LIMIT {ENTRIES})",
        "c0 AS MATERIALIZED (SELECT part, k, i, x FROM p JOIN f USING (vec_id))",
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, part, min(d) AS d, arg_min(k, d * {ENTRIES} + k) AS k FROM (
          SELECT p.vec_id, p.part, c.k, sum((p.x - c.x) * (p.x - c.x))::BIGINT AS d FROM p JOIN c{r} c ON p.part = c.part AND p.i = c.i GROUP BY p.vec_id, p.part, c.k) GROUP BY vec_id, part)""")
        if r < ROUNDS:
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.part, c.k, c.i, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
              SELECT part, k, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS x FROM (
                SELECT p.part, a.k, p.i, sum(p.x)::BIGINT AS s, count(*) AS n FROM p JOIN a{r} a ON p.vec_id = a.vec_id AND p.part = a.part GROUP BY p.part, a.k, p.i)) m
              ON c.part = m.part AND c.k = m.k AND c.i = m.i)""")
    steps.append(f"e AS (SELECT vec_id, string_agg(printf('%02x', k), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id)")
    return f"""WITH {", ".join(steps)}
      SELECT v.vec_id, e.code, e.error, (sum(e.error) OVER (PARTITION BY v.label))::BIGINT AS label_error,
        (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, k, i)) FROM c{ROUNDS}) AS codebooks_sha256
      FROM v JOIN e USING (vec_id)"""


SQL = _sql()
