"""Sets, fast similarity sketches and verified links, for texts and for lines.

A sketch of t coordinates is filled in rounds: a round hashes every element to
a bin and a value, and each bin without a value from an earlier round keeps the
least. A bin that no round has filled takes the least of all elements under a
hash of its own. Which round fills a bin is decided by the union of two sets, so
that a coordinate of both is equal as often as their similarity says.

Equal bands of a sketch put sets into a common bucket. Emitting all pairs of a
bucket is never needed. Band keys travel packed, many to a row. Each member is
first held against one of its bucket, its leader: a task's members against the
task's first, and those against one of all. Buckets whose members are then still
in more than one component are compared inside tasks, in blocks of bounded size
and bytes, by set sizes and sketches alone. Where few members are alike, their
pairs are confirmed by joins; where many are, as in a family of texts just below
the threshold, the texts of those members follow once, all their pairs are
counted on full sets in the same task, and only links that join components leave it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import among, settled, stash
from .graph import components

#: Members of a bucket that one task holds against as many others, and bytes of their texts (one longer text apart).
BLOCK, BLOCK_BYTES = 512, 2_000_000
#: Elements that are hashed at a time, rounds, the share of elements with which closed sets are carried on, and elements of a table of sets.
CACHED, ROUNDS, STAY, TABLE = 100_000, 8, 0.6, 250_000
#: Elements of sets that are counted against each other at a time.
HELD = 500_000
#: Coordinates that pairs are first held against, and bytes of texts confirmed at a time.
MARKS, SLICE_BYTES = 64, 200_000
#: Bits of a band key that tell the band.
BAND_BITS = 7
#: UTF-8 texts to the hashes of their sets, with repeats, in one array, and how many each has.
Hashes = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
_EMPTY = np.uint32(2**32 - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketches(flat: np.ndarray, size: np.ndarray, t: int) -> np.ndarray:
    """One row of t 32-bit values per set; size[k] elements of flat belong to set k. Empty sets stay unfilled."""
    return sketches_of([(flat, size)], t)


def sketches_of(pieces: Iterable[tuple[np.ndarray, np.ndarray]], t: int) -> np.ndarray:
    """sketches() of the sets of all pieces (flat, size), of which one is held at a time.

    Sets go through the rounds some at a time, so that what is hashed stays in the processor's
    cache. Of those that are left with an unfilled bin half of each element is kept for the last round.
    """
    done, values, left, n = [np.empty((0, t), np.uint32)], [np.empty(0, np.uint32)], [np.empty((2, 0), np.int64)], 0
    for flat, size in pieces:
        ends = np.cumsum(size)
        for a, b in _some(size):
            mixed = mix(flat[ends[a] - size[a] : ends[b - 1]])
            own = np.full((b - a, t), _EMPTY)
            _rounds(mixed, size[a:b], own)
            open_ = (own == _EMPTY).any(axis=1)
            values.append(mixed.view(np.uint32)[1::2][np.repeat(open_, size[a:b])])
            left.append(np.stack([n + np.flatnonzero(open_), size[a:b][open_]]))
            done.append(own)
            n += b - a
    out = np.concatenate(done)
    _fill(np.concatenate(values), *np.concatenate(left, axis=1), out)
    return out


def _some(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of sets of about CACHED elements."""
    cut = np.r_[0, np.flatnonzero(np.diff(np.cumsum(size) // CACHED)) + 1, len(size)].tolist()
    return ((a, b) for a, b in zip(cut, cut[1:]) if b > a)


def _rounds(flat: np.ndarray, size: np.ndarray, done: np.ndarray) -> None:
    """The first rounds over sets of mixed elements; done has a row of coordinates for each.

    Each half of an element is mixed already: its product with an odd number of the
    round gives the bin, that of the other half the value. A round changes nothing in a set
    that has no unfilled bin, so such sets leave only where that spares enough of the elements.
    """
    rows, t = done.shape
    halves = flat.view(np.uint32).reshape(-1, 2)
    x, y = halves[:, 0].copy(), halves[:, 1].copy()
    # out has a row for each set that is carried on
    row, out, base = np.arange(rows), done, np.repeat(np.arange(rows, dtype=np.uint32) * np.uint32(t), size)
    unfilled = out.reshape(-1) == _EMPTY
    held, place = np.empty_like(x), np.empty(len(x), np.intp)
    for i in range(ROUNDS):
        odd = np.array([(2 * i + 1) * 0x9E3779B1 % 2**32, (2 * i + 1) * 0x85EBCA6B % 2**32], np.uint32)
        np.multiply(x, odd[0], out=held)
        held >>= np.uint32(16)
        held *= np.uint32(t)
        held >>= np.uint32(16)
        held += base
        place[:] = held
        if i:
            free = np.flatnonzero(unfilled.take(place))
            at, values = place[free], y[free] * odd[1]
        else:
            at, values = place, y * odd[1]
        np.minimum.at(out.reshape(-1), at, values)
        unfilled[at] = False
        if i == ROUNDS - 1:
            break
        open_ = unfilled.reshape(-1, t).any(axis=1)
        left = int(size[open_].sum())
        if left > STAY * len(x):
            continue
        if out is not done:
            done[row] = out
        if not left:
            return
        stay = np.repeat(open_, size)
        x, y, row, out, size = x[stay], y[stay], row[open_], out[open_], size[open_]
        base = np.repeat(np.arange(len(size), dtype=np.uint32) * np.uint32(t), size)
        unfilled, held, place = unfilled.reshape(-1, t)[open_].ravel(), held[: len(x)], place[: len(x)]
    if out is not done:
        done[row] = out


def _fill(values: np.ndarray, left: np.ndarray, size: np.ndarray, done: np.ndarray) -> None:
    """The last round for the sets `left`: each unfilled bin takes the least of all elements under a hash of its own.

    Sets of about one size are rows of one table, the shorter ones with their last element repeated.
    """
    t, start = done.shape[1], np.cumsum(size) - size
    seed = mix(np.arange(1, 2 * t + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32).reshape(2, t)
    seed[1] |= np.uint32(1)
    order = np.argsort(size, kind="stable")
    order = order[np.searchsorted(size[order], 1) :]
    left, start, size = left[order], start[order], size[order]
    # a table ends where sizes reach a further power of two or its elements are enough
    cut = np.flatnonzero((np.diff(np.cumsum(size) // TABLE) > 0) | (np.diff(np.frexp(size)[1]) > 0)) + 1
    for a, b in zip(np.r_[0, cut].tolist(), np.r_[cut, len(left)].tolist()):
        if a == b:
            continue
        width = int(size[b - 1])
        each = values.take(start[a:b, None] + np.minimum(np.arange(width), size[a:b, None] - 1))
        own, edges = done[left[a:b]].T.copy(), np.arange(0, each.size, width)
        for k, one in enumerate(own):
            rows = np.flatnonzero(one == _EMPTY)
            if len(rows):
                hashed = each.take(rows, axis=0)
                hashed ^= seed[0, k]
                hashed *= seed[1, k]
                one[rows] = np.minimum.reduceat(hashed.ravel(), edges[: len(rows)])
        done[left[a:b]] = own.T


def bands_of(sketch: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of `rows` coordinates; bands differ in their seed."""
    n, t = sketch.shape
    cut = sketch.reshape(n, t // rows, rows)
    key = np.broadcast_to(np.arange(1, t // rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), cut.shape[:2])
    for k in range(rows):
        key = mix(key ^ cut[:, :, k].astype(np.uint64))
    return key.view(np.int64)


def bytes_of(sketch: np.ndarray) -> np.ndarray:
    """One byte of each coordinate, to estimate the similarity of two sets."""
    return (mix(sketch.astype(np.uint64)) >> np.uint64(56)).astype(np.uint8)


def sizes_allow(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can share percent or more of their union."""
    return np.minimum(x, y) * 100 >= np.maximum(x, y) * percent


def likely(pairs: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may reach the threshold by their sizes and MARKS coordinates of their sketches. near has (id, n, sig)."""
    least = lowest(percent, MARKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, MARKS) for c in ("sig_a", "sig_b"))
            fit = sizes_allow(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), percent)
            yield batch.select(["a", "b"]).filter(pa.array(fit & (estimate((x == y).mean(axis=1)) >= least)))

    few = near.select("id", "n", F.substring("sig", 1, MARKS).alias("sig"))
    return _with_both(pairs, few, ["n", "sig"]).mapInArrow(run, "a long, b long")


def _slices(length: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of rows of about SLICE_BYTES and 4096 at most."""
    held, cut = np.cumsum(length, dtype=np.int64), [0]
    while cut[-1] < len(length):
        start = cut[-1]
        cut.append(min(start + 4096, max(start + 1, int(np.searchsorted(held, (held[start - 1] if start else 0) + SLICE_BYTES)))))
    return list(zip(cut, cut[1:]))


def confirm(pairs: DataFrame, near: DataFrame, hashes: Hashes, percent: int) -> DataFrame:
    """The pairs (a, b), a stored table, whose full sets share percent or more of their union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(c).to_pylist() for c in ("text_a", "text_b"))
            cut = _slices(np.array([len(x) + len(y) for x, y in zip(left, right)], np.int64))
            keep = [shared_enough(hashes(left[a:b]), hashes(right[a:b]), percent) for a, b in cut]
            yield batch.select(["a", "b"]).filter(pa.array(np.concatenate([*keep, np.empty(0, bool)])))

    # only texts of pairs are moved
    texts = among(near.select("id", "text"), pairs.select(F.explode(F.array("a", "b")).alias("id")))
    return _with_both(pairs, texts, ["text"]).mapInArrow(run, "a long, b long")


def _with_both(pairs: DataFrame, given: DataFrame, columns: list[str]) -> DataFrame:
    of = lambda side: given.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
    return pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", *[f"{c}_{side}" for side in "ab" for c in columns])


def distinct_sizes(flat: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How many different elements each of up to 4096 sets has: 12 bits of the set and 52 of the hash are sorted."""
    u = np.sort(np.repeat(np.arange(len(size), dtype=np.uint64) << np.uint64(52), size) | mix(flat) >> np.uint64(12))
    u = u[np.r_[True, u[1:] != u[:-1]][: len(u)]]
    return np.bincount((u >> np.uint64(52)).astype(np.int64), minlength=len(size))


def shared_enough(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], percent: int) -> np.ndarray:
    """For each of up to 4096 pairs of sets, given as (hashes, how many each has), whether they share percent or more of their union.

    One sort puts equal hashes of a pair side by side: 12 bits of the pair, 51 of the hash, one of the side.
    """
    n = len(left[1])
    both = [
        np.repeat(np.arange(n, dtype=np.uint64) << np.uint64(52), size) | mix(flat) >> np.uint64(13) << np.uint64(1) | np.uint64(side)
        for side, (flat, size) in enumerate((left, right))
    ]
    u = np.sort(np.concatenate(both))
    u = u[np.r_[True, u[1:] != u[:-1]][: len(u)]]
    total = np.bincount((u >> np.uint64(52)).astype(np.int64), minlength=n)
    twice = u[1:][u[1:] >> np.uint64(1) == u[:-1] >> np.uint64(1)]
    shared = np.bincount((twice >> np.uint64(52)).astype(np.int64), minlength=n)
    return (shared * 100 >= (total - shared) * percent) & (total > 0)


def estimate(equal: np.ndarray) -> np.ndarray:
    """The similarity of two sets of whose coordinates' bytes this share is equal."""
    return (equal - 1 / 256) / (1 - 1 / 256)


def lowest(percent: int, width: int) -> float:
    """The least estimate by `width` coordinates of a pair at the threshold, but for one in 30,000."""
    return percent / 100 - 4 * (percent / 100 * (1 - percent / 100) / width) ** 0.5


def partners(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each set on the left, its place and the places of those on the right that share percent or more of the union with it.

    Sets are arrays of different elements, none empty. Elements are numbered; a left
    set marks its own, and one pass over the right counts the marks of every set.
    """
    size = np.array([len(x) for x in (*left, *right)])
    words, code = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    end = np.cumsum(size)
    mark, split = np.zeros(len(words), bool), end[len(left) - 1]
    others, start, sizes = code[split:], (end - size)[len(left) :] - split, size[len(left) :]
    for k, n in enumerate(size[: len(left)].tolist()):
        own = code[end[k] - n : end[k]]
        mark[own] = True
        shared = np.add.reduceat(mark[others], start, dtype=np.int64)
        mark[own] = False
        yield k, np.flatnonzero(shared * 100 >= (n + sizes - shared) * percent)


def _by_block(
    batches: Iterator[pa.RecordBatch], found: Callable[[pa.Table], pa.RecordBatch | None], together: Callable[[pa.Table], pa.RecordBatch | None] | None = None
) -> Iterator[pa.RecordBatch]:
    """What found gives for the rows of each (key, i, j), or together for those of many small whole buckets; rows come sorted."""
    held: pa.Table | None = None

    def whole(rows: pa.Table, at: np.ndarray, cut: list[int]) -> Iterator[pa.RecordBatch | None]:
        size, alone = np.diff(cut), (at[1:, cut[:-1]] == 0).all(axis=0)
        small = alone & (size <= SMALL) if together else np.zeros(len(size), bool)
        if small.any():
            yield together(rows.take(np.flatnonzero(np.repeat(small, size))))
        for k in np.flatnonzero(~small).tolist():
            yield found(rows.slice(cut[k], cut[k + 1] - cut[k]))

    def places(rows: pa.Table) -> np.ndarray:
        return np.stack([rows.column(c).to_numpy() for c in ("key", "i", "j")])

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        if not rows.num_rows:
            continue
        at = places(rows)
        cut = np.r_[0, np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1].tolist()
        yield from (out for out in whole(rows, at, cut) if out is not None)
        held = rows.slice(cut[-1])
    if held is not None:
        yield from (out for out in whole(held, places(held), [0, held.num_rows]) if out is not None)


def _equal(sig: np.ndarray, x: np.ndarray, y: np.ndarray, band: np.ndarray | int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The estimates of pairs of rows, and whether it is on a bucket of this band to look at the pair.

    A pair shares many bands, and the first of them looks. Bands are told by a byte
    of each coordinate and one of the key: one that is not shared seems so about
    once in a million times.
    """
    bands = sig.shape[1] // (rows + 1)
    same = sig[x] == sig[y]
    values = same[:, : bands * rows]
    shared = values.reshape(len(same), bands, rows).all(axis=2) & same[:, bands * rows :]
    before = shared & (np.arange(bands) < np.asarray(band).reshape(-1, 1))
    return estimate(values.mean(axis=1)), ~before.any(axis=1)


def _pairs(block: pa.Table, least: float, rows: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a block that are alike by their sizes and sketches and of different components: left, right."""
    sig = np.frombuffer(b"".join(block.column("sig").to_pylist()), dtype=np.uint8).reshape(block.num_rows, -1)
    side, comps, size = (block.column(c).to_numpy() for c in ("side", "comp", "n"))
    first, second = block.column("i")[0].as_py(), block.column("j")[0].as_py()
    band = block.column("key")[0].as_py() & (2**BAND_BITS - 1)
    left, right = np.flatnonzero(side == first), np.flatnonzero(side == second)
    out = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for k, i in enumerate(left.tolist()):
        others = right[k + 1 :] if first == second else right
        others = others[(comps[others] != comps[i]) & sizes_allow(size[others], size[i], percent)]
        about, mine = _equal(sig, np.full(len(others), i), others, band, rows)
        others = others[mine & (about >= least)]
        out.append((np.full(len(others), i), others))
    return tuple(np.concatenate(x) for x in zip(*out))


#: Members of a block whose pairs are looked for together with those of other blocks, and pairs that a member of a larger one gives.
SMALL, MOST = 32, 2
_ALIKE = "key long, i int, j int, side int, id long, comp long, other long"


def _alike(least: float, band_rows: int, percent: int) -> Callable:
    """Pairs (id, other) of members that are alike and of different components.

    A large block with more than MOST such pairs for each of its members gives those
    members instead, without other.
    """
    kind = pa.schema([("key", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("side", pa.int32()), ("id", pa.int64()), ("comp", pa.int64()), ("other", pa.int64())])

    def row_pairs(ids: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
        none = [pa.nulls(len(left), f.type) for f in kind]
        return pa.RecordBatch.from_arrays([*none[:4], pa.array(ids[left]), none[5], pa.array(ids[right])], schema=kind)

    def found(block: pa.Table) -> pa.RecordBatch | None:
        left, right = _pairs(block, least, band_rows, percent)
        if not len(left):
            return None
        if len(left) <= MOST * block.num_rows:
            return row_pairs(block.column("id").to_numpy(), left, right)
        members = block.select(kind.names[:-1]).take(np.unique(np.r_[left, right])).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_arrays([*members.columns, pa.nulls(members.num_rows, pa.int64())], schema=kind)

    def together(rows: pa.Table) -> pa.RecordBatch | None:
        """Pairs of many small blocks: each row is held against the next ones of its block."""
        sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), dtype=np.uint8).reshape(rows.num_rows, -1)
        ids, comps, key, size = (rows.column(c).to_numpy() for c in ("id", "comp", "key", "n"))
        left, right = [], []
        at = np.arange(len(key))
        for step in range(1, SMALL):
            at = at[at + step < len(key)]
            at = at[key[at] == key[at + step]]
            if not len(at):
                break
            x = at[(comps[at] != comps[at + step]) & sizes_allow(size[at], size[at + step], percent)]
            about, mine = _equal(sig, x, x + step, key[x] & (2**BAND_BITS - 1), band_rows)
            x = x[mine & (about >= least)]
            left.append(x)
            right.append(x + step)
        left, right = (np.concatenate([*x, np.empty(0, np.int64)]) for x in (left, right))
        return row_pairs(ids, left, right) if len(left) else None

    return lambda batches: _by_block(batches, found, together)


def _linked(hashes: Hashes, percent: int) -> Callable:
    """Confirmed links between different components of a block of members that are alike to many.

    All pairs of the block's two sides are counted on full sets; a pair that the links so far
    already join gives none, so a block gives fewer links than it has members.
    """

    def pieces(at: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
        return np.split(at, np.flatnonzero(np.diff(np.cumsum(size[at]) // HELD)) + 1)

    def found(block: pa.Table) -> pa.RecordBatch | None:
        ids, comps, side = (block.column(c).to_numpy() for c in ("id", "comp", "side"))
        sets = [np.unique(hashes([text.as_py()])[0]) for text in block.column("text")]
        size = np.array([len(x) for x in sets])
        comps = np.unique(comps, return_inverse=True)[1].tolist()
        first, second = block.column("i")[0].as_py(), block.column("j")[0].as_py()
        left, right = np.flatnonzero(side == first), np.flatnonzero(side == second)
        parent, links = list(range(len(comps))), []

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        for some in pieces(left, size) if len(left) and len(right) else []:
            for others in pieces(right, size):
                if first == second and others[-1] < some[0]:
                    continue
                for k, near in partners([sets[i] for i in some], [sets[j] for j in others], percent):
                    i = int(some[k])
                    for j in others[near].tolist():
                        a, b = root(comps[i]), root(comps[j])
                        if a != b:
                            parent[max(a, b)] = min(a, b)
                            links.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], names=["a", "b"]) if links else None

    return lambda batches: _by_block(batches, found)


def signatures(texts: DataFrame, hashes: Hashes, t: int, rows: int) -> DataFrame:
    """(id, text, n, sig): n is the set's size; sig has one byte of each of t coordinates, those that the bands are made of, and one of each band key."""

    def pieces(texts: pa.Array, sizes: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for a, b in _slices(pc.binary_length(texts).to_numpy()):
            flat, size = hashes(texts.slice(a, b - a).to_pylist())
            sizes.append(distinct_sizes(flat, size))
            yield flat, size

    def marks(sketch: np.ndarray) -> np.ndarray:
        return np.concatenate([bytes_of(sketch), (bands_of(sketch, rows) & 255).astype(np.uint8)], axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes: list[np.ndarray] = []
            sketch = sketches_of(pieces(batch.column(1), sizes), t)
            sig = [x.tobytes() for k in range(0, len(sketch), 512) for x in marks(sketch[k : k + 512])]
            made = [pa.array(np.concatenate([np.empty(0, np.int64), *sizes])), pa.array(sig, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=["id", "text", "n", "sig"])

    return texts.select("id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "id long, text binary, n long, sig binary")


#: Band entries that a task holds at a time, and entries meant for one bucket of band keys.
CHUNK, PER_BUCKET = 500_000, 32_000
_MEMBER = "key long, id long, against long"


def _sorted(code: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of so many bits in order, and the place of each; equal ones by place. Numbers that hold both sort faster than places do."""
    least = np.uint64(len(code).bit_length())
    if bits + int(least) > 64:
        order = np.argsort(code, kind="stable")
        return code[order], order
    both = np.sort(code << least | np.arange(len(code), dtype=np.uint64))
    return both >> least, (both & (np.uint64(1) << least) - np.uint64(1)).view(np.int64)


def _dealt(read: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]], buckets: int) -> Callable:
    """Band entries of a task, packed by bucket: 31 bits of the key, and where the id lies above the chunk's least.

    Of entries with one key only the first goes to the key's bucket, with a mark; the
    others are held against it here, so that a key that many sets share costs a
    bucket no more than one entry for each chunk.
    """
    kind = pa.schema([("bucket", pa.int32()), ("base", pa.int64()), ("keys", pa.binary()), ("places", pa.binary()), ("members", pa.binary())])

    def rows(ids: np.ndarray, bands: np.ndarray) -> Iterator[pa.RecordBatch]:
        h = bands.view(np.uint64).ravel()
        band = np.tile(np.arange(bands.shape[1], dtype=np.uint64), len(bands))
        code = (h & np.uint64(2**32 - 1)) % np.uint64(buckets) << np.uint64(31) | h >> np.uint64(33 + BAND_BITS) << np.uint64(BAND_BITS) | band
        code, order = _sorted(code, buckets.bit_length() + 31)
        code, own = code.view(np.int64), ids[order // bands.shape[1]]
        first = np.r_[True, code[1:] != code[:-1]]
        at = np.flatnonzero(first)
        size = np.diff(np.r_[at, len(code)])
        rest = np.flatnonzero(~first)
        base = int(ids.min())
        place = own[at] - base
        place = place.astype(np.uint16 if place.max() < 2**16 else np.uint32 if place.max() < 2**32 else np.int64)
        word = ((code[at] & (2**31 - 1)) << 1 | (size > 1)).astype(np.uint32)
        edge = np.searchsorted(code[at], np.arange(buckets + 1) << 31).tolist()
        out = [(b, base, word[x:y].tobytes(), place[x:y].tobytes(), None) for b, (x, y) in enumerate(zip(edge, edge[1:])) if y > x]
        leader = np.repeat(own[at], size)
        found = np.stack([code[rest], own[rest], leader[rest]]) if len(rest) else np.empty((3, 0), np.int64)
        for k in range(0, len(rest), PER_BUCKET):
            out.append(((base + k) % buckets, base, None, None, found[:, k : k + PER_BUCKET].tobytes()))
        for k in range(0, len(out), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out[k : k + 4096]), kind)], schema=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            ids, bands = read(batch)
            if len(ids):
                held.append((ids, bands))
                n += bands.size
            if n >= CHUNK:
                yield from rows(*(np.concatenate(x) for x in zip(*held)))
                held, n = [], 0
        if held:
            yield from rows(*(np.concatenate(x) for x in zip(*held)))

    return run


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of the keys that two entries or more share, from rows sorted by bucket; a key of two members is one row without key."""

    def emit(key: np.ndarray, own: np.ndarray, against: np.ndarray | None = None, lone: np.ndarray | None = None) -> pa.RecordBatch:
        columns = [pa.array(key, mask=lone), pa.array(own), pa.nulls(len(own), pa.int64()) if against is None else pa.array(against)]
        return pa.RecordBatch.from_arrays(columns, names=["key", "id", "against"])

    def rows(bucket: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        word = np.concatenate([w for w, _ in held])
        order = _sorted((word >> 1).astype(np.uint64), 31)[1]
        word, own = word[order], np.concatenate([i for _, i in held])[order]
        at = np.flatnonzero(np.r_[True, word[1:] >> 1 != word[:-1] >> 1])
        size = np.diff(np.r_[at, len(word)])
        marked = np.add.reduceat(word & 1, at).astype(bool)
        two = (size == 2) & ~marked
        shared = ((size > 1) | marked) & ~two
        key = (word >> 1).astype(np.int64) | bucket << 31
        if shared.any():
            yield emit(key[at][shared], own[at][shared])
        rest = np.ones(len(word), bool)
        rest[at] = False
        if rest.any():
            yield emit(key[rest], own[rest], np.repeat(own[at], size)[rest], np.repeat(two, size)[rest])

    now, held = None, []
    for batch in batches:
        for bucket, base, keys, places, members in zip(*(c.to_pylist() for c in batch.columns)):
            if members is not None:
                key, own, leader = np.frombuffer(members, np.int64).reshape(3, -1)
                yield emit(key, own, leader)
                continue
            if bucket != now and held:
                yield from rows(now, held)
                held = []
            now, word = bucket, np.frombuffer(keys, np.uint32)
            kind = {2: np.uint16, 4: np.uint32, 8: np.int64}[4 * len(places) // len(keys)]
            held.append((word, np.frombuffer(places, kind).astype(np.int64) + base))
    if held:
        yield from rows(now, held)


def near_components(
    nodes: DataFrame, width: int, rows: int, read: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]], texts: DataFrame,
    hashes: Hashes, percent: int, more: DataFrame | None = None,
) -> DataFrame:
    """(id, comp) of the nodes that have a link; comp is the least id reached.

    nodes: stored, one row per set; read gives the ids (long) of a batch of them and
    a row of `width` band keys of `rows` coordinates for each. texts: (id, text), stored, one row per id.
    more: further links (a, b).
    """
    return settled(lambda: _near_components(nodes, width, rows, read, texts, hashes, percent, more), "components")


def _near_components(
    nodes: DataFrame, width: int, rows: int, read: Callable, texts: DataFrame, hashes: Hashes, percent: int, more: DataFrame | None
) -> DataFrame:
    buckets = min(2**20, 1 << max(4, (nodes.count() * width // PER_BUCKET).bit_length()))
    dealt = nodes.mapInArrow(_dealt(read, buckets), "bucket int, base long, keys binary, places binary, members binary")
    member = stash(dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_met, _MEMBER), "buckets", tidy=True)
    # every member is held against a leader, so the pairs name all that have a partner
    pairs = member.filter("against IS NOT NULL").select(F.least("id", "against").alias("a"), F.greatest("id", "against").alias("b"))
    pairs = stash(pairs.distinct(), "met")
    near = signatures(among(texts, pairs.select(F.explode(F.array("a", "b")).alias("id"))), hashes, width * rows, rows).withColumn("bytes", F.length("text"))
    near = stash(near, "candidates", tidy=True)
    links = confirm(stash(likely(pairs, near, percent), "likely"), near, hashes, percent)
    links = stash(links if more is None else links.union(more), "links")
    comp = stash(components(links), "components")
    placed = near.select("id", "bytes").join(comp, "id", "left")
    # two that share a key with nobody else were held against each other
    of = member.filter("key IS NOT NULL").select("key", "id").join(placed.select("id", "bytes", F.coalesce("comp", "id").alias("comp")), "id")
    sizes = of.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum("bytes").alias("b"))
    largest = F.max(F.struct("n", "comp", "b"))
    open_ = sizes.groupBy("key").agg(F.sum("n").alias("m"), F.sum("b").alias("m_b"), F.count("*").alias("comps"), largest.alias("most"))
    open_ = open_.filter("comps > 1 AND m > 2").select("key", "m", "m_b", F.col("most.n").alias("most_n"), F.col("most.b").alias("most_b"), F.col("most.comp").alias("most"))
    rest = stash(of.drop("bytes").join(open_, "key"), "open")
    if rest.isEmpty():
        return comp
    least = lowest(percent, width * rows)
    # the members of the largest component, which need no holding against each other, take the first sides
    own, whole, hashed = F.col("comp") == F.col("most"), (F.col("m") <= BLOCK) & (F.col("m_b") <= BLOCK_BYTES), F.xxhash64("id")
    count = lambda n, size: F.ceil(F.greatest(n / BLOCK, size / BLOCK_BYTES)).cast("int")
    first, last = count(F.col("most_n"), F.col("most_b")), count(F.col("m") - F.col("most_n"), F.col("m_b") - F.col("most_b"))
    side = F.when(whole, 0).when(own, F.pmod(hashed, first)).otherwise(first + F.pmod(hashed, last)).cast("int")
    met = F.when(whole, F.array(F.lit(0))).otherwise(F.sequence(F.when(own, first).otherwise(0), first + last - 1))
    sides = (
        rest.select("key", "id", "comp", side.alias("side"), F.explode(met).alias("other"))
        .select("key", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "id", "comp")
    )
    alike = stash(_in_blocks(sides.join(near.select("id", "n", "sig"), "id"), _alike(least, rows, percent), _ALIKE), "alike")
    pairs = alike.filter("other IS NOT NULL").select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
    more = confirm(stash(pairs, "pairs"), near, hashes, percent)
    # texts of a block follow only for members that are alike to many of other components
    dense = alike.filter("other IS NULL").drop("other")
    if not dense.isEmpty():
        more = more.union(_in_blocks(dense.join(among(near.select("id", "text"), dense), "id"), _linked(hashes, percent), "a long, b long"))
    more = stash(more.distinct(), "links")
    return comp if more.isEmpty() else _merged(comp, more)


def _merged(comp: DataFrame, more: DataFrame) -> DataFrame:
    """The components (id, comp) after further links (a, b): those are few, and only the components that they join are looked at."""
    of = lambda side: comp.select(F.col("id").alias(side), F.col("comp").alias(f"of_{side}"))
    ends = [F.coalesce(f"of_{side}", side).alias(side) for side in "ab"]
    joined = stash(components(more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(*ends).distinct()), "joined")
    now = joined.select(F.col("id").alias("comp"), F.col("comp").alias("now"))
    return comp.join(now, "comp", "left").select("id", F.coalesce("now", "comp").alias("comp")).union(joined.join(comp, "id", "left_anti").select("id", "comp"))


def _in_blocks(rows: DataFrame, run: Callable, schema: str) -> DataFrame:
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, schema)
