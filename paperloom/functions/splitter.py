"""Splitting of text at blank lines, line ends, blanks and characters, many texts at once.

A text is cut at the first separator that it has; pieces below the size are
packed, longer ones are cut by the separators that follow. Here all texts of a
batch stand in one array of characters. Each separator is looked for once, in
the whole array, and the places where it may cut are one sorted array, in which
the ends and starts of chunks are found by binary search: a step finds the next
chunk of every run of pieces in the batch.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATORS = ("\n\n", "\n", " ", "")
#: Characters of texts that are split at once.
SLICE = 1_000_000
#: Texts of an Arrow batch that become Python strings at a time.
ROWS = 64


def _found(codes: np.ndarray, separator: str) -> np.ndarray:
    """Where a separator stands, each occurrence after the end of the one before; for a pair of equal characters they start at even places of a run."""
    at = np.flatnonzero(codes == ord(separator[0]))
    if len(separator) == 1 or not len(at):
        return at
    first = np.r_[True, np.diff(at) > 1]
    inside = at - at[first][np.cumsum(first) - 1]
    return at[(inside % 2 == 0) & np.r_[~first[1:], False]]


def _packed(cuts: np.ndarray, start: np.ndarray, end: np.ndarray, size: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of runs of pieces: as many pieces as fit, then on from the first that leaves no more than the overlap and room for the next piece."""
    starts, ends = [start[:0]], [end[:0]]
    while len(start):
        at = np.searchsorted(cuts, np.minimum(start + size, end), "right") - 1
        stop = cuts[at]
        starts.append(start)
        ends.append(stop)
        more = stop < end
        at, stop, end = at[more], stop[more], end[more]
        start = cuts[np.minimum(np.searchsorted(cuts, np.maximum(stop - overlap, cuts[np.minimum(at + 1, len(cuts) - 1)] - size)), at)]
    return np.concatenate(starts), np.concatenate(ends)


def spans(text: str, lengths: np.ndarray, size: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the chunks of texts that stand in text one after the other, in order."""
    if overlap > size:
        raise ValueError("overlap is larger than the chunk size")
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    high = np.cumsum(lengths).astype(np.int64)
    low = high - lengths
    low, high = low[lengths > 0], high[lengths > 0]
    starts, ends = [low[:0]], [high[:0]]
    for level, separator in enumerate(SEPARATORS):
        if not len(low):
            break
        # the separators that lie wholly in a segment
        found = _found(codes, separator) if separator else _every(low, high)
        at = np.searchsorted(low, found, "right") - 1
        inside = (at >= 0) & (found + len(separator) <= high[np.maximum(at, 0)])
        found = found[inside]
        has = np.bincount(at[inside], minlength=len(low)) > 0
        own, to = low[has], high[has]
        mark = np.zeros(len(codes) + 1, bool)
        mark[found] = mark[own] = mark[to] = True
        cuts = np.flatnonzero(mark)
        # pieces: cut to cut inside the segments
        n = np.searchsorted(cuts, to) - np.searchsorted(cuts, own)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - np.searchsorted(cuts, own), n)
        piece, fin = cuts[at], cuts[at + 1]
        segment = np.repeat(np.arange(len(own)), n)
        small = fin - piece < size
        # runs of small pieces, within a segment
        opens = small & np.r_[True, ~small[:-1] | (segment[1:] != segment[:-1])] if len(small) else small
        closes = small & np.r_[~small[1:] | (segment[1:] != segment[:-1]), True] if len(small) else small
        a, b = _packed(cuts, piece[opens], fin[closes], size, overlap)
        starts.append(a)
        ends.append(b)
        if level + 1 == len(SEPARATORS):
            starts.append(piece[~small])
            ends.append(fin[~small])
        low, high = np.concatenate([low[~has], piece[~small]]), np.concatenate([high[~has], fin[~small]])
        order = np.argsort(low)
        low, high = low[order], high[order]
    start, end = np.concatenate(starts), np.concatenate(ends)
    order = np.argsort(start, kind="stable")
    return start[order], end[order]


def _every(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All places of segments."""
    n = high - low
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - low, n)


def split_texts(texts: list[str], size: int, overlap: int = 0) -> list[list[str]]:
    """The chunks of each text, of about size characters, stripped; empty ones are left out."""
    out: list[list[str]] = []
    for part in _slices(texts):
        whole, lengths = "".join(part), np.array([len(t) for t in part], np.int64)
        # a pair must not be counted from the text before
        if any(a.endswith("\n") and b.startswith("\n") for a, b in zip(part, part[1:])):
            own = [spans(t, np.array([len(t)], np.int64), size, overlap) for t in part]
            out += [[c for a, b in zip(*s) if (c := t[a:b].strip())] for t, s in zip(part, own)]
            continue
        start, end = spans(whole, lengths, size, overlap)
        row = np.searchsorted(np.cumsum(lengths), start, "right")
        chunks: list[list[str]] = [[] for _ in part]
        for r, a, b in zip(row.tolist(), start.tolist(), end.tolist()):
            if chunk := whole[a:b].strip():
                chunks[r].append(chunk)
        out += chunks
    return out


def _slices(texts: Iterable[str]) -> Iterator[list[str]]:
    held, n = [], 0
    for text in texts:
        if held and n + len(text) > SLICE:
            yield held
            held, n = [], 0
        held.append(text)
        n += len(text)
    if held:
        yield held


def split_batches(batches: Iterator[pd.Series], size: int, overlap: int) -> Iterator[pd.Series]:
    """The chunks of batches of texts, given out a slice at a time: a batch's chunks are never held together."""
    for texts in batches:
        for part in _slices(texts):
            yield pd.Series(split_texts(part, size, overlap), dtype=object)


def split_arrays(batches: Iterator[pa.Array], size: int, overlap: int) -> Iterator[pa.Array]:
    """As split_batches, but a batch's texts stay in Arrow's memory and become strings a slice at a time."""
    for texts in batches:
        for part in _slices(t for k in range(0, len(texts), ROWS) for t in texts.slice(k, ROWS).to_pylist()):
            yield pa.array(split_texts(part, size, overlap), pa.list_(pa.string()))


def chunks(text: Column, size: int, overlap: int) -> Column:
    """Array of the chunks of a text column, stripped, without empty ones; a null text has none."""
    if overlap > size:
        raise ValueError("overlap is larger than the chunk size")

    @F.arrow_udf("array<string>")
    def split(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from split_arrays(batches, size, overlap)

    return split(F.coalesce(text, F.lit("")))
