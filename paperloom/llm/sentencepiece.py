"""Operator 2: SentencePiece BPE encoding and decoding in vectorised merge rounds.

The text is cut into words: a run of word-start marks and what follows it. No
vocabulary piece spans a cut (checked when the model is read), so each distinct
word is encoded once per batch and kept in a bounded cache. All new words of a
batch form one flat array of symbols. Each round takes, per word, the best rank
of any adjacent pair (a segmented minimum), merges its leftmost non-overlapping
occurrences at once, and compacts the arrays; words without a mergeable pair
leave. Where a merge would create a pair of the same or a better rank, only the
first occurrence of that word merges in the round. This is exactly the order of
a priority queue by score and then position.

Characters outside the vocabulary become byte pieces. Decoding maps ids to
their bytes by table and reads them as UTF-8, each stray byte as U+FFFD.

Defined results: a null or empty text has no ids and decodes to the empty
string. Texts go through in slices of bounded size; there is no shuffle.
"""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, unused

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
NONE = np.iinfo(np.int64).max
#: Distinct words that a worker keeps, and characters that it encodes at a time.
CACHE_WORDS, SLICE_CHARS = 200_000, 4_000_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}[key & 7] if key & 7 != 2 else number()
        yield key >> 3, data[at : at + size]
        at += size


def _one_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("paperloom_one_byte", _one_byte)


class Pieces:
    """A BPE model: its pieces, the pairs that merge, and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = file.read()
        pieces, scores, kinds = [], [], []
        for field, value in _fields(data):
            if field == 1:
                one = dict(_fields(value))
                pieces.append(one[1].decode())
                scores.append(struct.unpack("<f", one[2])[0] if 2 in one else 0.0)
                kinds.append(one.get(3, NORMAL))
            elif field == 3:
                rules = dict(_fields(value))
                if rules.get(2) or rules.get(4, 1) or not rules.get(3, 1) or not rules.get(5, 1):
                    raise ValueError("only models that keep the text as it is, with a mark before it, are supported")
        self.size = n = len(pieces)
        self.ids = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == NORMAL}
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece spans words")
        _, rank = np.unique(-np.array(scores, dtype=np.float64), return_inverse=True)
        found = [
            (a * n + b, i)
            for p, i in self.ids.items()
            for cut in range(1, len(p))
            if (a := self.ids.get(p[:cut])) is not None and (b := self.ids.get(p[cut:])) is not None
        ]
        keys, merged = np.array(found, dtype=np.int64).T
        order = np.argsort(keys)
        self.keys, self.merged = keys[order], merged[order]
        self.rank = rank.astype(np.int64)
        self.byte0 = next(i for i, k in enumerate(kinds) if k == BYTE)
        raw = [
            bytes([i - self.byte0]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else p.replace(MARK, " ").encode()
            for i, (p, k) in enumerate(zip(pieces, kinds))
        ]
        self.raw = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.raw_size = np.array([len(r) for r in raw], dtype=np.int64)
        self.marked = np.array([k == NORMAL and p.startswith(MARK) for p, k in zip(pieces, kinds)])
        self.raw_from = np.cumsum(self.raw_size) - self.raw_size

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of the merged piece of each pair; NONE where there is none."""
        key = np.where((left < self.size) & (right < self.size), left * self.size + right, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        merged = np.where(hit, self.merged[at], -1)
        return np.where(hit, self.rank[merged], NONE), merged

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each word, by merge rounds over all of them at once."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(words)
        chars = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        codes, place = np.unique(chars, return_inverse=True)
        known = np.array([self.ids.get(chr(c), self.size + c) for c in codes.tolist()], dtype=np.int64)
        symbol = known[place] if len(chars) else np.empty(0, np.int64)
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        rank, merged = self._pairs(symbol, word)
        while len(symbol):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.minimum.reduceat(rank, first)
            ended = best == NONE
            if ended.any():
                sizes = np.diff(np.r_[first, len(symbol)])
                for k in np.flatnonzero(ended).tolist():
                    out[word[first[k]]] = self._bytes(symbol[first[k] : first[k] + sizes[k]])
                stay = np.repeat(~ended, sizes)
                symbol, word, rank, merged = symbol[stay], word[stay], rank[stay], merged[stay]
                first, best = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else first[:0], best[~ended]
                if not len(symbol):
                    break
            sizes = np.diff(np.r_[first, len(symbol)])
            at = np.flatnonzero(rank == np.repeat(best, sizes))
            run = np.r_[True, at[1:] != at[:-1] + 1]
            in_run = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            at = at[in_run % 2 == 0]
            at = self._only_first(at, symbol, word, rank, merged)
            symbol[at] = merged[at]
            stay = np.ones(len(symbol), dtype=bool)
            stay[at + 1] = False
            new = np.zeros(len(symbol), dtype=bool)
            new[at] = True
            new[at[at > 0] - 1] = True
            # a neighbour that was itself merged away hands its mark to the piece before it
            gone = np.flatnonzero(new & ~stay)
            new[gone - 1] = True
            symbol, word, rank, merged, new = symbol[stay], word[stay], rank[stay], merged[stay], new[stay]
            again = np.flatnonzero(new)
            inner = again[again + 1 < len(symbol)]
            inner = inner[word[inner] == word[inner + 1]]
            rank[again] = NONE
            rank[inner], merged[inner] = self.pair(symbol[inner], symbol[inner + 1])
        return out

    def _pairs(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, merged = np.full(len(symbol), NONE), np.full(len(symbol), -1)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], merged[inner] = self.pair(symbol[inner], symbol[inner + 1])
        return rank, merged

    def _only_first(self, at: np.ndarray, symbol: np.ndarray, word: np.ndarray, rank: np.ndarray, merged: np.ndarray) -> np.ndarray:
        """at, but only the first place of words in which a new pair would not come later."""
        many = np.flatnonzero(np.bincount(word[at], minlength=0)[word[at]] > 1)
        if not len(many):
            return at
        a, m, bar = at[many], merged[at[many]], rank[at[many]]
        early = np.zeros(len(a), dtype=bool)
        left = np.maximum(a - 1, 0)
        early |= (a > 0) & (word[left] == word[a]) & (self.pair(symbol[left], m)[0] <= bar)
        right = np.minimum(a + 2, len(symbol) - 1)
        early |= (a + 2 < len(symbol)) & (word[right] == word[a]) & (self.pair(m, symbol[right])[0] <= bar)
        beside = np.r_[False, a[1:] == a[:-1] + 2]
        early |= beside & (self.pair(np.r_[m[:1], m[:-1]], m)[0] <= bar)
        bad = np.unique(word[a[early]])
        if not len(bad):
            return at
        leading = np.r_[True, word[at[1:]] != word[at[:-1]]]
        return at[leading | ~np.isin(word[at], bad)]

    def _bytes(self, symbol: np.ndarray) -> np.ndarray:
        if (symbol < self.size).all():
            return symbol.astype(np.int32)
        parts = [[s] if s < self.size else [self.byte0 + b for b in chr(s - self.size).encode()] for s in symbol.tolist()]
        return np.array([i for p in parts for i in p], dtype=np.int32)

    def decode(self, flat: np.ndarray, ends: np.ndarray) -> list[str]:
        """The text of each list of ids; ends[k] is where list k stops in flat.

        If the first piece that says anything has a mark, that mark is dropped.
        """
        size = self.raw_size[flat]
        data = self.raw[_spread(self.raw_from[flat], size)].tobytes()
        cut = np.r_[0, np.cumsum(size)][np.r_[0, ends]].tolist()
        said = np.flatnonzero(size)
        first = said[np.minimum(np.searchsorted(said, np.r_[0, ends[:-1]]), len(said) - 1)] if len(said) else np.zeros(len(ends), int)
        drop = (self.marked[flat[first]] if len(said) else np.zeros(len(ends), bool)).tolist()
        return [data[a + (d and b > a) : b].decode("utf-8", "paperloom_one_byte") for a, b, d in zip(cut, cut[1:], drop)]


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[k], start[k] + 1, ... for size[k] numbers, for all k in turn."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


class Encoder:
    """Encodes texts with a bounded cache of words."""

    def __init__(self, path: str):
        self.pieces = Pieces(path)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.size = np.empty(0, np.int32), np.empty(0, np.int64)

    def words(self, text: str) -> list[str]:
        """The words without their first mark; where marks follow each other the later ones stay in the word."""
        if not text:
            return []
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
            return [w[1:] for w in re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))]
        return text.split(" ")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and where each text's ids end."""
        words = [self.words(t) for t in texts]
        new = set().union(*words).difference(self.index)
        if len(self.index) + len(new) > CACHE_WORDS:
            self.clear()
            new = set().union(*words)
        if new:
            listed = sorted(new)
            ids = self.pieces.encode_words([MARK + w for w in listed])
            self.index.update(zip(listed, range(len(self.size), len(self.size) + len(listed))))
            self.flat = np.concatenate([self.flat, *ids])
            self.size = np.r_[self.size, [len(i) for i in ids]]
        index = self.index
        at = np.fromiter((index[w] for ws in words for w in ws), dtype=np.int64)
        size = self.size[at]
        flat = self.flat[_spread((np.cumsum(self.size) - self.size)[at], size)]
        ends = np.r_[0, np.cumsum(size)][np.cumsum([len(w) for w in words])]
        return flat, ends


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and model."""
    return Encoder(path)


def slices(texts: list[str]) -> Iterator[slice]:
    """Runs of texts of bounded length in sum."""
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > SLICE_CHARS:
            yield slice(start, i)
            start, held = i, 0
        held += len(t) + 1
    if start < len(texts):
        yield slice(start, len(texts))


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """docs with an array of ids and, if a name is given, the text decoded from them.

    Columns of these names that docs has already are replaced. model is a path
    that every executor can open, as part of its Python installation.
    """
    carried = [c for c in docs.columns if c not in (ids, decoded)]
    held = unused(docs, "coded_text")
    docs = docs.select(*[F.col(f"`{c}`") for c in carried], F.coalesce(F.col(text), F.lit("")).alias(held))
    fields = [f for f in docs.schema.fields if f.name != held]
    added = [T.StructField(ids, T.ArrayType(T.IntegerType()))] + ([T.StructField(decoded, T.StringType())] if decoded else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(model)
        for batch in batches:
            texts = batch.column(held).to_pylist()
            rest = batch.drop_columns([held])
            for part in slices(texts):
                flat, ends = code.encode(texts[part])
                columns = [pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(flat, pa.int32()))]
                if decoded:
                    columns.append(pa.array(code.pieces.decode(flat, ends), pa.string()))
                kept = rest.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([*kept.columns, *columns], names=[*kept.schema.names, ids, *([decoded] if decoded else [])])

    return docs.mapInArrow(run, T.StructType(fields + added))


def decode(frame: DataFrame, model: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """frame with the text of an array of ids; a null array is an empty one."""
    fields = [f for f in frame.schema.fields if f.name != decoded]
    frame = frame.select(*[f.name for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(model).pieces
        for batch in batches:
            lists = [np.array(x or [], dtype=np.int64) for x in batch.column(ids).to_pylist()]
            flat = np.concatenate([np.empty(0, np.int64), *lists])
            texts = pieces.decode(flat, np.cumsum([len(x) for x in lists], dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, decoded])

    return frame.mapInArrow(run, T.StructType([*fields, T.StructField(decoded, T.StringType())]))


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def digests(docs: DataFrame, model: str) -> DataFrame:
    """docs with n_tokens, ids_sha256 and decoded_sha256 in place of the texts; other columns stay, ids and decoded among them."""
    carried = [c for c in docs.columns if c not in ("text", "n_tokens", "ids_sha256", "decoded_sha256")]
    ids, decoded = unused(docs, "coded_ids"), unused(docs, "coded_back")
    coded = encode(docs, model, ids=ids, decoded=decoded)
    return coded.select(
        *[F.col(f"`{c}`") for c in carried],
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
    )


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"), model_path())
