"""Operator 7: token ids in sorted string tables.

Documents are range-partitioned and sorted by identifier; each partition
becomes one shard file. A shard has

    blocks   compressed; entries with the part of the key that differs from the
             key before, the number of ids and the ids
    index    one entry per block: first key, place, ids before it
    filter   a Bloom filter over the keys
    footer   fixed size: places of index and filter, counts, magic

so one document is found by filter, binary search of the index and a scan of
one block. Files are written under a temporary name and then moved, so a task
that runs again, or twice, leaves one whole shard. Shards go to the shared
folder through its file system, never to a local one.

The tokenizer runs on distinct chunks between single blanks: byte-level
pre-tokenisation never joins what such a blank separates, so a chunk has the
same ids alone and in its text. Texts where a blank touches other white space,
or that hold a special token, go to the tokenizer whole; chunks tell of either.
Of the chunks that a task knows, the less frequent half goes when there are too
many.

Defined results: null and empty texts have only the end id. A null doc_id has
the empty key and sorts first; rows that share a doc_id keep an entry each.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_folder, stash, table

END_ID = 2
MAGIC = b"PLSST001"
#: Fixed value: how byte-level vocabularies write the blank.
BLANK = "Ġ"
_FOOTER = struct.Struct("<QQQQQQBB6x8s")
BLOCK_BYTES, BLOOM_BITS, BLOOM_HASHES = 256 * 1024, 10, 7
CACHE_CHUNKS, JOINED, SLICE_CHARS = 400_000, 300, 2_000_000


def _places(chunks: Iterable[str]) -> dict[str, int]:
    """Chunk to place, in order of the places; a chunk that is looked up and new gets the next place."""
    held = {c: k for k, c in enumerate(chunks)}
    return defaultdict(count(len(held)).__next__, held)


class Tokens:
    """A tokenizers file, with a bounded cache of chunks. end: an id that is put after each text."""

    def __init__(self, path: str, end: int | None = None):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(added)) if added else None
        vocabulary = self.library.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith(BLANK)]] = True
        self.width = 2 if self.library.get_vocab_size() <= 65536 else 4
        # what stands after each text is a chunk too, under a name that none of a text can have
        self.end = [] if end is None else ["  "]
        self.flat, self.size = np.array([end] * len(self.end), np.uint32), np.ones(len(self.end), np.int64)
        self.odd, self.seen = np.zeros(len(self.end), bool), np.zeros(len(self.end), np.int64)
        self.places = _places(self.end)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks that each follow a blank, with that blank, in one array, and how many each has.

        Many chunks go to the library as one text; the ids of tokens that start with a blank part them again.
        """
        texts = (" " + " ".join(chunks[i : i + JOINED]) for i in range(0, len(chunks), JOINED))
        ids = [np.array(self.whole([t])[0], np.uint32) for t in texts]
        flat = np.concatenate([np.empty(0, np.uint32), *ids])
        size = np.diff(np.r_[np.flatnonzero(self.opens[flat]), len(flat)])
        if len(size) == len(chunks):
            return flat, size
        parted = self.whole([" " + c for c in chunks])
        return np.concatenate([np.array(i, np.uint32) for i in parted]), np.array([len(i) for i in parted])

    def learn(self) -> None:
        """The ids of the chunks that are new, and whether a text with them has to go whole.

        A text's first chunk has a line end and a blank before it; one that ends its text in white space, a blank after it.
        """
        new = list(islice(self.places, len(self.size), None))
        # most have no white space at their ends, and all of them together no special token
        special = self.special if self.special and self.special.search(" ".join(new)) else None
        plain = [c != "" and c.strip() == c and not (special and special.search(c)) for c in new]
        alone, joined, odd = [], [k for k, p in enumerate(plain) if p], np.zeros(len(new), bool)
        for k in [k for k, p in enumerate(plain) if not p]:
            name = new[k]
            first, last = name.startswith("\n "), name.endswith(" ") and name != "\n "
            chunk = name[2 * first : len(name) - last]
            if not chunk or (not first and chunk[0].isspace()) or (not last and chunk[-1].isspace()) or (special and special.search(chunk)):
                odd[k] = True
            else:
                alone.append((k, chunk if first else " " + chunk))
        parted = self.whole([c for _, c in alone])
        flat, of_joined = self.chunks([new[k] for k in joined])
        size, own = np.zeros(len(new), np.int64), np.zeros(len(new), bool)
        size[[k for k, _ in alone]], size[joined] = [len(i) for i in parted], of_joined
        own[[k for k, _ in alone]] = True
        both, of_alone = np.empty(int(size.sum()), np.uint32), np.repeat(own, size)
        both[of_alone] = np.concatenate([np.empty(0, np.uint32), *[np.array(i, np.uint32) for i in parted]])
        both[~of_alone] = flat
        self.flat, self.size, self.odd = np.concatenate([self.flat, both]), np.r_[self.size, size], np.r_[self.odd, odd]
        self.seen = np.r_[self.seen, np.zeros(len(new), np.int64)]

    def forget(self) -> None:
        """Keeps the more frequent half of the chunks, and the end."""
        order = np.argsort(-self.seen[len(self.end) :], kind="stable")[: CACHE_CHUNKS // 2] + len(self.end)
        keep = np.r_[np.arange(len(self.end)), np.sort(order)]
        names, start = list(self.places), np.cumsum(self.size) - self.size
        size = self.size[keep]
        self.flat = self.flat[np.repeat(start[keep] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        self.size, self.odd, self.seen = size, self.odd[keep], self.seen[keep] // 2
        self.places = _places([names[k] for k in keep.tolist()])

    def _at(self, chunks: list[str]) -> np.ndarray:
        return np.fromiter(map(self.places.__getitem__, chunks), np.int64, len(chunks))

    def flat_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with its end, in one array, and where each begins; one place more than texts."""
        if len(self.places) > CACHE_CHUNKS:
            self.forget()
        # words are told apart by Arrow; only different ones are looked up here
        parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        words, cut = parts.flatten().dictionary_encode(), parts.offsets.to_numpy()
        at = self._at(words.dictionary.to_pylist())[words.indices.to_numpy()]
        heads, tails, full = [], [], np.array([t != "" for t in texts], bool)
        for text, low, high in zip(texts, cut[:-1].tolist(), cut[1:].tolist()):
            if text:
                blank = text[-1].isspace()
                heads.append("\n " + (text if high == low + 1 else text[: text.index(" ")]) + " " * (blank and high == low + 1))
                if blank and high > low + 1:
                    tails.append((high - 1, text[text.rindex(" ") + 1 :] + " "))
        at[cut[:-1][full]] = self._at(heads)
        at[[k for k, _ in tails]] = self._at([t for _, t in tails])
        # an empty text has no chunk
        n = np.diff(cut) - ~full
        at = np.insert(np.delete(at, cut[:-1][~full]), np.repeat(np.cumsum(n), len(self.end)), 0)
        ends = np.cumsum(n + len(self.end))
        if len(self.places) > len(self.size):
            self.learn()
        self.seen += np.bincount(at, minlength=len(self.seen))
        size, start = self.size[at], (np.cumsum(self.size) - self.size)[at]
        after = np.r_[0, np.cumsum(size)]
        flat = self.flat[np.repeat(start - after[:-1], size) + np.arange(after[-1])]
        cut, odd = np.r_[0, after[ends]], np.r_[0, np.cumsum(self.odd[at])]
        whole = np.flatnonzero(odd[ends] > odd[np.r_[0, ends[:-1]][: len(ends)]]).tolist()
        if not whole:
            return flat, cut
        tail = self.flat[: len(self.end)]
        each = [flat[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
        for k, ids in zip(whole, self.whole([texts[k] for k in whole])):
            each[k] = np.concatenate([np.array(ids, np.uint32), tail])
        return np.concatenate(each), np.r_[0, np.cumsum([len(x) for x in each])]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        flat, cut = self.flat_ids(texts)
        return [flat[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]


@lru_cache(maxsize=2)
def tokens(path: str, end: int | None = None) -> Tokens:
    # a task has one core; the library's own threads would only take memory and time from others
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokens(path, end)


def key_of(doc_id: int | None) -> bytes:
    """Bytes in the order of the numbers; none for null."""
    return b"" if doc_id is None else struct.pack(">Q", doc_id + 2**63)


def id_of(key: bytes) -> int | None:
    return struct.unpack(">Q", key)[0] - 2**63 if key else None


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _bits(keys: list[bytes], size: int) -> np.ndarray:
    """The bit places of keys in a filter of so many bits, a row per key."""
    h = np.array([(xxhash.xxh3_64_intdigest(k), xxhash.xxh3_64_intdigest(k, seed=1) | 1) for k in keys], np.uint64).reshape(-1, 2)
    return (h[:, :1] + h[:, 1:] * np.arange(BLOOM_HASHES, dtype=np.uint64)) % np.uint64(size)


class ShardWriter:
    """Takes entries in key order and writes one shard."""

    def __init__(self, file, width: int):
        self.file, self.width, self.kind = file, width, f"<u{width}"
        self.at = self.n_docs = self.n_ids = self.block_ids = 0
        self.keys: list[bytes] = []
        self.index: list[bytes] = []
        self.block = bytearray()
        self.first = self.last = b""
        self.in_block = 0
        self.pack = zstandard.ZstdCompressor(level=1)

    def add(self, key: bytes, ids: np.ndarray) -> None:
        if not self.in_block:
            self.first, self.last, self.block_ids = key, b"", self.n_ids
        shared = 0
        while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
            shared += 1
        self.block += _varint(shared) + _varint(len(key) - shared) + key[shared:] + _varint(len(ids))
        self.block += ids.astype(self.kind).tobytes()
        self.last, self.in_block = key, self.in_block + 1
        self.keys.append(key)
        self.n_docs += 1
        self.n_ids += len(ids)
        if len(self.block) >= BLOCK_BYTES:
            self.flush()

    def _put(self, data: bytes) -> None:
        self.file.write(data)
        self.at += len(data)

    def flush(self) -> None:
        if self.in_block:
            data = self.pack.compress(bytes(self.block))
            self.index.append(_varint(len(self.first)) + self.first + _varint(self.at) + _varint(len(data)) + _varint(self.in_block) + _varint(self.block_ids))
            self._put(data)
            self.block, self.in_block = bytearray(), 0

    def close(self) -> None:
        self.flush()
        index_at, index = self.at, b"".join(self.index)
        self._put(index)
        size = max(64, -(-self.n_docs * BLOOM_BITS // 8) * 8)
        bloom = np.zeros(size, np.uint8)
        for start in range(0, len(self.keys), 65536):
            bloom[_bits(self.keys[start : start + 65536], size).astype(np.int64).ravel()] = 1
        bloom_at, packed = self.at, np.packbits(bloom).tobytes()
        self._put(packed)
        self._put(_FOOTER.pack(index_at, len(index), bloom_at, len(packed), self.n_docs, self.n_ids, self.width, BLOOM_HASHES, MAGIC))


def file_system(uri: str) -> tuple[FileSystem, str]:
    """The file system of a URI and the path in it; Hadoop's names for S3 are known too."""
    return FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


class ShardReader:
    """Reads a shard by its footer: all entries in order, or those of one key."""

    def __init__(self, uri: str):
        system, path = file_system(uri)
        self.file = system.open_input_file(path)
        end = self.file.size()
        foot = self.file.read_at(_FOOTER.size, end - _FOOTER.size)
        index_at, index_size, bloom_at, bloom_size, self.n_docs, self.n_ids, self.width, _, magic = _FOOTER.unpack(foot)
        if magic != MAGIC:
            raise ValueError(f"{uri} is no whole shard")
        self.bloom = np.unpackbits(np.frombuffer(self.file.read_at(bloom_size, bloom_at), np.uint8))
        data, at = self.file.read_at(index_size, index_at), 0
        self.blocks: list[tuple[bytes, int, int, int, int]] = []
        while at < len(data):
            n, at = _read_varint(data, at)
            key, at = data[at : at + n], at + n
            numbers = []
            for _ in range(4):
                value, at = _read_varint(data, at)
                numbers.append(value)
            self.blocks.append((key, *numbers))
        self.unpack = zstandard.ZstdDecompressor()

    def block(self, k: int) -> Iterator[tuple[bytes, int, np.ndarray]]:
        """(key, ids of the shard before, ids) of each entry of block k."""
        _, place, size, count, before = self.blocks[k]
        data, at, key = self.unpack.decompress(self.file.read_at(size, place)), 0, b""
        for _ in range(count):
            shared, at = _read_varint(data, at)
            n, at = _read_varint(data, at)
            key, at = key[:shared] + data[at : at + n], at + n
            n, at = _read_varint(data, at)
            ids = np.frombuffer(data, f"<u{self.width}", n, at)
            at += n * self.width
            yield key, before, ids
            before += n

    def __iter__(self) -> Iterator[tuple[bytes, int, np.ndarray]]:
        for k in range(len(self.blocks)):
            yield from self.block(k)

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every entry of a document; an empty list if there is none."""
        key = key_of(doc_id)
        if not self.blocks or not self.bloom[_bits([key], len(self.bloom)).astype(np.int64)].all():
            return []
        firsts = [b[0] for b in self.blocks]
        k = max(0, bisect_right(firsts, key) - 1)
        while k > 0 and firsts[k] == key:
            k -= 1
        found = []
        while k < len(firsts) and firsts[k] <= key:
            found += [ids for own, _, ids in self.block(k) if own == key]
            k += 1
        return found


def write_tables(docs: DataFrame, tokenizer: str, folder: str, end_id: int | None = END_ID) -> DataFrame:
    """Writes shards of (doc_id, text) to folder, a URI; returns their manifest, stored:
    shard, path, n_docs, n_ids and the first and last doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, system = tokens(tokenizer, end_id), None
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            start = 0
            while start < len(ids):
                if system is None:
                    shard = TaskContext.get().partitionId()
                    path = f"{folder}/shard-{shard:06d}.sst"
                    system, place = file_system(path)
                    system.create_dir(place.rpartition("/")[0], recursive=True)
                    partial = f"{place}.{uuid.uuid4().hex}.part"
                    stream = system.open_output_stream(partial)
                    writer, first = ShardWriter(stream, code.width), ids[0]
                stop, held = start, 0
                while stop < len(ids) and (stop == start or held + len(texts[stop]) <= SLICE_CHARS):
                    held += len(texts[stop])
                    stop += 1
                for doc_id, own in zip(ids[start:stop], code.encode(texts[start:stop])):
                    writer.add(key_of(doc_id), own)
                last, start = ids[stop - 1], stop
        if system is not None:
            writer.close()
            stream.close()
            system.move(partial, place)
            row = {"shard": shard, "path": path, "n_docs": writer.n_docs, "n_ids": writer.n_ids, "first_id": first, "last_id": last}
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64())]))

    text = F.coalesce(F.col("text"), F.lit(""))
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    made = dealt.mapInArrow(run, "shard int, path string, n_docs long, n_ids long, first_id long, last_id long")
    return stash(made, "manifest")


def read_tables(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids): every entry of the shards; start counts the ids of all entries before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                reader = ShardReader(path)
                for k in range(len(reader.blocks)):
                    rows = list(reader.block(k))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([id_of(key) for key, _, _ in rows], pa.int64()),
                            pa.array([base + before for _, before, _ in rows], pa.int64()),
                            pa.array([ids.astype("<u4").tobytes() for _, _, ids in rows], pa.binary()),
                        ],
                        names=["doc_id", "start", "ids"],
                    )

    return based(manifest).mapInArrow(run, "doc_id long, start long, ids binary")


def based(manifest: DataFrame) -> DataFrame:
    """(path, base), a task per shard; base is the sum of n_ids of all shards before, by a window over the manifest's few rows."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    return shards.repartition(max(1, manifest.count()))


def digests(entries: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of entries read back; ids are their little-endian 32-bit bytes."""
    return entries.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_token_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(read_tables(write_tables(docs, tokenizer_path(), new_folder(spark, "tokens"))))
