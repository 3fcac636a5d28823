"""Operator 10: main text of web pages, with a suffix array per host.

A page is read into blocks of text with a role: inside an article, inside main,
other, or furniture (menus, headers, footers, sidebars, notices, adverts, forms,
comments by element or class). The blocks that a page marks as its article, or
else as its main part, or else all but furniture may hold its text.

The token streams of a host's pages are concatenated and their suffixes sorted,
by prefix doubling up to the length that counts, which gives the runs of RUN
tokens that distinct pages share. Pages that mark no article or main part are
judged by each other: a run on MIN_PAGES distinct ones of the host, however
large, is boilerplate. If one stretch of such runs is COPY_WORDS long and makes
MIN_COPY of a page's words, the page is a copy of others and that stretch its
text: it stays. Pages that mark their text need more, since quotations and
copies of articles repeat too: a run on SHARE of all pages of the host, and on
MIN_MARKED at least, is boilerplate there, unless such runs make MIN_COPY or
more of the marked text. Blocks that boilerplate covers go, and of other blocks
the runs inside them; the unique rest stays.

No task holds a whole host: pages of hosts over GROUP_BYTES of html are dealt to
groups by their text. Each group's suffix array counts its runs, and the counts
are added up over the host by a hash of the run. Runs of marked pages are counted
in two steps: a run on SHARE of a host's pages is on SHARE of the pages of some
group, so groups first name those, and then all groups count what any has named.
So counts are those of the whole host however it is dealt. Pages are parsed once
more to be cut, so they are never stored in between.

Defined results: a null or empty html has no text; pages whose url has no host
form the host ''; equal streams count as one page; rows that share a page_id
are read one by one.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stash, table
from .similar import mix

RUN, MIN_PAGES, MIN_MARKED, SHARE, MIN_COPY, COPY_WORDS, BUCKETS = 8, 3, 20, 0.5, 0.5, 60, 256
#: Bytes of html of one group of a host's pages, rows of a broadcast table of hosts, and bytes of runs that tasks hold at once.
GROUP_BYTES, MAX_HOSTS, MAX_RUNS = 16 << 20, 100_000, 32 << 20
ARTICLE, MAIN, OTHER, FURNITURE = 0, 1, 2, 3

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|canvas|object|select)\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)"
#: Element names and words of class, id and role.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_FURNITURE = frozenset("head nav footer aside form button dialog audio video menu".split())
_WORDS_INSIDE = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion cookie cookies consent gdpr popup sidebar comment comments "
    "disqus share sharing social related recommended newsletter subscribe".split()
)
_WORDS = _WORDS_INSIDE | frozenset(
    "banner notice notification modal overlay menu nav navbar navigation breadcrumb breadcrumbs header masthead footer signup login search "
    "pagination pager widget toolbar contentinfo complementary".split()
)


def _is_furniture(name: str, attrs: str, inside: bool) -> bool:
    if name in _FURNITURE or (name == "header" and not inside):
        return True
    if not attrs or name in ("html", "body"):
        return False
    words: set[str] = set()
    for key, *values in _ATTR.findall(attrs):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
            return True
        if key in ("class", "id", "role"):
            words.update(re.split(r"[^a-z0-9]+", value))
    if name == "main":
        return False
    return bool(words & (_WORDS_INSIDE if inside or name == "article" else _WORDS))


def page_blocks(page: str | None) -> list[tuple[str, int]]:
    """(text, role) of each block of a page that has text, in page order."""
    out: list[tuple[str, int]] = []
    if not page:
        return out
    parts: list[str] = []
    articles = mains = depth = 0
    seen_main, skip = False, ""

    def end_block() -> None:
        if parts:
            if text := " ".join(html.unescape("".join(parts)).split()):
                out.append((text, FURNITURE if skip else ARTICLE if articles else MAIN if mains else OTHER))
            parts.clear()

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            parts.append(page[at : token.start()])
        at = token.end()
        name = (token["name"] or token["name2"] or "").lower()
        if not name:
            continue
        closes, attrs = token["close"] or token["close2"], token["attrs"] or token["attrs2"] or ""
        if name == "br":
            parts.append(" ")
            continue
        if name in _BLOCKS or name in _FURNITURE:
            end_block()
        if name in _VOID:
            continue
        holds = name in ("article", "main")
        if closes:
            if skip:
                if name == skip:
                    depth -= 1
                    if not depth:
                        end_block()
                        skip = ""
            elif name == "article":
                articles = max(0, articles - 1)
            elif name == "main":
                mains = max(0, mains - 1)
            continue
        if skip and holds and not seen_main:
            # furniture that was never closed ends where the main part begins
            skip = ""
        if skip:
            depth += name == skip
        elif _is_furniture(name, attrs, articles > 0):
            end_block()
            skip, depth = name, 1
        elif holds:
            seen_main = True
            articles += name == "article"
            mains += name == "main"
    if at < len(page):
        parts.append(page[at:])
    end_block()
    return out


def _best(blocks: list[tuple[str, int]]) -> int:
    """The role of the blocks that hold a page's text."""
    roles = {r for _, r in blocks}
    return ARTICLE if ARTICLE in roles else MAIN if MAIN in roles else OTHER


def _digest(blocks: list[tuple[str, int]]) -> int:
    """Of a page's tokens: equal pages meet in one group, where they count once."""
    return xxhash.xxh3_64_intdigest(" ".join(t for t, _ in blocks).encode("utf-8", "surrogatepass")) - 2**63


def _packed(blocks: list[tuple[str, int]]) -> bytes:
    return zlib.compress(json.dumps(blocks, ensure_ascii=False).encode(), 1)


def _unpacked(packed: bytes) -> tuple[tuple[str, int], ...]:
    return tuple((t, r) for t, r in json.loads(zlib.decompress(packed)))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, salt, groups, page) of the pages with text."""
    for batch in batches:
        hosts, salts, all_groups, pages = [], [], [], []
        for host, groups, page in zip(*(batch.column(c).to_pylist() for c in ("host", "groups", "html"))):
            if blocks := page_blocks(page):
                hosts.append(host)
                salts.append(_digest(blocks) % groups)
                all_groups.append(groups)
                pages.append(_packed(blocks))
        columns = [pa.array(hosts, pa.string()), pa.array(salts, pa.int32()), pa.array(all_groups, pa.int32()), pa.array(pages, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "salt", "groups", "page"])


def _classes(streams: list[list[int]], run: int) -> tuple[np.ndarray, ...]:
    """The suffixes of all streams in order of their first `run` tokens, and the classes of those that share them.

    The streams are concatenated with a unique token after each, and their
    suffixes are sorted by prefix doubling: after k rounds ranks order them by
    their first 2^k tokens, and two last ranks that overlap give the order by
    `run` tokens. Neighbours of equal rank share a substring of that length.

    Gives the text, each stream's size, the suffixes, where each class begins
    among them, and the stream of each suffix where it is the first of its class
    in that stream, else -1.
    """
    size = np.array([len(s) for s in streams], np.int64)
    top = max((int(np.max(s, initial=0)) for s in streams), default=0) + 1
    text = np.concatenate([np.r_[np.array(s, np.int64), top + k] for k, s in enumerate(streams)])
    owner = np.repeat(np.arange(len(streams)), size + 1)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)

    def doubled(rank: np.ndarray, by: int) -> np.ndarray:
        later = np.r_[rank[by:], np.full(min(by, len(rank)), -1)][: len(rank)]
        return np.unique(rank * (len(rank) + 1) + later + 1, return_inverse=True)[1].astype(np.int64)

    length = 1
    while length * 2 <= run:
        rank, length = doubled(rank, length), length * 2
    if length < run:
        rank = doubled(rank, run - length)
    suffixes = np.argsort(rank, kind="stable")
    of, at = rank[suffixes], owner[suffixes]
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    fresh = np.r_[True, (of[1:] != of[:-1]) | (at[1:] != at[:-1])]
    return text, size, suffixes, first, np.where(fresh, at, -1)


def repeated_tokens(streams: list[list[int]], run: int, least: int) -> list[np.ndarray]:
    """For each stream, which tokens lie in a substring of `run` tokens or more that occurs in `least` distinct streams."""
    text, size, suffixes, first, of = _classes(streams, run)
    pages = np.add.reduceat((of >= 0).astype(np.int64), first)
    starts = suffixes[np.repeat(pages >= least, np.diff(np.r_[first, len(suffixes)]))]
    hit = np.zeros(len(text), bool)
    hit[starts] = True
    covered = _spread(hit, run)
    cut = np.cumsum(size + 1)
    return [covered[b - n - 1 : b - 1] for b, n in zip(cut.tolist(), size.tolist())]


def _spread(hit: np.ndarray, run: int) -> np.ndarray:
    """Which places lie in a run that starts at a hit."""
    seen = np.r_[0, np.cumsum(hit)]
    at = np.arange(len(hit))
    return seen[at + 1] > seen[np.maximum(at + 1 - run, 0)]


class _Words:
    """Numbers and hashes of the words of a group."""

    def __init__(self) -> None:
        self.ids: dict[str, int] = {}
        self.hashes: list[int] = []

    def stream(self, blocks: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray]:
        """The words of a page and the block of each; -1 stands where marked text begins or ends, so no run crosses that."""
        best, ids, of, before = _best(blocks), [], [], None
        for k, (text, role) in enumerate(blocks):
            if best != OTHER and before not in (None, role == best):
                ids.append(-1)
                of.append(-1)
            before = role == best
            words = text.split()
            for w in words:
                if (x := self.ids.get(w)) is None:
                    x = self.ids[w] = len(self.hashes)
                    self.hashes.append(xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")))
                ids.append(x)
            of += [k] * len(words)
        return np.array(ids, np.int64), np.array(of, np.int64)

    def keys(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A hash of the RUN words from each place on, and whether there are so many, with no -1 among them."""
        n = len(ids)
        key, whole = np.zeros(n, np.uint64), np.zeros(n, bool)
        if n >= RUN:
            word = np.array([*self.hashes, 0], np.uint64)[ids]
            m = n - RUN + 1
            for j in range(RUN):
                key[:m] = mix(key[:m] * np.uint64(0x9E3779B97F4A7C15) + word[j : m + j])
            bad = np.r_[0, np.cumsum(ids < 0)]
            whole[:m] = bad[RUN:] == bad[:m]
        return key, whole


def _counts(pages: list[tuple[tuple[str, int], ...]]) -> tuple[np.ndarray, ...]:
    """Each run of distinct pages by its hash, in how many of them and in how many without marks it occurs; and how many pages there are."""
    words, streams, bare, seen = _Words(), [], [], set()
    for blocks in pages:
        ids = words.stream(blocks)[0]
        own = ids[ids >= 0].tobytes()
        if own and own not in seen:
            seen.add(own)
            streams.append(ids)
            bare.append(_best(blocks) == OTHER)
    if not streams:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), 0
    alone, unique = len(words.hashes), []
    for ids in streams:
        gaps = np.flatnonzero(ids < 0)
        ids = ids.copy()
        ids[gaps] = alone + np.arange(len(gaps))
        alone += len(gaps)
        unique.append(ids)
    text, _, suffixes, first, of = _classes(unique, RUN)
    key, whole = words.keys(np.where(text < len(words.hashes), text, -1))
    at = suffixes[first]
    whole = whole[at]
    all_, without = (np.add.reduceat(x.astype(np.int64), first)[whole] for x in (of >= 0, np.r_[bare, False][of]))
    return key[at[whole]], all_, without, len(streams)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int, int], list, list[int]]]:
    """Each group (host, salt, groups) with its distinct pages and the keys named for it, from rows sorted by group."""
    now, pages, named = None, {}, []
    for batch in batches:
        for *key, page, keys in zip(*(batch.column(c).to_pylist() for c in ("host", "salt", "groups", "page", "named"))):
            if key != now:
                if pages:
                    yield tuple(now), list(pages), named
                now, pages, named = key, {}, []
            if page is None:
                named += keys
            else:
                pages[_unpacked(page)] = None
    if pages:
        yield tuple(now), list(pages), named


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, key): the runs on SHARE of a group's pages."""
    for (host, _, _), held, _ in _each(batches):
        keys, counts, _, pages = _counts(held)
        often = keys[counts >= SHARE * pages].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([host] * len(often), pa.string()), pa.array(often)], names=["host", "key"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of each group that may be boilerplate, by bucket of their hash."""
    kind = pa.schema([
        ("host", pa.string()), ("salt", pa.int32()), ("bucket", pa.int32()), ("pages", pa.int64()),
        ("keys", pa.binary()), ("counts", pa.binary()), ("bare_keys", pa.binary()), ("bare_counts", pa.binary()),
    ])
    for (host, salt, groups), held, named in _each(batches):
        keys, counts, bare, pages = _counts(held)
        often = counts >= max(MIN_MARKED, SHARE * pages) if groups == 1 else np.isin(keys, np.array(named, np.int64).astype(np.uint64))
        some = bare >= (MIN_PAGES if groups == 1 else 1)
        bucket = (keys >> np.uint64(40)).astype(np.int64) % min(groups, BUCKETS)
        out = []
        for b in range(min(groups, BUCKETS)):
            # every group has a row in every bucket, so that each bucket knows of all pages
            x, y = often & (bucket == b), some & (bucket == b)
            packed = [keys[x].tobytes(), counts[x].astype(np.int32).tobytes(), keys[y].tobytes(), bare[y].astype(np.int32).tobytes()]
            if groups > 1 or x.any() or y.any():
                out.append((host, salt, b, pages, *packed))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(kind)], schema=kind)


def _hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, salt, keys, bare_keys): each group's runs that are boilerplate on the whole host, from rows sorted by host and bucket."""

    def judged(keys: list[bytes], counts: list[bytes], least: float) -> list[bytes]:
        each = [np.frombuffer(k, np.uint64) for k in keys]
        of = np.unique(np.concatenate(each), return_inverse=True)[1]
        pages = np.bincount(of, np.concatenate([np.frombuffer(c, np.int32) for c in counts])) if len(of) else np.empty(0)
        often = np.split(pages[of] >= least, np.cumsum([len(k) for k in each])[:-1])
        return [k[o].tobytes() for k, o in zip(each, often)]

    def rows(host: str, held: list[tuple]) -> pa.RecordBatch:
        salts, pages, keys, counts, bare_keys, bare_counts = zip(*held)
        found = judged(keys, counts, max(MIN_MARKED, SHARE * sum(pages))), judged(bare_keys, bare_counts, MIN_PAGES)
        out = [x for x in zip(salts, *found) if x[1] or x[2]]
        columns = [pa.array([host] * len(out), pa.string()), *(pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int32(), pa.binary(), pa.binary())))]
        return pa.RecordBatch.from_arrays(columns, names=["host", "salt", "keys", "bare_keys"])

    now, held = None, []
    for batch in batches:
        for host, bucket, *row in zip(*(batch.column(c).to_pylist() for c in ("host", "bucket", "salt", "pages", "keys", "counts", "bare_keys", "bare_counts"))):
            if (host, bucket) != now and held:
                yield rows(now[0], held)
                held = []
            now = (host, bucket)
            held.append(tuple(row))
    if held:
        yield rows(now[0], held)


def _sorted(*keys: bytes) -> np.ndarray:
    return np.unique(np.frombuffer(b"".join(keys), np.uint64))


def _text(blocks: list[tuple[str, int]], words: _Words, hot: np.ndarray) -> str:
    """The page's text without the runs in hot, which is sorted.

    A block that such runs cover goes; of others the runs inside it go. Marked
    text that is mostly such runs is a copy and stays; so does a stretch of them
    that is most of an unmarked page.
    """
    best = _best(blocks)
    if not len(hot):
        return "\n\n".join(t for t, r in blocks if r == best)
    ids, of = words.stream(blocks)
    key, whole = words.keys(ids)
    hit = whole & (hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key)
    covered = _spread(hit, RUN)
    inside = _spread(hit & (of == np.r_[of[RUN - 1 :], np.full(min(RUN - 1, len(of)), -1)][: len(of)]), RUN)
    role_of = np.array([*(r for _, r in blocks), -1], np.int64)[of]
    if best != OTHER and covered[role_of == best].mean() >= MIN_COPY:
        return "\n\n".join(t for t, r in blocks if r == best)
    if best == OTHER:
        edges = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8)))
        sizes = edges[1::2] - edges[::2]
        if len(sizes) and sizes.max() >= max(COPY_WORDS, MIN_COPY * (role_of == best).sum()):
            stretch = slice(edges[2 * sizes.argmax()], edges[2 * sizes.argmax() + 1])
            covered[stretch] = inside[stretch] = False
    kept = []
    for k, (text, role) in enumerate(blocks):
        if role == best:
            at = np.flatnonzero(of == k)
            if not inside[at].any() and not covered[at].all():
                kept.append(text)
            elif not covered[at].all():
                kept.append(" ".join(w for w, x in zip(text.split(), inside[at].tolist()) if not x))
    return "\n\n".join(kept)


def _cut_by(runs: Broadcast) -> Callable:
    """Texts of pages; runs holds, by host, the runs for marked pages and for others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.uint64)
        for batch in batches:
            texts, words = [], _Words()
            for host, page in zip(*(batch.column(c).to_pylist() for c in ("host", "html"))):
                blocks = page_blocks(page)
                marked, bare = runs.value.get(host, (none, none))
                texts.append(_text(blocks, words, bare if _best(blocks) == OTHER else marked))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of pages; the rows with the runs of a group come before its pages."""
    now, hot, words, marked, bare = None, [], _Words(), None, None
    for batch in batches:
        texts = []
        for host, salt, keys, bare_keys, page in zip(*(batch.column(c).to_pylist() for c in ("host", "salt", "keys", "bare_keys", "html"))):
            if (host, salt) != now:
                now, hot, words, marked = (host, salt), [], _Words(), None
            if keys is not None:
                hot.append((keys, bare_keys))
                texts.append(None)
                continue
            if marked is None:
                marked, bare = _sorted(*(k for k, _ in hot)), _sorted(*(k for both in hot for k in both))
            blocks = page_blocks(page)
            texts.append(_text(blocks, words, bare if _best(blocks) == OTHER else marked))
        out = pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])
        yield out.filter(pa.array([t is not None for t in texts], pa.bool_()))


def _salted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        salts = [_digest(page_blocks(page)) % groups for groups, page in zip(batch.column("groups").to_pylist(), batch.column("html").to_pylist())]
        yield batch.drop_columns(["groups"]).append_column("salt", pa.array(salts, pa.int32()))


def main_text(pages: DataFrame, group_bytes: int = GROUP_BYTES, max_runs: int = MAX_RUNS) -> DataFrame:
    """(page_id, url, text) of pages with page_id, url and html."""
    kinds = dict(pages.select("page_id", "url").dtypes)
    out = f"page_id {kinds['page_id']}, url {kinds['url']}, text string"
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST, 1))
    pages = pages.select("page_id", "url", "html", host.alias("host"))
    groups = F.ceil(F.sum(F.octet_length("html")) / F.lit(group_bytes)).cast("int")
    large = stash(pages.groupBy("host").agg(groups.alias("groups")).filter("groups > 1"), "hosts")
    dealt = pages.join(F.broadcast(large) if large.count() <= MAX_HOSTS else large, "host", "left").withColumn("groups", F.coalesce("groups", F.lit(1)))
    parse = lambda df: df.select("host", "groups", "html").mapInArrow(_parse, "host string, salt int, groups int, page binary")
    parsed = parse(dealt)
    dealt_out = lambda df: df.repartition("host", "salt").sortWithinPartitions("host", "salt", F.col("page").asc_nulls_first())
    named = F.lit(None).cast("array<long>")
    if not large.isEmpty():
        names = dealt_out(parse(dealt.filter("groups > 1")).withColumn("named", named)).mapInArrow(_names, "host string, key long")
        names = names.distinct().groupBy("host").agg(F.collect_list("key").alias("named")).join(large, "host")
        salt = F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("salt")
        names = stash(names.select("host", salt, "groups", F.lit(None).cast("binary").alias("page"), "named"), "named")
        rows = parsed.withColumn("named", named).unionByName(names)
    else:
        rows = parsed.withColumn("named", named)
    counted = dealt_out(rows).mapInArrow(
        _groups, "host string, salt int, bucket int, pages long, keys binary, counts binary, bare_keys binary, bare_counts binary"
    )
    hot = counted.repartition("host", "bucket").sortWithinPartitions("host", "bucket").mapInArrow(_hot, "host string, salt int, keys binary, bare_keys binary")
    hot = stash(hot, "runs")
    size = hot.agg(F.sum(F.octet_length("host") + F.octet_length("keys") + F.octet_length("bare_keys"))).first()[0] or 0
    if size <= max_runs:
        found: dict[str, list[tuple[bytes, bytes]]] = {}
        for r in hot.drop("salt").collect():
            found.setdefault(r.host, []).append((bytes(r.keys), bytes(r.bare_keys)))
        runs = {h: (_sorted(*(k for k, _ in both)), _sorted(*(k for pair in both for k in pair))) for h, both in found.items()}
        return pages.mapInArrow(_cut_by(pages.sparkSession.sparkContext.broadcast(runs)), out)
    salted = dealt.mapInArrow(_salted, f"host string, page_id {kinds['page_id']}, url {kinds['url']}, html string, salt int")
    both = salted.unionByName(hot, allowMissingColumns=True).repartition("host", "salt").sortWithinPartitions("host", "salt", F.col("keys").asc_nulls_last())
    return both.mapInArrow(_cut, out)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
