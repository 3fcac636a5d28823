"""Operator 12: how the sources of a language differ in their words.

Each source of a language gives each kept term of the language a smoothed share
p of its words, in billionths and whole numbers; so does the language itself.
What a share p costs against q is floor((p - q) (p - q) / q). Two sources are
compared by the sum of that over all kept terms, and a source with its language
by the terms that it uses more.

Terms are counted in their task first, so the shuffle gets a row for a term,
source and task, not for an occurrence. A source's vocabulary is sparse: most
terms of the language are missing in it and have its baseline share p0. So a
pair of sources starts from the value of two baselines, times all terms; the
terms that one of them has are corrected by a histogram of its shares against
the distinct baselines of the language; and only terms that both have are looked
at term by term, summed up by pair in the task that holds the term. No pair
leaves a task before it is summed.

Top terms are picked by radix select. Values are cut into digits of 16 bits;
from the highest digit on, one distributed histogram for each source tells which
digit the k-th value has, and only values with that digit are counted for the
next. Values equal to the k-th are cut the same way by the UTF-8 bytes of their
terms, two at a time, after what the terms that are left begin with. No source's
terms are sorted or gathered: what reaches the last sort are the k that stay.

Defined results: null text, language and source count as ''. Each row is a
document of its own, whatever its id. A source without kept terms has the
baseline alone; a language without kept terms gives pairs of value 0 and no
terms. Columns other than the three are left out. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_if, stash, table

#: What stands between terms.
GAP = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS, TOP, SCALE = 3, 200, 1_000_000_000
#: Sources whose numbers are broadcast; with more they are joined.
MAX_SOURCES = 100_000
DIGIT, HIGHEST = 16, 48
#: Bytes of text counted at once, rows of counts that a task holds, and pairs that it looks at at once and holds.
SLICE, HELD, PAIRS = 8_000_000, 300_000, 1_000_000


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of a task; one row without a term for each source."""
    held: list[pa.Table] = []
    rows = 0

    def merged() -> pa.Table:
        whole = pa.concat_tables(held).combine_chunks().group_by(["lang", "source", "term"], use_threads=False)
        return whole.aggregate([("n", "sum"), ("docs", "sum")]).rename_columns(["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for part in _slices(batch):
            held.append(_terms(part))
            rows += held[-1].num_rows
            if rows > HELD:
                held = [merged()]
                rows = held[0].num_rows
                if rows > HELD // 2:
                    yield from held.pop().to_batches()
                    rows = 0
    if held:
        yield from merged().to_batches()


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows in a row with SLICE bytes of text, one at least."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + SLICE, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _terms(batch: pa.RecordBatch) -> pa.Table:
    lang, source = batch.column("lang").dictionary_encode(), batch.column("source").dictionary_encode()
    wide = len(source.dictionary)
    group = lang.indices.to_numpy().astype(np.int64) * wide + source.indices.to_numpy()
    words = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), GAP)
    own = pc.list_parent_indices(words).to_numpy()
    words = words.flatten().dictionary_encode()
    names = words.dictionary
    kinds = max(1, len(names))
    # by document first: how often it has a term
    pair, n = np.unique(own.astype(np.int64) * kinds + words.indices.to_numpy(), return_counts=True)
    key, at = np.unique(group[pair // kinds] * kinds + pair % kinds, return_inverse=True)
    total, docs = np.bincount(at, n, len(key)).astype(np.int64), np.bincount(at, minlength=len(key))
    term = names.take(pa.array(key % kinds)) if len(key) else pa.array([], pa.string())
    full = pc.not_equal(term, "").to_numpy(zero_copy_only=False).astype(bool)
    there = np.unique(group)
    every = np.r_[key[full] // kinds, there]
    term = pa.concat_arrays([term.filter(pa.array(full)).cast(pa.string()), pa.nulls(len(there), pa.string())])
    zeros = np.zeros(len(there), np.int64)
    columns = [lang.dictionary.take(pa.array(every // wide)), source.dictionary.take(pa.array(every % wide)), term, pa.array(np.r_[total[full], zeros]), pa.array(np.r_[docs[full], zeros])]
    return pa.table(columns, ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of documents (text, lang, source), and a row without a term for every source."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    counted = texts.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, words: Column, kept: Column) -> Column:
    """1 + floor(billion (n + 1) / (words + kept)), exact."""
    whole = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", whole(n + 1) * F.lit(SCALE).cast("decimal(10,0)"), whole(words + kept)) + 1


def cost(p: str, q: str) -> Column:
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


class Shares:
    """What pairs and top terms are made from, all of it stored.

    groups   group, lang, source, kept (terms of the language), base (p0)
    entries  group, lang, term, p, q (the language's share): the terms that a source has
    """

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS):
        counts = stash(term_counts(docs), "term-counts")
        # a term of a language has a row for each source that has it, no more
        of_term = Window.partitionBy("lang", "term")
        kept = counts.filter("term IS NOT NULL").withColumns({"of_lang": F.sum("n").over(of_term), "in_docs": F.sum("docs").over(of_term), "least": F.min("source").over(of_term)})
        kept = stash(kept.filter(F.col("in_docs") >= min_docs), "kept-terms")
        langs = kept.groupBy("lang").agg(F.count_if(F.col("source") == F.col("least")).alias("kept"), F.sum("n").alias("lang_words"))
        words = kept.groupBy("lang", "source").agg(F.sum("n").alias("words"))
        groups = counts.filter("term IS NULL").select("lang", "source").join(words, ["lang", "source"], "left").join(langs, "lang", "left")
        groups = groups.na.fill(0, ["words", "kept", "lang_words"]).withColumn("group", F.monotonically_increasing_id())
        base = F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("words"), F.col("kept")))
        self.groups = stash(groups.withColumn("base", base), "sources")
        self.few = broadcast_if(self.groups, MAX_SOURCES)
        entries = kept.select("lang", "source", "term", "n", "of_lang").join(self.few, ["lang", "source"])
        p, q = share(F.col("n"), F.col("words"), F.col("kept")), share(F.col("of_lang"), F.col("lang_words"), F.col("kept"))
        self.entries = stash(entries.select("group", "lang", "term", p.alias("p"), q.alias("q"), "base"), "shares")


def _both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, value): what terms that both sources have add to each pair, over the terms of a task.

    A row is a term with its sources; sums wrap around 64 bits on the way, which the whole does not leave.
    """
    keys, values = np.empty((0, 2), np.int64), np.empty(0, np.int64)

    def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        keys, values = keys[order], values[order]
        first = np.r_[True, (keys[1:] != keys[:-1]).any(1)] if len(keys) else np.empty(0, bool)
        at = np.flatnonzero(first)
        return keys[at], np.add.reduceat(values, at) if len(at) else values

    for batch in batches:
        who = batch.column("who")
        flat, size = who.flatten(), pc.list_value_length(who).to_numpy(zero_copy_only=False).astype(np.int64)
        group, p, base = (flat.field(k).to_numpy() for k in ("group", "p", "base"))
        partners = np.repeat(size, size)
        first = np.repeat(np.cumsum(size) - size, size)
        ends = np.cumsum(partners)
        start = 0
        while start < len(group):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PAIRS, "right")))
            n = partners[start:stop]
            a = np.repeat(np.arange(start, stop), n)
            b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n - first[start:stop], n)
            a, b = a[apart := a != b], b[apart]
            of = lambda x, y: (x - y) * (x - y) // y
            value = of(p[a], p[b]) - of(p[a], base[b]) - of(base[a], p[b]) + of(base[a], base[b])
            keys, values = summed(np.concatenate([keys, np.column_stack([group[a], group[b]])]), np.concatenate([values, value]))
            if len(values) > PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()), pa.array(values)], ["a", "b", "value"])
                keys, values = keys[:0], values[:0]
            start = stop
    yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()), pa.array(values)], ["a", "b", "value"])


def divergence(shares: Shares) -> DataFrame:
    """(a, b, value) of every two sources of a language: the cost of a's shares against b's."""
    exact = lambda c: F.sum(c.cast("decimal(38,0)"))
    met = shares.entries.groupBy("lang", "term").agg(F.collect_list(F.struct("group", "p", "base")).alias("who")).filter(F.size("who") > 1).select("who")
    both = met.mapInArrow(_both, "a long, b long, value long").groupBy("a", "b").agg(exact(F.col("value")).alias("both"))
    histogram = shares.entries.groupBy("group", "lang", "base", "p").agg(F.count("*").alias("n"))
    bases = shares.groups.filter("base IS NOT NULL").select("lang", F.col("base").alias("other")).distinct()
    met = stash(histogram, "histogram").join(broadcast_if(stash(bases, "bases"), MAX_SOURCES), "lang")
    alone = met.groupBy("group", "other").agg(
        exact(F.col("n") * (cost("p", "other") - cost("base", "other"))).alias("left"), exact(F.col("n") * (cost("other", "p") - cost("other", "base"))).alias("right")
    )
    alone = broadcast_if(stash(alone, "corrections"), MAX_SOURCES)
    a, b = (shares.few.select("lang", "kept", F.col("group").alias(k), F.col("base").alias(f"base_{k}")) for k in "ab")
    pairs = a.join(b.drop("kept"), "lang").filter("a != b").join(both, ["a", "b"], "left")
    pairs = pairs.join(alone.select(F.col("group").alias("a"), F.col("other").alias("base_b"), "left"), ["a", "base_b"], "left")
    pairs = pairs.join(alone.select(F.col("group").alias("b"), F.col("other").alias("base_a"), "right"), ["b", "base_a"], "left")
    none = F.lit(0).cast("decimal(38,0)")
    start = F.coalesce(F.col("kept").cast("decimal(20,0)") * cost("base_a", "base_b"), none)
    return pairs.select("a", "b", (start + F.coalesce("left", none) + F.coalesce("right", none) + F.coalesce("both", none)).cast("long").alias("value"))


def top_by_radix(rows: DataFrame, k: int = TOP) -> DataFrame:
    """The k rows of each group of stored (group, term, value) with the highest values, ties to the least term in UTF-8; all if there are fewer.

    Terms of a group differ and values are not negative.
    """
    many = rows.groupBy("group").agg(F.count("*").alias("n")).filter(F.col("n") > k)
    state = many.select("group", F.lit(0).cast("long").alias("low"), F.lit(2**63 - 1).alias("high"), F.lit(k).cast("long").alias("need"), F.col("n").alias("there"))
    state = stash(state, "thresholds")
    for shift in range(HIGHEST, -1, -DIGIT):
        open_ = state.filter("need < there")
        if open_.isEmpty():
            break
        inside = rows.join(broadcast_if(open_, MAX_SOURCES), "group").filter("value BETWEEN low AND high")
        digit = F.shiftright("value", shift).bitwiseAND(2**DIGIT - 1)
        state = stash(_narrowed(inside, digit, F.col("digit").desc(), ["low", "need"]).select(
            "group", (F.col("low") + F.shiftleft("digit", shift)).alias("low"), (F.col("low") + F.shiftleft("digit", shift) + (2**shift - 1)).alias("high"), "need", "there"
        ).unionByName(state.filter("need = there")), "thresholds")
    bytes_ = F.encode("term", "UTF-8")
    ties = stash(state.select("group", "low", "need", "there", F.lit(b"").alias("bound"), F.lit(0).alias("width")), "ties")
    while not (open_ := ties.filter("need < there")).isEmpty():
        inside = rows.withColumn("bytes", bytes_).join(broadcast_if(open_, MAX_SOURCES), "group")
        inside = inside.filter((F.col("value") == F.col("low")) & (F.substring("bytes", F.lit(1), F.col("width")) == F.col("bound")))
        inside = stash(inside.drop("term", "value", "width"), "tied")
        ends = inside.groupBy("group").agg(F.min("bytes").alias("x"), F.max("bytes").alias("y"))
        # what the least and the greatest begin with, all begin with
        shared = F.expr("filter(sequence(1, length(x) + 1), i -> substring(x, 1, i) != substring(y, 1, i) OR i > length(x))[0] - 1")
        inside = inside.join(broadcast_if(stash(ends.select("group", shared.alias("shared")), "shared"), MAX_SOURCES), "group")
        digit = F.substring("bytes", F.lit(1), F.col("shared") + 2)
        # a term that ends within the width differs from all longer ones there
        cut = _narrowed(inside.withColumn("width", F.col("shared") + 2), digit, F.col("digit").asc(), ["low", "need", "width"])
        ties = stash(cut.select("group", "low", "need", "there", F.col("digit").alias("bound"), "width").unionByName(ties.filter("need = there")), "ties")
    held = rows.join(broadcast_if(ties.drop("need", "there"), MAX_SOURCES), "group", "left")
    within = (F.col("value") == F.col("low")) & (F.substring(bytes_, F.lit(1), F.col("width")) <= F.col("bound"))
    return held.filter(F.col("low").isNull() | (F.col("value") > F.col("low")) | within).select("group", "term", "value")


def _narrowed(inside: DataFrame, digit: Column, order: Column, carried: list[str]) -> DataFrame:
    """The digit of each group that its need-th row has, how many rows of that digit are needed and how many there are."""
    histogram = inside.groupBy("group", *carried, digit.alias("digit")).agg(F.count("*").alias("there"))
    before = F.sum("there").over(Window.partitionBy("group").orderBy(order)) - F.col("there")
    found = histogram.withColumn("before", before).filter((F.col("before") < F.col("need")) & (F.col("need") <= F.col("before") + F.col("there")))
    return found.withColumn("need", F.col("need") - F.col("before"))


def audit(docs: DataFrame, top: int = TOP, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank): all other sources by divergence, and the terms that a source uses more, the first of them."""
    shares = Shares(docs, min_docs)
    pairs = divergence(shares).join(shares.few.select(F.col("group").alias("b"), F.col("source").alias("item")), "b")
    pairs = pairs.select(F.col("a").alias("group"), F.lit("pair").alias("part"), "item", "value")
    more = stash(shares.entries.filter("p > q").select("group", "term", cost("p", "q").alias("value")), "terms")
    terms = top_by_radix(more, top).select("group", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("group", "part").orderBy(F.desc("value"), "item"))
    ranked = pairs.unionByName(terms).withColumn("rank", rank)
    return ranked.join(shares.few.select("group", "lang", "source"), "group").select("lang", "source", "part", "item", "value", "rank")


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by language and source."""
    return audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


_SHARE = f"1 + ({SCALE}::HUGEINT * ({{n}} + 1)) // ({{words}} + 1 * {{kept}})"
_COST = "(({p} - {q})::HUGEINT * ({p} - {q})) // {q}"
SQL = f"""
  WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
    l AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= {MIN_DOCS}),
    s AS MATERIALIZED (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN l ON w.lang = l.lang AND w.term = l.term GROUP BY w.lang, w.source, w.term),
    t AS (SELECT lang, count(*) AS kept, sum(n)::BIGINT AS words FROM l GROUP BY lang),
    g AS (SELECT d.lang, d.source, coalesce(x.words, 0) AS words FROM (SELECT DISTINCT lang, source FROM d) d
      LEFT JOIN (SELECT lang, source, sum(n)::BIGINT AS words FROM s GROUP BY lang, source) x ON d.lang = x.lang AND d.source = x.source),
    p AS MATERIALIZED (SELECT g.lang, g.source, l.term, coalesce(s.n, 0) AS n, ({_SHARE.format(n="coalesce(s.n, 0)", words="g.words", kept="t.kept")})::BIGINT AS p,
        ({_SHARE.format(n="l.n", words="t.words", kept="t.kept")})::BIGINT AS q
      FROM g JOIN l ON g.lang = l.lang JOIN t ON g.lang = t.lang LEFT JOIN s ON s.lang = g.lang AND s.source = g.source AND s.term = l.term),
    v AS (SELECT a.lang, a.source, b.source AS item, sum({_COST.format(p="a.p", q="b.p")})::BIGINT AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY a.lang, a.source, b.source),
    r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source != b.source LEFT JOIN v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
      UNION ALL SELECT lang, source, 'term', term, ({_COST.format(p="p", q="q")})::BIGINT FROM p WHERE n > 0 AND p > q)
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM r) WHERE part = 'pair' OR rank <= {TOP}"""
