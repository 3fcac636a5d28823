"""Operator 1: line-first quality rules, all in DataFrame functions.

Each line is judged by punctuation, navigation and boilerplate rules; failing
lines are removed; a document whose removed lines hold too much of its text is
rejected. Base counts (words, symbols, repeated lines and three-word windows)
come from the whole text. Everything is computed inside the row: no shuffle,
so skewed sources cost nothing extra.

Defined results: a null or empty text has no words, fails the base rule and is
not kept; its clean text is the empty string. Repeated rows are judged alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, computed_once, table, unused

SYMBOLS = r"#*$%&|<>"
#: A lone mark between blanks that menus put between their entries.
SEPARATOR = r"(^|[ \t])[|»›>•·/→]([ \t]|$)"
TERMINAL = r"""[.!?;:…。！？]["'”’»)\]]*[ \t\r]*$"""
BOILERPLATE = (
    r"(?i)(cookie|javascript|privacy policy|terms of (use|service)|all rights reserved|"
    r"sign (in|up)|log ?in|subscribe|click here|read more|share this|powered by|lorem ipsum)"
)


@dataclass(frozen=True)
class QualityConfig:
    """Thresholds; the defaults are those of the registered query."""

    min_words: int = 50
    max_repeat_percent: int = 50
    #: A line fails with more symbols per hundred non-blank characters.
    max_symbol_percent: int = 10
    #: A line without closing punctuation fails below this many words.
    min_open_words: int = 3
    #: A line fails with two separators or more if they are this share of its words.
    max_separator_percent: int = 25
    #: Boilerplate phrases count in lines up to this length only.
    max_boilerplate_words: int = 25
    #: A document is rejected if failing lines hold more of its non-blank characters.
    max_lost_percent: int = 40


def word_array(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def non_blank(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))


def count_of(text: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def line_fails(line: Column, cfg: QualityConfig) -> Column:
    """True for a line with a word that breaks a rule; false for a blank line."""
    chars = non_blank(line)
    words = count_of(line, WORD)
    symbols = F.length(F.regexp_replace(line, f"[^{SYMBOLS}]+", ""))
    separators = count_of(line, SEPARATOR)
    punctuation = (symbols * 100 > chars * cfg.max_symbol_percent) | (
        ~line.rlike(TERMINAL) & (words < cfg.min_open_words)
    )
    navigation = (separators >= 2) & (separators * 100 >= words * cfg.max_separator_percent)
    boilerplate = line.rlike(BOILERPLATE) & (words <= cfg.max_boilerplate_words)
    return (chars > 0) & (punctuation | navigation | boilerplate)


def repeated_words(frame: DataFrame, words: str, out: str) -> DataFrame:
    """Adds the number of words that lie in three-word windows found twice or more.

    Windows are compared by 64-bit hash. Sorting (hash, position) puts equal
    windows side by side, so the work is n log n for any text.
    """
    w = F.col(words)
    hashes = F.when(
        F.size(w) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        ),
    )
    h, sorted_, places = (unused(frame, x) for x in ("hashes", "sorted", "places"))
    frame = frame.withColumn(h, hashes)
    paired = F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))),
    )
    frame = frame.withColumn(sorted_, paired)
    s = F.col(sorted_)
    twice = F.filter(
        s,
        lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
    )
    frame = frame.withColumn(places, F.sort_array(F.transform(twice, lambda x: x["p"])))
    p = F.col(places)
    gaps = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)
    return frame.withColumn(out, F.coalesce(covered, F.lit(0).cast("long"))).drop(h, sorted_, places)


def quality_rules(docs: DataFrame, cfg: QualityConfig = QualityConfig(), text: str = "text") -> DataFrame:
    """docs with word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words,
    n_failed_lines, lost_chars, base_failed, kept and clean_text added."""
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_failed_lines", "lost_chars", "base_failed", "kept", "clean_text"]
    docs = docs.drop(*[c for c in added if c != text])
    t = F.coalesce(F.col(text), F.lit(""))
    words, lines, judged = (unused(docs, x) for x in ("words", "lines", "judged"))
    out = docs.withColumns({words: word_array(t), lines: F.split(t, "\n", -1)})
    out = repeated_words(out, words, "n_repeat_words").withColumn("n_words", F.size(words).cast("long")).drop(words)
    filled = F.filter(lines, lambda x: x.rlike(WORD))
    out = out.withColumns(
        {
            "word_chars": non_blank(t).cast("long"),
            "n_symbols": F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("long"),
            "n_dup_lines": (F.size(filled) - F.size(F.array_distinct(filled))).cast("long"),
            judged: F.transform(lines, lambda x: F.struct(x.alias("line"), line_fails(x, cfg).alias("bad"))),
        }
    ).drop(lines)
    bad = F.filter(judged, lambda x: x["bad"])
    out = out.withColumns(
        {
            "n_failed_lines": F.size(bad).cast("long"),
            "lost_chars": F.aggregate(bad, F.lit(0).cast("long"), lambda a, x: a + non_blank(x["line"])),
            "base_failed": (F.col("n_words") < cfg.min_words)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * cfg.max_repeat_percent),
        }
    )
    lost = F.col("lost_chars") * 100 > F.col("word_chars") * cfg.max_lost_percent
    out = computed_once(out.withColumn("kept", ~F.col("base_failed") & ~lost), added[:-1])
    good = F.filter(judged, lambda x: ~x["bad"])
    return out.withColumn("clean_text", F.array_join(F.transform(good, lambda x: x["line"]), "\n")).drop(judged)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_failed_lines", "lost_chars",
    )


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d
),
tri AS (
  SELECT doc_id, p, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM w WHERE len(w) >= 3)
),
hit AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM tri) WHERE n >= 2
),
rep AS (
  SELECT doc_id, count(DISTINCT p + k) AS n_repeat_words FROM hit, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
),
line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d
),
judged AS (
  SELECT doc_id, line, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
    length(regexp_replace(line, '[^#*$%&|<>]+', '', 'g')) AS symbols,
    len(regexp_extract_all(line, '(^|[ \t])[|»›>•·/→]([ \t]|$)')) AS seps,
    regexp_matches(line, '[.!?;:…。！？]["''”’»)\]]*[ \t\r]*$') AS closed,
    regexp_matches(line, '(?i)(cookie|javascript|privacy policy|terms of (use|service)|all rights reserved|sign (in|up)|log ?in|subscribe|click here|read more|share this|powered by|lorem ipsum)') AS boiler
  FROM line
),
verdict AS (
  SELECT doc_id, line, chars, chars > 0 AND (
    symbols * 100 > chars * 10 OR (NOT closed AND words < 3)
    OR (seps >= 2 AND seps * 100 >= words * 25) OR (boiler AND words <= 25)) AS bad
  FROM judged
),
lines AS (
  SELECT doc_id, count(*) FILTER (WHERE chars > 0) - count(DISTINCT line) FILTER (WHERE chars > 0) AS n_dup_lines,
    count(*) FILTER (WHERE bad) AS n_failed_lines, coalesce(sum(chars) FILTER (WHERE bad), 0)::BIGINT AS lost_chars
  FROM verdict GROUP BY doc_id
),
counts AS (
  SELECT w.doc_id, len(w.w)::BIGINT AS n_words,
    length(regexp_replace(w.text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(w.text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    lines.n_dup_lines::BIGINT AS n_dup_lines, coalesce(rep.n_repeat_words, 0)::BIGINT AS n_repeat_words,
    lines.n_failed_lines::BIGINT AS n_failed_lines, lines.lost_chars
  FROM w JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT lost_chars * 100 > word_chars * 40 AS kept,
  n_failed_lines, lost_chars
FROM counts
"""
