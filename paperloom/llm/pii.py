"""Operator 4: personal data spans, all in DataFrame functions.

Regular expressions propose spans, checksums confirm them (Luhn for cards,
mod-97 for account numbers, ranges for addresses and digit counts for phones)
and context words beside a span adjust its score. Spans of the four base kinds
stay once valid; the other kinds need min_score. All work is done inside the
row, in time linear in the text, so there is no shuffle and nothing to skew.

Offsets come from cutting the text at its matches: the lengths of the pieces
before a match and of the matches before it sum to its start.

The patterns forbid backtracking (possessive) and, after a failure, restarts in
the middle of a run; \\G lets a match start where the last one ended. Both give
the matches of the plain leftmost pattern, but in linear time.

Defined results: null and empty texts have no spans; equal rows equal spans.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import computed_once, table, unused

_LOCAL, _HOST = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A text without a match of this cheap pattern is not searched.
    needs: str
    base: bool
    #: Score in hundredths of a valid span, and what a context word adds.
    score: int
    context: str
    bonus: int = 35


#: In the order in which spans with one start are listed.
KINDS = (
    Kind("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++", "@", True, 60, r"(?i)(e-?mail|mail|contact|write|reach)"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", True, 50, r"(?i)\b(ip|host|server|address|login)\b"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){13}", True, 60, r"(?i)(card|visa|master|amex|credit|pay)"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", True, 50, r"(?i)(phone|tel|call|mobile|fax)"),
    Kind("iban", r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b", r"[A-Z]{2}[0-9]{2}", False, 60, r"(?i)(iban|bank|account|konto)"),
    Kind("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", r"[0-9]-[0-9]", False, 30, r"(?i)(ssn|social security)"),
    Kind("secret", r"""(?i)\b(?:token|secret|api[_-]?key|password|passwd)["']?[\x20\t]{0,3}[=:][\x20\t]{0,3}["'][A-Za-z0-9+/_=-]{16,}["']""", "[=:]", False, 70, r"(?i)(auth|bearer|credential)"),
)
MIN_SCORE = 50
#: Characters on each side in which context words count, up to the next match of the kind.
NEAR = 40
_BLOCK = 512


def running_sum(numbers: Column) -> Column:
    """Inclusive running sums of an int array, in blocks so that long arrays stay cheap."""

    def sums(array: Column, start: Column) -> Column:
        zero = F.struct(start.alias("t"), F.array().cast("array<int>").alias("a"))
        return F.aggregate(
            array,
            zero,
            lambda acc, x: F.struct((acc["t"] + x).alias("t"), F.concat(acc["a"], F.array(acc["t"] + x)).alias("a")),
            lambda acc: acc["a"],
        )

    blocks = F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / _BLOCK).cast("int"))
    totals = F.transform(blocks, lambda b: F.aggregate(F.slice(numbers, b * _BLOCK + 1, _BLOCK), F.lit(0), lambda a, x: a + x))
    ends = sums(totals, F.lit(0))
    whole = F.flatten(
        F.transform(
            F.arrays_zip(blocks.alias("b"), totals.alias("t"), ends.alias("e")),
            lambda z: sums(F.slice(numbers, z["b"] * _BLOCK + 1, _BLOCK), z["e"] - z["t"]),
        )
    )
    return F.when(F.size(numbers) > 0, whole).otherwise(F.array().cast("array<int>"))


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """True if the digits, from the right every second one doubled, sum to a multiple of ten."""

    def one(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), one), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """True if an account number leaves 1 by the mod-97 rule."""
    compact = F.regexp_replace(account, " ", "")
    turned = F.split(F.concat(F.substring(compact, 5, 99), F.substring(compact, 1, 4)), "")

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(turned, F.lit(0), step) == 1


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$")
    if kind == "card":
        d = digits_of(match)
        return F.length(d).between(14, 19) & luhn(d)
    if kind == "phone":
        return F.length(digits_of(match)).between(10, 15)
    if kind == "iban":
        return mod97(match)
    return F.lit(True)


def cut_at(text: Column, kind: Kind) -> dict[str, Column]:
    """The matches of a kind in a text and the pieces between them; none where needs has no match."""
    none = F.array().cast("array<string>")
    there = text.rlike(kind.needs)
    return {
        "m": F.when(there, F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))).otherwise(none),
        "q": F.when(there, F.split(text, kind.pattern, -1)).otherwise(none),
    }


def spans_of(place: int, kind: Kind, matches: Column, pieces: Column, ends: Column) -> Column:
    """Array of (start, kind, stop, score): the valid spans of one kind."""

    def one(m: Column, i: Column) -> Column:
        near = F.concat(F.right(F.get(pieces, i), F.lit(NEAR)), F.lit("\n"), F.left(F.get(pieces, i + 1), F.lit(NEAR)))
        return F.when(
            valid(kind.name, m),
            F.struct(
                (F.get(ends, i) - F.length(m)).alias("start"),
                F.lit(place).alias("kind"),
                F.get(ends, i).alias("stop"),
                (F.lit(kind.score) + F.when(near.rlike(kind.context), kind.bonus).otherwise(0)).alias("score"),
            ),
        )

    least = 0 if kind.base else MIN_SCORE
    return F.filter(F.transform(matches, one), lambda s: s.isNotNull() & (s["score"] >= least))


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with pii: array of (start, kind, stop, score), in order of start and then kind.

    kind is the place in KINDS; offsets count code points, stop is exclusive.
    Each step is a column of its own, so that no lambda computes one again.
    """
    t, every = F.coalesce(F.col(text), F.lit("")), range(len(KINDS))
    docs = docs.drop("pii")
    at = unused(docs, "pii_part_")
    own = [f"{at}{x}{i}" for i in every for x in "mqnes"]
    docs = docs.withColumns({f"{at}{x}{i}": c for i in every for x, c in cut_at(t, KINDS[i]).items()})
    long = {i: F.transform(f"{at}m{i}", _length_with(f"{at}q{i}")) for i in every}
    docs = docs.withColumns({f"{at}n{i}": long[i] for i in every})
    docs = docs.withColumns({f"{at}e{i}": running_sum(F.col(f"{at}n{i}")) for i in every})
    spans = {f"{at}s{i}": spans_of(i, KINDS[i], *[F.col(f"{at}{x}{i}") for x in "mqe"]) for i in every}
    docs = docs.withColumns(spans)
    return computed_once(docs.withColumn("pii", F.sort_array(F.concat(*spans))).drop(*own), ["pii"])


def _length_with(pieces: str):
    return lambda m, i: F.length(m) + F.length(F.get(F.col(pieces), i))


def spelled(spans: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with each span of text replaced by its kind in angle brackets; where spans overlap, the first one counts."""
    found = find_pii(docs, text)
    t, names = F.coalesce(F.col(text), F.lit("")), F.array(*[F.lit(f"<{k.name}>") for k in KINDS])
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(
        "pii",
        zero,
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                s["stop"].alias("at"),
                F.concat(acc["out"], F.substring(t, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["kind"])).alias("out"),
            ),
        ).otherwise(acc),
        lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.length(t))),
    )
    return found.withColumn(text, done).drop("pii")


def number_of(kind: int) -> Column:
    return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = {f"n_{k.name}": number_of(i) for i, k in enumerate(KINDS)}
    base = F.filter("pii", lambda s: s["kind"] < sum(k.base for k in KINDS))
    return found.select(
        "doc_id",
        *[c.alias(n) for n, c in counts.items()],
        F.sha2(spelled(base), 256).alias("base_sha256"),
        spelled(F.col("pii")).alias("spans"),
        (F.size("pii") > 0).alias("has_pii"),
        F.array_join(F.transform("pii", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def _sql() -> str:
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
    }
    quoted = lambda s: s.replace("'", "''")
    cut = "\nUNION ALL\n".join(
        f"SELECT doc_id, {i} AS kind, '{k.name}' AS name, {k.base} AS base, {k.score} AS score, {k.bonus} AS bonus, '{quoted(k.context)}' AS context, "
        f"string_split_regex(text, '{quoted(p)}') AS pieces, regexp_extract_all(text, '{quoted(p)}') AS matches FROM d"
        for i, k in enumerate(KINDS)
        for p in [plain.get(k.name, k.pattern)]
    )
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
cut AS ({cut}),
one AS (
  SELECT doc_id, kind, name, base, score, bonus, context, i, matches[i] AS m, pieces[i] AS before, pieces[i + 1] AS after
  FROM (SELECT *, unnest(range(1, len(matches) + 1)) AS i FROM cut WHERE len(matches) > 0)
),
placed AS (
  SELECT *, sum(length(before) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i)::BIGINT AS stop,
    regexp_replace(m, '[^0-9]+', '', 'g') AS digits, replace(m, ' ', '') AS compact
  FROM one
),
checked AS (
  SELECT *, stop - length(m) AS start,
    CASE name
      WHEN 'ip' THEN list_bool_and(list_transform(string_split(m, '.'), lambda x: x::HUGEINT <= 255))
      WHEN 'card' THEN length(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda j:
        CASE WHEN j % 2 = 1 THEN (reverse(digits)[j])::INT
             ELSE (reverse(digits)[j])::INT * 2 - CASE WHEN (reverse(digits)[j])::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0
      WHEN 'phone' THEN length(digits) BETWEEN 10 AND 15
      WHEN 'iban' THEN list_reduce(list_prepend(0::BIGINT, list_transform(range(1, length(compact) + 1), lambda j:
        CASE WHEN ascii((compact[5:] || compact[:4])[j]) >= 65 THEN 100000 + ascii((compact[5:] || compact[:4])[j]) - 55
             ELSE ascii((compact[5:] || compact[:4])[j]) - 48 END::BIGINT)),
        lambda a, x: CASE WHEN x >= 100000 THEN (a * 100 + x - 100000) % 97 ELSE (a * 10 + x) % 97 END) = 1
      ELSE true END AS ok,
    score + CASE WHEN regexp_matches(right(before, {NEAR}) || chr(10) || left(after, {NEAR}), context) THEN bonus ELSE 0 END AS total
  FROM placed
),
good AS (SELECT * FROM checked WHERE ok AND (base OR total >= {MIN_SCORE})),
per AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE kind = {i}) AS n_{k.name}" for i, k in enumerate(KINDS))},
    string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (WHERE base) AS base,
    string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) AS spans,
    string_agg(total::VARCHAR, ',' ORDER BY start, kind) AS scores
  FROM good GROUP BY doc_id
)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k.name}, 0)::BIGINT AS n_{k.name}" for k in KINDS)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, spans IS NOT NULL AS has_pii, coalesce(scores, '') AS scores
FROM d LEFT JOIN per USING (doc_id)
"""


SQL = _sql()
