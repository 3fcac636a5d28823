"""Operator 13: URL rules whose block decisions follow redirects.

A rule names a host and a path; it fits the host and its subdomains where the
path starts with the rule's, and the longest rule that fits decides. Pages that
no rule fits are judged by what they are aliases of: redirect and canonical-link
edges join URLs into components, found by rounds of distributed joins, and a
component with a blocked URL blocks its members. A rule that allows a URL takes
precedence over that, for this URL; it does not free the others.

Edges are read from the pages themselves (a canonical link, a refresh to another
URL) and from a table of redirects seen elsewhere, if there is one. Their ends
need not be pages: a page that redirects to a blocked URL is blocked. The host,
the path and the query name a URL in edges; scheme, default port, upper case in
the host and the fragment don't count.

Everything is DataFrame functions. Only pages whose html speaks of such links
are searched for them, only edges are shuffled, and of pages only the name of
their URL. A page with very many aliases is one key of joins, which AQE splits,
and of sums, which are added up before the shuffle.

Defined results: a null URL, or one without ://, has an empty host and path, no
rule and no aliases, and is allowed. Of rules that fit with the same length the
longer host decides, then allow. Rows that repeat a URL have one verdict each.
A link without a target, or to its own page, is none. Relative links are
resolved against the page. Columns of pages are kept; those that the result
names anew (host, path, rule, verdict) are replaced. An empty table gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import graph
from .common import lower_ascii, stash, table

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @classmethod
    def of(cls, verdict: str, text: str) -> Rule:
        """A rule from its text, such as net/es/."""
        host, slash, path = text.partition("/")
        return cls(host, slash + path, verdict)


#: The rules of the query.
RULES = (
    Rule.of(ALLOW, "com/"),
    Rule.of(BLOCK, "example.com/en/"),
    Rule.of(ALLOW, "www.example.com/en/"),
    Rule.of(BLOCK, "net/es/"),
    Rule.of(BLOCK, "net/fr/"),
)

_HREF = r"""(?is)[\s"'/]href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_CONTENT = r"""(?is)[\s"'/]content\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_CANONICAL = r"""(?is)[\s"'/]rel\s*=\s*("\s*canonical\s*"|'\s*canonical\s*'|canonical[\s/>])"""
_REFRESH = r"""(?is)[\s"'/]http-equiv\s*=\s*["']?\s*refresh["'\s/>]"""


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z in lower case; empty without ://."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def name_of(url: Column) -> Column:
    """What names a URL in edges: host without a default port, path (at least /) and query; null without ://."""
    host = F.regexp_replace(host_of(url), ":(80|443)?$", "")
    path = F.when(path_of(url) == "", "/").otherwise(path_of(url))
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    return F.when(url.contains("://"), F.concat(host, path, query))


def ruling(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """(rule, verdict) of the rule that decides; null if none fits. The plan carries the rules, hundreds at most."""

    def fits(r: Rule) -> Column:
        return ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)

    best = sorted(rules, key=lambda r: (-len(r.host + r.path), -len(r.host), r.verdict != ALLOW, r))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in reversed(best):
        found = F.when(fits(r), F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _resolved(target: Column, base: Column) -> Column:
    """A link's target as a URL, seen from the URL base."""
    origin, root = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1), F.regexp_extract(base, r"(?s)^(.*?):?//", 1)
    path, bare = path_of(base), F.regexp_extract(base, r"(?s)^([^?#]*)", 1)
    beside = F.concat(F.regexp_extract(path, r"(?s)^(.*/)", 1), target)
    tail = F.regexp_extract(beside, r"(?s)([?#].*)$", 1)
    start = F.array().cast("array<string>")
    steps = F.aggregate(
        F.split(F.ltrim(F.regexp_extract(beside, r"(?s)^([^?#]*)", 1), F.lit("/")), "/"),
        start,
        lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(s == ".", done).otherwise(F.concat(done, F.array(s))),
    )
    return (
        F.when(target.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(root, F.lit(":"), target))
        .when(target.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(target.startswith("/"), F.concat(origin, target))
        .when(target.startswith("?"), F.concat(bare, target))
        .when((target == "") | target.startswith("#"), F.lit(None).cast("string"))
        .otherwise(F.concat(origin, F.lit("/"), F.array_join(steps, "/"), tail))
    )


def _unquoted(value: Column) -> Column:
    return F.trim(F.replace(F.regexp_replace(value, r"""^["']|["']$""", ""), F.lit("&amp;"), F.lit("&")))


def links_of(pages: DataFrame) -> DataFrame:
    """(a, b): the names of a page's URL and of what it is a copy of or sends its readers to."""
    low = F.lower("html")
    speaks = pages.filter(F.col("url").contains("://") & (low.contains("canonical") | low.contains("http-equiv"))).select("url", "html")
    shown = F.regexp_replace("html", r"(?is)<!--.*?(-->|$)|<(script|style)\b.*?(</\2\s*>|$)", " ")
    tags = speaks.select("url", F.explode(F.regexp_extract_all(shown, F.lit(r"(?is)<(?:link|meta)[\s/](?:\"[^\"]*\"|'[^']*'|[^\"'>])*>"), F.lit(0))).alias("tag"))
    link, refresh = F.col("tag").rlike(r"(?i)^<link"), F.regexp_extract("tag", _CONTENT, 1)
    sent = F.regexp_extract(_unquoted(refresh), r"(?is)^[\s\d.]*[;,]?\s*url\s*=\s*(.*)$", 1)
    target = F.when(link & F.col("tag").rlike(_CANONICAL), _unquoted(F.regexp_extract("tag", _HREF, 1))).when(~link & F.col("tag").rlike(_REFRESH), _unquoted(sent))
    named = tags.select("url", target.alias("target")).filter("target IS NOT NULL AND target != ''")
    return named.select(name_of(F.col("url")).alias("a"), name_of(_resolved(F.col("target"), F.col("url"))).alias("b")).filter("a != b")


def blocked_aliases(links: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(name) of the URLs in links (a, b) whose component has a URL that a rule blocks."""
    nodes = graph.components(links, native=True)
    decided = ruling(F.regexp_extract("id", "(?s)^([^/]*)", 1), F.regexp_extract("id", r"(?s)^[^/]*([^?]*)", 1), rules)["verdict"]
    nodes = stash(nodes.select("id", "comp", F.coalesce(decided == BLOCK, F.lit(False)).alias("blocked")), "aliases")
    return nodes.join(nodes.filter("blocked").select("comp").distinct(), "comp", "left_semi").select(F.col("id").alias("name"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """pages (url, html, ...) with host, path, rule and verdict; redirects are further pairs of URLs (source, target)."""
    links = links_of(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select(name_of(F.col("source")).alias("a"), name_of(F.col("target")).alias("b")).filter("a != b"))
    links = stash(links.distinct(), "links")
    rest = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    ruled = ruling(host_of(F.col("url")), path_of(F.col("url")), rules)
    held = pages.select(F.struct(*rest).alias("page"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), ruled.alias("ruled"), name_of(F.col("url")).alias("name"))
    if not links.isEmpty():
        aliases = blocked_aliases(links, rules).select(F.col("name").alias("alias"))
        held = held.join(stash(aliases, "blocked"), F.col("ruled").isNull() & (F.col("name") == F.col("alias")), "left")
    else:
        held = held.withColumn("alias", F.lit(None).cast("string"))
    verdict = F.coalesce(F.col("ruled.verdict"), F.when(F.col("alias").isNotNull(), BLOCK).otherwise(ALLOW))
    return held.select("page.*", "host", "path", F.col("ruled.rule").alias("rule"), verdict.alias("verdict"))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, judged by the rules and by the links between them."""
    return judge(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    """The same rules; components as all URLs reached, absolute and root-relative targets only."""
    host = "coalesce(translate(regexp_extract({0}, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"
    path = "coalesce(regexp_extract({0}, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '')"

    def name(url: str) -> str:
        p = path.format(url)
        return f"CASE WHEN contains({url}, '://') THEN regexp_replace({host.format(url)}, ':(80|443)?$', '') || CASE WHEN {p} = '' THEN '/' ELSE {p} END || regexp_extract({url}, '^.*?://[^?#]*(\\?[^#]*)', 1, 's') END"

    order = sorted(RULES, key=lambda r: -len(r.host + r.path))

    def case(h: str, p: str, value) -> str:
        return "CASE " + " ".join(f"WHEN ({h} = '{r.host}' OR ends_with({h}, '.{r.host}')) AND starts_with({p}, '{r.path}') THEN '{value(r)}'" for r in order) + " END"

    tag = r"""<(?:link|meta)[\s/](?:"[^"]*"|''[^'']*''|[^"''>])*>"""
    value = r"""("[^"]*"|''[^'']*''|[^\s"''>]+)"""
    clean = r"""trim(replace(regexp_replace({}, '^["'']|["'']$', '', 'g'), '&amp;', '&'))"""
    href, content = (clean.format(rf"""regexp_extract(tag, '[\s"''/]{a}\s*=\s*{value}', 1, 'is')""") for a in ("href", "content"))
    rel = _CANONICAL[5:].replace("'", "''")
    refresh = _REFRESH[5:].replace("'", "''")
    return f"""
      WITH RECURSIVE t AS (
        SELECT url, unnest(regexp_extract_all(regexp_replace(html, '<!--.*?(-->|$)|<script\\b.*?(</script\\s*>|$)|<style\\b.*?(</style\\s*>|$)', ' ', 'gis'), '{tag}', 0, 'is')) AS tag
        FROM pages WHERE contains(url, '://') AND (contains(lower(html), 'canonical') OR contains(lower(html), 'http-equiv'))),
      l AS (
        SELECT url, CASE WHEN regexp_matches(tag, '^<link', 'i') AND regexp_matches(tag, '{rel}', 'is') THEN {href}
          WHEN NOT regexp_matches(tag, '^<link', 'i') AND regexp_matches(tag, '{refresh}', 'is') THEN trim(regexp_extract({content}, '^[\\s\\d.]*[;,]?\\s*url\\s*=\\s*(.*)$', 1, 'is')) END AS goal FROM t),
      u AS (SELECT url, CASE WHEN starts_with(goal, '/') THEN regexp_extract(url, '^(.*?://[^/?#]*)', 1, 's') || goal ELSE goal END AS goal FROM l WHERE goal IS NOT NULL AND goal != ''),
      n AS (SELECT {name('url')} AS a, {name('goal')} AS b FROM u),
      e AS (SELECT a, b FROM n WHERE a != b UNION SELECT b, a FROM n WHERE a != b),
      r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
      x AS (SELECT DISTINCT a FROM r WHERE {case("regexp_extract(b, '^([^/]*)', 1)", "regexp_extract(b, '^[^/]*([^?]*)', 1)", lambda r: r.verdict)} = 'block'),
      p AS (SELECT page_id, {host.format('url')} AS host, {path.format('url')} AS path, {name('url')} AS name FROM pages)
      SELECT page_id, host, path, {case('host', 'path', lambda r: r.host + r.path)} AS rule,
        coalesce({case('host', 'path', lambda r: r.verdict)}, CASE WHEN x.a IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
      FROM p LEFT JOIN x ON p.name = x.a"""


SQL = _sql()
