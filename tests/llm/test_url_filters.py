import os
import random
import re

from pyspark.sql import functions as F

from paperloom.llm import url_filters as U


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]


def brute_rule(host, path):
    fits = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.host + r.path), default=None)


def brute_name(url):
    if url is None or "://" not in url:
        return None
    host, path = brute_parts(url)
    rest = url.split("://", 1)[1].split("#")[0]
    query = "?" + rest.split("?", 1)[1] if "?" in rest else ""
    return re.sub(":(80|443)?$", "", host) + (path or "/") + query


def brute(pages, links):
    """(id, host, path, rule, verdict) by walking the links from every page."""
    near = {}
    for a, b in links:
        a, b = brute_name(a), brute_name(b)
        if a and b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    out = []
    for number, url, _ in pages:
        host, path = brute_parts(url)
        rule = brute_rule(host, path)
        seen, todo = set(), [brute_name(url)]
        while todo:
            x = todo.pop()
            if x and x not in seen:
                seen.add(x)
                todo += near.get(x, ())
        parts = [x.split("?")[0].partition("/") for x in seen]
        blocked = any(r and r.verdict == "block" for r in (brute_rule(h, "/" + p) for h, _, p in parts))
        out.append((str(number), host, path, rule and rule.host + rule.path, rule.verdict if rule else "block" if blocked else "allow"))
    return sorted(out, key=str)


def tables():
    rng = random.Random(3)
    urls = [f"http{rng.choice(['', 's'])}://{h}.example.{t}{rng.choice(['', '/', f'/{p}/{i}', f'/{p}/{i}?x={i % 3}#top'])}" for i in range(150) for h, t, p in [(rng.choice(["www", "m", "a.b", "X"]), rng.choice(["com", "net", "org", "org"]), rng.choice(["en", "es", "fr", "de"]))]]
    urls += [None, "", "no scheme", "://", "http://COM/", "http://com", "HTTP://www.Example.com:80/en/", "http://example.com/en", "http://a.net/es/?q", "http://xcom/", "http://com?x/en/", "http://é.NET/fr/É://z", urls[0]]
    pages, links = [], []
    for i, url in enumerate(urls):
        html, other = f"<p>page {i}</p>", rng.choice(urls[:150])
        if url and "://" in url and i % 3 == 0:
            form = rng.choice(['<LINK href="{}" rel="canonical">', "<link rel='canonical' href='{}' />", '<meta http-equiv="refresh" content="0; url={}">', "<meta content='3;URL={}' http-equiv=Refresh>"])
            html += form.format(other)
            links.append((url, other))
        if i % 7 == 0:
            html += f'<!-- <link rel="canonical" href="{rng.choice(urls[:150])}"> --><link rel="stylesheet" href="http://a.net/es/1"><script>var x = \'<link rel="canonical" href="http://a.net/fr/">\'</script>'
        pages.append((i, url, html))
    pages += [(None, "http://a.org/x", None), (7, "http://q.org/dir/page", '<link rel="canonical" href="/es/1&amp;2">'), (8, "http://q.org/r", '<meta http-equiv="refresh" content="5">'), (9, "http://hub.org/", "x" * 400_000 + '<link rel=canonical href=http://k.net/fr/z>')]
    links += [("http://q.org/dir/page", "http://q.org/es/1&2"), ("http://hub.org/", "http://k.net/fr/z")]
    for i in range(60):
        pages.append((1000 + i, f"http://s{i}.org/", '<link rel="canonical" href="http://hub.org/">'))
        links.append((f"http://s{i}.org/", "http://hub.org/"))
    return pages, links


def rows(df):
    return sorted(((str(r.page_id), r.host, r.path, r.rule, r.verdict) for r in df.collect()), key=str)


def test_against_brute_force_and_sql(spark, tmp_path):
    import duckdb

    pages, links = tables()
    spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got = rows(U.op13_url_filters(spark, str(tmp_path)))
    assert got == brute(pages, links)
    assert sum(g[3] is None and g[4] == "block" for g in got) > 60  # propagated
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert sorted(((str(a), b, c, d, e) for a, b, c, d, e in duck.execute(f"SELECT page_id, host, path, rule, verdict FROM ({U.SQL})").fetchall()), key=str) == got


def test_relative_links_and_redirects(spark):
    base = "http://h.org/a/b/c?q#f"
    cases = {
        "https://x.org/y": "https://x.org/y", "//x.org/y": "http://x.org/y", "/y?z": "http://h.org/y?z", "y": "http://h.org/a/b/y", "../y": "http://h.org/a/y", "./y/../z?k=..#f": "http://h.org/a/b/z?k=..#f",
        "?z": "http://h.org/a/b/c?z", "#top": None, "mailto:x": None, "../../../../y": "http://h.org/y",
    }
    df = spark.createDataFrame([(k, base) for k in cases], "target string, base string")
    assert {r.target: r.url for r in df.select("target", U._resolved(F.col("target"), F.col("base")).alias("url")).collect()} == cases
    pages = spark.createDataFrame([(1, "http://a.org/1", None, "v"), (2, "http://b.com/x", None, "v"), (3, "http://c.org/", "", "v")], "page_id long, url string, html string, verdict string")
    seen = spark.createDataFrame([("http://a.org/1", "http://mid.org/"), ("http://mid.org", "http://z.net/es/9"), ("http://b.com/x", "http://mid.org/"), (None, "http://c.org/"), ("http://c.org/", None)], "source string, target string")
    got = {r.page_id: (r.rule, r.verdict) for r in U.judge(pages, redirects=seen).collect()}
    assert got == {1: (None, "block"), 2: ("com/", "allow"), 3: (None, "allow")}  # an explicit allow stays


def test_clashing_columns_and_empty(spark):
    names = ["page", "ruled", "name", "alias", "host", "path", "rule", "verdict", "a", "b", "id", "comp", "tag", "target"]
    schema = "page_id long, url string, html string, " + ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame([(1, "http://x.org/1", '<link rel="canonical" href="http://y.net/fr/">', *names)], schema)
    out = U.judge(df)
    r = out.first()
    assert (r.host, r.verdict, r.rule, r.alias, r.name, r.page) == ("x.org", "block", None, "alias", "name", "page") and len(out.columns) == len(df.columns)
    assert U.judge(df.limit(0)).count() == 0


def test_no_python_runs(spark):
    plan = U.op13_url_filters(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan) and os.path.exists(U.__file__)
