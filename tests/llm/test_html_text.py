import random

from paperloom.llm import html_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy</div>
<article><header><h1>Head &amp; line</h1></header><p>One <b>bo</b>ld<br>two&nbsp;three &lt;x&gt; a < b<p>Next
  para &quot;q&quot; &am</p><div class="comments"><div>nested</div><p>hater</p></div><form>f</form><table><tr><td>c1</td><td>c2</td></tr></table></article>
<aside>side</aside><footer>&copy; x</footer></body></html>"""


def text_of(page):
    return "\n\n".join(t for t, r in html_text.page_blocks(page) if r == html_text.ARTICLE)


def test_article():
    assert text_of(PAGE) == 'Head & line\n\nOne bold two three <x> a < b\n\nNext para "q" &am\n\nc1\n\nc2'


def test_broken_pages():
    assert text_of("<nav><a>m<article><p>x") == "x"
    assert text_of("<article><p>cut <scr") == "cut"
    assert text_of("<article><p>a<!-- open") == "a"
    assert text_of('<article><p title="a>b">in<script>never closed <p>x') == "in"
    assert html_text.page_blocks(None) == html_text.page_blocks("") == []
    assert len(text_of("<article>" + "<p>word</p>" * 20000).split()) == 20000


def test_repeated_tokens_against_naive():
    rng = random.Random(5)
    for run in (3, 4, 8):
        for _ in range(20):
            common = [rng.randrange(50) for _ in range(rng.randint(1, 14))]
            streams = []
            for _ in range(6):
                s = [rng.randrange(6) for _ in range(rng.randint(0, 20))]
                at = rng.randint(0, len(s))
                streams.append(s[:at] + (common if rng.random() < 0.7 else []) + s[at:])
            seen = {}
            for k, s in enumerate(streams):
                for i in range(len(s) - run + 1):
                    seen.setdefault(tuple(s[i : i + run]), set()).add(k)
            for s, got in zip(streams, html_text.repeated_tokens(streams, run, 3)):
                want = [False] * len(s)
                for i in range(len(s) - run + 1):
                    if len(seen[tuple(s[i : i + run])]) >= 3:
                        want[i : i + run] = [True] * run
                assert got.tolist() == want


def test_pages(spark):
    rng = random.Random(2)
    own = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))
    notice = "we use small files on your device to make this site work better for all"
    rows, want = [], {}
    for i in range(1300):
        text = own()
        if i % 2:
            rows.append((i, f"http://big.example/{i}", f"<body><div>{notice}</div><div>{text}</div><footer>foot</footer></body>"))
        else:
            rows.append((i, f"http://big.example/{i}", f"<body><div>{notice}</div><article><p>{text}</p></article></body>"))
        want[i] = text
    rows += [(2000, None, None), (2001, "x", ""), (2002, "http://a.example/", f"<p>{notice}</p>"), (2002, "http://a.example/", f"<p>{notice}</p>")]
    want |= {2000: "", 2001: "", 2002: notice}
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")
    got = html_text.main_text(df).collect()
    assert len(got) == len(rows) and all(r.text == want[r.page_id] for r in got)
    assert html_text.main_text(df.limit(0)).count() == 0


def test_notice_of_a_large_host(spark):
    """Few of a large host's pages repeat a notice, inside blocks that are otherwise their own."""
    rng = random.Random(3)
    own = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    notice = "we use small files on your device to make this site work better for all"
    rows, want = [], {}
    for i in range(1300):
        head, tail = own(10 if i % 3 else 1), own(5)
        with_notice = i % 65 == 0
        rows.append((i, f"http://big.example/{i}", f"<body><p>{head}{' ' + notice if with_notice else ''} {tail}</p></body>"))
        want[i] = f"{head} {tail}"
    rows += [(5000 + i, f"http://big.example/x{i}", f"<p>{notice}</p>") for i in range(3)]
    want |= {5000 + i: "" for i in range(3)}
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_text(df).collect()}
    assert got == want


def test_repeats_inside_articles(spark):
    """Repeats inside marked text go; a copy of an article stays."""
    rng = random.Random(4)
    own = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))
    share = "tell your friends about this page and read more of our stories every single day"
    copy = own()
    rows, want = [], {}
    for i in range(40):
        text, tag = own(), "main" if i % 2 else "article"
        rows.append((i, f"http://a.example/{i}", f"<{tag}><p>{text}</p><p>{share}</p></{tag}><footer>foot</footer>"))
        want[i] = text
    for i in range(40, 44):
        rows.append((i, f"http://a.example/{i}", f"<nav>n{i}</nav><article><p>{copy}</p></article>"))
        want[i] = copy
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.main_text(df).collect()}
    assert got == want


def naive(pages):
    """(page_id, text) of (page_id, host, html) by sets of word runs, from the rule as stated."""
    out, run = [], html_text.RUN
    for host in {h for _, h, _ in pages}:
        own = [(p, html_text.page_blocks(page)) for p, h, page in pages if h == host]
        best = {p: min([r for _, r in b if r != html_text.FURNITURE], default=html_text.OTHER) for p, b in own}
        streams = {}
        for p, blocks in own:
            stream, before = [], None
            for k, (text, role) in enumerate(blocks):
                if best[p] != html_text.OTHER and before not in (None, role == best[p]):
                    stream.append((None, -1))
                before = role == best[p]
                stream += [(w, k) for w in text.split()]
            streams[p] = stream
        places = lambda s: [i for i in range(len(s) - run + 1) if all(w for w, _ in s[i : i + run])]
        distinct = {tuple(w for w, _ in s if w): p for p, s in streams.items() if s}
        runs = {p: {tuple(w for w, _ in streams[p][i : i + run]) for i in places(streams[p])} for p in distinct.values()}
        count = lambda r, some: sum(r in runs[p] for p in some)
        bare = [p for p in runs if best[p] == html_text.OTHER]
        every = set().union(*runs.values()) if runs else set()
        often = {r for r in every if count(r, runs) >= max(html_text.MIN_MARKED, len(runs) / 2)}
        some = often | {r for r in every if count(r, bare) >= 3}
        for p, blocks in own:
            s, hot = streams[p], some if best[p] == html_text.OTHER else often
            covered, inside = set(), set()
            for i in places(s):
                if tuple(w for w, _ in s[i : i + run]) in hot:
                    covered |= set(range(i, i + run))
                    inside |= set(range(i, i + run)) if len({k for _, k in s[i : i + run]}) == 1 else set()
            mine = [i for i, (w, k) in enumerate(s) if w and blocks[k][1] == best[p]]
            if best[p] != html_text.OTHER and 2 * len(covered & set(mine)) >= len(mine):
                inside = covered = set()
            if best[p] == html_text.OTHER:
                stretches, at = [], 0
                while at < len(s):
                    end = at
                    while end < len(s) and end in covered:
                        end += 1
                    stretches.append((end - at, -at))
                    at = max(end, at + 1)
                longest, at = max(stretches, default=(0, 0))
                if longest >= max(html_text.COPY_WORDS, len(mine) / 2):
                    gone = set(range(-at, -at + longest))
                    covered, inside = covered - gone, inside - gone
            left = [[w for i, (w, k) in enumerate(s) if k == n and i not in inside] for n, (_, r) in enumerate(blocks) if r == best[p] and any(k == n and i not in covered for i, (_, k) in enumerate(s))]
            out.append((p, "\n\n".join(" ".join(x) for x in left)))
    return sorted(out)


def test_against_brute_force(spark):
    """One and many groups, partitions, and both ways of bringing runs to pages."""
    rng = random.Random(11)
    own = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    common = [own(rng.randint(6, 20)) for _ in range(5)]
    pages = []
    for i in range(260):
        host = rng.choice(["a.example", "b.example", "c.example", "c.example"])
        blocks = []
        for _ in range(rng.randint(0, 5)):
            text = own(rng.randint(1, 25))
            if rng.random() < (0.85 if host == "b.example" else 0.3):
                at = rng.randint(0, len(text.split()))
                words = text.split()
                text = " ".join(words[:at] + [common[0] if rng.random() < 0.7 else rng.choice(common)] + words[at:])
            blocks.append(text)
        tag = rng.choice(["article", "main", "div"])
        page = f"<nav>{common[1]}</nav><p>{common[2]}</p><{tag}>" + "".join(f"<p>{b}</p>" for b in blocks) + f"</{tag}><footer>foot {host}</footer>"
        pages.append((i, host, page))
    pages += [(300 + i, h, p) for i, (_, h, p) in enumerate(pages[:30])]
    want = naive(pages)
    df = spark.createDataFrame([(i, f"http://{h.upper()}/{i}", p) for i, h, p in pages], "page_id long, url string, html string")
    run = lambda n, **k: sorted((r.page_id, r.text) for r in html_text.main_text(df.repartition(n), **k).collect())
    assert run(3) == want and any(t != "" for _, t in want)
    # however a host is dealt to groups
    assert run(1, group_bytes=9000) == want == run(5, group_bytes=9000, max_runs=0)
    assert run(7, group_bytes=1000) == want == run(2, max_runs=0)


def test_groups_and_half_of_a_host(spark):
    """A paragraph on just over, and one on just under, half of a host's marked pages, in one group and in many."""
    rng = random.Random(5)
    own = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    over, under = own(20), own(20)
    texts = [own(60) for _ in range(200)]
    rows = [(i, f"http://a.example/{i}", f"<article><p>{t}</p>" + f"<p>{over}</p>" * (i < 102) + f"<p>{under}</p>" * (i >= 102) + "</article>") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: t + (f"\n\n{under}" if i >= 102 else "") for i, t in enumerate(texts)}
    for size in (2**20, 8000, 2500):
        assert {r.page_id: r.text for r in html_text.main_text(df, group_bytes=size).collect()} == want


def test_small_hosts_and_copies_without_marks(spark):
    """On few pages nothing of an article goes; pages that are copies keep their body whatever stands around it."""
    rng = random.Random(6)
    own = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    shared = own(30)
    rows = [(i, "http://few.example/", f"<article><p>{own(90)}</p><p>{shared}</p></article>") for i in range(6)]
    want = {i: r[2].removeprefix("<article><p>").removesuffix("</p></article>").replace("</p><p>", "\n\n") for i, r in enumerate(rows)}
    body, foot = [own(50), own(70), own(40)], own(12)
    for i in range(4):
        menu = own(9)
        rows.append((100 + i, "http://copies.example/", f"<div>{menu}</div>" + "".join(f"<p>{b}</p>" for b in body) + f"<i>{own(3)}</i><div>{foot}</div>"))
        want[100 + i] = None
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, text in want.items():
        if text is not None:
            assert got[i] == text
        else:
            assert "\n\n".join(body) in got[i] and foot not in got[i]


def test_articles_without_their_tags(spark):
    """Menus, adverts and footers go and articles stay, also where nothing marks the article."""
    rng = random.Random(12)
    own = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))
    rows, want = [], {}
    for i in range(20):
        text = own()
        rows.append((i, "http://a.example/", f"<div>home news sport weather travel money culture shop</div><div>{text}</div><div>all of these words are on every page of this host</div>"))
        want[i] = text
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_text.main_text(df).collect()} == want
