"""Text functions against Python's own."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.functions import prompts, splitter
from paperloom.functions import text as T

ODD = ["", " \t\n", "a\x1c\x1db", "\x85x\xa0 y ", "　z ", "tab\tone", "two  blanks\t\tx", "𝔘nicode 😀 ", "plain"]


def test_white_space_is_pythons(spark):
    df = spark.createDataFrame([(x,) for x in ODD], "t string")
    for r in df.select("t", T.strip(F.col("t")).alias("s"), T.collapse(F.col("t")).alias("c"), T.non_space_length(F.col("t")).alias("n"), T.has_enough_text(F.col("t"), 1).alias("e")).collect():
        assert (r.s, r.c, r.n) == (r.t.strip(), " ".join(r.t.split()), len("".join(r.t.split()))) and r.e == bool(r.t.strip())


def test_single_tab_stays(spark):
    assert spark.range(1).select(T.squeeze_blanks(F.lit("a\tb  c\t\td\n\n"))).first()[0] == "a\tb c d\n\n"


def test_figures_block(spark):
    rows = [("t \n", None), ("t", " none "), ("t", "NONE."), ("t\n", " fig ")]
    got = [r[0] for r in spark.createDataFrame(rows, "t string, f string").select(T.with_figures(F.col("t"), F.col("f"))).collect()]
    assert got == ["t \n", "t", "t\n\n[FIGURES]\nNONE.\n", "t\n\n[FIGURES]\nfig\n"]


def test_source_line(spark):
    texts = ["SOURCE PDF: /a/b/c.pdf\nx", "no", "\n" * 60 + "SOURCE PDF: late.pdf", "source pdf:\nnext line", "SOURCE PDF: dir/name/\n"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in texts], "t string").select(T.source_of_artefact(F.col("t"))).collect()]
    assert got == ["c.pdf", None, None, "next line", "name"]


def test_providers_and_masks(spark):
    ids = [("openai.gpt",), ("gemini.x",), ("google.gemini-2",), ("",), (None,), (".x",), ("plain",)]
    got = [tuple(r) for r in spark.createDataFrame(ids, "m string").select(T.model_provider(F.col("m")), T.token_limit_name(F.col("m")), T.mask_secret(F.col("m"))).collect()]
    assert [g[0] for g in got] == ["openai", "gemini", "google", "unknown", "unknown", "unknown", "unknown"]
    assert [g[1] for g in got] == ["max_completion_tokens", "max_output_tokens", "max_tokens", "max_tokens", "max_tokens", "max_tokens", "max_tokens"]
    assert got[0][2] == "op" + "*" * 8 and got[4][2] == "" and got[5][2] == "**"


def test_data_url(spark):
    url = spark.range(1).select(T.data_url(F.lit(b"x" * 200), F.lit("jpg"))).first()[0]
    assert url.startswith("data:image/jpeg;base64,") and "\n" not in url
    with pytest.raises(Exception, match="unsupported"):
        spark.range(1).select(T.data_url(F.lit(b"x"), F.lit("gif"))).collect()


def test_json_scalar(spark):
    rows = [('{"source":"a"}',), ('{"source":{"x":1}}',), ('{"source":[1]}',), ('{"source":5}',), ("{}",), ("no",), (None,)]
    assert [r[0] for r in spark.createDataFrame(rows, "j string").select(T.json_text(F.col("j"), "$.source")).collect()] == ["a", None, None, "5", None, None, None]


def recursive_split(text, size, overlap, separators=splitter.SEPARATORS):
    """The same chunks by recursion, one text at a time, not stripped."""
    at = next((i for i, s in enumerate(separators) if not s or s in text), len(separators) - 1)
    separator, finer = separators[at], separators[at + 1 :]
    head, *rest = text.split(separator) if separator else (None, *text)
    pieces = [p for p in (head, *(separator + r for r in rest)) if p]
    out, small = [], []

    def pack():
        window = []
        for piece in small:
            if window and sum(map(len, window)) + len(piece) > size:
                out.append("".join(window))
                while window and (sum(map(len, window)) > overlap or sum(map(len, window)) + len(piece) > size):
                    window.pop(0)
            window.append(piece)
        out.append("".join(window))
        small.clear()

    for piece in pieces:
        if len(piece) < size:
            small.append(piece)
        else:
            pack()
            out.extend(recursive_split(piece, size, overlap, finer) if finer else [piece])
    pack()
    return out


PIECES = st.lists(st.sampled_from(["a", "bb", "é", " ", "  ", "\n", "\n\n", "\n\n\n", "x" * 9, "日", "😀", "\t"]), max_size=60).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=5), st.integers(1, 30), st.integers(0, 30))
def test_batch_split_equals_recursion(texts, size, overlap):
    overlap = min(overlap, size)
    want = [[c.strip() for c in recursive_split(t, size, overlap) if c.strip()] for t in texts]
    assert splitter.split_texts(texts, size, overlap) == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n", max_size=200), st.integers(1, 30))
def test_split_keeps_all_text(text, size):
    (pieces,) = splitter.split_texts([text], size)
    assert "".join("".join(pieces).split()) == "".join(text.split())
    assert all(len(p) <= size for p in pieces)


def test_split_overlap():
    assert splitter.split_texts(["aa bb cc dd"], 6, 3) == [["aa bb", "bb cc", "cc dd"]]
    assert splitter.split_texts(["x" * 5, ""], 5) == [["x" * 5], []] and splitter.split_texts([], 5) == []
    with pytest.raises(ValueError):
        splitter.split_texts(["x"], 5, 6)


def test_split_sql_on_odd_texts():
    """The SQL that holds against chunk_pages, with small chunks and overlaps."""
    import random

    import duckdb

    from paperloom.plans import registry

    rng = random.Random(8)
    texts = ["".join(rng.choices(["a", "bb", "é", " ", "  ", "\n", "\n\n", "\n\n\n", "x" * 9, "日", "😀"], k=rng.randint(0, 50))) for _ in range(300)]
    duck = duckdb.connect()
    duck.execute("CREATE TABLE t (source VARCHAR, pos INT, page_label VARCHAR, text VARCHAR)")
    duck.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", [("s", i, str(i), t) for i, t in enumerate(texts)])
    for size, overlap in ((7, 3), (20, 20), (5, 0)):
        got = duck.execute(f"WITH RECURSIVE {registry._split_sql('SELECT * FROM t', size, overlap)} SELECT pos, chunk FROM chunks WHERE chunk != '' ORDER BY pos, start").fetchall()
        assert got == [(i, c) for i, cs in enumerate(splitter.split_texts(texts, size, overlap)) for c in cs]


def test_prompts():
    assert "NONE" in prompts.figures_prompt() and prompts.text_prompt("  ") == prompts.text_prompt() and "more" in prompts.text_prompt(" more ")


def test_model_parameters():
    from paperloom.model import model_parameters

    assert model_parameters("openai.x") == {"temperature": 0.0, "max_completion_tokens": 8000} and model_parameters(" Gemini.x", 0.5, 9) == {"temperature": 0.5, "max_output_tokens": 9}
    assert model_parameters("google.gemini-2.5-pro") == model_parameters("plain") == {"temperature": 0.0, "max_tokens": 8000}
