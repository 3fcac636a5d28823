"""Columns named as operators once named their own stay what they are."""

import pytest

from paperloom.llm import line_dedup, pii, quality_rules, sentencepiece

NAMES = ["_row", "_w", "_h", "_judged", "_lines", "_text", "_doc_id", "_s", "_p", "_pii_m0", "words", "lines", "hashes", "sorted", "places", "judged", "computed", "coded_text", "coded_ids", "line_doc_id", "pii_part_m0"]
OPERATORS = {
    "quality_rules": quality_rules.quality_rules,
    "find_pii": pii.find_pii,
    "encode": lambda df: sentencepiece.encode(df, sentencepiece.model_path(), decoded="decoded"),
    "digests": lambda df: sentencepiece.digests(df, sentencepiece.model_path()),
    "dedup_lines": line_dedup.dedup_lines,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns(spark, name):
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in NAMES)
    rows = [(i, t, *[f"{n} {i}" for n in NAMES]) for i, t in enumerate(["Mail a@b.cd or call.\nA line that is here twice.", "A line that is here twice.", None])]
    df = spark.createDataFrame(rows, schema)
    own = OPERATORS[name](df.select("doc_id", "text"))
    got = OPERATORS[name](df)
    assert {r.doc_id: tuple(r[n] for n in NAMES) for r in got.collect()} == {r[0]: r[2:] for r in rows}
    assert sorted(map(str, got.select(*own.columns).collect())) == sorted(map(str, own.collect()))


def test_digests_keep_ids_and_decoded(spark):
    df = spark.createDataFrame([(1, "a", "i", "d")], "doc_id long, text string, ids string, decoded string")
    assert tuple(sentencepiece.digests(df, sentencepiece.model_path()).select("ids", "decoded").first()) == ("i", "d")


def test_greatest_ids_in_the_near_stage(spark):
    import corpus_pipeline

    top, text = 2**63 - 1, " ".join(f"word{i}" for i in range(30))
    rows = [(top, text), (top, "quite another text of some more words than five here"), (top, text), (3, "short one"), (3, "short two"), (None, text)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = sorted((str(r.doc_id), r.text) for r in corpus_pipeline.near_duplicates(spark, df, "").collect())
    assert got == sorted([("3", "short one"), ("3", "short two"), (str(top), rows[1][1]), (str(top), text), ("None", text)])
