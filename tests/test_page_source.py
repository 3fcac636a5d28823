"""The page source and the file sink."""

import pytest
from pyspark.sql import functions as F

from paperloom.operators import chunk, classify
from paperloom.sources import file_sink, page_source
from paperloom.sources.page_source import Wanted

READER = "fake_pages:LineReader"


@pytest.fixture
def notes(tmp_path):
    """What a reader notes in Python workers, by way of a file that its module looks for."""
    folder = tmp_path / "notes"
    folder.mkdir()
    return folder


@pytest.fixture
def reader(spark, tmp_path, notes):
    """A module of a name of its own, so that workers know where to note."""
    name = f"noted_{tmp_path.name}"
    (tmp_path / f"{name}.py").write_text(f"import os, sys\nsys.path.insert(0, {str(__import__('pathlib').Path(__file__).parent)!r})\nos.environ['FAKE_PAGES_NOTES'] = {str(notes)!r}\nfrom fake_pages import LineReader\n")
    spark.sparkContext.addPyFile(str(tmp_path / f"{name}.py"))
    import sys

    sys.path.insert(0, str(tmp_path))
    yield f"{name}:LineReader"
    sys.path.remove(str(tmp_path))


@pytest.fixture(autouse=True)
def pushdown(spark):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    yield
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def noted(folder):
    lines = [x for f in folder.iterdir() for x in f.read_text().split("\n") if x]
    for f in folder.iterdir():
        f.unlink()
    return lines


def test_large_files_are_shared_out(spark, tmp_path, notes, reader):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "big.pdf").write_text("\n".join(f"line {i} " + "x" * 90 for i in range(100)))
    for i in range(5):
        (folder / f"small{i}.pdf").write_text("only page!")
    (folder / "other.txt").write_text("no")
    df = page_source.scan(spark, f"file://{folder}", reader, task_bytes=1000)
    assert df.rdd.getNumPartitions() >= 10
    rows = df.collect()
    assert sorted((r.page_no, r.text.split()[1]) for r in rows if r.doc.endswith("big.pdf")) == [(i + 1, str(i)) for i in range(100)]
    assert sum(r.has_image for r in rows) == 5 and len(rows) == 105
    noted(notes)
    # conditions reach the source: pages that are not wanted are not read, tasks without any are not planned
    few = df.filter("page_no <= 3")
    assert few.rdd.getNumPartitions() <= 4
    assert few.count() == 3 + 5
    read = noted(notes)
    assert sorted(x for x in read if x.startswith("page")) == ["page 1"] * 6 + ["page 2", "page 3"]
    one = df.filter((F.col("doc") == f"{folder}/big.pdf") & F.col("page_no").isin(50, 51, 700))
    assert sorted(r.page_no for r in one.collect()) == [50, 51]
    read = noted(notes)
    assert sorted(x for x in read if x.startswith("page")) == ["page 50", "page 51"] and len(read) <= 5
    assert df.filter("page_no > 98 AND text LIKE '%99%'").count() == 1
    assert {x for x in noted(notes) if x.startswith("page")} == {"page 99", "page 100"}


def test_shares_against_all_pages():
    """Whether a share can hold a wanted page, against every page."""
    for k in (1, 2, 7):
        for low, high, pages in ((1, 9e9, None), (5, 9, None), (8, 8, None), (3, 2, None), (1, 9e9, frozenset({4, 11})), (5, 9e9, frozenset({4}))):
            wanted = Wanted(low, high, pages)
            for j in range(k):
                assert wanted.any_of(j, k) == any(wanted.has(p) for p in range(j + 1, 200, k))


def test_two_rules_for_errors(spark, tmp_path, reader):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, text in (("a.pdf", "one\nbad page\nthree!"), ("b.pdf", "unreadable"), ("c.pdf", ""), ("d.pdf", "none\n" + "x\n" * 40)):
        (folder / name).write_text(text)
    with pytest.raises(Exception, match="OSError|KeyError"):
        page_source.scan(spark, f"file://{folder}", reader).collect()
    got = page_source.scan(spark, f"file://{folder}", reader, on_error="note", sample=10)
    rows = sorted((r.doc[-5], r.page_no or 0, r.text, r.error) for r in got.collect())
    assert rows[:5] == [("a", 1, "one", None), ("a", 2, "", None), ("a", 3, "three!", None), ("b", 0, None, "KeyError"), ("c", 0, None, None)]
    assert [r[1] for r in rows[5:]] == [1 + 4 * i for i in range(10)]
    signals = got.withColumn("page_idx", F.col("page_no") - 1)
    labels = {r.doc[-5]: r.reason for r in classify.classify(signals).collect()}
    assert labels["b"] == "read_error=KeyError" and labels["c"] == "zero_pages" and labels["a"].startswith("text_chars=9,")
    with pytest.raises(Exception, match="on_error"):
        page_source.scan(spark, f"file://{folder}", reader, on_error="pass").collect()
    with pytest.raises(Exception):
        page_source.scan(spark, f"file://{folder}/absent", reader).collect()
    images = page_source.scan(spark, f"file://{folder}", reader, what="images", pattern="a.pdf", dpi=72).collect()
    assert sorted((r.page_no, r.width, r.height, bytes(r.image)) for r in images) == [(1, 0, 72, b"one"), (2, 1, 72, b"bad page"), (3, 2, 72, b"three!")]


def test_files_of_a_run(spark, tmp_path):
    images = spark.createDataFrame([("a/x.pdf", 1, b"1"), ("b/x.pdf", 1, b"2"), ("b/x.pdf", 12, b"3")], "doc string, page_no int, image binary").repartition(3)
    file_sink.write_image_files(images, f"file://{tmp_path}/img")
    found = {str(f.relative_to(tmp_path / "img")): f.read_bytes() for f in (tmp_path / "img").rglob("*") if f.is_file()}
    own = file_sink.own_name_of
    assert found == {f"{own('a/x.pdf')}/page_0001.png": b"1", f"{own('b/x.pdf')}/page_0001.png": b"2", f"{own('b/x.pdf')}/page_0012.png": b"3"}
    artefacts = spark.createDataFrame([("é/x.pdf", "tëxt\nwith line ends\n"), ("y.pdf", "")], "doc string, value string")
    file_sink.write_artefact_files(artefacts, f"file://{tmp_path}/out")
    file_sink.write_artefact_files(artefacts.filter("doc = 'y.pdf'").withColumn("value", F.lit("new")), f"file://{tmp_path}/out")
    assert (tmp_path / "out" / f"{own('é/x.pdf')}.txt").read_bytes() == "tëxt\nwith line ends\n".encode() and (tmp_path / "out" / f"{own('y.pdf')}.txt").read_text() == "new"
    assert len(list((tmp_path / "out").iterdir())) == 2


def test_a_failing_task_leaves_no_file(spark, tmp_path):
    broken = F.when(F.col("page_no") == 9, F.raise_error(F.lit("broken")).cast("binary")).otherwise(F.lit(b"x"))
    images = spark.range(1, 10).select(F.lit("d.pdf").alias("doc"), F.col("id").cast("int").alias("page_no")).repartition(4).withColumn("image", broken)
    with pytest.raises(Exception, match="broken"):
        file_sink.write_image_files(images, f"file://{tmp_path}/img")
    assert not [f for f in (tmp_path / "img").rglob("*") if f.is_file()] if (tmp_path / "img").exists() else True
    with pytest.raises(Exception, match="leaves the folder"):
        file_sink.write_files(spark.createDataFrame([("a/../../x", b"")], "name string, content binary"), f"file://{tmp_path}/img")


def test_artefacts_as_columns_and_in_python(spark, tmp_path):
    from paperloom.functions import artefacts

    texts = [
        "no footer", "a\n--- PAGE 1 ---\nrest", "a\n---\npage 3\n---\n", "a\r\n--- PAGE 1 ---\r\n", "x\nBEGIN TEXT\na\n--- PAGE 1 ---\nend text\n--- PAGE 2 ---\n", "BEGIN TEXT\na\n--- PAGE 1 ---\n", "a\n--- PAGE ١ ---\n",
        "==\n BEGIN TEXT ==\n p\n--- PAGE 1 ---\n=== END TEXT\n", "a\x85--- PAGE 1 ---",
    ]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "source string, text string")
    got = {}
    for r in chunk.parse_pages(df).orderBy("pos").collect():
        got.setdefault(int(r.source), []).append((r.page_num, r.page_text))
    assert [got.get(i, []) for i in range(len(texts))] == [artefacts.pages(t) for t in texts]
    file_sink.write_artefact_files(df.select(F.col("source").alias("doc"), F.col("text").alias("value")), f"file://{tmp_path}/out")
    read = page_source.scan(spark, f"file://{tmp_path}/out", "paperloom.sources.page_source:ArtefactReader", pattern="*.txt")
    want = sorted((file_sink.own_name_of(str(i)), k + 1, p) for i, t in enumerate(texts) for k, (_, p) in enumerate(artefacts.pages(t)))
    assert sorted((r.doc.rpartition("/")[2][:-4], r.page_no, r.text) for r in read.collect()) == want
