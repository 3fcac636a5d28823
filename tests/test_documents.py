"""Classification, extraction, chunks and artefacts."""

import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperloom.model import ClassifyConfig, ExtractConfig, MIXED, SCANNED_PDF, TEXT_PDF
from paperloom.functions import splitter
from paperloom.operators import answers, chunk, classify, extract, stats
from paperloom.sources import pages, sinks
from paperloom.streaming import ingest


def test_classify(spark):
    rows = [("strong", 0, "x" * 5000, True), ("scan", 0, "", True), ("scan", 1, "", True), ("none", 0, "", False), ("empty", None, None, None)]
    rows += [("page", 0, "x" * 50, True)] + [("page", i, "", i < 5) for i in range(1, 10)] + [("tie", i, "", i == 0) for i in range(8)]
    rows += [("edge", i, "x" * 20, i < 6) for i in range(10)]
    got = {r.doc: (r.label, r.reason) for r in classify.classify(spark.createDataFrame(rows, "doc string, page_idx int, text string, has_image boolean")).collect()}
    assert got["strong"][0] == TEXT_PDF and got["scan"][0] == SCANNED_PDF and got["none"][0] == MIXED and got["empty"] == (MIXED, "zero_pages")
    assert got["page"] == (TEXT_PDF, "text_chars=50, text_pages=1, image_ratio=0.50")
    assert got["tie"] == (MIXED, "text_chars=0, text_pages=0, image_ratio=0.12") and got["edge"][0] == MIXED


def test_sampling(spark):
    rows = [(f"d{n}", i) for n in (1, 9, 10, 19, 20, 47) for i in range(n)]
    got = classify.sample_pages(spark.createDataFrame(rows, "doc string, page_idx int")).groupBy("doc").agg(F.array_sort(F.collect_list("page_idx")).alias("p"))
    for doc, p in got.collect():
        n = int(doc[1:])
        k = min(10, n)
        assert p == list(range(0, n, max(1, n // k)))[:k]


def test_page_readers(spark, tmp_path):
    for name, text in (("a.pdf", "one\fTWO  words\f "), ("b.pdf", "bad"), ("c.txt", "x"), ("e.pdf", "-")):
        (tmp_path / name).write_text(text)

    def reader(content, wanted):
        parts = content.decode().split("\f") if content != b"-" else []
        for i in range(len(parts)) if wanted is None else (w for w in wanted if w < len(parts)):
            yield i, parts[i], i == 0

    def count(content):
        if content == b"bad":
            raise KeyError("x")
        return len(content.decode().split("\f")) if content != b"-" else 0

    files = pages.scan_files(spark, str(tmp_path))
    assert [r.path.rpartition("/")[2] for r in pages.list_files(files).collect()] == ["a.pdf", "b.pdf", "e.pdf"]
    assert "Exchange" not in files._jdf.queryExecution().toString() and sorted(r.path.rpartition("/")[2] for r in files.collect()) == ["a.pdf", "b.pdf", "e.pdf"]
    texts = pages.page_texts(files, reader, max_pages=2).collect()
    assert sorted((r.doc.rpartition("/")[2], r.page_no, r.text) for r in texts) == [("a.pdf", 1, "one"), ("a.pdf", 2, "TWO  words"), ("b.pdf", 1, "bad")]
    found = {r.doc.rpartition("/")[2]: (r.label, r.reason) for r in classify.classify(pages.page_signals(files, count, reader)).collect()}
    assert found["b.pdf"] == (MIXED, "read_error=KeyError") and found["e.pdf"][1] == "zero_pages" and found["a.pdf"][1].startswith("text_chars=12")
    images = pages.page_images(files, lambda c, dpi, most: [(0, 1, 1, c)])
    out = sinks.write_page_images(images, f"file://{tmp_path}/img", whole_path=False).collect()
    assert [r.file.endswith("page_0001.png") for r in out] == [True] * 3 and (tmp_path / "img" / "b.pdf" / "page_0001.png").read_bytes() == b"bad"
    asked = spark.sparkContext.accumulator(0)

    def counted(files):
        def seen(content):
            asked.add(1)
            return count(content)

        return pages.page_signals(files, seen, reader)

    first = classify.classify_files(files, counted)
    cache = spark.createDataFrame(first.filter("doc NOT LIKE '%a.pdf'").collect(), first.schema)
    before = asked.value
    again = {r.doc.rpartition("/")[2]: r.label for r in classify.classify_files(files, counted, cache).collect()}
    assert again == {d: label for d, (label, _) in found.items()} and asked.value == before + 1


def test_images_of_one_base_name(spark, tmp_path):
    images = spark.createDataFrame([("a/x.pdf", 1, b"1"), ("b/x.pdf", 1, b"2")], "doc string, page_no int, image binary")
    out = sinks.write_page_images(images, f"file://{tmp_path}/img").collect()
    assert sorted(open(r.file, "rb").read() for r in out) == [b"1", b"2"] and all(r.file.endswith("/x.pdf/page_0001.png") for r in out)


def _pages(spark):
    rows = [("d.pdf", 1, "x" * 60, 0.5, TEXT_PDF), ("d.pdf", 2, "", 0.5, TEXT_PDF), ("s.pdf", 1, "x" * 60, 0.5, SCANNED_PDF), ("s.pdf", 2, "x", 0.0, SCANNED_PDF)]
    rows += [("m.pdf", 1, "x" * 60, 0.001, MIXED), ("m.pdf", 2, "x" * 60, None, MIXED), ("m.pdf", 3, "x" * 49, 0.5, MIXED)]
    return spark.createDataFrame(rows, "doc string, page_no int, text string, nonwhite_ratio double, label string").withColumn("image", F.encode(F.concat("doc", F.col("page_no").cast("string")), "utf-8"))


def test_routes_and_calls(spark):
    asked = spark.sparkContext.accumulator(0)

    def factory():
        def model(image, prompt):
            asked.add(1)
            return extract.stub_model(image, prompt)

        return model

    cfg = ExtractConfig()
    routed = {(r.doc, r.page_no): r.route for r in extract.routes(_pages(spark), cfg).collect()}
    assert routed == {("d.pdf", 1): "layer", ("d.pdf", 2): "layer", ("s.pdf", 1): "model", ("s.pdf", 2): "blank", ("m.pdf", 1): "blank", ("m.pdf", 2): "layer", ("m.pdf", 3): "model"}
    got = {(r.doc, r.page_no): r.page_text for r in extract.extract_pages(_pages(spark), cfg, factory).collect()}
    assert got[("s.pdf", 1)] == "[vlm] s.pdf1" and got[("m.pdf", 1)] == "[BLANK PAGE SKIPPED]" and got[("d.pdf", 2)] == ""
    assert asked.value == 2
    with pytest.raises(Exception, match="needs a model"):
        extract.extract_pages(_pages(spark), cfg).collect()
    with pytest.raises(ValueError):
        ExtractConfig(mode="other")


def test_artefact_round_trip(spark):
    texts = extract.extract_pages(_pages(spark), ExtractConfig(), lambda: extract.stub_model)
    made = extract.assemble(texts, ExtractConfig()).withColumnsRenamed({"doc": "source", "value": "text"})
    back = {(r.source, r.page_num): r.page_text for r in chunk.parse_pages(made).collect()}
    assert back == {(r.doc, r.page_no): r.page_text.strip() for r in texts.collect()}


@pytest.mark.parametrize(
    "text, found",
    [
        ("no footer", []), ("a\n--- PAGE 1 ---\nrest", [(1, "a")]), ("a\n--- PAGE 2 ---\nb\n--- page 2 ---\n", [(2, "a"), (2, "b")]), ("a\n---\npage 3\n---\n", [(3, "a")]),
        ("--- PAGE 1 ---\n--- PAGE 2 ---", [(1, ""), (2, "")]), ("a\r\n--- PAGE 1 ---\r\n", [(1, "a")]), ("a\x85--- PAGE 1 ---", []), ("x\nBEGIN TEXT\na\n--- PAGE 1 ---\nend text\n--- PAGE 2 ---\n", [(1, "a")]),
        ("BEGIN TEXT\na\n--- PAGE 1 ---\n", [(1, "BEGIN TEXT\na")]), ("a\n--- PAGE ١ ---\n", [(1, "a")]),
        ("a\n--- PAGE 1234567890123456789 ---\nb\n--- PAGE 99999999999999999999 ---\n", [(1234567890123456789, "a")]),
    ],
)
def test_page_footers(spark, text, found):
    got = chunk.parse_pages(spark.createDataFrame([("s", text)], "source string, text string")).orderBy("pos").collect()
    assert [(r.page_num, r.page_text) for r in got] == found


def test_chunks(spark):
    rows = [("s", 0, 1, "aa bb\n\ncc"), ("s", 1, 2, " \n "), ("s", 2, 2, "dd"), ("t", 0, 1, None)]
    got = chunk.chunk_pages(spark.createDataFrame(rows, "source string, pos int, page_num long, page_text string"), size=6, overlap=0).orderBy("source_name", "chunk_index").collect()
    assert [(r.source_name, r.chunk_index, r.page_label, r.text.rpartition("\n\n")[2]) for r in got] == [("s", 0, "1", "aa bb"), ("s", 1, "1", "cc"), ("s", 2, "2", "dd")]
    assert got[0].metadata == {"source": "s", "page_label": "1", "extraction": "ocr"} and got[0].text.startswith("---\nsource_file: s\n---\n\n")
    assert chunk.stored_documents(spark.createDataFrame(got)).columns == ["page_content", "metadata"]


def test_numbers_of_chunks(spark, monkeypatch):
    """Across blocks of pages; texts are never sorted, nor is a source numbered in one task."""
    monkeypatch.setattr(chunk, "BLOCK", 7)
    rows = [(s, i, i, "w " * ((i * 7) % 5) * 20) for s in ("hot", "hot", None) for i in range(30)] + [("few", i, i, "x") for i in (100, 3, 20)]
    rows = list(dict.fromkeys(rows))
    pages = spark.createDataFrame(rows, "source string, pos int, page_num long, page_text string").repartition(4)
    for most in (500_000, 0):
        monkeypatch.setattr(chunk, "MAX_PAGES", most)
        got = {}
        made = chunk.chunk_pages(pages, size=30, overlap=0, header=False)
        for r in made.collect():
            got.setdefault(r.source_name, []).append((r.chunk_index, int(r.page_label)))
        for source, found in got.items():
            places = [page for _, page in sorted(found)]
            assert [i for i, _ in sorted(found)] == list(range(len(found))) and places == sorted(places)
        assert {s: len(f) for s, f in got.items()} == {s: sum(len(splitter.split_texts([r[3]], 30)[0]) for r in rows if r[0] == s) for s in got}
    plan = made._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Window [" in line or "Sort [source" in line]
    assert sorts and not any("pieces" in x or "text" in x for x in sorts)


def test_stats(spark):
    assert tuple(stats.length_stats(spark.createDataFrame([("a",), ("aa",), ("aaaaaa",)], "text string")).first()) == (3, 2, 4)
    with pytest.raises(Exception, match="no texts"):
        stats.length_stats(spark.createDataFrame([], "text string")).collect()


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.txt").write_bytes(b"SOURCE PDF: q.pdf\nBEGIN TEXT\nhello \xff\n--- PAGE 1 ---\nEND TEXT\n")
    read = pages.read_artefacts(spark, f"{tmp_path}/in").first()
    assert read.source == "q.pdf" and "�" in read.text
    assert pages.read_artefacts(spark, f"{tmp_path}/in", "given").first().source == "given"
    stream = ingest.stream_artefacts(spark, f"{tmp_path}/in")
    assert stream.isStreaming and stream.columns == ["source", "text"]
    assert ClassifyConfig().sample_pages == 10


def test_align_limits_and_gaps(spark):
    texts = spark.createDataFrame([("a", i, f"t{i}") for i in (1, 2, 4)], "doc string, page_no int, text string")
    images = spark.createDataFrame([("a", i, i * 10) for i in (2, 3, 4)], "doc string, page_no int, width int")
    rows = lambda *a, **k: sorted((r.page_no, *[r[c] for c in ("text", "width") if c in r]) for r in extract.align(*a, **k).collect())
    assert rows(texts, images) == [(2, "t2", 20), (4, "t4", 40)] and rows(texts, images, max_pages=3) == [(2, "t2", 20)]
    assert rows(texts, None, max_pages=2) == [(1, "t1"), (2, "t2")] and rows(None, images) == [(2, 20), (3, 30), (4, 40)]
    with pytest.raises(ValueError):
        extract.align(None, None)


def test_blank_pages_by_pixels(spark):
    """Shares of dark pixels against a count by hand; the margins don't count where only the middle does."""
    import numpy as np

    rng = np.random.default_rng(3)
    grids = [rng.integers(0, 256, size).astype(np.uint8) for size in ((10, 20), (33, 17), (100, 2))] + [np.full((20, 20), 255, np.uint8)]
    grids[3][:2] = 0
    data = [(bytes([*g.shape]) + g.tobytes(),) for g in grids] + [(None,)]
    decode = lambda b: np.frombuffer(b[2:], np.uint8).reshape(b[0], b[1])
    df = spark.createDataFrame(data, "image binary").coalesce(1)
    for crop in (True, False):
        cfg = ExtractConfig(center_crop=crop)
        got = [r[0] for r in df.select(extract.nonwhite_ratio(F.col("image"), cfg, decode)).collect()]
        for g, value in zip(grids, got):
            h, w = g.shape
            middle = [int(v) for y, row in enumerate(g) for x, v in enumerate(row) if not crop or (int(h * 0.1) <= y < int(h * 0.9) and int(w * 0.1) <= x < int(w * 0.9))]
            assert value == pytest.approx(sum(v < 245 for v in middle) / len(middle))
        assert got[-1] is None and (got[3] == 0) == crop


def test_images_for_the_model(spark):
    """RGB, no side over the limit, JPEG of the set quality; by a stand-in for pictures."""

    class Picture:
        def __init__(self, mode, size):
            self.mode, self.size = mode, size

        def convert(self, mode):
            return Picture(mode, self.size)

        def resize(self, size):
            return Picture(self.mode, size)

        def save(self, out, format, quality):
            out.write(f"{self.mode} {self.size[0]}x{self.size[1]} {format} {quality}".encode())

    def opened(data):
        mode, width, height = data.decode().split()
        return Picture(mode, (int(width), int(height)))

    df = spark.createDataFrame([(b"RGBA 3200 1000",), (b"RGB 300 1600",), (b"L 10 4000",), (None,)], "image binary").coalesce(1)
    got = [r[0] and bytes(r[0]).decode() for r in df.select(extract.prepared_image(F.col("image"), ExtractConfig(), opened)).collect()]
    assert got == ["RGB 1600x500 JPEG 85", "RGB 300x1600 JPEG 85", "RGB 4x1600 JPEG 85", None]


def test_figures_and_stored_answers(spark, tmp_path):
    """With figures to describe; answers that are stored are asked for once."""
    asked = spark.sparkContext.accumulator(0)

    def factory():
        def model(image, prompt):
            asked.add(1)
            return extract.stub_model(image, prompt)

        return model

    cfg = ExtractConfig(describe_figures=True)
    done = extract.extract_pages(_pages(spark), cfg, factory, folder=f"file://{tmp_path}/run")
    got = {(r.doc, r.page_no): r.page_text for r in done.collect()}
    assert done.count() == 7 and asked.value == 2 + 5
    again = extract.extract_pages(_pages(spark), cfg, factory, folder=f"file://{tmp_path}/run")
    assert {(r.doc, r.page_no): r.page_text for r in again.collect()} == got and asked.value == 2 + 5
    assert got[("s.pdf", 1)] == "[vlm] s.pdf1\n\n[FIGURES]\n- figure of 6 bytes\n" and got[("s.pdf", 2)] == "[BLANK PAGE SKIPPED]"


def test_questions_are_asked_once(spark, tmp_path, monkeypatch):
    """Equal images are one question; a run that breaks off leaves its answers; the next asks the rest."""
    asked, fail = spark.sparkContext.accumulator(0), {"at": b"q30"}

    def factory(at=None):
        def model(image, prompt):
            if at is not None and image == at:
                raise OSError("no answer")
            asked.add(1)
            return f" {prompt}:{image.decode()} "

        return model

    rows = [(i, f"q{i % 40}".encode()) for i in range(100)]
    frame = spark.createDataFrame(rows, "n int, image binary").repartition(3)
    ledger = f"file://{tmp_path}/ledger"
    ask = lambda make, prompt="p", of=frame: answers.answered(of, make, prompt, "m", ledger, "answer", run=8)
    with pytest.raises(Exception, match="no answer"):
        ask(lambda: factory(fail["at"]))
    before = asked.value
    kept = answers.read_ledger(spark, ledger).count()
    got = {r.n: r.answer for r in ask(factory).collect()}
    assert got == {i: f"p:q{i % 40}" for i in range(100)} and asked.value == before + 40 - kept and 0 < kept < 40
    assert ask(factory).count() == 100 and asked.value == before + 40 - kept
    assert ask(factory, "other").filter("answer LIKE 'other:%'").count() == 100 and asked.value == before + 80 - kept
    with pytest.raises(Exception, match="needs the image"):
        ask(factory, of=spark.createDataFrame([(1, None)], "n int, image binary"))
    assert ask(factory, of=frame.limit(0)).count() == 0
    # two jobs may have asked the same; an image is prepared for questions only
    spark.read.parquet(ledger).write.mode("append").parquet(ledger)
    assert answers.answered(frame, lambda: None, "p", "m", ledger, "answer", prepare=lambda image: F.raise_error(F.lit("prepared")).cast("binary")).count() == 100


def test_folder_to_artefacts(spark, tmp_path):
    """Files to artefacts in one call: classes, blank pages, prepared images, figures, saved images, page limit."""
    import numpy as np

    from paperloom.operators import convert

    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "t.pdf").write_text("\n".join(["long text " * 12] * 3 + ["short!"]))
    (folder / "s.pdf").write_text("\n".join(["scan!", "blank!", "scan!"]))

    class Picture:
        mode, size = "RGB", (10, 10)

        def __init__(self, data):
            self.data = data

        def save(self, out, format, quality):
            out.write(b"prepared " + self.data)

    imaging = extract.Imaging(Picture, lambda data: np.full((10, 10), 255 if data.startswith(b"blank") else 0))
    reader, out = "fake_pages:LineReader", f"file://{tmp_path}/out"
    spark.sparkContext.addPyFile(str(__import__("pathlib").Path(__file__).parent / "fake_pages.py"))
    cfg = ExtractConfig(describe_figures=True, save_images=True, images_dir=f"file://{tmp_path}/img", max_pages=3)
    made = convert.convert_folder(spark, f"file://{folder}", reader, out, cfg, lambda: extract.stub_model, imaging, folder=f"file://{tmp_path}/run")
    rows = {r.doc.rpartition("/")[2]: r for r in made.collect()}
    assert rows["t.pdf"].label == TEXT_PDF and rows["s.pdf"].label == SCANNED_PDF
    assert "TEXT_MODE: pypdf\nINPUT_PDF_TYPE: TEXT_PDF\nDESCRIBE_FIGURES: True\n" in rows["t.pdf"].value and rows["t.pdf"].value.endswith("TOTAL PAGES: 3\n") and "short" not in rows["t.pdf"].value
    scan = rows["s.pdf"].value
    assert "TEXT_MODE: vlm" in scan and "[vlm] prepared scan!\n\n[FIGURES]\n- figure of 14 bytes\n\n--- PAGE 1 ---" in scan.replace("\n\n\n", "\n\n") and f"{cfg.blank_placeholder}\n\n--- PAGE 2 ---" in scan
    files = sorted(f.name for f in (tmp_path / "out").iterdir())
    assert len(files) == 2 and {(tmp_path / "out" / f).read_text() for f in files} == {r.value for r in rows.values()}
    assert sorted(f.name for f in (tmp_path / "img").rglob("*.png")) == [f"page_000{i}.png" for i in (1, 1, 2, 2, 3, 3)]
    plain = convert.convert_folder(spark, f"file://{folder}", reader, f"{out}2", ExtractConfig(mode="pypdf"))
    assert {r.doc[-5:]: r.label for r in plain.collect()} == {"t.pdf": None, "s.pdf": None} and not extract.needs_images(ExtractConfig(mode="pypdf"))


def test_page_sampling_leaves_texts_in_place(spark):
    df = spark.createDataFrame([("d", i, "x" * 100) for i in range(30)], "doc string, page_idx int, text string")
    plan = classify.sample_pages(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and not [x for x in plan.splitlines() if "hashpartitioning" in x and "text" in x]


def test_images_that_nobody_reads_are_not_joined(spark, tmp_path):
    """Answers were joined with the images of their pages, which then all went through the shuffle."""
    rows = [(i, f"image {i % 30}".encode()) for i in range(90)]
    path = f"file://{tmp_path}/pages"
    spark.createDataFrame(rows, "n INT, image BINARY").write.parquet(path)
    frame, ledger = spark.read.parquet(path), f"file://{tmp_path}/ledger"
    done = answers.answered(frame, lambda: lambda image, prompt: f"{prompt} {bytes(image).decode()}", "p", "m", ledger, "answer", run=7).select("n", "answer")
    plan = done._jdf.queryExecution().optimizedPlan().toString().splitlines()
    left = plan[next(k for k, line in enumerate(plan) if "Join LeftOuter" in line) + 1]
    assert "_asked_key" in left and not re.search(r"[\[,] ?image#\d+[,\]]", left)
    assert {(r.n, r.answer) for r in done.collect()} == {(i, f"p image {i % 30}") for i in range(90)}
    # what is asked later is read, though the folder was read before
    more = spark.createDataFrame([(1, b"image 1"), (2, b"new")], "n INT, image BINARY")
    both = done.join(answers.answered(more, lambda: lambda image, prompt: "later", "p", "m", ledger, "more").select("n", "more"), "n")
    assert sorted(tuple(r) for r in both.collect()) == [(1, "p image 1", "p image 1"), (2, "p image 2", "later")]
    assert spark.read.parquet(ledger).count() == 31


def test_chunks_are_given_out_by_slices(monkeypatch):
    """All chunks of a batch of 10,000 texts were held at once."""
    import pandas as pd

    monkeypatch.setattr(splitter, "SLICE", 1000)
    texts = [f"text {i} of some words " * (i % 40) for i in range(200)]
    made = list(splitter.split_batches(iter([pd.Series(texts[:150]), pd.Series(texts[150:]), pd.Series([], dtype=object)]), 50, 10))
    assert len(made) > 50 and [c for m in made for c in m] == splitter.split_texts(texts, 50, 10)


def test_a_batch_of_texts_stays_in_arrow():
    """Texts of a batch become strings some at a time, not all before the first chunks are given out."""
    taken = []

    class Batch:
        def __init__(self, texts):
            self.texts = texts

        def __len__(self):
            return len(self.texts)

        def slice(self, start, n):
            taken.append(n)
            return pa.array(self.texts[start : start + n])

    texts = [f"{k} " * 20_000 for k in range(1000)]
    made = splitter.split_arrays(iter([Batch(texts)]), 1500, 0)
    first = next(made)
    assert sum(taken) < 200 and first.to_pylist()[0] == splitter.split_texts(texts[:1], 1500)[0]
    few = ["a b\n\nc", "", "x" * 99]
    assert [c for m in splitter.split_arrays(iter([pa.array(few), pa.array([], pa.string())]), 50, 10) for c in m.to_pylist()] == splitter.split_texts(few, 50, 10)
