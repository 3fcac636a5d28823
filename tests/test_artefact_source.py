"""Artefacts read by ranges against the same artefacts read whole."""

import random

from paperloom.operators import chunk
from paperloom.sources import artefact_source, pages


def written(tmp_path, texts):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, t in enumerate(texts):
        (folder / f"f{i:03d}.txt").write_bytes(t if isinstance(t, bytes) else t.encode())
    return f"file://{folder}"


def rows(df):
    return sorted((r.source, r.pos, r.page_num, r.page_text) for r in df.collect())


def test_ranges_equal_whole_texts(spark, tmp_path):
    rng = random.Random(9)
    bits = ["\n", "\n", "\n", " ", "--- PAGE 3 ---", "---", "PAGE 4", "page", "5", "--- page 6", "word", "é longer words here", "==", "BEGIN TEXT", "END TEXT", "=== begin\ttext ==", "\r\n", "\x85", "- 7 -", "--- PAGE 99999999999999999999 ---"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", "", "\n"]) for _ in range(rng.randint(0, 60))) for _ in range(70)]
    texts += ["SOURCE PDF: q.pdf\nBEGIN TEXT\na\n--- PAGE 1 ---\nEND TEXT\n--- PAGE 2 ---\n", "", b"\xff\n--- PAGE 1 ---\n\xc3", "a\n---\n\n\npage\n\n8\n\n---\n\nb", "no end of line --- PAGE 1 ---", "x\n" * 30 + "SOURCE PDF: late.pdf"]
    path = written(tmp_path, texts)
    want = rows(chunk.parse_pages(pages.read_artefacts(spark, path)))
    assert len(want) > 25
    for split in (17, 10**6):
        assert rows(artefact_source.artefact_pages(spark, path, split_bytes=split)) == want


def test_a_large_artefact_is_many_tasks(spark, tmp_path):
    lines = [f"line {i} of some words" + ("\n\n---\nPAGE\n%d ---" % i if i % 50 == 0 else "") for i in range(4000)]
    path = written(tmp_path, ["SOURCE PDF: big.pdf\n==== BEGIN TEXT ====\n" + "\n".join(lines) + "\n==== END TEXT ====\n"])
    spark.dataSource.register(artefact_source.ArtefactParts)
    raw = spark.read.format("artefact_parts").options(path=path, split_bytes=5000).load()
    assert raw.rdd.getNumPartitions() > 15 and raw.filter("kind = 'foot'").count() == 80
    assert rows(artefact_source.artefact_pages(spark, path, split_bytes=5000)) == rows(chunk.parse_pages(pages.read_artefacts(spark, path)))


def test_small_ranges_share_tasks(spark, tmp_path):
    """By a task for each range, 6 GB in ranges of 256 kB were 23,000 tasks and files of parts."""
    path = written(tmp_path, ["SOURCE PDF: q.pdf\n" + "some words\n--- PAGE 1 ---\n" * 200] * 6 + [""])
    scan = artefact_source.PartScan({"path": path, "split_bytes": "1000", "tasks": "4"})
    tasks, alone = scan.partitions(), artefact_source.PartScan({"path": path, "split_bytes": "1000"}).partitions()
    ranges = [r for t in tasks for r in t.files]
    assert len(tasks) <= 5 and ranges == [r for t in alone for r in t.files] and len(alone) > 30
    assert max(b - a for _, a, b in ranges) <= 1000 and len({path for path, _, _ in ranges}) == 7


def test_places_count_each_byte_once():
    class Text(str):
        taken = 0

        def __getitem__(self, k):
            piece = str.__getitem__(self, k)
            Text.taken += len(piece)
            return piece

    text = Text("aé\udcff€" * 500)
    marks = set(range(0, 2001, 3))
    want = {k: 7 + len(str(text)[:k].encode("utf-8", "surrogateescape")) for k in marks}
    assert artefact_source._places(text, marks, 7) == want and Text.taken <= 2000
