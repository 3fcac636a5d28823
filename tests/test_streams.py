"""Streams: token pieces by request, and files to a collection."""

import random
import time

import uuid

import pytest

from paperloom.model import ExtractConfig
from paperloom.operators import collection, extract, stats
from paperloom.streaming import ingest, tokens

PIECES = "request_id string, seq int, content string, add_kw string, resp_meta string"


def write(spark, rows, folder):
    spark.createDataFrame(rows, PIECES).coalesce(1).write.mode("append").parquet(folder)


def test_token_stream_in_shuffled_batches(spark, tmp_path):
    rng = random.Random(4)
    rows = [(f"r{k}", i, rng.choice(["", None, f"p{i} ", "é"]), rng.choice(["", None, f"a{i}"]), rng.choice(["", None, f"m{i}"])) for k in range(7) for i in range(rng.randint(1, 12))]
    rows += [("none", 0, None, None, None)]
    want = {r.request_id: (r.text, r.n_chars, r.last_reason, r.last_meta) for r in stats.joined_stream(spark.createDataFrame(rows, PIECES)).collect()}
    rng.shuffle(rows)
    seen: dict = {}

    def keep(batch, number):
        for r in batch.collect():
            seen[r.request_id] = (r.text, r.n_chars, r.last_reason, r.last_meta)
            done.update({r.request_id} if r.done else ())

    done: set = set()
    folder = f"{tmp_path}/in"
    write(spark, rows[:1], folder)
    stream = tokens.joined(spark.readStream.schema(PIECES).option("maxFilesPerTrigger", 1).parquet(folder), idle_ms=12000)
    query = stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/check").start()
    # with timers there is always another batch, so what has come is waited for
    try:
        for i in range(1, len(rows), 20):
            write(spark, rows[i : i + 20], folder)
        end = time.time() + 100
        while (seen != want or done != set(want)) and time.time() < end:
            assert query.exception() is None
            time.sleep(0.5)
        assert seen == want and done == set(want)
    finally:
        query.stop()
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_files_to_a_collection_exactly_once(spark, tmp_path, monkeypatch):
    """Documents through classes, routes, model, artefacts and chunks; a batch that breaks off after it was added, and before."""
    folder, asked = tmp_path / "in", spark.sparkContext.accumulator(0)
    folder.mkdir()

    def reader(content, wanted):
        lines = content.decode().split("\f")
        return [(i, lines[i], lines[i] == "scan") for i in (range(len(lines)) if wanted is None else wanted) if i < len(lines)]

    def model():
        def ask(image, prompt):
            asked.add(1)
            return "seen " + image.decode()

        return ask

    plugs = ingest.Plugs(
        reader, lambda content: content.count(b"\f") + 1, collection.hash_embedder(4), lambda content, dpi, most: [(i, 1, 1, f"{i} {content.decode()[:3]}".encode()) for i in range(content.count(b"\f") + 1)], model
    )
    name, check = f"F{uuid.uuid4().hex[:10].upper()}", f"{tmp_path}/check"

    def run():
        query = ingest.ingest_files(ingest.stream_files(spark, str(folder), files_a_batch=2), name, plugs, check, ExtractConfig())
        query.awaitTermination(150)
        return query

    def chunks():
        spark.catalog.refreshTable(name)
        return {(r.document, r.n_chunks) for r in collection.inspect(spark.table(name)).collect()}

    (folder / "a.pdf").write_text("\f".join(["words of a page " * 20] * 2))
    (folder / "s.pdf").write_text("scan\fscan")
    run()
    assert chunks() == {("a.pdf", 2), ("s.pdf", 2)} and asked.value == 2
    (folder / "b.pdf").write_text("new words of a page " * 20)
    (folder / "t.pdf").write_text("scan")
    note, load = collection._note, collection.load
    monkeypatch.setattr(collection, "_note", lambda spark, name, batch, done: (_ for _ in ()).throw(RuntimeError("broken")) if done else note(spark, name, batch, done))
    with pytest.raises(Exception, match="broken"):
        run()
    monkeypatch.setattr(collection, "_note", note)
    before = asked.value
    run()
    assert chunks() == {("a.pdf", 2), ("s.pdf", 2), ("b.pdf", 1), ("t.pdf", 1)} and asked.value == before
    (folder / "c.pdf").write_text("other words of a page " * 20)
    monkeypatch.setattr(collection, "load", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("broken")))
    with pytest.raises(Exception, match="broken"):
        run()
    monkeypatch.setattr(collection, "load", load)
    run()
    run()
    assert chunks() == {("a.pdf", 2), ("s.pdf", 2), ("b.pdf", 1), ("t.pdf", 1), ("c.pdf", 1)}
    collection.drop_collection(spark, name)
    assert extract.needs_images(ExtractConfig())
