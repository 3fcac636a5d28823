"""Collections in a catalog, and the registered queries against DuckDB."""

import os
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from paperloom import session
from paperloom.operators import collection
from paperloom.plans import registry
from paperloom.streaming import ingest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def chunks(spark):
    return lambda *names: spark.createDataFrame([(f"text of {n}", {"source": n} if n else {"page_label": "1"}) for n in names], "text string, metadata map<string,string>")


def test_life_of_a_collection(spark, chunks):
    name, model = "my_docs", collection.hash_embedder(8)
    spark.sql("DROP TABLE IF EXISTS `MY_DOCS`")
    assert collection.load(spark, name, chunks().limit(0), model) == 0
    assert not spark.catalog.tableExists("`MY_DOCS`")
    assert collection.load(spark, name, chunks("a", "b", "b", None), model, dimension=8) == 4
    collection.load(spark, name, chunks("a"), model, dimension=8)
    table = lambda: spark.table("`MY_DOCS`")
    assert [tuple(r) for r in collection.inspect(table()).collect()] == [("a", 2), ("b", 2)]
    assert [r.document for r in collection.list_documents(table()).collect()] == ["a", "b", None]
    assert tuple(collection.inspect_totals(table()).first()) == (2, 4)
    assert "MY_DOCS" in [r.name for r in collection.list_collections(spark).collect()]
    assert {tuple(r) for r in collection.analyze(table()).collect()} == {("records", "", 5), ("dimension", "8", 5), ("format", "FLOAT32", 5)}
    collection.set_table_comment(spark, name, "it's here")
    assert collection.table_comment(spark, name) == "it's here" and collection.table_comment(spark, "absent") == "" and collection.describe_table(spark, "absent") == "(no table comment)"
    assert collection.load(spark, name, chunks("a"), model, dimension=8, replace=True) == 1 and collection.table_comment(spark, name) == "it's here"
    assert collection.table_comment(spark, "x`y") == "" and table().schema["embedding"].metadata.get("dimension") == 8
    assert [t.name for t in spark.catalog.listTables() if t.name.upper().startswith("MY_DOCS")] in (["MY_DOCS"], ["my_docs"])
    assert collection.delete_documents(spark, name, ["b", "absent"]) == 2
    assert [r.document for r in collection.list_documents(table()).collect()] == ["a", None]
    near = collection.most_similar(table(), collection.hash_embedder(8)()(["text of a"])[0], 1).first()
    assert near.text == "text of a" and near.similarity == pytest.approx(1)
    collection.drop_collection(spark, name)
    with pytest.raises(Exception):
        collection.drop_collection(spark, name)


def files(spark, name):
    """(file, time) of a table's data files, by bucket."""
    spark.catalog.refreshTable(name)
    out = {}
    for f in spark.table(name).inputFiles():
        path = f.removeprefix("file://")
        out.setdefault(int(path.split("bucket=")[1].split("/")[0]), set()).add((path, os.stat(path).st_mtime_ns))
    return out


def test_deletes_and_replaces_touch_their_buckets(spark, chunks):
    name, model = f"B{uuid.uuid4().hex[:10].upper()}", collection.hash_embedder(4)
    names = [f"doc{i}.pdf" for i in range(40)]
    collection.load(spark, name, chunks(*names, *names, None), model)
    bucket = {r.d: r.b for r in spark.createDataFrame([(n,) for n in [*names, ""]], "d string").select("d", collection.bucket_of(F.col("d")).alias("b")).collect()}
    before = files(spark, name)
    assert collection.delete_documents(spark, name, ["doc3.pdf", "doc4.pdf", "absent"]) == 4
    after = files(spark, name)
    touched = {bucket["doc3.pdf"], bucket["doc4.pdf"], spark.range(1).select(collection.bucket_of(F.lit("absent"))).first()[0]}
    assert {b: f for b, f in before.items() if b not in touched} == {b: f for b, f in after.items() if b not in touched} and len(touched) < len(before)
    left = {r.document: r.n_chunks for r in collection.inspect(spark.table(name)).collect()}
    assert left == {n: 2 for n in names if n not in ("doc3.pdf", "doc4.pdf")} and spark.table(name).count() == 77
    assert collection.load(spark, name, chunks("doc5.pdf", "new.pdf"), model, replace=True) == 2
    left = {r.document: r.n_chunks for r in collection.inspect(spark.table(name)).collect()}
    assert left["doc5.pdf"] == left["new.pdf"] == 1 and left["doc6.pdf"] == 2 and spark.table(name).count() == 77
    assert collection.delete_documents(spark, name, names + ["new.pdf"]) == 76 and spark.table(name).count() == 1
    assert collection.delete_documents(spark, name, []) == 0
    collection.drop_collection(spark, name)


def test_tables_without_buckets(spark, chunks):
    name, model = f"U{uuid.uuid4().hex[:10].upper()}", collection.hash_embedder(4)
    collection.embed(chunks("a", "b", "b", None), model).write.saveAsTable(name)
    assert collection.load(spark, name, chunks("a"), model) == 1 and collection.load(spark, name, chunks("b"), model, replace=True) == 1
    assert collection.delete_documents(spark, name, ["a"]) == 2
    assert [r.document for r in collection.list_documents(spark.table(name)).collect()] == ["b", None] and spark.table(name).count() == 2
    # what a run that broke off leaves is no collection
    spark.table(name).write.saveAsTable(f"`{collection._new_name(name)}`")
    assert [r.name for r in collection.list_collections(spark).collect() if name in r.name] == [name]
    for t in spark.catalog.listTables():
        if name.lower() in t.name.lower():
            spark.sql(f"DROP TABLE `{t.name}`")


def test_batch_that_broke_off(spark, chunks, monkeypatch):
    name, model = f"L{uuid.uuid4().hex[:10].upper()}", collection.hash_embedder(4)
    collection.load(spark, name, chunks("a"), model, batch="one")
    note = collection._note

    def broken(spark, name, batch, done):
        if done:
            raise RuntimeError("broken")
        note(spark, name, batch, done)

    monkeypatch.setattr(collection, "_note", broken)
    with pytest.raises(RuntimeError):
        collection.load(spark, name, chunks("b"), model, batch="two")
    monkeypatch.setattr(collection, "_note", note)
    assert collection.load(spark, name, chunks("b"), model, batch="two") == 0 and collection.load(spark, name, chunks("b"), model, batch="two") == 0
    assert collection.load(spark, name, chunks("c"), model, batch="three") == 1
    assert [tuple(r) for r in collection.inspect(spark.table(name)).collect()] == [("a", 1), ("b", 1), ("c", 1)]
    collection.drop_collection(spark, name)


@pytest.mark.parametrize("name", ["", "1a", "a;b", "a b", None])
def test_names(name):
    with pytest.raises(ValueError):
        collection.safe_name(name)


def test_streamed_load(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.txt").write_text("SOURCE PDF: q.pdf\nBEGIN TEXT\nhello\n--- PAGE 1 ---\nEND TEXT\n")
    name = f"S{uuid.uuid4().hex[:10].upper()}"
    ingest.ingest(ingest.stream_artefacts(spark, f"{tmp_path}/in"), name, collection.hash_embedder(4), f"{tmp_path}/check").awaitTermination(120)
    assert [tuple(r) for r in collection.inspect(spark.table(name)).collect()] == [("q.pdf", 1)]
    # a batch that is there already adds nothing; a new file does
    batch = spark.table(name).first().batch
    again = spark.createDataFrame([("text", {"source": "q.pdf"})], "text string, metadata map<string,string>")
    assert collection.load(spark, name, again, collection.hash_embedder(4), batch=batch) == 0
    (tmp_path / "in" / "y.txt").write_text("SOURCE PDF: z.pdf\nBEGIN TEXT\nhello\n--- PAGE 1 ---\nEND TEXT\n")
    ingest.ingest(ingest.stream_artefacts(spark, f"{tmp_path}/in"), name, collection.hash_embedder(4), f"{tmp_path}/check").awaitTermination(120)
    # the stream has a session of its own; this one has listed the table's files before
    spark.catalog.refreshTable(name)
    assert [tuple(r) for r in collection.inspect(spark.table(name)).collect()] == [("q.pdf", 1), ("z.pdf", 1)]
    collection.drop_collection(spark, name)


def test_session(spark):
    assert session.check_connection(spark) == (True, "connection ok")
    assert session.connection_report(spark).count() > 0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "documents embeddings pages customer events conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", registry.QUERIES)
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SMALL)
    rows = sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))
    if name in registry.SQL:
        other = duck.sql(registry.SQL[name])
        names = sorted(other.columns)
        assert names == sorted(df.columns)
        assert rows == sorted(map(repr, other.select(*[f'"{n}"' for n in names]).fetchall()))
    assert rows


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
