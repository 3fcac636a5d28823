import hashlib
import random
import re

import sentencepiece as sentencepiece_library
from pyspark.sql import functions as F

import corpus_pipeline
import test_line_dedup
import test_near_dedup
from paperloom.llm import decontaminate, quality_rules, sentencepiece

KIND = "doc_id long, text string, lang string, _note string"


def prose(seed, n=80):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))) for _ in range(n))


def test_near_duplicates_stage(spark):
    a, b, c, d = (prose(k) for k in range(4))
    data = [
        (1, a, "en", "p"), (1, a, "en", "p"), (2, a + " more", "en", "q"), (3, b, "en", "r"), (3, c, "en", "s"), (4, c, "en", "t"),
        (None, a, "en", "u"), (None, d, "en", "v"), (None, d, "en", "v"), (5, None, None, "w"), (6, "", None, "x"),
    ]
    df = spark.createDataFrame(data, KIND)
    out = corpus_pipeline.near_duplicates(spark, df, "")
    assert out.columns == df.columns
    got = sorted((r.doc_id or 0, r.text or "", r._note) for r in out.collect())
    # of rows 3 and 4 with the text c, either may stay, but one only
    texts = sorted(t for _, t, _ in got)
    assert texts == sorted([a, a, b, c, d, d, "", ""])
    assert [n for i, _, n in got if not i] == [n for _, n in sorted([(a, "u"), (d, "v"), (d, "v")])]
    assert [i for i, t, _ in got if t == a and i] == [1]
    assert corpus_pipeline.near_duplicates(spark, df.limit(0), "").count() == 0


def test_decontamination_stage(spark, tmp_path):
    item, short = prose(20, 20), prose(21, 5)
    items = [(1, item), (1, item), (None, prose(22, 20)), (3, None), (4, short), (5, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(None, prose(23), "en", "p"), (2, prose(24), "en", "q"), (2, prose(24), "en", "q"), (3, None, None, "r"), (4, "", "en", "s"), (5, prose(22, 20), "en", "t")]
    # a hit is all 13 words of a window, or a whole shorter item; 13 of 261 words are under 5 percent
    clean += [(6, " ".join(item.split()[:12]), "en", "u"), (7, prose(25, 248) + " " + " ".join(item.split()[:13]), "en", "v")]
    dirty = [(None, item, "en", "w"), (8, item.upper(), "en", "x"), (9, prose(26, 40) + " " + short, "en", "y"), (10, prose(25, 247) + " " + " ".join(item.split()[:13]), "en", "z")]
    df = spark.createDataFrame(clean + dirty, KIND).withColumnRenamed("_note", "n_words")
    out = corpus_pipeline.clean_of_benchmark(spark, df, str(tmp_path))
    assert out.columns == [c for c in df.columns]
    assert sorted(r.text or "" for r in out.collect()) == sorted(t or "" for _, t, _, _ in clean)
    assert corpus_pipeline.clean_of_benchmark(spark, df.limit(0), str(tmp_path)).count() == 0


def test_line_stage(spark):
    a, b, c = (prose(k) for k in range(30, 33))
    data = [(1, f"{a}\n{b}", "en", "p"), (2, f"{a}\n{c}", "en", "q"), (3, b, "en", "r"), (None, a, "en", "s"), (4, None, None, "t"), (2, f"{a}\n{c}", "en", "q")]
    df = spark.createDataFrame(data, KIND)
    got = sorted((r.doc_id or 0, r.text or "") for r in corpus_pipeline.lines(spark, df, "").collect())
    assert got == sorted([(1, f"{a}\n{b}"), (2, c), (2, c), (0, a), (4, "")])
    assert corpus_pipeline.lines(spark, df.limit(0), "").count() == 0


def test_run(spark, tmp_path):
    """Real documents, some without an id and some repeated, through all stages; and empty tables."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    lone = docs.withColumn("text", F.concat(F.lit("unlike "), "text")).withColumn("doc_id", F.lit(None).cast("long"))
    every = docs.union(docs.limit(20)).union(lone.limit(10))
    for name, frame in (("all", every), ("none", every.limit(0))):
        frame.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        items.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    frame = spark.read.parquet(f"{tmp_path}/all/documents.parquet")
    quality = corpus_pipeline.quality(spark, frame, "").collect()
    items = spark.read.parquet(f"{tmp_path}/all/benchmark.parquet")
    dirty = decontaminate.decontaminate(corpus_pipeline.quality(spark, frame, ""), items).filter("contaminated AND doc_id IS NULL").count()
    got = corpus_pipeline.run(spark, f"{tmp_path}/all").collect()
    ids = [r.doc_id for r in got if r.doc_id is not None]
    assert ids and len(ids) == len(set(ids)) and set(ids) <= {r.doc_id for r in quality}
    nulls = sum(r.doc_id is None for r in quality)
    assert nulls and sum(r.doc_id is None for r in got) == nulls - dirty
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def quality_by_hand(text):
    """The text without failing lines, or None where the document goes; the rules as stated in quality_rules."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    three = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, w in enumerate(three) for k in range(3) if three.count(w) > 1}
    if len(words) < 50 or 100 * len(hit) > 50 * len(words):
        return None
    good, lost = [], 0
    for line in text.split("\n"):
        chars, own = re.sub(r"[\x20\x09-\x0D]+", "", line), re.findall(r"[^\x20\x09-\x0D]+", line)
        symbols, marks = len(re.findall(r"[#*$%&|<>]", line)), len(re.findall(quality_rules.SEPARATOR, line))
        bad = symbols * 100 > len(chars) * 10 or (not re.search(quality_rules.TERMINAL, line) and len(own) < 3)
        bad = bad or (marks >= 2 and marks * 100 >= len(own) * 25) or (re.search(quality_rules.BOILERPLATE, line) and len(own) <= 25)
        if chars and bad:
            lost += len(chars)
        else:
            good.append(line)
    return None if lost * 100 > sum(map(len, words)) * 40 else "\n".join(good)


def by_hand(docs, items):
    """doc_id -> (ids_sha256, decoded_sha256) of what run() keeps of documents with distinct ids."""
    docs = {d: t for d, text in docs.items() if (t := quality_by_hand(text)) is not None}
    drop = test_line_dedup.brute(sorted(docs.items()), 5, 5)
    for d, places in drop.items():
        lines = docs[d].split("\n")
        if len(places) < sum(bool(x.strip()) for x in lines):
            docs[d] = "\n".join(x for i, x in enumerate(lines) if i not in places)
        else:
            del docs[d]
    docs = {d: docs[d] for d, (_, least) in test_near_dedup.brute(sorted(docs.items())).items() if d == least}
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))
    windows = {tuple(w[i : i + 13]) for w in map(fold, items) if w for i in range(max(1, len(w) - 12))}
    out, library = {}, sentencepiece_library.SentencePieceProcessor(model_file=sentencepiece.model_path())
    for d, text in docs.items():
        w = fold(text)
        hit = {i + k for n in {len(x) for x in windows} for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows for k in range(n)}
        if not (hit and 20 * len(hit) >= len(w)):
            ids = library.encode(text)
            out[d] = tuple(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids)))
    return out


def test_run_against_brute_force(spark, tmp_path):
    """Real documents and items, with clashing extra columns."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect() if len(r.text) < 6000}
    some = docs.filter(F.length("text") < 6000)
    clash = {c: F.lit("x") for c in ("_w", "_judged", "_h", "_bytes", "kept", "n_words", "items", "n_lines", "dropped", "_row", "_id", "component_id")}
    some.withColumns(clash).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    want = by_hand(rows, [r.text for r in items.collect()])
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, str(tmp_path))
        assert out.dtypes == frame.dtypes and out.filter(" AND ".join(f"`{c}` = 'x'" for c in clash)).count() == out.count() > 0
    got = {r.doc_id: (r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == want and 20 < len(want) < len(rows)
