"""The named queries of the engine and their SQL.

The corpus tables stand in for ingested material: a conversation is a document
whose turns are pages; PER documents in a row make a longer one. Image flags,
blank ratios, labels and figure texts are synthetic, made from the ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import text as T
from paperloom.model import BEGIN_LINE, END_LINE, LAYER, MIXED, SCANNED_PDF, TEXT_PDF, WS, ClassifyConfig, ExtractConfig
from paperloom.operators import answers, chunk, classify, collection, convert, extract, similarity, stats
from paperloom.sources import artefact_source, file_sink, page_source
from paperloom.storage import new_folder

#: Rows of documents that make one document of pages.
PER, LARGE = 40, 400
CONFIG = ExtractConfig(mode=LAYER)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _paged(spark: SparkSession, sf_dir: str, per: int = PER) -> DataFrame:
    """documents as (doc, page_idx, text, doc_id); no shuffle."""
    doc = F.format_string("set%d.pdf", F.floor(F.col("doc_id") / per))
    return _table(spark, sf_dir, "documents").select(doc.alias("doc"), (F.col("doc_id") % per).alias("page_idx"), "text", "doc_id")


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as (doc, page_no, mode, page_text)."""
    doc = F.format_string("talks/%d.pdf", "conv_id")
    return _table(spark, sf_dir, "conversations").select(
        doc.alias("doc"), (F.col("turn") + 1).alias("page_no"), F.lit(LAYER).alias("mode"), F.coalesce("text", F.lit("")).alias("page_text")
    )


def _artefacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.assemble(_turns(spark, sf_dir), CONFIG)


def _sha(text: Column) -> Column:
    return F.sha2(text, 256)


def pages_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _artefacts(spark, sf_dir).select(F.col("doc").alias("source"), F.col("value").alias("text"))
    return chunk.parse_pages(made).select("source", "page_num", "page_text")


def artifact_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _artefacts(spark, sf_dir)


def body_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _artefacts(spark, sf_dir).select("doc", T.artefact_body(F.col("value")).alias("body"))


def source_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _artefacts(spark, sf_dir).select("doc", T.source_of_artefact(F.col("value")).alias("source"))


def _signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images on two pages of three; in every third document all pages but one in seven lack text."""
    pages = classify.sample_pages(_paged(spark, sf_dir))
    scanned = (F.floor(F.col("doc_id") / PER) % 3 == 0) & (F.col("doc_id") % 7 != 0)
    text = F.when(scanned, "").otherwise(T.collapse(F.coalesce("text", F.lit(""))))
    return pages.select("doc", "page_idx", text.alias("text"), (F.col("doc_id") % 3 != 0).alias("has_image"))


def sample_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.sample_pages(_paged(spark, sf_dir)).select("doc", "page_idx")


def classify_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.classify(_signals(spark, sf_dir))


def classify_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.report_lines(classify.classify(_signals(spark, sf_dir)), verbose=True)


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    label = F.element_at(F.array(F.lit(TEXT_PDF), F.lit(SCANNED_PDF), F.lit(MIXED), F.lit(None).cast("string")), (F.col("doc_id") % 4 + 1).cast("int"))
    ratio = F.when(F.col("doc_id") % 11 != 0, (F.col("doc_id") % 100) / 1000)
    pages = docs.select(
        F.format_string("%d.pdf", "doc_id").alias("doc"), F.lit(1).alias("page_no"), F.col("text"), ratio.alias("nonwhite_ratio"), label.alias("label"), F.col("text").cast("binary").alias("image")
    )
    return extract.routes(pages, ExtractConfig())


def page_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).select("doc", "mode", "route")


def extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _routed(spark, sf_dir).withColumn("image", F.coalesce("image", F.lit(b"")))
    done = extract.extract_pages(pages, ExtractConfig(), lambda: extract.stub_model)
    return done.select("doc", "mode", _sha(F.col("page_text")).alias("page_sha256"))


def extract_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _routed(spark, sf_dir).drop("mode", "route").withColumn("image", F.coalesce("image", F.lit(b"")))
    done = extract.extract_pages(pages, ExtractConfig(describe_figures=True), lambda: extract.stub_model)
    return done.select("doc", "mode", _sha(F.col("page_text")).alias("page_sha256"))


def answers_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as a page image, asked of the model once for equal ones, and then all again from the ledger."""
    ledger = f"{new_folder(spark, 'ledger')}/answers"
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("image"))
    first = answers.answered(docs, lambda: extract.stub_model, "text", CONFIG.model_id, ledger, "answer")
    again = answers.answered(first.withColumnRenamed("answer", "first_answer"), lambda: _no_model, "text", CONFIG.model_id, ledger, "answer")
    return again.select("doc_id", _sha(F.col("answer")).alias("answer_sha256"), (F.col("answer") == F.col("first_answer")).alias("same"))


def _no_model(image: bytes, prompt: str) -> str:
    raise RuntimeError("asked again")


def _artefact_files(spark: SparkSession, sf_dir: str) -> str:
    """The folder of one text file for each conversation."""
    path = new_folder(spark, "artefact-files")
    file_sink.write_artefact_files(_artefacts(spark, sf_dir), path)
    return path


READER = {"reader": "paperloom.sources.page_source:ArtefactReader", "pattern": "*.txt"}


def page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as files, all or none, and their pages read by ranges."""
    pages = page_source.scan(spark, _artefact_files(spark, sf_dir), task_bytes=100_000, **READER)
    return pages.select(T.base_name(F.col("doc")).alias("file"), "page_no", "text")


def document_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to artefacts in one call: scanned, routed, joined and written."""
    made = convert.convert_folder(spark, _artefact_files(spark, sf_dir), out=new_folder(spark, "converted"), cfg=CONFIG, **READER)
    return made.select(T.base_name(F.col("doc")).alias("file"), _sha(F.col("value")).alias("value_sha256"))


def folder_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files, classified from sampled pages."""
    made = convert.classify_folder(spark, _artefact_files(spark, sf_dir), **READER)
    return made.select(T.base_name(F.col("doc")).alias("file"), "label", "reason")


def artefact_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents joined to large artefacts, written as files and read back by ranges of bytes."""
    pages = _paged(spark, sf_dir, LARGE).select("doc", (F.col("page_idx") + 1).alias("page_no"), F.lit(LAYER).alias("mode"), F.coalesce("text", F.lit("")).alias("page_text"))
    path = new_folder(spark, "artefact-files")
    file_sink.write_artefact_files(extract.assemble(pages, CONFIG), path)
    made = artefact_source.artefact_pages(spark, path, split_bytes=262_144)
    return made.select("source", "pos", "page_num", _sha(F.col("page_text")).alias("text_sha256"))


def page_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _paged(spark, sf_dir).select("doc", (F.col("page_idx") + 1).alias("page_no"), "text", "doc_id")
    texts = pages.select("doc", "page_no", F.length("text").alias("n_chars"))
    return extract.align(texts, pages.select("doc", "page_no", (F.col("doc_id") % 1000).alias("width")))


def figures_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.array(F.lit(None).cast("string"), F.lit(" none\n"), F.lit("NONE."), F.format_string(" - (pos: top) figure %d ", "doc_id"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.element_at(given, (F.col("doc_id") % 4 + 1).cast("int")).alias("figures"))
    return docs.select("doc_id", _sha(T.with_figures(F.col("text"), F.col("figures"))).alias("text_sha256"))


def _chunk_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paged(spark, sf_dir).select(
        F.col("doc").alias("source"), F.col("page_idx").alias("pos"), (F.col("page_idx") + 1).alias("page_num"), F.coalesce("text", F.lit("")).alias("page_text")
    )


def chunk_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = chunk.chunk_pages(_chunk_source(spark, sf_dir))
    return made.select("source_name", "page_label", "chunk_index", F.to_json("metadata").alias("metadata"), F.length("text").alias("n_chars"), _sha(F.col("text")).alias("text_sha256"))


def chunk_whole_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks larger than any page: one of each page that has text, with header, label, index and metadata."""
    made = chunk.chunk_pages(_chunk_source(spark, sf_dir), size=2**30, overlap=0)
    return made.select("source_name", "page_label", "chunk_index", F.to_json("metadata").alias("metadata"), _sha(F.col("text")).alias("text_sha256"))


def chunk_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = chunk.chunk_pages(_chunk_source(spark, sf_dir), overlap=0, header=False)
    return made.groupBy("source_name", "page_label").agg(F.sum(T.non_space_length(F.col("text"))).alias("n_chars"))


def embed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = collection.embed(chunk.chunk_pages(_chunk_source(spark, sf_dir)), collection.hash_embedder(), 64)
    return made.select("metadata", _sha(F.col("text")).alias("text_sha256"), F.size("embedding").alias("n_dimensions"))


def chunk_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.length_stats(_table(spark, sf_dir, "conversations"))


def _collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as a collection; every tenth has no source."""
    source = F.when(F.col("doc_id") % 10 != 0, F.col("source"))
    meta = F.to_json(F.struct(source.alias("source"), F.col("lang").alias("page_label"), F.lit("ocr").alias("extraction")))
    return _table(spark, sf_dir, "documents").select("doc_id", meta.alias("metadata"))


def inspect_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collection.inspect(_collection(spark, sf_dir))


def list_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collection.list_documents(_collection(spark, sf_dir))


def inspect_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collection.inspect_totals(_collection(spark, sf_dir))


def analyze_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = F.when(F.col("vec_id") % 3 == 0, F.slice("embedding", 1, 32)).otherwise(F.col("embedding"))
    return collection.analyze(_table(spark, sf_dir, "embeddings").select(vector.alias("embedding")), mode="actual")


#: What similarity queries ask for: every 50th vector, its nearest, and lists looked into.
NEAREST, PROBES = 10, 24


def _asked(spark: SparkSession, sf_dir: str) -> tuple[similarity.Index, DataFrame]:
    vectors = _table(spark, sf_dir, "embeddings").filter("vec_id IS NOT NULL")
    return similarity.build(vectors, "vec_id"), vectors.filter("vec_id % 50 = 0")


def similar_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact nearest vectors of every query."""
    index, asked = _asked(spark, sf_dir)
    return similarity.search(index, asked, NEAREST, key="vec_id").select("query", "id", "rank")


def similar_vectors_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by inverted lists."""
    index, asked = _asked(spark, sf_dir)
    return similarity.search(index, asked, NEAREST, PROBES, key="vec_id").select("query", "id", "rank")


def delete_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = spark.createDataFrame([("src1",), ("src3",), ("absent",)], "document STRING")
    return collection.without_documents(_collection(spark, sf_dir), gone)


def json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", T.json_text(F.col("props"), "$.k").alias("k"))


def basename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", T.base_name(F.col("url")).alias("base"), T.file_name(F.col("url")).alias("file"))


def mask_secret(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select("c_custkey", T.mask_secret(F.col("c_name")).alias("masked"))


MODELS = ("openai.gpt-5", "google.gemini-2.5-pro", "Gemini.x", " meta .llama", "plain", ".odd", "")


def model_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.array(*[F.lit(m) for m in MODELS])
    pick = F.element_at(ids, (F.col("c_custkey") % len(MODELS) + 1).cast("int"))
    return _table(spark, sf_dir, "customer").select("c_custkey", T.model_provider(pick).alias("provider"), T.token_limit_name(pick).alias("limit_name"))


def normalize_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return _table(spark, sf_dir, "documents").select(
        "doc_id", _sha(T.collapse(text)).alias("collapsed"), _sha(T.squeeze_blanks(text)).alias("squeezed"), T.has_enough_text(text, 50).alias("enough")
    )


def data_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = T.data_url(F.coalesce("text", F.lit("")).cast("binary"), F.when(F.col("doc_id") % 2 == 0, "PNG").otherwise("jpeg"))
    return _table(spark, sf_dir, "documents").select("doc_id", _sha(url).alias("url_sha256"))


def token_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.col("turn")
    tokens = _table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("request_id"), turn.alias("seq"), F.when(turn % 3 != 2, F.col("text")).otherwise("").alias("content"),
        F.when(turn % 2 == 0, F.concat(F.lit("a"), turn.cast("string"))).otherwise("").alias("add_kw"), F.when(turn % 3 == 1, F.concat(F.lit("m"), turn.cast("string"))).alias("resp_meta"),
    )
    return stats.joined_stream(tokens)


QUERIES = {
    f.__name__: f
    for f in (
        pages_roundtrip, artifact_assembly, body_extract, source_infer, sample_pages, classify_documents, classify_report, page_route, extract_pages, extract_figures, page_align, answers_ledger, page_scan, artefact_ranges, document_run, folder_classes,
        figures_append, chunk_pages, chunk_whole_pages, chunk_conservation, embed_chunks, chunk_length_stats, inspect_collection, list_documents, inspect_totals,
        analyze_collection, similar_vectors, similar_vectors_index, delete_documents, json_path, basename, mask_secret, model_provider, normalize_ws, data_url, token_stream,
    )
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns to artefacts, back to pages, and the pages counted per source."""
    pages = pages_roundtrip(spark, sf_dir)
    stored = pages.select(F.to_json(T.chunk_metadata(F.col("source"), F.col("page_num").cast("string"))).alias("metadata"))
    return collection.inspect(stored)


_TRIM = f"trim({{}}, '{WS}')"


def _split_sql(pages: str, size: int, overlap: int) -> str:
    """CTEs that end in chunks (source, pos, page_label, start, chunk): pages (source, pos, page_label, text) cut at one separator after the other.

    Each level cuts what is still too long. Runs of short pieces are packed by a
    recursive query that follows, from the start of a chunk, where it ends and where the next one starts.
    """
    steps = [f"s0 AS MATERIALIZED (SELECT source, pos, page_label, 0::BIGINT AS pt, text AS t FROM ({pages}) WHERE text != '')"]
    separators = ("chr(10) || chr(10)", "chr(10)", "' '", "''")
    for level, sep in enumerate(separators):
        last = level + 1 == len(separators)
        has = "true" if last else f"contains(t, {sep})"
        steps.append(f"""p{level} AS MATERIALIZED (
          SELECT source, pos, page_label, {level} AS level, pt AS seg, pt + (sum(length(piece)) OVER (PARTITION BY source, pos, pt ORDER BY i) - length(piece))::BIGINT AS pt, length(piece) AS n, piece FROM (
            SELECT source, pos, page_label, pt, i, CASE WHEN i > 1 THEN {sep} ELSE '' END || parts[i] AS piece
            FROM (SELECT *, string_split(t, {sep}) AS parts FROM s{level} WHERE {has}) x, LATERAL (SELECT unnest(generate_series(1, len(parts))) AS i)) y
          WHERE piece != '')""")
        if not last:
            steps.append(f"""s{level + 1} AS MATERIALIZED (SELECT source, pos, page_label, pt, t FROM s{level} WHERE NOT {has}
              UNION ALL SELECT source, pos, page_label, pt, piece FROM p{level} WHERE n >= {size})""")
    every = " UNION ALL ".join(f"SELECT * FROM p{k}" for k in range(len(separators)))
    return ", ".join(steps) + f""",
      q AS MATERIALIZED (SELECT *, pt + n AS fin, count(*) FILTER (WHERE n >= {size}) OVER (PARTITION BY source, pos, level, seg ORDER BY pt) AS run FROM ({every})),
      b AS MATERIALIZED (SELECT source, pos, page_label, level, seg, run, pt, fin, max(fin) OVER w AS goal, max(fin) OVER r AS stop, min(pt) OVER r AS start FROM q WHERE n < {size}
        WINDOW r AS (PARTITION BY source, pos, level, seg, run), w AS (PARTITION BY source, pos, level, seg, run ORDER BY fin RANGE BETWEEN CURRENT ROW AND ({size} - n) FOLLOWING)),
      m AS (SELECT b.*, greatest(b.goal - {overlap}, x.fin - {size}) AS least FROM b LEFT JOIN b x ON b.source = x.source AND b.pos = x.pos AND b.level = x.level AND b.seg = x.seg AND b.run = x.run AND x.pt = b.goal),
      f AS MATERIALIZED (SELECT m.source, m.pos, m.page_label, m.level, m.seg, m.run, m.start, m.pt, m.goal, CASE WHEN m.goal < m.stop THEN n.pt END AS next
        FROM m ASOF LEFT JOIN b n ON m.source = n.source AND m.pos = n.pos AND m.level = n.level AND m.seg = n.seg AND m.run = n.run AND m.least <= n.pt),
      c AS (SELECT * FROM f WHERE pt = start
        UNION ALL SELECT f.* FROM c JOIN f ON f.source = c.source AND f.pos = c.pos AND f.level = c.level AND f.seg = c.seg AND f.run = c.run AND f.pt = c.next),
      chunks AS (SELECT source, pos, page_label, pt AS start, {_TRIM.format("substr(text, pt + 1, goal - pt)")} AS chunk FROM c JOIN (SELECT source, pos, text FROM ({pages})) USING (source, pos)
        UNION ALL SELECT source, pos, page_label, pt, {_TRIM.format("piece")} FROM p3 WHERE n >= {size})"""


_SPACE = f"[{WS}]"
_TURNS = "SELECT 'talks/' || conv_id || '.pdf' AS doc, conv_id || '.pdf' AS name, turn + 1 AS page_no, coalesce(text, '') AS t FROM conversations"
_FILES = f"SELECT name || '-' || left(sha256(doc), 12) || '.txt' AS file, page_no, t FROM ({_TURNS})"
_BLOCKS = f"SELECT doc, name, string_agg(rtrim(t, '{WS}') || chr(10) || chr(10) || '--- PAGE ' || page_no || ' ---' || chr(10) || chr(10), '' ORDER BY page_no) AS blocks, count(*) AS n FROM ({_TURNS}) GROUP BY doc, name"
_HEADER = f"'SOURCE PDF: ' || name || chr(10) || 'DPI: {CONFIG.dpi}' || chr(10) || 'MODEL_ID: {CONFIG.model_id}' || chr(10) || 'TEXT_MODE: {LAYER}' || chr(10) || 'INPUT_PDF_TYPE: None' || chr(10) || 'DESCRIBE_FIGURES: False' || chr(10)"
_PAGED = f"SELECT 'set' || (doc_id // {PER}) || '.pdf' AS doc, doc_id % {PER} AS page_idx, coalesce(text, '') AS text, doc_id FROM documents"
_SQUEEZED = f"SELECT doc AS source, page_idx AS pos, (page_idx + 1)::VARCHAR AS page_label, regexp_replace(text, '[ \t]{{2,}}', ' ', 'g') AS text FROM ({_PAGED})"
_HEADED = "'---' || chr(10) || 'source_file: ' || source || chr(10) || '---' || chr(10) || chr(10) || chunk"
_SAMPLED = f"""
  SELECT * FROM (SELECT *, greatest(1, n // least(10, n)) AS stride FROM (SELECT *, count(*) OVER (PARTITION BY doc) AS n FROM ({_PAGED})))
  WHERE page_idx % stride = 0 AND page_idx // stride < 10"""
_C = ClassifyConfig()
_CLASSIFIED = f"""
  SELECT doc, CASE WHEN chars >= {_C.strong_text_chars} THEN '{TEXT_PDF}' WHEN has_text AND (images = 0 OR ratio < {_C.scanned_ratio}) THEN '{TEXT_PDF}'
      WHEN NOT has_text AND images > 0 AND ratio >= {_C.scanned_ratio} THEN '{SCANNED_PDF}' ELSE '{MIXED}' END AS label,
    printf('text_chars=%d, text_pages=%d, image_ratio=%.2f', chars, text_pages, ratio) AS reason
  FROM (
    SELECT doc, sum(len)::BIGINT AS chars, count(*) FILTER (WHERE len >= {_C.min_text_chars_page}) AS text_pages, count(*) FILTER (WHERE has_image) AS images,
      count(*) FILTER (WHERE has_image) / count(*)::DOUBLE AS ratio, sum(len) >= {_C.min_text_chars_doc} OR bool_or(len >= {_C.min_text_chars_page}) AS has_text
    FROM (
      SELECT doc, doc_id % 3 != 0 AS has_image,
        CASE WHEN (doc_id // {PER}) % 3 = 0 AND doc_id % 7 != 0 THEN 0 ELSE length(trim(regexp_replace(text, '{_SPACE}+', ' ', 'g'))) END AS len
      FROM ({_SAMPLED}))
    GROUP BY doc)"""
_ROUTED = f"""
  SELECT doc, text, mode, CASE WHEN mode != 'pypdf' AND coalesce(ratio < 0.01, false) THEN 'blank'
      WHEN mode = 'pypdf' OR (mode = 'auto' AND length(regexp_replace(text, '{_SPACE}', '', 'g')) >= 50) THEN 'layer' ELSE 'model' END AS route
  FROM (SELECT doc_id || '.pdf' AS doc, coalesce(text, '') AS text, CASE doc_id % 4 WHEN 0 THEN 'pypdf' WHEN 1 THEN 'vlm' ELSE 'auto' END AS mode,
    CASE WHEN doc_id % 11 != 0 THEN (doc_id % 100) / 1000.0 END AS ratio FROM documents)"""
#: With figures to describe, a blank image counts in every mode.
_ROUTED_FIGURES = _ROUTED.replace("WHEN mode != 'pypdf' AND", "WHEN")
_COLLECTION = "SELECT doc_id, CASE WHEN doc_id % 10 != 0 THEN source END AS source, lang FROM documents"
_MODEL = "CASE c_custkey % 7 WHEN 0 THEN {} WHEN 1 THEN {} WHEN 2 THEN {} WHEN 3 THEN {} ELSE {} END"

SQL = {
    "pages_roundtrip": f"SELECT doc AS source, page_no AS page_num, {_TRIM.format('replace(t, chr(13) || chr(10), chr(10))')} AS page_text FROM ({_TURNS})",
    "artifact_assembly": f"SELECT doc, {_HEADER} || '{BEGIN_LINE}' || blocks || '{END_LINE}' || 'TOTAL PAGES: ' || n || chr(10) AS value FROM ({_BLOCKS})",
    "body_extract": f"SELECT doc, {_TRIM.format('blocks')} AS body FROM ({_BLOCKS})",
    "source_infer": f"SELECT DISTINCT doc, name AS source FROM ({_TURNS})",
    "sample_pages": f"SELECT doc, page_idx FROM ({_SAMPLED})",
    "classify_documents": _CLASSIFIED,
    "classify_report": f"SELECT doc, rpad(label, 12, ' ') || '| ' || doc || ' | ' || reason AS line FROM ({_CLASSIFIED})",
    "page_route": f"SELECT doc, mode, route FROM ({_ROUTED})",
    "extract_pages": f"SELECT doc, mode, sha256(CASE route WHEN 'blank' THEN '{CONFIG.blank_placeholder}' WHEN 'layer' THEN text ELSE {_TRIM.format(chr(39) + '[vlm] ' + chr(39) + ' || text')} END) AS page_sha256 FROM ({_ROUTED})",
    "extract_figures": f"""
      SELECT doc, mode, sha256(CASE WHEN route = 'blank' THEN '{CONFIG.blank_placeholder}' WHEN n % 2 = 1 THEN t
        ELSE rtrim(t, '{WS}') || chr(10) || chr(10) || '[FIGURES]' || chr(10) || '- figure of ' || n || ' bytes' || chr(10) END) AS page_sha256
      FROM (SELECT doc, mode, route, strlen(text) AS n, CASE route WHEN 'layer' THEN text ELSE {_TRIM.format(chr(39) + '[vlm] ' + chr(39) + ' || text')} END AS t FROM ({_ROUTED_FIGURES}))""",
    "answers_ledger": f"SELECT doc_id, sha256({_TRIM.format(chr(39) + '[vlm] ' + chr(39) + ' || coalesce(text, ' + chr(39) * 2 + ')')}) AS answer_sha256, true AS same FROM documents",
    "page_scan": f"SELECT file, row_number() OVER (PARTITION BY file ORDER BY page_no)::INT AS page_no, {_TRIM.format('replace(t, chr(13) || chr(10), chr(10))')} AS text FROM ({_FILES})",
    "artefact_ranges": f"""
      SELECT doc AS source, (row_number() OVER (PARTITION BY doc ORDER BY page_idx) - 1)::INT AS pos, page_idx + 1 AS page_num, sha256({_TRIM.format("replace(text, chr(13) || chr(10), chr(10))")}) AS text_sha256 FROM ({_PAGED.replace(str(PER), str(LARGE))})""",
    "document_run": f"""
      SELECT file, sha256({_HEADER.replace("name", "file")} || '{BEGIN_LINE}' || string_agg(rtrim({_TRIM.format("replace(t, chr(13) || chr(10), chr(10))")}, '{WS}') || chr(10) || chr(10) || '--- PAGE ' || k || ' ---' || chr(10) || chr(10), '' ORDER BY k)
        || '{END_LINE}' || 'TOTAL PAGES: ' || count(*) || chr(10)) AS value_sha256
      FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY page_no) AS k FROM ({_FILES})) GROUP BY file""",
    "folder_classes": f"""
      SELECT file, CASE WHEN chars >= {_C.strong_text_chars} OR chars >= {_C.min_text_chars_doc} OR text_pages > 0 THEN '{TEXT_PDF}' ELSE '{MIXED}' END AS label,
        printf('text_chars=%d, text_pages=%d, image_ratio=0.00', chars, text_pages) AS reason
      FROM (SELECT file, sum(len)::BIGINT AS chars, count(*) FILTER (WHERE len >= {_C.min_text_chars_page}) AS text_pages
        FROM (SELECT *, length(trim(regexp_replace(t, '{_SPACE}+', ' ', 'g'))) AS len, row_number() OVER (PARTITION BY file ORDER BY page_no) - 1 AS k, count(*) OVER (PARTITION BY file) AS n FROM ({_FILES}))
        WHERE k % greatest(1, n // least({_C.sample_pages}, n)) = 0 AND k // greatest(1, n // least({_C.sample_pages}, n)) < {_C.sample_pages} GROUP BY file)""",
    "page_align": f"""
      SELECT a.doc, a.page_no, a.n_chars, b.width
      FROM (SELECT doc, page_idx + 1 AS page_no, length(text)::INT AS n_chars FROM ({_PAGED})) a
      JOIN (SELECT doc, page_idx + 1 AS page_no, doc_id % 1000 AS width FROM ({_PAGED})) b ON a.doc = b.doc AND a.page_no = b.page_no""",
    "figures_append": f"""
      SELECT doc_id, sha256(CASE WHEN f IS NULL THEN t ELSE rtrim(t, '{WS}') || chr(10) || chr(10) || '[FIGURES]' || chr(10) || f || chr(10) END) AS text_sha256
      FROM (SELECT doc_id, coalesce(text, '') AS t, CASE doc_id % 4 WHEN 2 THEN 'NONE.' WHEN 3 THEN '- (pos: top) figure ' || doc_id END AS f FROM documents)""",
    "chunk_pages": f"""
      WITH RECURSIVE {_split_sql(_SQUEEZED, 1500, 100)}
      SELECT source AS source_name, page_label, (row_number() OVER (PARTITION BY source ORDER BY pos, start) - 1)::INT AS chunk_index,
        '{{"source":"' || source || '","page_label":"' || page_label || '","extraction":"ocr"}}' AS metadata, length({_HEADED})::INT AS n_chars, sha256({_HEADED}) AS text_sha256
      FROM chunks WHERE chunk != ''""",
    "embed_chunks": f"""
      WITH RECURSIVE {_split_sql(_SQUEEZED, 1500, 100)}
      SELECT '{{"source":"' || source || '","page_label":"' || page_label || '","extraction":"ocr"}}' AS metadata, sha256({_HEADED}) AS text_sha256, 64 AS n_dimensions FROM chunks WHERE chunk != ''""",
    "chunk_whole_pages": f"""
      SELECT doc AS source_name, (page_idx + 1)::VARCHAR AS page_label, (row_number() OVER (PARTITION BY doc ORDER BY page_idx) - 1)::INT AS chunk_index,
        '{{"source":"' || doc || '","page_label":"' || (page_idx + 1) || '","extraction":"ocr"}}' AS metadata,
        sha256('---' || chr(10) || 'source_file: ' || doc || chr(10) || '---' || chr(10) || chr(10) || t) AS text_sha256
      FROM (SELECT doc, page_idx, {_TRIM.format("regexp_replace(text, '[ \t]{2,}', ' ', 'g')")} AS t FROM ({_PAGED})) WHERE t != ''""",
    "chunk_conservation": f"""
      SELECT doc AS source_name, (page_idx + 1)::VARCHAR AS page_label, length(regexp_replace(text, '{_SPACE}', '', 'g'))::BIGINT AS n_chars
      FROM ({_PAGED}) WHERE length(regexp_replace(text, '{_SPACE}', '', 'g')) > 0""",
    "chunk_length_stats": """
      SELECT round_even(avg(length(text)), 0)::BIGINT AS mean, round_even(stddev_pop(length(text)), 0)::BIGINT AS std, round_even(quantile_cont(length(text), 0.75), 0)::BIGINT AS p75 FROM conversations""",
    "inspect_collection": f"SELECT source AS document, count(*) AS n_chunks FROM ({_COLLECTION}) WHERE source IS NOT NULL GROUP BY source ORDER BY document",
    "list_documents": f"SELECT DISTINCT source AS document FROM ({_COLLECTION}) ORDER BY document",
    "inspect_totals": f"SELECT count(DISTINCT source) AS documents, count(source) AS chunks FROM ({_COLLECTION})",
    "analyze_collection": """
      SELECT 'records' AS metric, '' AS value, count(*) AS n FROM embeddings
      UNION ALL SELECT 'format', 'FLOAT32', count(*) FROM embeddings WHERE embedding IS NOT NULL HAVING count(*) > 0
      UNION ALL SELECT 'dimension', (CASE WHEN vec_id % 3 = 0 THEN least(32, len(embedding)) ELSE len(embedding) END)::VARCHAR AS d, count(*)
      FROM embeddings WHERE embedding IS NOT NULL GROUP BY d""",
    "similar_vectors": f"""
      WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL)
      SELECT query, id, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY query ORDER BY near DESC, id)::INT AS rank
        FROM (SELECT a.vec_id AS query, b.vec_id AS id, round(list_cosine_similarity(a.e, b.e), 9) AS near FROM v a, v b WHERE a.vec_id % 50 = 0))
      WHERE rank <= {NEAREST}""",
    "delete_documents": f"""
      SELECT doc_id, '{{' || CASE WHEN source IS NULL THEN '' ELSE '"source":"' || source || '",' END || '"page_label":"' || lang || '","extraction":"ocr"}}' AS metadata
      FROM ({_COLLECTION}) WHERE source IS NULL OR source NOT IN ('src1', 'src3')""",
    "json_path": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "basename": "SELECT page_id, regexp_extract(url, '[^/]*$') AS base, regexp_extract(rtrim(url, '/'), '[^/]*$') AS file FROM pages",
    "mask_secret": "SELECT c_custkey, CASE WHEN c_name IS NULL THEN '' WHEN length(c_name) <= 2 THEN repeat('*', length(c_name)) ELSE left(c_name, 2) || repeat('*', length(c_name) - 2) END AS masked FROM customer",
    "model_provider": f"""
      SELECT c_custkey, {_MODEL.format("'openai'", "'google'", "'gemini'", "'meta'", "'unknown'")} AS provider,
        {_MODEL.format("'max_completion_tokens'", "'max_tokens'", "'max_output_tokens'", "'max_tokens'", "'max_tokens'")} AS limit_name FROM customer""",
    "normalize_ws": f"""
      SELECT doc_id, sha256(trim(regexp_replace(t, '{_SPACE}+', ' ', 'g'))) AS collapsed, sha256(regexp_replace(t, '[ \\t]{{2,}}', ' ', 'g')) AS squeezed,
        length(regexp_replace(t, '{_SPACE}', '', 'g')) >= 50 AS enough
      FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""",
    "data_url": "SELECT doc_id, sha256('data:image/' || CASE WHEN doc_id % 2 = 0 THEN 'png' ELSE 'jpeg' END || ';base64,' || base64(encode(coalesce(text, '')))) AS url_sha256 FROM documents",
    "token_stream": """
      SELECT conv_id::VARCHAR AS request_id, coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE turn % 3 != 2), '') AS text,
        coalesce(sum(length(text)) FILTER (WHERE turn % 3 != 2), 0)::BIGINT AS n_chars,
        arg_max(CASE WHEN turn % 2 = 0 THEN 'a' || turn ELSE 'm' || turn END, turn) FILTER (WHERE turn % 2 = 0 OR turn % 3 = 1) AS last_reason,
        arg_max('m' || turn, turn) FILTER (WHERE turn % 3 = 1) AS last_meta
      FROM conversations GROUP BY conv_id""",
}
