"""Support-assistant module bound to the driver tables.

* index: ``embeddings`` (64-d vectors) with chunk text from ``documents``
  (vec_id = doc_id, left join); every vector is also a query against the
  rest of the index, so retrieval runs over the whole table;
* queries with text: ``conversations`` user turns;
* raw model responses: JSON texts built from ``events`` rows, with planted
  defects (truncated, missing field, string confidence, numeric answer,
  out-of-range confidence), attempts numbered per user by time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanthorn.functions import text as tx
from lanthorn.operators import features as fe
from lanthorn.operators import retrieval as rt
from lanthorn.operators import vectors as vx
from lanthorn.plans.registry import query
from lanthorn.session import read_table, scratch_path, spread

# Intent keywords for the driver's invented prose (the reference's own
# list, ``retrieval.POLICY_KEYWORDS``, never occurs in it).
DRV_KEYWORDS = ["tion", "queja", "ment"]


def r6(c):
    return F.round(c, 6) + F.lit(0.0)


def r9(c):
    return F.round(c, 9) + F.lit(0.0)


def index_table(spark, sf_dir) -> DataFrame:
    return rt.chunk_index(read_table(spark, sf_dir, "embeddings"), read_table(spark, sf_dir, "documents"),
                          "vec_id", "embedding", "doc_id", "text")


def nearest(spark, sf_dir, k: int = 3) -> DataFrame:
    idx = index_table(spark, sf_dir)
    return rt.retrieve(idx.select("key", "embedding"), idx, "key", "embedding", k, exclude_self=True)


def user_turns(spark, sf_dir) -> DataFrame:
    return read_table(spark, sf_dir, "conversations").filter(F.col("role") == "user") \
        .withColumn("query_id", F.col("conv_id") * 1000 + F.col("turn"))


def raw_responses(spark, sf_dir) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    k = F.col("event_id")
    ans = F.concat(F.lit('{"answer": "'), F.col("event_type"), F.lit('"'))
    src = F.concat(F.lit(', "sources": ["doc_'), F.col("user_id").cast("string"), F.lit('"]'))
    conf = F.concat(F.lit(', "confidence": 0.'), F.lpad((k % 100).cast("string"), 2, "0"), F.lit("}"))
    raw = (F.when(k % 13 == 0, F.concat(ans, src))
           .when(k % 17 == 0, F.concat(ans, conf))
           .when(k % 19 == 0, F.concat(ans, F.lit(', "sources": [], "confidence": "0.5"}')))
           .when(k % 23 == 0, F.lit('{"answer": 1, "sources": [], "confidence": 0.5}'))
           .when(k % 7 == 0, F.concat(ans, F.lit(', "sources": [], "confidence": 1.2}')))
           .otherwise(F.concat(ans, src, conf)))
    return e.select("event_id", F.col("user_id").alias("query_id"), "ts", raw.alias("raw"))


E_SQL = "e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"
NN_SQL = E_SQL + """,
d AS (SELECT q.vec_id AS query_id, i.vec_id AS neighbor_id,
        1 - list_dot_product(q.v, i.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(i.v, i.v)))
        AS distance FROM e q JOIN e i ON q.vec_id <> i.vec_id),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id)
        AS rank FROM d) WHERE rank <= 3),
chunks AS (SELECT nn.*, printf('doc_%02d_chunk_01', nn.neighbor_id) AS id, doc.text
           FROM nn LEFT JOIN documents doc ON doc.doc_id = nn.neighbor_id)"""

RAW_SQL = """raw AS (
  SELECT event_id, user_id AS query_id, ts, CASE
    WHEN event_id % 13 = 0 THEN '{"answer": "' || event_type || '", "sources": ["doc_' || CAST(user_id AS VARCHAR) || '"]'
    WHEN event_id % 17 = 0 THEN '{"answer": "' || event_type || '", "confidence": 0.' || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') || '}'
    WHEN event_id % 19 = 0 THEN '{"answer": "' || event_type || '", "sources": [], "confidence": "0.5"}'
    WHEN event_id % 23 = 0 THEN '{"answer": 1, "sources": [], "confidence": 0.5}'
    WHEN event_id % 7 = 0 THEN '{"answer": "' || event_type || '", "sources": [], "confidence": 1.2}'
    ELSE '{"answer": "' || event_type || '", "sources": ["doc_' || CAST(user_id AS VARCHAR) || '"], "confidence": 0.' || lpad(CAST(event_id % 100 AS VARCHAR), 2, '0') || '}'
  END AS raw FROM events),
parsed AS (
  SELECT event_id, json_type(raw) = 'OBJECT' AS is_obj, json_type(raw, '$.answer') = 'VARCHAR' AS ans_ok,
    coalesce(json_type(raw, '$.sources') = 'ARRAY'
             AND coalesce(list_bool_and(list_transform(json_type(raw, '$.sources[*]'), lambda t: t = 'VARCHAR')), true),
             false) AS src_ok,
    CASE WHEN json_type(raw, '$.confidence') IN ('DOUBLE', 'UBIGINT', 'BIGINT')
           THEN CAST(json_extract(raw, '$.confidence') AS DOUBLE)
         WHEN json_type(raw, '$.confidence') = 'VARCHAR'
           THEN TRY_CAST(json_extract_string(raw, '$.confidence') AS DOUBLE) END AS conf,
    json_extract_string(raw, '$.answer') AS answer,
    array_to_string(json_extract_string(raw, '$.sources[*]'), ',') AS sources
  FROM raw WHERE json_valid(raw)),
checked AS (
  SELECT r.event_id, r.query_id, r.ts, coalesce(p.is_obj AND p.ans_ok AND p.src_ok
         AND p.conf BETWEEN 0 AND 1, false) AS valid, p.conf, p.answer, p.sources
  FROM raw r LEFT JOIN parsed p USING (event_id))"""


# ------------------------------------------------------------------ ids and text
@query("format_ids", """
SELECT doc_id, printf('doc_%02d', doc_id) AS document_id, printf('doc_%02d_chunk_01', doc_id) AS chunk_id
FROM documents""")
def q_format_ids(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", tx.format_doc_id("doc_id").alias("document_id"),
                    tx.format_chunk_id("doc_id").alias("chunk_id"))


@query("corpus_rows", """
SELECT printf('doc_%02d_chunk_01', doc_id) AS id, printf('doc_%02d', doc_id) AS document_id,
  regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS text FROM documents""")
def q_corpus_rows(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select(tx.format_chunk_id("doc_id").alias("id"), tx.format_doc_id("doc_id").alias("document_id"),
                    tx.strip_ws("text").alias("text"))


@query("snippet", """
SELECT doc_id, regexp_replace(replace(substring(text, 1, 200), chr(10), ' '), '^\\s+|\\s+$', '', 'g')
  AS snippet FROM documents""")
def q_snippet(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", tx.snippet("text").alias("snippet"))


@query("answer_template", f"""
SELECT doc_id, '{rt.ANSWER_PREFIX}' || regexp_replace(replace(substring(text, 1, 200), chr(10), ' '),
  '^\\s+|\\s+$', '', 'g') AS answer FROM documents""")
def q_answer_template(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", F.concat(F.lit(rt.ANSWER_PREFIX), tx.snippet("text")).alias("answer"))


# ------------------------------------------------------------------ vectors
def checksum(vector: str):
    """Every component of a vector in one number: the sum of component times position."""
    weighted = F.transform(vector, lambda x, i: x.cast("double") * (i + 1))
    return r6(F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x)).alias("checksum")


@query("vector_index", """
SELECT e.vec_id AS key, printf('doc_%02d_chunk_01', e.vec_id) AS id, printf('doc_%02d', e.vec_id) AS document_id,
  CAST(length(d.text) AS INTEGER) AS text_chars, CAST(len(e.embedding) AS INTEGER) AS dim, md5(d.text) AS text_md5,
  round(list_sum([CAST(e.embedding[i] AS DOUBLE) * i FOR i IN range(1, len(e.embedding) + 1)]), 6) + 0.0 AS checksum
FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id""")
def q_vector_index(spark, sf_dir):
    idx = index_table(spark, sf_dir)
    return idx.select("key", "id", "document_id", F.length("text").alias("text_chars"),
                      F.size("embedding").alias("dim"), F.md5("text").alias("text_md5"), checksum("embedding"))


@query("cosine_distance", "WITH " + E_SQL + """
SELECT a.vec_id, b.vec_id AS next_id, round(1 - list_dot_product(a.v, b.v)
  / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))), 6) + 0.0 AS distance
FROM e a JOIN e b ON b.vec_id = a.vec_id + 1""")
def q_cosine_distance(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec_id").alias("next_id"),
                 F.col("embedding").alias("nb"))
    return e.join(b, "vec_id").select("vec_id", "next_id",
                                      r6(vx.cosine_distance("embedding", "nb")).alias("distance"))


@query("knn_top3", "WITH " + NN_SQL + """
SELECT query_id, neighbor_id, CAST(rank AS INTEGER) AS rank, round(distance, 6) + 0.0 AS distance FROM nn""")
def q_knn_top3(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    nn = vx.knn(e, e, 3, "vec_id", "vec_id", "embedding", "embedding", exclude_self=True)
    return nn.select("query_id", "neighbor_id", "rank", r6(F.col("distance")).alias("distance"))


@query("retrieve_and_answer", "WITH " + NN_SQL + f"""
SELECT query_id, '{rt.ANSWER_PREFIX}' || regexp_replace(replace(substring(coalesce(
    max(text) FILTER (WHERE rank = 1), ''), 1, 200), chr(10), ' '), '^\\s+|\\s+$', '', 'g') AS answer,
  string_agg(id, ',' ORDER BY rank) AS sources, CAST(1.0 AS DOUBLE) AS confidence FROM chunks GROUP BY query_id""")
def q_retrieve_and_answer(spark, sf_dir):
    a = rt.answer_from_chunks(nearest(spark, sf_dir))
    return a.select("query_id", "answer", F.array_join("sources", ",").alias("sources"), "confidence")


@query("extract_list", "WITH " + NN_SQL + """
SELECT query_id, string_agg(id, ',' ORDER BY rank) AS source_ids FROM chunks GROUP BY query_id""")
def q_extract_list(spark, sf_dir):
    a = rt.answer_from_chunks(nearest(spark, sf_dir))
    return a.select("query_id", F.array_join("sources", ",").alias("source_ids"))


@query("assemble_context", "WITH " + NN_SQL + """,
ctx AS (SELECT query_id, string_agg('Source: ' || id || chr(10) || coalesce(text, ''), chr(10) || chr(10)
          ORDER BY rank) AS context FROM chunks GROUP BY query_id)
SELECT c.query_id, md5(c.context) AS context_md5, CAST(length(c.context) AS INTEGER) AS context_chars,
  md5('CONTEXT:' || chr(10) || c.context || chr(10) || chr(10) || 'QUESTION:' || chr(10)
      || coalesce(d.text, '')) AS prompt_md5
FROM ctx c LEFT JOIN documents d ON d.doc_id = c.query_id""")
def q_assemble_context(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    idx = index_table(spark, sf_dir)
    queries = idx.select("key").join(docs.select(F.col("doc_id").alias("key"), "text"), "key", "left")
    ctx = rt.assemble_context(nearest(spark, sf_dir), queries, "key", F.col("text"))
    return ctx.select("query_id", F.md5("context").alias("context_md5"),
                      F.length("context").alias("context_chars"), F.md5("prompt").alias("prompt_md5"))


@query("index_upsert", "WITH " + E_SQL + """,
u AS (SELECT vec_id, 1 AS version, v FROM e
      UNION ALL SELECT vec_id, 2, [-x FOR x IN v] FROM e WHERE label = 0
      UNION ALL SELECT vec_id + 1000000, 2, v FROM e WHERE label = 1)
SELECT vec_id, version, round(list_sum([v[i] * i FOR i IN range(1, len(v) + 1)]), 6) + 0.0 AS checksum FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY version DESC) AS rk FROM u) WHERE rk = 1""")
def q_index_upsert(spark, sf_dir):
    return _upserted(spark, sf_dir).select("vec_id", "version", checksum("embedding"))


def _upserted(spark, sf_dir) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    base = e.select("vec_id", F.lit(1).alias("version"), "embedding")
    changed = e.filter(F.col("label") == 0).select(
        "vec_id", F.lit(2).alias("version"), F.transform("embedding", lambda x: -x).alias("embedding"))
    added = e.filter(F.col("label") == 1).select(
        (F.col("vec_id") + 1000000).alias("vec_id"), F.lit(2).alias("version"), "embedding")
    return rt.upsert(base, changed.unionByName(added), "vec_id", "version")


@query("collection_count", """
SELECT count(*) AS documents_indexed FROM (SELECT vec_id FROM embeddings
  UNION SELECT vec_id + 1000000 FROM embeddings WHERE label = 1)""")
def q_collection_count(spark, sf_dir):
    return _upserted(spark, sf_dir).agg(F.count(F.lit(1)).alias("documents_indexed"))


@query("smote", "WITH " + E_SQL + """,
cnt AS (SELECT count(*) FILTER (WHERE label = 0) AS n_min, count(*) FILTER (WHERE label <> 0) AS n_maj FROM e),
mino AS (SELECT vec_id, v, row_number() OVER (ORDER BY vec_id) AS o FROM e WHERE label = 0),
copies AS (SELECT m.vec_id, m.v, (c.i - 1) * n_min + m.o AS copy
           FROM mino m, cnt, range(1, (n_maj - n_min) // n_min + 2) c(i)
           WHERE (c.i - 1) * n_min + m.o <= n_maj - n_min),
d AS (SELECT q.vec_id AS query_id, i.vec_id AS neighbor_id,
        1 - list_dot_product(q.v, i.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(i.v, i.v)))
        AS distance FROM mino q JOIN mino i ON q.vec_id <> i.vec_id),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id)
        AS rank FROM d) WHERE rank <= 5),
pick AS (SELECT c.*, CAST(('0x' || substr(md5(CAST(c.vec_id AS VARCHAR) || '-' || CAST(c.copy AS VARCHAR)),
           1, 8)) AS BIGINT) % 5 + 1 AS rank,
         CAST(('0x' || substr(md5(CAST(c.vec_id AS VARCHAR) || '-u-' || CAST(c.copy AS VARCHAR)), 1, 8))
           AS BIGINT) / 4294967296.0 AS u FROM copies c),
s AS (SELECT p.vec_id AS parent, p.copy, p.v AS a, b.v AS b, p.u FROM pick p
      JOIN nn ON nn.query_id = p.vec_id AND nn.rank = p.rank JOIN mino b ON b.vec_id = nn.neighbor_id)
SELECT parent, CAST(copy AS BIGINT) AS copy, 0 AS label, round(a[1] + u * (b[1] - a[1]), 9) + 0.0 AS v0,
  round(list_sum([(a[i] + u * (b[i] - a[i])) * i FOR i IN range(1, len(a) + 1)]), 6) + 0.0 AS checksum FROM s""")
def q_smote(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings").withColumn("label", (F.col("label") != 0).cast("int"))
    s = fe.smote(e, "label", "vec_id", "embedding", minority=0, k=5)
    return s.select("parent", F.col("copy").cast("long").alias("copy"), "label",
                    r9(F.col("embedding")[0]).alias("v0"), checksum("embedding"))


# ------------------------------------------------------------------ intent and routing
def _kw_sql(col: str) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({col}, '')), '{k}')" for k in DRV_KEYWORDS) + ")"


@query("contains_any_keyword", f"""
SELECT conv_id, turn, {_kw_sql('text')} AS matched FROM conversations WHERE role = 'user'""")
def q_contains_any_keyword(spark, sf_dir):
    u = user_turns(spark, sf_dir)
    return u.select("conv_id", "turn", tx.contains_any("text", DRV_KEYWORDS).alias("matched"))


@query("classify_intent", f"""
SELECT conv_id, turn, CASE WHEN {_kw_sql('text')} THEN 'policy_question' ELSE 'general_question' END AS intent
FROM conversations WHERE role = 'user'""")
def q_classify_intent(spark, sf_dir):
    return rt.classify_intent(user_turns(spark, sf_dir), "text", DRV_KEYWORDS).select("conv_id", "turn", "intent")


@query("route", f"""
SELECT CASE WHEN {_kw_sql('text')} THEN 'retrieve_and_answer' ELSE 'direct_answer' END AS branch,
  count(*) AS n FROM conversations WHERE role = 'user' GROUP BY 1""")
def q_route(spark, sf_dir):
    c = rt.classify_intent(user_turns(spark, sf_dir), "text", DRV_KEYWORDS)
    branch = F.when(F.col("intent") == rt.POLICY, "retrieve_and_answer").otherwise("direct_answer")
    return c.groupBy(branch.alias("branch")).agg(F.count(F.lit(1)).alias("n"))


@query("direct_answer", f"""
SELECT conv_id * 1000 + turn AS query_id, '{rt.DIRECT_ANSWER}' AS answer, 0 AS n_sources,
  CAST(1.0 AS DOUBLE) AS confidence
FROM conversations WHERE role = 'user' AND NOT {_kw_sql('text')}""")
def q_direct_answer(spark, sf_dir):
    c = rt.classify_intent(user_turns(spark, sf_dir), "text", DRV_KEYWORDS)
    d = rt.direct_answers(c.filter(F.col("intent") == rt.GENERAL), "query_id")
    return d.select("query_id", "answer", F.size("sources").alias("n_sources"), "confidence")


@query("label_in_set", """
SELECT conv_id, turn, CASE WHEN lower(regexp_replace(role, '^\\s+|\\s+$', '', 'g')) IN ('user', 'assistant')
  THEN lower(regexp_replace(role, '^\\s+|\\s+$', '', 'g')) END AS label,
  CASE WHEN lower(regexp_replace(role, '^\\s+|\\s+$', '', 'g')) NOT IN ('user', 'assistant')
  THEN 'invalid label: ' || lower(regexp_replace(role, '^\\s+|\\s+$', '', 'g')) END AS error
FROM conversations""")
def q_label_in_set(spark, sf_dir):
    c = read_table(spark, sf_dir, "conversations")
    lab, err = rt.normalise_label("role", ("user", "assistant"))
    return c.select("conv_id", "turn", lab.alias("label"), err.alias("error"))


# ------------------------------------------------------------------ response validation
@query("validate_response", "WITH " + RAW_SQL + """
SELECT event_id, valid, CASE WHEN valid THEN conf END AS confidence FROM checked""")
def q_validate_response(spark, sf_dir):
    r = raw_responses(spark, sf_dir).withColumn("v", rt.validate_response("raw"))
    return r.select("event_id", F.col("v.valid").alias("valid"), F.col("v.confidence").alias("confidence"))


@query("first_valid_attempt", "WITH " + RAW_SQL + f""",
att AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY ts, event_id) AS attempt FROM checked),
best AS (SELECT query_id, min(attempt) AS attempt FROM att WHERE valid AND attempt <= 3 GROUP BY query_id)
SELECT q.query_id, b.attempt, coalesce(a.answer, '{rt.FAILED_ANSWER}') AS answer,
  coalesce(a.sources, '') AS sources, coalesce(a.conf, 0.0) AS confidence
FROM (SELECT DISTINCT query_id FROM raw) q LEFT JOIN best b USING (query_id)
LEFT JOIN att a ON a.query_id = b.query_id AND a.attempt = b.attempt""")
def q_first_valid_attempt(spark, sf_dir):
    r = rt.number_attempts(raw_responses(spark, sf_dir), "query_id", ["ts", "event_id"], limit=3)
    f = rt.first_valid_attempt(r, "query_id", "attempt", "raw")
    return f.select("query_id", "attempt", "answer", F.array_join("sources", ",").alias("sources"),
                    "confidence")


# ------------------------------------------------------------------ text embedding (rows-only)
@query("embed_text")
def q_embed_text(spark, sf_dir):
    docs = spread(read_table(spark, sf_dir, "documents"))  # one row group: spread before tokenising
    model = vx.fit_text_embedder(docs, "text")
    emb = vx.embed_text(model, docs, "text")
    return emb.select("doc_id", F.size("embedding").alias("dim"), r6(vx.norm("embedding")).alias("norm"))


def stored_index(spark, docs: DataFrame, model) -> DataFrame:
    """The documents' index as a stored (compressed) table, embedded once from whole texts.

    An answer shows the first ``SNIPPET_CHARS`` characters of a chunk; no more of its text is sent to the join and stored again.
    """
    path = scratch_path(spark, "static-index")
    shown = docs.select("doc_id", F.substring("text", 1, tx.SNIPPET_CHARS).alias("text"))
    rt.chunk_index(vx.embed_text(model, docs, "text").select("doc_id", "embedding"), shown, "doc_id", "embedding", "doc_id", "text") \
        .write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("answer_batch")
def q_answer_batch(spark, sf_dir):
    docs = spread(read_table(spark, sf_dir, "documents"))  # one row group: spread before tokenising
    model = vx.fit_text_embedder(docs, "text")
    index = stored_index(spark, docs, model)
    queries = vx.embed_text(model, user_turns(spark, sf_dir), "text", "qvec")
    out = rt.answer_batch(queries, index, "query_id", "text", "qvec", DRV_KEYWORDS)
    return out.select("query_id", "intent", "answer", F.array_join("sources", ",").alias("sources"),
                      "confidence")
