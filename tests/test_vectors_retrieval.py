"""kNN against numpy brute force; routing, answers and response validation."""

import json

import numpy as np
from pyspark.sql import functions as F

from lanthorn.operators import retrieval as rt
from lanthorn.operators import vectors as vx
from lanthorn.session import read_table

from conftest import SF_SMALL


def _brute(q, qi, m, mi, k, exclude_self):
    qn = q / np.linalg.norm(q, axis=1, keepdims=True)
    mn = m / np.linalg.norm(m, axis=1, keepdims=True)
    d = 1 - qn @ mn.T
    out = {}
    for r, a in enumerate(qi):
        cand = [(d[r, c], b) for c, b in enumerate(mi) if not (exclude_self and a == b)]
        out[a] = [b for _, b in sorted(cand)[:k]]
    return out


def test_knn_matches_brute_force_in_tiles(spark):
    e = read_table(spark, SF_SMALL, "embeddings")
    pdf = e.toPandas()
    mat = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
    ids = pdf["vec_id"].to_numpy()
    want = _brute(mat, ids, mat, ids, 3, True)
    spark.conf.set("lanthorn.knn.tileBytes", str(64 * 8 * 120))  # forces several tiles on both sides
    spark.conf.set("lanthorn.knn.index", "false")
    try:
        got = vx.knn(e, e, 3, "vec_id", "vec_id", "embedding", "embedding", exclude_self=True)
        rows = got.orderBy("query_id", "rank").collect()
    finally:
        spark.conf.unset("lanthorn.knn.tileBytes")
        spark.conf.unset("lanthorn.knn.index")
    per = {}
    for r in rows:
        per.setdefault(r["query_id"], []).append(r["neighbor_id"])
    assert per == {int(a): [int(x) for x in b] for a, b in want.items()}


def test_knn_ties_go_to_smaller_id_and_small_index(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "id long, v array<double>")
    ix = spark.createDataFrame([(7, [2.0, 0.0]), (5, [1.0, 0.0])], "id long, v array<double>")
    rows = vx.knn(q, ix, 3, "id", "id", "v", "v").orderBy("rank").collect()
    assert [r["neighbor_id"] for r in rows] == [5, 7]  # equal distance, fewer rows than k


def test_embedder_gives_unit_vectors(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    m = vx.fit_text_embedder(docs, "text", 64)
    norms = vx.embed_text(m, docs, "text").select(vx.norm("embedding").alias("n")).toPandas()["n"]
    assert np.allclose(norms[norms > 0], 1.0, atol=1e-5)


def test_intent_and_answers(spark):
    kw = rt.POLICY_KEYWORDS
    q = spark.createDataFrame([(1, "What is the DELIVERY fee?"), (2, "my item arrived damaged")],
                              "qid long, text string")
    idx = spark.createDataFrame([(10, "doc_10_chunk_01", "doc_10", "doc_10_chunk_01", "Free delivery over 149.\n",
                                  [1.0, 0.0], ("doc_10", "doc_10_chunk_01"))],
                                "key long, id string, document_id string, chunk_id string, text string, "
                                "embedding array<double>, metadata struct<document_id:string, chunk_id:string>")
    qv = q.withColumn("qvec", F.array(F.lit(1.0), F.lit(0.1)))
    out = {r["query_id"]: r for r in rt.answer_batch(qv, idx, "qid", "text", "qvec", kw).collect()}
    assert out[1]["intent"] == rt.POLICY and out[1]["sources"] == ["doc_10_chunk_01"]
    assert out[1]["answer"] == rt.ANSWER_PREFIX + "Free delivery over 149."
    assert out[2]["intent"] == rt.GENERAL and out[2]["sources"] == [] and out[2]["confidence"] == 1.0


def test_validate_response_cases(spark):
    cases = {
        json.dumps({"answer": "a", "sources": ["x"], "confidence": 0.5}): True,
        "not json": False,
        json.dumps({"answer": "a", "confidence": 0.5}): False,
        json.dumps({"answer": "a", "sources": [], "confidence": 1.2}): False,
        json.dumps({"answer": "a", "sources": [], "confidence": "0.5"}): True,
        json.dumps({"answer": 1, "sources": [], "confidence": 0.5}): False,
        json.dumps({"answer": "a", "sources": [1], "confidence": 0.5}): False,
        json.dumps({"answer": "a", "sources": [None], "confidence": 0.5}): False,
        json.dumps({"answer": "a", "sources": ["x", None], "confidence": 0.5}): False,
        json.dumps({"answer": "a", "sources": ["x", "y"], "confidence": True}): False,
    }
    df = spark.createDataFrame([(k,) for k in cases], "raw string")
    got = {r["raw"]: r["v"]["valid"] for r in df.select("raw", rt.validate_response("raw").alias("v")).collect()}
    assert got == cases


def test_first_valid_attempt(spark):
    ok = json.dumps({"answer": "fine", "sources": ["s"], "confidence": 0.9})
    rows = [(1, 1, "bad"), (1, 2, "bad"), (1, 3, ok), (2, 1, "bad"), (2, 2, "bad"), (2, 3, "bad"), (2, 4, ok)]
    df = spark.createDataFrame(rows, "q long, attempt int, raw string")
    got = {r["query_id"]: r for r in rt.first_valid_attempt(df, "q", "attempt", "raw", 3, ["fb"]).collect()}
    assert got[1]["attempt"] == 3 and got[1]["answer"] == "fine"
    assert got[2]["attempt"] is None and got[2]["confidence"] == 0.0 and got[2]["sources"] == ["fb"]


def test_upsert_is_idempotent(spark):
    base = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k long, version int, v string")
    upd = spark.createDataFrame([(2, 2, "B"), (3, 2, "c")], "k long, version int, v string")
    once = rt.upsert(base, upd, "k", "version")
    twice = rt.upsert(once, upd, "k", "version")
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r["k"]: r["v"] for r in once.collect()} == {1: "a", 2: "B", 3: "c"}


def test_answers_carry_no_more_of_a_text_than_they_show(spark):
    long = "\n start " + "x" * 300 + "tail"
    chunks = spark.createDataFrame([(1, 1, "a", long), (1, 2, "b", "tail " * 100), (2, 1, "c", None)],
                                   "query_id bigint, rank int, id string, text string")
    out = rt.answer_from_chunks(chunks)
    rows = {r["query_id"]: r for r in out.collect()}
    assert rows[1]["answer"] == rt.ANSWER_PREFIX + ("  start " + "x" * 300)[:200].strip() and rows[1]["sources"] == ["a", "b"]
    assert rows[2]["answer"] == rt.ANSWER_PREFIX
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    inside = plan[plan.index("collect_list"):]
    assert "substring" in inside


def test_stored_index_holds_of_a_text_what_answers_show(spark):
    from lanthorn.plans.support import stored_index

    docs = spark.createDataFrame([(1, "alpha " * 500), (2, "beta gamma"), (2, "beta gamma"), (None, "delta"), (3, None)], "doc_id bigint, text string")
    model = vx.fit_text_embedder(docs.fillna({"text": ""}), "text")
    index = stored_index(spark, docs, model)
    assert index.agg(F.max(F.length("text"))).first()[0] == 200
    rows = sorted((r["key"] or 0, r["n"]) for r in index.groupBy("key").agg(F.count("*").alias("n")).collect())
    assert rows == [(0, 1), (1, 1), (2, 4), (3, 1)]  # as chunk_index joins repeated and missing ids
    whole = vx.embed_text(model, docs, "text").where("doc_id = 1").first()["embedding"]
    assert index.where("key = 1").first()["embedding"] == whole  # the whole text is embedded
