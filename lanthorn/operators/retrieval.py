"""Intent routing, retrieval-backed answers and strict response validation.

Every step is a DataFrame job over a table of queries: one plan answers
all of them, and each query gets exactly one answer row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanthorn.functions import text as tx
from lanthorn.operators.ordinal import rank_within
from lanthorn.operators.nearest import VectorIndex
from lanthorn.operators.vectors import knn

# Fixed values of the assistant (the keyword list decides the intent).
POLICY_KEYWORDS = ["delivery", "return", "refund", "membership", "tracking", "cancel",
                   "gift card", "support hours"]
POLICY = "policy_question"
GENERAL = "general_question"
ANSWER_PREFIX = "Based on the retrieved context: "
DIRECT_ANSWER = "I can only answer policy questions right now."
FAILED_ANSWER = "ERROR: response failed schema validation after 3 attempts."
PROMPT_TEMPLATE = "CONTEXT:\n{context}\n\nQUESTION:\n{query}"


def classify_intent(queries: DataFrame, text: str, keywords: Sequence[str] = POLICY_KEYWORDS,
                    out: str = "intent") -> DataFrame:
    """policy_question when the lower-cased text contains any keyword."""
    return queries.withColumn(out, F.when(tx.contains_any(text, keywords), F.lit(POLICY))
                              .otherwise(F.lit(GENERAL)))


def normalise_label(col: str, allowed: Sequence[str] = (POLICY, GENERAL)) -> tuple[Column, Column]:
    """(label, error): strip+lower the label; error text when not allowed."""
    lab = tx.normalise(col)
    ok = lab.isin(*allowed)
    return (F.when(ok, lab), F.when(~F.coalesce(ok, F.lit(False)),
                                   F.concat(F.lit("invalid label: "), F.coalesce(lab, F.lit("null")))))


def chunk_index(vectors: DataFrame, docs: DataFrame, vec_id: str, vec: str, doc_id: str,
                text: str) -> DataFrame:
    """Index rows: id, document_id, chunk_id, text, embedding, metadata."""
    joined = vectors.join(docs.select(F.col(doc_id).alias("__d"), F.col(text).alias("text")),
                          F.col(vec_id) == F.col("__d"), "left")
    cid = tx.format_chunk_id(vec_id)
    did = tx.format_doc_id(vec_id)
    return joined.select(
        F.col(vec_id).alias("key"), cid.alias("id"), did.alias("document_id"), cid.alias("chunk_id"),
        "text", F.col(vec).alias("embedding"),
        F.struct(did.alias("document_id"), cid.alias("chunk_id")).alias("metadata"))


def retrieve(queries: DataFrame, index: DataFrame, query_key: str, query_vec: str, k: int = 3,
             exclude_self: bool = False, built: VectorIndex | None = None) -> DataFrame:
    """Top-k chunks per query with id, text and distance, ranked."""
    nn = knn(queries, index, k, query_key, "key", query_vec, "embedding", exclude_self, built)
    return nn.join(index.select(F.col("key").alias("neighbor_id"), "id", "text", "metadata"),
                   "neighbor_id")


def answer_from_chunks(chunks: DataFrame, k: int = 3) -> DataFrame:
    """Per query: answer from the top chunk, sources in rank order, confidence 1.0.

    ``collect_list`` per query is bounded by k, and holds of every text only the characters that a snippet can show.
    """
    shown = F.substring("text", 1, tx.SNIPPET_CHARS).alias("text")
    per = chunks.groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "id", shown))).alias("chunks"))
    top_text = F.element_at("chunks", 1)["text"]
    return per.select(
        "query_id",
        F.concat(F.lit(ANSWER_PREFIX), tx.snippet(F.coalesce(top_text, F.lit("")))).alias("answer"),
        F.transform("chunks", lambda c: c["id"]).alias("sources"),
        F.lit(1.0).alias("confidence"))


def assemble_context(chunks: DataFrame, queries: DataFrame, query_key: str, query_text: Column,
                     template: str = PROMPT_TEMPLATE) -> DataFrame:
    """Per query: 'Source: id\\ntext' blocks in rank order joined by a blank line,
    placed into the prompt template."""
    per = chunks.groupBy("query_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "id", "text"))).alias("chunks"))
    context = F.array_join(F.transform("chunks", lambda c: F.concat(
        F.lit("Source: "), c["id"], F.lit("\n"), F.coalesce(c["text"], F.lit("")))), "\n\n")
    q = queries.select(F.col(query_key).alias("query_id"), query_text.alias("__q"))
    head, rest = template.split("{context}")
    mid, tail = rest.split("{query}")
    return per.join(q, "query_id").select(
        "query_id", context.alias("context"),
        F.concat(F.lit(head), context, F.lit(mid), F.coalesce("__q", F.lit("")), F.lit(tail)).alias("prompt"))


def direct_answers(queries: DataFrame, query_key: str, answer: str = DIRECT_ANSWER) -> DataFrame:
    return queries.select(F.col(query_key).alias("query_id"), F.lit(answer).alias("answer"),
                          F.array().cast("array<string>").alias("sources"), F.lit(1.0).alias("confidence"))


def answer_batch(queries: DataFrame, index: DataFrame, query_key: str, text: str, query_vec: str,
                 keywords: Sequence[str] = POLICY_KEYWORDS, k: int = 3, built: VectorIndex | None = None) -> DataFrame:
    """Classify -> route -> retrieve-and-answer or direct answer, one row per query.

    ``built``: what ``vectors.knn_index`` made of ``index``, where many batches are answered from one index.
    """
    routed = classify_intent(queries, text, keywords)
    policy = routed.filter(F.col("intent") == POLICY)
    general = routed.filter(F.col("intent") == GENERAL)
    # no more of a text is sent to the join than an answer can show
    shown = index.withColumn("text", F.substring("text", 1, tx.SNIPPET_CHARS))
    answered = answer_from_chunks(retrieve(policy, shown, query_key, query_vec, k, built=built), k)
    # a policy query with an empty index gets an explicit error row; the answers are joined once
    asked = policy.select(F.col(query_key).alias("query_id")).join(answered, "query_id", "left").select(
        "query_id", F.coalesce("answer", F.lit("ERROR: no context retrieved")).alias("answer"),
        F.coalesce("sources", F.array().cast("array<string>")).alias("sources"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))
    return asked.withColumn("intent", F.lit(POLICY)).unionByName(direct_answers(general, query_key).withColumn("intent", F.lit(GENERAL)))


# ------------------------------------------------------------------ response validation
_NUMERIC = r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)"


def validate_response(raw: Column | str) -> Column:
    """Struct(valid, answer, sources, confidence) of a JSON response text.

    Valid when the text parses to an object with a string ``answer``, an
    array of strings ``sources`` (empty allowed, null elements not) and a
    ``confidence`` in [0, 1] given as a number or a numeric string (a
    boolean is none).  ``from_json`` would accept a number as the
    answer and a missing field as null, so the types are read from a
    variant instead.
    """
    v = F.try_parse_json(raw if isinstance(raw, Column) else F.col(raw))
    kind = lambda path: F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    is_obj = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    ans_ok = F.coalesce(kind("$.answer") == "STRING", F.lit(False))
    src_kind = kind("$.sources")
    items = F.try_variant_get(v, "$.sources", "array<variant>")
    every = F.forall(items, lambda x: F.coalesce(F.schema_of_variant(x) == "STRING", F.lit(False)))
    src_ok = F.coalesce(src_kind.startswith("ARRAY") & every, F.lit(False))
    conf_kind = kind("$.confidence")
    conf = F.when(conf_kind.rlike(_NUMERIC) | (conf_kind == "STRING"),
                  F.try_variant_get(v, "$.confidence", "double"))
    conf_ok = F.coalesce(conf.between(0.0, 1.0), F.lit(False))
    valid = is_obj & ans_ok & src_ok & conf_ok
    return F.struct(valid.alias("valid"),
                    F.when(valid, F.try_variant_get(v, "$.answer", "string")).alias("answer"),
                    F.when(valid, F.try_variant_get(v, "$.sources", "array<string>")).alias("sources"),
                    F.when(valid, conf).alias("confidence"))


def first_valid_attempt(attempts: DataFrame, query_key: str, attempt: str, raw: str,
                        max_attempts: int = 3, fallback_sources: Sequence[str] = (),
                        failed_answer: str = FAILED_ANSWER) -> DataFrame:
    """First valid response per query within ``max_attempts``; else an error row.

    ``min_by`` is an aggregate with map-side partial results, so a query
    with very many attempts does not gather them in one place.
    """
    checked = attempts.withColumn("__v", validate_response(raw))
    ok = checked.filter((F.col(attempt) <= max_attempts) & F.col("__v.valid"))
    best = ok.groupBy(query_key).agg(
        F.min_by(F.struct(F.col(attempt).alias("attempt"), F.col("__v.answer").alias("answer"),
                          F.col("__v.sources").alias("sources"),
                          F.col("__v.confidence").alias("confidence")), F.col(attempt)).alias("b"))
    keys = attempts.select(query_key).distinct()
    fb = F.array(*[F.lit(s) for s in fallback_sources]).cast("array<string>")
    return keys.join(best, query_key, "left").select(
        F.col(query_key).alias("query_id"), F.col("b.attempt").alias("attempt"),
        F.coalesce(F.col("b.answer"), F.lit(failed_answer)).alias("answer"),
        F.coalesce(F.col("b.sources"), fb).alias("sources"),
        F.coalesce(F.col("b.confidence"), F.lit(0.0)).alias("confidence"))


def number_attempts(events: DataFrame, query_key: str, order: Sequence[str], name: str = "attempt",
                    limit: int | None = None) -> DataFrame:
    """Attempt number per query along ``order``.

    With ``limit`` only that many attempts per query are numbered: each task keeps its own
    first ones before the shuffle (``WindowGroupLimit``), so nothing is sorted globally and a query with very many
    attempts sends a few.  Without, a distributed rank numbers them all.
    """
    if limit is None:
        return rank_within(events, [query_key], list(order), name)
    w = Window.partitionBy(query_key).orderBy(*order)
    return events.withColumn(name, F.row_number().over(w)).where(F.col(name) <= limit)


# ------------------------------------------------------------------ index maintenance
def upsert(current: DataFrame, updates: DataFrame, key: str, version: str) -> DataFrame:
    """Insert-or-replace by key: the highest version of every key survives.

    ``max_by`` aggregates with partial results per partition, so a key
    that receives a third of all updates is combined map-side.
    """
    both = current.unionByName(updates)
    cols = [c for c in both.columns if c != key]
    best = both.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(version)).alias("__b"))
    return best.select(key, *[F.col(f"__b.{c}").alias(c) for c in cols])
