"""Quality rules: base counts and a hashed n-gram log-likelihood ratio.

The corpus and a trusted part of it are two multinomials over hashed word
unigrams and bigrams.  A document's verdict is its mean log ratio of the two,
per n-gram, against a fixed threshold.  Both multinomials are counted over every
document; each task keeps one vector of ``buckets`` counts, so memory and
traffic do not depend on the corpus.

Defined cases: null text counts as empty; without words every count is 0 and
the document fails the base rules; repeated rows are counted and returned as
often as they occur; an empty corpus gives a ratio of 0 everywhere and an empty
result; only ``id_col`` and ``text_col`` of the input are read, so extra
columns never clash; a null id is returned and is never trusted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanthorn.llm import textbuf as tb
from lanthorn.llm.common import count_blobs, id_and_bytes, summed_counts

BUCKETS = 1 << 18
SMOOTHING = 5.0
THRESHOLD = -0.16
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SLICE_BYTES = 1 << 20
COUNT_SLICES = 32
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, base_failed boolean, llr double, kept boolean")


def ngrams(x: tb.Texts, buckets: int):
    """Bucket and text index of every word unigram and bigram, and the word arrays."""
    s, e, d = x.words()
    h = tb.span_hash(x.prefix_hash(), s, e)
    same = d[1:] == d[:-1]
    pairs = tb.chain([h[:-1], h[1:]])[same]
    grams = np.concatenate([h, pairs]) & tb.U64(buckets - 1)
    return grams.astype(np.int64), np.concatenate([d, d[1:][same]]), (s, e, d, h)


def fit_ratio(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> np.ndarray:
    """log(target / raw) per bucket; ``trusted`` holds the ids of the trusted documents.

    ``buckets`` must be a power of two; the driver holds two vectors of that length.
    The target count is compared with its expectation under the raw corpus, both plus
    ``smoothing``, so a bucket seen a few times stays near 0.
    """
    marks = trusted.select(F.col(id_col).cast("bigint").alias("doc_id")).where("doc_id is not null").distinct()
    marks = marks.withColumn("trusted", F.lit(True)).hint("merge")  # both sides grow with the corpus
    flagged = id_and_bytes(docs, id_col, text_col).join(marks, "doc_id", "left")

    def count(batches):
        total = np.zeros(2 * buckets, dtype=np.int64)
        for batch in batches:
            flags = np.asarray(batch.column(1).fill_null(False).to_numpy(zero_copy_only=False), dtype=bool)
            for x in tb.slices(batch, "text", SLICE_BYTES):
                grams, d, _ = ngrams(x, buckets)
                total[:buckets] += np.bincount(grams, minlength=buckets)
                total[buckets:] += np.bincount(grams[flags[x.first + d]], minlength=buckets)
        yield count_blobs(total, 2 * COUNT_SLICES)

    blobs = flagged.select("text", "trusted").mapInArrow(count, "slice int, counts binary")
    total = summed_counts(blobs, 2 * buckets, 2 * COUNT_SLICES).astype(np.float64)
    raw, target = total[:buckets], total[buckets:]
    share = target.sum() / max(raw.sum(), 1.0)
    return np.log((target + smoothing) / (raw * share + smoothing))


def measure(x: tb.Texts, ratio: np.ndarray) -> dict[str, np.ndarray]:
    """Base counts and mean log ratio of each text of a slice."""
    grams, gd, (s, e, d, h) = ngrams(x, len(ratio))
    n = x.n
    n_words = np.bincount(d, minlength=n)
    mask = tb.IS_WORD[x.buf]
    chars = x.count_in(mask & ((x.buf & 0xC0) != 0x80))
    symbols = x.count_in(SYMBOLS[x.buf])
    ls, le, ld = x.runs(x.buf != 10)
    words_before = np.searchsorted(s, np.stack([ls, le]))
    has_word = words_before[1] > words_before[0]
    ls, le, ld = ls[has_word], le[has_word], ld[has_word]
    lines = tb.chain([tb.span_hash(x.prefix_hash(), ls, le), ld.astype(tb.U64)])
    _, first = np.unique(lines, return_index=True)
    dup_lines = np.bincount(ld, minlength=n) - np.bincount(ld[first], minlength=n)
    repeat = np.zeros(n, dtype=np.int64)
    if len(h) >= 3:
        ok = np.flatnonzero(d[2:] == d[:-2])
        keys = tb.chain([h[:-2], h[1:-1], h[2:], d[2:].astype(tb.U64)])[ok]
        order = np.argsort(keys)
        k = keys[order]
        twice = np.zeros(len(k), dtype=bool)
        twice[1:] = k[1:] == k[:-1]
        twice[:-1] |= twice[1:]
        at = ok[order[twice]]
        covered = np.zeros(len(h), dtype=bool)
        for j in range(3):
            covered[at + j] = True
        repeat = np.bincount(d[covered], minlength=n)
    total = np.bincount(gd, weights=ratio[grams], minlength=n)
    llr = total / np.maximum(np.bincount(gd, minlength=n), 1)
    return {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup_lines,
            "n_repeat_words": repeat, "llr": llr}


def apply_rules(docs: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per document: base counts, ``base_failed``, ``llr`` and the verdict ``kept``."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)  # len(ratio) doubles, fixed by the bucket parameter

    def run(batches):
        for batch in batches:
            for x in tb.slices(batch, "text", SLICE_BYTES):
                m = measure(x, shared.value)
                failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
                kept = ~failed & (m["llr"] >= threshold)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(x.first, x.n),
                     *(tb.long_column(m[c]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                     pa.array(failed), pa.array(m["llr"]), pa.array(kept)],
                    names=[c.split()[0] for c in SCHEMA.split(", ")])

    return id_and_bytes(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def drop_rejected(docs: DataFrame, ratio: np.ndarray, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that the rules reject; the verdict is taken as the rows pass, without a join."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    extra = "bytes_of_" + "_".join(docs.columns)

    def run(batches):
        for batch in batches:
            kept = [np.zeros(0, dtype=bool)]
            for x in tb.slices(batch, extra, SLICE_BYTES):
                m = measure(x, shared.value)
                failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
                kept.append(~failed & (m["llr"] >= threshold))
            yield batch.filter(pa.array(np.concatenate(kept))).select(batch.schema.names[:-1])

    return docs.withColumn(extra, F.col(text_col).cast("binary")).mapInArrow(run, docs.schema)
