"""Document fingerprints by locally consistent parsing.

Deterministic coin tossing labels every symbol by the lowest bit in which it differs from
its left neighbour; four rounds leave six labels, and local label maxima cut
the text into phrases.  A phrase's name (a hash of its symbols) is one symbol of the
next level.  A cut depends on a few neighbours only, so equal substrings get the same phrases
inside, wherever they lie.  Runs of one symbol are collapsed to (symbol, length) first, so
neighbours always differ.

The fingerprint keeps the smallest distinct names of the third level (phrases of about 40
bytes), and of the second and first level where a text has few above.  Likeness is the
bottom-k estimate of the Jaccard index of two texts' names on one level.

Defined cases: null text counts as empty; an empty text has the empty fingerprint, is alike (1) to
an empty text and unlike (0) to any other; equal texts have equal fingerprints and likeness 1;
repeated ids are ordered by text; null ids come last; a single document is its own next; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanthorn.llm import textbuf as tb
from lanthorn.llm.common import id_and_bytes

LEVELS = 3
KEEP = (16, 24, 32)  # names kept on level 1, 2, 3
ENOUGH = 8
GROUP_BYTES = 2 << 20
SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _coin_table(size: int) -> np.ndarray:
    """Label of (left, own) for symbols below ``size``: 2 * lowest differing bit + own bit there."""
    left, own = np.meshgrid(np.arange(size), np.arange(size), indexing="ij")
    v = left ^ own
    low = np.where(v > 0, np.log2(np.maximum(v & -v, 1)), 0).astype(np.int64)
    return (2 * low + ((own >> low) & 1)).astype(np.uint8).reshape(-1)


_BYTES = _coin_table(256)
_SMALL = _coin_table(128)


def _labels(y: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Coin tossing until six labels are left; neighbours inside a text stay different."""
    out = np.empty(len(y), dtype=np.uint8)
    if y.dtype == np.uint8:
        wide = y.astype(np.uint16)
        out[1:] = _BYTES[(wide[:-1] << np.uint16(8)) | wide[1:]]
    else:
        v = y[1:] ^ y[:-1]
        low = np.bitwise_count((v & (~v + tb.U64(1))) - tb.U64(1))
        low[v == 0] = 0
        out[1:] = 2 * low + ((y[1:] >> low.astype(tb.U64)) & tb.U64(1)).astype(np.uint8)
    at = np.flatnonzero(first)
    out[at] = (y[at] & y.dtype.type(1)).astype(np.uint8)
    for _ in range(3):
        wide = out.astype(np.uint16)
        new = np.empty_like(out)
        new[1:] = _SMALL[(wide[:-1] << np.uint16(7)) | wide[1:]]
        new[at] = out[at] & 1
        out = new
    return out


def phrases(x: np.ndarray, first: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of a level, and which of them begin a text."""
    keep = first.copy()
    keep[1:] |= x[1:] != x[:-1]
    at = np.flatnonzero(keep)
    y, start = x[at], first[at]
    run = np.diff(np.append(at, len(x))).astype(tb.U64)
    label = _labels(y, start)
    cut = start.copy()
    cut[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~start[2:]
    own = tb.TABLE[0][y] if y.dtype == np.uint8 else y
    own = tb.mix(own + run * tb.U64(0x9FB21C651E98DF25))
    h = tb.prefix_sums(own, own % tb.PRIME)
    s = np.flatnonzero(cut)
    e = np.append(s[1:], len(own))
    return tb.mix(tb.span_hash(h, s, e) + tb.U64(level)), start[s]


def signatures(texts: list[bytes]) -> list[tuple[tuple[int, ...], ...]]:
    """Per text: the smallest distinct 32-bit names of levels 1, 2 and 3 (empty where not kept)."""
    n = len(texts)
    out = [[(), (), ()] for _ in texts]
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=n)
    full = np.flatnonzero(lengths)
    if not len(full):
        return [tuple(o) for o in out]
    x = np.frombuffer(b"".join(texts), dtype=np.uint8)
    first = np.zeros(len(x), dtype=bool)
    first[np.cumsum(lengths[full]) - lengths[full]] = True
    names, owners = [], []
    for level in range(LEVELS):
        x, first = phrases(x, first, level)
        names.append(x)
        owners.append(full[np.cumsum(first) - 1])
    wanted = np.ones(n, dtype=bool)
    for level in range(LEVELS - 1, -1, -1):
        got = wanted[owners[level]]
        name = (names[level][got] >> tb.U64(32)).astype(np.int64)
        key = np.unique((owners[level][got] << 32) | name)
        owner = key >> 32
        count = np.bincount(owner, minlength=n)
        begin = np.cumsum(count) - count
        small = (key & 0xFFFFFFFF).tolist()
        for i in np.flatnonzero(wanted & (count > 0)):
            out[i][level] = tuple(small[begin[i]: begin[i] + min(count[i], KEEP[level])])
        wanted &= count < KEEP[level]
    return [tuple(o) for o in out]


def written_form(sig) -> str:
    """Levels 3, 2, 1 joined by ``.``; eight hex digits a name."""
    if not any(sig):
        return ""
    return ".".join("".join(f"{v:08x}" for v in level) for level in reversed(sig))


def likeness(a, b) -> float:
    """Bottom-k Jaccard estimate on the highest level on which both have enough names, else the lowest common one."""
    if not any(a) or not any(b):
        return float(a == b)
    level = next((k for k in range(LEVELS - 1, -1, -1) if min(len(a[k]), len(b[k])) >= ENOUGH), None)
    if level is None:
        level = next((k for k in range(LEVELS) if a[k] and b[k]), LEVELS - 1)
    x, y = a[level], b[level]
    k = min(KEEP[level], max(len(x), len(y)))
    union = sorted({*x, *y})[:k]
    both = {*x} & {*y}
    return sum(v in both for v in union) / len(union) if union else 0.0


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows placed so that each document is followed by its next one, in blocks of descending ids.

    Block borders are quantiles of the ids (one per shuffle partition).  The first
    document of a block is also sent, as a visitor, to the block that it follows, so one shuffle is enough.
    """
    spark = docs.sparkSession
    base = id_and_bytes(docs, id_col, text_col)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = [i / parts for i in range(1, parts)] or [0.5]
    found = base.select(F.percentile_approx("doc_id", F.array(*map(F.lit, share)), 100 * parts).alias("q")).first()["q"]
    borders = np.array(sorted(set(found or [])), dtype=np.int64)  # one per shuffle partition at most

    def blocks(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        known = np.asarray(ids.is_valid())
        value = np.asarray(ids.fill_null(0), dtype=np.int64)
        return np.where(known, np.searchsorted(borders, value, side="right"), 0), value

    def tops(batches):
        for b in batches:
            block, value = blocks(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), b.column(0)], names=["block", "doc_id"])

    top = {r["block"]: r["top"] for r in base.select("doc_id").mapInArrow(tops, "block bigint, doc_id bigint")
           .groupBy("block").agg(F.max("doc_id").alias("top")).collect()}  # one row per block
    order = sorted(top)
    goes = {top[b]: order[(i + 1) % len(order)] for i, b in enumerate(order) if top[b] is not None}

    def place(batches):
        for b in batches:
            block, value = blocks(b.column(0))
            known = np.asarray(b.column(0).is_valid())
            away = [i for i in np.flatnonzero(known) if int(value[i]) in goes]
            for rows, to, visitor in ((None, block, 0), (away, [goes[int(value[i])] for i in away], 1)):
                part = b if rows is None else b.take(pa.array(rows, pa.int64()))
                if part.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array(np.asarray(to), pa.int64()),
                         pa.array(np.full(part.num_rows, visitor), pa.int32())],
                        names=["doc_id", "text", "block", "visitor"])

    return (base.mapInArrow(place, "doc_id bigint, text binary, block bigint, visitor int")
            .repartition(parts, "block")
            .sortWithinPartitions("block", "visitor", F.col("doc_id").desc_nulls_last(), "text"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its fingerprint, its edited text's, and their likeness (see the query)."""

    def run(batches):
        held, size = [], 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                held.append((row[0], row[1] or b"", row[2], row[3]))
                size += len(held[-1][1])
                if size >= GROUP_BYTES and len(held) > 1:
                    yield _rows(held)
                    held, size = held[-1:], len(held[-1][1])
        if held:
            yield _rows(held, True)

    return neighbours(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def _rows(held, last: bool = False) -> pa.RecordBatch:
    """Results of all held rows but the last one, which follows them (of it too, if it ends the part)."""
    follows, only = [], {}
    for i, (_, _, block, _) in enumerate(held):
        only.setdefault(block, i)
        has_next = i + 1 < len(held) and held[i + 1][2] == block
        follows.append(i + 1 if has_next else None)
    work = [i for i, row in enumerate(held) if not row[3] and (last or i < len(held) - 1)]
    texts = [row[1].decode("utf-8", "replace") for row in held]
    edited = {}
    for i in work:
        j = i if follows[i] is None else follows[i]  # a lone document is its own next
        half = len(texts[i]) // 2
        edited[i] = (texts[i][: len(texts[i]) - half] + texts[j][:half]).encode()
    sigs = signatures([row[1] for row in held])
    esigs = signatures([edited[i] for i in work])
    cols = [[], [], [], [], [], [], []]
    for i, es in zip(work, esigs):
        j = i if follows[i] is None else follows[i]
        for c, v in zip(cols, (held[i][0], len(texts[i]), hashlib.sha256(edited[i]).hexdigest(), written_form(sigs[i]),
                               written_form(es), likeness(sigs[i], es), likeness(sigs[i], sigs[j]))):
            c.append(v)
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      names=[c.split()[0] for c in SCHEMA.split(", ")])
