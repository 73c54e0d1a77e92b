"""Removal of repeated byte strings: a distributed difference-cover scheme.

A byte goes when a string of ``length`` bytes covering it also starts anywhere else.  Which suffixes share their
first ``length`` bytes is found as in difference-cover suffix sorting:

1. *Sample.*  Positions of a text whose residue modulo v lies in a difference cover D.  Any two positions
   have a common shift d < v that takes both into the sample, so two equal strings of ``length`` bytes contain, at
   one and the same shift, two sampled blocks of ``length - v + 1`` bytes that are equal.
2. *Name and sort.*  The blocks' names (64-bit hashes; only equality is needed, so hash order serves)
   are dealt by their leading bits, sorted, and neighbours compared.  A unique name rules out
   every string that contains its block at such a shift; repeated names go on.
3. *Merge the remaining suffixes.*  A position stays in play if a repeated sampled block lies within v
   bytes after it.
4. *Compare prefixes.*  The ``length``-byte prefixes of the positions in play are dealt, sorted, and neighbours
   compared the same way; equal ones mark their positions, and marked strings cover the bytes that go.

The prefix is bounded, so one level of names replaces the recursion.  Equal whole texts are named first: only
one of them takes part in step 3 and 4, and all of them go.

Texts are packed into chunks (compressed, written once); every exchange sends a chunk's *distinct* names, so a string that
occurs in a third of all texts is sent once per chunk, and gets back one bit per name.  Nothing is collected.

Defined cases: null text counts as empty; texts shorter than ``length`` keep all bytes; matches never cross
documents; repeated rows are repeated texts; an empty table gives an empty result; extra columns are not read; null ids are
returned.  A text longer than a chunk is a chunk of its own; memory follows the longest text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanthorn.llm import textbuf as tb
from lanthorn.llm.common import id_and_bytes, release, written

LENGTH = 200
CHUNK_BYTES = 1 << 20
NAMES_PER_BUCKET = 1_500_000
#: perfect difference sets modulo q*q + q + 1
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 31: (0, 1, 3, 8, 12, 18), 57: (0, 1, 3, 13, 32, 36, 43, 52),
          133: (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)}
CHUNK = "chunk bigint, ids array<bigint>, sizes array<bigint>, packed binary"
BLOB = "kind int, bucket int, chunk bigint, names binary"
REPLY = "kind int, bucket int, chunk bigint, bits binary"
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, removed array<struct<s:bigint,e:bigint>>"
TEXTS, BLOCKS, PREFIXES = 0, 1, 2
#: bytes of a name sent besides its bucket bits; a bucket's size is bounded, so its chance of a false match is, too:
#: blocks may match falsely (the prefixes decide), prefixes do so with about 1e-11 per position, whatever the corpus
_WIDTH = {TEXTS: 8, BLOCKS: 5, PREFIXES: 7}


def cover_for(length: int) -> tuple[int, tuple[int, ...]]:
    """The longest cover whose blocks keep a third of ``length``."""
    v = max(v for v in COVERS if v == 1 or 3 * (length - v + 1) >= length)
    return v, COVERS[v]


def chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Whole texts packed into compressed chunks; a chunk's number is fixed when it is written."""

    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        squeeze = zstandard.ZstdCompressor(level=6)
        for b in batches:
            for x in tb.slices(b, "text", chunk_bytes):
                ids = b.column(0).slice(x.first, x.n).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 32 | n]), pa.array([ids], pa.list_(pa.int64())),
                     pa.array([(x.ends - x.starts).tolist()], pa.list_(pa.int64())),
                     pa.array([squeeze.compress(x.buf.tobytes())], pa.binary())],
                    names=["chunk", "ids", "sizes", "packed"])
                n += 1

    return docs.mapInArrow(run, CHUNK)


class Chunk:
    """One chunk's texts and the names that the steps derive from them."""

    def __init__(self, sizes: list[int], packed: bytes, length: int):
        self.length = length
        ends = np.cumsum(np.array(sizes, dtype=np.int64))
        starts = ends - np.array(sizes, dtype=np.int64)
        raw = zstandard.ZstdDecompressor().decompress(packed) if len(ends) and ends[-1] else b""
        self.x = tb.Texts(np.frombuffer(raw, dtype=np.uint8), starts, ends, 0)
        self.h = self.x.prefix_hash()

    def whole_texts(self) -> np.ndarray:
        raw = self.x.buf.tobytes()
        return np.array([int.from_bytes(hashlib.blake2b(raw[s:e], digest_size=8).digest(), "little")
                         for s, e in zip(self.x.starts.tolist(), self.x.ends.tolist())], dtype=tb.U64)

    def sampled(self) -> np.ndarray:
        """Sampled positions with a whole block before their text's end."""
        v, cover = cover_for(self.length)
        block = self.length - v + 1
        longest = int((self.x.ends - self.x.starts).max(initial=0))
        pattern = np.zeros(longest + v, dtype=bool)
        for d in cover:
            pattern[d::v] = True
        mask = np.zeros(len(self.x.buf), dtype=bool)
        for s, e in zip(self.x.starts.tolist(), self.x.ends.tolist()):
            if e - s >= self.length:
                mask[s:e - block + 1] = pattern[: e - s - block + 1]
        return np.flatnonzero(mask)

    def blocks(self, at: np.ndarray) -> np.ndarray:
        v, _ = cover_for(self.length)
        return tb.span_hash(self.h, at, at + self.length - v + 1)

    def in_play(self, at: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """Positions with one of the sampled positions ``at`` less than v after them; not in texts ``skip``."""
        v, _ = cover_for(self.length)
        owner = np.searchsorted(self.x.ends, at, side="right")
        at, owner = at[~skip[owner]], owner[~skip[owner]]
        low = np.maximum(at - v + 1, self.x.starts[owner])
        high = np.minimum(at, self.x.ends[owner] - self.length)
        ok = low <= high
        return np.flatnonzero(covered(len(self.x.buf), low[ok], high[ok] + 1))

    def prefixes(self, at: np.ndarray) -> np.ndarray:
        return tb.span_hash(self.h, at, at + self.length)


def covered(n: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the ranges."""
    step = np.bincount(start, minlength=n + 1)
    step -= np.bincount(stop, minlength=n + 1)
    return np.cumsum(step[:n], out=step[:n]) > 0


def split(names: np.ndarray, buckets: int):
    """Distinct names in order, where each name is among them, whether it occurs twice here, bucket borders."""
    u, back = np.unique(names, return_inverse=True)
    twice = np.bincount(back, minlength=len(u)) > 1
    shift = tb.U64(64 - buckets.bit_length() + 1)
    border = np.searchsorted(u >> shift, np.arange(buckets + 1)) if buckets > 1 else np.array([0, len(u)])
    return u, back, twice, border


def blobs(chunk: int, kind: int, names: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row per bucket: a chunk's distinct names, ``_WIDTH`` leading bytes after the bucket bits."""
    u, _, _, border = split(names, buckets)
    left = (u << tb.U64(buckets.bit_length() - 1)).view(np.uint8).reshape(-1, 8)[:, 8 - _WIDTH[kind]:]
    used = np.flatnonzero(np.diff(border)) if len(u) else []
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(used), kind), pa.int32()), pa.array(used, pa.int32()), pa.array(np.full(len(used), chunk), pa.int64()),
         pa.array([left[border[k]:border[k + 1]].tobytes() for k in used], pa.binary())],
        names=["kind", "bucket", "chunk", "names"])


def _compare(table: pa.Table) -> pa.Table:
    """Sort one bucket's names and compare neighbours; a bit per sent name tells whether another chunk has it."""
    kind = table.column("kind")[0].as_py()
    names, owners = table.column("names").to_pylist(), table.column("chunk").to_pylist()
    width = _WIDTH[kind]
    size = np.array([len(n) // width for n in names], dtype=np.int64)
    wide = np.zeros((int(size.sum()), 8), dtype=np.uint8)
    wide[:, 8 - width:] = np.frombuffer(b"".join(names), dtype=np.uint8).reshape(-1, width)
    value = wide.view(tb.U64).reshape(-1)
    order = np.argsort(value)
    same = value[order[1:]] == value[order[:-1]]
    flag = np.zeros(len(value), dtype=bool)
    flag[order[1:][same]] = True
    flag[order[:-1][same]] = True
    # the first of equal whole texts, by chunk, is not marked as a later copy: it stands for all of them
    rows = [(o, flag[e - s:e]) for o, s, e in zip(owners, size.tolist(), np.cumsum(size).tolist())]
    first = np.zeros(len(value), dtype=bool)
    if kind == TEXTS and len(value):
        owner = np.repeat(np.array(owners, dtype=np.int64), size)
        by = np.lexsort((owner, value))
        new = np.ones(len(by), dtype=bool)
        new[1:] = value[by[1:]] != value[by[:-1]]
        first[by[new]] = True
    out = [(o, np.packbits(f).tobytes() + (np.packbits(~first[e - s:e]).tobytes() if kind == TEXTS else b""))
           for (o, f), s, e in zip(rows, size.tolist(), np.cumsum(size).tolist()) if f.any()]
    return pa.table({"kind": pa.array([kind] * len(out), pa.int32()),
                     "bucket": pa.array([table.column("bucket")[0].as_py()] * len(out), pa.int32()),
                     "chunk": pa.array([o for o, _ in out], pa.int64()), "bits": pa.array([b for _, b in out], pa.binary())})


def exchanged(sent: DataFrame, name: str) -> DataFrame:
    """Replies to the sent blobs, written."""
    return written(sent.groupBy("kind", "bucket").applyInArrow(_compare, REPLY), name)


def flags(replies, kind: int, border: np.ndarray, second: bool = False) -> np.ndarray:
    """The reply bits of a kind, placed at the distinct names they answer."""
    out = np.zeros(int(border[-1]), dtype=bool)
    for r in replies or ():
        if r["kind"] == kind:
            lo, hi = int(border[r["bucket"]]), int(border[r["bucket"] + 1])
            bits = np.frombuffer(r["bits"], dtype=np.uint8)
            half = (hi - lo + 7) // 8
            out[lo:hi] = np.unpackbits(bits[half:] if second else bits[:half])[: hi - lo].astype(bool)
    return out


def text_copies(c: Chunk, replies, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: whether an equal text is anywhere else, and whether another one stands for it."""
    u, back, twice, border = split(c.whole_texts(), buckets)
    copies = flags(replies, TEXTS, border)
    later = (copies & flags(replies, TEXTS, border, second=True))[back]
    inside = np.ones(len(back), dtype=bool)
    _, first = np.unique(back, return_index=True)
    inside[first] = False
    return (copies | twice)[back], later | inside


def positions(c: Chunk, replies, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(copied texts, positions in play) after the first exchange."""
    at = c.sampled()
    _, back, twice, border = split(c.blocks(at), buckets)
    repeated = (flags(replies, BLOCKS, border) | twice)[back]
    copied, stand_in = text_copies(c, replies, buckets)
    return copied, c.in_play(at[repeated], stand_in)


def _answered(chunked: DataFrame, replies: DataFrame) -> DataFrame:
    """Chunks beside the array of their replies (bounded by kinds times buckets)."""
    per = replies.groupBy(F.col("chunk").alias("of")).agg(F.collect_list(F.struct("kind", "bucket", "bits")).alias("replies"))
    return chunked.join(per.hint("merge"), F.col("chunk") == F.col("of"), "left").select("chunk", "ids", "sizes", "packed", "replies")


def _rows(batch: pa.RecordBatch):
    for i in range(batch.num_rows):
        yield {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   chunk_bytes: int = CHUNK_BYTES, names_per_bucket: int = NAMES_PER_BUCKET) -> DataFrame:
    """Per document: bytes, bytes and spans removed, hash of what is kept, and the removed byte ranges."""
    spark = docs.sparkSession
    chunked = written(chunks(id_and_bytes(docs, id_col, text_col), chunk_bytes), "repeat-chunks")
    v, cover = cover_for(length)
    total = chunked.select(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, s: a + s))).first()[0] or 0
    buckets = 1 << max(int(total * len(cover) / v / names_per_bucket), 1).bit_length()
    wide = min(buckets * 4, 1 << 20)

    def first(batches):
        for b in batches:
            for row in _rows(b):
                c = Chunk(row["sizes"], row["packed"], length)
                yield blobs(row["chunk"], TEXTS, c.whole_texts(), buckets)
                yield blobs(row["chunk"], BLOCKS, c.blocks(c.sampled()), buckets)

    def second(batches):
        for b in batches:
            for row in _rows(b):
                c = Chunk(row["sizes"], row["packed"], length)
                _, at = positions(c, row["replies"], buckets)
                yield blobs(row["chunk"], PREFIXES, c.prefixes(at), wide)

    def last(batches):
        for b in batches:
            for row in _rows(b):
                c = Chunk(row["sizes"], row["packed"], length)
                copied, at = positions(c, row["replies"], buckets)
                _, back, twice, border = split(c.prefixes(at), wide)
                at = at[(flags(row["replies"], PREFIXES, border) | twice)[back]]
                yield _result(c, row["ids"], copied, at)

    one = exchanged(chunked.mapInArrow(first, BLOB), "repeat-blocks")
    release(spark)
    two = exchanged(_answered(chunked, one).mapInArrow(second, BLOB), "repeat-prefixes")
    release(spark)
    return _answered(chunked, one.union(two)).mapInArrow(last, RESULT)


def _result(c: Chunk, ids, copied: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    x = c.x
    gone = covered(len(x.buf), at, at + c.length)
    for i in np.flatnonzero(copied & (x.ends - x.starts >= c.length)):
        gone[x.starts[i]:x.ends[i]] = True
    s, e, d = x.runs(gone)
    count = np.bincount(d, minlength=x.n)
    offsets = np.concatenate([[0], np.cumsum(count)])
    shas = []
    for i in range(x.n):
        part = x.buf[x.starts[i]:x.ends[i]]
        shas.append(hashlib.sha256((part[~gone[x.starts[i]:x.ends[i]]] if count[i] else part).tobytes()).hexdigest())
    spans = pa.StructArray.from_arrays([tb.long_column(s - x.starts[d]), tb.long_column(e - x.starts[d])], names=["s", "e"])
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), tb.long_column(x.ends - x.starts), tb.long_column(x.count_in(gone)), tb.long_column(count),
         pa.array(shas, pa.string()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)],
        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])
