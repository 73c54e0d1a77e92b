"""Ranked lexical search by branch and bound over frequency-ordered document trees.

The terms of a block of items make a vocabulary, and every text is cut down to its vector of those terms and
their counts.  A task gathers such vectors into blocks.  In a block the vectors, their terms in order of falling
document frequency, share the paths of a trie: documents are sorted by their vectors, the longest common
prefixes of neighbours give the inner nodes, and documents with one vector and one length share a leaf.  A node
holds, for every term, the largest count below it (subtree tf maxima) and the smallest length factor
below it (m minimum).  A score grows with each count and falls with the factor, so both together bound all scores below;
at a leaf the bound is the score.  For each item the tree is walked depth first, best bounds first, and a node
is entered only while its bound reaches the item's k-th best score of the task so far.  The tasks' k best
rows per item meet in one window.

Items come in blocks of at most ``VOCABULARY`` distinct terms (one item at least), each block searched over all
documents; nothing else bounds their number.  A block of documents has as many rows as ``CELLS`` cells of its
tables allow.

Defined cases: null and empty texts, and texts without terms, are never found and do not count among the
documents; equal item rows count as one, items of one id with several texts are ranked each by itself; an item
without terms finds nothing; repeated rows are separate documents; a null doc_id comes after all others among equal scores;
empty tables give an empty result; extra columns are not read.  One whole text is held at a time.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanthorn.llm.common import count_blobs, id_and_bytes, summed_counts, written

K = 10
VOCABULARY = 1 << 14
CELLS = 1 << 24
#: nodes with so few documents are not divided further
BUCKET = 8
#: nodes entered together
FRONT = 64
#: bytes outside terms become blanks, A-Z lower case; bytes from 0x80 on belong to terms
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
LENGTH_SHARE = 75
SCALE = 10 ** 9

VECTORS = "doc_id bigint, n bigint, terms binary, tfs binary"
BEST = "item_no int, doc_id bigint, score bigint"


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def weight(total: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1)))


def item_blocks(items: DataFrame, id_col: str, text_col: str, vocabulary: int = VOCABULARY):
    """Lists of (item_id, Counter of terms); the driver holds one block at a time."""
    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("binary").alias("text")).distinct()
    block, known = [], set()
    for row in rows.toLocalIterator():
        terms = Counter(terms_of(bytes(row["text"]) if row["text"] is not None else None))
        if not terms:
            continue
        if block and len(known | terms.keys()) > vocabulary:
            yield block
            block, known = [], set()
        block.append((row["item_id"], terms))
        known |= terms.keys()
    if block:
        yield block


def restricted(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, tfs) of every text: its length in terms, and the vocabulary's terms in it with their counts."""
    import numpy as np
    import pyarrow as pa

    def cut(batches):
        for b in batches:
            n, terms, tfs = [], [], []
            for text in b.column(1):
                words = terms_of(text.as_py())
                counts = Counter(map(vocabulary.get, words))
                counts.pop(None, None)
                n.append(len(words))
                terms.append(np.fromiter(counts.keys(), "<u4", len(counts)).tobytes())
                tfs.append(np.fromiter(counts.values(), "<u4", len(counts)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())],
                names=["doc_id", "n", "terms", "tfs"])

    return written(id_and_bytes(docs, id_col, text_col).mapInArrow(cut, VECTORS), "fptree-vectors")


def document_frequencies(vectors: DataFrame, size: int):
    """How many documents hold each term of the vocabulary."""
    import numpy as np

    def count(batches):
        total = np.zeros(size, dtype=np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), "<u4"), minlength=size)
        yield count_blobs(total, 1)

    return summed_counts(vectors.select("terms").mapInArrow(count, "slice int, counts binary"), size, 1)


class Tree:
    """Trie of one block of documents: node 0 is the root, inner nodes come first, then the leaves."""

    def __init__(self, leaves, width: int):
        """``leaves``: (ranks ascending, tfs, m, ids) per distinct (vector, m), ids in result order."""
        import numpy as np

        leaves = sorted(leaves, key=lambda x: (x[0].astype(">u4").tobytes(), x[1].tobytes(), x[2]))
        prefixes = [_shared(a[0], b[0]) for a, b in zip(leaves, leaves[1:])]
        spans = _divided(_nodes(prefixes), BUCKET)
        inner, n = len(spans), len(leaves)
        self.ids = [x[3] for x in leaves]
        self.inner = inner
        self.tf = np.zeros((inner + n, width), dtype=np.int32)
        self.m = np.zeros(inner + n, dtype=np.int64)
        for i, (ranks, tfs, m, _) in enumerate(leaves, inner):
            self.tf[i, ranks] = tfs
            self.m[i] = m
        children: list[list[int]] = [[] for _ in spans]
        open_nodes: list[int] = []
        at = 0

        def leaves_until(end):
            nonlocal at
            while at < end:
                while spans[open_nodes[-1]][1] <= at:
                    open_nodes.pop()
                children[open_nodes[-1]].append(inner + at)
                at += 1

        for node, (left, _) in enumerate(spans):
            if open_nodes:
                leaves_until(left)
                while spans[open_nodes[-1]][1] <= left:
                    open_nodes.pop()
                children[open_nodes[-1]].append(node)
            open_nodes.append(node)
        leaves_until(n)
        self.children = [np.array(c) for c in children]
        for node in range(inner - 1, -1, -1):
            below = self.children[node]
            self.tf[node] = self.tf[below].max(axis=0)
            self.m[node] = self.m[below].min()

    def bounds(self, nodes, ranks, weights):
        """Upper bounds of all scores below the nodes; the scores themselves at leaves."""
        tf = self.tf[nodes[:, None], ranks[None, :]].astype("int64")
        return (weights * ((SCALE * tf) // (1000 * tf + 8 * self.m[nodes][:, None]))).sum(axis=1)

    def search(self, ranks, weights, best: list, k: int) -> list:
        """``best`` ((-score, id is null, id) ascending, k at most) brought up to date with this block."""
        import numpy as np

        def least():
            return max(-best[k - 1][0], 1) if len(best) >= k else 1

        root = np.zeros(1, dtype=np.int64)
        stack = [(root, self.bounds(root, ranks, weights))]
        while stack:
            nodes, bound = stack.pop()
            nodes = nodes[bound >= least()]
            if not len(nodes):
                continue
            below = np.concatenate([self.children[v] for v in nodes])
            score = self.bounds(below, ranks, weights)
            keep = score >= least()
            below, score = below[keep], score[keep]
            leaf = below >= self.inner
            if leaf.any():
                # equal scores: the smaller first id wins, so no leaf beyond the k-th can hold a result
                found = [(-int(s), *self.ids[v - self.inner][0], int(v)) for v, s in zip(below[leaf], score[leaf])]
                found = sorted(found)[:k]
                best = sorted(best + [(f[0], *i) for f in found for i in self.ids[f[3] - self.inner]])[:k]
            below, score = below[~leaf], score[~leaf]
            order = np.argsort(score, kind="stable")
            for end in range(0, len(order), FRONT):
                part = order[end:end + FRONT]
                stack.append((below[part], score[part]))
        return best


def _shared(a, b) -> int:
    n = min(len(a), len(b))
    differs = a[:n] != b[:n]
    return int(differs.argmax()) if differs.any() else n


def _nodes(prefixes: list[int]) -> list[tuple[int, int]]:
    """Stretches [left, right) of sorted vectors with a common prefix longer than that around them; parents first."""
    found, stack = [], [(0, 0)]
    for i, shared in enumerate([*prefixes, -1]):
        left = i
        while stack and stack[-1][0] > shared:
            depth, left = stack.pop()
            found.append((left, i + 1))
        if shared >= 0 and (not stack or stack[-1][0] < shared):
            stack.append((shared, left))
    return sorted(found, key=lambda s: (s[0], -s[1]))


def _divided(spans: list[tuple[int, int]], bucket: int) -> list[tuple[int, int]]:
    """The spans without those inside a span of at most ``bucket`` documents."""
    kept, whole = [], 0
    for left, right in spans:
        if right <= whole:
            continue
        kept.append((left, right))
        if right - left <= bucket:
            whole = right
    return kept


def _search_block(docs: DataFrame, block, first_no: int, k: int, id_col: str, text_col: str, cells: int) -> DataFrame:
    import numpy as np
    import pyarrow as pa

    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*[terms for _, terms in block])))}
    width = len(vocabulary)
    vectors = restricted(docs, vocabulary, id_col, text_col)
    totals = vectors.where("n > 0").agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    total, length = totals["docs"], max(totals["terms"], 1)
    df = document_frequencies(vectors, width)
    rank = np.empty(width, dtype=np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(width)
    wanted = []
    for terms in (t for _, t in block):
        at = [vocabulary[t] for t in terms]
        wanted.append((rank[at], np.array([c * weight(total, int(df[i])) for c, i in zip(terms.values(), at)], dtype=np.int64)))
    most = max(cells // max(width, 1) // 2, 2 * BUCKET)

    def look(batches):
        best = [[] for _ in wanted]
        held = {}

        def searched():
            tree = Tree([(np.frombuffer(r, ">u4").astype(np.int64), np.frombuffer(t, "<u4"), m, sorted(ids)[:k])
                         for (r, t, m), ids in held.items()], width)
            for i, (ranks, weights) in enumerate(wanted):
                best[i] = tree.search(ranks, weights, best[i], k)
            held.clear()

        for b in batches:
            for doc_id, n, terms, tfs in zip(*(c.to_pylist() for c in b.columns)):
                if not terms:
                    continue
                ranks = rank[np.frombuffer(terms, "<u4")]
                order = np.argsort(ranks)
                m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * total) // length
                key = ranks[order].astype(">u4").tobytes(), np.frombuffer(tfs, "<u4")[order].tobytes(), m
                held.setdefault(key, []).append((doc_id is None, doc_id or 0))
                if len(held[key]) >= 100 * k:
                    held[key] = sorted(held[key])[:k]
                if len(held) >= most:
                    searched()
        if held:
            searched()
        found = [(first_no + i, None if null else doc_id, -score) for i, rows in enumerate(best) for score, null, doc_id in rows]
        no, ids, scores = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(no, pa.int32()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], names=["item_no", "doc_id", "score"])

    best_of_tasks = vectors.mapInArrow(look, BEST)
    order = Window.partitionBy("item_no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return written(best_of_tasks.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "fptree-best")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
                   item_id_col: str = "item_id", item_text_col: str = "text", vocabulary: int = VOCABULARY, cells: int = CELLS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k highest-scoring documents with a score above 0."""
    spark = docs.sparkSession
    kind = items.schema[item_id_col].dataType.simpleString()
    out, first_no = None, 0
    for block in item_blocks(items, item_id_col, item_text_col, vocabulary):
        names = spark.createDataFrame([(first_no + i, item_id) for i, (item_id, _) in enumerate(block)], f"item_no int, item_id {kind}")
        found = _search_block(docs, block, first_no, k, id_col, text_col, cells)
        found = found.join(F.broadcast(names), "item_no").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
        first_no += len(block)
    return out if out is not None else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
