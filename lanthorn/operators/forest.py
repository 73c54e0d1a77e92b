"""A bagged forest of deep trees whose work and memory grow with the rows, not with nodes times bins.

``pyspark.ml`` sums, level by level, a dense histogram of every open node over all partitions and holds all trees on the
driver; on deep trees that is far more than the rows.  Here

* a binned row is a number (``Packing``), its features, label and bag weight read off by shifts;
* a table of up to ``SUBTREE_ROWS`` rows is sent once per group of trees, and a task grows its whole trees;
* of a larger one, large nodes are split by histograms that Spark sums (a few nodes a tree), and the rows of every smaller node
  meet in one task, which grows the rest of that tree;
* the grown subtrees are a table; rows to be predicted meet groups of whole trees, or, where a tree is larger than ``TREE_BYTES``,
  are dealt to the subtrees by tree and node.

The rules are those of ``pyspark.ml``: Poisson(1) bags, gini, splits at up to ``maxBins`` - 1 thresholds a feature, a new choice of
features at every node, no split without gain, siblings that end with one prediction joined, votes by class shares.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanthorn.session import scratch_path

#: rows (bag weight) of a node that one task may grow alone, rows of a partition, rows dealt at once, and rows handled at once
SUBTREE_ROWS = 1 << 23
PART_ROWS = 1 << 19
CHUNK = 1 << 16
PIECE = 1 << 15
#: trees that share one copy of the rows, at least; rows and bytes of trees that vote in one task
TOGETHER = 8
VOTE_ROWS = 1 << 21
TREE_BYTES = 1 << 25
#: least gain, as rows of impurity, above the rounding of its sums
GAIN = 1e-9
_CDF = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(20)])
#: the weight by the first 16 bits of a hash, -1 where they leave it open
_EDGES = np.searchsorted(_CDF, np.arange((1 << 16) + 1) / 2.0 ** 16, side="right")
_BAG = np.where(_EDGES[:-1] == _EDGES[1:], _EDGES[:-1], -1)
#: bits of a packed row before its features: the label, then the bag weight
LOW = 6
#: weight of such bits, and that of label 1 on top of it 2^26 times
_SUMS = np.array([(c >> 1) * (1.0 + (c & 1) * 2.0 ** 26) for c in range(1 << LOW)])


def bag(row: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """Poisson(1) weight of every row in the bag of ``tree``, from a hash of the row alone."""
    z = row.astype(np.uint64) ^ np.random.SeedSequence([seed, tree]).generate_state(1, np.uint64)[0]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    z ^= z >> np.uint64(31)
    out = _BAG.take((z >> np.uint64(48)).view(np.int64))
    near = np.flatnonzero(out < 0)
    out[near] = np.searchsorted(_CDF, (z[near] >> np.uint64(11)) / 2.0 ** 53, side="right")
    return out


def impurity(ones: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Half the gini impurity times the rows."""
    return ones * (total - ones) / np.maximum(total, 1)


def joined(levels: list, left: np.ndarray, ones: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``left`` (-1: leaf) with siblings that end with one prediction made one leaf, lowest level first."""
    left, one = left.copy(), 2 * ones > total
    for level in reversed(levels):
        inner = level[left[level] >= 0]
        a = left[inner]
        left[inner[(left[a] < 0) & (left[a + 1] < 0) & (one[a] == one[a + 1])]] = -1
    return left


class Packing:
    """Where the features of a binned row lie in its numbers, the first of which starts with label and bag weight (``LOW`` bits)."""

    def __init__(self, sizes: Sequence[int]):
        self.size = np.maximum(np.asarray(sizes, dtype=np.int64), 2)
        bits = np.array([int(n - 1).bit_length() for n in self.size], dtype=np.int64)
        word, at, places = 0, LOW, []
        for b in bits.tolist():
            if at + b > 63:
                word, at = word + 1, 0
            places.append((word, at))
            at += b
        self.words, self.mask = word + 1, (1 << bits) - 1
        self.word, self.shift = (np.array(c, dtype=np.int64) for c in zip(*places))
        self.bytes = (at + 7) // 8 if self.words == 1 else 8  # of a number, as it travels

    def pack(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = np.zeros((self.words, len(x)), np.int64)
        out[0] = y
        for j in range(x.shape[1]):
            out[self.word[j]] |= x[:, j].astype(np.int64) << self.shift[j]
        return out

    def send(self, rows: np.ndarray) -> bytes:
        flat = np.ascontiguousarray(rows.T)
        return flat.tobytes() if self.bytes == 8 else flat.view(np.uint8).reshape(-1, 8)[:, :self.bytes].tobytes()

    def receive(self, sent: bytes) -> np.ndarray:
        if self.bytes == 8:
            return np.ascontiguousarray(np.frombuffer(sent, np.int64).reshape(-1, self.words).T)
        flat = np.zeros((len(sent) // self.bytes, 8), np.uint8)
        flat[:, :self.bytes] = np.frombuffer(sent, np.uint8).reshape(-1, self.bytes)
        return flat.view(np.int64).reshape(1, -1)

    def weighed(self, rows: np.ndarray, w: np.ndarray) -> np.ndarray:
        """The rows of positive weight, with their weights."""
        s = np.flatnonzero(w)
        out = rows.take(s, axis=1)
        out[0] |= w.take(s) << 1
        return out


def _least(r: np.ndarray, k: int) -> np.ndarray:
    """The columns of the ``k`` smallest numbers of every row, smallest first."""
    if k > 4 or r.shape[1] > 256:
        return r.argsort(axis=1)[:, :k]
    # the number of the column takes the last bits, then the k smallest are kept column by column
    key = np.ascontiguousarray(r.T).view(np.int64) & ~255 | np.arange(r.shape[1])[:, None]
    best = np.full((k, len(r)), np.iinfo(np.int64).max)
    for c in key:
        for i in range(k):
            c, best[i] = np.maximum(best[i], c), np.minimum(best[i], c)
    return (best & 255).T[:, :r.shape[1]]


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, subset: int, rng) -> dict:
    """One subtree over binned rows with labels y and weights w (up to 31); see ``grow_packed``."""
    lay = Packing(x.max(axis=0).astype(np.int64) + 1)
    return grow_packed(lay.weighed(lay.pack(x, y), w), lay, depth, subset, rng)


def grow_packed(rows: np.ndarray, lay: Packing, depth: int, subset: int, rng) -> dict:
    """One subtree over packed rows: arrays feature, split (x <= split goes left), left (right is the next; -1: leaf), ones, total.

    The rows of a node lie together, so a level reads them in order, ``PIECE`` at a time.  Nodes with more rows than bins are
    counted bin by bin, others sorted, so a level costs as much as its rows.  Sums hold the weight and, 2^26 times, that of label 1.
    """
    p, sides = len(lay.size), (0, 1)
    code, weight = np.bincount(rows[0] & (1 << LOW) - 1, minlength=1 << LOW), np.arange(1 << LOW) >> 1
    t, o = np.array([(code * weight).sum()]), np.array([(code * weight)[1::2].sum()])
    ids, rank, size, count = np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([rows.shape[1]]), 1
    made_, ones, total, levels = [], [o], [t], [ids]
    if not 0 < o[0] < t[0]:
        depth = 0

    def bins(f, a, b, size):
        """The bins of rows a to b, ``size`` rows of every node, each of which looks at a feature f."""
        if len(f) == 1:
            return rows[lay.word[f[0]], a:b] >> lay.shift[f[0]] & lay.mask[f[0]]
        out = np.repeat(lay.shift[f], size)
        np.right_shift(rows[0, a:b] if lay.words == 1 else rows[np.repeat(lay.word[f], size), np.arange(a, b)], out, out=out)
        out &= np.repeat(lay.mask[f], size)
        return out

    # the open nodes are kept in the order of their rows; rank is a node's place among them by number
    while depth > 0 and len(ids):
        depth -= 1
        n, upto = len(ids), np.cumsum(size)
        chosen, own = _least(rng.random((n, p)), subset)[rank], impurity(o, t)
        gain, at, value, left_t, left_o = np.full(n, GAIN), np.zeros(n, np.int64), np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64)
        edge = np.r_[0, np.flatnonzero(np.diff((upto - size) // PIECE)) + 1, n]
        chunks = [c for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())
                  for c in (((a, b - 1), (b - 1, b)) if b - a > 1 and size[b - 1] > PIECE else ((a, b),))]
        for a, b in chunks:
            ra, rb, here = int(upto[a] - size[a]), int(upto[b - 1]), size[a:b]
            pieces = [(i, min(i + PIECE, rb)) for i in range(ra, rb, PIECE)] if b - a == 1 else [(ra, rb)]
            before = np.cumsum(t[a:b] + (o[a:b] << 26)) - (t[a:b] + (o[a:b] << 26))
            for j in range(chosen.shape[1]):
                f = chosen[a:b, j]
                width = lay.size[f]
                first = np.cumsum(width) - width
                cells = int(first[-1] + width[-1])
                if b - a == 1 or cells <= 5 * (rb - ra):
                    h = 0.0
                    for i, k in pieces:
                        cell = bins(f, i, k, here)
                        if b - a > 1:
                            cell += np.repeat(first, here)
                        h = h + np.bincount(cell, weights=_SUMS.take(rows[0, i:k] & (1 << LOW) - 1), minlength=cells)
                    cell = np.flatnonzero(h > 0)
                    s = h[cell].astype(np.int64).cumsum()
                    of = np.repeat(np.arange(b - a), width).take(cell)
                    v = cell - first.take(of)
                else:
                    key = np.sort(np.repeat(np.arange(b - a) << 8 + LOW, here) | bins(f, ra, rb, here) << LOW | rows[0, ra:rb] & (1 << LOW) - 1)
                    s = _SUMS.take(key & (1 << LOW) - 1).astype(np.int64).cumsum()
                    key >>= LOW
                    end = np.flatnonzero(np.r_[key[1:] != key[:-1], True])
                    s, of, v = s.take(end), key.take(end) >> 8, key.take(end) & 255
                inside = np.flatnonzero(of[1:] == of[:-1])  # a split lies between two bins of one node
                if not len(inside):
                    continue
                of, v = of.take(inside), v.take(inside)
                s = s.take(inside) - before.take(of)
                lt, lo = s & (1 << 26) - 1, s >> 26
                g = own[a:b].take(of) - impurity(lo, lt) - impurity(o[a:b].take(of) - lo, t[a:b].take(of) - lt)
                start = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                top = np.maximum.reduceat(g, start)
                best = np.flatnonzero(g == np.repeat(top, np.diff(np.r_[start, len(g)])))
                best = best[np.r_[True, of[best][1:] != of[best][:-1]]]
                best = best[g[best] > gain[a:b][of[best]]]
                i, to = of[best], of[best] + a
                gain[to], at[to], value[to], left_t[to], left_o[to] = g[best], f[i], v[best], lt[best], lo[best]
        parts = value >= 0
        by_rank, number, made = np.empty(n, np.int64), np.empty(n, np.int64), int(parts.sum())
        by_rank[rank] = np.arange(n)
        number[by_rank] = np.cumsum(parts[by_rank]) - 1
        made_.append((ids[parts], at[parts], value[parts], count + 2 * number[parts]))
        new_t, new_o = np.zeros(2 * made, np.int64), np.zeros(2 * made, np.int64)
        child_t, child_o = (left_t, t - left_t), (left_o, o - left_o)
        for side in sides:
            new_t[2 * number[parts] + side], new_o[2 * number[parts] + side] = child_t[side][parts], child_o[side][parts]
        mixed = [parts & (c > 0) & (c < d) for c, d in zip(child_o, child_t)]
        kept, place, sizes = [], [], []
        for a, b in chunks:
            if not (mixed[0][a:b].any() or mixed[1][a:b].any()):
                continue
            ra, rb, here = int(upto[a] - size[a]), int(upto[b - 1]), size[a:b]
            if b - a == 1:
                right = np.concatenate([bins(at[a:b], i, min(i + PIECE, rb), here) > value[a] for i in range(ra, rb, PIECE)])
            else:
                right = bins(at[a:b], ra, rb, here) > np.repeat(value[a:b], here)
            rights = np.add.reduceat(right, upto[a:b] - here - ra, dtype=np.int64)
            for side, rows_of in zip(sides, (here - rights, rights)):
                open_ = mixed[side][a:b]
                if open_.any():
                    goes = right if side else ~right
                    goes = np.flatnonzero(goes if open_.all() else goes & np.repeat(open_, here))
                    kept.append(rows[:, ra:rb].take(goes, axis=1))
                    place.append(2 * number[a:b][open_] + side)
                    sizes.append(rows_of[open_])
        total.append(new_t)
        ones.append(new_o)
        levels.append(count + np.arange(2 * made))
        none = np.zeros(0, np.int64)
        rows = np.concatenate(kept, axis=1) if kept else rows[:, :0]
        place, size = np.concatenate([none, *place]), np.concatenate([none, *sizes])
        live = np.zeros(2 * made, np.int64)
        live[place] = 1
        ids, t, o, rank = count + place, new_t[place], new_o[place], (np.cumsum(live) - 1)[place]
        count += 2 * made
    out = {"ones": np.concatenate(ones), "total": np.concatenate(total), "feature": np.zeros(count, np.int64),
           "split": np.zeros(count, np.int64), "left": np.full(count, -1)}
    for where, *what in made_:
        for name, values in zip(("feature", "split", "left"), what):
            out[name][where] = values
    out["left"] = joined(levels, out["left"], out["ones"], out["total"])
    return out


def cut(tree: dict, depth: int) -> np.ndarray:
    """``left`` of the tree cut at ``depth``, siblings that then end with one prediction joined: that of a tree grown no deeper."""
    left, levels = tree["left"].copy(), [np.zeros(1, np.int64)]
    while len(levels) <= depth:
        inner = levels[-1][left[levels[-1]] >= 0]
        if not len(inner):
            break
        levels.append(np.concatenate([left[inner], left[inner] + 1]))
    if len(levels) > depth:
        left[levels[max(depth, 0)]] = -1
    return joined(levels, left, tree["ones"], tree["total"])


def descend(tree: dict, x: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """The leaf that every binned row reaches, from the root or from the nodes ``start``."""
    at, rows = np.zeros(len(x), np.int64) if start is None else start.copy(), np.arange(len(x))
    rows = rows[tree["left"][at] >= 0]
    while len(rows):
        n = at[rows]
        at[rows] = tree["left"][n] + (x[rows, tree["feature"][n]] > tree["split"][n])
        rows = rows[tree["left"][at[rows]] >= 0]
    return at


def descend_packed(tree: dict, rows: np.ndarray, lay: Packing, start: np.ndarray | None = None) -> np.ndarray:
    """``descend`` over packed rows, ``PIECE`` at a time."""
    at, left, split = np.zeros(rows.shape[1], np.int64) if start is None else start.copy(), tree["left"], tree["split"]
    word, shift, mask = (c.take(tree["feature"]) for c in (lay.word, lay.shift, lay.mask))
    for a in range(0, rows.shape[1], PIECE):
        here = at[a:a + PIECE]
        i = np.flatnonzero(left.take(here) >= 0)
        node = here.take(i)
        w = rows[0, a:a + PIECE].take(i)
        while len(i):
            if lay.words > 1:
                w = rows[word.take(node), a + i]
            node = left.take(node) + ((w >> shift.take(node) & mask.take(node)) > split.take(node))
            here[i] = node
            on = np.flatnonzero(left.take(node) >= 0)
            i, w, node = i.take(on), w.take(on), node.take(on)
    return at


def _pack(tree: dict) -> dict:
    return {"feature": tree["feature"].astype(np.uint16).tobytes(), "split": tree["split"].astype(np.uint8).tobytes(),
            "next": tree["left"].astype(np.int32).tobytes(), "ones": tree["ones"].astype(np.int32).tobytes(),
            "total": tree["total"].astype(np.int32).tobytes()}


def _unpack(r) -> dict:
    kinds = {"feature": np.uint16, "split": np.uint8, "next": np.int32, "ones": np.int32, "total": np.int32}
    return {("left" if c == "next" else c): np.frombuffer(r[c], k).astype(np.int64) for c, k in kinds.items()}


PACKED_ARRAYS = ("feature", "split", "next", "ones", "total")
PACKED = "tree int, node int, " + ", ".join(f"{c} binary" for c in PACKED_ARRAYS)


def _bins(x: np.ndarray, thresholds: list) -> np.ndarray:
    return np.stack([np.searchsorted(t, x[:, j], side="left") for j, t in enumerate(thresholds)], axis=1).astype(np.uint8)


def learn_thresholds(rows: DataFrame, p: int, bins: int) -> list:
    """Midpoints of the values of features with up to ``bins`` values, of evenly spread quantiles of the others."""
    def values(batches):
        for b in batches:
            x = np.stack(b["x"].to_list())
            for j in range(p):
                u = np.unique(x[:, j])
                yield pd.DataFrame({"j": j, "v": u if len(u) <= bins else [None]})

    found = rows.select("x").mapInPandas(values, "j int, v double").distinct().groupBy("j").agg(
        F.count("*").alias("n"), F.count_if(F.col("v").isNull()).alias("more"), F.slice(F.sort_array(F.collect_set("v")), 1, bins).alias("v"))
    few = {r["j"]: r["v"] for r in found.collect() if not r["more"] and r["n"] <= bins}
    many = [j for j in range(p) if j not in few]
    if many:
        share = [k / bins for k in range(1, bins + 1)]
        cut = rows.agg(*[F.percentile_approx(F.col("x")[j], share, 10000).alias(str(j)) for j in many]).first()
        few.update({j: sorted(set(cut[str(j)])) for j in many})
    return [((np.array(few[j][:-1]) + np.array(few[j][1:])) / 2).tolist() for j in range(p)]


def _spread_labels(spark: SparkSession, n: int) -> list[int]:
    """``n`` numbers that ``repartition(n, number)`` puts into partitions of their own."""
    g = F.col("id").cast("int")
    found = spark.range(64 * n).select(g.alias("g"), F.pmod(F.hash(g), F.lit(n)).alias("at")).groupBy("at").agg(F.min("g").alias("g"))
    return (sorted(r["g"] for r in found.collect()) + [-1 - i for i in range(n)])[:n]


def _ranges(trees: int, groups: int, ends: Sequence[int] = ()) -> list[range]:
    """The trees in about ``groups`` ranges, none of which crosses one of ``ends``."""
    edges = sorted({0, trees, *(e for e in ends if 0 < e < trees)})
    out = []
    for a, b in zip(edges, edges[1:]):
        parts = min(max(round(groups * (b - a) / trees), 1), b - a)
        cut_ = [a + (b - a) * i // parts for i in range(parts + 1)]
        out += [range(x, y) for x, y in zip(cut_, cut_[1:])]
    return out


def _gathered(batches, lay: Packing, sizes: dict) -> dict:
    """{group: {kind: (chunks, rows, r)}} of record batches (g, kind, chunk, rows, r); ``sizes``: rows of every kind.

    ``chunks`` lists (chunk, first, last) in the order in which the rows lie.
    """
    out: dict = {}
    for b in batches:
        for i, (g, kind, chunk) in enumerate(zip(*(b.column(c).to_pylist() for c in ("g", "kind", "chunk")))):
            if kind not in out.setdefault(g, {}):
                out[g][kind] = ([], np.empty((lay.words, sizes[kind]), np.int64), np.empty(sizes[kind], np.int64))
            chunks, rows, r = out[g][kind]
            got = lay.receive(b.column("rows")[i].as_py())
            a = chunks[-1][2] if chunks else 0
            chunks.append((chunk, a, a + got.shape[1]))
            rows[:, a:a + got.shape[1]] = got
            if (hashes := b.column("r")[i].as_py()) is not None:
                r[a:a + got.shape[1]] = np.frombuffer(hashes, np.int64)
    return out


def _bagged(rows: np.ndarray, r: np.ndarray, lay: Packing, seed: int, tree: int) -> np.ndarray:
    return np.concatenate([lay.weighed(rows[:, a:a + CHUNK], bag(r[a:a + CHUNK], seed, tree)) for a in range(0, len(r), CHUNK)] or [rows], axis=1)


def _walk(tree: dict, rows: np.ndarray, lay: Packing, depths: Sequence[int | None], base: int, above: Sequence[float | None]) -> np.ndarray:
    """Class shares (depth by row) of rows in a subtree whose root lies ``base`` deep; ``above``: the share of a cut's leaf above it."""
    share = tree["ones"] / np.maximum(tree["total"], 1)  # a bag may be empty
    at, p1 = np.zeros(rows.shape[1], np.int64), np.zeros((len(depths), rows.shape[1]))
    for i in sorted(range(len(depths)), key=lambda i: math.inf if depths[i] is None else depths[i]):  # a deeper cut ends on the same way, no earlier
        if above[i] is not None:
            p1[i] = above[i]
            continue
        left = tree["left"] if depths[i] is None else cut(tree, depths[i] - base)
        at = descend_packed({**tree, "left": left}, rows, lay, at)
        p1[i] = share[at]
    return p1


#: class shares added up over trees from ``first`` on, for the rows ``at`` (none: all) of a chunk, and the number of those trees
VOTES = "chunk bigint, first int, at binary, p1 binary, n binary"


def _voted(first: int, chunks: list, p1: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "chunk": pa.array([c for c, _, _ in chunks], pa.int64()), "first": pa.array([first] * len(chunks), pa.int32()),
        "at": pa.array([None] * len(chunks), pa.binary()), "p1": pa.array([p1[:, a:b].tobytes() for _, a, b in chunks], pa.binary()),
        "n": pa.array([n[a:b].astype(np.int32).tobytes() for _, a, b in chunks], pa.binary())})


def _sums(votes: pd.DataFrame, rows: int, trees: Sequence[int], depths: int) -> tuple:
    """Class shares of one chunk added up over the first ``trees`` trees, per depth; of how many trees."""
    votes, total = votes.sort_values("first", kind="stable"), np.zeros((depths, rows))
    number, out = np.zeros(rows, dtype=np.int64), np.zeros((len(trees), depths, rows))
    for before, until in zip([0, *sorted(trees)], sorted(trees)):
        some = votes[(votes["first"] >= before) & (votes["first"] < until)]
        for i, v, n in zip(some["at"], some["p1"], some["n"]):
            at = slice(None) if i is None else np.frombuffer(i, np.uint16)
            total[:, at] += np.frombuffer(v).reshape(depths, -1)
            number[at] += np.frombuffer(n, np.int32)
        out[list(trees).index(until)] = total
    return out, number


def _added(votes: DataFrame, chunks: DataFrame, trees: int) -> DataFrame:
    """(id, p1, n): every row's sum of class shares, and of how many trees; rows without a vote have none."""
    def add(votes, chunk):
        if not len(votes) or not len(chunk):
            return pd.DataFrame({"id": [], "p1": [], "n": []})
        ids = np.frombuffer(chunk["ids"].iloc[0], np.int64)
        total, number = _sums(votes, len(ids), [trees], 1)
        at = np.flatnonzero(number)
        return pd.DataFrame({"id": ids[at], "p1": total[0, 0, at], "n": number[at]})

    return votes.groupBy("chunk").cogroup(chunks.select("chunk", "ids").groupBy("chunk")).applyInPandas(add, "id bigint, p1 double, n bigint")


def _counted(votes: DataFrame, chunks: DataFrame, trees: Sequence[int], depths: Sequence[int | None]) -> dict:
    """{(trees, depth): (tp, fp, fn)} of class 1 over the rows that have a vote."""
    def add(votes, chunk):
        if not len(votes) or not len(chunk):
            return pd.DataFrame({"k": [], "tp": [], "fp": [], "fn": []})
        y = np.frombuffer(chunk["y"].iloc[0], np.uint8) == 1
        total, number = _sums(votes, len(y), trees, len(depths))
        y, at, out = y[number > 0], number > 0, []
        for j, t in enumerate(trees):
            for i in range(len(depths)):
                one = total[j, i, at] / t > 0.5
                out.append((j * len(depths) + i, int((one & y).sum()), int((one & ~y).sum()), int((~one & y).sum())))
        return pd.DataFrame(out, columns=["k", "tp", "fp", "fn"])

    sums = votes.groupBy("chunk").cogroup(chunks.select("chunk", "y").groupBy("chunk")).applyInPandas(add, "k int, tp bigint, fp bigint, fn bigint")
    found = {r["k"]: (r["tp"], r["fp"], r["fn"]) for r in sums.groupBy("k").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")]).collect()}
    return {(t, d): found.get(j * len(depths) + i, (0, 0, 0)) for j, t in enumerate(trees) for i, d in enumerate(depths)}


class _Forest(Params):
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "features vector", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "key that tells rows apart in the bags", TypeConverters.toString)
    numTrees = Param(Params._dummy(), "numTrees", "trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "largest depth", TypeConverters.toInt)
    subset = Param(Params._dummy(), "subset", "features looked at per node", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins per feature, 256 at most", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    def _rows(self, df: DataFrame) -> DataFrame:
        """``df`` with features x, label y and the number r that the bags are drawn from."""
        x, y = vector_to_array(self.getOrDefault("featuresCol")), F.col(self.getOrDefault("labelCol")).cast("int")
        return df.withColumns({"x": x, "y": y, "r": F.xxhash64(F.col(self.getOrDefault("keyCol")).alias("k"), x, y)})

    def _unseen(self, df: DataFrame) -> DataFrame:
        """(x, y) of rows to be predicted, y 1 for class 1 and 0 for any other label or none."""
        return df.select(vector_to_array(self.getOrDefault("featuresCol")).alias("x"),
                         F.coalesce(F.col(self.getOrDefault("labelCol")) == 1, F.lit(False)).cast("int").alias("y"))


def _packing(thresholds: list) -> Packing:
    return Packing([len(t) + 1 for t in thresholds])


def _chunks(rows: DataFrame, thresholds: list, lay: Packing) -> DataFrame:
    """Binned rows (x, and r, y and id if there are any) in chunks of up to ``CHUNK`` rows: chunk, size, rows, r, y, ids; written once."""
    def packed(batches):
        for whole in batches:
            for a in range(0, len(whole), CHUNK):
                b = whole.iloc[a:a + CHUNK]
                y = b["y"].to_numpy(dtype=np.int64)
                yield pd.DataFrame({"size": [len(b)], "rows": [lay.send(lay.pack(_bins(np.stack(b["x"].to_list()), thresholds), y))],
                                    "r": [b["r"].to_numpy(dtype=np.int64).tobytes()], "y": [y.astype(np.uint8).tobytes()],
                                    "ids": [b["id"].to_numpy(dtype=np.int64).tobytes()]})

    missing = {c: F.lit(0).cast(t) for c, t in (("y", "int"), ("r", "bigint"), ("id", "bigint")) if c not in rows.columns}
    made = rows.withColumns(missing).select("x", "y", "r", "id").mapInPandas(packed, "size int, rows binary, r binary, y binary, ids binary")
    return made.withColumn("chunk", F.monotonically_increasing_id()).checkpoint(eager=True)


class Forest(_Forest, Estimator):
    """Classifier of a 0/1 label; ``fit`` writes the trees below the checkpoint folder."""

    @keyword_only
    def __init__(self, *, labelCol="label", featuresCol="features", keyCol="id", numTrees=100, maxDepth=30, subset=1, maxBins=64, seed=42):
        super().__init__()
        self._setDefault(labelCol="label", featuresCol="features", keyCol="id", numTrees=100, maxDepth=30, subset=1, maxBins=64, seed=42)
        self._set(**self._input_kwargs)

    def _prepared(self, rows: DataFrame) -> tuple:
        """Rows (x, y, r, perhaps id) in chunks, their number, the thresholds and the packing."""
        seen = rows.agg(F.count("*").alias("n"), F.count_if(F.col("y").isin(0, 1)).alias("ok"), F.max(F.size("x")).alias("p")).first()
        n = seen["n"]
        if not n or seen["ok"] < n:
            raise ValueError("the forest needs rows, and labels of 0 or 1")
        thresholds = learn_thresholds(rows, seen["p"], self.getOrDefault("maxBins"))
        lay, slots = _packing(thresholds), rows.sparkSession.sparkContext.defaultParallelism
        return _chunks(rows.repartition(max(slots, math.ceil(n / PART_ROWS))), thresholds, lay), n, thresholds, lay

    def _whole_trees(self, data: DataFrame, sizes: dict, lay: Packing, work, schema: str, ends: Sequence[int] = ()) -> DataFrame:
        """``work(trees, gathered)`` once per group of trees, in a task that has all rows of ``data`` (kind, chunk, rows, r)."""
        spark, trees = data.sparkSession, self.getOrDefault("numTrees")
        groups = _ranges(trees, min(spark.sparkContext.defaultParallelism, math.ceil(trees / TOGETHER)), ends)
        labels = _spread_labels(spark, len(groups))
        of = dict(zip(labels, groups))

        def each(batches):
            every = _gathered(batches, lay, sizes)
            for g in list(every):
                yield from work(of[g], every.pop(g))

        copies = data.withColumn("g", F.explode(F.array(*[F.lit(v) for v in labels])))
        return copies.repartition(len(groups), "g").mapInArrow(each, schema)

    def _whole(self, n: int, lay: Packing) -> bool:
        return n * lay.words <= SUBTREE_ROWS

    def _grown(self, rows: np.ndarray, r: np.ndarray, lay: Packing, t: int) -> dict | None:
        """Tree ``t`` over all packed rows; None where its bag is empty."""
        seed = self.getOrDefault("seed")
        some = _bagged(rows, r, lay, seed, t)
        if not some.shape[1]:
            return None
        return grow_packed(some, lay, self.getOrDefault("maxDepth"), self.getOrDefault("subset"), np.random.default_rng([seed, t, 0, 1]))

    def _fit(self, df: DataFrame) -> ForestModel:
        return self._fitted(*self._prepared(self._rows(df).select("x", "y", "r")))

    def _voted_as_grown(self, data: DataFrame, sizes: dict, lay: Packing, depths: Sequence[int | None] = (None,), ends: Sequence[int] = ()) -> DataFrame:
        """Class shares (``VOTES``) on the rows of kind 1 in ``data``, or, without such, on the rows outside of each tree's bag.

        A tree votes in the task that has grown it, so it is not written.
        """
        seed, kind = self.getOrDefault("seed"), 1 if 1 in sizes else 0

        def vote(group, kinds):
            _, rows, r = kinds[0]
            if kind not in kinds:
                return
            chunks, asked, _ = kinds[kind]
            p1, n = np.zeros((len(depths), asked.shape[1])), np.zeros(asked.shape[1], np.int32)
            for t in group:
                tree = self._grown(rows, r, lay, t)
                for a in range(0, asked.shape[1] if tree is not None else 0, CHUNK):
                    s = np.arange(a, min(a + CHUNK, asked.shape[1]))
                    s = s if kind else s[bag(r[a:a + CHUNK], seed, t) == 0]
                    p1[:, s] += _walk(tree, asked.take(s, axis=1), lay, depths, 0, [None] * len(depths))
                    n[s] += 1
            yield _voted(group[0], chunks, p1, n)

        return self._whole_trees(data, sizes, lay, vote, VOTES, ends)

    def grid_counts(self, seen: DataFrame, unseen: DataFrame, trees: Sequence[int], depths: Sequence[int | None]) -> dict:
        """``grid_counts`` on ``unseen`` of the forest fitted to ``seen``."""
        data, n, thresholds, lay = self._prepared(self._rows(seen).select("x", "y", "r"))
        chunks = _chunks(self._unseen(unseen), thresholds, lay)
        m = chunks.agg(F.sum("size")).first()[0] or 0
        if not m or not self._whole(max(n, m), lay):
            model = self._fitted(data, n, thresholds, lay)
            return _counted(model._votes(chunks, lay, depths, trees), chunks, trees, depths)
        rows = [d.select(F.lit(k).alias("kind"), "chunk", "rows", r.alias("r")) for k, d, r in ((0, data, F.col("r")), (1, chunks, F.lit(None).cast("binary")))]
        return _counted(self._voted_as_grown(rows[0].unionByName(rows[1]), {0: n, 1: m}, lay, depths, trees), chunks, trees, depths)

    def out_of_bag(self, df: DataFrame) -> DataFrame:
        """``out_of_bag`` on ``df`` of the forest fitted to it."""
        name = f"__row_{uuid.uuid4().hex[:8]}"
        rows = df.withColumn(name, F.monotonically_increasing_id()).checkpoint(eager=True)
        data, n, thresholds, lay = self._prepared(self._rows(rows).select("x", "y", "r", F.col(name).alias("id")))
        if self._whole(n, lay):
            votes = self._voted_as_grown(data.select(F.lit(0).alias("kind"), "chunk", "rows", "r"), {0: n}, lay)
        else:
            votes = self._fitted(data, n, thresholds, lay)._votes(data, lay, out_of_bag=True)
        sums = _added(votes, data, self.getOrDefault("numTrees"))
        return rows.join(sums.withColumnRenamed("id", name), name).drop(name)

    def _fitted(self, data: DataFrame, n: int, thresholds: list, lay: Packing) -> ForestModel:
        get = lambda c: self.getOrDefault(c)
        spark, trees, bins, subset, seed, deepest = data.sparkSession, get("numTrees"), get("maxBins"), get("subset"), get("seed"), get("maxDepth")
        p, slots = len(lay.size), spark.sparkContext.defaultParallelism
        top = [{"feature": np.zeros(1, np.int64), "split": np.zeros(1, np.int64), "left": np.full(1, -1), "ones": np.zeros(1, np.int64),
                "total": np.full(1, n), "depth": np.zeros(1, np.int64)} for _ in range(trees)]
        closed = [set() for _ in range(trees)]
        path = scratch_path(spark, "forest")
        whole = self._whole(n, lay)
        open_ = {t: [0] for t in range(trees)} if not whole and deepest > 0 else {}

        def chosen(t: int, node: int) -> np.ndarray:
            return np.random.default_rng([seed, t, node]).random(p).argsort()[:subset]

        def received(batches):
            for b in batches:
                for rows, r in zip(b["rows"], b["r"]):
                    yield lay.receive(rows), np.frombuffer(r, np.int64)

        while open_:
            def counts(batches, top=top, open_=open_):
                looked = {t: np.stack([chosen(t, v) for v in nodes]) for t, nodes in open_.items()}
                sums = {t: np.zeros((subset, len(nodes) * bins)) for t, nodes in open_.items()}
                for rows, r in received(batches):
                    for t, nodes in open_.items():
                        some = _bagged(rows, r, lay, seed, t)
                        slot = np.full(len(top[t]["left"]), -1)
                        slot[nodes] = np.arange(len(nodes))
                        at = slot.take(descend_packed(top[t], some, lay))
                        s = np.flatnonzero(at >= 0)
                        some, at = some.take(s, axis=1), at.take(s)
                        w = _SUMS.take(some[0] & (1 << LOW) - 1)
                        for j in range(looked[t].shape[1]):
                            f = looked[t][:, j].take(at)
                            v = (some[0] if lay.words == 1 else some[lay.word.take(f), np.arange(len(at))]) >> lay.shift.take(f) & lay.mask.take(f)
                            sums[t][j] += np.bincount(at * bins + v, weights=w, minlength=len(nodes) * bins)
                for t, nodes in open_.items():
                    h = sums[t].astype(np.int64)
                    h = np.stack([h & (1 << 26) - 1, h >> 26], axis=2).reshape(subset, len(nodes), bins * 2)  # weight, that of label 1
                    yield pd.DataFrame({"tree": t, "node": nodes, "h": [np.ascontiguousarray(h[:, i]).tobytes() for i in range(len(nodes))]})

            def best(key, parts):
                t, node = key
                h = sum(np.frombuffer(v, np.int64) for v in parts["h"]).reshape(-1, bins, 2)
                total, ones = int(h[0, :, 0].sum()), int(h[0, :, 1].sum())
                lt, lo = h[:, :, 0].cumsum(axis=1), h[:, :, 1].cumsum(axis=1)
                g = impurity(ones, total) - impurity(lo, lt) - impurity(ones - lo, total - lt)
                g[(lt == 0) | (lt == total)] = -1.0
                j, v = np.unravel_index(g.argmax(), g.shape)
                f = int(chosen(int(t), int(node))[j]) if g[j, v] > GAIN else -1
                return pd.DataFrame([(t, node, f, int(v), int(lt[j, v]), int(lo[j, v]), total, ones)],
                                    columns=["tree", "node", "feature", "split", "lt", "lo", "total", "ones"])

            sums = data.select("rows", "r").mapInPandas(counts, "tree int, node int, h binary").groupBy("tree", "node")
            found = sums.applyInPandas(best, "tree int, node int, feature int, split int, lt bigint, lo bigint, total bigint, ones bigint").collect()
            open_ = {}
            for r in sorted(found, key=lambda r: (r["tree"], r["node"])):
                tree, node, t = top[r["tree"]], r["node"], r["tree"]
                tree["total"][node], tree["ones"][node] = r["total"], r["ones"]
                if r["feature"] < 0:
                    closed[t].add(node)
                    continue
                first = len(tree["left"])
                tree["feature"][node], tree["split"][node], tree["left"][node] = r["feature"], r["split"], first
                depth = tree["depth"][node] + 1
                for i, (total, ones) in enumerate(((r["lt"], r["lo"]), (r["total"] - r["lt"], r["ones"] - r["lo"]))):
                    for c, v in (("feature", 0), ("split", 0), ("left", -1), ("ones", ones), ("total", total), ("depth", depth)):
                        tree[c] = np.append(tree[c], v)
                    if not 0 < ones < total or depth >= deepest:
                        closed[t].add(first + i)
                    elif total * lay.words > SUBTREE_ROWS:
                        open_.setdefault(t, []).append(first + i)

        def deal(batches):
            parts = list(received(batches))
            if not parts:
                return
            rows, r = (np.concatenate(c, axis=-1) for c in zip(*parts))
            for t in range(trees):
                some = _bagged(rows, r, lay, seed, t)
                at = descend_packed(top[t], some, lay)
                order = np.argsort(at.astype(np.uint16) if len(top[t]["left"]) < 1 << 16 else at, kind="stable")
                nodes, first = np.unique(at.take(order), return_index=True)
                sent = [(int(v), lay.send(some.take(i, axis=1))) for v, i in zip(nodes, np.split(order, first[1:])) if int(v) not in closed[t]]
                yield pd.DataFrame({"tree": t, "node": [v for v, _ in sent], "rows": [b for _, b in sent]})

        def subtree(key, parts):
            t, node = int(key[0]), int(key[1])
            rows = np.concatenate([lay.receive(v) for v in parts["rows"]], axis=1)
            made = grow_packed(rows, lay, deepest - int(top[t]["depth"][node]), subset, np.random.default_rng([seed, t, node, 1]))
            return pd.DataFrame([{"tree": t, "node": node, **_pack(made)}])

        def grown(group, kinds):
            _, rows, r = kinds[0]
            for t in group:
                made = self._grown(rows, r, lay, t)
                if made is not None:
                    yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "node": pa.array([0], pa.int32()),
                                                      **{c: pa.array([v], pa.binary()) for c, v in _pack(made).items()}})

        if whole:
            self._whole_trees(data.select(F.lit(0).alias("kind"), "chunk", "rows", "r"), {0: n}, lay, grown, PACKED).write.parquet(f"{path}/subtrees")
        else:
            groups = sum(int((t["left"] < 0).sum()) for t in top)
            dealt = data.select("rows", "r").mapInPandas(deal, "tree int, node int, rows binary").repartition(min(max(groups, slots), 4000), "tree", "node")
            dealt.groupBy("tree", "node").applyInPandas(subtree, PACKED).write.parquet(f"{path}/subtrees")
        # leaves among the large nodes, and siblings there that end with one prediction
        ended = spark.read.parquet(f"{path}/subtrees").where(F.length("split") == 1).select("tree", "node", "ones", "total").collect()
        ends = [set(c) for c in closed]
        for r in ended:
            ends[r["tree"]].add(r["node"])
            for c in ("ones", "total"):
                top[r["tree"]][c][r["node"]] = np.frombuffer(r[c], np.int32)[0]
        extra = [(t, v) for t in range(trees) for v in sorted(closed[t])]
        for t, tree in enumerate(top):
            for node in range(len(tree["left"]) - 1, -1, -1):
                a = int(tree["left"][node])
                if a >= 0 and a in ends[t] and a + 1 in ends[t] and len({2 * tree["ones"][i] > tree["total"][i] for i in (a, a + 1)}) == 1:
                    tree["left"][node] = -1
                    ends[t].add(node)
                    extra.append((t, node))
        leaf = lambda t, v: _pack({"feature": np.zeros(1), "split": np.zeros(1), "left": np.full(1, -1), "ones": top[t]["ones"][[v]], "total": top[t]["total"][[v]]})
        if extra:
            spark.createDataFrame([(t, v, *leaf(t, v).values()) for t, v in extra], PACKED).write.mode("append").parquet(f"{path}/subtrees")
        state = {"thresholds": thresholds, "top": [{c: t[c].tolist() for c in ("feature", "split", "left", "ones", "total", "depth")} for t in top]}
        return self._copyValues(ForestModel(state, f"{path}/subtrees"))


class ForestModel(_Forest, Model, MLWritable, MLReadable):
    """Thresholds and the tops of the trees, and the path of the table of their subtrees."""

    def __init__(self, state: dict | None = None, subtrees: str | None = None):
        super().__init__()
        self.state, self.subtrees = state, subtrees

    def _above(self, depths: Sequence[int | None]) -> list:
        """For every depth {(tree, node): class share}: nodes of the tops' ends where a tree cut at that depth has ended already."""
        top, above = self.state["top"], [{} for _ in depths]
        if all(len(t["left"]) == 1 for t in top) or all(d is None for d in depths):
            return above

        def roots(batches):
            for b in batches:
                for _, g in b.iterrows():
                    tree, base = _unpack(g), top[g["tree"]]["depth"][g["node"]]
                    one = [bool((tree["left"] if d is None else cut(tree, d - base))[0] < 0) for d in depths]
                    yield pd.DataFrame({"tree": [g["tree"]], "node": [g["node"]], "one": [one]})

        found = SparkSession.getActiveSession().read.parquet(self.subtrees).mapInPandas(roots, "tree int, node int, one array<boolean>")
        ended = {(r["tree"], r["node"]): r["one"] for r in found.collect()}
        for i, d in enumerate(depths):
            for t, tree in enumerate(top if d is not None else []):
                left, depth, ones, total = (tree[c] for c in ("left", "depth", "ones", "total"))
                end = [False] * len(left)
                for v in reversed(range(len(left))):  # children come after their parent
                    a = left[v]
                    both = a >= 0 and end[a] and end[a + 1] and (2 * ones[a] > total[a]) == (2 * ones[a + 1] > total[a + 1])
                    end[v] = depth[v] >= d or both or (a < 0 and ended[t, v][i])
                open_ = [(0, None)]
                while open_:
                    v, at = open_.pop()
                    at = v if at is None and end[v] else at
                    if left[v] >= 0:
                        open_ += [(left[v], at), (left[v] + 1, at)]
                    elif at is not None:
                        above[i][t, v] = ones[at] / max(total[at], 1)
        return above

    def _votes(self, chunks: DataFrame, lay: Packing, depths: Sequence[int | None] = (None,), ends: Sequence[int] = (), out_of_bag: bool = False) -> DataFrame:
        """Class shares of the trees on ``chunks`` (``VOTES``); out of bag, of the rows alone that a tree's bag lacks.

        A group of whole trees meets a part of the rows in one task.  Where a tree is too large for that, each row meets the one
        subtree of every tree that it falls into.
        """
        spark = chunks.sparkSession
        top = [{c: np.array(v, dtype=np.int64) for c, v in t.items()} for t in self.state["top"]]
        trees, slots, seed = len(top), spark.sparkContext.defaultParallelism, self.getOrDefault("seed")
        above = self._above(depths)
        grown = spark.read.parquet(self.subtrees)
        of_all = grown.groupBy("tree").agg(F.sum(sum(F.length(c) for c in PACKED_ARRAYS)).alias("bytes")).agg(F.max("bytes").alias("most"), F.sum("bytes").alias("sum")).first()
        most, every = of_all["most"] or 0, of_all["sum"] or 0

        def ended(t, node):
            return [a.get((t, node)) for a in above]

        def whole(asked, grown):
            if not len(asked) or not len(grown):
                return pd.DataFrame({c.split()[0]: [] for c in VOTES.split(", ")})
            parts = [lay.receive(v) for v in asked["rows"]]
            upto = np.cumsum([c.shape[1] for c in parts])
            chunk = [(int(c), int(u) - x.shape[1], int(u)) for c, x, u in zip(asked["chunk"], parts, upto)]
            rows, r = np.concatenate(parts, axis=1), np.frombuffer(b"".join(asked["r"]), np.int64)
            p1, n = np.zeros((len(depths), rows.shape[1])), np.zeros(rows.shape[1], np.int64)
            for t, own in grown.groupby("tree"):
                for i, node, some in _fallen(rows, r, t, own["node"]):
                    p1[:, i] += _walk(_unpack(own.iloc[node]), some, lay, depths, int(top[t]["depth"][own["node"].iloc[node]]), ended(t, int(own["node"].iloc[node])))
                    n[i] += 1
            return _voted(int(grown["tree"].min()), chunk, p1, n).to_pandas()

        def _fallen(rows, r, t, nodes):
            """(rows, place among ``nodes``, packed rows) of every subtree that some rows fall into."""
            s = np.flatnonzero(bag(r, seed, t) == 0) if out_of_bag else np.arange(rows.shape[1])
            if not len(s):
                return
            some = rows.take(s, axis=1) if out_of_bag else rows
            place = {int(v): k for k, v in enumerate(nodes)}
            if len(top[t]["left"]) == 1:
                if 0 in place:
                    yield (s if out_of_bag else slice(None)), place[0], some
                return
            at = descend_packed(top[t], some, lay)
            order = np.argsort(at, kind="stable")
            for i in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
                if int(at[i[0]]) in place:
                    yield s[i], place[int(at[i[0]])], some.take(i, axis=1)

        if most <= TREE_BYTES:
            rows = chunks.agg(F.sum("size")).first()[0] or 0
            parts = max(math.ceil(rows * lay.words / VOTE_ROWS), 1)
            groups = _ranges(trees, min(max(math.ceil(every / TREE_BYTES), math.ceil(slots / parts), 1), trees), ends)
            labels = _spread_labels(spark, parts * len(groups))
            cell = F.array(*[F.array(*[F.lit(labels[part * len(groups) + g]) for g in range(len(groups))]) for part in range(parts)])
            asked = chunks.select("chunk", "rows", "r", F.explode(F.element_at(cell, F.pmod(F.xxhash64("chunk"), F.lit(parts)).cast("int") + 1)).alias("cell"))
            group = F.element_at(F.array(*[F.lit(g) for g, own in enumerate(groups) for _ in own]), F.col("tree") + 1)
            cells = F.array(*[F.array(*[F.lit(labels[part * len(groups) + g]) for part in range(parts)]) for g in range(len(groups))])
            grown = grown.withColumn("cell", F.explode(F.element_at(cells, group + 1)))
            asked, grown = (d.repartition(len(labels), "cell").groupBy("cell") for d in (asked, grown))
            return asked.cogroup(grown).applyInPandas(whole, VOTES)

        def deal(batches):
            for b in batches:
                for chunk, rows, r in zip(b["chunk"], b["rows"], b["r"]):
                    rows, r = lay.receive(rows), np.frombuffer(r, np.int64)
                    for t in range(trees):
                        out = [(int(nodes[k]), i, some) for nodes in (np.unique(np.flatnonzero(top[t]["left"] < 0)),) for i, k, some in _fallen(rows, r, t, nodes)]
                        every = np.arange(rows.shape[1])
                        yield pd.DataFrame({"tree": t, "node": [v for v, _, _ in out], "chunk": chunk, "rows": [lay.send(some) for _, _, some in out],
                                            "at": [every[i].astype(np.uint16).tobytes() for _, i, _ in out]})

        def vote(asked, grown):
            if not len(asked) or not len(grown):
                return pd.DataFrame({c.split()[0]: [] for c in VOTES.split(", ")})
            t, node = int(asked["tree"].iloc[0]), int(asked["node"].iloc[0])
            tree, base = _unpack(grown.iloc[0]), int(top[t]["depth"][node])
            p1 = [_walk(tree, lay.receive(v), lay, depths, base, ended(t, node)) for v in asked["rows"]]
            return pd.DataFrame({"chunk": asked["chunk"], "first": t, "at": asked["at"], "p1": [v.tobytes() for v in p1],
                                 "n": [np.ones(v.shape[1], np.int32).tobytes() for v in p1]})

        n = min(max(sum(int((t["left"] < 0).sum()) for t in top), slots), 4000)
        asked = chunks.mapInPandas(deal, "tree int, node int, chunk bigint, rows binary, at binary").repartition(n, "tree", "node")
        return asked.groupBy("tree", "node").cogroup(grown.repartition(n, "tree", "node").groupBy("tree", "node")).applyInPandas(vote, VOTES)

    def _transform(self, df: DataFrame) -> DataFrame:
        """``df`` with probability and prediction."""
        name, trees, lay = f"__row_{uuid.uuid4().hex[:8]}", len(self.state["top"]), _packing(self.state["thresholds"])
        rows = df.withColumn(name, F.monotonically_increasing_id()).checkpoint(eager=True)
        chunks = _chunks(rows.select(F.col(name).alias("id"), vector_to_array(self.getOrDefault("featuresCol")).alias("x")), self.state["thresholds"], lay)
        sums = _added(self._votes(chunks, lay), chunks, trees).withColumn("p1", F.col("p1") / trees).drop("n").checkpoint(eager=True)
        p1 = F.col("p1")
        return (rows.join(sums.withColumnRenamed("id", name), name)
                .withColumn("probability", array_to_vector(F.array(1.0 - p1, p1))).withColumn("prediction", (p1 > 0.5).cast("double"))
                .drop(name, "p1"))

    def grid_counts(self, df: DataFrame, trees: Sequence[int], depths: Sequence[int | None]) -> dict:
        """{(trees, depth): (tp, fp, fn)} of class 1 on ``df`` for the first ``trees`` trees cut at ``depth`` (None: as grown), in one walk."""
        lay = _packing(self.state["thresholds"])
        chunks = _chunks(self._unseen(df), self.state["thresholds"], lay)
        return _counted(self._votes(chunks, lay, depths, trees), chunks, trees, depths)

    def out_of_bag(self, df: DataFrame) -> DataFrame:
        """The rows of ``df``, those of the fit, with the sum p1 of the class shares and the number n of the trees whose bags lack the row."""
        name, lay = f"__row_{uuid.uuid4().hex[:8]}", _packing(self.state["thresholds"])
        rows = df.withColumn(name, F.monotonically_increasing_id()).checkpoint(eager=True)
        chunks = _chunks(self._rows(rows).select(F.col(name).alias("id"), "x", "r"), self.state["thresholds"], lay)
        sums = _added(self._votes(chunks, lay, out_of_bag=True), chunks, len(self.state["top"]))
        return rows.join(sums.withColumnRenamed("id", name), name).drop(name)

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        DefaultParamsWriter.saveMetadata(self.model, path, spark)
        spark.createDataFrame([(json.dumps(self.model.state),)], "state string").write.parquet(f"{path}/state")
        spark.read.parquet(self.model.subtrees).write.parquet(f"{path}/subtrees")


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = ForestModel(json.loads(spark.read.parquet(f"{path}/state").first()["state"]), f"{path}/subtrees")
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
