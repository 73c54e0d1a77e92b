"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded; learned filters eight bytes wide slide over the whole text in steps of four.
Overlapping chunks (512 bytes, every 256) are max-pooled per filter, and the mean and the maximum over
a text's chunks feed one logistic unit.  The network is trained on a bounded sample of labelled
rows, ``per_class`` whole texts per label (those whose ids have the smallest hash, without the held-out
quarter), and then scores every whole text on the executors.

Defined cases: null text counts as empty; an empty text gets the score of the bare
network (no bytes but padding); labels other than 0 and 1 and labels of unknown documents are not learned
from; without labels of both kinds the score is 0.5; repeated rows are returned as often as they occur;
an empty table gives an empty result; extra columns are not read; null ids are returned, held out false.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanthorn.llm.common import id_and_bytes
from lanthorn.llm.langid import held_out

STEP = 4          # bytes per step; a filter covers two steps
HALF_CHUNK = 64   # steps per half chunk
DIM, FILTERS = 8, 24
PER_CLASS = 1500
MAX_TRAIN_BYTES = 30_000
EPOCHS, LEAST_STEPS, BATCH, RATE = 10, 350, 48, 4e-3
THRESHOLD = 0.7
GROUP_BYTES = 1 << 20
SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int"


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes padded per text to whole steps plus one, first step of each text, steps of each text."""
    steps = np.array([(len(t) + STEP - 1) // STEP + 2 for t in texts], dtype=np.int64)
    flat = b"".join([t.ljust(int(s) * STEP, b"\0") for t, s in zip(texts, steps)])
    return np.frombuffer(flat, dtype=np.uint8), np.cumsum(steps) - steps, steps


class Net:
    """Embedding, two half filters, a filter bias and the output unit."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {
            "emb": r.normal(0, 0.5, (256, DIM)).astype(np.float32),
            "near": r.normal(0, 0.2, (STEP * DIM, FILTERS)).astype(np.float32),
            "far": r.normal(0, 0.2, (STEP * DIM, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "out": r.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
            "out_bias": np.zeros(1, np.float32),
        }

    def forward(self, texts: list[bytes], argmax: bool = False):
        """Document features (and, for training, which step won each chunk and filter)."""
        p = self.p
        flat, first, steps = laid_out(texts)
        x = p["emb"][flat].reshape(-1, STEP * DIM)
        both = x @ np.concatenate([p["near"], p["far"]], axis=1)
        y = both[:, :FILTERS].copy()
        y[:-1] += both[1:, FILTERS:]
        y += p["bias"]
        np.maximum(y, 0, out=y)
        y[first + steps - 1] = 0  # the step after a text's last would see the next text
        halves = (steps + HALF_CHUNK - 1) // HALF_CHUNK
        owner = np.repeat(np.arange(len(texts)), halves)
        begin = np.cumsum(halves) - halves
        nth = np.arange(len(owner)) - begin[owner]
        at = first[owner] + nth * HALF_CHUNK
        m = np.maximum.reduceat(y, at, axis=0)
        last = np.append(owner[1:] != owner[:-1], True)
        chunk = m.copy()
        chunk[:-1] = np.where(last[:-1, None], m[:-1], np.maximum(m[:-1], m[1:]))
        use = ~last | (nth == 0)  # a text of one half chunk is one chunk; else the last half is in the chunk before
        n_chunks = np.bincount(owner[use], minlength=len(texts))
        cown = owner[use]
        c = chunk[use]
        starts = np.cumsum(n_chunks) - n_chunks
        mean = np.add.reduceat(c, starts, axis=0) / n_chunks[:, None]
        top = np.maximum.reduceat(c, starts, axis=0)
        feats = np.concatenate([mean, top], axis=1)
        if not argmax:
            return feats
        return feats, {"flat": flat, "x": x, "y": y, "at": at, "end": np.minimum(at + HALF_CHUNK, (first + steps)[owner]),
                       "m": m, "c": c, "use": np.flatnonzero(use), "cown": cown, "last": last, "n_chunks": n_chunks, "top": top}

    def scores(self, texts: list[bytes]) -> np.ndarray:
        z = self.forward(texts) @ self.p["out"] + self.p["out_bias"][0]
        return 1.0 / (1.0 + np.exp(-z.astype(np.float64)))

    def gradients(self, texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        feats, k = self.forward(texts, argmax=True)
        prob = 1 / (1 + np.exp(-(feats @ p["out"] + p["out_bias"][0])))
        dz = ((prob - labels) * weights / len(texts)).astype(np.float32)
        g = {"out": feats.T @ dz, "out_bias": np.array([dz.sum()], np.float32)}
        dm, dt = dz[:, None] * p["out"][:FILTERS], dz[:, None] * p["out"][FILTERS:]
        dc = dm[k["cown"]] / k["n_chunks"][k["cown"], None]
        winner = k["c"] == k["top"][k["cown"]]
        share = np.zeros_like(k["top"])
        np.add.at(share, k["cown"], winner)
        dc = dc + winner * (dt / np.maximum(share, 1))[k["cown"]]
        # a chunk's maximum lies in one of its two halves; inside a half, at the first step that has it
        half = np.repeat(k["use"][:, None], FILTERS, axis=1)
        right = ~k["last"][k["use"]]
        nxt = np.minimum(k["use"] + 1, len(k["m"]) - 1)
        better = right[:, None] & (k["m"][nxt] > k["m"][k["use"]])
        half = half + better
        f = np.repeat(np.arange(FILTERS)[None, :], len(half), axis=0).ravel()
        half, d = half.ravel(), dc.ravel()
        live = (k["m"][half, f] > 0) & (d != 0)
        half, f, d = half[live], f[live], d[live]
        span = np.arange(HALF_CHUNK)[None, :]
        where = np.minimum(k["at"][half][:, None] + span, k["end"][half][:, None] - 1)
        step = np.take_along_axis(where, k["y"][where, f[:, None]].argmax(axis=1)[:, None], axis=1)[:, 0]
        own, after = k["x"][step], k["x"][step + 1]
        g["bias"] = np.bincount(f, weights=d, minlength=FILTERS).astype(np.float32)
        hot = np.zeros((len(f), FILTERS), np.float32)
        hot[np.arange(len(f)), f] = d
        g["near"], g["far"] = own.T @ hot, after.T @ hot
        g["emb"] = np.zeros_like(p["emb"])
        for kind, s in (("near", step), ("far", step + 1)):
            back = (hot @ p[kind].T).reshape(-1, DIM)
            np.add.at(g["emb"], k["flat"].reshape(-1, STEP)[s].ravel(), back)
        return g

    def fit(self, texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> "Net":
        """Adam on the weighted logistic loss; both labels weigh the same."""
        share = np.bincount(labels.astype(int), minlength=2) / len(labels)
        weights = 0.5 / share[labels.astype(int)]
        r = np.random.default_rng(seed)
        first = {n: np.zeros_like(v) for n, v in self.p.items()}
        second = {n: np.zeros_like(v) for n, v in self.p.items()}
        t = 0
        epochs = max(epochs, -(-LEAST_STEPS * BATCH // len(texts)))
        for epoch in range(epochs):
            order = r.permutation(len(texts))
            rate = RATE * (1 - epoch / epochs) + RATE / 20
            for i in range(0, len(order), BATCH):
                pick = order[i:i + BATCH]
                t += 1
                for n, g in self.gradients([texts[j] for j in pick], labels[pick], weights[pick]).items():
                    first[n] = 0.9 * first[n] + 0.1 * g
                    second[n] = 0.99 * second[n] + 0.01 * g * g
                    self.p[n] -= (rate * (first[n] / (1 - 0.9 ** t)) / (np.sqrt(second[n] / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)
        return self


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[list[bytes], np.ndarray]:
    """At most ``per_class`` whole texts of each label, to the driver; the ids are chosen on the labels alone."""
    known = labels.where("quality in (0, 1) and doc_id is not null").where(~held_out()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropDuplicates(["doc_id"])
    known = known.withColumn("h", F.xxhash64("doc_id"))
    picked = None
    for q in (0, 1):
        few = known.where(F.col("quality") == q).orderBy("h", "doc_id").limit(per_class)
        picked = few if picked is None else picked.union(few)
    rows = docs.where(F.length("text") <= MAX_TRAIN_BYTES).join(F.broadcast(picked), "doc_id").select("h", "doc_id", "text", "quality")
    got = sorted(((r["h"], r["doc_id"], bytes(r["text"] or b""), r["quality"]) for r in rows.dropDuplicates(["doc_id"]).collect()))
    return [g[2] for g in got], np.array([g[3] for g in got], dtype=np.float32)


def classify(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = THRESHOLD, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; ``labels`` holds (doc_id, quality)."""
    base = id_and_bytes(docs, id_col, text_col)
    texts, known = training_rows(base, labels, per_class)
    net = Net().fit(texts, known) if len(set(known.tolist())) == 2 else None
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few thousand numbers

    def run(batches):
        for b in batches:
            texts = [t or b"" for t in b.column(1).to_pylist()]
            score, at = [], 0
            while at < len(texts):
                end, held = at, 0
                while end < len(texts) and (end == at or held + len(texts[end]) <= GROUP_BYTES):
                    held += len(texts[end])
                    end += 1
                score.append(shared.value.scores(texts[at:end]) if shared.value else np.full(end - at, 0.5))
                at = end
            s = np.concatenate(score) if score else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return base.withColumn("held_out", held_out()).mapInArrow(run, SCHEMA)
