"""Language identification by cross-parsing entropy.

Per language a suffix automaton accepts the substrings of labelled text.  A text is parsed
greedily into longest substrings that the automaton knows; the fewer phrases a
language needs, the better it explains the text.  Phrase counts are normalised by
the log of the language's training length (Ziv-Merhav cross entropy), and the
least wins.

Training is bounded: per language at most ``train_docs`` documents of ``train_min`` to
``train_max`` characters, those with the smallest hash of their text, whole.  A language with fewer of them
is filled up with whole texts of the nearest lengths, up to as many characters in all as ``train_docs`` texts
of middle length have (its nearest text is taken whatever its length).  Everything else covers all data.  Every letter
of the training texts has a symbol of its own, in all scripts; edges of the most frequent symbols lie in a dense table, the
others in a sorted list.  Prediction reads the text only.  Texts are parsed
whole, in windows of ``WINDOW`` symbols stepped side by side (a window border ends a phrase).

Defined cases: null text or one without letters is ``und`` with score 0; ties go to the language
first in code point order; rows without a label are not learned from; without any training
text every row is ``und``; repeated rows are returned as often as they occur; an
empty table gives an empty result; extra columns are not read; null ids are returned, held out false.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanthorn.llm.common import id_and_text
from lanthorn.llm.textbuf import long_column

WINDOW = 1024
GROUP_CHARS = 1 << 20
SYMBOLS = 64  # symbols of the dense table; 0: anything that is no letter, 1: a letter unseen in training, 2..: training letters by frequency
UNDETERMINED = "und"
SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double"
_letter = regex.compile(r"\p{L}")


def held_out(id_col: str = "doc_id"):
    """Whether crc32 of the id as text is 2 modulo 4 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_texts(docs: DataFrame, train_docs: int, train_min: int, train_max: int) -> dict[str, list[str]]:
    """At most ``train_docs`` whole labelled texts per language, or the nearest ones in length (bounded, to the driver)."""
    text = F.col("text").cast("string")
    known = docs.where(F.col("lang").isNotNull() & ~held_out())
    known = known.select(F.col("lang").cast("string").alias("lang"), text.alias("text"), F.xxhash64(text).alias("h"))
    fit = known.where(F.length("text").between(train_min, train_max))
    # salted two-step selection: a task sees at most train_docs rows per language and salt
    salt = F.pmod("h", F.lit(64))
    one = Window.partitionBy("lang", "salt").orderBy("h", "text")
    few = fit.dropDuplicates(["lang", "h"]).withColumn("salt", salt).withColumn("r", F.row_number().over(one))
    few = few.where(F.col("r") <= train_docs).withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text")))
    out: dict[str, list[str]] = {}
    for row in few.where(F.col("r") <= train_docs).orderBy("lang", "h").collect():
        out.setdefault(row["lang"], []).append(row["text"])
    thin = [r["lang"] for r in known.select("lang").distinct().collect() if len(out.get(r["lang"], [])) < train_docs]
    if thin:
        nearest_texts(known.where(F.col("lang").isin(thin)), out, train_min, train_max, train_docs * (train_min + train_max) // 2)
    return out


def nearest_texts(known: DataFrame, out: dict[str, list[str]], train_min: int, train_max: int, chars: int) -> None:
    """Add to ``out`` the whole texts nearest to the band, up to ``chars`` characters per language, one at least.

    They are chosen by hash and length; only the texts of the chosen ones travel.
    """
    n = F.length("text")
    far = known.where(~n.between(train_min, train_max) & F.col("text").rlike(r"\p{L}"))
    far = far.select("lang", "h", n.alias("n"), F.greatest(train_min - n, n - train_max).alias("far")).distinct()
    # salted two-step selection, as for the band
    for by in (["lang", F.pmod("h", F.lit(64))], ["lang"]):
        order = Window.partitionBy(*by).orderBy("far", "h", "n").rowsBetween(Window.unboundedPreceding, -1)
        far = far.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0))).where(F.col("before") < chars).drop("before")
    total = {lang: sum(map(len, texts)) for lang, texts in out.items()}
    full, chosen = set(), []
    for row in far.orderBy("lang", "far", "h", "n").collect():
        lang = row["lang"]
        if lang not in full and (total.get(lang, 0) + row["n"] <= chars or lang not in total):
            total[lang] = total.get(lang, 0) + row["n"]
            chosen.append((lang, row["h"], row["n"]))
        else:
            full.add(lang)
    if not chosen:
        return
    want = known.sparkSession.createDataFrame(chosen, "lang string, h bigint, n int")  # bounded by languages x chars
    texts = known.withColumn("n", n).join(F.broadcast(want), ["lang", "h", "n"], "left_semi").dropDuplicates(["lang", "h", "n"])
    found = {(r["lang"], r["h"], r["n"]): r["text"] for r in texts.collect()}
    for key in chosen:
        out.setdefault(key[0], []).append(found[key])


def automaton(symbols: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Transitions of the suffix automaton of a symbol string.

    A table (states, SYMBOLS) int32, -1 where none, and rows (state, symbol, target) of the symbols from SYMBOLS on.
    """
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    table = np.full((len(nxt), SYMBOLS), -1, dtype=np.int32)
    rare = []
    for s, edges in enumerate(nxt):
        for c, t in edges.items():
            if c < SYMBOLS:
                table[s, c] = t
            else:
                rare.append((s, c, t))
    return table, np.array(rare, dtype=np.int64).reshape(-1, 3)


class Model:
    """Alphabet and automata of all languages, in one transition table and one list of rarer symbols' edges."""

    def __init__(self, texts: dict[str, list[str]]):
        self.langs = sorted(texts)
        count: dict[str, int] = {}
        for parts in texts.values():
            for t in parts:
                for ch in t.lower():
                    if ch.isalpha():
                        count[ch] = count.get(ch, 0) + 1
        letters = sorted(count, key=lambda c: (-count[c], c))
        self.size = max(len(letters) + 2, SYMBOLS)
        self.code = np.ones(0x110000, dtype=np.min_scalar_type(self.size))
        self.code[[c for c in range(0x110000) if not chr(c).isalpha()]] = 0
        for i, ch in enumerate(letters):
            self.code[ord(ch)] = i + 2
        tables, rares, self.roots, self.norm, at = [], [], [], [], 0
        for lang in self.langs:
            symbols = [int(s) for t in texts[lang] for s in self.encode(" " + t + " ")]
            table, rare = automaton(symbols)
            rares.append(rare + np.array([at, 0, at]))
            tables.append(np.where(table >= 0, table + at, -1).astype(np.int32))
            self.roots.append(at)
            self.norm.append(np.log2(max(len(symbols), 2)))
            at += len(table)
        self.table = np.concatenate(tables) if tables else np.zeros((0, SYMBOLS), np.int32)
        rare = np.concatenate([*rares, np.zeros((0, 3), np.int64)])
        keys = rare[:, 0] * self.size + rare[:, 1]
        order = np.argsort(keys)
        # a last key that no state has ends the list, so every search lands inside
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.targets = np.append(rare[order, 2], -1).astype(np.int32)
        every = np.arange(self.size)
        self.first = np.array([self.step(np.full((1, self.size), r), every, True)[0] for r in self.roots]).reshape(-1, self.size)

    def step(self, state: np.ndarray, s: np.ndarray, rare: bool) -> np.ndarray:
        """(languages, windows) states after symbols ``s``, -1 where there is no edge; ``rare``: some may lie beyond the table."""
        if not rare:
            return self.table[state, s]
        to = self.table[state, np.where(s < SYMBOLS, s, 1)]  # symbol 1 has no edges
        at = np.flatnonzero(s >= SYMBOLS)
        if len(at):
            key = state[:, at].astype(np.int64) * self.size + s[at]
            place = np.searchsorted(self.keys, key)
            to[:, at] = np.where(self.keys[place] == key, self.targets[place], -1)
        return to

    def encode(self, text: str) -> np.ndarray:
        """Symbols of a lower-cased text; runs of non-letters are one symbol 0."""
        cp = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
        s = self.code[cp]
        keep = np.ones(len(s), dtype=bool)
        keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
        return s[keep]

    def phrase_counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts, languages) phrases of the greedy parse, and symbols per text."""
        coded = [self.encode(t) for t in texts]
        size = np.array([len(c) for c in coded], dtype=np.int64)
        pieces = (size + WINDOW - 1) // WINDOW
        owner = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = (np.cumsum(size) - size)[owner] + nth * WINDOW
        width = np.minimum(WINDOW, size[owner] - nth * WINDOW)
        order = np.argsort(-width, kind="stable")
        start, width, owner = start[order], width[order], owner[order]
        flat = np.concatenate([*coded, np.zeros(1, self.code.dtype)])
        rare = int(flat.max()) >= SYMBOLS
        live = np.searchsorted(-width, -np.arange(WINDOW), side="left")  # windows longer than each step
        roots = np.array(self.roots, dtype=np.int32)[:, None]
        state = np.repeat(roots, len(start), axis=1)
        count = np.zeros(state.shape, dtype=np.int32)
        for step in range(int(width.max(initial=0))):
            n = live[step]
            s = flat[start[:n] + step]
            to = self.step(state[:, :n], s, rare)
            stuck = to < 0
            count[:, :n] += stuck
            again = self.first[:, s]  # a new phrase begins with this symbol; an unseen one is a phrase by itself
            unseen = again < 0
            count[:, :n] += unseen & (state[:, :n] != roots)
            state[:, :n] = np.where(stuck, np.where(unseen, roots, again), to)
        count += state != roots  # the phrase that the window's end leaves open
        out = np.zeros((len(texts), len(roots)), dtype=np.int64)
        for k in range(len(roots)):
            out[:, k] = np.bincount(owner, weights=count[k], minlength=len(texts))
        return out, size


def predict(model: Model, texts: list[str]) -> tuple[list[str], list[float]]:
    """Language and score of each text; the score is 1 - (least cost / mean cost of the others) / 2."""
    if not model.langs:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts)
    phrases, _ = model.phrase_counts(texts)
    cost = phrases * np.array(model.norm)[None, :]
    best = cost.argmin(axis=1)
    least = cost[np.arange(len(texts)), best]
    others = (cost.sum(axis=1) - least) / max(len(model.langs) - 1, 1)
    score = np.clip(1 - least / np.maximum(others, 1e-9) / 2, 0.0, 1.0)
    known = [bool(_letter.search(t)) for t in texts]
    return ([model.langs[b] if k else UNDETERMINED for b, k in zip(best, known)],
            [float(s) if k else 0.0 for s, k in zip(score, known)])


def identify(docs: DataFrame, train_docs: int = 16, train_min: int = 200, train_max: int = 2000, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    learn = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = Model(training_texts(learn, train_docs, train_min, train_max))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by languages x train_docs x train_max, or the nearest text where longer

    def run(batches):
        m = shared.value
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            lang, score = [], []
            at = 0
            while at < len(texts):
                end, held = at, 0
                while end < len(texts) and (end == at or held + len(texts[end]) <= GROUP_CHARS):
                    held += len(texts[end])
                    end += 1
                found = predict(m, texts[at:end])
                lang += found[0]
                score += found[1]
                at = end
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return id_and_text(docs, id_col, text_col).withColumn("held_out", held_out()).mapInArrow(run, SCHEMA)
