"""Token counts with a whole-token shortcut.

Before the job, every vocabulary string that ends a word is run through the merge
table once; those that come out as a single token are *proven whole*.  On the
executors a pre-token found among them counts one without merging; only the
rest is merged, and each worker remembers a bounded number of such results.

The tokenizer file is the JSON of a byte-level BPE with word ends (NFC, white
space folded, lower case).  Special strings inside a text are matched on the raw
text and count one each, as the library does by default.

Defined cases: null text counts as empty (0 bytes, 0 tokens, not over the
limit); repeated rows are returned as often as they occur; an empty table gives
an empty result; only the id and text columns are read, so extra columns never
clash; a null id is returned.  Texts are never cut: a long text is processed
whole, in one pass.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lanthorn.llm.common import id_and_text
from lanthorn.llm.textbuf import long_column

SPACE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
CACHE_WORDS = 500_000
GROUP_CHARS = 2_000_000
LONG_WORD = 256
NEVER = 1 << 40
SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in keep}
    for i, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + i)
    return [out[b] for b in range(256)]


class WordBpe:
    """Merge table, pre-token pattern and the proven whole tokens of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", SPACE)
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int64)
        self.final = np.array([vocab[s + end] for s in symbols], dtype=np.int64)
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        byte_of = {s: b for b, s in enumerate(symbols)}
        ends = [v[: -len(end)] for v in vocab if v.endswith(end)]
        words = [bytes(map(byte_of.__getitem__, v)) for v in ends]
        self.whole = {w for w, n in zip(words, self.merged(words)) if n == 1}

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of merging each pair of ids, ``NEVER`` where the table has none."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def merged(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each word: the lowest-ranked pair, leftmost first, is merged until none is left.

        Words of one length are rows of a matrix; each round merges one pair in every
        row that still has one, so the matrix narrows by a column a round.
        """
        out = np.zeros(len(words), dtype=np.int64)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            if n > LONG_WORD:
                out[at] = [self.merged_long(words[i]) for i in at]
                continue
            raw = np.frombuffer(b"".join([words[i] for i in at]), dtype=np.uint8).reshape(len(at), n)
            ids = self.inner[raw]
            ids[:, -1] = self.final[raw[:, -1]]
            r = self.rank(ids[:, :-1], ids[:, 1:])
            while n > 1:
                best = r.argmin(axis=1)
                rows = np.arange(len(at))
                low = r[rows, best]
                live = low < NEVER
                out[at[~live]] = n
                at, ids, r, best, low = at[live], ids[live], r[live], best[live], low[live]
                if not len(at):
                    break
                rows = np.arange(len(at))
                ids[rows, best] = self.made[low]
                left = np.arange(n - 1)[None, :]
                ids = np.take_along_axis(ids, left + (left > best[:, None]), axis=1)
                n -= 1
                if n > 1:
                    left = left[:, :-1]
                    r = np.take_along_axis(r, left + (left >= best[:, None]), axis=1)
                    for column, has in ((best - 1, best > 0), (best, best < n - 1)):
                        i, c = rows[has], column[has]
                        r[i, c] = self.rank(ids[i, c], ids[i, c + 1])
            out[at] = n
        return out

    def merged_long(self, word: bytes) -> int:
        """The same for one very long word, by a heap of pairs over a linked list."""
        ids = [*self.inner[list(word[:-1])].tolist(), int(self.final[word[-1]])]
        rank = {int(k): int(v) for k, v in zip(self.keys, self.ranks)}
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(rank[k], i, k) for i in range(n - 1) if (k := ids[i] << 32 | ids[i + 1]) in rank]
        heapq.heapify(heap)
        count = n
        while heap:
            r, i, k = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or ids[i] << 32 | ids[j] != k:
                continue
            ids[i], ids[j] = int(self.made[r]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            count -= 1
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (k := ids[a] << 32 | ids[b]) in rank:
                    heapq.heappush(heap, (rank[k], a, k))
        return count


def counter(bpe: WordBpe, bound: int = CACHE_WORDS):
    """A function from texts to their numbers of tokens.

    Pre-tokens proven whole count one; the others are merged once per batch and
    remembered, ``bound`` words at most.
    """
    find = regex.compile(bpe.pattern, regex.V0).findall
    fold = regex.compile(f"[{SPACE}]+").sub
    split = regex.compile("(" + "|".join(map(regex.escape, bpe.special)) + ")").split
    special = set(bpe.special)
    known: dict[str, int] = {w.decode(): 1 for w in bpe.whole if _is_text(w)}
    proven = len(known)

    def pre_tokens(text: str) -> tuple[list[str], int]:
        words, marks = [], 0
        for part in split(text) if any(s in text for s in special) else (text,):
            if part in special:
                marks += 1
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            words += find(fold(" ", part).lower())
        return words, marks

    def count(texts: list[str]) -> list[int]:
        cut = [pre_tokens(t) for t in texts]
        new = list(set().union(*(w for w, _ in cut)).difference(known))
        if len(known) + len(new) > proven + bound:
            for w in list(known)[proven:]:
                del known[w]
            new = list(set().union(*(w for w, _ in cut)).difference(known))
        known.update(zip(new, bpe.merged([w.encode() for w in new]).tolist()))
        return [sum(map(known.__getitem__, w)) + marks for w, marks in cut]

    return count


def _is_text(w: bytes) -> bool:
    try:
        w.decode()
    except UnicodeDecodeError:
        return False
    return True


def groups(texts: list[str], size: int):
    """Consecutive texts of ``size`` code points in all, or a longer one alone."""
    part, held = [], 0
    for t in texts:
        if part and held + len(t) > size:
            yield part
            part, held = [], 0
        part.append(t)
        held += len(t)
    if part:
        yield part


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(WordBpe(tokenizer_path))  # bounded by the vocabulary

    def run(batches):
        count = counter(shared.value)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            n = [x for part in groups(texts, GROUP_CHARS) for x in count(part)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), long_column([len(t.encode()) for t in texts]), long_column(n),
                 pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)
