"""SentencePiece encoding and decoding by suffix-array matching.

A batch's distinct words lie end to end in one symbol text.  Its suffixes are sorted, every
vocabulary piece is found by binary search as a range of them, and each occurrence is
an edge from its first to its last position.  The edges are sorted by end position and
relaxed position by position: a prefix's encoding is that of a shorter prefix plus one
edge, namely the only edge that may follow that prefix's last piece.  Two pieces
may follow each other exactly when merging their symbols from scratch gives these two
pieces back; answers are remembered per pair.  This yields the byte-pair (BPE)
segmentation of the library, whose merges go by score and then from the left.

Words are cut before each run of word marks that follows another symbol, as no piece reaches
across such a place (checked when the model is loaded).  Symbols outside the vocabulary
become byte pieces.

Defined cases: null text counts as empty and has no pieces; the word mark itself in a text
decodes to a blank, as in the library; repeated rows are returned as often as they
occur; an empty table gives an empty result; extra columns are not read; null ids are
returned.  Texts are never cut.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lanthorn.llm.common import id_and_text
from lanthorn.llm.textbuf import long_column

MARK = "▁"
WIDTH = 16          # symbols by which suffixes are sorted; no piece may be longer
GROUP_CHARS = 1 << 20
CACHE_WORDS = 400_000
CACHE_PAIRS = 4_000_000
LONG = 1 << 40
ENCODED = "doc_id bigint, text string, n_pieces bigint, n_byte_pieces bigint, ids binary"
DECODED = ENCODED + ", decoded string"
_words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall


class PieceModel:
    """Pieces, scores and merge pairs of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        if proto.trainer_spec.model_type != 2 or proto.normalizer_spec.precompiled_charsmap:
            raise ValueError("a BPE model without text normalisation is needed")
        if proto.normalizer_spec.remove_extra_whitespaces or not proto.normalizer_spec.escape_whitespaces:
            raise ValueError("a model that keeps and marks white space is needed")
        self.prefix = MARK if proto.normalizer_spec.add_dummy_prefix else ""
        normal = {i: p.piece for i, p in enumerate(proto.pieces) if p.type == 1}
        self.byte_id = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == 6}
        if any(MARK in p[1:] and p.strip(MARK) for p in normal.values()) or max(map(len, normal.values())) > WIDTH:
            raise ValueError("pieces reach across words or are too long")
        letters = sorted({c for p in normal.values() for c in p})
        self.letters = {c: i + 1 for i, c in enumerate(letters)}
        self.unknown = len(letters) + 1
        self.code = np.full(0x110000, self.unknown, dtype=np.uint16)
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        # node numbers: one per symbol first (0 is the gap between words), then one per longer piece
        longer = [i for i, p in normal.items() if len(p) > 1]
        node = {c: k for c, k in self.letters.items()} | {normal[i]: self.unknown + 1 + k for k, i in enumerate(longer)}
        self.nodes = self.unknown + 1 + len(longer)
        self.id_of = np.full(self.nodes, -1, dtype=np.int32)
        ids = {p: i for i, p in normal.items()}
        for p, n in node.items():
            self.id_of[n] = ids.get(p, -1)
        score = {p: proto.pieces[i].score for p, i in ids.items()}
        order = {s: r for r, s in enumerate(sorted({score[normal[i]] for i in longer}, reverse=True))}
        self.length = np.ones(self.nodes, dtype=np.int64)
        self.spell = np.zeros((self.nodes, WIDTH), dtype=np.uint16)
        self.spell[: self.unknown + 1, 0] = np.arange(self.unknown + 1)
        merges = []
        for i in longer:
            p = normal[i]
            n = node[p]
            self.length[n] = len(p)
            self.spell[n, : len(p)] = [self.letters[c] for c in p]
            for k in range(1, len(p)):
                if p[:k] in node and p[k:] in node:
                    merges.append((node[p[:k]] << 32 | node[p[k:]], order[score[p]], n))
        merges = np.array(sorted(merges), dtype=np.int64).reshape(-1, 3)
        self.keys, self.ranks, self.made = merges[:, 0].copy(), merges[:, 1].copy(), merges[:, 2].copy()
        self.raw = [b""] * len(proto.pieces)
        for i, p in enumerate(proto.pieces):
            self.raw[i] = p.piece.replace(MARK, " ").encode() if p.type == 1 else bytes([int(p.piece[1:-1], 16)]) if p.type == 6 else b""

    def rank(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], LONG), self.made[at]

    def follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the symbols of a then b from scratch ends with just (a, b); a = 0: with b alone."""
        out = np.zeros(len(a), dtype=bool)
        la, lb = np.where(a > 0, self.length[a], 0), self.length[b]
        for n in np.unique(la + lb):
            at = np.flatnonzero(la + lb == n)
            ids = np.zeros((len(at), n), dtype=np.int64)
            column = np.arange(n)[None, :]
            cut = la[at][:, None]
            left = self.spell[a[at]][np.arange(len(at))[:, None], np.minimum(column, WIDTH - 1)]
            right = self.spell[b[at]][np.arange(len(at))[:, None], np.clip(column - cut, 0, WIDTH - 1)]
            ids = np.where(column < cut, left, right).astype(np.int64)
            goal_a, goal_b, goal = a[at], b[at], np.where(a[at] > 0, 2, 1)
            r, made = self.rank(ids[:, :-1], ids[:, 1:])
            width = int(n)
            while True:
                if width > 1:
                    best = r.argmin(axis=1)
                    rows = np.arange(len(at))
                    live = r[rows, best] < LONG
                else:
                    live = np.zeros(len(at), dtype=bool)
                done = ~live
                two = done & (goal == width)
                ok = two & (ids[:, width - 1] == goal_b) & ((goal == 1) | (ids[:, 0] == goal_a))
                out[at[ok]] = True
                if not live.any():
                    break
                at, ids, r, made, best = at[live], ids[live], r[live], made[live], best[live]
                goal_a, goal_b, goal = goal_a[live], goal_b[live], goal[live]
                rows = np.arange(len(at))
                ids[rows, best] = made[rows, best]
                keep = np.arange(width - 1)[None, :]
                ids = np.take_along_axis(ids, keep + (keep > best[:, None]), axis=1)
                width -= 1
                if width > 1:
                    keep = keep[:, :-1]
                    pick = keep + (keep >= best[:, None])
                    r, made = np.take_along_axis(r, pick, axis=1), np.take_along_axis(made, pick, axis=1)
                    for c, has in ((best - 1, best > 0), (best, best < width - 1)):
                        i, j = rows[has], c[has]
                        r[i, j], made[i, j] = self.rank(ids[i, j], ids[i, j + 1])
        return out


class Encoder:
    """Encodes texts of one worker; remembers a bounded number of words and of piece pairs."""

    def __init__(self, model: PieceModel):
        self.m = model
        self.words: dict[str, bytes] = {}
        self.pairs = np.zeros(0, dtype=np.int64)
        self.fits = np.zeros(0, dtype=bool)

    def allowed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key, back = np.unique(a << 32 | b, return_inverse=True)
        at = np.searchsorted(self.pairs, key)
        known = at < len(self.pairs)
        known[known] = self.pairs[at[known]] == key[known]
        if not known.all():
            new = key[~known]
            fits = self.m.follows(new >> 32, new & 0xFFFFFFFF)
            if len(self.pairs) + len(new) > CACHE_PAIRS:
                self.pairs, self.fits = self.pairs[:0], self.fits[:0]
                return self.m.follows(key >> 32, key & 0xFFFFFFFF)[back]
            pairs = np.concatenate([self.pairs, new])
            order = np.argsort(pairs, kind="stable")
            self.pairs, self.fits = pairs[order], np.concatenate([self.fits, fits])[order]
            at = np.searchsorted(self.pairs, key)
        return self.fits[at][back]

    def edges(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, node) of every piece occurrence in a symbol text, sorted by end."""
        n = len(s)
        used = np.unique(np.append(s, 0))  # symbols of this batch, the gap first; renumbered in order
        renumber = np.zeros(self.m.unknown + 1, dtype=np.int64)
        renumber[used] = np.arange(len(used))
        kind = np.dtype(">u1") if len(used) < 255 else np.dtype(">u2")
        wide = np.concatenate([renumber[s], np.zeros(WIDTH, np.int64)]).astype(kind)
        rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(wide, WIDTH)[:n])
        quads = rows.view(">u8").astype(np.uint64)
        order = np.lexsort(quads.T[::-1])
        keys = rows[order].view(f"S{WIDTH * kind.itemsize}").reshape(-1)
        has = np.zeros(self.m.unknown + 1, dtype=bool)
        has[used] = True
        here = has[self.m.spell[self.m.unknown + 1:]].all(axis=1)
        piece = np.flatnonzero(here)
        spell, size = renumber[self.m.spell[self.m.unknown + 1:][piece]], self.m.length[self.m.unknown + 1:][piece]
        beyond = np.arange(WIDTH)[None, :] >= size[:, None]
        low = np.ascontiguousarray(spell.astype(kind)).view(keys.dtype).reshape(-1)
        high = np.ascontiguousarray(np.where(beyond, (1 << 8 * kind.itemsize) - 1, spell).astype(kind)).view(keys.dtype).reshape(-1)
        lo = np.searchsorted(keys, low, side="left")
        hi = np.searchsorted(keys, high, side="right")
        found = np.flatnonzero(hi > lo)
        times = hi[found] - lo[found]
        place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(lo[found], times)
        start = order[place]
        node = np.repeat(piece[found] + self.m.unknown + 1, times)
        single = np.flatnonzero(s)
        start = np.concatenate([single, start])
        node = np.concatenate([s[single].astype(np.int64), node])
        return start, start + self.m.length[node], node

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids (int32, little endian) of each word."""
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        text = "".join(words)
        cp = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
        gap = size + 1
        begin = np.cumsum(gap) - gap
        s = np.zeros(int(gap.sum()), dtype=np.uint16)
        mask = np.ones(len(s), dtype=bool)
        mask[begin + size] = False
        s[mask] = self.m.code[cp]
        start, end, node = self.edges(s)
        depth = end - begin[np.searchsorted(begin, start, side="right") - 1]  # end within the word
        order = np.argsort(depth, kind="stable")
        start, end, node, depth = start[order], end[order], node[order], depth[order]
        last = np.zeros(len(s) + 1, dtype=np.int64)   # node of the last piece of each prefix; 0 at a word's begin
        origin = np.zeros(len(s) + 1, dtype=np.int64)
        borders = np.searchsorted(depth, np.arange(1, int(size.max(initial=0)) + 2))
        for lo, hi in zip(borders[:-1], borders[1:]):
            ok = self.allowed(last[start[lo:hi]], node[lo:hi])
            last[end[lo:hi][ok]] = node[lo:hi][ok]
            origin[end[lo:hi][ok]] = start[lo:hi][ok]
        owner, nodes, at = [], [], []
        live = np.arange(len(words))
        here = begin + size
        while len(live):
            nodes.append(last[here])
            owner.append(live)
            here = origin[here]
            at.append(here)
            more = here > begin[live]
            live, here = live[more], here[more]
        owner, nodes, at = np.concatenate(owner), np.concatenate(nodes), np.concatenate(at)
        order = np.argsort(at, kind="stable")
        owner, nodes, at = owner[order], nodes[order], at[order]
        ids = self.m.id_of[nodes].astype("<i4")
        count = np.bincount(owner, minlength=len(words))
        stop = np.cumsum(count)
        flat = ids.tobytes()
        out = [flat[4 * (e - c): 4 * e] for e, c in zip(stop.tolist(), count.tolist())]
        for w in np.unique(owner[ids < 0]):
            parts = []
            for k in range(stop[w] - count[w], stop[w]):
                if ids[k] >= 0:
                    parts.append(int(ids[k]))
                else:
                    parts += [self.m.byte_id[b] for b in words[w][at[k] - begin[w]].encode("utf-8", "replace")]
            out[w] = np.array(parts, dtype="<i4").tobytes()
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        m = self.m
        cut = [_words(m.prefix + t.replace(" ", MARK)) if t else [] for t in texts]
        wanted = set().union(*cut)
        new = list(wanted.difference(self.words))
        if len(self.words) + len(new) > CACHE_WORDS:
            self.words.clear()
            new = list(wanted)
        if new:
            self.words.update(zip(new, self.encode_words(new)))
        return [b"".join(map(self.words.__getitem__, w)) for w in cut]


def encode(docs: DataFrame, model: PieceModel, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """(doc_id, text, n_pieces, n_byte_pieces, ids): ids are int32, little endian, in a binary column.

    With ``back`` a column ``decoded`` follows: what ``decode`` would make of the ids, in the same pass over the texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary

    def run(batches):
        encoder = Encoder(shared.value)
        plain = decoder(shared.value)
        is_byte = np.zeros(len(shared.value.raw), dtype=bool)
        is_byte[list(shared.value.byte_id.values())] = True
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                end, held = at, 0
                while end < len(texts) and (end == at or held + len(texts[end]) <= GROUP_CHARS):
                    held += len(texts[end])
                    end += 1
                ids = encoder(texts[at:end])
                size = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                bytes_in = np.concatenate([[0], np.cumsum(is_byte[np.frombuffer(b"".join(ids), "<i4")])])
                stop = np.cumsum(size)
                columns = [b.column(0).slice(at, end - at), b.column(1).slice(at, end - at), long_column(size),
                           long_column(bytes_in[stop] - bytes_in[stop - size]), pa.array(ids, pa.binary())]
                names = ["doc_id", "text", "n_pieces", "n_byte_pieces", "ids"]
                if back:
                    columns.append(pa.array([plain(x) for x in ids], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names=names)
                at = end

    return id_and_text(docs, id_col, text_col).mapInArrow(run, DECODED if back else ENCODED)


def decoder(model: PieceModel):
    """A function from ids (bytes of int32) to text: pieces joined, marks as blanks, without the prefix blank."""
    length = np.array([len(r) for r in model.raw], dtype=np.int64)
    offset = np.cumsum(length) - length
    flat = np.frombuffer(b"".join(model.raw), dtype=np.uint8)

    def decode(ids: bytes) -> str:
        i = np.frombuffer(ids, dtype="<i4")
        size = length[i]
        total = np.cumsum(size)
        if not len(i) or not total[-1]:
            return ""
        place = np.repeat(offset[i] - (total - size), size) + np.arange(total[-1])
        text = flat[place].tobytes().decode("utf-8", "replace")
        return text[1:] if model.prefix and text[0] == " " else text

    return decode


def decode(encoded: DataFrame, model: PieceModel) -> DataFrame:
    """The encoded rows with ``decoded`` text beside their other columns but ``ids``' use."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        back = decoder(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([back(x) for x in b.column(4).to_pylist()], pa.string())],
                names=[*b.schema.names, "decoded"])

    return encoded.select("doc_id", "text", "n_pieces", "n_byte_pieces", "ids").mapInArrow(run, DECODED)
