"""Arrow text batches as flat byte buffers, with vectorised word and window hashes.

Every helper works on one bounded slice of an Arrow batch: the UTF-8 bytes of
several whole texts lie end to end in one ``uint8`` array, ``starts`` and
``ends`` give each text's place.  Nothing here crosses a text boundary.
Hashes are two polynomials over random byte tables, one modulo 2^64 and one modulo the
prime 2^31 - 1, joined by a 64-bit mixer; equal byte strings have equal hashes at any
place in any batch.  The prime one tells apart the structured strings (Thue-Morse and
its relatives) on which every polynomial modulo a power of two collides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
PRIME = U64((1 << 31) - 1)
_PRIME_BASE = 1_284_865_837
_random = np.random.default_rng(20240607)
TABLE = np.stack([_random.integers(1, 1 << 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1),
                  _random.integers(1, int(PRIME), 256, dtype=np.int64).astype(U64)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
TABLE_LOWER = TABLE[:, LOWER]
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_powers: list[np.ndarray] = []
_prime_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^0..B^n and B^-0..B^-n modulo 2^64 (kept per Python worker)."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, 1 << 20)
        out = []
        for b in (_BASE, _BASE_INV):
            p = np.full(size, b, dtype=U64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=U64))
        _powers[:] = out
    return _powers[0], _powers[1]


def prime_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^0..B^n and B^-0..B^-n modulo ``PRIME`` (kept per Python worker)."""
    if not _prime_powers or len(_prime_powers[0]) <= n:
        size = max(n + 1, 1 << 20)
        out = []
        for b in (_PRIME_BASE, pow(_PRIME_BASE, -1, int(PRIME))):
            p = np.ones(size, dtype=U64)
            done = 1
            while done < size:
                more = min(done, size - done)
                p[done:done + more] = p[:more] * U64(pow(b, done, int(PRIME))) % PRIME
                done += more
            out.append(p)
        _prime_powers[:] = out
    return _prime_powers[0], _prime_powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> U64(33))
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


class Texts:
    """Whole texts of a slice: ``buf`` (uint8), ``starts``, ``ends`` (int64), first row index."""

    def __init__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: int):
        self.buf, self.starts, self.ends, self.first = buf, starts, ends, first
        self.n = len(starts)

    def raw(self, i: int) -> bytes:
        return self.buf[self.starts[i]:self.ends[i]].tobytes()

    def prefix_hash(self, table: np.ndarray = TABLE) -> np.ndarray:
        """``prefix_sums`` of the bytes' values in a table of two rows."""
        return prefix_sums(table[0][self.buf], table[1][self.buf])

    def count_in(self, mask: np.ndarray) -> np.ndarray:
        """Per text: how many bytes have ``mask`` set."""
        c = np.zeros(len(mask) + 1, dtype=np.int64)
        np.cumsum(mask, out=c[1:])
        return c[self.ends] - c[self.starts]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text index of every word (maximal run of word bytes)."""
        return self.runs(IS_WORD[self.buf])

    def runs(self, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of set bytes, cut at text boundaries."""
        n = len(mask)
        if n == 0:
            z = np.zeros(0, dtype=np.int64)
            return z, z, z
        first = mask.copy()
        first[1:] &= ~mask[:-1]
        full = self.starts[self.starts < self.ends]
        first[full] = mask[full]
        last = mask.copy()
        last[:-1] &= ~mask[1:]
        last[self.ends[self.starts < self.ends] - 1] = mask[self.ends[self.starts < self.ends] - 1]
        s = np.flatnonzero(first)
        e = np.flatnonzero(last) + 1
        return s, e, np.searchsorted(self.ends, s, side="right")


def prefix_sums(wide: np.ndarray, prime: np.ndarray) -> np.ndarray:
    """Two rows H with H[j] - H[i] = sum of v_k * B^k over i <= k < j, modulo 2^64 and ``PRIME`` (values below it)."""
    n = len(wide)
    h = np.zeros((2, n + 1), dtype=U64)
    np.cumsum(wide * powers(n)[0][:n], out=h[0, 1:])
    np.cumsum(prime * prime_powers(n)[0][:n] % PRIME, out=h[1, 1:])  # exact up to 2^33 values
    return h


def span_hash(h: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hash of values [s, e) from prefix sums, the same wherever they lie."""
    n = h.shape[1]
    wide = (h[0][e] - h[0][s]) * powers(n)[1][s]
    prime = (h[1][e] - h[1][s]) % PRIME * prime_powers(n)[1][s] % PRIME
    return mix(mix(wide + (e - s).astype(U64) * U64(0x2545F4914F6CDD1D)) + prime * U64(0xD6E8FEB86659FD93))


def chain(parts: list[np.ndarray]) -> np.ndarray:
    """Ordered combination of equally long hash arrays."""
    out = mix(parts[0] + U64(0x5851F42D4C957F2D))
    for x in parts[1:]:
        out = mix(out * U64(6364136223846793005) + x)
    return out


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[Texts]:
    """Consecutive rows of a batch whose text bytes total ``max_bytes`` at most.

    A longer single text comes alone and whole.  Null texts are empty.
    """
    col = batch.column(batch.schema.get_field_index(column))
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"")
    if pa.types.is_large_binary(col.type) or pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        kind = np.int32
    n = len(col)
    if n == 0:
        return
    _, off_buf, data = col.buffers()
    offs = np.frombuffer(off_buf, dtype=kind)[col.offset: col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), n)
        base = offs[i]
        yield Texts(data[base:offs[j]], offs[i:j] - base, offs[i + 1:j + 1] - base, i)
        i = j


def long_column(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.int64))
