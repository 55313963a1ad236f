"""Vectorised text primitives shared by the operators of this subpackage.

Texts arrive as Arrow string arrays; everything here works on the array's UTF-8 buffer
with numpy, so no Python object is made per word. Fingerprints are 64-bit polynomial
sums (mod 2**64, random byte table, odd base) passed through a mixing step. Words longer
than LONG_WORD bytes are hashed with xxhash, as polynomials mod 2**64 have known
collisions on very long structured strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard

U64 = np.uint64
CHUNK_BYTES = 1 << 20
LONG_WORD = 512

_rng = np.random.default_rng(20240607)
BYTE_TABLE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASE = int(_rng.integers(2**60, 2**62)) * 8 + 5  # odd, of maximal order mod 2**64
BASE %= 1 << 64
BASE_INV = pow(BASE, -1, 1 << 64)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64, kept per process and grown on demand."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        m = -(-n // 65536) * 65536
        with np.errstate(over="ignore"):
            have = np.full(m, U64(base))
            have[0] = 1
            np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        h = h + U64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
        h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93)
        return h ^ (h >> U64(32))


class Texts:
    """Some texts as one byte buffer: `buf` (uint8) and `offs` (len n + 1)."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        self.buf, self.offs = buf, offs
        self._spans = None

    def __len__(self) -> int:
        return len(self.offs) - 1

    @classmethod
    def of(cls, col: pa.Array) -> Texts:
        col = pc.fill_null(col, "") if col.null_count else col
        if len(col) == 0:
            return cls(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
        _, ob, db = col.buffers()
        offs = np.frombuffer(ob, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
        data = np.frombuffer(db, np.uint8) if db is not None else np.zeros(0, np.uint8)
        return cls(data[offs[0]:offs[-1]], offs - offs[0])

    def slice(self, a: int, b: int) -> Texts:
        o = self.offs[a:b + 1]
        return Texts(self.buf[o[0]:o[-1]], o - o[0])

    def take(self, rows: np.ndarray) -> Texts:
        starts, lens = self.offs[rows], self.offs[rows + 1] - self.offs[rows]
        return Texts(self.buf[ragged(starts, lens)], np.concatenate([[0], np.cumsum(lens)]))

    def mapped(self, table: np.ndarray) -> Texts:
        return Texts(table[self.buf], self.offs)

    def bytes_of(self, i: int) -> bytes:
        return self.buf[self.offs[i]:self.offs[i + 1]].tobytes()

    def spans(self, gap: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of maximal runs of bytes outside `gap`, and word offsets per text."""
        if self._spans is None or self._spans[0] is not gap:
            self._spans = (gap, self._find_spans(gap))
        return self._spans[1]

    def _find_spans(self, gap):
        n = len(self.buf)
        if n == 0:
            z = np.zeros(0, np.int64)
            return z, z, np.zeros(len(self) + 1, np.int64)
        word = ~gap[self.buf]
        first = word.copy()
        first[1:] &= ~word[:-1]
        last = word.copy()
        last[:-1] &= ~word[1:]
        edge = self.offs[1:-1]
        edge = edge[(edge > 0) & (edge < n)]
        first[edge] |= word[edge]
        last[edge - 1] |= word[edge - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        return starts, ends, np.searchsorted(starts, self.offs)

    def count(self, marks: np.ndarray) -> np.ndarray:
        """Per text, how many bytes are marked."""
        c = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return c[self.offs[1:]] - c[self.offs[:-1]]

    def hashes(self, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
        """64-bit hash of each byte span of the buffer."""
        if len(starts) == 0:
            return np.zeros(0, np.uint64)
        sums = prefix_sums(self.buf)
        with np.errstate(over="ignore"):
            h = (sums[ends] - sums[starts]) * powers(BASE_INV, len(sums))[starts]
            h += (ends - starts).astype(np.uint64) * U64(0x9FB21C651E98DF25)
        h = mix(h, salt)
        for i in np.flatnonzero(ends - starts > LONG_WORD):
            h[i] = xxhash.xxh3_64_intdigest(self.buf[starts[i]:ends[i]].tobytes(), seed=salt)
        return h

    def words(self, salt: int = 0, gap: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of all texts, and word offsets per text."""
        s, e, w = self.spans(gap)
        return self.hashes(s, e, salt), w


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """sums[i] = sum of table[buf[j]] * BASE**j over j < i, mod 2**64."""
    with np.errstate(over="ignore"):
        v = BYTE_TABLE[buf]
        v *= powers(BASE, len(buf) + 1)[:-1]
        out = np.empty(len(buf) + 1, np.uint64)
        out[0] = 0
        np.cumsum(v, out=out[1:])
    return out


def windows(h: np.ndarray, woffs: np.ndarray, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in `h`) where k words of one text start, and the hashes of those windows."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ok = np.ones(n, bool)
    for b in woffs[1:-1][np.diff(woffs[:-1]) > 0] if k > 1 else ():
        ok[max(0, b - k + 1):b] = False
    pos = np.flatnonzero(ok)
    with np.errstate(over="ignore"):
        acc = np.zeros(n, np.uint64)
        for j in range(k):
            acc += h[j:j + n] * powers(BASE, k + 1)[j + 1]
    return pos, mix(acc[pos], salt)


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenated index ranges [start, start + len)."""
    lens = np.asarray(lens, np.int64)
    total = int(lens.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - (ends - lens), lens)


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """Row ranges of a batch whose texts hold about `limit` bytes (a longer text stands alone)."""
    col = batch.column(batch.schema.get_field_index(column))
    texts = Texts.of(col)
    a = 0
    while a < len(texts):
        b = int(np.searchsorted(texts.offs, texts.offs[a] + limit, side="right")) - 1
        b = min(len(texts), max(a + 1, b))
        yield a, b, texts.slice(a, b)
        a = b


def packed_chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """As `chunks`, of texts that `pack_texts` compressed."""
    open_, part, a, size = zstandard.ZstdDecompressor(), [], 0, 0
    for i, x in enumerate(col):
        x = x.as_py()
        part.append(open_.decompress(x) if x else b"")
        size += len(part[-1])
        if size >= limit or i == len(col) - 1:
            offs = np.concatenate([[0], np.cumsum([len(p) for p in part])])
            yield a, i + 1, Texts(np.frombuffer(b"".join(part), np.uint8), offs)
            part, a, size = [], i + 1, 0


def pack_texts(t: Texts) -> list[bytes]:
    """Each text compressed by itself; the empty text as no bytes."""
    close = zstandard.ZstdCompressor(1)
    return [close.compress(x) if x else b"" for x in map(t.bytes_of, range(len(t)))]


def doc_of(woffs: np.ndarray) -> np.ndarray:
    """Text index of each word."""
    return np.repeat(np.arange(len(woffs) - 1), np.diff(woffs))
