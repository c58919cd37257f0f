"""Words of many texts at once, as numpy arrays.

A word is a run of anything but space and the ASCII controls 9 to 13. Words and lines are
compared by a 64-bit hash of their bytes: a polynomial modulo 2^64 for spans of at most ``LONG``
bytes, a keyed BLAKE2 digest for longer ones. (Strings that collide under such a polynomial for
every base exist, but only from 1,024 bytes on, so none can be built of short spans.) Two
different spans of a batch share a hash with probability below 1e-7.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LONG = 256
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 20)
        for key, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (multiply and xor-shift rounds)."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


@dataclass
class Texts:
    """Bytes of the texts end to end; text i is ``data[cut[i]:cut[i + 1]]``."""

    data: np.ndarray
    cut: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.cut) - 1


def texts(column: pa.Array | pa.ChunkedArray) -> Texts:
    """UTF-8 bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    cut = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(raw[cut[0] : cut[-1]], cut - cut[0])


@dataclass
class Words:
    """start, end: byte positions; doc: row of each word; first, last: word range of each row."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    last: np.ndarray

    @property
    def n(self) -> int:
        return len(self.start)


def prefix_hash(t: Texts) -> np.ndarray:
    up, _ = _power(len(t.data) + 1)
    out = np.zeros(len(t.data) + 1, np.uint64)
    np.cumsum(_BYTE[t.data] * up[: len(t.data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] wherever it stands; its length counts too."""
    _, down = _power(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def digest_long(value: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hashes with those of long spans replaced by digests of their bytes."""
    for k in np.flatnonzero(end - start > LONG).tolist():
        value[k] = int.from_bytes(hashlib.blake2b(data[start[k] : end[k]].tobytes(), digest_size=8, key=b"atelier").digest(), "little")
    return value


def words(t: Texts, prefix: np.ndarray | None = None) -> Words:
    inside = ~_SPACE[t.data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edge = t.cut[(t.cut > 0) & (t.cut < len(t.data))]
    opens[edge] = inside[edge]
    closes[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.searchsorted(start, t.cut[:-1])
    last = np.searchsorted(start, t.cut[1:])
    doc = np.repeat(np.arange(t.rows), last - first)
    value = span_hash(prefix_hash(t) if prefix is None else prefix, start, end)
    return Words(start, end, digest_long(value, t.data, start, end), doc, first, last)


def sums(flags: np.ndarray, t: Texts) -> np.ndarray:
    """Number of set flags (one per byte) in each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[t.cut[1:]] - total[t.cut[:-1]]


_STEP = np.random.default_rng(11).integers(1, 1 << 63, 64, dtype=np.uint64) | U(1)


def shingles(column: pa.Array | pa.ChunkedArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the distinct runs of ``size`` words of each text in lower case, by row.

    A text of fewer words, but one at least, has them all as its only shingle.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    t = texts(pc.utf8_lower(column))
    w = words(t)
    count = w.last - w.first
    at = np.arange(w.n)
    run = at + size <= w.last[w.doc]
    total = np.zeros(w.n, np.uint64)
    for k in range(size):
        inside = np.minimum(at + k, w.n - 1)
        term = w.hash[inside] * _STEP[k]
        total += np.where(run, term, U(0))
    short = np.flatnonzero((count > 0) & (count < size))
    first = w.first[short]
    for k in range(size - 1):
        has = count[short] > k
        total[first[has]] += w.hash[first[has] + k] * _STEP[k]
    run[first] = True
    value, row = mix(total[run]), w.doc[run]
    _, keep = np.unique(mix(value + row.astype(np.uint64) * U(0xA24BAED4963EE407)), return_index=True)
    keep.sort()
    return value[keep], row[keep]
