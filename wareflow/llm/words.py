"""Hashes of the words of many texts at once, in numpy over Arrow buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_B = 0x9E3779B97F4A7C15
_BI = pow(_B, -1, 1 << 64)
#: Bytes of text that are worked on together.
PART = 1 << 19
#: The six ASCII white-space characters.
_SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def _values(lower: bool) -> np.ndarray:
    b = np.arange(256)
    if lower:
        b = np.where((b >= 65) & (b <= 90), b + 32, b)
    with np.errstate(over="ignore"):
        return mix((b + 1).astype(np.uint64) * _GOLD)


_VALUES = {low: _values(low) for low in (False, True)}


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as were asked for."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << n.bit_length()
            with np.errstate(over="ignore"):
                cls.up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, _B, dtype=np.uint64)]))
                cls.down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, _BI, dtype=np.uint64)]))
        return cls.up, cls.down


def parts(batches, column: str = "text", most: int = PART):
    """The batches cut by the bytes of a text column: a longer text comes alone."""
    for b in batches:
        size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(b.column(column)), 0), dtype=np.int64) + 64)
        at = 0
        while at < b.num_rows:
            stop = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, side="right")))
            yield b.slice(at, stop - at)
            at = stop


#: A prime below 2**31 and the base of the second sum.
_P, _R = (1 << 31) - 1, 1_220_703_125


class _Residues:
    """Powers of the second base and of its inverse modulo the prime, as many as were asked for."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(cls.up) < n:
            k = len(cls.up)
            cls.up = np.concatenate([cls.up, cls.up * np.uint64(pow(_R, k, _P)) % np.uint64(_P)])
            cls.down = np.concatenate([cls.down, cls.down * np.uint64(pow(_R, -k, _P)) % np.uint64(_P)])
        return cls.up, cls.down


def sums(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums before each number of a sequence, weighted by powers: see span().

    There are two: modulo 2**64, where some regular sequences (Thue and Morse's) meet whatever the base, and modulo a prime, where they don't.
    """
    up, (residues, _) = _Powers.of(len(h) + 1)[0], _Residues.of(len(h) + 1)
    zero = np.zeros(1, np.uint64)
    with np.errstate(over="ignore"):
        return np.concatenate([zero, np.cumsum(h * up[: len(h)])]), np.concatenate([zero, np.cumsum(h % np.uint64(_P) * residues[: len(h)] % np.uint64(_P))])


def span(total: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the numbers from start to end (exclusive): the same numbers give the same hash anywhere."""
    whole, small = total
    down, back = _Powers.of(len(whole))[1], _Residues.of(len(whole))[1]
    with np.errstate(over="ignore"):
        first = (whole[end] - whole[start]) * down[start] + (end - start).astype(np.uint64) * _M1
        second = (small[end] - small[start]) % np.uint64(_P) * back[start] % np.uint64(_P)
        return mix(first + mix(second + _GOLD))


def word_hashes(column: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, and where each text's begin (one entry more than texts).

    A word is a run of bytes other than ASCII white space; lower folds A to Z. Null texts have no words. A word's
    hash is of two polynomials of its bytes' random values, whose sums over all bytes are taken at once.
    """
    whole = pc.fill_null(column.cast(pa.large_string()), "")
    bounds = np.frombuffer(whole.buffers()[1], dtype=np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = whole.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]] if data is not None and len(bounds) else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    solid = ~_SPACE[raw]
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    start[inner] |= solid[inner]  # a word also ends where its text does
    end[inner - 1] |= solid[inner - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    out, value, k = np.empty(len(s), np.uint64), _VALUES[lower], 0
    while k < len(s):
        stop = max(k + 1, int(np.searchsorted(e, s[k] + PART, side="right")))
        total = sums(value[raw[s[k] : e[stop - 1]]])
        out[k:stop] = span(total, s[k:stop] - s[k], e[k:stop] - s[k])
        k = stop
    return out, np.searchsorted(s, bounds)


def text_keys(column: pa.Array) -> np.ndarray:
    """A 64-bit hash of each whole text as it is; null counts as empty."""
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(x or b"") for x in column.cast(pa.binary()).to_pylist()], dtype=np.uint64).view(np.int64)
