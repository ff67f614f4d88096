"""Texts as sorted arrays of hashed word n-grams, their bitmaps and digests."""

from __future__ import annotations

import numpy as np
import xxhash

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_PIECE = 1 << 18  # bytes of words hashed at once
_MOST_BITS = 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and 64-bit hashes of the words in bytes of text: sums of mixed (place in the word, byte)."""
    inside = np.concatenate([[False], ~_BLANK[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    ends, out = np.cumsum(lengths), np.empty(len(starts), dtype=np.uint64)
    cuts = np.searchsorted(ends, np.arange(0, ends[-1] if len(ends) else 0, _PIECE), side="right")
    cuts = np.unique(np.concatenate([[0], cuts, [len(starts)]])).tolist()
    for a, b in zip(cuts, cuts[1:]):  # pieces of whole words bound the work memory
        first = ends[a:b] - lengths[a:b] - (ends[a] - lengths[a])
        place = np.arange(int(lengths[a:b].sum())) - np.repeat(first, lengths[a:b])
        letters = data[place + np.repeat(starts[a:b], lengths[a:b])]
        out[a:b] = np.add.reduceat(mix(((place << 8) + letters + 1).astype(np.uint64)), first)
    return starts, mix(out)


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of every text."""
    data = [t.encode("utf-8", "replace").translate(_LOWER) if t else b"" for t in texts]
    at = np.cumsum([0, *(len(d) + 1 for d in data)])
    starts, h = word_hashes(np.frombuffer(b" ".join([*data, b""]), dtype=np.uint8))
    del data
    bounds = np.searchsorted(starts, at).tolist()
    places = mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
    whole = np.full(max(0, len(h) - n + 1), n, dtype=np.uint64)
    for k in range(n):
        whole += mix(h[k:k + len(whole)] * places[k])
    whole = mix(whole)
    out = []
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= n:  # windows within the text
            out.append(np.unique(whole[a:b - n + 1]))
        elif b > a:  # fewer words: the whole sequence is one
            total = mix(h[a:b] * places[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([total], dtype=np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def bitmap(elements: np.ndarray, bits: int | None = None) -> np.ndarray:
    """Bytes of a power of two of parity bits: each tells whether an odd number of elements hash to it.

    Half a bit to one bit an element, 256 at least and 16 KB at most, so that
    two blocks of bitmaps fit in a task's memory whatever the texts.
    """
    bits = bits or min(_MOST_BITS, max(256, 1 << (len(elements).bit_length() - 1)))
    hits = np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((hits & 1).astype(np.uint8), bitorder="little")


def differing_bits(x: np.ndarray, y: np.ndarray) -> int:
    """Bits in which two bitmaps differ; the longer is folded to the shorter."""
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64))


def digest(elements: np.ndarray, salt: int = 0) -> tuple[int, int]:
    """Two signed 64-bit halves of a set's 128-bit hash."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(elements.tobytes(), seed=salt), np.int64).tolist())
