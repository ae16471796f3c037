"""Vectorised word and shingle hashes over the bytes of a batch of texts.

A text's bytes enter a prefix sum of ``T[byte] * P**position`` (mod 2**64), so the hash of
any span is two look-ups and a multiplication; a final mixer spreads it over 64 bits. All
steps are numpy passes over a whole batch: no Python work per word.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from .common import byte_chunks

CHUNK_BYTES = 2 << 20
_P = 0x9E3779B97F4A7C15 | 1
_M = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


@lru_cache(4)
def _powers(n: int):
    up, down = np.full(n, _P, np.uint64), np.full(n, pow(_P, -1, 1 << 64), np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(n: int):
    size = 1 << max(16, (n + 1).bit_length())
    return _powers(size)


@lru_cache(4)
def byte_codes(fold_case: bool) -> np.ndarray:
    table = np.random.Generator(np.random.PCG64(20_24)).integers(1, 2**63, 256, dtype=np.uint64)
    if fold_case:
        table[65:91] = table[97:123]
    return table


_SEP = np.zeros(256, bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True


def arrow_bytes(col):
    """(bytes, offsets) of a string or binary Arrow column; nulls become empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_large_binary(col.type):
        col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset: col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def text_chunks(col, limit: int = CHUNK_BYTES):
    """Parts of a column: (first row, last row, bytes, offsets from 0)."""
    raw, offsets = arrow_bytes(col)
    for i, j in byte_chunks(offsets, limit):
        a, b = offsets[i], offsets[j]
        yield i, j, raw[a:b], offsets[i:j + 1] - a


def word_spans(raw: np.ndarray, offsets: np.ndarray, sep: np.ndarray = _SEP):
    """Start and end of every word (bytes not in ``sep``), and for each row where its words
    begin (length rows + 1)."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~sep[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def prefix_hash(raw: np.ndarray, fold_case: bool) -> np.ndarray:
    up, _ = powers(len(raw))
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(byte_codes(fold_case)[raw] * up[:len(raw)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts, ends) -> np.ndarray:
    _, down = powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(raw, offsets, k: int):
    """Per row the sorted distinct hashes of its k-word windows (A-Z folded); rows with
    fewer words give the whole sequence as one; rows without words give none."""
    starts, ends, first = word_spans(raw, offsets)
    words = span_hash(prefix_hash(raw, True), starts, ends)
    count = np.diff(first)
    acc = np.zeros(max(len(words) - k + 1, 0), np.uint64)
    for i in range(k):
        part = words[i:len(words) - k + 1 + i] if len(words) >= k else words[:0]
        acc = acc * np.uint64(0x9FB21C651E98DF25) + part
    acc = mix(acc)
    out = []
    for r in range(len(count)):
        a, n = first[r], count[r]
        if n >= k:
            s = np.sort(acc[a:a + n - k + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif n:
            h = np.uint64(n)
            for w in words[a:a + n]:
                h = np.uint64((int(h) * 0x9FB21C651E98DF25 + int(w)) & _M)
            out.append(mix(np.array([h], np.uint64) + np.uint64(0x5851F42D)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
