"""Byte-string kernels of the suffix-array dedup operator (numpy, one chunk of
text at a time).

A chunk is cut by *rolling-hash triggers*: position ``t`` is a trigger of the
window starting at ``p`` when the hash of the 16 bytes at ``t`` is the smallest
(leftmost on ties) among the starts ``p .. p + SPAN - 1``.  The trigger of a
window depends on the window's own bytes only, so equal 200-byte strings pick
the same trigger wherever they stand; every window has exactly one trigger, and
the windows of one trigger are consecutive.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE_1, BASE_2 = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
GRAM = 16                     # bytes under the rolling hash
MASK = (1 << 64) - 1
IDX_BITS = 24                 # position bits packed under the hash
PIECE = 1 << 20               # bytes of text handled at once


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads the low-entropy low bits of a polynomial hash."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(29))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(32))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse; kept by the worker."""
    kept = _POWERS.get(base)
    if kept is None or len(kept[0]) < n:
        made = []
        for x in (base & MASK, pow(base, -1, 1 << 64)):
            p = np.full(max(n, 1 << 16), x, U)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        kept = _POWERS[base] = made[0], made[1]
    return kept


class Hashes:
    """Polynomial hashes (modulo 2^64) of any stretch of a buffer, from sums over
    its prefixes: the difference of two sums, moved to position 0 by the inverse
    power, since the base is odd."""

    def __init__(self, buf: np.ndarray, base: int):
        power, self.back = _powers(base, len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, U)
        np.cumsum((buf.astype(U) + U(1)) * power[:len(buf)], out=self.sums[1:])

    def at(self, pos: np.ndarray, length: int) -> np.ndarray:
        return (self.sums[pos + length] - self.sums[pos]) * self.back[pos]

    def all(self, length: int) -> np.ndarray:
        """Of every position, the last ones over what is left of the buffer."""
        n = len(self.sums) - 1
        ends = np.minimum(np.arange(n) + length, n)
        return (self.sums[ends] - self.sums[:-1]) * self.back[:n]


def suffix_ranks(buf: np.ndarray, length: int) -> np.ndarray:
    """Place of every suffix of ``buf`` of ``length`` bytes or more in the order
    of their first ``length`` bytes: the suffix array of ``buf`` by prefix
    doubling, stopped where the order is that of the strings wanted.  Equal ranks
    are equal bytes.  ``length`` is 8 or more."""
    if len(buf) < length:
        return np.empty(0, np.int64)
    eight = np.lib.stride_tricks.sliding_window_view(buf, 8)
    key = np.zeros(len(eight), U)
    for i in range(8):
        key = key << U(8) | eight[:, i]
    rank, n = np.unique(key, return_inverse=True)[1].astype(np.int64), 8
    while n < length:
        step = min(n, length - n)
        rank = np.unique(rank[:-step] * (rank.max() + 1) + rank[step:], return_inverse=True)[1].astype(np.int64)
        n += step
    return rank


def window_argmin(h: np.ndarray, span: int) -> np.ndarray:
    """Leftmost position of the minimum of ``h[p : p + span]`` for every p."""
    n = len(h)
    m = n - span + 1
    key = (h & U(MASK ^ ((1 << IDX_BITS) - 1))) | np.arange(n, dtype=U)
    pad = -n % span
    blocks = np.concatenate([key, np.full(pad, MASK, U)]).reshape(-1, span)
    prefix = np.minimum.accumulate(blocks, axis=1).ravel()
    suffix = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    best = np.minimum(suffix[:m], prefix[span - 1:span - 1 + m])
    return (best & U((1 << IDX_BITS) - 1)).astype(np.int64)


def triggers(buf: np.ndarray, valid: np.ndarray, size: int):
    """Triggers of all valid window starts of a chunk.

    ``valid`` marks starts whose ``size`` bytes lie inside one document.
    Returns (t, first, last, anchor, full): trigger position, first and last
    window start that it owns, hash of the bytes that all windows of a trigger
    share right of it, and hash of all bytes its windows cover."""
    span = size - GRAM * 4
    n = len(buf)
    if n < size or not valid.any():
        e = np.empty(0, np.int64)
        return e, e, e, e.astype(U), e.astype(U)
    one = Hashes(buf, BASE_1)
    arg = window_argmin(mix(one.all(GRAM)), span)
    p = np.flatnonzero(valid)
    t = arg[p]
    new = np.ones(len(p), bool)
    new[1:] = (t[1:] != t[:-1]) | (p[1:] != p[:-1] + 1)
    at = np.flatnonzero(new)
    first, last, t = p[at], p[np.append(at[1:], len(p)) - 1], t[at]
    anchor = mix(Hashes(buf, BASE_2).at(t, size - span + 1))
    whole = mix(one.at(first, size)) * U(3) + mix(one.at(last, size))
    full = mix(whole + (t - first).astype(U) * U(0x9E3779B1) + (t - last).astype(U) * U(0x85EBCA6B))
    return t, first, last, anchor, full


def chunks(texts, size: int):
    """Texts (bytes) put together in chunks of bounded length: (buffer, doc,
    origin, valid), doc and origin (position 0 of the chunk's part in its text)
    per part with the parts' ends.  A long text is cut into parts that overlap
    by size - 1 bytes, so that every window start is valid in one part."""
    parts, held = [], 0

    def flush():
        buf = np.frombuffer(b"".join(p[2] for p in parts), np.uint8)
        ends = np.cumsum([len(p[2]) for p in parts])
        valid = np.zeros(len(buf), bool)
        for end, p in zip(ends.tolist(), parts):
            if len(p[2]) >= size:
                valid[end - len(p[2]):end - size + 1] = True
        begin = ends - [len(p[2]) for p in parts]
        return buf, np.array([p[0] for p in parts]), np.array([p[1] for p in parts]) - begin, ends, valid

    for i, raw in enumerate(texts):
        if raw is None or len(raw) < size:
            continue
        for at in range(0, len(raw) - size + 1, PIECE):
            piece = raw[at:at + PIECE + size - 1]
            if parts and held + len(piece) > PIECE:
                yield flush()
                parts, held = [], 0
            parts.append((i, at, piece))
            held += len(piece)
    if parts:
        yield flush()
