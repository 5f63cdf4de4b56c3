"""Word-shingle sets as sorted 64-bit hashes, computed over the bytes of many texts at once."""

from __future__ import annotations

import numpy as np

#: White space of the word contract, as a table over bytes.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts, first word of each text with the end last). A-Z count as a-z."""
    data = b"\x20".join([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]) + b"\x20"
    raw = np.frombuffer(data, np.uint8)
    space = _SPACE[raw]
    ends = np.flatnonzero(space)
    sizes = np.fromiter((len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts), np.int64, len(texts)) + 1
    borders = np.concatenate([[0], np.cumsum(sizes)])
    starts = np.concatenate([[0], ends[:-1] + 1])
    real = ends > starts
    starts, ends = starts[real], ends[real]
    firsts = np.searchsorted(starts, borders)
    if not len(starts):
        return np.zeros(0, np.uint64), firsts
    length = ends - starts
    power = _powers(int(length.max()) + 1)
    flat = np.concatenate([[0], np.cumsum(length)])
    inside = ~space
    offset = np.arange(flat[-1]) - np.repeat(flat[:-1], length)
    parts = (raw[inside].astype(np.uint64) + np.uint64(1)) * power[offset]
    return mix(np.add.reduceat(parts, flat[:-1]) + length.astype(np.uint64) * _BASE), firsts


def shingle_sets(texts: list[str | None], k: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles; fewer words count as one shingle, none as none."""
    words, firsts = word_hashes(texts)
    factors = _powers(k + 1)[1:]
    n = len(words)
    rolled = np.zeros(n, np.uint64)
    for j in range(k):
        rolled[: n - j] += words[j:] * factors[j]
    rolled = mix(rolled)
    out = []
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        if b - a >= k:
            own = np.sort(rolled[a : b - k + 1])
            keep = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif b > a:
            out.append(mix(np.array([(words[a:b] * factors[: b - a]).sum() + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
