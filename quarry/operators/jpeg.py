"""Baseline JPEG files of arrays, without an imaging library.

Three components of full size, one scan, quantisation by a rule instead of a table, and Huffman codes made for each image from its own
symbols. All steps but the codes' construction are array operations over all images of a call.
"""

from __future__ import annotations

import heapq
import struct

import numpy as np

#: Coefficients in the order of the format: by diagonals, whose direction alternates.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else i % 8)))
SPARE = 256  # a symbol of no use that takes the code of all ones, which the format forbids


def quantisation(quality: int) -> np.ndarray:
    """Step of each coefficient, 8 by 8: it grows with the frequency, and falls to 1 towards quality 100."""
    u = np.arange(8)
    steps = (12 + 9.0 * (u[:, None] + u)) * (1 - quality / 100) * 2
    return np.clip(np.rint(steps), 1, 255).astype(int)


def _coefficients(images: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Quantised coefficients [image, block, component, 64] of RGB images of one size, blocks row by row, in zigzag order."""
    high, wide = -images.shape[1] % 8, -images.shape[2] % 8
    rows, columns = (images.shape[1] + high) // 8, (images.shape[2] + wide) // 8
    padded = np.pad(images[..., :3], ((0, 0), (0, high), (0, wide), (0, 0)), mode="edge")
    every = padded.reshape(-1, rows, 8, columns, 8, 3).transpose(0, 1, 3, 2, 4, 5).reshape(-1, 64, 3)
    # blocks of one colour are many and of few colours: one of each is enough
    flat = (every == every[:, :1]).all(axis=(1, 2))
    colour = every[:, 0].astype(np.int64) @ [65536, 256, 1]
    _, example, which = np.unique(colour[flat], return_index=True, return_inverse=True)
    of = np.empty(len(every), np.int64)
    of[flat] = which
    of[~flat] = len(example) + np.arange(len(every) - len(which))
    rgb = np.concatenate([every[flat][example], every[~flat]]).astype(float)
    to = np.array([[0.299, 0.587, 0.114], [-0.168736, -0.331264, 0.5], [0.5, -0.418688, -0.081312]])
    planes = rgb @ to.T + [-128, 0, 0]
    k = np.arange(8)
    basis = np.where(k[:, None] == 0, np.sqrt(0.125), 0.5) * np.cos(np.pi * (2 * k + 1) * k[:, None] / 16)
    blocks = planes.reshape(-1, 8, 8, 3).transpose(0, 3, 2, 1)
    # one product for all blocks of all images along an axis, then along the other
    down = (np.ascontiguousarray(blocks).reshape(-1, 8) @ basis.T).reshape(-1, 8, 8).transpose(0, 2, 1)
    found = np.rint((np.ascontiguousarray(down).reshape(-1, 8) @ basis.T).reshape(-1, 8, 8) / steps).astype(np.int32)
    return found.reshape(-1, 3, 64)[..., ZIGZAG][of].reshape(len(images), rows * columns, 3, 64)


def _tokens(blocks: np.ndarray) -> tuple[np.ndarray, ...]:
    """(image, whether of the first coefficient, symbol, extra bits, their number) in the order of the scans."""
    change = np.diff(blocks[..., 0], axis=1, prepend=0)
    flat = blocks.reshape(-1, 64)
    block, at = np.nonzero(flat[:, 1:])
    at = at + 1
    value = flat[block, at]
    last = np.where(np.concatenate([[True], block[1:] != block[:-1]]), 0, np.concatenate([[0], at[:-1]])) if len(at) else at
    zeros = at - last - 1
    size = lambda v: np.ceil(np.log2(np.abs(v) + 1)).astype(int)
    long = zeros // 16  # runs of sixteen zeros have a symbol of their own
    n = len(flat)
    first = change.reshape(-1)
    final = np.zeros(n, int)
    final[block] = at  # the last one stays
    ends = np.flatnonzero(final < 63)
    none = lambda k: np.zeros(k, int)
    parts = [  # (block, place, turn), symbol, extra bits, their number
        (np.arange(n), none(n), none(n), size(first), first, size(first)),
        (np.repeat(block, long), np.repeat(at, long), none(long.sum()), np.full(long.sum(), 0xF0), none(long.sum()), none(long.sum())),
        (block, at, np.ones(len(at), int), (zeros % 16) * 16 + size(value), value, size(value)),
        (ends, np.full(len(ends), 64), none(len(ends)), none(len(ends)), none(len(ends)), none(len(ends))),
    ]
    where, place, turn, symbol, number, bits = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort((where * 65 + place) * 2 + turn, kind="stable")
    extra = np.where(number < 0, number + (1 << bits) - 1, number)
    return where[order] // (blocks.shape[1] * blocks.shape[2]), place[order] == 0, symbol[order], extra[order], bits[order]


def code_lengths(counts: dict[int, int], most: int = 16) -> dict[int, int]:
    """Lengths of a Huffman code that has none over most: the rare symbols are raised until it holds."""
    counts = dict(counts)
    while True:
        order = sorted(counts)
        heap = [(counts[s], i, i) for i, s in enumerate(order)]
        heapq.heapify(heap)
        over = [0] * (2 * len(order) - 1)  # of each node the one above it, which has a larger number
        for node in range(len(order), len(over)):
            (a, i, left), (b, _, right) = heapq.heappop(heap), heapq.heappop(heap)
            over[left] = over[right] = node
            heapq.heappush(heap, (a + b, i, node))
        depth = [0] * len(over)
        for node in range(len(over) - 2, -1, -1):
            depth[node] = depth[over[node]] + 1
        length = dict(zip(order, depth, strict=False)) if len(order) > 1 else dict.fromkeys(order, 1)
        if max(length.values()) <= most:
            return length
        counts = {s: n // 2 + 1 for s, n in counts.items()}


def _codes(counts: dict[int, int]) -> tuple[dict[int, tuple[int, int]], bytes]:
    """(code, length) by symbol of the symbols' counts, and the table as it stands in the file."""
    length = code_lengths({s: 2 * n for s, n in counts.items()} | {SPARE: 1})
    longest = max(length.values())
    length[SPARE] = longest  # it is the rarest, so it shares the longest length; the last place gives it all ones
    order = sorted(length, key=lambda s: (length[s], s == SPARE, s))
    out, now, before, per = {}, 0, 0, bytearray(16)
    for s in order:
        now <<= length[s] - before
        before = length[s]
        if s != SPARE:
            out[s] = now, before
            per[before - 1] += 1
        now += 1
    return out, bytes(per) + bytes(out)


def _packed(owner: np.ndarray, values: np.ndarray, sizes: np.ndarray, n: int) -> list[bytes]:
    """Numbers of at most 32 bits written with so many bits each, for each of n owners by itself: filled up with ones; a byte of ones is
    followed by zeros. owner must be sorted."""
    total = np.bincount(owner, sizes, n).astype(np.int64)
    words = -(-(total + 7) // 32) + 1
    starts = np.cumsum(words) - words
    ends = np.cumsum(sizes)
    at = ends - sizes - (np.cumsum(total) - total)[owner] + 32 * starts[owner]
    fill = -total % 8
    at, values, sizes = np.concatenate([at, 32 * starts + total]), np.concatenate([values, (1 << fill) - 1]), np.concatenate([sizes, fill])
    window = values.astype(np.uint64) << (64 - sizes - (at & 31)).astype(np.uint64) % 64  # two words; none has bits of another
    word = at >> 5
    low = (window & np.uint64(0xFFFFFFFF)).astype(float)
    whole = np.bincount(word, (window >> np.uint64(32)).astype(float), words.sum()) + np.bincount(word + 1, low, words.sum() + 1)[:-1]
    raw = whole.astype(">u4").tobytes()
    return [raw[4 * a : 4 * a + (t + 7) // 8].replace(b"\xff", b"\xff\x00") for a, t in zip(starts.tolist(), total.tolist(), strict=True)]


def jpegs(images: np.ndarray, quality: int = 92) -> list[bytes]:
    """Baseline files of images (image, height, width, 3 or 4) of bytes and one size; alpha is left out. Each file has codes of its own."""
    steps = quantisation(quality)
    owner, is_first, symbol, extra, bits = _tokens(_coefficients(images, steps))
    slot = (2 * owner + ~is_first) * 256 + symbol
    counts = np.bincount(slot, minlength=512 * len(images))
    used = np.flatnonzero(counts)
    code, length = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
    tables: list[bytes] = []
    cuts = np.searchsorted(used, np.arange(2 * len(images) + 1) * 256).tolist()
    symbols, often, used = (used % 256).tolist(), counts[used].tolist(), used.tolist()
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        found, table = _codes(dict(zip(symbols[a:b], often[a:b], strict=True)))
        code[used[a:b]], length[used[a:b]] = zip(*(found[s] for s in symbols[a:b]), strict=True)
        tables.append(bytes([0x10 * (i % 2)]) + table)
    scans = _packed(owner, code[slot] << bits | extra, length[slot] + bits, len(images))
    part = lambda marker, body: b"\xff" + bytes([marker]) + struct.pack(">H", len(body) + 2) + body
    frame = struct.pack(">BHHB", 8, images.shape[1], images.shape[2], 3) + b"".join(bytes([c, 0x11, 0]) for c in (1, 2, 3))
    before = b"\xff\xd8" + part(0xE0, b"JFIF\0\x01\x01\0\0\x01\0\x01\0\0") + part(0xDB, b"\0" + bytes(steps.ravel()[ZIGZAG].tolist())) + part(0xC0, frame)
    scan = part(0xDA, b"\x03" + b"".join(bytes([c, 0]) for c in (1, 2, 3)) + b"\0\x3f\0")
    return [before + part(0xC4, tables[2 * i] + tables[2 * i + 1]) + scan + own + b"\xff\xd9" for i, own in enumerate(scans)]


def jpeg(image: np.ndarray, quality: int = 92) -> bytes:
    """A baseline file of an array (height, width, 3 or 4) of bytes; alpha is left out."""
    return jpegs(image[None], quality)[0]
