"""Sprite atlases: frame tables, key lookup, alias chains and crops of binary blobs.

Layout (fixed values of the format): magic WZSS, int32 version 4 or 5. A blob with a header in front of it
names its tables by (count, offset) pairs; an older blob holds a frame table that is found by its
sequential ids. All integers are little-endian int32.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

MAGIC, VERSIONS, HEADER_FIELDS = b"WZSS", (4, 5), 19
FRAMES = "asset string, frame int, name string, page int, x int, y int, w int, h int, alias_of int, pivot_x float, pivot_y float, error string"


class AtlasError(ValueError):
    """A blob that does not hold a readable atlas."""


def sprite_key(path: str) -> str:
    """md5 of the path written as a GUID: its first three fields are little-endian."""
    d = hashlib.md5(path.encode()).digest()
    return (d[3::-1] + d[5:3:-1] + d[7:5:-1] + d[8:]).hex()


@dataclass
class Atlas:
    """Frame columns as arrays; alias is -1 for a frame with pixels of its own."""

    page: np.ndarray
    box: np.ndarray
    alias: np.ndarray
    pivot: np.ndarray
    names: dict[str, int] = field(default_factory=dict)

    def resolve(self, frame: int) -> int:
        """The frame that an alias chain ends in."""
        steps = 0
        while self.alias[frame] >= 0:
            frame, steps = int(self.alias[frame]), steps + 1
            if steps > len(self.alias):
                raise AtlasError("alias chain without an end")
        return frame

    def find(self, path: str) -> int:
        key = sprite_key(path)
        if key not in self.names:
            raise AtlasError(f"no frame for {path}")
        return self.names[key]

    def crop(self, frame: int, pages: list[np.ndarray]) -> np.ndarray:
        """Pixels of a frame; boxes count from the bottom left, arrays from the top."""
        frame = self.resolve(frame)
        number = int(self.page[frame])
        if not 0 <= number < len(pages):
            raise AtlasError("no such page")
        pixels = pages[number]
        x, y, w, h = map(int, self.box[frame])
        if x < 0 or y < 0 or x + w > pixels.shape[1] or y + h > pixels.shape[0]:
            raise AtlasError("box outside its page")
        top = pixels.shape[0] - y - h
        return pixels[top : top + h, x : x + w]


def encode(paths: list[str], boxes: list[tuple[int, int, int, int] | None], alias: list[int], pivots: list[tuple[float, float]], pages: int = 1) -> bytes:
    """An atlas with a header: frames in the order of paths, with a box on page 0 or, where that is None, the frame they stand for."""
    direct = [(i, i, 0, k, k) for k, i in enumerate(i for i, b in enumerate(boxes) if b is not None)]
    links = [(i, -1, -1, alias[i]) for i, b in enumerate(boxes) if b is None]
    own = [b for b in boxes if b is not None]
    names = [sprite_key(p).encode() for p in paths]
    blob, at = MAGIC + np.array([VERSIONS[-1]], "<i4").tobytes(), {}
    for key, values, dtype in (
        ("pages", list(range(pages)), "<i4"), ("pivots", [p for p, b in zip(pivots, boxes, strict=True) if b is not None], "<f4"), ("boxes", own, "<i4"), ("direct", direct, "<i4"),
        ("links", links, "<i4"), ("cuts", np.cumsum([0, *map(len, names)]).tolist(), "<i4"),
    ):
        at[key] = len(blob)
        blob += np.array(values, dtype).tobytes()
    fields = (pages, at["pages"], 0, 0, 0, len(own), at["pivots"], len(own), at["boxes"], len(direct), at["direct"], len(links), at["links"], len(names), len(blob), at["cuts"], 0, 0, 0)
    blob += b"".join(names)
    return bytes(32) + np.array(fields, "<i4").tobytes() + np.array([len(blob)], "<i4").tobytes() + blob


def _table(blob: bytes, count: int, offset: int, width: int, kind: str = "<i4") -> np.ndarray:
    if count < 0 or offset < 8 or offset + count * width * 4 > len(blob):
        raise AtlasError("table outside the blob")
    return np.frombuffer(blob, kind, count * width, offset).reshape(count, width)


def _indexes(values: np.ndarray, limit: int) -> None:
    if len(values) and (values.min() < 0 or values.max() >= limit):
        raise AtlasError("index outside its table")


def read_atlas(raw: bytes, sprites: int) -> Atlas:
    """The atlas in raw; sprites is the number of frames an old blob is expected to have."""
    at = raw.find(MAGIC)
    if at < 0:
        raise AtlasError("no atlas magic")
    blob = raw[at:]
    ints = lambda b, n, o: np.frombuffer(b, "<i4", n, o)
    if len(blob) < 8 or ints(blob, 1, 4)[0] not in VERSIONS:
        raise AtlasError("unknown atlas version")
    if at >= 32:
        name = int(ints(raw, 1, 28)[0])
        start = (32 + name + 3) // 4 * 4
        if name >= 0 and start + 4 * HEADER_FIELDS <= at:
            return _with_header(blob, ints(raw, HEADER_FIELDS, start).tolist())
    return _searched(blob, sprites)


def _with_header(blob: bytes, f: list[int]) -> Atlas:
    slots = _table(blob, f[0], f[1], 1)[:, 0]
    if sorted(slots) != list(range(len(slots))):
        raise AtlasError("pages are not a permutation")
    pivots = _table(blob, f[5], f[6], 2, "<f4")
    boxes = _table(blob, f[7], f[8], 4)
    direct, links = _table(blob, f[9], f[10], 5), _table(blob, f[11], f[12], 4)
    n, data = f[13], f[14]
    cuts = _table(blob, n + 1, f[15], 1)[:, 0]
    if cuts[0] != 0 or (np.diff(cuts) < 0).any() or data + int(cuts[-1]) > len(blob):
        raise AtlasError("name pool is broken")
    names = [blob[data + a : data + b].decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    for column, limit in zip(direct.T, (n, n, len(slots), len(boxes), len(pivots)), strict=True):
        _indexes(column, limit)
    _indexes(links[:, 0], n)
    _indexes(links[:, 3], n)
    out = Atlas(np.full(n, -1, np.int32), np.zeros((n, 4), np.int32), np.full(n, -1, np.int32), np.full((n, 2), np.nan, np.float32))
    frame, name, slot, box, pivot = direct.T
    if len(direct) and (boxes[box][:, 2:] <= 0).any():
        raise AtlasError("empty box")
    out.page[frame], out.box[frame], out.pivot[frame] = slots[slot], boxes[box], pivots[pivot]
    out.alias[links[:, 0]] = links[:, 3]
    if len({*frame.tolist(), *links[:, 0].tolist()}) != n:
        raise AtlasError("frames are missing")
    out.names = {names[i]: int(x) for i, x in zip(name, frame, strict=True)} | {names[i]: int(i) for i in links[:, 0]}
    return out


def _searched(blob: bytes, sprites: int) -> Atlas:
    """Old blobs: the frame table is where rows (i, i, page, box, ·) begin, boxes stand before it, aliases after."""
    words = np.frombuffer(blob, "<i4", len(blob) // 4)
    for start in np.flatnonzero((words[2:-4] == 0) & (words[3:-3] == 0) & (words[4:-2] >= 0) & (words[5:-1] == 0)) + 2:
        rows = words[start : start + 5 * min(sprites, (len(words) - start) // 5)].reshape(-1, 5)
        order = np.arange(len(rows))
        good = (rows[:, 0] == order) & (rows[:, 1] == order) & (rows[:, 2] >= 0) & (rows[:, 3] >= 0)
        count = len(rows) if good.all() else int(good.argmin())
        many = int(rows[:count, 3].max(initial=-1)) + 1
        first = start - 4 * many
        if not count or not many or first < 2:
            continue
        boxes = words[first:start].reshape(-1, 4)
        if (boxes[:, 2:] <= 0).any():
            continue
        aliases = _aliases(words, start + 5 * count, count, sprites)
        if aliases is None:
            continue
        n = count + len(aliases)
        out = Atlas(np.full(n, -1, np.int32), np.zeros((n, 4), np.int32), np.full(n, -1, np.int32), np.full((n, 2), np.nan, np.float32))
        out.page[:count], out.box[:count], out.alias[count:] = rows[:count, 2], boxes[rows[:count, 3]], aliases
        return out
    raise AtlasError("no frame table found")


def _aliases(words: np.ndarray, start: int, direct: int, sprites: int) -> np.ndarray | None:
    """Targets of the frames after the direct ones, in either of two row layouts; None if there should be some and are not."""
    wanted = sprites - direct
    if not wanted:
        return np.zeros(0, np.int32)
    for shift in range(5):
        rows = words[start + shift : start + shift + 4 * wanted]
        if len(rows) < 4 * wanted:
            continue
        rows = rows.reshape(-1, 4)
        own = direct + np.arange(wanted)
        for good, target in (
            ((rows[:, 0] == own) & (rows[:, 1] >= -1) & (rows[:, 2] == -1) & (rows[:, 3] >= 0) & (rows[:, 3] < sprites), rows[:, 3]),
            ((rows[:, 0] == -1) & (rows[:, 1] == -1) & (rows[:, 2] >= 0) & (rows[:, 2] < sprites) & (rows[:, 3] == own), rows[:, 2]),
        ):
            held = wanted if good.all() else int(good.argmin())
            if held and direct + held >= round(sprites * 0.95):
                return target[:held]
    return None


def decode_frames(blobs: DataFrame, asset: str = "asset", content: str = "content", sprites: str = "sprites") -> DataFrame:
    """One row per frame of every blob (FRAMES); an unreadable blob is one row with its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, raw, n in zip(pdf[asset], pdf[content], pdf[sprites], strict=True):
                try:
                    a = read_atlas(bytes(raw), int(n))
                except (AtlasError, ValueError) as problem:
                    yield pd.DataFrame([(name, *[None] * 10, str(problem))], columns=[c.split()[0] for c in FRAMES.split(", ")])
                    continue
                of = {v: k for k, v in a.names.items()}
                yield pd.DataFrame(
                    {
                        "asset": name, "frame": np.arange(len(a.page)), "name": [of.get(i) for i in range(len(a.page))], "page": a.page,
                        "x": a.box[:, 0], "y": a.box[:, 1], "w": a.box[:, 2], "h": a.box[:, 3], "alias_of": a.alias,
                        "pivot_x": a.pivot[:, 0], "pivot_y": a.pivot[:, 1], "error": None,
                    }
                )

    return blobs.select(asset, content, sprites).mapInPandas(run, FRAMES)


def resolved_aliases(frames: DataFrame) -> DataFrame:
    """(asset, frame, target) of every frame by following its aliases to the end; a cycle raises in the query. An atlas was read as one
    blob, so its frame numbers are one group; steps are doubled until the longest chain is done."""

    def follow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("frame")
        frame, alias = pdf["frame"].to_numpy(), pdf["alias_of"].fillna(-1).to_numpy(np.int64)
        place = np.minimum(np.searchsorted(frame, alias), len(frame) - 1)
        goes_on = (alias >= 0) & (frame[place] == alias)
        at = np.where(goes_on, place, np.arange(len(frame)))
        for _ in range(len(frame).bit_length()):
            at = at[at]
        if goes_on[at].any():
            raise AtlasError(f"alias chain without an end in {pdf['asset'].iloc[0]}")
        return pd.DataFrame({"asset": pdf["asset"], "frame": frame, "target": np.where(alias[at] >= 0, alias[at], frame[at])})

    kind = frames.schema["asset"].dataType.simpleString()
    return frames.where("error is null").select("asset", "frame", "alias_of").groupBy("asset").applyInPandas(follow, f"asset {kind}, frame int, target int")
