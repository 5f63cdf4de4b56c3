"""Pixel work on arrays (height, width, 4) of bytes: boxes, fractions, digests, hashes and composition.

The functions are plain numpy; *_frames run them over rows (path, height, width, pixels binary) with Arrow batches.
"""

from __future__ import annotations

import hashlib
import itertools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .jpeg import jpegs

#: Drawing order of figure parts; others stand at 30.
PART_ORDER = {
    "capeBelowBody": 0, "backHairBelowCap": 1, "body": 10, "pants": 15, "shoes": 16, "coat": 20, "armBelowHead": 25, "arm": 30,
    "lHand": 31, "rHand": 31, "weaponBelowArm": 32, "weapon": 35, "head": 40, "face": 45, "hair": 50, "hairOverHead": 51, "cap": 60, "capOverHair": 61,
}
OTHER_PARTS, LARGEST, SATURATED = 30, 512, 0.55
SKY = (184, 222, 245)


def alpha_box(image: np.ndarray) -> tuple[int, int, int, int] | None:
    """(left, top, right, bottom) of the pixels that are not transparent; None if all are."""
    rows, columns = image[..., 3].any(axis=1), image[..., 3].any(axis=0)
    if not rows.any():
        return None
    (top, bottom), (left, right) = np.flatnonzero(rows)[[0, -1]], np.flatnonzero(columns)[[0, -1]]
    return int(left), int(top), int(right) + 1, int(bottom) + 1


def paste(canvas: np.ndarray, sprite: np.ndarray, x: int, y: int, flip: bool = False) -> None:
    """Draws sprite over canvas in place; what lies outside is cut off."""
    sprite = sprite[:, ::-1] if flip else sprite
    x0, y0, x1, y1 = max(0, x), max(0, y), min(canvas.shape[1], x + sprite.shape[1]), min(canvas.shape[0], y + sprite.shape[0])
    if x0 >= x1 or y0 >= y1:
        return
    over, under = sprite[y0 - y : y1 - y, x0 - x : x1 - x], canvas[y0:y1, x0:x1]
    if (((over[..., 3] + 1) & 254) == 0).all() and (under[..., 3] == 255).all():  # nothing to blend: alpha is 0 or 255
        np.copyto(under, over, where=over[..., 3:] > 0)
        return
    over, under = over.astype(np.float64) / 255, under.astype(np.float64) / 255
    a, b = over[..., 3:], under[..., 3:]
    alpha = a + b * (1 - a)
    colour = np.divide(over[..., :3] * a + under[..., :3] * b * (1 - a), alpha, out=np.zeros_like(over[..., :3]), where=alpha > 0)
    canvas[y0:y1, x0:x1] = np.rint(np.concatenate([colour, alpha], axis=2) * 255).astype(np.uint8)


def digest(image: np.ndarray) -> tuple[str, int, int, int, float]:
    """(sha256 of size and pixels of the alpha box, width, height, opaque pixels, saturated share of them)."""
    box = alpha_box(image)
    if box is None:
        raise ValueError("an image without a visible pixel")
    left, top, right, bottom = box
    cut = np.ascontiguousarray(image[top:bottom, left:right])
    seen = cut[..., 3] > 0
    rgb = cut[..., :3].astype(np.float32) / 255
    most, least = rgb.max(axis=2), rgb.min(axis=2)
    saturation = np.divide(most - least, most, out=np.zeros_like(most), where=most > 0)
    size = struct.pack("<HH", right - left, bottom - top)
    return hashlib.sha256(size + cut.tobytes()).hexdigest(), right - left, bottom - top, int(seen.sum()), float((saturation[seen] >= SATURATED).mean())


def visibility(alpha: np.ndarray, x: int, y: int, front: np.ndarray) -> tuple[float, float, float]:
    """(share inside the frame, visible share, covered share of what is inside) of a sprite's alpha at (x, y) behind front's alpha."""
    height, width = front.shape
    inside = alpha[max(0, -y) : max(0, height - y), max(0, -x) : max(0, width - x)]
    cover = front[max(0, y) : max(0, y + alpha.shape[0]), max(0, x) : max(0, x + alpha.shape[1])]
    total = max(1, int((alpha > 0).sum()))
    kept = int((inside > 0).sum())
    # products of two bytes count as covered only from 1 of 255 up
    covered = int((inside.astype(np.uint32) * cover + 127 >= 255).sum()) if kept else 0
    return kept / total, max(0.0, (kept - covered) / total), covered / kept if kept else 0.0


def _window(size: int, out: int) -> np.ndarray:
    """Weights of a three-lobed windowed sinc that resamples size samples to out."""
    scale = size / out
    wide = max(1.0, scale)
    centre = (np.arange(out) + 0.5) * scale
    x = (np.arange(size) + 0.5 - centre[:, None]) / wide
    w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
    return w / w.sum(axis=1, keepdims=True)


def perceptual_hash(image: np.ndarray) -> int:
    """64 bits: the low 8 by 8 cosine coefficients of the grey 32 by 32 image over the median of rows 1 to 7."""
    grey = image[..., :3].astype(np.float64) @ np.array([0.299, 0.587, 0.114])
    small = np.rint(np.clip(_window(grey.shape[0], 32) @ grey @ _window(grey.shape[1], 32).T, 0, 255))
    k = np.arange(32)
    basis = np.sqrt(np.where(k == 0, 1, 2) / 32)[:, None] * np.cos(np.pi * (2 * k[None] + 1) * k[:, None] / 64)
    low = (basis @ small @ basis.T)[:8, :8]
    return int.from_bytes(np.packbits((low > np.median(low[1:])).ravel()).tobytes(), "big")


def compose(parts: list[dict], required: set[str] = frozenset()) -> dict | None:
    """One figure of parts {path, z, image, origin, anchors}: parts that share an anchor with the figure are attached until
    none is left that does. None if a required part is missing or stays loose, or the figure is larger than LARGEST."""
    if not parts or not required <= {p["path"] for p in parts}:
        return None
    body = next((p for p in parts if p["z"] == "body" or p["path"].endswith("/body")), parts[0])
    known = dict(body["anchors"])
    placed, loose = [(body, 0, 0)], [p for p in parts if p is not body]
    moved = True
    while moved and loose:
        moved = False
        still = []
        for p in loose:
            shared = next((n for n in p["anchors"] if n in known), None)
            if shared is None:
                still.append(p)
                continue
            at = (known[shared][0] - p["anchors"][shared][0], known[shared][1] - p["anchors"][shared][1])
            placed.append((p, *at))
            for n, (ax, ay) in p["anchors"].items():
                known.setdefault(n, (at[0] + ax, at[1] + ay))
            moved = True
        loose = still
    if any(p["path"] in required for p in loose):
        return None
    corners = [(x - p["origin"][0], y - p["origin"][1], p) for p, x, y in placed]
    left, top = min(c[0] for c in corners), min(c[1] for c in corners)
    width = max(c[0] + c[2]["image"].shape[1] for c in corners) - left
    height = max(c[1] + c[2]["image"].shape[0] for c in corners) - top
    if not (0 < width <= LARGEST and 0 < height <= LARGEST):
        return None
    canvas = np.zeros((height, width, 4), np.uint8)
    for x, y, p in sorted(corners, key=lambda c: (PART_ORDER.get(c[2]["z"], OTHER_PARTS), c[2]["path"])):
        paste(canvas, p["image"], x - left, y - top)
    return {"path": "composite", "image": canvas, "origin": (-left, -top)}


#: Least height and largest side of a whole figure, and the widest gap between its rows.
FIGURE_ROWS, FIGURE_SIDE, FIGURE_GAP = 35, 180, 3


def whole_figure(parts: list[dict], mandatory: dict[str, tuple[str, ...]]) -> dict | None:
    """compose() of parts that make a whole figure, else None: every mandatory part is there under one of its names and all parts are
    attached; the figure has a person's size and no gap of rows. mandatory: part -> the last path segments that count as it."""
    names = {p["path"].rsplit("/", 1)[-1] for p in parts}
    if not all(names & set(of) for of in mandatory.values()):
        return None
    out = compose(parts, {p["path"] for p in parts})
    if out is None or max(out["image"].shape[:2]) > FIGURE_SIDE:
        return None
    rows = np.flatnonzero(out["image"][..., 3].any(axis=1))
    return None if len(rows) < FIGURE_ROWS or (np.diff(rows) > FIGURE_GAP).any() else out


def figures(parts: DataFrame, mandatory: dict[str, tuple[str, ...]]) -> DataFrame:
    """(figure, digest, width, height, complete) of groups of parts (figure, path, z, height, width, pixels, origin_x, origin_y,
    anchors map<string, struct<x:int,y:int>>). A figure is a few parts, so each is one group."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("path")
        held = [
            {"path": r.path, "z": r.z, "image": np.frombuffer(r.pixels, np.uint8).reshape(r.height, r.width, 4), "origin": (r.origin_x, r.origin_y), "anchors": {k: (v["x"], v["y"]) for k, v in dict(r.anchors).items()}}
            for r in pdf.itertuples()
        ]
        made = whole_figure(held, mandatory)
        row = (pdf["figure"].iloc[0], *(digest(made["image"])[:3] if made else (None, 0, 0)), made is not None)
        return pd.DataFrame([row], columns=["figure", "digest", "width", "height", "complete"])

    kind = parts.schema["figure"].dataType.simpleString()
    return parts.groupBy("figure").applyInPandas(one, f"figure {kind}, digest string, width int, height int, complete boolean")


#: Digits of five rows of three pixels, a bit each, the top row first.
DIGITS = {"0": 0b111101101101111, "1": 0b010110010010111, "2": 0b111001111100111, "3": 0b111001111001111, "4": 0b101101111001001, "5": 0b111100111001111, "6": 0b111100111101111, "7": 0b111001010010010, "8": 0b111101111101111, "9": 0b111101111001111}


def number_sprite(text: str, scale: int = 3, colour: tuple[int, int, int] = (255, 188, 32), edge: tuple[int, int, int] = (40, 20, 20)) -> np.ndarray:
    """A number as a sprite: digits of three by five cells with an edge round them."""
    cells = np.zeros((5, 4 * len(text) - 1), bool)
    for i, c in enumerate(text):
        cells[:, 4 * i : 4 * i + 3] = (DIGITS[c] >> np.arange(14, -1, -1)).reshape(5, 3) & 1
    inside = np.pad(np.kron(cells, np.ones((scale, scale), bool)), 2)
    wide = np.zeros_like(inside)
    for dy in range(-2, 3):
        for dx in range(-2, 3):
            wide |= np.roll(inside, (dy, dx), (0, 1))
    out = np.zeros((*inside.shape, 4), np.uint8)
    out[wide] = (*edge, 255)
    out[inside] = (*colour, 255)
    return out


def sheet(images: list[np.ndarray], columns: int, cell: tuple[int, int]) -> np.ndarray:
    """A contact sheet: images row by row in cells (width, height), each in the middle of its cell, cut where it is larger."""
    rows = -(-len(images) // columns)
    out = np.full((max(1, rows) * cell[1], columns * cell[0], 4), 255, np.uint8)
    for i, image in enumerate(images):
        left, top = i % columns * cell[0], i // columns * cell[1]
        part = out[top : top + cell[1], left : left + cell[0]]
        paste(part, image, (cell[0] - image.shape[1]) // 2, (cell[1] - image.shape[0]) // 2)
    return out


def lit(image: np.ndarray, factor: float) -> np.ndarray:
    """Brightness by a factor; alpha stays."""
    out = image.copy()
    out[..., :3] = np.clip(np.rint(out[..., :3] * factor), 0, 255)
    return out


def faded(image: np.ndarray, share: float) -> np.ndarray:
    """Blend towards black."""
    return lit(image, 1 - share)


def png(image: np.ndarray) -> bytes:
    """Lossless file of an image, without an imaging library."""
    rows = np.concatenate([np.zeros((image.shape[0], 1), np.uint8), image.reshape(image.shape[0], -1)], axis=1).tobytes()
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", image.shape[1], image.shape[0], 8, 6, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def read_png(data: bytes) -> np.ndarray:
    """Pixels of an 8-bit RGB or RGBA file without interlacing; RGB gets full alpha."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG file")
    at, packed, head = 8, b"", b""
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        head, packed = (body if kind == b"IHDR" else head), (packed + body if kind == b"IDAT" else packed)
        at += 12 + size
    width, height, depth, colour, _, _, laced = struct.unpack(">IIBBBBB", head)
    if depth != 8 or colour not in (2, 6) or laced:
        raise ValueError("only 8-bit RGB and RGBA without interlacing")
    n = 3 if colour == 2 else 4
    rows = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(height, 1 + width * n)
    out = np.zeros((height, width, n), np.uint8)
    above = np.zeros((width, n), np.int64)
    for y, row in enumerate(rows):
        line = row[1:].reshape(width, n).astype(np.int64)
        if row[0] == 1:
            line = np.cumsum(line, axis=0)
        elif row[0] == 2:
            line = line + above
        elif row[0] in (3, 4):
            left, corner = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for x in range(width):
                if row[0] == 3:
                    guess = (left + above[x]) // 2
                else:
                    p = left + above[x] - corner
                    a, b, c = np.abs(p - left), np.abs(p - above[x]), np.abs(p - corner)
                    guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, above[x], corner))
                line[x] = (line[x] + guess) & 255
                left, corner = line[x], above[x]
        above = line & 255
        out[y] = above
    return out if n == 4 else np.concatenate([out, np.full((height, width, 1), 255, np.uint8)], axis=2)


def _images(pdf: pd.DataFrame) -> Iterator[tuple[str, np.ndarray]]:
    for path, h, w, raw in zip(pdf["path"], pdf["height"], pdf["width"], pdf["pixels"], strict=True):
        yield path, np.frombuffer(raw, np.uint8).reshape(h, w, 4)


def digest_frames(frames: DataFrame) -> DataFrame:
    """(path, digest, width, height, alpha_pixels, saturated, phash) of frames; fully transparent ones have nulls."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(p, *(digest(i) if alpha_box(i) else (None, 0, 0, 0, 0.0)), f"{perceptual_hash(i):016x}") for p, i in _images(pdf)]
            yield pd.DataFrame(rows, columns=["path", "digest", "width", "height", "alpha_pixels", "saturated", "phash"])

    return frames.select("path", "height", "width", "pixels").mapInPandas(run, "path string, digest string, width int, height int, alpha_pixels long, saturated double, phash string")


#: What is drawn after what. Only targets and hidden objects give rows; npcs, tiles and objects are drawn and stay unlabelled.
DRAWN = ("back", "tile", "object", "npc", "target", "hidden", "front")


def _tiled(image: np.ndarray, x: int, y: int, step_x: int, step_y: int, width: int, height: int) -> Iterator[tuple[int, int]]:
    """Where a sprite is drawn that repeats by a step, 0 for an axis on which it does not."""
    axis = lambda at, step, size, extent: range(at - -(-(at + size) // step) * step + step, extent, step) if step else [at]
    for py in axis(y, step_y, image.shape[0], height):
        for px in axis(x, step_x, image.shape[1], width):
            yield px, py


#: Rows of placed sprites that one task's copy of a sprite meets: pictures that more rows use are joined in several copies.
USES = 100_000


def _with_pictures(scenes: DataFrame, sprites: DataFrame) -> DataFrame:
    """scenes with height, width and pixels by path. A picture that very many rows use would send all of them to one task, so its rows
    are dealt by scene to as many copies of it as they need."""
    often = scenes.groupBy("path").agg(F.count("*").alias("_n")).where(F.col("_n") > USES).select("path", F.ceil(F.col("_n") / USES).cast("int").alias("_copies"))
    copies = F.coalesce("_copies", F.lit(1))
    rows = scenes.join(often, "path", "left").withColumn("_copy", F.pmod(F.hash("scene"), copies)).drop("_copies")
    pictures = sprites.select("path", "height", "width", "pixels").join(often, "path", "left").withColumn("_copy", F.explode(F.sequence(F.lit(0), copies - 1))).drop("_copies")
    return rows.join(pictures, ["path", "_copy"]).drop("_copy")


def _cover(cover: np.ndarray, alpha: np.ndarray, places: list[tuple[int, int]]) -> None:
    """Raises cover to the alpha of a sprite that is drawn at places, where its own pieces may overlap."""
    layer = cover if len(places) == 1 else np.zeros_like(cover)
    for x, y in places:
        x0, y0, x1, y1 = max(0, x), max(0, y), min(cover.shape[1], x + alpha.shape[1]), min(cover.shape[0], y + alpha.shape[0])
        if x0 >= x1 or y0 >= y1:
            continue
        over, under = alpha[y0 - y : y1 - y, x0 - x : x1 - x], layer[y0:y1, x0:x1]
        if layer is cover:
            np.maximum(under, over, out=under)
        else:
            a, b = over / 255, under / 255
            under[...] = np.rint((a + b * (1 - a)) * 255)
    if layer is not cover:
        np.maximum(cover, layer, out=cover)


LABEL = ("path", "x", "y", "w", "h", "clip_fraction", "visible_fraction", "occlusion_fraction")


def _scene_rows(drawn: list[tuple], width: int, height: int, least_clip: float, least_visible: float) -> tuple[list[tuple], list[tuple]]:
    """(labels, hidden objects) of a scene's (kind, path, image, x, y, places) in drawing order, as tuples of LABEL, hidden ones with
    their largest overlap with a target."""
    cover = np.zeros((height, width), np.uint8)  # alpha of all that is drawn later
    found: dict[int, tuple[float, float, float]] = {}
    for i in range(len(drawn) - 1, -1, -1):
        kind, _, image, x, y, places = drawn[i]
        if kind in ("target", "hidden"):
            found[i] = visibility(image[..., 3], x, y, cover)
        if kind in ("hidden", "front"):
            _cover(cover, image[..., 3], places)
    labels: list[tuple] = []
    hidden: list[tuple] = []
    for i, (kind, path, image, x, y, _) in enumerate(drawn):
        box = alpha_box(image) if i in found else None
        if box is None:
            continue
        left, top, right, bottom = max(0, x + box[0]), max(0, y + box[1]), min(width, x + box[2]), min(height, y + box[3])
        clip, visible, covered = found[i]
        row = (path, left, top, right - left, bottom - top, round(clip, 4), round(visible, 4), round(covered, 4))
        if kind == "target" and right - left >= 4 and bottom - top >= 4 and clip >= least_clip and visible >= least_visible:
            labels.append(row)
        elif kind == "hidden" and right > left and bottom > top:
            hidden.append((*row, round(max([0.0, *(_overlap(row[1:5], t[1:5]) for t in labels)]), 4)))
    return labels, hidden


def _lists(rows: list[list[tuple]], kind: pa.DataType) -> pa.Array:
    """A column of arrays of structs, from tuples of the struct's fields."""
    flat = list(zip(*itertools.chain.from_iterable(rows), strict=True)) or [()] * kind.value_type.num_fields
    fields = list(kind.value_type)
    values = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(flat, fields, strict=True)], fields=fields)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), values).cast(kind)


def render_scenes(scenes: DataFrame, sprites: DataFrame, width: int, height: int, least_clip: float = 0.3, least_visible: float = 0.3, quality: int | None = 92, images: bool = True) -> DataFrame:
    """Scenes of placed sprites to an image, its labels and its hidden objects.

    scenes: (scene, layer, kind, path, x, y, flip), optionally with alpha (0 to 255), step_x and step_y; kind is one of DRAWN. Rows meet
    their pixels by a join, then a scene's rows stand together and are read in a row: kinds are drawn in the order of DRAWN and by layer inside a
    kind, over a sky. What stands in front, and hidden objects drawn later, cover. One row per scene: (scene, image, labels, hidden): a JPEG of a quality,
    or a PNG where it is None, with clip, visible and covered shares rounded to four places; hidden objects also have their largest
    overlap with a target. Shares do not depend on colours, so without images, for those who read no image, only the drawing is left out."""
    for name, value in (("alpha", 255), ("step_x", 0), ("step_y", 0)):
        scenes = scenes if name in scenes.columns else scenes.withColumn(name, F.lit(value))
    label = "path:string,x:int,y:int,w:int,h:int,clip_fraction:double,visible_fraction:double,occlusion_fraction:double"
    kind = scenes.schema["scene"].dataType.simpleString()
    types = ["image binary"] * images + [f"labels array<struct<{label}>>", f"hidden array<struct<{label},max_target_iou:double>>"]
    columns = ["scene", "kind", "path", "x", "y", "flip", "alpha", "step_x", "step_y", "height", "width", "pixels"]
    list_of = lambda *more: pa.list_(pa.struct([("path", pa.string()), *((c, pa.int32()) for c in LABEL[1:5]), *((c, pa.float64()) for c in (*LABEL[5:], *more))]))
    held = max(1, 2**18 // (width * height))  # scenes whose images are written at once

    def one(rows: Iterator[tuple]) -> tuple:
        drawn = []
        for _, kind, path, x, y, flip, alpha, step_x, step_y, h, w, raw in rows:
            if kind not in DRAWN:
                raise ValueError(f"{kind} is not one of {DRAWN}")
            image = np.frombuffer(raw, np.uint8).reshape(h, w, 4)
            if alpha < 255:
                image = image.copy()
                image[..., 3] = image[..., 3].astype(int) * alpha // 255
            image = image[:, ::-1] if flip else image
            drawn.append((kind, path, image, x, y, list(_tiled(image, x, y, step_x, step_y, width, height))))
        if not images:
            return None, *_scene_rows(drawn, width, height, least_clip, least_visible)
        canvas = np.empty((height, width, 4), np.uint8)
        canvas[...] = (*SKY, 255)
        for _, _, image, _, _, places in drawn:
            for px, py in places:
                paste(canvas, image, px, py)
        return canvas, *_scene_rows(drawn, width, height, least_clip, least_visible)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []  # of the scene's column

        def rows() -> Iterator[tuple]:
            for batch in batches:
                types[:] = [batch.schema.field("scene").type]
                yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)

        # a scene may go on in the next batch, so groups are cut in the stream of rows
        made = ((scene, one(own)) for scene, own in itertools.groupby(rows(), key=lambda r: r[0]))
        while part := list(itertools.islice(made, held if images else 4096)):
            names, found = zip(*part, strict=True)
            canvases, labels, hidden = zip(*found, strict=True)
            out = {"scene": pa.array(names, types[0])}
            if images:
                out["image"] = pa.array([png(c) for c in canvases] if quality is None else jpegs(np.stack(canvases), quality), pa.binary())
            out |= {"labels": _lists(labels, list_of()), "hidden": _lists(hidden, list_of("max_target_iou"))}
            yield pa.RecordBatch.from_pydict(out)

    turn = F.array_position(F.array(*map(F.lit, DRAWN)), F.col("kind"))
    placed = _with_pictures(scenes, sprites).repartition("scene").sortWithinPartitions("scene", turn, "layer", "path", "x", "y")
    return placed.select(*columns).mapInArrow(run, ", ".join([f"scene {kind}", *types]))


def _overlap(a: tuple, b: tuple) -> float:
    """Intersection over union of two boxes (x, y, w, h)."""
    wide = max(0, min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0]))
    both = wide * max(0, min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1]))
    union = a[2] * a[3] + b[2] * b[3] - both
    return both / union if union else 0.0
