"""Box, platform and camera expressions. A box is (x, y, w, h) in pixels; all functions give Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH, HEIGHT, LEAST = 1280, 224, 4


def _box(p: str) -> tuple[Column, Column, Column, Column]:
    return tuple(F.col(f"{p}{c}") for c in "xywh")


def intersection(a: str = "a.", b: str = "b.") -> Column:
    (ax, ay, aw, ah), (bx, by, bw, bh) = _box(a), _box(b)
    wide = F.greatest(F.lit(0), F.least(ax + aw, bx + bw) - F.greatest(ax, bx))
    return wide * F.greatest(F.lit(0), F.least(ay + ah, by + bh) - F.greatest(ay, by))


def iou(a: str = "a.", b: str = "b.") -> Column:
    """Intersection over union; 0 where the union is empty."""
    (_, _, aw, ah), (_, _, bw, bh) = _box(a), _box(b)
    both = intersection(a, b)
    union = aw * ah + bw * bh - both
    return F.when(union > 0, both.cast("double") / union).otherwise(F.lit(0.0))


def separated(gap: int, a: str = "a.", b: str = "b.") -> Column:
    """Whether two boxes keep a gap on at least one axis."""
    (ax, ay, aw, ah), (bx, by, bw, bh) = _box(a), _box(b)
    return (ax + aw + gap <= bx) | (bx + bw + gap <= ax) | (ay + ah + gap <= by) | (by + bh + gap <= ay)


def inside(p: str = "", margin: int = 0, least: int = LEAST, width: int = WIDTH, height: int = HEIGHT) -> Column:
    """Whether a box of a least side lies in the frame with a margin."""
    x, y, w, h = _box(p)
    return (x >= margin) & (y >= margin) & (x + w <= width - margin) & (y + h <= height - margin) & (w >= least) & (h >= least)


def edge_sides(p: str = "", width: int = WIDTH, height: int = HEIGHT) -> Column:
    """The sides, in the order LRTB, on which an unclipped box leaves the frame."""
    x, y, w, h = _box(p)
    side = lambda c, s: F.when(c, F.lit(s)).otherwise(F.lit(""))
    return F.concat(side(x < 0, "L"), side(x + w > width, "R"), side(y < 0, "T"), side(y + h > height, "B"))


def platform_y(x: Column, p: str = "") -> Column:
    """Ground height at x: the lower end of a vertical segment, else the line through it, rounded half to even."""
    x1, y1, x2, y2 = (F.col(f"{p}{c}") for c in ("x1", "y1", "x2", "y2"))
    line = y1 + (y2 - y1).cast("double") * (x - x1) / F.when(x2 != x1, x2 - x1)
    return F.when(x1 == x2, F.greatest(y1, y2)).otherwise(F.bround(line)).cast("int")


def frame_box(camera_x: Column, camera_y: Column, flip: Column) -> tuple[Column, Column]:
    """Top left corner of a sprite (world_x, world_y, width, origin_x, origin_y) under a camera; a flip mirrors the origin."""
    origin = F.when(flip, F.col("width") - F.col("origin_x")).otherwise(F.col("origin_x"))
    return F.col("world_x") - origin - camera_x, F.col("world_y") - F.col("origin_y") - camera_y


def tile_range(base: Column, step: Column, extent: int, sprite: Column) -> Column:
    """Positions base + i * step at which a repeated sprite touches [0, extent)."""
    first = F.floor((-sprite - base) / step) + 1
    last = F.ceil((extent - base) / step) - 1
    return F.when(last >= first, F.transform(F.sequence(first, last), lambda i: (base + i * step).cast("int"))).otherwise(F.array().cast("array<int>"))


def parallax_base(place: Column, camera: Column, rate: Column, extent: int, origin: Column) -> Column:
    """Where a background sprite's corner is drawn: rate is the percentage of the camera's way that the sprite moves along
    (0: pinned to the screen, -100: pinned to the world); rounded half to even."""
    return F.bround(place + extent / 2 + (camera + extent / 2) * rate / 100 - origin).cast("int")


def clamped(x: Column, size: Column, extent: int = WIDTH) -> Column:
    """The nearest place at which a sprite of a size lies inside [0, extent); 0 for one that is larger."""
    return F.greatest(F.lit(0), F.least(x, extent - size))
