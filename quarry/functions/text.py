"""Names, number formats and classifications of labels and manifests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scenario families and action families, first match wins.
NATURAL = ("natural_sparse", "natural_standard", "multi_platform")
FAMILIES = ("natural", "dense", "edge", "occlusion", "clutter", "negative")
DEAD = "die|dead|death"


def stem(split: Column, index: Column) -> Column:
    return F.format_string("%s_%06d", split, index.cast("int"))


def scenario_family(name: Column) -> Column:
    """dense before edge before occlusion before negative before natural; the rest is clutter."""
    return (
        F.when(name.contains("dense"), "dense")
        .when(name.contains("edge"), "edge")
        .when(name.contains("occlusion"), "occlusion")
        .when(name.startswith("negative_"), "negative")
        .when(name.isin(*NATURAL), "natural")
        .otherwise("clutter")
    )


def action_family(action: Column, families: tuple[str, ...]) -> Column:
    """The first family that the lower-cased action begins with, else the action."""
    low = F.lower(action)
    found = F.coalesce(*[F.when(low.startswith(f), F.lit(f)) for f in families])
    return F.coalesce(found, low)


def decimals(x: Column, n: int) -> Column:
    """Fixed decimals rounded half to even on the decimal value, without grouping."""
    return F.call_function("format_number", x, F.lit("0." + "0" * n))


def yolo_line(class_id: Column, x: Column, y: Column, w: Column, h: Column, width: int, height: int) -> Column:
    parts = [(x + w / 2) / width, (y + h / 2) / height, w / F.lit(width), h / F.lit(height)]
    return F.concat_ws(" ", class_id.cast("string"), *[decimals(p, 8) for p in parts])


def hex16(x: Column) -> Column:
    return F.lpad(F.lower(F.hex(x)), 16, "0")


def guid_key(path: Column) -> Column:
    """Hex of the md5 of a path with the byte order of a GUID: the first 4, 2 and 2 bytes reversed."""
    m = F.md5(path.cast("binary"))
    order = [7, 5, 3, 1, 11, 9, 15, 13]
    return F.concat(*[F.substring(m, i, 2) for i in order], F.substring(m, 17, 16))


def map_id(key: Column) -> Column:
    """Nine digits of a map's key, null where there are none."""
    found = F.regexp_extract(key, r"/Map/Map/Map\d/(\d{9})", 1)
    return F.when(found != "", found)


def item_id(path: Column, fallback: Column) -> Column:
    """The leading path segment if it is seven digits or more."""
    head = F.element_at(F.split(path, "/"), 1)
    return F.when(head.rlike(r"^\d{7,}$"), head).otherwise(fallback)
