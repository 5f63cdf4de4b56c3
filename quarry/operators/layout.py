"""Pairs of boxes inside an image, layout measures and their verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import geometry as g


def box_pairs(boxes: DataFrame, image: str = "image_id", idx: str = "idx") -> DataFrame:
    """Each pair idx < idx of one image once, with its iou. An equi-join on the image: boxes of an image are few."""
    own = boxes.select(image, idx, "x", "y", "w", "h")
    a, b = own.alias("a"), own.alias("b")
    joined = a.join(b, (F.col(f"a.{image}") == F.col(f"b.{image}")) & (F.col(f"a.{idx}") < F.col(f"b.{idx}")))
    return joined.select(F.col(f"a.{image}").alias(image), F.col(f"a.{idx}").alias("i"), F.col(f"b.{idx}").alias("j"), g.iou().alias("iou"))


def layout_measures(boxes: DataFrame, width: int = g.WIDTH) -> DataFrame:
    """Per image: n, pairs, max_iou, low pairs (under .05), overlapping (.05 and more), in the two bands, span, footholds."""
    pairs = box_pairs(boxes).groupBy("image_id").agg(
        F.count("*").alias("pairs"),
        F.max("iou").alias("max_iou"),
        F.count_if(F.col("iou") < 0.05).alias("low_pairs"),
        F.count_if(F.col("iou") >= 0.05).alias("overlapping"),
        F.count_if(F.col("iou").between(0.15, 0.45)).alias("mild"),
        F.count_if(F.col("iou").between(0.35, 0.70)).alias("severe"),
    )
    per = boxes.groupBy("image_id").agg(
        F.count("*").alias("n"),
        ((F.max(F.col("x") + F.col("w")) - F.min("x")) / F.lit(width)).alias("span"),
        (F.count_distinct("foothold_id") + F.max(F.col("foothold_id").isNull().cast("int"))).alias("footholds"),
    )
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("pairs", "low_pairs", "overlapping", "mild", "severe")}
    return per.join(pairs, "image_id", "left").withColumns(zero | {"max_iou": F.coalesce("max_iou", F.lit(0.0))})


def layout_valid(layout: str = "layout") -> Column:
    """Whether an image's measures fit the layout planned for it; images with one box fit any."""
    c = F.col
    low = c("low_pairs") / F.greatest(F.lit(1), c("pairs"))
    return (
        F.when(c("n") < 2, True)
        .when(c(layout) == "distributed", (c("span") >= 0.45) & F.when(c("n") <= 5, c("max_iou") < 0.05).otherwise(low >= 0.8))
        .when(c(layout) == "clustered", c("max_iou") <= F.when(c("multi_platform"), 0.70).otherwise(0.45))
        .when(c(layout) == "overlap", c("mild") > 0)
        .when(c(layout) == "severe_overlap", c("severe") > 0)
        .otherwise(True)
    )


def max_target_iou(hidden: DataFrame, targets: DataFrame) -> DataFrame:
    """Each hidden object's largest iou with a target of its image, 0 without any."""
    a, b = hidden.alias("a"), targets.alias("b")
    joined = a.join(b, F.col("a.image_id") == F.col("b.image_id"), "left")
    return joined.groupBy(F.col("a.image_id").alias("image_id"), F.col("a.idx").alias("idx")).agg(F.coalesce(F.max(g.iou()), F.lit(0.0)).alias("max_target_iou"))


def crowded_pairs(boxes: DataFrame, gap: int, image: str = "image_id") -> DataFrame:
    """Pairs of boxes that come closer than the gap."""
    own = boxes.select(image, "idx", "x", "y", "w", "h")
    a, b = own.alias("a"), own.alias("b")
    joined = a.join(b, (F.col(f"a.{image}") == F.col(f"b.{image}")) & (F.col("a.idx") < F.col("b.idx")) & ~g.separated(gap))
    return joined.select(F.col(f"a.{image}").alias(image), F.col("a.idx").alias("i"), F.col("b.idx").alias("j"))


def pair_bands(boxes: DataFrame, bands: dict[str, tuple[float, float]]) -> DataFrame:
    """(image_id, one count for each band): pairs whose iou lies in a band, both ends included."""
    return box_pairs(boxes).groupBy("image_id").agg(*[F.count_if(F.col("iou").between(*b)).alias(n) for n, b in bands.items()])


def acceptance() -> list[tuple[str, Column]]:
    """What speaks against a rendered scene, in the order in which it is asked. Columns: hidden_loot, loot, hidden_pets, pets, lacking
    (required kinds that are not seen), monsters, planned, players, planned_players (null where players are unlabelled), repeated (boxes that occur
    again), scenario, moderate and extreme (pairs in these bands), cut and covered (monsters cut or covered to the wanted share), small and
    tall (monsters of that size), bucket, and those of layout_valid with n, span, footholds and multi_platform."""
    some = F.col("monsters") > 0
    has = lambda word: F.col("scenario").contains(word)
    return [
        ("hidden", (F.col("hidden_loot") != F.col("loot")) | (F.col("hidden_pets") != F.col("pets")) | (F.col("lacking") > 0)),
        ("monsters", F.col("monsters") != F.col("planned")),
        ("players", F.coalesce(F.col("players") != F.col("planned_players"), F.lit(False))),
        ("repeated", F.col("repeated") > 0),
        ("dense", ((F.col("scenario") == "dense_moderate") & (F.col("moderate") == 0)) | ((F.col("scenario") == "dense_extreme") & (F.col("extreme") == 0))),
        ("edge", has("edge") & some & (F.col("cut") == 0)),
        ("occlusion", has("occlusion") & some & (F.col("covered") == 0)),
        ("layout", (F.col("monsters") >= 2) & ~F.coalesce(layout_valid(), F.lit(True))),
        ("platform", F.col("multi_platform") & (F.col("footholds") < 2)),
        ("size", (F.col("scenario") == "size_extreme") & (((F.col("bucket") == "small") & (F.col("small") == 0)) | ((F.col("bucket") == "large") & (F.col("tall") == 0)))),
    ]
