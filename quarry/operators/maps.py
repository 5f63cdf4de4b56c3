"""Operators over maps: grounds, neighbours, cameras, lookups of assets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import geometry as g


def ground(spawns: DataFrame, footholds: DataFrame) -> DataFrame:
    """Each spawn's ground height: on its foothold where there is one, else its own."""
    f = footholds.withColumnRenamed("foothold_id", "fh").select("map_id", "fh", "x1", "y1", "x2", "y2", F.lit(True).alias("hit"))
    joined = spawns.join(f, ["map_id", "fh"], "left")
    return joined.select("map_id", "spawn_id", F.coalesce(g.platform_y(F.col("x")), F.col("y")).alias("ground_y"), F.coalesce("hit", F.lit(False)).alias("matched"))


def cells(x, reach: int):
    """The cells, each reach wide, that a point within reach of x can lie in: an equi-join key that cuts a map's spawns into strips."""
    at = F.floor(x / reach)
    return F.array(at - 1, at, at + 1)


def with_neighbours(spawns: DataFrame, reach_x: int, reach_y: int) -> DataFrame:
    """(map_id, mob_id) with another spawn on another foothold within reach: a semi-join inside the map."""
    a = spawns.withColumn("cell", F.floor(F.col("x") / reach_x)).alias("a")
    b = spawns.select("map_id", "fh", "x", "y", F.explode(cells(F.col("x"), reach_x)).alias("cell")).alias("b")
    near = (
        (F.col("a.map_id") == F.col("b.map_id")) & (F.col("a.cell") == F.col("b.cell")) & (F.col("a.fh") != F.col("b.fh"))
        & (F.abs(F.col("a.x") - F.col("b.x")) <= reach_x) & (F.abs(F.col("a.y") - F.col("b.y")) <= reach_y)
    )
    return a.join(b, near, "left_semi").select("map_id", "mob_id").distinct()


def near_anchors(anchors: DataFrame, spawns: DataFrame, reach_x: int, reach_y: int) -> DataFrame:
    """Number of spawns in a box round each anchor."""
    a = anchors.select("map_id", "spawn_id", "x", "y", F.explode(cells(F.col("x"), reach_x)).alias("cell")).alias("a")
    b = spawns.select("map_id", "x", "y", F.floor(F.col("x") / reach_x).alias("cell")).alias("b")
    near = (F.col("a.map_id") == F.col("b.map_id")) & (F.col("a.cell") == F.col("b.cell")) & (F.abs(F.col("a.x") - F.col("b.x")) <= reach_x) & (F.abs(F.col("a.y") - F.col("b.y")) <= reach_y)
    return a.join(b, near).groupBy(F.col("a.map_id").alias("map_id"), F.col("a.spawn_id").alias("spawn_id")).agg(F.count("*").alias("near"))


def nearest(spawns: DataFrame, footholds: DataFrame) -> DataFrame:
    """The foothold of the map whose middle is nearest in x, ties to the smaller id."""
    f = footholds.select("map_id", "foothold_id", F.expr("(x1 + x2) div 2").alias("mid"))
    joined = spawns.select("map_id", "spawn_id", "x").join(f, "map_id").withColumn("distance", F.abs(F.col("mid") - F.col("x")))
    best = joined.groupBy("map_id", "spawn_id").agg(F.min(F.struct("distance", "foothold_id")).alias("b"))
    return best.select("map_id", "spawn_id", F.col("b.foothold_id").alias("nearest"), F.col("b.distance").alias("distance"))


def camera_bounds(footholds: DataFrame, width: int = g.WIDTH, height: int = g.HEIGHT) -> DataFrame:
    """(map_id, left_, right_, top_, bottom_): where a camera may stand so that the platforms stay in view."""
    b = footholds.groupBy("map_id").agg(
        (F.min(F.least("x1", "x2")) - 100).alias("left_"), (F.max(F.greatest("x1", "x2")) + 100).alias("r"),
        (F.min(F.least("y1", "y2")) - height).alias("top_"), (F.max(F.greatest("y1", "y2")) + 100).alias("b"),
    )
    return b.select("map_id", "left_", F.greatest("left_", F.col("r") - width).alias("right_"), "top_", F.greatest("top_", F.col("b") - height).alias("bottom_"))


def ground_locations(spawns: DataFrame, footholds: DataFrame) -> DataFrame:
    """Distinct points to stand on: spawns and the middles of platforms that are not vertical."""
    middles = footholds.where("x1 <> x2").select("map_id", F.expr("(x1 + x2) div 2").cast("int").alias("x"), F.expr("(y1 + y2) div 2").cast("int").alias("y"))
    return spawns.select("map_id", "x", "y").unionByName(middles).distinct()


def nearest_actor(points: DataFrame, actors: DataFrame, default: int = 200) -> DataFrame:
    """Least Manhattan distance from each point to an actor of its image."""
    a, b = points.alias("a"), actors.alias("b")
    gap = F.abs(F.col("a.x") - F.col("b.x")) + F.abs(F.col("a.y") - F.col("b.y"))
    joined = a.join(b, F.col("a.image_id") == F.col("b.image_id"), "left")
    return joined.groupBy(F.col("a.image_id").alias("image_id"), F.col("a.idx").alias("idx")).agg(F.coalesce(F.min(gap), F.lit(default)).alias("gap"))


def find_key(keys: DataFrame, suffix: str, contains: str = "") -> DataFrame:
    """The key whose path ends with the suffix and contains the other text, whatever the case: shortest first, then in order."""
    low = F.lower("path")
    hit = low.endswith(suffix.lower()) & low.contains(contains.lower())
    return keys.where(hit).orderBy(F.length("key"), "key").limit(1)


def icons(frames: DataFrame, group: str) -> DataFrame:
    """Icon frames of each group, only the raw ones where a group has any; numbered frames are no icons."""
    tail = F.lower(F.element_at(F.split("path", "/"), -1))
    rows = frames.withColumns({"raw": tail == "iconraw", "digit": tail.rlike(r"^\d+$")}).where(~F.col("digit"))
    return rows.withColumn("_any", F.max("raw").over(Window.partitionBy(group))).where(F.col("raw") == F.col("_any")).drop("_any")
