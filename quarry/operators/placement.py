"""Placing actors and overlays on the platforms of a map, sample by sample.

A sample's candidates are small (one map's platforms), so each is a group of its own: (sample, seed, mode, n, spacing) meets
its map's points by a join, and the choice inside a group is a numpy loop with the sample's own generator. Groups are
independent, so any number of samples runs in parallel and a rerun gives the same places.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import geometry as g

#: Distance between neighbours as a share of the sprite's width, by mode.
SPACING = {"natural": 0.65, "distributed": 0.65, "clustered": 0.65, "multi_platform": 0.65, "overlap": 0.18}
LOOT_SPREAD, OTHER_SPREAD = {"scattered": 120, "small_piles": 24, "multi_pile": 18, "dense_stack": 10}, 90
PLACED = "sample long, slot int, x int, y int, foothold_id int"


def sample_seed(seed: int, ordinal: Column, form: str = "scattered", mob: Column | None = None) -> Column:
    """A sample's own seed, as a number of the plan it belongs to: "scattered" and its second tries "again" multiply the seed,
    "whole" and "patch" shift it (64 bits, so seeds under 2 ** 31 and 2 ** 23)."""
    if form in ("scattered", "again"):
        return F.lit(seed * (1_000_003 if form == "scattered" else 2_000_003)) + ordinal
    own = ordinal.cast("long")
    if form == "whole":
        return F.lit(seed << 32).cast("long").bitwiseXOR(own)
    if form == "patch" and mob is not None:
        return F.lit(seed << 40).cast("long").bitwiseXOR(own).bitwiseXOR(mob.cast("long"))
    raise ValueError(f"no such form of seed: {form}")


def place_actors(samples: DataFrame, footholds: DataFrame, view: int = g.WIDTH) -> DataFrame:
    """PLACED rows: n actors of a width on the platforms of each sample's map.

    samples: (sample, map_id, seed, mode, n, width). natural and distributed spread over all platforms, clustered and overlap
    stay near one anchor, multi_platform uses two platforms at least where the map has them. Samples whose
    map has no room get fewer rows; count them to reject."""
    flat = footholds.where("x1 <> x2").select("map_id", "foothold_id", F.least("x1", "x2").alias("l"), F.greatest("x1", "x2").alias("r"), "x1", "y1", "x2", "y2")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        s = pdf.iloc[0]
        rng = np.random.default_rng(int(s["seed"]) & (2**63 - 1))
        step = max(1, int(s["width"] * SPACING.get(s["mode"], 0.65)))
        spots = pd.concat([pd.DataFrame({"foothold_id": r.foothold_id, "x": np.arange(r.l, r.r + 1, step)}) for r in pdf.sort_values("foothold_id").itertuples()])
        spots = spots.merge(pdf[["foothold_id", "x1", "y1", "x2", "y2"]], on="foothold_id")
        spots["y"] = np.rint(spots["y1"] + (spots["y2"] - spots["y1"]) * (spots["x"] - spots["x1"]) / (spots["x2"] - spots["x1"])).astype(int)
        anchor = spots.iloc[int(rng.integers(len(spots)))]
        near = spots[(spots["x"] - anchor["x"]).abs() <= (view // 2 - 80 if s["mode"] in ("natural", "distributed", "multi_platform") else 2 * s["width"])]
        order = near.iloc[rng.permutation(len(near))]
        if s["mode"] == "distributed":  # far apart first
            order = order.iloc[np.argsort(-np.abs(order["x"].to_numpy() - near["x"].mean()), kind="stable")]
        if s["mode"] == "multi_platform":
            order = order.assign(k=order.groupby("foothold_id").cumcount()).sort_values("k", kind="stable")
        taken: list[tuple[int, int, int]] = []
        for r in order.itertuples():
            if all(abs(r.x - x) >= step or r.foothold_id != f for x, _, f in taken):
                taken.append((int(r.x), int(r.y), int(r.foothold_id)))
            if len(taken) == s["n"]:
                break
        rows = [(int(s["sample"]), i, x, y, f) for i, (x, y, f) in enumerate(taken)]
        return pd.DataFrame(rows, columns=["sample", "slot", "x", "y", "foothold_id"])

    joined = samples.join(flat, "map_id")
    return joined.groupBy("sample").applyInPandas(one, PLACED)


def place_loot(samples: DataFrame, ground: DataFrame, footholds: DataFrame) -> DataFrame:
    """(sample, slot, x, y, foothold_id): n objects of each sample (sample, map_id, seed, layout, n), no two at one point.

    Each pile has a ground point (map_id, x, y, foothold_id) as its heart; objects go to the piles in turn, at most the layout's spread
    away from the heart, on the heart's platform: not past its ends, at its height. Where a platform has no room
    left the spread grows by one a try and other ground points are taken; a map without room gives fewer rows."""
    lines = footholds.where("x1 <> x2").select("map_id", F.col("foothold_id").alias("f"), "x1", "y1", "x2", "y2")
    points = ground.join(lines, (ground.map_id == lines.map_id) & (ground.foothold_id == lines.f), "left").drop(lines.map_id)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        s = pdf.iloc[0]
        n, layout = int(s["n"]), s["layout"]
        rng = np.random.default_rng(int(s["seed"]) & (2**63 - 1))
        spots = pdf.sort_values(["x", "y", "foothold_id"])[["x", "y", "foothold_id", "x1", "y1", "x2", "y2"]].to_numpy(float)
        piles = {"dense_stack": 1, "small_piles": max(1, round(n / int(rng.integers(2, 6)))), "multi_pile": min(max(2, round(n / 4)), 4)}.get(layout, n)
        hearts, spread = rng.integers(0, len(spots), piles), LOOT_SPREAD.get(layout, OTHER_SPREAD)
        seen: dict[tuple[int, int], int] = {}
        for i in range(n):
            heart = int(hearts[i % piles])
            for attempt in range(50):
                if attempt and attempt % 5 == 0:
                    heart = int(rng.integers(0, len(spots)))
                x, y, foothold, x1, y1, x2, y2 = spots[heart]
                if not np.isnan(x1):
                    reach = spread + attempt
                    x = min(max(x + int(rng.integers(-reach, reach + 1)), min(x1, x2)), max(x1, x2))
                    y = np.rint(y1 + (y2 - y1) * (x - x1) / (x2 - x1))
                if (int(x), int(y)) not in seen:
                    seen[int(x), int(y)] = int(foothold)
                    break
        rows = [(int(s["sample"]), i, x, y, f) for i, ((x, y), f) in enumerate(seen.items())]
        return pd.DataFrame(rows, columns=["sample", "slot", "x", "y", "foothold_id"])

    return samples.where("n > 0").join(points, "map_id").groupBy("sample").applyInPandas(one, PLACED)


def death_overlays(samples: DataFrame, spawns: DataFrame, frames: DataFrame, uses: DataFrame, footholds: DataFrame) -> DataFrame:
    """(sample, slot, mob_id, path, x, y): n frames of death of each sample (sample, map_id, seed, n), each time one of the least used.

    Candidates are the map's monsters (map_id, mob_id, fh, x, y) with their frames (mob_id, path); uses (mob_id, path, n) is what came
    before the sample, and its own picks are added. A monster dies anywhere on its platform, else where it stands."""
    lines = footholds.where("x1 <> x2").select("map_id", F.col("foothold_id").alias("fh"), "x1", "y1", "x2", "y2")
    c = spawns.join(frames, "mob_id").join(uses.withColumnRenamed("n", "used"), ["mob_id", "path"], "left").join(lines, ["map_id", "fh"], "left")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["mob_id", "path", "x", "y"])
        rng = np.random.default_rng(int(pdf["seed"].iloc[0]) & (2**63 - 1))
        kind = pdf.groupby(["mob_id", "path"]).ngroup().to_numpy()
        count = pdf["used"].fillna(0).to_numpy(np.int64)
        rows = []
        for slot in range(int(pdf["n"].iloc[0])):
            pool = np.flatnonzero(count == count.min())
            r = pdf.iloc[int(pool[rng.integers(len(pool))])]
            count[kind == kind[pdf.index.get_loc(r.name)]] += 1
            x, y = int(r["x"]), int(r["y"])
            if not np.isnan(r["x1"]):
                x = int(rng.integers(min(r["x1"], r["x2"]), max(r["x1"], r["x2"]) + 1))
                y = int(np.rint(r["y1"] + (r["y2"] - r["y1"]) * (x - r["x1"]) / (r["x2"] - r["x1"])))
            rows.append((int(r["sample"]), slot, int(r["mob_id"]), r["path"], x, y))
        return pd.DataFrame(rows, columns=["sample", "slot", "mob_id", "path", "x", "y"])

    joined = samples.where("n > 0").join(c, "map_id")
    return joined.groupBy("sample").applyInPandas(lambda pdf: one(pdf.reset_index(drop=True)), "sample long, slot int, mob_id int, path string, x int, y int")


def best_point(points: DataFrame, actors: DataFrame, enough: int = 200) -> DataFrame:
    """(sample, x, y): of each sample's points the one whose nearest actor is farthest away, ties to the smaller point; a point
    without any actor counts as enough away."""
    a = actors.select("sample", F.col("x").alias("ax"), F.col("y").alias("ay"))
    gap = F.min(F.abs(F.col("x") - F.col("ax")) + F.abs(F.col("y") - F.col("ay")))
    far = points.join(a, "sample", "left").groupBy("sample", "x", "y").agg(F.coalesce(gap, F.lit(enough)).alias("gap"))
    best = far.groupBy("sample").agg(F.min(F.struct(-F.col("gap"), "x", "y")).alias("b"))
    return best.select("sample", "b.x", "b.y")


def placement_mode(layout: Column, scene: Column, n: Column, multi: Column) -> Column:
    """How a sample's actors are placed, from its layout, its scene and their number."""
    return (
        F.when(multi, "multi_platform")
        .when(n <= 1, "natural")
        .when(layout.isin("overlap", "severe_overlap"), "overlap")
        .when(layout == "clustered", "clustered")
        .when(scene.contains("dense"), "clustered")
        .otherwise("distributed")
    )


def camera(actors: DataFrame, bounds: DataFrame, seed: int, width: int = g.WIDTH, height: int = g.HEIGHT) -> DataFrame:
    """(sample, camera_x, camera_y): the middle of the actors moved by at most 80 pixels, kept inside the map's bounds.

    actors: (sample, map_id, x, y); bounds from operators.maps.camera_bounds."""
    noise = lambda name, low, high: F.lit(low) + F.pmod(F.xxhash64(F.lit(seed), F.lit(name), "sample"), F.lit(high - low + 1)).cast("int")
    middle = F.element_at(F.array_sort(F.collect_list("y")), F.floor(F.count("*") / 2).cast("int") + 1)
    focus = actors.groupBy("sample", "map_id").agg(F.bround((F.min("x") + F.max("x")) / 2).cast("int").alias("fx"), middle.alias("fy"))
    at = focus.join(bounds, "map_id")
    clamp = lambda v, low, high: F.greatest(low, F.least(high, v))
    return at.select(
        "sample",
        clamp(F.col("fx") - width // 2 + noise("x", -80, 80), F.col("left_"), F.col("right_")).alias("camera_x"),
        clamp(F.col("fy") - noise("y", height * 2 // 3, height - 16), F.col("top_"), F.col("bottom_")).alias("camera_y"),
    )


def accepted_scenes(scenes: DataFrame) -> DataFrame:
    """scenes with reason: the first acceptance test of a scattered scene that fails, or accepted.

    scenes: (placed, wanted, outside, crowded, span, least_clip, least_visible)."""
    tests = [
        ("count", F.col("placed") != F.col("wanted")), ("outside", F.col("outside") > 0), ("crowded", F.col("crowded") > 0),
        ("narrow", (F.col("wanted") > 1) & (F.col("span") < 0.45)), ("clipped", F.col("least_clip") < 0.9999), ("hidden", F.col("least_visible") < 0.98),
    ]
    return scenes.withColumn("reason", F.coalesce(*[F.when(c, F.lit(name)) for name, c in tests], F.lit("accepted")))


def first_accepted(attempts: DataFrame, sample: str = "sample", attempt: str = "attempt") -> DataFrame:
    """Of each sample's attempts the first that was accepted; samples without one are missing and go to the next round."""
    good = attempts.where("reason = 'accepted'")
    best = good.groupBy(sample).agg(F.min(attempt).alias("_first"))
    return good.join(best, sample).where(F.col(attempt) == F.col("_first")).drop("_first")


def overlay_kinds(scene: Column, overlays: Column, loot: Column, death: Column) -> Column:
    """Kinds of overlays of a sample: the ones its scene lists, loot where some is planned, death where the scene is of that
    kind; a scene without a list gets what its name says."""
    named = F.when(scene.contains("pet"), F.array(F.lit("pet"))).when(scene.contains("skill"), F.array(F.lit("skill"), F.lit("damage"))).otherwise(F.array().cast("array<string>"))
    own = F.when(F.size(overlays) > 0, overlays).otherwise(named)
    extra = F.concat(F.when(loot > 0, F.array(F.lit("loot"))).otherwise(F.array().cast("array<string>")), F.when(death, F.array(F.lit("death"))).otherwise(F.array().cast("array<string>")))
    return F.array_sort(F.array_distinct(F.concat(own, extra)))


def place_visual(samples: DataFrame, footholds: DataFrame, taken: DataFrame, gap: int, seed: int, steep: int = 8) -> DataFrame:
    """(sample, x, y, foothold_id): one point for each sample at the left, middle or right of a nearly flat platform of its map
    that keeps a gap from all taken points (sample, x); among those that do, a seeded choice. Samples without one are missing."""
    flat = footholds.where(F.abs(F.col("y1") - F.col("y2")) <= steep).select(
        "map_id", "foothold_id", "y1", F.explode(F.array(F.least("x1", "x2") + 10, F.expr("(x1 + x2) div 2").cast("int"), F.greatest("x1", "x2") - 10)).alias("px")
    )
    c = samples.join(flat, "map_id").select("sample", "foothold_id", F.col("px").alias("x"), F.col("y1").alias("y"))
    t = taken.select(F.col("sample").alias("s"), F.col("x").alias("tx"))
    free = c.join(t, (c["sample"] == t["s"]) & (F.abs(c["x"] - t["tx"]) < gap), "left_anti")
    best = free.groupBy("sample").agg(F.min(F.struct(F.xxhash64(F.lit(seed), "sample", "foothold_id", "x").alias("r"), "x", "y", "foothold_id")).alias("b"))
    return best.select("sample", "b.x", "b.y", "b.foothold_id")


def thinned(spawns: DataFrame, step_x: int = 40, step_y: int = 30) -> DataFrame:
    """Spawns of each map such that no two are nearer than both steps; earlier spawns win. One map is one small group."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("spawn_id")
        kept: list[int] = []
        xs, ys = pdf["x"].to_numpy(), pdf["y"].to_numpy()
        for i in range(len(pdf)):
            if not kept or not ((np.abs(xs[kept] - xs[i]) < step_x) & (np.abs(ys[kept] - ys[i]) < step_y)).any():
                kept.append(i)
        return pdf.iloc[kept]

    rows = spawns.select("map_id", "spawn_id", "x", "y")
    return rows.groupBy("map_id").applyInPandas(one, rows.schema)


def edge_camera(actors: DataFrame, cameras: DataFrame, bounds: DataFrame, seed: int, width: int = g.WIDTH, height: int = g.HEIGHT) -> DataFrame:
    """(sample, camera_x, camera_y) that cuts 10 to 70 percent of an outermost actor, on a side that a hash picks (left and right
    twice as often as top and bottom). actors: (sample, map_id, slot, x, y, w, h), x and y the top left corner in the world."""
    unit = lambda name: F.pmod(F.xxhash64(F.lit(seed), F.lit(name), "sample"), F.lit(1_000_000)) / 1_000_000
    side = F.element_at(F.array(*map(F.lit, ["left", "right", "left", "right", "top", "bottom"])), F.floor(unit("side") * 6).cast("int") + 1)
    box = F.struct("slot", "x", "y", "w", "h")
    outer = actors.groupBy("sample", "map_id").agg(
        F.min_by(box, F.struct("x", "slot")).alias("l"), F.max_by(box, F.struct(F.col("x") + F.col("w"), "slot")).alias("r"),
        F.min_by(box, F.struct("y", "slot")).alias("t"), F.max_by(box, F.struct(F.col("y") + F.col("h"), "slot")).alias("b"),
    )
    rows = outer.withColumns({"side": side, "cut": 0.1 + 0.6 * unit("cut")}).join(cameras, "sample").join(bounds, "map_id")
    gone = lambda c, size: F.bround(F.col(f"{c}.{size}") * F.col("cut")).cast("int")
    x = F.when(F.col("side") == "left", F.col("l.x") + gone("l", "w")).when(F.col("side") == "right", F.col("r.x") + F.col("r.w") - gone("r", "w") - width).otherwise(F.col("camera_x"))
    y = F.when(F.col("side") == "top", F.col("t.y") + gone("t", "h")).when(F.col("side") == "bottom", F.col("b.y") + F.col("b.h") - gone("b", "h") - height).otherwise(F.col("camera_y"))
    clamp = lambda v, low, high: F.greatest(F.col(low), F.least(F.col(high), v))
    return rows.select("sample", clamp(x, "left_", "right_").alias("camera_x"), clamp(y, "top_", "bottom_").alias("camera_y"), "side")
