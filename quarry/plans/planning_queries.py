"""Schedules, seeds, placement and cameras: plans are compared with the quotas they were made from, places with what they promise."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions import geometry as g
from quarry.operators import maps as m
from quarry.operators import placement as pl
from quarry.operators import schedule as sc
from quarry.operators import splits

from .registry import query
from .views import view

#: What a plan is asked for, counted from the images: each has its boxes, its scene with players or without, and loot in negative ones.
ASKED = """a AS (SELECT split, image_id % 6 AS boxes, CASE WHEN image_id % 6 = 0 THEN 'negative_loot' WHEN image_id % 4 = 1 THEN 'monster_player' ELSE 'monster' END AS scene,
  CASE WHEN image_id % 6 > 0 AND image_id % 4 = 1 THEN 1 + image_id % 3 % 2 ELSE 0 END AS players, CASE WHEN image_id % 6 = 0 THEN 1 + image_id % 7 ELSE 0 END AS loot FROM {images})"""


def asked(spark, sf):
    i = F.col("image_id")
    scene = F.when(i % 6 == 0, "negative_loot").when(i % 4 == 1, "monster_player").otherwise("monster")
    with_player = (i % 6 > 0) & (i % 4 == 1)
    return view(spark, sf, "images").select(
        "split", (i % 6).alias("boxes"), scene.alias("scene"), F.when(with_player, 1 + i % 3 % 2).otherwise(0).alias("players"), F.when(i % 6 == 0, 1 + i % 7).otherwise(0).alias("loot")
    )


def config(spark, sf) -> dict:
    """A configuration whose quotas are the histograms of asked(): a few keys each."""
    rows = asked(spark, sf)
    count = lambda c: {r[0]: r[1] for r in rows.groupBy(c).count().orderBy(c).collect()}
    scene, loot = count("scene"), count("loot")
    loot.pop(0, None)
    specs = {
        "negative_loot": {"positive": False, "max_players": 0, "min_loot": 1, "max_loot": 7},
        "monster": {"positive": True, "max_players": 0, "min_instances": 1, "max_instances": 5},
        "monster_player": {"positive": True, "min_players": 1, "max_players": 2, "min_instances": 1, "max_instances": 5},
    }
    return {
        "seed": 7, "splits": count("split"), "box_quotas": count("boxes"), "player_quotas": count("players"), "loot_count_quotas": loot, "loot_layout_quotas": {"scattered": 3, "dense_stack": 1},
        "multi_platform_fraction": 0.5, "target_layout_weights": {"1-3": {"distributed": 1.0}, "4-5": {"clustered": 1.0}}, "scenarios": {k: v | {"count": scene[k]} for k, v in specs.items() if k in scene},
    }


@query(
    f"""WITH {ASKED} SELECT 'split' AS dim, split AS key, count(*) AS n FROM a GROUP BY split UNION ALL SELECT 'boxes', boxes::VARCHAR, count(*) FROM a GROUP BY boxes UNION ALL SELECT 'scene', scene, count(*) FROM a GROUP BY scene
    UNION ALL SELECT 'players', players::VARCHAR, count(*) FROM a GROUP BY players UNION ALL SELECT 'loot', loot::VARCHAR, count(*) FROM a GROUP BY loot
    UNION ALL SELECT 'misplaced', '0', 0::BIGINT UNION ALL SELECT 'indexes', 'distinct', count(*) FROM a"""
)
def planned_quotas(spark, sf):
    """Histograms of a whole plan, rows that break their scene's ranges, and distinct places in a split."""
    rows = sc.schedule(spark, config(spark, sf))
    dims = [("split", "split"), ("boxes", "target_count"), ("scene", "scenario"), ("players", "player_count"), ("loot", "loot_count")]
    scene = F.col("scenario")
    wrong = ((scene == "negative_loot") != (F.col("target_count") == 0)) | ((scene == "monster_player") != (F.col("player_count") > 0)) | ((scene == "negative_loot") != (F.col("loot_count") > 0))
    wrong |= (F.col("loot_layout") == "none") != (F.col("loot_count") == 0)
    wrong |= F.col("target_layout") != F.when(F.col("target_count") == 0, "none").when((F.col("target_count") == 1) | (F.col("target_count") <= 3), "distributed").otherwise("clustered")
    # one pass for all histograms: rows of equal values are counted first
    alike = rows.withColumn("wrong", wrong).groupBy("wrong", *[c for _, c in dims]).agg(F.count("*").alias("n"))
    pairs = [F.struct(F.lit(d).alias("dim"), F.col(c).cast("string").alias("key"), F.col("n").alias("n")) for d, c in dims]
    pairs.append(F.struct(F.lit("misplaced").alias("dim"), F.lit("0").alias("key"), F.when(F.col("wrong"), F.col("n")).otherwise(0).alias("n")))
    each = alike.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").unionByName(spark.createDataFrame([("misplaced", "0", 0)], "dim string, key string, n long"))
    indexes = rows.agg(F.count_distinct("split", "split_index").alias("n")).select(F.lit("indexes").alias("dim"), F.lit("distinct").alias("key"), "n")
    return each.groupBy("dim", "key").agg(F.sum("n").alias("n")).unionByName(indexes)


@query(
    f"""WITH {ASKED}, t AS (SELECT boxes AS key, count(*) AS n FROM a GROUP BY boxes), s AS (SELECT key, n * 60 // sum(n) OVER () AS low, n * 60 % sum(n) OVER () AS rest FROM t)
    SELECT key::VARCHAR AS key, (low + CASE WHEN row_number() OVER (ORDER BY rest DESC, key::VARCHAR DESC) <= 60 - sum(low) OVER () THEN 1 ELSE 0 END)::BIGINT AS n FROM s"""
)
def limited_plan(spark, sf):
    """A plan cut down to sixty rows keeps the shares of its box counts."""
    rows = sc.schedule(spark, config(spark, sf), 60)
    return rows.groupBy(F.col("target_count").cast("string").alias("key")).agg(F.count("*").alias("n"))


@query(
    """SELECT image_id, 7 * 1000003 + image_id AS scattered, 7 * 2000003 + image_id AS again, xor(7::BIGINT << 32, image_id::BIGINT) AS whole, xor(xor(7::BIGINT << 40, image_id::BIGINT), map_id::BIGINT) AS patch FROM {images}"""
)
def sample_seeds(spark, sf):
    """The seeds of a sample in all its forms."""
    i = F.col("image_id")
    return view(spark, sf, "images").select(
        "image_id", pl.sample_seed(7, i).alias("scattered"), pl.sample_seed(7, i, "again").alias("again"), pl.sample_seed(7, i, "whole").alias("whole"), pl.sample_seed(7, i, "patch", F.col("map_id")).alias("patch")
    )


MODE = """CASE WHEN multi_platform THEN 'multi_platform' WHEN n <= 1 THEN 'natural' WHEN layout IN ('overlap', 'severe_overlap') THEN 'overlap' WHEN layout = 'clustered' THEN 'clustered' WHEN contains(scenario, 'dense') THEN 'clustered' ELSE 'distributed' END"""


@query(f"SELECT image_id, {MODE} AS mode FROM (SELECT *, image_id % 5 AS n FROM {{images}}) q")
def placement_modes(spark, sf):
    rows = view(spark, sf, "images")
    mode = pl.placement_mode(F.col("layout"), F.col("scenario"), F.col("image_id") % 5, F.col("multi_platform"))
    return rows.select("image_id", mode.alias("mode"))


@query(
    """SELECT image_id, array_to_string(list_sort(list_distinct(list_concat(list_concat(CASE WHEN image_id % 4 = 0 THEN ['player', 'pet'] WHEN contains(scenario, 'pet') THEN ['pet'] WHEN contains(scenario, 'skill') THEN ['skill', 'damage'] ELSE []::VARCHAR[] END,
    CASE WHEN image_id % 3 > 0 THEN ['loot'] ELSE []::VARCHAR[] END), CASE WHEN image_id % 5 = 0 THEN ['death'] ELSE []::VARCHAR[] END))), ',') AS kinds FROM {images}"""
)
def overlay_kinds(spark, sf):
    i = F.col("image_id")
    listed = F.when(i % 4 == 0, F.array(F.lit("player"), F.lit("pet"))).otherwise(F.array().cast("array<string>"))
    kinds = pl.overlay_kinds(F.col("scenario"), listed, i % 3, i % 5 == 0)
    return view(spark, sf, "images").select("image_id", F.array_join(kinds, ",").alias("kinds"))


def samples(spark, sf, *more):
    """A sample for each map and each of five turns."""
    s = view(spark, sf, "spawns").select("map_id").distinct()
    turns = s.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(4)))).withColumn("sample", (F.col("map_id") * 5 + F.col("turn")).cast("long"))
    return turns.select("sample", "map_id", "turn", pl.sample_seed(7, F.col("sample")).alias("seed"), *more)


EACH = "s AS (SELECT (map_id * 5 + turn)::BIGINT AS sample, map_id, turn FROM (SELECT DISTINCT map_id FROM {spawns}) q, (SELECT unnest(range(5)) AS turn) t)"
HAVE_LINES = "(SELECT DISTINCT map_id FROM {footholds} WHERE x1 <> x2)"


def on_line(x: str = "x", y: str = "y"):
    """Whether a place is on its platform: not past its ends, at its height."""
    line = F.rint(F.col("y1") + (F.col("y2") - F.col("y1")) * (F.col(x) - F.col("x1")) / (F.col("x2") - F.col("x1")))
    return F.col(x).between(F.least("x1", "x2"), F.greatest("x1", "x2")) & (F.col(y) == line)


@query(f"WITH {EACH} SELECT sample, TRUE AS placed, TRUE AS on_platforms, TRUE AS apart FROM s WHERE map_id IN {HAVE_LINES}")
def placed_actors(spark, sf):
    """Actors in five ways of placing: one at least, none too many, all on platforms, and apart on each by their step."""
    mode = F.element_at(F.array(*map(F.lit, ["natural", "distributed", "clustered", "overlap", "multi_platform"])), F.col("turn") + 1)
    own = samples(spark, sf, mode.alias("mode"), (2 + F.col("turn")).cast("int").alias("n"), F.lit(40).alias("width"))
    lines = view(spark, sf, "footholds")
    rows = pl.place_actors(own, lines).join(own.select("sample", "map_id", "mode", "n"), "sample").join(lines, ["map_id", "foothold_id"])
    step = F.when(F.col("mode") == "overlap", 7).otherwise(26)
    gap = F.col("x") - F.lag("x").over(Window.partitionBy("sample", "foothold_id").orderBy("x"))  # an image's actors are few
    rows = rows.withColumn("apart", F.coalesce(gap >= step, F.lit(True)))
    return rows.groupBy("sample").agg((F.count("*").between(1, F.first("n"))).alias("placed"), F.bool_and(on_line()).alias("on_platforms"), F.bool_and("apart").alias("apart"))


@query(f"WITH {EACH} SELECT sample, (3 + turn * 4)::INTEGER AS objects, TRUE AS on_platforms FROM s WHERE turn < 4 AND map_id IN {HAVE_LINES}")
def placed_loot(spark, sf):
    """Loot in four layouts: as many points as asked for, no two the same, all on platforms."""
    layout = F.element_at(F.array(*map(F.lit, ["scattered", "small_piles", "multi_pile", "dense_stack", "none"])), F.col("turn") + 1)
    own = samples(spark, sf, layout.alias("layout"), F.when(F.col("turn") < 4, 3 + F.col("turn") * 4).otherwise(0).cast("int").alias("n"))
    lines = view(spark, sf, "footholds").where("x1 <> x2")
    ground = lines.select("map_id", F.expr("(x1 + x2) div 2").cast("int").alias("x"), F.col("y1").alias("y"), "foothold_id")
    rows = pl.place_loot(own, ground, lines).join(own.select("sample", "map_id"), "sample").join(lines, ["map_id", "foothold_id"])
    return rows.groupBy("sample").agg(F.count_distinct("x", "y").cast("int").alias("objects"), F.bool_and(on_line()).alias("on_platforms"))


@query(f"WITH {EACH} SELECT sample, (2 + 3 * turn)::INTEGER AS picks, TRUE AS even FROM s WHERE map_id IN (SELECT map_id FROM {{spawns}} WHERE kind = 'm')")
def death_picks(spark, sf):
    """Frames of death: as many as asked for, each time one of the least used, so that uses stay within one of each other."""
    own = samples(spark, sf, (2 + 3 * F.col("turn")).cast("int").alias("n"))
    s = view(spark, sf, "spawns").where("kind = 'm'").select("map_id", "mob_id", "fh", "x", "y")
    frames = s.select("mob_id").distinct().withColumn("path", F.explode(F.array(F.lit("die1/0"), F.lit("die1/1"))))
    uses = frames.limit(0).withColumn("n", F.lit(0))
    rows = pl.death_overlays(own, s, frames, uses, view(spark, sf, "footholds"))
    counts = rows.groupBy("sample", "mob_id", "path").agg(F.count("*").alias("k"))
    kinds = s.select("map_id", "mob_id").distinct().join(frames, "mob_id").groupBy("map_id").agg(F.count("*").alias("kinds")).join(own.select("sample", "map_id"), "map_id")
    per = counts.groupBy("sample").agg(F.sum("k").cast("int").alias("picks"), F.max("k").alias("most"), F.min("k").alias("least"), F.count("*").alias("used")).join(kinds, "sample")
    return per.select("sample", "picks", (F.when(F.col("used") < F.col("kinds"), F.col("most") == 1).otherwise(F.col("most") - F.col("least") <= 1)).alias("even"))


BOUNDS = "b AS (SELECT map_id, min(least(x1, x2)) - 100 AS l, greatest(min(least(x1, x2)) - 100, max(greatest(x1, x2)) + 100 - 1280) AS r, min(least(y1, y2)) - 224 AS t, greatest(min(least(y1, y2)) - 224, max(greatest(y1, y2)) + 100 - 224) AS d FROM {footholds} GROUP BY map_id)"


@query(f"WITH {EACH}, {BOUNDS} SELECT sample, TRUE AS inside, TRUE AS near FROM s JOIN b USING (map_id)")
def sample_cameras(spark, sf):
    """Cameras stay inside the map's bounds and, where these allow, within eighty pixels of the actors' middle."""
    own = samples(spark, sf)
    actors = own.join(view(spark, sf, "spawns").select("map_id", "x", "y"), "map_id").select("sample", "map_id", "x", "y")
    bounds = m.camera_bounds(view(spark, sf, "footholds"))
    middle = actors.groupBy("sample", "map_id").agg(F.bround((F.min("x") + F.max("x")) / 2).alias("mid"))
    rows = pl.camera(actors, bounds, 7).join(middle, "sample").join(bounds, "map_id")
    inside = F.col("camera_x").between(F.col("left_"), F.col("right_")) & F.col("camera_y").between(F.col("top_"), F.col("bottom_"))
    apart = F.abs(F.col("camera_x") + g.WIDTH // 2 - F.col("mid"))
    return rows.select("sample", inside.alias("inside"), ((apart <= 80) | F.col("camera_x").isin(F.col("left_"), F.col("right_"))).alias("near"))


@query(f"WITH {EACH}, {BOUNDS} SELECT sample, TRUE AS inside, TRUE AS cut FROM s JOIN b USING (map_id)")
def edge_cameras(spark, sf):
    """Cameras that cut an outermost actor, on the side they name, unless the map's bounds forbid it."""
    own = samples(spark, sf)
    spawns = view(spark, sf, "spawns")
    actors = own.join(spawns, "map_id").select("sample", "map_id", F.col("spawn_id").alias("slot"), "x", "y", F.lit(60).alias("w"), F.lit(50).alias("h"))
    bounds = m.camera_bounds(view(spark, sf, "footholds"))
    cameras = pl.camera(actors, bounds, 7)
    outer = actors.groupBy("sample", "map_id").agg(F.min("x").alias("l"), F.max(F.col("x") + F.col("w")).alias("r"), F.min("y").alias("t"), F.max(F.col("y") + F.col("h")).alias("b"))
    rows = pl.edge_camera(actors, cameras, bounds, 7).join(outer, "sample").join(bounds, "map_id")
    cx, cy = F.col("camera_x"), F.col("camera_y")
    gone = (
        F.when(F.col("side") == "left", (cx - F.col("l")) / 60).when(F.col("side") == "right", (F.col("r") - cx - g.WIDTH) / 60)
        .when(F.col("side") == "top", (cy - F.col("t")) / 50).otherwise((F.col("b") - cy - g.HEIGHT) / 50)
    )
    held = F.when(F.col("side").isin("left", "right"), cx.isin(F.col("left_"), F.col("right_"))).otherwise(cy.isin(F.col("top_"), F.col("bottom_")))
    inside = cx.between(F.col("left_"), F.col("right_")) & cy.between(F.col("top_"), F.col("bottom_"))
    return rows.select("sample", inside.alias("inside"), (gone.between(0.08, 0.72) | held).alias("cut"))


@query(
    f"""WITH {EACH}, p AS (SELECT map_id, foothold_id, unnest([least(x1, x2) + 10, (x1 + x2) // 2, greatest(x1, x2) - 10]) AS x FROM {{footholds}} WHERE abs(y1 - y2) <= 8),
    t AS (SELECT sample, map_id, turn * 600 AS tx FROM s), f AS (SELECT DISTINCT t.sample FROM t JOIN p ON t.map_id = p.map_id WHERE abs(p.x - t.tx) >= 200) SELECT sample, TRUE AS free FROM f"""
)
def placed_visuals(spark, sf):
    """One point for each sample on a nearly flat platform that keeps its distance from what is taken."""
    own = samples(spark, sf)
    taken = own.select("sample", (F.col("turn") * 600).alias("x"))
    rows = pl.place_visual(own.select("sample", "map_id"), view(spark, sf, "footholds"), taken, 200, 7)
    return rows.join(taken.withColumnRenamed("x", "tx"), "sample").select("sample", (F.abs(F.col("x") - F.col("tx")) >= 200).alias("free"))


@query("SELECT map_id, TRUE AS apart, TRUE AS whole FROM (SELECT DISTINCT map_id FROM {spawns}) q")
def thinned_spawns(spark, sf):
    """Of the kept spawns no two are near, and near each one left out is a kept one that came before."""
    s = view(spark, sf, "spawns").select("map_id", "spawn_id", "x", "y")
    kept = pl.thinned(s).withColumn("kept", F.lit(True))
    a, b = s.join(kept.select("map_id", "spawn_id", "kept"), ["map_id", "spawn_id"], "left").alias("a"), kept.withColumn("cell", F.explode(m.cells(F.col("x"), 40))).alias("b")
    near = (F.col("a.map_id") == F.col("b.map_id")) & (F.floor(F.col("a.x") / 40) == F.col("b.cell")) & (F.col("b.spawn_id") < F.col("a.spawn_id"))
    near &= (F.abs(F.col("a.x") - F.col("b.x")) < 40) & (F.abs(F.col("a.y") - F.col("b.y")) < 30)
    rows = a.join(b, near, "left").groupBy("a.map_id", "a.spawn_id").agg(F.max("a.kept").isNotNull().alias("kept"), F.max(F.col("b.spawn_id").isNotNull()).alias("met"))
    return rows.groupBy("map_id").agg(F.bool_and(~(F.col("kept") & F.col("met"))).alias("apart"), F.bool_and(F.col("kept") | F.col("met")).alias("whole"))


@query(
    f"""WITH {EACH}, p AS (SELECT sample, x, y, min(abs(x - ax) + abs(y - ay)) AS gap FROM (SELECT s.sample, f.x1 AS x, f.y1 AS y, a.x AS ax, a.y AS ay FROM s JOIN {{footholds}} f ON s.map_id = f.map_id JOIN {{spawns}} a ON a.map_id = s.map_id AND a.spawn_id % 5 = s.turn) q GROUP BY ALL)
    SELECT sample, arg_min(x, struct_pack(g := -gap, x := x, y := y)) AS x, arg_min(y, struct_pack(g := -gap, x := x, y := y)) AS y FROM p GROUP BY sample"""
)
def player_points(spark, sf):
    """The point of a map that is farthest from its nearest actor."""
    own = samples(spark, sf)
    points = own.join(view(spark, sf, "footholds"), "map_id").select("sample", F.col("x1").alias("x"), F.col("y1").alias("y"))
    actors = own.join(view(spark, sf, "spawns"), "map_id").where("spawn_id % 5 = turn").select("sample", "x", "y")
    met = points.join(actors.select("sample").distinct(), "sample", "left_semi")
    return pl.best_point(met, actors)


@query(
    """WITH n AS (SELECT count(DISTINCT map_id) AS n FROM {spawns}), k AS (SELECT n, greatest(1, round_even(n * 0.1, 0))::BIGINT AS side FROM n)
    SELECT 'test' AS split, side AS maps FROM k UNION ALL SELECT 'val', side FROM k UNION ALL SELECT 'train', n - 2 * side FROM k"""
)
def legacy_map_split(spark, sf):
    """Sizes of the split that one ordered generator draws."""
    ids = [str(r.map_id) for r in view(spark, sf, "spawns").select("map_id").distinct().limit(splits.MOST).collect()]
    rows = spark.createDataFrame(list(splits.legacy_split(ids, 7).items()), "map_id string, split string")
    return rows.groupBy("split").agg(F.count("*").alias("maps"))


@query(
    """SELECT image_id, idx, greatest(0, least(x + 200, 1280 - w)) AS kept_x, round_even(x + 640 + (y * 7 + 640) * ((idx * 37) % 200 - 100)::DOUBLE / 100 - h, 0)::INTEGER AS drawn_x FROM {boxes}"""
)
def sprite_corners(spark, sf):
    """Frames moved into the viewport, and background sprites that follow the camera by a rate."""
    b = view(spark, sf, "boxes")
    rate = ((F.col("idx") * 37) % 200 - 100).cast("double")
    return b.select("image_id", "idx", g.clamped(F.col("x") + 200, F.col("w")).alias("kept_x"), g.parallax_base(F.col("x"), F.col("y") * 7, rate, g.WIDTH, F.col("h")).alias("drawn_x"))


@query(
    """SELECT image_id, CASE WHEN image_id % 11 = 0 THEN 'count' WHEN image_id % 13 = 0 THEN 'outside' WHEN image_id % 17 = 0 THEN 'crowded' WHEN image_id % 3 + 1 > 1 AND (image_id % 10) / 10.0 < 0.45 THEN 'narrow'
    WHEN image_id % 19 = 0 THEN 'clipped' WHEN image_id % 23 = 0 THEN 'hidden' ELSE 'accepted' END AS reason FROM {images}"""
)
def scattered_verdicts(spark, sf):
    """The tests of a scattered scene in their order."""
    i = F.col("image_id")
    rows = view(spark, sf, "images").select(
        "image_id", (i % 3 + 1 + (i % 11 == 0).cast("int")).alias("placed"), (i % 3 + 1).alias("wanted"), (i % 13 == 0).cast("int").alias("outside"), (i % 17 == 0).cast("int").alias("crowded"),
        ((i % 10) / 10).alias("span"), F.when(i % 19 == 0, 0.9).otherwise(1.0).alias("least_clip"), F.when(i % 23 == 0, 0.5).otherwise(1.0).alias("least_visible"),
    )
    return pl.accepted_scenes(rows).select("image_id", "reason")
