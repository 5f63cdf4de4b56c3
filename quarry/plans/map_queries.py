"""Joins over spawns, footholds and cameras."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import geometry as g
from quarry.functions import text as t
from quarry.operators import maps as m

from .registry import query
from .views import view

LINE = "CASE WHEN f.x1 = f.x2 THEN greatest(f.y1, f.y2) ELSE round_even(f.y1 + (f.y2 - f.y1)::DOUBLE * (s.x - f.x1) / (f.x2 - f.x1), 0)::INTEGER END"


@query(f"SELECT s.map_id, s.spawn_id, coalesce({LINE}, s.y) AS ground_y, f.foothold_id IS NOT NULL AS matched FROM {{spawns}} s LEFT JOIN {{footholds}} f ON s.map_id = f.map_id AND s.fh = f.foothold_id")
def spawn_ground(spark, sf):
    return m.ground(view(spark, sf, "spawns"), view(spark, sf, "footholds"))


@query("SELECT map_id, spawn_id, mob_id FROM {spawns} WHERE kind = 'm' AND mob_id < 35 AND mob_id IN (SELECT mob_id FROM {boxes} WHERE class_id = 1)")
def live_spawns(spark, sf):
    """Valid spawns: a monster with a small id that has a sheet."""
    sheets = view(spark, sf, "boxes").where("class_id = 1").select("mob_id").distinct()
    return view(spark, sf, "spawns").where("kind = 'm' and mob_id < 35").join(sheets, "mob_id", "left_semi").select("map_id", "spawn_id", "mob_id")


@query(
    """SELECT DISTINCT a.map_id, a.mob_id FROM {spawns} a WHERE EXISTS (SELECT 1 FROM {spawns} b WHERE b.map_id = a.map_id AND b.fh <> a.fh AND abs(a.x - b.x) <= 560 AND abs(a.y - b.y) <= 176)"""
)
def multi_platform_mobs(spark, sf):
    return m.with_neighbours(view(spark, sf, "spawns"), g.WIDTH // 2 - 80, g.HEIGHT - 48)


@query("SELECT a.map_id, a.spawn_id, count(*) AS near FROM {spawns} a JOIN {spawns} b ON a.map_id = b.map_id AND abs(a.x - b.x) <= 350 AND abs(a.y - b.y) <= 70 GROUP BY ALL")
def spawns_near_anchors(spark, sf):
    """Spawns in the box round each spawn, since any of them can be the anchor."""
    s = view(spark, sf, "spawns")
    return m.near_anchors(s, s, 350, 70)


@query(
    """SELECT s.map_id, s.spawn_id, arg_min(f.foothold_id, struct_pack(d := abs((f.x1 + f.x2) // 2 - s.x), i := f.foothold_id)) AS nearest, min(abs((f.x1 + f.x2) // 2 - s.x)) AS distance
    FROM {spawns} s JOIN {footholds} f ON s.map_id = f.map_id GROUP BY ALL"""
)
def nearest_foothold(spark, sf):
    return m.nearest(view(spark, sf, "spawns"), view(spark, sf, "footholds"))


@query("SELECT map_id, min(least(x1, x2)) - 100 AS left_, greatest(min(least(x1, x2)) - 100, max(greatest(x1, x2)) + 100 - 1280) AS right_, min(least(y1, y2)) - 224 AS top_, greatest(min(least(y1, y2)) - 224, max(greatest(y1, y2)) + 100 - 224) AS bottom_ FROM {footholds} GROUP BY map_id")
def camera_bounds(spark, sf):
    return m.camera_bounds(view(spark, sf, "footholds"))


@query("SELECT map_id, x, y FROM {spawns} UNION SELECT map_id, (x1 + x2) // 2, (y1 + y2) // 2 FROM {footholds} WHERE x1 <> x2")
def ground_locations(spark, sf):
    return m.ground_locations(view(spark, sf, "spawns"), view(spark, sf, "footholds"))


@query(
    """WITH l AS (SELECT map_id, x, y FROM {spawns} UNION SELECT map_id, (x1 + x2) // 2, (y1 + y2) // 2 FROM {footholds} WHERE x1 <> x2),
    c AS (SELECT map_id, min(x) AS cx, min(y) - 100 AS cy FROM {spawns} GROUP BY map_id)
    SELECT map_id, count_if(x >= cx + 32 AND x < cx + 1280 - 32 AND y >= cy + 12 AND y <= cy + 224 - 2) AS visible, count(*) AS locations FROM l JOIN c USING (map_id) GROUP BY map_id"""
)
def locations_in_view(spark, sf):
    s = view(spark, sf, "spawns")
    cameras = s.groupBy("map_id").agg(F.min("x").alias("cx"), (F.min("y") - 100).alias("cy"))
    joined = m.ground_locations(s, view(spark, sf, "footholds")).join(cameras, "map_id")
    seen = F.col("x").between(F.col("cx") + 32, F.col("cx") + g.WIDTH - 33) & F.col("y").between(F.col("cy") + 12, F.col("cy") + g.HEIGHT - 2)
    return joined.groupBy("map_id").agg(F.count_if(seen).alias("visible"), F.count("*").alias("locations"))


@query("SELECT mob_id, count(DISTINCT map_id) AS maps, array_to_string(list_sort(list(DISTINCT map_id)), ',') AS map_ids FROM {spawns} WHERE kind = 'm' GROUP BY mob_id")
def maps_of_mobs(spark, sf):
    """Inverted index: mob to maps."""
    return view(spark, sf, "spawns").where("kind = 'm'").groupBy("mob_id").agg(F.array_sort(F.collect_set("map_id")).alias("k")).select("mob_id", F.size("k").cast("long").alias("maps"), F.array_join("k", ",").alias("map_ids"))


@query(
    """WITH r AS (SELECT mob_id, greatest(0, max(abs(x - y * 3))) AS reach FROM {spawns} WHERE kind = 'm' GROUP BY mob_id), n AS (SELECT map_id, count(DISTINCT fh) AS n FROM {spawns} GROUP BY map_id)
    SELECT map_id, count(*) AS feasible FROM (SELECT DISTINCT map_id, mob_id FROM {spawns}) s JOIN r USING (mob_id) JOIN n USING (map_id) WHERE reach >= 400 * (n - 1) + 4 GROUP BY map_id"""
)
def feasible_maps(spark, sf):
    """Maps with mobs that have room to spread n times."""
    s = view(spark, sf, "spawns")
    reach = s.where("kind = 'm'").groupBy("mob_id").agg(F.greatest(F.lit(0), F.max(F.abs(F.col("x") - F.col("y") * 3))).alias("reach"))
    n = s.groupBy("map_id").agg(F.count_distinct("fh").alias("n"))
    joined = s.select("map_id", "mob_id").distinct().join(reach, "mob_id").join(n, "map_id")
    return joined.where(F.col("reach") >= 400 * (F.col("n") - 1) + 4).groupBy("map_id").agg(F.count("*").alias("feasible"))


@query("SELECT map_id, foothold_id, list_sort([y1, y2])[2] AS lower_y, x1 = x2 AS vertical FROM {footholds}")
def foothold_shapes(spark, sf):
    f = view(spark, sf, "footholds")
    return f.select("map_id", "foothold_id", F.greatest("y1", "y2").alias("lower_y"), (F.col("x1") == F.col("x2")).alias("vertical"))


@query("SELECT map_id, list_sort(list(y1))[count(*) // 2 + 1] AS middle_y FROM {footholds} GROUP BY map_id")
def middle_ground(spark, sf):
    """Median by index: element n div 2 of the sorted heights."""
    ys = F.array_sort(F.collect_list("y1"))
    return view(spark, sf, "footholds").groupBy("map_id").agg(F.element_at(ys, (F.count("*") / 2).cast("int") + 1).alias("middle_y"))


@query(
    """SELECT i.image_id, i.split AS image_split, s.split AS map_split FROM {images} i LEFT JOIN (SELECT map_id, min(split) AS split FROM {images} WHERE image_id % 3 <> 0 GROUP BY map_id) s USING (map_id) WHERE s.split IS DISTINCT FROM i.split"""
)
def misplaced_maps(spark, sf):
    """Images whose map belongs to another split, or to none."""
    images = view(spark, sf, "images")
    of = images.where("image_id % 3 <> 0").groupBy("map_id").agg(F.min("split").alias("map_split"))
    joined = images.join(of, "map_id", "left").where(~F.col("split").eqNullSafe(F.col("map_split")))
    return joined.select("image_id", F.col("split").alias("image_split"), "map_split")


@query(
    """SELECT image_id, min(abs(a.x - b.x) + abs(a.y - b.y)) AS gap, a.idx FROM {boxes} a JOIN {boxes} b USING (image_id) WHERE a.class_id = 1 AND b.class_id = 0 GROUP BY ALL
    UNION ALL SELECT image_id, 200, idx FROM {boxes} a WHERE class_id = 1 AND NOT EXISTS (SELECT 1 FROM {boxes} b WHERE b.image_id = a.image_id AND b.class_id = 0)"""
)
def nearest_actor(spark, sf):
    """Least Manhattan distance to a monster of the image, 200 without any."""
    boxes = view(spark, sf, "boxes")
    return m.nearest_actor(boxes.where("class_id = 1"), boxes.where("class_id = 0"))


@query(
    """WITH b AS (SELECT image_id, idx, x - 640 AS base, greatest(1, w) AS step, w FROM {boxes}),
    p AS (SELECT image_id, idx, list_transform(range((floor((-w - base) / step) + 1)::BIGINT, ceil((1280 - base) / step)::BIGINT), lambda i: i * step + base) AS spots FROM b)
    SELECT image_id, idx, len(spots)::INTEGER AS places, list_min(spots)::INTEGER AS first_place, list_max(spots)::INTEGER AS last_place, coalesce(list_sum(spots), 0)::BIGINT AS total FROM p"""
)
def tiled_positions(spark, sf):
    """Where a background sprite without a step of its own is drawn: it repeats by its width. All places of every sprite, as one row a sprite."""
    b = view(spark, sf, "boxes").select("image_id", "idx", g.tile_range(F.col("x") - 640, F.greatest(F.lit(1), "w"), g.WIDTH, F.col("w")).alias("at"))
    total = F.aggregate("at", F.lit(0).cast("long"), lambda t, x: t + x)
    return b.select("image_id", "idx", F.size("at").alias("places"), F.array_min("at").alias("first_place"), F.array_max("at").alias("last_place"), total.alias("total"))


@query(
    """SELECT image_id, idx, x - CASE WHEN class_id = 1 THEN w - h ELSE h END - 100 AS left_, y - 5 - 50 AS top_ FROM {boxes}"""
)
def flipped_boxes(spark, sf):
    b = view(spark, sf, "boxes").select("image_id", "idx", "class_id", F.col("x").alias("world_x"), F.col("y").alias("world_y"), F.col("w").alias("width"), F.col("h").alias("origin_x"), F.lit(5).alias("origin_y"))
    left, top = g.frame_box(F.lit(100), F.lit(50), F.col("class_id") == 1)
    return b.select("image_id", "idx", left.alias("left_"), top.alias("top_"))


KEYS = "(SELECT item, '/Map/Map/Map' || item % 10 || '/' || printf('%09d', item * 7) || '.img' AS map_key, 'Mob/' || printf('%07d', item * 13) || '/stand/0' AS path FROM {items})"


@query(
    f"""SELECT item, regexp_extract(map_key, '/Map/Map/Map[0-9]/([0-9]+)', 1) AS map_id, regexp_extract(map_key, '/Map/Map/Map[0-9]/([0-9]+)', 1)::BIGINT BETWEEN 700 AND 7000 AS in_range,
    substr(md5(path), 7, 2) || substr(md5(path), 5, 2) || substr(md5(path), 3, 2) || substr(md5(path), 1, 2) || substr(md5(path), 11, 2) || substr(md5(path), 9, 2) || substr(md5(path), 15, 2) || substr(md5(path), 13, 2) || substr(md5(path), 17, 16) AS sprite_key,
    regexp_extract(path, 'Mob/([0-9]+)', 1) AS mob, lower(lpad(to_hex(item * 99991), 16, '0')) AS hex FROM {KEYS} k"""
)
def asset_keys(spark, sf):
    """Map ids, ranges and sprite keys read off asset paths."""
    i = view(spark, sf, "items").select("item", F.concat(F.lit("/Map/Map/Map"), F.col("item") % 10, F.lit("/"), F.format_string("%09d", F.col("item") * 7), F.lit(".img")).alias("map_key"),
                                        F.concat(F.lit("Mob/"), F.format_string("%07d", F.col("item") * 13), F.lit("/stand/0")).alias("path"))
    map_id = t.map_id(F.col("map_key"))
    return i.select("item", map_id.alias("map_id"), map_id.cast("long").between(700, 7000).alias("in_range"), t.guid_key(F.col("path")).alias("sprite_key"),
                    F.regexp_extract("path", r"Mob/(\d+)", 1).alias("mob"), t.hex16(F.col("item").cast("long") * 99991).alias("hex"))


@query("SELECT path, key FROM (SELECT grouping || '/' || category || '/' || item AS path, grouping || '/' || category || '/' || item AS key FROM {items}) k WHERE lower(path) LIKE '%/brand#11/%1' ORDER BY length(key), key LIMIT 1")
def asset_lookup(spark, sf):
    """Best key for a suffix: the shortest, then the first in order."""
    path = F.concat_ws("/", "grouping", "category", F.col("item").cast("string"))
    keys = view(spark, sf, "items").select(path.alias("path"), path.alias("key"))
    return m.find_key(keys, "1", "/brand#11/")


@query(
    """WITH f AS (SELECT item, category, CASE WHEN item % 3 = 0 THEN 'info/iconRaw' WHEN item % 3 = 1 THEN 'info/icon' ELSE 'stand/0' END AS path, item % 3 = 0 AS raw, item % 3 = 2 AS digit FROM {items})
    SELECT item, path, raw, digit FROM f WHERE NOT digit QUALIFY raw = bool_or(raw) OVER (PARTITION BY category)"""
)
def icon_candidates(spark, sf):
    """Icons of each category, raw ones where there are any."""
    item = F.col("item") % 3
    rows = view(spark, sf, "items").select("item", F.when(item == 0, "info/iconRaw").when(item == 1, "info/icon").otherwise("stand/0").alias("path"), "category")
    return m.icons(rows, "category").select("item", "path", "raw", "digit")
