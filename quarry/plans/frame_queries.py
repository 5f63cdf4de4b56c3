"""Queries over sprite paths, limits and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import coverage as c
from quarry.operators import frames as f
from quarry.operators import report

from .registry import query
from .views import view

#: Paths made of a part's numbers: every kind occurs.
FRAMES = """f AS (SELECT item, category AS asset, CASE item % 8 WHEN 0 THEN 'stand/' || item % 5 WHEN 1 THEN 'move/' || item % 3 WHEN 2 THEN 'die1/0' WHEN 3 THEN 'info/icon' WHEN 4 THEN 'Attack1/info/hit/0'
  WHEN 5 THEN 'effect/' || item % 7 WHEN 6 THEN 'skill1/death/0' ELSE 'jump/0' END AS path, width, height, width * height AS area FROM {items})"""


def frames(spark, sf):
    item = F.col("item")
    text = lambda head, n: F.concat(F.lit(head), (item % n).cast("string"))
    kinds = [text("stand/", 5), text("move/", 3), F.lit("die1/0"), F.lit("info/icon"), F.lit("Attack1/info/hit/0"), text("effect/", 7), F.lit("skill1/death/0"), F.lit("jump/0")]
    path = F.element_at(F.array(*kinds), item % 8 + 1)
    return view(spark, sf, "items").select("item", F.col("category").alias("asset"), path.alias("path"), "width", "height", (F.col("width") * F.col("height")).alias("area"))


@query(
    f"""WITH {FRAMES} SELECT item, regexp_matches(path, '(?i)^(stand|move|hit|attack|skill|jump|fly)') AND NOT regexp_matches(path, '(?i)(die|dead|death)') AS live, regexp_matches(path, '(?i)(die|dead|death)') AS dead,
    regexp_matches(path, '(?i)^(stand|move|jump|fly)') AND saturated > 5 AS pet, regexp_matches(path, '(?i)(^|/)(effect|hit|ball|screen)') AND NOT regexp_matches(path, '(?i)icon') AND width BETWEEN 8 AND 500 AND height BETWEEN 8 AND 300 AS skill,
    regexp_matches(path, '(?i)(^|/)(iconraw|icon|0)$') AS loot, CASE WHEN height <= 40 THEN 'small' WHEN height >= 120 THEN 'large' ELSE 'medium' END AS size FROM (SELECT *, item % 100 AS saturated FROM f) q"""
)
def frame_kinds(spark, sf):
    p = F.col("path")
    return frames(spark, sf).select(
        "item", f.is_live(p).alias("live"), f.is_dead(p).alias("dead"), f.is_pet(p, F.col("item") % 100 - 5).alias("pet"), f.is_skill(p, F.col("width"), F.col("height")).alias("skill"),
        f.is_loot(p).alias("loot"), f.size_class(F.col("height")).alias("size"),
    )


@query(
    f"""WITH {FRAMES}, r AS (SELECT asset, item, path, CASE WHEN path = 'die1/0' THEN 0 WHEN path = 'move' THEN 1 WHEN starts_with(path, 'die1/0/') THEN 2 WHEN starts_with(path, 'move/') THEN 3 END AS k FROM f WHERE item % 8 <> 2 OR asset < 'Brand#3')
    SELECT asset, path FROM r WHERE k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY asset ORDER BY k, path, item) = 1"""
)
def frame_lookup(spark, sf):
    rows = frames(spark, sf).where("item % 8 <> 2 or asset < 'Brand#3'").select("asset", "path").distinct()
    return f.prefix_lookup(rows, ["die1/0", "move"])


@query(
    f"""WITH {FRAMES}, r AS (SELECT item, asset, row_number() OVER (PARTITION BY asset ORDER BY area, item) AS up, count(*) OVER (PARTITION BY asset) AS n FROM f)
    SELECT item, CASE WHEN up <= greatest(1, n // 3) THEN 'smallest' WHEN up > n - greatest(1, n // 3) THEN 'largest' ELSE 'middle' END AS third FROM r"""
)
def size_thirds(spark, sf):
    return f.thirds(frames(spark, sf), ["asset"], "area", "item").select("item", "third")


@query(f"WITH {FRAMES} SELECT asset, count_if(x < 300 AND y < 100 AND x + width > 0 AND y + height > 0) AS visible FROM (SELECT *, item % 700 - 200 AS x, item % 190 - 60 AS y FROM f) q GROUP BY asset")
def pieces_in_view(spark, sf):
    rows = frames(spark, sf).withColumns({"x": F.col("item") % 700 - 200, "y": F.col("item") % 190 - 60})
    return rows.groupBy("asset").agg(F.count_if(f.in_view(F.col("x"), F.col("y"), F.col("width"), F.col("height"), 300, 100)).alias("visible"))


@query(f"WITH {FRAMES} SELECT item, CASE WHEN regexp_matches(split_part(key, '/', 1), '^[0-9]{{7,}}$') THEN split_part(key, '/', 1) ELSE asset END AS item_id FROM (SELECT item, asset, CASE WHEN item % 3 = 0 THEN printf('%07d', item) ELSE 'x' || item END || '/' || path AS key FROM f) q")
def item_ids(spark, sf):
    from quarry.functions.text import item_id

    head = F.when(F.col("item") % 3 == 0, F.format_string("%07d", "item")).otherwise(F.concat(F.lit("x"), F.col("item").cast("string")))
    return frames(spark, sf).select("item", item_id(F.concat_ws("/", head, "path"), F.col("asset")).alias("item_id"))


@query("""SELECT scenario, ceil(0.1 * count(*))::BIGINT AS part, min(image_id) AS first_image FROM {images} GROUP BY scenario""")
def proportional_limits(spark, sf):
    """A limited run takes a share of every scenario, rounded up."""
    return view(spark, sf, "images").groupBy("scenario").agg(F.ceil(F.count("*") * 0.1).cast("long").alias("part"), F.min("image_id").alias("first_image"))


@query("""SELECT category, item, row_number() OVER (PARTITION BY category ORDER BY item) AS place FROM {items} QUALIFY place <= 64""")
def first_names(spark, sf):
    """At most 64 names of each part group, in order."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("category").orderBy("item"))
    return view(spark, sf, "items").select("category", "item", place.alias("place")).where("place <= 64")


@query("""WITH c AS (SELECT split AS dim, scenario AS key, count(*) AS n FROM {images} GROUP BY ALL) SELECT dim, '{' || string_agg('"' || key || '":' || n, ',' ORDER BY key) || '}' AS document FROM c GROUP BY dim""".replace("'{'", "chr(123)").replace("'}'", "chr(125)"))
def coverage_report(spark, sf):
    counts = view(spark, sf, "images").groupBy(F.col("split").alias("dim"), F.col("scenario").alias("key")).agg(F.count("*").alias("n"))
    return report.counter_json(counts)


@query("""SELECT split, count(*) AS images FROM (SELECT split FROM {images} WHERE image_id % 1000 <> 7 UNION ALL SELECT 'train' FROM {images} WHERE image_id % 97 = 0) q GROUP BY split""")
def effective_split_sizes(spark, sf):
    images = view(spark, sf, "images")
    patch = images.where("image_id % 97 = 0").select(F.lit("train").alias("split"))
    return report.effective_sizes(images, patch, images.where("image_id % 1000 = 7").select("image_id"))


@query("""SELECT map_id, min(x)::BIGINT AS camera_x, least(12, count_if(x < 640)) + 1.5::DOUBLE * least(3, count(DISTINCT y))::DOUBLE AS score FROM {spawns} GROUP BY map_id""")
def camera_scores(spark, sf):
    """A candidate view's score: what is seen, and on how many levels."""
    s = view(spark, sf, "spawns")
    score = F.least(F.lit(12), F.count_if(F.col("x") < 640)) + F.lit(1.5) * F.least(F.lit(3), F.count_distinct("y"))
    return s.groupBy("map_id").agg(F.min("x").cast("long").alias("camera_x"), score.cast("double").alias("score"))


@query("""WITH u AS (SELECT map_id, count(*) AS n FROM {images} WHERE split = 'train' GROUP BY map_id), o AS (SELECT DISTINCT map_id FROM {images} WHERE image_id % 50 = 0)
SELECT u.map_id, row_number() OVER (ORDER BY o.map_id IS NULL, n, md5('83:' || u.map_id)) AS place FROM u LEFT JOIN o USING (map_id)""")
def candidate_maps(spark, sf):
    """Order in which maps are tried: those that worked before, then the least used, then by seeded rank."""
    from quarry.operators.quota import hash_places, seeded

    images = view(spark, sf, "images")
    uses = images.where("split = 'train'").groupBy("map_id").agg(F.count("*").alias("n"))
    worked = images.where("image_id % 50 = 0").select("map_id", F.lit(True).alias("ok")).distinct()
    rows = uses.join(worked, "map_id", "left").withColumn("new", F.col("ok").isNull().cast("int"))
    return hash_places(rows, seeded(83, F.col("map_id")), ("new", "n")).select("map_id", (F.col("place") + 1).alias("place"))


@query("""SELECT mob_id, count(*) AS lacking, arg_min(map_id, struct_pack(s := CASE WHEN split = 'train' THEN 0 ELSE 1 END, m := map_id)) AS map_id FROM (SELECT DISTINCT s.mob_id, i.map_id, i.split FROM {spawns} s JOIN {images} i ON s.map_id = i.map_id) q GROUP BY mob_id""")
def patch_maps(spark, sf):
    """A map for each mob, one of the training split first."""
    pairs = view(spark, sf, "spawns").select("map_id", "mob_id").distinct().join(view(spark, sf, "images").select("map_id", "split").distinct(), "map_id")
    best = F.min(F.struct((F.col("split") != "train").cast("int").alias("s"), "map_id"))["map_id"]
    return pairs.groupBy("mob_id").agg(F.count("*").alias("lacking"), best.alias("map_id"))


@query(
    """WITH c AS (SELECT split, scenario, quota_key, count(*) AS n FROM {images} GROUP BY ALL), e AS (SELECT split, scenario, quota_key, count(*) + CASE WHEN scenario = 'edge_crop' THEN 1 ELSE 0 END AS m FROM {images} GROUP BY split, scenario, quota_key)
    SELECT 'split' AS dim, split || '/' || scenario || '/' || quota_key AS key, n, m AS expected FROM c JOIN e USING (split, scenario, quota_key) WHERE n <> m"""
)
def quota_comparison(spark, sf):
    images = view(spark, sf, "images")
    n = images.groupBy("split", "scenario", "quota_key").agg(F.count("*").alias("n")).select(F.lit("split").alias("dim"), F.concat_ws("/", "split", "scenario", "quota_key").alias("key"), "n", "scenario")
    plan = n.withColumn("n", F.col("n") + (F.col("scenario") == "edge_crop").cast("int")).drop("scenario")
    return c.quota_differences(n.drop("scenario"), plan)
