"""Counts, coverage and balance."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import coverage as c

from .registry import query
from .views import view


@query(
    """SELECT 'split' AS dim, split AS key, count(*) AS n FROM {images} GROUP BY split UNION ALL SELECT 'scenario', scenario, count(*) FROM {images} GROUP BY scenario
    UNION ALL SELECT 'layout', layout, count(*) FROM {images} GROUP BY layout UNION ALL SELECT 'map', map_id::VARCHAR, count(*) FROM {images} GROUP BY map_id"""
)
def manifest_counters(spark, sf):
    return c.counters(view(spark, sf, "images"), {"split": F.col("split"), "scenario": F.col("scenario"), "layout": F.col("layout"), "map": F.col("map_id")})


@query("SELECT printf('instances_%02d', n) AS key, count(*) AS images FROM (SELECT image_id, count(*) AS n FROM {boxes} GROUP BY image_id) q GROUP BY ALL")
def instance_histogram(spark, sf):
    per = view(spark, sf, "boxes").groupBy("image_id").agg(F.count("*").cast("int").alias("n"))
    return per.groupBy(F.format_string("instances_%02d", "n").alias("key")).agg(F.count("*").alias("images"))


@query("SELECT mob_id, count(*) AS n FROM {boxes} WHERE class_id = 0 GROUP BY mob_id")
def mob_box_counts(spark, sf):
    return view(spark, sf, "boxes").where("class_id = 0").groupBy("mob_id").agg(F.count("*").alias("n"))


@query(
    """WITH u AS (SELECT split, item, count(*) AS n FROM {uses} GROUP BY ALL), k AS (SELECT DISTINCT item FROM {items}), s AS (SELECT unnest(['train', 'val', 'test']) AS split)
    SELECT split, min(n) AS least_seen, min(coalesce(n, 0)) AS least, count_if(coalesce(n, 0) < 4) AS below FROM s CROSS JOIN k LEFT JOIN u USING (split, item) GROUP BY split"""
)
def item_coverage_minima(spark, sf):
    """Least uses per split over the seen and over all eligible items."""
    uses, items = view(spark, sf, "uses"), view(spark, sf, "items").select("item").distinct()
    splits = spark.createDataFrame([("train",), ("val",), ("test",)], "split string")
    every = c.filled(uses.select("split", "item"), items.crossJoin(F.broadcast(splits)), ["split", "item"])  # three splits
    seen = F.when(F.col("n") > 0, F.col("n"))
    return every.groupBy("split").agg(F.min(seen).alias("least_seen"), F.min("n").alias("least"), F.count_if(F.col("n") < 4).alias("below"))


@query(
    """WITH n AS (SELECT mob_id, count(*) AS n FROM {boxes} WHERE class_id = 0 GROUP BY mob_id) SELECT min(n) AS least, max(n) AS most, max(n) / min(n) AS ratio, max(n) <= 5 * min(n) AS balanced FROM n"""
)
def balance_ratio(spark, sf):
    n = mob_box_counts(spark, sf)
    return n.agg(F.min("n").alias("least"), F.max("n").alias("most")).select("least", "most", (F.col("most") / F.col("least")).alias("ratio"), (F.col("most") <= 5 * F.col("least")).alias("balanced"))


DEFICITS = """n AS (SELECT mob_id % 23 * (mob_id % 3) AS mob_id, count(*) AS n FROM {boxes} GROUP BY ALL), d AS (SELECT mob_id, n, (max(n) OVER () + 4) // 5 AS target FROM n)"""


@query(f"WITH {DEFICITS} SELECT mob_id, n, target, target - n AS deficit FROM d WHERE target > n")
def coverage_deficits(spark, sf):
    counts = view(spark, sf, "boxes").groupBy((F.col("mob_id") % 23 * (F.col("mob_id") % 3)).alias("mob_id")).agg(F.count("*").alias("n"))
    return c.deficits(counts)


@query(f"WITH {DEFICITS} SELECT mob_id, part, least(10, target - n - part * 10) AS units FROM d, LATERAL (SELECT unnest(range((target - n + 9) // 10))::INTEGER AS part) r WHERE target > n")
def patch_tasks(spark, sf):
    return c.chunks(coverage_deficits(spark, sf), "deficit").select("mob_id", "part", "units")


@query(
    """SELECT count(DISTINCT map_id) AS maps, count(DISTINCT mob_id) AS mobs, count(*) AS boxes, count(DISTINCT image_id) AS images, count(DISTINCT CASE WHEN class_id = 1 THEN mob_id END) AS players FROM {boxes} JOIN {images} USING (image_id)"""
)
def dataset_totals(spark, sf):
    joined = view(spark, sf, "boxes").join(view(spark, sf, "images").select("image_id", "map_id"), "image_id")
    return joined.agg(
        F.count_distinct("map_id").alias("maps"), F.count_distinct("mob_id").alias("mobs"), F.count("*").alias("boxes"), F.count_distinct("image_id").alias("images"),
        F.count_distinct(F.when(F.col("class_id") == 1, F.col("mob_id"))).alias("players"),
    )


@query(
    """WITH r AS (SELECT mob_id, w, row_number() OVER (PARTITION BY mob_id ORDER BY w) - 1 AS rk, count(*) OVER (PARTITION BY mob_id) AS cnt FROM {boxes})
    SELECT mob_id, max(CASE WHEN rk = round_even((cnt - 1) * 0.05, 0) THEN w END) AS p5, max(CASE WHEN rk = round_even((cnt - 1) * 0.5, 0) THEN w END) AS p50, max(CASE WHEN rk = round_even((cnt - 1) * 0.95, 0) THEN w END) AS p95 FROM r GROUP BY mob_id"""
)
def width_percentiles(spark, sf):
    return c.percentile_rank(view(spark, sf, "boxes"), ["mob_id"], "w", [0.05, 0.5, 0.95])


@query("SELECT mob_id, min(w) AS least_w, round_even(median(w), 0)::INTEGER AS median_w, max(w) AS most_w, min(h) AS least_h, round_even(median(h), 0)::INTEGER AS median_h, max(h) AS most_h FROM {boxes} GROUP BY mob_id")
def mob_sizes(spark, sf):
    own = lambda x: (F.min(x).alias(f"least_{x}"), F.bround(F.median(x)).cast("int").alias(f"median_{x}"), F.max(x).alias(f"most_{x}"))
    return view(spark, sf, "boxes").groupBy("mob_id").agg(*own("w"), *own("h"))


@query("SELECT mob_id, greatest(0, max(abs(x - y * 3))) AS movement FROM {spawns} WHERE kind = 'm' GROUP BY mob_id")
def movement_ranges(spark, sf):
    return view(spark, sf, "spawns").where("kind = 'm'").groupBy("mob_id").agg(F.greatest(F.lit(0), F.max(F.abs(F.col("x") - F.col("y") * 3))).alias("movement"))


@query(
    """SELECT width * 100 + saturation AS key, arg_min(item, item) AS item, arg_min(height, item) AS height, array_to_string(list_sort(list(DISTINCT category)), ',') AS categories, count(DISTINCT item) AS items FROM {items} GROUP BY key"""
)
def merged_visuals(spark, sf):
    items = view(spark, sf, "items").withColumn("key", F.col("width") * 100 + F.col("saturation")).withColumnRenamed("item", "no").withColumn("item", F.col("no"))
    out = c.merged(items, "key", "no", ["item", "height"], ["category", "no"])
    return out.select("key", "item", "height", F.array_join("category_set", ",").alias("categories"), F.size("no_set").cast("long").alias("items"))


@query("SELECT category, count(*) AS n, count(DISTINCT grouping) AS kinds FROM {items} GROUP BY category")
def category_counts(spark, sf):
    return view(spark, sf, "items").groupBy("category").agg(F.count("*").alias("n"), F.count_distinct("grouping").alias("kinds"))


@query(
    """SELECT split, category, count(*) AS uses FROM {uses} JOIN (SELECT item, unnest([category, grouping]) AS category FROM (SELECT item, category, grouping FROM {items}) q) i USING (item, category) GROUP BY ALL
    UNION ALL SELECT split, i.category, count(*) FROM {uses} u JOIN {items} i ON u.item = i.item GROUP BY ALL"""
)
def item_category_uses(spark, sf):
    """Uses joined with the unnested categories of their items."""
    uses, items = view(spark, sf, "uses"), view(spark, sf, "items")
    unnested = items.select("item", F.explode(F.array("category", "grouping")).alias("category"))
    by_name = uses.join(unnested, ["item", "category"]).groupBy("split", "category").agg(F.count("*").alias("uses"))
    by_item = uses.select("item", "split").join(items, "item").groupBy("split", "category").agg(F.count("*").alias("uses"))
    return by_name.unionByName(by_item)


@query("SELECT map_id, count(*) AS spawns, count(DISTINCT mob_id) AS mobs, count_if(kind = 'n') AS npcs, count(DISTINCT fh) AS footholds, count(*) + 2 * count(DISTINCT fh) AS drawables FROM {spawns} GROUP BY map_id")
def map_audit(spark, sf):
    """Per map: spawns, mobs, npcs, footholds and the drawable count."""
    s = view(spark, sf, "spawns")
    return s.groupBy("map_id").agg(
        F.count("*").alias("spawns"), F.count_distinct("mob_id").alias("mobs"), F.count_if(F.col("kind") == "n").alias("npcs"),
        F.count_distinct("fh").alias("footholds"), (F.count("*") + 2 * F.count_distinct("fh")).alias("drawables"),
    )


@query(
    """SELECT item, width BETWEEN 2 AND 100 AND height >= 8 AS fits, saturation >= 55 AND width / height BETWEEN 0.55 AND 1.8 AND greatest(width, height) >= 20 AS high_risk FROM {items}"""
)
def item_gates(spark, sf):
    """Size gate and high-risk flag of item visuals."""
    ratio = F.col("width") / F.col("height")
    return view(spark, sf, "items").select(
        "item", (F.col("width").between(2, 100) & (F.col("height") >= 8)).alias("fits"),
        ((F.col("saturation") >= 55) & ratio.between(0.55, 1.8) & (F.greatest("width", "height") >= 20)).alias("high_risk"),
    )
