"""Quotas, schedules, splits and sampling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import quota as q
from quarry.operators import splits as sp

from .registry import query
from .views import view

QUOTAS = "k AS (SELECT quota_key AS key, count(*) AS n FROM {images} GROUP BY quota_key)"
APPORTIONED = """a AS (SELECT key, n, n * {t} // sum(n) OVER () AS low, n * {t} % sum(n) OVER () AS rest FROM k),
g AS (SELECT key, n, low + CASE WHEN row_number() OVER (ORDER BY rest DESC, key DESC) <= {t} - sum(low) OVER () THEN 1 ELSE 0 END AS quota FROM a)"""


def apportioned(total: int) -> str:
    return APPORTIONED.replace("{t}", str(total))


def quota_table(spark, sf):
    return view(spark, sf, "images").groupBy(F.col("quota_key").alias("key")).agg(F.count("*").alias("n"))


@query(f"WITH {QUOTAS}, {apportioned(997)} SELECT key, n, quota::BIGINT AS quota FROM g")
def scaled_quotas(spark, sf):
    return q.apportion(quota_table(spark, sf), 997)


@query(f"WITH {QUOTAS}, {apportioned(997)} SELECT key, (quota + CASE WHEN row_number() OVER (ORDER BY quota DESC, key) = 1 THEN 1010 - sum(quota) OVER () ELSE 0 END)::BIGINT AS quota FROM g")
def fitted_quotas(spark, sf):
    return q.fitted(q.apportion(quota_table(spark, sf), 997), 1010).select("key", "quota")


@query(f"WITH {QUOTAS}, {apportioned(997)} SELECT key, unnest(range(quota::BIGINT))::INTEGER AS unit FROM g")
def expanded_quotas(spark, sf):
    return q.expanded(q.apportion(quota_table(spark, sf), 997))


@query(
    f"""WITH {QUOTAS}, t AS (SELECT count(*) AS t FROM {{images}}), {APPORTIONED.replace('{t}', '(SELECT t FROM t)')},
    e AS (SELECT key, quota, sum(quota) OVER (ORDER BY key) AS hi FROM g), o AS (SELECT image_id, row_number() OVER (ORDER BY md5('7:' || image_id)) - 1 AS place FROM {{images}})
    SELECT image_id, place, key FROM o JOIN e ON place >= hi - quota AND place < hi"""
)
def assigned_quotas(spark, sf):
    """Every image gets a quota key in hash order, all quotas met exactly."""
    images = view(spark, sf, "images").select("image_id")
    return q.assigned(images, q.apportion(quota_table(spark, sf), images.count()), q.seeded(7, F.col("image_id")))


@query(
    f"""WITH {QUOTAS}, t AS (SELECT count(*) AS t FROM {{images}}), {APPORTIONED.replace('{t}', '(SELECT t FROM t)')},
    e AS (SELECT key, quota, sum(quota) OVER (ORDER BY key) AS hi FROM g), o AS (SELECT image_id, split, row_number() OVER (ORDER BY md5('11:' || image_id)) - 1 AS place FROM {{images}})
    SELECT image_id, place AS ordinal, split, row_number() OVER (PARTITION BY split ORDER BY place) - 1 AS split_index, key AS scenario FROM o JOIN e ON place >= hi - quota AND place < hi"""
)
def schedule(spark, sf):
    """A schedule: scenarios by quota in hash order, an ordinal, and the index inside each split."""
    images = view(spark, sf, "images").select("image_id", "split")
    rows = q.assigned(images, q.apportion(quota_table(spark, sf), images.count()), q.seeded(11, F.col("image_id")))
    rows = rows.withColumnsRenamed({"place": "ordinal", "key": "scenario"})
    return q.split_indexes(rows).select("image_id", "ordinal", "split", "split_index", "scenario")


@query(
    """WITH s AS (SELECT ceil(50 / count(DISTINCT scenario))::INTEGER AS k FROM {images}), r AS (SELECT image_id, scenario, row_number() OVER (PARTITION BY scenario ORDER BY image_id) AS n FROM {images})
    SELECT scenario, count_if(n <= k) AS checks, min(image_id) AS first_image FROM r, s GROUP BY scenario"""
)
def visual_checks(spark, sf):
    images = view(spark, sf, "images")
    limit = images.agg(F.ceil(F.lit(50) / F.count_distinct("scenario")).cast("int")).first()[0]
    rows = q.capped(images, ["scenario"], "image_id", limit)
    return rows.groupBy("scenario").agg(F.count_if("visual_check").alias("checks"), F.min("image_id").alias("first_image"))


USES = "c AS (SELECT split, item, count(*) AS n FROM {uses} GROUP BY ALL)"


@query(
    f"""WITH {USES}, e AS (SELECT split, item, unnest(range(n, n + 25)) AS place FROM c), r AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY place, item) AS pick FROM e)
    SELECT split, pick, item, place AS uses_before FROM r WHERE pick <= 25"""
)
def least_used_items(spark, sf):
    counts = view(spark, sf, "uses").groupBy("split", "item").agg(F.count("*").alias("n"))
    return q.least_used(counts, ["split"], 25)


@query(f"WITH {USES} SELECT item, n FROM c WHERE split = 'train' AND n <= (SELECT min(n) FROM c WHERE split = 'train') + 2")
def nearly_least_used(spark, sf):
    counts = view(spark, sf, "uses").where("split = 'train'").groupBy("item").agg(F.count("*").alias("n"))
    return q.within_slack(counts, 2)


@query("SELECT item, sha256('83:' || item) AS rank_key FROM {items} QUALIFY row_number() OVER (ORDER BY sha256('83:' || item)) <= round_even(count(*) OVER () * 0.05, 0)")
def challenge_items(spark, sf):
    """The first five percent of items by a seeded digest."""
    items = view(spark, sf, "items").select("item")
    k = F.bround(items.agg(F.count("*")).first()[0] * F.lit(0.05)).cast("int")
    key = F.sha2(F.concat(F.lit("83:"), F.col("item").cast("string")), 256)
    return q.hash_places(items, key).where(F.col("place") < k).select("item", key.alias("rank_key"))


@query(
    """WITH m AS (SELECT map_id, count(DISTINCT mob_id) AS mobs, count_if(kind = 'n') AS lacking, sum(y) % 17 AS frames FROM {spawns} GROUP BY map_id)
    SELECT map_id, row_number() OVER (ORDER BY lacking DESC, frames DESC, mobs, map_id) AS rank FROM m QUALIFY rank <= 20"""
)
def top_maps(spark, sf):
    """The twenty maps with the largest deficits, by a composite order."""
    m = view(spark, sf, "spawns").groupBy("map_id").agg(F.count_distinct("mob_id").alias("mobs"), F.count_if(F.col("kind") == "n").alias("lacking"), (F.sum("y") % 17).alias("frames"))
    top = m.orderBy(F.desc("lacking"), F.desc("frames"), "mobs", "map_id").limit(20)
    return top.select("map_id", F.row_number().over(Window.orderBy(F.desc("lacking"), F.desc("frames"), "mobs", "map_id")).alias("rank"))


@query("SELECT map_id, sum(n)::BIGINT AS top_five FROM (SELECT map_id, n, row_number() OVER (PARTITION BY map_id ORDER BY n DESC, mob_id) AS r FROM (SELECT map_id, mob_id, count(*) AS n FROM {spawns} GROUP BY ALL) a) b WHERE r <= 5 GROUP BY map_id")
def top_five_deficits(spark, sf):
    n = view(spark, sf, "spawns").groupBy("map_id", "mob_id").agg(F.count("*").alias("n"))
    ranked = n.withColumn("r", F.row_number().over(Window.partitionBy("map_id").orderBy(F.desc("n"), "mob_id")))
    return ranked.where("r <= 5").groupBy("map_id").agg(F.sum("n").alias("top_five"))


@query(
    """WITH m AS (SELECT DISTINCT map_id FROM {spawns}), r AS (SELECT map_id, row_number() OVER (ORDER BY md5('5:' || map_id)) - 1 AS k, count(*) OVER () AS n FROM m)
    SELECT map_id, CASE WHEN k < greatest(1, round_even(n * 0.1, 0)) THEN 'test' WHEN k < 2 * greatest(1, round_even(n * 0.1, 0)) THEN 'val' ELSE 'train' END AS split FROM r"""
)
def hashed_map_split(spark, sf):
    return q.hash_split(view(spark, sf, "spawns").select("map_id").distinct(), "map_id", 5, {"test": 0.1, "val": 0.1})


@query()
def coverage_preserving_split(spark, sf):
    """Held-out maps are taken greedily while every mob keeps a training map: sequential by nature, tests check what it promises."""
    maps = view(spark, sf, "spawns").where("kind = 'm'").groupBy("map_id").agg(F.array_sort(F.collect_set("mob_id")).alias("mob_ids"))
    return sp.coverage_split(maps, 5)


@query("SELECT map_id, count(DISTINCT split) AS splits FROM {images} GROUP BY map_id HAVING count(DISTINCT split) > 1")
def split_leakage(spark, sf):
    return sp.leaks(view(spark, sf, "images"), "map_id")


@query("SELECT DISTINCT i.map_id FROM {images} i WHERE i.split = 'train' AND i.map_id NOT IN (SELECT map_id FROM {images} WHERE split = 'test' AND map_id % 10 < 3)")
def training_maps(spark, sf):
    """Set difference: all maps less the held ones."""
    images = view(spark, sf, "images")
    held = images.where("split = 'test' and map_id % 10 < 3").select("map_id")
    return images.where("split = 'train'").select("map_id").distinct().join(held, "map_id", "left_anti")


@query("SELECT 'base' AS part, image_id FROM {images} WHERE image_id % 2 = 0 UNION ALL SELECT 'patch', image_id FROM {images} WHERE image_id % 97 = 0")
def combined_dataset(spark, sf):
    images = view(spark, sf, "images")
    part = lambda name, cond: images.where(cond).select(F.lit(name).alias("part"), "image_id")
    return part("base", "image_id % 2 = 0").unionByName(part("patch", "image_id % 97 = 0"))


@query(
    """WITH a AS (SELECT split, quota_key, count(*) AS n FROM {images} GROUP BY split, quota_key), b AS (SELECT split, quota_key, n + CASE WHEN quota_key LIKE '1%' THEN 1 ELSE 0 END AS n FROM a)
    SELECT differing = 0 AS equal, differing FROM (SELECT count(*) AS differing FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) d) e"""
)
def multiset_equality(spark, sf):
    images = view(spark, sf, "images")
    a = images.groupBy("split", "quota_key").agg(F.count("*").alias("n"))
    b = a.withColumn("n", F.col("n") + F.col("quota_key").startswith("1").cast("int"))
    return a.exceptAll(b).agg((F.count("*") == 0).alias("equal"), F.count("*").alias("differing"))


@query(
    """SELECT image_id, list_has_all(list(DISTINCT action_no), [0, 1]) AS has_required, array_to_string(list_sort(list(DISTINCT action_no)), ',') AS actions FROM {boxes} GROUP BY image_id"""
)
def required_actions(spark, sf):
    """Subset test: the required kinds are all there."""
    kinds = F.array_sort(F.collect_set("action_no"))
    return view(spark, sf, "boxes").groupBy("image_id").agg(kinds.alias("k")).select(
        "image_id", (F.size(F.array_except(F.array(F.lit(0), F.lit(1)), "k")) == 0).alias("has_required"), F.array_join("k", ",").alias("actions")
    )


@query("SELECT image_id, mob_id, min(idx) AS place FROM {boxes} GROUP BY ALL")
def ordered_distinct(spark, sf):
    """Distinct mobs of an image with the place where each came first."""
    return view(spark, sf, "boxes").groupBy("image_id", "mob_id").agg(F.min("idx").alias("place"))


@query("SELECT image_id, (image_id * 131 + 17) % 40 AS player, (image_id * 37 + 11) % 50 AS pet, (image_id * 37 + 54) % 50 AS second_pet FROM {images}")
def catalogue_picks(spark, sf):
    o = F.col("image_id")
    return view(spark, sf, "images").select("image_id", ((o * 131 + 17) % 40).alias("player"), ((o * 37 + 11) % 50).alias("pet"), ((o * 37 + 54) % 50).alias("second_pet"))


@query(
    """WITH c AS (SELECT image_id, attempt, (image_id * 7919 + attempt * 104729) % 100 AS roll FROM {images}, (SELECT unnest(range(1, 61))::INTEGER AS attempt) a)
    SELECT image_id, min(attempt) AS attempts FROM c WHERE roll < 9 GROUP BY image_id"""
)
def first_valid_attempts(spark, sf):
    """Bounded rejection sampling: candidates of all attempts, the first valid one wins."""
    tries = view(spark, sf, "images").select("image_id", F.explode(F.sequence(F.lit(1), F.lit(60))).alias("attempt"))
    valid = tries.where((F.col("image_id") * 7919 + F.col("attempt") * 104729) % 100 < 9)
    return valid.groupBy("image_id").agg(F.min("attempt").alias("attempts"))
