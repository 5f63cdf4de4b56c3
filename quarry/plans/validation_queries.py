"""Violation queries of the four validators."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import coverage as c
from quarry.operators import labels
from quarry.operators import validate as v
from quarry.operators.store import written

from .label_queries import MEASURES, VALID
from .registry import query
from .views import view

#: Labels with planted faults: boxes out of frame, wrong areas, dead actions, bad grounds, low visibility.
LABELS = """l AS (SELECT image_id, idx, CASE WHEN image_id % 211 = 0 THEN x - 1150 ELSE x END AS x, y, w, CASE WHEN image_id % 97 = 1 THEN 3 ELSE h END AS h, class_id, foothold_id, mob_id,
  w * CASE WHEN image_id % 97 = 1 THEN 3 ELSE h END + CASE WHEN image_id % 89 = 2 THEN 1 ELSE 0 END AS area, CASE WHEN action_no = 3 AND image_id % 5 = 0 THEN 'Die1' ELSE 'move' END AS action,
  CASE WHEN image_id % 3 = 0 THEN NULL ELSE (image_id % 31) / 10.0 END AS ground_error, CASE WHEN image_id % 7 = 0 THEN NULL ELSE (image_id % 41) / 40.0 END AS visible_fraction FROM {boxes})"""


def planted(boxes):
    i = F.col("image_id")
    h = F.when(i % 97 == 1, 3).otherwise(F.col("h"))
    return boxes.select(
        "image_id", "idx", F.when(i % 211 == 0, F.col("x") - 1150).otherwise(F.col("x")).alias("x"), "y", "w", h.alias("h"), "class_id", "foothold_id", "mob_id",
        (F.col("w") * h + F.when(i % 89 == 2, 1).otherwise(0)).alias("area"), F.when((F.col("action_no") == 3) & (i % 5 == 0), "Die1").otherwise("move").alias("action"),
        F.when(i % 3 != 0, (i % 31) / 10).alias("ground_error"), F.when(i % 7 != 0, (i % 41) / 40).alias("visible_fraction"),
    )


KEY = "image_id || '/' || idx"
FRAME = "NOT (x >= 0 AND y >= 0 AND x + w <= 1280 AND y + h <= 224 AND w >= 4 AND h >= 4)"


@query(
    f"""WITH {LABELS}, {MEASURES}, known AS (SELECT image_id FROM {{images}} WHERE image_id % 50 <> 3)
    SELECT 'VAL-A7' AS rule_id, {KEY} AS key, 'frame' AS detail FROM l WHERE {FRAME}
    UNION ALL SELECT DISTINCT 'VAL-A7', image_id::VARCHAR, 'missing' FROM l WHERE image_id NOT IN (SELECT image_id FROM known)
    UNION ALL SELECT 'VAL-A8', {KEY}, 'area' FROM l WHERE area <> w * h
    UNION ALL SELECT 'VAL-A9', {KEY}, 'death' FROM l WHERE class_id = 0 AND regexp_matches(lower(action), 'die|dead|death')
    UNION ALL SELECT 'VAL-A10', k.image_id::VARCHAR, coalesce(n, 0)::VARCHAR FROM known k LEFT JOIN (SELECT image_id, count(*) AS n FROM l GROUP BY image_id) c USING (image_id) WHERE coalesce(n, 0) NOT BETWEEN 1 AND 6
    UNION ALL SELECT 'VAL-A11', z.image_id::VARCHAR, 'dense' FROM z JOIN {{images}} i USING (image_id) WHERE contains(i.scenario, 'dense') AND n >= 2 AND overlapping = 0
    UNION ALL SELECT 'VAL-A12', map_id::VARCHAR, count(DISTINCT split)::VARCHAR FROM {{images}} GROUP BY map_id HAVING count(DISTINCT split) > 1
    UNION ALL SELECT 'VAL-A13', 'dataset', 'warning' FROM z HAVING count_if(overlapping > 0) / count(*) < 0.20"""
)
def validate_legacy(spark, sf):
    """Rules A7 to A13 on labels with planted faults."""
    images, boxes = view(spark, sf, "images"), written(view(spark, sf, "boxes"))  # read by every rule
    own = planted(boxes)
    known = images.where("image_id % 50 <> 3")
    m = written(v.layout.layout_measures(boxes).join(images.select("image_id", "scenario"), "image_id"))
    return c.union_all(
        [
            v.box_rules(own, "VAL-", {"frame": "A7", "area": "A8", "death": "A9"}),
            v.orphans(own, known, "VAL-A7"),
            v.count_range(known, own, "VAL-A10", 1, 6),
            v.violations(m, "VAL-A11", F.col("image_id"), F.col("scenario").contains("dense") & (F.col("n") >= 2) & (F.col("overlapping") == 0), "dense"),
            v.leakage(images, "VAL-A12"),
            v.single(spark, m.agg((F.count_if(F.col("overlapping") > 0) / F.count("*")).alias("ratio")), "VAL-A13", F.col("ratio") < 0.20, F.lit("warning")),
        ]
    )


@query(
    f"""WITH {LABELS}, {MEASURES}, i AS (SELECT *, CASE WHEN image_id % 401 = 0 THEN 'val' ELSE split END AS actual_split, CASE WHEN image_id % 307 = 0 THEN 'edge_crop' ELSE scenario END AS actual_scenario,
      (image_id % 4)::INTEGER AS planned FROM {{images}}), v AS (SELECT z.*, i.layout, i.multi_platform FROM z JOIN {{images}} i USING (image_id))
    SELECT 'VAL-B1' AS rule_id, 'dataset' AS key, count(*) || ' of ' || (count(*) + 1) AS detail FROM i
    UNION ALL SELECT 'VAL-B3', k, n || ' of ' || m FROM (SELECT actual_split AS k, count(*) AS n FROM i GROUP BY 1) a JOIN (SELECT split AS k, count(*) AS m FROM i GROUP BY 1) b USING (k) WHERE n <> m
    UNION ALL SELECT 'VAL-B4', k, n || ' of ' || m FROM (SELECT actual_scenario AS k, count(*) AS n FROM i GROUP BY 1) a JOIN (SELECT scenario AS k, count(*) AS m FROM i GROUP BY 1) b USING (k) WHERE n <> m
    UNION ALL SELECT 'VAL-B10', map_id::VARCHAR, count(DISTINCT split)::VARCHAR FROM i GROUP BY map_id HAVING count(DISTINCT split) > 1
    UNION ALL SELECT 'VAL-B15', ordinal::VARCHAR, 'copy' FROM (SELECT ordinal, row_number() OVER (PARTITION BY sha256 ORDER BY ordinal) AS r FROM {{manifest}}) q WHERE r > 1
    UNION ALL SELECT 'VAL-B21', image_id || '/' || class_id || '/' || x || '/' || y || '/' || w || '/' || h, count(*)::VARCHAR FROM l GROUP BY image_id, class_id, x, y, w, h HAVING count(*) > 1
    UNION ALL SELECT 'VAL-B22', i.image_id::VARCHAR, coalesce(n, 0) || ' of ' || planned FROM i LEFT JOIN (SELECT image_id, count(*) AS n FROM l WHERE class_id = 0 GROUP BY 1) c USING (image_id) WHERE coalesce(n, 0) <> planned
    UNION ALL SELECT 'VAL-B23', i.image_id::VARCHAR, coalesce(n, 0) || ' of ' || planned FROM i LEFT JOIN (SELECT image_id, count(*) AS n FROM l WHERE class_id = 1 GROUP BY 1) c USING (image_id) WHERE coalesce(n, 0) <> planned
    UNION ALL SELECT 'VAL-B24', image_id::VARCHAR, 'monsters' FROM i WHERE starts_with(scenario, 'negative_') AND image_id IN (SELECT image_id FROM l WHERE class_id = 0)
    UNION ALL SELECT 'VAL-B25', {KEY}, 'frame' FROM l WHERE {FRAME}
    UNION ALL SELECT 'VAL-B26', {KEY}, 'visible' FROM l WHERE coalesce(visible_fraction, 1.0) < 0.3
    UNION ALL SELECT 'VAL-B27', {KEY}, 'death' FROM l WHERE class_id = 0 AND regexp_matches(lower(action), 'die|dead|death')
    UNION ALL SELECT 'VAL-B28', {KEY}, 'ground' FROM l WHERE class_id = 0 AND coalesce(ground_error, 0) > 2
    UNION ALL SELECT CASE layout WHEN 'distributed' THEN 'VAL-B29' WHEN 'clustered' THEN 'VAL-B30' WHEN 'overlap' THEN 'VAL-B31' ELSE 'VAL-B32' END, image_id::VARCHAR, layout FROM v WHERE NOT {VALID}
    UNION ALL SELECT 'VAL-B33', image_id::VARCHAR, footholds::VARCHAR FROM v WHERE multi_platform AND footholds < 2"""
)
def validate_dataset(spark, sf):
    """Rules on records, histograms, labels and layouts, with planted faults."""
    images, boxes, manifest = view(spark, sf, "images"), written(view(spark, sf, "boxes")), view(spark, sf, "manifest")  # boxes are read by every rule
    own = planted(boxes)
    i = F.col("image_id")
    actual = images.withColumns({"split": F.when(i % 401 == 0, "val").otherwise(F.col("split")), "scenario": F.when(i % 307 == 0, "edge_crop").otherwise(F.col("scenario")), "planned": (i % 4).cast("int")})
    total = images.agg(F.count("*").alias("n")).withColumn("m", F.col("n") + 1)
    negative = images.where(F.col("scenario").startswith("negative_")).join(own.where("class_id = 0").select("image_id").distinct(), "image_id", "left_semi")
    return c.union_all(
        [
            v.single(spark, total, "VAL-B1", F.col("n") != F.col("m"), F.concat_ws(" of ", F.col("n").cast("string"), F.col("m").cast("string"))),
            v.histogram(actual, images, "VAL-B3", "split"),
            v.histogram(actual, images, "VAL-B4", "scenario"),
            v.leakage(images, "VAL-B10"),
            v.later_copies(manifest.select("ordinal", "sha256"), "VAL-B15", "sha256", "ordinal", "ordinal"),
            v.repeated(own, "VAL-B21", ["image_id", "class_id", "x", "y", "w", "h"]),
            v.box_counts(actual, own, "VAL-B22", "planned", "class_id = 0"),
            v.box_counts(actual, own, "VAL-B23", "planned", "class_id = 1"),
            v.violations(negative, "VAL-B24", F.col("image_id"), F.lit(True), "monsters"),
            v.box_rules(own, "VAL-", {"frame": "B25", "visible": "B26", "death": "B27", "ground": "B28"}),
            v.layouts(images, boxes, {"distributed": "VAL-B29", "clustered": "VAL-B30", "overlap": "VAL-B31", "severe_overlap": "VAL-B32", "platform": "VAL-B33"}),
        ]
    )


@query(
    """WITH h AS (SELECT image_id, idx, CASE WHEN idx % 3 = 0 THEN 'loot' ELSE 'pet' END AS kind, x, y, CASE WHEN image_id % 53 = 0 THEN 0 ELSE w END AS w, h, (image_id % 60) / 50.0 AS visible, (image_id % 70) / 60.0 AS occluded, (idx % 4) / 2.5 AS iou,
      CASE WHEN image_id % 29 = 0 THEN NULL ELSE mob_id END AS item_id FROM {boxes})
    SELECT 'VAL-B34' AS rule_id, image_id::VARCHAR AS key, n || ' of ' || (image_id % 3) AS detail FROM (SELECT i.image_id, coalesce(count_if(h.kind = 'loot'), 0) AS n FROM {images} i LEFT JOIN h USING (image_id) GROUP BY 1) q WHERE n <> image_id % 3
    UNION ALL SELECT 'VAL-B36', image_id || '/' || idx, 'frame' FROM h WHERE NOT (w > 0 AND h > 0 AND x >= 0 AND y >= 0 AND x + w <= 1280 AND y + h <= 224)
    UNION ALL SELECT 'VAL-B37', image_id || '/' || idx, 'visible' FROM h WHERE visible > 1 UNION ALL SELECT 'VAL-B38', image_id || '/' || idx, 'occluded' FROM h WHERE occluded > 1
    UNION ALL SELECT 'VAL-B39', image_id || '/' || idx, 'iou' FROM h WHERE iou > 1 UNION ALL SELECT 'VAL-B40', image_id || '/' || idx, 'identity' FROM h WHERE kind = 'loot' AND item_id IS NULL"""
)
def validate_hidden_objects(spark, sf):
    i = F.col("image_id")
    hidden = view(spark, sf, "boxes").select(
        "image_id", "idx", F.when(F.col("idx") % 3 == 0, "loot").otherwise("pet").alias("kind"), "x", "y", F.when(i % 53 == 0, 0).otherwise(F.col("w")).alias("w"), "h",
        ((i % 60) / 50).alias("visible"), ((i % 70) / 60).alias("occluded"), ((F.col("idx") % 4) / 2.5).alias("iou"), F.when(i % 29 != 0, F.col("mob_id")).alias("item_id"),
    )
    planned = view(spark, sf, "images").select("image_id", (i % 3).alias("loot"))
    key = F.concat_ws("/", i.cast("string"), F.col("idx").cast("string"))
    unit = lambda name: ~F.col(name).between(0, 1)
    rules = [
        ("VAL-B36", ~v.g.inside(least=1), "frame"), ("VAL-B37", unit("visible"), "visible"), ("VAL-B38", unit("occluded"), "occluded"), ("VAL-B39", unit("iou"), "iou"),
        ("VAL-B40", (F.col("kind") == "loot") & F.col("item_id").isNull(), "identity"),
    ]
    return v.box_counts(planned, hidden, "VAL-B34", "loot", "kind = 'loot'").unionByName(v.row_rules(hidden, key, rules))


LINES = "y AS (SELECT image_id || '/' || idx AS key, CASE WHEN image_id % 61 = 0 THEN '7 0.1 0.2 0.3 0.4' WHEN image_id % 67 = 0 THEN '0 0.1 0.2 0.3' WHEN image_id % 71 = 0 THEN '1 0.1 1.2 0.3 0.4' WHEN image_id % 73 = 0 THEN '0 0.1 x 0.3 0.4' ELSE '0 0.1 0.2 0.3 0.4' END AS line FROM {boxes})"


@query(f"WITH {LINES} SELECT 'VAL-B19' AS rule_id, key, line AS detail FROM y WHERE line IN ('7 0.1 0.2 0.3 0.4', '0 0.1 0.2 0.3') UNION ALL SELECT 'VAL-B20', key, line FROM y WHERE line IN ('1 0.1 1.2 0.3 0.4', '0 0.1 x 0.3 0.4')")
def validate_label_lines(spark, sf):
    i = F.col("image_id")
    line = F.when(i % 61 == 0, "7 0.1 0.2 0.3 0.4").when(i % 67 == 0, "0 0.1 0.2 0.3").when(i % 71 == 0, "1 0.1 1.2 0.3 0.4").when(i % 73 == 0, "0 0.1 x 0.3 0.4").otherwise("0 0.1 0.2 0.3 0.4")
    rows = view(spark, sf, "boxes").select(F.concat_ws("/", i.cast("string"), F.col("idx").cast("string")).alias("key"), line.alias("line"))
    return v.yolo_grammar(rows, "key", "line", "VAL-B19", "VAL-B20", 2)


@query(
    """WITH m AS (SELECT mob_id, count(*) AS n FROM {boxes} WHERE class_id = 0 GROUP BY 1), s AS (SELECT unnest(['train', 'val', 'test']) AS split), k AS (SELECT DISTINCT item, item % 20 = 0 AS challenge FROM {items}),
    u AS (SELECT split, item, count(*) AS n FROM {uses} GROUP BY ALL)
    SELECT 'VAL-B45' AS rule_id, mob_id::VARCHAR AS key, n::VARCHAR AS detail FROM m WHERE n < 800 UNION ALL SELECT 'VAL-B49', 'dataset', (max(n) / min(n))::VARCHAR FROM m HAVING max(n) > 5 * min(n)
    UNION ALL SELECT 'VAL-B51', item::VARCHAR, 'challenge' FROM (SELECT DISTINCT item FROM {uses} WHERE split = 'train') t JOIN k USING (item) WHERE challenge
    UNION ALL SELECT 'VAL-B52', split || '/' || item, coalesce(n, 0)::VARCHAR FROM s CROSS JOIN k LEFT JOIN u USING (split, item) WHERE (split <> 'train' OR NOT challenge) AND coalesce(n, 0) < 4"""
)
def validate_coverage(spark, sf):
    mobs = view(spark, sf, "boxes").where("class_id = 0").groupBy("mob_id").agg(F.count("*").alias("n"))
    items = view(spark, sf, "items").select("item", (F.col("item") % 20 == 0).alias("challenge")).distinct()
    uses = view(spark, sf, "uses")
    splits = spark.createDataFrame([("train",), ("val",), ("test",)], "split string")
    eligible = items.crossJoin(F.broadcast(splits)).where("split <> 'train' or not challenge")  # three splits
    filled = c.filled(uses.select("split", "item"), eligible, ["split", "item"])
    ratio = mobs.agg((F.max("n") / F.min("n")).alias("r"), F.max("n").alias("most"), F.min("n").alias("least"))
    leaked = uses.where("split = 'train'").select("item").distinct().join(items.where("challenge"), "item")
    return c.union_all(
        [
            v.below_minimum(mobs, "VAL-B45", F.col("mob_id"), 800),
            v.single(spark, ratio, "VAL-B49", F.col("most") > 5 * F.col("least"), F.col("r")),
            v.violations(leaked, "VAL-B51", F.col("item"), F.lit(True), "challenge"),
            v.below_minimum(filled, "VAL-B52", F.concat_ws("/", "split", F.col("item").cast("string")), 4),
        ]
    )


@query(
    """WITH p AS (SELECT image_id, split, scenario, (image_id % 5)::INTEGER AS monsters FROM {images}), a AS (SELECT image_id + CASE WHEN image_id % 503 = 0 THEN 10000000 ELSE 0 END AS image_id, CASE WHEN image_id % 101 = 0 THEN 'val' ELSE split END AS split, scenario, (image_id % 5)::INTEGER AS monsters FROM {images})
    SELECT 'VAL-C1' AS rule_id, coalesce(p.image_id, a.image_id)::VARCHAR AS key, CASE WHEN p.image_id IS NULL THEN 'extra' ELSE 'missing' END AS detail FROM p FULL JOIN a USING (image_id) WHERE p.image_id IS NULL OR a.image_id IS NULL
    UNION ALL SELECT 'VAL-C9', p.image_id::VARCHAR, 'split' FROM p JOIN a USING (image_id) WHERE p.split <> a.split
    UNION ALL SELECT 'VAL-D8', image_id::VARCHAR, count(*)::VARCHAR FROM (SELECT a.image_id FROM {boxes} a JOIN {boxes} b ON a.image_id = b.image_id AND a.idx < b.idx AND a.class_id = 0 AND b.class_id = 0
      WHERE NOT (a.x + a.w + 48 <= b.x OR b.x + b.w + 48 <= a.x OR a.y + a.h + 48 <= b.y OR b.y + b.h + 48 <= a.y)) q GROUP BY image_id
    UNION ALL SELECT 'VAL-C12', image_id::VARCHAR, 'pets' FROM {boxes} WHERE class_id = 1 GROUP BY image_id HAVING count(*) <> count(DISTINCT mob_id)
    UNION ALL SELECT 'VAL-D9', image_id::VARCHAR, count(*)::VARCHAR FROM {boxes} WHERE class_id = 0 GROUP BY image_id HAVING count(*) > 5"""
)
def validate_scattered(spark, sf):
    i = F.col("image_id")
    boxes = view(spark, sf, "boxes")
    plan = view(spark, sf, "images").select("image_id", "split", "scenario", (i % 5).cast("int").alias("monsters"))
    actual = plan.withColumns({"image_id": i + F.when(i % 503 == 0, 10000000).otherwise(0), "split": F.when(i % 101 == 0, "val").otherwise(F.col("split"))})
    both = plan.join(actual.withColumnsRenamed({"split": "s", "scenario": "c", "monsters": "m"}), "image_id")
    crowded = v.layout.crowded_pairs(boxes.where("class_id = 0"), 48).groupBy("image_id").agg(F.count("*").alias("n"))
    pets = boxes.where("class_id = 1").groupBy("image_id").agg(F.collect_list("mob_id").alias("ids"))
    monsters = boxes.where("class_id = 0").groupBy("image_id").agg(F.count("*").alias("n"))
    return c.union_all(
        [
            v.unexpected(plan, actual, "VAL-C1", "image_id"),
            v.violations(both, "VAL-C9", i, (F.col("split") != F.col("s")) | (F.col("scenario") != F.col("c")) | (F.col("monsters") != F.col("m")), "split"),
            v.violations(crowded, "VAL-D8", i, F.lit(True), F.col("n")),
            v.violations(pets, "VAL-C12", i, F.size("ids") != F.size(F.array_distinct("ids")), "pets"),
            v.violations(monsters, "VAL-D9", i, F.col("n") > 5, F.col("n")),
        ]
    )


@query(
    """SELECT image_id || '/' || idx AS key, line_no, abs((x + w / 2) / 1280 - (x + w / 2 + CASE WHEN image_id % 37 = 0 THEN 1 ELSE 0 END) / 1280) <= 0.0000001 AS same FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY idx) - 1 AS line_no FROM {boxes}) q"""
)
def label_line_agreement(spark, sf):
    """Label lines against boxes by position, within a tolerance."""
    boxes = view(spark, sf, "boxes")
    moved = boxes.withColumn("x", F.col("x") + F.when(F.col("image_id") % 37 == 0, 1).otherwise(0))
    lines = labels.yolo_bodies(moved).select("image_id", F.posexplode(F.split("body", "\n")).alias("line_no", "line"))
    own = boxes.select("image_id", "idx", (F.col("idx") - 1).alias("line_no"), ((F.col("x") + F.col("w") / 2) / 1280).alias("cx"))
    joined = own.join(lines, ["image_id", "line_no"])
    got = F.element_at(F.split("line", " "), 2).cast("double")
    return joined.select(F.concat_ws("/", F.col("image_id").cast("string"), F.col("idx").cast("string")).alias("key"), "line_no", (F.abs(F.col("cx") - got) <= 1e-7).alias("same"))


def histogram_sql(rule: str, column: str) -> str:
    return f"""SELECT '{rule}' AS rule_id, k AS key, coalesce(n, 0) || ' of ' || coalesce(m, 0) AS detail FROM (SELECT {column}::VARCHAR AS k, count(*) AS n FROM a GROUP BY 1) f
      FULL JOIN (SELECT {column}::VARCHAR AS k, count(*) AS m FROM p GROUP BY 1) e USING (k) WHERE n IS DISTINCT FROM m"""


HISTOGRAMS = {"VAL-B5": "monsters", "VAL-B6": "players", "VAL-B7": "loot", "VAL-B8": "layout", "VAL-B9": "loot_layout"}
#: The scenarios of the review set of 100 images.
REVIEW = {"player_pet_monster": 70, "player_monster": 15, "player_pet": 8, "monster": 5, "background": 2}


@query(
    f"""WITH {LINES}, p AS (SELECT image_id, layout, (image_id % 4)::INTEGER AS monsters, (image_id % 3)::INTEGER AS players, (image_id % 5)::INTEGER AS loot, CASE WHEN image_id % 2 = 0 THEN 'pile' ELSE 'none' END AS loot_layout FROM {{images}}),
    b AS (SELECT image_id, count_if(class_id = 0) AS monsters, count_if(class_id = 1) AS players FROM {{boxes}} GROUP BY 1),
    a AS (SELECT image_id, CASE WHEN image_id % 307 = 0 THEN 'overlap' ELSE layout END AS layout, coalesce(b.monsters, 0)::INTEGER AS monsters, coalesce(b.players, 0)::INTEGER AS players,
      loot + CASE WHEN image_id % 409 = 0 THEN 1 ELSE 0 END AS loot, CASE WHEN image_id % 311 = 0 THEN 'line' ELSE loot_layout END AS loot_layout FROM p LEFT JOIN b USING (image_id)),
    r AS (SELECT CASE WHEN item < 69 THEN 'player_pet_monster' WHEN item < 85 THEN 'player_monster' WHEN item < 93 THEN 'player_pet' WHEN item < 98 THEN 'monster' ELSE 'other' END AS k FROM (SELECT DISTINCT item FROM {{items}} WHERE item < 100) q),
    w AS (SELECT unnest({list(REVIEW)}) AS k, unnest({list(REVIEW.values())}) AS m)
    SELECT 'VAL-A5' AS rule_id, key, line AS detail FROM y WHERE line IN ('7 0.1 0.2 0.3 0.4', '0 0.1 0.2 0.3', '1 0.1 1.2 0.3 0.4') UNION ALL SELECT 'VAL-A6', key, line FROM y WHERE line = '0 0.1 x 0.3 0.4'
    UNION ALL SELECT 'VAL-C8', split_part(key, '/', 1), min(line) FROM y WHERE line <> '0 0.1 0.2 0.3 0.4' GROUP BY ALL
    UNION ALL {" UNION ALL ".join(histogram_sql(r, c) for r, c in HISTOGRAMS.items())}
    UNION ALL SELECT 'VAL-B35', image_id || '/' || idx, '3' FROM {{boxes}} WHERE image_id % 59 = 0
    UNION ALL SELECT 'VAL-D2', k, coalesce(n, 0) || ' of ' || coalesce(m, 0) FROM (SELECT k, count(*) AS n FROM r GROUP BY 1) f FULL JOIN w USING (k) WHERE n IS DISTINCT FROM m
    UNION ALL SELECT 'VAL-D6', image_id || '/' || idx, 'mismatch' FROM {{boxes}} WHERE image_id % 37 = 0 OR image_id % 83 = 0"""
)
def validate_plan_counts(spark, sf):
    """Rules on lines of one class, histograms of the plan, hidden boxes, the review set and lines against boxes."""
    i, item = F.col("image_id"), F.col("item")
    boxes = view(spark, sf, "boxes")
    plan = view(spark, sf, "images").select("image_id", "layout", (i % 4).cast("int").alias("monsters"), (i % 3).cast("int").alias("players"), (i % 5).cast("int").alias("loot"), F.when(i % 2 == 0, "pile").otherwise("none").alias("loot_layout"))
    labelled = boxes.groupBy("image_id").agg(F.count_if(F.col("class_id") == 0).cast("int").alias("monsters"), F.count_if(F.col("class_id") == 1).cast("int").alias("players"))
    actual = plan.drop("monsters", "players").join(labelled, "image_id", "left").fillna(0, ["monsters", "players"])
    actual = actual.withColumns({"layout": F.when(i % 307 == 0, "overlap").otherwise(F.col("layout")), "loot": F.col("loot") + F.when(i % 409 == 0, 1).otherwise(0), "loot_layout": F.when(i % 311 == 0, "line").otherwise(F.col("loot_layout"))})
    line = F.when(i % 61 == 0, "7 0.1 0.2 0.3 0.4").when(i % 67 == 0, "0 0.1 0.2 0.3").when(i % 71 == 0, "1 0.1 1.2 0.3 0.4").when(i % 73 == 0, "0 0.1 x 0.3 0.4").otherwise("0 0.1 0.2 0.3 0.4")
    key = F.concat_ws("/", i.cast("string"), F.col("idx").cast("string"))
    rows = boxes.select(key.alias("key"), line.alias("line"))
    part = F.split("key", "/")
    bad = v.yolo_grammar(rows, "key", "line", "VAL-C8", "VAL-C8", 2).select("rule_id", part[0].alias("key"), "detail", part[1].cast("int").alias("place"))
    hidden = boxes.select(key.alias("key"), F.when(i % 59 == 0, F.array("x", "y", "w")).otherwise(F.array("x", "y", "w", "h")).alias("bbox"))
    scenario = F.when(item < 69, "player_pet_monster").when(item < 85, "player_monster").when(item < 93, "player_pet").when(item < 98, "monster").otherwise("other")
    review = view(spark, sf, "items").where("item < 100").select("item").distinct().select(scenario.alias("scenario"))
    agreed = spark.createDataFrame([(k,) for k, n in REVIEW.items() for _ in range(n)], "scenario string")
    moved = boxes.withColumns({"x": F.col("x") + F.when(i % 37 == 0, 1).otherwise(0), "h": F.col("h") + F.when(i % 83 == 0, 1).otherwise(0)})
    lines = labels.yolo_bodies(moved).select("image_id", F.posexplode(F.split("body", "\n")).alias("line_no", "line"))
    both = boxes.withColumn("line_no", F.col("idx") - 1).join(lines, ["image_id", "line_no"], "left")
    return c.union_all(
        [
            v.first_bad(v.yolo_grammar(rows, "key", "line", "VAL-A5", "VAL-A6", 1), "key", "rule_id"),
            v.first_bad(bad, "key", "place").drop("place"),
            *[v.histogram(actual, plan, rule, column) for rule, column in HISTOGRAMS.items()],
            v.violations(hidden, "VAL-B35", F.col("key"), F.size("bbox") != 4, F.size("bbox")),
            v.histogram(review, agreed, "VAL-D2", "scenario"),
            v.violations(both, "VAL-D6", key, v.line_differs("line"), "mismatch"),
        ]
    )
