"""Layouts, pairs of boxes and label files."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions import geometry as g
from quarry.functions import text as t
from quarry.operators import labels, layout
from quarry.operators.quota import split_indexes

from .registry import query
from .views import view

PAIRS = """p AS (SELECT a.image_id, a.idx AS i, b.idx AS j,
  greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) AS both_, a.w * a.h + b.w * b.h AS area
  FROM {boxes} a JOIN {boxes} b ON a.image_id = b.image_id AND a.idx < b.idx),
u AS (SELECT image_id, i, j, CASE WHEN area - both_ > 0 THEN both_::DOUBLE / (area - both_) ELSE 0 END AS iou FROM p)"""
MEASURES = PAIRS + """, m AS (SELECT image_id, count(*) AS pairs, max(iou) AS max_iou, count_if(iou < 0.05) AS low_pairs, count_if(iou >= 0.05) AS overlapping,
  count_if(iou BETWEEN 0.15 AND 0.45) AS mild, count_if(iou BETWEEN 0.35 AND 0.70) AS severe FROM u GROUP BY image_id),
n AS (SELECT image_id, count(*) AS n, (max(x + w) - min(x)) / 1280 AS span, count(DISTINCT foothold_id) AS footholds FROM {boxes} GROUP BY image_id),
z AS (SELECT n.*, coalesce(pairs, 0)::BIGINT AS pairs, coalesce(max_iou, 0.0)::DOUBLE AS max_iou, coalesce(low_pairs, 0)::BIGINT AS low_pairs, coalesce(overlapping, 0)::BIGINT AS overlapping, coalesce(mild, 0)::BIGINT AS mild, coalesce(severe, 0)::BIGINT AS severe
  FROM n LEFT JOIN m USING (image_id))"""
VALID = """CASE WHEN n < 2 THEN TRUE WHEN layout = 'distributed' THEN span >= 0.45 AND CASE WHEN n <= 5 THEN max_iou < 0.05 ELSE low_pairs / greatest(1, pairs) >= 0.8 END
  WHEN layout = 'clustered' THEN max_iou <= CASE WHEN multi_platform THEN 0.70 ELSE 0.45 END WHEN layout = 'overlap' THEN mild > 0 WHEN layout = 'severe_overlap' THEN severe > 0 ELSE TRUE END"""


@query(f"WITH {MEASURES} SELECT z.image_id, i.layout, z.n, z.overlapping, z.max_iou, z.span, z.footholds, {VALID} AS valid FROM z JOIN {{images}} i USING (image_id)")
def layout_verdicts(spark, sf):
    measures = layout.layout_measures(view(spark, sf, "boxes"))
    joined = measures.join(view(spark, sf, "images").select("image_id", "layout", "multi_platform"), "image_id")
    return joined.select("image_id", "layout", "n", "overlapping", "max_iou", "span", "footholds", layout.layout_valid().alias("valid"))


@query(f"WITH {PAIRS} SELECT image_id, i, j, iou FROM u WHERE iou >= 0.05")
def overlapping_box_pairs(spark, sf):
    return layout.box_pairs(view(spark, sf, "boxes")).where("iou >= 0.05")


@query(f"WITH {MEASURES} SELECT count(*) AS images, count_if(overlapping > 0) AS overlap_images, CASE WHEN count(*) > 0 THEN count_if(overlapping > 0) / count(*) ELSE 0 END AS ratio, count_if(overlapping > 0) / count(*) < 0.20 AS warning FROM z")
def overlap_image_ratio(spark, sf):
    m = layout.layout_measures(view(spark, sf, "boxes"))
    out = m.agg(F.count("*").alias("images"), F.count_if(F.col("overlapping") > 0).alias("overlap_images"))
    ratio = F.coalesce(F.try_divide("overlap_images", "images"), F.lit(0.0))
    return out.withColumn("ratio", ratio).withColumn("warning", F.col("ratio") < 0.20)


@query(
    """SELECT a.image_id, a.idx, coalesce(max(CASE WHEN b.image_id IS NULL THEN 0 ELSE
    greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) /
    (a.w * a.h + b.w * b.h - greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)))::DOUBLE END), 0)::DOUBLE AS max_target_iou
    FROM {boxes} a LEFT JOIN {boxes} b ON a.image_id = b.image_id AND b.class_id = 0 WHERE a.class_id = 1 GROUP BY a.image_id, a.idx"""
)
def hidden_max_target_iou(spark, sf):
    boxes = view(spark, sf, "boxes")
    return layout.max_target_iou(boxes.where("class_id = 1"), boxes.where("class_id = 0"))


@query(
    """SELECT a.image_id, a.idx AS i, b.idx AS j FROM {boxes} a JOIN {boxes} b ON a.image_id = b.image_id AND a.idx < b.idx
    WHERE NOT (a.x + a.w + 24 <= b.x OR b.x + b.w + 24 <= a.x OR a.y + a.h + 24 <= b.y OR b.y + b.h + 24 <= a.y)"""
)
def crowded_actor_pairs(spark, sf):
    return layout.crowded_pairs(view(spark, sf, "boxes"), 24)


@query(
    """SELECT image_id, string_agg(class_id || ' ' || printf('%.8f', (x + w / 2) / 1280) || ' ' || printf('%.8f', (y + h / 2) / 224) || ' ' || printf('%.8f', w / 1280) || ' ' || printf('%.8f', h / 224), chr(10) ORDER BY idx) AS body
    FROM {boxes} GROUP BY image_id"""
)
def yolo_files(spark, sf):
    return labels.yolo_bodies(view(spark, sf, "boxes"))


@query(
    """WITH s AS (SELECT image_id, split, row_number() OVER (PARTITION BY split ORDER BY image_id) AS coco_image_id FROM {images})
    SELECT split, coco_image_id, row_number() OVER (PARTITION BY split ORDER BY coco_image_id, idx) AS annotation_id, class_id + 1 AS category_id, x, y, w, h, w * h AS area FROM s JOIN {boxes} USING (image_id)"""
)
def coco_annotations(spark, sf):
    return labels.coco(view(spark, sf, "images"), view(spark, sf, "boxes"))[1]


@query("SELECT split, row_number() OVER (PARTITION BY split ORDER BY image_id) AS coco_image_id, image_id, 1280 AS width, 224 AS height FROM {images}")
def coco_images(spark, sf):
    return labels.coco_rows(view(spark, sf, "images"))


@query(
    """WITH s AS (SELECT image_id, split, row_number() OVER (PARTITION BY split ORDER BY image_id) AS own, CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 ELSE 2 END AS pos FROM {images})
    SELECT split, own AS image_in_split, row_number() OVER (ORDER BY pos, own) AS image_in_all, row_number() OVER (ORDER BY pos, own, idx) AS annotation_id, idx, 1 AS category_id FROM s JOIN {boxes} USING (image_id)
    """.replace("row_number() OVER (ORDER BY pos, own) AS image_in_all", "own + (SELECT count(*) FROM s q WHERE q.pos < s.pos) AS image_in_all")
)
def coco_global_ids(spark, sf):
    return labels.coco_global(view(spark, sf, "images"), view(spark, sf, "boxes"), ["train", "val", "test"])


@query(
    """SELECT image_id, idx, concat(CASE WHEN x - 30 < 0 THEN 'L' ELSE '' END, CASE WHEN x - 30 + w * 3 > 1280 THEN 'R' ELSE '' END, CASE WHEN y - 20 < 0 THEN 'T' ELSE '' END, CASE WHEN y - 20 + h * 3 > 224 THEN 'B' ELSE '' END) AS edge_sides,
    greatest(0, x - 30) AS clip_x, greatest(0, y - 20) AS clip_y, least(1280, x - 30 + w * 3) AS clip_right, least(224, y - 20 + h * 3) AS clip_bottom FROM {boxes}"""
)
def clipped_boxes(spark, sf):
    """Boxes moved and enlarged so that many leave the frame."""
    moved = view(spark, sf, "boxes").select("image_id", "idx", (F.col("x") - 30).alias("x"), (F.col("y") - 20).alias("y"), (F.col("w") * 3).alias("w"), (F.col("h") * 3).alias("h"))
    return moved.select(
        "image_id", "idx", g.edge_sides().alias("edge_sides"), F.greatest(F.lit(0), "x").alias("clip_x"), F.greatest(F.lit(0), "y").alias("clip_y"),
        F.least(F.lit(g.WIDTH), F.col("x") + F.col("w")).alias("clip_right"), F.least(F.lit(g.HEIGHT), F.col("y") + F.col("h")).alias("clip_bottom"),
    )


FAMILY = "CASE WHEN contains(scenario, 'dense') THEN 'dense' WHEN contains(scenario, 'edge') THEN 'edge' WHEN contains(scenario, 'occlusion') THEN 'occlusion' WHEN starts_with(scenario, 'negative_') THEN 'negative' WHEN scenario IN ('natural_sparse', 'natural_standard', 'multi_platform') THEN 'natural' ELSE 'clutter' END"


@query(
    f"""WITH s AS (SELECT image_id, split, scenario, row_number() OVER (PARTITION BY split ORDER BY image_id) - 1 AS split_index FROM {{images}})
    SELECT image_id, split, split_index, printf('%s_%06d', split, split_index) AS stem, {FAMILY} AS family FROM s"""
)
def stems_and_families(spark, sf):
    rows = split_indexes(view(spark, sf, "images"), order="image_id")
    return rows.select("image_id", "split", "split_index", t.stem(F.col("split"), F.col("split_index")).alias("stem"), t.scenario_family(F.col("scenario")).alias("family"))


@query(f"""SELECT split, {FAMILY} AS family, row_number() OVER (PARTITION BY split, {FAMILY} ORDER BY image_id) AS line_no, image_id AS name FROM {{images}}""")
def challenge_slices(spark, sf):
    """The lines of the slice files: names of a split and a family in order."""
    return labels.slice_lines(view(spark, sf, "images").withColumn("family", t.scenario_family(F.col("scenario"))), "image_id")


@query(
    f"""WITH c AS (SELECT split, {FAMILY} AS family, count(*) AS n FROM {{images}} GROUP BY ALL),
    f AS (SELECT * FROM (VALUES ('train'), ('val'), ('test')) a(split), (VALUES ('natural'), ('dense'), ('edge'), ('occlusion'), ('clutter'), ('negative')) b(family))
    SELECT f.split, f.family, coalesce(n, 0) AS n FROM f LEFT JOIN c USING (split, family)"""
)
def challenge_slice_sizes(spark, sf):
    """All slice files with their number of lines, empty ones too."""
    images = view(spark, sf, "images").withColumn("family", t.scenario_family(F.col("scenario")))
    return labels.slice_sizes(images, ["train", "val", "test"], list(t.FAMILIES))


@query(
    """SELECT image_id, idx, CASE WHEN starts_with(a, 'stand') THEN 'stand' WHEN starts_with(a, 'move') THEN 'move' WHEN starts_with(a, 'attack') THEN 'attack' ELSE a END AS family, regexp_matches(a, 'die|dead|death') AS dead
    FROM (SELECT image_id, idx, CASE action_no WHEN 0 THEN 'stand1' WHEN 1 THEN 'move' WHEN 2 THEN 'attack2' WHEN 3 THEN 'die1' WHEN 4 THEN 'skill' WHEN 5 THEN 'bodydeath' ELSE 'moveto' END AS a FROM {boxes}) q"""
)
def action_families(spark, sf):
    names = ["stand1", "Move", "attack2", "die1", "skill", "bodydeath", "moveTo"]
    a = F.element_at(F.array(*map(F.lit, names)), F.col("action_no") + 1)
    return view(spark, sf, "boxes").select("image_id", "idx", t.action_family(a, ("stand", "move", "attack")).alias("family"), F.lower(a).rlike(t.DEAD).alias("dead"))


@query(
    """SELECT image_id, idx, w >= 8 AND h >= 9 AND printf('%.4f', w / (w + h))::DOUBLE >= 0.3 AS admitted, printf('%.4f', w / (w + h))::DOUBLE AS fraction, printf('%.3f', w / h)::DOUBLE AS ground_error FROM {boxes}"""
)
def label_admission(spark, sf):
    fraction = t.decimals(F.col("w") / (F.col("w") + F.col("h")), 4).cast("double")
    out = view(spark, sf, "boxes").select("image_id", "idx", "w", "h", fraction.alias("fraction"), t.decimals(F.col("w") / F.col("h"), 3).cast("double").alias("ground_error"))
    return out.select("image_id", "idx", ((F.col("w") >= 8) & (F.col("h") >= 9) & (F.col("fraction") >= 0.3)).alias("admitted"), "fraction", "ground_error")


@query(
    """WITH r AS (SELECT image_id, idx, CASE WHEN w < 20 THEN 'too_small' WHEN x + w > 1200 THEN 'clipped' WHEN class_id = 1 AND h > 30 THEN 'wrong_class' WHEN foothold_id = 3 THEN 'no_foothold' ELSE 'accepted' END AS reason FROM {boxes})
    SELECT reason, count(*) AS n FROM r GROUP BY reason"""
)
def rejection_reasons(spark, sf):
    """A chain of acceptance tests, the first that fails names the reason."""
    return labels.first_failure(
        view(spark, sf, "boxes"),
        [("too_small", F.col("w") < 20), ("clipped", F.col("x") + F.col("w") > 1200), ("wrong_class", (F.col("class_id") == 1) & (F.col("h") > 30)), ("no_foothold", F.col("foothold_id") == 3)],
    ).groupBy("reason").agg(F.count("*").alias("n"))


MONSTERS = "(SELECT * FROM {boxes} WHERE class_id = 0)"
SCENES = f"""{MEASURES.replace('{boxes}', MONSTERS)}, d AS (SELECT image_id, count_if(iou BETWEEN 0.05 AND 0.25) AS moderate, count_if(iou BETWEEN 0.25 AND 0.65) AS extreme FROM u GROUP BY image_id),
c AS (SELECT image_id, count_if(class_id = 0) AS monsters, count_if(class_id = 1) AS players, count(*) - count(DISTINCT (class_id, mob_id, x)) AS repeated, count_if(class_id = 0 AND x + w > 1200 AND idx % 4 > 0) AS cut,
  count_if(class_id = 0 AND action_no IN (1, 2, 3)) AS covered, count_if(class_id = 0 AND h <= 14) AS small, count_if(class_id = 0 AND h >= 34) AS tall FROM {{boxes}} GROUP BY image_id),
s AS (SELECT i.image_id, CASE WHEN i.image_id % 17 = 0 THEN 'size_extreme' ELSE i.scenario END AS scenario, i.layout, i.multi_platform, c.*, z.n, z.span, z.max_iou, z.low_pairs, z.pairs, z.mild, z.severe, z.footholds, coalesce(d.moderate, 0) AS moderate, coalesce(d.extreme, 0) AS extreme,
  CASE WHEN i.image_id % 2 = 0 THEN 'small' ELSE 'large' END AS bucket FROM {{images}} i JOIN c ON i.image_id = c.image_id LEFT JOIN z ON i.image_id = z.image_id LEFT JOIN d ON i.image_id = d.image_id)"""


@query(
    f"""WITH {SCENES} SELECT image_id, CASE WHEN image_id % 37 = 0 OR image_id % 41 = 0 OR image_id % 43 = 0 THEN 'hidden' WHEN image_id % 47 = 0 THEN 'monsters' WHEN image_id % 3 = 0 AND image_id % 53 = 0 THEN 'players' WHEN repeated > 0 THEN 'repeated'
    WHEN (scenario = 'dense_moderate' AND moderate = 0) OR (scenario = 'dense_extreme' AND extreme = 0) THEN 'dense' WHEN contains(scenario, 'edge') AND monsters > 0 AND cut = 0 THEN 'edge' WHEN contains(scenario, 'occlusion') AND monsters > 0 AND covered = 0 THEN 'occlusion'
    WHEN monsters >= 2 AND NOT coalesce({VALID}, TRUE) THEN 'layout' WHEN multi_platform AND footholds < 2 THEN 'platform'
    WHEN scenario = 'size_extreme' AND ((bucket = 'small' AND small = 0) OR (bucket = 'large' AND tall = 0)) THEN 'size' ELSE 'accepted' END AS reason FROM s"""
)
def accepted_scenes(spark, sf):
    """The whole chain of tests of a rendered scene; the first that fails names the reason."""
    boxes, images = view(spark, sf, "boxes"), view(spark, sf, "images")
    i, monster = F.col("image_id"), F.col("class_id") == 0
    counts = boxes.groupBy("image_id").agg(
        F.count_if(monster).alias("monsters"), F.count_if(~monster).alias("players"), (F.count("*") - F.count_distinct("class_id", "mob_id", "x")).alias("repeated"),
        F.count_if(monster & (F.col("x") + F.col("w") > 1200) & (F.col("idx") % 4 > 0)).alias("cut"), F.count_if(monster & F.col("action_no").isin(1, 2, 3)).alias("covered"),
        F.count_if(monster & (F.col("h") <= 14)).alias("small"), F.count_if(monster & (F.col("h") >= 34)).alias("tall"),
    )
    own = boxes.where(monster)
    bands = layout.pair_bands(own, {"moderate": (0.05, 0.25), "extreme": (0.25, 0.65)})
    rows = images.join(counts, "image_id").join(layout.layout_measures(own), "image_id", "left").join(bands, "image_id", "left").fillna(0, ["moderate", "extreme"])
    rows = rows.withColumns(
        {
            "scenario": F.when(i % 17 == 0, "size_extreme").otherwise(F.col("scenario")), "bucket": F.when(i % 2 == 0, "small").otherwise("large"), "loot": F.lit(2), "hidden_loot": F.when(i % 37 == 0, 1).otherwise(2),
            "pets": F.lit(0), "hidden_pets": (i % 41 == 0).cast("int"), "lacking": (i % 43 == 0).cast("int"), "planned": F.col("monsters") + (i % 47 == 0).cast("int"),
            "planned_players": F.when(i % 3 == 0, F.col("players") + (i % 53 == 0).cast("int")),
        }
    )
    return labels.first_failure(rows, layout.acceptance()).select("image_id", "reason")


@query("""SELECT image_id, string_agg(idx::VARCHAR, ',' ORDER BY foothold_id, idx) AS draw_order FROM {boxes} GROUP BY image_id""")
def draw_order(spark, sf):
    """Layer order: depth, then index, a stable sort of each image's parts."""
    parts = F.array_sort(F.collect_list(F.struct("foothold_id", "idx")))
    return view(spark, sf, "boxes").groupBy("image_id").agg(F.array_join(F.transform(parts, lambda p: p["idx"].cast("string")), ",").alias("draw_order"))


@query("""SELECT image_id, idx, max(w) OVER (PARTITION BY image_id ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS widest_above FROM {boxes}""")
def occluders_above(spark, sf):
    """Running occluder: what lies above each part in draw order."""
    above = Window.partitionBy("image_id").orderBy("idx").rowsBetween(1, Window.unboundedFollowing)
    return view(spark, sf, "boxes").select("image_id", "idx", F.max("w").over(above).alias("widest_above"))
