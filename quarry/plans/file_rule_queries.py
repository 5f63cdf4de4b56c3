"""Validation rules on files, records, coverage and review sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as t
from quarry.operators import coverage as c
from quarry.operators import dedup
from quarry.operators import validate as v

from .registry import query
from .views import view

#: What a listing and the files' headers would show of a manifest, with planted faults.
HEADERS = """f AS (SELECT ordinal, sha256, CASE WHEN ordinal % 83 = 0 THEN 1279 ELSE 1280 END AS width, CASE WHEN ordinal % 91 = 0 THEN 'PNG' ELSE 'JPEG' END AS format, ordinal % 71 <> 0 AS decodes,
  CASE WHEN ordinal % 59 = 0 THEN 'x' ELSE sha256 END AS file_sha256, box_count + CASE WHEN ordinal % 47 = 0 THEN 1 ELSE 0 END AS lines, box_count, split, scenario FROM {manifest})"""


def headers(spark, sf):
    o = F.col("ordinal")
    return view(spark, sf, "manifest").select(
        "ordinal", "sha256", F.when(o % 83 == 0, 1279).otherwise(1280).alias("width"), F.when(o % 91 == 0, "PNG").otherwise("JPEG").alias("format"), (o % 71 != 0).alias("decodes"),
        F.when(o % 59 == 0, "x").otherwise(F.col("sha256")).alias("file_sha256"), (F.col("box_count") + F.when(o % 47 == 0, 1).otherwise(0)).alias("lines"), "box_count", "split", "scenario",
    )


RULES = {"A": ("VAL-A2", "VAL-A4", "VAL-A3", None, None, None), "B": ("VAL-B12", "VAL-B13", "VAL-B16", "VAL-B17", "VAL-B14", "VAL-B18"), "C": ("VAL-C3", "VAL-C3", "VAL-C5", "VAL-C5", "VAL-C4", "VAL-C7")}


def _sql() -> str:
    parts = []
    for image, label, size, kind, sha, lines in RULES.values():
        parts.append(f"SELECT '{image}' AS rule_id, ordinal::VARCHAR AS key, 'missing' AS detail FROM f WHERE ordinal % 37 = 0")
        parts.append(f"SELECT '{label}', ordinal::VARCHAR, 'missing' FROM f WHERE ordinal % 41 = 0")
        parts.append(f"SELECT '{size}', ordinal::VARCHAR, 'size' FROM f WHERE width <> 1280")
        if kind:
            parts.append(f"SELECT '{kind}', ordinal::VARCHAR, format FROM f WHERE format <> 'JPEG'")
            parts.append(f"SELECT '{sha}', ordinal::VARCHAR, 'sha256' FROM f WHERE file_sha256 <> sha256")
            parts.append(f"SELECT '{lines}', ordinal::VARCHAR, lines || ' of ' || box_count FROM f WHERE lines <> box_count")
    parts.append("SELECT 'VAL-C6', ordinal::VARCHAR, 'decode' FROM f WHERE NOT decodes")
    parts.append("SELECT 'VAL-D4', ordinal::VARCHAR, 'decode' FROM f WHERE NOT decodes OR width <> 1280")
    parts.append("SELECT 'VAL-D5', ordinal::VARCHAR, lines || ' of ' || box_count FROM f WHERE lines <> box_count")
    for rule in ("VAL-C4", "VAL-D3"):
        parts.append(f"SELECT '{rule}', ordinal::VARCHAR, 'copy' FROM (SELECT ordinal, row_number() OVER (PARTITION BY sha256 ORDER BY ordinal) AS r FROM f) q WHERE r > 1")
    return f"WITH {HEADERS} " + " UNION ALL ".join(parts)


@query(_sql())
def validate_files(spark, sf):
    """Files that are missing, of the wrong size or format, changed, or with another number of lines."""
    files = headers(spark, sf)
    key, o = F.col("ordinal"), F.col("ordinal")
    images, labels = files.where(o % 37 != 0), files.where(o % 41 != 0)
    of = F.concat_ws(" of ", F.col("lines").cast("string"), F.col("box_count").cast("string"))
    rows, frames = [], []
    for image, label, size, kind, sha, lines in RULES.values():
        frames += [v.missing_keys(files, images, image, "ordinal"), v.missing_keys(files, labels, label, "ordinal")]
        rows.append((size, F.col("width") != 1280, "size"))
        if kind:
            rows += [(kind, F.col("format") != "JPEG", F.col("format")), (sha, F.col("file_sha256") != F.col("sha256"), "sha256"), (lines, F.col("lines") != F.col("box_count"), of)]
    rows += [("VAL-C6", ~F.col("decodes"), "decode"), ("VAL-D4", ~F.col("decodes") | (F.col("width") != 1280), "decode"), ("VAL-D5", F.col("lines") != F.col("box_count"), of)]
    copies = [v.later_copies(files.select("ordinal", "sha256"), r, "sha256", "ordinal", "ordinal") for r in ("VAL-C4", "VAL-D3")]
    return c.union_all([*frames, v.row_rules(files, key, rows), *copies])


@query(
    """WITH d AS (SELECT image_id, split, scenario, map_id FROM {images}), k AS (SELECT count(*) AS maps FROM (SELECT DISTINCT map_id FROM d) q),
    h AS (SELECT count(DISTINCT b.ordinal) AS near FROM {signatures} a JOIN {signatures} b ON a.ordinal < b.ordinal WHERE bit_count(xor(a.sig, b.sig)) <= 2), n AS (SELECT count(*) AS n FROM {signatures}),
    s AS (SELECT split, family, count(*) FROM (VALUES ('train'), ('val'), ('test')) a(split), (VALUES ('natural'), ('dense'), ('edge'), ('occlusion'), ('clutter'), ('negative')) b(family) GROUP BY ALL)
    SELECT 'VAL-B2' AS rule_id, stem AS key, count(*)::VARCHAR AS detail FROM (SELECT split || '_' || image_id % 3000 AS stem FROM d) q GROUP BY stem HAVING count(*) > 1
    UNION ALL SELECT 'VAL-B11', 'dataset', maps || ' maps' FROM k WHERE maps <> 177
    UNION ALL SELECT 'VAL-B41', 'dataset', near::VARCHAR FROM h, n WHERE near / greatest(1, n) >= 0.005
    UNION ALL SELECT 'VAL-B42', 'dataset', checks || ' of ' || wanted FROM (SELECT (SELECT count(*) FROM d WHERE image_id % 700 = 0) AS checks, sum(least(n, 6)) AS wanted FROM (SELECT scenario, count(*) AS n FROM d GROUP BY scenario) q) w WHERE checks < wanted
    UNION ALL SELECT 'VAL-A1', split, 'missing' FROM (VALUES ('test')) m(split) UNION ALL SELECT 'VAL-B43', split, 'missing' FROM (VALUES ('test')) m(split)
    UNION ALL SELECT 'VAL-B44', split || '/' || family, 'missing' FROM s WHERE family = 'edge' OR (split = 'val' AND family = 'dense')
    UNION ALL SELECT 'VAL-C2', map_id::VARCHAR, count(DISTINCT split)::VARCHAR FROM d GROUP BY map_id HAVING count(DISTINCT split) > 1
    UNION ALL SELECT 'VAL-C10', i.image_id::VARCHAR, 'split' FROM d i LEFT JOIN (SELECT DISTINCT split, map_id FROM d WHERE image_id % 3 <> 0) m ON i.split = m.split AND i.map_id = m.map_id WHERE m.map_id IS NULL"""
)
def validate_records(spark, sf):
    """Rules on stems, maps, near copies, visual checks and files that every split must have."""
    images, sigs = view(spark, sf, "images"), view(spark, sf, "signatures")
    stems = images.select(F.concat_ws("_", "split", (F.col("image_id") % 3000).cast("string")).alias("stem"))
    maps = images.agg(F.count_distinct("map_id").alias("maps"))
    classes = dedup.signature_classes(sigs)
    near = dedup.earlier_match_ratio(sigs, classes, dedup.hamming_pairs(classes))
    wanted = images.groupBy("scenario").agg(F.count("*").alias("n")).agg(F.sum(F.least("n", F.lit(6))).alias("wanted"))
    checks = images.agg(F.count_if(F.col("image_id") % 700 == 0).alias("checks")).crossJoin(wanted)  # one row each
    splits = spark.createDataFrame([("train",), ("val",), ("test",)], "split string")
    files = splits.where("split <> 'test'")
    slices = splits.crossJoin(spark.createDataFrame([(f,) for f in t.FAMILIES], "family string")).select(F.concat_ws("/", "split", "family").alias("key"))  # eighteen rows
    listed = slices.where("key not like '%/edge' and key <> 'val/dense'")
    of_split = images.where("image_id % 3 <> 0").select("split", "map_id").distinct()
    return c.union_all(
        [
            v.repeated(stems, "VAL-B2", ["stem"]),
            v.single(spark, maps, "VAL-B11", F.col("maps") != 177, F.concat(F.col("maps").cast("string"), F.lit(" maps"))),
            v.single(spark, near, "VAL-B41", F.col("ratio") >= 0.005, F.col("near_rows")),
            v.single(spark, checks, "VAL-B42", F.col("checks") < F.col("wanted"), F.concat_ws(" of ", F.col("checks").cast("string"), F.col("wanted").cast("string"))),
            v.missing_keys(splits, files, "VAL-A1", "split"),
            v.missing_keys(splits, files, "VAL-B43", "split"),
            v.missing_keys(slices, listed, "VAL-B44", "key"),
            v.leakage(images, "VAL-C2"),
            v.violations(images.join(of_split, ["split", "map_id"], "left_anti"), "VAL-C10", F.col("image_id"), F.lit(True), "split"),
        ]
    )


@query(
    """WITH b AS (SELECT image_id, count_if(class_id = 0) AS monsters, count_if(class_id = 1) AS players, count(*) AS n, min(x) AS least_x, count(DISTINCT mob_id) AS mobs FROM {boxes} GROUP BY image_id),
    m AS (SELECT mob_id, action_no, count(*) AS n FROM {boxes} GROUP BY ALL), k AS (SELECT * FROM (SELECT unnest(range(40))::INTEGER AS mob_id) a, (SELECT unnest(range(8))::INTEGER AS action_no) c)
    SELECT 'VAL-B46' AS rule_id, mob_id || '/' || action_no AS key, coalesce(n, 0)::VARCHAR AS detail FROM k LEFT JOIN m USING (mob_id, action_no) WHERE action_no <> 3 AND coalesce(n, 0) < 20
    UNION ALL SELECT 'VAL-B47', mob_id || '/' || action_no, coalesce(n, 0)::VARCHAR FROM k LEFT JOIN m USING (mob_id, action_no) WHERE action_no = 3 AND coalesce(n, 0) < 400
    UNION ALL SELECT 'VAL-B48', 'dataset', sum(players)::BIGINT::VARCHAR FROM b HAVING sum(players) < 10000000 UNION ALL SELECT 'VAL-B50', 'dataset', count(*)::VARCHAR FROM {items} HAVING count(*) <> 7296
    UNION ALL SELECT 'VAL-C11', image_id::VARCHAR, n || ' of ' || (monsters + 1) FROM b WHERE n <> monsters + 1 UNION ALL SELECT 'VAL-C13', image_id::VARCHAR, 'loose' FROM b WHERE image_id % 43 = 0
    UNION ALL SELECT 'VAL-D1', 'dataset', count(*)::VARCHAR FROM b HAVING count(*) <> 100 UNION ALL SELECT 'VAL-D7', image_id::VARCHAR, 'outside' FROM b WHERE least_x < 5
    UNION ALL SELECT 'VAL-D10', image_id::VARCHAR, 'pets' FROM b WHERE n <> mobs UNION ALL SELECT 'VAL-D11', image_id::VARCHAR, 'incomplete' FROM b WHERE image_id % 53 = 0
    UNION ALL SELECT 'VAL-E2', image_id::VARCHAR, 'classes' FROM b WHERE monsters = 0 OR players = 0
    UNION ALL SELECT 'VAL-E1', 'dataset', (max(n) / min(n))::VARCHAR FROM (SELECT mob_id, count(*) AS n FROM {boxes} GROUP BY mob_id) q HAVING max(n) <= 5 * min(n)"""
)
def validate_reviews(spark, sf):
    """Coverage of frames, and the rules of review sets and patches (the patch rule lists a dataset that keeps it)."""
    boxes = view(spark, sf, "boxes")
    b = boxes.groupBy("image_id").agg(
        F.count_if(F.col("class_id") == 0).alias("monsters"), F.count_if(F.col("class_id") == 1).alias("players"), F.count("*").alias("n"), F.min("x").alias("least_x"), F.count_distinct("mob_id").alias("mobs")
    )
    every = spark.range(40).selectExpr("cast(id as int) mob_id").crossJoin(spark.range(8).selectExpr("cast(id as int) action_no"))  # 320 rows
    used = c.filled(boxes.select("mob_id", "action_no"), every, ["mob_id", "action_no"])
    frame = F.concat_ws("/", F.col("mob_id").cast("string"), F.col("action_no").cast("string"))
    i = F.col("image_id")
    ratio = boxes.groupBy("mob_id").agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.min("n").alias("least"))
    rules = [
        ("VAL-C11", F.col("n") != F.col("monsters") + 1, F.concat_ws(" of ", F.col("n").cast("string"), (F.col("monsters") + 1).cast("string"))), ("VAL-C13", i % 43 == 0, "loose"),
        ("VAL-D7", F.col("least_x") < 5, "outside"), ("VAL-D10", F.col("n") != F.col("mobs"), "pets"), ("VAL-D11", i % 53 == 0, "incomplete"), ("VAL-E2", (F.col("monsters") == 0) | (F.col("players") == 0), "classes"),
    ]
    return c.union_all(
        [
            v.below_minimum(used.where("action_no <> 3"), "VAL-B46", frame, 20),
            v.below_minimum(used.where("action_no = 3"), "VAL-B47", frame, 400),
            v.single(spark, b.agg(F.sum("players").alias("p")), "VAL-B48", F.col("p") < 10000000, F.col("p")),
            v.single(spark, view(spark, sf, "items").agg(F.count("*").alias("n")), "VAL-B50", F.col("n") != 7296, F.col("n")),
            v.row_rules(b, i, rules),
            v.single(spark, b.agg(F.count("*").alias("n")), "VAL-D1", F.col("n") != 100, F.col("n")),
            v.single(spark, ratio, "VAL-E1", F.col("most") <= 5 * F.col("least"), F.col("most") / F.col("least")),
        ]
    )
