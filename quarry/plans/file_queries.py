"""Files of a small dataset, one sample for each nation: written to the shared folder, read again, and compared with the rows they came from."""

from __future__ import annotations

import uuid
import zipfile

import numpy as np
import pandas as pd
import yaml
from pyspark.sql import functions as F

from quarry.operators import frames, labels, report
from quarry.operators.jpeg import jpeg
from quarry.operators.quota import running
from quarry.operators.store import remembering, shared_dir
from quarry.sources import files, sinks

from .registry import query
from .views import view

NATIONS = "n AS (SELECT n_nationkey AS k, n_name AS name, CASE n_regionkey % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split, printf('s_%06d', n_nationkey) AS stem FROM nation)"


def nations(spark, sf):
    k = F.col("n_nationkey")
    split = F.when(F.col("n_regionkey") % 3 == 0, "train").when(F.col("n_regionkey") % 3 == 1, "val").otherwise("test")
    return view(spark, sf, "nation").select(k.alias("k"), F.col("n_name").alias("name"), split.alias("split"), F.format_string("s_%06d", k).alias("stem"))


def folder(spark) -> str:
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}"


@query(
    f"""WITH {NATIONS}, l AS (SELECT *, unnest(range(k % 4)) AS line_no FROM n)
    SELECT split || '/' || stem || '.txt' AS file, line_no::INTEGER AS line_no, (line_no % 2) || ' 0.5 0.25 0.' || (10 + k) || ' 0.125' AS line FROM l"""
)
def label_files(spark, sf):
    """Label files of every sample, written one by one and read again line by line."""
    n = F.col("k")
    lines = F.transform(F.sequence(F.lit(1), n % 4), lambda i: F.concat(((i - 1) % 2).cast("string"), F.lit(" 0.5 0.25 0."), (10 + n).cast("string"), F.lit(" 0.125")))
    body = F.when(n % 4 == 0, "").otherwise(F.array_join(lines, "\n"))
    at = folder(spark)
    sinks.layout_folders(at)
    sinks.write_label_files(nations(spark, sf).select("split", "stem", body.alias("body")), f"{at}/labels")
    return files.label_lines(spark, f"{at}/labels").select(F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias("file"), "line_no", "line")


@query(f"WITH {NATIONS} SELECT split || '/' || stem || '.txt' AS file, CASE WHEN k % 4 = 0 THEN 0 ELSE (k % 4) * 5 - 1 END::BIGINT AS length FROM n")
def listed_files(spark, sf):
    """Files of a folder with their lengths, empty ones too."""
    body = F.when(F.col("k") % 4 == 0, "").otherwise(F.array_join(F.array_repeat(F.lit("0 .5"), (F.col("k") % 4).cast("int")), "\n"))
    at = folder(spark)
    sinks.write_label_files(nations(spark, sf).select("split", "stem", body.alias("body")), at)
    return files.listing(spark, at, "*.txt").select(F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias("file"), "length")


@query(f"WITH {NATIONS} SELECT split || '/' || stem || '.jpg' AS file, 'JPEG' AS format, (16 + k)::INTEGER AS width, (9 + k % 7)::INTEGER AS height FROM n")
def image_files(spark, sf):
    """Images written as JPEG files, and what their headers say."""

    @F.pandas_udf("binary")
    def image(keys: pd.Series) -> pd.Series:
        draw = remembering(lambda h, w: jpeg(np.full((h, w, 3), (200, 90, 30), np.uint8)))
        return keys.map(lambda k: draw(9 + int(k) % 7, 16 + int(k)))

    at = folder(spark)
    sinks.write_images(nations(spark, sf).select("split", "stem", image("k").alias("image")), at)
    return files.image_headers(spark, at, "*.jpg").select(F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias("file"), "format", "width", "height")


@query(f"WITH {NATIONS} SELECT stem, split, name, 2::BIGINT AS records FROM n WHERE k % 5 <> 0 UNION ALL SELECT stem, split, name, 1 FROM n WHERE k % 5 = 0")
def manifest_appends(spark, sf):
    """A manifest of JSON lines that is appended to, read with its schema."""
    at, rows = folder(spark), nations(spark, sf).select("split", "stem", "name")
    sinks.write_manifest(rows, at)
    sinks.write_manifest(nations(spark, sf).where("k % 5 <> 0").select("split", "stem", "name"), at)
    return files.manifest(spark, at, "stem string, name string, split string").groupBy("stem", "split", "name").agg(F.count("*").alias("records"))


@query(f"WITH {NATIONS} SELECT 'instances_' || split || '.json' AS file, row_number() OVER (PARTITION BY split ORDER BY k) AS image_id, stem || '.jpg' AS file_name, k::DOUBLE AS x, (k + 4)::DOUBLE AS w FROM n")
def coco_files(spark, sf):
    """COCO documents of all splits, written as files and read again, images with their boxes."""
    ids = running(nations(spark, sf), "split", "k", {"before": F.lit(1)}).withColumn("coco_image_id", F.col("before") + 1)
    images = ids.select("split", "coco_image_id", F.concat("stem", F.lit(".jpg")).alias("file_name"), F.lit(1280).alias("width"), F.lit(224).alias("height"))
    w = F.col("k") + 4
    boxes = ids.select("split", "coco_image_id", F.col("coco_image_id").alias("annotation_id"), F.lit(1).alias("category_id"), F.col("k").alias("x"), F.lit(3).alias("y"), w.alias("w"), F.lit(5).alias("h"), (w * 5).alias("area"))
    at = folder(spark)
    documents = sinks.coco_documents(images, boxes, ["monster"])
    documents.select(F.col("split").alias("part"), F.concat(F.lit("instances_"), "split", F.lit(".json")).alias("file"), F.col("document").alias("value")).repartition("part").write.partitionBy("part", "file").text(at)
    image, box = files.coco(spark, f"{at}/*/*/*.txt")
    own = lambda df: df.withColumn("file", F.concat(F.lit("instances_"), F.regexp_extract("path", "part=([a-z]+)", 1), F.lit(".json")))
    image, box = own(image), own(box)
    return image.join(box.select("file", F.col("image_id").alias("id"), F.col("bbox")[0].alias("x"), F.col("bbox")[2].alias("w")), ["file", "id"]).select("file", F.col("id").alias("image_id"), "file_name", "x", "w")


@query(
    f"""WITH {NATIONS} SELECT 'slice' AS kind, split || '/' || CASE k % 3 WHEN 0 THEN 'dense' WHEN 1 THEN 'edge' ELSE 'natural' END AS key, string_agg(k::VARCHAR, ',' ORDER BY k) AS value FROM n GROUP BY ALL"""
)
def slice_files(spark, sf):
    """Slice files read again, in the order of their lines."""
    family = F.when(F.col("k") % 3 == 0, "dense").when(F.col("k") % 3 == 1, "edge").otherwise("natural")
    at = folder(spark)
    sinks.write_slices(labels.slice_lines(nations(spark, sf).withColumn("family", family), "k"), at)
    rows = spark.read.schema("value string, split string, family string").text(at)
    order = F.array_sort(F.collect_list(F.struct(F.col("value").cast("int").alias("n"), "value")))
    return rows.groupBy(F.lit("slice").alias("kind"), F.concat_ws("/", "split", "family").alias("key")).agg(F.array_join(F.transform(order, lambda r: r["value"]), ",").alias("value"))


CONFIG = """client_root: a
output_root: b
cache_dir: c
seed: 7
image: {width: 1280, height: 224}
splits: {train: 8, val: 1, test: 1}
"""


@query(
    """VALUES ('config', 'seed', '7'), ('config', 'splits', '10'), ('config', 'without seed', 'refused'), ('config', 'wrong size', 'refused'), ('catalog', 'version', '1.14.4'), ('catalog', 'none', 'unknown'),
    ('data.yaml', 'train', 'base/images/train+patch/images/train'), ('data.yaml', 'names', 'monster,player'), ('index', 'first', 'none'), ('index', 'written', '25'), ('index', 'other version', 'none'), ('bundles', 'all there', 'true'), ('bundles', 'one gone', 'false'),
    ('selection', 'maps', '3'), ('selection', 'without test', 'refused'), ('plan', 'rows', '7'), ('preview', 'files', 'README.txt,a.jpg,index.html'), ('disk', 'too little', 'refused')"""
)
def dataset_documents(spark, sf):
    """Configurations, versions, indexes and sidecars: what is read, and what is refused."""
    at = sinks.mounted(folder(spark))
    at.mkdir(parents=True)
    put = lambda name, text: (at / name).write_text(text, encoding="utf-8")
    rows: list[tuple[str, str, str]] = []

    def refused(kind: str, key: str, call) -> None:
        try:
            call()
            rows.append((kind, key, "taken"))
        except (ValueError, OSError):
            rows.append((kind, key, "refused"))

    put("a.yml", CONFIG)
    put("b.yml", CONFIG.replace("seed: 7\n", ""))
    put("c.yml", CONFIG.replace("224", "200"))
    config = files.load_config(at / "a.yml")
    rows += [("config", "seed", str(config["seed"])), ("config", "splits", str(sum(config["splits"].values())))]
    refused("config", "without seed", lambda: files.load_config(at / "b.yml"))
    refused("config", "wrong size", lambda: files.load_config(at / "c.yml"))
    names = spark.createDataFrame([("x/catalog_1.14.2.bin",), ("x/catalog_1.14.4.bin",), ("x/other",)], "path string")
    rows += [("catalog", "version", files.catalog_version(names).first().version), ("catalog", "none", files.catalog_version(names.limit(0)).first().version)]
    sinks.data_yaml(at / "data.yaml", ["base", "patch"], ["monster", "player"])
    data = yaml.safe_load((at / "data.yaml").read_text())
    rows += [("data.yaml", "train", "+".join(data["train"])), ("data.yaml", "names", ",".join(data["names"].values()))]
    index, n = f"file://{at}/index", nations(spark, sf)
    count = lambda df: "none" if df is None else str(df.count())
    rows.append(("index", "first", count(files.stored_index(spark, index))))
    sinks.write_index(n, index, files.INDEX_VERSION)
    rows.append(("index", "written", count(files.stored_index(spark, index))))
    sinks.write_index(n, index + "2", files.INDEX_VERSION + 1)
    rows.append(("index", "other version", count(files.stored_index(spark, index + "2"))))
    bundles = n.select(F.concat("name", F.lit(".bundle")).alias("bundle"))
    there = n.select(F.concat(F.lit("x/"), "name", F.lit(".bundle")).alias("path"), "k")
    rows += [("bundles", "all there", str(files.reusable(bundles, there)).lower()), ("bundles", "one gone", str(files.reusable(bundles, there.where("k <> 3"))).lower())]
    put("maps.json", '{"splits": {"train": ["1"], "val": ["2"], "test": ["3"]}}')
    put("some.json", '{"splits": {"train": ["1"], "val": ["2"], "test": []}}')
    rows.append(("selection", "maps", str(files.shared_splits(spark, f"file://{at}/maps.json").count())))
    refused("selection", "without test", lambda: files.shared_splits(spark, f"file://{at}/some.json"))
    put("plan.json", '{"schedule_sha256": "x", "rows": 7}')
    rows.append(("plan", "rows", str(files.sidecar(spark, f"file://{at}/plan.json", "schedule_sha256 string, rows int").first().rows)))
    made = sinks.write_preview(at / "preview", {"a.jpg": jpeg(np.zeros((8, 8, 3), np.uint8))}, "Preview", "One image.")
    with zipfile.ZipFile(made) as z:
        rows.append(("preview", "files", ",".join(sorted(x.rsplit("/", 1)[1] for x in z.namelist()))))
    refused("disk", "too little", lambda: sinks.enough_disk(at, 1e12))
    return spark.createDataFrame(rows, "col0 string, col1 string, col2 string")


@query(
    """SELECT map_id, map_key FROM (SELECT printf('%09d', s_suppkey * 1000037) AS map_id, CASE WHEN s_suppkey % 4 = 0 THEN '/Map/Event/' ELSE '/Map/Map/' END || s_suppkey AS map_key, s_suppkey AS k FROM supplier) q
    WHERE (map_id::BIGINT BETWEEN 1000000 AND 5000200 OR map_id::BIGINT BETWEEN 7000000 AND 60000000) AND NOT starts_with(map_id, '0090') AND k % 4 <> 0 AND k % 1000 <> 1"""
)
def picked_maps(spark, sf):
    """Maps by ranges of ids, without a prefix, without a hint in the key, of a list."""
    k = F.col("s_suppkey")
    maps = view(spark, sf, "supplier").select(
        F.format_string("%09d", k * 1000037).alias("map_id"), F.concat(F.when(k % 4 == 0, "/Map/Event/").otherwise("/Map/Map/"), k.cast("string")).alias("map_key"), k.alias("k")
    )
    listed = maps.where("k % 1000 <> 1").select("map_id")  # an include list, as a table
    picked = files.pick_maps(maps, [(1000000, 5000200), (7000000, 60000000)], without=("0090",), hints=("EVENT",))
    return picked.join(listed, "map_id", "left_semi").select("map_id", "map_key")


@query(
    """WITH m AS (SELECT map_id, count_if(kind = 'm') AS mobs, CASE map_id % 5 WHEN 0 THEN 2 WHEN 1 THEN NULL ELSE 0 END AS field_type, CASE WHEN map_id % 7 = 0 THEN 60 END AS time_limit FROM {spawns} GROUP BY map_id),
    f AS (SELECT map_id, count(*) AS footholds FROM {footholds} GROUP BY map_id) SELECT map_id FROM m JOIN f USING (map_id) WHERE mobs > 0 AND footholds > 0 AND coalesce(field_type, 0) = 0 AND coalesce(time_limit, 0) = 0"""
)
def normal_maps(spark, sf):
    """Maps with monsters and platforms, of no special kind and without a time limit."""
    mobs = view(spark, sf, "spawns").groupBy("map_id").agg(F.count_if(F.col("kind") == "m").alias("mobs"))
    lines = view(spark, sf, "footholds").groupBy("map_id").agg(F.count("*").alias("footholds"))
    m = F.col("map_id")
    kinds = mobs.join(lines, "map_id", "left").fillna(0, ["footholds"]).withColumns({"field_type": F.when(m % 5 == 0, 2).when(m % 5 != 1, 0), "time_limit": F.when(m % 7 == 0, 60)})
    return files.normal_maps(kinds).select("map_id")


@query(
    """SELECT user_id % 9 AS asset, event_type AS kind, 'e' || user_id % 2 AS error, arg_max(value, event_id) AS detail, count(*) AS times FROM {events} GROUP BY ALL"""
)
def missing_assets(spark, sf):
    """Assets that were not found, one row for each problem, the last detail."""
    e = view(spark, sf, "events")
    rows = e.select((F.col("user_id") % 9).alias("asset"), F.col("event_type").alias("kind"), F.concat(F.lit("e"), F.col("user_id") % 2).alias("error"), F.col("event_id").alias("ordinal"), F.col("value").alias("detail"))
    return report.missing_assets(rows)


@query(
    """WITH r AS (SELECT user_id AS sample, CASE WHEN event_type = 'purchase' AND event_id % 50 = 0 THEN 'accepted' ELSE event_type END AS reason FROM {events}), c AS (SELECT sample, reason, count(*) AS n FROM r GROUP BY ALL)
    SELECT sample, sum(n)::BIGINT AS attempts, '{' || string_agg('"' || reason || '":' || n, ',' ORDER BY reason) || '}' AS reasons FROM c GROUP BY sample HAVING NOT bool_or(reason = 'accepted')""".replace("'{'", "chr(123)").replace("'}'", "chr(125)")
)
def failed_samples(spark, sf):
    """Samples that used up their attempts, with the reasons."""
    e = view(spark, sf, "events")
    reason = F.when((F.col("event_type") == "purchase") & (F.col("event_id") % 50 == 0), "accepted").otherwise(F.col("event_type"))
    return report.failed_samples(e.select(F.col("user_id").alias("sample"), reason.alias("reason")))


@query(
    """WITH a AS (SELECT 'mob' AS dim, (mob_id)::VARCHAR AS key, count(*) AS n FROM {boxes} GROUP BY ALL), b AS (SELECT 'mob' AS dim, (mob_id)::VARCHAR AS key, count(*) AS n FROM {boxes} WHERE class_id = 1 OR mob_id % 7 = 0 GROUP BY ALL)
    SELECT dim, key, (a.n - coalesce(b.n, 0))::BIGINT AS n FROM a LEFT JOIN b USING (dim, key) WHERE a.n > coalesce(b.n, 0)"""
)
def counters_rolled_back(spark, sf):
    """Use counters with the uses of dropped images taken back; what falls to zero is left out."""
    boxes = view(spark, sf, "boxes")
    count = lambda df: df.groupBy(F.lit("mob").alias("dim"), F.col("mob_id").cast("string").alias("key")).agg(F.count("*").alias("n"))
    return report.combined_counters(count(boxes), count(boxes.where("class_id = 1 or mob_id % 7 = 0")), -1)


@query(
    """WITH f AS (SELECT category, saturation, item, row_number() OVER (PARTITION BY category ORDER BY height DESC, item) AS r FROM {items}), b AS (SELECT category, min(r) AS r FROM f GROUP BY category)
    SELECT count(DISTINCT category) AS pets, TRUE AS distinct_digests FROM f WHERE category IN (SELECT category FROM b)"""
)
def pet_catalogue(spark, sf):
    """Each pet's first frame whose picture no other pet took: one for each, all different."""
    rows = view(spark, sf, "items").select("category", F.concat_ws("x", "saturation", "width").alias("digest"), "height", "item")
    chosen = frames.first_unseen(rows, "category", "digest", ["height", "item"])
    return chosen.agg(F.count("*").alias("pets"), (F.count("*") == F.count_distinct("digest")).alias("distinct_digests"))


@query(
    """WITH v AS (SELECT 'R' || class_id AS rule_id, image_id::VARCHAR AS key, idx::VARCHAR AS detail FROM {boxes}), r AS (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY key, detail) AS r FROM v),
    k AS (SELECT rule_id, string_agg(DISTINCT key, ',' ORDER BY key) AS keys FROM r WHERE r <= 100 GROUP BY rule_id) SELECT rule_id, n, keys FROM (SELECT rule_id, count(*) AS n FROM v GROUP BY rule_id) c JOIN k USING (rule_id)"""
)
def violation_report(spark, sf):
    """How often each rule is broken, with the keys of the first hundred cases."""
    b = view(spark, sf, "boxes").select(F.concat(F.lit("R"), "class_id").alias("rule_id"), F.col("image_id").cast("string").alias("key"), F.col("idx").cast("string").alias("detail"))
    return report.validation_report(b).select("rule_id", "n", F.array_join("keys", ",").alias("keys"))
