"""Decoders, bundles and pixel work on files and sprites that are made from the tables' rows, so that SQL knows what must come out."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions import text as t
from quarry.operators import frames as fr
from quarry.operators import pixels
from quarry.sources import atlas, bundles, documents, files

from .registry import query
from .views import view


@query("SELECT map_id, foothold_id, x1, y1, x2, y2 FROM {footholds}")
def decoded_footholds(spark, sf):
    """Platforms written into binary documents, one for each map, and read back."""

    @F.pandas_udf("binary")
    def write(rows: pd.Series) -> pd.Series:
        def one(own) -> bytes:
            tree: dict = {}
            for r in own:
                tree.setdefault("0", {}).setdefault(str(r["foothold_id"] % 3), {})[str(r["foothold_id"])] = {c: int(r[c]) for c in ("x1", "y1", "x2", "y2")}
            return documents.encode("root", {"info": {"version": 5, "open": True, "rate": 0.5, "name": "map é", "at": (1.5, -2.0)}, "foothold": tree})

        return rows.map(one)

    own = F.collect_list(F.struct("foothold_id", "x1", "y1", "x2", "y2"))  # a map's platforms are few
    blobs = view(spark, sf, "footholds").groupBy(F.col("map_id").alias("asset")).agg(own.alias("rows")).select(F.col("asset").cast("string").alias("asset"), write("rows").alias("content"))
    inner = documents.decode_json(blobs).select(F.col("asset").alias("map_id"), F.get_json_object("json", "$.root").alias("json"))
    return documents.footholds(inner).select(*[F.col(c).cast("int").alias(c) for c in ("map_id", "foothold_id", "x1", "y1", "x2", "y2")])


#: Frames of an atlas: every fourth one stands for the frame before.
ATLAS = """f AS (SELECT category AS asset, (row_number() OVER (PARTITION BY category ORDER BY item) - 1)::INTEGER AS frame, item, 'Mob/' || printf('%07d', item) || '/stand/0' AS path, width, height FROM {items})"""
GUID = "substr(m, 7, 2) || substr(m, 5, 2) || substr(m, 3, 2) || substr(m, 1, 2) || substr(m, 11, 2) || substr(m, 9, 2) || substr(m, 15, 2) || substr(m, 13, 2) || substr(m, 17, 16)"


def atlas_frames_table(spark, sf):
    path = F.concat(F.lit("Mob/"), F.format_string("%07d", "item"), F.lit("/stand/0"))
    number = F.row_number().over(Window.partitionBy("category").orderBy("item")) - 1  # an atlas holds hundreds of frames
    return view(spark, sf, "items").select(F.col("category").alias("asset"), number.alias("frame"), "item", path.alias("path"), "width", "height")


def atlas_blobs(spark, sf):
    @F.pandas_udf("binary")
    def write(rows: pd.Series) -> pd.Series:
        def one(own) -> bytes:
            own = sorted(own, key=lambda r: r["frame"])
            boxes = [None if r["frame"] % 4 == 3 else (r["item"] % 500, r["item"] % 300, r["width"], r["height"]) for r in own]
            return atlas.encode([r["path"] for r in own], boxes, [r["frame"] - 1 for r in own], [(0.25 * (r["item"] % 5), 0.5) for r in own])

        return rows.map(one)

    rows = atlas_frames_table(spark, sf)
    per = rows.groupBy("asset").agg(F.collect_list(F.struct("frame", "item", "path", "width", "height")).alias("rows"), F.count("*").cast("int").alias("sprites"))
    return per.select("asset", write("rows").alias("content"), "sprites")


@query(
    f"""WITH {ATLAS}, k AS (SELECT *, md5(path) AS m FROM f)
    SELECT asset, frame, {GUID} AS name, CASE WHEN frame % 4 = 3 THEN -1 ELSE 0 END AS page, CASE WHEN frame % 4 = 3 THEN 0 ELSE item % 500 END AS x, CASE WHEN frame % 4 = 3 THEN 0 ELSE item % 300 END AS y,
    CASE WHEN frame % 4 = 3 THEN 0 ELSE width END AS w, CASE WHEN frame % 4 = 3 THEN 0 ELSE height END AS h, CASE WHEN frame % 4 = 3 THEN frame - 1 ELSE frame END AS target FROM k"""
)
def decoded_atlases(spark, sf):
    """Atlases written and read back, with what every frame stands for in the end."""
    found = atlas.decode_frames(atlas_blobs(spark, sf)).where("error is null")
    return found.join(atlas.resolved_aliases(found), ["asset", "frame"]).select("asset", "frame", "name", "page", "x", "y", "w", "h", "target")


@query(
    f"""WITH {ATLAS}, k AS (SELECT *, md5(path) AS m FROM f WHERE frame % 4 <> 3)
    SELECT asset, path, item % 500 AS x, item % 300 AS y, width AS w, height AS h, round_even(0.25 * (item % 5) * width, 0)::INTEGER AS origin_x, round_even(0.5 * height, 0)::INTEGER AS origin_y, 'z' || item % 3 AS z FROM k"""
)
def sprite_frames(spark, sf):
    """Sprite nodes meet the atlas frames they name; origins come from pivots."""
    nodes = atlas_frames_table(spark, sf).select("asset", "path", F.lit(7).alias("origin_x"), F.lit(9).alias("origin_y"), F.concat(F.lit("z"), F.col("item") % 3).alias("z"), "item")
    nodes = nodes.withColumn("key", t.guid_key(F.col("path")))
    found = atlas.decode_frames(atlas_blobs(spark, sf)).where("error is null and page >= 0")
    return fr.logical_frames(nodes, found).select("asset", "path", "x", "y", "w", "h", "origin_x", "origin_y", "z")


@query(
    f"""WITH {ATLAS} SELECT asset, 'a/b' || frame AS path, CASE WHEN frame % 5 = 4 THEN NULL WHEN frame % 5 = 3 THEN 'a/b' || (frame - 3) WHEN frame % 5 = 0 THEN 'a/b' || frame ELSE 'a/b' || (frame - frame % 5) END AS target FROM f"""
)
def linked_frames(spark, sf):
    """Links of frames followed to their pixels: chains of three, and circles, which lead nowhere."""
    n = F.col("frame")
    link = F.when(n % 5 == 0, None).when(n % 5 == 4, F.concat(F.lit("../a/./b"), n)).otherwise(F.concat(F.lit("../a/b"), n - 1))
    rows = atlas_frames_table(spark, sf).select("asset", F.concat(F.lit("a/b"), n).alias("path"), link.cast("string").alias("link"))
    return fr.resolved_links(rows)


@query(
    f"""WITH {ATLAS}, n AS (SELECT asset, max(item % 3) AS last FROM f GROUP BY asset), p AS (SELECT asset, unnest(range(last + 1))::INTEGER AS page FROM n)
    SELECT asset, page, regexp_replace(asset, '#', '_') || '_' || page || '.png' AS asset_key, page <> 2 AND EXISTS (SELECT 1 FROM f WHERE f.asset = p.asset AND f.item % 3 = p.page) AS found FROM p"""
)
def atlas_page_files(spark, sf):
    """The numbered page files that atlases need, found or not."""
    rows = atlas_frames_table(spark, sf).select("asset", (F.col("item") % 3).alias("page"))
    named = rows.withColumn("asset", F.concat(F.regexp_replace("asset", "#", "_"), F.lit(".img")))
    there = named.where("page <> 2").select(F.concat(F.regexp_replace("asset", r"\.img$", "_"), F.col("page"), F.lit(".png")).alias("asset_key")).distinct()
    found, missing = fr.atlas_pages(there, named)
    both = found.withColumn("found", F.lit(True)).unionByName(missing.withColumn("found", F.lit(False)))
    return both.select(F.regexp_replace(F.regexp_replace("asset", "_", "#"), r"\.img$", "").alias("asset"), "page", "asset_key", "found")


def nation_bundles(spark, sf):
    """A bundle for each nation, in all packings; every seventh is cut off."""

    @F.pandas_udf("binary")
    def write(keys: pd.Series, names: pd.Series) -> pd.Series:
        def one(k: int, name: str) -> bytes:
            made = bundles.packed_bundle([(f"{name}\\{i}", f"{name} {i} ".encode() * (40 + 13 * k)) for i in range(k % 4 + 1)], kind=k % 3, block=500, format=6 + k % 2, at_end=k % 5 == 0)
            return made[: len(made) // 2] if k % 7 == 6 else made

        return pd.Series([one(int(k), n) for k, n in zip(keys, names, strict=True)])

    n = view(spark, sf, "nation")
    return n.select(F.concat(F.lit("data/"), "n_name", F.lit(".bundle")).alias("path"), write("n_nationkey", "n_name").alias("content"), "n_nationkey", "n_name")


@query(
    """WITH n AS (SELECT n_nationkey AS k, n_name AS name FROM nation), e AS (SELECT k, name, unnest(range(k % 4 + 1)) AS i FROM n WHERE k % 7 <> 6)
    SELECT 'data/' || name || '.bundle' AS bundle, name || '/' || i AS asset_key, i::BIGINT AS path_id, 'serialized' AS type_name, FALSE AS failed FROM e
    UNION ALL SELECT 'data/' || name || '.bundle', NULL, NULL, NULL, TRUE FROM n WHERE k % 7 = 6"""
)
def bundle_index(spark, sf):
    """The index of all bundles, with those that cannot be read."""
    found, failed = fr.index_assets(nation_bundles(spark, sf), bundles.entries)
    rows = found.select("bundle", "asset_key", "path_id", "type_name", F.lit(False).alias("failed"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("asset_key", "string"), ("path_id", "long"), ("type_name", "string"))]
    return rows.unionByName(failed.select("bundle", *none, F.lit(True).alias("failed")))


@query(
    """WITH e AS (SELECT n_nationkey AS k, n_name AS name, unnest(range(n_nationkey % 4 + 1)) AS i FROM nation WHERE n_nationkey % 7 <> 6)
    SELECT name || '/' || i AS asset_key, (length(name || ' ' || i || ' ') * (40 + 13 * k))::BIGINT AS size, sha256(repeat(name || ' ' || i || ' ', (40 + 13 * k)::INTEGER)) AS sha256 FROM e"""
)
def bundle_files(spark, sf):
    """Every file of every bundle, unpacked block by block."""
    def run(batches):
        for pdf in batches:
            rows = []
            for content in pdf["content"]:
                for e, data in bundles.Bundle(bytes(content)).files():
                    rows.append((e.path.replace("\\", "/"), len(data), hashlib.sha256(data).hexdigest()))
            yield pd.DataFrame(rows, columns=["asset_key", "size", "sha256"])

    return nation_bundles(spark, sf).where("n_nationkey % 7 <> 6").select("content").mapInPandas(run, "asset_key string, size long, sha256 string")


@query(
    """WITH e AS (SELECT n_name AS name, unnest(range(n_nationkey % 4 + 1)) AS i FROM nation WHERE n_nationkey % 7 <> 6), w AS (SELECT n_name AS name, n_nationkey % 3 AS i FROM nation)
    SELECT 'data/' || w.name || '.bundle' AS bundle, w.i::BIGINT AS path_id, CASE WHEN e.name IS NOT NULL THEN w.name || '/' || w.i END AS asset_key FROM w LEFT JOIN e ON w.name = e.name AND w.i = e.i"""
)
def bundle_point_reads(spark, sf):
    """One entry of each bundle by its number."""
    index, _ = fr.index_assets(nation_bundles(spark, sf), bundles.entries)
    wanted = nation_bundles(spark, sf).select(F.col("path").alias("bundle"), (F.col("n_nationkey") % 3).cast("long").alias("path_id"))
    return files.point_read(index, wanted).select("bundle", "path_id", "asset_key")


#: Sprites: a canvas with a rectangle of one colour in it.
SPRITES = "p AS (SELECT item, 4 + item % 23 AS w, 3 + item % 17 AS h, item % 6 AS l, item % 4 AS t, CASE item % 3 WHEN 0 THEN 'c80a0a' WHEN 1 THEN '808080' ELSE 'ffe0c0' END AS rgb FROM {items})"


def sprites(spark, sf):
    """(path, height, width, pixels) of the sprite of each item, and its numbers."""

    @F.pandas_udf("binary")
    def draw(items: pd.Series) -> pd.Series:
        def one(i: int) -> bytes:
            out = np.zeros((3 + i % 17 + i % 4 + 2, 4 + i % 23 + i % 6 + 1, 4), np.uint8)
            out[i % 4 : i % 4 + 3 + i % 17, i % 6 : i % 6 + 4 + i % 23] = [(200, 10, 10, 255), (128, 128, 128, 255), (255, 224, 192, 255)][i % 3]
            return out.tobytes()

        return items.map(one)

    i = F.col("item")
    rows = view(spark, sf, "items").select("item", i.cast("string").alias("path"), (3 + i % 17 + i % 4 + 2).alias("height"), (4 + i % 23 + i % 6 + 1).alias("width"))
    return rows.withColumn("pixels", draw("item"))


@query(
    f"""WITH {SPRITES} SELECT item::VARCHAR AS path, w AS width, h AS height, (w * h)::BIGINT AS alpha_pixels, CASE WHEN rgb = 'c80a0a' THEN 1.0 ELSE 0.0 END::DOUBLE AS saturated,
    sha256(unhex(printf('%02x00%02x00', w, h) || repeat(rgb || 'ff', (w * h)::INTEGER))) AS digest FROM p"""
)
def sprite_digests(spark, sf):
    """Size, visible pixels, saturated share and digest of every sprite's visible part."""
    return pixels.digest_frames(sprites(spark, sf)).select("path", "width", "height", "alpha_pixels", "saturated", "digest")


#: A scene for each item on 64 by 48 pixels: its sprite, a wall in front of it and a hidden object, whose places follow from the item.
SCENES = f"""{SPRITES}, s AS (SELECT *, item % 70 - 8 + l AS x, item % 50 - 4 + t AS y, item % 64 AS wall FROM p),
v AS (SELECT *, greatest(0, x) AS x0, greatest(0, y) AS y0, least(64, x + w) AS x1, least(48, y + h) AS y1 FROM s),
o AS (SELECT *, greatest(0, x1 - x0) * greatest(0, y1 - y0) AS inside, greatest(0, least(x1, wall + 6) - greatest(x0, wall)) * greatest(0, least(y1, 30) - y0) AS behind FROM v),
r AS (SELECT *, inside / (w * h) AS clip, (inside - behind) / (w * h) AS seen, CASE WHEN inside > 0 THEN behind / inside ELSE 0 END AS covered FROM o)"""


def scenes(spark, sf, kind: str, quality: int | None = None, images: bool = True):
    i = F.col("item")
    own = view(spark, sf, "items").select(i.alias("scene"), F.lit(0).alias("layer"), F.lit(kind).alias("kind"), i.cast("string").alias("path"), (i % 70 - 8).alias("x"), (i % 50 - 4).alias("y"), F.lit(False).alias("flip"))
    wall = view(spark, sf, "items").select(i.alias("scene"), F.lit(1).alias("layer"), F.lit("front").alias("kind"), F.lit("wall").alias("path"), (i % 64).alias("x"), F.lit(0).alias("y"), (i % 2 == 0).alias("flip"))
    more = own.where("scene % 3 = 0").withColumn("kind", F.lit("npc")).withColumn("x", F.lit(0))  # drawn, never labelled
    wide = np.zeros((30, 6, 4), np.uint8) + np.array([0, 0, 0, 255], np.uint8)
    pictures = sprites(spark, sf).select("path", "height", "width", "pixels").unionByName(spark.createDataFrame([("wall", 30, 6, bytearray(wide.tobytes()))], "path string, height int, width int, pixels binary"))
    return pixels.render_scenes(own.unionByName(wall).unionByName(more), pictures, 64, 48, quality=quality, images=images)


SHARES = "printf('%.4f', clip)::DOUBLE AS clip_fraction, printf('%.4f', seen)::DOUBLE AS visible_fraction, printf('%.4f', covered)::DOUBLE AS occlusion_fraction"


@query(f"WITH {SCENES} SELECT item AS scene, x0 AS x, y0 AS y, x1 - x0 AS w, y1 - y0 AS h, {SHARES} FROM r WHERE x1 - x0 >= 4 AND y1 - y0 >= 4 AND clip >= 0.3 AND seen >= 0.3")
def scene_labels(spark, sf):
    """Labels of rendered scenes: what is inside, what is covered."""
    label = F.explode("labels").alias("l")
    return scenes(spark, sf, "target", images=False).select("scene", label).select("scene", "l.x", "l.y", "l.w", "l.h", "l.clip_fraction", "l.visible_fraction", "l.occlusion_fraction")


@query(f"WITH {SCENES} SELECT item AS scene, x0 AS x, y0 AS y, x1 - x0 AS w, y1 - y0 AS h, {SHARES}, 0.0::DOUBLE AS max_target_iou FROM r WHERE x1 > x0 AND y1 > y0")
def scene_hidden_objects(spark, sf):
    """Objects that stay unlabelled, with what is seen of them."""
    row = F.explode("hidden").alias("l")
    return scenes(spark, sf, "hidden", images=False).select("scene", row).select("scene", "l.x", "l.y", "l.w", "l.h", "l.clip_fraction", "l.visible_fraction", "l.occlusion_fraction", "l.max_target_iou")


@query("SELECT item AS scene, 'JPEG' AS format, 64 AS width, 48 AS height FROM {items}")
def scene_files(spark, sf):
    """Format and size in the files of rendered scenes."""
    h = F.hex("image")
    frame = F.regexp_extract(h, "FFC0[0-9A-F]{6}([0-9A-F]{8})", 1)
    number = lambda a: F.conv(F.substring(frame, a, 4), 16, 10).cast("int")
    ended = h.startswith("FFD8FF") & h.endswith("FFD9")
    return scenes(spark, sf, "target", 92).select("scene", F.when(ended, "JPEG").alias("format"), number(5).alias("width"), number(1).alias("height"))


@query(
    """WITH f AS (SELECT item, 20 + item % 60 AS body, 10 + item % 40 AS head, item % 9 AS gap, item % 7 = 6 AS headless FROM {items}), s AS (SELECT *, body + head + gap AS tall FROM f)
    SELECT item AS figure, NOT headless AND tall BETWEEN 35 + gap AND 180 AND gap < 3 AS complete, CASE WHEN NOT headless AND tall BETWEEN 35 + gap AND 180 AND gap < 3 THEN 10 ELSE 0 END AS width,
    CASE WHEN NOT headless AND tall BETWEEN 35 + gap AND 180 AND gap < 3 THEN tall ELSE 0 END AS height FROM s"""
)
def whole_figures(spark, sf):
    """Figures put together by their anchors; without a head, with too wide a gap or of a wrong size they are none."""

    def parts(batches):
        for pdf in batches:
            rows = []
            for i in pdf["item"]:
                body, head, gap = 20 + i % 60, 10 + i % 40, i % 9
                solid = lambda h, c: np.full((h, 10, 4), (c, 50, 50, 255), np.uint8).tobytes()
                rows.append((i, "stand/body", "body", body, 10, solid(body, 200), 0, 0, {"neck": {"x": 4, "y": 0}}))
                if i % 7 != 6:
                    rows.append((i, "stand/head", "head", head, 10, solid(head, 90), 0, 0, {"neck": {"x": 4, "y": head + gap}}))
            yield pd.DataFrame(rows, columns=["figure", "path", "z", "height", "width", "pixels", "origin_x", "origin_y", "anchors"])

    schema = "figure int, path string, z string, height int, width int, pixels binary, origin_x int, origin_y int, anchors map<string, struct<x:int,y:int>>"
    made = view(spark, sf, "items").select("item").mapInPandas(parts, schema)
    return pixels.figures(made, {"body": ("body",), "head": ("head",)}).select("figure", "complete", "width", "height")


@query(
    """SELECT item, ((4 * length(item::VARCHAR) - 1) * 2 + 4)::INTEGER AS width, 14 AS height, (4 * list_sum(list_transform(string_split(item::VARCHAR, ''), lambda c: [12, 8, 11, 11, 9, 11, 12, 7, 13, 12][c::INTEGER + 1])))::BIGINT AS coloured FROM {items}"""
)
def number_sprites(spark, sf):
    """Numbers drawn as sprites: their size and the pixels of their digits."""

    @F.pandas_udf("width int, height int, coloured long")
    def draw(items: pd.Series) -> pd.DataFrame:
        made = [pixels.number_sprite(str(i), scale=2, colour=(255, 188, 32)) for i in items]
        return pd.DataFrame({"width": [m.shape[1] for m in made], "height": [m.shape[0] for m in made], "coloured": [int((m[..., 0] == 255).sum()) for m in made]})

    return view(spark, sf, "items").select("item", draw("item").alias("m")).select("item", "m.*")


LIGHT = "(ARRAY[0.55, 0.70, 1.25, 1.40])[item % 4 + 1]::DOUBLE"


@query(f"SELECT item, least(255, round_even((item % 256) * {LIGHT}, 0))::INTEGER AS bright, round_even((item % 256) * (1 - 0.25::DOUBLE), 0)::INTEGER AS faded, 255 AS alpha FROM {{items}}")
def lit_sprites(spark, sf):
    """Brightness by a factor and a blend towards black; alpha stays."""

    @F.pandas_udf("bright int, faded int, alpha int")
    def draw(items: pd.Series) -> pd.DataFrame:
        rows = []
        for i in items:
            image = np.full((1, 1, 4), (i % 256, 0, 0, 255), np.uint8)
            rows.append((int(pixels.lit(image, (0.55, 0.70, 1.25, 1.40)[i % 4])[0, 0, 0]), int(pixels.faded(image, 0.25)[0, 0, 0]), int(pixels.lit(image, 0.55)[0, 0, 3])))
        return pd.DataFrame(rows, columns=["bright", "faded", "alpha"])

    return view(spark, sf, "items").select("item", draw("item").alias("m")).select("item", "m.*")
