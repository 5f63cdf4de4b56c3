"""Label files as tables: YOLO bodies, COCO images and annotations, slices, admission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import geometry as g
from quarry.functions import text as t

from .quota import running


def yolo_bodies(boxes: DataFrame, width: int = g.WIDTH, height: int = g.HEIGHT) -> DataFrame:
    """(image_id, body): one line per box in index order, no newline at the end. An image's boxes are few."""
    line = t.yolo_line(F.col("class_id"), F.col("x"), F.col("y"), F.col("w"), F.col("h"), width, height)
    rows = boxes.select("image_id", F.struct("idx", line.alias("line")).alias("r")).groupBy("image_id").agg(F.array_sort(F.collect_list("r")).alias("rows"))
    return rows.select("image_id", F.array_join(F.transform("rows", lambda r: r["line"]), "\n").alias("body"))


def numbered(images: DataFrame, boxes: DataFrame, order: str = "image_id") -> DataFrame:
    """images with n, images_before and boxes_before, counted inside their split."""
    counted = images.join(boxes.groupBy("image_id").agg(F.count("*").alias("n")), "image_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return running(counted, "split", order, {"images_before": F.lit(1), "boxes_before": F.col("n")})


def coco(images: DataFrame, boxes: DataFrame, order: str = "image_id") -> tuple[DataFrame, DataFrame]:
    """(images, annotations) with ids that start at 1 in each split; category is the class plus one."""
    ids = numbered(images, boxes, order).withColumn("coco_image_id", F.col("images_before") + 1)
    rows = ids.select("split", "coco_image_id", "boxes_before", "image_id").join(boxes, "image_id")
    number = F.col("boxes_before") + F.row_number().over(Window.partitionBy("image_id").orderBy("idx"))
    annotations = rows.select("split", "coco_image_id", number.alias("annotation_id"), (F.col("class_id") + 1).alias("category_id"), "x", "y", "w", "h", (F.col("w") * F.col("h")).alias("area"))
    return coco_rows(images, order), annotations


def coco_rows(images: DataFrame, order: str = "image_id") -> DataFrame:
    """The images section alone, which needs no boxes."""
    ids = running(images, "split", order, {"before": F.lit(1)})
    return ids.select("split", (F.col("before") + 1).alias("coco_image_id"), "image_id", F.lit(g.WIDTH).alias("width"), F.lit(g.HEIGHT).alias("height"))


def coco_global(images: DataFrame, boxes: DataFrame, splits: list[str], order: str = "image_id") -> DataFrame:
    """Annotations numbered across splits in the given order; images of the joint file are shifted by the splits before.

    Numbers are a split's offset plus the place inside the split."""
    position = F.array_position(F.array(*map(F.lit, splits)), F.col("split")).cast("int")
    ids = numbered(images, boxes, order).withColumn("pos", position)
    before = Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)  # one row a split
    sizes = ids.groupBy("pos").agg(F.sum("n").alias("n"), F.count("*").alias("m"))
    offsets = sizes.select("pos", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("all_boxes"), F.coalesce(F.sum("m").over(before), F.lit(0)).alias("all_images"))
    rows = ids.join(boxes.select("image_id", "idx"), "image_id").join(offsets, "pos")
    rank = F.row_number().over(Window.partitionBy("image_id").orderBy("idx"))
    own = F.col("images_before") + 1
    return rows.select(
        "split", own.alias("image_in_split"), (own + F.col("all_images")).alias("image_in_all"), (rank + F.col("boxes_before") + F.col("all_boxes")).alias("annotation_id"), "idx", F.lit(1).alias("category_id")
    )


def slice_lines(images: DataFrame, name: str) -> DataFrame:
    """(split, family, line_no, name): the lines of every slice's file, numbered from 1 in the order of the names, which are numbers."""
    rows = images.select("split", "family", F.col(name).alias("name"), F.concat_ws("/", "split", "family").alias("_slice"))
    return running(rows, "_slice", "name", {"before": F.lit(1)}).select("split", "family", (F.col("before") + 1).alias("line_no"), "name")


def slice_sizes(images: DataFrame, splits: list[str], families: list[str]) -> DataFrame:
    """(split, family, n) for every combination, empty ones included."""
    all_of = images.sparkSession.createDataFrame([(s, f) for s in splits for f in families], "split string, family string")
    return all_of.join(images.groupBy("split", "family").agg(F.count("*").alias("n")), ["split", "family"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def first_failure(df: DataFrame, tests: list[tuple[str, Column]], passed: str = "accepted") -> DataFrame:
    """df with reason: the name of the first test that speaks against the row."""
    return df.withColumn("reason", F.coalesce(*[F.when(c, F.lit(name)) for name, c in tests], F.lit(passed)))
