"""Files of a dataset as tables: listings, manifests, label files, COCO files, image headers and configuration."""

from __future__ import annotations

from functools import reduce
from pathlib import Path

import yaml
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import mounted

REQUIRED = ("client_root", "output_root", "cache_dir", "seed", "image", "splits")
SIZE = (1280, 224)
COCO = "images array<struct<id:long,file_name:string,width:int,height:int>>, annotations array<struct<id:long,image_id:long,category_id:int,bbox:array<double>,area:double>>, categories array<struct<id:int,name:string>>"


def load_config(path: str | Path) -> dict:
    """A YAML configuration with all required keys and the frame size that the operators assume."""
    config = yaml.safe_load(mounted(path).read_text(encoding="utf-8"))
    lacking = [k for k in REQUIRED if k not in config]
    if lacking:
        raise ValueError(f"missing keys: {', '.join(lacking)}")
    if (config["image"].get("width"), config["image"].get("height")) != SIZE:
        raise ValueError(f"images must be {SIZE[0]} by {SIZE[1]}")
    return config


def listing(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, length) of files, without reading them. Scans skip empty files; the names of the file index, which the
    driver holds for any scan, bring those back with length 0."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    plain = F.regexp_replace("path", "^file:/+", "file:/")  # the index and the scan write local addresses differently
    names = spark.createDataFrame([(n,) for n in files.inputFiles()], "path string").select(plain.alias("path"))
    return names.join(files.select(plain.alias("path"), "length"), "path", "left").select("path", F.coalesce("length", F.lit(0)).alias("length"))


def reusable(index: DataFrame, bundles: DataFrame) -> bool:
    """Whether a stored asset index can be used again: all bundles that it refers to are still there."""
    return index.select("bundle").distinct().join(bundles.select(F.element_at(F.split("path", "/"), -1).alias("bundle")), "bundle", "left_anti").isEmpty()


def catalog_version(files: DataFrame) -> DataFrame:
    """The version named by the last catalog file, unknown without one."""
    return files.agg(F.coalesce(F.max(F.regexp_extract("path", r"catalog_(.+)\.bin$", 1)), F.lit("")).alias("v")).select(F.when(F.col("v") != "", F.col("v")).otherwise("unknown").alias("version"))


def manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a declared schema: no pass over the data to infer one."""
    return spark.read.schema(schema).json(path)


def label_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(path, line_no, line) of label files; blank lines are no labels."""
    text = spark.read.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(folder)
    lines = text.select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    return lines.where(F.trim("line") != "")


def coco(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(images, annotations) of COCO files."""
    doc = spark.read.schema(COCO).option("multiLine", "true").json(path).select("*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"))
    return doc.select("path", "file", F.explode("images").alias("i")).select("path", "file", "i.*"), doc.select("path", "file", F.explode("annotations").alias("a")).select("path", "file", "a.*")


def image_headers(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, length, sha256, format, width, height) read off the files' first bytes in the JVM; JPEG sizes come from the first frame header."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    h = F.hex("content")
    number = lambda c, a, n: F.conv(F.substring(c, a, n), 16, 10).cast("int")
    # the first baseline or progressive frame marker with its length, precision, height and width
    frame = F.regexp_extract(h, r"^FFD8(?:FF(?!C[0-3])[0-9A-F]{2}(?:[0-9A-F]{2})*?)*?FFC[0-3][0-9A-F]{6}([0-9A-F]{8})", 1)
    png, jpeg = F.startswith(h, F.lit("89504E470D0A1A0A")), F.startswith(h, F.lit("FFD8FF"))
    return files.select(
        "path", "length", F.sha2("content", 256).alias("sha256"),
        F.when(png, "PNG").when(jpeg, "JPEG").alias("format"),
        F.when(png, number(h, 33, 8)).when(jpeg & (frame != ""), number(frame, 5, 4)).alias("width"),
        F.when(png, number(h, 41, 8)).when(jpeg & (frame != ""), number(frame, 1, 4)).alias("height"),
    )


def shared_splits(spark: SparkSession, path: str) -> DataFrame:
    """A map selection of another dataset; every split must have maps."""
    doc = spark.read.option("multiLine", "true").schema("splits map<string, array<string>>").json(path)
    rows = doc.select(F.explode("splits").alias("split", "maps"))
    if {r.split for r in rows.where(F.size("maps") > 0).select("split").collect()} != {"train", "val", "test"}:
        raise ValueError("train, val and test must all have maps")
    return rows.select("split", F.explode("maps").alias("map_id"))


#: The layout of an item index that can be used again.
INDEX_VERSION = 1


def stored_index(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored item index of this version; None where there is none or it has another layout, and it must be built."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException:
        return None
    if "schema_version" not in df.columns or not df.where(F.col("schema_version") != INDEX_VERSION).isEmpty():
        return None
    return df.drop("schema_version")


def sidecar(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON document beside a dataset (plan, map selection, geometry) with a declared schema."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def pick_maps(maps: DataFrame, ranges: list[tuple[int, int]] = (), without: tuple[str, ...] = (), only: tuple[str, ...] = (), hints: tuple[str, ...] = ()) -> DataFrame:
    """maps (map_id, map_key): with an id in any of the ranges, both ends included; without ids that begin with a prefix; those listed, if any
    are; without keys that hold a hint, whatever the case."""
    number = F.col("map_id").cast("long")
    keep = F.lit(True)
    if ranges:
        keep &= reduce(Column.__or__, [number.between(a, b) for a, b in ranges])
    for prefix in without:
        keep &= ~F.col("map_id").startswith(prefix)
    if only:
        keep &= F.col("map_id").isin(*only)
    for hint in hints:
        keep &= ~F.lower("map_key").contains(hint.lower())
    return maps.where(keep)


def normal_maps(maps: DataFrame) -> DataFrame:
    """Maps with monsters and platforms that are of no special kind and have no time limit; a missing kind or limit is none."""
    none = lambda c: F.coalesce(F.col(c), F.lit(0)) == 0
    return maps.where((F.col("mobs") > 0) & (F.col("footholds") > 0) & none("field_type") & none("time_limit"))


def point_read(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (bundle, path_id) with the index's row of each; one that is not there has a null key."""
    return wanted.join(index, ["bundle", "path_id"], "left")
