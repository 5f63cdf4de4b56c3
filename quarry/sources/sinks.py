"""Writers of a dataset: manifests, label files, COCO files, slices and data.yaml."""

from __future__ import annotations

import re
import shutil
import zipfile
from html import escape
from pathlib import Path

import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mounted(folder: str | Path) -> Path:
    """A folder, plain or as a file: address, as a path; other addresses are no files that a task could open."""
    text = str(folder)
    if "://" in text and not text.startswith("file://"):
        raise ValueError(f"{text} is no mounted folder")
    return Path(re.sub(r"^file:(//)?(?=/)", "", text))


def write_manifest(rows: DataFrame, folder: str, mode: str = "append") -> None:
    """JSON lines by split; Spark commits whole files, so a lost task leaves no half record."""
    rows.write.partitionBy("split").mode(mode).json(folder)


def write_label_files(bodies: DataFrame, folder: str, name: str = "stem", split: str = "split") -> None:
    """One text file per image at folder/split/name.txt, put in place by renaming; rows are (split, stem, body). folder is a
    path that all executors mount.

    The files are written by the tasks through the shared file system; a task that runs twice writes the same bytes."""
    root = str(mounted(folder))

    def put(rows) -> None:
        for r in rows:
            target = Path(root) / r[split] / f"{r[name]}.txt"
            target.parent.mkdir(parents=True, exist_ok=True)
            part = target.with_suffix(".txt.part")
            part.write_text(r["body"], encoding="utf-8")
            part.replace(target)

    bodies.select(split, name, "body").foreachPartition(put)


def write_images(images: DataFrame, folder: str, suffix: str = ".jpg") -> None:
    """One file per image at folder/split/stem, put in place by renaming; rows are (split, stem, image). folder is a path that all
    executors mount."""
    root = str(mounted(folder))

    def put(rows) -> None:
        for r in rows:
            target = Path(root) / r["split"] / f"{r['stem']}{suffix}"
            target.parent.mkdir(parents=True, exist_ok=True)
            part = target.with_suffix(".part")
            part.write_bytes(bytes(r["image"]))
            part.replace(target)

    images.select("split", "stem", "image").foreachPartition(put)


def enough_disk(folder: str | Path, gigabytes: float) -> None:
    """Raises if less is free; for the driver to call before each batch."""
    free = shutil.disk_usage(mounted(folder)).free / 1e9
    if free < gigabytes:
        raise OSError(f"{free:.1f} GB free, {gigabytes} needed")


def coco_documents(images: DataFrame, annotations: DataFrame, classes: list[str]) -> DataFrame:
    """(split, document): one JSON document per split. A document is as large as its split's labels: write
    tables (Parquet, or JSON lines per split) where a split does not fit one file."""
    entry = F.struct(F.col("coco_image_id").alias("id"), F.col("file_name"), "width", "height")
    box = F.struct(F.col("annotation_id").alias("id"), F.col("coco_image_id").alias("image_id"), "category_id", F.array("x", "y", "w", "h").alias("bbox"), "area", F.lit(0).alias("iscrowd"))
    categories = F.array(*[F.struct(F.lit(i + 1).alias("id"), F.lit(c).alias("name")) for i, c in enumerate(classes)])
    own = images.groupBy("split").agg(F.array_sort(F.collect_list(entry)).alias("images"))
    boxes = annotations.groupBy("split").agg(F.array_sort(F.collect_list(box)).alias("annotations"))
    return own.join(boxes, "split", "left").select("split", F.to_json(F.struct("images", F.coalesce("annotations", F.array()).alias("annotations"), categories.alias("categories"))).alias("document"))


def write_slices(lines: DataFrame, folder: str) -> None:
    """The lines (split, family, line_no, name) of all slices as text under folder/split=.../family=.../, in order over the part files
    of a folder. A slice of any size is written by many tasks; one without lines has no folder."""
    ordered = lines.repartitionByRange("split", "family", "line_no").sortWithinPartitions("split", "family", "line_no")
    ordered.select("split", "family", F.col("name").cast("string").alias("value")).write.mode("overwrite").partitionBy("split", "family").text(folder)


def write_index(rows: DataFrame, folder: str, version: int) -> None:
    """An index with the version of its layout, for files.stored_index; Spark commits it as a whole."""
    rows.withColumn("schema_version", F.lit(version)).write.mode("overwrite").parquet(folder)


def layout_folders(root: str | Path, splits: tuple[str, ...] = ("train", "val", "test")) -> list[str]:
    """Makes a dataset's folders and gives their names."""
    names = [f"{kind}/{s}" for kind in ("images", "labels") for s in splits] + ["annotations", "visual_checks", "catalogs"]
    for n in names:
        (mounted(root) / n).mkdir(parents=True, exist_ok=True)
    return names


def data_yaml(path: str | Path, roots: list[str], classes: list[str]) -> None:
    """data.yaml over one or more dataset folders: the splits are the unions of their image folders."""
    one = lambda split: f"{roots[0]}/images/{split}" if len(roots) == 1 else [f"{r}/images/{split}" for r in roots]
    mounted(path).write_text(yaml.safe_dump({s: one(s) for s in ("train", "val", "test")} | {"names": dict(enumerate(classes))}, sort_keys=False), encoding="utf-8")


def write_preview(folder: str | Path, pages: dict[str, bytes], title: str, note: str) -> Path:
    """An overview of a few images for people: the images, an HTML index, a README.txt, and all of it as one archive. Called on the driver."""
    root = mounted(folder)
    root.mkdir(parents=True, exist_ok=True)
    for name, data in pages.items():
        (root / name).write_bytes(data)
    cells = "".join(f'<figure><img src="{escape(n)}" alt="{escape(n)}"><figcaption>{escape(n)}</figcaption></figure>' for n in sorted(pages))
    (root / "index.html").write_text(f"<!DOCTYPE html><meta charset=utf-8><title>{escape(title)}</title><h1>{escape(title)}</h1>{cells}", encoding="utf-8")
    (root / "README.txt").write_text(f"{title}\n\n{note}\n", encoding="utf-8")
    archive = root.with_suffix(".zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for name in [*sorted(pages), "index.html", "README.txt"]:
            z.write(root / name, f"{root.name}/{name}")
    return archive
