"""Resuming, repairing and guarding a long run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing(plan: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Planned rows that are not done."""
    return plan.join(done.select(key), key, "left_anti")


def repaired(manifest: DataFrame, images: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Manifest rows whose image and label files both exist."""
    return manifest.join(images.select(key), key, "left_semi").join(labels.select(key), key, "left_semi")


def retired(failures: DataFrame, key: str, limit: int) -> DataFrame:
    return failures.groupBy(key).agg(F.count("*").alias("failures")).where(F.col("failures") >= limit)


def plan_digest(rows: DataFrame, line: str) -> DataFrame:
    """(rows, digest) of a plan of any size: sums of 60 bits of each line's md5, so tasks add up their parts in any order."""
    part = F.conv(F.substring(F.md5(F.col(line).cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")
    return rows.agg(F.count("*").alias("rows"), F.sum(part).cast("string").alias("digest"))


def guard(current: str, stored: str | None) -> None:
    """Refuses to go on with another plan than the stored one."""
    if stored is not None and stored != current:
        raise ValueError("the output belongs to another plan")
