"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


@functools.lru_cache
def _local_dir(app: str) -> str:
    return tempfile.mkdtemp(prefix="quarry-")


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a temporary folder if driver and executors are one process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = _local_dir(spark.sparkContext.applicationId)
    return f"{found.rstrip('/')}/quarry"


def written(df: DataFrame) -> DataFrame:
    """df written once and read again: cuts the lineage of loops and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Entries that a cache of decoded resources holds where nothing else is said, and at least.
CACHED, LEAST_CACHED = 384, 32


def remembering(load: Callable, entries: int = CACHED) -> Callable:
    """load with its latest results kept, the longest unused going first; each worker process has its own."""
    return functools.lru_cache(max(LEAST_CACHED, entries))(load)
