"""Shared folder, materialisation and connected components used by the operators."""

from __future__ import annotations

import ctypes
import functools
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contracts: U+0020 and U+0009 to U+000D.
SPACE = "\\x20\\x09-\\x0D"


@functools.lru_cache
def _local_dir(app: str) -> str:
    return tempfile.mkdtemp(prefix="quarry-")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: spark.checkpoint.dir. Where it is unset, a temporary one if all runs on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = _local_dir(spark.sparkContext.applicationId)
    return f"{found.rstrip('/')}/quarry"


def written(df: DataFrame) -> DataFrame:
    """df written once to the shared folder and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes written tables of which no later result reads: what was made of them is written itself."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        path = jvm.org.apache.hadoop.fs.Path(df._written)
        path.getFileSystem(conf).delete(path, True)


def ascii_lower(col):
    """A-Z to a-z and nothing else (lower() would touch other letters)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: What an operator keeps in a worker process between partitions: name -> how to drop it.
KEPT: dict[str, Callable[[], None]] = {}
#: Bytes of an Arrow batch that holds texts.
BATCH_BYTES = 6 << 20


def release(keep: str = "") -> None:
    """Drops what other operators keep in this worker and gives free memory back to the system."""
    for name, drop in KEPT.items():
        if name != keep:
            drop()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def tidy(run: Callable[[Iterator], Iterator], keep: str = "") -> Callable[[Iterator], Iterator]:
    """run for mapInPandas, releasing memory before and after its partition: Python workers are reused, and what one
    operator's largest batch took would stay with the worker through all that follow."""

    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        release(keep)
        yield from run(batches)
        release(keep)

    return wrapped


def in_small_batches(df: DataFrame) -> DataFrame:
    """df, after holding the Arrow batches of its session at BATCH_BYTES: rows here are whole texts of any length. Batches of narrow rows stay
    as long as they were; a text that is longer is a batch of its own."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get(name))
    if not 0 < now <= BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index of each of n nodes' component, for links a-b inside one task."""
    least = np.arange(n)
    while True:
        low = np.minimum(least[a], least[b])
        new = least.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == least).all():
            return least
        least = new


#: Edges of a graph that one task solves at once; a larger one is contracted first.
ONE_TASK = 200_000


def _solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(u, p): the least node that each node of a small graph reaches."""
    edges = [pdf.to_numpy() for pdf in batches]
    if edges:
        both = np.concatenate(edges)
        nodes, at = np.unique(both, return_inverse=True)
        at = at.reshape(both.shape)
        yield pd.DataFrame({"u": nodes, "p": nodes[forest(len(nodes), at[:, 0], at[:, 1])]})


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list: (id, component_id), component_id the smallest id reached.

    Every round hooks each node to its neighbour of least hashed priority and contracts the graph to
    the hooks, so the edges shrink by a constant factor a round whatever the order of the ids; once ONE_TASK or fewer are
    left, one task solves them. Only nodes with an edge are returned; no edge or label leaves the executors. Null ends are ignored.
    """
    e = written(
        edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
        .where("a is not null and b is not null and a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    label = None
    while many := e.count():
        if many <= ONE_TASK:
            hook = written(e.repartition(1).mapInPandas(_solved, "u long, p long"))
        else:
            both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
            best = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("v"))).alias("m"))
            own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("v"))
            hook = written(best.select(F.col("a").alias("u"), F.least(own, "m")["v"].alias("p")))
        if label is None:
            label = hook.select(F.col("u").alias("id"), F.col("p").alias("node"))
        else:
            label = label.join(hook, label.node == hook.u, "left").select("id", F.coalesce("p", "node").alias("node"))
        if many <= ONE_TASK:
            break
        label = written(label)
        e = written(
            e.join(hook.select(F.col("u").alias("a"), F.col("p").alias("pa")), "a")
            .join(hook.select(F.col("u").alias("b"), F.col("p").alias("pb")), "b")
            .where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct()
        )
    if label is None:
        return e.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    least = label.groupBy("node").agg(F.min("id").alias("component_id"))
    return label.join(least, "node").select("id", "component_id")
