"""Counts, coverage with zeros filled in, ratios, percentiles and balance plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counters(df: DataFrame, dims: dict[str, Column]) -> DataFrame:
    """(dim, key, n) of every dimension in one pass: the dimensions are stacked, then counted map-side."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dim"), c.cast("string").alias("key")) for d, c in dims.items()])
    return df.select(F.explode(pairs).alias("p")).groupBy("p.dim", "p.key").agg(F.count("*").alias("n"))


def filled(uses: DataFrame, catalog: DataFrame, keys: list[str]) -> DataFrame:
    """The catalog's keys with their number of uses, zero where there is none."""
    counts = uses.groupBy(*keys).agg(F.count("*").alias("n"))
    return catalog.select(*keys).distinct().join(counts, keys, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def deficits(counts: DataFrame, ratio: int = 5) -> DataFrame:
    """What each key lacks to reach the largest count over the ratio, rounded up; keys that lack nothing are left out."""
    target = counts.agg(F.ceil(F.max("n") / ratio).cast("long").alias("target"))
    joined = counts.crossJoin(target)  # one row
    return joined.withColumn("deficit", F.greatest(F.lit(0), F.col("target") - F.col("n"))).where("deficit > 0")


def chunks(tasks: DataFrame, amount: str, size: int = 10) -> DataFrame:
    """Rows of at most size units: (…, part, units) until the amount is used up."""
    parts = F.ceil(F.col(amount) / size).cast("int")
    out = tasks.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return out.withColumn("units", F.least(F.lit(size), F.col(amount) - F.col("part") * size))


def nearest_rank(values: Column, q: float) -> Column:
    """Element round((n - 1) * q), half to even, of the sorted values; 0 where there are none."""
    ordered = F.array_sort(F.collect_list(values))
    return F.when(F.size(ordered) == 0, F.lit(0)).otherwise(F.element_at(ordered, F.bround((F.greatest(F.size(ordered), F.lit(1)) - 1) * F.lit(q)).cast("int") + 1))


def percentile_rank(df: DataFrame, group: list[str], value: str, qs: list[float]) -> DataFrame:
    """Nearest-rank percentiles from the group's histogram: values are counted first, so a window holds one row for each distinct value."""
    counts = df.groupBy(*group, value).agg(F.count("*").alias("_n"))
    by = Window.partitionBy(*group)
    upto = counts.withColumns({"_upto": F.sum("_n").over(by.orderBy(value)), "_all": F.sum("_n").over(by)})
    rank = lambda q: F.bround((F.col("_all") - 1) * F.lit(q)).cast("long")
    picks = [F.min(F.when(F.col("_upto") > rank(q), F.col(value))).alias(f"p{round(q * 100)}") for q in qs]
    return upto.groupBy(*group).agg(*picks)


def merged(df: DataFrame, key: str, order: str, scalars: list[str], sets: list[str]) -> DataFrame:
    """One row per key: scalars of the first row, sorted distinct values of the sets."""
    first = F.min_by(F.struct(*scalars), order).alias("f")
    return df.groupBy(key).agg(first, *[F.array_sort(F.collect_set(s)).alias(f"{s}_set") for s in sets]).select(key, "f.*", *[f"{s}_set" for s in sets])


def quota_differences(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """(dim, key, n, expected) where a histogram differs from its plan."""
    joined = actual.join(expected.withColumnRenamed("n", "expected"), ["dim", "key"], "full")
    return joined.where(~F.col("n").eqNullSafe(F.col("expected"))).select("dim", "key", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("expected", F.lit(0)).alias("expected"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
