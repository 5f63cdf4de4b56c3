"""Quota-exact planning: apportionment, expansion and hash-ordered assignment.

Every random order is a hash of a seed and a stable key, so a plan is the same on any number of executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def seeded(seed: int, key: Column) -> Column:
    """A stable pseudo-random order of rows: hex of md5(seed:key)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")).cast("binary"))


def apportion(quotas: DataFrame, total: Column | int, key: str = "key", n: str = "n") -> DataFrame:
    """Largest remainders: quotas scaled to the total exactly, ties to the larger key. The quota table is small (one row a key)."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.lit(total) if isinstance(total, int) else total
    # integers throughout: quotient and remainder of n * total over the sum
    scaled = quotas.withColumns({"_sum": F.sum(n).over(everything)}).withColumn("_up", F.col(n) * total)
    scaled = scaled.withColumns({"_low": F.floor(F.col("_up") / F.col("_sum")).cast("long")}).withColumn("_rest", F.col("_up") - F.col("_low") * F.col("_sum"))
    left = total - F.sum("_low").over(everything)
    rank = F.row_number().over(Window.orderBy(F.col("_rest").desc(), F.col(key).cast("string").desc()))
    return scaled.withColumn("quota", (F.col("_low") + (rank <= left).cast("int")).cast("long")).select(key, n, "quota")


def fitted(quotas: DataFrame, total: int, key: str = "key", quota: str = "quota") -> DataFrame:
    """Quotas moved to the total by changing the largest one (ties to the first key)."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = F.row_number().over(Window.orderBy(F.col(quota).desc(), key))
    return quotas.withColumn(quota, F.col(quota) + F.when(rank == 1, F.lit(total) - F.sum(quota).over(everything)).otherwise(0))


def expanded(quotas: DataFrame, key: str = "key", quota: str = "quota") -> DataFrame:
    """One row per unit of quota: (key, unit) with units from 0."""
    return quotas.where(F.col(quota) > 0).select(key, F.explode(F.sequence(F.lit(0), F.col(quota).cast("int") - 1)).alias("unit"))


def hash_places(rows: DataFrame, order: Column, lead: tuple[str, ...] = ()) -> DataFrame:
    """rows with place, from 0, in the order of the lead columns (whole numbers) and then of a hash in hex. Equal ranges of the hash are
    ranked apart and added up, sixteen for each shuffle partition, so no task sees all rows."""
    buckets = 16 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = [*lead, "_b"]
    spread = rows.withColumn("_o", order).withColumn("_b", F.floor(F.conv(F.substring("_o", 1, 8), 16, 10).cast("long") * F.lit(buckets) / F.lit(2.0**32)))
    counts = spread.groupBy(*part).agg(F.count("*").alias("_n"))
    base = F.coalesce(F.sum("_n").over(Window.orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a bucket
    ranked = spread.withColumn("_r", F.row_number().over(Window.partitionBy(*part).orderBy("_o"))).join(counts.select(*part, base.alias("_base")), part)
    return ranked.select(*rows.columns, (F.col("_base") + F.col("_r") - 1).alias("place"))


def running(rows: DataFrame, group: str, order: str, amounts: dict[str, Column]) -> DataFrame:
    """rows with, for each name, the sum of its amount over the group's rows that come before in a numeric order without ties.

    The order is cut at percentiles, as many as there are shuffle partitions: sums over whole ranges, one row each, are added to sums
    inside a range, so no window holds a group. Where the cuts lie does not change a result, as long as both see the same ones: approximate
    percentiles depend on the order in which parts arrive, so they are found once, one short list a group, and kept on the driver."""
    parts = max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    marks = rows.groupBy(group).agg(F.percentile_approx(order, [i / parts for i in range(1, parts)], 10 * parts).alias("_marks"))
    marks = rows.sparkSession.createDataFrame(marks.collect(), marks.schema)
    placed = rows.join(marks, group).withColumn("_range", F.size(F.filter("_marks", lambda m: m < F.col(order)))).drop("_marks")
    placed = placed.withColumns({f"_{k}": v for k, v in amounts.items()})
    sums = placed.groupBy(group, "_range").agg(*[F.sum(f"_{k}").alias(f"_{k}") for k in amounts])
    ranges = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(group, "_range", *[F.coalesce(F.sum(f"_{k}").over(ranges), F.lit(0)).alias(f"_{k}_before") for k in amounts])
    inside = Window.partitionBy(group, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumns({f"_{k}_inside": F.coalesce(F.sum(f"_{k}").over(inside), F.lit(0)) for k in amounts})
    return placed.join(before, [group, "_range"]).select(*rows.columns, *[(F.col(f"_{k}_before") + F.col(f"_{k}_inside")).cast("long").alias(k) for k in amounts])


def assigned(rows: DataFrame, quotas: DataFrame, order: Column, key: str = "key", quota: str = "quota", block: int = 65536) -> DataFrame:
    """rows with a key each so that every quota is met: the row at place p in the order takes the key whose
    cumulative quota interval holds p. Intervals are joined by the blocks of places that they touch. order must be hex text."""
    upto = F.sum(quota).over(Window.orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow))  # one row a key
    ends = quotas.select(key, F.col(quota).alias("_q"), upto.alias("_end"))
    bounds = ends.withColumn("_start", F.col("_end") - F.col("_q")).where("_q > 0")
    bounds = bounds.withColumn("_block", F.explode(F.sequence(F.floor(F.col("_start") / block), F.floor((F.col("_end") - 1) / block))))
    placed = hash_places(rows, order).withColumn("_block", F.floor(F.col("place") / block))
    return placed.join(bounds, (placed._block == bounds._block) & (F.col("place") >= F.col("_start")) & (F.col("place") < F.col("_end"))).select(*rows.columns, "place", key)


def split_indexes(rows: DataFrame, split: str = "split", order: str = "ordinal") -> DataFrame:
    """rows with their 0-based index inside their split; order: numbers without ties."""
    return running(rows, split, order, {"split_index": F.lit(1)})


def capped(rows: DataFrame, group: list[str], order: str, k: Column | int) -> DataFrame:
    """rows with visual_check: whether they are among the first k of their group."""
    return rows.withColumn("visual_check", F.row_number().over(Window.partitionBy(*group).orderBy(order)) <= k)


def least_used(counts: DataFrame, pool: list[str], k: int, item: str = "item", n: str = "n") -> DataFrame:
    """The next k uses of each pool when the least used item always comes next, ties to the smaller item:
    use number r of an item stands at count n + r, and the k smallest of all (count, item) are taken."""
    least = F.min(n).over(Window.partitionBy(*pool))
    # an item more than k above the pool's least is not reached within k picks, and no item is picked over k times
    near = counts.withColumn("_m", least).where(F.col(n) - F.col("_m") < k)
    each = near.withColumn("_at", F.explode(F.sequence(F.col(n), F.col("_m") + k - 1)))
    by = Window.partitionBy(*pool).orderBy("_at", item)
    return each.withColumn("pick", F.row_number().over(by)).where(F.col("pick") <= k).select(*pool, "pick", item, F.col("_at").alias("uses_before"))


def within_slack(counts: DataFrame, slack: int, n: str = "n") -> DataFrame:
    """Rows at most slack above the least count."""
    least = counts.agg(F.min(n).alias("_least"))
    return counts.crossJoin(least).where(F.col(n) <= F.col("_least") + slack).drop("_least")  # one row


def hash_split(keys: DataFrame, key: str, seed: int, shares: dict[str, float], rest: str = "train") -> DataFrame:
    """Keys ordered by hash; each share takes round(n * share) of them, 1 at least, the rest goes to rest."""
    n = keys.agg(F.count("*").alias("_n"))
    placed = hash_places(keys, seeded(seed, F.col(key))).crossJoin(n)  # one row
    start, out = F.lit(0), F.lit(None).cast("string")
    for name, share in shares.items():
        end = start + F.greatest(F.lit(1), F.bround(F.col("_n") * share).cast("int"))
        out = F.coalesce(out, F.when((F.col("place") >= start) & (F.col("place") < end), F.lit(name)))
        start = end
    return placed.withColumn("split", F.coalesce(out, F.lit(rest))).drop("place", "_n")
