"""Reports as one JSON document: coverage, audit and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def counter_json(counts: DataFrame) -> DataFrame:
    """(dim, document) of counters (dim, key, n): a JSON object of each dimension, keys in order. Counted keys are few."""
    pairs = F.array_sort(F.collect_list(F.struct("key", "n")))
    return counts.groupBy("dim").agg(F.to_json(F.map_from_entries(pairs)).alias("document"))


def validation_report(violations: DataFrame, examples: int = 100) -> DataFrame:
    """(rule_id, n, keys): how often each rule is broken and the first keys; the number of errors is never cut."""
    by = violations.groupBy("rule_id").agg(F.count("*").alias("n"))
    first = violations.withColumn("_r", F.row_number().over(Window.partitionBy("rule_id").orderBy("key", "detail"))).where(F.col("_r") <= examples)
    keys = first.groupBy("rule_id").agg(F.array_sort(F.collect_set("key")).alias("keys"))
    return by.join(keys, "rule_id")


def effective_sizes(base: DataFrame, patch: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows per split of base and patch together, less the dropped ones of the base."""
    left = base.join(dropped, "image_id", "left_anti").select("split")
    return left.unionByName(patch.select("split")).groupBy("split").agg(F.count("*").alias("images"))


def missing_assets(rows: DataFrame) -> DataFrame:
    """One row for each (asset, kind, error) with the detail that came last. rows: (asset, kind, error, ordinal, detail)."""
    return rows.groupBy("asset", "kind", "error").agg(F.max_by("detail", "ordinal").alias("detail"), F.count("*").alias("times"))


def failed_samples(attempts: DataFrame) -> DataFrame:
    """(sample, attempts, reasons) of samples of which no attempt was accepted, to be kept before a run gives up; reasons counts each."""
    counts = attempts.groupBy("sample", "reason").agg(F.count("*").alias("n"))
    per = counts.groupBy("sample").agg(F.sum("n").alias("attempts"), F.array_sort(F.collect_list(F.struct("reason", "n"))).alias("reasons"), F.max(F.col("reason") == "accepted").alias("ok"))
    return per.where(~F.col("ok")).select("sample", "attempts", F.to_json(F.map_from_entries("reasons")).alias("reasons"))


def combined_counters(a: DataFrame, b: DataFrame, sign: int = 1) -> DataFrame:
    """Counters (dim, key, n) added (or with sign -1 taken away); what falls to zero or under is left out, as in a counter."""
    both = a.unionByName(b.withColumn("n", F.col("n") * sign))
    return both.groupBy("dim", "key").agg(F.sum("n").alias("n")).where("n > 0")
