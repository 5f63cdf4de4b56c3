"""Mixing sources to target weights along a time-varying curriculum.

Targets: the sources share all words by weight (1, 2, 3, repeating over the sources by code point, null
last); none gets more than REPEATS times its own size, and what is cut off goes to the others by weight.
With the sources ordered by cap over weight the capped ones are a prefix, so one running sum over the
source table finds the common level and no iteration is needed.

Taking: a source's documents are read in a fixed pseudo-random order (md5 of the id, then id and size), as many whole passes as the target
holds and then on to the word where it is reached. Word c of a source's demand is trained at
position t in [0, 1) where the integral of its weight schedule, 1 + slope * (2t - 1) with a slope between
-SLOPE and SLOPE fixed by the source's rank, reaches c over the target: the schedule is integrated in
closed form and inverted by the quadratic formula. Documents are then range-sorted by position.

Scale: running sums are taken in two levels, (source, bucket of the order) and then inside each bucket. Buckets are equal
ranges of the order, BUCKETS of them for each shuffle partition, so a source with a third of all documents is dealt over
all tasks and the order does not depend on their number; only per-bucket sums meet in one window. Joins carry per-bucket rows, never a broadcast of unknown size.

Null and empty texts have size 0 and take nothing; a source of size 0 has target 0. Rows with equal ids
stand next to each other in the order and are interchangeable. A null id sorts by an empty key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE

REPEATS, BUCKETS, SLOPE = 3, 16, 0.75
ADDED = ["size", "source_size", "target", "taken", "passes", "position"]


def sized(docs: DataFrame) -> DataFrame:
    """docs with size, the order key of each document, its bucket, and the source as a non-null pair."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.withColumns(
        {
            "size": F.coalesce(F.regexp_count("text", F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long"),
            "_order": key,
            "_bucket": F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * F.lit(buckets) / F.lit(2.0**32)).cast("int"),
            "_none": F.col("source").isNull(),
            "_source": F.coalesce("source", F.lit("")),
        }
    )


def targets(buckets: DataFrame) -> DataFrame:
    """One row per source: source_size, target, rank. buckets has one row per source and bucket with n words."""
    sizes = buckets.groupBy("_none", "_source").agg(F.sum("n").alias("source_size"))
    by = Window.orderBy("_none", "_source")
    ranked = sizes.withColumn("rank", F.row_number().over(by) - 1)
    ranked = ranked.withColumns({"weight": (F.col("rank") % 3 + 1).cast("long"), "cap": F.col("source_size") * REPEATS})
    # capped sources come first when ordered by cap over weight; the level is what the rest share per unit of weight
    tight = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = tight.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double") / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    ranked = ranked.withColumn("level", level)
    ranked = ranked.withColumn("fits", F.col("cap") >= F.col("level") * F.col("weight"))
    level = F.min(F.when(F.col("fits"), F.struct((F.col("cap") / F.col("weight")).alias("r"), F.col("rank"), F.col("level")))).over(everything)["level"]
    return ranked.withColumn("target", F.coalesce(F.least(F.col("cap").cast("double"), level * F.col("weight")), F.col("cap").cast("double"))).select(
        "_none", "_source", "rank", "source_size", "target"
    )


def place(word: Column) -> Column:
    """Training position of a word of a source's demand: t with t + slope * (t * t - t) = word / target."""
    x = F.least(F.lit(1.0), word / F.when(F.col("target") > 0, F.col("target")))
    slope = (F.col("rank") % 7 - 3) * (SLOPE / 3)
    root = F.sqrt(F.greatest(F.lit(0.0), (1 - slope) * (1 - slope) + 4 * slope * x))
    return 2 * x / (1 - slope + root)


def planned(docs: DataFrame) -> DataFrame:
    """docs in any order with the columns of mix, the source's rank and _start, where their first reading begins."""
    d = sized(docs.drop(*ADDED))
    small = sized(docs.select("doc_id", "source", "text")).groupBy("_none", "_source", "_bucket").agg(F.sum("size").alias("n"))
    own = ["_none", "_source"]
    running = F.sum("n").over(Window.partitionBy(*own).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    small = small.withColumn("_base", F.coalesce(running, F.lit(0))).join(targets(small), own)
    inside = F.sum("size").over(Window.partitionBy(*own, "_bucket").orderBy("_order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(small.drop("n"), [*own, "_bucket"])
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    start = F.col("_base") + F.col("_inside")
    rest = F.floor(F.col("target")).cast("long") - whole * F.col("source_size")
    more = F.greatest(F.lit(0), F.least(F.col("size"), rest - start)).cast("long")
    t = place(start)
    taken = whole * F.col("size") + more
    d = d.withColumns({"taken": taken, "passes": (F.when(F.col("size") > 0, whole + (more > 0).cast("long")).otherwise(F.lit(0))).cast("int")})
    return d.withColumns({"position": F.when(F.col("taken") > 0, t), "_start": start})


def mix(docs: DataFrame) -> DataFrame:
    """docs, range-sorted by position, with size, source_size, target, taken, passes and position.

    passes: how often the document is begun; position: where it is first read, null if it is not taken.
    """
    kept = [c for c in docs.columns if c not in ADDED]
    return planned(docs).orderBy(F.col("position").asc_nulls_last(), "_order").select(*kept, *ADDED)


def readings(docs: DataFrame) -> DataFrame:
    """docs as the mix reads them: one row for each reading that takes at least half a document's words, in
    training order. A document is read as often as taken over size says, rounded half up."""
    times = F.floor(F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(F.lit(0.0)) + 0.5).cast("int")
    read = planned(docs).withColumn("_times", times).where("_times > 0").withColumn("_time", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)))
    # each pass of a source is read after the one before, a source's size further on in its demand
    at = place(F.col("_start") + F.col("_time") * F.col("source_size"))
    return read.withColumn("_at", at).orderBy("_at", "_order", "_time").select(*docs.columns)


#: The same mix in DuckDB SQL, without passes' order of rows.
MIX_SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS o FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rnk FROM d GROUP BY source),
w AS (SELECT *, rnk % 3 + 1 AS weight, source_size * {REPEATS} AS cap FROM s),
l AS (SELECT *, ((SELECT sum(source_size) FROM w) - coalesce(sum(cap) OVER b, 0))::DOUBLE / ((SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER b, 0)) AS lvl
      FROM w WINDOW b AS (ORDER BY cap / weight, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT arg_min(lvl, struct_pack(r := cap / weight, k := rnk)) AS lvl FROM l WHERE cap >= lvl * weight),
t AS (SELECT w.*, least(cap::DOUBLE, f.lvl * weight) AS target FROM w, f),
c AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.rnk, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY o, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
m AS (SELECT *, greatest(0, least(size, floor(target)::BIGINT - whole * source_size - start)) AS more,
             least(1.0, start / CASE WHEN target > 0 THEN target END) AS x, (rnk % 7 - 3) * ({SLOPE} / 3)::DOUBLE AS slope FROM c)
SELECT doc_id, size, source_size, target, (whole * size + more)::BIGINT AS taken,
       (CASE WHEN size > 0 THEN whole + (more > 0)::BIGINT ELSE 0 END)::INTEGER AS passes,
       CASE WHEN whole * size + more > 0 THEN 2 * x / (1 - slope + sqrt(greatest(0.0, (1 - slope) * (1 - slope) + 4 * slope * x))) END AS position
FROM m
"""
