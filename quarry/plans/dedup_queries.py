"""Exact and near duplicates, resumption and incremental counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import dedup as d
from quarry.operators import incremental as inc

from .registry import query
from .views import view

FIRSTS = "f AS (SELECT sig, min(ordinal) AS o FROM {signatures} GROUP BY sig), p AS (SELECT a.o AS i, b.o AS j, bit_count(xor(a.sig, b.sig)) AS distance FROM f a JOIN f b ON a.o < b.o WHERE bit_count(xor(a.sig, b.sig)) <= 2)"
NEAR = "h AS (SELECT a.ordinal AS i, b.ordinal AS j, bit_count(xor(a.sig, b.sig)) AS distance FROM {signatures} a JOIN {signatures} b ON a.ordinal < b.ordinal WHERE bit_count(xor(a.sig, b.sig)) <= 2)"


@query("SELECT ordinal, sha256, row_number() OVER (PARTITION BY sha256 ORDER BY ordinal) > 1 AS duplicate FROM {manifest}")
def exact_duplicates(spark, sf):
    return d.first_of_each(view(spark, sf, "manifest").select("ordinal", "sha256"), "sha256", "ordinal").select("ordinal", "sha256", "duplicate")


@query("SELECT ordinal, sha256 FROM {manifest} QUALIFY row_number() OVER (PARTITION BY sha256 ORDER BY ordinal) = 1")
def accepted_by_digest(spark, sf):
    return d.first_accepted(view(spark, sf, "manifest").select("ordinal", "sha256"), "sha256", "ordinal")


def classes_and_pairs(spark, sf):
    rows = view(spark, sf, "signatures").select("ordinal", "sig")
    classes = d.signature_classes(rows)
    return rows, classes, d.hamming_pairs(classes)


@query(f"WITH {FIRSTS} SELECT i, j, distance::INTEGER AS distance FROM p")
def near_signature_pairs(spark, sf):
    """Near pairs of distinct signatures, each named by its first row; signature_members has the rows of each."""
    return classes_and_pairs(spark, sf)[2]


@query("SELECT ordinal, min(ordinal) OVER (PARTITION BY sig) AS first_row FROM {signatures}")
def signature_members(spark, sf):
    rows, classes, _ = classes_and_pairs(spark, sf)
    return rows.join(classes, "sig").select("ordinal", F.col("first").alias("first_row"))


@query(f"WITH {NEAR} SELECT (SELECT count(*) FROM {{signatures}}) AS rows, count(DISTINCT j) AS near_rows, count(DISTINCT j) / (SELECT count(*) FROM {{signatures}}) AS ratio FROM h")
def near_duplicate_ratio(spark, sf):
    return d.earlier_match_ratio(*classes_and_pairs(spark, sf))


@query(
    f"""WITH RECURSIVE {NEAR}, o AS (SELECT ordinal, row_number() OVER (ORDER BY ordinal) AS r FROM {{signatures}}),
    s(r, kept) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT s.r + 1, CASE WHEN EXISTS (SELECT 1 FROM h WHERE h.j = o.ordinal AND list_contains(s.kept, h.i)) THEN s.kept ELSE list_append(s.kept, o.ordinal) END FROM s JOIN o ON o.r = s.r + 1)
    SELECT ordinal, list_contains((SELECT kept FROM s ORDER BY r DESC LIMIT 1), ordinal) AS accepted FROM {{signatures}}"""
)
def greedy_near_duplicates(spark, sf):
    """First come, first kept: a row goes only if it is near a kept earlier row."""
    return d.greedy_gate(*classes_and_pairs(spark, sf)).select("ordinal", "accepted")


@query("SELECT image_id FROM {images} WHERE image_id NOT IN (SELECT image_id FROM {images} WHERE image_id % 4 <> 1)")
def resume_missing(spark, sf):
    """Planned samples that the manifest does not hold yet."""
    images = view(spark, sf, "images").select("image_id")
    return inc.missing(images, images.where("image_id % 4 <> 1"), "image_id")


@query("SELECT ordinal FROM {manifest} WHERE ordinal % 3 <> 0 AND ordinal % 5 <> 0")
def manifest_repair(spark, sf):
    """Manifest rows whose image and label are both listed."""
    rows = view(spark, sf, "manifest").select("ordinal")
    return inc.repaired(rows, rows.where("ordinal % 3 <> 0"), rows.where("ordinal % 5 <> 0"), "ordinal")


@query("SELECT map_id, count(*) AS failures FROM {images} WHERE image_id % 4 = 0 GROUP BY map_id HAVING count(*) >= 20")
def retired_maps(spark, sf):
    """Maps that failed too often and leave the next round."""
    return inc.retired(view(spark, sf, "images").where("image_id % 4 = 0"), "map_id", 20)


@query("SELECT count(*) AS rows, sum(CAST('0x' || substr(md5(image_id || ':' || split || ':' || scenario), 1, 15) AS BIGINT))::VARCHAR AS digest FROM {images}")
def plan_guard(spark, sf):
    """Digest of a plan, to refuse mixing it with another."""
    line = F.concat_ws(":", F.col("image_id").cast("string"), "split", "scenario")
    return inc.plan_digest(view(spark, sf, "images").select(line.alias("line")), "line")


@query("SELECT item, split, count(*) AS uses, min(event_id) AS first_use FROM {uses} GROUP BY ALL")
def rebuilt_counters(spark, sf):
    """Use counters rebuilt from the committed rows."""
    return view(spark, sf, "uses").groupBy("item", "split").agg(F.count("*").alias("uses"), F.min("event_id").alias("first_use"))


@query("SELECT split, left(sha256, 2) AS prefix, count(*) AS n, sum(length(payload))::BIGINT AS chars, round_even(avg(box_count), 0)::BIGINT AS boxes FROM {manifest} GROUP BY ALL")
def manifest_digest_histogram(spark, sf):
    rows = view(spark, sf, "manifest")
    return rows.groupBy("split", F.left("sha256", F.lit(2)).alias("prefix")).agg(
        F.count("*").alias("n"), F.sum(F.length("payload")).alias("chars"), F.bround(F.avg("box_count")).cast("long").alias("boxes")
    )


@query("SELECT ordinal, band, (sig >> (16 * band)) & 65535 AS bits FROM {signatures}, (SELECT unnest([0, 1, 2, 3]) AS band) b")
def signature_bands(spark, sf):
    band = F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.shiftrightunsigned("sig", 16 * b).bitwiseAND(0xFFFF).alias("bits")) for b in range(4)]))
    return view(spark, sf, "signatures").select("ordinal", band.alias("b")).select("ordinal", "b.band", "b.bits")
