"""Exact and near duplicates by digests and 64-bit signatures."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written

#: Blocks that must agree for two signatures to meet: their bits together make the key of the join.
AGREE = 3


def first_of_each(df: DataFrame, digest: str, order: str) -> DataFrame:
    """df with duplicate: whether an earlier row has the same digest. Only (digest, first) is joined back, so rows of a hot digest stay spread."""
    first = df.groupBy(digest).agg(F.min(order).alias("_first"))
    return df.join(first, digest).withColumn("duplicate", F.col(order) != F.col("_first")).drop("_first")


def signature_classes(df: DataFrame, sig: str = "sig", order: str = "ordinal") -> DataFrame:
    """(sig, first): every distinct signature with the first row that has it."""
    return df.groupBy(F.col(sig).alias("sig")).agg(F.min(order).alias("first"))


def hamming_pairs(classes: DataFrame, distance: int = 2) -> DataFrame:
    """(i, j, distance), i < j, of all pairs of classes (sig, first) within the distance, named by their first rows.

    Signatures are cut into distance + AGREE blocks, of which AGREE are equal in any such pair: for each choice of AGREE blocks
    signatures meet by these blocks' bits, 38 of 64 at a distance of 2, so that buckets stay small however many signatures there are."""
    blocks = distance + AGREE
    cuts = [64 * b // blocks for b in range(blocks + 1)]
    keys = []
    for no, chosen in enumerate(combinations(range(blocks), AGREE)):
        mask = sum((1 << cuts[b + 1]) - (1 << cuts[b]) for b in chosen)
        keys.append(F.struct(F.lit(no).alias("no"), F.col("s").bitwiseAND(F.lit(mask - 2**64 if mask >= 2**63 else mask)).alias("bits")))
    cut = classes.select(F.col("sig").alias("s"), F.col("first").alias("f")).withColumn("key", F.explode(F.array(*keys)))
    a, b = cut.alias("a"), cut.alias("b")
    apart = F.bit_count(F.col("a.s").bitwiseXOR(F.col("b.s")))
    near = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.f") < F.col("b.f"))).where(apart <= distance)
    return near.select(F.col("a.f").alias("i"), F.col("b.f").alias("j"), apart.alias("distance")).distinct()


def earlier_match_ratio(df: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(rows, near_rows, ratio): rows with an earlier row of the same or a near signature, over all rows."""
    # a row that is not its class's first has an earlier match; a first one has if a near class began before
    near = classes.join(pairs.select(F.col("j").alias("first")).distinct(), "first", "left_anti").agg(F.count("*").alias("alone"))
    n = df.agg(F.count("*").alias("rows"))
    return n.crossJoin(near).select("rows", (F.col("rows") - F.col("alone")).alias("near_rows")).withColumn("ratio", F.col("near_rows") / F.greatest(F.lit(1), F.col("rows")))  # one row each


def greedy_gate(df: DataFrame, classes: DataFrame, pairs: DataFrame, order: str = "ordinal") -> DataFrame:
    """df with accepted: a row is rejected only if it is near an accepted earlier row.

    Only the first row of a signature can be accepted: what speaks against it, or else it itself, speaks against the rest. So firsts
    are decided, in rounds that take all whose earlier neighbours are decided. Each round is
    one join on the undecided pairs, and every chain shrinks from its earliest end, so the loop ends."""
    open_pairs = written(pairs.select("i", "j"))
    rejected = None
    while not open_pairs.isEmpty():
        waiting = open_pairs.select(F.col("j").alias("o")).distinct()
        # i is settled and accepted once it waits no more and was not rejected
        loose = open_pairs.join(waiting.withColumnRenamed("o", "i"), "i", "left_anti")
        out = written(loose.select(F.col("j").alias("o")).distinct())
        rejected = out if rejected is None else rejected.unionByName(out)
        open_pairs = written(open_pairs.join(out.withColumnRenamed("o", "j"), "j", "left_anti").join(out.withColumnRenamed("o", "i"), "i", "left_anti"))
    kept = classes.select(F.col("first").alias(order))
    if rejected is not None:
        kept = kept.join(rejected.withColumnRenamed("o", order), order, "left_anti")
    return df.join(kept.withColumn("_yes", F.lit(True)), order, "left").withColumn("accepted", F.col("_yes").isNotNull()).drop("_yes")


def first_accepted(df: DataFrame, digest: str, order: str) -> DataFrame:
    """The rows that come first with their digest: the least of each task meet, so a hot digest is summed up before the shuffle."""
    rest = [c for c in df.columns if c not in (digest, order)]
    best = df.groupBy(digest).agg(F.min(F.struct(order, *rest)).alias("_m"))
    return best.select(*[F.col(c) if c == digest else F.col(f"_m.{c}").alias(c) for c in df.columns])

