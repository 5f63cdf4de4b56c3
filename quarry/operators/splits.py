"""Splits of maps without leakage."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quota import seeded


#: Maps that a plan may have: the fold below is held on the driver.
MOST = 100_000


def leaks(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """Keys that occur in more than one split."""
    return df.groupBy(key).agg(F.count_distinct(split).alias("splits")).where("splits > 1")


def coverage_split(maps: DataFrame, seed: int, share: float = 0.1) -> DataFrame:
    """(map_id, split): test and val each take round(n * share) maps, and every mob keeps a training map.

    maps: (map_id, mob_ids), one row per game map, a table of hundreds that configuration bounds. Maps that alone
    hold a mob stay in train; the others are held out in hash order while none of their mobs would
    lose its last map. Each decision depends on the ones before, so it is one fold on the driver.
    """
    spark = maps.sparkSession
    rows = maps.select("map_id", "mob_ids", seeded(seed, F.col("map_id")).alias("o")).orderBy("o").limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"more than {MOST} maps; a game has hundreds")
    left: dict = {}
    for r in rows:
        for mob in r.mob_ids:
            left[mob] = left.get(mob, 0) + 1
    side = round(len(rows) * share)
    held: list = []
    for r in rows:
        if len(held) < 2 * side and all(left[m] > 1 for m in r.mob_ids):
            held.append(r.map_id)
            for m in r.mob_ids:
                left[m] -= 1
    where = {m: "test" if i < len(held) // 2 else "val" for i, m in enumerate(held)}
    kind = maps.schema["map_id"].dataType.simpleString()
    return spark.createDataFrame([(r.map_id, where.get(r.map_id, "train")) for r in rows], f"map_id {kind}, split string")


def legacy_split(map_ids: list[str], seed: int, share: float = 0.1) -> dict[str, str]:
    """The split of a list of maps by one generator that is drawn from in a fixed order: an older plan's form, which depends on the order of all
    maps and so stays on the driver. round(n * share) maps each, 1 at least, are test and val."""
    order = sorted(map_ids)
    random.Random(seed).shuffle(order)
    side = max(1, round(len(order) * share))
    return {m: "test" if i < side else "val" if i < 2 * side else "train" for i, m in enumerate(order)}
