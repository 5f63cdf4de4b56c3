"""Validation rules: each finds its violations as rows (rule_id, key, detail)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import geometry as g
from quarry.functions import text as t

from . import layout


def violations(df: DataFrame, rule: str, key: Column, broken: Column, detail: Column | str = "") -> DataFrame:
    """Rows where a rule is broken; an unknown (null) outcome counts as broken."""
    detail = F.lit(detail) if isinstance(detail, str) else detail
    return df.where(F.coalesce(broken, F.lit(True))).select(F.lit(rule).alias("rule_id"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def row_rules(df: DataFrame, key: Column, rules: list[tuple[str, Column, Column | str]]) -> DataFrame:
    """Several rules over the same rows in one pass: the broken ones are collected per row and exploded."""
    made = [F.when(F.coalesce(broken, F.lit(True)), F.struct(F.lit(r).alias("rule_id"), key.cast("string").alias("key"), (F.lit(d) if isinstance(d, str) else d).cast("string").alias("detail"))) for r, broken, d in rules]
    return df.select(F.explode(F.filter(F.array(*made), lambda x: x.isNotNull())).alias("v")).select("v.*")


def missing_keys(expected: DataFrame, listing: DataFrame, rule: str, key: str) -> DataFrame:
    """Expected files or keys that are not listed."""
    return violations(expected.join(listing.select(key), key, "left_anti"), rule, F.col(key), F.lit(True), "missing")


def unexpected(expected: DataFrame, actual: DataFrame, rule: str, key: str) -> DataFrame:
    """Keys on one side only."""
    a = expected.select(F.col(key).alias("e"))
    joined = a.join(actual.select(F.col(key).alias("f")), F.col("e") == F.col("f"), "full").where("e is null or f is null")
    return violations(joined, rule, F.coalesce("e", "f"), F.lit(True), F.when(F.col("e").isNull(), "extra").otherwise("missing"))


def repeated(df: DataFrame, rule: str, keys: list[str]) -> DataFrame:
    """Combinations that occur more than once."""
    rows = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return violations(rows, rule, F.concat_ws("/", *keys), F.lit(True), F.col("n"))


def later_copies(df: DataFrame, rule: str, digest: str, order: str, key: str) -> DataFrame:
    """Rows that repeat the digest of an earlier one."""
    first = df.groupBy(digest).agg(F.min(order).alias("_first"))
    return violations(df.join(first, digest), rule, F.col(key), F.col(order) != F.col("_first"), "copy")


def histogram(actual: DataFrame, expected: DataFrame, rule: str, column: str) -> DataFrame:
    """Keys whose counts differ from the plan's."""
    a = actual.groupBy(F.col(column).cast("string").alias("k")).agg(F.count("*").alias("n"))
    e = expected.groupBy(F.col(column).cast("string").alias("k")).agg(F.count("*").alias("m"))
    joined = a.join(e, "k", "full")
    return violations(joined, rule, F.col("k"), ~F.col("n").eqNullSafe(F.col("m")), F.concat_ws(" of ", F.coalesce("n", F.lit(0)).cast("string"), F.coalesce("m", F.lit(0)).cast("string")))


def box_rules(boxes: DataFrame, prefix: str, rules: dict[str, str], least: int = g.LEAST) -> DataFrame:
    """Rules on single labels. rules: name -> id, of frame, area, death, ground, visible."""
    key = F.concat_ws("/", F.col("image_id").cast("string"), F.col("idx").cast("string"))
    tests = {
        "frame": ~g.inside(least=least),
        "area": F.col("area") != F.col("w") * F.col("h"),
        "death": (F.col("class_id") == 0) & F.lower("action").rlike(t.DEAD),
        "ground": (F.col("class_id") == 0) & (F.coalesce("ground_error", F.lit(0.0)) > 2),
        "visible": F.coalesce("visible_fraction", F.lit(1.0)) < 0.3,
    }
    return row_rules(boxes, key, [(f"{prefix}{rules[n]}", tests[n], n) for n in tests if n in rules])


def box_counts(images: DataFrame, boxes: DataFrame, rule: str, expected: str, where: str) -> DataFrame:
    """Images whose number of labels differs from the planned one; images without any count 0."""
    n = boxes.where(where).groupBy("image_id").agg(F.count("*").alias("n"))
    joined = images.select("image_id", expected).join(n, "image_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return violations(joined, rule, F.col("image_id"), F.col("n") != F.col(expected), F.concat_ws(" of ", F.col("n").cast("string"), F.col(expected).cast("string")))


def count_range(images: DataFrame, boxes: DataFrame, rule: str, low: int, high: int) -> DataFrame:
    n = boxes.groupBy("image_id").agg(F.count("*").alias("n"))
    joined = images.select("image_id").join(n, "image_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return violations(joined, rule, F.col("image_id"), ~F.col("n").between(low, high), F.col("n"))


def orphans(boxes: DataFrame, images: DataFrame, rule: str) -> DataFrame:
    return missing_keys(boxes.select("image_id").distinct(), images, rule, "image_id")


def leakage(images: DataFrame, rule: str, key: str = "map_id") -> DataFrame:
    rows = images.groupBy(key).agg(F.count_distinct("split").alias("n"))
    return violations(rows, rule, F.col(key), F.col("n") > 1, F.col("n"))


def layouts(images: DataFrame, boxes: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Layout verdicts (rule per layout) and the multi-platform rule (key platform)."""
    m = layout.layout_measures(boxes).join(images.select("image_id", "layout", "multi_platform"), "image_id")
    valid = F.coalesce(layout.layout_valid(), F.lit(True))
    tests = [(rule, F.col("layout").eqNullSafe(name) & ~valid, F.col("layout")) for name, rule in rules.items() if name != "platform"]
    return row_rules(m, F.col("image_id"), [*tests, (rules["platform"], F.coalesce(F.col("multi_platform") & (F.col("footholds") < 2), F.lit(False)), F.col("footholds"))])


def yolo_grammar(lines: DataFrame, key: str, line: str, grammar: str, coordinates: str, classes: int) -> DataFrame:
    """Rules on label lines: five fields with a known class, coordinates in [0, 1]."""
    f = F.split(F.trim(line), r"\s+")
    known = (F.size(f) == 5) & F.element_at(f, 1).rlike(r"^\d+$") & (F.expr(f"try_cast(element_at(split(trim({line}), '\\\\s+'), 1) as int)") < classes)
    inside = F.forall(F.transform(F.slice(f, 2, 4), lambda x: x.try_cast("double")), lambda v: F.coalesce(v.between(0, 1), F.lit(False)))
    return row_rules(lines, F.col(key), [(grammar, ~known, F.col(line)), (coordinates, (F.size(f) == 5) & ~inside, F.col(line))])


def line_differs(line: str, width: int = g.WIDTH, height: int = g.HEIGHT) -> Column:
    """Whether a label line is not class_id and the box x, y, w, h as shares of the frame, to 1e-7; a null line is."""
    f = F.split(F.trim(line), r"\s+")
    own = [(F.col("x") + F.col("w") / 2) / width, (F.col("y") + F.col("h") / 2) / height, F.col("w") / width, F.col("h") / height]
    got = [F.get(f, F.lit(n + 1)).try_cast("double") for n in range(4)]
    near = [a.between(0, 1) & (F.abs(a - b) <= 1e-7) for a, b in zip(got, own, strict=True)]
    same = (F.size(f) == 5) & F.col("class_id").isin(0, 1) & (F.get(f, F.lit(0)).try_cast("int") == F.col("class_id"))
    for x in near:
        same = same & x
    return ~F.coalesce(same, F.lit(False))


def below_minimum(counts: DataFrame, rule: str, key: Column, minimum: int) -> DataFrame:
    return violations(counts, rule, key, F.col("n") < minimum, F.col("n"))


def single(spark, df: DataFrame, rule: str, broken: Column, detail: Column) -> DataFrame:
    """A rule on one aggregated row."""
    return violations(df, rule, F.lit("dataset"), broken, detail)


def first_bad(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first violation of each key."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_r = 1").drop("_r")

