"""Views of the driver tables that stand in for labels, maps, manifests and schedules.

Each view is one SQL text that Spark and DuckDB both run (a second text where the dialects differ);
integers only, so both engines agree to the bit.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: name -> (text, DuckDB's text where it differs); {name} is a table or another view.
VIEWS: dict[str, tuple[str, str | None]] = {
    "boxes": (
        """SELECT l_orderkey AS image_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS INT) AS idx,
        CAST(l_partkey % 1200 AS INT) AS x, CAST(l_suppkey % 180 AS INT) AS y, CAST(4 + floor(l_quantity) AS INT) AS w, CAST(4 + l_linenumber * 5 AS INT) AS h,
        CAST(l_linenumber % 2 AS INT) AS class_id, CAST(l_partkey % 40 AS INT) AS mob_id, CAST(l_linenumber % 7 AS INT) AS action_no, CAST(l_suppkey % 4 AS INT) AS foothold_id FROM {lineitem}""",
        None,
    ),
    "images": (
        """SELECT o_orderkey AS image_id, CASE WHEN o_orderkey % 10 = 0 THEN 'test' WHEN o_orderkey % 10 = 1 THEN 'val' ELSE 'train' END AS split,
        CASE o_orderkey % 9 WHEN 0 THEN 'dense_moderate' WHEN 1 THEN 'edge_crop' WHEN 2 THEN 'foreground_occlusion' WHEN 3 THEN 'negative_pet' WHEN 4 THEN 'natural_sparse' WHEN 5 THEN 'monster_pet' WHEN 6 THEN 'negative_loot_dense' WHEN 7 THEN 'edge_occlusion_mixed' ELSE 'multi_platform' END AS scenario,
        CASE o_orderkey % 5 WHEN 0 THEN 'distributed' WHEN 1 THEN 'clustered' WHEN 2 THEN 'overlap' WHEN 3 THEN 'severe_overlap' ELSE 'none' END AS layout,
        o_orderkey % 3 = 0 AS multi_platform, CAST(o_custkey % 60 AS INT) AS map_id, o_orderpriority AS quota_key FROM {orders}""",
        None,
    ),
    "spawns": (
        """SELECT map_id, CAST(row_number() OVER (PARTITION BY map_id ORDER BY a, b, c, d, e, f) AS INT) AS spawn_id, mob_id, x, y, fh, kind FROM (
        SELECT CAST(l_suppkey AS INT) AS map_id, CAST(l_partkey % 40 AS INT) AS mob_id, CAST(floor(l_extendedprice) % 3000 AS INT) AS x, CAST(floor(l_tax * 100) * 25 AS INT) AS y, CAST(l_linenumber AS INT) AS fh,
        CASE WHEN l_returnflag = 'R' THEN 'n' ELSE 'm' END AS kind, l_orderkey AS a, l_linenumber AS b, l_partkey AS c, l_extendedprice AS d, l_tax AS e, l_returnflag AS f FROM {lineitem}) t""",
        None,
    ),
    "footholds": (
        """SELECT map_id, fh AS foothold_id, x1, y1, x1 + CASE WHEN fh = 7 THEN 0 ELSE 150 + fh * 17 END AS x2, y1 + (fh % 3 - 1) * 13 AS y2 FROM (
        SELECT DISTINCT CAST(l_suppkey AS INT) AS map_id, CAST(l_linenumber AS INT) AS fh, CAST((l_suppkey * 37 + l_linenumber * 401) % 3000 AS INT) AS x1, CAST(l_linenumber * 25 AS INT) AS y1 FROM {lineitem} WHERE l_linenumber <> 5) t""",
        None,
    ),
    "manifest": (
        """SELECT doc_id AS ordinal, CASE WHEN doc_id % 10 = 0 THEN 'test' WHEN doc_id % 10 = 1 THEN 'val' ELSE 'train' END AS split, source AS scenario,
        coalesce(text, '') AS payload, CAST(doc_id % 6 AS INT) AS box_count, sha2(coalesce(text, ''), 256) AS sha256 FROM {documents}""",
        """SELECT doc_id AS ordinal, CASE WHEN doc_id % 10 = 0 THEN 'test' WHEN doc_id % 10 = 1 THEN 'val' ELSE 'train' END AS split, source AS scenario,
        coalesce(text, '') AS payload, CAST(doc_id % 6 AS INT) AS box_count, sha256(coalesce(text, '')) AS sha256 FROM documents""",
    ),
    "signatures": (
        """SELECT vec_id AS ordinal, CAST(conv(substr(md5(CAST(vec_id - vec_id % 5 AS STRING)), 1, 15), 16, 10) AS BIGINT)
        ^ CASE vec_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 1048576 WHEN 3 THEN 4398046511105 ELSE 4398046511107 END AS sig FROM {embeddings}""",
        """SELECT vec_id AS ordinal, xor(CAST('0x' || substr(md5(CAST(vec_id - vec_id % 5 AS VARCHAR)), 1, 15) AS BIGINT),
        CAST(CASE vec_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 1048576 WHEN 3 THEN 4398046511105 ELSE 4398046511107 END AS BIGINT)) AS sig FROM embeddings""",
    ),
    "uses": (
        """SELECT CAST(user_id % 300 AS INT) AS item, event_type AS category, CASE WHEN event_id % 10 = 0 THEN 'test' WHEN event_id % 10 = 1 THEN 'val' ELSE 'train' END AS split, event_id FROM {events}""",
        None,
    ),
    "items": (
        """SELECT CAST(p_partkey AS INT) AS item, p_brand AS category, p_type AS grouping, CAST(4 + p_size * 3 AS INT) AS width, CAST(4 + p_partkey % 90 AS INT) AS height, CAST(p_partkey % 100 AS INT) AS saturation FROM {part}""",
        None,
    ),
}


def _names(text: str) -> list[str]:
    return re.findall(r"\{(\w+)\}", text)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view or table as a DataFrame."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name][0]
    return spark.sql(text, **{n: view(spark, sf_dir, n) for n in dict.fromkeys(_names(text))})


def with_views(sql: str) -> str:
    """DuckDB SQL with the views it names, written {name}, put before it as common table expressions."""
    parts = []
    for n in dict.fromkeys(_names(sql)):
        if n in VIEWS:
            text = VIEWS[n][1] or re.sub(r"\{(\w+)\}", r"\1", VIEWS[n][0])
            parts.append(f"{n} AS ({text})")
    body = re.sub(r"\{(\w+)\}", r"\1", sql).strip()
    if not parts:
        return body
    for start in ("WITH RECURSIVE", "WITH"):
        if body.upper().startswith(start):
            return f"{start} {', '.join(parts)}, {body[len(start):].lstrip()}"
    return f"WITH {', '.join(parts)} {body}"
