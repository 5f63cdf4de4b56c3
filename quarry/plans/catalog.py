"""All registered queries of the engine's own operators."""

from __future__ import annotations

from . import asset_queries, coverage_queries, dedup_queries, file_queries, file_rule_queries, frame_queries, label_queries, map_queries, planning_queries, quota_queries, validation_queries  # noqa: F401
from .registry import ORACLES, QUERIES

#: Columns that DuckDB types more widely than Spark: row numbers are long there, sums of counts 128 bits.
RESULT_TYPES = {
    "item_coverage_minima": {"below": "BIGINT"},
    "map_audit": {"npcs": "BIGINT"},
    "pieces_in_view": {"visible": "BIGINT"},
    "first_names": {"place": "INTEGER"},
    "overlap_image_ratio": {"overlap_images": "BIGINT"},
    "nearest_foothold": {"distance": "BIGINT"},
    "locations_in_view": {"visible": "BIGINT"},
    "visual_checks": {"checks": "BIGINT"},
    "least_used_items": {"pick": "INTEGER"},
    "top_maps": {"rank": "INTEGER"},
    "label_line_agreement": {"line_no": "INTEGER"},
}
for _name, _types in RESULT_TYPES.items():
    _casts = ", ".join(f"{c}::{t} AS {c}" for c, t in _types.items())
    ORACLES[_name] = f"SELECT * REPLACE ({_casts}) FROM ({ORACLES[_name]}) typed"
