"""Every registered query of the engine's own operators against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from quarry.plans import catalog

SF = os.environ.get("QUARRY_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def norm(rows):
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in rows)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for file in os.listdir(SF):
        c.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{file}')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = df.select(*columns).collect()
    if name in catalog.ORACLES:
        got = duck.execute(catalog.ORACLES[name])
        names = [d[0] for d in got.description]
        assert sorted(names) == columns
        order = [names.index(c) for c in columns]
        assert norm(rows) == norm([[r[i] for i in order] for r in got.fetchall()])
    else:
        assert rows


def test_entry_runs(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns[0] == "image_id" and df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_every_spawn_is_an_anchor(spark):
    from quarry.plans.views import view

    spawns = view(spark, SF, "spawns").collect()
    maps = {}
    for s in spawns:
        maps.setdefault(s.map_id, []).append(s)
    expected = {(a.map_id, a.spawn_id): sum(abs(a.x - b.x) <= 350 and abs(a.y - b.y) <= 70 for b in maps[a.map_id]) for a in spawns}
    got = catalog.QUERIES["spawns_near_anchors"](spark, SF).collect()
    assert len(got) == len(spawns) and {(r.map_id, r.spawn_id): r.near for r in got} == expected


def test_tiles_repeat_by_their_width(spark):
    """positions() of the reference, with the sprite's width as the step."""
    import math

    from quarry.plans.views import view

    expected = {}
    for b in view(spark, SF, "boxes").collect():
        base, step = b.x - 640, max(1, b.w)
        at = [base + i * step for i in range(math.floor((-b.w - base) / step) + 1, math.ceil((1280 - base) / step))]
        expected[b.image_id, b.idx] = (len(at), min(at), max(at), sum(at))
    got = catalog.QUERIES["tiled_positions"](spark, SF).collect()
    assert {(r.image_id, r.idx): (r.places, r.first_place, r.last_place, r.total) for r in got} == expected


def test_all_surveyed_rules_of_counts_and_lines_report(spark):
    got = {r.rule_id for r in catalog.QUERIES["validate_plan_counts"](spark, SF).select("rule_id").distinct().collect()}
    assert got == {f"VAL-{r}" for r in ("A5", "A6", "B5", "B6", "B7", "B8", "B9", "B35", "C8", "D2", "D6")}


@pytest.mark.parametrize("name", ["scene_labels", "scene_hidden_objects"])
def test_no_image_is_drawn_for_boxes(spark, name):
    assert "image" not in catalog.QUERIES[name](spark, SF)._jdf.queryExecution().analyzed().toString()


def test_asset_keys_of_large_numbers(spark, tmp_path):
    """Keys past the range of int, which the SQL itself refuses."""
    spark.range(1_199_990, 1_200_000).selectExpr("id as p_partkey", "'Brand#11' as p_brand", "'t' as p_type", "1 as p_size").write.parquet(str(tmp_path / "part.parquet"))
    got = catalog.QUERIES["asset_keys"](spark, str(tmp_path)).collect()
    assert sorted((r.item, r.hex) for r in got) == [(i, f"{i * 99991:016x}") for i in range(1_199_990, 1_200_000)]
