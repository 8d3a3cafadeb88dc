"""Plan shape: the properties the scale design relies on show in explain()."""

import contextlib
import io

import pytest

from pumpline.operators import alerts, gold, nearby, series, silver
from pumpline.plans import medallion, raw_registry
from pumpline.sources import raw as rawsrc


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored(spark, sf_small):
    layers = raw_registry.layers(spark, sf_small)
    return rawsrc.scan_table(spark, layers.gold), medallion.read_silver(spark, layers)


def test_latest_row_limits_before_shuffle(stored):
    _, s = stored
    p = plan(gold.gold_latest(s))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_dedup_limits_before_shuffle(stored):
    _, s = stored
    assert "WindowGroupLimit" in plan(silver.silver_dedup(s))


def test_radius_box_reaches_parquet(stored):
    g, _ = stored
    p = plan(nearby.prices_nearby(g, -12.9, -38.7, 25.0))
    assert "GreaterThanOrEqual(lat" in p and "LessThanOrEqual(lng" in p


def test_time_range_prunes_day_folders(stored):
    _, s = stored
    p = plan(series.timeseries_city(s, "click", date_from="2024-01-10", date_to="2024-01-12").items)
    assert "PartitionFilters" in p and "obs_date" in p.split("PartitionFilters")[1].split("\n")[0]


def test_column_pruning(stored):
    _, s = stored
    p = plan(series.timeseries_daily(s).items)
    read = [line for line in p.splitlines() if line.startswith("ReadSchema")][0]
    assert "station_name" not in read and "price_unit" in read


def test_price_drop_aggregates_by_hash(stored):
    """Neither the price pass nor the labels use the object aggregate, which
    falls back to sorting; texts are made distinct before their max."""
    _, s = stored
    for p in (plan(alerts.price_drop_all(s, hours=48)), plan(gold.station_labels(s))):
        p = p.split("===== Subqueries")[0]
        assert "ObjectHashAggregate" not in p and "HashAggregate" in p


def test_no_cartesian_product(stored):
    g, _ = stored
    from pyspark.sql import functions as F
    pts = g.select(F.col("cnpj").alias("point_id"), F.col("lat").alias("p_lat"), F.col("lng").alias("p_lng"))
    p = plan(nearby.nearby_join(pts, g, 5.0))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
