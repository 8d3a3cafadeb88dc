"""Results do not depend on the session time zone."""

import pytest

from __spark_entry__ import queries

NAMES = ["timeseries_daily", "silver_from_raw", "stream_daily", "anomalies", "run_log", "stats_summary_filtered"]


@pytest.mark.parametrize("name", NAMES)
def test_same_answer_in_another_zone(spark, sf_small, name):
    utc = sorted(queries()[name](spark, sf_small).collect())
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        from pumpline.plans import raw_registry, snapshots, stream_registry
        snapshots._TREES.clear(); stream_registry._CHAIN.clear(); raw_registry._LAYERS.clear()
        other = sorted(queries()[name](spark, sf_small).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert other == utc
