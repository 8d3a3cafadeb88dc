"""
and FIXTURES.md §5): fuel 'click', as_of = newest observation."""

import pytest

from pumpline.operators import alerts, gold, series
from pumpline.sources import testdata

CASES = {
    # sf: (drops 24 h, drops 72 h, anomalies |z|>=2 over 168 h, days, gold rows or None)
    "/root/testdata/sf0.001": (1, 4, 4, 30, None),
    "/root/testdata/sf0.01": (6, 32, 22, 30, 1499),
}


@pytest.mark.parametrize("sf", sorted(CASES))
def test_golden_counts(spark, sf):
    d24, d72, anom, days, gold_rows = CASES[sf]
    s = testdata.silver(spark, sf)
    assert alerts.price_drop(s, "click", hours=24, pct_drop=3.0).count() == d24
    assert alerts.price_drop(s, "click", hours=72, pct_drop=3.0).count() == d72
    assert alerts.anomalies(s, "click", hours=168, z=2.0, limit=2000).count() == anom
    assert series.timeseries_daily(s, page_size=200).total() == days
    if gold_rows is not None:
        assert gold.gold_latest(s).count() == gold_rows == testdata.gold(spark, sf).count()
