import pytest

from pumpline.functions import params
from pumpline.operators import alerts, lookups, nearby, paging, ranking, series
from tests.helpers import obs, silver_df


def test_parse_ts_accepts_iso_and_rejects_garbage():
    assert params.parse_ts("x", "2024-01-02 03:04:05").hour == 3
    assert params.parse_ts("x", "2024-01-02T03:04:05+02:00").hour == 1
    with pytest.raises(ValueError):
        params.parse_ts("date_from", "yesterday")
    with pytest.raises(ValueError):
        params.time_range("2024-01-05", "2024-01-01")


def test_bounds(spark):
    g = silver_df(spark, [obs(1, 5.0, 1)])
    with pytest.raises(ValueError):
        paging.latest_prices(g, page=0)
    with pytest.raises(ValueError):
        paging.latest_prices(g, order_by="cnpj; DROP TABLE x")
    with pytest.raises(ValueError):
        paging.latest_prices(g, order_dir="sideways")
    with pytest.raises(ValueError):
        paging.latest_prices(g, page_size=201)
    with pytest.raises(ValueError):
        lookups.cities(g, uf="BAH")
    with pytest.raises(ValueError):
        nearby.prices_nearby(g, -12.9, -38.5, radius_km=0)
    with pytest.raises(ValueError):
        nearby.prices_nearby(g, -12.9, -38.5, order_by="price_net")
    with pytest.raises(ValueError):
        ranking.best_prices(g, None)
    with pytest.raises(ValueError):
        alerts.price_drop(g, "GASOLINA", hours=169)
    with pytest.raises(ValueError):
        alerts.price_drop(g, "GASOLINA", pct_drop=0)
    with pytest.raises(ValueError):
        alerts.anomalies(g, "GASOLINA", z=0.5)
    with pytest.raises(ValueError):
        series.timeseries_daily(g, date_from="not a date")


def test_order_dir_is_case_insensitive(spark):
    g = silver_df(spark, [obs(1, 5.0, 1), obs(2, 4.0, 1)])
    rows = paging.latest_prices(g, order_dir=" DESC ").items.collect()
    assert [r.cnpj for r in rows] == [1, 2]
