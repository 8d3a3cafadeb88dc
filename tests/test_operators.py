"""Operator semantics on small rows with known answers (FIXTURES.md §6)."""


from pyspark.sql import functions as F

from pumpline.operators import alerts, gold, lookups, nearby, paging, ranking, series, silver
from tests.helpers import T0, obs, silver_df


def test_gold_latest_two_products_one_fuel(spark):
    rows = [obs(1, 5.0, 10, code="A"), obs(1, 5.5, 5, code="A"), obs(1, 6.0, 8, code="B"), obs(2, 4.0, 3, code="A")]
    g = gold.gold_latest(silver_df(spark, rows))
    got = sorted((r.cnpj, r.product_code, r.price_unit) for r in g.collect())
    assert got == [(1, "A", 5.5), (1, "B", 6.0), (2, "A", 4.0)]


def test_dedup_keeps_earliest_collection(spark):
    rows = [obs(1, 5.0, 10, run="r2", collected_hours_ago=1), obs(1, 5.0, 10, run="r1", collected_hours_ago=9),
            obs(1, 5.1, 9, run="r2", collected_hours_ago=1)]
    d = silver.silver_dedup(silver_df(spark, rows)).collect()
    assert len(d) == 2
    assert {r.run_id for r in d if r.price_unit == 5.0} == {"r1"}
    # idempotent
    assert silver.silver_dedup(silver.silver_dedup(silver_df(spark, rows))).count() == 2


def test_null_ordering_and_ties(spark):
    rows = [obs(3, 5.0, 1), obs(1, 5.0, 1), obs(2, 4.0, 2), obs(4, None, 1)]
    g = silver_df(spark, rows)
    asc = [r.cnpj for r in paging.latest_prices(g, order_by="price_unit", order_dir="asc").items.collect()]
    desc = [r.cnpj for r in paging.latest_prices(g, order_by="price_unit", order_dir="desc").items.collect()]
    assert asc == [2, 1, 3, 4]          # ties broken by cnpj, nulls last
    assert desc == [1, 3, 2, 4]         # nulls last in both directions
    best = [r.cnpj for r in ranking.best_prices(g, "GASOLINA").collect()]
    assert best == [2, 1, 3, 4]


def test_pages_cover_population_without_overlap(spark):
    rows = [obs(i, float(i % 3), i) for i in range(1, 24)]
    g = silver_df(spark, rows)
    seen = []
    for p in range(1, 6):
        page = paging.latest_prices(g, page=p, page_size=5)
        seen += [r.cnpj for r in page.items.collect()]
    assert sorted(seen) == list(range(1, 24))
    assert paging.latest_prices(g, page=1, page_size=5).total() == 23
    assert paging.latest_prices(g, page=9, page_size=5).items.count() == 0     # page past the end


def test_keyset_equals_offset(spark):
    rows = [obs(i % 7, float(i), i % 5, code=f"P{i % 3}") for i in range(40)]
    g = gold.gold_latest(silver_df(spark, rows))
    order = [F.col(c).desc() for c in paging.KEYSET_COLUMNS]
    full = [tuple(r) for r in g.orderBy(*order).select(*paging.KEYSET_COLUMNS).collect()]
    cursor = full[4]
    nxt = [tuple(r) for r in paging.keyset_page(g, cursor=cursor, page_size=5)
           .select(*paging.KEYSET_COLUMNS).collect()]
    assert nxt == full[5:10]


def test_price_drop_semantics(spark):
    rows = [
        obs(1, 10.0, 30), obs(1, 9.0, 2),          # 10 % drop
        obs(2, 0.0, 30), obs(2, 1.0, 2),           # avg_prev = 0 -> no division error, no alert
        obs(3, 5.0, 2),                            # only in the last window
        obs(4, 5.0, 30), obs(4, 5.2, 2),           # rise
    ]
    s = silver_df(spark, rows)
    res = alerts.price_drop(s, "GASOLINA", hours=24, pct_drop=3.0, as_of=T0).collect()
    assert [(r.cnpj, round(r.pct_drop, 6)) for r in res] == [(1, 10.0)]
    assert alerts.price_drop(s, "GASOLINA", hours=24, pct_drop=3.0, as_of=T0, label_scope="window").count() == 1


def test_anomalies_n1_sigma0_and_threshold(spark):
    one = silver_df(spark, [obs(1, 5.0, 1)])
    assert alerts.anomalies(one, "GASOLINA", as_of=T0).count() == 0            # n = 1
    flat = silver_df(spark, [obs(i, 5.0, 1) for i in range(5)])
    assert alerts.anomalies(flat, "GASOLINA", as_of=T0).count() == 0           # sigma = 0
    rows = [obs(i, 5.0, 1) for i in range(10)] + [obs(99, 50.0, 1)]
    res = alerts.anomalies(silver_df(spark, rows), "GASOLINA", z=2.0, as_of=T0).collect()
    assert [r.cnpj for r in res] == [99]
    assert alerts.anomalies(silver_df(spark, rows), "ETANOL", as_of=T0).count() == 0   # empty scope


def test_anomalies_by_scope_matches_single_scope(spark):
    rows = [obs(i, 5.0 + (i % 3) * 0.1, 1, city="A" if i < 10 else "B") for i in range(20)] + [obs(99, 9.0, 1, city="B")]
    s = silver_df(spark, rows)
    per_city = alerts.anomalies_by_scope(s, z=2.0, as_of=T0).filter("scope = 'fuel_uf_city' AND scope_city = 'B'")
    single = alerts.anomalies(s, "GASOLINA", uf="BA", city="B", z=2.0, as_of=T0)
    assert sorted(r.cnpj for r in per_city.collect()) == sorted(r.cnpj for r in single.collect())


def test_daily_rollup_equals_direct(spark):
    rows = [obs(i % 4, 3.0 + i * 0.01, i * 5, city="C" + str(i % 2)) for i in range(60)]
    s = silver_df(spark, rows)
    assert series.kpi_consistency(s).filter(~F.col("consistent")).count() == 0
    direct = {r.day: r.avg_price_unit for r in series.timeseries_daily(s, page_size=200).items.collect()}
    rolled = {r.day: r.avg_price_unit for r in series.daily_from_base(gold.timeseries_base(s)).collect()}
    # Plain double sums: equal up to the order of addition.
    assert direct.keys() == rolled.keys() and all(abs(direct[d] - rolled[d]) <= 1e-12 * abs(direct[d]) for d in direct)


def test_station_detail_and_unknown_station(spark):
    rows = [obs(1, 5.0, 3, code="A"), obs(1, 6.0, 1, code="B"), obs(2, 4.0, 1)]
    g = gold.gold_latest(silver_df(spark, rows))
    d = lookups.station_detail(g, cnpj=1).collect()
    assert len(d) == 1 and [f.product_code for f in d[0].fuels] == ["B", "A"]
    assert lookups.station_detail(g, cnpj=12345).count() == 0


def test_search_is_literal(spark):
    rows = [obs(1, 5.0, 1, name="POSTO 100%"), obs(2, 5.0, 1, name="POSTO 1000")]
    g = silver_df(spark, rows)
    assert [r.cnpj for r in lookups.station_search(g, q="100%").collect()] == [1]


def test_nearby_and_proximity_join_against_brute_force(spark):
    rows = [obs(i, 5.0, 1, lat=-13.0 + (i % 10) * 0.05, lng=-38.8 + (i // 10) * 0.05) for i in range(100)]
    g = silver_df(spark, rows)
    near = nearby.prices_nearby(g, -12.8, -38.6, radius_km=10, limit=500).collect()
    from math import asin, cos, radians, sin, sqrt

    def hav(a, b, c, d):
        return 2 * 6371 * asin(sqrt(sin(radians(c - a) / 2) ** 2 + cos(radians(a)) * cos(radians(c)) * sin(radians(d - b) / 2) ** 2))
    brute = {r[4] for r in rows if hav(-12.8, -38.6, r[12], r[13]) <= 10}
    assert {r.cnpj for r in near} == brute
    pts = spark.createDataFrame([(1, -12.9, -38.7), (2, -12.7, -38.5)], "point_id int, p_lat double, p_lng double")
    pairs = {(r.point_id, r.cnpj) for r in nearby.nearby_join(pts, g, 7.0).collect()}
    brute_pairs = {(p, r[4]) for p, a, b in [(1, -12.9, -38.7), (2, -12.7, -38.5)] for r in rows
                   if hav(a, b, r[12], r[13]) <= 7.0}
    assert pairs == brute_pairs


def test_unit_canonical(spark):
    df = spark.createDataFrame([("L",), ("lt",), ("LTS",), ("LITRO",), ("M3",), ("KG",)], "unit string")
    got = [r.unit for r in silver.unit_canonical(df).collect()]
    assert got == ["L", "L", "L", "L", "M3", "KG"]


def test_price_compare_scope_empty_and_one_row(spark):
    g = silver_df(spark, [obs(1, 5.0, 1, city="A"), obs(2, 7.0, 1, city="A"), obs(3, 9.0, 1, city="B")])
    one = series.price_compare_scope(g, "GASOLINA", city="A").collect()
    assert len(one) == 1 and one[0].stations == 2 and one[0].avg_price_unit == 6.0
    empty = series.price_compare_scope(g, "ETANOL").collect()
    assert len(empty) == 1 and empty[0].stations == 0 and empty[0].avg_price_unit is None


def test_stats_summary_approx_close_to_exact(spark, sf_small):
    from pumpline.sources import testdata
    s = testdata.silver(spark, sf_small)
    exact = series.stats_summary(s).first()
    approx = series.stats_summary(s, approx=True).first()
    assert exact.rows == approx.rows and abs(exact.avg_price_unit - approx.avg_price_unit) < 1e-9
    for c in ("stations", "cities", "ufs"):
        assert abs(getattr(approx, c) - getattr(exact, c)) <= max(1, 0.05 * getattr(exact, c))


def _rounded(rows):
    """Rows with doubles to 9 decimals: sums of doubles differ beyond."""
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=str)


def test_daily_series_from_base_equals_history(spark):
    rows = [obs(i % 4, 3.0 + i * 0.01, i * 5, city="C" + str(i % 2)) for i in range(80)]
    s = silver_df(spark, rows)
    base = gold.timeseries_base(s)
    for lo, hi in [(None, None), ("2024-01-02", "2024-01-08 23:59:59.999999"), ("2024-01-03 06:00:00", None)]:
        direct = series.timeseries_city(s, "GASOLINA", city="C1", date_from=lo, date_to=hi, page_size=500).items
        rolled = series.timeseries_city(s, "GASOLINA", city="C1", date_from=lo, date_to=hi, page_size=500,
                                        base=base).items
        assert _rounded(direct.collect()) == _rounded(rolled.collect())


def test_stats_summary_from_base_equals_history(spark):
    rows = [obs(i % 5, 3.0 + i * 0.01, i * 3, city="C" + str(i % 3)) for i in range(90)]
    s = silver_df(spark, rows)
    base = gold.timeseries_base(s)
    for lo, hi, city in [(None, None, None), ("2024-01-03", "2024-01-08 23:59:59.999999", "C1"),
                         ("2024-01-20", "2024-01-21 23:59:59.999999", None)]:
        direct = series.stats_summary(s, date_from=lo, date_to=hi, city=city).collect()
        rolled = series.stats_summary(s, date_from=lo, date_to=hi, city=city, base=base).collect()
        assert _rounded(direct) == _rounded(rolled)
