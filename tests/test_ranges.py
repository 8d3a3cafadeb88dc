"""Edge days beside the stored base, collections across midnight, cursors with
mixed directions, scope statistics, pruning to the touched days."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from pumpline.operators import alerts, gold, paging, runs, series
from pumpline.plans import medallion
from pumpline.schema import MANIFEST_SCHEMA
from tests.helpers import T0, obs, silver_df

AT = dt.datetime


@pytest.mark.parametrize("lo, hi, days, edges", [
    (None, None, (None, None), []),
    (AT(2024, 1, 5), AT(2024, 1, 7, 23, 59, 59, 999999), (AT(2024, 1, 5), AT(2024, 1, 7)), []),
    (AT(2024, 1, 5, 1), AT(2024, 1, 7, 23, 59, 59), (AT(2024, 1, 6), AT(2024, 1, 6)),
     [(AT(2024, 1, 5, 1), AT(2024, 1, 5, 23, 59, 59, 999999)), (AT(2024, 1, 7), AT(2024, 1, 7, 23, 59, 59))]),
    (AT(2024, 1, 5, 1), AT(2024, 1, 5, 2), None, [(AT(2024, 1, 5, 1), AT(2024, 1, 5, 2))]),
    (AT(2024, 1, 5, 1), AT(2024, 1, 6, 2), None, [(AT(2024, 1, 5, 1), AT(2024, 1, 6, 2))]),
    (None, AT(2024, 1, 7), (None, AT(2024, 1, 6)), [(AT(2024, 1, 7), AT(2024, 1, 7))]),
    (AT(2024, 1, 5, 1), None, (AT(2024, 1, 6), None), [(AT(2024, 1, 5, 1), AT(2024, 1, 5, 23, 59, 59, 999999))]),
])
def test_days_are_split(lo, hi, days, edges):
    assert series.split_days(lo, hi) == (days, edges)


def test_base_and_edges_equal_the_history(spark):
    rng = random.Random(4)
    s = silver_df(spark, [obs(i % 5, rng.choice([4.0, 5.25, 6.5]), rng.randint(0, 300) + rng.random()) for i in range(400)]).cache()
    base = gold.timeseries_base(s)
    for _ in range(6):
        a, b = sorted(T0 - dt.timedelta(hours=rng.randint(0, 320), seconds=rng.randint(0, 3599)) for _ in range(2))
        for fn in (lambda **k: series.timeseries_daily(s, date_from=a, date_to=b, page_size=50, **k).items, lambda **k: series.stats_summary(s, a, b, **k)):
            want, got = fn().collect(), fn(base=base).collect()
            assert [[round(x, 9) if isinstance(x, float) else x for x in r] for r in got] == [[round(x, 9) if isinstance(x, float) else x for x in r] for r in want]


def test_only_the_cut_days_are_read_from_the_history(spark):
    """Observations of whole days and base rows of cut days do not count."""
    s = silver_df(spark, [obs(1, 5.0, h) for h in range(0, 96, 6)])
    base = gold.timeseries_base(s.withColumn("price_unit", F.lit(1.0)))
    rows = series.timeseries_daily(s, date_from=AT(2024, 1, 7, 6), date_to=AT(2024, 1, 10, 23, 59, 59), base=base).items.collect()
    assert [(r.day.day, r.avg_price_unit) for r in rows] == [(7, 5.0), (8, 1.0), (9, 1.0), (10, 5.0)]


def manifest(run, at, rows=1):
    stats = {"totalPaginas_reported": 1, "totalRegistros_reported": rows, "registrosdaPagina_reported": rows, "rows_written": rows}
    return json.dumps({"run_id": run, "collected_at_utc": at.isoformat() + "+00:00", "anp": "G", "response_stats": stats})


def test_collections_across_midnight(spark, tmp_path):
    d = dt.timedelta(minutes=4)
    late = AT(2024, 1, 10, 23, 50)
    times = [late + i * d for i in range(5)] + [AT(2024, 1, 11, 12), AT(2024, 1, 11, 12, 4), AT(2024, 1, 11, 23, 59), AT(2024, 1, 12, 0, 4, 0)]
    times += [AT(2024, 2, 1, 23, 58) + i * d for i in range(2 * 360 + 20)]  # two whole days and parts of two more
    times += [AT(2024, 3, 1, 23, 59), AT(2024, 3, 3, 0, 1)]                 # a day between
    (tmp_path / "m.json").write_text("\n".join(manifest(f"r{i}", t, i) for i, t in enumerate(times)))
    got = runs.run_rollup(spark.read.schema(MANIFEST_SCHEMA).json(str(tmp_path / "m.json"))).collect()
    spans = sorted((r.started_at_utc[:16], r.finished_at_utc[:16], r.n_runs, len(r.runs)) for r in got)
    assert spans == [("2024-01-10T23:50", "2024-01-11T00:06", 5, 5), ("2024-01-11T12:00", "2024-01-11T12:04", 2, 2),
                     ("2024-01-11T23:59", "2024-01-11T23:59", 1, 1), ("2024-01-12T00:04", "2024-01-12T00:04", 1, 1),
                     ("2024-02-01T23:58", times[8 + 740].isoformat()[:16], 740, 740),
                     ("2024-03-01T23:59", "2024-03-01T23:59", 1, 1), ("2024-03-03T00:01", "2024-03-03T00:01", 1, 1)]
    assert sum(r.rows_written for r in got) == sum(range(len(times)))


def test_cursor_pages_equal_offset_pages(spark):
    rows = [obs(1, 5.0 + i, i // 3, code=f"P{i % 3}") for i in range(20)]
    s = silver_df(spark, rows)
    want = [tuple(r) for r in paging.timeseries_station(s, 1, page_size=100).items.collect()]
    got, cursor = [], None
    while True:
        page = paging.timeseries_station_after(s, 1, cursor=cursor, page_size=7).collect()
        if not page:
            break
        got += [tuple(r)[1:] for r in page]
        cursor = (page[-1].price_ts, page[-1].product_code)
    assert got == want


@pytest.mark.parametrize("order", [[("a", "asc"), ("b", "desc"), ("k", "asc")], [("a", "desc"), ("b", "asc"), ("k", "desc")]])
def test_cursor_passes_nulls_in_every_key(spark, order):
    rows = [(i % 4 if i % 4 else None, i % 3 if i % 3 else None, i) for i in range(30)]
    df = spark.createDataFrame(rows, "a int, b int, k int")
    want = [r.k for r in df.orderBy(*[paging.sort_col(*o) for o in order]).collect()]
    got, cursor = [], None
    while len(got) < 30:
        page = paging.keyset_page(df, cursor, 4, order=order).collect()
        got += [r.k for r in page]
        cursor = (page[-1].a, page[-1].b, page[-1].k)
    assert got == want and paging.keyset_page(df, cursor, 4, order=order).count() == 0


def test_scope_moments_equal_direct_statistics(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.choice(["", "u", "v"]), rng.choice("xyz"), 1e6 + rng.random()) for _ in range(200)] + [("c", "u", "x", 3.0)]
    df = spark.createDataFrame(rows, "f string, u string, c string, v double")
    levels = {"one": ["f"], "two": ["f", "u"], "three": ["f", "u", "c"]}
    got = alerts.scope_moments(df, "v", levels)
    for name, keys in levels.items():
        direct = {tuple(r[k] for k in keys): (r.m, r.s) for r in df.groupBy(*keys).agg(F.avg("v").alias("m"), F.stddev_samp("v").alias("s")).collect()}
        for r in got.collect():
            m, sd = direct[tuple(r[k] for k in keys)]
            assert abs(r[f"{name}_mean"] - m) < 1e-6
            assert (sd is None and r[f"{name}_sd"] is None) or abs(r[f"{name}_sd"] - sd) < 1e-6


def test_scopes_copy_no_row_before_the_filter(spark):
    s = silver_df(spark, [obs(i, 5.0 + i % 3, 3) for i in range(20)])
    plan = alerts.anomalies_by_scope(s)._jdf.queryExecution().optimizedPlan().toString()
    at = plan.index("Generate explode")
    assert plan.count("Generate") == 1 and "Join" in plan[at:]


def test_an_old_row_adds_its_day_only(spark, tmp_path):
    path = str(tmp_path / "silver")
    spark.range(30).selectExpr("id", "date_add(date'2024-01-01', cast(id as int)) as obs_date").write.partitionBy("obs_date").parquet(path)
    days = [dt.date(2024, 1, 2), dt.date(2024, 1, 29), dt.date(2024, 1, 30)]
    read = spark.read.parquet(path).filter(medallion.touched_days(days))
    assert sorted(r.id for r in read.collect()) == [1, 28, 29]
    scan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [obs_date" in scan and "IN (" in scan
    assert spark.read.parquet(path).filter(medallion.touched_days([None])).count() == 0
