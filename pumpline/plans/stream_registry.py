"""Registered streaming queries.

The runs derived from the driver's tables (``plans.snapshots``)
are delivered in ``ROUNDS`` rounds in the order of their collection, as a
collector would, and the chain (silver -> gold and dedup -> daily and price
drops) runs after each round with ``availableNow`` triggers, under the 72 h
watermark of production.  It runs once per application and sf and is reused by
later queries.  The daily series and the price drops add what is not final yet
to what the streams have made, so their SQL twins are the batch answers over
all rows; that of the dedup stream ends where its watermark has come to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import GOLD_KEY, OBS_KEY, QUERY_HOURS, SILVER_COLUMNS
from ..session import app_key, scratch_path
from ..sources.raw import scan_table
from ..streaming import jobs
from . import snapshots
from .raw_registry import _obs, _raw_ctes, raw_silver, tree

DROP_HOURS, DROP_PCT, SLIDE_HOURS = 24, 3.0, 12
ROUNDS, SHORT_HOURS = 3, 12
_CHAIN: dict[str, dict[str, str]] = {}


def _delivered(spark: SparkSession, sf: str, root: str):
    """Put the runs under ``root``, a round at a time, oldest collections first."""
    obs = _obs(spark, sf)
    newest, n = snapshots.collected_span(obs)
    for i in range(ROUNDS):
        # Round i: the collections c with (n - 1 - c) * ROUNDS // n = i.
        lo, hi = n + -(i + 1) * n // ROUNDS, n - 1 + -i * n // ROUNDS
        if lo <= hi:
            snapshots.write_runs(snapshots.snapshot_rows(obs, collections=(lo, hi), newest=newest), root)
        yield i


def chain(spark: SparkSession, sf: str) -> dict[str, str]:
    key = f"{app_key(spark)}|{sf}"
    if key not in _CHAIN:
        root = scratch_path(spark, "stream-chain")
        late = 0
        for i in _delivered(spark, sf, f"{root}/incoming"):
            ch = jobs.run_chain(spark, f"{root}/incoming", out_root=root, window_hours=DROP_HOURS, pct_drop=DROP_PCT, with_open=i == ROUNDS - 1)
            run = jobs.stream_dedup(spark, ch.silver, out=f"{root}/short", watermark=f"{SHORT_HOURS} hours")
            late += jobs.watermark_drops(run)
        _CHAIN[key] = {"silver": ch.silver, "dedup": ch.dedup, "gold": ch.gold, "daily": ch.daily, "drops": ch.drops, "open": ch.open, "late": late}
    return _CHAIN[key]


_LAYERS: dict[str, object] = {}


def stream_layers(spark: SparkSession, sf: str):
    """Layers filled by the streaming merge, 40 files per micro-batch so the
    merge runs over many epochs."""
    from . import medallion
    key = f"{app_key(spark)}|{sf}"
    if key not in _LAYERS:
        lay = medallion.layer_paths(scratch_path(spark, "stream-layers"))
        jobs.stream_into_layers(spark, tree(spark, sf).data_root, lay, max_files_per_trigger=40)
        _LAYERS[key] = lay
    return _LAYERS[key]


def q_stream_layers_silver(spark, sf) -> DataFrame:
    return spark.read.parquet(stream_layers(spark, sf).silver).select(*SILVER_COLUMNS)


def q_stream_layers_gold(spark, sf) -> DataFrame:
    return scan_table(spark, stream_layers(spark, sf).gold).select(*SILVER_COLUMNS)


def q_stream_layers_timeseries_base(spark, sf) -> DataFrame:
    return spark.read.parquet(stream_layers(spark, sf).daily_base).drop("obs_date")


def q_stream_bronze_silver(spark, sf) -> DataFrame:
    return spark.read.parquet(chain(spark, sf)["silver"]).select(*SILVER_COLUMNS)


def q_stream_dedup(spark, sf) -> DataFrame:
    return spark.read.parquet(chain(spark, sf)["dedup"]).select(*SILVER_COLUMNS)


def q_stream_gold_latest(spark, sf) -> DataFrame:
    return jobs.read_gold(spark, chain(spark, sf)["gold"]).select(*SILVER_COLUMNS)


def q_stream_daily(spark, sf) -> DataFrame:
    c = chain(spark, sf)
    return jobs.read_daily(spark, c["daily"], c["open"]).select(
        "day", "fuel_type", "avg_price_unit", "min_price_unit", "max_price_unit", "samples")


def q_stream_price_drop(spark, sf) -> DataFrame:
    c = chain(spark, sf)
    return jobs.read_drops(spark, c["drops"], c["dedup"], c["open"], hours=DROP_HOURS, pct_drop=DROP_PCT)


def q_stream_price_drop_sliding(spark, sf) -> DataFrame:
    c = chain(spark, sf)
    if "sliding" not in c:
        c["sliding"] = jobs.stream_price_drop(spark, c["dedup"], hours=DROP_HOURS, pct_drop=DROP_PCT, slide_hours=SLIDE_HOURS).output
    return jobs.read_drops(spark, c["sliding"], c["dedup"], c["open"], hours=DROP_HOURS, pct_drop=DROP_PCT, slide_hours=SLIDE_HOURS)


def q_stream_late_rows(spark, sf) -> DataFrame:
    """Observations of each round that a watermark of SHORT_HOURS drops as late."""
    return spark.range(1).select(F.lit(chain(spark, sf)["late"]).cast("bigint").alias("late_rows"))


def q_late_data_report(spark, sf) -> DataFrame:
    rep = jobs.late_data_report(raw_silver(spark, sf), quantiles=True)
    exact = raw_silver(spark, sf).groupBy("fuel_type").agg(
        F.percentile(F.timestamp_diff("SECOND", "price_ts", "collected_at") / 3600.0, F.lit(0.5)).alias("p50"),
        F.percentile(F.timestamp_diff("SECOND", "price_ts", "collected_at") / 3600.0, F.lit(0.95)).alias("p95"))
    near = lambda c, i: F.abs(F.col("lag_h_p50_p95")[i] - F.col(c)) <= 0.02 * F.col(c) + 0.1
    return (rep.join(exact, "fuel_type").withColumn("quantiles_near_exact", near("p50", 0) & near("p95", 1))
            .withColumns({"lag_h_p50": F.round("p50", 6), "lag_h_p95": F.round("p95", 6)}).drop("lag_h_p50_p95", "p50", "p95"))


QUERIES = {
    "stream_layers_silver": q_stream_layers_silver,
    "stream_layers_gold": q_stream_layers_gold,
    "stream_layers_timeseries_base": q_stream_layers_timeseries_base,
    "stream_bronze_silver": q_stream_bronze_silver,
    "stream_dedup": q_stream_dedup,
    "stream_gold_latest": q_stream_gold_latest,
    "stream_daily": q_stream_daily,
    "stream_price_drop": q_stream_price_drop,
    "stream_price_drop_sliding": q_stream_price_drop_sliding,
    "stream_late_rows": q_stream_late_rows,
    "late_data_report": q_late_data_report,
}

_COLS_SQL = ", ".join(SILVER_COLUMNS)
_BUCKET_US = DROP_HOURS * 3_600_000_000
_SLIDE_US = SLIDE_HOURS * 3_600_000_000
_MEAN = "avg(price_unit)"


def _passed(hours: int = QUERY_HOURS, time: str = "price_ts") -> str:
    """The watermark once the rows at hand are read, in whole milliseconds."""
    return f"date_trunc('millisecond', max({time})) - INTERVAL {hours} HOUR"


# What dedup has emitted.
_FINAL = f""", final AS (SELECT * FROM silver WHERE price_ts <= (SELECT {_passed()} FROM silver))"""


def _drops_sql(starts: str, source: str) -> str:
    return _raw_ctes(f"""
, w AS (SELECT fuel_type, cnpj, {starts} AS ws, max(station_name) AS station_name, max(city) AS city, max(uf) AS uf, {_MEAN} AS m
        FROM {source} GROUP BY ALL)
SELECT c.fuel_type, c.cnpj, c.station_name, c.city, c.uf, c.ws AS window_start, c.m AS avg_last, p.m AS avg_prev,
       100 * (1 - c.m / p.m) AS pct_drop
FROM w c JOIN w p ON c.fuel_type = p.fuel_type AND c.cnpj = p.cnpj AND c.ws = p.ws + INTERVAL {DROP_HOURS} HOUR
WHERE 100 * (1 - c.m / p.m) >= {DROP_PCT}""")


ORACLE_SQL = {
    "stream_bronze_silver": _raw_ctes("SELECT * FROM raw_silver"),
    "stream_dedup": _raw_ctes(f"{_FINAL} SELECT {_COLS_SQL} FROM final"),
    "stream_gold_latest": _raw_ctes(f"""SELECT {_COLS_SQL} FROM (
  SELECT *, row_number() OVER (PARTITION BY {", ".join(GOLD_KEY)} ORDER BY price_ts DESC) AS rn FROM silver)
WHERE rn = 1"""),
    "stream_daily": _raw_ctes(f"""
SELECT CAST(date_trunc('day', price_ts) AS TIMESTAMP) AS day, fuel_type, {_MEAN} AS avg_price_unit,
       min(price_unit) AS min_price_unit, max(price_unit) AS max_price_unit, count(*) AS samples
FROM silver GROUP BY ALL"""),
    "stream_price_drop": _drops_sql(f"make_timestamp((epoch_us(price_ts) // {_BUCKET_US}) * {_BUCKET_US})", "silver"),
    "stream_price_drop_sliding": _drops_sql(f"make_timestamp((epoch_us(price_ts) // {_SLIDE_US} - k) * {_SLIDE_US})",
                                            f"(SELECT *, unnest(range({DROP_HOURS // SLIDE_HOURS})) AS k FROM silver)"),
    "stream_late_rows": _raw_ctes(f"""
, n AS (SELECT max(collection) + 1 AS n FROM snap),
r AS (SELECT *, (n - 1 - collection) * {ROUNDS} // n AS round FROM snap, n),
m AS (SELECT round, max(max(price_ts)) OVER (ORDER BY round) AS t FROM r GROUP BY round)
SELECT count(*) AS late_rows
FROM (SELECT DISTINCT r.round, {", ".join(OBS_KEY)} FROM r JOIN m ON m.round = r.round - 1
      WHERE price_ts <= date_trunc('millisecond', m.t) - INTERVAL {SHORT_HOURS} HOUR)"""),
    "late_data_report": _raw_ctes("""
, l AS (SELECT fuel_type, (epoch_us(collected_at) - epoch_us(price_ts)) // 1000000 AS s FROM raw_silver)
SELECT fuel_type, count(*) AS rows, max(s) / 3600.0 AS max_lag_h, sum(s) / count(s) / 3600.0 AS mean_lag_h,
       count(*) FILTER (WHERE s > 86400) AS later_than_24h, count(*) FILTER (WHERE s > 172800) AS later_than_48h,
       count(*) FILTER (WHERE s > 259200) AS later_than_72h,
       round(quantile_cont(s / 3600.0, 0.5), 6) AS lag_h_p50, round(quantile_cont(s / 3600.0, 0.95), 6) AS lag_h_p95,
       true AS quantiles_near_exact
FROM l GROUP BY fuel_type"""),
}


def _layer_sql():
    from .raw_registry import ORACLE_SQL as RAW
    return {"stream_layers_silver": RAW["silver_from_raw"], "stream_layers_gold": RAW["gold_from_raw"],
            "stream_layers_timeseries_base": RAW["layers_timeseries_base"]}


ORACLE_SQL.update(_layer_sql())
