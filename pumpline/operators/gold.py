"""Gold tables: latest row per station/product and the daily pre-aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.params import as_of_column
from ..schema import GOLD_KEY


def day_of(col: str = "price_ts"):
    """Calendar day of a UTC wall-clock time, as a timestamp_ntz at midnight."""
    return F.date_trunc("day", F.col(col)).cast("timestamp_ntz")


def gold_latest(silver: DataFrame) -> DataFrame:
    """Latest row per (cnpj, product_code): newest price_ts, then newest
    collection, then run_id.

    ``row_number() == 1`` plans as a partial ``WindowGroupLimit`` before the
    shuffle, so a station with millions of rows ships one row per map task.
    """
    w = Window.partitionBy(*GOLD_KEY).orderBy(
        F.col("price_ts").desc_nulls_last(),
        F.col("collected_at").desc_nulls_last(),
        F.col("run_id").desc_nulls_last())
    keyed = silver.filter(F.col("cnpj").isNotNull() & F.col("product_code").isNotNull())
    return keyed.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def gold_latest_of_copies(copies: DataFrame) -> DataFrame:
    """``gold_latest`` of the deduplicated ``copies``, in one step.

    An observation has one price_ts within its station product, so the first
    collection of the newest price_ts is the row that ``silver_dedup`` keeps
    and ``gold_latest`` takes; rows are brought together once, a row per
    station product and map task.
    """
    w = Window.partitionBy(*GOLD_KEY).orderBy(
        F.col("price_ts").desc_nulls_last(),
        F.col("collected_at").asc_nulls_last(),
        F.col("run_id").asc_nulls_last())
    keyed = copies.filter(F.col("cnpj").isNotNull() & F.col("product_code").isNotNull() & F.col("price_ts").isNotNull())
    return keyed.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_as_of(silver: DataFrame, as_of="max") -> DataFrame:
    """gold_latest as it stood at ``as_of`` (rows after it are ignored)."""
    cut = as_of_column(silver, as_of)
    return gold_latest(silver.filter(F.col("price_ts") <= cut))


TIMESERIES_BASE_KEYS = ["fuel_type", "uf", "city", "cnpj", "day"]


def timeseries_base(silver: DataFrame) -> DataFrame:
    """Per (fuel, uf, city, station, day): sum, count, min, max of price_unit
    and the first / last observation time.

    The sum is kept unrounded (``sum_price``), so every coarser daily series
    rolls up from it to the figure the history gives, up to the rounding of
    double sums (avg = sum_price / n); the series and summary queries can read
    this table instead of the history for whole-day ranges.
    """
    return (silver.withColumn("day", day_of())
            .groupBy(*TIMESERIES_BASE_KEYS)
            .agg(F.sum("price_unit").alias("sum_price"),
                 F.count("price_unit").alias("n_price_unit"),
                 F.count(F.lit(1)).alias("samples"),
                 F.min("price_unit").alias("min_price_unit"),
                 F.max("price_unit").alias("max_price_unit"),
                 F.min("price_ts").alias("min_price_ts"),
                 F.max("price_ts").alias("max_price_ts")))


LABEL_KEYS = ["fuel_type", "uf", "city", "cnpj"]


def station_labels(silver: DataFrame) -> DataFrame:
    """Per (fuel, uf, city, station): the max station name over its rows.

    A small table (one row per station and place) that lets the price-drop
    alert label stations exactly as the source did (max over the filtered
    history) without scanning the history: max over the rows matching a
    fuel/uf/city filter is the max over the matching label rows.  Max is
    mergeable, so the table is maintained incrementally.
    """
    names = distinct_by_hash(silver.select(*LABEL_KEYS, "station_name"))
    return names.groupBy(*LABEL_KEYS).agg(F.max("station_name").alias("station_name"))


def distinct_by_hash(rows: DataFrame) -> DataFrame:
    """Distinct rows ahead of a max over texts.  A plain ``distinct`` there is
    optimised away, and the max over texts sorts all rows instead; the count
    that is asked about keeps this hash aggregation in the plan."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 0).drop("_n")


def rollup_daily(base: DataFrame, keys=("day",)) -> DataFrame:
    """Coarser daily series from ``timeseries_base``."""
    return (base.groupBy(*keys)
            .agg((F.sum("sum_price") / F.sum("n_price_unit")).alias("avg_price_unit"),
                 F.min("min_price_unit").alias("min_price_unit"),
                 F.max("max_price_unit").alias("max_price_unit"),
                 F.sum("samples").alias("samples")))


def best_per_group(gold: DataFrame, n: int = 3, keys=("fuel_type", "uf", "city")) -> DataFrame:
    """Top-n cheapest current rows per (fuel, uf, city), for every group at once.

    ``row_number() <= n`` gets a partial ``WindowGroupLimit``: each map task
    keeps at most n rows per group before the shuffle, so a city with a third
    of all stations costs n rows per task, not a third of the table.
    """
    w = Window.partitionBy(*keys).orderBy(
        F.col("price_unit").asc_nulls_last(), F.col("price_ts").desc_nulls_last(),
        F.col("cnpj").asc_nulls_last(), F.col("product_code").asc_nulls_last())
    return gold.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
