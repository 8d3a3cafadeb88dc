"""Daily series, comparisons and global statistics."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.params import (apply_filters, check_int, check_required, check_uf, eq, time_range,
                                time_range_pred)
from .gold import TIMESERIES_BASE_KEYS, day_of, rollup_daily, timeseries_base
from .paging import Page

# Means are plain averages; a roll-up of stored sums agrees with the direct
# figure up to the rounding of double sums.


def _daily(df: DataFrame, keys=()) -> DataFrame:
    return (df.withColumn("day", day_of())
            .groupBy(*keys, "day")
            .agg(F.avg("price_unit").alias("avg_price_unit"),
                 F.min("price_unit").alias("min_price_unit"),
                 F.max("price_unit").alias("max_price_unit"),
                 F.count(F.lit(1)).alias("samples")))


def _paged_days(daily: DataFrame, page: int, page_size: int) -> Page:
    offset = (page - 1) * page_size
    items = daily.orderBy("day")
    if offset:
        items = items.offset(offset)
    return Page(page, page_size, items.limit(page_size), daily)


_MICRO, _DAY = _dt.timedelta(microseconds=1), _dt.timedelta(days=1)
_BASE_COLUMNS = [*TIMESERIES_BASE_KEYS, "sum_price", "n_price_unit", "samples", "min_price_unit", "max_price_unit", "min_price_ts", "max_price_ts"]


def split_days(lo, hi):
    """The whole days within ``lo..hi`` as (first, last) midnights, None where
    open or if there is no such day, and the ranges at the edges beside them."""
    first = lo if lo is None or lo.time() == _dt.time(0) else _dt.datetime.combine(lo.date(), _dt.time(0)) + _DAY
    after = None if hi is None else _dt.datetime.combine((hi + _MICRO).date(), _dt.time(0))
    if first is not None and after is not None and first >= after:
        return None, [(lo, hi)]
    edges = [(lo, first - _MICRO)] if lo != first else []
    edges += [(after, hi)] if hi is not None and hi >= after else []
    return (first, None if after is None else after - _DAY), edges


def station_days(silver: DataFrame, base: DataFrame, lo, hi, *preds) -> DataFrame:
    """Station-days of any range: whole days from the stored daily base, the
    cut days at its edges from the observations of those days alone."""
    days, edges = split_days(lo, hi)
    parts = [timeseries_base(apply_filters(silver, *preds, time_range_pred(silver, "price_ts", a, b))).select(*_BASE_COLUMNS) for a, b in edges]
    if days is not None:
        parts.append(apply_filters(base, *preds, time_range_pred(base, "day", *days)).select(*_BASE_COLUMNS))
    return reduce(DataFrame.unionByName, parts)


def _daily_from(silver: DataFrame, base: DataFrame | None, lo, hi, *preds) -> DataFrame:
    """Daily series from the history or, with a stored daily base, rolled up
    from station-days (the same figures up to the rounding of double sums)."""
    if base is not None:
        return rollup_daily(station_days(silver, base, lo, hi, *preds)).select("day", "avg_price_unit", "min_price_unit", "max_price_unit", "samples")
    return _daily(apply_filters(silver, *preds, time_range_pred(silver, "price_ts", lo, hi)))


def timeseries_daily(silver: DataFrame, fuel_type: str | None = None, date_from=None, date_to=None,
                     page: int = 1, page_size: int = 50, base: DataFrame | None = None) -> Page:
    """Per-day avg/min/max/count of price_unit; total = number of days.
    ``base``: the stored daily base, read for the whole days of the range."""
    check_int("page", page, 1)
    check_int("page_size", page_size, 1, 200)
    lo, hi = time_range(date_from, date_to)
    return _paged_days(_daily_from(silver, base, lo, hi, eq("fuel_type", fuel_type)), page, page_size)


def timeseries_city(silver: DataFrame, fuel_type: str, uf: str | None = None, city: str | None = None,
                    date_from=None, date_to=None, page: int = 1, page_size: int = 50,
                    base: DataFrame | None = None) -> Page:
    check_required("fuel_type", fuel_type)
    uf = check_uf(uf)
    check_int("page", page, 1)
    check_int("page_size", page_size, 1, 500)
    lo, hi = time_range(date_from, date_to)
    daily = _daily_from(silver, base, lo, hi, eq("fuel_type", fuel_type), eq("uf", uf), eq("city", city))
    return _paged_days(daily, page, page_size)


def timeseries_city_all(silver: DataFrame) -> DataFrame:
    """Daily series of every (fuel, uf, city) at once (batch form)."""
    return _daily(silver, keys=("fuel_type", "uf", "city"))


def price_compare(gold: DataFrame, fuel_type: str | None = None, uf: str | None = None,
                  city: str | None = None) -> DataFrame:
    """avg/min/max/count/last time by (fuel, uf, city) over current prices.

    Returns every group (the shipped code returned an arbitrary first one).
    ``stations`` counts product rows as the source query did;
    ``distinct_stations`` counts stations.
    """
    uf = check_uf(uf)
    f = apply_filters(gold, eq("fuel_type", fuel_type), eq("uf", uf), eq("city", city))
    return (f.groupBy(F.col("fuel_type"),
                      F.coalesce(F.col("uf"), F.lit("")).alias("uf"),
                      F.coalesce(F.col("city"), F.lit("")).alias("city"))
            .agg(F.avg("price_unit").alias("avg_price_unit"),
                 F.min("price_unit").alias("min_price_unit"),
                 F.max("price_unit").alias("max_price_unit"),
                 F.count(F.lit(1)).alias("stations"),
                 F.count_distinct("cnpj").alias("distinct_stations"),
                 F.max("price_ts").alias("last_price_ts")))


def price_compare_scope(gold: DataFrame, fuel_type: str, uf: str | None = None,
                        city: str | None = None) -> DataFrame:
    """The single-scope answer: exactly one row for the requested (fuel,
    uf?, city?) scope, aggregated over all its rows; an empty scope gives
    stations = 0 and null prices (the source's stub answer)."""
    check_required("fuel_type", fuel_type)
    uf = check_uf(uf)
    f = apply_filters(gold, eq("fuel_type", fuel_type), eq("uf", uf), eq("city", city))
    return f.agg(F.lit(fuel_type).alias("fuel_type"),
                 F.lit(uf or "").alias("uf"),
                 F.lit(city or "").alias("city"),
                 F.avg("price_unit").alias("avg_price_unit"),
                 F.min("price_unit").alias("min_price_unit"),
                 F.max("price_unit").alias("max_price_unit"),
                 F.count(F.lit(1)).alias("stations"),
                 F.count_distinct("cnpj").alias("distinct_stations"),
                 F.max("price_ts").alias("last_price_ts"))


def price_compare_all(gold: DataFrame) -> DataFrame:
    return price_compare(gold)


def stats_summary(silver: DataFrame, date_from=None, date_to=None, uf: str | None = None,
                  city: str | None = None, fuel_type: str | None = None, approx: bool = False,
                  base: DataFrame | None = None) -> DataFrame:
    """One row: rows, distinct stations/cities/ufs, time span, mean price.

    Exact distinct counts plan as Expand + two-phase aggregation; with
    ``approx=True`` they become HyperLogLog++ sketches merged per task
    (fixed memory, ~1% error) for very large scopes.  With the stored daily
    base (``base``) every figure rolls up from station-days, and observations
    are read for the cut days at the range's edges only.
    """
    uf = check_uf(uf)
    lo, hi = time_range(date_from, date_to)
    dc = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    preds = (eq("uf", uf), eq("city", city), eq("fuel_type", fuel_type))
    if base is not None:
        b = station_days(silver, base, lo, hi, *preds)
        return b.agg(F.coalesce(F.sum("samples"), F.lit(0)).cast("bigint").alias("rows"),
                     dc("cnpj").alias("stations"),
                     dc("city").alias("cities"),
                     dc("uf").alias("ufs"),
                     F.min("min_price_ts").alias("min_price_ts"),
                     F.max("max_price_ts").alias("max_price_ts"),
                     (F.sum("sum_price") / F.sum("n_price_unit")).alias("avg_price_unit"))
    f = apply_filters(silver, time_range_pred(silver, "price_ts", lo, hi), *preds)
    return f.agg(F.count(F.lit(1)).alias("rows"),
                 dc("cnpj").alias("stations"),
                 dc("city").alias("cities"),
                 dc("uf").alias("ufs"),
                 F.min("price_ts").alias("min_price_ts"),
                 F.max("price_ts").alias("max_price_ts"),
                 F.avg("price_unit").alias("avg_price_unit"))


def kpi_consistency(silver: DataFrame, keys=("fuel_type", "uf", "city"), base: DataFrame | None = None) -> DataFrame:
    """Cross-check: per scope, the direct aggregate of silver against the
    roll-up of the daily base (the stored table when ``base`` is given, else
    computed from silver).  Returns one row per scope with both figures and
    ``consistent``; an empty ``filter(~consistent)`` is the pass condition."""
    keys = list(keys)
    direct = (silver.groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("rows_direct"),
                   F.min("price_unit").alias("min_direct"),
                   F.max("price_unit").alias("max_direct"),
                   F.avg("price_unit").alias("avg_direct")))
    base = base if base is not None else timeseries_base(silver)
    rolled = (base.groupBy(*[F.col(k).alias("_r_" + k) for k in keys])
              .agg(F.sum("samples").alias("rows_rollup"),
                   F.min("min_price_unit").alias("min_rollup"),
                   F.max("max_price_unit").alias("max_rollup"),
                   (F.sum("sum_price") / F.sum("n_price_unit")).alias("avg_rollup")))
    cond = [F.col(k).eqNullSafe(F.col("_r_" + k)) for k in keys]
    j = direct.join(rolled, cond, "full_outer")
    out = j.select(*[F.coalesce(F.col(k), F.col("_r_" + k)).alias(k) for k in keys],
                   "rows_direct", "rows_rollup", "min_direct", "min_rollup", "max_direct", "max_rollup",
                   "avg_direct", "avg_rollup")
    ok = ((F.col("rows_direct") == F.col("rows_rollup"))
          & F.col("min_direct").eqNullSafe(F.col("min_rollup"))
          & F.col("max_direct").eqNullSafe(F.col("max_rollup"))
          & F.coalesce(F.abs(F.col("avg_direct") - F.col("avg_rollup")) <= F.abs(F.col("avg_direct")) * F.lit(1e-9),
                       F.col("avg_direct").isNull() & F.col("avg_rollup").isNull()))
    return out.withColumn("consistent", F.coalesce(ok, F.lit(False)))


def daily_from_base(base: DataFrame, fuel_type: str | None = None) -> DataFrame:
    """The all-city daily series computed from the pre-aggregate."""
    return rollup_daily(apply_filters(base, eq("fuel_type", fuel_type)), keys=("day",))
