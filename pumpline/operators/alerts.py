"""Price-drop alerts and z-score anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .gold import distinct_by_hash
from ..functions.params import (apply_filters, as_of_column, check_float, check_int, check_required,
                                check_uf, eq, hours_interval, window_pred)

# sigma and z come from a square root; they are rounded to 6 decimals.
ROUND = 6


def _window_flags(silver: DataFrame, as_of, hours: int):
    cut = as_of_column(silver, as_of)
    h = hours_interval(hours)
    h2 = hours_interval(2 * hours)
    ts = F.col("price_ts")
    in_last = (ts >= cut - h) & (ts <= cut)
    in_prev = (ts < cut - h) & (ts >= cut - h2)
    return in_last, in_prev, cut, h2


def _drop_result(agg: DataFrame, pct_drop: float) -> DataFrame:
    pct = F.try_divide(F.col("avg_prev") - F.col("avg_last"), F.col("avg_prev")) * F.lit(100.0)
    return (agg.filter(F.col("avg_last").isNotNull() & F.col("avg_prev").isNotNull())
            .withColumn("pct_drop", pct)
            .filter(F.col("pct_drop") >= F.lit(pct_drop)))


def _numeric_drop(windows: DataFrame, keys, in_last, in_prev) -> DataFrame:
    """Mean price of each station in the last and the previous window, as
    conditional sums and counts in one hash aggregation (no self-join); a
    station with a third of the rows ships one partial row per task."""
    p = F.col("price_unit")
    return (windows.groupBy(*keys)
            .agg(F.sum(F.when(in_last, p)).alias("_s_last"), F.count(F.when(in_last, p)).alias("_n_last"),
                 F.sum(F.when(in_prev, p)).alias("_s_prev"), F.count(F.when(in_prev, p)).alias("_n_prev"))
            .select(*keys,
                    (F.col("_s_last") / F.col("_n_last")).alias("avg_last"),
                    (F.col("_s_prev") / F.col("_n_prev")).alias("avg_prev")))


def _with_labels(drops: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Add the label each source takes, the max over its rows in ``source``.
    Only rows of stations in ``drops`` count, and they are made distinct by a
    hash aggregation first, so the max over texts sees a few rows a station."""
    rows = source.select(*keys, *[c for c in ("station_name", "city", "uf") if c not in keys]) \
        .join(drops.select(*keys), keys, "left_semi")
    names = distinct_by_hash(rows).groupBy(*keys).agg(*[F.max(c).alias(c) for c in ("station_name", "city", "uf")])
    return drops.join(names, keys, "left")


def price_drop(silver: DataFrame, fuel_type: str, uf: str | None = None, city: str | None = None,
               hours: int = 24, pct_drop: float = 3.0, limit: int = 50, as_of="max",
               label_scope: str = "history", labels: DataFrame | None = None) -> DataFrame:
    """Stations whose mean price over the last ``hours`` before ``as_of`` fell
    by at least ``pct_drop`` percent against the ``hours`` before that.

    Station labels are the max over the station's whole filtered history
    (``label_scope="history"``, the source's semantics); with
    ``label_scope="window"`` the scan is pruned to the two windows, which is
    the same answer whenever a station's labels do not change over time.
    With the stored ``labels`` table (``gold.station_labels``) the history
    semantics hold exactly while the price pass reads only the two windows'
    days: the request cost no longer grows with the history.
    """
    check_required("fuel_type", fuel_type)
    uf = check_uf(uf)
    check_int("hours", hours, 1, 168)
    check_float("pct_drop", pct_drop, 0, 50, lo_open=True)
    check_int("limit", limit, 1, 500)
    if label_scope not in ("history", "window"):
        raise ValueError("label_scope must be 'history' or 'window'")
    preds = (eq("fuel_type", fuel_type), eq("uf", uf), eq("city", city), F.col("cnpj").isNotNull())
    base = apply_filters(silver, *preds)
    in_last, in_prev, cut, h2 = _window_flags(silver, as_of, hours)
    windows = base.filter(window_pred(base, "price_ts", cut - h2, cut))
    drops = _drop_result(_numeric_drop(windows, ["cnpj"], in_last, in_prev), pct_drop)
    top = drops.orderBy(F.col("pct_drop").desc(), F.col("cnpj").asc()).limit(limit)
    source = (apply_filters(labels, *preds) if labels is not None else windows if label_scope == "window" else base)
    return (_with_labels(top, source, ["cnpj"])
            .orderBy(F.col("pct_drop").desc(), F.col("cnpj").asc())
            .select("cnpj", "station_name", "city", "uf", "avg_last", "avg_prev", "pct_drop"))


def price_drop_all(silver: DataFrame, hours: int = 24, pct_drop: float = 3.0, as_of="max",
                   labels: DataFrame | None = None) -> DataFrame:
    """Drops for every (fuel, station) at once; no limit.  ``labels`` as in
    ``price_drop``."""
    check_int("hours", hours, 1, 168)
    check_float("pct_drop", pct_drop, 0, 50, lo_open=True)
    keys = ["fuel_type", "cnpj"]
    base = silver.filter(F.col("cnpj").isNotNull() & F.col("fuel_type").isNotNull())
    in_last, in_prev, cut, h2 = _window_flags(silver, as_of, hours)
    windows = base.filter(window_pred(base, "price_ts", cut - h2, cut))
    drops = _drop_result(_numeric_drop(windows, keys, in_last, in_prev), pct_drop)
    source = labels.filter(F.col("cnpj").isNotNull()) if labels is not None else base
    return (_with_labels(drops, source, keys)
            .select("fuel_type", "cnpj", "station_name", "city", "uf", "avg_last", "avg_prev", "pct_drop"))


def anomalies(silver: DataFrame, fuel_type: str, uf: str | None = None, city: str | None = None,
              hours: int = 24, z: float = 3.0, limit: int = 100, as_of="max") -> DataFrame:
    """Rows of the last ``hours`` whose |z| against the scope's mean and
    sample standard deviation is at least ``z`` (the row itself counts in the
    statistics; n = 1 or sigma = 0 gives no rows).

    The statistics are one scalar subquery over the same filtered rows (a
    partial+final aggregate returning both figures), no join.
    """
    check_required("fuel_type", fuel_type)
    uf = check_uf(uf)
    check_int("hours", hours, 1, 168)
    check_float("z", z, 0.5, 10, lo_open=True)
    check_int("limit", limit, 1, 2000)
    cut = as_of_column(silver, as_of)
    recent = apply_filters(silver, eq("fuel_type", fuel_type), eq("uf", uf), eq("city", city),
                           window_pred(silver, "price_ts", cut - hours_interval(hours), cut),
                           F.col("price_unit").isNotNull())
    stats = recent.agg(F.struct(F.avg("price_unit").alias("mu"),
                                F.stddev_samp("price_unit").alias("sigma")).alias("s")).scalar()
    mu, sigma = stats.getField("mu"), stats.getField("sigma")
    zcol = (F.col("price_unit") - mu) / sigma
    out = (recent.withColumn("mu", mu).withColumn("sigma", sigma)
           .filter(F.col("sigma").isNotNull() & (F.col("sigma") > 0))
           .withColumn("zscore", zcol)
           .filter(F.abs(F.col("zscore")) >= F.lit(z)))
    return (out.orderBy(F.abs(F.col("zscore")).desc(), F.col("price_ts").desc(), F.col("cnpj").asc(),
                        F.col("product_code").asc())
            .limit(limit)
            .select("price_ts", "cnpj", "station_name", "city", "uf", "fuel_type", "price_unit",
                    "mu", F.round("sigma", ROUND).alias("sigma"),
                    F.round("zscore", ROUND).alias("zscore")))


def anomalies_by_scope(silver: DataFrame, hours: int = 24, z: float = 3.0, as_of="max") -> DataFrame:
    """z-score anomalies for every (fuel), (fuel, uf) and (fuel, uf, city)
    scope at once.

    Count, mean and squared deviations are aggregated once, for the finest
    scopes (partial aggregation, so hot scopes cost one row per task); those
    of the coarser scopes are merged from them.  Each finest scope carries the
    statistics of all three of its scopes, so every recent row meets them in
    one join, is scored three times in place, and only scores of at least
    ``z`` become rows.  AQE broadcasts the scopes when they are small and
    otherwise splits skewed partitions.
    """
    check_int("hours", hours, 1, 168)
    check_float("z", z, 0.5, 10, lo_open=True)
    cut = as_of_column(silver, as_of)
    recent = silver.filter(window_pred(silver, "price_ts", cut - hours_interval(hours), cut)
                           & F.col("price_unit").isNotNull() & F.col("fuel_type").isNotNull())
    recent = recent.withColumns({"_u": F.coalesce(F.col("uf"), F.lit("")), "_c": F.coalesce(F.col("city"), F.lit(""))})
    levels = {"fuel": ["fuel_type"], "fuel_uf": ["fuel_type", "_u"], "fuel_uf_city": ["fuel_type", "_u", "_c"]}
    moments = scope_moments(recent, "price_unit", levels)
    price = F.col("price_unit")
    scored = [F.struct(F.lit(name).alias("scope"), (F.col("_u") if "_u" in keys else F.lit("")).alias("scope_uf"),
                       (F.col("_c") if "_c" in keys else F.lit("")).alias("scope_city"),
                       F.col(f"{name}_mean").alias("mu"), F.col(f"{name}_sd").alias("sigma"),
                       ((price - F.col(f"{name}_mean")) / F.nullif(F.col(f"{name}_sd"), F.lit(0.0))).alias("zscore"))
              for name, keys in levels.items()]
    far = F.filter(F.array(*scored), lambda s: F.abs(s["zscore"]) >= F.lit(z))
    out = recent.join(moments, levels["fuel_uf_city"]).withColumn("_far", far).filter(F.size("_far") > 0)
    return (out.select("fuel_type", "price_ts", "cnpj", "product_code", "station_name", "city", "uf", "price_unit", F.explode("_far").alias("_s"))
            .select("_s.scope", "fuel_type", "_s.scope_uf", "_s.scope_city", "price_ts", "cnpj", "product_code",
                    "station_name", "city", "uf", "price_unit", "_s.mu", F.round("_s.sigma", ROUND).alias("sigma"),
                    F.round("_s.zscore", ROUND).alias("zscore")))


def scope_moments(rows: DataFrame, value: str, levels: dict[str, list[str]]) -> DataFrame:
    """Mean and sample standard deviation of ``value`` in nested scopes.

    ``levels`` names each scope's keys, the finest last.  One row per finest
    scope, with ``<level>_mean`` and ``<level>_sd`` of every level it lies in:
    counts, means and squared deviations of the finest scopes are merged, the
    deviation of a part's mean from the whole's added n times."""
    finest = list(levels.values())[-1]
    n = F.count(value)
    out = rows.groupBy(*finest).agg(n.alias("_n"), F.avg(value).alias("_m"), (F.var_pop(value) * n).alias("_q"))
    for name, keys in levels.items():
        whole = Window.partitionBy(*keys)
        out = out.withColumn("_t", F.sum("_n").over(whole))
        out = out.withColumn(f"{name}_mean", F.sum(F.col("_n") * F.col("_m")).over(whole) / F.col("_t"))
        spread = F.sum(F.col("_q") + F.col("_n") * F.pow(F.col("_m") - F.col(f"{name}_mean"), 2)).over(whole)
        out = out.withColumn(f"{name}_sd", F.when(F.col("_t") > 1, F.sqrt(spread / (F.col("_t") - 1))))
    return out.select(*finest, *[f"{name}_{x}" for name in levels for x in ("mean", "sd")])
