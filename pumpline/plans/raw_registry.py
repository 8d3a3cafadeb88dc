"""Registered raw-layer queries.

The raw tree (partitioned JSONL, manifests, roll-ups, logs) is derived from
the driver's tables by ``plans.snapshots`` and written once per application;
each query reads it back through the scanners.  The SQL twins rebuild the
same snapshot rows from ``events`` with the same rule (explode of the
collections that saw each observation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold as goldops, runs, silver as silverops
from ..session import app_key
from ..schema import PAGE_ROWS, QUERY_LAT, QUERY_LNG, SILVER_COLUMNS
from ..sinks import raw as rawsink
from ..sources import raw as rawsrc, testdata
from . import snapshots

STEP_US = snapshots.STEP_HOURS * snapshots.US_PER_HOUR
WIN_US = snapshots.WINDOW_HOURS * snapshots.US_PER_HOUR


def _obs(spark: SparkSession, sf: str) -> DataFrame:
    return testdata.silver(spark, sf, with_obs_id=True)


def tree(spark: SparkSession, sf: str) -> snapshots.RawTree:
    return snapshots.raw_tree_for(spark, sf, _obs)


def raw(spark, sf) -> DataFrame:
    return rawsrc.scan_raw(spark, tree(spark, sf).data_root)


def raw_silver(spark, sf, keep_query: bool = False) -> DataFrame:
    return silverops.silver_typed(silverops.silver_flatten(raw(spark, sf)), keep_query=keep_query)


def silver_from_raw(spark, sf) -> DataFrame:
    return silverops.silver_dedup(raw_silver(spark, sf))


def manifests(spark, sf) -> DataFrame:
    return rawsrc.scan_manifest(spark, tree(spark, sf).manifest_root, glob="part-*", multiline=False)


def logs(spark, sf) -> DataFrame:
    return rawsrc.scan_run_log(spark, tree(spark, sf).log_root, glob="part-*")


def q_raw_runs(spark, sf):
    return raw(spark, sf).groupBy("run_id", "anp", "dt").agg(F.count(F.lit(1)).alias("rows"))


def q_silver_from_raw(spark, sf):
    return silver_from_raw(spark, sf).select(*SILVER_COLUMNS)


def q_gold_from_raw(spark, sf):
    return goldops.gold_latest(silver_from_raw(spark, sf)).select(*SILVER_COLUMNS)


def q_raw_line_quality(spark, sf):
    return runs.raw_line_quality(rawsrc.scan_raw(spark, tree(spark, sf).data_root, keep_corrupt=True))


def q_run_manifests(spark, sf):
    return manifests(spark, sf).select("run_id", "anp", "collected_at_utc", "response_stats.*")


def q_overall_manifest(spark, sf):
    o = rawsrc.scan_overall_manifest(spark, tree(spark, sf).overall_root, multiline=False)
    return o.select("finished_at_utc", "run_id", "anp", F.col("response_stats.rows_written").alias("rows_written"))


def q_run_log(spark, sf):
    return logs(spark, sf).filter(F.col("run_id").isNotNull()).select("run_id", "fuel", "rows", "ts", "level")


def q_run_log_lines(spark, sf):
    """All log lines by level and kind of message, those without a run too."""
    kind = F.regexp_extract("message", r"(Starting run|fetching page|wrote|Run completed)", 1)
    return logs(spark, sf).groupBy("level", F.coalesce("fuel", F.lit("")).alias("fuel"), kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("lines"), F.count("run_id").alias("with_run"), F.sum("rows").alias("rows"))


def q_run_reconcile(spark, sf):
    return runs.run_reconcile(logs(spark, sf), raw(spark, sf), manifests(spark, sf))


def _pages(spark, sf) -> DataFrame:
    """Response pages rebuilt from the raw lines: items of a run grouped in
    buckets of at most PAGE_ROWS invoice numbers, cheapest first."""
    r = raw(spark, sf)
    bucket = F.floor(F.col("raw.produto.cod_nfce").cast("bigint") / F.lit(PAGE_ROWS))
    return (r.groupBy("run_id", "anp", bucket.alias("page"))
            .agg(F.min("collected_at_utc").alias("collected_at_utc"), F.any_value("query").alias("query"),
                 F.sort_array(F.collect_list(F.struct(F.col("raw.produto.precoLiquido").alias("k"),
                                                      F.col("raw").alias("item")))).alias("items"))
            .select("collected_at_utc", "run_id", "anp", "query", "page",
                    F.struct(F.lit(None).cast("string").alias("totalPaginas"),
                             F.lit(None).cast("string").alias("totalRegistros"),
                             F.lit(None).cast("string").alias("registrosdaPagina"),
                             F.transform("items", lambda x: x["item"]).alias("resultado")).alias("response")))


def q_snapshot_envelope(spark, sf):
    rows = runs.snapshot_envelope(_pages(spark, sf))
    return rows.groupBy("run_id", "anp").agg(F.count(F.lit(1)).alias("rows"),
                                             F.count_distinct("raw.produto.cod_nfce").alias("observations"))


def q_response_check(spark, sf):
    chk = runs.response_check(_pages(spark, sf))
    return chk.groupBy("run_id").agg(F.count(F.lit(1)).alias("pages"), F.sum("items").alias("items"),
                                     F.max("total_pages").alias("total_pages"),
                                     F.max("total_records").alias("total_records"),
                                     F.sum("page_records").alias("page_records"),
                                     F.min(F.col("resultado_ok").cast("int")).alias("all_ok"))


# Faults planted in the saved pages by page number modulo PAGE_FAULTS.
PAGE_FAULTS, TEXT_TOTAL, NO_TOTAL, OBJECT, NO_LIST, CUT = 11, 1, 2, 3, 4, 5


def _saved_pages(spark, sf) -> str:
    """The response pages as JSON lines, some with text or missing totals,
    without a list, or cut off."""
    from ..session import scratch_path
    key = f"{app_key(spark)}|{sf}|pages"
    if key not in _LAYERS:
        kind = F.col("page") % PAGE_FAULTS
        n = F.size("response.resultado").cast("bigint")

        def line(pages, total, items):
            response = F.struct(pages.alias("totalPaginas"), total.alias("totalRegistros"), n.alias("registrosdaPagina"), items.alias("resultado"))
            return F.to_json(F.struct("collected_at_utc", "run_id", "anp", "query", response.alias("response")))

        items, none = F.col("response.resultado"), F.lit(None)
        good = line(F.lit(2), n + F.col("page"), items)
        text = (F.when(kind == TEXT_TOTAL, line(F.lit("many"), n.cast("string"), items))
                .when(kind == NO_TOTAL, line(none.cast("int"), none.cast("bigint"), items))
                .when(kind == OBJECT, line(F.lit(2), n, F.struct(F.lit("busy").alias("erro"))))
                .when(kind == NO_LIST, line(F.lit(2), n, none.cast("array<string>")))
                .when(kind == CUT, F.left(good, F.lit(60))).otherwise(good))
        path = scratch_path(spark, "pages")
        rawsink.write_text_lines(_pages(spark, sf).select(text.alias("value")), path)
        _LAYERS[key] = path
    return _LAYERS[key]


def q_response_pages(spark, sf):
    """Saved pages read back and checked, per run (null: lines that are no JSON)."""
    chk = runs.response_check(rawsrc.scan_pages(spark, _saved_pages(spark, sf)))
    return chk.groupBy("run_id").agg(F.count(F.lit(1)).alias("pages"), F.sum("items").alias("items"),
                                     F.max("total_pages").alias("total_pages"), F.sum("total_records").alias("total_records"),
                                     F.sum("page_records").alias("page_records"), F.count_if(~F.col("resultado_ok")).alias("without_list"))


def q_unit_canonical(spark, sf):
    r = raw(spark, sf).select(F.col("raw.produto.unidade").alias("unit_raw"),
                              F.col("raw.produto.anp").alias("fuel_type"))
    flagged = silverops.unit_flags(silverops.unit_canonical(r.withColumn("unit", F.col("unit_raw"))))
    return flagged.groupBy("unit_raw", "unit", "unit_suspect").agg(F.count(F.lit(1)).alias("rows"))


def q_distance_check(spark, sf):
    d = silverops.distance_check(raw_silver(spark, sf, keep_query=True))
    return d.groupBy("fuel_type").agg(F.count(F.lit(1)).alias("rows"),
                                      F.count("distance_diff_km").alias("checked"),
                                      F.count_if(~F.col("distance_ok")).alias("bad"),
                                      F.round(F.max("distance_diff_km"), 3).alias("max_diff_km"))


def q_silver_validate_raw(spark, sf):
    return silverops.silver_validate(raw_silver(spark, sf))


def q_partition_slug(spark, sf):
    g = testdata.stations(spark, sf)
    return g.select("cnpj", "station_name", rawsink.partition_slug("station_name").alias("slug"))


def q_run_overwrite(spark, sf):
    """Re-write the newest collection's runs into the tree (dynamic partition
    overwrite) and read everything back: counts must not change."""
    t = tree(spark, sf)
    snapshots.write_runs(snapshots.snapshot_rows(_obs(spark, sf), collections=(0, 0)), t.data_root)
    return q_raw_runs(spark, sf)


_LAYERS: dict[str, object] = {}


def layers(spark, sf):
    from ..session import scratch_path
    from . import medallion
    key = f"{app_key(spark)}|{sf}"
    if key not in _LAYERS:
        _LAYERS[key] = medallion.run(spark, tree(spark, sf).data_root, scratch_path(spark, "layers"))
    return _LAYERS[key]


_INCR: dict[str, object] = {}


def incremental_layers(spark, sf):
    """Layers built from every run but the newest collection, then the newest
    collection ingested incrementally."""
    from ..session import scratch_path
    from . import medallion
    key = f"{app_key(spark)}|{sf}"
    if key not in _INCR:
        root = tree(spark, sf).data_root
        newest = F.col("run_id").startswith("run-0000-")
        lay = medallion.layer_paths(scratch_path(spark, "layers-incr"))
        _write_bronze(spark, root, lay, ~newest)
        medallion.build_silver(spark, lay)
        medallion.build_gold(spark, lay)
        medallion.ingest_runs(spark, root, lay, newest)
        _INCR[key] = lay
    return _INCR[key]


def _write_bronze(spark, raw_root, lay, pred):
    rawsink.write_bronze(rawsrc.scan_raw(spark, raw_root).filter(pred), lay.bronze)


def q_incremental_gold(spark, sf):
    return rawsrc.scan_table(spark, incremental_layers(spark, sf).gold).select(*SILVER_COLUMNS)


def q_incremental_silver(spark, sf):
    return rawsrc.scan_table(spark, incremental_layers(spark, sf).silver).select(*SILVER_COLUMNS)


def q_incremental_timeseries_base(spark, sf):
    return rawsrc.scan_table(spark, incremental_layers(spark, sf).daily_base).drop("obs_date")


def q_layers_gold(spark, sf):
    return rawsrc.scan_table(spark, layers(spark, sf).gold).select(*SILVER_COLUMNS)


def q_layers_silver(spark, sf):
    return rawsrc.scan_table(spark, layers(spark, sf).silver).select(*SILVER_COLUMNS)


def q_layers_timeseries_base(spark, sf):
    return rawsrc.scan_table(spark, layers(spark, sf).daily_base).drop("obs_date")


def _stored(spark, sf):
    from . import medallion
    lay = layers(spark, sf)
    return (medallion.read_silver(spark, lay), rawsrc.scan_table(spark, lay.daily_base),
            rawsrc.scan_table(spark, lay.labels))


def q_price_drop_stored(spark, sf):
    from ..operators import alerts
    s, _, lab = _stored(spark, sf)
    return alerts.price_drop(s, "click", hours=72, pct_drop=3.0, limit=50, labels=lab)


def q_price_drop_all_stored(spark, sf):
    from ..operators import alerts
    s, _, lab = _stored(spark, sf)
    return alerts.price_drop_all(s, hours=24, pct_drop=3.0, labels=lab)


def q_anomalies_stored(spark, sf):
    from ..operators import alerts
    s, _, _ = _stored(spark, sf)
    return alerts.anomalies(s, "click", hours=168, z=2.0, limit=100)


def q_timeseries_city_stored(spark, sf):
    from ..operators import series
    s, base, _ = _stored(spark, sf)
    return series.timeseries_city(s, "click", city="NATION_3", page=1, page_size=500, base=base).items


def q_stats_summary_stored(spark, sf):
    from ..operators import series
    s, base, _ = _stored(spark, sf)
    return series.stats_summary(s, date_from="2024-01-05", date_to="2024-01-20 23:59:59.999999", fuel_type="click",
                                base=base)


EDGE_FROM, EDGE_TO = "2024-01-05 09:30:00", "2024-01-20 23:59:59"


def q_timeseries_city_edges(spark, sf):
    """A range that cuts its first day and, by whole seconds, its last one."""
    from ..operators import series
    s, base, _ = _stored(spark, sf)
    return series.timeseries_city(s, "click", city="NATION_3", date_from=EDGE_FROM, date_to=EDGE_TO, page=1, page_size=500, base=base).items


def q_timeseries_daily_edges(spark, sf):
    from ..operators import series
    s, base, _ = _stored(spark, sf)
    return series.timeseries_daily(s, date_from=EDGE_FROM, date_to=EDGE_TO, page=1, page_size=50, base=base).items


def q_stats_summary_edges(spark, sf):
    from ..operators import series
    s, base, _ = _stored(spark, sf)
    return series.stats_summary(s, date_from=EDGE_FROM, date_to=EDGE_TO, fuel_type="click", base=base)


def q_kpi_consistency_stored(spark, sf):
    """Stored silver against the stored daily base, two tables written by different steps."""
    from ..operators import series
    s, base, _ = _stored(spark, sf)
    return series.kpi_consistency(s, base=base)


QUERIES = {
    "timeseries_city_edges": q_timeseries_city_edges,
    "timeseries_daily_edges": q_timeseries_daily_edges,
    "stats_summary_edges": q_stats_summary_edges,
    "kpi_consistency_stored": q_kpi_consistency_stored,
    "price_drop_stored": q_price_drop_stored,
    "price_drop_all_stored": q_price_drop_all_stored,
    "anomalies_stored": q_anomalies_stored,
    "timeseries_city_stored": q_timeseries_city_stored,
    "stats_summary_stored": q_stats_summary_stored,
    "incremental_silver": q_incremental_silver,
    "incremental_gold": q_incremental_gold,
    "incremental_timeseries_base": q_incremental_timeseries_base,
    "layers_silver": q_layers_silver,
    "layers_gold": q_layers_gold,
    "layers_timeseries_base": q_layers_timeseries_base,
    "raw_runs": q_raw_runs,
    "raw_line_quality": q_raw_line_quality,
    "silver_from_raw": q_silver_from_raw,
    "gold_from_raw": q_gold_from_raw,
    "run_manifests": q_run_manifests,
    "overall_manifest": q_overall_manifest,
    "run_log": q_run_log,
    "run_log_lines": q_run_log_lines,
    "response_pages": q_response_pages,
    "run_reconcile": q_run_reconcile,
    "snapshot_envelope": q_snapshot_envelope,
    "response_check": q_response_check,
    "unit_canonical": q_unit_canonical,
    "distance_check": q_distance_check,
    "silver_validate_raw": q_silver_validate_raw,
    "partition_slug": q_partition_slug,
    "run_overwrite": q_run_overwrite,
}

# ---------------------------------------------------------------------------
# SQL twins
# ---------------------------------------------------------------------------

_COLS = ", ".join(SILVER_COLUMNS)
_NOT_RUN = [c for c in SILVER_COLUMNS if c not in ("run_id", "collected_at")]


def _raw_ctes(body: str) -> str:
    """CTEs: base (adapter silver), snap (observation x run), raw_silver
    (typed rows as read back, one per copy), silver (deduplicated)."""
    lag = "(epoch_us(x.t) - epoch_us(b.price_ts))"
    first = f"CAST(greatest(0, floor(({lag} - {WIN_US}) / {STEP_US}) + 1) AS BIGINT)"
    last = f"CAST(floor({lag} / {STEP_US}) AS BIGINT)"
    keep = ", ".join(f"b.{c}" for c in _NOT_RUN)
    return f"""WITH base AS ({testdata.SILVER_SQL}),
x AS (SELECT max(price_ts) AS t FROM base),
exploded AS (SELECT b.*, x.t, unnest(range({first}, {last} + 1)) AS collection FROM base b, x),
snap AS (
  SELECT e.*, e.t - e.collection * INTERVAL {snapshots.STEP_HOURS} HOUR AS coll_at,
         'run-' || lpad(CAST(e.collection AS VARCHAR), 4, '0') || '-' || e.fuel_type AS run,
         CAST(e.t - e.collection * INTERVAL {snapshots.STEP_HOURS} HOUR
              + INTERVAL ({snapshots.LOCAL_OFFSET_HOURS}) HOUR AS DATE) AS dt,
         strftime(e.t - e.collection * INTERVAL {snapshots.STEP_HOURS} HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
           AS collected_at_utc
  FROM exploded e),
raw_silver AS (SELECT {", ".join(_NOT_RUN)}, run AS run_id, coll_at AS collected_at FROM snap),
silver AS (SELECT {_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY cnpj, product_code, price_ts ORDER BY collected_at, run_id) AS rn
  FROM raw_silver) WHERE rn = 1)
{body}"""


def _runs_sql() -> str:
    return ("SELECT run AS run_id, fuel_type AS anp, dt, min(collected_at_utc) AS collected_at_utc, "
            "count(*) AS n, min(coll_at) AS coll_at, collection AS i FROM snap GROUP BY ALL")


def _manifests_sql() -> str:
    """Runs with a manifest, with the faults planted in the derived tree."""
    return (f"SELECT *, n + CAST(i % {snapshots.FAULT_EVERY} = {snapshots.SHORT} AS BIGINT) AS written, n + 3 * i AS total "
            f"FROM ({_runs_sql()}) WHERE i % {snapshots.FAULT_EVERY} <> {snapshots.NO_MANIFEST}")


def _logged_sql() -> str:
    """Runs in the logs: those with a manifest, and the ones only logged."""
    return (f"SELECT run_id, anp, written AS logged, coll_at FROM ({_manifests_sql()}) UNION ALL "
            f"SELECT 'run-' || ({snapshots.GHOSTS} + i) || '-' || anp, anp, {snapshots.GHOST_ROWS}, coll_at "
            f"FROM ({_runs_sql()}) WHERE i % {snapshots.FAULT_EVERY} = {snapshots.GHOST}")


def _validate_raw_sql() -> str:
    from .sql_common import VALIDATE_SQL
    return VALIDATE_SQL.replace("FROM silver GROUP BY fuel_type", "FROM raw_silver GROUP BY fuel_type")


ORACLE_SQL = {
    "raw_runs": _raw_ctes("SELECT run AS run_id, fuel_type AS anp, dt, count(*) AS rows FROM snap GROUP BY ALL"),
    "silver_from_raw": _raw_ctes(f"SELECT {_COLS} FROM silver"),
    "raw_line_quality": _raw_ctes("""
SELECT run AS run_id, count(*) AS lines, CAST(0 AS BIGINT) AS corrupt_lines, CAST(0 AS BIGINT) AS lines_without_item,
       count(*) FILTER (WHERE cnpj IS NULL OR product_code IS NULL OR price_ts IS NULL) AS lines_without_key
FROM snap GROUP BY run"""),
    "gold_from_raw": _raw_ctes(f"""SELECT {_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY cnpj, product_code
                               ORDER BY price_ts DESC, collected_at DESC, run_id DESC) AS rn FROM silver) WHERE rn = 1"""),
    "run_manifests": _raw_ctes(f"""
SELECT run_id, anp, collected_at_utc, CAST(ceil(total / {PAGE_ROWS}) AS BIGINT) AS totalPaginas_reported,
       total AS totalRegistros_reported, n AS registrosdaPagina_reported, written AS rows_written
FROM ({_manifests_sql()})"""),
    "overall_manifest": _raw_ctes(f"""
SELECT collected_at_utc AS finished_at_utc, run_id, anp, written AS rows_written FROM ({_manifests_sql()})"""),
    "run_log": _raw_ctes(f"""
SELECT run_id, anp AS fuel, CAST(logged AS BIGINT) AS "rows",
       date_trunc('millisecond', coll_at + INTERVAL ({snapshots.LOCAL_OFFSET_HOURS}) HOUR) AS ts, 'INFO' AS level
FROM ({_logged_sql()})"""),
    "run_log_lines": _raw_ctes(f"""
SELECT 'INFO' AS level, fuel, kind, count(*) AS lines, count(run) AS with_run, CAST(sum(logged) AS BIGINT) AS "rows" FROM (
  SELECT anp AS fuel, 'fetching page' AS kind, NULL AS run, NULL AS logged FROM ({_logged_sql()}) UNION ALL
  SELECT anp, 'wrote', run_id, logged FROM ({_logged_sql()}) UNION ALL
  SELECT '', k, NULL, NULL FROM (SELECT DISTINCT coll_at FROM ({_logged_sql()})), (VALUES ('Starting run'), ('Run completed')) AS t(k))
GROUP BY ALL"""),
    "response_pages": _raw_ctes(f"""
SELECT CASE WHEN kind = {CUT} THEN NULL ELSE run END AS run_id, count(*) AS pages,
       CAST(sum(CASE WHEN kind IN ({OBJECT}, {NO_LIST}, {CUT}) THEN 0 ELSE k END) AS BIGINT) AS items,
       CAST(max(CASE WHEN kind IN ({TEXT_TOTAL}, {NO_TOTAL}, {CUT}) THEN 1 ELSE 2 END) AS BIGINT) AS total_pages,
       CAST(sum(CASE WHEN kind IN ({NO_TOTAL}, {CUT}) THEN 0 WHEN kind IN ({TEXT_TOTAL}, {OBJECT}, {NO_LIST}) THEN k ELSE k + page END) AS BIGINT) AS total_records,
       CAST(sum(CASE WHEN kind = {CUT} THEN 0 ELSE k END) AS BIGINT) AS page_records,
       count(*) FILTER (WHERE kind IN ({OBJECT}, {NO_LIST}, {CUT})) AS without_list
FROM (SELECT *, page % {PAGE_FAULTS} AS kind FROM
      (SELECT run, CAST(floor(obs_id / {PAGE_ROWS}) AS BIGINT) AS page, count(*) AS k FROM snap GROUP BY ALL))
GROUP BY ALL"""),
    "run_reconcile": _raw_ctes(f"""
SELECT coalesce(r.run_id, l.run_id) AS run_id, coalesce(r.anp, l.anp) AS anp, l.run_id IS NOT NULL AS in_log,
       r.run_id IS NOT NULL AS in_data, m.run_id IS NOT NULL AS in_manifest, CAST(l.logged AS BIGINT) AS rows_logged,
       r.n AS rows_present, m.written AS rows_written, m.total AS reported_total, r.n / m.total AS coverage,
       CASE WHEN r.run_id IS NULL THEN 'log_only' WHEN m.run_id IS NULL THEN 'data_without_manifest'
            WHEN r.n <> m.written THEN 'row_count_mismatch' ELSE 'ok' END AS status
FROM ({_runs_sql()}) r LEFT JOIN ({_manifests_sql()}) m ON r.run_id = m.run_id
FULL JOIN ({_logged_sql()}) l ON r.run_id = l.run_id"""),
    "snapshot_envelope": _raw_ctes("""
SELECT run AS run_id, fuel_type AS anp, count(*) AS rows, count(DISTINCT obs_id) AS observations
FROM snap GROUP BY ALL"""),
    "response_check": _raw_ctes(f"""
SELECT run_id, count(*) AS pages, CAST(sum(k) AS BIGINT) AS items, CAST(1 AS BIGINT) AS total_pages,
       CAST(0 AS BIGINT) AS total_records, CAST(sum(k) AS BIGINT) AS page_records, 1 AS all_ok
FROM (SELECT run AS run_id, floor(obs_id / {PAGE_ROWS}) AS page, count(*) AS k FROM snap GROUP BY ALL)
GROUP BY run_id"""),
    "unit_canonical": _raw_ctes(f"""
SELECT {snapshots.UNIT_SPELLINGS!r}[(obs_id % {len(snapshots.UNIT_SPELLINGS)}) + 1] AS unit_raw, 'L' AS unit,
       fuel_type = 'GNV' AS unit_suspect, count(*) AS rows
FROM snap GROUP BY ALL"""),
    "distance_check": _raw_ctes(f"""
SELECT fuel_type, count(*) AS rows, count(d) AS checked, count(*) FILTER (WHERE d > 0.01) AS bad,
       round(max(d), 3) AS max_diff_km
FROM (SELECT fuel_type,
             abs({testdata.haversine_sql(QUERY_LAT, QUERY_LNG, 'lat', 'lng')} - distance_km) AS d FROM snap)
GROUP BY fuel_type"""),
    "partition_slug": f"""
SELECT c.c_custkey AS cnpj, c.c_name AS station_name,
       regexp_replace(c.c_name, '[^a-zA-Z0-9_\\-=\\.]', '_', 'g') AS slug
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "run_overwrite": None,
}
ORACLE_SQL["run_overwrite"] = ORACLE_SQL["raw_runs"]
ORACLE_SQL["layers_silver"] = ORACLE_SQL["silver_from_raw"]
ORACLE_SQL["incremental_silver"] = ORACLE_SQL["silver_from_raw"]
ORACLE_SQL["incremental_gold"] = ORACLE_SQL["gold_from_raw"]
ORACLE_SQL["layers_gold"] = ORACLE_SQL["gold_from_raw"]
ORACLE_SQL["layers_timeseries_base"] = _raw_ctes("""
SELECT fuel_type, uf, city, cnpj, CAST(date_trunc('day', price_ts) AS TIMESTAMP) AS day,
       sum(price_unit) AS sum_price, count(price_unit) AS n_price_unit,
       count(*) AS samples, min(price_unit) AS min_price_unit, max(price_unit) AS max_price_unit,
       min(price_ts) AS min_price_ts, max(price_ts) AS max_price_ts
FROM silver GROUP BY ALL""")
ORACLE_SQL["incremental_timeseries_base"] = ORACLE_SQL["layers_timeseries_base"]
ORACLE_SQL["silver_validate_raw"] = _raw_ctes(_validate_raw_sql())
