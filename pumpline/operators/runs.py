"""Run-level operators: response pages -> rows, manifests, roll-ups, logs,
reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeconv import parse_utc_text
from ..schema import MANIFEST_SCHEMA, SOURCE_NAME

def snapshot_envelope(pages: DataFrame, source: str = SOURCE_NAME) -> DataFrame:
    """One response page per row -> one snapshot line per result item.

    ``pages`` has collected_at_utc, run_id, anp, query and ``response``
    (struct with ``resultado``: array of items).  A null or empty
    ``resultado`` yields no rows (``explode`` drops it), like the collector.
    """
    return pages.select(
        "collected_at_utc", "run_id", F.lit(source).alias("source"), "anp", "query",
        F.explode("response.resultado").alias("raw"))


def response_check(pages: DataFrame) -> DataFrame:
    """Typed page totals with the collector's defaults: totalPaginas 1,
    totalRegistros 0, registrosdaPagina = number of items; ``resultado_ok``
    is false when the page has no item list."""
    r = F.col("response")
    n_items = F.coalesce(F.size(r.getField("resultado")), F.lit(0))
    n_items = F.when(n_items < 0, F.lit(0)).otherwise(n_items)
    return pages.select(
        "run_id", "anp",
        F.coalesce(F.expr("try_cast(response.totalPaginas AS BIGINT)"), F.lit(1).cast("bigint")).alias("total_pages"),
        F.coalesce(F.expr("try_cast(response.totalRegistros AS BIGINT)"), F.lit(0).cast("bigint")).alias("total_records"),
        F.coalesce(F.expr("try_cast(response.registrosdaPagina AS BIGINT)"), n_items.cast("bigint")).alias("page_records"),
        n_items.cast("bigint").alias("items"),
        r.getField("resultado").isNotNull().alias("resultado_ok"))


def reported_totals(checked: DataFrame) -> DataFrame:
    """Per run what its response pages reported (rows of ``response_check``):
    totals are repeated on every page, page records add up."""
    return checked.groupBy("run_id").agg(F.max("total_pages").alias("total_pages"), F.max("total_records").alias("total_records"),
                                         F.sum("page_records").alias("page_records"))


def run_manifest(raw: DataFrame, out_root: str = "", reported: DataFrame | None = None) -> DataFrame:
    """Per-run manifest: rows written from the lines a run left on disk, the
    source's totals from ``reported`` (see ``reported_totals``); without it
    they are null, never made up from the rows."""
    agg = raw.groupBy("run_id", "anp", "dt", "source").agg(
        F.min("collected_at_utc").alias("collected_at_utc"),
        F.any_value("query").alias("query"),
        F.count(F.lit(1)).alias("n"))
    if reported is None:
        none = F.lit(None).cast("bigint")
        agg = agg.withColumns({"total_pages": none, "total_records": none, "page_records": none})
    else:
        agg = agg.join(reported, "run_id", "left")
    path = F.concat_ws("/", F.lit(out_root.rstrip("/")), F.concat(F.lit("source="), F.col("source")),
                       F.concat(F.lit("anp="), F.col("anp")), F.concat(F.lit("dt="), F.col("dt").cast("string")),
                       F.concat(F.lit("run_id="), F.col("run_id")))
    return agg.select(
        "run_id", "collected_at_utc", "anp", F.lit(None).cast("string").alias("base_url"),
        path.alias("out_root"), F.lit(None).cast("string").alias("data_file"), "query",
        F.struct(F.col("total_pages").alias("totalPaginas_reported"),
                 F.col("total_records").alias("totalRegistros_reported"),
                 F.col("page_records").alias("registrosdaPagina_reported"),
                 F.col("n").alias("rows_written")).alias("response_stats"))


def run_rollup(manifests: DataFrame, out_dir: str = "", gap: str = "5 minutes") -> DataFrame:
    """One record per collection: the run manifests whose collection times
    are within ``gap`` of each other, with start/finish times taken from
    the runs (not from the collector's clock before its loop).  The runs list
    per collection is bounded by the number of fuels.

    Sessions are formed within each UTC day, so the work spreads over days.
    A day's first session that begins within ``gap`` of the last one of the
    day before goes on with it, over several midnights if whole days are one
    session; only a row per day is ordered for that."""
    m = (manifests.withColumn("_t", F.try_to_timestamp(F.col("collected_at_utc")))
         .withColumn("_day", F.to_date(parse_utc_text(F.col("collected_at_utc")))))
    sessions = m.groupBy("_day", F.session_window("_t", gap).alias("_w")).agg(
        F.min("_t").alias("_from"), F.max("_t").alias("_to"), F.min("collected_at_utc").alias("started_at_utc"),
        F.max("collected_at_utc").alias("finished_at_utc"), F.count(F.lit(1)).alias("n_runs"),
        F.sum("response_stats.rows_written").alias("rows_written"),
        F.collect_list(F.struct(*[F.col(c) for c in MANIFEST_SCHEMA.fieldNames()])).alias("runs"))
    days = sessions.groupBy("_day").agg(F.min("_from").alias("_first"), F.max("_to").alias("_end"), F.max("_from").alias("_last"),
                                        F.count(F.lit(1)).alias("_n"))
    by_day = Window.orderBy("_day")
    follows = (F.lag("_day").over(by_day) == F.date_sub("_day", 1)) & (F.col("_first") < F.lag("_end").over(by_day) + F.expr(f"INTERVAL {gap}"))
    days = days.withColumn("_follows", F.coalesce(follows, F.lit(False)))
    # Where a session that goes on began: the last session of the nearest earlier day that does not only go on itself.
    start = F.last(F.when(~F.col("_follows") | (F.col("_n") > 1), F.col("_last")), ignorenulls=True).over(by_day.rowsBetween(Window.unboundedPreceding, -1))
    days = days.select("_day", "_first", F.when(F.col("_follows"), start).alias("_start"))
    root = F.when(F.col("_from") == F.col("_first"), F.coalesce("_start", "_from")).otherwise(F.col("_from"))
    whole = sessions.join(days, "_day").groupBy(root.alias("_root")).agg(
        F.min("started_at_utc").alias("started_at_utc"), F.max("finished_at_utc").alias("finished_at_utc"),
        F.sum("n_runs").alias("n_runs"), F.sum("rows_written").alias("rows_written"),
        F.sort_array(F.flatten(F.collect_list("runs"))).alias("runs"))
    return whole.select("finished_at_utc", F.lit(out_dir).alias("out_dir"), "started_at_utc", "n_runs",
                        "rows_written", "runs")


def _local(ts_text_col: str, offset_hours: int = -3):
    t = parse_utc_text(F.col(ts_text_col))
    return t + F.make_dt_interval(F.lit(0), F.lit(offset_hours))


def run_log_lines(manifests: DataFrame, data_root: str, offset_hours: int = -3) -> DataFrame:
    """The collector's log lines for each collection (one log per
    collection, local clock), as a text frame with a ``log`` partition."""
    roll = run_rollup(manifests)
    start = _local("started_at_utc", offset_hours)
    fmt = "yyyy-MM-dd HH:mm:ss,SSS"
    log = F.concat(F.lit("run_"), F.date_format(start, "yyyyMMdd_HHmmss"))
    run = F.col("r")
    per_run = roll.select(log.alias("log"), F.explode("runs").alias("r")).select(
        "log",
        F.explode(F.array(
            F.concat(F.lit("["), F.date_format(_local("r.collected_at_utc", offset_hours), fmt), F.lit("] [INFO] "),
                     run.anp, F.lit(": fetching page 1 (only) ...")),
            F.concat(F.lit("["), F.date_format(_local("r.collected_at_utc", offset_hours), fmt), F.lit("] [INFO] "),
                     run.anp, F.lit(": wrote "), run.response_stats.rows_written.cast("string"),
                     F.lit(" rows (page 1) -> "), run.out_root, F.lit("/data.jsonl")))).alias("value"))
    per_collection = roll.select(
        log.alias("log"),
        F.explode(F.array(
            F.concat(F.lit("["), F.date_format(start, fmt), F.lit("] [INFO] Starting run. Log file: "), log,
                     F.lit(".log")),
            F.concat(F.lit("["), F.date_format(_local("finished_at_utc", offset_hours), fmt),
                     F.lit("] [INFO] Run completed successfully.")))).alias("value"))
    return per_collection.unionByName(per_run).select("value", "log")


def run_reconcile(logs: DataFrame, raw: DataFrame, manifests: DataFrame) -> DataFrame:
    """Per run_id: is it in the logs, on disk, in a manifest; rows logged vs
    present vs written vs reported; coverage = present / reported; status.

    Each input is first reduced to one row per run (partial aggregation), so
    the full outer joins are between small per-run tables.
    """
    lg = (logs.filter(F.col("run_id").isNotNull())
          .groupBy("run_id").agg(F.max("rows").alias("rows_logged"), F.max("fuel").alias("fuel_logged")))
    dt = raw.groupBy("run_id").agg(F.count(F.lit(1)).alias("rows_present"), F.max("anp").alias("anp_data"))
    mf = manifests.groupBy("run_id").agg(F.max("response_stats.rows_written").alias("rows_written"),
                                         F.max("response_stats.totalRegistros_reported").alias("reported_total"),
                                         F.max("anp").alias("anp_manifest"))
    j = lg.join(dt, "run_id", "full_outer").join(mf, "run_id", "full_outer")
    in_log, in_data, in_man = (F.col("rows_logged").isNotNull() | F.col("fuel_logged").isNotNull(),
                               F.col("rows_present").isNotNull(), F.col("rows_written").isNotNull())
    status = (F.when(in_log & ~in_data & ~in_man, "log_only")
               .when(in_data & ~in_man, "data_without_manifest")
               .when(~in_data & in_man, "manifest_without_data")
               .when(in_data & in_man & (F.col("rows_present") != F.col("rows_written")), "row_count_mismatch")
               .when(in_log & in_data & (F.col("rows_logged") != F.col("rows_present")), "log_count_mismatch")
               .when(~in_log, "not_logged")
               .otherwise("ok"))
    return j.select(
        "run_id", F.coalesce("anp_data", "anp_manifest", "fuel_logged").alias("anp"),
        in_log.alias("in_log"), in_data.alias("in_data"), in_man.alias("in_manifest"),
        "rows_logged", "rows_present", "rows_written", "reported_total",
        F.try_divide(F.col("rows_present"), F.col("reported_total")).alias("coverage"),
        status.alias("status"))


def raw_line_quality(raw: DataFrame) -> DataFrame:
    """Per run: lines, corrupt lines (text kept in ``_corrupt_record`` by
    ``scan_raw(keep_corrupt=True)``), lines without an item, lines without
    an observation key.  One partial aggregation per run."""
    corrupt = (F.col("_corrupt_record").isNotNull() if "_corrupt_record" in raw.columns
               else F.lit(False))
    no_item = F.col("raw").isNull() | F.col("raw.produto").isNull() | F.col("raw.estabelecimento").isNull()
    no_key = (F.col("raw.estabelecimento.cnpj").isNull() | F.col("raw.produto.codProduto").isNull()
              | F.col("raw.produto.data").isNull())
    return raw.groupBy("run_id").agg(F.count(F.lit(1)).alias("lines"),
                                     F.count_if(corrupt).alias("corrupt_lines"),
                                     F.count_if(~corrupt & no_item).alias("lines_without_item"),
                                     F.count_if(~corrupt & ~no_item & no_key).alias("lines_without_key"))
