"""Structured Streaming forms of ingestion, dedup, latest price and daily
aggregates, price drops.

Stages are chained through files, the way a medallion layout runs in
production: raw JSONL -> silver stream (parquet sink) -> dedup stream ->
gold / daily streams.  Every sink is idempotent per epoch (file sink with its
commit log, or ``foreachBatch`` writing a path/partition keyed by the epoch
or by the data), and every query keeps its progress in a checkpoint under
the shared ``spark.checkpoint.dir``, so a lost executor or a restarted job
re-runs the same epochs with the same result.

Event time is ``price_ts`` (UTC wall clock, timestamp_ntz).  Watermarks need
``timestamp``, so the streams carry ``event_time``, the instant of
``price_ts`` (converted through the session zone, so any zone works).  The default watermark is the collector's 72 h
window: an observation can first be collected up to 72 h after it happened.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.timeconv import instant_to_utc_ntz, utc_ntz_to_instant
from ..operators.silver import silver_flatten, silver_typed
from ..schema import GOLD_KEY, OBS_KEY, QUERY_HOURS, RAW_SCHEMA, SILVER_COLUMNS
from ..session import app_key, scratch_path, with_settings
from ..sinks import versions
from ..sources.raw import DATA_GLOB

WATERMARK = f"{QUERY_HOURS} hours"
DAILY_SCHEMA = ("day timestamp_ntz, sum_price double, n_price bigint, min_price_unit double, max_price_unit double, "
                "samples bigint, d string, fuel_type string")
DROPS_SCHEMA = ("fuel_type string, cnpj bigint, station_name string, city string, uf string, window_start timestamp_ntz, "
                "avg_last double, avg_prev double, pct_drop double")
OBS_COLUMNS = [c for c in SILVER_COLUMNS if c not in ("run_id", "collected_at")]


@dataclass
class StreamRun:
    query: StreamingQuery
    output: str
    checkpoint: str


class _LateRows(StreamingQueryListener):
    """Rows each query dropped as late, per epoch (a query's own progress
    keeps only the newest epochs)."""

    def __init__(self):
        self.epochs: dict[tuple[str, int], int] = {}

    def note(self, progress) -> None:
        self.epochs[str(progress.runId), progress.batchId] = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.note(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


_LISTENERS: dict[str, _LateRows] = {}


def _late_rows(spark: SparkSession) -> _LateRows:
    """The session's listener, added once."""
    app = app_key(spark)
    if app not in _LISTENERS:
        _LISTENERS[app] = _LateRows()
        spark.streams.addListener(_LISTENERS[app])
    return _LISTENERS[app]


# State partitions of a stream that starts anew (its checkpoint fixes them from
# then on).  Every task reports figures of every partition of each of its
# operator's stores, so what reaches the driver grows with their square.
STATE_PARTITIONS = 64
# Spark's store for states that may outgrow the heap: on local disk, its memory bounded for all of an executor's stores.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
           "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true"}


def _run(writer, output: str, checkpoint: str, available_now: bool = True, timeout_s: int | None = None,
         wait: bool = True, on_disk: bool = False) -> StreamRun:
    _late_rows(SparkSession.active())
    w = writer.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    spark = SparkSession.active()
    partitions = min(STATE_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with with_settings(spark, {"spark.sql.shuffle.partitions": str(partitions), **(ROCKSDB if on_disk else {})}):
        run = StreamRun(w.start(), output, checkpoint)
    if available_now and wait:
        finish(run, timeout_s)
    return run


def finish(run: StreamRun, timeout_s: int | None = None) -> StreamRun:
    """Wait until an availableNow query has drained, however long that takes
    unless the caller sets a limit; surface its failure."""
    q = run.query
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream did not finish within {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()
    return run


def raw_stream(spark: SparkSession, raw_root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New snapshot files under ``raw_root`` as a stream (explicit schema;
    manifests excluded by the name filter)."""
    r = (spark.readStream.schema(RAW_SCHEMA).option("pathGlobFilter", DATA_GLOB)
         .option("recursiveFileLookup", "false"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(raw_root)


def stream_bronze_silver(spark: SparkSession, raw_root: str, out: str | None = None,
                         max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamRun:
    """Raw lines -> typed silver rows (every collected copy), parquet sink."""
    out = out or scratch_path(spark, "stream-silver")
    silver = silver_typed(silver_flatten(raw_stream(spark, raw_root, max_files_per_trigger)))
    w = silver.writeStream.format("parquet").option("path", out).outputMode("append")
    return _run(w, out, out + "-ckpt", available_now)


def silver_stream(spark: SparkSession, silver_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    schema = spark.read.parquet(silver_path).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return _timed(r.parquet(silver_path))


def _timed(silver: DataFrame) -> DataFrame:
    return silver.withColumn("event_time", utc_ntz_to_instant(F.col("price_ts")))


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stream's table, empty as long as it has written nothing."""
    return (spark.read.schema(schema).parquet(path) if versions.exists(spark, path) else spark.createDataFrame([], schema))


def _first_copies(s: DataFrame) -> DataFrame:
    """The earliest collected copy of each observation of ``s`` (silver with
    event_time)."""
    rest = [c for c in s.columns if c not in (*OBS_KEY, "event_time")]
    first = s.groupBy(*OBS_KEY, "event_time").agg(F.min_by(F.struct(*rest), F.struct("collected_at", "run_id")).alias("_row"))
    return first.select(*OBS_KEY, "_row.*").select(*[c for c in s.columns if c != "event_time"])


def stream_dedup(spark: SparkSession, silver_path: str, out: str | None = None, watermark: str = WATERMARK,
                 max_files_per_trigger: int | None = None, available_now: bool = True, checkpoint: str | None = None) -> StreamRun:
    """One row per observation, its earliest collection, emitted once it is
    final: when the watermark (newest event time seen minus ``watermark``)
    has passed the observation.

    The copies of a key are reduced within each task before the shuffle, so a
    hot key costs one row per task and batch; the state keeps the earliest
    copy of every key of one watermark span.  A copy arriving after its
    observation is final is dropped as late (counted in the query progress).
    """
    out = out or scratch_path(spark, "stream-dedup")
    s = (silver_stream(spark, silver_path, max_files_per_trigger)
         .filter(F.col("event_time").isNotNull() & F.col("cnpj").isNotNull() & F.col("product_code").isNotNull())
         .withWatermark("event_time", watermark))
    w = _first_copies(s).writeStream.format("parquet").option("path", out).outputMode("append")
    return _run(w, out, checkpoint or out + "-ckpt", available_now)


def write_open(spark: SparkSession, dedup: StreamRun, silver_path: str, out: str) -> None:
    """What a drained ``stream_dedup`` still holds back: the earliest copies,
    so far, of the observations newer than its watermark.  ``out`` is replaced
    as a whole; it never holds more than a watermark span, and no observation
    that the stream has emitted.  A drain without a new epoch leaves it as it is."""
    progress = dedup.query.lastProgress
    if progress is None or "watermark" not in progress.eventTime:
        return
    passed = F.lit(progress.eventTime["watermark"].rstrip("Z").replace("T", " ")).cast("timestamp_ntz")
    s = spark.read.parquet(silver_path).filter((F.col("price_ts") > passed) & F.col("cnpj").isNotNull() & F.col("product_code").isNotNull())
    _first_copies(_timed(s)).write.mode("overwrite").parquet(out)


def stream_gold_latest(spark: SparkSession, silver_path: str, out: str | None = None,
                       available_now: bool = True, wait: bool = True, max_files_per_trigger: int | None = None) -> StreamRun:
    """Latest row per (cnpj, product_code), kept current by a streaming
    aggregation over all collected copies (one state row per key: the number
    of station products, not of observations).  Of an observation's copies
    the earliest collection counts, as after dedup.

    Update mode: an epoch holds the keys that it touched.  They are merged
    into the stored table by replacing the buckets of their stations only,
    as a new version beside the old one, so an epoch writes what it touches
    and a retried epoch leaves the same rows (``read_gold``).
    """
    out = out or scratch_path(spark, "stream-gold")
    s = silver_stream(spark, silver_path, max_files_per_trigger).filter(
        F.col("event_time").isNotNull() & F.col("cnpj").isNotNull() & F.col("product_code").isNotNull())
    cols = [c for c in s.columns if c not in (*GOLD_KEY, "event_time")]
    newest_first = F.struct((-F.unix_micros("event_time")).alias("age"), F.col("collected_at"), F.col("run_id"))
    agg = s.groupBy(*GOLD_KEY).agg(F.min_by(F.struct(*cols), newest_first).alias("_row"))
    latest = agg.select(*GOLD_KEY, "_row.*")

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        stage = f"{out}-stage"
        batch.write.mode("overwrite").parquet(stage)
        new = spark.read.schema(batch.schema).parquet(stage)
        if new.isEmpty():
            return
        if versions.exists(spark, out):
            touched = new.select(versions.bucket_of("cnpj").alias("bucket")).distinct()
            stored = versions.read_current(spark, out, keep_bucket=True).join(touched, "bucket", "left_semi")
            new = new.unionByName(stored.join(new.select(*GOLD_KEY), GOLD_KEY, "left_anti").select(*new.columns))
        versions.write_version(new, out, "cnpj", ("fuel_type", "lat"))

    w = latest.writeStream.outputMode("update").foreachBatch(upsert)
    return _run(w, out, out + "-ckpt", available_now, wait=wait)


def read_gold(spark: SparkSession, out: str) -> DataFrame:
    """The table kept by ``stream_gold_latest``."""
    return versions.read_current(spark, out)


def stream_daily(spark: SparkSession, dedup_path: str, out: str | None = None, watermark: str = WATERMARK,
                 available_now: bool = True, wait: bool = True, max_files_per_trigger: int | None = None) -> StreamRun:
    """Tumbling 1-day avg/min/max/count per fuel.

    Update mode: each epoch emits the full running aggregate of every
    (day, fuel) it touched; ``foreachBatch`` writes them with dynamic
    partition overwrite on (day, fuel), so the table always holds the latest
    figure per partition and a retried epoch rewrites the same partitions.
    Windows older than the watermark are final and leave the state.  The
    table keeps sums and counts, to which ``read_daily`` adds what is open.
    """
    out = out or scratch_path(spark, "stream-daily")
    s = silver_stream(spark, dedup_path, max_files_per_trigger).withWatermark("event_time", watermark)
    daily = _daily_figures(s)

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        (batch.withColumn("d", F.date_format("day", "yyyy-MM-dd"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("d", "fuel_type").parquet(out))

    w = daily.writeStream.outputMode("update").foreachBatch(upsert)
    return _run(w, out, out + "-ckpt", available_now, wait=wait)


def _daily_figures(s: DataFrame) -> DataFrame:
    agg = (s.groupBy(F.window("event_time", "1 day").alias("w"), "fuel_type")
           .agg(F.sum("price_unit").alias("sum_price"), F.count("price_unit").alias("n_price"),
                F.count(F.lit(1)).alias("samples"), F.min("price_unit").alias("min_price_unit"),
                F.max("price_unit").alias("max_price_unit")))
    return agg.select(instant_to_utc_ntz(F.col("w.start")).alias("day"), "fuel_type",
                      "sum_price", "n_price", "min_price_unit", "max_price_unit", "samples")


def read_daily(spark: SparkSession, out: str, open_path: str | None = None) -> DataFrame:
    """The daily series kept by ``stream_daily``; with ``open_path`` (see
    ``write_open``) the observations that are not final yet count too."""
    days = _stored(spark, out, DAILY_SCHEMA).drop("d")
    if open_path:
        days = days.unionByName(_daily_figures(_timed(spark.read.parquet(open_path))))
        days = days.groupBy("day", "fuel_type").agg(*[F.sum(c).alias(c) for c in ("sum_price", "n_price", "samples")],
                                                    F.min("min_price_unit").alias("min_price_unit"), F.max("max_price_unit").alias("max_price_unit"))
    return days.select("day", "fuel_type", (F.col("sum_price") / F.col("n_price")).alias("avg_price_unit"),
                       "min_price_unit", "max_price_unit", "samples")


def stream_price_drop(spark: SparkSession, dedup_path: str, hours: int = 24, pct_drop: float = 3.0, out: str | None = None,
                      watermark: str = WATERMARK, available_now: bool = True, slide_hours: int | None = None,
                      wait: bool = True, max_files_per_trigger: int | None = None) -> StreamRun:
    """Alerts in the stream: stations whose mean price in an ``hours`` window
    fell by at least ``pct_drop`` percent against the window that ends where
    it starts.

    Two windowed means of the same rows, one of them over event times moved
    on by ``hours``, so the window before carries the name of its successor.
    They are joined on window, fuel and station: a chain of stateful
    operators in append mode.  Both sides leave their aggregation when the
    watermark passes the window's end, meet in the join in that epoch and
    leave its state with it; an epoch appends its alerts and nothing that an
    earlier epoch wrote is read again.  Windows are tumbling by default;
    ``slide_hours`` (a divisor of ``hours``) makes them slide, and state
    grows by hours / slide_hours; that of sliding windows is kept on local
    disk (RocksDB), slower than on the heap.
    """
    out = out or scratch_path(spark, "stream-price-drop")

    def rows(later: int) -> DataFrame:
        s = silver_stream(spark, dedup_path, max_files_per_trigger)
        return s.withColumn("event_time", _moved(later)).withWatermark("event_time", watermark)

    w = _drop_alerts(rows, hours, pct_drop, slide_hours).writeStream.format("parquet").option("path", out).outputMode("append")
    return _run(w, out, out + "-ckpt", available_now, wait=wait, on_disk=slide_hours is not None)


def _moved(later: int) -> Column:
    return F.col("event_time") + F.make_dt_interval(F.lit(0), F.lit(later))


def _drop_alerts(rows: Callable[[int], DataFrame], hours: int, pct_drop: float, slide_hours: int | None) -> DataFrame:
    """Price drops of adjacent windows; ``rows(later)`` are the observations
    with their event times moved on by that many hours."""
    keys = ["w", "fuel_type", "cnpj"]

    def windows(later: int):
        return rows(later).groupBy(F.window("event_time", f"{hours} hours", f"{slide_hours or hours} hours").alias("w"), "fuel_type", "cnpj")

    mean = F.sum("price_unit") / F.count("price_unit")
    last = windows(0).agg(mean.alias("avg_last"), *[F.max(c).alias(c) for c in ("station_name", "city", "uf")])
    both = last.join(windows(hours).agg(mean.alias("avg_prev")), keys)
    pct = F.try_divide(F.col("avg_prev") - F.col("avg_last"), F.col("avg_prev")) * F.lit(100.0)
    return both.withColumn("pct_drop", pct).filter(F.col("pct_drop") >= F.lit(pct_drop)).select(
        "fuel_type", "cnpj", "station_name", "city", "uf", instant_to_utc_ntz(F.col("w.start")).alias("window_start"),
        "avg_last", "avg_prev", "pct_drop")


def read_drops(spark: SparkSession, out: str, dedup_path: str, open_path: str, hours: int = 24, pct_drop: float = 3.0,
               watermark: str = WATERMARK, slide_hours: int | None = None) -> DataFrame:
    """The alerts that a drained ``stream_price_drop`` (same parameters) has
    appended and, as far as observations have come, those of the windows that
    it has not closed: of final and open observations from two windows before
    the watermark on, the only ones read again."""
    opened = spark.read.parquet(open_path)
    final = spark.read.schema(opened.schema).parquet(dedup_path)
    # Its watermark, in whole milliseconds; null before anything is final.
    passed = final.agg((F.date_trunc("millisecond", F.max("price_ts")).cast("timestamp_ntz") - F.expr(f"INTERVAL {watermark}")).alias("t")).scalar()
    window = F.make_dt_interval(F.lit(0), F.lit(hours))

    def since(column: str, bound: Column) -> Column:
        return F.coalesce(F.col(column) > bound, F.lit(True))

    recent = final.unionByName(opened).filter(since("price_ts", passed - window - window))
    alerts = _drop_alerts(lambda later: _timed(recent).withColumn("event_time", _moved(later)), hours, pct_drop, slide_hours)
    closed = _stored(spark, out, DROPS_SCHEMA)
    return closed.unionByName(alerts.filter(since("window_start", passed - window)))


def late_data_report(silver_copies: DataFrame, thresholds_h=(24, 48, 72), quantiles: bool = False) -> DataFrame:
    """Lag between observation and collection, per fuel: rows, max and mean
    lag in hours and rows later than each threshold (a watermark shorter
    than the lag drops them).  ``quantiles=True`` adds approximate p50/p95
    (bounded-memory sketches)."""
    lag_s = F.timestamp_diff("SECOND", F.col("price_ts"), F.col("collected_at"))
    d = silver_copies.withColumn("_lag_s", lag_s)
    aggs = [F.count(F.lit(1)).alias("rows"),
            (F.max("_lag_s") / F.lit(3600.0)).alias("max_lag_h"),
            (F.sum("_lag_s") / F.count("_lag_s") / F.lit(3600.0)).alias("mean_lag_h")]
    aggs += [F.count_if(F.col("_lag_s") > F.lit(h * 3600)).alias(f"later_than_{h}h") for h in thresholds_h]
    if quantiles:
        aggs.append(F.percentile_approx(F.col("_lag_s") / 3600.0, [0.5, 0.95]).alias("lag_h_p50_p95"))
    return d.groupBy("fuel_type").agg(*aggs)


def watermark_drops(run: StreamRun) -> int:
    """Rows the stream dropped as later than its watermark, over all epochs
    of this run."""
    seen = _late_rows(SparkSession.active())
    for p in run.query.recentProgress:  # those whose event may not have arrived yet
        seen.note(p)
    return sum(n for (run_id, _), n in list(seen.epochs.items()) if run_id == str(run.query.runId))


@dataclass
class StreamChain:
    silver: str
    dedup: str
    gold: str
    daily: str
    drops: str
    open: str | None = None


def run_chain(spark: SparkSession, raw_root: str, out_root: str | None = None, window_hours: int = 24,
              available_now: bool = True, watermark: str = WATERMARK, slide_hours: int | None = None, pct_drop: float = 3.0,
              raw_files_per_trigger: int | None = None, files_per_trigger: int | None = None, with_open: bool = False) -> StreamChain:
    """Start the whole chain: raw -> silver -> gold and dedup, dedup -> daily
    and price drops, each stage reading the previous stage's sink.

    With ``available_now`` every stage drains what is present and stops, in
    order (a scheduled incremental run), in micro-batches of at most
    ``raw_files_per_trigger`` raw files and ``files_per_trigger`` files of the
    stages after.  Otherwise the stages run
    continuously; the downstream stages are started once their source table
    has its first files.

    The dedup table has two folders: ``state=final``, which the stream appends
    to and the stages after it read, and, after a drain ``with_open``,
    ``state=open`` with the observations that are not final yet.
    """
    root = (out_root or scratch_path(spark, "stream-chain")).rstrip("/")
    run = stream_bronze_silver(spark, raw_root, out=f"{root}/silver", available_now=available_now,
                               max_files_per_trigger=raw_files_per_trigger)
    silver = run.output
    if not available_now:
        _wait_for_files(spark, run)
    run = stream_dedup(spark, silver, out=f"{root}/dedup/state=final", watermark=watermark, available_now=available_now,
                       max_files_per_trigger=files_per_trigger, checkpoint=f"{root}/dedup-ckpt")
    dedup = run.output
    if not available_now:
        _wait_for_files(spark, run)
    elif with_open:
        write_open(spark, run, silver, f"{root}/dedup/state=open")
    # The downstream streams run side by side.
    same = {"available_now": available_now, "wait": False, "max_files_per_trigger": files_per_trigger}
    runs = [stream_gold_latest(spark, silver, out=f"{root}/gold", **same),
            stream_daily(spark, dedup, out=f"{root}/daily", watermark=watermark, **same),
            stream_price_drop(spark, dedup, hours=window_hours, pct_drop=pct_drop, out=f"{root}/drops", watermark=watermark,
                              slide_hours=slide_hours, **same)]
    if available_now:
        for r in runs:
            finish(r)
    return StreamChain(silver, dedup, *[r.output for r in runs], f"{root}/dedup/state=open" if available_now and with_open else None)


def _wait_for_files(spark: SparkSession, run: StreamRun) -> None:
    """Wait until a running stream has written its first files; a stream that
    ends without any raises its own failure."""
    import time

    from pyspark.errors import AnalysisException
    while True:
        try:
            spark.read.parquet(run.output).schema
            return
        except AnalysisException:
            if not run.query.isActive:
                finish(run)
                raise
            time.sleep(5)


def stream_into_layers(spark: SparkSession, raw_root: str, layers, checkpoint: str | None = None,
                       max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamRun:
    """Streaming ingestion into the stored layers: each micro-batch of new
    snapshot files is merged into silver / gold / daily base by
    ``plans.medallion.merge_new_rows`` inside ``foreachBatch``.

    Compared with the stateful chain it keeps the batch semantics exactly
    (a re-collected observation keeps its earliest collection; an
    observation arriving after any watermark still lands in its day), holds
    no unbounded state, and its dedup runs with a partial limit before the
    shuffle, so a hot observation key or station costs one row per task.
    Each epoch's raw lines go to the same bronze table as a batch run's (a
    repeated run replaces itself), and the merge itself is idempotent, so a
    retried epoch leaves the same tables.
    """
    from ..plans import medallion

    ckpt = checkpoint or scratch_path(spark, "stream-layers-ckpt")

    def merge(batch: DataFrame, epoch_id: int) -> None:
        medallion.merge_new_rows(spark, medallion.add_to_bronze(spark, batch, layers), layers)

    w = raw_stream(spark, raw_root, max_files_per_trigger).writeStream.foreachBatch(merge)
    return _run(w, layers.silver, ckpt, available_now)
