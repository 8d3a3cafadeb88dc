"""The batch job: raw snapshot files -> bronze -> silver -> gold + daily base.

Each layer is written as a table and the next layer reads the written table,
so lineage is cut at every layer (a lost executor re-runs one layer, not the
whole chain) and every layer can be re-run on its own.  Silver is
partitioned by fuel and observation day, so the query layer prunes folders
on its most common filters; gold and the daily base are small (one row per
station product / per station day).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold as goldops, silver as silverops
from ..schema import OBS_KEY, SILVER_COLUMNS, STORED_SILVER_SCHEMA
from ..sinks import raw as sinks, versions
from ..sources import raw as rawsrc


@dataclass
class Layers:
    bronze: str
    silver: str
    gold: str
    daily_base: str
    staging: str = ""
    labels: str = ""

    def stage(self, name: str) -> str:
        """Fixed staging location of one merge step: each merge overwrites
        it, so staged copies do not pile up across runs or epochs."""
        return f"{self.staging or self.silver + '_staging'}/{name}"


def layer_paths(root: str) -> Layers:
    root = root.rstrip("/")
    return Layers(f"{root}/bronze", f"{root}/silver", f"{root}/gold", f"{root}/timeseries_base",
                  f"{root}/_staging", f"{root}/station_labels")


def build_bronze(spark: SparkSession, raw_root: str, layers: Layers) -> None:
    sinks.write_bronze(rawsrc.scan_raw(spark, raw_root), layers.bronze)


def build_silver(spark: SparkSession, layers: Layers) -> None:
    bronze = rawsrc.scan_table(spark, layers.bronze)
    typed = silverops.silver_typed(silverops.silver_flatten(bronze))
    sinks.write_silver(silverops.silver_dedup(typed), layers.silver)


def read_silver(spark: SparkSession, layers: Layers) -> DataFrame:
    """Stored silver with its day partition column ``obs_date`` (operators
    add day predicates on it so time filters prune folders)."""
    return rawsrc.scan_table(spark, layers.silver, STORED_SILVER_SCHEMA).select(*SILVER_COLUMNS, "obs_date")


def build_gold(spark: SparkSession, layers: Layers) -> None:
    silver = read_silver(spark, layers)
    sinks.write_gold(goldops.gold_latest(silver).select(*SILVER_COLUMNS), layers.gold)
    if layers.labels:
        sinks.write_labels(goldops.station_labels(silver), layers.labels)
    b = goldops.timeseries_base(silver).withColumn("obs_date", F.to_date("day"))
    sinks.write_layer(b, layers.daily_base, ("obs_date",))


def run(spark: SparkSession, raw_root: str, out_root: str) -> Layers:
    layers = layer_paths(out_root)
    build_bronze(spark, raw_root, layers)
    build_silver(spark, layers)
    build_gold(spark, layers)
    return layers


def ingest_runs(spark: SparkSession, raw_root: str, layers: Layers, run_filter) -> None:
    """Incremental step for new runs (``run_filter``: a Column predicate on
    the raw tree, e.g. on run_id or dt, pruning folders): the new runs go to
    bronze and their rows are merged into silver, gold and the daily base by
    ``merge_new_rows``."""
    merge_new_rows(spark, add_to_bronze(spark, rawsrc.scan_raw(spark, raw_root).filter(run_filter), layers), layers)


def add_to_bronze(spark: SparkSession, new_raw: DataFrame, layers: Layers) -> DataFrame:
    """Put the lines of new or repeated runs into bronze and return them as
    stored.  The days they touch are rewritten: their lines of other runs and
    the new ones, staged first."""
    stage = layers.stage("raw")
    new_raw.write.mode("overwrite").parquet(stage)
    new = spark.read.schema(new_raw.schema).parquet(stage)
    if versions.exists(spark, layers.bronze):
        runs = new.select(*sinks.BRONZE_PARTITIONS, "run_id").distinct()
        days = new.select(*sinks.BRONZE_PARTITIONS).distinct()
        others = rawsrc.scan_table(spark, layers.bronze).select(*new.columns) \
            .join(days, sinks.BRONZE_PARTITIONS, "left_semi").join(runs, [*sinks.BRONZE_PARTITIONS, "run_id"], "left_anti")
        days_stage = layers.stage("raw_days")
        others.unionByName(new).write.mode("overwrite").parquet(days_stage)
        sinks.write_bronze(spark.read.schema(new.schema).parquet(days_stage), layers.bronze)
    else:
        sinks.write_bronze(new, layers.bronze)
    return new


def _in_touched_buckets(spark: SparkSession, path: str, new: DataFrame) -> DataFrame:
    """The stored rows of the buckets that ``new`` (with cnpj) touches."""
    touched = new.select(versions.bucket_of("cnpj").alias("bucket")).distinct()
    return versions.read_current(spark, path, keep_bucket=True).join(touched, "bucket", "left_semi").drop("bucket")


def touched_days(days: list) -> Column:
    """Partition filter for exactly these days (null: the folder without one)."""
    known = F.col("obs_date").isin([d for d in days if d is not None])
    return known | F.col("obs_date").isNull() if None in days else known


def merge_new_rows(spark: SparkSession, new_raw: DataFrame, layers: Layers) -> None:
    """Merge newly collected raw lines into the stored layers, rewriting only
    what they touch:

    * silver: the batch's observations (earliest copy each) are anti-joined
      with the stored observation keys of the touched days (key columns
      only) and the new ones appended; only when the batch holds an earlier
      collection of an already stored observation (runs out of order) are
      the touched (fuel, day) partitions rewritten — stored rows plus new,
      deduplicated, staged to a written table (a path is never overwritten
      while it is read) and written back with dynamic partition overwrite;
    * gold: in the buckets of the new rows' stations, latest of (current
      gold, new rows) after the same dedup rule
      (a re-collected observation keeps its first collection), which equals
      the latest over the whole history because gold already holds each
      key's latest row;
    * daily base: the touched days, recomputed from silver;
    * station labels: in the same buckets, max of (stored labels, new rows'
      labels) per key.

    Re-running the same input gives the same tables (idempotent), and gold
    and labels are never overwritten in place, so a job killed anywhere can
    be run again.  Where silver is stored but gold or labels are missing,
    they are rebuilt from silver; missing silver beside stored gold is an
    error.
    """
    first = not versions.exists(spark, layers.silver)
    if first and versions.exists(spark, layers.gold):
        raise FileNotFoundError(f"{layers.gold} is stored, but {layers.silver} is missing")
    whole = [p for p in (layers.gold, layers.labels) if p]
    rebuild = not first and not all(versions.current_paths(spark, p) for p in whole)
    new = (silverops.silver_typed(silverops.silver_flatten(new_raw))
           .withColumn("obs_date", F.to_date("price_ts")))
    stage_new = layers.stage("new")
    new.write.mode("overwrite").parquet(stage_new)
    new = spark.read.parquet(stage_new)
    new_rows = new.select(*SILVER_COLUMNS, "obs_date")
    touched = new.select("fuel_type", "obs_date").distinct()
    # The touched days themselves as a partition filter of the stored tables
    # (a few days of a collector's window, however long the history): one old
    # row adds its own day's folders and none between.
    days = [r.obs_date for r in new.select("obs_date").distinct().collect()]
    in_days = touched_days(days)
    stored = (spark.createDataFrame([], new_rows.schema) if first
              else read_silver(spark, layers).select(*new_rows.columns)).filter(in_days)

    # One row per observation of the batch (its earliest copy), compared with
    # the stored observation keys of the touched days (key columns only).
    batch = silverops.silver_dedup(new_rows)
    stored_keys = stored.select(*OBS_KEY, F.col("collected_at").alias("_s_col"), F.col("run_id").alias("_s_run"))
    earlier = batch.join(stored_keys, OBS_KEY).filter(
        F.struct(F.col("collected_at"), F.col("run_id")) < F.struct(F.col("_s_col"), F.col("_s_run")))
    if earlier.isEmpty():
        # Common case: append the genuinely new observations only.  A retried
        # batch finds them stored already and appends nothing.  Appending leaves
        # the files that are read here as they are, so nothing is staged.
        fresh = batch.join(stored.select(*OBS_KEY), OBS_KEY, "left_anti")
        sinks.write_silver(fresh.drop("obs_date"), layers.silver, mode="append")
    else:
        # A run arrived out of order with an earlier collection of stored
        # observations: rewrite the touched partitions so the earliest copy wins.
        current = stored.join(touched, ["fuel_type", "obs_date"], "left_semi")
        merged = silverops.silver_dedup(current.unionByName(new_rows))
        stage = layers.stage("silver")
        merged.write.mode("overwrite").parquet(stage)
        sinks.write_silver(spark.read.parquet(stage).drop("obs_date"), layers.silver)

    if rebuild:
        build_gold(spark, layers)
        return

    candidates = new.select(*SILVER_COLUMNS)
    if not first:
        candidates = candidates.unionByName(_in_touched_buckets(spark, layers.gold, new).select(*SILVER_COLUMNS))
    sinks.write_gold(goldops.gold_latest_of_copies(candidates), layers.gold)

    if layers.labels:
        names = goldops.station_labels(new)
        if not first:
            names = names.unionByName(_in_touched_buckets(spark, layers.labels, new).select(*names.columns))
        sinks.write_labels(names.groupBy(*goldops.LABEL_KEYS).agg(F.max("station_name").alias("station_name")), layers.labels)

    day_rows = read_silver(spark, layers).filter(in_days)
    b = goldops.timeseries_base(day_rows.drop("obs_date")).withColumn("obs_date", F.to_date("day"))
    sinks.write_layer(b, layers.daily_base, ("obs_date",))
