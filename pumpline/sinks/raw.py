"""Writers: partitioned JSONL snapshots, manifests, logs and the table layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import versions

from ..schema import RAW_PARTITIONS
from ..session import with_settings

SLUG_PATTERN = r"[^a-zA-Z0-9_\-=\.]"


def clustered(df: DataFrame, cols) -> DataFrame:
    """Cluster rows by the output partition columns before a partitioned
    write, with the ``rebalance`` hint: AQE sizes the shuffle partitions to
    the advisory size, splits a partition folder holding a third of all rows
    over many tasks and merges tiny ones, so files are neither huge nor
    thousands of slivers."""
    return df.hint("rebalance", *cols)


def partition_slug(col: Column | str) -> Column:
    """Path-safe partition value: any character outside [a-zA-Z0-9_-=.] -> _."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c.cast("string"), SLUG_PATTERN, "_")


# Run folders that a task writes at a time; it sorts its rows only if they are of more.
OPEN_FOLDERS = 64


def write_raw_jsonl(raw: DataFrame, root: str, overwrite_runs: bool = True, by_run: bool = False) -> None:
    """Write snapshot records as JSON lines under source=/anp=/dt=/run_id=.

    Spark moves the partition columns into the path; ``source``, ``anp`` and
    ``run_id`` read back from the path with the same values.  With
    ``overwrite_runs`` (dynamic partition overwrite) re-writing a run replaces
    exactly that run's folder, so a retried or re-run collection never
    duplicates rows.  Rows are clustered by partition first so each task
    writes few files, unless they already lie ``by_run``.  The lines, mostly
    repeated names, are compressed, and a task does not sort them by run.
    """
    out = raw.withColumn("anp", partition_slug("anp")).withColumn("run_id", partition_slug("run_id"))
    with with_settings(raw.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FOLDERS)}):
        ((out if by_run else clustered(out, RAW_PARTITIONS))
            .write.partitionBy(*RAW_PARTITIONS)
            .mode("overwrite" if overwrite_runs else "append")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
            .json(root))


def write_manifests(manifests: DataFrame, root: str) -> None:
    """Run manifests as JSON lines (one row per run, run_id kept in the
    body).  Manifests are one small row per run, a handful of files."""
    manifests.write.mode("overwrite").json(root)


def write_text_lines(lines: DataFrame, root: str, partition_col: str | None = None) -> None:
    """Write a one-string-column frame (``value``) as text files."""
    w = lines.repartition(partition_col) if partition_col else lines
    w = w.write.mode("overwrite")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.text(root)


def write_layer(df: DataFrame, path: str, partition_by=(), mode: str = "overwrite") -> None:
    """Persist bronze / silver / gold as Parquet.  With partition columns and
    dynamic overwrite, only the partitions present in ``df`` are replaced."""
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


BRONZE_PARTITIONS = [c for c in RAW_PARTITIONS if c != "run_id"]


def write_bronze(raw: DataFrame, path: str) -> None:
    """Bronze keeps every raw line as read (the audit copy), a folder per
    source, product and day; the run is a column.  Whole days must be given:
    dynamic overwrite replaces the days present in ``raw``."""
    write_layer(clustered(raw, BRONZE_PARTITIONS).sortWithinPartitions("run_id"), path, BRONZE_PARTITIONS)


def write_silver(silver: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Silver partitioned by fuel and observation day: queries filtering on
    fuel or a date range prune folders.  Inside each file rows are sorted by
    station, product and time, so a station's rows sit in few row groups and
    a lookup by cnpj skips the rest by their min/max statistics."""
    s = silver.withColumn("obs_date", F.to_date("price_ts"))
    s = clustered(s, ["fuel_type", "obs_date"]).sortWithinPartitions("cnpj", "product_code", "price_ts")
    write_layer(s, path, ("fuel_type", "obs_date"), mode=mode)


def save_table(df: DataFrame, name: str, path: str, partition_by=()) -> None:
    """Store ``df`` as the catalog table ``name`` with its data at ``path``:
    the catalog keeps the columns' types, partition columns included.  The
    table is made on the first call; later calls replace the partitions that
    ``df`` holds (a table without partitions as a whole)."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        w = df.write.format("parquet").option("path", path)
        (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(name)
    else:
        columns = spark.table(name).columns
        df.select(*columns).write.option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True)


def write_gold(gold: DataFrame, path: str) -> None:
    """Gold in buckets of stations, sorted by fuel and latitude inside: each
    row group covers a narrow latitude band, so the radius search's bounding
    box skips most of them."""
    versions.write_version(gold, path, "cnpj", ("fuel_type", "lat"))


def write_labels(labels: DataFrame, path: str) -> None:
    versions.write_version(labels, path, "cnpj", ("cnpj",))
