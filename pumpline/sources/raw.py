"""Readers for the raw snapshot tree, manifests, run logs and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks import versions
from pyspark.sql import types as T

from ..schema import ITEM_STRUCT, MANIFEST_SCHEMA, OVERALL_MANIFEST_SCHEMA, PAGE_SCHEMA, RAW_SCHEMA

# Snapshot files as the collector names them (data.jsonl) or as Spark's JSON
# writer does (part-*.json); manifest.json in the same folders is excluded.
DATA_GLOB = "{data.jsonl,part-*.json,part-*.json.*}"


CORRUPT_COLUMN = "_corrupt_record"


def scan_raw(spark: SparkSession, root: str, glob: str = DATA_GLOB, keep_corrupt: bool = False) -> DataFrame:
    """All snapshot lines under ``root`` with partition columns source, anp,
    dt, run_id taken from the directory names.

    The schema is explicit (no inference pass over the files; mostly-null
    fields keep their types) and filters on anp/dt prune directories.  With
    ``keep_corrupt`` a line that is not valid JSON for the schema keeps its
    text in ``_corrupt_record`` (its other fields null) so it can be counted
    or quarantined instead of passing as an empty row.
    """
    schema = RAW_SCHEMA
    reader = spark.read.option("pathGlobFilter", glob).option("mode", "PERMISSIVE")
    if keep_corrupt:
        schema = T.StructType(RAW_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return reader.schema(schema).json(root)


def scan_pages(spark: SparkSession, root: str, strict: bool = False) -> DataFrame:
    """Saved response pages, one JSON document a line, as ``response_check``
    and ``snapshot_envelope`` take them.

    Totals are read as text, whatever their JSON type.  ``resultado`` is a
    list of items, or null where it is missing or no list; with ``strict`` a
    page whose ``resultado`` is there but no list fails the job.  A line
    that is not valid JSON keeps its text in ``_corrupt_record``, its other
    columns are null.
    """
    schema = T.StructType(PAGE_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    lines = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN).json(root)
    valid = F.col(CORRUPT_COLUMN).isNull()
    text = F.col("response.resultado")
    is_list = F.ltrim(text).startswith("[")
    items = F.when(is_list, F.from_json(text, T.ArrayType(ITEM_STRUCT)))
    if strict:
        items = F.when(text.isNull() | is_list, items).otherwise(
            F.raise_error(F.concat(F.lit("response page without a list in resultado, run "), F.coalesce("run_id", F.lit("?")))))
    response = F.col("response").withField("resultado", items)
    return lines.select(*[F.when(valid, F.col(f.name)).alias(f.name) for f in PAGE_SCHEMA.fields if f.name != "response"],
                        F.when(valid & F.col("response").isNotNull(), response).alias("response"), CORRUPT_COLUMN)


def scan_manifest(spark: SparkSession, root: str, glob: str = "manifest.json", multiline: bool = True) -> DataFrame:
    """Per-run manifests: one row per manifest file (collector layout: pretty
    printed manifest.json beside data.jsonl) or per line (Spark-written)."""
    return (spark.read.schema(MANIFEST_SCHEMA)
            .option("multiLine", multiline)
            .option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true")
            .json(root))


def scan_overall_manifest(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Roll-up manifest(s): one row per run listed in ``runs``."""
    doc = spark.read.schema(OVERALL_MANIFEST_SCHEMA).option("multiLine", multiline).json(path)
    return (doc.select("finished_at_utc", "out_dir", F.explode("runs").alias("r"))
            .select("finished_at_utc", "out_dir", "r.*"))


LOG_LINE = r"^\[([0-9-]+ [0-9:]+,[0-9]+)\] \[([A-Z]+)\] (.*)$"
LOG_TS_FORMAT = "yyyy-MM-dd HH:mm:ss,SSS"


def scan_run_log(spark: SparkSession, root: str, glob: str = "*.log") -> DataFrame:
    """Collector log lines as typed rows.

    ts is the logger's local wall clock (as written), level and message split
    out; ``fuel``, ``rows`` and ``run_id`` are filled on lines that carry
    them ("<FUEL>: fetching page", "<FUEL>: wrote N rows ... run_id=<id>").
    Lines that do not match the format keep ts/level null.
    """
    lines = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
             .text(root).withColumn("file", F.col("_metadata.file_path")))
    ts_text = F.regexp_extract("value", LOG_LINE, 1)
    msg = F.regexp_extract("value", LOG_LINE, 3)
    fuel = F.regexp_extract(msg, r"^([A-Za-z0-9_]+): (fetching|wrote)", 1)
    rows = F.regexp_extract(msg, r"wrote (\d+) rows", 1)
    run = F.regexp_extract(msg, r"run_id=([0-9A-Za-z_.=-]+)", 1)
    return lines.select(
        F.element_at(F.split("file", "/"), -1).alias("log_file"),
        F.to_timestamp_ntz(F.nullif(ts_text, F.lit("")), F.lit(LOG_TS_FORMAT)).alias("ts"),
        F.nullif(F.regexp_extract("value", LOG_LINE, 2), F.lit("")).alias("level"),
        F.when(ts_text != "", msg).otherwise(F.col("value")).alias("message"),
        F.nullif(fuel, F.lit("")).alias("fuel"),
        F.nullif(rows, F.lit("")).cast("bigint").alias("rows"),
        F.nullif(run, F.lit("")).alias("run_id"),
    )


def scan_table(spark: SparkSession, name_or_path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored layer by catalog name (``catalog.table``) or by path.  By
    path, ``schema`` fixes the types that folder names would otherwise be
    read as (all-numeric fuel codes stay text); a catalog table has its own."""
    if "/" in name_or_path or name_or_path.startswith("file:"):
        if versions.current_paths(spark, name_or_path):
            return versions.read_current(spark, name_or_path)
        return (spark.read.schema(schema) if schema else spark.read).parquet(name_or_path)
    return spark.read.table(name_or_path)
