"""Tables replaced bucket by bucket, never in place.

A write puts the buckets it touches into a new ``version=<n>/bucket=<b>``
folder; Spark's commit marks the version as complete (``_SUCCESS``).  The
current table is, for every bucket, its newest complete version.  A job
killed while it writes leaves an incomplete version that no reader sees, and
an update rewrites only the buckets of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 16
KEEP = 2  # newest complete versions that are never deleted: readers may hold them


def _listed(spark: SparkSession, path: str) -> list[str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything was ever written at ``path``."""
    return bool(_listed(spark, path))


def _versions(spark: SparkSession, path: str, complete: bool = True) -> list[str]:
    found = [v for v in _listed(spark, path) if v.startswith("version=")]
    return [v for v in found if not complete or "_SUCCESS" in _listed(spark, f"{path}/{v}")]


def current_paths(spark: SparkSession, path: str) -> list[str]:
    """The newest complete folder of every bucket; empty for other layouts."""
    newest: dict[str, str] = {}
    for v in _versions(spark, path):
        newest.update({b: v for b in _listed(spark, f"{path}/{v}") if b.startswith("bucket=")})
    return [f"{path}/{v}/{b}" for b, v in sorted(newest.items())]


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def read_current(spark: SparkSession, path: str, keep_bucket: bool = False) -> DataFrame:
    paths = current_paths(spark, path)
    if not paths:
        raise FileNotFoundError(f"no complete version under {path}")
    rows = spark.read.option("basePath", path).parquet(*paths)
    return rows.drop("version") if keep_bucket else rows.drop("version", "bucket")


def write_version(df: DataFrame, path: str, key: str, sort: tuple[str, ...]) -> None:
    """Write ``df``, which must hold all rows of every bucket it touches, as a
    new version, then delete versions that nothing refers to any more."""
    spark = df.sparkSession
    n = max([int(v.split("=")[1]) for v in _versions(spark, path, complete=False)], default=0) + 1
    (df.withColumn("bucket", bucket_of(key)).repartition(BUCKETS, "bucket").sortWithinPartitions("bucket", *sort)
     .write.partitionBy("bucket").parquet(f"{path}/version={n:010d}"))
    used = {p.split("/")[-2] for p in current_paths(spark, path)}
    for old in _versions(spark, path)[:-KEEP]:
        if old not in used:
            where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{old}")
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
