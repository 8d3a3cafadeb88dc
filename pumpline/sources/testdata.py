"""Adapter from the driver's star-schema tables to silver price observations.

``events`` rows become price observations; ``customer -> nation -> region``
give each observing key (the station) a name, city and state.  The mapping is
fixed (see FIXTURES.md §5) and has an exact SQL twin, ``SILVER_SQL``, used by
the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import haversine_km
from ..schema import QUERY_LAT, QUERY_LNG, SILVER_COLUMNS


# The source publishes its distance (km from the query point) with 4 decimals.
SOURCE_DISTANCE_DECIMALS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lat(uid: Column) -> Column:
    return F.when(uid % 17 == 0, F.lit(None).cast("double")).otherwise(
        F.lit(-13.54) + ((uid * 37) % 140) / F.lit(100))


def _lng(uid: Column) -> Column:
    return F.lit(-39.28) + ((uid * 53) % 116) / F.lit(100)


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station attributes: one row per customer key.

    nation and region are the fixed 25 / 5 row dimensions; the planner
    broadcasts them from their file-size statistics.
    """
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reg = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (cust.join(nat, cust.c_nationkey == nat.n_nationkey)
                .join(reg, nat.n_regionkey == reg.r_regionkey)
                .select(F.col("c_custkey").alias("cnpj"),
                        F.col("c_name").alias("station_name"),
                        F.col("n_name").alias("city"),
                        F.substring("r_name", 1, 2).alias("uf"),
                        F.col("c_mktsegment").alias("district")))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events projected to observation columns (no station attributes yet).

    Lineage columns of the adapter: an event is "collected" when it happens
    (collected_at = price_ts) by no run (run_id null).
    """
    ev = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", r"(\d+)", 1).cast("bigint")
    return ev.select(
        F.col("event_id").alias("obs_id"),
        F.col("user_id").alias("cnpj"),
        F.col("event_type").alias("fuel_type"),
        F.concat(F.col("event_type"), F.lit("-"), (k % 2).cast("string")).alias("product_code"),
        F.col("ts").alias("price_ts"),
        F.col("value").alias("price_unit"),
        F.lit(None).cast("string").alias("run_id"),
        F.col("ts").alias("collected_at"),
    )


def attach_stations(spark: SparkSession, sf_dir: str, obs: DataFrame, with_obs_id: bool = False) -> DataFrame:
    """Observation rows + station attributes and derived columns -> silver
    columns.  An equi-join on the station key: the planner broadcasts the
    station side when its size statistics are under the threshold and
    otherwise shuffles both sides, AQE splitting a hot station's partition."""
    st = stations(spark, sf_dir)
    j = obs.join(st, "cnpj")
    lat, lng = _lat(F.col("cnpj")), _lng(F.col("cnpj"))
    out = j.select(
        "fuel_type", "product_code",
        F.upper(F.concat(F.col("fuel_type"), F.lit(" "), F.col("product_code"))).alias("product_desc"),
        F.lit("L").alias("unit"),
        "cnpj", "station_name", "city", "uf", "district",
        F.lit(None).cast("string").alias("street"),
        F.lit(None).cast("string").alias("number"),
        F.lit(None).cast("string").alias("zip_code"),
        lat.alias("lat"), lng.alias("lng"),
        F.round(haversine_km(QUERY_LAT, QUERY_LNG, lat, lng), SOURCE_DISTANCE_DECIMALS).alias("distance_km"),
        "price_ts", "price_unit",
        F.col("price_unit").alias("price_net"),
        F.col("price_unit").alias("price_gross"),
        F.lit(None).cast("double").alias("discount"),
        "run_id", "collected_at", "obs_id",
    )
    return out if with_obs_id else out.select(*SILVER_COLUMNS)


def silver(spark: SparkSession, sf_dir: str, with_obs_id: bool = False) -> DataFrame:
    """Silver observations built from the driver's tables."""
    return attach_stations(spark, sf_dir, observations(spark, sf_dir), with_obs_id)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gold_latest of ``silver``, computed on the narrow observation rows
    first (the latest-row window ships one partial row per key and map task)
    and only then joined to station attributes, which depend on the station
    key alone.  Same rows as ``gold_latest(silver(...))`` since the station
    join is an inner equi-join on part of the gold key."""
    from ..operators.gold import gold_latest
    return attach_stations(spark, sf_dir, gold_latest(observations(spark, sf_dir)))


# ---------------------------------------------------------------------------
# SQL twin (DuckDB dialect) for the oracle queries.
# ---------------------------------------------------------------------------

HAVERSINE_SQL = (
    "(6371.0 * 2 * asin(sqrt(pow(sin(radians(({lat2}) - ({lat1})) / 2), 2) + "
    "cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians(({lng2}) - ({lng1})) / 2), 2))))"
)


def haversine_sql(lat1, lng1, lat2, lng2) -> str:
    return HAVERSINE_SQL.format(lat1=lat1, lng1=lng1, lat2=lat2, lng2=lng2)


_LAT_SQL = "CASE WHEN e.user_id % 17 = 0 THEN NULL ELSE -13.54 + ((e.user_id * 37) % 140) / 100 END"
_LNG_SQL = "(-39.28 + ((e.user_id * 53) % 116) / 100)"

SILVER_SQL = f"""
SELECT
  e.event_type AS fuel_type,
  concat(e.event_type, '-', CAST(CAST(regexp_extract(e.props, '(\\d+)', 1) AS BIGINT) % 2 AS VARCHAR)) AS product_code,
  upper(concat(e.event_type, ' ', e.event_type, '-', CAST(CAST(regexp_extract(e.props, '(\\d+)', 1) AS BIGINT) % 2 AS VARCHAR))) AS product_desc,
  'L' AS unit,
  e.user_id AS cnpj, c.c_name AS station_name, n.n_name AS city, substr(r.r_name, 1, 2) AS uf, c.c_mktsegment AS district,
  CAST(NULL AS VARCHAR) AS street, CAST(NULL AS VARCHAR) AS number, CAST(NULL AS VARCHAR) AS zip_code,
  CAST({_LAT_SQL} AS DOUBLE) AS lat, CAST({_LNG_SQL} AS DOUBLE) AS lng,
  round({haversine_sql(QUERY_LAT, QUERY_LNG, _LAT_SQL, _LNG_SQL)}, {SOURCE_DISTANCE_DECIMALS}) AS distance_km,
  e.ts AS price_ts, e.value AS price_unit, e.value AS price_net, e.value AS price_gross,
  CAST(NULL AS DOUBLE) AS discount, CAST(NULL AS VARCHAR) AS run_id, e.ts AS collected_at,
  e.event_id AS obs_id
FROM events e
JOIN customer c ON e.user_id = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""

GOLD_SQL = """
SELECT * EXCLUDE (rn) FROM (
  SELECT s.*, row_number() OVER (PARTITION BY cnpj, product_code
                                 ORDER BY price_ts DESC, collected_at DESC, run_id DESC NULLS LAST) AS rn
  FROM silver s
) WHERE rn = 1
"""


def with_ctes(body: str, gold: bool = False) -> str:
    """Wrap an oracle query body with the silver (and gold) CTEs."""
    ctes = [f"silver AS ({SILVER_SQL})"]
    if gold:
        ctes.append(f"gold AS ({GOLD_SQL})")
    return "WITH " + ",\n".join(ctes) + "\n" + body
