"""Raw snapshot rows -> typed, deduplicated silver observations, plus checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import haversine_km
from ..functions.timeconv import parse_utc_text
from ..schema import OBS_KEY, QUERY_HOURS, SILVER_COLUMNS

# Spellings of the unit field seen for litres and for cubic metres.
LITRE_SPELLINGS = ["L", "LT", "LTS", "LITRO", "LITROS"]
CUBIC_METRE_SPELLINGS = ["M3", "M³"]
GAS_FUELS = ["GNV"]


def silver_flatten(raw: DataFrame) -> DataFrame:
    """Flatten envelope + product + station structs to silver column names.

    Times stay text here; ``silver_typed`` parses them.
    """
    p, e, q = "raw.produto.", "raw.estabelecimento.", "query."
    return raw.select(
        F.coalesce(F.col(p + "anp"), F.col("anp")).alias("fuel_type"),
        F.col(p + "codProduto").alias("product_code"),
        F.col(p + "descricao").alias("product_desc"),
        F.col(p + "unidade").alias("unit"),
        F.col(e + "cnpj").alias("cnpj"),
        F.col(e + "nomeEstabelecimento").alias("station_name"),
        F.col(e + "municipio").alias("city"),
        F.col(e + "uf").alias("uf"),
        F.col(e + "bairro").alias("district"),
        F.col(e + "endLogradouro").alias("street"),
        F.col(e + "endNumero").alias("number"),
        F.col(e + "cep").alias("zip_code"),
        F.col(e + "latitude").alias("lat"),
        F.col(e + "longitude").alias("lng"),
        F.col(e + "distancia").alias("distance_km"),
        F.col(p + "data").alias("price_ts_text"),
        F.col(p + "precoUnitario").alias("price_unit"),
        F.col(p + "precoLiquido").alias("price_net"),
        F.col(p + "precoBruto").alias("price_gross"),
        F.col(p + "desconto").alias("discount"),
        F.col("run_id"),
        F.col("collected_at_utc").alias("collected_at_text"),
        F.col(q + "latitude").alias("query_lat"),
        F.col(q + "longitude").alias("query_lng"),
        F.col(q + "raio").alias("query_radius_km"),
        F.col(q + "horas").alias("query_hours"),
    )


def parse_utc(text: Column) -> Column:
    """Text with a UTC offset (``2026-01-16 14:51:57-00:00`` or ISO) -> UTC
    wall-clock timestamp_ntz; unparseable text -> null (any session zone)."""
    return parse_utc_text(text)


def silver_typed(flat: DataFrame, keep_query: bool = False) -> DataFrame:
    """Types the flattened rows: times parsed, numbers cast, unit canonical."""
    typed = flat.select(
        *[c for c in flat.columns if c not in ("price_ts_text", "collected_at_text")],
        parse_utc(F.col("price_ts_text")).alias("price_ts"),
        parse_utc(F.col("collected_at_text")).alias("collected_at"),
    )
    typed = unit_canonical(typed)
    cols = SILVER_COLUMNS + (["query_lat", "query_lng", "query_radius_km", "query_hours"] if keep_query else [])
    return typed.select(*cols)


def unit_canonical(df: DataFrame, unit_col: str = "unit") -> DataFrame:
    """L/LT/LTS/LITRO -> L and M3 -> M3; other spellings upper-cased as is.

    A fixed five-entry mapping, so a ``when`` chain inside the projection
    (no join, stays in whole-stage codegen).
    """
    u = F.upper(F.trim(F.col(unit_col)))
    canon = (F.when(u.isin(*LITRE_SPELLINGS), F.lit("L"))
              .when(u.isin(*CUBIC_METRE_SPELLINGS), F.lit("M3"))
              .otherwise(u))
    return df.withColumn(unit_col, canon)


def unit_flags(df: DataFrame) -> DataFrame:
    """Adds ``unit_suspect``: gas sold per litre or liquid fuel per cubic metre."""
    gas = F.col("fuel_type").isin(*GAS_FUELS)
    return df.withColumn(
        "unit_suspect",
        (gas & (F.col("unit") == "L")) | (~gas & (F.col("unit") == "M3")))


def silver_dedup(silver: DataFrame) -> DataFrame:
    """One row per observation (cnpj, product_code, price_ts), keeping the
    earliest collection of it.

    The window partitions on the whole observation key, so even a station
    with a third of all rows spreads over many tasks; the plan gets a partial
    ``WindowGroupLimit`` that drops repeats before the shuffle.  Rows without
    a complete key are not observations and are left out here (counted by
    ``silver_validate``).
    """
    w = Window.partitionBy(*OBS_KEY).orderBy(
        F.col("collected_at").asc_nulls_last(), F.col("run_id").asc_nulls_last())
    keyed = silver.filter(F.col("cnpj").isNotNull() & F.col("product_code").isNotNull()
                          & F.col("price_ts").isNotNull())
    return keyed.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


# Rules checked per fuel: name -> predicate that is TRUE when the row FAILS.
def _rules(min_price: float, max_price: float, max_lag_hours: int) -> dict[str, Column]:
    return {
        "key_missing": F.col("cnpj").isNull() | F.col("product_code").isNull() | F.col("price_ts").isNull(),
        "price_missing": F.col("price_unit").isNull(),
        "price_out_of_range": (F.col("price_unit") < min_price) | (F.col("price_unit") > max_price),
        "net_above_unit": F.col("price_net") > F.col("price_unit"),
        "net_ne_gross": F.col("price_net") != F.col("price_gross"),
        "discount_mismatch": F.abs(F.col("discount") - (F.col("price_unit") - F.col("price_net"))) > 1e-6,
        "lat_out_of_range": (F.col("lat") < -90) | (F.col("lat") > 90),
        "lng_out_of_range": (F.col("lng") < -180) | (F.col("lng") > 180),
        "coords_missing": F.col("lat").isNull() | F.col("lng").isNull(),
        "ts_after_collection": F.col("price_ts") > F.col("collected_at"),
        "lag_over_window": F.col("collected_at") > F.col("price_ts") + F.make_dt_interval(F.lit(0), F.lit(max_lag_hours)),
    }


VALIDATION_RULES = ["key_missing", "price_missing", "price_out_of_range", "net_above_unit", "net_ne_gross",
                    "discount_mismatch", "lat_out_of_range", "lng_out_of_range", "coords_missing",
                    "ts_after_collection", "lag_over_window"]


def silver_validate(silver: DataFrame, min_price: float = 0.01, max_price: float = 1000.0,
                    max_lag_hours: int = QUERY_HOURS) -> DataFrame:
    """Rule table: one row per (fuel_type, rule) with rows, failed, passed and
    the fuel's min/max price.  A single aggregation pass (partial counts per
    task, one small shuffle on fuel) then an unpivot of the rule counters."""
    rules = _rules(min_price, max_price, max_lag_hours)
    agg = silver.groupBy("fuel_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("price_unit").alias("min_price_unit"),
        F.max("price_unit").alias("max_price_unit"),
        *[F.count_if(pred).alias(name) for name, pred in rules.items()],
    )
    long = agg.unpivot(["fuel_type", "rows", "min_price_unit", "max_price_unit"],
                       list(rules.keys()), "rule", "failed")
    return long.withColumn("passed", F.col("failed") == 0)


def distance_check(silver_with_query: DataFrame, tolerance_km: float = 0.01) -> DataFrame:
    """Recompute the source's distance from its query point; flag rows whose
    stored distance disagrees by more than ``tolerance_km``."""
    d = haversine_km(F.col("query_lat"), F.col("query_lng"), F.col("lat"), F.col("lng"))
    return (silver_with_query
            .withColumn("computed_distance_km", d)
            .withColumn("distance_diff_km", F.abs(F.col("computed_distance_km") - F.col("distance_km")))
            .withColumn("distance_ok", F.col("distance_diff_km") <= tolerance_km))
