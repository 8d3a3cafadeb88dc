"""Lookups over the gold table: fuels, cities, station search and detail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.params import apply_filters, check_int, check_uf, eq

DETAIL_ITEM_FIELDS = ["price_ts", "product_code", "fuel_type", "product_desc", "unit",
                      "price_unit", "price_net", "price_gross", "discount"]
STATION_ATTRS = ["station_name", "city", "uf", "district", "street", "number", "zip_code", "lat", "lng"]


def fuel_types(gold: DataFrame) -> DataFrame:
    return (gold.select("fuel_type").filter(F.col("fuel_type").isNotNull())
            .distinct().orderBy("fuel_type"))


def cities(gold: DataFrame, uf: str | None = None, limit: int = 500) -> DataFrame:
    """Distinct (uf, city) with a city, optionally for one uf; the intended
    query (the shipped text had AND without WHERE)."""
    uf = check_uf(uf)
    check_int("limit", limit, 1, 5000)
    return (apply_filters(gold, F.col("city").isNotNull(), eq("uf", uf))
            .select("uf", "city").distinct()
            .orderBy(F.col("uf").asc_nulls_last(), F.col("city").asc_nulls_last())
            .limit(limit))


def station_search(gold: DataFrame, q: str | None = None, uf: str | None = None,
                   city: str | None = None, limit: int = 50) -> DataFrame:
    """Distinct station identities whose name contains ``q`` (case-insensitive,
    literal match: ``%`` and ``_`` are not wildcards)."""
    uf = check_uf(uf)
    check_int("limit", limit, 1, 500)
    name_pred = F.lower(F.col("station_name")).contains(q.lower()) if q else None
    cols = ["cnpj", "station_name", "city", "uf", "district", "street", "number", "zip_code", "lat", "lng"]
    return (apply_filters(gold, name_pred, eq("uf", uf), eq("city", city))
            .select(*cols).distinct()
            .orderBy(*[F.col(c).asc_nulls_last() for c in ("uf", "city", "station_name", "cnpj", "lat", "lng")])
            .limit(limit))


def station_detail(gold: DataFrame, cnpj: int | None = None) -> DataFrame:
    """One row per station: attributes of its newest gold row and its current
    products, newest first.  Without ``cnpj`` it answers every station in one
    aggregation (a station has a handful of gold rows, so the per-station list
    is bounded by its product count).  An unknown cnpj gives no row."""
    if cnpj is not None:
        check_int("cnpj", cnpj, 0)
        gold = gold.filter(F.col("cnpj") == F.lit(cnpj))
    else:
        gold = gold.filter(F.col("cnpj").isNotNull())
    order_key = F.struct(F.col("price_ts"), F.col("product_code"))
    agg = gold.groupBy("cnpj").agg(
        F.max_by(F.struct(*STATION_ATTRS), order_key).alias("_base"),
        F.sort_array(F.collect_list(F.struct(*DETAIL_ITEM_FIELDS)), asc=False).alias("fuels"),
    )
    return agg.select("cnpj", *[F.col("_base." + c).alias(c) for c in STATION_ATTRS], "fuels")


def station_detail_flat(gold: DataFrame, cnpj: int | None = None) -> DataFrame:
    """``station_detail`` with the product list exploded (position 0 = newest)."""
    d = station_detail(gold, cnpj)
    return (d.select("cnpj", *STATION_ATTRS, F.posexplode("fuels").alias("pos", "item"))
            .select("cnpj", *STATION_ATTRS, "pos", *[F.col("item." + c).alias(c) for c in DETAIL_ITEM_FIELDS]))
