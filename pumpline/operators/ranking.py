"""Cheapest current prices for one fuel and scope."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.params import apply_filters, check_int, check_required, check_uf, eq

BEST_COLUMNS = ["fuel_type", "uf", "city", "station_name", "cnpj", "price_ts", "price_unit", "price_net",
                "price_gross", "discount", "lat", "lng"]


def best_prices(gold: DataFrame, fuel_type: str, uf: str | None = None, city: str | None = None,
                limit: int = 20) -> DataFrame:
    """Cheapest first, newest first among equal prices, then the row key.

    ORDER BY + LIMIT plans as TakeOrderedAndProject: each task keeps its own
    top ``limit`` rows and only those reach the final merge.
    """
    check_required("fuel_type", fuel_type)
    uf = check_uf(uf)
    check_int("limit", limit, 1, 200)
    f = apply_filters(gold, eq("fuel_type", fuel_type), eq("uf", uf), eq("city", city))
    return (f.orderBy(F.col("price_unit").asc_nulls_last(), F.col("price_ts").desc_nulls_last(),
                      F.col("cnpj").asc_nulls_last(), F.col("product_code").asc_nulls_last())
            .limit(limit).select(*BEST_COLUMNS))
