"""Paged listings: latest prices, a station's history, keyset pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.params import (LATEST_ORDER_COLUMNS, ORDER_DIRECTIONS, apply_filters,
                                check_choice, check_int, eq, parse_ts, sort_col, tie_break, time_range,
                                time_range_pred, ts_lit)

LATEST_COLUMNS = ["fuel_type", "uf", "city", "station_name", "cnpj", "product_desc", "unit",
                  "price_ts", "price_unit", "price_net", "price_gross", "discount", "lat", "lng", "distance_km"]
STATION_SERIES_COLUMNS = ["price_ts", "fuel_type", "price_unit", "price_net", "price_gross", "discount",
                          "station_name", "city", "uf", "lat", "lng"]


@dataclass
class Page:
    """A page of ``items`` plus the filtered population it was cut from.

    Both are lazy; ``total`` runs a count only when asked.  items and total
    come from one DataFrame lineage, so they agree for one table version.
    """
    page: int
    page_size: int
    items: DataFrame
    population: DataFrame

    def total(self) -> int:
        return self.population.count()

    def total_df(self) -> DataFrame:
        return self.population.agg(F.count(F.lit(1)).alias("total"))

    def as_dict(self) -> dict:
        """The service response: one page (at most ``page_size`` rows, capped
        by the caller's bounds) and the total."""
        return {"page": self.page, "page_size": self.page_size, "total": self.total(),
                "items": [r.asDict() for r in self.items.collect()]}


def _page_slice(df: DataFrame, order: list[Column], page: int, page_size: int) -> DataFrame:
    """ORDER BY .. LIMIT n OFFSET m: plans as one TakeOrderedAndProject with
    offset (each task keeps its top (m+n) rows, the driver merges)."""
    offset = (page - 1) * page_size
    sorted_df = df.orderBy(*order)
    if offset:
        sorted_df = sorted_df.offset(offset)
    return sorted_df.limit(page_size)


def latest_prices(gold: DataFrame, fuel_type: str | None = None, page: int = 1, page_size: int = 25,
                  order_by: str = "price_unit", order_dir: str = "asc") -> Page:
    check_int("page", page, 1)
    check_int("page_size", page_size, 1, 200)
    check_choice("order_by", order_by, LATEST_ORDER_COLUMNS)
    order_dir = check_choice("order_dir", order_dir, ORDER_DIRECTIONS)
    pop = apply_filters(gold, eq("fuel_type", fuel_type))
    order = [sort_col(order_by, order_dir)] + tie_break(exclude=(order_by,))
    items = _page_slice(pop, order, page, page_size).select(*LATEST_COLUMNS)
    return Page(page, page_size, items, pop)


def timeseries_station(silver: DataFrame, cnpj: int, fuel_type: str | None = None,
                       date_from=None, date_to=None, page: int = 1, page_size: int = 100) -> Page:
    """A station's observations, newest first."""
    check_int("cnpj", cnpj, 0)
    check_int("page", page, 1)
    check_int("page_size", page_size, 1, 2000)
    lo, hi = time_range(date_from, date_to)
    pop = apply_filters(silver, F.col("cnpj") == F.lit(cnpj), eq("fuel_type", fuel_type),
                        time_range_pred(silver, "price_ts", lo, hi))
    order = [F.col("price_ts").desc_nulls_last(), F.col("product_code").asc_nulls_last()]
    items = _page_slice(pop, order, page, page_size).select(*STATION_SERIES_COLUMNS)
    return Page(page, page_size, items, pop)


KEYSET_COLUMNS = ["price_ts", "cnpj", "product_code"]


def after_cursor(order, values) -> Column:
    """Rows after the cursor ``values`` in ``order`` (pairs of column and
    "asc" or "desc", nulls last): equal in the first keys and after it in the
    next, for every key in turn.  The first key's bound stands alone before
    it, so that it reaches the scan."""
    def after(name, direction, v):
        c = F.col(name)
        return v.isNotNull() & ((c > v if direction == "asc" else c < v) | c.isNull())

    cond, same = F.lit(False), F.lit(True)
    for (name, direction), v in zip(order, values):
        cond = cond | (same & after(name, direction, v))
        same = same & F.col(name).eqNullSafe(v)
    (name, direction), v = order[0], values[0]
    first = F.col(name) >= v if direction == "asc" else F.col(name) <= v
    return (first | F.col(name).isNull()) & cond


def keyset_page(df: DataFrame, cursor=None, page_size: int = 25, descending: bool = True, order=None) -> DataFrame:
    """Cursor pagination: the ``page_size`` rows after ``cursor`` in ``order``.

    ``order``: pairs of column and direction that together are unique;
    (price_ts, cnpj, product_code) all descending, or ascending without
    ``descending``, unless given.  Nulls come last in every key, as in offset
    pages.  ``cursor`` is the key of the last row of the previous page, as a
    tuple of values or a one-row DataFrame with the key columns (used through
    one scalar subquery).  The next page costs a top-k over rows after the
    cursor, independent of the page depth (offset paging sorts away
    everything before it).
    """
    check_int("page_size", page_size, 1, 2000)
    order = list(order or [(c, "desc" if descending else "asc") for c in KEYSET_COLUMNS])
    for _, direction in order:
        check_choice("order_dir", direction, ORDER_DIRECTIONS)
    if cursor is not None:
        if isinstance(cursor, DataFrame):
            packed = cursor.select(F.struct(*[c for c, _ in order]).alias("k")).scalar()
            vals = [packed.getField(c) for c, _ in order]
        else:
            vals = [ts_lit(parse_ts("cursor", v)) if c.endswith("_ts") and v is not None else F.lit(v) for (c, _), v in zip(order, cursor)]
        df = df.filter(after_cursor(order, vals))
    return df.orderBy(*[sort_col(*key) for key in order]).limit(page_size)


STATION_KEYSET = [("price_ts", "desc"), ("product_code", "asc")]


def timeseries_station_after(silver: DataFrame, cnpj: int, fuel_type: str | None = None, date_from=None, date_to=None,
                             cursor=None, page_size: int = 100) -> DataFrame:
    """``timeseries_station`` by cursor: the observations after the (price_ts,
    product_code) of the last one seen, with the key columns."""
    pop = timeseries_station(silver, cnpj, fuel_type, date_from, date_to).population
    return keyset_page(pop, cursor, page_size, order=STATION_KEYSET).select("product_code", *STATION_SERIES_COLUMNS)
