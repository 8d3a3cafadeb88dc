"""Radius queries: prices near a point, the source's listing, and the
many-points proximity join."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH_RADIUS_KM, KM_PER_DEG_LAT, box_predicate, haversine_km
from ..functions.params import (LISTING_ORDERS, NEARBY_ORDER_COLUMNS, ORDER_DIRECTIONS, apply_filters,
                                as_of_column, check_choice, check_float, check_int, eq, hours_interval,
                                sort_col, tie_break, window_pred)
from ..schema import PAGE_ROWS, QUERY_HOURS, QUERY_LAT, QUERY_LNG, QUERY_RADIUS_KM
from .paging import Page

ROUND = 6
NEARBY_COLUMNS = ["fuel_type", "uf", "city", "station_name", "cnpj", "product_desc", "unit",
                  "price_ts", "price_unit", "price_net", "price_gross", "discount", "lat", "lng", "distance_km"]


def _within(df: DataFrame, lat: float, lng: float, radius_km: float) -> DataFrame:
    """Rows within radius_km of (lat, lng), with the computed distance.

    The bounding box is a pair of range predicates Parquet can use to skip
    row groups; the exact haversine runs only on rows inside the box.  The
    stored ``distance_km`` (from the source's query point) is replaced by the
    computed one.
    """
    box = box_predicate("lat", "lng", lat, lng, radius_km)
    d = haversine_km(lat, lng, F.col("lat"), F.col("lng"))
    return (df.filter(F.col("lat").isNotNull() & F.col("lng").isNotNull() & box)
            .withColumn("distance_km", d)
            .filter(F.col("distance_km") <= F.lit(radius_km)))


def prices_nearby(gold: DataFrame, lat: float, lng: float, radius_km: float = 5.0,
                  fuel_type: str | None = None, limit: int = 50, order_by: str = "price_unit",
                  order_dir: str = "asc") -> DataFrame:
    check_float("lat", lat, -90, 90)
    check_float("lng", lng, -180, 180)
    check_float("radius_km", radius_km, 0, 200, lo_open=True)
    check_int("limit", limit, 1, 500)
    check_choice("order_by", order_by, NEARBY_ORDER_COLUMNS)
    order_dir = check_choice("order_dir", order_dir, ORDER_DIRECTIONS)
    near = _within(apply_filters(gold, eq("fuel_type", fuel_type)), lat, lng, radius_km)
    order = [sort_col(order_by, order_dir)] + tie_break(exclude=(order_by,))
    return (near.orderBy(*order).limit(limit)
            .withColumn("distance_km", F.round("distance_km", ROUND))
            .select(*NEARBY_COLUMNS))


def source_listing(silver: DataFrame, fuel_type: str, as_of="max", hours: int = QUERY_HOURS,
                   lat: float = QUERY_LAT, lng: float = QUERY_LNG, radius_km: float = QUERY_RADIUS_KM,
                   order: str = "preco.asc", page: int = 1, page_rows: int = PAGE_ROWS) -> Page:
    """The listing the collector asks the source for, computed over silver:
    observations of one fuel from the last ``hours`` before ``as_of`` within
    ``radius_km`` of the point, in one of the source's orders, page ``page``.
    ``Page.population`` gives the reported total; pages = ceil(total / rows).
    """
    check_int("hours", hours, 1, 24 * 30)
    check_float("radius_km", radius_km, 0, 1000, lo_open=True)
    check_int("page", page, 1)
    check_int("page_rows", page_rows, 1, 1000)
    if order not in LISTING_ORDERS:
        raise ValueError(f"order invalid: use one of {sorted(LISTING_ORDERS)}")
    col, direction = LISTING_ORDERS[order]
    cut = as_of_column(silver, as_of)
    lo = cut - hours_interval(hours)
    recent = apply_filters(silver, eq("fuel_type", fuel_type), F.col("price_ts") > lo,
                           window_pred(silver, "price_ts", lo, cut))
    pop = _within(recent, lat, lng, radius_km)
    offset = (page - 1) * page_rows
    items = pop.orderBy(sort_col(col, direction), *tie_break(exclude=(col,)))
    if offset:
        items = items.offset(offset)
    items = items.limit(page_rows).withColumn("distance_km", F.round("distance_km", ROUND))
    return Page(page, page_rows, items.select(*NEARBY_COLUMNS), pop)


def listing_totals(page: Page, max_pages: int | None = None) -> DataFrame:
    """totalRegistros / totalPaginas of a listing, as one row.  The live
    source reports at most a few pages however many records match; pass
    ``max_pages`` to reproduce that cap."""
    pages = F.ceil(F.col("total_records") / F.lit(page.page_size))
    if max_pages is not None:
        check_int("max_pages", max_pages, 1)
        pages = F.least(pages, F.lit(max_pages).cast("bigint"))
    return page.population.agg(F.count(F.lit(1)).alias("total_records")).withColumn("total_pages", pages)


def _band_width(radius_km: float, band: Column, dlat: float) -> tuple[Column, Column]:
    """Longitude cell width (deg) and cell count for latitude band ``band``.

    Two points within radius_km, one in this band and one in an adjacent
    band, have |lat| at most the band range's extreme, and at that latitude
    a great circle of radius_km spans at most 2*asin(sin(r/2R) / cos(lat))
    of longitude.  Cells are whole fractions of 360 degrees (n = floor(360 /
    minimal width), width = 360 / n) so the grid wraps at the antimeridian
    without a narrow last cell.
    """
    lo = band * F.lit(dlat) - F.lit(90.0 + dlat)          # lower edge of band - 1
    hi = (band + 2) * F.lit(dlat) - F.lit(90.0)           # upper edge of band + 1
    extreme = F.least(F.greatest(F.abs(lo), F.abs(hi)), F.lit(89.999999))
    ratio = F.lit(math.sin(radius_km / (2 * EARTH_RADIUS_KM))) / F.cos(F.radians(extreme))
    w_min = F.when(ratio >= 1, F.lit(360.0)).otherwise(F.degrees(F.lit(2.0) * F.asin(ratio)) * F.lit(1.000001))
    n = F.greatest(F.floor(F.lit(360.0) / w_min), F.lit(1).cast("bigint"))
    return F.lit(360.0) / n, n


def nearby_join(points: DataFrame, sites: DataFrame, radius_km: float,
                point_cols=("point_id", "p_lat", "p_lng"), site_lat: str = "lat", site_lng: str = "lng") -> DataFrame:
    """All (point, site) pairs within radius_km, without a Cartesian product.

    Latitude bands are radius_km tall; each band has its own longitude cell
    width, wide enough for its latitudes (``_band_width``).  A site falls in
    one (band, cell); each point is replicated to the 3 bands around it and,
    in each, to its 3 neighbouring cells (at most 9 copies), equi-joined on
    (band, cell), then the exact haversine filter runs.  Exact at any
    latitude and across the antimeridian, with no pass over the data to size
    the grid.  A dense cell is one hot join key: AQE's skew-join split takes
    it apart.  Output: point columns, site columns, distance_km.
    """
    check_float("radius_km", radius_km, 0, 2000, lo_open=True)
    pid, plat, plng = point_cols
    dlat = radius_km / KM_PER_DEG_LAT

    def band_of(lat_col: Column) -> Column:
        return F.floor((lat_col + F.lit(90.0)) / F.lit(dlat))

    def cell_of(lng_col: Column, width: Column, n: Column) -> Column:
        return F.pmod(F.floor((lng_col + F.lit(180.0)) / width), n)

    s_band = band_of(F.col(site_lat))
    s_w, s_n = _band_width(radius_km, s_band, dlat)
    site_cells = (sites.filter(F.col(site_lat).isNotNull() & F.col(site_lng).isNotNull())
                  .withColumn("_band", s_band)
                  .withColumn("_cell", cell_of(F.col(site_lng), s_w, s_n)))

    pts = (points.filter(F.col(plat).isNotNull() & F.col(plng).isNotNull())
           .withColumn("_band", F.explode(F.sequence(band_of(F.col(plat)) - 1, band_of(F.col(plat)) + 1))))
    p_w, p_n = _band_width(radius_km, F.col("_band"), dlat)
    c = cell_of(F.col(plng), p_w, p_n)
    pt_cells = pts.withColumn("_cell", F.explode(F.array_distinct(F.array(F.pmod(c - 1, p_n), c,
                                                                          F.pmod(c + 1, p_n)))))
    j = pt_cells.join(site_cells, ["_band", "_cell"])
    d = haversine_km(F.col(plat), F.col(plng), F.col(site_lat), F.col(site_lng))
    return j.withColumn("distance_km", d).filter(F.col("distance_km") <= F.lit(radius_km)).drop("_band", "_cell")
