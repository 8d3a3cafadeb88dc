"""Argument checks, optional-filter building, time arguments and sort whitelists.

Every public operator validates its arguments here before any plan is built;
a bad argument raises ``ValueError`` (the service layer maps it to a 422).
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bounds of the request parameters and the sort whitelists, as
# the service accepts them.
LATEST_ORDER_COLUMNS = [
    "price_unit", "price_net", "price_gross", "discount", "price_ts",
    "city", "uf", "station_name", "distance_km",
]
NEARBY_ORDER_COLUMNS = ["price_unit", "distance_km", "price_ts"]
ORDER_DIRECTIONS = ["asc", "desc"]

# Listing order choices of the source page: (name -> column, direction).
LISTING_ORDERS = {
    "preco.asc": ("price_net", "asc"),
    "preco.desc": ("price_net", "desc"),
    "distancia.asc": ("distance_km", "asc"),
    "distancia.desc": ("distance_km", "desc"),
    "data.desc": ("price_ts", "desc"),
    "data.asc": ("price_ts", "asc"),
}

# Unique tie-break appended to every ORDER BY so pages never overlap.
TIE_BREAK = ["cnpj", "product_code", "price_ts"]


def check_int(name: str, value, lo: int | None = None, hi: int | None = None) -> int:
    if isinstance(value, bool) or not isinstance(value, int):
        raise ValueError(f"{name} must be an integer, got {value!r}")
    if lo is not None and value < lo:
        raise ValueError(f"{name} must be >= {lo}, got {value}")
    if hi is not None and value > hi:
        raise ValueError(f"{name} must be <= {hi}, got {value}")
    return value


def check_float(name: str, value, lo: float | None = None, hi: float | None = None,
                lo_open: bool = False) -> float:
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        raise ValueError(f"{name} must be a number, got {value!r}")
    value = float(value)
    if lo is not None and (value <= lo if lo_open else value < lo):
        raise ValueError(f"{name} must be {'>' if lo_open else '>='} {lo}, got {value}")
    if hi is not None and value > hi:
        raise ValueError(f"{name} must be <= {hi}, got {value}")
    return value


def check_uf(uf: str | None) -> str | None:
    if uf is not None and uf != "" and len(uf) != 2:
        raise ValueError(f"uf must have 2 letters, got {uf!r}")
    return uf or None


def check_required(name: str, value):
    if value is None or value == "":
        raise ValueError(f"{name} is required")
    return value


def check_choice(name: str, value: str, allowed) -> str:
    v = value.lower().strip() if isinstance(value, str) and name.endswith("dir") else value
    if v not in allowed:
        raise ValueError(f"{name} invalid: use one of {sorted(allowed)}")
    return v


def parse_ts(name: str, value) -> _dt.datetime | None:
    """Parse a date/time argument on the driver; bad text is a ValueError, not a
    failed job."""
    if value is None or value == "":
        return None
    if isinstance(value, _dt.datetime):
        return value.replace(tzinfo=None) if value.tzinfo is None else \
            value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    if isinstance(value, _dt.date):
        return _dt.datetime(value.year, value.month, value.day)
    if not isinstance(value, str):
        raise ValueError(f"{name} must be a date/time text, got {value!r}")
    text = value.strip().replace("T", " ")
    try:
        parsed = _dt.datetime.fromisoformat(text)
    except ValueError as exc:
        raise ValueError(f"{name} is not a valid date/time: {value!r}") from exc
    if parsed.tzinfo is not None:
        parsed = parsed.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return parsed


def time_range(date_from, date_to) -> tuple[_dt.datetime | None, _dt.datetime | None]:
    lo, hi = parse_ts("date_from", date_from), parse_ts("date_to", date_to)
    if lo is not None and hi is not None and lo > hi:
        raise ValueError("date_from must not be after date_to")
    return lo, hi


def ts_lit(value: _dt.datetime) -> Column:
    """A UTC wall-clock literal (built from text, so no zone is applied)."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def conjunction(preds) -> Column | None:
    preds = [p for p in preds if p is not None]
    return reduce(lambda a, b: a & b, preds) if preds else None


def apply_filters(df: DataFrame, *preds) -> DataFrame:
    cond = conjunction(preds)
    return df if cond is None else df.filter(cond)


def eq(col: str, value) -> Column | None:
    """Equality conjunct, only when the argument was supplied."""
    if value is None or value == "":
        return None
    return F.col(col) == F.lit(value)


def between_ts(col: str, lo, hi) -> Column | None:
    preds = []
    if lo is not None:
        preds.append(F.col(col) >= ts_lit(lo))
    if hi is not None:
        preds.append(F.col(col) <= ts_lit(hi))
    return conjunction(preds)


# Day partition column of stored silver (to_date of price_ts, UTC).
PARTITION_DATE = "obs_date"


def time_range_pred(df: DataFrame, col: str, lo, hi) -> Column | None:
    """``lo <= col <= hi`` plus, when ``df`` is stored silver with its day
    partition column, the same range on the day so whole day folders are
    pruned at planning time."""
    pred = between_ts(col, lo, hi)
    if pred is not None and PARTITION_DATE in df.columns:
        if lo is not None:
            pred = pred & (F.col(PARTITION_DATE) >= F.to_date(ts_lit(lo)))
        if hi is not None:
            pred = pred & (F.col(PARTITION_DATE) <= F.to_date(ts_lit(hi)))
    return pred


def window_pred(df: DataFrame, col: str, lo: Column, hi: Column) -> Column:
    """``lo <= col <= hi`` for Column bounds (e.g. as_of minus hours), with
    the day-partition range added on stored silver; the bounds are scalar
    subqueries evaluated before the scan, so day folders are pruned at run
    time."""
    pred = (F.col(col) >= lo) & (F.col(col) <= hi)
    if PARTITION_DATE in df.columns:
        pred = pred & (F.col(PARTITION_DATE) >= F.to_date(lo)) & (F.col(PARTITION_DATE) <= F.to_date(hi))
    return pred


def as_of_column(df: DataFrame, as_of, ts_col: str = "price_ts") -> Column:
    """The reference instant of sliding windows.

    ``None`` -> the current time (UTC wall clock); ``"max"`` -> the newest
    ``ts_col`` in ``df`` as a scalar subquery (one value, evaluated once);
    text/datetime -> that literal; a Column is used as is.
    """
    if isinstance(as_of, Column):
        return as_of
    if as_of is None:
        from .timeconv import utc_now
        return utc_now()
    if isinstance(as_of, str) and as_of == "max":
        if PARTITION_DATE in df.columns and ts_col == "price_ts":
            # obs_date = to_date(price_ts): the newest time lies in the newest
            # day folder, so only that folder's time column is read.
            newest_day = df.agg(F.max(PARTITION_DATE)).scalar()
            return df.filter(F.col(PARTITION_DATE) == newest_day).agg(F.max(ts_col)).scalar()
        return df.agg(F.max(ts_col)).scalar()
    return ts_lit(parse_ts("as_of", as_of))


def hours_interval(hours) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(hours))


def sort_col(name: str, direction: str) -> Column:
    c = F.col(name)
    return c.asc_nulls_last() if direction == "asc" else c.desc_nulls_last()


def tie_break(exclude=()) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in TIE_BREAK if c not in exclude]
