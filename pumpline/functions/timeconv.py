"""Conversions between instants (timestamp) and UTC wall clock
(timestamp_ntz) that hold whatever the session time zone is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant_to_utc_ntz(ts: Column) -> Column:
    """timestamp -> its UTC wall clock as timestamp_ntz."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


def utc_ntz_to_instant(ts: Column) -> Column:
    """UTC wall clock (timestamp_ntz) -> the instant, as timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts).cast("timestamp")


def parse_utc_text(text: Column) -> Column:
    """Text with an offset (``2026-01-16 14:51:57-00:00``, ISO ``...+00:00``)
    -> UTC wall clock; unparseable text -> null."""
    return instant_to_utc_ntz(F.try_to_timestamp(text))


def utc_now() -> Column:
    return instant_to_utc_ntz(F.current_timestamp())
