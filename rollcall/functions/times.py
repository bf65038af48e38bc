"""Time helpers (T3, T4, T11, K11) as built-in column expressions.

Instants arrive either as TIMESTAMP (a zoned instant) or as TIMESTAMP_NTZ
holding UTC wall time.  ``utc_wall`` turns both into UTC wall time so the
rest never depends on the session zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the page's local zone.
LOCAL_ZONE = "America/Sao_Paulo"


def utc_wall(df: DataFrame, name: str) -> Column:
    """UTC wall time (TIMESTAMP_NTZ) of column ``name`` of ``df``."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        return c
    # from the instant itself: going through session wall time would fold a zone's repeated hour
    seconds = F.unix_micros(c).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def to_local(utc_ntz: Column, zone: str = LOCAL_ZONE) -> Column:
    """UTC wall time to wall time in ``zone`` (zone rules, summer time included)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_ntz)


def weekday0(c: Column) -> Column:
    """T4: Monday = 0 (not ``dayofweek``, where Sunday = 1)."""
    return F.weekday(c)


def run_date_text(d: Column) -> Column:
    """Date to ``YYYYMMDD`` text (zero filled)."""
    return F.date_format(d, "yyyyMMdd")


def run_date(yyyymmdd: Column) -> Column:
    """``YYYYMMDD`` text back to a DATE via ``YYYY-MM-DD``."""
    return F.to_date(F.concat_ws("-", F.substring(yyyymmdd, 1, 4), F.substring(yyyymmdd, 5, 2),
                                 F.substring(yyyymmdd, 7, 2)))


def stamp(ts: _dt.datetime, inventory: bool = False) -> str:
    """Output-name stamp; ``YYYY-MM-DD HHMMSS`` or ``YYYYMMDD`` (zero padded).

    The stamp is an argument taken once on the driver, never ``now()`` inside a plan.
    """
    return ts.strftime("%Y%m%d") if inventory else ts.strftime("%Y-%m-%d %H%M%S")
