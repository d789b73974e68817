"""Session times: zone-less parsing, whole-unit differences, moments that files can be skipped by."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(text: Column | str, on_error: str = "fail") -> Column:
    """Date and time of an ISO string as TIMESTAMP_NTZ; fraction and offset are ignored.

    A malformed string fails the query, or gives NULL with `on_error="null"`.
    """
    c = F.col(text) if isinstance(text, str) else text
    plain = F.concat(F.substring(c, 1, 10), F.lit(" "), F.substring(c, 12, 8))
    if on_error == "fail":
        return plain.cast("timestamp_ntz")
    if on_error == "null":
        return plain.try_cast("timestamp_ntz")
    raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")


def whole_hours(start: Column, end: Column) -> Column:
    """Complete hours from start to end, truncated toward zero."""
    return (end - start).cast("interval hour").cast("bigint")


def whole_minutes(start: Column, end: Column) -> Column:
    """Complete minutes from start to end, truncated toward zero."""
    return (end - start).cast("interval minute").cast("bigint")


def ntz(moment: str | datetime) -> Column:
    return F.lit(str(moment)).cast("timestamp_ntz")


def _seconds(moment: Column) -> Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), moment)


def stored_moment(text: Column | str) -> Column:
    """The wall clock of an ISO string in seconds since 1970 began; NULL if malformed.

    A BIGINT, because Parquet files and row groups are skipped by its statistics. They are not
    by TIMESTAMP_NTZ columns, nor by TIMESTAMP ones as Spark writes them by default.
    """
    return _seconds(wall_clock(text, on_error="null"))


def parsed_moment(text: Column | str) -> Column:
    """As `stored_moment`, but a malformed string fails the query."""
    return _seconds(wall_clock(text))


def moment_of(stored: str, text: str) -> Column:
    """A stored moment. Where it is NULL the text is parsed, so that a malformed string fails the
    query."""
    return F.coalesce(F.col(stored), parsed_moment(text))


def second_from(moment: str | datetime) -> int:
    """The first stored second at or after a moment."""
    return math.ceil(_since_1970(moment))


def second_until(moment: str | datetime) -> int:
    """The last stored second at or before a moment."""
    return math.floor(_since_1970(moment))


def moment_from(moment: str | datetime) -> Column:
    return F.lit(second_from(moment)).cast("bigint")


def moment_until(moment: str | datetime) -> Column:
    return F.lit(second_until(moment)).cast("bigint")


def _since_1970(moment: str | datetime) -> float:
    when = datetime.fromisoformat(moment) if isinstance(moment, str) else moment
    return (when - datetime(1970, 1, 1)).total_seconds()


def whole_units(begun: Column, ended: Column, seconds: int) -> Column:
    """Complete units of some seconds between two stored moments, truncated toward zero."""
    return F.call_function("div", ended - begun, F.lit(seconds))
