"""Time expressions. Instants are epoch integers, so no session time zone takes part."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_DAY = 86_400_000
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def wall_us(ts: Column | str) -> Column:
    """Epoch microseconds of a timestamp without time zone, read as UTC."""
    wall = ts if isinstance(ts, Column) else F.col(ts)
    # a plain difference; functions on instants would take the session's zone into account
    seconds = (wall - F.expr("timestamp_ntz'1970-01-01 00:00:00'")).cast("interval second")
    return (seconds.cast("decimal(18,6)") * F.lit(1_000_000)).cast("long")


def wall_ms(ts: Column | str) -> Column:
    """Epoch milliseconds of a timestamp without time zone; the rest is cut off."""
    return F.call_function("div", wall_us(ts), F.lit(1000))


def epoch_us(instant: datetime) -> int:
    if instant.tzinfo is None:
        raise ValueError("as_of needs a time zone")
    return (instant - _EPOCH) // timedelta(microseconds=1)


def instant_us(as_of: datetime | None = None) -> Column:
    """Epoch microseconds of a given instant, or of the moment the query runs.

    In a streaming plan "now" is the batch time kept in the checkpoint, so a replayed
    batch gets the same value again.
    """
    return F.unix_micros(F.current_timestamp()) if as_of is None else F.lit(epoch_us(as_of))
