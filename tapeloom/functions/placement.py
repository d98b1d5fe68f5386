"""Where a trade lies in the stored table: the day of its timestamp and a bucket of its symbol.

Both are bounded whatever the feed sends, so a flood of odd symbols or timestamps cannot
multiply directories. Days grow with timestamps, so a range of one is a range of the other.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapeloom.functions.clock import MS_PER_DAY

# Days count from 1970. All that is earlier is one day, and so is all that comes after 2099.
FIRST_DAY = -1
LAST_DAY = 47_481


def day_sql(timestamp: str = "timestamp") -> str:
    bounded = f"least(greatest({timestamp}, -1L), {(LAST_DAY + 1) * MS_PER_DAY - 1}L)"
    return f"CAST(({bounded} - pmod({bounded}, {MS_PER_DAY}L)) div {MS_PER_DAY}L AS INT)"


def bucket_sql(buckets: int, symbol: str = "symbol") -> str:
    return f"CAST(pmod(xxhash64({symbol}), {buckets}) AS INT)"


def day(timestamp: str = "timestamp") -> Column:
    return F.expr(day_sql(timestamp))


def symbol_bucket(buckets: int, symbol: str = "symbol") -> Column:
    return F.expr(bucket_sql(buckets, symbol))


def day_of(timestamp_ms: int) -> int:
    return min(max(timestamp_ms // MS_PER_DAY, FIRST_DAY), LAST_DAY)
