"""Reads of the live table. Each is a predicate on the key, which reaches the files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.placement import day_of


def by_symbol(trades: DataFrame, symbol: str, *, newest_first: bool = False) -> DataFrame:
    """All trades of one symbol; in table order (newest first) on request."""
    found = trades.where(F.col("symbol") == symbol)
    return found.orderBy(F.desc("timestamp")) if newest_first else found


def newest(trades: DataFrame, symbol: str, n: int) -> DataFrame:
    """The n newest trades of one symbol, with their rank.

    A first job runs here, while the DataFrame is built: it finds the n-th newest timestamp
    from the key columns alone, so that the other columns are read, and upserted, only for
    what is not older than it. On a stored table that also selects the days.
    """
    found = by_symbol(trades, symbol)
    newest_times = found.select("timestamp").orderBy(F.desc("timestamp")).limit(n)
    oldest = newest_times.agg(F.min("timestamp")).first()[0]
    if oldest is not None:
        found = found.where(F.col("timestamp") >= oldest)
    top = found.orderBy(F.desc("timestamp")).limit(n)
    # the window sees nothing but the limit's n rows
    order = Window.partitionBy("symbol").orderBy(F.desc("timestamp"))
    return top.withColumn("rank", F.row_number().over(order))


def time_range(trades: DataFrame, symbol: str, first_ms: int, last_ms: int) -> DataFrame:
    """The trades of one symbol in an inclusive time range."""
    found = trades.where(
        (F.col("symbol") == symbol) & F.col("timestamp").between(first_ms, last_ms)
    )
    if "day" not in trades.columns:
        return found
    return found.where(F.col("day").between(day_of(first_ms), day_of(last_ms)))


def at_timestamp(trades: DataFrame, timestamp_ms: int) -> DataFrame:
    """The trades of all symbols at exactly one timestamp."""
    return trades.where(F.col("timestamp") == timestamp_ms)
