"""The keyed table's rules: last write wins, and rows expire."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.clock import instant_us
from tapeloom.schemas import KEY, WRITE_ORDER

# Fixed value: the lifetime of a row, 30 days from its write.
TTL_SECONDS = 2_592_000


def latest(rows: DataFrame, keys: list[str] = KEY, order: list[str] = WRITE_ORDER) -> DataFrame:
    """One row per key, the one written last; nulls of that row replace older values.

    The greatest (order, row) struct is a partial aggregate: each task first reduces a
    key to one row, so a key with any number of copies moves at most one row per task.
    """
    rest = [c for c in rows.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *rest)).alias("newest")
    folded = rows.groupBy(*keys).agg(newest)
    return folded.select(*[c if c in keys else F.col(f"newest.{c}") for c in rows.columns])


def live(rows: DataFrame, as_of: datetime | None = None, ttl_seconds: int = TTL_SECONDS) -> DataFrame:
    """The rows not yet expired: those written less than the lifetime ago."""
    cutoff = instant_us(as_of) - F.lit(ttl_seconds * 1_000_000)
    return rows.where(F.col("ingest_us") > cutoff)
