"""The streaming job: start its queries, wait for them, and stop them together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tapeloom.plans.table import TradeTable
from tapeloom.streaming.sinks import TRIGGER, table_sink


def start(
    records: DataFrame,
    table: TradeTable,
    checkpoints: str,
    *,
    preview_rows: int = 0,
    refuse_bad_keys: bool = False,
    trigger: dict = TRIGGER,
    rebalance: bool = False,
) -> list[StreamingQuery]:
    """Start the query that stores trades, badly keyed trades and dead letters.

    It reads the source once and parses each message once. With `preview_rows` it also
    prints the first trades of each batch, from what it wrote.
    """
    sink = table_sink(
        records, table, f"{checkpoints}/table", trigger, rebalance, preview_rows, refuse_bad_keys
    )
    return [sink.start()]


def wait(queries: list[StreamingQuery], poll_seconds: int = 1) -> None:
    """Wait until all queries end. The first failure of any of them stops all and is raised."""
    try:
        running = list(queries)
        while running:
            running = [query for query in running if not query.awaitTermination(poll_seconds)]
    finally:
        stop(queries)


def stop(queries: list[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()
