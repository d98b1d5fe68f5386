"""The newest trade of every key as a stream of changes, kept in Spark's state store.

An aggregation in update mode: a batch gives the keys that it changed, with their new row, and
nothing else. A trade's write time is the event time. State is kept by day of the write, so that
the watermark lets a day go when its rows have outlived their lifetime; rows that
come later than that are dropped and counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tapeloom.functions.clock import instant_us
from tapeloom.operators.upsert import TTL_SECONDS
from tapeloom.schemas import KEY, TRADE_COLUMNS
from tapeloom.streaming.sinks import TRIGGER

WRITTEN = "written"
_SOURCE = ["src_partition", "src_offset", "pos"]


def changes(trades: DataFrame, lifetime_seconds: int = TTL_SECONDS) -> DataFrame:
    """The keys that change and their newest rows, from flat trades with `written`, a timestamp.

    Of two rows with a key the one that arrives in a later batch wins, and within a batch the
    one that comes last in the source, as in the table. A key has a row for each day that it
    is written on; the later one stands. Trades of a key are reduced within tasks before they
    meet in one, so a hot key moves a row a task and batch.
    """
    arrived = trades.withWatermark(WRITTEN, f"{lifetime_seconds} seconds").withColumn("arrived_us", instant_us())
    rest = [name for name in TRADE_COLUMNS if name not in KEY]
    newest = F.max(F.struct("arrived_us", *_SOURCE, *rest)).alias("newest")
    folded = arrived.groupBy(*KEY, F.window(WRITTEN, "1 day").alias("day")).agg(newest)
    found = [F.col(name) if name in KEY else F.col(f"newest.{name}") for name in TRADE_COLUMNS]
    return folded.select(*found, *[F.col(f"newest.{name}") for name in _SOURCE])


def change_sink(
    trades: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict = TRIGGER,
    lifetime_seconds: int = TTL_SECONDS,
) -> DataStreamWriter:
    """Write each batch's changes to its own directory; a batch that is run again replaces it.

    After the last batch of a load there may be one without rows, which only drops state.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        changes(trades, lifetime_seconds)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(write)
    )


def state_of(query: StreamingQuery) -> tuple[int, int]:
    """Keys held after the last batch, and rows dropped as too late, by the query's progress."""
    operators = [operator for progress in query.recentProgress for operator in progress.stateOperators]
    dropped = sum(operator.numRowsDroppedByWatermark for operator in operators)
    return (operators[-1].numRowsTotal if operators else 0), dropped
