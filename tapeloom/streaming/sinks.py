"""Stream sinks: the topic, the console, the table, and a wide-column store connector."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tapeloom.operators import decode
from tapeloom.operators.decode import classify
from tapeloom.plans.table import TradeTable, with_ingest_time
from tapeloom.schemas import KIND_BAD_KEY, KIND_DEAD_LETTER, KIND_TRADE

# The trigger, the console preview and the connector's write settings.
TRIGGER = {"processingTime": "10 seconds"}
PREVIEW_ROWS = 5
CONNECTOR_SETTINGS = {
    "spark.cassandra.output.consistency.level": "LOCAL_ONE",
    "spark.cassandra.output.concurrent.writes": "4",
    "spark.cassandra.output.batch.size.rows": "64",
    "spark.cassandra.output.throughput_mb_per_sec": "20",
}

# The connector's settings for the whole session.
CONNECTOR_SESSION = {
    "spark.cassandra.connection.keep_alive_ms": "60000",
    "spark.cassandra.connection.timeout_ms": "10000",
    "spark.cassandra.output.batch.size.rows": "50",
}


def _appending(rows: DataFrame, checkpoint: str, trigger: dict) -> DataStreamWriter:
    return (
        rows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )


def topic_rows(records: DataFrame) -> DataFrame:
    return records.select(F.col("key").cast("string"), F.col("value").cast("string"))


def publish_sink(
    records: DataFrame,
    write: Callable[[DataFrame, int], None],
    target: str,
    checkpoint: str,
    trigger: dict = TRIGGER,
) -> DataStreamWriter:
    """Publish each batch with `write`; the query has the target's name.

    The records of a batch are counted while it is written, and the count is in the query's
    progress, under "published", once the write has succeeded: a `DeliveryAudit` reports it, or
    the failure. After a failure the batch is run again by the next start. Which partition a
    record lands in is the broker's choice, which the topic sink does not tell Spark.
    """
    counted = topic_rows(records).observe("published", F.count(F.lit(1)).alias("records"))
    return _appending(counted, checkpoint, trigger).queryName(target).foreachBatch(write)


def topic_writer(servers: str, topic: str) -> Callable[[DataFrame, int], None]:
    """Writes a batch of records to a topic. Needs the Kafka data source package."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    return write


def console_sink(
    trades: DataFrame, checkpoint: str, rows: int = PREVIEW_ROWS, trigger: dict = TRIGGER
) -> DataStreamWriter:
    """Show the first rows of each batch in full."""
    return (
        _appending(trades, checkpoint, trigger)
        .format("console")
        .option("truncate", "false")
        .option("numRows", rows)
    )


def table_sink(
    records: DataFrame,
    table: TradeTable,
    checkpoint: str,
    trigger: dict = TRIGGER,
    rebalance: bool = False,
    preview_rows: int = 0,
    refuse_bad_keys: bool = False,
) -> DataStreamWriter:
    """Keep the table up to date with a stream of records.

    The batch's directory is named by its id, so a batch that is run again after a
    failure replaces what it wrote before. `preview_rows` prints the first trades of
    each batch from what was written, so the source is read and parsed only once. How many
    rows of each kind a batch delivered is in the query's progress, under "delivered".
    Trades without a key are kept apart, or with `refuse_bad_keys` fail the query.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        table.append(rows, batch_id, rebalance)
        if preview_rows:
            table.batch(batch_id).show(preview_rows, truncate=False)

    kinds = {"trades": KIND_TRADE, "bad_keys": KIND_BAD_KEY, "dead_letters": KIND_DEAD_LETTER}
    counts = [F.count(F.when(F.col("kind") == k, True)).alias(name) for name, k in kinds.items()]
    classified = classify(records)
    if refuse_bad_keys:
        classified = decode.refuse_bad_keys(classified)
    rows = with_ingest_time(classified).observe("delivered", *counts)
    return _appending(rows, checkpoint, trigger).foreachBatch(write)


def connector_session(hosts: list[str], port: int = 9042) -> dict[str, str]:
    """Session settings to reach an outside store, for the session builder."""
    return {
        "spark.cassandra.connection.host": ",".join(hosts),
        "spark.cassandra.connection.port": str(port),
        **CONNECTOR_SESSION,
    }


def connector_options(keyspace: str, table: str, settings: dict | None = None) -> dict[str, str]:
    return {"keyspace": keyspace, "table": table, **CONNECTOR_SETTINGS, **(settings or {})}


def connector_sink(
    trades: DataFrame,
    keyspace: str,
    table: str,
    checkpoint: str,
    settings: dict | None = None,
    trigger: dict = TRIGGER,
) -> DataStreamWriter:
    """Append trades to a keyed table of an outside store. Needs its connector package."""
    return (
        _appending(trades, checkpoint, trigger)
        .format("org.apache.spark.sql.cassandra")
        .options(**connector_options(keyspace, table, settings))
    )
