"""From records to trades. Every step is map-only: no shuffle, no Python."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.wire import parse_message
from tapeloom.schemas import (
    KIND_BAD_KEY,
    KIND_CONTROL,
    KIND_DEAD_LETTER,
    KIND_TRADE,
    TRADE_COLUMNS,
    TRADE_TYPE,
)


def _trade_fields():
    return [
        F.col("message_type"),
        F.col("trade.c").alias("condition"),
        F.col("trade.p").alias("price"),
        F.col("trade.s").alias("symbol"),
        F.col("trade.t").alias("timestamp"),
        F.col("trade.v").alias("volume"),
    ]


def _messages(records: DataFrame, *keep: str) -> DataFrame:
    parsed = records.select(
        *keep, "src_partition", "src_offset", "value", parse_message("value").alias("message")
    )
    # type and data apart: the explode below then drops the array instead of repeating it
    return parsed.select(
        *keep,
        "src_partition",
        "src_offset",
        "value",
        F.col("message.type").alias("message_type"),
        F.col("message.data").alias("data"),
    )


def flatten(records: DataFrame, *keep: str) -> DataFrame:
    """One row per element of each message's `data`, with its place in the source.

    Messages without elements give no row; a null element gives a row of nulls. `keep`
    names columns of the records to carry along.
    """
    # The plain explode would infer a filter on `data`, which parses every message again.
    elements = _messages(records, *keep).select(
        *keep,
        "src_partition",
        "src_offset",
        "message_type",
        F.posexplode_outer("data").alias("pos", "trade"),
    )
    return elements.where(F.col("pos").isNotNull()).select(
        *keep, *_trade_fields(), "src_partition", "src_offset", "pos"
    )


def decode(records: DataFrame) -> DataFrame:
    """The public trade columns of every trade in the records."""
    return flatten(records).select(*TRADE_COLUMNS)


def classify(records: DataFrame) -> DataFrame:
    """Trades, badly keyed trades, dead letters and control messages of the records, in one pass.

    `kind` says which, `reason` says why a row is not a trade, and `value` holds the text
    of a dead letter. A control message (another type, no elements) is one row with its place
    in the source, so every record has a row.
    """
    blank = F.coalesce(F.trim("value") == "", F.lit(True))
    undecodable = F.col("message_type").isNull() & F.col("data").isNull()
    no_trades = (F.col("message_type") == TRADE_TYPE) & (
        F.coalesce(F.size("data"), F.lit(0)) <= 0
    )
    dead = (
        F.when(blank, "empty_value")
        .when(undecodable, "not_decodable")
        .when(no_trades, "no_trades")
    )
    # decided per message, so that no trade carries the text of its whole message
    judged = _messages(records).withColumn("dead", dead).withColumn(
        "value", F.when(F.col("dead").isNotNull(), F.col("value"))
    )
    rows = judged.select(
        "src_partition",
        "src_offset",
        "value",
        "dead",
        "message_type",
        F.posexplode_outer("data").alias("pos", "trade"),
    )
    symbol, timestamp = F.col("trade.s"), F.col("trade.t")
    bad_key = (
        F.when(F.col("trade").isNull(), "null_trade")
        .when(symbol.isNull(), "missing_symbol")
        .when(symbol == "", "empty_symbol")
        .when(timestamp.isNull(), "missing_timestamp")
    )
    kind = (
        F.when(F.col("dead").isNotNull(), KIND_DEAD_LETTER)
        .when(F.col("pos").isNull(), KIND_CONTROL)
        .when(bad_key.isNotNull(), KIND_BAD_KEY)
        .otherwise(KIND_TRADE)
    )
    return rows.select(
        *_trade_fields(),
        "src_partition",
        "src_offset",
        "pos",
        F.coalesce("dead", F.when(F.col("pos").isNotNull(), bad_key)).alias("reason"),
        "value",
        kind.alias("kind"),
    )


def keyed_trades(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("kind") == KIND_TRADE).drop("kind", "reason", "value")


def dead_letters(classified: DataFrame) -> DataFrame:
    """Messages that could not be decoded, or hold no trades though they claim to."""
    return classified.where(F.col("kind") == KIND_DEAD_LETTER).select(
        "src_partition", "src_offset", "reason", "value"
    )


def quarantined(classified: DataFrame) -> DataFrame:
    """Trades the table cannot key: symbol null or empty, or timestamp null."""
    return classified.where(F.col("kind") == KIND_BAD_KEY).select(
        *TRADE_COLUMNS, "src_partition", "src_offset", "pos", "reason"
    )


def refuse_bad_keys(classified: DataFrame) -> DataFrame:
    """The classified rows, failing the job at the first trade that has no key."""
    message = F.concat(
        F.lit("trade without key at offset "), F.col("src_offset"), F.lit(": "), F.col("reason")
    )
    refused = F.when(F.col("kind") == KIND_BAD_KEY, F.raise_error(message).cast("string"))
    return classified.where(refused.isNull())
