"""From raw frames to topic records, and the choice of symbols."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.wire import decode_utf8, frame_elements, frame_end, is_frame
from tapeloom.schemas import TRADE_TYPE

# The symbols the feed is asked for, and the key of every record.
SYMBOLS = ["AAPL", "AMZN", "BINANCE:BTCUSDT", "IC MARKETS:1"]
RECORD_KEY = "d"


def trade_records(frames: DataFrame, key: Column | str = RECORD_KEY) -> DataFrame:
    """The frames that are trade messages, as topic records with their text unchanged.

    Frames of another type are left out, and so are those that `rejects` gives with a
    reason. A constant key sends all records to one topic partition; give a column to
    spread them.
    """
    record_key = key if isinstance(key, Column) else F.lit(key)
    text = decode_utf8("value", on_error="null")
    return (
        frames.withColumn("value", text)
        .where(is_frame("value", TRADE_TYPE))
        .withColumn("key", record_key)
    )


def rejects(frames: DataFrame) -> DataFrame:
    """The frames that cannot be read, untouched, with a `reason`.

    That is `empty` for null, `not_utf8`, or `not_an_object` for anything but exactly one
    JSON object. Each frame is parsed once.
    """
    names = frames.columns
    text = decode_utf8("value", on_error="null")
    parsed = frames.withColumn("_text", text).withColumn("_parts", frame_elements(F.col("_text")))
    whole = (
        (F.size("_parts") == 2)
        & F.col("_parts")[0].isNotNull()
        & (F.col("_parts")[1]["type"] == frame_end(F.col("_text")))
    )
    reason = (
        F.when(F.col("value").isNull(), "empty")
        .when(F.col("_text").isNull(), "not_utf8")
        .when(~F.coalesce(whole, F.lit(False)), "not_an_object")
    )
    return parsed.withColumn("reason", reason).where("reason is not null").select(*names, "reason")


def strict_text(frames: DataFrame, on_error: str = "raise") -> DataFrame:
    """Frames as text. Invalid UTF-8 fails the job, or its frame is left out ('drop')."""
    if on_error == "drop":
        text = frames.withColumn("value", decode_utf8("value", on_error="null"))
        return text.where(F.col("value").isNotNull())
    return frames.withColumn("value", decode_utf8("value", on_error))


def subscribe(trades: DataFrame, symbols: Iterable[str] | DataFrame = tuple(SYMBOLS)) -> DataFrame:
    """The trades of the given symbols.

    A list becomes a predicate. A table of symbols is semi-joined: broadcast if Spark
    estimates from its files that it is below the broadcast threshold, else shuffled, where
    a symbol that is too frequent for one task is split by the adaptive skew join.
    """
    if isinstance(symbols, DataFrame):
        wanted = symbols.select("symbol").distinct()
        return trades.join(wanted, "symbol", "left_semi").select(*trades.columns)
    return trades.where(F.col("symbol").isin(list(symbols)))
