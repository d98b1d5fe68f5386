"""The given tables as trade messages. All map-only, so a query's cost is its own."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.functions.clock import wall_ms, wall_us
from tapeloom.schemas import TRADE_TYPE
from tapeloom.sources.files import stream_parquet

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
MS_PER_MINUTE = 60_000
MS_PER_HOUR = 3_600_000

# Words whose texts share a task; each becomes a row, and a fold sorts the rows of a task.
WORDS_PER_TASK = 500_000
CHARS_PER_WORD = 64  # a longer word counts as several


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    return stream_parquet(spark, path, EVENTS, max_files_per_trigger=max_files)


def event_load(spark: SparkSession, sf_dir: str, folder: str, load: int, loads: int = 3) -> None:
    """Add one of several loads of the events to a folder of files: every third id, or so.

    Its files are even in size, whatever the table's are, so a stream's batch of them feeds many tasks.
    """
    rows = events(spark, sf_dir).where(F.col("event_id") % loads == load)
    rows.hint("rebalance").write.mode("append").parquet(folder)


def minute(timestamp: Column) -> Column:
    """The start of the minute: a key that several events share."""
    return timestamp - F.pmod(timestamp, F.lit(MS_PER_MINUTE))


def hour(timestamp: Column) -> Column:
    """The start of the hour: a key that several batches share, however few the events."""
    return timestamp - F.pmod(timestamp, F.lit(MS_PER_HOUR))


def wall_between(first_ms: int, last_ms: int) -> Column:
    """Whether `ts` lies in an inclusive range of milliseconds; pushed down to the files."""

    def wall(ms: int) -> Column:
        instant = datetime(1970, 1, 1) + timedelta(milliseconds=ms)
        return F.lit(instant.isoformat(" ")).cast("timestamp_ntz")

    return (F.col("ts") >= wall(first_ms)) & (F.col("ts") < wall(last_ms + 1))


def props_k() -> Column:
    return F.from_json("props", "k long")["k"]


def event_trades(
    rows: DataFrame, key_time: Column | None = None, keep: tuple[Column, ...] = ()
) -> DataFrame:
    """Events as flat trades with their write order and write time, not going through JSON."""
    return rows.select(
        F.lit(TRADE_TYPE).alias("message_type"),
        F.col("props").alias("condition"),
        F.col("value").alias("price"),
        F.col("event_type").alias("symbol"),
        (wall_ms("ts") if key_time is None else key_time).alias("timestamp"),
        props_k().cast("double").alias("volume"),
        wall_us("ts").alias("ingest_us"),
        F.lit(0).cast("long").alias("batch_id"),
        F.lit(0).alias("src_partition"),
        F.col("event_id").alias("src_offset"),
        F.lit(0).alias("pos"),
        *keep,
    )


def event_messages(
    rows: DataFrame,
    key_time: Column | None = None,
    symbol: Column | None = None,
    message_type: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Events as records, each one message with one trade; `keep` names event columns to add."""
    trade = F.struct(
        F.col("props").alias("c"),
        F.col("value").alias("p"),
        (F.col("event_type") if symbol is None else symbol).alias("s"),
        (wall_ms("ts") if key_time is None else key_time).alias("t"),
        props_k().alias("v"),
    )
    kind = F.lit(TRADE_TYPE) if message_type is None else message_type
    message = F.to_json(F.struct(kind.alias("type"), F.array(trade).alias("data")))
    return rows.select(
        F.lit(None).cast("string").alias("key"),
        message.alias("value"),
        F.lit(0).alias("src_partition"),
        F.col("event_id").alias("src_offset"),
        *keep,
    )


def spread_texts(rows: DataFrame) -> DataFrame:
    """The same rows, dealt over tasks by the number of words in `text`, which are counted first.

    Sizes in bytes, which a rebalance goes by, do not tell what the texts become: a word of a
    few bytes is a row of hundreds. So tasks get more as the table grows, and not larger.
    """
    words = F.size(F.split("text", " ")) + F.length("text") / CHARS_PER_WORD
    total = rows.agg(F.sum(words)).first()[0] or 0
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(cores, math.ceil(total / WORDS_PER_TASK)))


def document_messages(rows: DataFrame) -> DataFrame:
    """Documents as records, each one message with a trade for every word of its text.

    The word is the symbol, its length the price, its place the volume. One document is
    one moment, so a word that comes again in it writes the same key again.
    """
    trades = F.transform(
        F.split("text", " "),
        lambda word, i: F.struct(
            F.col("lang").alias("c"),
            F.length(word).alias("p"),
            word.alias("s"),
            F.col("doc_id").alias("t"),
            i.alias("v"),
        ),
    )
    message = F.to_json(F.struct(F.lit(TRADE_TYPE).alias("type"), trades.alias("data")))
    return rows.select(
        F.lit(None).cast("string").alias("key"),
        message.alias("value"),
        F.lit(0).alias("src_partition"),
        F.col("doc_id").alias("src_offset"),
    )
