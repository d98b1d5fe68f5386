"""Schemas. All of them are declared; nothing is inferred from data."""

from pyspark.sql import types as T

# The names and types of the feed's wire format.
WIRE_TRADE = T.StructType(
    [
        T.StructField("c", T.StringType()),
        T.StructField("p", T.DoubleType()),
        T.StructField("s", T.StringType()),
        T.StructField("t", T.LongType()),
        T.StructField("v", T.DoubleType()),
    ]
)
WIRE_MESSAGE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("data", T.ArrayType(WIRE_TRADE)),
    ]
)

# Fixed value: the `type` of a message that holds trades.
TRADE_TYPE = "trade"

# The public trade row, one per element of a message's `data`.
TRADE = T.StructType(
    [
        T.StructField("message_type", T.StringType()),
        T.StructField("condition", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("volume", T.DoubleType()),
    ]
)
TRADE_COLUMNS = TRADE.fieldNames()

# One visible row per key; among rows of one key the greatest write order wins.
KEY = ["symbol", "timestamp"]
WRITE_ORDER = ["batch_id", "src_partition", "src_offset", "pos"]

# What the kind of a stored row can be. A control message is one that holds no trades and
# need not: it has a row with its place in the source, so that the place is not missed.
KIND_TRADE = "trade"
KIND_BAD_KEY = "bad_key"
KIND_DEAD_LETTER = "dead_letter"
KIND_CONTROL = "control"

# A topic record after the key and value casts, with its place in the source.
RECORD = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("src_partition", T.IntegerType()),
        T.StructField("src_offset", T.LongType()),
    ]
)

_WRITTEN = [
    T.StructField("src_partition", T.IntegerType()),
    T.StructField("src_offset", T.LongType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("reason", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("ingest_us", T.LongType()),
]

# A row of the append log; the last three columns are directories. `ingest_us` is the write
# time in epoch microseconds: a plain integer is pushed down to parquet whatever timestamp
# encoding a session uses.
LOG = T.StructType(
    TRADE.fields
    + _WRITTEN
    + [
        T.StructField("batch_id", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("day", T.IntegerType()),
    ]
)

# A row of the compacted table, one per key; the last two columns are directories.
STORED = T.StructType(
    TRADE.fields
    + [
        T.StructField("ingest_us", T.LongType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("symbol_bucket", T.IntegerType()),
    ]
)

# A row of the table in buckets, one per key, with its place in the source; the last column is a directory.
BUCKETED = T.StructType(
    TRADE.fields
    + [
        T.StructField("batch_id", T.LongType()),
        T.StructField("src_partition", T.IntegerType()),
        T.StructField("src_offset", T.LongType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("ingest_us", T.LongType()),
        T.StructField("day", T.IntegerType()),
    ]
)

# A row that is not a trade, of a compacted batch; the last column is a directory.
REJECTED = T.StructType(
    TRADE.fields
    + _WRITTEN
    + [
        T.StructField("batch_id", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("batches", T.LongType()),
    ]
)

# What a compacted batch delivered, by kind of row, and the runs of offsets that it holds as
# rows of the kind `run`; the last column is a directory.
KIND_RUN = "run"
DELIVERY = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("src_partition", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("first_offset", T.LongType()),
        T.StructField("last_offset", T.LongType()),
        T.StructField("batches", T.LongType()),
    ]
)
