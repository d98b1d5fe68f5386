"""The registered queries: each takes a session and the folder of the given tables."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.functions.clock import wall_ms, wall_us
from tapeloom.functions.placement import day_of
from tapeloom.operators import decode as d
from tapeloom.operators import publish, reads
from tapeloom.operators.upsert import latest, live
from tapeloom.plans import feeds
from tapeloom.plans.backfill import backfill
from tapeloom.plans.bucketed import BucketedTrades
from tapeloom.plans.table import TradeTable, with_ingest_time
from tapeloom.schemas import KIND_TRADE, RECORD, TRADE, TRADE_COLUMNS, TRADE_TYPE
from tapeloom.sources.files import read_parquet
from tapeloom.sources.paths import glob, shared_dir
from tapeloom.streaming.audit import DeliveryAudit
from tapeloom.streaming.changes import WRITTEN, change_sink
from tapeloom.streaming.job import wait
from tapeloom.streaming.sinks import publish_sink, table_sink

ONCE = {"availableNow": True}
AS_OF = datetime(2024, 2, 10, 12, tzinfo=timezone.utc)  # rows of a day expire in part
EARLIER = datetime(2024, 2, 5, tzinfo=timezone.utc)
RANGE_MS = (1_704_844_800_000, 1_705_708_799_999)  # 2024-01-10 up to the end of 2024-01-19


def _minute_key():
    return feeds.minute(wall_ms("ts"))


def _hour_key():
    return feeds.hour(wall_ms("ts"))


# -- ingress ------------------------------------------------------------------------


def utf8_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts sent as bytes, where the sender of one language breaks every one of them."""
    text = F.col("text").cast("binary")
    broken = F.when(F.col("lang") == "de", F.concat(text, F.unhex(F.lit("FF")))).otherwise(text)
    frames = feeds.table(spark, sf_dir, "documents").select("doc_id", broken.alias("value"))
    kept = publish.strict_text(frames, on_error="drop")
    return kept.select("doc_id", F.length("value").alias("n_chars"), F.md5("value").alias("digest"))


def _frames(rows: DataFrame) -> DataFrame:
    """Events as raw frames in bytes, purchases being the trades among them.

    Errors are forged: trades too, but with a second object and the end of a list behind.
    """
    event_type = F.col("event_type")
    sent_type = F.when(event_type.isin("purchase", "error"), TRADE_TYPE).otherwise(event_type)
    messages = feeds.event_messages(rows, message_type=sent_type, keep=("event_type",))
    forged = F.when(event_type == "error", ',{"type":"end of frame"}]junk').otherwise("")
    value = F.concat("value", forged).cast("binary")
    return messages.withColumn("value", value).drop("event_type")


def _published(records: DataFrame) -> DataFrame:
    return d.flatten(records, "key").select(
        "key", F.col("src_offset").alias("event_id"), "symbol", "price", "timestamp"
    )


def publish_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw frames to topic records; what is published is decoded."""
    return _published(publish.trade_records(_frames(feeds.events(spark, sf_dir))))


def publish_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors arrive as broken UTF-8, signups with junk behind, views with a forged end."""
    event_type = F.col("event_type")
    messages = feeds.event_messages(feeds.events(spark, sf_dir), keep=("event_type",))
    whole = F.col("value").cast("binary")
    value = (
        F.when(event_type == "error", F.concat(whole, F.unhex(F.lit("FF"))))
        .when(event_type == "signup", F.concat(whole, F.lit("] junk").cast("binary")))
        .when(event_type == "view", F.concat(whole, F.lit(',{"type":"end of frame"}]').cast("binary")))
        .otherwise(whole)
    )
    rejected = publish.rejects(messages.withColumn("value", value))
    return rejected.select(F.col("src_offset").alias("event_id"), "reason")


def subscribe_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = d.decode(feeds.event_messages(feeds.events(spark, sf_dir)))
    return publish.subscribe(trades, ["click", "view"])


def subscribe_symbol_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word trades of the words that occur in the benchmark's texts."""
    trades = d.decode(_word_messages(spark, sf_dir))
    words = feeds.table(spark, sf_dir, "benchmark").select(
        F.explode(F.split("text", " ")).alias("symbol")
    )
    return publish.subscribe(trades, words)


def _word_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as messages. Their files may be few row groups, so few tasks, and a message

    becomes hundreds of rows: whole texts are spread first, which are small beside those rows.
    """
    texts = feeds.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return feeds.document_messages(feeds.spread_texts(texts))


# -- decoding -----------------------------------------------------------------------


def decode_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.decode(feeds.event_messages(feeds.events(spark, sf_dir)))


def decode_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with a trade for every word of a whole text."""
    flat = d.flatten(_word_messages(spark, sf_dir))
    return flat.select(*TRADE_COLUMNS, "pos")


def parse_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.events(spark, sf_dir).select("event_id", feeds.props_k().alias("k"))


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five trades, as the console shows them."""
    flat = d.flatten(feeds.event_messages(feeds.events(spark, sf_dir)))
    return flat.orderBy("src_partition", "src_offset", "pos").limit(5).select(*TRADE_COLUMNS)


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors arrive cut off, signups without trades, and views are control messages."""
    records = feeds.event_messages(feeds.events(spark, sf_dir), keep=("event_type",))
    event_type = F.col("event_type")
    value = (
        F.when(event_type == "error", F.substring("value", 1, 20))
        .when(event_type == "signup", F.lit('{"type":"trade","data":[]}'))
        .when(event_type == "view", F.lit('{"type":"ping"}'))
        .otherwise(F.col("value"))
    )
    judged = d.classify(records.withColumn("value", value))
    return d.dead_letters(judged).select(F.col("src_offset").alias("event_id"), "reason")


def quarantine_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors arrive without a symbol, signups with an empty one, views without a time."""
    event_type = F.col("event_type")
    symbol = F.when(event_type == "signup", "").when(event_type != "error", event_type)
    key_time = F.when(event_type != "view", wall_ms("ts"))
    judged = d.classify(
        feeds.event_messages(feeds.events(spark, sf_dir), key_time=key_time, symbol=symbol)
    )
    return d.quarantined(judged).select(
        F.col("src_offset").alias("event_id"),
        F.coalesce("symbol", F.lit("none")).alias("symbol"),
        F.coalesce(F.col("timestamp").cast("string"), F.lit("none")).alias("timestamp"),
        "price",
        "reason",
    )


# -- the table's rules --------------------------------------------------------------


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = feeds.event_messages(feeds.events(spark, sf_dir), key_time=_minute_key())
    order = ["src_partition", "src_offset", "pos"]
    return latest(d.flatten(messages), order=order).select(*TRADE_COLUMNS)


def upsert_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A word that comes more than once in a text keeps its last place."""
    order = ["src_partition", "src_offset", "pos"]
    return latest(d.flatten(_word_messages(spark, sf_dir)), order=order).select(*TRADE_COLUMNS)


def ttl_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live(feeds.event_trades(feeds.events(spark, sf_dir)), AS_OF).select(*TRADE_COLUMNS)


def _live_trades(
    spark: SparkSession, sf_dir: str, between_ms: tuple[int, int] | None = None
) -> DataFrame:
    rows = feeds.events(spark, sf_dir)
    if between_ms is not None:
        rows = rows.where(feeds.wall_between(*between_ms))
    return latest(feeds.event_trades(rows).drop("ingest_us")).select(*TRADE_COLUMNS)


def trades_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.by_symbol(_live_trades(spark, sf_dir), "click")


def latest_for_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.newest(_live_trades(spark, sf_dir), "click", 10)


def symbol_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.time_range(_live_trades(spark, sf_dir, RANGE_MS), "click", *RANGE_MS)


def timestamp_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trades at the newest timestamp of the whole table."""
    newest = feeds.events(spark, sf_dir).agg(F.max("ts").alias("ts"))  # from the files' footers
    newest_ms = newest.select(wall_ms("ts")).first()[0]
    return reads.at_timestamp(_live_trades(spark, sf_dir, (newest_ms, newest_ms)), newest_ms)


# -- the stored table ---------------------------------------------------------------


def _stored_halves(spark: SparkSession, sf_dir: str, registered: bool = False) -> TradeTable:
    """A table written in two batches, the first of them already compacted, at an earlier time.

    The batches have the even and the odd events, so they share keys and days. The offsets of
    the second are below those of the first: only the order of the batches lets it win.
    """
    table = TradeTable.create(spark, shared_dir(spark, "table"), buckets=4)
    rows = feeds.events(spark, sf_dir)
    for batch_id in (0, 1):
        half = rows.where(F.col("event_id") % 2 == batch_id)
        trades = feeds.event_trades(half, key_time=_hour_key()).drop("batch_id")
        kinds = trades.withColumns(
            {
                "src_offset": F.col("src_offset") if batch_id == 0 else -F.col("src_offset"),
                "kind": F.lit(KIND_TRADE),
                "reason": F.lit(None).cast("string"),
                "value": F.lit(None).cast("string"),
            }
        )
        table.append(kinds, batch_id)
        if batch_id == 0:
            table.compact(EARLIER)
            if registered:
                table.register_view(f"{table.name}_live", AS_OF)
    return table


def compact_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything compacted: one row per key, expired rows gone."""
    table = _stored_halves(spark, sf_dir)
    table.compact(AS_OF, full=True)
    return table.live(AS_OF).select(*TRADE_COLUMNS)


def merge_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table read while its second batch is still in the log."""
    return _stored_halves(spark, sf_dir).live(AS_OF).select(*TRADE_COLUMNS)


def dashboard_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL reader's view of one symbol in a time range, by its table function."""
    table = _stored_halves(spark, sf_dir)
    table.compact(AS_OF)
    table.register_view(f"{table.name}_live", AS_OF)
    return spark.sql(
        f"SELECT * FROM {table.name}_live_between({RANGE_MS[0]}, {RANGE_MS[1]}) WHERE symbol = 'click'"
    )


def dashboard_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain SQL over a view that was registered before the second batch came."""
    table = _stored_halves(spark, sf_dir, registered=True)
    first, last = map(day_of, RANGE_MS)
    return spark.sql(
        f"SELECT {', '.join(TRADE_COLUMNS)} FROM {table.name}_live WHERE symbol IN ('click', 'view') "
        f"AND timestamp BETWEEN {RANGE_MS[0]} AND {RANGE_MS[1]} AND day BETWEEN {first} AND {last}"
    )


def table_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four ways to read the stored table: a symbol, its newest, a range, one timestamp."""
    table = _stored_halves(spark, sf_dir)
    table.compact(AS_OF)
    rows = table.live(AS_OF)
    in_range = reads.time_range(table.live(AS_OF, between_ms=RANGE_MS), "view", *RANGE_MS)
    newest_ms = rows.agg(F.max("timestamp")).first()[0]
    found = {
        "symbol": reads.by_symbol(rows, "click"),
        "newest": reads.newest(rows, "error", 10),
        "range": in_range,
        "timestamp": reads.at_timestamp(rows, newest_ms),
    }
    labelled = [f.select(F.lit(n).alias("read"), *TRADE_COLUMNS) for n, f in found.items()]
    return reduce(DataFrame.unionByName, labelled)


def table_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored trades of a table of symbols: those that are more frequent than the mean."""
    table = _stored_halves(spark, sf_dir)
    table.compact(AS_OF)
    counts = feeds.events(spark, sf_dir).groupBy(F.col("event_type").alias("symbol")).count()
    mean = F.sum("count").over(Window.partitionBy()) / F.count("*").over(Window.partitionBy())
    frequent = counts.withColumn("mean", mean).where(F.col("count") > F.col("mean"))
    return table.of_symbols(frequent, AS_OF).select(*TRADE_COLUMNS)


def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key of the stored table, found by directory, statistics and Bloom filters."""
    table = _stored_halves(spark, sf_dir)
    table.compact(AS_OF, full=True)
    newest = feeds.events(spark, sf_dir).where("event_type = 'view'").agg(F.max("ts").alias("ts"))
    hour = newest.select(feeds.hour(wall_ms("ts"))).first()[0]
    found = reads.at_timestamp(reads.by_symbol(table.live(AS_OF), "view"), hour)
    return found.select(*TRADE_COLUMNS)


def bucketed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd events, then even ones, upserted into a table in buckets of the key; the odd ones come again.

    A later load has the smaller offsets, so only the order of the loads lets its rows win.
    """
    table = BucketedTrades(spark, shared_dir(spark, "bucketed"), buckets=8)
    rows = feeds.events(spark, sf_dir)
    for load in (1, 0, 1):
        half = feeds.event_trades(rows.where(F.col("event_id") % 2 == load), key_time=_hour_key())
        own = {"batch_id": F.lit(1 - load).cast("long"), "src_offset": -F.col("src_offset")}
        table.upsert(half.withColumns(own), AS_OF)
    return table.live(AS_OF).select(*TRADE_COLUMNS)


def bucketed_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three newest trades of every symbol of a table in buckets."""
    table = BucketedTrades(spark, shared_dir(spark, "bucketed"), buckets=8)
    table.upsert(feeds.event_trades(feeds.events(spark, sf_dir), key_time=_hour_key()), AS_OF)
    return table.newest(3, AS_OF).select(*TRADE_COLUMNS, "rank")


def table_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the table keeps of messages without trades and of trades without keys."""
    table = TradeTable.create(spark, shared_dir(spark, "rejects"), buckets=4)
    symbol = F.when(F.col("event_type") != "error", F.col("event_type"))
    messages = feeds.event_messages(feeds.events(spark, sf_dir), symbol=symbol, keep=("event_type",))
    records = messages.withColumn(
        "value", F.when(F.col("event_type") == "signup", "").otherwise(F.col("value"))
    )
    table.append(with_ingest_time(d.classify(records)), 0)
    table.compact()
    place = [F.col("src_offset").alias("event_id"), "reason"]
    return table.dead_letters().select(*place).unionByName(table.quarantined().select(*place))


# -- streaming ----------------------------------------------------------------------


def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of at most a third of their files a batch, decoded into parquet."""
    out = shared_dir(spark, "stream-decode")
    for load in range(3):
        feeds.event_load(spark, sf_dir, f"{out}/events", load)
    # a cap that does not grow with the files would make batches of one task, one after the other
    cap = -(-len(glob(spark, f"{out}/events/*.parquet")) // 3)
    trades = d.decode(feeds.event_messages(feeds.event_stream(spark, f"{out}/events", max_files=cap)))
    query = (
        trades.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(**ONCE)
        .start(f"{out}/trades")
    )
    wait([query])
    # a capped stream has more batches than one; what it wrote is complete all the same
    batches = F.lit(sum(p.numInputRows > 0 for p in query.recentProgress) > 1)
    return spark.read.schema(TRADE).parquet(f"{out}/trades").withColumn("capped", batches)


def stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw frames streamed into a stored topic, which is then decoded."""
    out = shared_dir(spark, "stream-publish")
    records = publish.trade_records(_frames(feeds.event_stream(spark, f"{sf_dir}/events.parquet")))
    query = (
        records.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(**ONCE)
        .start(f"{out}/topic")
    )
    wait([query])
    return _published(read_parquet(spark, f"{out}/topic", RECORD))


class _Interrupted(Exception):
    pass


class _FailsAfterSecondWrite(TradeTable):
    def append(self, rows, batch_id, rebalance=False):
        super().append(rows, batch_id, rebalance)
        if batch_id == 1:
            raise _Interrupted


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events streamed into a table load by load, failing after the second write.

    Three loads come one after the other; each is one batch of all its files, so its tasks
    run side by side, and the order of the batches is that of the loads. The third has come when
    the restart runs the second batch again. `delivered` counts the trades of all batches in the
    log, so a batch that was written twice shows, also where the upsert would hide it.
    """
    root = shared_dir(spark, "stream-upsert")
    table = TradeTable.create(spark, f"{root}/table", buckets=4)

    def run(into: TradeTable) -> None:
        stream = feeds.event_stream(spark, f"{root}/events")
        records = feeds.event_messages(stream, key_time=_hour_key())
        wait([table_sink(records, into, f"{root}/checkpoint", ONCE).start()])

    feeds.event_load(spark, sf_dir, f"{root}/events", 0)
    run(table)
    feeds.event_load(spark, sf_dir, f"{root}/events", 1)
    try:
        run(_FailsAfterSecondWrite(spark, table.root))
    except StreamingQueryException as failure:
        if _Interrupted.__name__ not in str(failure):
            raise
    feeds.event_load(spark, sf_dir, f"{root}/events", 2)
    run(table)
    delivered = table.deliveries().where(F.col("kind") == KIND_TRADE).agg(F.sum("rows").alias("delivered"))
    return table.live().select(*TRADE_COLUMNS).join(delivered)


def stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of events, one batch each, by a stream that is started anew for every load."""
    root = shared_dir(spark, "stream-changes")
    rows = feeds.events(spark, sf_dir)
    for load in range(3):
        rows.where(F.col("event_id") % 3 == load).write.mode("append").parquet(f"{root}/events")
        stream = feeds.event_stream(spark, f"{root}/events")
        written = F.timestamp_micros(wall_us("ts")).alias(WRITTEN)
        trades = feeds.event_trades(stream, key_time=_hour_key(), keep=(written,))
        wait([change_sink(trades, f"{root}/changes", f"{root}/checkpoint", ONCE).start()])
    changed = spark.read.parquet(f"{root}/changes")
    return changed.select((F.col("src_offset") % 3).alias("load"), *TRADE_COLUMNS)


def offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream lost: errors never arrive, views are control messages and no loss."""
    root = shared_dir(spark, "offset-gaps")
    table = TradeTable.create(spark, f"{root}/table", buckets=4)
    stream = feeds.event_stream(spark, f"{sf_dir}/events.parquet")
    messages = feeds.event_messages(stream, keep=("event_type",)).where("event_type <> 'error'")
    value = F.when(F.col("event_type") == "view", '{"type":"ping"}').otherwise(F.col("value"))
    wait([table_sink(messages.withColumn("value", value), table, f"{root}/checkpoint", ONCE).start()])
    return table.gaps()


class _FailsAtThirdBatch(TradeTable):
    def append(self, rows, batch_id, rebalance=False):
        if batch_id == 2:
            raise _Interrupted
        super().append(rows, batch_id, rebalance)


def backfill_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill in four slices, interrupted in the third, compacted, and run again to its end.

    `written` counts the trades that arrived in all batches, so a slice written twice shows.
    """
    root = shared_dir(spark, "backfill")
    table = TradeTable.create(spark, f"{root}/table", buckets=4)
    rows = feeds.events(spark, sf_dir)
    records = feeds.event_messages(rows, key_time=_hour_key())
    first, last = rows.agg(F.min("event_id"), F.max("event_id")).first()
    size = (last - first) // 4 + 1
    try:
        backfill(_FailsAtThirdBatch(spark, table.root), records, "events", size)
    except _Interrupted:
        table.compact()
    batches = len(backfill(table, records, "events", size))
    written = table.deliveries().agg(F.sum("rows").alias("written"))
    return table.live().select(*TRADE_COLUMNS, F.lit(batches).alias("resumed")).join(written)


class _RefusesOnce:
    """Writes batches of records to a folder, but fails before the first of them once."""

    def __init__(self, folder: str):
        self.folder = folder
        self.refused = False

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        if not self.refused:
            self.refused = True
            raise _Interrupted
        rows.write.mode("overwrite").parquet(f"{self.folder}/batch_id={batch_id}")


def publish_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a publishing stream reports: each batch's success, and the failure before it."""
    root = shared_dir(spark, "publish-deliveries")
    records = publish.trade_records(_frames(feeds.event_stream(spark, f"{sf_dir}/events.parquet")))
    write = _RefusesOnce(f"{root}/topic")
    target = f"topic-{root.rsplit('-', 1)[1]}"  # queries of a session have names of their own
    with DeliveryAudit(spark, f"{root}/audit", [target]) as audit:
        for _ in range(2):
            try:
                wait([publish_sink(records, write, target, f"{root}/checkpoint", ONCE).start()])
            except StreamingQueryException as failure:
                if _Interrupted.__name__ not in str(failure):
                    raise
    return audit.deliveries().groupBy(F.lit("topic").alias("target"), "outcome").agg(
        F.sum("records").alias("records"), F.count_distinct("batch_id").alias("batches")
    )


def delivery_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream delivered over all batches: errors have no symbol, signups are no JSON."""
    root = shared_dir(spark, "delivery")
    table = TradeTable.create(spark, f"{root}/table", buckets=4)
    symbol = F.when(F.col("event_type") != "error", F.col("event_type"))
    stream = feeds.event_stream(spark, f"{sf_dir}/events.parquet")
    messages = feeds.event_messages(stream, symbol=symbol, keep=("event_type",))
    records = messages.withColumn(
        "value", F.when(F.col("event_type") == "signup", "not JSON").otherwise(F.col("value"))
    )
    wait([table_sink(records, table, f"{root}/checkpoint", ONCE).start()])
    return table.deliveries().groupBy("src_partition", "kind").agg(
        F.sum("rows").alias("rows"),
        F.min("first_offset").alias("first_offset"),
        F.max("last_offset").alias("last_offset"),
    )


QUERIES = {
    query.__name__: query
    for query in (
        utf8_strict,
        publish_trades,
        publish_rejects,
        subscribe_symbols,
        subscribe_symbol_table,
        decode_trades,
        decode_nested,
        parse_props,
        preview,
        dead_letters,
        quarantine_keys,
        upsert_latest,
        upsert_nested,
        ttl_live,
        trades_by_symbol,
        latest_for_symbol,
        symbol_time_range,
        timestamp_lookup,
        compact_expire,
        merge_on_read,
        dashboard_view,
        dashboard_range,
        table_reads,
        table_rejects,
        table_symbols,
        key_lookup,
        bucketed_upsert,
        bucketed_newest,
        stream_decode,
        stream_publish,
        publish_deliveries,
        stream_upsert,
        delivery_metrics,
        stream_changes,
        offset_gaps,
        backfill_slices,
    )
}
