"""The trade table: an append log of write batches, folded at intervals into a partitioned table.

    <root>/properties               lifetime and bucket count, fixed at creation
    <root>/log/batch_id=N/kind=K/day=D
                                    rows of write batch N; a replayed batch replaces itself
    <root>/stored/day=D/symbol_bucket=B
                                    compacted trades, one per key
    <root>/rejected, <root>/delivered
                                    dead letters and badly keyed trades of compacted batches,
                                    and what those batches delivered, by ranges of batches

All four are Parquet tables of Spark's catalog, so SQL sees new batches when they are written.
Compaction overwrites the partitions that new batches touch, by dynamic partition overwrite,
and then lets the folded batches go, oldest first. What it has folded it may fold again: until a
batch is gone from the log, its rows in the log hide those in the stored table. So a
compaction that was cut off is simply run again. There is one writer and one compaction at a time.
"""

from __future__ import annotations

import hashlib
import re
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tapeloom.functions.clock import MS_PER_DAY, epoch_us, instant_us
from tapeloom.functions.placement import bucket_sql, day, day_of, day_sql, symbol_bucket
from tapeloom.operators import offsets
from tapeloom.operators.decode import dead_letters, quarantined
from tapeloom.operators.upsert import TTL_SECONDS, latest, live
from tapeloom.schemas import (
    DELIVERY,
    KEY,
    KIND_CONTROL,
    KIND_RUN,
    KIND_TRADE,
    LOG,
    REJECTED,
    STORED,
    TRADE_COLUMNS,
    WRITE_ORDER,
)
from tapeloom.sources import paths

PLACE = ["day", "symbol_bucket"]
_PARTS = {
    "log": (LOG, ["batch_id", "kind", "day"]),
    "stored": (STORED, PLACE),
    "rejected": (REJECTED, ["batches"]),
    "delivered": (DELIVERY, ["batches"]),
}
NO_DAY = -2  # of rows that are not trades
BATCHES = 1000  # batches whose rejects and deliveries share a directory

# Options of every part: an insert replaces the partitions it has rows for, and no others.
# Where a row group holds many keys, its Bloom filters tell which it does not hold.
_OPTIONS = {"partitionOverwriteMode": "dynamic"}
_KEY_FILTERS = {
    f"parquet.bloom.filter.{option}#{column}": value
    for column in KEY
    for option, value in (("enabled", "true"), ("adaptive.enabled", "true"))
}


class TradeTable:
    def __init__(self, spark: SparkSession, root: str, name: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.name = name or f"trades_{hashlib.md5(self.root.encode()).hexdigest()[:12]}"
        properties = spark.read.schema("ttl_seconds long, buckets int").json(
            f"{self.root}/properties"
        ).first()
        self.ttl_seconds = properties["ttl_seconds"]
        self.buckets = properties["buckets"]
        self._last_batch: int | None = None
        for part, (schema, partitioning) in _PARTS.items():
            if not spark.catalog.tableExists(self._table(part)):
                self._declare(part, schema, partitioning)

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        root: str,
        ttl_seconds: int = TTL_SECONDS,
        buckets: int = 16,
        name: str | None = None,
    ) -> TradeTable:
        """Create the table if it is absent; an existing one keeps its properties.

        `name` is how its parts begin in the catalog, such as `market.trades`. A catalog that
        outlives the session knows them from then on; in a session's own catalog they are
        declared again, and what lies in the folders is found.
        """
        root = root.rstrip("/")
        if not paths.glob(spark, f"{root}/properties/_SUCCESS"):  # nor cut off while written
            properties = spark.range(1, numPartitions=1).select(
                F.lit(ttl_seconds).alias("ttl_seconds"), F.lit(buckets).alias("buckets")
            )
            properties.write.mode("overwrite").json(f"{root}/properties")
        return cls(spark, root, name)

    def _table(self, part: str) -> str:
        return f"{self.name}_{part}"

    def _declare(self, part: str, schema: StructType, partitioning: list[str]) -> None:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        chosen = _OPTIONS | (_KEY_FILTERS if part == "stored" else {})
        options = ", ".join(f"'{key}' '{value}'" for key, value in chosen.items())
        folder = f"{self.root}/{part}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._table(part)} ({columns}) USING parquet OPTIONS ({options}) "
            f"PARTITIONED BY ({', '.join(partitioning)}) LOCATION '{folder}'"
        )
        if paths.glob(self.spark, f"{folder}/{partitioning[0]}=*"):
            self.spark.sql(f"MSCK REPAIR TABLE {self._table(part)}")

    def _read(self, part: str) -> DataFrame:
        # files of a partition may have been replaced by another session, such as a stream's
        self.spark.catalog.refreshTable(self._table(part))
        return self.spark.table(self._table(part))

    def _insert(self, rows: DataFrame, part: str) -> None:
        rows.select(_PARTS[part][0].fieldNames()).write.mode("overwrite").insertInto(self._table(part))

    def _partitions(self, part: str) -> list[dict[str, str]]:
        """The partitions of a part, as values by name: metadata of the catalog only."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self._table(part)}").collect()
        return [dict(p.split("=", 1) for p in row[0].split("/")) for row in rows]

    def _drop(self, part: str, **of: int) -> None:
        """Let partitions go: first from the catalog, so that no reader looks for their files."""
        wanted = {name: str(value) for name, value in of.items()}
        held = [p for p in self._partitions(part) if wanted.items() <= p.items()]
        if held:
            specs = [", ".join(f"{name} = '{value}'" for name, value in p.items()) for p in held]
            dropped = ", ".join(f"PARTITION ({spec})" for spec in specs)
            self.spark.sql(f"ALTER TABLE {self._table(part)} DROP IF EXISTS {dropped}")
        folder = "/".join(f"{name}={value}" for name, value in of.items())
        paths.remove(self.spark, f"{self.root}/{part}/{folder}")

    # -- writes ---------------------------------------------------------------------

    def append(self, rows: DataFrame, batch_id: int, rebalance: bool = False) -> None:
        """Write one batch of classified rows with `ingest_us`; writing it again replaces it.

        All kinds of rows go out in a single pass. The order groups the kinds, so the writer
        needs no sort of its own, and gives the files of the trades narrow key ranges.
        `rebalance` shuffles a batch of many small source partitions into files of even
        size. Batch ids must not go back: rows of an older id would win over newer ones. The
        last batch may come again, as after a restart; if it is already compacted, it
        must be the same rows, and nothing is written.
        """
        in_log, last = self._log_batches(), self.last_batch()
        if batch_id < last:
            raise ValueError(
                f"batch {batch_id} comes after batch {last}: was the stream's checkpoint lost?"
            )
        if batch_id in in_log:
            self._drop("log", batch_id=batch_id)
        elif batch_id == last:
            self._refuse_other_rows(rows, batch_id)
            return
        if rebalance:
            rows = rows.hint("rebalance")
        own_day = F.when(F.col("kind") == KIND_TRADE, day()).otherwise(NO_DAY)
        placed = rows.withColumns({"batch_id": F.lit(batch_id).cast("long"), "day": own_day})
        self._insert(placed.sortWithinPartitions("kind", "day", *KEY), "log")
        self._last_batch = batch_id

    def _refuse_other_rows(self, rows: DataFrame, batch_id: int) -> None:
        before = self.deliveries().where(F.col("batch_id") == batch_id)
        again = _delivered(rows.withColumn("batch_id", F.lit(batch_id).cast("long")))
        # one row for each source partition and kind on either side
        if not before.exceptAll(again).unionByName(again.exceptAll(before)).isEmpty():
            raise ValueError(
                f"batch {batch_id} is already compacted, with other rows: was the stream's checkpoint lost?"
            )

    def has_batch(self, batch_id: int) -> bool:
        """Whether a batch is written, be it in the log or compacted."""
        if batch_id in self._log_batches():
            return True
        of = (F.col("batches") == batch_id // BATCHES) & (F.col("batch_id") == batch_id)
        return not self._read("delivered").where(of).isEmpty()

    def _log_batches(self) -> list[int]:
        return sorted({int(p["batch_id"]) for p in self._partitions("log")})

    def last_batch(self) -> int:
        """The last batch in the log, or that this object wrote or found compacted; -1 if there is none."""
        return max([self._last_folded(), *self._log_batches()])

    def _last_folded(self) -> int:
        if self._last_batch is None:
            newest = max([int(p["batches"]) for p in self._partitions("delivered")], default=None)
            found = None
            if newest is not None:
                found = self._read("delivered").where(F.col("batches") == newest).agg(F.max("batch_id")).first()[0]
            self._last_batch = -1 if found is None else found
        return self._last_batch

    def compact(self, as_of: datetime | None = None, full: bool = False) -> list[int]:
        """Fold the batches of the log into the stored table, without expired rows.

        Only the days with new rows are rewritten, or all of them if `full`; gives those
        days. Days before the lifetime's begin are let go if no row in them was written since.
        If it fails, the old days stay or are hidden by the log, and it can be run again.
        """
        as_of = as_of or datetime.now(timezone.utc)
        held = self._partitions("log")
        batches = sorted({int(p["batch_id"]) for p in held})
        touched = {int(p["day"]) for p in held if p["kind"] == KIND_TRADE}
        if full:
            touched |= {int(p["day"]) for p in self._partitions("stored")}
        if batches:
            log = self._read("log").where(F.col("batch_id") <= batches[-1])
            if {p["kind"] for p in held} - {KIND_TRADE, KIND_CONTROL}:
                self._fold(log.where(~F.col("kind").isin(KIND_TRADE, KIND_CONTROL)), "rejected", [*WRITE_ORDER, "kind"])
            self._fold(_deliveries(log), "delivered", ["batch_id", "src_partition", "kind", "first_offset"])
        if touched:
            self._rewrite(sorted(touched), batches[-1] if batches else -1, as_of)
        for batch_id in batches:
            self._drop("log", batch_id=batch_id)
        self._expire(as_of)
        return sorted(touched)

    def _rewrite(self, days: list[int], through: int, as_of: datetime) -> None:
        of_days = F.col("day").isin(days)
        log = self._read("log").where((F.col("kind") == KIND_TRADE) & (F.col("batch_id") <= through) & of_days)
        before = self._files(days)
        merged = self._merge(self._stored().where(of_days), log, as_of)
        self._insert(
            # splits a hot symbol's directory over many tasks, and joins small ones
            merged.hint("rebalance", *PLACE).sortWithinPartitions(*PLACE, "symbol", F.desc("timestamp")),
            "stored",
        )
        # an insert leaves alone what it has no rows for: all that was there has expired
        for (own_day, bucket), files in self._files(days).items():
            if files == before.get((own_day, bucket)):
                self._drop("stored", day=own_day, symbol_bucket=bucket)

    def _files(self, days: list[int]) -> dict[tuple[int, int], list[str]]:
        """The files of the stored table's days by directory."""
        found: dict[tuple[int, int], list[str]] = {}
        for own_day in days:
            for path in paths.glob(self.spark, f"{self.root}/stored/day={own_day}/symbol_bucket=*/*.parquet"):
                bucket = int(re.search(r"/symbol_bucket=(\d+)/", path).group(1))
                found.setdefault((own_day, bucket), []).append(path)
        return found

    def _expire(self, as_of: datetime) -> None:
        oldest = day_of(epoch_us(as_of) // 1000) - -(-self.ttl_seconds * 1000 // MS_PER_DAY)
        old = {int(p["day"]) for p in self._partitions("stored") if int(p["day"]) < oldest}
        if not old:
            return
        # one row a day; row groups without a live row are left out by their statistics
        rows = live(self._read("stored").where(F.col("day").isin(sorted(old))), as_of, self.ttl_seconds)
        for day_ in sorted(old - {row["day"] for row in rows.select("day").distinct().collect()}):
            self._drop("stored", day=day_)

    def _fold(self, rows: DataFrame, part: str, keys: list[str]) -> None:
        """Add rows of batches to a part, once however often they come."""
        rows = rows.withColumn("batches", F.floor(F.col("batch_id") / BATCHES))
        names = _PARTS[part][0].fieldNames()
        touched = sorted({batch // BATCHES for batch in self._log_batches()})
        held = self._read(part).where(F.col("batches").isin(touched))
        rest = [name for name in names if name not in [*keys, "batches"]]
        both = held.select(names).unionByName(rows.select(names))
        once = both.groupBy(*keys, "batches").agg(F.max(F.struct(*rest)).alias("row")).select(
            *keys, "batches", *[F.col(f"row.{name}") for name in rest]
        )
        self._insert(once, part)

    # -- reads ----------------------------------------------------------------------

    def live(
        self, as_of: datetime | None = None, between_ms: tuple[int, int] | None = None
    ) -> DataFrame:
        """The visible trades: one row per key, not expired at `as_of`, by default the time of the query.

        `as_of` must not lie before that of the last compaction, which drops what expired.
        Besides the public columns it has `day` and `symbol_bucket`. Predicates on `symbol`
        or `timestamp` select directories by themselves, and so does a range of `day`, or of
        timestamps as `between_ms`. Only the days that the log holds rows of take part in
        a join; the others are just scanned.
        """
        held = {int(p["day"]) for p in self._partitions("log") if p["kind"] == KIND_TRADE}
        log, stored = self._read("log").where(F.col("kind") == KIND_TRADE), self._stored()
        if between_ms is not None:
            first, last = map(day_of, between_ms)
            in_range = F.col("timestamp").between(*between_ms) & F.col("day").between(first, last)
            log, stored = log.where(in_range), stored.where(in_range)
            held = {day_ for day_ in held if first <= day_ <= last}
        touched = F.col("day").isin(sorted(held))
        rest = live(stored.where(~touched) if held else stored, as_of, self.ttl_seconds)
        rows = rest.select(*TRADE_COLUMNS, *PLACE)
        if not held:
            return rows
        merged = self._merge(stored.where(touched), log, as_of)
        return merged.select(*TRADE_COLUMNS, *PLACE).unionByName(rows)

    def of_symbols(self, symbols: DataFrame, as_of: datetime | None = None) -> DataFrame:
        """The visible trades of the symbols in a table's column `symbol`.

        The buckets of the wanted symbols become a pruning subquery, so directories that hold
        none of them are not read. Whether the symbols are broadcast is Spark's choice by their
        size; if they are too many for that, both sides are shuffled and all buckets are read.
        """
        # no key is empty; the comparison tells Spark that the table of symbols selects
        wanted = symbols.select("symbol").where("symbol > ''").distinct()
        placed = wanted.withColumn("symbol_bucket", symbol_bucket(self.buckets))
        return self.live(as_of).join(placed, ["symbol", "symbol_bucket"], "left_semi").select(*TRADE_COLUMNS, *PLACE)

    def view_sql(self, as_of: datetime | None = None) -> str:
        """The live trades in SQL over the catalog's tables: what it shows is what is there when it is asked."""
        rest = [name for name in STORED.fieldNames() if name not in [*KEY, *PLACE]]
        now = "unix_micros(current_timestamp())" if as_of is None else str(epoch_us(as_of))
        log, stored = self._table("log"), self._table("stored")
        own = ", ".join(f"s.{name}" for name in STORED.fieldNames())
        folded = ", ".join(f"row.{name}" if name in rest else name for name in STORED.fieldNames())
        return f"""
            WITH fresh AS (SELECT * FROM {log} WHERE kind = '{KIND_TRADE}'),
            newest AS (
              SELECT symbol, timestamp, day, {bucket_sql(self.buckets)} AS symbol_bucket,
                max(struct({", ".join(WRITE_ORDER + rest)})) AS row
              FROM fresh GROUP BY symbol, timestamp, day),
            touched AS (SELECT DISTINCT day FROM fresh),
            rows AS (
              SELECT /*+ BROADCAST(t) */ {own} FROM {stored} s LEFT ANTI JOIN touched t ON s.day = t.day
              UNION ALL
              SELECT {own} FROM (
                SELECT /*+ BROADCAST(t) */ s.* FROM {stored} s LEFT SEMI JOIN touched t ON s.day = t.day) s
              LEFT ANTI JOIN newest n ON s.symbol = n.symbol AND s.timestamp = n.timestamp AND s.day = n.day
              UNION ALL
              SELECT {folded} FROM newest)
            SELECT {", ".join(TRADE_COLUMNS + PLACE)} FROM rows
            WHERE ingest_us > {now} - {self.ttl_seconds * 1_000_000}
              AND symbol_bucket = {bucket_sql(self.buckets)} AND day = {day_sql()}"""

    def register_view(self, name: str = "trades", as_of: datetime | None = None) -> None:
        """Offer the live trades to SQL readers, as a view of the catalog and two table functions.

        Who asks the view later sees later batches, expiry and compactions. `symbol = x`,
        `timestamp = x` and ranges of `day`, the number of days since 1970, select directories; a
        range of `timestamp` alone leaves out the other days' row groups by their statistics.
        `trades_between(first_ms, last_ms)` says both ranges at once, `trades_of(array('A', 'B'))`
        names several symbols. Days are bounded in number, so those of the log may be broadcast.
        """
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {self.view_sql(as_of)}")
        columns = ", ".join(TRADE_COLUMNS)
        self.spark.sql(f"""
            CREATE OR REPLACE TEMPORARY FUNCTION {name}_between(first_ms BIGINT, last_ms BIGINT)
            RETURNS TABLE RETURN SELECT {columns} FROM {name}
            WHERE timestamp BETWEEN first_ms AND last_ms
            AND day BETWEEN {day_sql("first_ms")} AND {day_sql("last_ms")}""")
        self.spark.sql(f"""
            CREATE OR REPLACE TEMPORARY FUNCTION {name}_of(symbols ARRAY<STRING>)
            RETURNS TABLE RETURN SELECT {columns} FROM {name}
            WHERE array_contains(symbols, symbol) AND array_contains(
            transform(symbols, s -> {bucket_sql(self.buckets, "s")}), symbol_bucket)""")

    def dead_letters(self) -> DataFrame:
        return dead_letters(self._rejected())

    def quarantined(self) -> DataFrame:
        return quarantined(self._rejected())

    def deliveries(self) -> DataFrame:
        """Rows and offsets delivered per write batch, source partition and kind of row.

        A trade message has a row for each of its trades; any other message has one row, and so
        has a control message. So every record that arrived is in the offsets of some kind.
        """
        return self._delivered().where(F.col("kind") != KIND_RUN)

    def delivered_runs(self) -> DataFrame:
        """The runs of offsets that arrived, per write batch and source partition, cut at blocks of offsets."""
        return self._delivered().where(F.col("kind") == KIND_RUN).drop("kind")

    def gaps(self) -> DataFrame:
        """The offsets between the first and the last that never arrived, over all batches."""
        return offsets.gaps(self.delivered_runs())

    def batch(self, batch_id: int) -> DataFrame:
        """The trades of one write batch still in the log, before any upsert."""
        of = (F.col("batch_id") == batch_id) & (F.col("kind") == KIND_TRADE)
        return self._read("log").where(of).select(*TRADE_COLUMNS)

    # -- parts ----------------------------------------------------------------------

    def _stored(self) -> DataFrame:
        # True of every row; with `symbol = x` or `timestamp = x` it becomes a predicate on
        # the directories, also for readers who only know the public columns
        placed = (F.col("symbol_bucket") == symbol_bucket(self.buckets)) & (F.col("day") == day())
        return self._read("stored").where(placed)

    def _merge(self, base: DataFrame, log: DataFrame, as_of: datetime | None) -> DataFrame:
        # A key in the log hides its row in the base: batches in the log are newer, or the very
        # ones the base has it from. So the base, already one row per key, is not folded again.
        # Its keys come from the folded rows, so the log is shuffled once, and while Spark finds
        # them below the broadcast threshold the base is not shuffled at all. Both callers give
        # as base only the days that the log touches.
        columns = STORED.fieldNames()
        trades = log.select([c for c in LOG.fieldNames() if c not in ("kind", "reason", "value")])
        newest = latest(trades, [*KEY, "day"], WRITE_ORDER)
        newest = newest.withColumn("symbol_bucket", symbol_bucket(self.buckets)).select(columns)
        kept = base.join(newest.select(*KEY, "day"), [*KEY, "day"], "left_anti").select(columns)
        return live(kept, as_of, self.ttl_seconds).unionByName(live(newest, as_of, self.ttl_seconds))

    def _rejected(self) -> DataFrame:
        log = self._read("log").where(~F.col("kind").isin(KIND_TRADE, KIND_CONTROL)).drop("day")
        batches = self._log_batches()
        # a batch that is folded but not yet gone from the log shows once
        done = self._read("rejected").where(~F.col("batch_id").isin(batches)) if batches else self._read("rejected")
        return done.drop("batches").unionByName(log)

    def _delivered(self) -> DataFrame:
        batches, done = self._log_batches(), self._read("delivered").drop("batches")
        if not batches:
            return done
        return done.where(~F.col("batch_id").isin(batches)).unionByName(_deliveries(self._read("log")))


def _delivered(log: DataFrame) -> DataFrame:
    return log.groupBy("batch_id", "src_partition", "kind").agg(
        F.count("*").alias("rows"),
        F.min("src_offset").alias("first_offset"),
        F.max("src_offset").alias("last_offset"),
    )


def _deliveries(log: DataFrame) -> DataFrame:
    """What batches delivered, by kind, and their runs of offsets, in which a message counts once."""
    messages = log.where("pos is null or pos = 0").select("batch_id", "src_partition", "src_offset")
    runs = offsets.pieces(messages, "batch_id").withColumn("kind", F.lit(KIND_RUN))
    counts = _delivered(log)
    return counts.unionByName(runs.select(counts.columns))


def with_ingest_time(classified: DataFrame) -> DataFrame:
    """Classified rows with their write time; in a stream this is the batch's own time."""
    return classified.withColumn("ingest_us", instant_us())
