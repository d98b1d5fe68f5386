"""The keyed table in buckets of its key: an upsert shuffles what is new, and never what is stored.

A Parquet table of Spark's catalog, in directories of a day and, within them, buckets by a hash of
symbol and timestamp, sorted by both. A bucket is a task of the scan and of the write, in all
days at once, so stored rows meet new ones where they already are. The whole key is hashed: a
symbol that has a third of all rows is spread like any other, which buckets of symbols would
not do. `TradeTable` reads a symbol from few directories and takes many small batches in its
log; this one suits large loads into a table that is far larger than they are.

Rows carry their write order, so a load that comes again, or loads that come out of order, change
nothing. Days are replaced each for itself when all of them are written; a load that was cut off
there is run again.
"""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.functions.clock import MS_PER_DAY, epoch_us
from tapeloom.functions.placement import day, day_of
from tapeloom.operators.upsert import TTL_SECONDS, latest, live
from tapeloom.schemas import BUCKETED, KEY, TRADE_COLUMNS, WRITE_ORDER
from tapeloom.sources import paths

_REST = [name for name in BUCKETED.fieldNames() if name not in [*KEY, "day"]]


class BucketedTrades:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        buckets: int = 200,
        ttl_seconds: int = TTL_SECONDS,
        name: str | None = None,
    ):
        """Declare the table if it is absent; one that the catalog knows keeps its buckets.

        Take as many buckets as make one of them, over the days that a load touches, a task's
        worth. Where they equal `spark.sql.shuffle.partitions`, new rows are shuffled once only.
        """
        self.spark = spark
        self.root = root.rstrip("/")
        self.name = name or f"bucketed_{hashlib.md5(self.root.encode()).hexdigest()[:12]}"
        self.ttl_seconds = ttl_seconds
        if not spark.catalog.tableExists(self.name):
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BUCKETED)
            keys = ", ".join(KEY)
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet "
                f"OPTIONS ('partitionOverwriteMode' 'dynamic') PARTITIONED BY (day) "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{self.root}'"
            )
            if paths.glob(spark, f"{self.root}/day=*"):
                spark.sql(f"MSCK REPAIR TABLE {self.name}")

    def upsert(self, trades: DataFrame, as_of: datetime | None = None) -> list[int]:
        """Write the newest row of each key, from trades with their write order and `ingest_us`.

        Of a stored row and a new one the greater write order wins, nulls included. Only the days
        with new rows are rewritten, without what has expired by `as_of`; gives those days. A
        first pass finds them from the timestamps alone.
        """
        as_of = as_of or datetime.now(timezone.utc)
        placed = trades.withColumn("day", day())
        touched = sorted(row["day"] for row in placed.select("day").distinct().collect())
        if touched:
            merged = live(self._merge(placed, touched), as_of, self.ttl_seconds)
            rows = merged.sortWithinPartitions("day", *KEY)
            rows.select(BUCKETED.fieldNames()).write.mode("overwrite").insertInto(self.name)
        return touched

    def _merge(self, placed: DataFrame, days: list[int]) -> DataFrame:
        """Stored and new rows of the days, one per key.

        A full join on exactly the columns of the buckets: it takes the stored rows as they lie,
        and sends the new ones, one per key already, to them. The day follows from the timestamp.
        """
        fresh = latest(placed.select(BUCKETED.fieldNames()), KEY, WRITE_ORDER)
        held = self._read().where(F.col("day").isin(days))
        new, old = (
            rows.select(*KEY, F.struct("day", *_REST).alias(side))
            for rows, side in ((fresh, "new"), (held, "old"))
        )
        order = [F.struct(*[f"{side}.{name}" for name in WRITE_ORDER]) for side in ("new", "old")]
        wins = F.col("old").isNull() | (F.col("new").isNotNull() & (order[0] >= order[1]))
        row = F.when(wins, F.col("new")).otherwise(F.col("old"))
        both = old.join(new, KEY, "full").select(*KEY, row.alias("row"))
        return both.select(*KEY, *[F.col(f"row.{name}").alias(name) for name in ("day", *_REST)])

    def live(self, as_of: datetime | None = None, between_ms: tuple[int, int] | None = None) -> DataFrame:
        """The visible trades, with their `day`; a range of timestamps selects directories."""
        rows = self._read()
        if between_ms is not None:
            first, last = map(day_of, between_ms)
            rows = rows.where(F.col("timestamp").between(*between_ms) & F.col("day").between(first, last))
        return live(rows, as_of, self.ttl_seconds).select(*TRADE_COLUMNS, "day")

    def of_key(self, symbol: str, timestamp_ms: int, as_of: datetime | None = None) -> DataFrame:
        """The trade of one key, from the files of one day.

        Spark selects single buckets by one column only, so each bucket of the day is asked; their
        files are sorted by key, so the statistics leave out all row groups but one at most of each.
        """
        found = self.live(as_of, (timestamp_ms, timestamp_ms))
        return found.where(F.col("symbol") == symbol)

    def of_keys(self, keys: DataFrame, as_of: datetime | None = None) -> DataFrame:
        """The trades of a table of keys; if it is large it alone is shuffled."""
        return self.live(as_of).join(keys.select(*KEY).distinct(), KEY, "left_semi")

    def newest(self, n: int, as_of: datetime | None = None) -> DataFrame:
        """The n newest trades of every symbol, with their rank, of symbols with few or very many.

        Each bucket first keeps its own n newest of a symbol, where its rows lie, so a symbol
        sends no more than n rows a bucket to the task that ranks them.
        """
        newest = Window.partitionBy("symbol").orderBy(F.desc("timestamp"))
        ranked = self.live(as_of).withColumn("rank", F.row_number().over(newest))
        # Spark takes the bound into each task, before the shuffle
        return ranked.where(F.col("rank") <= n)

    def expire(self, as_of: datetime | None = None) -> list[int]:
        """Let the days go that hold no live row; gives them. Only days before the lifetime's begin can."""
        as_of = as_of or datetime.now(timezone.utc)
        oldest = day_of(epoch_us(as_of) // 1000) - -(-self.ttl_seconds * 1000 // MS_PER_DAY)
        partitions = [row[0] for row in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()]
        old = {int(p.split("=")[1]) for p in partitions if int(p.split("=")[1]) < oldest}
        if not old:
            return []
        rows = live(self._read().where(F.col("day").isin(sorted(old))), as_of, self.ttl_seconds)
        gone = sorted(old - {row["day"] for row in rows.select("day").distinct().collect()})
        for own_day in gone:  # first from the catalog, so that no reader looks for the files
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (day = '{own_day}')")
            paths.remove(self.spark, f"{self.root}/day={own_day}")
        return gone

    def _read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)
