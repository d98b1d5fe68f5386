"""What became of a stream's batches, from the events that Spark gives of its progress.

A listener appends to one Parquet table: for a batch that is done, a row for each source, and for
a topic one for each of its partitions, with the range of offsets and what was counted in the
batch; for a query that failed, a row with the reason. Nothing is read or counted twice for it.
It is a report, made after the batch: a driver that is lost between the two leaves no row. What is
in the stored table its own `deliveries` say.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Collection
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tapeloom.functions.clock import MS_PER_DAY
from tapeloom.sources import paths

AUDIT = (
    "target string, query_id string, run_id string, batch_id long, outcome string, source string, topic string, "
    "src_partition int, first_offset long, last_offset long, observed map<string,bigint>, "
    "error_class string, error string, at_ms long, day int"
)
DELIVERED = "delivered"
FAILED = "failed"
SETTLE_SECONDS = 60
_BATCH = ["query_id", "batch_id"]


def offset_ranges(start: str | None, end: str | None) -> list[tuple]:
    """(topic, partition, first, last) of a source's offsets before and after a batch, as JSON.

    A topic's offsets are next ones by partition, and a partition that got nothing has no range. Where
    a partition begins in its first batch the events do not say: its first offset is null. A source
    that counts its files or batches has one range, without topic and partition.
    """
    # what is not there is told as the text of a missing value
    before, after = (json.loads(text) if text not in (None, "", "None") else None for text in (start, end))
    if not isinstance(after, dict):
        return [(None, None, before, after)] if isinstance(after, int) else []
    if "logOffset" in after:
        first = before["logOffset"] + 1 if before else 0
        return [(None, None, first, after["logOffset"])] if first <= after["logOffset"] else []
    found = []
    for topic, partitions in after.items():
        for partition, stop in partitions.items():
            first = ((before or {}).get(topic) or {}).get(partition)
            if first is None and stop > 0 or first is not None and first < stop:
                found.append((topic, int(partition), first, stop - 1))
    return sorted(found, key=lambda row: row[:2])


class DeliveryAudit(StreamingQueryListener):
    """Reports the batches of the session's named queries, of all of them or of those in `targets`.

    Used in a `with` statement it begins before the queries start, and at its end waits for the
    last reports of those that have ended.
    """

    def __init__(self, spark: SparkSession, path: str, targets: Collection[str] | None = None):
        self._session = spark
        self.path = path
        self.targets = targets
        self._names: dict[str, str] = {}  # of the runs that have begun and not ended
        self._reported: dict[str, int] = {}  # the last batch of a query
        self._changed = threading.Condition()
        self._fault: Exception | None = None

    def __enter__(self) -> DeliveryAudit:
        self._session.streams.addListener(self)
        return self

    def __exit__(self, *failure) -> None:
        try:
            active = {str(query.runId) for query in self._session.streams.active}
            self._settle(set(self._names) - active)
        finally:
            self._session.streams.removeListener(self)

    def settle(self, *queries: StreamingQuery) -> None:
        """Wait for the last reports of queries that have ended."""
        self._settle({str(query.runId) for query in queries})

    def _settle(self, runs: set[str]) -> None:
        with self._changed:
            done = self._changed.wait_for(lambda: not runs & set(self._names), SETTLE_SECONDS)
        if self._fault is not None:
            raise self._fault
        if not done:
            raise TimeoutError(f"no end reported of the runs {sorted(runs & set(self._names))}")

    # -- events ---------------------------------------------------------------------

    def onQueryStarted(self, event) -> None:
        if event.name and (self.targets is None or event.name in self.targets):
            self._names[str(event.runId)] = event.name

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        target = self._names.get(str(event.progress.runId))
        if target is not None:
            self._keep_fault(self._report_batch, target, event.progress)

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        target = self._names.get(run)
        if target is None:
            return
        if event.exception is not None:
            self._keep_fault(self._report_failure, target, event)
        with self._changed:
            del self._names[run]
            self._changed.notify_all()

    def _keep_fault(self, report, *of) -> None:
        try:
            report(*of)
        except Exception as fault:  # Spark would only log it; whoever waits for the reports gets it
            self._fault = fault

    def _report_batch(self, target: str, progress) -> None:
        observed = {
            name: value
            for metrics in progress.observedMetrics.values()
            for name, value in metrics.asDict().items()
            if isinstance(value, int)
        }
        at = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
        rows = [
            (source.description, *range_, observed, None, None)
            for source in progress.sources
            for range_ in offset_ranges(source.startOffset, source.endOffset) or [(None,) * 4]
        ]
        self._reported[str(progress.id)] = progress.batchId
        self._add(target, progress.id, progress.runId, progress.batchId, DELIVERED, at, rows)

    def _report_failure(self, target: str, event) -> None:
        # batches are done one by one, so it was the one after the last that is reported
        batch_id = self._last(str(event.id)) + 1
        row = (None, None, None, None, None, {}, event.errorClassOnException, event.exception)
        self._add(target, event.id, event.runId, batch_id, FAILED, datetime.now(timezone.utc), [row])

    def _last(self, query_id: str) -> int:
        if query_id not in self._reported:
            found = None
            if paths.glob(self._session, f"{self.path}/day=*"):
                done = self.read().where((F.col("query_id") == query_id) & (F.col("outcome") == DELIVERED))
                found = done.agg(F.max("batch_id")).first()[0]
            self._reported[query_id] = -1 if found is None else found
        return self._reported[query_id]

    def _add(self, target, query_id, run_id, batch_id, outcome, at: datetime, rows: list[tuple]) -> None:
        at_ms = int(at.timestamp() * 1000)
        told = [
            (target, str(query_id), str(run_id), batch_id, outcome, *row, at_ms, at_ms // MS_PER_DAY) for row in rows
        ]
        frame = self._session.createDataFrame(told, AUDIT).coalesce(1)
        frame.write.mode("append").partitionBy("day").parquet(self.path)

    # -- reads ----------------------------------------------------------------------

    def read(self) -> DataFrame:
        """All reports: batches by source and partition, and failures."""
        return self._session.read.schema(AUDIT).parquet(self.path)

    def ranges(self) -> DataFrame:
        """The offsets that each batch took, by source and partition, once however often it was run."""
        place = [*_BATCH, "target", "source", "topic", "src_partition"]
        done = self.read().where((F.col("outcome") == DELIVERED) & F.col("last_offset").isNotNull())
        return done.groupBy(*place).agg(
            F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset")
        )

    def deliveries(self) -> DataFrame:
        """One row for each batch that is done, with its count of records, and one for each failure."""
        records = F.coalesce(F.element_at("observed", "records"), F.lit(0))
        columns = ["batch_id", "target", "outcome", "records", "error_class", "error"]
        told = self.read().withColumn("records", records)
        done = told.where(F.col("outcome") == DELIVERED).groupBy(*_BATCH, "target", "outcome")
        done = done.agg(
            F.max("records").alias("records"),
            F.max("error_class").alias("error_class"),
            F.max("error").alias("error"),
        )
        return done.select(columns).unionByName(told.where(F.col("outcome") == FAILED).select(columns))

    def fold(self, before: datetime | None = None) -> list[int]:
        """Make one file of each day that has passed, which no event is added to any more; gives those days."""
        today = int((before or datetime.now(timezone.utc)).timestamp() * 1000) // MS_PER_DAY
        files = paths.glob(self._session, f"{self.path}/day=*/*.parquet")
        days = [int(file.rsplit("/day=", 1)[1].split("/")[0]) for file in files]
        many = sorted({day for day in days if day < today and days.count(day) > 1})
        if many:
            rows = self.read().where(F.col("day").isin(many))
            write = rows.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            write.partitionBy("day").parquet(self.path)
        return many
