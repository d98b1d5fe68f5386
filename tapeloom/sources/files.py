"""File sources: stored topic rows and raw frames, as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tapeloom.sources import paths

# A stored copy of topic rows, in the topic source's own columns.
TOPIC_ROW = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def stream_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TOPIC_ROW,
    *,
    max_files_per_trigger: int | None = None,
    ignore_missing_files: bool = False,
) -> DataFrame:
    """A stream over the parquet files of a directory, or over one file.

    All files already there are read first; later starts go on from the checkpoint. A file
    that goes after its batch was listed fails the stream, unless missing files are ignored. One
    that is gone before that Spark leaves out in any case; deliveries have a gap in their offsets.
    """
    reader = (
        spark.readStream.schema(schema)
        .format("parquet")
        .option("ignoreMissingFiles", str(ignore_missing_files).lower())
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if paths.is_file(spark, path):
        # a stream over a plain file path is refused; the same path as a glob is not
        folder, _, name = path.rpartition("/")
        path = f"{folder}/{{{name}}}"
    return reader.load(path)


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType = TOPIC_ROW
) -> DataFrame:
    """The same stored rows as a batch, for a backfill."""
    return spark.read.schema(schema).parquet(path)


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    """Raw frames of text files, one frame a line, in the column `value`."""
    return spark.read.text(path)


def stream_frames(
    spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
