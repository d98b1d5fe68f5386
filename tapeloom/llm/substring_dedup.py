"""Substring dedup: passages that came before, in any document, are removed from later ones.

Units are lines, and lines of `min_words` or more are cut further where their own words say so:
after a word whose hash is smaller than those of the words around it. Such cuts depend on a few
words only, so a passage is cut alike wherever it stands, in the middle of a line too. Units are
normalised (A-Z lower-cased, white space between words made one space) and hashed; equal
digests are one group over all documents, whose earliest unit by document and place stays.
A whole line that came before goes, however short. Of pieces cut inside lines a few common words
are no passage: they go where they and neighbouring units that came before have `min_words`
together. Neighbouring units to be removed make a span. Offsets are those of the original
text, in code points.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.spans import redact
from tapeloom.llm.words import only, raw_texts, unused
from tapeloom.sources.paths import shared_dir

REACH = 4  # words to either side that a cut is smaller than
MIN_WORDS = 8
CACHED_WORDS = 300_000
CACHED_BYTES = 64
UNITS_OUT = 1 << 16
UNIT = (
    "row long, doc_id long, unit int, start int, stop int, words int, whole boolean, digest long, check int"
)


class CutHashes(dict):
    """A 32-bit hash of a word, the same on every machine; kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.md5(word).digest()[:4], "big")
        if len(word) <= CACHED_BYTES:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = value
        return value


def cut_after(hashes: np.ndarray, lines: np.ndarray, short: np.ndarray) -> np.ndarray:
    """Whether a unit ends with each word: at a line's end, or at a strict local minimum of a line not short."""
    count = len(hashes)
    cuts = ~short
    for distance in range(1, min(REACH, count - 1) + 1):
        apart = lines[distance:] != lines[:-distance]
        left, right = hashes[:-distance], hashes[distance:]
        cuts[:-distance] &= apart | (left < right)
        cuts[distance:] &= apart | (right < left)
    cuts[:-1] |= lines[1:] != lines[:-1]
    cuts[-1:] = True
    return cuts


def units_of(raw: bytes, hash_of: CutHashes, min_words: int = MIN_WORDS) -> Iterator[tuple]:
    """The units of a text: number, start, stop, words, if a short line, and two parts of the digest."""
    words = raw.lower().split()
    if not words:
        return
    codes = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    edges = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    lines = np.searchsorted(np.flatnonzero(codes == 10), starts)
    short = np.bincount(lines)[lines] < min_words
    hashes = np.fromiter(map(hash_of.__getitem__, words), np.uint32, len(words))
    first = 0
    for number, last in enumerate(np.flatnonzero(cut_after(hashes, lines, short)).tolist()):
        digest = xxhash.xxh3_128_intdigest(b" ".join(words[first : last + 1]))
        yield (
            number, int(starts[first]), int(stops[last]), last + 1 - first, bool(short[last]),
            (digest & (1 << 64) - 1) - (1 << 63), (digest >> 64 & (1 << 32) - 1) - (1 << 31),
        )
        first = last + 1


def find_units(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The units of all texts. `rows` has the columns row, doc_id and text."""
    names = [field.split()[0] for field in UNIT.split(", ")]
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.bool_(), pa.int64(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hash_of = CutHashes()
        for batch in batches:
            found: list[tuple] = []
            keys = zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist())
            for (row, doc_id), raw in zip(keys, raw_texts(batch)):
                found.extend((row, doc_id, *unit) for unit in units_of(raw or b"", hash_of, min_words))
                if len(found) >= UNITS_OUT:
                    yield _batch(found, names, kinds)
                    found = []
            if found:
                yield _batch(found, names, kinds)

    return rows.mapInArrow(run, UNIT)


def _batch(found: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)


def repeated_spans(
    docs: DataFrame, min_words: int = MIN_WORDS, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The spans to remove: one row each, with its place and the document that keeps the text.

    Earliest means the smallest doc_id, then the place in the text; null ids come last, and of
    rows with the same id the one read first counts as earlier. Null, empty and blank texts
    have no units. Documents without repeated passages give no rows; further columns are
    ignored. `kept_doc_id` is the earliest document that keeps a part of the span.

    A digest that very many documents share is reduced within tasks when groups are formed;
    when units meet their group it has one row on the groups' side, so adaptive execution can
    split it.
    """
    rows = only(docs, id_column, text).toDF("doc_id", "text").select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text"
    )
    return _row_spans(rows, min_words).drop("row")


def _row_spans(rows: DataFrame, min_words: int) -> DataFrame:
    """The spans of numbered rows (row, doc_id, text), with the number of the row they lie in."""
    spark = rows.sparkSession
    folder = shared_dir(spark, "units")
    find_units(rows, min_words).write.parquet(f"{folder}/units")
    units = spark.read.schema(UNIT).parquet(f"{folder}/units")

    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "unit")
    groups = (
        units.groupBy("digest", "check")
        .agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "check", "first.doc_id", "first.row", "first.unit")
        .toDF("digest", "check", "kept_doc_id", "kept_row", "kept_unit")
    )
    groups.write.parquet(f"{folder}/groups")
    kept = spark.read.schema(groups.schema).parquet(f"{folder}/groups")
    later = units.join(kept, ["digest", "check"]).where(
        (F.col("row") != F.col("kept_row")) | (F.col("unit") != F.col("kept_unit"))
    )
    by_row = Window.partitionBy("row").orderBy("unit")
    run = F.col("unit") - F.row_number().over(by_row)
    together = F.sum("words").over(Window.partitionBy("row", "run"))
    gone = later.withColumn("run", run).withColumn("together", together).where((F.col("together") >= min_words) | F.col("whole"))
    spans = gone.withColumn("run", run).groupBy("row", "run").agg(
        F.max("doc_id").alias("doc_id"),
        F.min("start").alias("start"),
        F.max("stop").alias("stop"),
        F.sum("words").alias("n_words"),
        F.min("kept_doc_id").alias("kept_doc_id"),
    )
    return spans.select(
        "row", "doc_id", F.col("start").cast("long"), F.col("stop").cast("long"), "n_words", "kept_doc_id"
    )


def remove_repeats(
    docs: DataFrame, min_words: int = MIN_WORDS, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All rows and columns, with the repeated passages cut out of the texts, and where they were.

    The new last column, `removed`, or `removed_` where there is such a column, has the spans
    by their offsets in the text as it was; it is null where nothing was cut. Rows are told
    apart by numbers that are written down with them, so ids may be null or repeat. Null
    texts stay null.
    """
    spark = docs.sparkSession
    own, hit, removed = unused(docs, "_row", "_hit", "removed")
    folder = shared_dir(spark, "numbered")
    docs.withColumn(own, F.monotonically_increasing_id()).write.parquet(folder)
    numbered = spark.read.schema(docs.schema.add(own, "long")).parquet(folder)
    column = F.col(f"`{text}`")
    rows = numbered.select(
        F.col(own).alias("row"), F.col(f"`{id_column}`").cast("long").alias("doc_id"), column.alias("text")
    )
    span = F.struct(F.col("start").cast("int").alias("start"), F.col("stop").cast("int").alias("stop"))
    each = _row_spans(rows, min_words).groupBy(F.col("row").alias(hit))
    each = each.agg(F.array_sort(F.collect_list(span)).alias(removed))
    cut = F.when(F.col(removed).isNull(), column).otherwise(redact(column, F.col(removed), ""))
    joined = numbered.join(each, numbered[own] == each[hit], "left").withColumn(text, cut)
    return joined.select(*[f"`{name}`" for name in docs.columns], removed)
