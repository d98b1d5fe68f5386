"""Mixing sources to target weights by repeating documents a whole or a drawn number of times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.llm.words import only, unused, word_count
from tapeloom.sources.paths import shared_dir

# The weights that sources get in turn, in code point order, and the cap.
WEIGHTS = [5, 2, 1]
MOST_REPEATS = 3

SEED = "mix-1"
_HEX_DIGITS = 13


def sized(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, source and number of words of every document."""
    rows = only(docs, id_column, "source", text).toDF("doc_id", "source", "text")
    return rows.select(
        F.col("doc_id").cast("long"),
        "source",
        word_count(F.col("text")).alias("size"),
        content(F.col("text")).alias("digest"),
    )


def targets(sizes: DataFrame) -> DataFrame:
    """Size, target and repetition rate of each source.

    A source's target is its weight's part of all words, but at most three times its own
    words; what is cut off goes to the others by weight. Sources that are cut are those with
    the least words for their weight. So with sources in that order, running sums tell how
    high the words for a unit of weight would be with the first k cut, and the first k that
    cuts nobody further is the answer. There is one row a source from here on, so the
    windows over all of them hold as many rows as there are sources, not documents.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), place + 1))

    ratio = F.col("source_size") / F.col("weight")
    order = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = weighed.select(
        "source",
        "source_size",
        "weight",
        (
            (
                F.sum("source_size").over(everything)
                - MOST_REPEATS * F.coalesce(F.sum("source_size").over(before), F.lit(0))
            ).cast("double")
            / (
                F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
            ).cast("double")
        ).alias("level"),
    )
    cap = (MOST_REPEATS * F.col("source_size")).cast("double")
    stands = F.when(cap >= F.col("level") * F.col("weight"), F.col("level"))
    # the first level that stands, in the same order; with none all sources are cut
    level = F.first(stands, ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.least(cap, F.coalesce(level * F.col("weight"), cap))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return levels.select("source", "source_size", target.alias("target")).withColumn("rate", rate)


def content(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def draw(doc_id: Column, digest: Column, seed: str = SEED) -> Column:
    """A number from 0 up to 1 that depends on the id, the text's digest and the seed alone."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")), digest)
    digits = F.substring(F.md5(key.cast("binary")), 1, _HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / float(16**_HEX_DIGITS)


def copies(rate: Column, doc_id: Column, digest: Column, seed: str = SEED) -> Column:
    """How often the mix takes a document: the whole part of the rate, and perhaps once more."""
    whole = F.floor(rate)
    return (whole + (draw(doc_id, digest, seed) < rate - whole).cast("long")).cast("long")


def _stored(frame: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again: computed once, and its size is known."""
    folder = shared_dir(frame.sparkSession, name)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def mix(docs: DataFrame, seed: str = SEED, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """What the mix takes of each document.

    A null text has size 0; documents without a source are a source of their own, after all
    others; with no words at all every target is 0. Rows with a null or repeated id draw by
    their texts; rows that repeat both id and text are the same row and share a draw. Whether the table of sources is
    broadcast is Spark's choice by the size of its file; otherwise both sides are shuffled.
    """
    sizes = _stored(sized(docs, id_column, text), "sizes")
    rates = _stored(targets(sizes), "rates").withColumnRenamed("source", "own_source")
    joined = sizes.join(rates, F.col("source").eqNullSafe(F.col("own_source")))
    taken = F.col("size") * copies(F.col("rate"), F.col("doc_id"), F.col("digest"), seed)
    return joined.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def emit(docs: DataFrame, seed: str = SEED, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The mixed corpus: every row as often as the mix takes it, all columns unchanged."""
    sizes = sized(docs, id_column, text)
    own_source, own_rate, copy = unused(docs, "_own_source", "_rate", "_copy")
    rates = _stored(targets(sizes), "rates").select(
        F.col("source").alias(own_source), F.col("rate").alias(own_rate)
    )
    joined = docs.join(rates, F.col("source").eqNullSafe(F.col(own_source)))
    digest = content(F.col(f"`{text}`"))
    times = copies(F.col(own_rate), F.col(f"`{id_column}`").cast("long"), digest, seed).cast("int")
    repeats = F.explode(F.array_repeat(F.lit(0), times)).alias(copy)
    return joined.select(*[docs[f"`{name}`"] for name in docs.columns], repeats).drop(copy)
