"""Benchmark decontamination with an FM-index per shard of the documents.

A task packs its documents into shards of bounded size and indexes each: the words of its texts
as numbers, suffix array, Burrows-Wheeler transform, wavelet matrix for ranks, and every 32nd
suffix position. The phrases of the benchmark, all windows of ten words, are searched backwards
in the index, all at a time; what is found is located by walking to sampled positions, and the
places merge to spans.

Words that no phrase has are one symbol that no phrase has either, so runs of known words too
short for any phrase can be left out of the index without losing a find.

Phrases are broadcast in parts of bounded size. One part is the usual case; with more of them the
documents are read once for each, and finds, few beside the texts, are merged by the text's digest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.words import only, raw_texts
from tapeloom.sources.paths import shared_dir

# What a word is, after A-Z are lower-cased, and how long a window is.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10

SHARD_WORDS = 1 << 20  # of a shard's texts; a longer text is a shard of its own
SAMPLED = 32
PART_BYTES = 1 << 22  # of items' texts whose phrases are broadcast at a time

_PLAIN = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
_SPAN_TYPE = "array<struct<first:long,last:long,start:long,stop:long>>"
_FOUND = f"row long, n_words long, spans {_SPAN_TYPE}, items array<string>"


def split_words(text: bytes | None) -> list[bytes]:
    return text.translate(_PLAIN).split() if text else []


# -- the index ----------------------------------------------------------------------


class Phrases(NamedTuple):
    """Windows as rows of word numbers by length, and the items that each comes from."""

    numbers: dict[bytes, int]  # of words, from 1; 0 is any other word
    windows: dict[int, np.ndarray]  # by length, one row each
    items: dict[int, list[list[str]]]  # by length, of each row


def phrases_of(items: list[tuple[str | None, bytes]]) -> Phrases:
    numbers: dict[bytes, int] = {}
    found: dict[int, dict[tuple, list[str]]] = {}
    for item, text in items:
        words = [numbers.setdefault(word, len(numbers) + 1) for word in split_words(text)]
        size = min(WINDOW, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            known = found.setdefault(size, {}).setdefault(tuple(words[i : i + size]), [])
            if item is not None and (not known or known[-1] != item):
                known.append(item)
    windows = {size: np.array(list(rows), np.int32) for size, rows in found.items()}
    return Phrases(numbers, windows, {size: list(rows.values()) for size, rows in found.items()})


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The starts of all suffixes in order, by doubling the length that is compared.

    A rank is the first place of a suffix's group; only groups of several are sorted further.
    """
    order = np.argsort(text, kind="stable")
    rank, places = np.empty(len(text), np.int64), np.arange(len(text))
    new = np.concatenate(([True], text[order][1:] != text[order][:-1]))
    rank[order] = np.maximum.accumulate(np.where(new, places, 0))
    length = 1
    while True:
        alone = new & np.concatenate((new[1:], [True]))
        places = places[~alone]
        if not len(places):
            return order
        starts = order[places]
        beyond = starts + length
        behind = np.where(beyond < len(text), rank[np.minimum(beyond, len(text) - 1)] + 1, 0)
        again = np.lexsort((behind, rank[starts]))
        starts, behind = starts[again], behind[again]
        own = rank[starts]
        order[places] = starts
        new = np.concatenate(([True], (own[1:] != own[:-1]) | (behind[1:] != behind[:-1])))
        rank[starts] = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        length *= 2


class Wavelet:
    """A wavelet matrix: rank of any symbol, and the symbol at any place, by one bit a level."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels, self.zeros, self.ones = max(1, int(largest).bit_length()), [], []
        for level in range(self.levels - 1, -1, -1):
            bits = (symbols >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bits, dtype=np.int32))).astype(np.int32))
            self.zeros.append(len(symbols) - int(self.ones[-1][-1]))
            symbols = np.concatenate((symbols[bits == 0], symbols[bits == 1]))

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol comes before each end."""
        begins = np.zeros_like(ends)
        for number, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = ((symbols >> (self.levels - 1 - number)) & 1).astype(bool)
            low, high = ones[begins], ones[ends]
            begins = np.where(bit, zeros + low, begins - low)
            ends = np.where(bit, zeros + high, ends - high)
        return ends - begins

    def at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it comes before."""
        symbols, begins = np.zeros_like(places), np.zeros_like(places)
        for ones, zeros in zip(self.ones, self.zeros):
            high, low = ones[places], ones[begins]
            bit = ones[places + 1] > high
            places = np.where(bit, zeros + high, places - high)
            begins = np.where(bit, zeros + low, begins - low)
            symbols = symbols * 2 + bit
        return symbols, places - begins


class FmIndex:
    """Count and places of word sequences in a text of word numbers."""

    def __init__(self, text: np.ndarray):
        # the end is smaller than all symbols, so every row of the transform has one before it
        text = np.concatenate((text + 1, [0])).astype(np.int64)
        order = suffix_array(text)
        before = text[order - 1]
        largest = int(text.max())
        self.smaller = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=largest + 1))))
        self.ranks = Wavelet(before, largest)
        self.marked = order % SAMPLED == 0
        self.sample_rank = np.concatenate(([0], np.cumsum(self.marked)))
        self.samples = order[self.marked]
        self.size = len(text)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which patterns (rows) come in the text, and their ranges of rows of the transform."""
        left = np.flatnonzero((patterns + 1 < len(self.smaller) - 1).all(axis=1))
        low = np.zeros(len(left), np.int64)
        high = np.full(len(left), self.size, np.int64)
        for place in range(patterns.shape[1] - 1, -1, -1):
            symbols = patterns[left, place] + 1
            low = self.smaller[symbols] + self.ranks.rank(symbols, low)
            high = self.smaller[symbols] + self.ranks.rank(symbols, high)
            alive = low < high
            left, low, high = left[alive], low[alive], high[alive]
        return left, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text positions of rows: step back until a sampled one is met."""
        found = np.zeros(len(rows), np.int64)
        walking, steps = np.arange(len(rows)), 0
        while len(walking):
            met = self.marked[rows]
            found[walking[met]] = self.samples[self.sample_rank[rows[met]]] + steps
            walking, rows = walking[~met], rows[~met]
            symbols, seen = self.ranks.at(rows)
            rows = self.smaller[symbols] + seen
            steps += 1
        return found


# -- shards -------------------------------------------------------------------------


def long_runs(numbers: np.ndarray, shortest: int) -> np.ndarray:
    """Places in runs of known words that are long enough for a phrase, and one place behind each."""
    known = np.concatenate(([False], numbers > 0, [False]))
    edges = np.flatnonzero(known[1:] != known[:-1])
    begins, ends = edges[::2], edges[1::2]
    keep = ends - begins >= shortest
    mask = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(mask, begins[keep], 1)
    np.add.at(mask, np.minimum(ends[keep] + 1, len(numbers)), -1)
    return np.flatnonzero(np.cumsum(mask[:-1]) > 0)


def find(numbers: np.ndarray, phrases: Phrases, block: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Places of phrases in a shard's words: (first words, rows of the phrases, length), in blocks."""
    places = long_runs(numbers, min(phrases.windows, default=1))
    if not len(places):
        return
    index = FmIndex(numbers[places])
    for size, windows in phrases.windows.items():
        which, low, high = index.search(windows)
        ends = np.cumsum(high - low)
        total = int(ends[-1]) if len(ends) else 0
        for start in range(0, total, block):  # a phrase may come anywhere, and very often
            slots = np.arange(start, min(start + block, total))
            owner = np.searchsorted(ends, slots, side="right")
            rows = high[owner] - (ends[owner] - slots)
            yield places[index.locate(rows)], which[owner], size


def search_shard(texts: list[np.ndarray], phrases: Phrases) -> list[tuple[list[tuple[int, int]], list[str]]]:
    """For each text of a shard, in numbers of words, the merged spans that are hit, and the items found."""
    starts = np.cumsum([0] + [len(text) + 1 for text in texts])  # one other word between texts
    numbers = np.zeros(starts[-1], np.int64)
    for start, text in zip(starts, texts):
        numbers[start : start + len(text)] = text
    edges = np.zeros(len(numbers) + 1, np.int64)
    items: dict[int, set[str]] = {}
    for firsts, rows, size in find(numbers, phrases):
        np.add.at(edges, firsts, 1)
        np.add.at(edges, firsts + size, -1)
        many = len(phrases.items[size])
        for pair in np.unique((np.searchsorted(starts, firsts, side="right") - 1) * many + rows).tolist():
            items.setdefault(pair // many, set()).update(phrases.items[size][pair % many])
    hit = np.concatenate(([False], np.cumsum(edges[:-1]) > 0, [False]))
    turns = np.flatnonzero(hit[1:] != hit[:-1])
    spans: dict[int, list[tuple[int, int]]] = {}
    owners = np.searchsorted(starts, turns[::2], side="right") - 1
    for t, first, end in zip(owners.tolist(), turns[::2].tolist(), turns[1::2].tolist()):
        spans.setdefault(t, []).append((first - int(starts[t]), end - int(starts[t])))
    return [(spans.get(t, []), sorted(items.get(t, ()))) for t in range(len(texts))]


def _located(text: bytes, spans: list[tuple[int, int]]) -> list[dict]:
    """Spans of words with their places in the text, in code points."""
    if not spans:
        return []
    places = [match.span() for match in re.finditer(WORD, text.decode().translate(_LOWER))]
    return [
        {"first": first, "last": end - 1, "start": places[first][0], "stop": places[end - 1][1]}
        for first, end in spans
    ]


_LOWER = {b: b + 32 for b in range(0x41, 0x5B)}
_SPANS = pa.list_(
    pa.struct([("first", pa.int64()), ("last", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
)


def _search(phrases):
    """The task: rows (row, text) of documents to rows of finds, shard by shard."""

    def found_in(rows: list, texts: list[bytes | None], numbers: list[np.ndarray]) -> pa.RecordBatch:
        found = search_shard(numbers, phrases.value)
        columns = [
            pa.array(rows, pa.int64()),
            pa.array([len(n) for n in numbers], pa.int64()),
            pa.array([_located(text, spans) for text, (spans, _) in zip(texts, found)], _SPANS),
            pa.array([items for _, items in found], pa.list_(pa.string())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["row", "n_words", "spans", "items"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = phrases.value.numbers.get
        shard: tuple[list, list, list] = ([], [], [])
        held = 0
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), raw_texts(batch)):
                words = split_words(text)
                if held and held + len(words) > SHARD_WORDS:
                    yield found_in(*shard)
                    shard, held = ([], [], []), 0
                numbers = np.fromiter(map(known, words, repeat(0)), np.int32, len(words))
                for column, value in zip(shard, (row, text, numbers)):
                    column.append(value)
                held += len(words) + 1
        if held:
            yield found_in(*shard)

    return task


# -- over tables --------------------------------------------------------------------


def _merged(spans):
    """Spans of several parts of the phrases as one list, those that meet made one."""
    none = F.array().cast(_SPAN_TYPE)

    def step(done, span):
        last = F.try_element_at(done, F.lit(-1))
        meets = F.coalesce(span["first"] <= last["last"] + 1, F.lit(False))
        both = F.struct(
            last["first"].alias("first"),
            F.greatest(last["last"], span["last"]).alias("last"),
            last["start"].alias("start"),
            F.greatest(last["stop"], span["stop"]).alias("stop"),
        )
        return F.when(meets, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(both))).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(F.array_sort(F.flatten(F.collect_list(spans))), none, step)


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Per document doc_id, n_words, the spans to remove and the items found in it.

    A span has its first and last word and its place in the text, start and stop, in code
    points. Null and empty texts have no words and no spans, and so have items without
    words; an item without id hits words but is not listed. Rows that repeat are rows each;
    items that repeat an id are one. With an empty table of either kind nothing is hit.
    """
    spark = docs.sparkSession
    phrases = only(benchmark, item_column, item_text).toDF("item", "text").select(
        F.col("item").cast("string"), "text"
    )
    size = phrases.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    rows = only(docs, id_column, text).toDF("row", "text")
    rows = rows.withColumn("row", F.col("row").cast("long"))
    if parts > 1:  # ids may be null or repeat; numbers that are written down stay the same
        folder = shared_dir(spark, "decontamination")
        numbered = rows.withColumnRenamed("row", "doc_id").withColumn("row", F.monotonically_increasing_id())
        numbered.write.parquet(f"{folder}/rows")
        numbered = spark.read.schema("doc_id long, text string, row long").parquet(f"{folder}/rows")
        rows = numbered.select("row", "text")
    found = []
    for part in range(parts):
        in_part = F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part
        held = [(row["item"], row["text"].encode()) for row in phrases.where(in_part & F.col("text").isNotNull()).toLocalIterator()]
        own = spark.sparkContext.broadcast(phrases_of(held))
        found.append(rows.mapInArrow(_search(own), _FOUND))
    if parts == 1:
        return found[0].withColumnRenamed("row", "doc_id")
    counted = found[0].select("row", "n_words")
    hits = reduce(DataFrame.unionByName, found).where(F.size("spans") > 0)
    hits = hits.groupBy("row").agg(
        _merged(F.col("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
    )
    none = [F.array().cast(_SPAN_TYPE), F.array().cast("array<string>")]
    return numbered.select("doc_id", "row").join(counted, "row").join(hits, "row", "left").select(
        "doc_id",
        "n_words",
        *[F.coalesce(F.col(name), empty).alias(name) for name, empty in zip(("spans", "items"), none)],
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """How many words of each document are hit, and by which items, as a digest of their ids."""
    found = find_hits(docs, benchmark, **options)
    lengths = F.transform("spans", lambda span: span["last"] - span["first"] + 1)
    n_hit = F.aggregate(lengths, F.lit(0).cast("long"), lambda total, length: total + length)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
