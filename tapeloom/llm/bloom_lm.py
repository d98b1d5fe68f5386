"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Training cuts texts into chunks of tokens; each chunk sends its distinct one- and two-word grams
and their counts to the blocks of the hash space, once. Each block adds these up and fills its own
segment of the filter: a gram whose count lies in the q-th count class is entered q times, with
the numbers 1 to q. A segment gets as many bits as its entries need, so every gram is entered
whatever the size of the corpus. The segments are written; they are the model.

Scoring knows no counts of grams. The filter is broadcast to the workers, which ask it for each
gram of a chunk with 1, 2, ... until it says no; the last yes tells the class of its count,
and these classes give smoothed probabilities. A filter above `broadcast_bytes` stays where it is
written: chunks then send their distinct grams, without counts, to the segments, and the answers
go back to the chunks. Both ways ask the same filter and give the same scores.

The base score needs exact word counts. Those of the most frequent words are broadcast, at
most `frequent` of them; all other words of a text are joined with the table of counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.words import hash_words, mix, only, raw_texts
from tapeloom.sources.paths import shared_dir

FOLDS, HELD_OUT_FOLD = 7, 2
END = b" "  # no word holds a blank
CHUNK_TOKENS = 1 << 20
HASHED_TOKENS = 1 << 17  # tokens held as words at a time
ASKED_GRAMS = 1 << 17  # grams that the filter is asked for at a time
BLOCK_GRAMS = 1 << 21  # grams of all chunks in one block, about
COUNTED_WORDS = 400_000
PROBES = 4
FULL = 0.6  # set positions a segment may get, as a part of its bits
STORED_BYTES = 6
_BEGIN, _ONE, _TWO, _LEVEL = (
    np.uint64(x)
    for x in (0x2545F4914F6CDD1D, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA24BAED4963EE407)
)


BLOCK_BITS = 6  # 64 blocks at least
SEGMENT_BITS = 10  # bits of a segment, as a power of two, at least
BROADCAST_BYTES = 1 << 28  # of a filter that is broadcast: 256 MB at most


def block_bits_for(grams: int) -> int:
    """Bits of the hash that name a block, so that a block has about as many grams at any size."""
    return max(BLOCK_BITS, (grams // BLOCK_GRAMS).bit_length())


FREQUENT = 1 << 20  # words whose exact counts are broadcast: 12 MB at most
BIGRAM_WEIGHT = 0.15


@lru_cache(maxsize=1)
def class_bounds() -> np.ndarray:
    """The least count of each class: every count up to 4, then two classes to a doubling."""
    return np.array([1, 2, 3, *(m << e for e in range(1, 50) for m in (2, 3))], np.int64)


def count_class(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(class_bounds(), counts, "right")


@lru_cache(maxsize=1)
def class_counts() -> np.ndarray:
    """The count each class stands for: the geometric middle of its range; 0 for none."""
    low = class_bounds().astype(float)
    high = np.append(low[1:] - 1, low[-1])
    return np.append(0.0, np.sqrt(low * high))


# -- grams ----------------------------------------------------------------------------


def tokens(raw: bytes | None) -> list[bytes]:
    return [*(raw or b"").lower().split(), END]


def chunk_grams(known: np.ndarray, back: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of a chunk, its words first, and the place of each token's two-word gram.

    Tokens are places in `known`, the distinct hashes. A two-word gram is made of the token
    before it in its text, or the place where a text begins, and the token.
    """
    size = len(known)
    before = np.append(size, back[:-1])
    before[starts] = size
    pairs, two = np.unique(before * (size + 1) + back, return_inverse=True)
    first, second = np.divmod(pairs, size + 1)
    pair_hashes = np.append(known, _BEGIN)[first] * _TWO + known[second]
    return np.concatenate([mix(known * _ONE), mix(pair_hashes)]), two + size


def gram_counts(grams: int, back: np.ndarray, two_at: np.ndarray, trained: np.ndarray) -> np.ndarray:
    """How often each gram comes in a chunk's training tokens."""
    return np.bincount(back[trained], minlength=grams) + np.bincount(two_at[trained], minlength=grams)


def _position_bits(grams: np.ndarray, level: np.ndarray, bits: np.ndarray | int) -> Iterator[np.ndarray]:
    """Where an entry's probes lie in a segment of 2 ** bits positions."""
    spread = mix(grams + level.astype(np.uint64) * _LEVEL)
    mask = (np.uint64(1) << np.asarray(bits, np.uint64)) - np.uint64(1)
    first, step = spread >> np.uint64(32), spread | np.uint64(1)
    for probe in range(PROBES):
        yield (first + np.uint64(probe) * step) & mask


def block_of(grams: np.ndarray, block_bits: int) -> np.ndarray:
    return (grams >> np.uint64(64 - block_bits)).astype(np.int64)


def stored(grams: np.ndarray) -> np.ndarray:
    """The low bits that are shuffled: with the block, 54 bits of the hash at least."""
    return grams & np.uint64((1 << (8 * STORED_BYTES)) - 1)


def by_block(grams: np.ndarray, block_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of a chunk's grams by block and hash, and the bounds of the blocks in it."""
    order = np.argsort(grams)
    return order, np.searchsorted(block_of(grams[order], block_bits), np.arange((1 << block_bits) + 1))


def fill_segment(grams: np.ndarray, counts: np.ndarray) -> tuple[int, np.ndarray]:
    """A segment with room for every class of every gram: its size as a power of two, and its bits."""
    levels = count_class(counts)
    entries, bits = int(levels.sum()), SEGMENT_BITS
    while entries > FULL * (1 << bits) / PROBES:
        bits += 1
    positions = np.zeros(1 << bits, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        own = grams[levels >= level]
        for place in _position_bits(own, np.full(len(own), level), bits):
            positions[place] = True
    return bits, np.packbits(positions, bitorder="little")


@dataclass(frozen=True)
class Filter:
    """Segments by block: their sizes as powers of two, where they begin, and their bits."""

    block_bits: int
    sizes: np.ndarray  # 0 where a block has no grams
    begins: np.ndarray
    bits: np.ndarray

    @staticmethod
    def of(block_bits: int, segments: list[tuple[int, int, bytes]]) -> Filter:
        """The filter of (block, size, bits) rows; blocks that are not among them are empty."""
        sizes, begins = np.zeros(1 << block_bits, np.int64), np.zeros(1 << block_bits, np.int64)
        at = 0
        for block, size, raw in segments:
            sizes[block], begins[block] = size, at
            at += len(raw)
        parts = [np.frombuffer(raw, np.uint8) for _, _, raw in segments]
        return Filter(block_bits, sizes, begins, np.concatenate(parts or [np.zeros(0, np.uint8)]))

    def classes(self, grams: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """The count class of each gram, 0 if unknown: asked with rising numbers until a no."""
        found = np.zeros(len(grams), np.uint8)
        for at in range(0, len(grams), ASKED_GRAMS):
            part = slice(at, at + ASKED_GRAMS)
            found[part] = self._classes(stored(grams[part]), blocks[part])
        return found

    def _classes(self, low: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        found = np.zeros(len(low), np.uint8)
        left = np.flatnonzero(self.sizes[blocks] > 0)
        level = 1
        while len(left) and level <= len(class_bounds()):
            own = blocks[left]
            there = np.ones(len(left), bool)
            for place in _position_bits(low[left], np.full(len(left), level), self.sizes[own]):
                at = place.astype(np.int64)
                there &= (self.bits[self.begins[own] + (at >> 3)] >> (at & 7).astype(np.uint8)) & 1 == 1
            left = left[there]
            found[left] = level
            level += 1
        return found


def model_logs(
    classes: np.ndarray,
    back: np.ndarray,
    two_at: np.ndarray,
    end: int,
    starts: np.ndarray,
    total: int,
    distinct: int,
    weight: float,
) -> np.ndarray:
    """The log10 probability of each token after the one before it in its text.

    A mixture, by `weight`, of the share of the two-word gram in its first word's count and
    the word's own smoothed share. A text's first token comes after the place where a text
    begins; there are as many of these as ends. `classes` are those of chunk_grams, `end` is
    the place of the end among them.
    """
    counts = class_counts()[classes]
    one, two = counts[back], counts[two_at]
    history = np.append(0.0, one[:-1])
    history[starts] = counts[end]
    alone = np.minimum(1.0, (one + 1) / (total + distinct + 1))
    after = np.minimum(1.0, two / np.maximum(history, 1.0))
    return np.log10(weight * after + (1 - weight) * alone)


# -- training -------------------------------------------------------------------------


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Whether a document is kept from training; one without an id is not."""
    column = doc_id if isinstance(doc_id, Column) else F.col(doc_id)
    fold = F.crc32(column.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))


def count_words(texts: DataFrame) -> DataFrame:
    """Every token with its count. Counted within tasks first, so a hot word is no hot key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.record_batch(
                {"word": pa.array(counts.keys(), pa.binary()), "c": pa.array(counts.values(), pa.int64())}
            )

        for batch in batches:
            for raw in raw_texts(batch):
                counts.update(tokens(raw))
                if len(counts) >= COUNTED_WORDS:
                    yield out()
                    counts.clear()
        yield out()

    partial = texts.select("text").mapInArrow(run, "word binary, c long")
    return partial.groupBy("word").agg(F.sum("c").alias("c"))


def _packed(values: np.ndarray) -> bytes:
    """Unsigned numbers, byte by byte of all of them, so that high bytes that repeat shrink."""
    wide = values.dtype.itemsize
    raw = np.ascontiguousarray(values.view(np.uint8).reshape(-1, wide).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    flat = np.frombuffer(pa.decompress(raw[8:], size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def _packed_hashes(values: np.ndarray) -> bytes:
    """Hashes as their steps, which are small where they rise."""
    return _packed(np.diff(values, prepend=np.uint64(0)))


def _unpacked_hashes(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(raw, np.uint64), dtype=np.uint64)


def _tokens_of(row: dict) -> tuple[np.ndarray, ...]:
    """Distinct hashes, tokens, starts of texts and whether a token trains, of a stored chunk."""
    sizes = np.array(row["sizes"], np.int64)
    known = _unpacked_hashes(row["known"])
    back = _unpacked(row["back"], np.uint32).astype(np.int64)
    return known, back, np.cumsum(sizes) - sizes, np.repeat(np.array(row["trains"], bool), sizes)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def counted_grams(chunks: DataFrame, block_bits: int) -> DataFrame:
    """The grams of training texts with their counts: one row for each block and chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            known, back, starts, trained = _tokens_of(row)
            grams, two_at = chunk_grams(known, back, starts)
            counts = gram_counts(len(grams), back, two_at, trained)
            grams, counts = grams[counts > 0], counts[counts > 0]
            order, edges = by_block(grams, block_bits)
            low, counts = stored(grams[order]), counts[order].astype(np.uint32)
            held = [
                (block, _packed_hashes(low[first:end]), _packed(counts[first:end]))
                for block, (first, end) in enumerate(zip(edges.tolist(), edges[1:].tolist()))
                if end > first
            ]
            kinds = [pa.int32(), pa.binary(), pa.binary()]
            columns = list(zip(*held)) or [(), (), ()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["block", "grams", "counts"])

    wanted = chunks.select("trains", "sizes", "known", "back")
    return wanted.mapInArrow(run, "block int, grams binary, counts binary")


SEGMENTS = "block int, size int, entries long, bits binary"


def segments(counted: DataFrame) -> DataFrame:
    """Each block's segment of the filter, from its grams in all chunks."""

    def fill(table: pa.Table) -> pa.Table:
        grams, back = np.unique(
            np.concatenate([_unpacked_hashes(raw) for raw in table["grams"].to_pylist()]), return_inverse=True
        )
        weights = np.concatenate([_unpacked(raw, np.uint32) for raw in table["counts"].to_pylist()])
        counts = np.bincount(back, weights.astype(np.float64)).astype(np.int64)
        size, bits = fill_segment(grams, counts)
        return pa.table(
            {
                "block": pa.array([table["block"][0].as_py()], pa.int32()),
                "size": pa.array([size], pa.int32()),
                "entries": pa.array([int(count_class(counts).sum())], pa.int64()),
                "bits": pa.array([bits.tobytes()], pa.binary()),
            }
        )

    return counted.groupBy("block").applyInArrow(fill, SEGMENTS)


def asked_grams(chunks: DataFrame, block_bits: int) -> DataFrame:
    """The distinct grams of chunks, without counts: one row for each block and chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            grams, _ = chunk_grams(*_tokens_of(row)[:3])
            order, edges = by_block(grams, block_bits)
            low = stored(grams[order])
            held = [
                (block, row["chunk"], _packed_hashes(low[first:end]))
                for block, (first, end) in enumerate(zip(edges.tolist(), edges[1:].tolist()))
                if end > first
            ]
            kinds = [pa.int32(), pa.int64(), pa.binary()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=["block", "chunk", "grams"])

    wanted = chunks.select("chunk", "trains", "sizes", "known", "back")
    return wanted.mapInArrow(run, "block int, chunk long, grams binary")


def answers(asked: DataFrame, held: DataFrame, block_bits: int) -> DataFrame:
    """The count class of every asked gram, in the order of `by_block`, from the stored segments."""

    def ask(grams: pa.Table, segment: pa.Table) -> pa.Table:
        own = Filter.of(block_bits, [(row["block"], row["size"], row["bits"]) for row in segment.to_pylist()])
        rows = []
        for row in grams.to_pylist():
            low = _unpacked_hashes(row["grams"])
            found = own.classes(low, np.full(len(low), row["block"]))
            rows.append((row["chunk"], row["block"], _packed(found)))
        kinds = [pa.int64(), pa.int32(), pa.binary()]
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["chunk", "block", "classes"])

    both = asked.groupBy("block").cogroup(held.groupBy("block"))
    return both.applyInArrow(ask, "chunk long, block int, classes binary")


@dataclass(frozen=True)
class Model:
    """What scoring needs: the written filter, and exact counts of words for the base score."""

    docs: DataFrame | None  # the documents trained from, whose chunks are there already
    columns: tuple[str, str]  # their id and text
    chunks: str  # folder of their chunks
    block_bits: int
    segments: str  # folder of the filter
    filter_bytes: int
    total: int
    distinct: int
    word_hashes: np.ndarray
    word_counts: np.ndarray
    all_words: bool  # whether the words above are the whole vocabulary
    vocabulary: str  # folder of the table of all words and counts


def _frequent(vocabulary: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Hashes and counts of words above a count that at most `limit` words reach."""
    level = F.floor(F.log2("c") * 8).cast("int")
    sizes = sorted(vocabulary.groupBy(level.alias("l")).count().collect(), reverse=True)
    taken, lowest = 0, None
    for row in sizes:  # one row for an eighth of a doubling
        taken += row["count"]
        if taken > limit:
            break
        lowest = row["l"]
    whole = taken <= limit
    if lowest is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), whole
    rows = vocabulary.where(level >= lowest)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = hash_words(batch.column("word").to_pylist()).view(np.int64)
            yield pa.record_batch([pa.array(hashes), batch.column("c")], names=["h", "c"])

    found = rows.mapInArrow(hashed, "h long, c long").toArrow()
    hashes = found["h"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found["c"].to_numpy()[order], whole


def train(
    docs: DataFrame,
    frequent: int = FREQUENT,
    id_column: str = "doc_id",
    text: str = "text",
) -> Model:
    """The filter and the word counts of all training documents, written to the shared folder."""
    spark = docs.sparkSession
    rows = _marked(docs, id_column, text)
    folder = shared_dir(spark, "language-model")
    count_words(rows.where("trains")).write.parquet(f"{folder}/vocabulary")
    vocabulary = spark.read.schema("word binary, c long").parquet(f"{folder}/vocabulary")
    total, distinct = vocabulary.agg(F.sum("c"), F.count(F.lit(1))).first()
    hashes, counts, whole = _frequent(vocabulary, frequent)
    model = Model(
        docs=docs,
        columns=(id_column, text),
        chunks=f"{folder}/chunks",
        block_bits=block_bits_for(2 * (total or 0)),
        segments=f"{folder}/filter",
        filter_bytes=0,
        total=total or 0,
        distinct=distinct,
        word_hashes=hashes,
        word_counts=counts,
        all_words=whole,
        vocabulary=f"{folder}/vocabulary",
    )
    chunks = _chunks(rows, model, model.chunks)
    segments(counted_grams(chunks, model.block_bits)).write.parquet(model.segments)
    size = F.sum(F.expr("shiftleft(1L, size - 3)"))
    return replace(model, filter_bytes=_segments_of(spark, model).agg(size).first()[0] or 0)


def _marked(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    rows = only(docs, id_column, text).toDF("doc_id", "text")
    return rows.select(F.col("doc_id").cast("long"), "text", (~held_out()).alias("trains"))


def _segments_of(spark: SparkSession, model: Model) -> DataFrame:
    return spark.read.schema(SEGMENTS).parquet(model.segments)


# -- scoring --------------------------------------------------------------------------

SCORED = (
    "chunk long, place int, doc_id long, n_tokens long, n_known long, base_score double, score double"
)


def score(
    docs: DataFrame,
    model: Model,
    weight: float = BIGRAM_WEIGHT,
    id_column: str = "doc_id",
    text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Base and model scores of every document, held out or not.

    A null text counts as empty: its only token is the end. Repeated rows and rows with a
    null id are scored one by one. With no training token at all every count is 0. Any
    documents can be scored; nothing is counted anew.
    """
    spark = docs.sparkSession
    if docs is model.docs and (id_column, text) == model.columns:
        chunks = _stored_chunks(spark, model.chunks)
    else:
        chunks = _chunks(_marked(docs, id_column, text), model, shared_dir(spark, "chunks"))
    if model.filter_bytes <= broadcast_bytes:
        scored = _by_broadcast(chunks, model, weight)
    else:
        asked = asked_grams(chunks, model.block_bits)
        found = answers(asked, _segments_of(spark, model), model.block_bits)
        scored = _combined(chunks, found, model, weight)
    if not model.all_words:
        scored = _with_other_words(spark, scored, chunks, model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


CHUNKS = (
    "doc_ids array<long>, trains array<boolean>, sizes array<long>, "
    "n_known array<long>, base array<double>, others array<array<struct<word:binary,n:long>>>, "
    "known binary, back binary"
)


def _stored_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{CHUNKS}, chunk long").parquet(folder)


def _chunks(rows: DataFrame, model: Model, folder: str) -> DataFrame:
    """Texts as chunks of hashed tokens with their base scores, written to the shared folder."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(replace(model, docs=None))
    others_type = pa.list_(pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))

    def based(texts: list[list[bytes]]) -> tuple[np.ndarray, ...]:
        """Hashes, sizes, numbers of known words and base scores of texts, and their other words."""
        own = shared.value
        missing = 1.0 / (own.total + own.distinct + 1)
        sizes = np.array([len(words) for words in texts], np.int64)
        starts = np.cumsum(sizes) - sizes
        hashes = hash_words(list(chain.from_iterable(texts)))
        known, back = np.unique(hashes, return_inverse=True)
        count = _counts_of(known, own)[back]
        there = count > 0
        if own.all_words:
            base = np.log10((count + 1) * missing)
            others = [[] for _ in texts]
        else:
            base = np.where(there, np.log10((count + 1) * missing), 0.0)
            bounds = np.append(starts, len(hashes)).tolist()
            others = []
            for words, first, last in zip(texts, bounds, bounds[1:]):
                rest = Counter(words[i] for i in np.flatnonzero(~there[first:last]).tolist())
                others.append([{"word": word, "n": n} for word, n in rest.items()])
        n_known = np.add.reduceat(there.astype(np.int64), starts)
        return hashes, sizes, n_known, np.add.reduceat(base, starts), pa.array(others, others_type.value_type)

    def done(keys: list[tuple], parts: list[tuple]) -> pa.RecordBatch:
        hashes, sizes, n_known, base, others = zip(*parts)
        known, back = np.unique(np.concatenate(hashes), return_inverse=True)
        ids, trains = zip(*keys)
        every = pa.concat_arrays(others)
        columns = {
            "doc_ids": pa.array([ids], pa.list_(pa.int64())),
            "trains": pa.array([trains], pa.list_(pa.bool_())),
            "sizes": pa.array([np.concatenate(sizes)], pa.list_(pa.int64())),
            "n_known": pa.array([np.concatenate(n_known)], pa.list_(pa.int64())),
            "base": pa.array([np.concatenate(base)], pa.list_(pa.float64())),
            "others": pa.ListArray.from_arrays(pa.array([0, len(every)], pa.int32()), every),
            "known": pa.array([_packed_hashes(known)], pa.binary()),
            "back": pa.array([_packed(back.astype(np.uint32))], pa.binary()),
        }
        return pa.record_batch(columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, parts, held = [], [], 0
        texts, waiting = [], 0
        for batch in batches:
            marks = (batch.column(name).to_pylist() for name in ("doc_id", "trains"))
            for key, raw in zip(zip(*marks), raw_texts(batch)):
                keys.append(key)
                texts.append(tokens(raw))
                waiting += len(texts[-1])
                if waiting >= HASHED_TOKENS:
                    parts.append(based(texts))
                    held += waiting
                    texts, waiting = [], 0
                if held >= CHUNK_TOKENS:
                    yield done(keys, parts)
                    keys, parts, held = [], [], 0
        if texts:
            parts.append(based(texts))
        if parts:
            yield done(keys, parts)

    chunks = rows.mapInArrow(cut, CHUNKS).withColumn("chunk", F.monotonically_increasing_id())
    chunks.write.option("compression", "zstd").parquet(folder)
    return _stored_chunks(spark, folder)


def _scores(row: dict, classes: np.ndarray, tokens_: tuple, two_at: np.ndarray, model: Model, weight: float) -> list[pa.Array]:
    """The columns of SCORED for a chunk, from the count classes of its grams."""
    _, back, starts = tokens_
    end = int(back[-1])  # the last token of the last text
    logs = model_logs(classes, back, two_at, end, starts, model.total, model.distinct, weight)
    rows = len(starts)
    return [
        pa.array([row["chunk"]] * rows, pa.int64()),
        pa.array(range(rows), pa.int32()),
        pa.array(row["doc_ids"], pa.int64()),
        pa.array(row["sizes"], pa.int64()),
        pa.array(row["n_known"], pa.int64()),
        pa.array(row["base"], pa.float64()),
        pa.array(np.add.reduceat(logs, starts)),
    ]


_SCORED_NAMES = [field.split()[0] for field in SCORED.split(", ")]


def _without_words(model: Model) -> Model:
    none = np.zeros(0, np.int64)
    return replace(model, docs=None, word_hashes=none, word_counts=none)


def _by_broadcast(chunks: DataFrame, model: Model, weight: float) -> DataFrame:
    """Every chunk's scores in one task, which asks the whole filter: its size was checked."""
    spark, own = chunks.sparkSession, _without_words(model)
    rows = _segments_of(spark, model).select("block", "size", "bits").toArrow().to_pylist()
    whole = Filter.of(model.block_bits, [(row["block"], row["size"], row["bits"]) for row in rows])
    held = spark.sparkContext.broadcast(whole)
    del rows, whole

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            tokens_ = _tokens_of(row)[:3]
            grams, two_at = chunk_grams(*tokens_)
            classes = held.value.classes(grams, block_of(grams, own.block_bits))
            yield pa.record_batch(_scores(row, classes, tokens_, two_at, own, weight), names=_SCORED_NAMES)

    return chunks.drop("others").mapInArrow(run, SCORED)


def _combined(chunks: DataFrame, found: DataFrame, model: Model, weight: float) -> DataFrame:
    """The scores of each chunk's documents, from the answers of all blocks to its grams."""
    own_model = _without_words(model)

    def combine(own: pa.Table, answered: pa.Table) -> pa.Table:
        row = own.to_pylist()[0]
        tokens_ = _tokens_of(row)[:3]
        grams, two_at = chunk_grams(*tokens_)
        order, _ = by_block(grams, own_model.block_bits)
        classes = np.zeros(len(grams), np.uint8)
        parts = answered.sort_by("block")["classes"].to_pylist()
        classes[order] = np.concatenate([_unpacked(raw, np.uint8) for raw in parts])
        return pa.table(_scores(row, classes, tokens_, two_at, own_model, weight), names=_SCORED_NAMES)

    both = chunks.drop("others").groupBy("chunk").cogroup(found.groupBy("chunk"))
    return both.applyInArrow(combine, SCORED)


def _counts_of(hashes: np.ndarray, model: Model) -> np.ndarray:
    """The exact counts of frequent words, 0 for others."""
    if not len(model.word_hashes):
        return np.zeros(len(hashes), np.int64)
    at = np.searchsorted(model.word_hashes, hashes)
    at[at == len(model.word_hashes)] = 0
    return np.where(model.word_hashes[at] == hashes, model.word_counts[at], 0)


def _with_other_words(
    spark: SparkSession, scored: DataFrame, chunks: DataFrame, model: Model
) -> DataFrame:
    """Adds what the words outside the broadcast add to the base score."""
    places = chunks.select("chunk", F.posexplode("others").alias("place", "own"))
    words = places.select("chunk", "place", F.inline("own"))
    vocabulary = spark.read.schema("word binary, c long").parquet(model.vocabulary)
    count = F.coalesce("c", F.lit(0))
    logs = F.log10((count + 1) / F.lit(float(model.total + model.distinct + 1)))
    none = F.lit(None)
    added = words.join(vocabulary, "word", "left").select(
        "chunk",
        "place",
        none.cast("long").alias("doc_id"),
        none.cast("long").alias("n_tokens"),
        F.when(count > 0, F.col("n")).otherwise(0).alias("n_known"),
        (F.col("n") * logs).alias("base_score"),
        none.cast("double").alias("score"),
    )
    return (
        scored.unionByName(added)
        .groupBy("chunk", "place")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_tokens").alias("n_tokens"),
            F.sum("n_known").alias("n_known"),
            F.sum("base_score").alias("base_score"),
            F.max("score").alias("score"),
        )
    )
