"""Exact Jaccard join of 5-word shingle sets, heavy-light by set size.

Texts with the same set are one class, so copies are compared once. Classes are then joined:

- Light sets, at most as large as a boundary, are joined by fixed-size subsets. Sets of sizes
  n and m link if they share c(n, m) shingles; every set gives its subsets of that size for
  every size a partner can have, and equal subsets are links, without further check.
- Heavy sets scan inverted lists. The list entries of a set are its first shingles by hash, so
  many that linked sets must share a part of them. Most shingles occur in one set only. What
  is left of a set, its entries that other sets have too, must be a certain number, or the set
  links with nothing; and of these entries the most frequent can be left out again, as many
  as linked sets cannot share alone. So a passage that very many texts hold is scanned only
  for texts that consist of little else.
- The boundary is where enumerating subsets starts to cost more rows than list entries.

Scanning is in two steps, as only components are wanted. Each list has a centre, the set of it
that shares most of its entries, such as the text that copies were made from. All sets of the
lists with one centre are its group; sets of one list are always in one group. First, every set
is checked against the centres of its groups, exactly, on whole sets, which gives components.
Then the sets of a group that are not connected yet are compared with each other, in blocks of
bounded size by products of incidence matrices, and only the links that connect anything leave
the task. So no pairs of a large group are ever written, and no link between different
components is lost. Shingles are 64-bit hashes of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.llm.components import components
from tapeloom.llm.words import WINDOW, hash_windows, hash_words, mix, only, raw_texts, unused
from tapeloom.sources.paths import shared_dir

# The similarity, 3/4, as whole numbers.
OVER, UNDER = 3, 4
SHARED_PERCENT = 15  # of a set that linked sets surely share among their list entries
LARGEST_LIGHT = 12
LEAST_BUCKETS = 256
CHUNK_ENTRIES = 1 << 20
CHECK_FILTER_BITS = 1 << 26  # 8 MB, whatever the corpus
BLOCK_SETS, BLOCK_SHINGLES = 1024, 1 << 20  # of a block of a group, on average at most
MATRIX_COLUMNS = 4096
TOKEN_BYTES, SET_BYTES = 5, 6
_SET_MASK = (1 << (8 * SET_BYTES)) - 1


def _up(a: int, b: int) -> int:
    return -(-a // b)


def least_overlap(n: int, m: int) -> int:
    """How many shingles sets of these sizes share at least if they link."""
    return _up(OVER * (n + m), OVER + UNDER)


def least_partner(n: int) -> int:
    return _up(OVER * n, UNDER)


def sure_entries(n: int) -> int:
    """How many entries a set of n shingles surely shares with a linked set no smaller."""
    return _up(SHARED_PERCENT * n, 100)


def entries(n: int) -> int:
    """How many list entries a set has: the lemma of longer prefixes, for any partner's size."""
    return n - least_partner(n) + sure_entries(n)


def shingle_set(raw: bytes | None) -> np.ndarray:
    """The sorted distinct shingles of a text; of fewer than five words, all of them as one."""
    words = (raw or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    size = min(WINDOW, len(words))
    return np.unique(mix(hash_windows(hash_words(words), size) + np.uint64(size)))


def set_key(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


SETS = "doc_id long, set long, n long, small binary"


def find_sets(rows: DataFrame) -> DataFrame:
    """The set of each document: its key and size, and `small`, the shingles of a small set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (set_key(s), len(s), s.tobytes() if 0 < len(s) <= LARGEST_LIGHT else None)
                for s in map(shingle_set, raw_texts(batch))
            ]
            keys, sizes, small = zip(*found) if found else ((), (), ())
            arrays = [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(small, pa.binary())]
            yield pa.record_batch([batch.column("doc_id"), *arrays], names=["doc_id", "set", "n", "small"])

    return rows.mapInArrow(run, SETS)


def distinct_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Each set of a task's texts once, with its key."""
    seen: set[int] = set()
    for batch in batches:
        for raw in raw_texts(batch):
            shingles = shingle_set(raw)
            key = set_key(shingles)
            if len(shingles) and key not in seen:
                seen.add(key)
                yield key, shingles


# -- light sets -----------------------------------------------------------------------


def partner_sizes(n: int) -> range:
    return range(least_partner(n), UNDER * n // OVER + 1)


def subset_count(n: int) -> int:
    return sum(comb(n, least_overlap(n, m)) for m in partner_sizes(n))


def boundary(sizes: dict[int, int]) -> int:
    """The largest light size: the one with the least cost, in rows and numbers moved.

    `sizes` counts the sets of each size up to LARGEST_LIGHT. A subset is written and joined.
    A list entry is listed, shared and scanned, and the sets it leads to are moved whole for
    the check, as either side. Light sets that can have heavy partners are listed as well.
    """

    def cost(limit: int) -> int:
        light = sum(2 * k * subset_count(n) for n, k in sizes.items() if n <= limit)
        listed = least_partner(limit + 1) if limit else 1
        return light + sum(k * (3 * entries(n) + 2 * n) for n, k in sizes.items() if n >= listed)

    return min(range(LARGEST_LIGHT + 1), key=cost)


def subset_keys(shingles: np.ndarray) -> Iterator[tuple[int, bool]]:
    """The keys of a light set's subsets, and whether it is one of the smaller of the two sizes."""
    n = len(shingles)
    values = shingles.tolist()
    for m in partner_sizes(n):
        low, high = min(n, m), max(n, m)
        for subset in combinations(values, least_overlap(n, m)):
            raw = np.array([low, high, *subset], np.uint64).tobytes()
            yield xxhash.xxh3_64_intdigest(raw) - (1 << 63), n == low


def light_links(sets: DataFrame, limit: int, folder: str) -> DataFrame:
    """Links (a, b) among sets of at most `limit` shingles.

    Of the sets with an equal subset, those of the smaller size link with all; so all link
    with the smallest key among these, and nothing else is needed for components.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.bool_()]
        for batch in batches:
            found = [
                (subset, key, low)
                for key, small in zip(batch.column("set").to_pylist(), batch.column("small"))
                for subset, low in subset_keys(np.frombuffer(small.as_buffer(), np.uint64))
            ]
            columns = list(zip(*found)) or [()] * 3
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.record_batch(arrays, names=["subset", "set", "low"])

    light = sets.where(F.col("n").between(1, limit)).select("set", "small").distinct()
    subsets = light.mapInArrow(run, "subset long, set long, low boolean").distinct()
    subsets.write.parquet(f"{folder}/subsets")
    subsets = sets.sparkSession.read.schema(subsets.schema).parquet(f"{folder}/subsets")
    centres = subsets.groupBy("subset").agg(
        F.min(F.when(F.col("low"), F.col("set"))).alias("a"), F.count(F.lit(1)).alias("k")
    )
    centres.where("a is not null and k > 1").drop("k").write.parquet(f"{folder}/centres")
    centres = sets.sparkSession.read.schema("subset long, a long").parquet(f"{folder}/centres")
    links = subsets.join(centres, "subset").where(F.col("a") != F.col("set"))
    return links.select("a", F.col("set").alias("b")).distinct()


# -- inverted lists -------------------------------------------------------------------


def _pack(values: np.ndarray, size: int) -> np.ndarray:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]


def _unpack(parts: list[bytes], size: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, size)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :size] = raw
    return wide.view("<u8").reshape(-1)


def short_key(column: str) -> Column:
    """The low bits of a set's key, by which list entries know it.

    Sets that share them by chance share list entries too, which can only add pairs to check.
    """
    return F.col(column).bitwiseAND(F.lit(_SET_MASK))


def list_blocks(rows: DataFrame, least: int, bits: int) -> DataFrame:
    """Packed list entries, one row for each bucket of shingles and chunk of sets."""
    mask = np.uint64((1 << bits) - 1)

    def out(tokens: list[np.ndarray], owners: list[np.ndarray]) -> pa.RecordBatch:
        token, owner = np.concatenate(tokens), np.concatenate(owners)
        bucket = (token & mask).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        packed, whose = _pack(token[order] >> np.uint64(bits), TOKEN_BYTES), _pack(owner[order], SET_BYTES)
        numbers, first = np.unique(bucket[order], return_index=True)
        edges = [*first.tolist(), len(token)]
        cut = list(zip(edges, edges[1:]))
        return pa.record_batch(
            {
                "bucket": pa.array(numbers, pa.int32()),
                "tokens": pa.array([packed[a:b].tobytes() for a, b in cut], pa.binary()),
                "owners": pa.array([whose[a:b].tobytes() for a, b in cut], pa.binary()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, owners, held = [], [], 0
        for key, shingles in distinct_sets(batches):
            if len(shingles) < least:
                continue
            own = shingles[: entries(len(shingles))]
            tokens.append(own)
            owners.append(np.full(len(own), key & _SET_MASK, np.uint64))
            held += len(own)
            if held >= CHUNK_ENTRIES:
                yield out(tokens, owners)
                tokens, owners, held = [], [], 0
        if tokens:
            yield out(tokens, owners)

    return rows.select("text").mapInArrow(run, "bucket int, tokens binary, owners binary")


def shared_entries(blocks: DataFrame, bits: int) -> DataFrame:
    """The entries (owner, token, df) whose shingle is listed for two sets or more."""

    def count(table: pa.Table) -> pa.Table:
        token = _unpack(table["tokens"].to_pylist(), TOKEN_BYTES)
        owner = _unpack(table["owners"].to_pylist(), SET_BYTES)
        order = np.lexsort((owner, token))
        token, owner = token[order], owner[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
        token, owner = token[new], owner[new]
        _, place, counts = np.unique(token, return_inverse=True, return_counts=True)
        df = counts[place]
        several = df > 1
        whole = (token[several] << np.uint64(bits)) | np.uint64(table["bucket"][0].as_py())
        return pa.table(
            {
                "owner": pa.array(owner[several].astype(np.int64)),
                "token": pa.array(whole.astype(np.int64)),
                "df": pa.array(df[several].astype(np.int32)),
            }
        )

    return blocks.groupBy("bucket").applyInArrow(count, "owner long, token long, df int")


def list_entries(shared: DataFrame, sets: DataFrame) -> DataFrame:
    """The entries that are scanned: of each set's shared ones the rarest, all that are needed.

    A set shares `sure` of its entries with any partner. With fewer shared ones it has none;
    otherwise a partner is among the lists of all but the `sure - 1` most frequent ones.
    `alone` is the part of its entries that no other set has.
    """
    partner = F.ceil(F.col("n") * OVER / UNDER)
    sure = F.ceil(partner * SHARED_PERCENT / 100).cast("int")
    all_entries = F.col("n") - partner + F.ceil(F.col("n") * SHARED_PERCENT / 100)
    sizes = sets.where("n > 0").groupBy(short_key("set").alias("owner")).agg(
        F.min("n").alias("n"), F.max("n").alias("most")
    )
    own = shared.groupBy("owner").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("own"))
    kept = own.join(sizes, "owner").withColumn("sure", sure).where(F.size("own") >= F.col("sure"))
    scanned = F.slice("own", 1, F.size("own") - F.col("sure") + 1)
    alone = 1 - F.size("own") / all_entries
    return kept.select("owner", "n", "most", alone.alias("alone"), F.explode(scanned).alias("entry")).select(
        "owner", "n", "most", "alone", "entry.token"
    )


def group_members(listed: DataFrame, folder: str) -> DataFrame:
    """(centre, owner, n, most, c_n, c_most) of every set and every centre of one of its lists."""
    order = F.struct("alone", F.xxhash64("owner").alias("h"), "owner", "n", "most")
    centres = listed.groupBy("token").agg(F.min(order).alias("c"))
    names = ["token", "centre", "c_n", "c_most"]
    centres = centres.select("token", "c.owner", "c.n", "c.most").toDF(*names)
    centres.write.parquet(f"{folder}/list-centres")
    schema = "token long, centre long, c_n long, c_most long"
    centres = listed.sparkSession.read.schema(schema).parquet(f"{folder}/list-centres")
    return listed.join(centres, "token").select(
        "centre", "owner", "n", "most", "c_n", "c_most"
    ).distinct()


def centre_pairs(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of each centre and the sets of its group that are of a size to link."""
    fits = (UNDER * F.col("most") >= OVER * F.col("c_n")) & (UNDER * F.col("c_most") >= OVER * F.col("n"))
    others = members.where((F.col("centre") != F.col("owner")) & fits)
    return others.select(F.col("centre").alias("a"), F.col("owner").alias("b"))


def spanning_links(
    sets: list[np.ndarray], sides: np.ndarray, labels: np.ndarray
) -> Iterator[tuple[int, int]]:
    """Links (i, j) that connect different labels, none that connects nothing new.

    `sides` tells the block of each set; with two blocks only pairs across them are looked at,
    as the pairs inside are another task's. Overlaps are summed over columns of shingles.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    numbers = np.cumsum(counts > 1) - 1
    row = np.repeat(np.arange(len(sets)), sizes)
    several = counts[column] > 1
    row, column = row[several], numbers[column[several]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, MATRIX_COLUMNS):
        a, b = np.searchsorted(column, [first, first + MATRIX_COLUMNS])
        incidence = np.zeros((len(sets), min(MATRIX_COLUMNS, int(column[-1]) + 1 - first)), np.float32)
        incidence[row[a:b], column[a:b] - first] = 1
        common += incidence @ incidence.T
    labels = labels.copy()
    two_blocks = sides.min() != sides.max()
    for i in range(len(sets)):
        links = UNDER * common[i] >= OVER * (sizes[i] + sizes - common[i])
        links &= labels != labels[i]
        if two_blocks:
            links &= sides != sides[i]
        if links.any():
            joined, first = np.unique(labels[links], return_index=True)
            for j in np.flatnonzero(links)[first].tolist():
                yield i, j
            labels[np.isin(labels, joined)] = labels[i]


def open_links(members: DataFrame, known: DataFrame, whole: DataFrame, buckets: int) -> DataFrame:
    """Links (a, b), by whole keys, between sets of a group that are not connected yet.

    `known` gives the component of each set that has one. Groups within one component have
    nothing to find. A group is dealt to blocks of bounded size; a task sees two of them.
    """
    named = members.join(known, members["owner"] == known["node"], "left").select(
        "centre", "owner", "n", F.coalesce("component", "owner").alias("component")
    )
    others = F.col("owner") != F.col("centre")
    groups = named.groupBy("centre").agg(
        F.min(F.when(others, F.col("component"))).alias("low"),
        F.max(F.when(others, F.col("component"))).alias("high"),
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)
        ).cast("int").alias("blocks"),
    )
    mixed = groups.where("low < high").select("centre", "blocks")
    dealt = (
        named.where(others)
        .join(mixed, "centre")
        .withColumn("block", F.pmod(F.xxhash64("owner"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .select("centre", "low", "high", "block", "owner", "component")
    )
    bucket = F.pmod(F.xxhash64("centre", "low", "high"), F.lit(buckets)).cast("int")
    rows = dealt.join(whole, "owner").select(
        bucket.alias("bucket"), "centre", "low", "high", "block", "component", "set", "shingles"
    )

    def scan(table: pa.Table) -> pa.Table:
        table = table.sort_by([("centre", "ascending"), ("low", "ascending"), ("high", "ascending")])
        keys = np.stack([table[name].to_numpy().astype(np.int64) for name in ("centre", "low", "high")])
        edges = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0))).tolist()
        names, sides = table["set"].to_numpy(), table["block"].to_numpy()
        labels, shingles = table["component"].to_numpy(), table["shingles"].combine_chunks()
        at, values = shingles.offsets.to_numpy(), shingles.values.to_numpy()
        found = []
        for first, last in zip(edges, [*edges[1:], table.num_rows]):
            if len(np.unique(labels[first:last])) > 1:
                sets = [values[at[i] : at[i + 1]] for i in range(first, last)]
                links = spanning_links(sets, sides[first:last], labels[first:last])
                found += [(names[first + i], names[first + j]) for i, j in links]
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("bucket").applyInArrow(scan, "a long, b long")


# -- exact checks ---------------------------------------------------------------------


def key_filter(keys: DataFrame) -> np.ndarray:
    """A bit array of fixed size with a few bits for each key: never says no to one of them."""
    blocks = 64
    bits = CHECK_FILTER_BITS // blocks

    def fill(table: pa.Table) -> pa.Table:
        own = np.zeros(bits, bool)
        for place in _filter_places(table["key"].to_numpy().astype(np.uint64), bits):
            own[place] = True
        packed = np.packbits(own, bitorder="little").tobytes()
        return pa.table(
            {"block": pa.array([table["block"][0].as_py()], pa.int32()), "bits": pa.array([packed], pa.binary())}
        )

    block = F.col("key").bitwiseAND(F.lit(blocks - 1)).cast("int")
    found = keys.select("key").withColumn("block", block)
    rows = found.groupBy("block").applyInArrow(fill, "block int, bits binary").toArrow()
    whole = np.zeros((blocks, bits // 8), np.uint8)
    for number, own in zip(rows["block"].to_pylist(), rows["bits"]):
        whole[number] = np.frombuffer(own.as_buffer(), np.uint8)
    return whole


def _filter_places(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    spread = mix(keys)
    step = (spread >> np.uint64(32)) | np.uint64(1)
    for probe in range(3):
        yield ((spread + np.uint64(probe) * step) % np.uint64(bits)).astype(np.int64)


def _maybe_in(key: int, whole: np.ndarray) -> bool:
    own = whole[key & (len(whole) - 1)]
    places = _filter_places(np.array([key], np.uint64), whole.shape[1] * 8)
    return all(own[p[0] >> 3] >> (p[0] & 7) & 1 for p in places)


def whole_sets(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The shingles of the sets named by `keys`, and perhaps of some others, each once.

    The filter that picks them in the tasks has a fixed size. When a corpus overfills it, it
    lets more sets pass, which costs time only.
    """
    picked = rows.sparkSession.sparkContext.broadcast(key_filter(keys))

    def out(found: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        names, sets = zip(*found)
        offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        values = pa.array(np.concatenate(sets).view(np.int64))
        return pa.record_batch(
            {
                "owner": pa.array([name & _SET_MASK for name in names], pa.int64()),
                "set": pa.array(names, pa.int64()),
                "shingles": pa.ListArray.from_arrays(pa.array(offsets), values),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, np.ndarray]] = []
        for key, shingles in distinct_sets(batches):
            if _maybe_in(key & _SET_MASK, picked.value):
                found.append((key, shingles))
            if len(found) >= 256:
                yield out(found)
                found = []
        if found:
            yield out(found)

    each = rows.select("text").mapInArrow(run, "owner long, set long, shingles array<long>")
    return each.dropDuplicates(["set"])


def checked(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """The links (a, b), by whole keys, among pairs of short keys: shared over all shingles."""
    first = whole.toDF("a", "a_set", "a_shingles")
    second = whole.toDF("b", "b_set", "b_shingles")
    both = pairs.join(first, "a").join(second, "b")
    common = F.size(F.array_intersect("a_shingles", "b_shingles"))
    union = F.size("a_shingles") + F.size("b_shingles") - common
    return both.where(UNDER * common >= OVER * union).select(F.col("a_set").alias("a"), F.col("b_set").alias("b"))


# -- operator -------------------------------------------------------------------------


def link_sets(rows: DataFrame, sets: DataFrame, folder: str, limit: int | None = None) -> DataFrame:
    """(node, component) of every set that links with another. `rows` has the texts.

    `limit` is the largest light size, if it is not to be chosen by cost.
    """
    spark = rows.sparkSession

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    small = sets.where(F.col("n").between(1, LARGEST_LIGHT)).select("set", "n").distinct()
    if limit is None:
        limit = boundary({row["n"]: row["count"] for row in small.groupBy("n").count().collect()})
    least = least_partner(limit + 1) if limit else 1
    wanted = max(LEAST_BUCKETS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    bits = (wanted - 1).bit_length()

    shared = shared_entries(list_blocks(rows, least, bits), bits)
    listed = stored(list_entries(shared, sets), "listed")
    members = stored(group_members(listed, folder), "members")
    whole = stored(whole_sets(rows, members.select(F.col("owner").alias("key"))), "whole")
    links = stored(checked(centre_pairs(members), whole), "links-1")
    if limit:
        links = links.unionByName(stored(light_links(sets, limit, folder), "links-light"))
    known = stored(components(links), "components-1")
    # whole keys that share a short one give their set several labels, which loses no link
    short = known.select(short_key("node").alias("node"), short_key("component").alias("component"))
    more = stored(open_links(members, short, whole, 1 << bits), "links-2")
    return joined_components(known, more, folder)


def joined_components(known: DataFrame, more: DataFrame, folder: str) -> DataFrame:
    """(node, component) when further links join components: the graph of these alone is solved."""
    named = known.withColumnsRenamed({"node": "_node", "component": "_component"})
    for end in ("a", "b"):
        more = more.join(named, more[end] == named["_node"], "left").select(
            F.coalesce("_component", end).alias(end), *[c for c in ("a", "b") if c != end]
        )
    # nodes without a component so far are components of themselves
    found = components(more).toDF("_old", "_new")
    found.write.parquet(f"{folder}/components-2")
    found = known.sparkSession.read.schema(found.schema).parquet(f"{folder}/components-2")
    moved = known.join(found, known["component"] == found["_old"], "left").select(
        "node", F.coalesce("_new", "component").alias("component")
    )
    alone = found.join(known, found["_old"] == known["node"], "left_anti").toDF("node", "component")
    return moved.unionByName(alone)


def document_sets(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", limit: int | None = None
) -> DataFrame:
    """(doc_id, set, n, component, component_id) of every document.

    `component` is one key for all sets of a component, null for an empty set.
    """
    spark: SparkSession = docs.sparkSession
    rows = only(docs, id_column, text).toDF("doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    folder = shared_dir(spark, "ngram-join")
    find_sets(rows).write.parquet(f"{folder}/sets")
    sets = spark.read.schema(SETS).parquet(f"{folder}/sets")

    linked = link_sets(rows, sets, folder, limit)
    classes = sets.where("n > 0").groupBy("set").agg(F.min("doc_id").alias("first"))
    named = classes.join(linked, classes["set"] == linked["node"], "left").select(
        "set", "first", F.coalesce("component", "set").alias("component")
    )
    named.write.parquet(f"{folder}/named")
    named = spark.read.schema(named.schema).parquet(f"{folder}/named")
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_set = named.join(smallest, "component").select(F.col("set").alias("_set"), "component", "component_id")
    of_set.write.parquet(f"{folder}/result")
    of_set = spark.read.schema(of_set.schema).parquet(f"{folder}/result")
    joined = sets.join(of_set, (sets["set"] == of_set["_set"]) & (sets["n"] > 0), "left")
    alone = F.when(F.col("n") == 0, F.col("doc_id"))
    return joined.select(
        "doc_id", "set", "n", "component", F.coalesce("component_id", alone).alias("component_id")
    )


def join_documents(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", limit: int | None = None
) -> DataFrame:
    """Set size and component of every document: links are Jaccard 0.75 or more of shingles.

    `component_id` is the smallest id reachable by links, the document's own included; ids
    that are null are left out of that, and a component of such documents only has none.
    Null, empty and blank texts have an empty set and link with nothing. Repeated rows, and
    different documents with equal sets, are one class and in one component. Further columns
    are ignored.
    """
    found = document_sets(docs, id_column, text, limit)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, with all their columns, of one document of each component.

    The one with the smallest id stays; null ids come last. Of rows that repeat both its id
    and its set one stays. Documents with an empty set all stay. Texts are not shuffled unless
    the table of what goes is too large to broadcast.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark, "keep-one")
    document_sets(docs, id_column, text).write.parquet(f"{folder}/sets")
    schema = "doc_id long, set long, n long, component long, component_id long"
    found = spark.read.schema(schema).parquet(f"{folder}/sets").where("component is not null")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "set")
    first = found.groupBy("component").agg(F.min(rank).alias("first"))
    each = found.groupBy("component", "doc_id", "set").agg(F.count(F.lit(1)).alias("k"))
    judged = each.join(first, "component").withColumn(
        "stays", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("set") == F.col("first.set"))
    )
    judged = judged.where("not stays or k > 1").select(
        F.col("doc_id").alias("_doc_id"), F.col("set").alias("_key"), "stays"
    )
    judged.write.parquet(f"{folder}/judged")
    judged = spark.read.schema("_doc_id long, _key long, stays boolean").parquet(f"{folder}/judged")

    (own,) = unused(docs, "_set")
    tagged, id_name = _with_set(docs, text, own), f"`{id_column}`"
    same = tagged[id_name].cast("long").eqNullSafe(judged["_doc_id"]) & (tagged[own] == judged["_key"])
    rest = tagged.join(judged, same, "left_anti")
    repeated = judged.where("stays")
    if not repeated.isEmpty():
        same = tagged[id_name].cast("long").eqNullSafe(repeated["_doc_id"]) & (tagged[own] == repeated["_key"])
        once = tagged.join(repeated, same, "left_semi").dropDuplicates([id_column, own])
        rest = rest.unionByName(once)
    return rest.drop(own)


def _with_set(docs: DataFrame, text: str, name: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [set_key(shingle_set(raw)) for raw in raw_texts(batch, text)]
            yield batch.append_column(name, pa.array(keys, pa.int64()))

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    return docs.mapInArrow(run, schema)
