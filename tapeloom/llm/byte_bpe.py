"""Byte-level BPE: encode whole texts, keep the offsets, decode the ids.

Texts are cut without a regular expression. Each character gets a class from an array
indexed by code point; classes of characters that depend on what follows are told apart by
comparing shifted arrays. A class acts on the state "what kind of piece are we in" as a
function. These few functions and all their compositions form a finite set, numbered once;
composing two of them is one table lookup. Composition is associative, so the state before
every character comes from a blocked scan of lookups over a whole chunk of texts, and
(state, class) tells whether a piece starts here. The pieces go through cached pair merging.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.words import only, raw_texts

# The letters after an apostrophe that make a piece with it.
SHORT_ENDINGS = ["s", "t", "m", "d"]
LONG_ENDINGS = ["re", "ve", "ll"]

CHUNK_CHARS = 1 << 19
CACHED_PIECES = 250_000
CACHED_CHARS = 40
SHORT_BYTES = 100
SCHEMA = "doc_id long, ids array<int>, ends array<int>, decoded binary"

# -- classes and states ---------------------------------------------------------------

LETTER, NUMBER, OTHER, QUOTE_1, QUOTE_2, SPACE, BLANK, INNER, FIRST = range(9)
"""QUOTE_1, QUOTE_2: an apostrophe with one or two ending letters after it. SPACE: a plain
space before a character that is no white space. BLANK: other white space at that place.
INNER: white space before more of it or before the end. FIRST: what stands between texts."""

(S_NEW, S_LETTER, S_NUMBER, S_OTHER, S_JOIN, S_INNER, S_LEFT_2, S_LEFT_1) = range(8)
"""S_NEW: whatever comes starts a piece. S_JOIN: after a space that the next run joins.
S_LEFT_n: n letters of a contraction are still to come."""


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The next state, and whether a piece starts at this character."""
    if kind == FIRST:
        return S_NEW, True
    if state in (S_LEFT_2, S_LEFT_1):
        return (S_LEFT_1 if state == S_LEFT_2 else S_NEW), False
    if kind == INNER:
        return S_INNER, state != S_INNER
    if kind == SPACE:
        return S_JOIN, True
    if kind == BLANK:
        return S_NEW, True
    joined = state == S_JOIN
    if kind in (QUOTE_1, QUOTE_2):
        if joined or state == S_OTHER:
            return S_OTHER, False
        return (S_LEFT_1 if kind == QUOTE_1 else S_LEFT_2), True
    run = {LETTER: S_LETTER, NUMBER: S_NUMBER, OTHER: S_OTHER}[kind]
    return run, not joined and state != run


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Composition, the state each function leads to from S_NEW, function of each class, starts."""
    states, kinds = range(8), range(9)
    of_class = [tuple(_step(s, k)[0] for s in states) for k in kinds]
    known = {tuple(states): 0}
    for function in of_class:
        known.setdefault(function, len(known))
    while True:
        pairs = [tuple(g[f[s]] for s in states) for f in list(known) for g in list(known)]
        before = len(known)
        for function in pairs:
            known.setdefault(function, len(known))
        if len(known) == before:
            break
    compose = np.array([known[f] for f in pairs], np.int16)
    reached = np.array([f[S_NEW] for f in known], np.int8)
    starts = np.array([[_step(s, k)[1] for k in kinds] for s in states])
    compose = compose.reshape(len(known), len(known))
    return compose, reached, np.array([known[f] for f in of_class], np.int16), starts


COMPOSE, REACHED, OF_CLASS, STARTS = _tables()
FUNCTIONS = len(REACHED)
_BETWEEN = 0x110000  # stands between two texts; no code point


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """LETTER, NUMBER, INNER (white space) or OTHER for every code point, as the library sees them."""
    single = {bytes([b]): b for b in range(256)}
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    found = np.full(_BETWEEN + 1, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", INNER)):
        coder = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        members = bytes(coder.encode_ordinary(every)).decode()
        found[np.frombuffer(members.encode("utf-32-le"), np.uint32)] = kind
    found[_BETWEEN] = FIRST
    return found


def classify(codes: np.ndarray) -> np.ndarray:
    """The class of each character, the following ones considered."""
    kinds = _classes()[codes]
    later = np.append(codes[1:], [_BETWEEN, _BETWEEN]).astype(np.uint32)
    white = kinds == INNER
    before_text = np.append(~white[1:] & (kinds[1:] != FIRST), False)
    kinds[white & before_text] = BLANK
    kinds[white & before_text & (codes == ord(" "))] = SPACE
    quotes = np.flatnonzero(codes == ord("'"))
    if len(quotes):
        next_1, next_2 = later[quotes], later[quotes + 1]
        one = np.isin(next_1, [ord(c) for c in SHORT_ENDINGS])
        two = np.zeros(len(quotes), bool)
        for a, b in LONG_ENDINGS:
            two |= (next_1 == ord(a)) & (next_2 == ord(b))
        kinds[quotes[two]] = QUOTE_2
        kinds[quotes[one]] = QUOTE_1
    return kinds


def scan(functions: np.ndarray) -> np.ndarray:
    """For each place the composition of all functions before it, in two levels of lookups."""
    count = len(functions)
    width = max(1, int(count**0.5) // 4)
    height = -(-count // width)
    grid = np.zeros(height * width, np.int16)
    grid[:count] = functions
    grid = np.ascontiguousarray(grid.reshape(height, width).T)
    before = np.empty_like(grid)
    total = np.zeros(height, np.int16)
    for place in range(width):
        before[place] = total
        total = COMPOSE[total, grid[place]]
    shift, carried = 1, total
    while shift < height:
        carried = np.concatenate(
            [carried[:shift], COMPOSE[carried[:-shift], carried[shift:]]]
        )
        shift *= 2
    entered = np.append(np.int16(0), carried[:-1])
    return COMPOSE[entered, before].T.reshape(-1)[:count]


def piece_starts(codes: np.ndarray) -> np.ndarray:
    """The places at which a piece starts, for texts each followed by the mark between texts."""
    kinds = classify(codes)
    state = REACHED[scan(OF_CLASS[kinds])]
    return np.flatnonzero(STARTS[state, kinds])


# -- merging --------------------------------------------------------------------------


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Join the neighbouring pair of the lowest rank, leftmost first, until none is known."""
    if piece in ranks:
        return [ranks[piece]]
    return (merge_short if len(piece) <= SHORT_BYTES else merge_long)(piece, ranks)


def merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Cuts and the ranks of the pairs around them in two lists; the least rank by scanning."""
    get, none = ranks.get, len(ranks) + 256
    cuts = list(range(len(piece) + 1))
    pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pairs:
        lowest = min(pairs)
        if lowest == none:
            break
        i = pairs.index(lowest)
        del cuts[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = get(piece[cuts[i] : cuts[i + 2]], none)
        if i:
            pairs[i - 1] = get(piece[cuts[i - 1] : cuts[i + 1]], none)
    return [ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:])]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """A heap of pairs over a linked list: n bytes take n log n steps, however long."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    after = list(range(1, len(parts) + 1))
    ahead = list(range(-1, len(parts) - 1))
    pairs = []
    for i in range(len(parts) - 1):
        rank = ranks.get(parts[i] + parts[i + 1])
        if rank is not None:
            pairs.append((rank, i))
    heapq.heapify(pairs)
    while pairs:
        rank, i = heapq.heappop(pairs)
        j = after[i] if parts[i] is not None else len(parts)
        if j >= len(parts) or ranks.get(parts[i] + parts[j]) != rank:
            continue
        parts[i] += parts[j]
        parts[j] = None
        after[i] = after[j]
        if after[i] < len(parts):
            ahead[after[i]] = i
        for left, right in ((ahead[i], i), (i, after[i])):
            if left >= 0 and right < len(parts):
                rank = ranks.get(parts[left] + parts[right])
                if rank is not None:
                    heapq.heappush(pairs, (rank, left))
    return [ranks[part] for part in parts if part is not None]


class Pieces(dict):
    """Ids by piece, in two generations: when the new one is full it becomes the old one.

    Long pieces, which seldom come again, are not kept.
    """

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.old: dict[str, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.old.get(piece)
        if ids is None:
            ids = tuple(merge(piece.encode(), self.ranks))
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(maxsize=2)
def _coder(path: str) -> tuple[Pieces, list[bytes], np.ndarray]:
    """The coder of a vocabulary, kept by the worker process over tasks."""
    ranks = load_ranks(path)
    bytes_of = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        bytes_of[rank] = piece
    return Pieces(ranks), bytes_of, np.array([len(b) for b in bytes_of], np.int64)


def encode_texts(texts: list[str], path: str) -> Iterator[tuple[list[int], np.ndarray]]:
    """For each text its ids, and where each id ends, in bytes."""
    pieces, _, lengths = _coder(path)
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(text) for text in texts], np.int64)
    ends = np.cumsum(sizes)
    marked = np.insert(codes, ends, _BETWEEN)
    starts = piece_starts(marked)
    starts = starts[marked[starts] != _BETWEEN]
    last = ends + np.arange(len(texts))  # the marks' places
    bounds = np.searchsorted(starts, np.append(0, last + 1))
    for k, text in enumerate(texts):
        own = starts[bounds[k] : bounds[k + 1]] - (last[k] - sizes[k])
        cuts = own.tolist() + [len(text)]
        found = map(pieces.__getitem__, (text[a:b] for a, b in zip(cuts, cuts[1:])))
        ids = list(chain.from_iterable(found))
        yield ids, np.cumsum(lengths[ids]) if ids else np.zeros(0, np.int64)


def decode_ids(ids: list[int], path: str) -> bytes:
    return b"".join(map(_coder(path)[1].__getitem__, ids))


def decode_range(ids: list[int], ends: list[int], first: int, last: int, path: str) -> bytes:
    """The bytes `first` to `last` of a text from the ids that cover them; the offsets find these."""
    a, b = int(np.searchsorted(ends, first, "right")), int(np.searchsorted(ends, last, "left")) + 1
    begin = ends[a - 1] if a else 0
    return decode_ids(ids[a:b], path)[first - begin : last - begin]


# -- operators ------------------------------------------------------------------------


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids, their end offsets in bytes and the decoded bytes of every text, in a map-only job.

    `path` names the vocabulary file, which every worker reads for itself. A null text counts
    as empty: no ids, no bytes. Repeated rows are each encoded; null ids are kept; further
    columns are ignored. Memory: one chunk of about half a million characters, or one text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(keys: list, texts: list[str]) -> pa.RecordBatch:
            ids, ends, decoded = [], [], []
            for own, own_ends in encode_texts(texts, path):
                ids.append(pa.array(own, pa.int32()))
                ends.append(own_ends.astype(np.int32))
                decoded.append(decode_ids(own, path))
            return pa.record_batch(
                {
                    "doc_id": pa.array(keys, pa.int64()),
                    "ids": _lists(ids),
                    "ends": _lists(ends),
                    "decoded": pa.array(decoded, pa.binary()),
                }
            )

        for batch in batches:
            keys, texts, held = [], [], 0
            for key, raw in zip(batch.column("doc_id").to_pylist(), raw_texts(batch)):
                keys.append(key)
                texts.append((raw or b"").decode("utf-8", "replace"))
                held += len(texts[-1]) + 1
                if held >= CHUNK_CHARS:
                    yield done(keys, texts)
                    keys, texts, held = [], [], 0
            if keys:
                yield done(keys, texts)

    rows = only(docs, id_column, text).toDF("doc_id", "text")
    return rows.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def _lists(arrays: list) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate([np.asarray(a) for a in arrays]) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The texts of stored ids: adds `decoded`, bytes, to the columns doc_id and ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode_ids(ids or [], path) for ids in batch.column("ids").to_pylist()]
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id"), "decoded": pa.array(texts, pa.binary())}
            )

    return only(encoded, "doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """Number of ids, and digests of the ids as decimal text and of the decoded bytes."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
