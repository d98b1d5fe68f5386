"""Helpers that run inside tasks: whole texts of a batch, their words and word windows.

A word is a maximal run of characters other than space, tab, line feed, vertical tab, form
feed and carriage return. None of these bytes occurs inside a longer UTF-8 character, so
`bytes.split()` finds exactly these words; `bytes.lower()` changes A-Z only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
WINDOW = 5
_MIX_1, _MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(33)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def raw_texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes | None]:
    """The UTF-8 bytes of each text, one at a time, so that only one is held besides the batch."""
    for value in batch.column(name):
        buffer = value.as_buffer()
        yield None if buffer is None else buffer.to_pybytes()


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    values = values ^ (values >> _SHIFT)
    values = values * _MIX_1
    values = values ^ (values >> _SHIFT)
    values = values * _MIX_2
    return values ^ (values >> _SHIFT)


def hash_windows(words: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """One hash for each window of `size` words; none for fewer words."""
    count = max(0, len(words) - size + 1)
    found = np.zeros(count, np.uint64)
    for place in range(size):
        found = mix(found * _STEP + words[place : place + count])
    return found


def word_count(text: Column | str) -> Column:
    """The number of words of a text; null counts as empty. Stays inside the JVM."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{BLANKS}|{BLANKS}$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, BLANKS))).cast("long")


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, each changed as far as needed to be no column of `docs` in any case of letters."""
    taken = {name.lower() for name in docs.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        found.append(name)
    return found


def only(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that further columns cannot clash with an operator's own."""
    return docs.select(*[F.col(f"`{name}`") for name in names])
