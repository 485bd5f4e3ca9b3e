"""Words, shingles and slices of text, shared by the operators that work in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What separates words: space and U+0009 to U+000D, nothing else.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about max_bytes of text, so that memory follows the bytes, not the rows.

    One row longer than max_bytes makes a slice of its own; whole texts stay together.
    """
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    run = (np.cumsum(sizes) - sizes) // max_bytes
    cuts = np.flatnonzero(np.diff(run)) + 1
    for start, stop in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield batch.slice(start, stop - start)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(word codes, words per row, the distinct words by code) of a string array; null counts as empty."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    filled = np.asarray(pc.not_equal(pc.binary_length(flat), 0))  # leading or trailing space gives an empty piece
    ends = np.asarray(lists.offsets).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(filled)])
    start = ends[0]
    counts = before[ends[1:] - start] - before[ends[:-1] - start]
    coded = flat.filter(pa.array(filled)).dictionary_encode()
    return np.asarray(coded.indices).astype(np.int64), counts, coded.dictionary


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def hash_words(words: pa.Array) -> np.ndarray:
    import xxhash

    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w) for w in words.cast(pa.binary()).to_pylist()), dtype=np.uint64, count=len(words))


def sort_rows(values: np.ndarray, counts: np.ndarray) -> None:
    """Sorts each row's stretch of values in place."""
    ends = np.cumsum(counts).tolist()
    start = 0
    for end in ends:
        values[start:end].sort()
        start = end


def shingles_of(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit shingle hashes, shingles per row), each row's hashes distinct and ascending.

    Words are lower-cased in A-Z only. A row of fewer than n words has its whole sequence as its only
    shingle; a row without words has none.
    """
    codes, counts, words = words_of(pc.ascii_lower(pc.fill_null(texts, "")))
    if not len(codes):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    h = hash_words(words)[codes]
    rows = np.repeat(np.arange(len(counts)), counts)
    starts = np.repeat(np.cumsum(counts) - counts, counts)
    place, size = np.arange(len(codes)) - starts, np.repeat(counts, counts)
    with np.errstate(over="ignore"):
        rolled, short = np.zeros(len(h), np.uint64), size < n
        for k in range(n):
            part = np.zeros(len(h), np.uint64)
            part[: max(len(h) - k, 0)] = h[k:]
            rolled = np.where(short & (place + k >= size), rolled, mix(rolled * np.uint64(0x9E3779B97F4A7C15) + part + np.uint64(k + 1)))
        rolled = np.where(short, mix(rolled + size.astype(np.uint64)), rolled)
    use = np.where(short, place == 0, place <= size - n)
    rolled, rows = rolled[use], rows[use]
    sort_rows(rolled, np.bincount(rows, minlength=len(counts)))
    first = np.ones(len(rolled), bool)
    first[1:] = (rolled[1:] != rolled[:-1]) | (rows[1:] != rows[:-1])
    return rolled[first], np.bincount(rows[first], minlength=len(counts))
