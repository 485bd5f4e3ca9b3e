"""Exact dedup by two passes over a Bloom filter of saturating cells.

Pass 1 counts, up to two, how many rows fall on each cell; a row can only have an equal one if all its
cells hold two or more. Pass 2 tests every row: those that can't be repeated go straight through, and
only the others (true repeats and a small share of false ones) are shuffled, as a digest and an id, never
as text. The filter has at most ``MAX_FILTER_BITS`` bits at any input size; past what it holds well, more
rows take the shuffle and the result is the same.

Defined results: a null text counts as empty; equal texts are those identical once each run of space and
U+0009 to U+000D is one space; of equal rows the smallest doc_id stays, null ids last, and one row only
stays where ids repeat; an empty table gives an empty result; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import scratch
from .text import SPACES

#: 64 MB: the proven bound of what pass 2 broadcasts.
MAX_FILTER_BITS = 1 << 29
CELLS_PER_KEY, PROBES, BLOCK_BITS = 16, 2, 1 << 18


def filter_bits(keys: int) -> int:
    return min(MAX_FILTER_BITS, max(BLOCK_BITS, 1 << (CELLS_PER_KEY * max(keys, 1) - 1).bit_length()))


def _cells(digests: pa.Array, bits: int) -> np.ndarray:
    """PROBES cells of each 32-byte digest, one row each."""
    words = np.frombuffer(b"".join(digests.to_pylist()), "<u8").reshape(-1, 4)
    return (words[:, :PROBES] & np.uint64(bits - 1)).astype(np.int64)


def _packed(offsets: np.ndarray) -> bytes:
    """A block's cells: sorted 32-bit offsets, or a bitmap where that is shorter."""
    if len(offsets) * 4 < BLOCK_BITS // 8:
        return b"s" + offsets.astype("<u4").tobytes()
    bitmap = np.zeros(BLOCK_BITS, bool)
    bitmap[offsets] = True
    return b"b" + np.packbits(bitmap).tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    if packed[:1] == b"b":
        return np.unpackbits(np.frombuffer(packed, np.uint8, offset=1)).astype(bool)
    bitmap = np.zeros(BLOCK_BITS, bool)
    bitmap[np.frombuffer(packed, "<u4", offset=1)] = True
    return bitmap


_CELLS = "block int, once binary, twice binary"


def _count_cells(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, n = np.unique(_cells(batch.column(0), bits), return_counts=True)
            blocks = cells // BLOCK_BITS
            at = np.flatnonzero(np.diff(blocks, prepend=-1))
            parts = [(int(blocks[a]), _packed(cells[a:b] % BLOCK_BITS), _packed(cells[a:b][n[a:b] > 1] % BLOCK_BITS)) for a, b in zip(at, [*at[1:], len(cells)], strict=True)]
            for k in range(0, len(parts), 256):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*parts[k : k + 256], strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], ["block", "once", "twice"])

    return run


def _merge_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block; one block's two bitmaps are held at a time."""
    held, once, twice = None, None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([held], pa.int32()), pa.array([np.packbits(twice).tobytes()], pa.binary())], ["block", "cells"])

    for batch in batches:
        for block, a, b in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if block != held:
                if held is not None:
                    yield out()
                held, once, twice = block, np.zeros(BLOCK_BITS, bool), np.zeros(BLOCK_BITS, bool)
            seen = _unpacked(a)
            twice |= _unpacked(b) | (once & seen)
            once |= seen
    if held is not None:
        yield out()


def repeated_cells(digests: DataFrame, bits: int) -> np.ndarray:
    """Bitmap, packed, of the cells on which two rows or more fall. digests: one binary column of 32 bytes."""
    merged = digests.mapInArrow(_count_cells(bits), _CELLS).repartition("block").sortWithinPartitions("block").mapInArrow(_merge_cells, "block int, cells binary")
    bitmap = np.zeros(bits // 8, np.uint8)
    for block, cells in merged.toLocalIterator():  # at most MAX_FILTER_BITS in all
        bitmap[block * BLOCK_BITS // 8 : (block + 1) * BLOCK_BITS // 8] = np.frombuffer(cells, np.uint8)
    return bitmap


def _judged(rows: DataFrame) -> DataFrame:
    """doc_id, row_no, digest, keep_id, group_size and kept, from doc_id, row_no and digest of each row, a written table."""
    bits = filter_bits(rows.count())
    cells = rows.sparkSession.sparkContext.broadcast(repeated_cells(rows.select("digest"), bits))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = cells.value
        for batch in batches:
            at = _cells(batch.column("digest"), bits)
            hit = (bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool).all(axis=1)
            yield batch.append_column("maybe", pa.array(hit, pa.bool_()))

    tested = scratch(rows.mapInArrow(test, "doc_id long, digest binary, row_no long, maybe boolean"), "tested")
    alone = tested.where("not maybe").select("doc_id", "row_no", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    maybe = tested.where("maybe")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("keep_id"), F.col("row_no").alias("keep_no"))).alias("first")
    # a written table, so that a digest of very many rows can be split in the join
    groups = scratch(maybe.groupBy("digest").agg(first, F.count("*").alias("group_size")), "groups")
    some = maybe.join(groups, "digest").select("doc_id", "row_no", "digest", F.col("first.keep_id").alias("keep_id"), "group_size", (F.col("row_no") == F.col("first.keep_no")).alias("kept"))
    return alone.unionByName(some)


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ").cast("binary"), 256))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), _digest(F.col(f"`{text_col}`")).alias("digest"), F.monotonically_increasing_id().alias("row_no"))
    return _judged(scratch(rows, "digests")).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns, of any name; rows are numbered once, so one only stays where rows repeat."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    doc, words = (F.col(names[docs.columns.index(c)]) for c in (id_col, text_col))
    rows = scratch(docs.toDF(*names).select("*", doc.cast("long").alias("doc_id"), _digest(words).alias("digest"), F.monotonically_increasing_id().alias("row_no")), "numbered")
    stays = _judged(rows.select("doc_id", "digest", "row_no")).where("kept").select("row_no")
    return rows.join(stays, "row_no", "left_semi").select(*names).toDF(*docs.columns)
