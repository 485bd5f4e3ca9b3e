"""Best-fit packing into sequences of a fixed number of tokens by minimum bin slack.

Texts become token ids in Arrow batches and are cut where they are longer than a sequence. Only a histogram
of piece lengths, at most ``capacity`` counts at any input size, goes to the driver. There, per bin, the
longest length left is seated and a bitset subset-sum over the lengths left, each as often as it is there,
finds the fullest feasible filling; the combination is removed as often as the counts allow at one stroke,
which is what taking it bin by bin would do. Pieces then find their place by their rank within their
length, taken in chunks, so that no length is ever in one task.

Defined results: null text counts as empty and is its end token alone; the first piece of a long text is
the shorter one; rows that repeat are packed each on their own; an empty table gives an empty result; only
the id and text columns are read. Ids are those of ``tokenizers`` without special tokens added: an added token
of the file that stands in a text has its own id.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import scratch
from .text import slices

CAPACITY, END_ID, CHUNK = 2048, 0, 4096
#: Distinct stretches of text whose ids a worker remembers; then it starts anew.
REMEMBERED = 500_000
#: Stretches of more bytes go to ``tokenizers`` itself: on a million spaces the faster encoder's pattern exhausts its stack.
LONG_STRETCH = 100_000


#: Fixed value: the pre-tokenizer of byte-level BPE files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _bytes_of_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable ones stand for themselves, the others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level BPE tokenizer file, equal to those that ``tokenizers`` gives each text whole.

    The file's vocabulary is its merge order, so its ids serve as ranks. Its pre-tokenizer never lets a
    token start with anything but white space run over white space, so a text may be cut before a space or
    newline that follows a character known not to be white space. Added tokens are found first, leftmost and
    longest, and what stands before and after one is encoded apart from it. Each distinct stretch is encoded
    once and its ids are copied to where it occurs.
    """

    def __init__(self, path: str):
        import json

        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        tokens = file.get("added_tokens") or []
        if any(t.get(flag) for t in tokens for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: added tokens that look at their surroundings or at normalised text are not supported")
        special = {t["content"]: t["id"] for t in tokens if t["content"]}
        self.added = {content.encode(): k for content, k in special.items()}
        self.finder = re.compile(b"|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)))
        letters = _bytes_of_letters()
        ranks = {bytes(letters[c] for c in token): rank for token, rank in file["model"]["vocab"].items() if token not in special}
        self.encode = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.path = path
        self.known: dict[bytes, int] = {}
        self.ids, self.ends = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _added_tokens(self, texts: pa.Array, data: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
        """Where added tokens start and end, text by text, so that none is found across two texts."""
        holds = np.zeros(len(texts), bool)
        for token in self.added:
            holds |= np.asarray(pc.match_substring(texts, token.decode()))
        spans = []
        for k in np.flatnonzero(holds).tolist():
            first, last = int(ends[k]), int(ends[k + 1])
            spans += [(first + m.start(), first + m.end()) for m in self.finder.finditer(data[first:last].tobytes())]
        return spans

    def _stretches(self, data: np.ndarray, ends: np.ndarray, added: list[tuple[int, int]]) -> np.ndarray:
        """Where stretches start, ends of the texts and of added tokens among them."""
        white = (data == 0x20) | (data == 0x0A)
        before, lead = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
        before[1:], lead[2:] = data[:-1], data[:-2]
        solid = ((before > 0x20) & (before < 0x7F)) | ((before >= 0x80) & (lead >= 0xC3) & (lead <= 0xCA))
        cut = white & solid
        cut[ends[ends < len(data)]] = True
        cut[0] = True
        for start, stop in added:
            cut[start], cut[start + 1 : stop], cut[stop : stop + 1] = True, False, True
        return np.flatnonzero(cut)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text)."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        cuts = self._stretches(data, ends, self._added_tokens(texts, data, ends))
        offsets = np.append(cuts, len(data)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        places = self._places(coded.dictionary.to_pylist())
        flat, stops = self.ids, self.ends
        place = places[np.asarray(coded.indices)]
        starts, sizes = stops[place], stops[place + 1] - stops[place]
        after = np.cumsum(sizes)
        ids = flat[np.arange(after[-1]) + np.repeat(starts - (after - sizes), sizes)]
        until = np.append(0, after)[np.searchsorted(cuts, ends)]
        return ids, np.diff(until)

    def _long(self, stretch: str) -> list[int]:
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path).encode(stretch, add_special_tokens=False).ids

    def _places(self, stretches: list[bytes]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known, self.ids, self.ends = {}, self.ids[:0], self.ends[:1]
        new = [s for s in stretches if s not in self.known]
        if new:
            encode, first = self.encode, len(self.known)
            lists = [[self.added[s]] if s in self.added else encode(s.decode()) if len(s) <= LONG_STRETCH else self._long(s.decode()) for s in new]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            self.known.update(zip(new, range(first, first + len(new)), strict=True))
            self.ids = np.append(self.ids, np.fromiter(chain.from_iterable(lists), np.uint32, sizes.sum()))
            self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(sizes))
        return np.fromiter(map(self.known.__getitem__, stretches), np.int64, len(stretches))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for all tasks of a worker."""
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids; one row per piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                ids, sizes = encode(part.column("text"))
                ids = np.insert(ids, np.cumsum(sizes), end_id).astype("<u4")
                sizes = sizes + 1
                n = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                stop = sizes[row] - (n[row] - 1 - piece) * capacity
                start = np.maximum(stop - capacity, 0)
                base = np.repeat(np.cumsum(sizes) - sizes, n)
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(base + start, base + stop, strict=True)]
                out = [part.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(stop - start, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(stop - start)), pa.int32()), pa.array(ids.view("<i4"))))
                yield pa.RecordBatch.from_arrays(out, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(out)])

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def _fullest(room: int, counts: dict[int, int]) -> list[tuple[int, int]]:
    """(length, how many) of a filling of at most room that leaves the least slack, longer lengths first."""
    mask = (1 << (room + 1)) - 1
    reach, layers = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, step = min(counts[length], room // length), 1
        while left:
            n = min(step, left)
            layers.append((length, n, reach))
            reach |= reach << (length * n) & mask
            left, step = left - n, step * 2
        if reach >> room & 1:
            break
    full, found = reach.bit_length() - 1, {}
    for length, n, before in reversed(layers):
        if not before >> full & 1:
            full -= length * n
            found[length] = found.get(length, 0) + n
    return sorted(found.items(), reverse=True)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(bins, [(length, pieces per bin)])]: every bin seats the longest length left and the fullest filling of the rest."""
    counts = {k: v for k, v in histogram.items() if v}
    out = []
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        use = dict(_fullest(capacity - longest, {k: v for k, v in counts.items() if v}))
        counts[longest] += 1
        use[longest] = use.get(longest, 0) + 1
        bins = min(counts[k] // n for k, n in use.items())
        out.append((bins, sorted(use.items(), reverse=True)))
        for k, n in use.items():
            counts[k] -= bins * n
            if not counts[k]:
                del counts[k]
    return out


def _places(steps: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """Per use of a length in a step: where its ranks start, and what bin and offset they get."""
    used: dict[int, int] = {}
    rows, first = [], 0
    for bins, use in steps:
        offset = 0
        for length, n in use:
            rows.append((length, used.get(length, 0), n, first, offset))
            used[length] = used.get(length, 0) + bins * n
            offset += length * n
        first += bins
    rows.sort()
    return dict(zip(("length", "start", "n", "bin", "offset"), np.array(rows, np.int64).reshape(-1, 5).T, strict=True))


def packed(table: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """A written table with doc_id, piece and length, and to it sequence_id and offset."""
    spark = table.sparkSession
    histogram = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    where = spark.sparkContext.broadcast(_places(plan(histogram, capacity)))
    chunks = spark.createDataFrame([(k, -(-n // CHUNK)) for k, n in histogram.items()], "length long, chunks long")  # at most capacity rows
    rows = table.join(F.broadcast(chunks), "length").withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece"), F.col("chunks"))).select(*table.columns, "chunk")
    order = Window.partitionBy("length", "chunk").orderBy(*[F.col(c) for c in table.columns if c != "ids"])
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("length", "chunk").agg(F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    ranked = rows.withColumn("place", F.row_number().over(order)).join(bases.select("length", "chunk", "base"), ["length", "chunk"])
    ranked = ranked.select(*table.columns, (F.col("base") + F.col("place") - 1).alias("place"))
    kept = table.columns

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, wide = where.value, 1 << 45
        keys = at["length"] * wide + at["start"]
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (np.asarray(batch.column(c)).astype(np.int64) for c in ("length", "place"))
            k = np.searchsorted(keys, length * wide + rank, side="right") - 1
            along, n = rank - at["start"][k], at["n"][k]
            extra = [pa.array(at["bin"][k] + along // n, pa.int64()), pa.array(at["offset"][k] + along % n * length, pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *extra], [*kept, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
    return ranked.mapInArrow(seat, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset; one row per piece."""
    table = scratch(pieces(docs, tokenizer, capacity, end_id, id_col, text_col, with_ids), "pieces")
    return packed(table, capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, doc_ids, from rows that carry ids; at most a capacity of ids a row."""
    grouped = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids"))).alias("parts"))
    return grouped.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
