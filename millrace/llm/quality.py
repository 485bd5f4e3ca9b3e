"""Quality rules: text statistics and learned decision lists.

``text_stats`` measures whole texts in Arrow batches. ``learn`` is sequential covering: on two thirds of the
labelled rows it grows one conjunction of thresholds at a time by information gain, prunes it on the other
third, and goes on with the rows that the rule leaves, as long as rules stay precise and cover ``min_cover``
rows; their number has no other bound, that of a rule's tests is ``max_tests``. ``verdict`` turns the
ordered list into one nested Spark conditional, so that scoring is a projection.

Defined results: null text has no words; an empty table gives an empty result; without labels, or with one
class only, the list is empty and keeps all that the base rule keeps; labels that name no document, null
labels and repeated ids with different labels do no harm (each pair counts as an example); only the id and
text columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import mix, slices, sort_rows, words_of

WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30
SYMBOLS, SHOUTS = b"#*$%&|<>", b"!"
#: At most so many labelled rows are fitted, the first by a hash of the id, and so many go to the driver.
MAX_LABELLED = 50_000
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_upper", "n_letters", "n_shouts", "n_lines")
_STATS = "doc_id long, " + ", ".join(f"{c} long" for c in BASE + EXTRA)
#: What rules may test: shares, so that a threshold means the same for short and long texts.
FEATURES = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "shouts_per_word": ("n_shouts", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "upper_share": ("n_upper", "n_letters"),
    "words_per_line": ("n_words", "n_lines"),
}


def _codes_of_windows(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a number per 8-word window, equal for equal windows only; where it starts): pairs of words, then pairs of pairs."""
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(codes))  # words from here to the end of the text
    width, at, now = 1, np.arange(len(codes)), codes
    while width < WINDOW:
        ok = left[at] >= 2 * width
        at = at[ok]
        full = np.zeros(len(codes), np.int64)
        full[np.flatnonzero(left >= width)] = now
        paired = full[at] * (int(now.max(initial=0)) + 1) + full[at + width]
        now = np.unique(paired, return_inverse=True)[1] if len(paired) else paired
        width *= 2
    return now, at


def _may_repeat(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a row has two windows with one hash; a row that has none repeats nothing."""
    mixed, n = mix(codes.astype(np.uint64)), len(codes)
    rolled = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(WINDOW, n)):
            rolled[: n - k] = rolled[: n - k] * np.uint64(0x9E3779B97F4A7C15) + mixed[k:]
    rows = np.repeat(np.arange(len(counts)), counts)
    whole = np.repeat(np.cumsum(counts), counts) - np.arange(n) >= WINDOW
    rolled, rows = rolled[whole], rows[whole]
    sort_rows(rolled, np.bincount(rows, minlength=len(counts)))
    same = np.flatnonzero((rolled[1:] == rolled[:-1]) & (rows[1:] == rows[:-1]))
    out = np.zeros(len(counts), bool)
    out[rows[same]] = True
    return out


def _repeated_words(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Words per row that stand in a window found twice or more in the row."""
    out = np.zeros(len(counts), np.int64)
    some = _may_repeat(codes, counts) if len(codes) else out.astype(bool)
    if not some.any():
        return out
    codes, counts = codes[np.repeat(some, counts)], counts[some]
    windows, at = _codes_of_windows(codes, counts)
    rows = np.repeat(np.arange(len(counts)), counts)
    key = rows[at] * (int(windows.max()) + 1) + windows
    _, back, n = np.unique(key, return_inverse=True, return_counts=True)
    starts = at[n[back] > 1]
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    out[some] = np.bincount(rows, np.cumsum(edge[:-1]) > 0, minlength=len(counts)).astype(np.int64)
    return out


def _chars(texts: pa.Array, which: bytes) -> np.ndarray:
    """How many bytes of each text are among ASCII characters."""
    wanted = np.zeros(256, np.int64)
    wanted[list(which)] = 1
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    sums = np.concatenate([[0], np.cumsum(wanted[data])])
    return sums[ends[1:] - ends[0]] - sums[ends[:-1] - ends[0]]


def _dup_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word that equal an earlier line; lines with a word."""
    lists = pc.split_pattern(texts, "\n")
    lines, n = lists.flatten(), np.diff(np.asarray(lists.offsets)).astype(np.int64)
    worded = np.asarray(pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]"))
    coded = lines.dictionary_encode()
    rows = np.repeat(np.arange(len(n)), n)
    key = rows * (len(coded.dictionary) + 1) + np.asarray(coded.indices).astype(np.int64)
    kept = key[worded]
    first = np.zeros(len(kept), bool)
    first[np.unique(kept, return_index=True)[1]] = True
    return np.bincount(rows[worded][~first], minlength=len(n)), np.bincount(rows[worded], minlength=len(n))


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    texts = pc.fill_null(texts.cast(pa.string()), "")
    codes, counts, words = words_of(texts)
    lengths = np.asarray(pc.utf8_length(words)).astype(np.int64)
    rows = np.repeat(np.arange(len(counts)), counts)
    dup, lines = _dup_lines(texts)
    upper, lower = _chars(texts, bytes(range(65, 91))), _chars(texts, bytes(range(97, 123)))
    return {
        "n_words": counts, "word_chars": np.bincount(rows, lengths[codes] if len(codes) else None, minlength=len(counts)).astype(np.int64), "n_symbols": _chars(texts, SYMBOLS), "n_dup_lines": dup,
        "n_repeat_words": _repeated_words(codes, counts), "n_upper": upper, "n_letters": upper + lower, "n_shouts": _chars(texts, SHOUTS), "n_lines": lines,
    }


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics in BASE and EXTRA, one row per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                stats = measure(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(stats[c], pa.int64()) for c in BASE + EXTRA)], ["doc_id", *BASE, *EXTRA])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, _STATS)


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    """All tests hold: the document is rejected."""

    tests: tuple[Test, ...]
    rejects: int
    of: int

    def __str__(self) -> str:
        return f"reject if {' and '.join(map(str, self.tests))}  ({self.rejects} of {self.of})"


def _holds(x: dict[str, np.ndarray], test: Test) -> np.ndarray:
    return x[test.feature] >= test.threshold if test.above else x[test.feature] <= test.threshold


def _covered(x: dict[str, np.ndarray], tests: tuple[Test, ...], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for t in tests:
        out &= _holds(x, t)
    return out


def _best_test(x: dict[str, np.ndarray], bad: np.ndarray, inside: np.ndarray) -> tuple[float, Test | None]:
    """The threshold with the most information gained: covered bad rows times the rise in log2 of precision."""
    p0, n0 = bad[inside].sum(), inside.sum()
    base, best = np.log2(p0 / n0), (1e-9, None)
    for name, values in x.items():
        order = np.argsort(values[inside], kind="stable")
        v, b = values[inside][order], bad[inside][order]
        cut = np.flatnonzero(np.diff(v) > 0)
        if not len(cut):
            continue
        below, bad_below = cut + 1, np.cumsum(b)[cut]
        middle = (v[cut] + v[cut + 1]) / 2
        for above, n, p in ((False, below, bad_below), (True, n0 - below, p0 - bad_below)):
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / n) - base), 0)
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), Test(name, above, float(middle[k])))
    return best


def learn(x: dict[str, np.ndarray], bad: np.ndarray, fold: np.ndarray, max_tests: int = 4, min_precision: float = 0.75, min_cover: int = 3) -> list[Rule]:
    """Decision list from feature columns, labels (True: reject) and folds (True: used to prune)."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while bad[left].any() and not bad[left].all():
        grow, prune = left & ~fold, left & fold
        tests: tuple[Test, ...] = ()
        while len(tests) < max_tests:
            inside = grow & _covered(x, tests, len(bad))
            if not bad[inside].any() or bad[inside].all():
                break
            _, test = _best_test(x, bad, inside)
            if test is None:
                break
            tests += (test,)

        def worth(some: tuple[Test, ...], prune=prune) -> float:
            hit = prune & _covered(x, some, len(bad))
            return (2 * bad[hit].sum() - hit.sum() + 0.0) / (hit.sum() + 2)

        while len(tests) > 1 and worth(tests[:-1]) >= worth(tests):
            tests = tests[:-1]
        hit = left & _covered(x, tests, len(bad))
        held = prune & hit
        good_there = (bad[held].sum() + 1) / (held.sum() + 2) >= min_precision or held.sum() < min_cover
        if not tests or hit.sum() < min_cover or bad[hit].mean() < min_precision or not good_there:
            break
        rules.append(Rule(tests, int(bad[hit].sum()), int(hit.sum())))
        left &= ~hit
    return rules


def features(stats: DataFrame) -> DataFrame:
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return stats.withColumns({name: share(*of) for name, of in FEATURES.items()})


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """Decision list from labels of 0 (reject) and 1, on at most max_labelled rows that pass the base rule."""
    marks = labels.where(F.col(f"`{label_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("long").alias("_id"), (F.col(f"`{label_col}`") == 0).alias("bad"))
    place = F.md5(F.col("_id").cast("string").cast("binary"))
    marks = marks.withColumn("place", place).orderBy("place", "bad").limit(max_labelled)  # a top-k, not a sort of all
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    wanted = F.broadcast(marks.select("_id").distinct())  # at most max_labelled ids of 8 bytes
    stats = text_stats(texts.join(wanted, texts["doc_id"] == F.col("_id"), "left_semi"))
    rows = features(stats).join(marks, F.col("doc_id") == F.col("_id")).where(~base_failed()).select("bad", "place", *FEATURES)
    rows = rows.orderBy("place", "bad", *FEATURES).limit(max_labelled).toPandas()  # ids that repeat make no more rows than that
    rows = rows.sort_values(["place", "bad", *FEATURES], kind="stable")
    if not len(rows):
        return []
    fold = np.array([int(p[:8], 16) % 3 == 0 for p in rows["place"]])
    return learn({c: rows[c].to_numpy(float) for c in FEATURES}, rows["bad"].to_numpy(bool), fold)


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects, from 1; 0: kept. One ordered conditional over FEATURES."""
    out = None
    for k, rule in enumerate(rules, 1):
        hit = F.lit(True)
        for t in rule.tests:
            hit &= (F.col(t.feature) >= t.threshold) if t.above else (F.col(t.feature) <= t.threshold)
        out = F.when(hit, k) if out is None else out.when(hit, k)
    return F.lit(0) if out is None else out.otherwise(0)


def quality(docs: DataFrame, labels: DataFrame | None = None, rules: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics, features, base_failed, rule (0: none) and kept, one row per row of docs."""
    if rules is None:
        rules = fit(docs, labels, id_col, text_col) if labels is not None else []
    return judged(text_stats(docs, id_col, text_col), rules)


def judged(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    scored = features(stats).withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def good_documents(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of docs that pass, all columns kept; measured where they lie, without a join."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*names)
    doc, words = (F.col(names[docs.columns.index(c)]) for c in (id_col, text_col))
    whole = plain.select(doc.cast("long").alias("doc_id"), words.cast("string").alias("text"), F.struct(*names).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                stats = measure(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(stats[c], pa.int64()) for c in BASE + EXTRA), part.column("row")], ["doc_id", *BASE, *EXTRA, "row"])

    fields = "row struct<" + ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in plain.schema) + ">"
    stats = whole.mapInArrow(run, f"{_STATS}, {fields}")
    return judged(stats, rules).where("kept").select("row.*").toDF(*docs.columns)
