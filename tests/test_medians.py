"""Grouped medians against plain ones, with good sketches and with such as miss the middle; table fingerprints by hand."""

import hashlib
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import fingerprint, medians, repair, split


def _rows():
    rng = random.Random(7)
    draw = {"even": lambda: rng.gauss(0, 1e6), "ties": lambda: float(rng.choice([0, 0, 0, 1, 5])), None: lambda: rng.random(), "two": lambda: rng.choice([-1.0, 1.0]), "one": lambda: 3.5}
    sizes = {"even": 4000, "ties": 3001, None: 777, "two": 2000, "one": 1}
    rows = [(k, draw[k]()) for k, n in sizes.items() for _ in range(n)]
    return rows + [(k, None) for k in (*sizes, "empty") for _ in range(50)]


@pytest.mark.parametrize(("slack", "accuracy", "groups"), [(2e-5, 100_000, 10_000), (0.01, 10, 10_000), (-0.3, 100, 10_000), (2e-5, 100_000, 0)])
def test_medians_are_exact(spark, monkeypatch, slack, accuracy, groups):
    for name, value in (("SLACK", slack), ("ACCURACY", accuracy), ("MAX_GROUPS", groups)):
        monkeypatch.setattr(medians, name, value)
    rows = _rows()
    want = {k: statistics.median([v for x, v in rows if x == k and v is not None]) for k in {x for x, v in rows if v is not None}}
    df = spark.createDataFrame(rows, "`a.b` string, value double")
    got = {r[0]: r[1] for r in medians.grouped_medians(df, ["a.b"]).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_medians_without_keys_and_of_nothing(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 5.0)], "id int, value double")
    assert [r["value"] for r in repair.impute_medians(df, ["value"], ()).orderBy("id").collect()] == [2.0, 3.5, 5.0]
    assert medians.grouped_medians(df.limit(0), ["id"]).count() == repair.impute_medians(df.limit(0), ["value"], ("id",)).count() == 0


def test_windowed_split_is_the_same_for_any_digits(spark):
    groups = spark.range(2000).select(F.md5(F.col("id").cast("string").cast("binary")).alias("feature_group_id"), (1 + F.col("id") % 5).alias("row_count"), F.array(F.when(F.col("id") % 3 == 0, "x").otherwise("y")).alias("labels"))
    few, many = ({r["feature_group_id"]: r["split"] for r in split.split_windowed(groups, digits=d).collect()} for d in (1, 6))
    assert few == many and len(few) == 2000


def test_table_fingerprint(spark):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    rows = [(k % 40, None if k % 7 == 0 else f"t{k % 40}") for k in range(100)]
    counts = Counter(sha(f'{{"a":{a},"b":' + (f'"{b}"' if b else "null") + "}") for a, b in rows)
    buckets = {}
    for h in sorted(counts):
        buckets.setdefault(h[:4], []).append(f"{h} {counts[h]}")
    want = sha(",".join(sha(",".join(buckets[x])) for x in sorted(buckets)))
    df = spark.createDataFrame(rows, "a int, b string")
    assert tuple(fingerprint.table_fingerprint(df).first()) == (want, 100)
    assert tuple(fingerprint.table_fingerprint(df.orderBy(F.rand(1)).repartition(3)).first()) == (want, 100)
    assert fingerprint.table_fingerprint(df.union(df.limit(1))).first()[0] != want
