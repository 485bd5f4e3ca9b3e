"""The edge frame of the fixtures: missing and infinite values, odd labels, duplicates and conflicts."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from millrace.operators import checks, columns, duplicates, fingerprint, materialise, profile, repair, split
from millrace.sources import files

ROLES = columns.Roles(("f1", "f2"), "label", "source")
SCHEMA = "id long, f1 double, f2 double, label string, source string"
EDGE = [
    (1, 1.0, 2.0, "a", "s1"), (2, 1.0, 2.0, "a", "s1"), (3, 1.0, 2.0, "a", "s2"), (4, 3.0, math.inf, "b", "s1"), (5, 3.0, math.inf, "c", "s1"),
    (6, None, math.nan, "b", "s2"), (7, 5.0, -math.inf, " b ", "s2"), (8, 7.0, 1.0, None, "s1"), (9, 7.0, 1.0, "B", None), (10, None, 4.0, "gone", "s1"), (11, 0.0, 6.0, "", "s1"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA).cache()


@pytest.fixture(scope="module")
def groups(edge):
    return duplicates.feature_groups(edge, ROLES).cache()


def test_missing_and_infinite(edge):
    assert edge.transform(profile.infinite_summary).first().asDict() == {"n_rows": 11, "infinite_cells": 3, "infinite_rows": 3}
    clean = columns.infinite_to_missing(edge)
    assert {r[0]: r[1] for r in profile.missing_by_column(clean, ["f1", "f2", "label"]).collect()} == {"f1": 2, "f2": 4, "label": 1}


def test_medians_fill_and_groups_without_values_stay_missing(edge):
    got = {r["id"]: (r["f1"], r["f2"]) for r in repair.impute_medians(edge, ["f1", "f2"], ("label",)).collect()}
    assert got[6] == (3.0, None) and got[10] == (None, 4.0) and got[1] == (1.0, 2.0)


def test_labels(edge):
    assert repair.label_blemishes(edge, "label").first().asDict() == {"n_null": 1, "n_blank": 1, "n_padded": 1, "padded_labels": 1}
    assert [tuple(r) for r in repair.inconsistent_labels(edge, "label").collect()] == [("b", 3, " b  | B | b")]
    kept = repair.normalise_labels(edge, "label", {"B": "b", "�": "x"}).where("id in (8, 9)").orderBy("id").collect()
    assert [(r["label"], r["Raw_Label"]) for r in kept] == [(None, None), ("b", "B")]


def test_groups_and_conflicts(edge, groups):
    assert groups.agg(F.sum("row_count")).first()[0] == len(EDGE)
    assert groups.count() == len({(r[1], str(r[2])) for r in EDGE})
    summary = {r[0]: r[1] for r in duplicates.conflict_summary(groups).collect()}
    assert summary["conflict_groups"] == 1 and summary["conflict_rows"] == 2 and summary["same_source_groups"] == 1
    assert [tuple(r)[:3] for r in duplicates.conflict_pairs(groups).collect()] == [("b", "c", 1)]


def test_exact_duplicates_per_source(edge):
    got = {r["source"]: r["extra_rows"] for r in duplicates.exact_duplicates(edge, ("f1", "f2", "label"), "source").collect()}
    assert got == {"s1": 1, "s2": 0, None: 0}


def test_fingerprint_vectors(edge):
    assert fingerprint.canonical(1.0) == fingerprint.canonical(1) == "1" and fingerprint.canonical(math.nan) == "<NA>"
    by_hand = hashlib.blake2b(b"\0\0\0\1" b"1" b"\0\0\0\x04" b"<NA>", digest_size=16).hexdigest()
    assert fingerprint.fingerprint((1.0, None)) == by_hand
    rows = fingerprint.with_fingerprint(edge, ROLES.features).collect()
    assert all(r["feature_group_id"] == fingerprint.fingerprint((r["f1"], r["f2"])) for r in rows)


def _many(spark, n=3000):
    return spark.range(n).select(F.md5(F.col("id").cast("string").cast("binary")).alias("feature_group_id"), (1 + F.col("id") % 7).alias("row_count"), F.when(F.col("id") % 50 == 0, F.array(F.lit("x"), F.lit("y"))).otherwise(F.array(F.when(F.col("id") % 9 == 0, "y").otherwise("x"))).alias("labels"), (F.col("id") % 50 == 0).alias("is_label_conflict"), (F.col("id") % 4 == 0).alias("is_cross_source"))


@pytest.mark.parametrize("greedy", [True, False])
def test_splits_hold_their_ratios_and_each_group_once(spark, greedy):
    many = _many(spark)
    if greedy:
        got = split.split_greedy(many, duplicates.label_involvement(many)).join(many, "feature_group_id")
    else:
        got = split.split_windowed(many)
    assert got.count() == got.select("feature_group_id").distinct().count() == 3000
    for row in split.record_counts(got).collect():
        assert abs(row["difference"]) < 0.02


def test_greedy_agrees_with_a_plain_fold(spark):
    many = _many(spark, 400)
    rows = [r.asDict() for r in many.collect()]
    label_records = {x: sum(r["row_count"] for r in rows if x in r["labels"]) for x in ("x", "y")}
    stage = lambda r: 0 if r["is_label_conflict"] else 1 if r["is_cross_source"] else 2 if label_records[r["labels"][0]] <= 1000 else 3
    place = lambda r: (label_records[r["labels"][0]], r["labels"][0]) if stage(r) > 1 else (0, "")
    rows.sort(key=lambda r: (stage(r), place(r), -r["row_count"], r["feature_group_id"]))
    ratios, had, all_had = split.RATIOS, {(x, s): 0 for x in label_records for s in split.RATIOS}, dict.fromkeys(split.RATIOS, 0)
    extra = {0: (3.0, sum(r["row_count"] for r in rows if r["is_label_conflict"]), dict.fromkeys(ratios, 0)), 1: (1.5, sum(r["is_cross_source"] for r in rows), dict.fromkeys(ratios, 0))}
    total, expected = sum(r["row_count"] for r in rows), {}
    lack = lambda aim, now: (aim - now) / max(aim, 1.0)
    for r in rows:
        def score(s, r=r):
            v = 0.75 * sum(lack(label_records[x] * ratios[s], had[x, s]) for x in r["labels"]) / len(r["labels"]) + 0.25 * lack(total * ratios[s], all_had[s])
            if stage(r) in extra:
                w, aim, now = extra[stage(r)]
                v += w * lack(aim * ratios[s], now[s])
            return v
        seed = int.from_bytes(hashlib.blake2b(r["feature_group_id"].encode(), digest_size=8).digest(), "little")
        best = min(ratios, key=lambda s: (-score(s), (seed + list(ratios).index(s)) % 997))
        expected[r["feature_group_id"]] = best
        all_had[best] += r["row_count"]
        for x in r["labels"]:
            had[x, best] += r["row_count"]
        if stage(r) in extra:
            extra[stage(r)][2][best] += r["row_count"]
    got = {r[0]: r[1] for r in split.split_greedy(many, duplicates.label_involvement(many)).collect()}
    assert got == expected


def test_routing_writing_and_audit(spark, edge, groups, tmp_path):
    assigned = split.split_windowed(groups)
    routed = materialise.route(edge, ROLES, assigned)
    out = str(tmp_path / "splits")
    materialise.write_splits(routed, out)
    with pytest.raises(Exception, match="already exists"):
        materialise.write_splits(routed, out)
    back = spark.read.parquet(out)
    audit = {r[0]: r[1] for r in materialise.leakage_audit(back, ROLES, assigned).collect()}
    assert audit["rows"] == len(EDGE) and audit["groups_in_several_splits"] == audit["misplaced_rows"] == audit["unassigned_rows"] == 0
    with pytest.raises(Exception, match="no assignment"):
        materialise.route(edge, ROLES, assigned.limit(0)).collect()


def test_checks(edge):
    report = checks.run_checks(edge, [checks.Check("rows", F.count("*"), 11), checks.Check("null_labels", F.count_if(F.col("label").isNull()), 0)])
    assert {r["check"]: r["status"] for r in report.collect()} == {"rows": "PASS", "null_labels": "FAIL"}
    with pytest.raises(checks.CheckFailed, match="null_labels"):
        checks.raise_on_fail(report)


def test_csv_by_position_with_provenance(spark, tmp_path):
    (tmp_path / "b.csv").write_text(" x, Label\n1.5,a\nInfinity,\n")
    (tmp_path / "a.csv").write_text(" x, Label\noops,b\n")
    assert [r[0] for r in files.discover(spark, str(tmp_path)).orderBy("file_name").collect()] == ["a.csv", "b.csv"]
    assert files.header(spark, str(tmp_path / "b.csv")) == ["x", "Label"] and files.label_column([" x", " Label"]) == " Label"
    rows = files.read_csv(spark, str(tmp_path), "x double, Label string", strict=False).orderBy("Source_File", "x").collect()
    assert [(r["x"], r["Source_File"]) for r in rows] == [(None, "a.csv"), (1.5, "b.csv"), (math.inf, "b.csv")] and rows[0]["_corrupt_record"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    groups = duplicates.feature_groups(none, ROLES)
    assert split.split_windowed(groups).count() == 0 and split.split_greedy(groups, duplicates.label_involvement(groups)).count() == 0
    assert [r["records"] for r in split.record_counts(split.split_windowed(groups)).collect()] == [0, 0, 0]
    assert {r[1] for r in duplicates.conflict_summary(groups).collect()} == {0.0}
