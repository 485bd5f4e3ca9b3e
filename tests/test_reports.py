"""Audits of written splits, file status and sizes, reports, codecs and the identity of vectors."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import duplicates, materialise, profile, split
from millrace.operators.columns import Roles
from millrace.sources import files

ROLES = Roles(("f1", "f2"), "label", "source")


def _rows(spark):
    rows = [(float(k % 20), float(k % 3), "ab"[k % 2], f"s{k % 4}") for k in range(400)]
    return spark.createDataFrame(rows, "f1 double, f2 double, label string, source string")


def test_written_splits(spark, tmp_path):
    df = _rows(spark)
    assigned = split.split_windowed(duplicates.feature_groups(df, ROLES))
    path = str(tmp_path / "out")
    materialise.write_splits(materialise.route(df, ROLES, assigned), path)
    report = {r["check"]: r["n"] for r in materialise.written_audit(spark, path, ROLES, assigned).collect()}
    assert report == {"lacking_columns": 0, "extra_columns": 0, "labels_not_in_every_split": 0, "rows": 400, "distinct_groups": 60, "groups_in_several_splits": 0, "misplaced_rows": 0, "unassigned_rows": 0}
    df.limit(3).withColumn("split", F.lit("holdout")).withColumn("Source_File", F.lit("s")).withColumn("feature_group_id", F.lit("x")).write.partitionBy("split").mode("append").parquet(path)
    worse = {r["check"]: r["n"] for r in materialise.written_audit(spark.newSession(), path, ROLES, assigned).collect()}
    assert worse["misplaced_rows"] == 3 and worse["groups_in_several_splits"] == 3 and worse["labels_not_in_every_split"] >= 0 and worse["rows"] == 403
    sizes = {r["folder"]: r for r in files.output_sizes(spark, path).collect()}
    assert set(sizes) == {"split=train", "split=validation", "split=test", "split=holdout"} and all(r["n_bytes"] > 0 for r in sizes.values())
    assert files.parquet_files(spark, path).agg(F.sum("n_rows")).first()[0] == 403


def test_file_status(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n3,4\n")
    (tmp_path / "b.csv").write_text("x,y\n1,two\n3,4\n")
    (tmp_path / "c.csv").write_text("x,y\n")
    got = {r["file_name"]: (r["n_rows"], r["n_corrupt"], r["status"]) for r in files.file_status(spark, str(tmp_path), "x int, y int").collect()}
    assert got == {"a.csv": (2, 0, "ok"), "b.csv": (2, 1, "corrupt_rows"), "c.csv": (0, 0, "empty")}
    found = files.discover(spark, str(tmp_path))
    assert files.expect_files(found, 3).count() == 3
    with pytest.raises(ValueError, match="3 files where 8"):
        files.expect_files(found, 8)


def test_reports_and_codecs(spark):
    metrics = spark.createDataFrame([("a", 1.0), ("b", None)], "metric string, value double")
    counts = spark.createDataFrame([("x", 2), ("y", 2), (None, 5)], "label string, n long")
    assert json.loads(files.json_document({"m": metrics, "c": counts.limit(1)})) == {"m": {"a": 1.0, "b": None}, "c": [{"label": "x", "n": 2}]}
    text = files.text_report("Quality", {"Counts": profile.ranked(counts, ["n"], ["label"])})
    assert text.splitlines()[:2] == ["Quality", "======="] and [x.split() for x in text.splitlines()[6:]] == [["5", "1"], ["x", "2", "2"], ["y", "2", "3"]]
    packed = spark.createDataFrame([("b | a|c", "a: 1 | web: x: 20 | none"), (None, None), ("", "")], "l string, c string")
    got = packed.select(duplicates.parsed_list(F.col("l")).alias("l"), duplicates.parsed_counts(F.col("c")).alias("c")).collect()
    assert [tuple(r) for r in got] == [(["a", "b", "c"], {"a": 1, "web: x": 20}), ([], {}), ([], {})]


def test_zeros_and_missing_numbers_are_one_vector(spark):
    rows = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (None,)], "x double")
    ids = [r[0] for r in rows.select(duplicates.native_id(("x",))).collect()]
    assert ids[0] == ids[1] != ids[2] == ids[3]
