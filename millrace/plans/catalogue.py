"""The catalogue of queries over the driver's tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks, columns, duplicates, fingerprint, materialise, profile, repair, split
from ..sources import files

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

FLOWS = columns.Roles(("l_suppkey", "l_quantity", "l_discount", "l_tax"), "l_returnflag", "l_linestatus")
PRIORITIES = {"4-NOT SPECIFIED": "4-Not Specified"}
DOMAIN = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-Not Specified", "5-LOW", "6-NEVER"]
EXPECTED_TYPES = ["click", "purchase", "view", "refund"]
#: A label is rare with at most one part in so many of all records.
RARE = 3


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def take(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return take


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(*FLOWS.features, FLOWS.label, FLOWS.source)


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.feature_groups(_flows(spark, sf_dir), FLOWS)


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_windowed(_groups(spark, sf_dir))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events have no holes: some are put in, by id."""
    n = F.col("event_id")
    value = F.when(n % 97 == 0, float("inf")).when(n % 89 == 0, float("nan")).when(n % 83 != 0, F.col("value"))
    return _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", value.alias("value"))


def _spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priorities in several spellings, by key."""
    n, p = F.col("o_orderkey"), F.col("o_orderpriority")
    return _table(spark, sf_dir, "orders").select("o_orderkey", F.when(n % 11 == 0, F.lower(p)).when(n % 13 == 0, F.concat(F.lit(" "), p)).when(n % 17 == 0, "  ").when(n % 19 != 0, p).alias("label"))


_SPELLED = """WITH l AS (SELECT CASE WHEN o_orderkey % 11 = 0 THEN lower(o_orderpriority) WHEN o_orderkey % 13 = 0 THEN ' ' || o_orderpriority
    WHEN o_orderkey % 17 = 0 THEN '  ' WHEN o_orderkey % 19 <> 0 THEN o_orderpriority END AS label FROM orders) """
_EVENTS = """WITH e AS (SELECT event_id, event_type, CASE WHEN event_id % 97 = 0 THEN 'inf'::DOUBLE WHEN event_id % 89 = 0 THEN 'nan'::DOUBLE
    WHEN event_id % 83 <> 0 THEN value END AS value FROM events),
    c AS (SELECT event_id, event_type, CASE WHEN isfinite(value) THEN value END AS v, value FROM e) """
_ID = "md5(" + " || ".join(f"coalesce(length({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in FLOWS.features) + ")"
_GROUPS = f"""WITH k AS (SELECT {_ID} AS id, l_returnflag AS label, l_linestatus AS source FROM lineitem),
    per AS (SELECT id, label, count(*) AS n FROM k GROUP BY 1, 2),
    g AS (SELECT id, count(*) AS row_count, list_sort(list(DISTINCT label)) AS labels, list_sort(list(DISTINCT source)) AS sources FROM k GROUP BY 1),
    x AS (SELECT *, len(labels) AS n_labels, len(sources) AS n_sources FROM g),
    conflict AS (SELECT *, n_sources > 1 AS is_cross FROM x WHERE n_labels > 1) """
_SPLIT = (
    _GROUPS
    + """, shares AS (SELECT *, coalesce(sum(row_count) OVER (PARTITION BY labels[1] ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE
        / sum(row_count) OVER (PARTITION BY labels[1])::DOUBLE AS share FROM x),
    s AS (SELECT * EXCLUDE share, CASE WHEN share < 0.7 THEN 'train' WHEN share < 0.85 THEN 'validation' ELSE 'test' END AS split FROM shares),
    names AS (SELECT * FROM (VALUES ('train', 0.7::DOUBLE), ('validation', 0.15::DOUBLE), ('test', 0.15::DOUBLE)) AS t(split, target_ratio)) """
)
_DUPLICATES = """WITH g AS (SELECT l_linestatus AS source, count(*) AS n FROM lineitem GROUP BY l_linestatus, l_suppkey, l_quantity, l_discount, l_tax, l_returnflag),
    d AS (SELECT source, sum(n)::BIGINT AS n_rows, count(*) FILTER (n > 1) AS duplicate_groups, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS duplicate_rows, sum(n - 1)::BIGINT AS extra_rows FROM g GROUP BY 1) """


def _long(source: str, *metrics: str) -> str:
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, {m}::DOUBLE AS value FROM {source}" for m in metrics)


def _dense(name: str, where: str) -> str:
    return f"""SELECT names.split, count(s.id) AS {name}_groups, coalesce(sum(s.row_count), 0)::BIGINT AS {name}_records
    FROM names LEFT JOIN s ON s.split = names.split AND {where} GROUP BY 1"""


@query("SELECT l_returnflag AS label, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 4)::DOUBLE AS percentage FROM lineitem GROUP BY 1")
def label_distribution(spark, sf_dir):
    return profile.label_counts(_table(spark, sf_dir, "lineitem"), "l_returnflag")


@query("""SELECT l_linestatus, l_returnflag AS label, count(*) AS n,
    round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY l_linestatus), 4)::DOUBLE AS percentage FROM lineitem GROUP BY 1, 2""")
def label_distribution_by_source(spark, sf_dir):
    return profile.label_counts(_table(spark, sf_dir, "lineitem"), "l_returnflag", ("l_linestatus",))


@query(_EVENTS + "SELECT 'value' AS column_name, count(*) AS n_missing FROM c WHERE v IS NULL HAVING count(*) > 0")
def missing_by_column(spark, sf_dir):
    return profile.missing_by_column(columns.infinite_to_missing(_events(spark, sf_dir)), ["user_id", "event_type", "value"])


@query(_EVENTS + "SELECT event_type AS label, count(*) AS n_rows FROM c WHERE v IS NULL GROUP BY 1")
def missing_by_label(spark, sf_dir):
    return profile.missing_by_label(columns.infinite_to_missing(_events(spark, sf_dir)), ["user_id", "value"], "event_type")


@query(_EVENTS + "SELECT event_type AS source, count(*) AS n_rows, count(*) FILTER (v IS NULL) AS missing_cells, count(*) FILTER (v IS NULL) AS affected_rows FROM c GROUP BY 1")
def missing_summary(spark, sf_dir):
    return profile.missing_summary(columns.infinite_to_missing(_events(spark, sf_dir)), ["user_id", "value"], "event_type")


@query(_EVENTS + "SELECT count(*) AS n_rows, count(*) FILTER (isinf(value)) AS infinite_cells, count(*) FILTER (isinf(value)) AS infinite_rows FROM c")
def infinite_summary(spark, sf_dir):
    return profile.infinite_summary(_events(spark, sf_dir))


@query()
def dtype_profile(spark, sf_dir):
    return profile.dtype_profile(_table(spark, sf_dir, "lineitem"))


@query(_EVENTS + """SELECT event_type AS label, 'value' AS feature, count(v) AS n, count(*) - count(v) AS n_missing, round(avg(v), 4) AS mean, round(median(v), 6) AS median,
    round(stddev_samp(v), 4) AS std, min(v) AS min, max(v) AS max FROM c GROUP BY 1 HAVING count(v) > 0""")
def imputation_stats(spark, sf_dir):
    stats = profile.describe_by_label(_events(spark, sf_dir), ["value"], "event_type")
    return stats.withColumns({"mean": F.round("mean", 4), "median": F.round("median", 6), "std": F.round("std", 4)})


@query(_EVENTS + "SELECT event_id, event_type, round(coalesce(v, median(v) OVER (PARTITION BY event_type)), 6) AS value FROM c")
def median_impute(spark, sf_dir):
    filled = repair.impute_medians(_events(spark, sf_dir), ["value"], ("event_type",))
    return filled.select("event_id", "event_type", F.round("value", 6).alias("value"))


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN '4-Not Specified' ELSE o_orderpriority END AS o_orderpriority, o_orderpriority AS \"Raw_Label\" FROM orders")
def label_normalize(spark, sf_dir):
    return repair.normalise_labels(_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", PRIORITIES)


@query("SELECT o_orderpriority AS raw_label, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN '4-Not Specified' ELSE o_orderpriority END AS label, count(*) AS n FROM orders GROUP BY 1, 2")
def label_mapping_report(spark, sf_dir):
    return repair.mapping_report(repair.normalise_labels(_table(spark, sf_dir, "orders"), "o_orderpriority", PRIORITIES), "o_orderpriority")


@query(_SPELLED + "SELECT lower(trim(label)) AS canonical, count(DISTINCT label) AS n_spellings, array_to_string(list_sort(list(DISTINCT label)), ' | ') AS spellings FROM l WHERE label IS NOT NULL GROUP BY 1 HAVING count(DISTINCT label) > 1")
def label_inconsistencies(spark, sf_dir):
    return repair.inconsistent_labels(_spelled(spark, sf_dir), "label")


@query(_SPELLED + """SELECT count(*) FILTER (label IS NULL) AS n_null, count(*) FILTER (trim(label) = '') AS n_blank, count(*) FILTER (label <> trim(label) AND trim(label) <> '') AS n_padded,
    count(DISTINCT CASE WHEN label <> trim(label) AND trim(label) <> '' THEN label END) AS padded_labels FROM l""")
def label_whitespace_blank(spark, sf_dir):
    return repair.label_blemishes(_spelled(spark, sf_dir), "label")


@query("WITH n AS (SELECT o_orderpriority AS label, count(*) AS n FROM orders GROUP BY 1), d AS (SELECT unnest([" + ", ".join(f"'{x}'" for x in DOMAIN) + """]) AS label)
    SELECT coalesce(n.label, d.label) AS label, CASE WHEN n.label IS NULL THEN 'missing' WHEN d.label IS NULL THEN 'unexpected' ELSE 'expected' END AS status, coalesce(n, 0)::BIGINT AS n
    FROM n FULL JOIN d ON n.label = d.label""")
def label_domain_check(spark, sf_dir):
    return repair.against_domain(_table(spark, sf_dir, "orders"), "o_orderpriority", DOMAIN)


@query()
def schema_checks(spark, sf_dir):
    return checks.schema_checks(_flows(spark, sf_dir), [*FLOWS.features, FLOWS.label, FLOWS.source], 6)


@query("WITH f AS (SELECT DISTINCT event_type FROM events), e AS (SELECT unnest([" + ", ".join(f"'{x}'" for x in EXPECTED_TYPES) + """]) AS event_type)
    SELECT coalesce(f.event_type, e.event_type) AS event_type, CASE WHEN f.event_type IS NULL THEN 'missing' WHEN e.event_type IS NULL THEN 'unexpected' ELSE 'found' END AS status
    FROM f FULL JOIN e ON f.event_type = e.event_type""")
def file_reconciliation(spark, sf_dir):
    expected = spark.createDataFrame([(x,) for x in EXPECTED_TYPES], "event_type string")
    return profile.reconcile(_table(spark, sf_dir, "events"), expected, "event_type")


@query(_DUPLICATES + "SELECT *, round(100.0::DOUBLE * duplicate_rows / n_rows, 4)::DOUBLE AS duplicate_percentage FROM d")
def exact_duplicates_by_source(spark, sf_dir):
    return duplicates.exact_duplicates(_flows(spark, sf_dir), (*FLOWS.features, FLOWS.label), FLOWS.source)


@query(_DUPLICATES + ", t AS (SELECT sum(n_rows) AS n_rows, sum(duplicate_groups) AS duplicate_groups, sum(duplicate_rows) AS duplicate_rows, sum(extra_rows) AS extra_rows, round(100.0::DOUBLE * sum(duplicate_rows) / sum(n_rows), 4) AS duplicate_percentage FROM d) "
    + _long("t", "n_rows", "duplicate_groups", "duplicate_rows", "extra_rows", "duplicate_percentage"))
def exact_duplicates_summary(spark, sf_dir):
    return duplicates.duplicate_totals(exact_duplicates_by_source(spark, sf_dir))


@query(_GROUPS + """SELECT id AS feature_group_id, row_count, n_labels::INTEGER AS label_count, array_to_string(labels, ' | ') AS labels, n_sources::INTEGER AS source_file_count,
    array_to_string(sources, ' | ') AS source_files, n_labels > 1 AS is_label_conflict FROM x""")
def feature_groups(spark, sf_dir):
    return duplicates.packed_groups(_groups(spark, sf_dir))


@query(_GROUPS + """SELECT c.id AS feature_group_id, row_count AS occurrences, n_labels::INTEGER AS label_count, array_to_string(labels, ' | ') AS labels,
    (SELECT string_agg(label || ': ' || n, ' | ' ORDER BY label) FROM per WHERE per.id = c.id) AS label_counts, n_sources::INTEGER AS source_file_count,
    array_to_string(sources, ' | ') AS source_files FROM conflict c""")
def feature_conflicts(spark, sf_dir):
    return duplicates.conflict_report(_groups(spark, sf_dir))


@query(_GROUPS + """, t AS (SELECT count(*) AS conflict_groups, coalesce(sum(row_count), 0) AS conflict_rows, count(*) FILTER (is_cross) AS cross_source_groups, count(*) FILTER (NOT is_cross) AS same_source_groups,
    max(n_labels) AS most_labels, max(row_count) AS largest_group, round(100.0::DOUBLE * count(*) FILTER (is_cross) / count(*), 4) AS cross_source_percentage FROM conflict) """
    + _long("t", "conflict_groups", "conflict_rows", "cross_source_groups", "same_source_groups", "most_labels", "largest_group", "cross_source_percentage"))
def conflict_summary(spark, sf_dir):
    return duplicates.conflict_summary(_groups(spark, sf_dir))


@query(_GROUPS + """SELECT label, count(*) AS conflict_groups, sum(n)::BIGINT AS rows_in_conflicts, count(*) FILTER (is_cross) AS cross_source_groups, count(*) FILTER (NOT is_cross) AS same_source_groups
    FROM conflict JOIN per USING (id) GROUP BY 1""")
def conflict_label_involvement(spark, sf_dir):
    return duplicates.conflict_labels(_groups(spark, sf_dir))


@query(_GROUPS + """SELECT a.label AS label_a, b.label AS label_b, count(*) AS conflict_groups, sum(a.n + b.n)::BIGINT AS rows_in_conflicts, count(*) FILTER (is_cross) AS cross_source_groups, count(*) FILTER (NOT is_cross) AS same_source_groups
    FROM conflict c JOIN per a ON c.id = a.id JOIN per b ON c.id = b.id AND a.label < b.label GROUP BY 1, 2""")
def conflict_label_pairs(spark, sf_dir):
    return duplicates.conflict_pairs(_groups(spark, sf_dir))


@query(_GROUPS + "SELECT source, count(*) AS conflict_groups FROM (SELECT unnest(sources) AS source FROM conflict) GROUP BY 1")
def conflict_source_patterns(spark, sf_dir):
    return duplicates.conflict_sources(_groups(spark, sf_dir))


@query("SELECT md5(length(text) || ':' || text) AS feature_group_id, count(*) AS row_count, count(DISTINCT source)::INTEGER AS source_file_count FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1")
def cross_source_groups(spark, sf_dir):
    groups = duplicates.feature_groups(_table(spark, sf_dir, "documents"), columns.Roles(("text",), "lang", "source"))
    return groups.where("is_cross_source").select("feature_group_id", "row_count", "source_file_count")


@query(_GROUPS + """SELECT min(row_count) AS smallest, max(row_count) AS largest, round(avg(row_count), 6) AS mean, median(row_count)::DOUBLE AS median, count(*) FILTER (row_count = 1) AS singletons,
    count(*) FILTER (row_count > 1) AS repeated, count(*) FILTER (row_count >= 3) AS at_least_3, count(*) FILTER (row_count >= 10) AS at_least_10 FROM x""")
def group_size_stats(spark, sf_dir):
    return profile.group_size_stats(_groups(spark, sf_dir), thresholds=(3, 10)).withColumn("mean", F.round("mean", 6))


@query(_GROUPS + "SELECT labels[1] AS label, sum(row_count)::BIGINT AS n_records FROM x WHERE n_labels = 1 GROUP BY 1")
def single_label_counts(spark, sf_dir):
    return duplicates.single_label_counts(_groups(spark, sf_dir))


_INVOLVED = _GROUPS + ", i AS (SELECT label, count(*) AS group_count, sum(row_count)::BIGINT AS record_count, count(*) FILTER (n_labels > 1) AS multi_label_groups FROM x JOIN per USING (id) GROUP BY 1) "


@query(_INVOLVED + "SELECT * FROM i")
def label_group_involvement(spark, sf_dir):
    return duplicates.label_involvement(_groups(spark, sf_dir))


@query(_INVOLVED + f"SELECT * FROM i WHERE record_count * {RARE} <= (SELECT sum(record_count) FROM i)")
def rare_classes(spark, sf_dir):
    return duplicates.rare_labels(duplicates.label_involvement(_groups(spark, sf_dir)), RARE)


@query(_INVOLVED + "SELECT label, split, target_ratio, round(record_count * target_ratio, 4) AS target_records FROM i CROSS JOIN (VALUES ('train', 0.7::DOUBLE), ('validation', 0.15::DOUBLE), ('test', 0.15::DOUBLE)) AS t(split, target_ratio)")
def split_targets(spark, sf_dir):
    return split.split_targets(duplicates.label_involvement(_groups(spark, sf_dir))).withColumn("target_records", F.round("target_records", 4))


@query(_SPLIT + "SELECT id AS feature_group_id, row_count, split FROM s")
def split_windowed(spark, sf_dir):
    return _assigned(spark, sf_dir).select("feature_group_id", "row_count", "split")


@query()
def split_greedy(spark, sf_dir):
    groups = _groups(spark, sf_dir)
    return split.split_greedy(groups, duplicates.label_involvement(groups))


@query(_SPLIT + """SELECT names.split, count(s.id) AS groups, coalesce(sum(row_count), 0)::BIGINT AS records, round(coalesce(sum(row_count), 0)::DOUBLE / (SELECT sum(row_count) FROM s)::DOUBLE, 6) AS actual_ratio, target_ratio,
    round(coalesce(sum(row_count), 0)::DOUBLE / (SELECT sum(row_count) FROM s)::DOUBLE - target_ratio, 6) AS difference FROM names LEFT JOIN s ON s.split = names.split GROUP BY names.split, target_ratio""")
def split_record_counts(spark, sf_dir):
    return split.record_counts(_assigned(spark, sf_dir))


@query(_SPLIT + _dense("conflict", "n_labels > 1"))
def split_conflict_counts(spark, sf_dir):
    return split.flagged_counts(_assigned(spark, sf_dir), "is_label_conflict", "conflict")


@query(_SPLIT + _dense("cross_source", "n_sources > 1"))
def split_cross_source_counts(spark, sf_dir):
    return split.flagged_counts(_assigned(spark, sf_dir), "is_cross_source", "cross_source")


@query(_SPLIT + "SELECT label, count(*) AS total_groups, sum(row_count)::BIGINT AS total_records, " + ", ".join(
    f"count(*) FILTER (split = '{s}') AS {s}_groups, coalesce(sum(row_count) FILTER (split = '{s}'), 0)::BIGINT AS {s}_records, round(100.0::DOUBLE * coalesce(sum(row_count) FILTER (split = '{s}'), 0) / sum(row_count), 4)::DOUBLE AS {s}_percentage" for s in split.RATIOS
) + " FROM (SELECT unnest(labels) AS label, row_count, split FROM s) GROUP BY 1")
def split_label_pivot(spark, sf_dir):
    return split.label_pivot(_assigned(spark, sf_dir))


@query(_SPLIT + "SELECT source AS \"Source_File\", count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'validation') AS validation, count(*) FILTER (split = 'test') AS test, count(*) AS total FROM k JOIN s USING (id) GROUP BY 1")
def split_source_pivot(spark, sf_dir):
    return split.row_pivot(materialise.route(_flows(spark, sf_dir), FLOWS, _assigned(spark, sf_dir)), "Source_File")


def _faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assignment with faults by id: some ids are lost, some have no split or one of no known name, some stand twice, some are renamed."""
    at = F.substring("feature_group_id", 1, 2)
    rows = _assigned(spark, sf_dir).where(at != "a0").withColumn("split", F.when(at == "c0", "holdout").when(at != "b0", F.col("split")))
    rows = rows.withColumn("feature_group_id", F.when(at == "e0", F.concat(F.lit("x"), "feature_group_id")).otherwise(F.col("feature_group_id")))
    return rows.select("feature_group_id", "split", F.explode(F.sequence(F.lit(1), F.when(at == "d0", 2).otherwise(1)))).drop("col")


_FAULTY = _SPLIT + """, f AS (SELECT CASE WHEN left(id, 2) = 'e0' THEN 'x' || id ELSE id END AS id, CASE left(id, 2) WHEN 'b0' THEN NULL WHEN 'c0' THEN 'holdout' ELSE split END AS split
    FROM s CROSS JOIN (VALUES (1), (2)) AS t(copy) WHERE left(id, 2) <> 'a0' AND (copy = 1 OR left(id, 2) = 'd0')),
    fid AS (SELECT id, count(*) AS times FROM f GROUP BY 1) """


@query(_FAULTY + """SELECT 'repeated_left' AS "check", 0::BIGINT AS n UNION ALL SELECT 'repeated_right', count(*) FROM fid WHERE times > 1 UNION ALL SELECT 'missing_right', count(*) FROM s WHERE id NOT IN (SELECT id FROM fid)
    UNION ALL SELECT 'missing_left', count(*) FROM fid WHERE id NOT IN (SELECT id FROM s) UNION ALL SELECT 'matched', count(*) FROM s WHERE id IN (SELECT id FROM fid)""")
def assignment_join(spark, sf_dir):
    return materialise.one_to_one(_groups(spark, sf_dir), _faulty(spark, sf_dir), "feature_group_id")


@query(_FAULTY + """SELECT 'repeated_ids' AS "check", count(*) AS n FROM fid WHERE times > 1 UNION ALL SELECT 'null_splits', count(*) FROM f WHERE split IS NULL
    UNION ALL SELECT 'outside_domain', count(*) FROM f WHERE split NOT IN ('train', 'validation', 'test') UNION ALL SELECT 'missing_ids', count(*) FROM s WHERE id NOT IN (SELECT id FROM fid)
    UNION ALL SELECT 'unknown_ids', count(*) FROM fid WHERE id NOT IN (SELECT id FROM s)
    UNION ALL SELECT 'lost_records', (SELECT sum(row_count) FROM s)::BIGINT - (SELECT sum(row_count * times) FROM s JOIN fid USING (id))::BIGINT""")
def assignment_validation(spark, sf_dir):
    return split.assignment_report(_groups(spark, sf_dir), _faulty(spark, sf_dir))


@query(_GROUPS + """, t AS (SELECT sum(row_count) AS n, max(row_count) AS largest_group FROM x)
    SELECT split, target_ratio, round(n * target_ratio)::BIGINT AS target_records, largest_group, largest_group <= round(n * target_ratio) AS fits
    FROM t CROSS JOIN (VALUES ('train', 0.7::DOUBLE), ('validation', 0.15::DOUBLE), ('test', 0.15::DOUBLE)) AS r(split, target_ratio)""")
def split_design(spark, sf_dir):
    return split.split_design(_groups(spark, sf_dir))


@query(_SPLIT.replace(f"SELECT {_ID} AS id,", f"SELECT {', '.join(FLOWS.features)}, {_ID} AS id,") + f"SELECT {', '.join(FLOWS.features)}, label AS l_returnflag, source AS l_linestatus, source AS \"Source_File\", split FROM k JOIN s USING (id)")
def materialize_rows(spark, sf_dir):
    return materialise.route(_flows(spark, sf_dir), FLOWS, _assigned(spark, sf_dir))


@query(_SPLIT.replace(f"SELECT {_ID} AS id,", f"SELECT l_suppkey, {_ID} AS id,") + """, m AS (SELECT k.id, s.split AS expected, CASE WHEN l_suppkey % 50 = 7 AND source = 'O' THEN 'test' ELSE s.split END AS split FROM k JOIN s USING (id)),
    d AS (SELECT id, count(DISTINCT split) AS splits FROM m GROUP BY 1)
    SELECT 'rows' AS metric, (SELECT count(*) FROM m) AS n UNION ALL SELECT 'distinct_groups', (SELECT count(*) FROM d) UNION ALL SELECT 'groups_in_several_splits', (SELECT count(*) FROM d WHERE splits > 1)
    UNION ALL SELECT 'misplaced_rows', (SELECT count(*) FROM m WHERE split <> expected AND left(id, 1) <> '0') UNION ALL SELECT 'unassigned_rows', (SELECT count(*) FROM m WHERE left(id, 1) = '0')""")
def leakage_audit(spark, sf_dir):
    """Some rows are moved to another split, and some groups are struck from the assignment, so that the audit has something to find."""
    assigned = _assigned(spark, sf_dir)
    rows = materialise.route(_flows(spark, sf_dir), FLOWS, assigned)
    moved = rows.withColumn("split", F.when((F.col("l_suppkey") % 50 == 7) & (F.col("l_linestatus") == "O"), "test").otherwise(F.col("split")))
    return materialise.leakage_audit(moved, FLOWS, assigned.where("feature_group_id not like '0%'"))


@query(_SPLIT + "SELECT label AS l_returnflag, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'validation') AS validation, count(*) FILTER (split = 'test') AS test, count(*) AS total FROM k JOIN s USING (id) GROUP BY 1")
def split_label_row_pivot(spark, sf_dir):
    return split.row_pivot(materialise.route(_flows(spark, sf_dir), FLOWS, _assigned(spark, sf_dir)), FLOWS.label)


@query(_GROUPS + """, t AS (SELECT count(*) FILTER (row_count > 1) AS duplicate_groups, sum(row_count) FILTER (row_count > 1) AS duplicate_rows, sum(row_count - 1) AS extra_rows,
    count(*) FILTER (row_count > 1 AND n_sources > 1) AS cross_source_groups FROM x) """ + _long("t", "duplicate_groups", "duplicate_rows", "extra_rows", "cross_source_groups"))  # fmt: skip
def feature_duplicates(spark, sf_dir):
    return duplicates.feature_duplicates(_groups(spark, sf_dir))


@query(_GROUPS + "SELECT id AS feature_group_id, n_labels AS n_labels, labels[1] AS first_label, (SELECT sum(n)::BIGINT FROM per WHERE per.id = conflict.id) AS n_counted FROM conflict")
def packed_lists_parsed(spark, sf_dir):
    """The report's packed lists and counts, read back."""
    report = duplicates.conflict_report(_groups(spark, sf_dir))
    labels, counts = duplicates.parsed_list(F.col("labels")), duplicates.parsed_counts(F.col("label_counts"))
    total = F.aggregate(F.map_values(counts), F.lit(0).cast("long"), lambda s, x: s + x)
    return report.select("feature_group_id", F.size(labels).cast("long").alias("n_labels"), F.get(labels, F.lit(0)).alias("first_label"), total.alias("n_counted"))


@query("""WITH n AS (SELECT o_custkey, count(*) AS n_orders, max(o_orderkey) AS last_order FROM orders GROUP BY 1)
    SELECT *, row_number() OVER (ORDER BY n_orders DESC, last_order DESC, o_custkey) AS rank FROM n QUALIFY rank <= 20""")
def top_customers(spark, sf_dir):
    """The first twenty of a report in two falling orders."""
    counts = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.max("o_orderkey").alias("last_order"))
    return profile.ranked(counts, ["n_orders", "last_order"], ["o_custkey"], top=20)


@query("WITH n AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1) SELECT *, row_number() OVER (ORDER BY n DESC, event_type) AS rank FROM n")
def ordered_counts(spark, sf_dir):
    return profile.ranked(_table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n")), ["n"], ["event_type"])


@query(_SPELLED + """, m AS (SELECT label AS raw_label, CASE label WHEN '1-URGENT' THEN 'URGENT' ELSE label END AS expected, CASE WHEN label = '2-HIGH' THEN NULL WHEN label = '1-URGENT' THEN 'URGENT' ELSE trim(label) END AS label FROM l)
    SELECT raw_label, label, expected, count(*) AS n FROM m WHERE label IS DISTINCT FROM expected GROUP BY 1, 2, 3""")
def label_mismatches(spark, sf_dir):
    """Labels that were trimmed, and some lost, after a mapping that does neither."""
    label = F.col("raw")
    rows = _spelled(spark, sf_dir).select(F.col("label").alias("raw")).withColumn("label", F.when(label != "2-HIGH", F.when(label == "1-URGENT", "URGENT").otherwise(F.trim(label))))
    return repair.label_mismatches(rows, "raw", "label", {"1-URGENT": "URGENT"})


@query("SELECT 'lineitem.parquet' AS file_name, count(*) AS n_rows, (SELECT count(*) FROM information_schema.columns WHERE table_name = 'lineitem')::INTEGER AS n_columns FROM lineitem")
def parquet_footers(spark, sf_dir):
    return files.parquet_files(spark, f"{sf_dir}/lineitem.parquet")


@query()
def assignment_fingerprint(spark, sf_dir):
    return fingerprint.table_fingerprint(_assigned(spark, sf_dir).select("feature_group_id", "split"))


@query()
def blake2b_group_id(spark, sf_dir):
    return fingerprint.with_fingerprint(_flows(spark, sf_dir), FLOWS.features)


@query("SELECT 'null_labels' AS \"check\", 0::BIGINT AS expected, count(*) FILTER (l_returnflag IS NULL) AS actual, CASE WHEN count(*) FILTER (l_returnflag IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM lineitem UNION ALL SELECT 'missing_cells', 0, 0, 'PASS' UNION ALL SELECT 'outside_domain', 0, count(*) FILTER (l_returnflag NOT IN ('A', 'N')), CASE WHEN count(*) FILTER (l_returnflag NOT IN ('A', 'N')) = 0 THEN 'PASS' ELSE 'FAIL' END FROM lineitem")
def validation_report(spark, sf_dir):
    df = _flows(spark, sf_dir)
    label = F.col(FLOWS.label)
    missing = sum((F.count_if(columns.is_missing(df, c)) for c in FLOWS.features), F.lit(0))
    rules = [checks.Check("null_labels", F.count_if(label.isNull()), 0), checks.Check("missing_cells", missing, 0), checks.Check("outside_domain", F.count_if(~label.isin("A", "N")), 0)]
    return checks.run_checks(df, rules)
