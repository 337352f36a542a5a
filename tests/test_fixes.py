import pytest
from pyspark.sql import functions as F

from plumbline.config import Thresholds
from plumbline.operators import (
    changes,
    completeness_fixes,
    consistency_fixes,
    profile,
    remediation,
    schema_fixes,
    scoring,
)
from plumbline.plans import pipeline
from plumbline.plans.dirty_orders import dirty_orders
from plumbline.session import cut


def column(df, name):
    return [r[0] for r in df.select(F.col(f"`{name}`")).collect()]


@pytest.fixture(scope="module")
def dirty(spark, data):
    return cut(dirty_orders(spark, data))


# --- schema ------------------------------------------------------------------


def test_same_names_keep_the_first():
    assert schema_fixes.same_name_columns(["Tipo Imposta", "tipo_imposta", "x", "TIPO-IMPOSTA"]) == ["tipo_imposta", "TIPO-IMPOSTA"]


def test_overlapping_columns(table):
    n = [str(i) for i in range(12)]
    df = table(
        spesa=n, **{"SPESA TOTALE": [str(i * 2) for i in range(12)]},
        ente=["1"] * 12, ente_x=["2"] * 12,  # constant: no correlation
        descr=["a", "b"] * 6, descr_b=["a", "b"] * 6, abc=n, abcd=n,  # three letters are too short
    )
    assert schema_fixes.overlapping_columns(df) == ["SPESA TOTALE", "descr_b"]


def test_currency_and_integers(table):
    df = schema_fixes.strip_currency(table(a=["€5", "$6", "0 unità"], b=["1.5", "2%", "6,0"]), ["a", "b"])
    assert dict(df.dtypes) == {"a": "bigint", "b": "double"}
    assert column(df, "a") == [5, 6, None] and column(df, "b") == [1.5, 2.0, None]


def test_years_need_five_numbers_and_a_short_one(table):
    years = ["98", "1999", "2001", "7", "2101", None]
    assert column(schema_fixes.coerce_years(table(y=years), ["y"]), "y") == [1998, 1999, 2001, 2007, 2101, None]
    assert schema_fixes.coerce_years(table(y=years[:4]), ["y"]).dtypes == [("y", "string")]


def test_rounding_is_half_to_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (129474.23000000003,)], "x double")
    assert column(schema_fixes.round_decimals(df, {"x": 2}), "x") == [0.12, 0.38, 129474.23]


def test_proposals(table):
    df = table(
        anno=["98", "1998", "2001", "99", "2002"],
        amount=["1.25", "2.50000000000003", "3.1", "4", "5"],
        count=["1.0", "2", "3.0", "4", "5"],
        price=["1.23456789", "2.5", "3", "4", "5.00000000000001"],
        plain=["1", "2", "3", "4", "5"],
    )
    found = schema_fixes.propose_enrichments(df, df.columns)
    assert {c: e["fix_action"] for c, e in found.items()} == {"anno": "coerce_year", "amount": "round_Ndp", "count": "coerce_int"}
    assert found["amount"]["params"] == {"decimals": 2}


def test_unknown_actions_are_discarded(spark):
    rows = [{"column": "a", "fix_action": "round_Ndp", "params": {"decimals": 1}}, {"column": "b", "fix_action": "none"}, {"column": "c", "fix_action": "drop"}]
    assert set(schema_fixes.valid_enrichments(rows)) == {"a"}
    frame = spark.createDataFrame([("a", "coerce_int", {"k": "v"}), ("b", "x", None)], "`column` string, fix_action string, params map<string,string>")
    assert schema_fixes.valid_enrichments(frame) == {"a": {"fix_action": "coerce_int", "params": {"k": "v"}}}


def test_fix_schema_twice_changes_nothing(dirty):
    once = schema_fixes.fix_schema(dirty, profile.profile_table(dirty), {}).df
    again = schema_fixes.fix_schema(once, profile.profile_table(once), {})
    assert again.log == [] and again.types_changed == 0
    assert sorted(map(str, again.df.collect())) == sorted(map(str, once.collect()))


def test_type_change_counts(dirty):
    known = profile.profile_table(dirty)
    assert schema_fixes.fix_schema(dirty, known, {}).types_changed == 2  # rata and spesa
    assert schema_fixes.fix_schema(dirty, known, {}, count_all_numeric=True).types_changed == 6


# --- completeness ------------------------------------------------------------


def test_drop_edge(table):
    cells = ["x"] + [None] * 19  # exactly 95 %
    assert completeness_fixes.fix_completeness(table(a=cells, b=["1"] * 20)).df.columns == ["a", "b"]
    assert completeness_fixes.fix_completeness(table(a=cells, b=["1"] * 20), inclusive=True).df.columns == ["b"]


def test_median_only_up_to_fifteen_percent(spark):
    rows = [(float(i), None if i < 2 else 1) for i in range(10)] + [(None, 1)]
    df = spark.createDataFrame(rows, "a double, b int")
    fixed = completeness_fixes.impute_median(df)
    assert sorted(column(fixed.df, "a"))[5] == 4.5
    assert column(fixed.df, "b").count(None) == 2
    assert fixed.log == [("remediation", "median_imputation", "a", 1)]


def test_mode_breaks_ties_by_value(table):
    df = completeness_fixes.fill_mode(table(a=["b", "a", None, "b", "a"]), ["a"])
    assert column(df, "a").count("a") == 3


# --- consistency -------------------------------------------------------------


def test_canonical_case(table):
    cells = ["Red", "Red ", "red", "RED", "blue", "Blue", None, "x"]
    df = consistency_fixes.canonical_case(table(a=cells), ["a"])
    assert sorted(map(str, column(df, "a"))) == sorted(["Red"] * 4 + ["Blue"] * 2 + ["None", "x"])


def test_dates_keep_or_lose_unreadable(table):
    df = table(d=["01/02/2024", "soon", None])
    assert column(consistency_fixes.normalize_dates(df, ["d"]), "d") == ["2024-02-01", "soon", None]
    assert column(consistency_fixes.normalize_dates(df, ["d"], keep_unreadable=False), "d") == ["2024-02-01", None, None]


def test_fix_consistency_twice_changes_nothing(dirty):
    known = profile.profile_table(dirty)
    once = consistency_fixes.fix_consistency(dirty, known)
    assert once.rows_removed == 16
    again = consistency_fixes.fix_consistency(once.df, known)
    assert again.log == [] and again.df.count() == once.df.count()


# --- remediation and scores --------------------------------------------------


def metrics(spark, **changed):
    base = {
        "column_count": 20, "avg_missing_pct": 0.0, "naming_issues": 0, "type_issues": 0, "completeness_pct": 100.0,
        "format_issues": 0, "duplicate_rows": 0, "iqr_outliers": 0, "outlier_penalty": 0.0, "rare_values": 0,
        "cross_column": False,
    }
    base |= changed
    schema = (
        "column_count bigint, avg_missing_pct double, naming_issues bigint, type_issues bigint, completeness_pct double, "
        "format_issues bigint, duplicate_rows bigint, iqr_outliers bigint, outlier_penalty double, rare_values bigint, cross_column boolean"
    )
    return spark.createDataFrame([tuple(base.values())], schema)


def test_scores(spark):
    clean = scoring.reliability_score(metrics(spark)).first()
    assert (clean["score"], clean["grade"]) == (100.0, "A")
    bad = metrics(spark, avg_missing_pct=80.0, naming_issues=4, duplicate_rows=5000, iqr_outliers=100, cross_column=True)
    got = scoring.reliability_score(bad).first()
    assert got["score"] == 100 - 20 - 2 - 10 - 2 - 5 and got["grade"] == "C"
    other = scoring.documented_score(metrics(spark, type_issues=2, completeness_pct=90.0, format_issues=1)).first()
    assert other["score"] == 100 - 3 - 5 - 1.5


def test_null_rate_score(spark):
    rates = spark.createDataFrame([("a", 100, 60), ("b", 100, 10), ("c_flag", 100, 30), ("d", 100, 2)], "`column` string, row_count bigint, null_count bigint")
    got = scoring.null_rate_score(rates, ["a", "c_flag"]).first()
    assert got["score"] == 100 - 10 - 1 - 0.5 - 6 and got["grade"] == "B"


def test_grades(spark):
    df = spark.createDataFrame([(90.0,), (89.9,), (75.0,), (60.0,), (45.0,), (44.9,)], "s double")
    assert [r[0] for r in df.select(scoring.grade(F.col("s"))).collect()] == ["A", "B", "B", "C", "D", "F"]


def test_roadmap_and_expected_score(spark):
    steps = scoring.roadmap(metrics(spark, duplicate_rows=1, iqr_outliers=1, format_issues=1, avg_missing_pct=1.0))
    assert [r["category"] for r in steps.collect()] == ["Consistency", "Completeness", "Schema", "Anomaly"]
    assert scoring.expected_score(70.0, steps).first()["expected_score"] == 91.0
    assert [r["category"] for r in scoring.roadmap(metrics(spark)).collect()] == ["General"]


def test_suggestions_are_applied_or_reviewed(spark, table):
    df = table(**{"A b": [" x", " x", "y"], "a_b": ["1", "1", "2"]})
    proposed = scoring.suggestions(metrics(spark, duplicate_rows=1, naming_issues=1, rare_values=1))
    fixed, review = remediation.apply_suggestions(df, proposed)
    assert fixed.df.columns == ["a_b", "a_b_2"] and sorted(map(tuple, fixed.df.collect())) == [("x", "1"), ("y", "2")]
    assert [r["field"] for r in review.collect()] == ["anomaly_columns"]


def test_cap_and_group_rare(table, spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "x double")
    assert max(column(remediation.cap_at_percentile(df, ["x"]), "x")) == 99.0
    rare = remediation.group_rare(table(a=["x"] * 400 + ["odd"]))
    assert column(rare, "a").count("Other") == 1


# --- pipeline ----------------------------------------------------------------


def test_gates(spark):
    def gate(completeness, columns, rows, numeric, words):
        df = spark.createDataFrame(
            [(completeness, columns, rows, numeric, words)],
            "overall_completeness double, total_columns bigint, total_rows bigint, numeric_columns array<string>, categorical_columns array<string>",
        )
        return tuple(pipeline.stage_gates(df).first())

    assert gate(0.95, 3, 10, [], []) == (False, True, False)
    assert gate(0.9499, 2, 10, ["a"], []) == (True, False, True)
    assert gate(1.0, 3, 9, [], ["a"]) == (False, False, True)


def test_repeats():
    class Fixed:
        rows_removed, types_changed = 11, 6

    assert pipeline.repeat_stage("consistency", Fixed, 100, 0) == "completeness"
    assert pipeline.repeat_stage("consistency", Fixed, 110, 0) is None
    assert pipeline.repeat_stage("schema", Fixed, 100, 1) == "consistency"
    assert pipeline.repeat_stage("schema", Fixed, 100, 2) is None


def test_pipeline_writes_its_stages(spark, table, tmp_path):
    n = 30
    df = table(
        **{"Spesa Tot": ["€1.5", "2"] * 15, "data-x": ["01/02/2024"] * 3 + ["2024-02-01"] * 27},
        stato=["Red"] * 20 + ["red"] * 10, note=["a"] + [None] * (n - 1),
    )
    report = pipeline.run(df, folder=str(tmp_path))
    assert set(report.stages) == {"v1", "v2", "v3", "v2_iter1", "v4"} or set(report.stages) >= {"v1", "v3", "v4"}
    assert report.df.columns == ["spesa_tot", "data_x", "stato"]
    assert {r["stato"] for r in report.df.collect()} == {"Red"}
    assert {r["data_x"] for r in report.df.collect()} == {"2024-02-01"}
    assert spark.read.json(str(tmp_path / "findings")).count() == report.findings.count()
    assert changes.changes_per_stage(report.changes).count() >= 3
    assert report.score.first()["grade"] in "ABCDF"


def test_pipeline_on_a_tiny_table(table):
    report = pipeline.run(table(a=["1", "2", "3", "4", "5"], b=["x", "y", "x", "y", "x"]))
    assert [r["stage"] for r in report.log.collect()] == ["schema", "anomaly", "remediation"]
    assert report.df.count() == 5
