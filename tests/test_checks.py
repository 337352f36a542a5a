import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.config import Thresholds
from plumbline.operators import anomaly, completeness, consistency, duplicates, profile, schema
from plumbline.operators import quantiles
from plumbline.operators.quantiles import exact_quantiles
from plumbline.operators.scan import scan


def by_column(df):
    return {r["column"]: r for r in df.collect()}


def kinds(df, **changes):
    return {c: p.semantic_type for c, p in profile.profile_table(df, Thresholds(**changes)).columns.items()}


# --- profile -----------------------------------------------------------------


def test_type_edges(table):
    n = 20
    df = table(
        all_null=[None] * n,
        bools=["yes", "NO"] * 10,
        four=["yes", "no", "t", "f"] * 5,
        unique_numbers=[str(i) for i in range(n)],
        nine_tenths=["x", "y"] + ["1"] * 18,
        below=["x", "y", "z"] + ["1"] * 17,
        seven_tenths=["2024-01-01"] * 14 + ["a"] * 6,
        other_dates=["2024-01-01"] * 10 + ["01/02/2024"] * 10,
    )
    assert kinds(df) == {
        "all_null": "text", "bools": "boolean", "four": "text", "unique_numbers": "identifier",
        "nine_tenths": "numeric", "below": "text", "seven_tenths": "date", "other_dates": "text",
    }
    assert kinds(df, date_policy="any")["other_dates"] == "date"


def test_profile_of_nothing(table, spark):
    empty = spark.createDataFrame([], "a string, b string")
    known = profile.profile_table(empty)
    assert known.row_count == 0 and set(known.columns) == {"a", "b"}
    one = profile.profile_table(table(a=["1"]), samples=True).columns["a"]
    assert (one.semantic_type, one.cardinality_ratio, one.samples) == ("boolean", 1.0, ("1",))


def test_samples_are_commonest_first(table):
    rows = profile.profile_columns(table(a=["b", "a", "b", "c", None, None, None])).collect()
    assert rows[0]["sample_values"] == ["b", "a", "c"]


def test_complex_columns_are_left_out(spark):
    df = spark.createDataFrame([(1, [1.0])], "id int, v array<double>")
    assert [r["column"] for r in profile.profile_columns(df).collect()] == ["id"]


# --- completeness ------------------------------------------------------------


def test_missing_counts_and_bands(table):
    df = table(a=["1", None, "n.d.", "N.D."], b=["x", "y", "z", " "], c=["1", "2", "3", "4"])
    found = by_column(completeness.missing_by_column(df))
    assert {c: (r["null_count"], r["null_pct"]) for c, r in found.items()} == {"a": (2, 50.0), "b": (1, 25.0)}
    assert completeness.rows_with_missing(df).first()["rows_with_any_null"] == 3
    assert [r["column"] for r in completeness.sparse_columns(df).collect()] == []  # exactly half is not sparse
    patterns = {r["missing_columns"]: r["rows"] for r in completeness.co_missing(df).collect()}
    assert patterns == {"": 1, "a": 2, "b": 1}


def test_severity_edges(spark):
    df = spark.createDataFrame([(95.0,), (95.01,), (20.0,), (5.0,), (4.99,)], "r double")
    rows = df.select(completeness.severity_from(F.col("r")), completeness.severity_above(F.col("r"))).collect()
    assert [r[0] for r in rows] == ["CRITICAL", "CRITICAL", "HIGH", "MODERATE", "LOW"]
    assert [r[1] for r in rows] == ["HIGH", "CRITICAL", "HIGH", "MODERATE", "LOW"]


def test_completeness_of_empty_table(spark):
    empty = spark.createDataFrame([], "a string")
    assert completeness.completeness_by_column(empty).first()["completeness_pct"] is None


# --- schema ------------------------------------------------------------------


def test_contamination_needs_more_than_placeholders(table):
    df = table(only_placeholder=["1"] * 19 + ["n.d."], odd=["1"] * 18 + ["n.d.", "6,0"])
    found = by_column(schema.type_contamination(df))
    assert set(found) == {"odd"}
    assert (found["odd"]["bad_count"], found["odd"]["examples"], found["odd"]["severity"]) == (2, ["6,0"], "MODERATE")
    assert schema.type_contamination(table(a=["x"])).collect() == []


def test_duplicate_columns_over_many_pairs(spark):
    # more than 62 involved columns need several bit sets
    names = [f"code{i:02d}x" for i in range(64)] + ["code"]
    df = spark.range(30).select(*[(F.col("id") % 7 + i % 2).cast("string").alias(n) for i, n in enumerate(names)])
    found = by_column(schema.duplicate_columns(df))
    assert set(found) == {n for i, n in enumerate(names[:-1]) if i % 2 == 0}
    assert all(r["column_b"] == "code" and r["jaccard"] == 1.0 for r in found.values())


def test_redundant_pairs_need_eleven_rows(table):
    ten = [str(i) for i in range(10)]
    assert schema.redundant_pairs(table(a=ten, b=ten)).collect() == []
    eleven = ten + ["A "]
    got = schema.redundant_pairs(table(a=eleven, b=ten + ["a"])).first()
    assert (got["rows_compared"], got["overlap_pct"]) == (11, 100.0)


# --- consistency -------------------------------------------------------------


def test_code_label_counts_codes_without_labels(table):
    df = table(
        code=["1", "1", "2", "2", "3", None] * 2, label=["a", "b", "c", "c", None, "z"] * 2
    )
    got = consistency.code_label_consistency(df).first()
    assert (got["codes"], got["inconsistent"], got["pct_inconsistent"]) == (3, 1, 33.3)


@pytest.mark.parametrize("distinct, found", [(15, True), (16, False)])
def test_code_cardinality_edge(table, distinct, found):
    code = [str(i % distinct) for i in range(96)]
    label = ["x" if i < 50 else "y" for i in range(96)]
    codes, labels = consistency.code_label_columns(table(code=code, label=label))
    assert (("code" in codes), labels) == (found, ["label"])


def test_period_and_month(table):
    df = table(period=["202401"] * 9 + ["202412"], year=["2024"] * 9 + ["2023"], month=["1"] * 10, name=["x"] * 10)
    found = {(r["other_column"], r["part"]): r["mismatch_count"] for r in consistency.period_mismatches(df).collect()}
    assert found == {("year", "year"): 1, ("month", "month"): 1}
    few = df.limit(4)
    assert consistency.period_mismatches(few).collect() == []


def test_negative_priority(table):
    df = table(total=["-1", "2", "3", "4", "5"], other=["-1", "-2", "3", "4", "5"], few=["-1", "2", None, None, None])
    got = {r["column"]: (r["priority"], r["negatives"]) for r in consistency.negative_values(df).collect()}
    assert got == {"total": ("HIGH", 1), "other": ("MODERATE", 2)}


def test_variant_cap(table):
    thirty = [f"v{i}" for i in range(28)] + ["Red", "red"]
    assert [r["folded"] for r in consistency.case_variants(table(a=thirty)).collect()] == ["red"]
    assert consistency.case_variants(table(a=thirty + ["one more"])).collect() == []
    assert sorted((r["folded"], r["form"]) for r in consistency.case_variant_rows(table(a=thirty + ["one more", "RED "])).collect()) == [("red", "RED "), ("red", "Red"), ("red", "red")]


# --- duplicates --------------------------------------------------------------


def brute_duplicates(rows):
    return len(rows) - len(set(rows))


@pytest.mark.parametrize("limit", ["-1", "10MB"])
def test_exact_duplicates_with_a_hot_row(spark, limit):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)  # -1 takes the shuffle joins
    random.seed(3)
    rows = [("hot", None)] * 400 + [(str(random.randrange(300)), random.choice([None, "a", "b"])) for _ in range(800)]
    df = spark.createDataFrame(rows, "a string, b string").repartition(4)
    got = duplicates.exact_duplicates(df).first()
    assert got["duplicate_rows"] == brute_duplicates(rows)
    left = [tuple(r) for r in duplicates.drop_duplicate_rows(df).collect()]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(map(str, left)) == sorted(map(str, set(rows)))


def test_swapped_nulls_are_different_rows(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    assert duplicates.exact_duplicates(df).first()["duplicate_rows"] == 0


def test_near_duplicates_on_null_keys(spark):
    rows = [(None, "1"), (None, "2"), ("k", "1"), ("k", "1"), ("u", "3")]
    df = spark.createDataFrame(rows, "k string, v string")
    assert duplicates.near_duplicates(df, ["k"]).first()["affected_rows"] == 4
    assert duplicates.near_duplicate_rows(df, ["k"]).count() == 4
    assert duplicates.near_duplicate_rows(df, ["k"], differing_only=True).count() == 2
    assert duplicates.differing_duplicates(df, keys=["k"]).first()["affected_rows"] == 2


def test_key_candidates_prefer_distinct_columns(table):
    df = table(a=[str(i) for i in range(20)], b=[str(i // 2) for i in range(20)], c=[str(i // 4) for i in range(20)])
    assert duplicates.key_candidates(df) == ["b", "c"]


# --- anomaly -----------------------------------------------------------------


@pytest.mark.parametrize("buckets, rows", [(4096, 20_000), (4096, 10), (64, 50)])
def test_quantiles_by_refinement(spark, buckets, rows):
    rng = np.random.default_rng(5)
    xs = np.concatenate([np.full(700, 3.25), rng.lognormal(0, 4, 1000), rng.normal(0, 1, 300), [1e300, -1e300]])
    df = spark.createDataFrame([(float(x),) for x in rng.permutation(xs)], "x double").repartition(4)
    ps = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    t = Thresholds(quantile_buckets=buckets, quantile_rows=rows)
    got = exact_quantiles(df, {"x": F.col("x")}, ps, t=t)["x"]
    assert np.allclose(got, np.quantile(xs, ps), rtol=1e-12)


def test_quantiles_when_the_sketch_is_off(spark, monkeypatch):
    """Brackets that miss the rank are widened; the result never depends on the sketch."""
    monkeypatch.setattr(quantiles, "_REACH", 0.0)
    monkeypatch.setattr(quantiles, "_SKETCH", 8)
    xs = np.random.default_rng(1).normal(0, 1, 5001)
    df = spark.createDataFrame([(float(x), float(-x)) for x in xs], "x double, y double")
    got = exact_quantiles(df, {"x": F.col("x"), "y": F.col("y")}, [0.1, 0.5, 0.9])
    assert np.allclose(got["x"], np.quantile(xs, [0.1, 0.5, 0.9])) and np.allclose(got["y"], np.quantile(-xs, [0.1, 0.5, 0.9]))


def test_quantiles_take_as_many_jobs_whatever_the_skew(spark):
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for name, x in (("even", F.col("id").cast("double")), ("skewed", F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.exp(F.col("id") / 100))), ("constant", F.lit(1.0))):
        df = spark.range(40_000).select(x.alias("x"))
        spark.sparkContext.setJobGroup(name, name)
        try:
            got = exact_quantiles(df, {"x": F.col("x")}, [0.25, 0.5, 0.75])["x"]
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs.append(len(tracker.getJobIdsForGroup(name)))
        assert np.allclose(got, df.agg(F.percentile("x", F.array(*map(F.lit, [0.25, 0.5, 0.75])))).first()[0])
    assert max(jobs) <= 16


def test_quantiles_of_one_value_and_none(spark):
    df = spark.createDataFrame([(1.0, None)], "x double, y double")
    got = exact_quantiles(df, {"x": F.col("x"), "y": F.col("y")}, [0.5])
    assert got == {"x": [1.0]}


def test_constant_column_has_no_outliers(table):
    assert anomaly.numeric_outliers(table(a=["5"] * 50)).collect() == []
    # nine values are too few, ten are enough
    nine = ["1"] * 8 + ["100"]
    assert anomaly.numeric_outliers(table(a=nine)).collect() == []
    got = anomaly.numeric_outliers(table(a=["1"] + nine)).first()
    assert (got["iqr_outliers"], got["lower_fence"], got["upper_fence"]) == (1, 1.0, 1.0)


def test_outlier_examples_keep_copies(table):
    cells = [str(i % 5) for i in range(95)] + ["1000", "1000", "900", "-700"]
    assert anomaly.largest_outliers(table(a=cells)).first()["examples"] == [1000.0, 1000.0, 900.0, -700.0]


def test_rare_values_count_null_as_a_value(table):
    cells = ["x"] * 998 + [None, "y"]
    got = {r["value"] for r in anomaly.rare_categories(table(a=cells)).collect()}
    assert got == {None, "y"}
    exactly = ["x"] * 995 + ["y"] * 5  # 0.5 % is not rare
    assert anomaly.rare_categories(table(a=exactly)).collect() == []


@pytest.mark.parametrize("distinct, n", [(50, 1), (51, 0)])
def test_rare_cardinality_cap(table, distinct, n):
    cells = [f"v{i % (distinct - 1)}" for i in range(distinct * 20)] + ["rare"]
    assert anomaly.rare_categories(table(a=cells)).count() == n


def test_scan_reads_native_numbers(spark):
    df = spark.createDataFrame([(1, 2.5, "3"), (None, -1.0, "x")], "i int, d double, s string")
    seen = scan(df)
    assert [seen.of(c, "numbers") for c in "ids"] == [1, 2, 1]
    assert seen.of("d", "negatives") == 1 and seen.of("s", "max") == 3.0


def test_examples_of_findings(spark, table):
    dates = ["2024-01-0%d" % (i % 9 + 1) for i in range(40)] + ["01/02/2024"] * 3 + ["soon", "soon", "n.d.", None, "2024-99-99"]
    row = schema.date_contamination(table(d=dates)).first()
    assert (row["bad_count"], row["examples"]) == (7, ["01/02/2024", "soon", "2024-99-99"])
    by_any = schema.date_contamination(table(d=dates), Thresholds(date_policy="any")).first()
    assert by_any["examples"] == ["soon", "2024-99-99"]
    periods = table(rata=["202401", "202402", "202403", "202404", "202405", "202406"], anno=["2024"] * 4 + ["2023", "2022"])
    assert consistency.period_mismatches(periods).first()["examples"] == ["202405: 2023", "202406: 2022"]
    signs = spark.createDataFrame([(-1.5, "-1"), (-7.0, "-2"), (-1.2, "-3"), (2.0, "4"), (float("nan"), None), (None, "x")], "v double, t string")
    found = consistency.negative_values(signs, native_only=True).collect()
    assert [(r["column"], r["negatives"], r["min_value"]) for r in found] == [("v", 3, -7.0)]
    assert set(found[0]["examples"]) <= {-1.5, -7.0, -1.2} and -7.0 in found[0]["examples"]
    empty = spark.createDataFrame([], "v double, t string")
    assert consistency.negative_values(empty, native_only=True).count() == consistency.negative_values(empty.select("t"), native_only=True).count() == 0


def test_values_far_from_the_mean(table):
    df = table(v=[str(i % 10) for i in range(200)] + ["500", "400", "400"], w=["5"] * 203)
    rows = {r["column"]: r["examples"] for r in anomaly.largest_outliers(df, by_deviation=True).collect()}
    assert rows == {"v": [500.0, 400.0, 400.0]}


def test_mostly_dates(table):
    df = table(d=["2024-01-01"] * 7 + ["x", "y", None], e=["2024-01-01"] * 6 + ["x"] * 4, f=["2024-01-01"] * 10)
    assert [tuple(r) for r in consistency.date_outliers(df).collect()] == [("d", 9, 2)]
