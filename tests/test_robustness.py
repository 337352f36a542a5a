"""Inputs that the given tables do not hold: long cells, huge and odd numbers, wide files, nested columns."""

import datetime

import pytest
from pyspark.sql import functions as F

from plumbline.functions.dates import picture, shape, with_dates
from plumbline.functions.numbers import to_number
from plumbline.operators import anomaly, completeness, consistency, duplicates, remediation, schema, schema_fixes, text_metrics
from plumbline.operators.quantiles import exact_quantiles
from plumbline.plans import pipeline
from plumbline.sources import csv

INF, NAN = float("inf"), float("nan")
LONG_ISO = "2024-01-02T10:00:00.123456789+01:00[Europe/Rome]"


def test_long_datetimes_have_a_format(table):
    df = table(v=[LONG_ISO, "2024-01-02" + "x" * 60, "99/99/9999" + " " * 50])
    assert [r[0] for r in df.select(shape(F.col("v"), picture(F.col("v")))).collect()] == ["ISO-8601 datetime", "other", "other"]
    assert with_dates(table(value=[LONG_ISO])).first()["date"] == datetime.date(2024, 1, 2)


def test_common_spellings_of_dates(table):
    cells = ["1/2/2024", "2024-1-5", "18/06/2025 10:30", "18 June 2025", "June 18, 2025", "18 giugno 2025", "12/25/2024 9:05", "2024/1/5", "Marble 18 2025", "32/1/2024"]
    got = [r["date"] for r in with_dates(table(value=cells)).collect()]
    d = datetime.date
    june = d(2025, 6, 18)
    assert got == [d(2024, 2, 1), d(2024, 1, 5), june, june, june, june, d(2024, 12, 25), d(2024, 1, 5), None, None]


def test_numbers_at_the_edge_of_a_double(table):
    cells = ["1e300", "1.5e308", "1e309", "9" * 400, "-1e400", "1e-400", "nan", "inf"]
    assert [r[0] for r in table(v=cells).select(to_number(F.col("v"))).collect()] == [1e300, 1.5e308, None, None, None, 0.0, None, None]


def test_delimiter_of_wide_lines(spark, tmp_path):
    path = str(tmp_path / "wide.csv")
    names = [f"column_number_{i}" for i in range(900)]
    with open(path, "w") as f:
        for row in (names, ["1,5"] * 900, ["2"] * 900, ["3"] * 450):
            f.write(";".join(row) + "\n")
    assert csv.detect_delimiter(spark, path) == ";"
    assert len(csv.read_csv(spark, path).columns) == 900


def test_types_are_inferred_without_the_missing_cells(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    with open(path, "w") as f:
        f.write("a,b,c,d,e\n1,NA,2024-01-02,x,NA\nNA,2.5,,1,NA\n3,1e3,2024-01-03,2,\n")
    assert csv.read_csv(spark, path, infer_types=True).dtypes == [("a", "int"), ("b", "double"), ("c", "date"), ("d", "string"), ("e", "string")]


def test_digits_beyond_a_long(table):
    ids = [str(10**23 + i) for i in range(20)]
    df = table(k=ids, rata=["202401"] * 20, anno=["24"] * 20)
    assert consistency.period_mismatches(df).count() >= 0
    assert schema_fixes.coerce_years(df, ["k", "anno"]).select("anno").first()[0] == 2024
    assert table(t=["Removed 99999999999999999999 exact duplicate rows"]).select(text_metrics.captured_sum(F.col("t"), text_metrics.DUPLICATE_PATTERNS)).first()[0] is None


@pytest.mark.parametrize("odd", [INF, -INF, NAN])
def test_quantiles_without_odd_values(spark, odd):
    df = spark.createDataFrame([(float(i),) for i in range(1, 102)] + [(odd,)] * 3 + [(None,)], "x double")
    t = pipeline.Thresholds(quantile_rows=10, quantile_buckets=4)
    assert exact_quantiles(df, {"x": F.col("x")}, [0.0, 0.5, 1.0], t=t)["x"] == [1.0, 51.0, 101.0]
    assert anomaly.numeric_outliers(df, t).collect() == []
    capped = remediation.cap_at_percentile(df, ["x"], 0.5)
    assert capped.where("x is null").count() == 4 and capped.agg(F.max("x")).first()[0] == 51.0


def test_quantiles_of_tiny_values(spark):
    df = spark.createDataFrame([(5e-324 * (i % 3),) for i in range(30)], "x double")
    t = pipeline.Thresholds(quantile_rows=1, quantile_buckets=4)
    assert exact_quantiles(df, {"x": F.col("x")}, [0.5], t=t)["x"] == [5e-324]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(NAN,), (None,), (1.0,)], "x double")
    assert completeness.missing_by_column(df).first()["null_count"] == 2


def test_capping_keeps_missing_cells(table):
    df = table(spesa=[str(i) for i in range(1, 100)] + [None, "N.D."])
    capped = remediation.cap_at_percentile(df, ["spesa"], 0.9)
    assert capped.where("spesa is null").count() == 2


def test_names_of_nested_columns_and_empty_tables(spark):
    df = spark.createDataFrame([], "`A B` array<int>, `_id` string, ok int")
    assert {(r["column"], r["cells"]) for r in schema.naming_violations(df).collect()} == {("A B", 0)}


NESTED = "k string, `My List` array<double>, m map<string,int>, s struct<n:map<int,string>,t:string>, b binary"


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_nested_columns_go_through_the_pipeline(spark, tmp_path, fmt):
    def row(i, turned=False):
        m = {"b": 2, "a": i} if turned else {"a": i, "b": 2}
        return f"k{i}", [1.0, None], m, ({2: "y", 1: "x"} if turned else {1: "x", 2: "y"}, None) if fmt == "parquet" else None, bytearray([i])

    rows = [row(i) for i in range(20)] + [row(i, turned=True) for i in range(5)] + [("k0", None, {"a": 9}, None, None)]
    schema_ = NESTED if fmt == "parquet" else NESTED.replace("map<int,string>", "map<string,string>")
    report = pipeline.run(spark.createDataFrame(rows, schema_), folder=str(tmp_path), fmt=fmt)
    out = report.df
    # JSON cells have no key order either, so both formats keep 21 of the 26 rows.
    assert out.count() == 21
    assert [k for _, k in out.dtypes][1:] == ["array<double>", "map<string,int>", out.dtypes[3][1], "binary"]
    assert "my_list" in out.columns
    kept = {(r["k"], tuple(r["my_list"] or ())): r for r in out.collect()}
    assert kept["k3", (1.0, None)]["m"] == {"a": 3, "b": 2} and kept["k3", (1.0, None)]["b"] == bytearray([3])
    assert kept["k0", ()]["m"] == {"a": 9}
    assert ("drop_duplicate_rows", 5) in {(r["action"], r["affected"]) for r in report.changes.collect()}


def test_maps_are_compared_by_their_entries(spark):
    df = spark.sql(
        "select * from values (1, array(map('a', 1, 'b', 2))), (1, array(map('b', 2, 'a', 1))), (1, array(map('b', 1, 'a', 2))), "
        "(2, null), (2, null), (3, array(null)), (3, array()) as t(k, `m x`)"
    )
    assert duplicates.exact_duplicates(df).first()["duplicate_rows"] == 2
    assert duplicates.drop_duplicate_rows(df).count() == 5
    assert duplicates.drop_duplicate_rows(df).dtypes == df.dtypes
    groups = duplicates.differing_duplicates(df, keys=["k"]).first()
    assert (groups["key_groups"], groups["affected_rows"]) == (2, 5)
    assert duplicates.near_duplicate_rows(df, ["m x"]).count() == 4


def test_rows_that_differ_only_in_nulls(spark):
    df = spark.createDataFrame([("k", "a", None), ("k", "a", 1), ("m", "a", None), ("m", "a", None), (None, "a", 1), (None, "b", 1)], "k string, v string, n int")
    row = duplicates.differing_duplicates(df, keys=["k"]).first()
    assert (row["key_groups"], row["affected_rows"]) == (2, 4)
    assert sorted(str(r["k"]) for r in duplicates.near_duplicate_rows(df, ["k"], differing_only=True).collect()) == ["None", "None", "k", "k"]


def test_codes_against_all_labels(table):
    df = table(cod=["1", "1", "2", None], a=["x", "y", "z", "q"], b=["x", None, "z", "q"])
    pairs = [("cod", "a"), ("cod", "b")]
    got = {r["label_column"]: (r["codes"], r["inconsistent"]) for r in consistency.code_label_consistency(df, pairs=pairs, only_broken=False).collect()}
    assert got == {"a": (2, 1), "b": (2, 0)}
