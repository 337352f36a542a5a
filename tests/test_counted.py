"""Cells read once a value, and what that must not change."""

import re

import pytest
from pyspark.sql import functions as F

from plumbline.config import Thresholds
from plumbline.functions.dates import with_dates
from plumbline.operators import consistency, schema
from plumbline.operators.anomaly import numeric_outliers
from plumbline.operators.cells import cells
from plumbline.operators.counted import counted_cells
from plumbline.operators.findings import schema_findings
from plumbline.operators.profile import profile_columns
from plumbline.operators.quantiles import counted_quantiles, exact_quantiles
from plumbline.operators.scan import scan
from plumbline.plans import pipeline
from plumbline.session import cut


def _rows(df):
    return sorted(map(str, df.collect()))


def _mixed(table):
    days = [f"2024-01-{i:02d}" for i in range(1, 29)] * 2
    return table(day=days + ["13/02/2024", "n.d.", None, "nonsense"], n=[str(i % 9 - 1) for i in range(56)] + ["x", None, "", "7.5"])


def test_counted_cells_add_up_whatever_is_counted(table):
    df = _mixed(table)
    counted, single = counted_cells(df), counted_cells(df, t=Thresholds(counted_values=0))
    assert counted.count() < single.count() == 2 * df.count()
    summed = [_rows(x.groupBy("column", "value").agg(F.sum("cnt").alias("cnt"))) for x in (counted, single)]
    assert summed[0] == summed[1]


def test_checks_do_not_depend_on_what_is_counted(table):
    df = _mixed(table)
    ways = [counted_cells(df), counted_cells(df, t=Thresholds(counted_values=0))]
    for check in (schema.type_contamination, schema.date_contamination, consistency.mixed_formats):
        first, second = (_rows(check(df, counted=c)) for c in ways)
        assert first == second
    assert "13/02/2024" in str(schema.date_contamination(df, counted=ways[0]).collect())
    assert _rows(schema_findings(df, counted=ways[0])) == _rows(schema_findings(df, counted=ways[1]))
    figures = ("filled", "numbers", "periods", "negatives", "min", "negative_0", "about_distinct", "about_numbers")
    assert scan(df, figures) == scan(df, figures, counted=ways[0])
    profiles = [_rows(profile_columns(df, Thresholds(text_values=0, counted_values=n))) for n in (0, 1000)]
    assert profiles[0] == profiles[1]


def test_reading_dates_is_small_enough_to_be_compiled(spark, table, capsys):
    """The JVM leaves methods of over 8,000 bytes to its interpreter."""
    df = _mixed(table)
    settings = {"spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        with_dates(cells(df)).groupBy("column", "layout").agg(F.count("date")).explain("codegen")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_moments_and_quartiles_of_counted_columns_equal_those_of_cells(spark):
    """Weighted by their counts, far from zero and for a constant column too."""
    numbers = [1e9 + x for x in (1, 2, 2, 2, 5, 5, 7, 8, 90, 90, 3, 3)]
    df = spark.createDataFrame([(str(x), 0.1, x) for x in numbers] + [(None, 0.1, None), ("n.d.", 0.1, float("nan"))], "a string, b double, c double")
    counted = counted_cells(df)
    figures = ("filled", "numbers", "min", "max", "mean", "std", "std_population")
    plain, by_value = scan(df, figures), scan(df, figures, counted=counted)
    assert by_value.values == {c: pytest.approx(v, rel=1e-9) for c, v in plain.values.items()}
    assert by_value.of("b", "std") == 0.0
    assert _rows(numeric_outliers(df, counted=counted)) == _rows(numeric_outliers(df))
    quartiles = exact_quantiles(df, {"a": F.col("a").try_cast("double")}, (0.0, 0.25, 0.5, 1.0))
    assert counted_quantiles(counted, ["a"], (0.0, 0.25, 0.5, 1.0)) == quartiles


def test_pipeline_counts_the_cells_of_an_unchanged_table_once(table, monkeypatch):
    """Profile, checks and fixes share the counted cells, and a table that a fix has written is not written again."""
    df = table(a=["1", "2", "x", "2"] * 5, b=["u", "U", "u", None] * 5, c=["2024-01-02"] * 20)
    taken, written = [], []
    monkeypatch.setattr(pipeline, "counted_cells", lambda *a, **k: taken.append(1) or counted_cells(*a, **k))
    monkeypatch.setattr(pipeline, "cut", lambda x: written.append(1) or cut(x))
    report = pipeline.run(df)
    stored = sum(r["stage"] in ("schema", "completeness") for r in report.log.collect())
    assert len(written) <= 1 + stored + 1  # the profile, stages that do not write their table, the remediation at most
    assert len(taken) == 1 + sum(r["stage"] in ("schema", "completeness", "consistency") for r in report.log.collect())


def test_methods_that_the_jvm_would_interpret_are_split(spark):
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    try:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
        cut(spark.range(1).toDF("i"))
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "9000")
        cut(spark.range(1).toDF("i"))
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "9000"
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", before)
