import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.functions import names
from plumbline.functions.dates import period, picture, shape, with_dates
from plumbline.functions.numbers import expand_year, rounded, to_number
from plumbline.functions.text import drop_currency, null_placeholders, strip


def values(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_number_traps(table):
    cells = ["12d", "1_000", "6,0", " 12 ", "inf", "nan", "5.", ".5", "-1e3", "", None, "+7", "0x1", "1e999"]
    assert values(table(v=cells), to_number(F.col("v"))) == [
        None, None, None, 12.0, None, None, 5.0, 0.5, -1000.0, None, None, 7.0, None, None,
    ]


def test_dates_day_first_with_month_first_fallback(table):
    cells = {
        "11/07/2024": "2024-07-11", "12/25/2024": "2024-12-25", "202402": None, "GIU 18 2025": "2025-06-18",
        "Feb-2024": "2024-02-01", "2024-06": "2024-06-01", "06/2024": "2024-06-01", "11-05-24": "2024-05-11",
        "11-05-74": "1974-05-11", "2024-01-02T03:04:05": "2024-01-02", "99/99/2024": None, "3 Mar 2024": "2024-03-03",
        "31.12.1999": "1999-12-31", "2024-02-30": None, "2024/04/11": "2024-04-11", "Jun 18 2025": "2025-06-18",
        "mon 18 2025": None, "text": None, " 2024-01-05 ": "2024-01-05",
    }
    got = with_dates(table(value=list(cells))).select("value", F.col("date").cast("string")).collect()
    assert {r[0]: r[1] for r in got} == cells


def test_shapes(table):
    cells = ["2024-01-02T0", "2024-01-02Z", "202401", "GEN-2024", "gen-2024", "01/2024", "x", "2024-01-02"]
    text = F.col("v")
    assert values(table(v=cells), shape(text, picture(text))) == [
        "ISO-8601 datetime", "other", "YYYYMM", "MON-YYYY", "other", "MM/YYYY", "other", "YYYY-MM-DD",
    ]


def test_months_and_periods(table):
    cells = ["2024-06", "06/2024", "GIU-2024", "202406", "2024-13", "Rata 2024"]
    assert values(table(v=cells), period(F.col("v"))) == ["202406", "202406", "202406", "202406", None, None]


def test_text(table):
    assert values(table(v=[" \tab c ", None]), strip(F.col("v"))) == ["ab c", None]
    assert values(table(v=["€1", "EUR 2 ", "$3%", "6,0"]), drop_currency(F.col("v"))) == ["1", "2", "3", "6,0"]
    assert values(table(v=["n.d.", "N.D.", "Unknown", "unknown", " ", ""]), null_placeholders(F.col("v"))) == [
        None, "N.D.", "Unknown", None, None, None,
    ]
    assert values(table(v=[" n.d. "]), null_placeholders(F.col("v"), trimmed=True)) == [None]


def test_years(spark):
    df = spark.createDataFrame([(0,), (29,), (30,), (99,), (1999,), (-5,), (2101,)], "y bigint")
    assert values(df, expand_year(F.col("y"))) == [2000, 2029, 1930, 1999, 1999, -5, 2101]


def test_names():
    assert names.violations("1Spesa-Totale %") == ["uppercase", "space", "digit start", "special character", "hyphen"]
    assert names.snake_case("Spesa  TOTALE%") == "spesa_totale"
    assert names.snake_case_dropping("2cod_imposta") == "col_2cod_imposta"
    assert names.snake_case_dropping("ente%code") == "entecode"
    assert names.renames(["A B", "a_b", "a-b"], names.snake_case) == {"A B": "a_b", "a_b": "a_b_2", "a-b": "a_b_3"}
    assert names.resolve("aggregation_time", ["aggregation-time"]) == "aggregation-time"
    assert names.resolve("spesa_totale", ["SPESA TOTALE"]) == "SPESA TOTALE"
    assert names.resolve("x", ["y"]) is None


@settings(max_examples=3, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=5, max_size=30))
def test_rounding_agrees_with_numpy(spark, xs):
    import numpy as np

    got = values(spark.createDataFrame([(x,) for x in xs], "x double"), rounded(F.col("x"), 2))
    assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(got, np.round(np.array(xs), 2)))


@pytest.mark.parametrize("cell", ["a`b", "a b", "a.b"])
def test_odd_column_names(spark, cell):
    from plumbline.functions.text import ref

    df = spark.createDataFrame([("1",)], "x string").toDF(cell)
    assert df.select(to_number(ref(cell))).first()[0] == 1.0
