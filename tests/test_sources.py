import csv as python_csv

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from plumbline.operators import text_metrics
from plumbline.sources import csv, sinks
from plumbline.sources.tables import load, spread, text_layer


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
def test_delimiters(spark, table, tmp_path, sep):
    path = str(tmp_path / "t")
    df = table(a=["1", "n,d; x", "NA", None], b=[" p ", 'say "hi"', "q", "N/A"])
    sinks.write_csv(df.coalesce(1), path, sep)
    assert csv.detect_delimiter(spark, path) == sep
    got = {tuple(r) for r in csv.read_csv(spark, path).collect()}
    assert got == {("1", " p "), ("n,d; x", 'say "hi"'), (None, "q"), (None, None)}


def test_delimiter_falls_back_to_comma(spark, tmp_path):
    (tmp_path / "one.csv").write_text("name\nx\ny\n")
    assert csv.detect_delimiter(spark, str(tmp_path / "one.csv")) == ","


def test_malformed_utf8_is_replaced(spark, tmp_path):
    (tmp_path / "bad.csv").write_bytes(b"a,b\n\xff1,2\n")
    assert csv.read_csv(spark, str(tmp_path / "bad.csv")).first()["a"] == "�1"


def test_missing_path(spark):
    with pytest.raises(AnalysisException):
        csv.read_csv(spark, "/nowhere/x.csv", ",")


def test_inferred_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n2,y\n")
    assert csv.read_csv(spark, str(tmp_path / "t.csv"), infer_types=True).dtypes == [("a", "int"), ("b", "string")]


def test_stage_round_trip_keeps_odd_names(table, tmp_path):
    df = table(**{"a b,c": ["1"], "x;y": [None]})
    for fmt in ("parquet", "csv"):
        back = sinks.write_stage(df, str(tmp_path / fmt), 2, 1, fmt)
        assert back.columns == ["a b,c", "x;y"] and back.count() == 1
    assert sinks.stage_path("base", 2, 1) == "base/stage=v2_iter1"


def test_findings_without_nan(spark, tmp_path):
    df = spark.createDataFrame([("c", "x", None, "m", v, None, ["e"]) for v in (1.0, float("nan"), float("inf"))], sinks.FINDING_SCHEMA)
    sinks.write_findings(df, str(tmp_path / "f"))
    assert sorted(str(r["value"]) for r in sinks.read_findings(spark, str(tmp_path / "f")).collect()) == ["1.0", "None", "None"]
    lines = spark.createDataFrame([('{"check":"c","value":2.5}',), ("no json",)], "t string")
    assert [r["value"] for r in sinks.parse_findings(lines, "t").collect()] == [2.5, None]


def test_text_layer(spark):
    df = spark.createDataFrame([(1.5, 2, [1])], "d double, i int, a array<int>")
    assert tuple(text_layer(df, scale=2).first()) == ("1.50", "2")


def test_spread(spark, data):
    assert spread(load(spark, data, "orders")).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100).repartition(9)
    assert spread(many).rdd.getNumPartitions() == 9


def test_text_metrics(table):
    text = "Removed 3 exact duplicate rows. 4 exact duplicates. 12.5% missing, 2% missing. Score: 87.5/100 Grade: B+\nFixes applied: 3\n kept "
    row = (
        table(t=[text, "nothing 50 / 100"])
        .select(
            text_metrics.captured_sum(F.col("t"), text_metrics.DUPLICATE_PATTERNS).alias("dups"),
            text_metrics.captured_mean(F.col("t"), text_metrics.MISSING_PATTERN).alias("missing"),
            text_metrics.stated_score(F.col("t")).alias("score"),
            text_metrics.stated_grade(F.col("t")).alias("grade"),
            text_metrics.without_lines(F.col("t")).alias("kept"),
        )
        .collect()
    )
    assert (row[0]["dups"], row[0]["missing"], row[0]["score"], row[0]["grade"]) == (7, 7.25, "87.5", "B")  # the sign ends no word
    assert row[0]["kept"].endswith("B+\n kept") and "Fixes" not in row[0]["kept"]
    assert (row[1]["dups"], row[1]["missing"], row[1]["score"], row[1]["grade"]) == (0, None, "50", "")


def _with_splits(spark, bytes_, read):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, (bytes_, "1")):
        spark.conf.set(n, v)
    try:
        return read()
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)


HARD = [
    ["1", "two\nlines", "plain"], ["2", 'say ""hi""\n\n\nthen, "go"', "x"], ["3", "", None], ["4", "\n", "\n,\n"], ["5", ",,,", '"'], ["6", "a" * 300 + "\n" + "b" * 300, "z"],
    ["7", 'open " in the middle', 'end"'], ["8", "é\u2028ü\n", "\tq "], ["9", '\n"\n""\n', "last"],
]


@pytest.mark.parametrize("split", [23, 333, 100_000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_breaks_at_every_split_size(spark, tmp_path, split, end):
    """What Python's csv module wrote comes back, wherever the splits fall."""
    path = tmp_path / "t"
    path.mkdir()
    for k in range(2):
        with open(path / f"{k}.csv", "w", newline="", encoding="utf-8") as f:
            writer = python_csv.writer(f, lineterminator=end)
            writer.writerow(["id", "two\nline name", "c"])
            writer.writerows([[f"{k}{r[0]}", *r[1:]] for r in HARD])
    got = _with_splits(spark, str(split), lambda: [tuple(r) for r in csv.read_csv(spark, str(path), ",", na_values=()).collect()])
    want = [(f"{k}{a}", b or None, c) for k in range(2) for a, b, c in HARD]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert csv.read_csv(spark, str(path), ",").columns == ["id", "two\nline name", "c"]


def test_quotes_inside_plain_cells_open_nothing(spark, tmp_path):
    """Only a quote at the beginning of a cell opens it."""
    (tmp_path / "t.csv").write_text('a,b\n5" disk,x\n6" disk,"two\nlines"\n\n"",y\n')
    got = {tuple(r) for r in csv.read_csv(spark, str(tmp_path / "t.csv"), ",").collect()}
    assert got - {(None, "y"), ("", "y")} == {('5" disk', "x"), ('6" disk', "two\nlines")} and len(got) == 3


def test_unclosed_quote_and_empty_files(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,x\n2,"never\nclosed')
    assert {tuple(r) for r in csv.read_csv(spark, str(tmp_path / "t.csv"), ",").collect()} == {("1", "x"), ("2", "never\nclosed")}
    (tmp_path / "h.csv").write_text('a,"b\nc"\n')
    assert csv.read_csv(spark, str(tmp_path / "h.csv"), ",").collect() == []


def test_plain_files_are_read_as_before(spark, tmp_path):
    (tmp_path / "p.csv").write_text('a,b\n1,"x, y"\n2,z\n')
    plan = csv.read_csv(spark, str(tmp_path / "p.csv"), ",")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" in plan and "MapInArrow" not in plan
