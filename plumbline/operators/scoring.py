"""Suggestions, reliability scores, grades and the improvement roadmap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.numbers import rounded, share
from plumbline.operators.cells import measure, small_frame


def quality_metrics(findings: DataFrame, column_count: int) -> DataFrame:
    """One row with a figure per kind of issue, taken from a findings frame.

    ``avg_missing_pct`` is the mean over columns with missing cells, ``outlier_penalty`` the sum over columns of
    outliers / 50, at most 10 each.
    """
    check, value = F.col("check"), F.col("value")

    def number(*names: str) -> Column:
        return F.count_if(check.isin(*names))

    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.when(check == name, value)), F.lit(0.0))

    return findings.agg(
        F.lit(column_count).cast("long").alias("column_count"),
        F.coalesce(F.avg(F.when(check == "missing", value)), F.lit(0.0)).alias("avg_missing_pct"),
        number("naming").alias("naming_issues"),
        number("type_contamination", "date_contamination").alias("type_issues"),
        F.coalesce(F.max(F.when(check == "completeness", value)), F.lit(100.0)).alias("completeness_pct"),
        number("mixed_formats").alias("format_issues"),
        total("exact_duplicates").cast("long").alias("duplicate_rows"),
        total("iqr_outliers").cast("long").alias("iqr_outliers"),
        F.coalesce(F.sum(F.when(check == "iqr_outliers", F.least(value / 50, F.lit(10.0)))), F.lit(0.0)).alias("outlier_penalty"),
        number("rare_value").alias("rare_values"),
        (number("code_label", "period") > 0).alias("cross_column"),
    )


# --- scores ------------------------------------------------------------------


def grade(score: Column) -> Column:
    return F.when(score >= 90, "A").when(score >= 75, "B").when(score >= 60, "C").when(score >= 45, "D").otherwise("F")


def grade_strict(score: Column) -> Column:
    return F.when(score >= 90, "A").when(score >= 80, "B").when(score >= 70, "C").when(score >= 60, "D").otherwise("F")


def _scale() -> Column:
    """Wide tables are not punished per column."""
    return F.least(F.lit(10.0) / F.greatest(F.col("column_count"), F.lit(1)), F.lit(1.0))


def _capped(x: Column, cap: float) -> Column:
    return F.least(x.cast("double"), F.lit(float(cap)))


def reliability_score(metrics: DataFrame) -> DataFrame:
    """Metrics rows with deductions, score (0-100) and grade."""
    deductions = {
        "missing_deduction": rounded(_capped(F.col("avg_missing_pct") * 0.4, 20), 1),
        "naming_deduction": rounded(_capped(F.col("naming_issues") * _scale(), 5), 1),
        "duplicate_deduction": rounded(_capped(F.col("duplicate_rows") / 100, 10), 1),
        "outlier_deduction": rounded(_capped(F.col("iqr_outliers") / 50, 10), 1),
        "cross_deduction": F.when(F.col("cross_column"), 5.0).otherwise(0.0),
    }
    total = sum((F.col(d) for d in deductions), F.lit(0.0))
    return (
        metrics.withColumns(deductions)
        .withColumn("score", F.greatest(F.lit(0.0), rounded(F.lit(100.0) - total, 1)))
        .withColumn("grade", grade(F.col("score")))
    )


def documented_score(metrics: DataFrame) -> DataFrame:
    """Documented variant of the score: type, naming, completeness, format and per-column outlier deductions."""
    schema = _capped((F.col("type_issues") * 3 + F.col("naming_issues")) * _scale(), 20)
    total = (
        schema
        + (F.lit(100.0) - F.col("completeness_pct")) * 0.5
        + F.col("format_issues") * 3 * _scale()
        + F.when(F.col("cross_column"), 5.0).otherwise(0.0)
        + _capped(F.col("duplicate_rows") / 100, 10)
        + F.col("outlier_penalty")
    )
    return metrics.withColumn("score", F.greatest(F.lit(0.0), rounded(F.lit(100.0) - total, 1))).withColumn(
        "grade", grade(F.col("score"))
    )


def null_rate_score(rates: DataFrame, text_columns: list[str]) -> DataFrame:
    """Alternate score from null shares per column (``column``, ``row_count``, ``null_count``).

    Over 20 % costs 20 times the share, at most 10; over 5 % five times the share; a text column over 10 % one
    more, unless it is a flag column.
    """
    p = share(F.col("null_count"), F.col("row_count"))
    worded = F.col("column").isin(*text_columns) if text_columns else F.lit(False)
    filled = F.col("null_count") < F.col("row_count")
    cost = F.when(p > 0.20, F.least(p * 20, F.lit(10.0))).when(p > 0.05, p * 5).otherwise(0.0)
    extra = F.when(worded & filled & ~F.col("column").endswith("_flag") & (p > 0.10), 1.0).otherwise(0.0)
    return (
        rates.agg(F.coalesce(F.sum(cost + extra), F.lit(0.0)).alias("deduction"))
        .select(
            rounded(F.col("deduction"), 4).alias("deduction"),
            F.greatest(F.lit(0.0), rounded(F.lit(100.0) - F.col("deduction"), 1)).alias("score"),
        )
        .withColumn("grade", grade_strict(F.col("score")))
    )


# --- suggestions and roadmap -------------------------------------------------

TRIM = "trim_text_columns"
SNAKE_CASE = "rename_to_snake_case"
DEDUPLICATE = "drop_repeated_rows"
CAP = "cap_extremes_and_group_rare"
PRESERVE = "keep_nulls_and_flag_them"


def suggestions(metrics: DataFrame) -> DataFrame:
    """(place, field, issue, action, confidence, risk, auto_apply) for the issues a metrics row shows.

    Only low-risk actions with a confidence of at least 0.9 are applied without review.
    """
    always = F.lit(True)
    rules = [
        ("all_text_columns", "outer_blanks", TRIM, 0.97, "low", always),
        ("column_names", "names_not_snake_case", SNAKE_CASE, 0.95, "low", F.col("naming_issues") > 0),
        ("rows", "repeated_rows", DEDUPLICATE, 0.90, "low", F.col("duplicate_rows") > 0),
        ("anomaly_columns", "outliers_or_rare_values", CAP, 0.82, "medium", (F.col("iqr_outliers") > 0) | (F.col("rare_values") > 0)),
        ("missing_values", "missing_cells", PRESERVE, 0.92, "low", F.col("avg_missing_pct") > 0),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("place"), F.lit(field).alias("field"), F.lit(issue).alias("issue"), F.lit(action).alias("action"),
                F.lit(confidence).alias("confidence"), F.lit(risk).alias("risk"),
                F.lit(confidence >= 0.9 and risk == "low").alias("auto_apply"), when.alias("applies"),
            )
            for i, (field, issue, action, confidence, risk, when) in enumerate(rules, 1)
        ]
    )
    return metrics.select(F.inline(rows)).filter("applies").drop("applies")


def roadmap(metrics: DataFrame) -> DataFrame:
    """(priority, category, action, score_impact, difficulty, auto_applicable), largest impact first."""
    rules = [
        ("Consistency", "drop_repeats_and_merge_near_ones", 8.0, "easy", True, F.col("duplicate_rows") > 0),
        ("Completeness", "fill_or_drop_sparse_columns", 7.0, "medium", True, F.col("avg_missing_pct") > 0),
        ("Schema", "unify_types_and_dates", 6.0, "easy", True, F.col("type_issues") + F.col("format_issues") > 0),
        ("Anomaly", "check_outliers_and_rare_values", 4.0, "medium", False, F.col("iqr_outliers") + F.col("rare_values") > 0),
    ]
    nothing = ~rules[0][-1]
    for rule in rules[1:]:
        nothing = nothing & ~rule[-1]
    rules.append(("General", "spot_check_key_columns", 3.0, "medium", False, nothing))
    rows = F.array(
        *[
            F.struct(
                F.lit(category).alias("category"), F.lit(action).alias("action"), F.lit(impact).alias("score_impact"),
                F.lit(difficulty).alias("difficulty"), F.lit(auto).alias("auto_applicable"), when.alias("applies"),
            )
            for category, action, impact, difficulty, auto, when in rules
        ]
    )
    kept = F.array_sort(F.filter(rows, lambda r: r["applies"]), lambda a, b: F.signum(b["score_impact"] - a["score_impact"]).cast("int"))
    return metrics.select(F.posexplode(kept).alias("i", "r")).select(
        (F.col("i") + 1).alias("priority"), "r.category", "r.action", "r.score_impact", "r.difficulty", "r.auto_applicable"
    )


def expected_score(score: float, steps: DataFrame) -> DataFrame:
    """One row: gain of the three largest roadmap steps and the score after them."""
    gain = F.coalesce(F.sum("score_impact"), F.lit(0.0))
    return (
        steps.filter("priority <= 3")
        .agg(gain.alias("gain"))
        .select(
            F.lit(score).alias("score"), "gain", F.least(F.lit(100.0), rounded(F.lit(score) + F.col("gain"), 1)).alias("expected_score")
        )
    )


def before_after(before: DataFrame, after: DataFrame, score: float, mark: str) -> DataFrame:
    """One row: rows and columns before and after the fixes, with score and grade."""
    rows = [measure(d, {"n": F.count(F.lit(1))})["n"] for d in (before, after)]
    return small_frame(
        after,
        [(rows[0], rows[1], len(before.columns), len(after.columns), score, mark)],
        "original_rows bigint, fixed_rows bigint, original_columns bigint, fixed_columns bigint, score double, grade string",
    )
