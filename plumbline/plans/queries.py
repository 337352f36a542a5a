"""Every operator as a query over the given tables: name -> (spark, folder) -> DataFrame.

Array and map results are printed to text so that rows can be compared with any SQL engine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.config import Thresholds
from plumbline.functions.numbers import rounded
from plumbline.functions.text import ref
from plumbline.operators import (
    anomaly,
    changes,
    completeness,
    completeness_fixes,
    consistency,
    consistency_fixes,
    counted,
    duplicates,
    findings,
    profile,
    remediation,
    schema,
    schema_fixes,
    scoring,
    text_metrics,
)
from plumbline.plans import pipeline
from plumbline.plans.dirty_orders import dirty_orders
from plumbline.session import cut, shared_folder
from plumbline.sources import csv, sinks
from plumbline.sources.tables import load, spread, text_layer

# What an analyst asks for beyond the profile; the values alone leave the year 2001 written as 1 ambiguous.
ENRICHMENTS = {
    "anno": {"fix_action": "coerce_year", "params": {}},
    "quota": {"fix_action": "round_Ndp", "params": {"decimals": 2}},
}

Query = Callable[[SparkSession, str], DataFrame]


def _joined(c: str | Column) -> Column:
    return F.array_join(F.col(c) if isinstance(c, str) else c, "|")


def _rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: rounded(F.col(c), digits) for c in columns})


def _printed(df: DataFrame) -> DataFrame:
    """A repaired table with every cell as text; doubles with two decimals."""
    return text_layer(df, scale=2)


def _scratch(spark: SparkSession) -> str:
    """A new folder all executors reach."""
    return f"{shared_folder(spark)}/plumbline-{uuid.uuid4().hex}"


# --- sources and sinks -------------------------------------------------------


def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Semicolon file written, its delimiter found, read back with NA strings as null."""
    path = _scratch(spark)
    sinks.write_csv(dirty_orders(spark, folder), path, sep=";")
    sep = csv.detect_delimiter(spark, path)
    df = csv.read_csv(spark, path, sep)
    return completeness.missing_counts(df, placeholders=False).withColumn("delimiter", F.lit(sep))


def csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    """Customer as CSV, read back with inferred types."""
    path = _scratch(spark)
    sinks.write_csv(load(spark, folder, "customer"), path)
    df = csv.read_csv(spark, path, infer_types=True)
    kinds = F.create_map(*[F.lit(x) for c, k in df.dtypes for x in (c, k)])
    return (
        completeness.missing_counts(df).select("column", "row_count").withColumn("dtype", F.element_at(kinds, F.col("column")))
    )


def csv_quoted_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as CSV, whose texts hold line breaks and quotes, read back in splits."""
    path = _scratch(spark)
    sinks.write_csv(load(spark, folder, "documents").select("doc_id", "text", "lang", "source"), path)
    df = csv.read_csv(spark, path, na_values=())
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


def csv_malformed(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in a file in which every third name begins with a byte that is no UTF-8."""
    path = _scratch(spark)
    customer = load(spark, folder, "customer")
    broken = F.when(F.col("c_custkey") % 3 == 0, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    lines = customer.select(F.concat(broken, F.concat_ws(",", "c_name", "c_custkey").cast("binary")).cast("string").alias("value"))
    header = customer.select(F.lit("c_name,c_custkey").alias("value")).limit(1)
    header.unionByName(lines).coalesce(1).write.text(path)
    return csv.read_csv(spark, path, ",").select("c_name", F.col("c_custkey").cast("int").alias("c_custkey"))


def findings_json(spark: SparkSession, folder: str) -> DataFrame:
    """Completeness findings through the JSON sink and back."""
    path = _scratch(spark)
    sinks.write_findings(findings.completeness_findings(dirty_orders(spark, folder)), path)
    return sinks.read_findings(spark, path).select("check", "column", "metric", "value", "severity")


def stage_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Stage table written as version 2 and read back."""
    return sinks.write_stage(completeness_fixes.clear_placeholders(dirty_orders(spark, folder)), _scratch(spark), 2)


# --- profile -----------------------------------------------------------------


def _profile(df: DataFrame) -> DataFrame:
    out = profile.profile_columns(df)
    return _rounded(out, "numeric_ratio", "date_ratio", "avg_length").withColumn("sample_values", _joined("sample_values"))


def profile_dirty(spark: SparkSession, folder: str) -> DataFrame:
    return _profile(dirty_orders(spark, folder))


def profile_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return _profile(text_layer(spread(load(spark, folder, "lineitem")), scale=2))


def profile_events(spark: SparkSession, folder: str) -> DataFrame:
    return _profile(text_layer(spread(load(spark, folder, "events")), scale=2))


def profile_summary(spark: SparkSession, folder: str) -> DataFrame:
    out = profile.profile_summary(profile.profile_columns(dirty_orders(spark, folder), samples=False))
    return out.withColumns({n: _joined(n) for n, k in out.dtypes if k.startswith("array")})


def stage_gates(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.stage_gates(
        profile.profile_summary(profile.profile_columns(dirty_orders(spark, folder), samples=False))
    )


# --- completeness ------------------------------------------------------------


def completeness_fix(spark: SparkSession, folder: str) -> DataFrame:
    return completeness_fixes.fix_completeness(dirty_orders(spark, folder)).df


def missing_indicators(spark: SparkSession, folder: str) -> DataFrame:
    df = completeness_fixes.clear_placeholders(dirty_orders(spark, folder)).select("_id", "spesa", "area_geografica")
    return completeness.missing_indicators(df, ["spesa", "area_geografica"])


def fill_unknown(spark: SparkSession, folder: str) -> DataFrame:
    df = dirty_orders(spark, folder).select("_id", "stato", "area_geografica", "note")
    return completeness_fixes.fill_unknown(df, ["area_geografica", "note"])


def fill_mode(spark: SparkSession, folder: str) -> DataFrame:
    df = dirty_orders(spark, folder).select("_id", "area_geografica", "note")
    return completeness_fixes.fill_mode(df, ["area_geografica", "note"])


# --- schema ------------------------------------------------------------------


def type_contamination(spark: SparkSession, folder: str) -> DataFrame:
    return schema.type_contamination(dirty_orders(spark, folder)).withColumn("examples", _joined("examples"))


def domain_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """Value overlap of key columns that should refer to each other."""
    keys = load(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    return schema.domain_overlap(
        keys, [("l_orderkey", "l_partkey"), ("l_orderkey", "l_suppkey"), ("l_partkey", "l_suppkey")]
    ).withColumn("jaccard", rounded(F.col("jaccard"), 4))


def strip_currency(spark: SparkSession, folder: str) -> DataFrame:
    df = dirty_orders(spark, folder).select("_id", "spesa", "mese", "quota")
    return _printed(schema_fixes.strip_currency(df, ["spesa", "mese"]).drop("quota"))


def coerce_years(spark: SparkSession, folder: str) -> DataFrame:
    return schema_fixes.coerce_years(dirty_orders(spark, folder).select("_id", "anno", "mese"), ["anno"])


def round_decimals(spark: SparkSession, folder: str) -> DataFrame:
    return _printed(schema_fixes.round_decimals(dirty_orders(spark, folder).select("_id", "quota"), {"quota": 2}))


def coerce_integers(spark: SparkSession, folder: str) -> DataFrame:
    df = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return schema_fixes.coerce_integers(df, ["l_quantity", "l_discount"])


def mostly_numeric(spark: SparkSession, folder: str) -> DataFrame:
    return _printed(schema_fixes.coerce_mostly_numeric(cut(dirty_orders(spark, folder))).df)


def overlapping_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Table without columns that repeat another one."""
    df = dirty_orders(spark, folder)
    return df.drop(*[ref(c) for c in schema_fixes.overlapping_columns(df)])


def redundant_columns(spark: SparkSession, folder: str) -> DataFrame:
    return schema_fixes.drop_redundant(dirty_orders(spark, folder)).df


def snake_case_names(spark: SparkSession, folder: str) -> DataFrame:
    return schema_fixes.rename_snake_case(dirty_orders(spark, folder), dropping=True)


def enrichment_proposals(spark: SparkSession, folder: str) -> DataFrame:
    df = cut(dirty_orders(spark, folder))
    cells = counted.counted_cells(df)
    found = schema_fixes.propose_enrichments(df, profile.profile_table(df, counted=cells).typed("numeric"), counted=cells)
    rows = [(c, e["fix_action"], e["params"].get("decimals")) for c, e in found.items()]
    return spark.createDataFrame(rows, "`column` string, fix_action string, decimals bigint")


def schema_fix(spark: SparkSession, folder: str) -> DataFrame:
    df = cut(dirty_orders(spark, folder))
    cells = counted.counted_cells(df)
    return _printed(schema_fixes.fix_schema(df, profile.profile_table(df, counted=cells), ENRICHMENTS, counted=cells).df)


# --- consistency -------------------------------------------------------------


def mixed_formats(spark: SparkSession, folder: str) -> DataFrame:
    out = consistency.mixed_formats(dirty_orders(spark, folder))
    entries = F.transform(F.map_entries("distribution"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return out.select("column", rounded(F.col("date_share"), 4).alias("date_share"), "formats", _joined(F.array_sort(entries)).alias("distribution"))


def case_variants(spark: SparkSession, folder: str) -> DataFrame:
    return consistency.case_variants(dirty_orders(spark, folder)).withColumn("forms", _joined("forms"))


def case_variants_any(spark: SparkSession, folder: str) -> DataFrame:
    return consistency.case_variant_rows(dirty_orders(spark, folder))


def code_label_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return consistency.code_label_consistency(text_layer(spread(load(spark, folder, "lineitem")), scale=2))


def code_label_by_name(spark: SparkSession, folder: str) -> DataFrame:
    df = dirty_orders(spark, folder)
    return consistency.code_label_consistency(df, pairs=consistency.paired_by_name(df.columns))


def negative_values(spark: SparkSession, folder: str) -> DataFrame:
    return consistency.negative_values(dirty_orders(spark, folder)).withColumn("examples", _money_list("examples"))


def negative_balances(spark: SparkSession, folder: str) -> DataFrame:
    customer = consistency.negative_values(text_layer(load(spark, folder, "customer"), scale=2))
    both = customer.unionByName(consistency.negative_values(text_layer(load(spark, folder, "supplier"), scale=2)))
    return both.withColumn("examples", _money_list("examples"))


def negative_native(spark: SparkSession, folder: str) -> DataFrame:
    """Numeric-typed columns only: the account number as text is left alone however negative it reads."""
    account = F.col("c_acctbal")
    df = load(spark, folder, "customer").withColumn("balance_text", account.cast("decimal(18,2)").cast("string"))
    return consistency.negative_values(df, native_only=True).withColumn("examples", _money_list("examples"))


def date_contamination(spark: SparkSession, folder: str) -> DataFrame:
    return schema.date_contamination(cut(dirty_orders(spark, folder))).withColumn("examples", _joined("examples"))


def period_mismatches(spark: SparkSession, folder: str) -> DataFrame:
    return consistency.period_mismatches(dirty_orders(spark, folder)).withColumn("examples", _joined("examples"))


def duplicate_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose whole text repeats another's."""
    return duplicates.exact_duplicates(load(spark, folder, "documents").select("text"))


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return duplicates.near_duplicates(dirty_orders(spark, folder))


def near_duplicate_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items that share their order and line number with another row."""
    df = load(spark, folder, "lineitem")
    return duplicates.near_duplicate_rows(df, ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


def differing_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Keys by name; rows that share them and differ elsewhere."""
    df = load(spark, folder, "lineitem")
    return duplicates.differing_duplicates(df, keys=["l_orderkey", "l_linenumber"])


def named_key_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return duplicates.differing_duplicates(dirty_orders(spark, folder).drop("_id"))


def dedup(spark: SparkSession, folder: str) -> DataFrame:
    return duplicates.drop_duplicate_rows(dirty_orders(spark, folder))


def normalize_dates(spark: SparkSession, folder: str) -> DataFrame:
    df = dirty_orders(spark, folder).select("_id", "aggregation-time")
    return consistency_fixes.normalize_dates(df, ["aggregation-time"])


def fragmented_dates_fix(spark: SparkSession, folder: str) -> DataFrame:
    return consistency_fixes.normalize_fragmented_dates(dirty_orders(spark, folder))


def normalize_periods(spark: SparkSession, folder: str) -> DataFrame:
    return consistency_fixes.normalize_periods(dirty_orders(spark, folder).select("_id", "rata"), ["rata"])


def canonical_case(spark: SparkSession, folder: str) -> DataFrame:
    df = dirty_orders(spark, folder).select("_id", "priorita", "stato")
    return consistency_fixes.canonical_case(df, ["priorita", "stato"])


def lower_variants(spark: SparkSession, folder: str) -> DataFrame:
    return consistency_fixes.lower_variants(dirty_orders(spark, folder))


def consistency_fix(spark: SparkSession, folder: str) -> DataFrame:
    df = cut(dirty_orders(spark, folder))
    cells = counted.counted_cells(df)
    return consistency_fixes.fix_consistency(df, profile.profile_table(df, counted=cells), counted=cells).df


# --- anomaly -----------------------------------------------------------------


def outliers_events(spark: SparkSession, folder: str) -> DataFrame:
    return anomaly.numeric_outliers(spread(load(spark, folder, "events")))


def outliers_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """Alternate check over native numbers: population deviation, only columns with fence outliers."""
    df = spread(load(spark, folder, "lineitem")).withColumn("price_per_unit_squared", F.pow(F.col("l_extendedprice") / F.col("l_quantity"), 2))
    return anomaly.numeric_outliers(df, native_only=True, population_std=True, by_iqr_only=True)


def _money_list(c: str) -> Column:
    return _joined(F.transform(c, lambda x: x.cast("decimal(18,2)").cast("string")))


def largest_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return anomaly.largest_outliers(dirty_orders(spark, folder)).withColumn("examples", _money_list("examples"))


def largest_deviations(spark: SparkSession, folder: str) -> DataFrame:
    """The five largest values more than three deviations from the mean."""
    found = anomaly.largest_outliers(dirty_orders(spark, folder), by_deviation=True)
    return found.withColumn("examples", _money_list("examples"))


def outlier_flags(spark: SparkSession, folder: str) -> DataFrame:
    df = load(spark, folder, "events").select("event_id", "value")
    return anomaly.outlier_flags(df, ["value"])


def clear_placeholder_words(spark: SparkSession, folder: str) -> DataFrame:
    return anomaly.clear_placeholder_words(dirty_orders(spark, folder))


# --- remediation, scores -----------------------------------------------------


def median_impute(spark: SparkSession, folder: str) -> DataFrame:
    df = schema_fixes.strip_currency(dirty_orders(spark, folder), ["spesa", "quota"])
    return _printed(completeness_fixes.impute_median(df).df)


def cap_p99(spark: SparkSession, folder: str) -> DataFrame:
    df = load(spark, folder, "events").select("event_id", "value")
    return _rounded(remediation.cap_at_percentile(df, ["value"]), "value")


def group_rare(spark: SparkSession, folder: str) -> DataFrame:
    return remediation.group_rare(dirty_orders(spark, folder))


def trim_text(spark: SparkSession, folder: str) -> DataFrame:
    return remediation.trim_text(dirty_orders(spark, folder))


def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    df = cut(dirty_orders(spark, folder))
    return cut(scoring.quality_metrics(findings.all_findings(df), len(df.columns)))


def reliability_score(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(scoring.reliability_score(_metrics(spark, folder)), "avg_missing_pct", "outlier_penalty")


def documented_score(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.documented_score(_metrics(spark, folder)).select("type_issues", "completeness_pct", "format_issues", "score", "grade")


def null_rate_score(spark: SparkSession, folder: str) -> DataFrame:
    df = dirty_orders(spark, folder)
    return scoring.null_rate_score(completeness.missing_counts(df, placeholders=False), df.columns)


def suggestions(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.suggestions(_metrics(spark, folder))


def roadmap(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.roadmap(_metrics(spark, folder))


def expected_score(spark: SparkSession, folder: str) -> DataFrame:
    metrics = _metrics(spark, folder)
    score = scoring.reliability_score(metrics).first()["score"]
    return scoring.expected_score(score, scoring.roadmap(metrics))


def apply_suggestions(spark: SparkSession, folder: str) -> DataFrame:
    return _remediated(cut(dirty_orders(spark, folder))).df


def _remediated(df: DataFrame) -> changes.Fixed:
    cells = counted.counted_cells(df)
    proposed = scoring.suggestions(scoring.quality_metrics(findings.all_findings(df, counted=cells), len(df.columns)))
    return remediation.apply_suggestions(df, proposed, counted=cells)[0]


def _completeness_log(spark: SparkSession, folder: str, inclusive: bool) -> DataFrame:
    df = dirty_orders(spark, folder)
    return changes.change_log(df, completeness_fixes.fix_completeness(df, inclusive=inclusive).log)


def completeness_log(spark: SparkSession, folder: str) -> DataFrame:
    """Steps of the completeness fix, the nulls it keeps among them."""
    return _completeness_log(spark, folder, inclusive=False)


def completeness_log_inclusive(spark: SparkSession, folder: str) -> DataFrame:
    """Alternate fix: columns from 95 % missing on are dropped."""
    return _completeness_log(spark, folder, inclusive=True)


def remediation_log(spark: SparkSession, folder: str) -> DataFrame:
    """Steps of the remediation, kept nulls among them."""
    df = cut(dirty_orders(spark, folder))
    return changes.change_log(df, _remediated(df).log)


def changes_by_stage(spark: SparkSession, folder: str) -> DataFrame:
    return changes.changes_per_stage(completeness_log(spark, folder).unionByName(remediation_log(spark, folder)))


def same_names(spark: SparkSession, folder: str) -> DataFrame:
    """The dirty orders with two columns added whose reduced names are taken, and without such columns."""
    df = dirty_orders(spark, folder)
    df = df.withColumns({"Sta-to": ref("priorita"), "QUOTA %": ref("spesa")})
    return df.drop(*[ref(c) for c in schema_fixes.same_name_columns(df.columns)])


def valid_enrichments(spark: SparkSession, folder: str) -> DataFrame:
    """One proposed action per customer segment and nation; those outside the vocabulary are discarded."""
    actions = F.array(*[F.lit(a) for a in ("round_Ndp", "none", "coerce_int", "drop", "coerce_year")])
    rows = load(spark, folder, "customer").groupBy("c_nationkey").agg(F.max("c_custkey").alias("k"))
    rows = rows.select(F.col("c_nationkey").cast("string").alias("column"), F.get(actions, (F.col("k") % 5).cast("int")).alias("fix_action"))
    found = schema_fixes.valid_enrichments(rows)
    return spark.createDataFrame([(c, e["fix_action"]) for c, e in found.items()], "`column` string, fix_action string")


def negative_values_ten(spark: SparkSession, folder: str) -> DataFrame:
    """Documented variant: at least ten numbers."""
    found = consistency.negative_values(dirty_orders(spark, folder), Thresholds(negative_min_values=10))
    return found.withColumn("examples", _money_list("examples"))


def finding_texts(spark: SparkSession, folder: str) -> DataFrame:
    """A findings text per customer, put together from the figures of the customer's orders."""
    rows = load(spark, folder, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("o_orderstatus") == "F").cast("long")).alias("f")
    )
    n, f = F.col("n").cast("string"), F.col("f").cast("string")
    lines = [
        F.lit("[Schema Team] Naming: uppercase names"),
        F.concat(F.lit("Removed "), n, F.lit(" exact duplicate rows")),
        F.concat(f, F.lit(" IQR outliers and "), n, F.lit(".5% missing")),
        F.concat(F.lit("  Fixes applied: "), n),
        F.concat(F.lit("Overall score: "), (F.col("n") + 60).cast("string"), F.lit(".5 / 100, grade "), F.when(F.col("n") > 10, "B+").otherwise("c")),
        F.when(F.col("f") > 3, "year is inconsistent with period").otherwise("periods agree"),
    ]
    return rows.select("o_custkey", F.concat_ws("\n", *lines).alias("text"))


def text_figures(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(text_metrics.text_figures(finding_texts(spark, folder), "text"), "missing_pct").drop("text")


def stated_scores(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    return finding_texts(spark, folder).select(
        "o_custkey",
        text_metrics.stated_score(text).alias("score"),
        text_metrics.stated_grade(text).alias("grade"),
        text_metrics.without_lines(text).alias("kept"),
    )


def document_numbers(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers followed by a word, and words of interest, over the whole text of every document."""
    text = F.col("text")
    return spread(load(spark, folder, "documents")).select(
        "doc_id",
        text_metrics.captured_sum(text, [r"(\d{1,6})\s+[a-z]"]).alias("numbers"),
        text_metrics.hits(text, "date|rare|type").alias("hits"),
        F.length(text_metrics.without_lines(text, ["licensed"])).alias("kept_chars"),
    )


# --- pipeline ----------------------------------------------------------------


def _run(spark: SparkSession, folder: str) -> pipeline.Report:
    return pipeline.run(cut(dirty_orders(spark, folder)), enrichments=ENRICHMENTS)


def pipeline_table(spark: SparkSession, folder: str) -> DataFrame:
    return _printed(_run(spark, folder).df)


def pipeline_changes(spark: SparkSession, folder: str) -> DataFrame:
    return changes.changes_per_stage(_run(spark, folder).changes)


def pipeline_log(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder).log


def _copied_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers, every fifth twice: so many duplicates that the completeness stage runs again."""
    df = load(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment", F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal")).alias("c_acctbal"))
    return df.unionByName(df.where("c_custkey % 5 = 0"))


def nested_columns(spark: SparkSession, folder: str) -> DataFrame:
    """The pipeline over customers with an array, a map and a struct. Every fifth customer comes twice, the entries of its
    map in another order, which is the same row; every seventh twice with another array, which is not."""
    df = load(spark, folder, "customer")
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    entries = F.array(
        F.struct(F.lit("segment").alias("k"), F.col("c_mktsegment").alias("v")),
        F.struct(F.lit("nation").alias("k"), nation.cast("string").alias("v")),
    )

    def rows(part: DataFrame, facts: Column, codes: Column) -> DataFrame:
        return part.select(
            "c_custkey", "c_name", codes.alias("Codes"), F.map_from_entries(facts).alias("facts"),
            F.struct(F.col("c_mktsegment").alias("segment"), nation.alias("nation")).alias("place"),
        )

    codes = F.array(nation, key % 3)
    several = [
        rows(df, entries, codes),
        rows(df.where(key % 5 == 0), F.reverse(entries), codes),
        rows(df.where(key % 7 == 0), entries, F.array(nation, key % 3, F.lit(-1))),
    ]
    out = pipeline.run(several[0].unionByName(several[1]).unionByName(several[2])).df
    facts = F.array_sort(F.transform(F.map_entries("facts"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return out.select(
        F.col("c_custkey").cast("long").alias("c_custkey"), "c_name",
        _joined(F.transform("codes", lambda x: x.cast("string"))).alias("codes"), _joined(facts).alias("facts"),
        F.col("place.segment").alias("segment"), F.col("place.nation").cast("long").alias("nation"),
    )


def repeated_stage_log(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.run(_copied_customers(spark, folder)).log.select("step", "stage", "reason", "rows_removed")


def repeated_stage_findings(spark: SparkSession, folder: str) -> DataFrame:
    """Completeness findings of the second check, which sees the table without its duplicates."""
    rows = pipeline.run(_copied_customers(spark, folder)).findings.where("`check` = 'missing'")
    return rows.select("column", "metric", "value")


def before_after(spark: SparkSession, folder: str) -> DataFrame:
    report = _run(spark, folder)
    score = report.score.first()
    return scoring.before_after(dirty_orders(spark, folder), report.df, score["score"], score["grade"])


def _over_dirty(check: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: check(dirty_orders(spark, folder))


QUERIES: dict[str, Query] = {
    "csv_scan": csv_scan,
    "csv_inferred": csv_inferred,
    "csv_quoted_breaks": csv_quoted_breaks,
    "csv_malformed": csv_malformed,
    "findings_json": findings_json,
    "stage_versions": stage_versions,
    "profile_dirty": profile_dirty,
    "profile_lineitem": profile_lineitem,
    "profile_events": profile_events,
    "profile_summary": profile_summary,
    "stage_gates": stage_gates,
    "missing_by_column": _over_dirty(completeness.missing_by_column),
    "missing_split": _over_dirty(completeness.missing_split),
    "rows_with_missing": _over_dirty(completeness.rows_with_missing),
    "completeness_rate": _over_dirty(completeness.completeness_by_column),
    "completeness_overall": _over_dirty(completeness.completeness_overall),
    "missing_severity": _over_dirty(completeness.missing_severity),
    "sparse_columns": _over_dirty(completeness.sparse_columns),
    "co_missing": _over_dirty(completeness.co_missing),
    "placeholder_null": _over_dirty(completeness_fixes.clear_placeholders),
    "completeness_fix": completeness_fix,
    "missing_indicators": missing_indicators,
    "fill_unknown": fill_unknown,
    "fill_mode": fill_mode,
    "type_contamination": type_contamination,
    "date_contamination": date_contamination,
    "stripped_contamination": _over_dirty(schema.stripped_contamination),
    "naming_violations": _over_dirty(schema.naming_violations),
    "snake_case_violations": _over_dirty(lambda df: schema.naming_violations(df, snake_case=True)),
    "duplicate_columns": _over_dirty(schema.duplicate_columns),
    "domain_overlap": domain_overlap,
    "redundant_pairs": _over_dirty(schema.redundant_pairs),
    "strip_currency": strip_currency,
    "coerce_years": coerce_years,
    "round_decimals": round_decimals,
    "coerce_integers": coerce_integers,
    "mostly_numeric": mostly_numeric,
    "overlapping_columns": overlapping_columns,
    "redundant_columns": redundant_columns,
    "snake_case_names": snake_case_names,
    "enrichment_proposals": enrichment_proposals,
    "schema_fix": schema_fix,
    "format_distribution": _over_dirty(consistency.format_distribution),
    "mixed_formats": mixed_formats,
    "fragmented_dates": _over_dirty(consistency.fragmented_dates),
    "period_outliers": _over_dirty(consistency.period_outliers),
    "date_outliers": _over_dirty(consistency.date_outliers),
    "mixed_case_style": _over_dirty(consistency.mixed_case_style),
    "whitespace_variants": _over_dirty(consistency.whitespace_variants),
    "case_variants": case_variants,
    "case_variants_any": case_variants_any,
    "code_label": _over_dirty(consistency.code_label_consistency),
    "code_label_lineitem": code_label_lineitem,
    "code_label_by_name": code_label_by_name,
    "period_mismatches": period_mismatches,
    "negative_values": negative_values,
    "negative_balances": negative_balances,
    "negative_native": negative_native,
    "exact_duplicates": _over_dirty(duplicates.exact_duplicates),
    "duplicate_texts": duplicate_texts,
    "near_duplicates": near_duplicates,
    "near_duplicate_rows": near_duplicate_rows,
    "differing_duplicates": differing_duplicates,
    "named_key_duplicates": named_key_duplicates,
    "dedup": dedup,
    "normalize_dates": normalize_dates,
    "fragmented_dates_fix": fragmented_dates_fix,
    "normalize_periods": normalize_periods,
    "canonical_case": canonical_case,
    "lower_variants": lower_variants,
    "consistency_fix": consistency_fix,
    "outliers_dirty": _over_dirty(anomaly.numeric_outliers),
    "outliers_events": outliers_events,
    "outliers_lineitem": outliers_lineitem,
    "largest_outliers": largest_outliers,
    "largest_deviations": largest_deviations,
    "outlier_flags": outlier_flags,
    "rare_categories": _over_dirty(anomaly.rare_categories),
    "rare_values": _over_dirty(anomaly.rare_values),
    "invalid_markers": _over_dirty(anomaly.invalid_markers),
    "placeholder_words": _over_dirty(anomaly.placeholder_words),
    "clear_placeholder_words": clear_placeholder_words,
    "dominant_category": _over_dirty(anomaly.dominant_category),
    "frequent_values": _over_dirty(anomaly.frequent_values),
    "anomaly_rates": _over_dirty(anomaly.anomaly_rates),
    "median_impute": median_impute,
    "cap_p99": cap_p99,
    "group_rare": group_rare,
    "trim_text": trim_text,
    "reliability_score": reliability_score,
    "documented_score": documented_score,
    "null_rate_score": null_rate_score,
    "suggestions": suggestions,
    "roadmap": roadmap,
    "expected_score": expected_score,
    "apply_suggestions": apply_suggestions,
    "text_figures": text_figures,
    "stated_scores": stated_scores,
    "document_numbers": document_numbers,
    "pipeline_table": pipeline_table,
    "pipeline_changes": pipeline_changes,
    "completeness_log": completeness_log,
    "completeness_log_inclusive": completeness_log_inclusive,
    "remediation_log": remediation_log,
    "changes_by_stage": changes_by_stage,
    "same_names": same_names,
    "valid_enrichments": valid_enrichments,
    "negative_values_ten": negative_values_ten,
    "pipeline_log": pipeline_log,
    "before_after": before_after,
    "nested_columns": nested_columns,
    "repeated_stage_log": repeated_stage_log,
    "repeated_stage_findings": repeated_stage_findings,
}
