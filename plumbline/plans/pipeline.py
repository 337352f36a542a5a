"""Profile, check, fix and score a table, stage by stage."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import DEFAULTS, Thresholds
from plumbline.operators import findings as found
from plumbline.operators.cells import columns_of, small_frame
from plumbline.operators.changes import Fixed, change_log
from plumbline.operators.counted import counted_cells
from plumbline.operators.completeness_fixes import fix_completeness
from plumbline.operators.consistency_fixes import fix_consistency
from plumbline.operators.profile import TableProfile, profile_columns, profile_summary, take_profile
from plumbline.operators.remediation import apply_suggestions
from plumbline.operators.schema_fixes import fix_schema, propose_enrichments
from plumbline.operators.scan import scan
from plumbline.operators.scoring import quality_metrics, reliability_score, roadmap, suggestions
from plumbline.session import cut
from plumbline.sources.sinks import write_findings, write_stage
from plumbline.sources.tables import text_layer

STAGES = ("schema", "completeness", "consistency", "anomaly", "remediation")
_VERSIONS = {"schema": 1, "completeness": 2, "consistency": 3, "remediation": 4}
_CHECKS = {
    "schema": found.schema_findings,
    "completeness": found.completeness_findings,
    "consistency": found.consistency_findings,
    "anomaly": found.anomaly_findings,
}
MAX_REPEATS = 2


def stage_gates(summary: DataFrame, nested_columns: int = 0) -> DataFrame:
    """One row: which optional stages a profile summary calls for.

    A table complete to 95 % or more needs no completeness stage; consistency needs three columns and ten rows;
    anomaly needs a numeric or categorical column. Nested columns, which no profile holds, count among the three.
    """
    return summary.select(
        (F.col("overall_completeness") < 0.95).alias("completeness"),
        ((F.col("total_columns") + nested_columns >= 3) & (F.col("total_rows") >= 10)).alias("consistency"),
        ((F.size("numeric_columns") > 0) | (F.size("categorical_columns") > 0)).alias("anomaly"),
    )


def repeat_stage(last: str, fixed: Fixed | None, total_rows: Column | int, repeats: int) -> str | None:
    """Stage to run next because of what the last one changed; at most two repeats."""
    if fixed is None or repeats >= MAX_REPEATS:
        return None
    if last == "consistency" and fixed.rows_removed > 0.1 * max(total_rows, 1):
        return "completeness"
    if last == "schema" and fixed.types_changed > 5:
        return "consistency"
    return None


def _metrics(stage_findings: list[DataFrame], raw: DataFrame) -> DataFrame:
    return quality_metrics(reduce(DataFrame.unionByName, stage_findings), len(raw.columns))


@dataclass
class Report:
    df: DataFrame
    profile: TableProfile
    findings: DataFrame
    changes: DataFrame
    log: DataFrame
    score: DataFrame
    suggestions: DataFrame
    roadmap: DataFrame
    stages: dict[str, DataFrame] = field(default_factory=dict)


def run(
    df: DataFrame,
    t: Thresholds = DEFAULTS,
    enrichments: Mapping[str, Mapping[str, Any]] | None = None,
    folder: str | None = None,
    fmt: str = "parquet",
) -> Report:
    """Run every stage the profile calls for; each checks the table as the stages before it left it. A stage that is
    repeated because of what another changed checks the table anew, and these findings take the place of its first.

    Each stage's table is written below ``folder`` (or checkpointed), so later stages read it instead of repeating
    the earlier ones and a lost executor costs one stage at most. Without ``enrichments`` they are derived from the
    values. Arrays, maps, structs, variants and binary columns go through unread: their names are checked and
    mended, and they count when rows are compared.
    """
    raw = text_layer(df, nested=True)
    columns = columns_of(raw, None)
    seen = scan(raw, ("about_distinct",), columns)
    # Cells of the current table, counted once for the profile, the checks and the fixes that find it unchanged.
    counted = counted_cells(raw, columns, t, seen)
    profile_rows = cut(profile_columns(raw, t, columns, counted=counted, seen=seen))
    profile = take_profile(profile_rows, columns_of(raw, None))
    summary = profile_summary(profile_rows, t)
    gates = stage_gates(summary, len(raw.columns) - len(columns_of(raw, None))).first().asDict()
    numeric = profile.typed("numeric")
    if enrichments is None:
        enrichments = propose_enrichments(raw, numeric, counted=counted)

    current, outputs, log = raw, {}, []
    # The findings of a stage are those of its last check: a stage that runs again checks again.
    stage_findings: dict[str, DataFrame] = {}
    changes: list[tuple[str, str, str, int]] = []
    done: list[str] = []
    runs: dict[str, int] = {}
    repeats, last, fixed = 0, "", None
    while True:
        stage = repeat_stage(last, fixed, profile.row_count, repeats)
        reason = "rows or types changed"
        if stage is not None:
            repeats += 1
        else:
            stage = next((s for s in STAGES if s not in done and (s not in gates or gates[s])), None)
            reason = "profile"
        if stage is None:
            break
        if counted is None:
            counted = counted_cells(current, t=t)
        if stage in _CHECKS:
            stage_findings[stage] = _CHECKS[stage](current, t, counted)
        if stage == "schema":
            fixed = fix_schema(current, profile, enrichments, t, counted=counted)
        elif stage == "completeness":
            fixed = fix_completeness(current, t, counted=counted)
        elif stage == "consistency":
            fixed = fix_consistency(current, profile, t, counted)
        elif stage == "remediation":
            metrics = _metrics(list(stage_findings.values()), raw)
            fixed, _ = apply_suggestions(current, suggestions(metrics), t, counted)
        else:
            fixed = None
        if fixed is not None:
            iteration = runs.get(stage, 0)
            version = _VERSIONS[stage]
            if folder:
                current = write_stage(fixed.df, folder, version, iteration, fmt)
            else:
                current = fixed.df if fixed.stored else cut(fixed.df)
            counted = None
            outputs[f"v{version}" + (f"_iter{iteration}" if iteration else "")] = current
            changes += fixed.log
        runs[stage] = runs.get(stage, 0) + 1
        if stage not in done:
            done.append(stage)
        log.append(
            (len(log) + 1, stage, reason, fixed.rows_removed if fixed else 0, fixed.types_changed if fixed else 0)
        )
        last = stage

    metrics = _metrics(list(stage_findings.values()), raw)
    long = reduce(DataFrame.unionByName, stage_findings.values())
    if folder:
        write_findings(long, f"{folder}/findings")
    return Report(
        df=current,
        profile=profile,
        findings=long,
        changes=change_log(raw, changes),
        log=small_frame(
            raw, log, "step bigint, stage string, reason string, rows_removed bigint, types_changed bigint"
        ),
        score=reliability_score(metrics),
        suggestions=suggestions(metrics),
        roadmap=roadmap(metrics),
        stages=outputs,
    )
