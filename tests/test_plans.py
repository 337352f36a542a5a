"""The compiled path, and what plans must not hold."""

import pytest

from plumbline.plans.queries import QUERIES

NAMES = ("missing_by_column", "code_label", "exact_duplicates", "normalize_dates", "outliers_dirty", "differing_duplicates", "case_variants_any")


@pytest.mark.parametrize("name", NAMES)
def test_compiled_and_interpreted_agree(spark, data, name):
    interpreted = sorted(map(str, QUERIES[name](spark, data).collect()))
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    spark.conf.set("spark.sql.codegen.factoryMode", "FALLBACK")
    try:
        assert sorted(map(str, QUERIES[name](spark, data).collect())) == interpreted
    finally:
        spark.conf.set("spark.sql.codegen.wholeStage", "false")
        spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")


@pytest.mark.parametrize("name", NAMES)
def test_plans_have_no_python_and_no_cross_joins(spark, data, name):
    plan = QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
