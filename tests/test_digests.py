"""Counts of large columns by digests: same results as by text, and no text in the exchange."""

import random
from dataclasses import replace

import pytest

from plumbline.config import DEFAULTS
from plumbline.operators import anomaly, consistency, digests, duplicates, profile
from plumbline.plans.dirty_orders import dirty_orders
from plumbline.sources.tables import load, text_layer

ALL_LARGE = replace(DEFAULTS, text_values=-1)


def test_profile_is_the_same_by_text_and_by_digests(spark, data):
    for df in (dirty_orders(spark, data), text_layer(load(spark, data, "lineitem").limit(700), scale=2)):
        by_text = sorted(map(str, profile.profile_columns(df).collect()))
        assert sorted(map(str, profile.profile_columns(df, ALL_LARGE).collect())) == by_text


def test_profile_of_odd_columns(table):
    df = table(a=[None] * 4, b=["x", "x", None, ""], c=["1", "2", "3", "4"])
    assert sorted(map(str, profile.profile_columns(df).collect())) == sorted(map(str, profile.profile_columns(df, ALL_LARGE).collect()))
    assert profile.profile_columns(df.limit(0), ALL_LARGE).collect() == []


@pytest.mark.parametrize("sample", [1, 4, 1000])
def test_commonest_values_with_many_ties(spark, table, sample):
    rng = random.Random(sample)
    columns = {
        "unique": [f"v{rng.getrandbits(40):x}" for _ in range(400)],
        "pairs": [f"p{i // 2}" for i in range(400)],
        "few_above": ["top"] * 40 + ["next"] * 30 + [f"z{i}" for i in range(330)],
        "nulls": [None] * 399 + ["only"],
        "rare_first": [f"a{i}" for i in range(200)] + [f"b{i // 2}" for i in range(200)],
    }
    df = table(**columns)
    names = list(columns)
    counts = digests.digest_counts(df, names).cache()
    got = {r["column"]: r["examples"] for r in digests.common_first(digests.commonest(df, counts, names, 5, sample), 5).collect()}
    for name, values in columns.items():
        filled = [v for v in values if v is not None]
        assert got[name] == sorted(set(filled), key=lambda v: (-filled.count(v), v))[:5], name


def test_digest_exchange_has_fixed_width(spark, data):
    df = load(spark, data, "orders")
    counts = digests.digest_counts(df, df.columns)
    assert {t for _, t in counts.dtypes} <= {"int", "bigint"}
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count(1)" in plan and "value" not in plan.split("Exchange")[0]


def test_rare_and_frequent_values_are_the_same_by_digests(spark, data):
    orders = text_layer(load(spark, data, "orders"), scale=2)
    for check in (anomaly.rare_values, anomaly.frequent_values):
        assert sorted(map(str, check(orders, ALL_LARGE).collect())) == sorted(map(str, check(orders).collect()))


def test_spellings_and_keys_against_plain_python(table):
    rng = random.Random(9)
    a = [rng.choice(["Roma", "ROMA", " roma", "Milano", "milano", "Bari", None]) for _ in range(300)]
    df = table(a=a, b=[f"k{i // 2}" for i in range(300)], c=["x" * 40 + str(i // 3) for i in range(300)], d=["same"] * 300, e=[None] * 300)
    groups = {}
    for v in a:
        if v is not None:
            groups.setdefault(v.strip().lower(), []).append(v)
    want = {("a", k, v, vs.count(v)) for k, vs in groups.items() if len(set(vs)) > 1 for v in vs}
    assert {tuple(r) for r in consistency.case_variant_rows(df).collect()} == want
    assert duplicates.key_candidates(df) == ["b"]  # c is long, d and e are constant
    assert duplicates.named_keys(table(x=["1", "2", "3", "3"], y=["1", "1", "1", "2"], z=["1", "2", "2", "1"])) == ["x"]
    row = duplicates.near_duplicates(table(p=["1", None, None, "1"], q=[None, "1", "1", None]), ["p", "q"]).first()
    assert tuple(row) == ("p,q", 2, 4)  # nulls count where they stand
    assert tuple(duplicates.near_duplicates(table(p=["1", None], q=[None, "1"]), ["p", "q"]).first()) == ("p,q", 0, 0)


def test_no_text_travels_for_keys(spark, data):
    df = load(spark, data, "orders")
    plan = duplicates.near_duplicates(df, ["o_orderstatus", "o_clerk"] if "o_clerk" in df.columns else [df.columns[0], df.columns[2]])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k1#" in plan and plan.count("hashpartitioning") == 1
