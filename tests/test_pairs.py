"""Redundant pairs of columns: one pass whatever the width, same rows as pair by pair."""

import random
from itertools import combinations

import pytest

from plumbline.operators import schema


def plain(columns, min_rows=10, overlap=0.85):
    out = []
    for (a, x), (b, y) in combinations(columns.items(), 2):
        filled = [(u.strip().lower(), v.strip().lower()) for u, v in zip(x, y) if u is not None and v is not None]
        same = sum(u == v for u, v in filled)
        if len(filled) > min_rows and same / len(filled) > overlap:
            out.append((a, b, len(filled), round(same / len(filled) * 100, 1)))
    return sorted(out)


def noisy(rng, values, wrong, gone):
    return [None if rng.random() < gone else "other" if rng.random() < wrong else rng.choice([v, v.upper(), f" {v}"]) if v is not None else None for v in values]


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_against_plain_python(table, seed):
    rng = random.Random(seed)
    base = [[rng.choice("abcdef") + str(rng.randrange(k)) for _ in range(120)] for k in (1, 3, 30)]
    columns = {f"b{i}": b for i, b in enumerate(base)}
    for i, b in enumerate(base):
        for k in range(3):
            columns[f"n{i}{k}"] = noisy(rng, b, [0.0, 0.1, 0.2][k], [0.0, 0.3, 0.9][k])
    columns |= {"empty": [None] * 120, "flag": ["y"] * 120, "flag2": ["Y "] * 119 + [None], "blank": [""] * 120}
    df = table(**columns)
    got = sorted(tuple(r) for r in schema.redundant_pairs(df).collect())
    assert got == plain(columns) and got
    assert schema.redundant_pairs(df.limit(0)).collect() == [] and schema.redundant_pairs(df.select("flag")).collect() == []


def test_three_hundred_columns_take_a_bounded_number_of_jobs(spark, table):
    rng = random.Random(3)
    columns = {f"c{i}": [str(rng.randrange(2, 50)) for _ in range(40)] for i in range(290)}
    columns |= {f"d{i}": list(columns[f"c{i}"]) for i in range(10)}
    df = table(**columns)
    tracker, group = spark.sparkContext.statusTracker(), "pairs-of-300"
    spark.sparkContext.setJobGroup(group, group)
    try:
        got = sorted(tuple(r)[:2] for r in schema.redundant_pairs(df).collect())
        assert len(tracker.getJobIdsForGroup(group)) <= 20
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == [r[:2] for r in plain(columns)]
