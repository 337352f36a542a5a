import hashlib
import random
import re

import pytest

from plumbline.llm import exact_dedup


def plain(rows):
    """(doc_id, keep_id, group_size, kept, sha) of every row, by grouping in memory."""
    groups = {}
    for doc, text in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", text or ""), []).append(doc)
    out = []
    for body, docs in groups.items():
        docs.sort(key=lambda d: (d is None, d or 0))
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(d, docs[0], len(docs), i == 0, sha) for i, d in enumerate(docs)]
    return sorted(out, key=repr)


ROWS = [
    *[(i, t) for i, t in enumerate([None, "", " ", "\t\n", "a b", "a\r\n\x0bb", " a b", "a b ", "a\x1cb", "a b", "A b", "é", "é"])],
    *[(100 + i, f"text {i % 40}") for i in range(300)],
    *[(1000 + i, "hot text " * 3000) for i in range(150)],
    (None, "text 3"), (None, "only here"), (None, "only here"), (7, "again"), (7, "again"), (7, "other"), (-4, "again"),
]


@pytest.mark.parametrize("bits, most, capacity", [(64, 1_000_000, 1024), (3, 1_000_000, 4), (3, 0, 1), (64, 0, 2), (1, 1_000_000, 1024)])
def test_against_grouping_in_memory(spark, bits, most, capacity):
    """Narrow keys put different texts under one key, and buckets that no bit can split; results stay the same."""
    rows = ROWS[:]
    random.Random(bits).shuffle(rows)
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id bigint, text string, key string, n int")
    got = exact_dedup.duplicates(docs, capacity=capacity, bits=bits, most=most)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)


def test_empty_table_and_columns_kept(spark):
    docs = spark.createDataFrame([(d, t, "x", 1, i) for i, (d, t) in enumerate(ROWS)], "doc_id bigint, text string, _sha string, kept int, at int")
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, re.sub("[\x20\x09-\x0d]+", " ", r.text or "")) for r in kept.collect()]
    assert len(rows) == len(set(b for _, b in rows)) == sum(r[3] for r in plain(ROWS))
    assert sorted((d for d, _ in rows), key=str) == sorted((r[0] for r in plain(ROWS) if r[3]), key=str)
    assert exact_dedup.duplicates(docs.limit(0)).collect() == [] and exact_dedup.deduplicated(docs.limit(0)).collect() == []


@pytest.mark.parametrize("capacity", [1, 3, 16, 1000])
def test_directory_splits_overfull_buckets_only(spark, capacity):
    rng = random.Random(capacity)
    # Half of the keys stand close together, so buckets end at different depths.
    keys = {rng.getrandbits(64) - (1 << 63) for _ in range(120)} | {(5 << 58) + rng.getrandbits(54) for _ in range(120)}
    frame = spark.createDataFrame([(k,) for k in keys], "key bigint")
    cells, bits = exact_dedup.directory(frame, capacity)
    at = {r.cell: r.bucket for r in cells.collect()}
    held = {}
    for k in keys:
        bucket = at[(k % (1 << 64)) >> (64 - bits)]
        depth = bucket.bit_length() - 1
        assert bucket == (1 << depth) + ((k % (1 << 64)) >> (64 - depth))
        held.setdefault(bucket, []).append(k)
    assert all(len(v) <= capacity or b.bit_length() - 1 == bits for b, v in held.items())
    if capacity < 100:
        assert len({b.bit_length() for b in held}) > 1
    for b in held:  # no bucket lies inside another
        assert not any(b >> s in held for s in range(1, b.bit_length()))
