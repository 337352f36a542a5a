import random

import numpy as np
import pytest
import xxhash

from plumbline.llm import simhash
from plumbline.llm.components import components


def plain_fingerprint(text, words=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    parts = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in lowered).split(" ") if w]
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fingerprints, radius=3):
    fp = np.array(fingerprints, np.uint64)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= radius
    label = np.arange(len(fp))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice(["ein", "zwei", "drei", "Vier", "fünf", "six", "x\x1cy"]) for _ in range(120)) for _ in range(12)]
    texts = [None, "", " \t\n", "One", "one", "two words", "A B C", "a\tb\nc", "İstanbul K sign", *base]
    for t in base:
        words = t.split(" ")
        for _ in range(6):
            words = list(words)
            words[rng.randrange(120)] = "other"
            texts.append(" ".join(words))
    rows = [(2 * i + 1, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, component_id string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    expected = [plain_fingerprint(t) for t in texts]
    labels = plain_components(expected)
    assert got == {2 * i + 1: (f"{f:016x}", 2 * int(k) + 1) for i, (f, k) in enumerate(zip(expected, labels))}
    assert len(set(labels)) < len(texts)
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({2 * int(k) + 1 for k in labels})


def test_null_ids_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "same text here"), (5, "same text here"), (5, "same text here"), (9, "SAME text here")], "doc_id bigint, text string")
    assert sorted((r.doc_id or 0, r.component_id) for r in simhash.near_duplicates(docs).collect()) == [(0, 5), (5, 5), (5, 5), (9, 5)]
    assert sorted((r.doc_id or 0) for r in simhash.deduplicated(docs).collect()) == [0, 5]
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_rows_that_share_an_id_go_by_their_own_text(spark):
    a, b = "alpha beta gamma delta", "one two three four five"
    rows = [(1, a), (5, a), (5, b), (5, b), (6, b), (7, "on its own"), (None, a), (8, None), (8, "")]
    docs = spark.createDataFrame([(*r, "x", i) for i, r in enumerate(rows)], "doc_id bigint, text string, fp string, _own int")
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id or 0), r.text or "") for r in kept.collect()) == [(0, a), (1, a), (5, b), (7, "on its own"), (8, "")]
    assert simhash.deduplicated(docs.limit(0)).collect() == []


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
@pytest.mark.parametrize("tile", [4096, 16])
def test_trees_join_what_brute_force_joins(spark, radius, tile):
    rng = random.Random(radius)
    centres = [rng.getrandbits(64) for _ in range(60)]
    points = set(centres)
    for c in centres[:12]:  # a crowd of almost equal fingerprints, and chains
        for _ in range(25):
            points.add(c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    points = sorted(points)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    fps = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    edges = simhash.links(fps, radius, leaf=4, tile=tile).collect()
    label = {p: p for p in signed}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    unsigned = dict(zip(signed, points))
    for a, b in edges:
        assert (unsigned[a] ^ unsigned[b]).bit_count() <= radius and a != b
        label[root(a)] = root(b)
    expected = plain_components(points, radius)
    groups = {}
    for p, k in zip(signed, expected):
        groups.setdefault(int(k), set()).add(root(p))
    assert all(len(g) == 1 for g in groups.values())
    assert len({root(p) for p in signed}) == len(groups)


def test_two_bit_levels_find_the_same(spark):
    rng = random.Random(1)
    centre = rng.getrandbits(63)
    points = sorted({centre, *(centre ^ (1 << rng.randrange(60)) for _ in range(20))})
    fps = spark.createDataFrame([(p,) for p in points], "fp bigint")
    for width, levels in ((2, 16), (4, 8)):
        at = simhash.visits(fps, width, levels, 1).collect()
        own = {(r.half, r.shard, r.fp) for r in at if r.own}
        seen = {(r.half, r.shard, r.fp) for r in at}
        for a in points:
            for b in points:
                if a != b and (a ^ b).bit_count() <= 3:
                    assert any((h, s, b) in seen for h, s, x in own if x == a) or any((h, s, a) in seen for h, s, x in own if x == b)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 100), (None, 3)] + [(300, 300 + i) for i in range(1, 50)]
    out = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    got = {r.node: r.component for r in out}
    assert len(out) == len(got)
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 100, **{i: 300 for i in range(300, 350)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
