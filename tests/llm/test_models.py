import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import crf_quality, nn_descent


def brute_marginals(score, move, n):
    total, good = 0.0, np.zeros(n)
    for bits in range(1 << n):
        y = [bits >> i & 1 for i in range(n)]
        weight = np.exp(sum((s if b else 0) for s, b in zip(score, y)) + sum(move[a, b] for a, b in zip(y, y[1:])))
        total += weight
        good += weight * np.array(y)
    return good / total


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(0)
    lengths = [1, 5, 3, 7, 1]
    score, move = rng.normal(size=sum(lengths)), rng.normal(size=(2, 2))
    good, _ = crf_quality.Chains(lengths).marginals(score, move)
    at = 0
    for n in lengths:
        assert np.allclose(good[at : at + n], brute_marginals(score[at : at + n], move, n))
        at += n


def test_line_features_do_not_depend_on_blocks(monkeypatch):
    lines = ["", "A a b b b", "SHOUT!! LOUD!!", "x | y | z", "é 12 $$$", "\U0001f389 ok", " " * 10, "word " * 100]
    whole = crf_quality.line_features(lines)
    monkeypatch.setattr(crf_quality, "_BLOCK", 5)
    assert np.allclose(whole, crf_quality.line_features(lines))
    assert whole[1][6] == 2 / 5 and whole[0][10] == 1 and crf_quality.line_features([]).shape == (0, 11)


def test_quality_on_the_held_out_fold(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = crf_quality.quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert docs.count() == crf_quality.quality(docs, labels).count()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93
    assert all(0 <= r.score <= 1 for r in rows)


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "Fine words here.\n" * 3, 3), (None, "x" * 100_000, 4), (3, "again", 5)], "doc_id bigint, text string, score int")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rows = crf_quality.quality(docs, none).collect()
    assert [r.score for r in rows] == [0.5] * 5 and crf_quality.quality(docs.limit(0), none).collect() == []
    labels = spark.createDataFrame([(3, 1, 0), (3, None, 0), (None, 0, 0), (1, 0, 0)], "doc_id bigint, quality int, toxic int")
    rows = crf_quality.quality(docs, labels).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    scores = {r.doc_id: r.score for r in rows}
    assert scores[1] == scores[2]
    kept = crf_quality.accepted(docs, labels)
    assert kept.columns == docs.columns


def test_one_very_long_document_does_not_fill_the_sample(spark):
    ids = [r.id for r in spark.range(200).where(~crf_quality.held_out(F.col("id"))).orderBy(F.xxhash64("id")).collect()][:80]
    good, bad = "These are plain words of a text.\nAnd some more of them here.\n", "!!! $$$ | BUY | NOW !!!\n### 1 1 1 1\n"
    for long_quality in (0, 1):
        quality = {d: i % 2 if long_quality == 0 else 1 - i % 2 for i, d in enumerate(ids)}
        texts = {d: (good if q else bad) * (25_000 if d == ids[0] else 3) for d, q in quality.items()}
        docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
        model = crf_quality.train(docs, spark.createDataFrame(list(quality.items()), "doc_id bigint, quality int"))
        assert quality[ids[0]] == long_quality
        assert all((s > 0.5) == (quality[d] == 1) for d, s in zip(ids, model.scores([texts[d] for d in ids])))


@pytest.mark.parametrize("n, most", [(1, 4), (512, 512), (513, 512), (50_000, 512), (9, 4), (100, 33), (7, 1), (10**6, 100)])
def test_lines_given_to_the_fit(n, most):
    runs = crf_quality.line_runs(n, most)
    assert all(a < b for a, b in runs) and all(x[1] <= y[0] for x, y in zip(runs, runs[1:])) and runs[-1][1] <= n
    assert (runs == [(0, n)]) == (n <= most) and most // 2 < sum(b - a for a, b in runs) <= most or n <= most


def exact_nearest(vectors, every, k):
    out = {}
    for q, v in vectors.items():
        if q % every == 0:
            scored = sorted(((-float(np.dot(v, w)), o) for o, w in vectors.items() if o != q))[:k]
            out[q] = [(o, -s) for s, o in scored]
    return out


def test_recall_of_the_graph(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 16)) * rng.uniform(0.5, 2, size=(700, 1))
    vectors = dict(enumerate(x))
    df = spark.createDataFrame([(i, v.tolist(), i) for i, v in vectors.items()], "vec_id bigint, embedding array<double>, query_id int")
    out = nn_descent.nearest(df, k=10, degree=16, trees=4, leaf=100, width=10, effort=40).collect()
    expected = exact_nearest(vectors, 20, 10)
    got = {}
    for r in out:
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert got.keys() == expected.keys() and all(sorted(g) == list(range(1, 11)) for g in got.values())
    hits = sum(len({i for i, _ in g.values()} & {i for i, _ in expected[q]}) for q, g in got.items())
    assert hits >= 0.9 * 10 * len(expected)
    for q, g in got.items():
        ordered = [g[i] for i in sorted(g)]
        assert all(abs(s - float(np.dot(x[q], x[o]))) < 1e-12 for o, s in ordered)
        assert ordered == sorted(ordered, key=lambda p: (-p[1], p[0]))


def test_equal_vectors_and_vectors_without_part(spark):
    rng = random.Random(3)
    rows = [(i, [1.0, 0.0]) for i in range(0, 90)] + [(100 + i, [rng.random(), rng.random()]) for i in range(10)]
    odd = [(200, None), (220, [0.0, 0.0]), (240, [float("nan"), 1.0]), (260, [float("inf"), 1.0]), (280, [None, 1.0]), (300, []), (None, [1.0, 1.0])]
    df = spark.createDataFrame([*rows, *odd, rows[0]], "vec_id bigint, embedding array<double>")
    out = nn_descent.nearest(df, k=20, leaf=16, trees=3).collect()
    expected = exact_nearest({i: np.array(v) for i, v in rows}, 20, 20)
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [o for o, _ in e] for q, e in expected.items()}


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_few_vectors(spark, n):
    df = spark.createDataFrame([(20 * i, [1.0, float(i)]) for i in range(n)], "vec_id bigint, embedding array<double>")
    out = nn_descent.nearest(df).collect()
    assert len(out) == n * (n - 1)


def test_effort_follows_the_recall_that_is_measured(spark):
    """Independent Gaussian vectors and a walk that starts far too narrow: the effort grows until the target is met."""
    rng = np.random.default_rng(5)
    vectors = dict(enumerate(rng.normal(size=(600, 24))))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id bigint, embedding array<double>")
    expected = exact_nearest(vectors, 20, 10)

    def recall(**kw):
        got = {}
        for r in nn_descent.nearest(df, k=10, degree=10, trees=3, leaf=100, rest=0.5, width=6, effort=8, **kw).collect():
            got.setdefault(r.query_id, set()).add(r.vec_id)
        return sum(len(got.get(q, set()) & {i for i, _ in e}) for q, e in expected.items()) / (10 * len(expected))

    assert recall(target=0.0) < 0.9 <= recall(target=0.95)


def test_exact_neighbours_of_some_queries(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 8))
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node bigint, vec array<double>")
    truth = nn_descent.exact(nodes, {q: x[q].tolist() for q in (3, 40)}, 5)
    assert truth == {q: set(np.argsort(-(x @ x[q]))[:5].tolist()) for q in (3, 40)}
    assert nn_descent.exact(nodes.limit(0), {3: x[3].tolist()}, 5) == {} == nn_descent.exact(nodes, {}, 5)


def lists_of(rows):
    return [(n, np.array(ids, "<i8").tobytes(), np.array(sims, "<f4").tobytes()) for n, ids, sims in rows]


def test_batches_of_whole_groups_and_merged_lists(spark):
    """Groups that straddle Spark's batches reach the function whole, and each list is that of its node."""
    rng = random.Random(2)
    rows = [(n, ids := rng.sample(range(60), rng.randint(0, 9)), [rng.choice([0.5, 0.25, -1.0, rng.random()]) for _ in ids]) for n in [-4, 0, 3, 4, 5, 2**60] for _ in range(rng.randint(1, 30))]
    rows.append((9, [7, 7, 8], [0.5, 0.75, 0.75]))
    df = spark.createDataFrame(lists_of(rows), "node bigint, ids binary, sims binary")

    def make():
        def work(batch, starts):
            nodes = batch.column("node").to_pylist()
            groups = [nodes[a:b] for a, b in zip(starts, starts[1:])]
            assert all(len(set(g)) == 1 for g in groups) and len({g[0] for g in groups}) == len(groups)
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in groups]), pa.array([len(g) for g in groups])], names=["node", "n"])

        return work

    expected = {}
    for n, ids, sims in rows:
        for i, s in zip(ids, np.array(sims, "<f4").tolist()):
            expected.setdefault(n, {})[i] = max(s, expected.get(n, {}).get(i, -9.0))
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    try:
        for most in ("1", "7", "10000"):
            spark.conf.set(limit, most)
            sizes = [tuple(r) for r in nn_descent.by_group(df.select("node"), "node", make, "node bigint, n bigint").collect()]
            assert sorted(sizes) == sorted(Counter(r[0] for r in rows).items())
            got = {r.node: (np.frombuffer(r.ids, "<i8").tolist(), np.frombuffer(r.sims, "<f4").tolist()) for r in nn_descent.merged(df, 5).collect()}
            assert got.keys() == {r[0] for r in rows}
            for n, (ids, sims) in got.items():
                best = sorted(expected.get(n, {}).items(), key=lambda x: (-x[1], x[0]))[:5]
                assert ids == [i for i, _ in best] and sims == [s for _, s in best]
    finally:
        spark.conf.set(limit, before)
    assert nn_descent.merged(df.limit(0), 5).collect() == []


def test_an_iteration_compares_the_neighbours_of_each_node(spark):
    """Against a plain version: neighbours both ways of each centre are offered to each other, the best of the offers stay."""
    rng = np.random.default_rng(8)
    n, k, offers = 40, 4, 3
    q = rng.integers(-3, 4, size=(n, 5)).astype(np.int8)
    sims = q.astype(float) @ q.T.astype(float)
    graph = {i: sorted(rng.choice([j for j in range(n) if j != i], k if i % 5 else 2, replace=False).tolist(), key=lambda j: (-sims[i, j], j)) for i in range(n)}
    around = {c: set(graph[c]) | {i for i in range(n) if c in graph[i]} for c in range(n)}
    expected, changed = {}, 0
    for i in range(n):
        least = sims[i, graph[i][-1]] if len(graph[i]) == k else -np.inf
        new = set(graph[i])
        for c in range(n):
            if i in around[c]:
                new |= set(sorted((j for j in around[c] if j != i and sims[i, j] > least), key=lambda j: (-sims[i, j], j))[:offers])
        expected[i] = sorted(new, key=lambda j: (-sims[i, j], j))[:k]
        changed += len(set(expected[i]) - set(graph[i]))
    base = spark.createDataFrame([(i, q[i].tobytes(), 1.0) for i in range(n)], "node bigint, q8 binary, unit double")
    df = spark.createDataFrame(lists_of([(i, x, sims[i, x]) for i, x in graph.items()]), "node bigint, ids binary, sims binary")
    out = nn_descent.descend(df, base, k, n, n, offers).collect()
    assert {r.node: np.frombuffer(r.ids, "<i8").tolist() for r in out} == expected
    assert sum(r.changed for r in out) == changed > 0
    edges = sorted(map(tuple, nn_descent.edges_of(df, 3).collect()))
    assert edges == sorted((i, j, sims[i, j]) for i, x in graph.items() for j in x[:3])
