import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from plumbline.llm import spelling_variants as sv
from plumbline.llm.queries import op11_spelling_variants


def plain_counts(rows, typo=199, letters=6, least=5):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            code = zlib.crc32(f"{doc}:{run}".encode())
            if typo and code % typo == 0:
                run = run[: code % len(run)] + run[code % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= letters and n >= least}


def plain_variants(counts, ratio=5):
    """By deleting each letter: near words share a deletion, or one is a deletion of the other; then compared in full."""
    by = defaultdict(set)
    for w in counts:
        by[w].add(w)
        for i in range(len(w)):
            by[w[:i] + w[i + 1 :]].add(w)
    near = {w: {x for i in range(len(w)) for x in by[w[:i] + w[i + 1 :]] if one_edit(w, x)} | {x for x in by[w] if one_edit(w, x)} for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return out


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def rows_of(frame):
    rows = [tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


@pytest.mark.parametrize("per_range", [3, 50_000])
def test_variants_against_brute_force(spark, monkeypatch, per_range):
    monkeypatch.setattr(sv, "_RANGE", per_range)
    rng = random.Random(per_range)
    words = {"".join(rng.choice("abä") for _ in range(rng.randint(1, 6))) for _ in range(150)} | {"aaaaaaa", "aaaaaa", "aaaaaaaa", "ÿ" * 9, "÷×ÿabc", "z" * 90, "z" * 89, "y" + "z" * 88}
    counts = {w: rng.choice([1, 2, 5, 5, 10, 25, 50, 250, 1250]) for w in sorted(words)}
    frame = spark.createDataFrame([(*r, "x") for r in counts.items()], "word string, n bigint, id string")
    assert rows_of(sv.variants(frame)) == plain_variants(counts)
    if per_range > 3:
        assert sv.variants(frame.limit(0)).collect() == []


@pytest.mark.parametrize("reverse", [False, True])
def test_node_numbers_are_those_of_one_trie(spark, monkeypatch, reverse):
    monkeypatch.setattr(sv, "_RANGE", 4)
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 7))) for _ in range(60)})
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r.word: r.nodes for r in sv.numbered(frame, reverse).collect()}
    nodes = {}
    for w in sorted(x[::-1] if reverse else x for x in words):
        for i in range(len(w)):
            nodes.setdefault(w[: i + 1], len(nodes) + 1)
    assert got == {w: [nodes[(w[::-1] if reverse else w)[: i + 1]] for i in range(len(w))] for w in words}


def test_words_against_counting_in_memory(spark):
    rng = random.Random(3)
    pool = ["Spelling", "spelling", "spellings", "Übung", "übungen", "naïve×ly", "short", "x" * 70, "résumé_resume", "KKelvin", "one-two", "İstanbul"]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 60)))) for i in range(500)] + [(1000, None), (1001, ""), (1002, "spelling " * 20_000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, word int")
    assert {r.word: r.n for r in sv.counted(docs, typo=199).collect()} == plain_counts(rows)
    assert {r.word: r.n for r in sv.counted(docs).collect()} == plain_counts(rows, None)
    nameless = spark.createDataFrame([(None, "nameless words here")] * 6, "doc_id bigint, text string")
    assert [r.n for r in sv.counted(nameless).collect()] == [6]


def test_registered_query_on_the_table(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    want = plain_variants(plain_counts(rows))
    assert rows_of(op11_spelling_variants(spark, data)) == want
    assert sum(v[0] is not None for v in want.values()) > 3


def test_texts_take_the_common_spelling(spark):
    counts = {"spelling": 100, "speling": 3, "spelin": 1}
    found = sv.variants(spark.createDataFrame(list(counts.items()), "word string, n bigint"), ratio=3)
    docs = spark.createDataFrame([(1, "Speling, spelin; SPELLING.", "x"), (2, None, "y")], "doc_id bigint, text string, lang string")
    assert [tuple(r) for r in sv.rewritten(docs, found).orderBy("doc_id").collect()] == [(1, "spelling, spelling; SPELLING.", "x"), (2, None, "y")]
    with pytest.raises(ValueError):
        sv.rewritten(docs, found, most=1)
