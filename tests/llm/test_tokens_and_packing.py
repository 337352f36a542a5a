import itertools
import random
import struct
import zlib
from collections import Counter

import pytest

from plumbline.llm import packing, token_counts
from plumbline.llm.queries import vocabulary
from plumbline.llm.tokens import encoder, runs_of_space

TEXTS = [
    None, "", " ", "\n\n", "a", "a  b", "it's\tfine \r\n now ", "<|endoftext|> in a text<|endoftext|>", "x" * 5000,
    "Ça coûte 12,50 € à Zürich", "日本語  テキスト", " nbsp thin", "tail space ", "\x1c\x1d separators \x85 next", "ends\n", "🎉🎉 party " * 50,
]


def exact(text):
    return encoder(vocabulary()).exact.encode(text or "", add_special_tokens=False).ids


def test_ids_are_those_of_the_library():
    bpe = encoder(vocabulary())
    assert bpe.fast is not None
    for t in TEXTS:
        assert bpe.ids(t or "") == exact(t)


def test_ids_agree_around_every_code_point():
    bpe = encoder(vocabulary())
    full, fast = token_counts.splitters()
    for start in range(0, 0x110000, 257):
        t = "".join(f"a1 {chr(i)}b {chr(i)}{chr(i)}!" for i in range(start, min(start + 257, 0x110000)) if not 0xD800 <= i < 0xE000)
        ids = exact(t)
        assert bpe.ids(t) == ids
        assert sum(len(bpe.ids(w)) for w in (full if runs_of_space(t) else fast)(t)) == len(ids)


def test_counts(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "no id", "x"), (1, "again", "x"), (1, "again", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")
    out = token_counts.token_counts(docs, vocabulary(), cache_entries=5).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens) for r in out if r.doc_id is not None) == sorted((False, i, len((t or "").encode()), len(exact(t))) for i, t, _ in rows if i is not None)
    assert len(out) == len(rows)
    assert token_counts.counted(docs.limit(0), vocabulary()).collect() == []
    assert {r.over_limit for r in token_counts.counted(docs.where("doc_id = 8"), vocabulary()).collect()} == {len(exact(TEXTS[8])) > 512}


def test_frequent_table_reads_no_more_than_it_needs(spark):
    """Tasks stop early; what the table holds are true lengths; counts with such a table are those of the library."""
    docs = spark.createDataFrame([(i, f"the same words again and again {i} " * 200) for i in range(300)], "doc_id bigint, text string").repartition(3)
    table = token_counts.frequent_table(docs, vocabulary(), sample_tasks=2, sample_chars=50_000, entries=10)
    assert 0 < len(table) <= 10 and all(n == len(exact(w)) for w, n in table.items())
    assert token_counts.frequent_table(docs.limit(0), vocabulary()) == {}
    out = token_counts.token_counts(docs, vocabulary(), sample_tasks=2).collect()
    assert len(out) == 300 and all(r.n_tokens == len(exact(f"the same words again and again {r.doc_id} " * 200)) for r in out[:5])


def optimum(counts, capacity):
    items = sorted((n for n, c in counts.items() for _ in range(c)), reverse=True)
    best = [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for s in {b for b in bins if b + items[i] <= capacity}:
            rest = list(bins)
            rest.remove(s)
            place(i + 1, rest + [s + items[i]])
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best[0]


def test_plan_is_the_optimum_on_small_cases():
    rng = random.Random(5)
    for _ in range(60):
        capacity = rng.randint(5, 20)
        counts = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 9)))
        plan = packing.complete_bins(counts, capacity)
        assert Counter(n for f, m in plan.items() for n in f * m) == counts
        assert all(sum(f) <= capacity for f in plan)
        assert sum(plan.values()) == optimum(counts, capacity) >= packing.lower_bound(counts, capacity)


def test_bin_completion_beats_best_fit():
    # Best fit decreasing needs one sequence more here.
    counts = Counter([44, 24, 24, 22, 21, 17, 8, 8, 6, 6])
    assert optimum(counts, 60) == sum(packing.complete_bins(counts, 60).values())
    with pytest.raises(ValueError):
        packing.complete_bins({7: 1}, 6)


def test_sequences_are_gapless_and_whole(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "\n\n"), (None, "no id"), *((100 + i, "same text") for i in range(40))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    parts = packing.pieces(docs, vocabulary(), capacity=64)
    out = packing.pack(parts, 64, salt_rows=7).collect()
    whole = {}
    for r in sorted(out, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.start)):
        assert len(r.ids) == 4 * r.length and 1 <= r.length <= 64
        assert r.piece == 0 or r.length == 64
        whole.setdefault(r.doc_id, []).append(list(struct.unpack(f"<{r.length}I", r.ids)))
    for i, t in enumerate(TEXTS):
        if i != 3:
            assert list(itertools.chain(*whole[i])) == exact(t) + [2]
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    counts = Counter(r.length for r in out)
    assert len(by_sequence) == sum(packing.complete_bins(counts, 64).values())
    digests = packing.packed(docs, vocabulary(), 64).collect()
    assert sorted(r.ids_crc32 for r in digests) == sorted(zlib.crc32(r.ids) for r in out)
    assert packing.packed(docs.limit(0), vocabulary()).collect() == []


def test_groups_of_rows_without_ids(spark, monkeypatch):
    """Rows of one length, without ids or with one: every group has its share, and places stay gapless over many runs."""
    monkeypatch.setattr(packing, "_RUN", 4)
    parts = spark.range(900).selectExpr("if(id % 3 = 0, 7L, null) as doc_id", "0 as piece", "if(id % 9 = 0, 20L, 30L) as length", "1 as _x")
    out = packing.pack(parts, 100, salt_rows=10)
    assert out.columns == ["doc_id", "piece", "length", "_x", "sequence_id", "offset"]
    seen = {}
    for r in out.collect():
        seen.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in seen.values():
        ends = list(itertools.accumulate(n for _, n in sorted(places)))
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 100
    assert sum(len(p) for p in seen.values()) == 900
    assert len(seen) == sum(packing.complete_bins({20: 100, 30: 800}, 100).values())
