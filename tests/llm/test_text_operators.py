import random

import pytest

from plumbline.llm import decontaminate, line_dedup
from plumbline.llm import license_scan as licenses


def distance_to_best(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    least = min(row)
    return least, row.index(least)


def test_matcher_against_brute_force():
    rng = random.Random(11)
    for _ in range(1500):
        item = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 14)))
        text = decontaminate.normal("".join(rng.choice("abc ") for _ in range(rng.randint(0, 40))))
        rate = rng.choice([0, 0.1, 0.2, 0.34])
        want = decontaminate.normal(item)
        found = list(decontaminate.Matcher([(1, item)], rate).find(text))
        if not want:
            assert not found
            continue
        least, end = distance_to_best(want, text)
        if least > decontaminate.budget(len(want), rate):
            assert not found
        else:
            [(item_id, distance, start, stop)] = found
            assert (item_id, distance, stop) == (1, least, end)
            assert distance_to_best(want, text[start:stop])[0] == least


def test_matches(spark):
    item = "The quick brown fox jumps over the lazy dog and runs far away from the old red barn today."
    edited = item.replace("quick", "quack").replace("lazy", "lazzy")
    docs = spark.createDataFrame(
        [(1, f"before\n{item} after", 1), (2, "Before  " + edited.upper().replace(" ", "\n"), 1), (3, "clean text", 1), (4, None, 1), (5, "", 1), (None, item, 1), (1, item, 1)],
        "doc_id bigint, text string, item_id int",
    )
    bench = spark.createDataFrame([(7, item, "x"), (7, item, "x"), (8, None, "x"), (9, "  ", "x"), (10, "not there at all, anywhere", "x")], "item_id bigint, text string, doc_id string")
    rows = sorted((r.doc_id or 0, r.item_id, r.distance) for r in decontaminate.matches(docs, bench).collect())
    assert rows == sorted([(0, 7, 0)] * 2 + [(1, 7, 0)] * 4 + [(2, 7, 2)] * 2)
    assert sorted((r.doc_id or 0, r.item_id, r.distance) for r in decontaminate.matches(docs, bench, block_chars=20).collect()) == rows
    assert sorted(r.doc_id or 0 for r in decontaminate.decontaminated(docs, bench).collect()) == [0, 3, 4, 5]
    assert decontaminate.matches(docs, bench.limit(0)).collect() == []
    assert decontaminate.matches(docs.limit(0), bench).collect() == []


def shortest_runs(lines, over=50):
    """First and last line of the shortest runs of over ``over`` words from each line on and up to each line."""
    size = [len(x.split()) for x in lines]
    out = set()
    for i in range(len(lines)):
        out.update([(i, b) for b in range(i, len(lines)) if sum(size[i : b + 1]) > over][:1])
        out.update([(a, i) for a in range(i, -1, -1) if sum(size[a : i + 1]) > over][:1])
    return out


def plain_dedup(rows, window=2, divisor=2, least=2):
    """Texts without repeated chunks and without runs of over 50 words that an earlier document has."""
    seen, runs, out = {}, set(), {}
    for doc, text in sorted((d, t) for d, t in rows if t is not None):
        every = text.split("\n")
        gone, at, own = set(), 0, {(a, b): tuple(every[a : b + 1]) for a, b in shortest_runs(every)}
        for k, (lines, _) in enumerate(line_dedup.chunks(text, window, divisor, least)):
            if len(lines) >= least and seen.setdefault("\n".join(lines), (doc, k)) != (doc, k):
                gone.update(range(at, at + len(lines)))
            at += len(lines)
        for (a, b), run in own.items():
            if run in runs:
                gone.update(range(a, b + 1))
        runs.update(own.values())
        out[doc] = "\n".join(x for i, x in enumerate(every) if i not in gone)
    return out


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(2)
    passage = [f"shared line {i}" for i in range(12)]
    rows = [(i, "\n".join([f"own {i} {k}" for k in range(rng.randint(0, 4))] + passage + [f"end {i}"])) for i in range(30)]
    rows += [(100, ""), (101, None), (102, "one line"), (103, "one line"), (104, "\n" * 50), (105, "a\nb\n" * 40)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, n_lines string")
    got = {r.doc_id: r for r in line_dedup.deduplicated(docs).collect()}
    assert {d: r.text for d, r in got.items() if r.text is not None} == plain_dedup(rows)
    assert got[101].text is None and got[101].n_lines == 0
    # A passage is cut alike behind different beginnings: most of it goes from all documents but the first.
    assert sum(r.removed_lines for d, r in got.items() if 0 < d < 30) > 29 * 6
    assert all(r.n_lines == (r.text or "").count("\n") + 1 + r.removed_lines for r in got.values() if r.text)
    assert got[102].text == got[103].text == "one line"
    assert line_dedup.deduplicated(docs.limit(0)).collect() == []


def test_line_dedup_keeps_rows_and_columns(spark):
    docs = spark.createDataFrame([(None, "a\nb\nc\nd", "x", 7), (1, "a\nb\nc\nd", "y", 7), (1, "a\nb\nc\nd", "y", 7), (2, "a\nb\nc\nd", "z", 7)], "doc_id bigint, text string, lang string, n_chars bigint")
    out = line_dedup.cleaned(docs)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    rows = sorted((r.doc_id or 0, r.text, r.lang, r.n_chars) for r in out.collect())
    assert [r[:1] + r[2:3] for r in rows] == [(0, "x"), (1, "y"), (1, "y"), (2, "z")]
    assert rows[0][1] == rows[1][1] == rows[2][1] == "a\nb\nc\nd"
    assert len(rows[3][1]) < 7 and rows[3][3] == len(rows[3][1])


def test_line_dedup_survives_columns_with_its_own_names(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc\nd", 1, 2, 3, 4), (2, "a\nb\nc\nd", 1, 2, 3, 4)], "doc_id bigint, text string, n_lines int, removed_lines int, _drop int, _doc int")
    out = line_dedup.cleaned(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id, r.n_lines, r.removed_lines, r._drop, r._doc) for r in out.collect()) == [(1, 1, 2, 3, 4), (2, 1, 2, 3, 4)]


def plain_runs(rows, over=50):
    """Lines of each text that stand in a run of over ``over`` words that an earlier document has too."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        lines = text.split("\n")
        spans = [(a, b, tuple(lines[a:b])) for a in range(len(lines)) for b in range(a + 1, len(lines) + 1) if sum(len(x.split()) for x in lines[a:b]) > over]
        out[doc] = {i for a, b, run in spans if run in seen for i in range(a, b)}
        seen.update(run for _, _, run in spans)
    return out


def test_line_dedup_finds_every_long_run(spark):
    rng = random.Random(5)
    pool = [" ".join(f"w{i}x{k}" for k in range(n)) for i, n in enumerate([0, 1, 3, 9, 17, 20, 26, 30, 51, 60])]
    rows = []
    for d in range(60):
        text = [f"own {d} {k}" if rng.random() < 0.4 else rng.choice(pool) for k in range(rng.randint(1, 9))]
        at = rng.randint(0, len(text))
        text[at:at] = [pool[i] for i in rng.choice([(6, 7), (7, 1, 5), (4, 3, 5, 2, 2), (9,), (0, 8, 0)])]
        rows.append((d, "\n".join(text)))
    rows += [(100, "one " * 51), (101, "one " * 51), (102, "two " * 50), (103, "two " * 50)]
    got = {r.doc_id: r for r in line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    runs = plain_runs(rows)
    shape, seen, expected = (2, 2, 2), {}, {}
    for doc, text in rows:
        gone, at = set(runs[doc]), 0
        for k, (lines, _) in enumerate(line_dedup.chunks(text, *shape)):
            if len(lines) >= 2 and seen.setdefault("\n".join(lines), (doc, k)) != (doc, k):
                gone.update(range(at, at + len(lines)))
            at += len(lines)
        expected[doc] = ("\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone), len(gone))
    assert {d: (r.text, r.removed_lines) for d, r in got.items()} == expected
    assert got[101].text == "" and got[103].text == "two " * 50


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if ord(c) > 127 or c.isdigit() or "a" <= c <= "z" else " " for c in lowered).split(" ")


def plain_scan(text):
    words = [w for w in plain_words(text) if w]
    places = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    labels, share = {label for _, label in places}, 0.0
    for line in (text or "").split("\n"):
        held = {w for w in plain_words(line) if w}
        for t, label in licenses.TEMPLATES:
            content = set(t.split())
            if len(held & content) >= 0.8 * len(content) - 1e-9:
                labels.add(label)
                share = max(share, len(held & content) / len(content))
    at = [i for i, _ in places]
    base = ",".join(sorted({label for _, label in places}))
    return len(words), len(at), min(at, default=None), max(at, default=None), base, ",".join(sorted(labels)), 1.0 if at else share


def test_license_scan_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = sorted({w for t, _ in licenses.TEMPLATES for w in t.split()}) + ["x", "é", "-", "\n", "CC", "By", "K"]
    texts = [None, "", "!!!", "MIT License MIT License", "apache license apache license", "cc-by 4.0; CC BY", "İ mit licensE é", "mit licenses", "GNU General  Public\nLicense"]
    texts += [t.upper() for t, _ in licenses.TEMPLATES]
    for t, _ in licenses.TEMPLATES * 3:
        words = t.split()
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rng.shuffle(words)
        texts.append(" ".join(words) + "\n" + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40))))
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "mit license", "x"), (3, texts[3], "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, labels string")
    out = licenses.scan(docs).collect()
    assert sorted(map(repr, ((r[0], *r[1:7], round(r[7], 9)) for r in out))) == sorted(map(repr, ((i, *(x := plain_scan(t))[:6], round(x[6], 9)) for i, t, _ in rows)))
    assert licenses.scan(docs.limit(0)).collect() == []


@pytest.mark.parametrize("column", ["doc_id", "text"])
def test_columns_of_nulls(spark, column):
    docs = spark.createDataFrame([(1, "a b c"), (2, "mit license")], "doc_id bigint, text string").selectExpr(*[f"cast(null as {t}) {c}" if c == column else c for c, t in (("doc_id", "bigint"), ("text", "string"))])
    bench = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert licenses.scan(docs).count() == line_dedup.deduplicated(docs).count() == 2
    assert decontaminate.matches(docs, bench).count() == (1 if column == "doc_id" else 0)
