"""License scan: exact phrases, and templates found by a set-similarity join.

A template is found in a block of text (a line) if the block holds at least ``threshold`` of the template's different
words. The join is exact and never compares a block with every template: words are ordered by how many documents of the
whole corpus hold them, rarest first; a block that reaches the threshold must share one of the first words of the
template in that order (prefix filter), have enough words at all (length filter) and enough of them behind the shared
one (positional filter). What is left is verified. Everything is DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import lower_ascii, stored

# ---------------------------------------------------------------------------
# Phrases and labels that the result is defined by.
# ---------------------------------------------------------------------------
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Sentences that licenses are stated with, in words as the scan sees them, and the label each one gives.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may obtain a copy of the license at http www apache org licenses license 2 0", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("all rights reserved", "all-rights-reserved"),
)

_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(column):
    """Words of a text, each between single spaces: `` w1 w2 ``; one space if there are none."""
    return F.regexp_replace(F.concat(F.lit(" "), lower_ascii(F.coalesce(column, F.lit(""))), F.lit(" ")), _NO_WORD, " ")


def _spaces(column):
    return F.length(column) - F.length(F.replace(column, F.lit(" ")))


def phrase_columns(text: str, phrases: tuple[tuple[str, str], ...] = PHRASES):
    """Columns for a column of ``words_of``: n_words, n_base, first_word, last_word, base_labels (array)."""
    s = F.col(text)
    n_words = F.greatest(_spaces(s) - 1, F.lit(0)).cast("long")
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases:
        there = F.contains(s, F.lit(f" {phrase} "))
        parts = F.split(s, f" {phrase}(?= )")
        counts.append(F.when(there, F.size(parts) - 1).otherwise(0))
        firsts.append(F.when(there, _spaces(parts[0])))
        lasts.append(F.when(there, n_words - (_spaces(F.element_at(parts, -1)) - 1) - len(phrase.split())))
        labels.append(F.when(there, F.lit(label)))
    return [
        n_words.alias("n_words"),
        sum(counts[1:], counts[0]).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"),
        F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))).alias("base_labels"),
    ]


def document_counts(words: DataFrame, vocabulary: list[str], column: str) -> dict[str, int]:
    """In how many documents each word of a fixed vocabulary occurs; one number for each of its words."""
    fixed = F.array(*[F.lit(w) for w in vocabulary])
    held = words.select(F.explode(F.array_intersect(F.split(column, " "), fixed)).alias("w"))
    return {r["w"]: r["n"] for r in held.groupBy("w").agg(F.count("*").alias("n")).collect()}


def scan(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score for every row.

    Words are runs of anything but ASCII characters that are no digit or lower-case letter, after A-Z is lower-cased.
    ``score`` is 1 where a phrase stands, else the largest share of a template that a block holds, 0 below the threshold.
    Null and empty texts have no words; first_word and last_word are null and the labels empty without a phrase. Null
    ids and repeated rows are kept, an empty table gives no rows, other columns are left out."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
    words = texts.select("doc_id", "_text", words_of(F.col("_text")).alias("_words"))
    sets = [(set(t.split()), label) for t, label in templates]
    counts = document_counts(words, sorted(set().union(*(s for s, _ in sets))), "_words")
    order = sorted(set().union(*(s for s, _ in sets)), key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    prefix = []
    for number, (content, label) in enumerate(sets):
        need = math.ceil(threshold * len(content) - 1e-9)
        ranked = sorted(content, key=rank.get)
        prefix += [(w, number, i, need, ranked, label) for i, w in enumerate(ranked[: len(ranked) - need + 1])]
    first = sorted({p[0] for p in prefix}, key=rank.get)
    # One row for each prefix word of the fixed templates.
    table = docs.sparkSession.createDataFrame(prefix, "word string, template int, i int, need int, content array<string>, label string")

    any_first = F.lit(False)
    for w in first:
        any_first = any_first | F.contains("_words", F.lit(f" {w} "))
    lines = F.filter(F.transform(F.split("_text", "\n"), words_of), lambda x: F.length(x) > 1)
    rows = stored(
        words.select(F.monotonically_increasing_id().alias("_row"), "doc_id", *phrase_columns("_words", phrases), F.when(any_first, F.array_distinct(lines)).alias("_blocks"))
    )
    blocks = rows.where("_blocks is not null").select("_row", F.posexplode("_blocks").alias("_block", "_line"))
    in_order = F.array(*[F.lit(w) for w in order])
    held = F.filter(in_order, lambda w: F.contains(F.col("_line"), F.concat(F.lit(" "), w, F.lit(" "))))
    blocks = blocks.select("_row", "_block", held.alias("_held")).where(F.size("_held") > 0)
    probes = blocks.select("_row", "_block", "_held", F.posexplode("_held").alias("j", "w"))
    joined = probes.join(F.broadcast(table), F.col("w") == F.col("word"))
    length = F.size("_held") >= F.col("need")
    behind = 1 + F.least(F.size("content") - F.col("i") - 1, F.size("_held") - F.col("j") - 1)
    before = F.least(F.col("i"), F.col("j"))
    common = F.size(F.array_intersect("_held", "content"))
    found = joined.where(length & (behind + before >= F.col("need"))).where(common >= F.col("need"))
    by_row = found.groupBy("_row").agg(F.collect_set("label").alias("_labels"), F.max(common / F.size("content")).alias("_share")).withColumnRenamed("_row", "_found")
    out = rows.join(by_row, F.col("_row") == F.col("_found"), "left")
    none = F.array().cast("array<string>")
    return out.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", F.coalesce("_labels", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_share", F.lit(0.0))).alias("score"),
    )


def oracle() -> str:
    """The same rows by comparing every line with every template."""
    word = "trim(regexp_replace(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g'), ' ')"
    phrases = ", ".join(f"(['{"','".join(p.split())}'], '{label}')" for p, label in PHRASES)
    templates = ", ".join(f"({i}, list_distinct(string_split('{t}', ' ')), '{label}')" for i, (t, label) in enumerate(TEMPLATES))
    return f"""
WITH phrases(p, label) AS (VALUES {phrases}), templates(t, content, label) AS (VALUES {templates}),
docs AS (SELECT doc_id, text, CASE WHEN {word.format("text")} = '' THEN []::VARCHAR[] ELSE string_split({word.format("text")}, ' ') END AS w FROM documents),
places AS (SELECT doc_id, label, i - 1 AS place FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs) d JOIN phrases ON w[i] = p[1] AND w[i:i + len(p) - 1] = p),
base AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS found FROM places GROUP BY doc_id),
lines AS (SELECT DISTINCT doc_id, list_distinct(string_split({word.format("line")}, ' ')) AS held FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)),
shares AS (SELECT doc_id, label, len(list_intersect(held, content)) AS n, len(content) AS size FROM lines, templates),
own AS (SELECT doc_id, list(DISTINCT label) AS found, max(n::DOUBLE / size) AS share FROM shares WHERE n >= ceil(0.8 * size - 1e-9) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(b.n_base, 0)::BIGINT AS n_base, b.first_word::BIGINT AS first_word, b.last_word::BIGINT AS last_word,
  coalesce(list_aggregate(list_sort(b.found), 'string_agg', ','), '') AS base_labels,
  coalesce(list_aggregate(list_sort(list_distinct(list_concat(coalesce(b.found, []), coalesce(o.found, [])))), 'string_agg', ','), '') AS labels,
  CASE WHEN b.n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(o.share, 0.0::DOUBLE) END AS score
FROM docs d LEFT JOIN base b USING (doc_id) LEFT JOIN own o USING (doc_id)"""
