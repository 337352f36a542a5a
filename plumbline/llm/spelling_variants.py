"""Spelling variants of words by a dictionary of trie-node pairs.

The words of a corpus stand in two tries, one of the words and one of the reversed words. Nodes are numbered in the
order in which the sorted words create them, so a number stands for exactly one beginning (or end) of a word, and the
numbers of whole words sort as the words do. Ranges of sorted words are numbered by a task each; the driver sees the first
and last word of a range and the path of the last, and hands on how much of a path the next range inherits.

A word of L letters has L pairs (node of the beginning, node of the end) that skip one letter and L + 1 pairs that skip
none. Two words differ by a replaced letter exactly where they share a skipping pair, and by an inserted one where a
skipping pair of the longer equals a whole pair of the shorter. So rows of two integers that meet are neighbours, without
any comparison of texts. Words under one pair differ in one letter only, so they are never more than the alphabet has
letters, and one for the pair that skips none; counts and the best neighbour come from that short list, not from pairs of
words. In a run of equal letters skipping any gives the same word, which counts once, at the first.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import arrow_map, grouped_map, stored

# Letters of a word; one run in so many of a document loses a letter in ``typo`` counts.
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
TYPO_DIVISOR = 199
# Words of a range that one task numbers.
_RANGE = 50_000
# Kinds of pairs: no letter skipped; a letter skipped; the same within a run of equal letters.
_WHOLE, _SKIP, _SKIP_AGAIN = 0, 1, 2


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo: int | None = None, letters: int = 6, least: int = 5) -> DataFrame:
    """(word, n): maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased, of at least ``letters`` code points and
    ``least`` occurrences in all texts. Null texts have none; a null id counts as an empty one.

    With ``typo`` runs are damaged first: where crc32 of ``id:run`` is divisible by ``typo``, the run loses its code point
    number crc32 % length. Equal runs of a slice of rows are counted together before they leave the task."""

    def make():
        lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

        def work(batch):
            counts: Counter[str] = Counter()
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                runs = Counter(_RUN.findall((text or "").encode().translate(lower).decode()))
                counts.update(_damaged(runs, "" if doc is None else doc, typo) if typo else runs)
            return ((w, n) for w, n in counts.items() if len(w) >= letters)

        return work

    runs = arrow_map(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), make, "word string, n bigint")
    return runs.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _damaged(runs: Counter, doc, typo: int) -> Counter:
    out: Counter[str] = Counter()
    start = zlib.crc32(f"{doc}:".encode())
    for run, n in runs.items():
        code = zlib.crc32(run.encode(), start)
        if code % typo == 0:
            at = code % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def _paths(words, path: list[int], number: int, last: str = ""):
    """(word, path, next number) of sorted words: a path has the numbers of a word's nodes from the first letter on."""
    for word in words:
        shared = len(os.path.commonprefix((last, word)))
        new = len(word) - shared
        path = path[:shared] + list(range(number, number + new))
        number += new
        last = word
        yield word, path, number


def numbered(words: DataFrame, reverse: bool = False) -> DataFrame:
    """(word, nodes) for a stored frame of different ``word``s: the numbers of the trie nodes on the word's path, from 1 on.

    With ``reverse`` the trie is that of the reversed words, and the path starts at the last letter."""
    spelled = F.reverse("word") if reverse else F.col("word")
    parts = words.count() // _RANGE + 1
    ranges = stored(words.select("word", spelled.alias("spelled")).repartitionByRange(parts, "spelled").select("word", "spelled", F.spark_partition_id().alias("part")))

    def summary():
        def work(table):
            spelled = table.column("spelled").to_pylist()
            for _, path, number in _paths(spelled, [], 0):
                pass
            yield table.column("part")[0].as_py(), spelled[0], spelled[-1], number, path

        return work

    # One row for each range, with a word and its path: what the driver holds grows with the ranges, not with the words.
    seen = grouped_map(ranges, ["part"], summary, "part int, first string, last string, size bigint, path array<bigint>", ("spelled",)).collect()
    starts: dict[int, tuple[list[int], int]] = {}
    last, path, number = "", [], 1
    for row in sorted(seen, key=lambda r: r.part):
        inherited = path[: len(os.path.commonprefix((last, row.first)))]
        starts[row.part] = (inherited, number)
        path = [inherited[k] if k < len(inherited) else number + k - len(inherited) for k in row.path]
        number += row.size - len(inherited)
        last = row.last

    def make():
        def work(table):
            inherited, number = starts[table.column("part")[0].as_py()]
            spelled = table.column("spelled").to_pylist()
            paths = _paths(spelled, inherited, number, spelled[0][: len(inherited)])
            for word, (_, path, _) in zip(table.column("word").to_pylist(), paths):
                yield word, path

        return work

    return grouped_map(ranges, ["part"], make, "word string, nodes array<bigint>", ("spelled",))


def pairs(words: DataFrame) -> DataFrame:
    """(p, s, kind, id, n) of every word of (word, n, forward, backward); id is the node of the whole word."""

    def make():
        def work(batch):
            for word, n, forward, backward in zip(*(c.to_pylist() for c in batch.columns)):
                size, me = len(word), forward[-1]
                begin, end = [0, *forward], [0, *backward]
                for i in range(size):
                    yield begin[i], end[size - i], _WHOLE, me, n
                    yield begin[i], end[size - 1 - i], _SKIP_AGAIN if i and word[i - 1] == word[i] else _SKIP, me, n
                yield begin[size], 0, _WHOLE, me, n

        return work

    return arrow_map(words.select("word", "n", "forward", "backward"), make, "p bigint, s bigint, kind int, id bigint, n bigint")


def neighbours(found: DataFrame) -> DataFrame:
    """(id, n_near, best) from ``pairs``; best is (n, -id) of the neighbour with the largest n, of equal ones the first."""
    me = F.struct("n", (-F.col("id")).alias("m"))
    skipping = F.collect_list(F.when(F.col("kind") != _WHOLE, F.struct(me.alias("me"), (F.col("kind") == _SKIP).alias("first"))))
    met = found.groupBy("p", "s").agg(skipping.alias("skip"), F.max(F.when(F.col("kind") == _WHOLE, me)).alias("whole"), F.count("*").alias("size")).where("size > 1")
    met = met.withColumn("skip", F.sort_array("skip", asc=False))
    met = met.withColumn("shorter", F.filter("skip", lambda e: e["first"]))
    top, second = F.try_element_at("skip", F.lit(1)), F.try_element_at("skip", F.lit(2))

    def seen(e):
        others = F.when(e["me"] == top["me"], second["me"]).otherwise(top["me"])
        whole = F.when(e["first"], F.col("whole"))
        count = F.size("skip") - 1 + F.when(whole.isNotNull(), 1).otherwise(0)
        return F.struct((-e["me"]["m"]).alias("id"), count.cast("long").alias("near"), F.greatest(others, whole).alias("best"))

    whole = F.struct((-F.col("whole.m")).alias("id"), F.size("shorter").cast("long").alias("near"), F.try_element_at("shorter", F.lit(1))["me"].alias("best"))
    each = F.concat(F.transform("skip", seen), F.when(F.col("whole").isNotNull(), F.array(whole)).otherwise(F.slice(F.array(whole), 1, 0)))
    rows = met.select(F.explode(each).alias("e")).select("e.*").where("near > 0")
    return rows.groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) for every ``id`` of (id, to): the end of the chain. A form has several times the count of its variant,
    so chains have no cycles and a length in the logarithm of the largest count; every round halves what is left."""
    current = stored(forms)
    while True:
        onward = current.select(F.col("id").alias("via"), F.col("to").alias("beyond"))
        further = stored(current.join(onward, F.col("to") == F.col("via"), "left").select("id", F.coalesce("beyond", "to").alias("to"), F.col("beyond").isNotNull().alias("moved")))
        if further.where("moved").isEmpty():
            return further.select("id", F.col("to").alias("root"))
        current = further.select("id", "to")


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near and form_n for every row of (word, n), whose words differ.

    Near words differ by one inserted, deleted or replaced code point. The form of a word is the near word of the largest
    n, of equal ones the first in code-point order, if that n is at least ``ratio`` times the word's; else null. The root is
    the end of the chain of forms, the word itself if it has none. No words give no rows."""
    if ratio < 2:
        raise ValueError("a form has to be commoner than its variant")
    words = stored(words.select("word", "n"))
    forward = numbered(words).select("word", F.col("nodes").alias("forward"))
    backward = numbered(words, reverse=True).select("word", F.col("nodes").alias("backward"))
    nodes = stored(words.join(forward, "word").join(backward, "word"))
    near = stored(neighbours(pairs(nodes)))
    named = nodes.select(F.element_at("forward", -1).alias("id"), "word", "n")
    enough = F.col("best.n") >= ratio * F.col("n")
    known = stored(named.join(near, "id", "left").select("id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(enough, -F.col("best.m")).alias("form_id"), F.when(enough, F.col("best.n")).alias("form_n")))
    ends = roots(known.where("form_id is not null").select("id", F.col("form_id").alias("to")))
    form = known.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    root = ends.join(known.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    joined = known.join(form, "form_id", "left").join(root, "id", "left")
    return joined.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def rewritten(docs: DataFrame, found: DataFrame, text_col: str = "text", most: int = 200_000) -> DataFrame:
    """``docs`` with every word of a text that has a form in ``variants`` replaced by its root; all else stays.

    The dictionary of variants goes to the tasks by broadcast; beyond ``most`` of them it is an error to ask for it."""
    known = found.where("form is not null").select("word", "root").limit(most + 1).collect()
    if len(known) > most:
        raise ValueError(f"more than {most} variants: join the words of the texts instead")
    better = {r.word: r.root for r in known}
    at, schema = docs.columns.index(text_col), docs.schema

    def run(batches):
        import pyarrow as pa

        lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

        def mended(match):
            return better.get(match[0].translate(lower), match[0])

        for batch in batches:
            texts = [None if t is None else _RUN.sub(mended, t) for t in batch.column(at).to_pylist()]
            columns = [pa.array(texts, type=c.type) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, schema)
