"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters counts as found in a text if some stretch of the text is within ``budget(m)`` edits of it. Of
budget + 1 pieces that an item is cut into, at least one survives that many edits unchanged. So one automaton finds the
exact hits of all pieces in a text, and only the stretches around hits are verified, by Myers' bit-parallel distance.
The result is the same as if every item were compared with every stretch.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import arrow_map, stored

MATCHES = "doc_id bigint, item_id bigint, distance int, start bigint, stop bigint"


def normal(text: str) -> str:
    """Lower case, every run of white space one space, none at the ends."""
    return " ".join(text.lower().split())


def budget(length: int, rate: float) -> int:
    return int(length * rate)


def cut(item: str, count: int) -> Iterator[tuple[int, str]]:
    """(offset, piece) of ``count`` pieces of almost equal length that make up ``item``."""
    ends = [len(item) * k // count for k in range(count + 1)]
    return ((a, item[a:b]) for a, b in zip(ends, ends[1:]))


class Pattern:
    """Myers' bit-parallel edit distance of one pattern to the best stretch of a text."""

    def __init__(self, pattern: str):
        self.size = len(pattern)
        self.mask: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.mask[c] = self.mask.get(c, 0) | 1 << i

    def best(self, text: str, limit: int, whole: bool = False) -> tuple[int, int] | None:
        """(distance, end) of the stretch of ``text`` nearest to the pattern, the leftmost end among equals; None above
        ``limit``. ``whole``: of the stretches that begin where ``text`` begins."""
        full, top, get = (1 << self.size) - 1, 1 << (self.size - 1), self.mask.get
        up, down, score = full, 0, self.size
        best = (score, 0) if score <= limit else None
        for end, c in enumerate(text, 1):
            eq = get(c, 0)
            x = (((eq & up) + up) ^ up) | eq | down
            ph, mh = down | ~(x | up) & full, up & x
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
            ph = ph << 1 & full | whole
            mh = mh << 1 & full
            xv = eq | down
            up = mh | ~(xv | ph) & full
            down = ph & xv
            if score <= limit and (best is None or score < best[0]):
                best = (score, end)
        return best


class Matcher:
    """Finds items of one block in texts."""

    def __init__(self, items: list[tuple], rate: float):
        """``items``: item_id, text and, if more than one, the number of rows that hold them."""
        import ahocorasick

        self.items = []
        self.automaton = ahocorasick.Automaton()
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, text, *times in items:
            text = normal(text)
            if not text:
                continue
            limit = budget(len(text), rate)
            for offset, piece in cut(text, limit + 1):
                pieces.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((item_id, text, limit, times[0] if times else 1, Pattern(text), Pattern(text[::-1])))
        for piece, where in pieces.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item_id, distance, start, stop) of the best stretch for each item found; positions in the normal text."""
        if not self.items:
            return
        windows: dict[int, set[int]] = {}
        for last, (length, where) in self.automaton.iter(text):
            for item, offset in where:
                windows.setdefault(item, set()).add(last - length + 1 - offset)
        for item, starts in windows.items():
            item_id, pattern, limit, times, myers, backward = self.items[item]
            size = len(pattern)
            exact = [s for s in starts if s >= 0 and text.startswith(pattern, s)]
            if exact:
                yield from times * [(item_id, 0, min(exact), min(exact) + size)]
                continue
            best = None
            for a, b in _merged(sorted(starts), limit, size):
                a = max(0, a)
                hit = myers.best(text[a:b], limit)
                if hit and (best is None or hit[0] < best[0]):
                    best = (hit[0], a + hit[1])
            if best:
                distance, stop = best
                back = backward.best(text[max(0, stop - size - limit) : stop][::-1], limit, whole=True)
                yield from times * [(item_id, distance, stop - back[1], stop)]


def _merged(starts: list[int], limit: int, size: int) -> Iterator[tuple[int, int]]:
    """Stretches that hold every match whose item would begin within ``limit`` of one of ``starts``."""
    begin = end = None
    for s in starts:
        a, b = s - limit, s + size + limit
        if begin is None:
            begin, end = a, b
        elif a <= end:
            end = max(end, b)
        else:
            yield begin, end
            begin, end = a, b
    if begin is not None:
        yield begin, end


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = 0.05, id_col: str = "doc_id", text_col: str = "text", block_chars: int = 4_000_000) -> DataFrame:
    """(doc_id, item_id, distance, start, stop) for every item found in a whole text, with its best stretch: the least
    distance, then the leftmost end. Positions count characters of the normal text (lower case, single spaces).

    ``rate`` is the number of edits allowed for each character of an item. Items that are null or blank match nothing,
    null and empty texts hold nothing; repeated items and rows are all reported; null ids are kept. An empty table
    gives no rows. Items are broadcast in blocks of about ``block_chars`` characters, each against all texts. With several
    blocks they are worked off in turn: the driver and the executors hold one at a time, and its matches are written before
    the next one is read."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text")).where(F.col("text").isNotNull())
    items = items.groupBy("item_id", "text").agg(F.count("*").alias("times"))
    chars = items.agg(F.sum(F.length("text")).alias("n")).head()["n"] or 0
    blocks = max(1, -(-chars // block_chars))
    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col)).where(F.col(text_col).isNotNull())
    if blocks == 1:
        return arrow_map(texts, _search(_held(items), rate), MATCHES)
    items, found = stored(items), None
    for block in range(blocks):
        held = _held(items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block))
        one = stored(arrow_map(texts, _search(held, rate), MATCHES))
        held.destroy()
        found = one if found is None else found.unionByName(one)
    return found


def _held(items: DataFrame):
    """A broadcast of the (item_id, text, times) of one block."""
    return items.sparkSession.sparkContext.broadcast([tuple(r) for r in items.select("item_id", "text", "times").collect()])


def _search(held, rate: float):
    def make():
        matcher = Matcher(held.value, rate)

        def work(batch):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for item_id, distance, start, stop in matcher.find(normal(text)):
                    yield doc, item_id, distance, start, stop

        return work

    return make


def decontaminated(docs: DataFrame, benchmark: DataFrame, rate: float = 0.05) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item, whole rows with all columns. Rows with a null doc_id
    take no part and are kept."""
    dirty = matches(docs.where("doc_id is not null"), benchmark, rate).select(F.col("doc_id").alias("_dirty")).distinct()
    return docs.join(dirty, F.col("doc_id") == F.col("_dirty"), "left_anti")
