"""Best-fit packing of documents into sequences of a fixed number of tokens.

Sequences depend on piece lengths only, and there are at most ``capacity`` different lengths whatever the size of the
corpus. So the lengths are counted on the cluster, a plan of fillings with multiplicities is made from those counts, and
every piece takes its place by its rank among the pieces of its length.

The plan: best fit decreasing gives the incumbent. Bin completion then looks for a plan with fewer sequences: take the
largest length left, enumerate the fillings around it that no other filling dominates, take a filling as often as the
counts allow, and give a branch up when the space it has wasted leaves too little for the incumbent to be beaten.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import arrow_map, stored
from plumbline.llm.tokens import encoder

Filling = tuple[int, ...]  # lengths in one sequence, largest first

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"


def pieces(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of every document: doc_id, piece, start, length and ``ids`` (unsigned 32-bit, little-endian).

    A document is the ids of its text and ``end_id``. One that is longer than ``capacity`` is cut; all its pieces but
    the first are full. A null text counts as empty (one piece holding ``end_id``); null doc_ids and repeated rows are
    kept; an empty table gives no rows; other columns are left out."""
    if capacity < 1:
        raise ValueError("capacity must be positive")

    def make():
        bpe = encoder(path)

        def work(batch):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = bpe.ids(text or "")
                ids.append(end_id)
                packed = struct.pack(f"<{len(ids)}I", *ids)
                first = len(ids) % capacity or capacity
                start, end, number = 0, first, 0
                while start < len(ids):
                    yield doc, number, start, end - start, packed[4 * start : 4 * end]
                    start, end, number = end, end + capacity, number + 1

        return work

    return arrow_map(docs.select(F.col(id_col).cast("long"), F.col(text_col)), make, PIECES)


def best_fit(counts: dict[int, int], capacity: int) -> Counter[Filling]:
    """Best fit decreasing over counted lengths. Equal sequences are handled together, so the time depends on the number
    of different lengths, not on that of pieces."""
    open_bins: dict[int, Counter[Filling]] = {}
    done: Counter[Filling] = Counter()

    def put(filling: Filling, number: int) -> None:
        left = capacity - sum(filling)
        if left:
            open_bins.setdefault(left, Counter())[filling] += number
        else:
            done[filling] += number

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            space = min((s for s in open_bins if s >= length), default=None)
            if space is None:
                each = min(capacity // length, left)
                put((length,) * each, left // each)
                left %= each
                continue
            bins = open_bins[space]
            filling = min(bins)
            each = min(space // length, left)
            number = min(bins[filling], left // each)
            bins[filling] -= number
            if not bins[filling]:
                del bins[filling]
            if not bins:
                del open_bins[space]
            put(filling + (length,) * each, number)
            left -= each * number
    for bins in open_bins.values():
        done.update(bins)
    return done


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No plan has fewer sequences: all tokens need space, and above half the capacity no two pieces share one; pieces
    too large to stand beside a piece of at least ``small`` leave space that those cannot use."""
    best = -(-sum(n * c for n, c in counts.items()) // capacity)
    for small in {0, *(n for n in counts if 2 * n <= capacity)}:
        alone = sum(c for n, c in counts.items() if n > capacity - small)
        shared = sum(c for n, c in counts.items() if capacity < 2 * n and n <= capacity - small)
        space = shared * capacity - sum(n * c for n, c in counts.items() if capacity < 2 * n and n <= capacity - small)
        rest = sum(n * c for n, c in counts.items() if small <= n and 2 * n <= capacity)
        best = max(best, alone + shared + max(0, -(-(rest - space) // capacity)))
    return best


def fillings(largest: int, counts: dict[int, int], capacity: int, waste: int, width: int = 16) -> list[Filling]:
    """Undominated ways to fill a sequence around ``largest`` with at most ``waste`` tokens left, least waste first.

    A filling is dominated if a piece fits into what it leaves, or if one of its pieces can be exchanged for a larger
    one that fits: the other filling then leaves only smaller pieces to place."""
    lengths = sorted((n for n in counts if counts[n]), reverse=True)
    found: list[tuple[int, Filling]] = []
    steps = [200 * width]

    def undominated(filling: Filling, left: int) -> bool:
        used = Counter(filling)
        free = [n for n in lengths if counts[n] > used[n]]
        if any(n <= left for n in free):
            return False
        return not any(x < n <= x + left for x in set(filling[1:]) for n in free)

    def extend(filling: Filling, left: int, start: int) -> None:
        steps[0] -= 1
        if steps[0] < 0 or len(found) >= 4 * width:
            return
        if left <= waste and undominated(filling, left):
            found.append((left, filling))
        if not left:
            return
        for i in range(start, len(lengths)):
            n = lengths[i]
            if n <= left and counts[n] > filling.count(n):
                extend(filling + (n,), left - n, i)

    extend((largest,), capacity - largest, 0)
    return [f for _, f in sorted(found, key=lambda x: (x[0], len(x[1]), x[1]))[:width]]


def complete_bins(counts: dict[int, int], capacity: int, effort: int = 100_000) -> Counter[Filling]:
    """Plan with as few sequences as bin completion finds in ``effort`` / (number of lengths) branchings; the search ends
    there with the best plan so far, which is never worse than best fit.

    Every length must be from 1 to ``capacity``."""
    counts = {n: c for n, c in counts.items() if c}
    nodes = max(50, effort // max(1, len(counts)))
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError("a length is not between 1 and the capacity")
    best = best_fit(counts, capacity)
    bound = lower_bound(counts, capacity)
    best_size = sum(best.values())
    total = sum(n * c for n, c in counts.items())
    left = dict(counts)
    chosen: list[tuple[Filling, int]] = []
    used = wasted = 0

    def children() -> Iterator[tuple[Filling, int]]:
        largest = max(left)
        allowed = (best_size - 1) * capacity - total - wasted
        if allowed < 0:
            return
        for filling in fillings(largest, left, capacity, allowed):
            each = Counter(filling)
            often = min(left[n] // c for n, c in each.items())
            waste = capacity - sum(filling)
            if waste:
                often = min(often, allowed // waste)
            yield filling, often
            if often > 1:
                yield filling, 1

    stack: list[Iterator[tuple[Filling, int]]] = [children()] if left and best_size > bound else []
    while stack and best_size > bound and nodes:
        nodes -= 1
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if chosen:
                filling, often = chosen.pop()
                for n in filling:
                    left[n] = left.get(n, 0) + often
                used -= often
                wasted -= often * (capacity - sum(filling))
            continue
        filling, often = step
        for n in filling:
            left[n] -= often
            if not left[n]:
                del left[n]
        used += often
        wasted += often * (capacity - sum(filling))
        chosen.append(step)
        if not left:
            if used < best_size:
                best, best_size = _counted(chosen), used
            stack.append(iter(()))
            continue
        # The rest may also be packed best-fit; often that already is a better plan.
        rest = best_fit(left, capacity)
        if used + sum(rest.values()) < best_size:
            best = _counted(chosen) + rest
            best_size = sum(best.values())
        stack.append(children())
    return best


def _counted(chosen: list[tuple[Filling, int]]) -> Counter[Filling]:
    out: Counter[Filling] = Counter()
    for filling, often in chosen:
        out[filling] += often
    return out


def places(plan: Counter[Filling]) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, rank_from, rank_to, sequence, offset): the pieces of that length with these ranks go to the
    sequences from ``sequence`` on, at that offset."""
    taken: Counter[int] = Counter()
    rows, sequence = [], 0
    for filling, number in sorted(plan.items(), reverse=True):
        offset = 0
        for n in filling:
            rows.append((n, taken[n], taken[n] + number, sequence, offset))
            taken[n] += number
            offset += n
        sequence += number
    return rows


_RUN = 1_000  # groups whose sizes are added up by one task


def pack(parts: DataFrame, capacity: int = 1024, salt_rows: int = 500) -> DataFrame:
    """``parts`` (doc_id, piece, length and any other columns) with ``sequence_id`` and ``offset``.

    Pieces of one length are ranked in salted groups of about ``salt_rows``, so a length that holds a third of all
    pieces is spread over the cluster, whatever their ids: rows are numbered as they are stored, and the salts are drawn
    from these numbers, so null and repeated ids are spread as well. Pieces with equal ids are told apart by their
    number; an empty table stays empty. Columns named sequence_id or offset are replaced."""
    names = [c for c in parts.columns if c not in ("sequence_id", "offset")]
    parts = stored(parts.select(*[F.col(f"`{c}`") for c in names], F.monotonically_increasing_id().alias("_row")))
    counted = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    spark = parts.sparkSession
    plan = complete_bins(counted, capacity)
    table = spark.createDataFrame(places(plan), "_length bigint, _from bigint, _to bigint, _sequence bigint, _offset bigint")
    salts = spark.createDataFrame([(n, -(-c // salt_rows)) for n, c in counted.items()], "_of bigint, _salts bigint")
    salted = parts.join(F.broadcast(salts), F.col("length") == F.col("_of")).withColumn("_salt", F.pmod(F.xxhash64("_row"), F.col("_salts")))
    # Pieces in the groups before: running sums over runs of groups first, then within each run, so that no task holds
    # all groups of a length.
    sizes = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")).withColumn("_run", F.floor(F.col("_salt") / _RUN))
    runs = sizes.groupBy("length", "_run").agg(F.sum("_n").alias("_in_run"))
    runs = runs.withColumn("_earlier", F.sum("_in_run").over(Window.partitionBy("length").orderBy("_run")) - F.col("_in_run"))
    within = F.sum("_n").over(Window.partitionBy("length", "_run").orderBy("_salt")) - F.col("_n")
    before = (
        sizes.withColumn("_within", within)
        .join(runs.drop("_in_run"), ["length", "_run"])
        .select(F.col("length").alias("_len"), F.col("_salt").alias("_salted"), (F.col("_earlier") + F.col("_within")).alias("_before"))
    )
    in_group = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "_row")
    ranked = (
        salted.withColumn("_rank", F.row_number().over(in_group) - 1)
        .join(before, (F.col("length") == F.col("_len")) & (F.col("_salt") == F.col("_salted")))
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
    )
    # A row for each slot of a filling: a few thousand whatever the corpus, so it may be broadcast.
    placed = ranked.join(F.broadcast(table), (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    return placed.select(*[F.col(f"`{c}`") for c in names], (F.col("_sequence") + F.col("_rank") - F.col("_from")).alias("sequence_id"), F.col("_offset").alias("offset"))


def packed(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Every piece with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    parts = pieces(docs, path, capacity, end_id).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(parts, capacity)
