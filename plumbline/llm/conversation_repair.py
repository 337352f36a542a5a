"""Repair of the turn structure of conversations by Knuth's lightest-derivation agenda.

A repaired conversation is an optional system turn and then pairs of a user and an assistant turn, or nothing. That is an
automaton of four states (none yet, after system, after user, after assistant). An item ``(rows, from, to)`` says that a
stretch of rows leads from one state to another; its weight is (cost, audit), the audit being the initials of the edits
(Delete, Insert, Keep, Rerole). One row, or one inserted turn, is an axiom. Two items that meet in a row and a state
deduce the item of both stretches: costs add up, audits are joined.

The agenda pops items by (cost, rows read, audit). Every deduction is superior in this order: it costs at least as much
as its parts, and where it costs nothing it reads one more row, so a popped item is final. It is monotone as well: audits
of one stretch with the same cost are never beginnings of one another (each row gives one letter, further letters are
insertions and cost something), so a part that comes first by ASCII order stays first in whatever is built from it.

Rows are put in order by a range shuffle, so even one huge conversation is dealt over many tasks. Tasks finalise the 16
items of stretches of at most 1,024 rows; the goal item of a conversation is deduced from those of its stretches, which
are streamed in order. Only the digest of the repaired text, a SHA-256 over the whole, has to read the rows of a
conversation one after the other; it streams them in order and holds one row at a time and the audit.
"""

from __future__ import annotations

import hashlib
import heapq
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import grouped_map, stored, streamed

# Costs of the edits, and what an undeleted truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# Faults, first match counts.
SOUND, BLANK, DUPLICATE, CUT = 0, 1, 2, 3

# States: none yet, after system, after user, after assistant. The role initials that lead on from each, and the state
# and role of the one user or assistant turn that may follow.
_STATES = range(4)
_KEEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_NEXT = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))
_GOALS = (0, 3)
# The initials of neighbours that need no repair.
LEGAL = ("su", "ua", "au")
# Rows of a stretch, as a power of two.
_STRETCH = 10

Weight = tuple[int, str]


def edits(state: int, initial: str, fault: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of one row in a state."""
    out = [("D", DELETE, state)]
    if fault not in (BLANK, DUPLICATE):
        more = TRUNCATED if fault == CUT else 0
        if initial in _KEEP[state]:
            out.append(("K", more, _KEEP[state][initial]))
        else:
            out.append(("R", REROLE + more, _NEXT[state][0]))
    return out


def finalised(rows: list[tuple[str, int]], start: int, goals: tuple[int, ...] = tuple(_STATES)) -> dict[int, Weight]:
    """Weight of the item of all ``rows`` (initial, fault) from ``start`` to each state of ``goals``."""
    agenda: list[tuple[int, int, str, int]] = [(0, 0, "", start)]
    final: set[tuple[int, int]] = set()
    found: dict[int, Weight] = {}
    while agenda and len(found) < len(goals):
        cost, read, audit, state = heapq.heappop(agenda)
        if (read, state) in final:
            continue
        final.add((read, state))
        if read == len(rows):
            if state in goals:
                found[state] = (cost, audit)
        else:
            for letter, more, to in edits(state, *rows[read]):
                if (read + 1, to) not in final:
                    heapq.heappush(agenda, (cost + more, read + 1, audit + letter, to))
        to = _NEXT[state][0]
        if (read, to) not in final:
            heapq.heappush(agenda, (cost + INSERT, read, audit + "I", to))
    return found


class Deduction:
    """The items from the first row of a conversation to each state, extended stretch by stretch.

    The beginning that all their audits share is put aside, so that comparing them stays cheap in a long conversation."""

    def __init__(self):
        self.shared: list[str] = []
        self.items: dict[int, Weight] = {0: (0, "")}

    def add(self, stretch: dict[tuple[int, int], Weight]) -> None:
        agenda = []
        for start, (cost, audit) in self.items.items():
            agenda += [(cost + more, audit + rest, to) for (a, to), (more, rest) in stretch.items() if a == start]
        heapq.heapify(agenda)
        self.items = {}
        while agenda:
            cost, audit, to = heapq.heappop(agenda)
            self.items.setdefault(to, (cost, audit))
        common = os.path.commonprefix([a for _, a in self.items.values()])
        if common:
            self.shared.append(common)
            self.items = {q: (c, a[len(common) :]) for q, (c, a) in self.items.items()}

    def goal(self) -> Weight:
        cost, audit = min(self.items[q] for q in _GOALS if q in self.items)
        return cost, "".join(self.shared) + audit


def turns(rows, audit: str):
    """(role, text) of every repaired turn, from (role, text) of the rows in order and the audit."""
    letters = iter(audit)
    state = 0
    for role, text in rows:
        letter = next(letters)
        while letter == "I":
            state, inserted = _NEXT[state]
            yield inserted, ""
            letter = next(letters)
        if letter == "K":
            state = _KEEP[state][role[:1]]
            yield role, text
        elif letter == "R":
            state, role = _NEXT[state]
            yield role, text
    for _ in letters:
        state, inserted = _NEXT[state]
        yield inserted, ""


def _rank(role: str, text: str) -> Column:
    """Order of the rows of one turn: by role, then text, of which the first 64 characters count, then by a digest of
    both: bounds of the range shuffle stay short whatever the texts are."""
    return F.struct(F.left(role, F.lit(64)), F.left(text, F.lit(64)), F.sha2(F.concat(role, F.lit(":"), text), 256)).alias("order")


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with one of five faults put in by crc32(``conv_id:turn``) % 20, each null
    taken as one space: 0 drops the row, 1 empties its text, 2 takes out ``[.!?]``, 3 repeats it, 4 makes it a user's.
    ``rank`` tells what stood first among rows of one turn, see ``_rank``; then the copy."""
    blank = F.lit(" ")
    role, text = F.coalesce(F.col("role").cast("string"), blank), F.coalesce(F.col("text").cast("string"), blank)
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    code = (F.crc32(name) % 20).cast("int")
    base = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role0"), text.alias("text0"), code.alias("code")).where("code <> 0")
    copies = base.withColumn("copy", F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    changed_text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text0", "[.!?]", "")).otherwise(F.col("text0"))
    changed_role = F.when(F.col("code") == 4, "user").otherwise(F.col("role0"))
    return copies.select("conv_id", "turn", changed_role.alias("role"), changed_text.alias("text"), F.struct(_rank("role0", "text0"), "copy").alias("rank"))


def ordered(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``at``, numbers that grow along each conversation: by turn, null ones first, then by
    ``rank``. A range shuffle puts the rows in order; a conversation may lie in several tasks."""
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("rank").asc(), F.col("own").asc()]
    # Rows that are equal in all of these may go to several tasks too.
    placed = rows.withColumn("own", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stored(placed.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("at")))


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` of ``ordered`` with ``fault``: blank, else a copy of an earlier row, else truncated, else sound."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    said = rows.where(~blank).groupBy("conv_id", "role", "text").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Only rows said more than once are on the right side, one for each; hot ones can be split on the left.
    again = stored(said.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("text").alias("_text"), "first"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("text") == F.col("_text"))
    joined = rows.join(again, same, "left")
    ends = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(blank, BLANK).when(F.col("at") > F.col("first"), DUPLICATE).when(~ends, CUT).otherwise(SOUND)
    return joined.select("conv_id", "turn", "role", "text", "at", fault.alias("fault"))


def stretches(rows: DataFrame) -> DataFrame:
    """One row for each stretch of a conversation: its place, illegal neighbours, first and last initial, and its items
    as (from, to, cost, audit)."""
    bits = rows.select("conv_id", F.shiftright("at", _STRETCH).alias("stretch"), "at", F.substring("role", 1, 1).alias("initial"), "fault")

    def make():
        def work(table):
            conv, stretch = table.column("conv_id")[0].as_py(), table.column("stretch")[0].as_py()
            initials, kinds = table.column("initial").to_pylist(), table.column("fault").to_pylist()
            rows = list(zip(initials, kinds))
            illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
            items = [(a, b, cost, audit) for a in _STATES for b, (cost, audit) in finalised(rows, a).items()]
            yield conv, stretch, illegal, initials[0], initials[-1], items

        return work

    schema = f"conv_id {_type_of(rows, 'conv_id')}, stretch bigint, illegal bigint, head string, tail string, items array<struct<start: int, stop: int, cost: bigint, audit: string>>"
    return grouped_map(bits, ["conv_id", "stretch"], make, schema, ("at",))


def _type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def goals(parts: DataFrame) -> DataFrame:
    """conv_id, illegal, cost and audit of every conversation, from its stretches in order."""

    def make():
        def work(conv, rows):
            whole, illegal, tail = Deduction(), 0, None
            for _, _, inside, head, last, items in rows:
                illegal += inside + (tail is not None and tail + head not in LEGAL)
                tail = last
                whole.add({(i["start"], i["stop"]): (i["cost"], i["audit"]) for i in items})
            cost, audit = whole.goal()
            yield conv, illegal, cost, audit

        return work

    return streamed(parts, "conv_id", ("stretch",), make, f"conv_id {_type_of(parts, 'conv_id')}, illegal bigint, cost bigint, audit string")


def _digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id and SHA-256 of the repaired text; each conversation's audit comes before its rows."""
    lead = audits.select("conv_id", F.lit(-1).cast("long").alias("at"), F.lit("").alias("role"), F.col("audit").alias("text"))

    def make():
        def work(conv, rows):
            audit = next(rows)[3]
            digest, first = hashlib.sha256(), True
            for role, text in turns(((r[2], r[3]) for r in rows), audit):
                digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                first = False
            yield conv, digest.hexdigest()

        return work

    return streamed(rows.select("conv_id", "at", "role", "text").unionByName(lead), "conv_id", ("at",), make, f"conv_id {_type_of(rows, 'conv_id')}, repaired_sha256 string")


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, turn (from 0), role and text of every repaired conversation of ``rows`` (conv_id, turn, role, text), which
    are taken as they are. Conversations whose cheapest repair is empty have no rows. Null roles and texts count as one
    space. An empty table gives no rows; other columns are left out."""
    blank = F.lit(" ")
    plain = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role"), blank).alias("role"), F.coalesce(F.col("text"), blank).alias("text"))
    marked = stored(faults(ordered(plain.withColumn("rank", _rank("role", "text")))))
    lead = goals(stretches(marked)).select("conv_id", F.lit(-1).cast("long").alias("at"), F.lit("").alias("role"), F.col("audit").alias("text"))

    def make():
        def work(conv, rows):
            audit = next(rows)[3]
            for k, (role, text) in enumerate(turns(((r[2], r[3]) for r in rows), audit)):
                yield conv, k, role, text

        return work

    return streamed(marked.select("conv_id", "at", "role", "text").unionByName(lead), "conv_id", ("at",), make, f"conv_id {_type_of(marked, 'conv_id')}, turn bigint, role string, text string")


def audited(conversations: DataFrame) -> DataFrame:
    """What is wrong with every conversation after ``damaged``, and its cheapest repair: conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit and repaired_sha256.

    gaps: turns missing between the smallest and the largest. Each row counts for its first fault. illegal: neighbours
    whose role initials are none of su, ua, au. cost and audit: the cheapest edits, of equal ones those whose initials
    come first in ASCII order. A conversation that lost all its rows has zeros, an empty audit and the digest of nothing.
    A null conv_id is a conversation like any other. Repeated rows stand beside each other, so all but the first are
    duplicates. Rows of one turn are ordered by role, then text (``_rank``). An empty table gives no rows."""
    marked = stored(faults(ordered(damaged(conversations))))
    audits = stored(goals(stretches(marked)))
    turns_of = marked.select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count("turn").alias("turns"))
    counts = marked.groupBy("conv_id").agg(*[F.sum((F.col("fault") == k).cast("long")).alias(name) for k, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (CUT, "truncated"))])
    out = conversations.select("conv_id").distinct()
    for part in (turns_of, counts, audits, _digests(marked, audits)):
        named = part.withColumnRenamed("conv_id", "_conv")
        out = out.join(named, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    zero = F.lit(0).cast("long")
    numbers: list[Column] = [F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), zero).alias("gaps")]
    numbers += [F.coalesce(c, zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
