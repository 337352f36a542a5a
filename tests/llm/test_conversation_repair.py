import hashlib
import random
import re
import zlib

import pytest

from plumbline.llm import conversation_repair as cr
from plumbline.llm.queries import op12_conversation_repair

GRAMMAR = re.compile("(s?(ua)+)?")


def damage(rows):
    """Rows of each conversation after the damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        kept = out.setdefault(conv, [])
        if code == 0:
            continue
        key = (turn is not None, turn or 0, role, text)
        new_text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        kept += [(*key, k, turn, "user" if code == 4 else role, new_text) for k in range(2 if code == 3 else 1)]
    return {c: [r[5:] for r in sorted(v, key=lambda r: r[:5])] for c, v in out.items()}


def fault_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, audit, turns) of the cheapest repair: every sequence of edits, no cheaper prefix to the same roles left out
    but by what any finite search has to bound: at most two insertions in a row."""
    best = {"": (0, "", ())}  # by role initials read so far
    best = _insertions({"": [(0, "", ())]})
    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for roles, options in best.items():
            for cost, audit, made in options:
                more = 3 if fault == "truncated" else 0
                after.setdefault(roles, []).append((cost + 4, audit + "D", made))
                if fault in ("blank", "duplicate"):
                    continue
                after.setdefault(roles + role[:1] if role[:1] else roles + "?", []).append((cost + more, audit + "K", (*made, (role, text))))
                for new in ("user", "assistant"):
                    after.setdefault(roles + new[0], []).append((cost + 3 + more, audit + "R", (*made, (new, text))))
        best = _insertions({k: _least(v) for k, v in after.items() if _begins(k)})
    return min(o for roles, options in best.items() if GRAMMAR.fullmatch(roles) for o in options)


def _least(options):
    return [min(options)]


def _begins(roles):
    return any(GRAMMAR.fullmatch(roles + rest) for rest in ("", "a", "ua"))


def _insertions(best):
    for _ in range(2):
        grown = {k: list(v) for k, v in best.items()}
        for roles, options in best.items():
            for cost, audit, made in options:
                for new in ("user", "assistant"):
                    if _begins(roles + new[0]):
                        grown.setdefault(roles + new[0], []).append((cost + 3, audit + "I", (*made, (new, ""))))
        best = {k: _least(v) for k, v in grown.items()}
    return best


def expected(rows):
    out = {}
    for conv, kept in damage(rows).items():
        faults = fault_of(kept)
        cost, audit, made = cheapest(kept, faults)
        turns = sorted({t for t, _, _ in kept if t is not None})
        initials = [r[:1] for _, r, _ in kept]
        text = "\n".join(f"{r}:{t}" for r, t in made)
        out[conv] = (
            turns[-1] - turns[0] + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


def conversations(rng, count):
    rows = []
    for c in range(count):
        for turn in range(rng.randint(1, 9)):
            if rng.random() < 0.9:
                role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None])
                rows.append((c, rng.choice([turn] * 9 + [None]), role, rng.choice(["Yes.", "No", "Why?", "", " \t", None, "Ä\x1c!", f"text {turn}.", "Stop! "])))
    return rows


def test_against_every_repair(spark):
    rng = random.Random(12)
    rows = conversations(rng, 400)
    rows += [(None, 0, "user", "Hi."), (None, 1, "assistant", "Hello."), (900, None, "user", "a."), (900, None, "assistant", "b.")]
    rows += [(901, 3, "user", "Same."), (901, 3, "user", "Same."), (901, 4, "assistant", "x" * 100_000 + ".")]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, cost int, rank string")
    out = cr.audited(frame)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = [(r[0], tuple(r)[1:]) for r in out.collect()]
    want = expected(rows)
    assert len(got) == len(want) and dict(got) == want
    assert cr.audited(frame.limit(0)).collect() == []


def test_registered_query_on_the_table(spark, data):
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r[0]: tuple(r)[1:] for r in op12_conversation_repair(spark, data).collect()} == expected(rows)


@pytest.mark.parametrize("size", [1, 3, 7])
def test_stretches_deduce_what_one_agenda_does(size):
    rng = random.Random(size)
    for _ in range(300):
        rows = [(rng.choice(["u", "a", "s", "x", ""]), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 40))]
        whole = cr.Deduction()
        for i in range(0, len(rows), size):
            whole.add({(a, b): w for a in range(4) for b, w in cr.finalised(rows[i : i + size], a).items()})
        assert whole.goal() == min(cr.finalised(rows, 0, (0, 3)).values())


def test_one_long_conversation_is_dealt_over_stretches(spark):
    rng = random.Random(4)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice([f"turn {t}.", "again.", "cut", ""])) for t in range(5000)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    marked = cr.faults(cr.ordered(frame.withColumn("rank", cr.F.lit(0))))
    parts = cr.stretches(marked)
    assert parts.count() >= 5
    codes = [(r.role[:1], r.fault) for r in marked.orderBy("at").collect()]
    row = cr.goals(parts).collect()[0]
    assert (row.cost, row.audit) == min(cr.finalised(codes, 0, (0, 3)).values())


def test_repaired_turns(spark):
    frame = spark.createDataFrame([(1, 0, "system", "S."), (1, 1, "assistant", "Lone."), (1, 2, "user", "Q?"), (2, 0, None, None), (3, None, "user", "Q?"), (3, 1, "tool", "A.")], "conv_id bigint, turn bigint, role string, text string")
    got = sorted(map(tuple, cr.repaired(frame).collect()))
    assert got[:5] == [(1, 0, "system", "S."), (1, 1, "user", ""), (1, 2, "assistant", "Lone."), (1, 3, "user", "Q?"), (1, 4, "assistant", "")]
    assert got[5:] == [(3, 0, "user", "Q?"), (3, 1, "assistant", "A.")]  # conversation 2 was blank
