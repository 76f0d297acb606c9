"""Conversation repair against a plain search over (cost, letters), on whole tables, on odd rows and across ranges."""

import hashlib
import random
import re
import zlib

import pytest

from skyframe.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string, edit string, conv string"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out.setdefault(conv, []).extend([(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    return out


def audit(turns):
    """Every state's least (cost, letters), turn by turn."""
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1][:32], t[2][:64], t[2]))
    seen, faults = set(), []
    for _, role, text in turns:
        left = text.strip(BLANKS)
        faults.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else None)
        seen.add((role, text))
    nexts = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(2):
            for state, (cost, letters, said) in list(best.items()):
                to = nexts[state]
                new = (cost + 5, letters + "I", said + [names[to] + ":"])
                if to not in best or new < best[to]:
                    best[to] = new
        return best

    best = inserted({"": (0, "", [])})
    for (_, role, text), fault in zip(turns, faults):
        now = {}

        def offer(state, *new):
            if state not in now or new < now[state]:
                now[state] = new

        for state, (cost, letters, said) in best.items():
            offer(state, cost + 2, letters + "D", said)
            if fault in ("blank", "duplicate"):
                continue
            extra, to = 5 if fault else 0, nexts[state]
            if role[:1] == to or (role[:1] == "s" and state == ""):
                offer(role[:1], cost + extra, letters + "K", said + [f"{role}:{text}"])
            offer(to, cost + 1 + extra, letters + "R", said + [f"{names[to]}:{text}"])
        best = inserted(now)
    cost, letters, said = min(v for k, v in best.items() if k in ("", "a"))
    known = [t for t, _, _ in turns if t is not None]
    heads = [r[:1] for _, r, _ in turns]
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:])), cost, letters, hashlib.sha256("\n".join(said).encode()).hexdigest())


def expected(rows):
    after = damaged(rows)
    return {conv: audit(after.get(conv, [])) for conv in {r[0] for r in rows}}


def got(rows):
    return {r.conv_id: tuple(r)[1:] for r in rows.collect()}


def conversations(seed, n, most, heads=("system", "user", "assistant", "user", "assistant", "tool", "")):
    rng = random.Random(seed)
    said = ["Yes.", "No!", "Why?", "well", "", " \t", "so. ", None, "long " * 40 + "."]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, most)):
            rows.append((conv, turn + (turn > 3) * rng.randint(0, 2), rng.choice([*heads, None]), rng.choice(said) if rng.random() < 0.4 else f"say {rng.randint(0, 9999)}."))
    return rows


@pytest.mark.parametrize("seed", range(200))
def test_walk_is_the_ascii_least_of_the_cheapest(seed):
    rng = random.Random(seed)
    turns = [(rng.choice("suau-"), rng.choice([None, None, None, "blank", "duplicate", "truncated"])) for _ in range(rng.randint(0, 14))]
    best = {0: (0, "")}

    def inserted(best):
        for _ in range(2):
            for s, (cost, letters) in list(best.items()):
                to = cv.NEXT[s][0]
                best[to] = min(best.get(to, (999, "")), (cost + 5, letters + "I"))
        return best

    best = inserted(best)
    for head, fault in turns:
        now = {}
        for s, (cost, letters) in best.items():
            for letter, price, then in cv.moves(s, head, fault):
                now[then] = min(now.get(then, (9999, "")), (cost + price, letters + letter))
        best = inserted(now)
    want = min(v for s, v in best.items() if s in (cv.START, cv.ASSISTANT))
    steps = list(cv.walk(turns, cv.START, cv.END))
    last = steps[-1][2] if steps else cv.START
    assert want == (sum(s[1] for s in steps) + cv.END[last], "".join(s[0] for s in steps) + cv.finish(last))
    costs = cv.costs_between(turns)
    assert min(c + e for c, e in zip(costs[cv.START], cv.END)) == want[0]


def test_audits_of_random_conversations(spark):
    rows = conversations(3, 60, 9)
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    assert got(cv.audits(cv.damaged(frame), frame)) == expected(rows)


def test_one_conversation_over_many_ranges(spark, cut_keys):
    rows = conversations(5, 8, 6) + [(77, t // 3, r, x) for t, (_, _, r, x) in enumerate(conversations(6, 90, 9))]
    rows += [(None, t, r, x) for _, t, r, x in conversations(8, 1, 5)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(4)
    assert got(cv.audits(cv.damaged(frame), frame)) == expected(rows)


def test_odd_rows(spark, none):
    rows = [(1, None, None, None), (1, None, "user", "a."), (1, 5, "user", "a."), (None, None, None, None), (None, 3, "assistant", "ok"),
            (2, 1, "system", "s."), (3, 4, "user", "x" * 100_000), (3, 4, "user", "x" * 100_000), (4, -3, "assistant", " "), (4, 9, "user", "y!")]
    rows += [(5, 0, "user", "again.")] * 40 + [(6, t, "user", "again.") for t in range(30)]
    frame = spark.createDataFrame([(*r, None, "y") for r in rows], SCHEMA)
    assert got(cv.audits(cv.damaged(frame), frame)) == expected(rows)
    empty = frame.limit(0)
    assert cv.audits(cv.damaged(empty), empty).collect() == [] and cv.repaired(empty).collect() == []


def test_repaired_rows_alternate_and_match_the_audit(spark, cut_keys):
    rows = conversations(9, 30, 9) + [(40, t, r, x) for t, (_, _, r, x) in enumerate(conversations(10, 60, 9))]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    audits = {str(k): v for k, v in got(cv.audits(frame)).items()}
    edits = {}
    for r in sorted(cv.repaired(frame).collect(), key=lambda r: (r.conv_id, r.block, r.n, r.k)):
        edits.setdefault(r.conv_id, []).append(r)
    assert edits.keys() == audits.keys()
    for conv, rows in edits.items():
        kept = [r for r in rows if r.role is not None]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in kept))
        assert "".join(r.edit for r in rows) == audits[conv][6]
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in kept).encode()).hexdigest() == audits[conv][7]


def test_whole_table(spark):
    from skyframe.llm.plans import op13_conversation_repair

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(op13_conversation_repair(spark, "/root/testdata/sf0.001")) == expected(rows)
