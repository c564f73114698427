"""Conversation repair against a plain search over the states of the grammar."""

import hashlib
import random
import re
import zlib

import pytest

from veilframe.llm import turns
from veilframe.llm.turns import ASSISTANT, ENDS, START, STATES, SYSTEM, USER, aligned

NEXT = {START: "su", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
AT = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


def plain(rows, entry=START, exits=ENDS, last=True):
    """rows: (initial, forced, extra). The least (cost, audit) by way of all ways, and the exit."""
    n = len(rows)
    best = {}
    for i in range(n, -1, -1):
        # Two rounds of empty turns are enough: three lead back to where one began.
        here = {s: (exits[s], "", s) if i == n and s in exits else (10**9, "~", s) for s in STATES}
        if i < n:
            c, forced, extra = rows[i]
            for s in STATES:
                ways = [(best[s][0] + 2, "D" + best[s][1], best[s][2])]
                if not forced:
                    for to in NEXT[s]:
                        t = best[AT[to]]
                        if to == c:
                            ways.append((t[0] + extra, "K" + t[1], t[2]))
                        if to != "s":
                            ways.append((t[0] + extra + 1, "R" + t[1], t[2]))
                here[s] = min(ways)
        for _ in range(4 if i < n or last else 0):
            for s in STATES:
                for to in NEXT[s].replace("s", ""):
                    t = here[AT[to]]
                    here[s] = min(here[s], (t[0] + 5, "I" + t[1], t[2]))
        best = here
    return best[entry]


def numbers(rows):
    return [AT.get(c, START) for c, _, _ in rows], [f for _, f, _ in rows], [x for _, _, x in rows]


def some_rows(rng, n):
    return [(rng.choice("suuuaaax"), rng.random() < 0.15, rng.choice((0, 0, 0, 5))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(300))
def test_least_cost_and_first_audit(seed):
    rng = random.Random(seed)
    rows = some_rows(rng, rng.randint(0, 14))
    if not rows:
        return
    cost, audit, _ = aligned(*numbers(rows), (START,), ENDS, True)[START]
    assert (cost, audit) == plain(rows)[:2]


@pytest.mark.parametrize("seed", range(150))
def test_blocks_between_all_states(seed):
    rng = random.Random(seed)
    rows = some_rows(rng, rng.randint(1, 9))
    exits = {s: rng.randint(0, 12) for s in STATES if rng.random() < 0.8} or {USER: 0}
    found = aligned(*numbers(rows), STATES, exits, False)
    for entry in STATES:
        expected = plain(rows, entry, exits, False)
        assert found[entry][0] == expected[0] if expected[0] < 10**8 else found[entry][0] >= turns.FAR
        if expected[0] < 10**8:
            assert found[entry] == expected


def test_the_band_holds_long_conversations():
    rows = some_rows(random.Random(5), 700)
    assert aligned(*numbers(rows), (START,), ENDS, True)[START][:2] == plain_long(rows)


def plain_long(rows):
    import sys
    sys.setrecursionlimit(10_000)
    return plain(rows)[:2]


def digest(rows):
    """rows: (turn, role, text) of one conversation -> what the report says."""
    rows = sorted(((t, r, x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, lines, faults, costs = set(), [], [], []
    for _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        costs.append((role[:1], fault in ("blank", "duplicate"), 5 * (fault == "truncated")))
    cost, audit, _ = plain(costs)
    state, i = START, 0
    for letter in audit:
        if letter == "D":
            i += 1
            continue
        if letter == "I":
            state = AT[NEXT[state].replace("s", "")]
            lines.append(f"{turns.ROLES[state]}:")
            continue
        role, text = rows[i][1:]
        state = AT["s"] if letter == "K" and state == START and role[:1] == "s" else AT[NEXT[state].replace("s", "")]
        lines.append(f"{role if letter == 'K' else turns.ROLES[state]}:{text}")
        i += 1
    numbered = [t for t, _, _ in rows if t is not None]
    gaps = max(numbered) - min(numbered) + 1 - len(set(numbered)) if numbered else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain_report(rows):
    def text(x):
        return " " if x is None else x

    out = {}
    for conv, turn, role, said in rows:
        have = out.setdefault(conv, [])
        fault = zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        role, said = text(role), text(said)
        said = "" if fault == 1 else re.sub("[.!?]", "", said) if fault == 2 else said
        have += [(turn, "user" if fault == 4 else role, said)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return sorted(((c, *digest(r)) for c, r in out.items()), key=repr)


SCHEMA = "conv_id bigint, turn bigint, role string, text string, fault int, key string"


def conversations():
    rng = random.Random(11)
    rows = []
    for conv in [*range(60), None, 2**60 + 1]:
        for turn in range(rng.randint(1, 12)):
            role = rng.choice(["system", "user", "assistant", "tool", "", None]) if rng.random() < 0.2 else ("user", "assistant")[turn % 2]
            said = rng.choice(["Yes.", "No", " \n", None, "", "Why?  ", "a longer text, é.", "Yes."])
            rows.append((conv, None if rng.random() < 0.1 else turn + rng.choice([0, 0, 0, 4, 2**55]), role, said, 7, "x"))
    rows += rows[:40]
    rows += [(77, 0, "user", "x" * 50_000 + ".", 7, "x"), (78, None, None, None, 7, "x")]
    return rows


@pytest.mark.parametrize("block_turns", [1024, 3, 1])
def test_report_equals_the_plain_one(spark, block_turns):
    rows = conversations()
    report = turns.damage_and_repair(spark.createDataFrame(rows, SCHEMA), block_turns=block_turns)
    assert report.columns == ["conv_id", *turns.COUNTS, "audit", "repaired_sha256"]
    assert sorted(map(tuple, report.collect()), key=repr) == plain_report([r[:4] for r in rows])


def test_query_equals_the_plain_report(spark, sf_dir):
    from veilframe.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_conversation_repair"](spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=repr) == plain_report(rows) and len(got) > 10


def test_rows_of_a_block_in_several_files(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant"]), f"{rng.random()}" + rng.choice([".", ""])) for c in range(9) for t in range(40)]
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "6000"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = sorted(map(tuple, turns.damage_and_repair(spark.createDataFrame(rows, SCHEMA.split(", fault")[0])).collect()), key=repr)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == plain_report(rows)


def test_rows_of_a_turn_go_by_their_whole_texts(spark):
    rng = random.Random(3)
    rows = [(c, t // 3, rng.choice(["user", "assistant"]), "p" * rng.choice([70, 300]) + rng.choice("abcdefgh") + rng.choice([".", ""]))
            for c in range(20) for t in range(12)]
    report = turns.damage_and_repair(spark.createDataFrame(rows, SCHEMA.split(", fault")[0]))
    assert sorted(map(tuple, report.collect()), key=repr) == plain_report(rows)


def test_edits_by_turn(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Are you there?"), (1, 2, "assistant", "Yes."), (1, 2, "assistant", "Yes."), (1, 3, "assistant", " ")]
    done = turns.repaired(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    got = [(r.turn, r.edit, r.times, r.fault, r.new_role) for r in done.orderBy("place", "step").collect()]
    assert got == [(0, "D", 1, "", None), (1, "K", 1, "", "user"), (2, "K", 2, "", "assistant"), (3, "D", 1, "blank", None)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert turns.damage_and_repair(empty).count() == 0 and turns.repaired(empty).count() == 0
