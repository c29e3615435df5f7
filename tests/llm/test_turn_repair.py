"""Conversation repair: run-length walks against a plain forward programme, whole results against plain Python."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import turn_repair as tr

SPACE = " \t\n\v\f\r"


def cheapest(symbols):
    """Least ``(cost, audit)`` by trying every edit forwards; a symbol is (initial, truncated, must go)."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}

    def inserted(ways):
        for _ in range(3):
            for state, (cost, audit) in list(ways.items()):
                new = follow[state], (cost + 5, audit + "I")
                if new[0] not in ways or new[1] < ways[new[0]]:
                    ways[new[0]] = new[1]
        return ways

    ways = {"": (0, "")}
    for initial, truncated, must in symbols:
        after = {}

        def offer(state, cost, audit):
            if state not in after or (cost, audit) < after[state]:
                after[state] = cost, audit

        for state, (cost, audit) in inserted(ways).items():
            offer(state, cost + 2, audit + "D")
            if not must:
                if initial == follow[state] or (initial == "s" and state == ""):
                    offer(initial, cost + 5 * truncated, audit + "K")
                offer(follow[state], cost + 1 + 5 * truncated, audit + "R")
        ways = after
    ways = inserted(ways)
    return min(ways[s] for s in ("", "a") if s in ways)


def plain(rows):
    """{conv_id: report} of (conv_id, turn, role, text) rows."""
    chats = {}
    for conv, turn, role, text in rows:
        chats.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        role = "user" if fault == 4 else role
        chats[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    out = {}
    for conv, turns in chats.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        out[conv] = report(turns)
    return out


def report(turns):
    seen, symbols, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in turns:
        bare = text.strip(SPACE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        if fault:
            count[fault] += 1
        symbols.append((role[:1], fault == "truncated", fault in ("blank", "duplicate")))
    cost, audit = cheapest(symbols)
    lines, rows, state = [], iter(turns), ""
    for edit in audit:
        _, role, text = (None, "", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        state = role[0] if edit == "K" else "a" if state == "u" else "u"
        lines.append(f"{role if edit == 'K' else {'u': 'user', 'a': 'assistant'}[state]}:{text}")
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
    known = [t for t, _, _ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    return (gaps, *count.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def found(spark, rows):
    schema = "conv_id long, turn long, role string, text string"
    df = rows if not isinstance(rows, list) else spark.createDataFrame(rows, schema)
    turns, reports = tr.repair(tr.damaged(df))
    digests = {r["conv"]: r["repaired_sha256"] for r in tr.turn_digests(turns).collect()}
    names = "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    empty = hashlib.sha256(b"").hexdigest()
    return {r["conv"]: (*[r[n] for n in names], digests.get(r["conv"], empty)) for r in reports.collect()}


def kind_of(initial, truncated, must):
    return tr.MUST_GO if must else 2 * "sua".find(initial) + truncated if initial in "sua" else 6 + truncated


@pytest.mark.parametrize("blocks", [1, 3])
def test_walks(blocks):
    alphabet = [(i, t, False) for i in "suax" for t in (0, 1)] + [("u", 0, True)]
    rng = random.Random(4)
    cases = [list(c) for n in range(4) for c in itertools.product(alphabet, repeat=n)]
    cases += [rng.choices(alphabet, rng.choices(range(1, 9), k=9), k=rng.randrange(4, 40)) for _ in range(400)]
    cases += [[s for s in rng.choices(alphabet, k=4) for _ in range(rng.randrange(1, 30))] for _ in range(200)]
    for case in cases:
        cuts = sorted(rng.choices(range(len(case) + 1), k=blocks - 1))
        parts = [tr.runs([kind_of(*s) for s in case[a:b]], itertools.repeat(1)) for a, b in zip([0, *cuts], [*cuts, len(case)])]
        tails = [tr.FINISH]
        for part in reversed(parts[1:]):
            tails.append(tr.times(tr.transition(part), tails[-1]))
        whole, state = "", tr.EMPTY
        for k, part in enumerate(parts):
            audit, state = tr.unroll(part, tails[-1 - k], state, k == blocks - 1)
            whole += audit
        cost, expected = cheapest(case)
        assert whole == expected
        assert tr.times(tr.transition(parts[0]), tails[-1])[tr.EMPTY] == cost


def test_powers():
    for symbol in range(9):
        step = np.where(np.eye(4, dtype=bool), 0, tr.NEVER)
        for n in range(20):
            assert (tr.transition([(symbol, n)]) == step).all()
            assert (tr.advance(symbol, n, tr.FINISH) == tr.times(step, tr.FINISH)).all()
            step = tr.times(step, tr.power(symbol, 0))


ROLES = ["user", "assistant", "system", "tool", "", None, "umbrella"]
TEXTS = ["Yes.", "no", "Why? ", "", " \n", None, "ok!\t", "é。", "A long answer. And more", " "]


def chats(seed, n, turns):
    rng = random.Random(seed)
    out = []
    for conv in [None, *range(n)]:
        for turn in range(rng.randrange(1, turns)):
            role = rng.choice(ROLES) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            text = rng.choice(TEXTS) if rng.random() < 0.5 else f"word {rng.randrange(10**6)}{rng.choice(['.', '!', '', '? '])}"
            out.append((conv, None if rng.random() < 0.05 else turn + rng.randrange(3), role, text))
    return out + out[:3]


def test_small_conversations(spark):
    rows = chats(1, 60, 12)
    expected = {str(c) if c is not None else "null": v for c, v in plain(rows).items()}
    got = found(spark, rows)
    assert got == {c: v for c, v in expected.items() if c in got}
    assert all(v[:7] == (0, 0, 0, 0, 0, 0, "") for c, v in expected.items() if c not in got)


def test_hot_conversation(spark):
    rng = random.Random(7)
    rows = chats(2, 20, 9)
    rows += [(5, k, rng.choice(("user", "assistant", "tool")) if rng.random() < 0.4 else ("user", "assistant")[k % 2],
              "same." if rng.random() < 0.1 else f"t {k}{rng.choice('.!?x')}") for k in range(4000)]
    rows += [(6, 1, "user", "again and again.")] * 3000
    expected = {str(c) if c is not None else "null": v for c, v in plain(rows).items()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        assert tr._judged(tr.damaged(df)).filter("conv = '5'").select("block").distinct().count() > 2
        got = found(spark, df)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {c: v for c, v in expected.items() if c in got} and len(got["5"][6]) >= 3000


def test_turns_and_columns(spark):
    rows = [(1, 0, "user", "Hi.", "x", 1), (1, 1, "assistant", "Hello.", "y", 2), (1, 2, "user", "cut", "z", 3), (1, 3, "tool", "Out.", "z", 4)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string, block int")
    turns, report = tr.repair(df.withColumn("copies", F.lit(1)))
    assert [r["audit"] for r in report.collect()] == ["KKDD"]
    kept = turns.orderBy("block", "place").select("conv", "edit", "role", "text").collect()
    assert [tuple(r) for r in kept] == [("1", "K", "user", "Hi."), ("1", "K", "assistant", "Hello.")]
    turns, report = tr.repair(df.limit(0).withColumn("copies", F.lit(1)))
    assert turns.count() == report.count() == tr.turn_digests(turns).count() == 0
    long = "many words " * 300_000 + "."
    rows = [(3, 0, "system", long), (3, 1, "user", "a."), (3, 2, "assistant", long)]
    assert found(spark, rows)["3"] == plain(rows)[3]


def test_query(spark, sf):
    columns = "conv_id", "turn", "role", "text"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select(*columns).collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in tr.op12_conversation_repair(spark, sf).collect()}
    assert got == plain(rows)
