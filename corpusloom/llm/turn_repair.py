"""Repair of conversation structure: cheapest edits by a run-length dynamic programme over min-plus transitions."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from corpusloom.llm.common import store, table
from corpusloom.operators.joins import hot_keys, left_lookup

# What the edits cost, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SPACES = " \t\n\x0b\x0c\r"
# States: nothing put out, after a system turn, after a user turn, after an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
# What a user or assistant turn leads to from each state: the turn that may come next.
NEXT = (USER, USER, ASSISTANT, USER)
ENDS = (EMPTY, ASSISTANT)
# Symbols: twice the role class (system, user, assistant, other) plus one if truncated; rows that must go.
MUST_GO = 8
NEVER = 1 << 60
# Pieces of repaired text that one row carries to its digest, in turns.
PIECE = 256


def keep_to(state: int, role: int) -> int | None:
    """The state after a kept row of this role class, or None where the pattern forbids it."""
    if role == 0:
        return SYSTEM if state == EMPTY else None
    return role + 1 if role < 3 and NEXT[state] == role + 1 else None


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The min-plus product of two matrices, or of a matrix and a vector."""
    total = a[:, :, None] + b[None, :, :] if b.ndim == 2 else a + b[None, :]
    return np.minimum(total.min(axis=1), NEVER)


def _insertions() -> np.ndarray:
    found = np.full((4, 4), NEVER, np.int64)
    for state in range(4):
        at, cost = state, 0
        for _ in range(3):
            found[state, at] = min(found[state, at], cost)
            at, cost = NEXT[at], cost + INSERT
    return found


INSERTIONS = _insertions()
FINISH = INSERTIONS[:, list(ENDS)].min(axis=1)
_powers: dict[tuple[int, int], np.ndarray] = {}


def edits(symbol: int) -> list[tuple[str, int, list[int | None]]]:
    """``(initial, cost, state after each state)`` of what may be done to a row, in ASCII order."""
    found = [("D", DELETE, [EMPTY, SYSTEM, USER, ASSISTANT])]
    if symbol != MUST_GO:
        more = TRUNCATED * (symbol & 1)
        found.append(("K", KEEP + more, [keep_to(s, symbol >> 1) for s in range(4)]))
        found.append(("R", REROLE + more, list(NEXT)))
    return found


def power(symbol: int, digit: int) -> np.ndarray:
    """The transition of ``2**digit`` rows of a symbol, insertions before each included; kept for the next call."""
    known = _powers.get((symbol, digit))
    if known is None:
        if digit:
            half = power(symbol, digit - 1)
            known = times(half, half)
        else:
            single = np.full((4, 4), NEVER, np.int64)
            for _, cost, after in edits(symbol):
                for state, to in enumerate(after):
                    if to is not None:
                        single[state, to] = min(single[state, to], cost)
            known = times(INSERTIONS, single)
        _powers[symbol, digit] = known
    return known


def advance(symbol: int, count: int, tail: np.ndarray) -> np.ndarray:
    """The cheapest costs from each state before a run to the end, given those after it."""
    for digit in range(count.bit_length()):
        if count >> digit & 1:
            tail = times(power(symbol, digit), tail)
    return tail


def runs(kinds: Iterable[int], copies: Iterable[int]) -> list[tuple[int, int]]:
    """Equal consecutive symbols collapsed; all copies of a row after the first must go."""
    found: list[tuple[int, int]] = []
    for kind, n in zip(kinds, copies):
        for symbol, count in ((kind, 1), (MUST_GO, n - 1)):
            if found and found[-1][0] == symbol:
                found[-1] = symbol, found[-1][1] + count
            elif count:
                found.append((symbol, count))
    return found


def transition(parts: list[tuple[int, int]]) -> np.ndarray:
    """The transition of a whole block of runs."""
    whole = np.where(np.eye(4, dtype=bool), 0, NEVER)
    for symbol, count in reversed(parts):
        for digit in range(count.bit_length()):
            if count >> digit & 1:
                whole = times(power(symbol, digit), whole)
    return whole


def _inserted(audit: list[str], state: int, cost: np.ndarray) -> int | None:
    """The state after an insertion, if one is on a cheapest way; it is then written down."""
    if cost[state] < NEVER and cost[NEXT[state]] + INSERT == cost[state]:
        audit.append("I")
        return NEXT[state]
    return None


def unroll(parts: list[tuple[int, int]], tail: np.ndarray, state: int, last: bool) -> tuple[str, int]:
    """The ASCII-least cheapest edits of a block from ``state``, and the state after it.

    ``tail`` holds the cheapest costs after the block; at the ``last`` block of a conversation the
    closing insertions are written too. Costs at the ends of runs come from the powers; inside a run
    they are stepped back row by row, but for rows that must go: all but the last simply go.
    """
    ends = [tail]
    for symbol, count in reversed(parts):
        ends.append(advance(symbol, count, ends[-1]))
    audit: list[str] = []
    for (symbol, count), after_run in zip(parts, reversed(ends[:-1])):
        if symbol == MUST_GO and count > 1:
            audit.append("D" * (count - 1))
            count = 1
        costs = [after_run]
        for _ in range(count):
            costs.append(times(power(symbol, 0), costs[-1]))
        choices = edits(symbol)
        for left in range(count, 0, -1):
            done = False
            while not done:
                best, rest = costs[left], costs[left - 1]
                for initial, cost, after in choices:
                    to = after[state]
                    if to is not None and cost + rest[to] == best[state]:
                        # An insertion comes before K and R in ASCII order, and after D.
                        moved = _inserted(audit, state, best) if initial != "D" else None
                        if moved is None:
                            audit.append(initial)
                            state, done = to, True
                        else:
                            state = moved
                        break
                else:
                    state = _inserted(audit, state, best)
    while last and state not in ENDS:
        state = _inserted(audit, state, FINISH)
    return "".join(audit), state


def after_turn(edit: str, role: str, state: int) -> int:
    """The state after a turn that was kept, given another role or inserted."""
    return keep_to(state, "sua".index(role[0])) if edit == "K" else NEXT[state]


def apply_audit(audit: str, rows: Iterator[tuple[str, str]], state: int) -> Iterator[tuple[str, str, str]]:
    """``(edit, role, text)`` for every turn that stays or is new."""
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        state = after_turn(edit, role, state)
        yield edit, role if edit == "K" else "user" if state == USER else "assistant", text


def damaged(rows: DataFrame) -> DataFrame:
    """Turns with seeded faults: by crc32 of ``conv_id:turn`` modulo 20 dropped (0), emptied (1), without ``[.!?]`` (2),
    repeated (3) or given to the user (4). Nulls count as one space."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault = F.pmod(F.crc32(name), F.lit(20))
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"), fault.alias("fault"),
    ).filter("fault <> 0").drop("fault")


def _numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a partition with a block per conversation in it, and their place in the block."""
    block, place, current = TaskContext.get().partitionId() << 33, 0, None
    for batch in batches:
        blocks, places = [], []
        for conv in batch.column("conv").to_pylist():
            if conv != current:
                block, place, current = block + 1, 0, conv
            blocks.append(block)
            places.append(place)
            place += 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(blocks, pa.int64()), pa.array(places, pa.int64())],
            [*batch.schema.names, "block", "place"])


def _judged(rows: DataFrame) -> DataFrame:
    """Distinct rows with copies, role class, symbol and fault, in sorted blocks; stored."""
    blank = F.rtrim(F.col("text"), F.lit(SPACES)) == ""
    ended = F.substring(F.rtrim(F.col("text"), F.lit(SPACES)), -1, 1).isin(".", "!", "?")
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    rows = rows.groupBy(conv.alias("conv"), "turn", "role", "text").agg(F.sum("copies").cast("long").alias("n"))
    said = F.md5(F.concat(F.length("conv").cast("string"), F.lit(":"), F.length("role").cast("string"), F.lit(":"), "conv", "role", "text"))
    rows = rows.select("*", said.alias("said"), order.alias("order"))
    first = rows.groupBy("said").agg(F.min("order").alias("first"), F.count("*").alias("times"))
    hot = hot_keys(first.filter("times >= 1000"), "said", "times")
    rows = left_lookup(rows, first.select("said", "first"), "said", hot)
    fault = F.when(blank, "blank").when(F.col("order") != F.col("first"), "duplicate").when(~ended, "truncated").otherwise("")
    rows = rows.select("conv", "turn", "role", "text", "n", role.alias("class"), fault.alias("fault"))
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO).otherwise(
        F.col("class") * 2 + (F.col("fault") == "truncated").cast("int"))
    rows = rows.withColumn("kind", symbol.cast("int"))
    keys = "conv", "turn", "role", "text"
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return store(rows.mapInArrow(_numbered, f"{schema}, block long, place long"), "turns")


LEGAL = {(0, 1), (1, 2), (2, 1)}


def _grouped(df: DataFrame, key: str, order: list[str], function: Callable[[list[dict]], list[tuple]], kinds: dict[str, pa.DataType]) -> DataFrame:
    """``function`` from the rows of one key, in order, to rows; many small groups share a batch."""

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], list(kinds))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                if held and held[0][key] != row[key]:
                    out += function(held)
                    held = []
                held.append(row)
            yield rows(out)
        if held:
            yield rows(function(held))

    sorted_rows = df.repartition(key).sortWithinPartitions(key, *order)
    return sorted_rows.mapInArrow(run, from_arrow_schema(pa.schema(list(kinds.items()))))


def _summary(block: list[dict]) -> list[tuple]:
    classes, copies = [r["class"] for r in block], [r["n"] for r in block]
    illegal = sum(n - 1 for n in copies) + sum(pair not in LEGAL for pair in zip(classes, classes[1:]))
    whole = transition(runs([r["kind"] for r in block], copies))
    return [(block[0]["conv"], block[0]["block"], whole.ravel().tolist(), illegal, classes[0], classes[-1])]


def _tails(blocks: list[dict]) -> list[tuple]:
    """Costs after every block of a conversation, each with its total cost and illegal pairs."""
    illegal = sum(b["illegal"] for b in blocks)
    illegal += sum((a["last"], b["first"]) not in LEGAL for a, b in zip(blocks, blocks[1:]))
    tail, tails = FINISH, []
    for block in reversed(blocks):
        tails.append(tail.tolist())
        tail = times(np.array(block["moves"], np.int64).reshape(4, 4), tail)
    return [(b["conv"], b["block"], t, k, k == len(blocks) - 1, int(tail[EMPTY]), illegal)
            for k, (b, t) in enumerate(zip(blocks, reversed(tails)))]


def _walks(block: list[dict]) -> list[tuple]:
    """The edits of a block from every state it may be entered in."""
    row = block[0]
    parts, tail = runs([r["kind"] for r in block], [r["n"] for r in block]), np.array(row["tail"], np.int64)
    out = []
    for state in range(4) if row["number"] else [EMPTY]:
        audit, after = unroll(parts, tail, state, row["final"])
        out.append((row["conv"], row["block"], state, after, audit))
    return out


def _entered(walks: list[dict]) -> list[tuple]:
    """The state each block of a conversation is entered in."""
    leave = {(w["block"], w["enter"]): w["leave"] for w in walks}
    state, out = EMPTY, []
    for block in dict.fromkeys(w["block"] for w in walks):
        out.append((block, state))
        state = leave[block, state]
    return out


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns of whole blocks, whose rows come sorted; every block's audit stands on its first row."""
    current, audit, at, place, state = None, "", 0, 0, EMPTY
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["block"] != current:
                current, at, place, state, audit = row["block"], 0, 0, row["enter"], row["audit"]
            # The edits of this row's copies, with the insertions before each; after the last row, all that is left.
            end, seen = at, 0
            while end < len(audit) and (seen < row["n"] or row["final"]):
                seen += audit[end] != "I"
                end += 1
            for edit, role, text in apply_audit(audit[at:end], repeat((row["role"], row["text"])), state):
                state = after_turn(edit, role, state)
                out.append((row["conv"], row["block"], place, edit, role, text))
                place += 1
            at = end
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        columns = list(zip(*out)) or [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["conv", "block", "place", "edit", "role", "text"])


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per conversation from its pieces, which come sorted; nothing is gathered."""
    current = digest = None
    for batch in batches:
        done = []
        for conv, piece in zip(batch.column("conv").to_pylist(), batch.column("piece").to_pylist()):
            if conv != current:
                if digest is not None:
                    done.append((current, digest.hexdigest()))
                current, digest = conv, hashlib.sha256(piece.encode())
            else:
                digest.update(b"\n" + piece.encode())
        yield _digest_rows(done)
    if digest is not None:
        yield _digest_rows([(current, digest.hexdigest())])


def _digest_rows(done: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([c for c, _ in done], pa.string()), pa.array([d for _, d in done], pa.string())], ["conv", "repaired_sha256"])


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns after repair, and one report row per conversation, of ``(conv_id, turn, role, text, copies)``.

    Rows are taken by turn (nulls first), then role and text. Blank rows and those whose role and text
    were seen earlier must go; kept rows whose text does not end in ``.``, ``!`` or ``?`` cost more. The
    cheapest edits that give a system turn or none, then user and assistant turns in alternation, are
    found per block of consecutive rows: a block is a 4 by 4 min-plus matrix, made of the powers of its
    runs' transitions. Only these matrices meet per conversation, at most one per partition, so a
    conversation may hold any share of all rows. Among cheapest edits the ASCII-least are taken.

    Turns: ``(conv, block, place, edit, role, text)``, ordered by block and place; ``conv`` is the id as
    text, ``null`` for none. Report: ``conv``, counts, ``cost``, ``audit``. Equal rows are counted, not
    repeated. Nulls in role or text count as one space, an empty text as blank. Extra columns are
    ignored; an empty table gives no rows.
    """
    judged = _judged(rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "copies"))
    light = judged.select("conv", "block", "place", "class", "kind", "n")
    name, number, small = pa.string(), pa.int64(), pa.int32()
    summary = _grouped(light, "block", ["place"], _summary, {
        "conv": name, "block": number, "moves": pa.list_(number), "illegal": number, "first": small, "last": small})
    tails = store(_grouped(summary, "conv", ["block"], _tails, {
        "conv": name, "block": number, "tail": pa.list_(number), "number": number, "final": pa.bool_(), "cost": number,
        "illegal": number}), "tails")
    walks = store(_grouped(light.join(tails.select("block", "tail", "number", "final"), "block"), "block", ["place"], _walks, {
        "conv": name, "block": number, "enter": small, "leave": small, "audit": name}), "walks")
    entered = _grouped(walks.select("conv", "block", "enter", "leave"), "conv", ["block"], _entered, {"block": number, "enter": small})
    chosen = store(walks.join(entered, ["block", "enter"]), "edits")

    last = judged.groupBy("block").agg(F.max("place").alias("final"))
    facts = chosen.join(last, "block").select("block", "enter", "audit", "final")
    marked = judged.join(facts, "block").select(
        "conv", "block", "place", "role", "text", "n", F.when(F.col("place") == 0, F.col("audit")).alias("audit"), "enter",
        (F.col("place") == F.col("final")).alias("final"))
    marked = marked.repartition("block").sortWithinPartitions("block", "place")
    turns = marked.mapInArrow(_pieces, "conv string, block long, place long, edit string, role string, text string")

    def copies(fault: str):
        # Further copies of a row are duplicates, unless blank.
        own = F.when(F.col("fault") == fault, F.lit(1)).otherwise(F.lit(0))
        if fault == "blank":
            return F.sum(own * F.col("n")).alias(fault)
        more = F.when(F.col("fault") != "blank", F.col("n") - 1).otherwise(F.lit(0))
        return F.sum(own + (more if fault == "duplicate" else F.lit(0))).alias(fault)

    span = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    counts = judged.groupBy("conv").agg(
        F.coalesce(span, F.lit(0)).alias("gaps"), copies("blank"), copies("duplicate"), copies("truncated"))
    audits = chosen.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("block", "audit"))).alias("l"))
    audits = audits.select("conv", F.array_join(F.col("l.audit"), "").alias("audit"))
    report = counts.join(tails.filter("number = 0").select("conv", "cost", "illegal"), "conv").join(audits, "conv")
    return turns, report


def turn_digests(turns: DataFrame) -> DataFrame:
    """``(conv, repaired_sha256)`` of ``role:text`` lines. A digest is sequential, so one task streams each
    conversation, in pieces of some hundred turns."""
    line = F.struct("place", F.concat("role", F.lit(":"), "text").alias("line"))
    pieces = turns.groupBy("conv", "block", F.floor(F.col("place") / PIECE).alias("part")).agg(
        F.sort_array(F.collect_list(line)).alias("l"))
    pieces = pieces.select("conv", "block", "part", F.array_join(F.col("l.line"), "\n").alias("piece"))
    pieces = pieces.repartition("conv").sortWithinPartitions("conv", "block", "part").select("conv", "piece")
    return pieces.mapInArrow(_digests, "conv string, repaired_sha256 string")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns, report = repair(damaged(rows))
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("conv")
    every = rows.select("conv_id", conv).distinct()
    found = every.join(report, "conv", "left").join(turn_digests(turns), "conv", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def _more(state: str, cost: str, edits_: str) -> str:
    """SQL: a state ``cost|audit`` with more cost and edits; null stays null."""
    return f"(format('{{:010d}}', {state}[1:10]::BIGINT + {cost}) || {state}[11:] || '{edits_}')"


def _step_sql() -> str:
    """SQL: the four states after one row, from those before it; equal costs go to the ASCII-least audit."""
    before = {
        "e": "e", "s": "s",
        "u": f"least(u, {_more('e', INSERT, 'I')}, {_more('s', INSERT, 'I')}, {_more('a', INSERT, 'I')})",
        "a": f"least(a, {_more('u', INSERT, 'I')}, {_more('e', 2 * INSERT, 'II')}, {_more('s', 2 * INSERT, 'II')})"}
    inserted = ", ".join(f"{sql} AS {name}" for name, sql in before.items())
    late = f"{TRUNCATED} * truncated"

    def kept(initial: str, state: str) -> str:
        return f"CASE WHEN NOT must AND initial = '{initial}' THEN {_more(state, late, 'K')} END"

    def reroled(state: str) -> str:
        return f"CASE WHEN NOT must THEN {_more(state, f'{REROLE} + {late}', 'R')} END"

    to_user = ", ".join(f"{kept('u', s)}, {reroled(s)}" for s in ("e", "s", "a"))
    after = {
        "e": _more("e", DELETE, "D"), "s": f"least({_more('s', DELETE, 'D')}, {kept('s', 'e')})",
        "u": f"least({_more('u', DELETE, 'D')}, {to_user})",
        "a": f"least({_more('a', DELETE, 'D')}, {kept('a', 'u')}, {reroled('u')})"}
    stepped = ", ".join(f"{sql} AS {name}" for name, sql in after.items())
    return f"""SELECT conv, i, {stepped} FROM (SELECT conv, i, must, truncated, initial, {inserted} FROM (
      SELECT way.conv, judged.i, must, truncated, initial, e, s, u, a FROM way JOIN judged ON judged.conv = way.conv AND judged.i = way.i + 1))"""


# CRC-32 bit by bit over the characters of the seed, which are ASCII.
_CRC = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(seed, ''), lambda c: ascii(c)::BIGINT),
    lambda x, y: list_reduce([xor(x, y), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda v, w: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)), 4294967295::BIGINT)"""
_BLANK = r"NOT regexp_matches(text, '[^\x20\x09-\x0D]')"

SQL = rf"""
WITH RECURSIVE seeded AS (
  SELECT coalesce(conv_id::VARCHAR, 'null') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS seed FROM conversations),
faults AS (SELECT conv, turn, role, text, {_CRC} % 20 AS f FROM seeded),
damaged AS (
  SELECT conv, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE f WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM faults WHERE f <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
checked AS (
  SELECT *, {_BLANK} AS blank, i > min(i) OVER (PARTITION BY conv, role, text) AS again,
    NOT regexp_matches(text, '[.!?][ 	-
]*$') AS cut, role[1:1] AS initial,
    lag(role[1:1]) OVER (PARTITION BY conv ORDER BY i) AS before FROM placed),
judged AS (SELECT *, blank OR again AS must, (NOT blank AND NOT again AND cut)::BIGINT AS truncated FROM checked),
way AS (
  SELECT DISTINCT conv, 0::BIGINT AS i, '0000000000' AS e, NULL::VARCHAR AS s, NULL::VARCHAR AS u, NULL::VARCHAR AS a FROM judged
  UNION ALL {_step_sql()}),
ways AS (
  SELECT conv, least(e, a, {_more('u', INSERT, 'I')}, {_more('s', 2 * INSERT, 'II')}) AS best
  FROM way JOIN (SELECT conv, max(i) AS i FROM judged GROUP BY conv) USING (conv, i)),
edits AS (
  SELECT conv, edit, j, sum((edit <> 'I')::INT) OVER (PARTITION BY conv ORDER BY j) AS i,
    sum((edit <> 'D')::INT) OVER (PARTITION BY conv ORDER BY j) AS q
  FROM (SELECT conv, unnest(string_split(best[11:], '')) AS edit, unnest(range(len(best) - 10)) AS j FROM ways WHERE len(best) > 10)),
turns AS (
  SELECT conv, edit, j, q, CASE edit WHEN 'I' THEN '' ELSE text END AS text, role,
    max((q = 1 AND edit = 'K' AND initial = 's')::INT) OVER (PARTITION BY conv) AS led
  FROM edits LEFT JOIN judged USING (conv, i) WHERE edit <> 'D'),
repaired AS (
  SELECT conv, string_agg(CASE WHEN edit = 'K' THEN role WHEN (q - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
    chr(10) ORDER BY j) AS lines FROM turns GROUP BY conv),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(blank::INT) AS blank,
    sum((again AND NOT blank)::INT) AS duplicate, sum(truncated) AS truncated,
    sum((before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au'))::INT) AS illegal FROM judged GROUP BY conv)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best[1:10], '0')::BIGINT AS cost,
  coalesce(best[11:], '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, 'null') AS conv FROM conversations)
  LEFT JOIN counts USING (conv) LEFT JOIN ways USING (conv) LEFT JOIN repaired USING (conv)
"""
