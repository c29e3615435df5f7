"""Chat formatting as a relational job: turn structs sorted, adjacent roles merged, all in Spark expressions.

The template, with ``system``, ``user`` and ``assistant`` as roles::

    <s>### user:
    first text<part>second text of the same role</turn>### assistant:
    answer</turn>

Inside texts ``\\``, ``<`` and ``#`` are written as ``\\b``, ``\\l`` and ``\\h``, in roles also ``:`` as
``\\c``, so no marker can appear there and the original comes back by plain replacements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import table

# The markers of the template. All begin with an escaped character.
START, HEAD, NAME_END, PART, TURN = "<s>", "### ", ":\n", "<part>", "</turn>"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
LOSS_ROLE = "assistant"


def escaped(text: Column, escapes=ESCAPES) -> Column:
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column, escapes=ESCAPES) -> Column:
    for plain, code in reversed(escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_chats(turns: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss_spans)``: one text per conversation and the spans that are trained on.

    Turns are ordered by ``turn``, then role, then text, nulls first, so that ties have one result.
    Adjacent turns of one role share a header and are separated by a part marker, so each text can
    be read back. ``loss_spans`` are ``(start, length)`` in code points of ``formatted``, one for each
    assistant text, empty texts included. Null texts and roles are empty; a null ``conv_id`` is a conversation
    of its own; repeated rows are repeated turns; extra columns are ignored, an empty table gives
    no rows. A conversation becomes one string, so its turns meet in one row by definition.
    """
    text = escaped(F.coalesce("text", F.lit("")))
    role = F.coalesce("role", F.lit(""))
    rows = turns.select("conv_id", F.struct(F.col("turn"), role.alias("role"), text.alias("body")).alias("t"))
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    # Each turn opens with a header, or with a part marker if the role goes on.
    roles = F.col("t.role")
    opening = F.transform("t", lambda x, i: F.when(
        (i > 0) & (F.get(roles, i - 1) == x["role"]), F.lit(PART)
    ).otherwise(F.concat(F.when(i == 0, F.lit(START)).otherwise(F.lit(TURN)), F.lit(HEAD), escaped(x["role"], ROLE_ESCAPES), F.lit(NAME_END))))
    chats = chats.select("conv_id", "t", opening.alias("opening"))
    body = F.zip_with("opening", "t", lambda o, x: F.concat(o, x["body"]))
    formatted = F.concat(F.array_join(body, ""), F.lit(TURN))
    lengths = F.zip_with("opening", "t", lambda o, x: F.struct(
        (x["role"] == LOSS_ROLE).alias("loss"), F.char_length(o).alias("skip"), F.char_length(x["body"]).alias("length")))
    chats = chats.select("conv_id", formatted.alias("formatted"), lengths.alias("l"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    walked = F.aggregate("l", zero, lambda acc, x: F.struct(
        (acc["at"] + x["skip"] + x["length"]).alias("at"),
        F.when(x["loss"], F.array_append(acc["spans"], F.struct(
            (acc["at"] + x["skip"]).alias("start"), x["length"].alias("length")))).otherwise(acc["spans"]).alias("spans")))
    return chats.select("conv_id", "formatted", walked["spans"].alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text as an array of ``(role, text)``, in order."""
    last = F.char_length(formatted) - len(START) - len(TURN)
    blocks = F.split(F.call_function("substring", formatted, F.lit(len(START) + 1), last), TURN)

    def parts(block: Column) -> Column:
        head = F.substring_index(block, NAME_END, 1)
        role = unescaped(F.call_function("substring", head, F.lit(len(HEAD) + 1)), ROLE_ESCAPES)
        body = F.call_function("substring", block, F.char_length(head) + len(NAME_END) + 1)
        return F.transform(F.split(body, PART), lambda p: F.struct(role.alias("role"), unescaped(p).alias("text")))

    return F.flatten(F.transform(blocks, parts))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return unescaped(F.array_join(F.transform(
        spans, lambda s: F.call_function("substring", formatted, s["start"] + 1, s["length"])), ""))


# The conversation that the registered query adds to the table.
EXTRA = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "conv_id", "turn", "role", "text"
    extra = spark.createDataFrame(EXTRA, "conv_id long, turn long, role string, text string")
    chats = format_chats(table(spark, sf_dir, "conversations").select(*columns).union(extra))
    turns = read_turns(F.col("formatted"))
    loss = loss_text(F.col("formatted"), F.col("loss_spans"))
    chats = chats.select("conv_id", turns.alias("turns"), loss.alias("loss"), F.char_length("formatted").cast("long").alias("formatted_chars"))
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(listed, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def _sql_escaped(column: str, escapes=ESCAPES) -> str:
    for plain, code in escapes:
        column = f"replace({column}, '{plain}', '{code}')"
    return column


SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES {', '.join(f"({c}::BIGINT, {t}::BIGINT, '{r}', '{x}')" for c, t, r, x in EXTRA)})),
marked AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = '{LOSS_ROLE}' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{LOSS_ROLE}'), '')) AS loss_sha256,
  ({len(START) + len(TURN)} + sum(length({_sql_escaped('text')}) + CASE
    WHEN before IS NOT DISTINCT FROM role THEN {len(PART)}
    ELSE {len(HEAD) + len(NAME_END)} + length({_sql_escaped('role', ROLE_ESCAPES)}) + CASE WHEN before IS NULL THEN 0 ELSE {len(TURN)} END END))::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""
