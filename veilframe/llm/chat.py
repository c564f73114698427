"""Chat formatting: the cheapest repair of a conversation's roles, then its rendering.

Legal conversations are an automaton: a system turn may open, then user and assistant take turns,
and an assistant ends. A turn may be kept, relabelled, or merged into the one before, and empty turns
may be put in; each has a cost. What one turn does to the automaton is a small matrix of costs from
state to state, and a run of turns is the product of its matrices, with sums for products and minima
for sums. Products do not depend on how they are bracketed, so a conversation of any length is cut:
rows are ordered and written by range, every partition in blocks of bounded length. Blocks are
multiplied within partitions, partitions within conversations, and the best states at all seams are
handed back down the same way. Each block is then repaired between its two states, on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from veilframe.session import written

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)  # states: nothing yet, or the role of the last turn
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
ENDS = (START, ASSISTANT)
KEEP, MERGE, RELABEL, INSERT, GUESS = 0, 2, 3, 4, 1  # costs; GUESS: a role for a turn that has none
CODES = "xsua"  # a turn's role: none that is known, system, user, assistant
# A text's "<|" becomes "<||", which no mark begins with, so a text cannot open or close a turn.
MARK, ESCAPED = "<|", "<||"
BLOCK_TURNS = 2048
OPEN, CLOSE, JOIN = "<|{}|>\n", "<|end|>\n", "\n\n"
FAR = 10 ** 12
LONGS = T.ArrayType(T.LongType())
SEAMS = T.ArrayType(T.StructType([T.StructField("k", T.LongType()), T.StructField("entry", T.IntegerType()), T.StructField(
    "leave", T.IntegerType()), T.StructField("opens", T.BooleanType()), T.StructField("ends", T.BooleanType())]))


def role_code(role: Column) -> Column:
    name = F.lower(F.trim(F.coalesce(role, F.lit(""))))
    return F.when(name == "system", "s").when(name == "user", "u").when(name == "assistant", "a").otherwise("x")


@lru_cache(maxsize=None)
def insertions(state: int) -> dict[int, tuple[int, tuple[int, ...]]]:
    """The states that empty turns lead to: their cost and the roles put in, the fewest."""
    found = {state: (0, ())}
    queue = [state]
    while queue:
        at = queue.pop(0)
        for to in NEXT[at]:
            if to not in found:
                found[to] = (found[at][0] + INSERT, (*found[at][1], to))
                queue.append(to)
    return found


@lru_cache(maxsize=None)
def steps(code: str) -> tuple[tuple[tuple[int, tuple[int, ...], str] | None, ...], ...]:
    """From state to state by one turn: cost, roles put in before it, and what becomes of the turn."""
    role = CODES.index(code)
    table = []
    for state in range(4):
        best: list[tuple[int, tuple[int, ...], str] | None] = [None] * 4

        def offer(to: int, cost: int, put: tuple[int, ...], how: str) -> None:
            if best[to] is None or (cost, len(put), how) < (best[to][0], len(best[to][1]), best[to][2]):
                best[to] = (cost, put, how)

        for at, (cost, put) in insertions(state).items():
            for to in NEXT[at]:
                change = KEEP if to == role else GUESS if role == 0 else RELABEL
                offer(to, cost + change, put, "keep" if to == role else "relabel")
            if at != START:
                change = KEEP if at == role else GUESS if role == 0 else RELABEL
                offer(at, cost + MERGE + change, put, "merge")
        table.append(tuple(best))
    return tuple(table)


def costs(code: str) -> list[list[int]]:
    return [[step[0] if step else FAR for step in row] for row in steps(code)]


def product(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    return [[min(FAR, *(a[i][k] + b[k][j] for k in range(4))) for j in range(4)] for i in range(4)]


UNIT = [[0 if i == j else FAR for j in range(4)] for i in range(4)]


@lru_cache(maxsize=1 << 14)
def matrix_of(codes: str) -> tuple[int, ...]:
    """The matrix of a run of turns, row by row."""
    out = UNIT
    for code in codes:
        out = product(out, costs(code))
    return tuple(x for row in out for x in row)


def squared(flat) -> list[list[int]]:
    return [[int(x) for x in flat[4 * i:4 * i + 4]] for i in range(4)]


def seams(matrices: list[list[list[int]]], entry: int, exits: dict[int, int]) -> list[int]:
    """The states at the seams of a cheapest way from `entry`; `exits`: allowed last states and their cost."""
    rows = [[0 if s == entry else FAR for s in range(4)]]
    for m in matrices:
        rows.append([min(FAR, *(rows[-1][i] + m[i][j] for i in range(4))) for j in range(4)])
    state = min(exits, key=lambda s: (rows[-1][s] + exits[s], s))
    way = [state]
    for at in range(len(matrices) - 1, -1, -1):
        way.append(min(range(4), key=lambda i: (rows[at][i] + matrices[at][i][way[-1]], i)))
    return way[::-1]


def endings() -> dict[int, int]:
    """What it costs to end from each state: nothing, or the empty turns to a legal end."""
    return {s: min(insertions(s)[e][0] for e in ENDS if e in insertions(s)) for s in range(4)}


def repaired(codes: str, entry: int, leave: int) -> list[tuple[tuple[int, ...], str, int]]:
    """For each turn the roles put in before it, what becomes of it, and its role."""
    way = seams([costs(c) for c in codes], entry, {leave: 0})
    return [(*steps(c)[a][b][1:], b) for c, a, b in zip(codes, way, way[1:])]


@pandas_udf(LONGS)
def run_matrix(codes: pd.Series) -> pd.Series:
    return codes.map(lambda c: list(matrix_of(c)))


@pandas_udf(LONGS)
def product_of(parts: pd.Series) -> pd.Series:
    def of(rows) -> list[int]:
        out = UNIT
        for r in rows:
            out = product(out, squared(r["m"]))
        return [x for row in out for x in row]

    return parts.map(of)


@pandas_udf(SEAMS)
def seams_of(parts: pd.Series, entry: pd.Series, leave: pd.Series, opens: pd.Series, ends: pd.Series) -> pd.Series:
    """The states between parts (k, m); `leave` below zero: as is cheapest to end."""
    out = []
    for rows, first, last, begins, closes in zip(parts, entry, leave, opens, ends):
        way = seams([squared(r["m"]) for r in rows], int(first), endings() if last < 0 else {int(last): 0})
        n = len(rows)
        out.append([{"k": int(r["k"]), "entry": way[i], "leave": way[i + 1], "opens": bool(begins) and i == 0,
                     "ends": bool(closes) and i == n - 1} for i, r in enumerate(rows)])
    return pd.Series(out)


def rendering(codes: str, texts: list[str], entry: int, leave: int, ends: bool) -> list[tuple[str, str, str, str]]:
    """(role, action, roles put in before, rendered) of each turn. The pieces, end to end, are the
    rendered conversation: a turn is closed by what follows it, and the last by its own piece."""
    out = []
    state = entry
    for (put, how, role), text in zip(repaired(codes, entry, leave), texts):
        piece, opened = "", state != START
        for empty in put:
            piece += (CLOSE if opened else "") + OPEN.format(ROLES[empty - 1])
            opened = True
        piece += JOIN if how == "merge" else (CLOSE if opened else "") + OPEN.format(ROLES[role - 1])
        out.append([ROLES[role - 1], how, ",".join(ROLES[r - 1] for r in put), piece + text.replace(MARK, ESCAPED)])
        state = role
    if ends and out:
        last = min((e for e in ENDS if e in insertions(state)), key=lambda e: insertions(state)[e][0])
        for empty in insertions(state)[last][1]:
            out[-1][3] += CLOSE + OPEN.format(ROLES[empty - 1])
        out[-1][3] += CLOSE
    return out


def formatted(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
              block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row a turn: conversation, turn, place (order within the conversation), role after repair, action
    (keep, relabel, merge), `put_in` (roles of empty turns before it) and `rendered`, the turn's piece.

    Pieces joined by place are the rendered conversation; "<|" within a text is written "<||". Turns are ordered by number, those without one
    last, then by role and text; repeated rows follow each other. Roles are matched without regard to case;
    unknown and null ones are any role, at the cost of a guess. Null texts are empty. Rows without a
    conversation are one conversation. An empty table gives an empty result.
    """
    rows = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                     role_code(F.col(role_col)).alias("code")).withColumn("seen", F.monotonically_increasing_id())
    rows = rows.withColumns({"key": F.coalesce(F.col("conv").cast("string"), F.lit("")), "none": F.col("conv").isNull(), "late": F.col("turn").isNull()})
    order = ["key", "none", "late", "turn", "code", F.xxhash64("text"), "seen"]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    within = F.monotonically_increasing_id()  # partition number above, row number below
    rows = rows.select("conv", "key", "none", "turn", "text", "code", within.alias("place"))
    rows = rows.withColumns({"part": F.shiftright("place", 33), "block": F.floor(F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) / block_turns)})
    rows = written(rows, "chat_rows")

    codes = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "code"))), lambda r: r["code"]), "")
    blocks = rows.groupBy("key", "none", "part", "block").agg(codes.alias("codes"))
    blocks = written(blocks.select("key", "none", "part", F.col("block").alias("k"), run_matrix("codes").alias("m")), "chat_blocks")

    def gathered(level: DataFrame, *by: str) -> DataFrame:
        return level.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("k", "m"))).alias("parts"))

    in_part = gathered(blocks, "key", "none", "part")
    whole_parts = in_part.select("key", "none", F.col("part").alias("k"), product_of("parts").alias("m"))
    yes, free = F.lit(True), F.lit(-1)
    top = gathered(whole_parts, "key", "none").select(
        "key", "none", F.explode(seams_of("parts", F.lit(START), free, yes, yes)).alias("s")).select("key", "none", F.col("s.k").alias("part"), "s")
    low = in_part.join(top, ["key", "none", "part"]).select("key", "none", "part", F.explode(
        seams_of("parts", "s.entry", "s.leave", "s.opens", "s.ends")).alias("s")).select(
        "key", "none", "part", F.col("s.k").alias("block"), "s.entry", "s.leave", "s.ends")
    low = written(low, "chat_seams")

    by = ["key", "none", "part", "block"]
    ready = rows.join(low, by).sortWithinPartitions(*by, "place").select(
        "conv", "turn", "place", "text", "code", "entry", "leave", "ends", "key", "none", "part", "block")

    kinds = {f.name: f.dataType for f in rows.schema}
    schema = T.StructType([T.StructField(n, kinds[n]) for n in ("conv", "turn", "place")] + [
        T.StructField(n, T.StringType()) for n in ("role", "action", "put_in", "rendered")])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        now = None

        def done() -> pa.RecordBatch:
            first = held[0]
            pieces = rendering("".join(r["code"] for r in held), [r["text"] for r in held], first["entry"], first["leave"], first["ends"])
            columns = [[r[n] for r in held] for n in ("conv", "turn", "place")] + [list(c) for c in zip(*pieces)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], arrow.names)

        for batch in batches:
            for r in batch.to_pylist():
                block = (r["key"], r["none"], r["part"], r["block"])
                if block != now and held:
                    yield done()
                    held.clear()
                now = block
                held.append(r)
        if held:
            yield done()

    out = ready.mapInArrow(run, schema)
    return out.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), "place", "role", "action", "put_in", "rendered")
