"""Conversation structure repair: turns aligned to the role sequences a conversation may have.

A legal sequence is empty or `s?(ua)+`: perhaps a system turn, then user and assistant in turn. Turns may be
kept, get the role of user or assistant, be deleted, and empty turns may be put in; the cheapest edits
count, and of those the ones whose initials, written in order, come first. The turns are aligned to the
grammar's string of each feasible length by the tables of Wagner and Fischer. As all lengths end alike,
one table by turns and characters left holds them all. An incumbent, the cost of a plain way from
turn to turn, bounds how far turns left and characters left may differ (Ukkonen's band): n deletions cost
2n and n insertions 5n. Lengths of equal cost are told apart by the audits traced back through the table.

A conversation of any length is cut in blocks of bounded length. Blocks are aligned between every pair
of states of the grammar, the costs are carried from the last seam to the first, and a block is then
traced on its own, given what its ends cost. Rows of a block lie together; nothing else has to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from veilframe.llm.common import NO_SPACE, SPACE
from veilframe.session import written, written_and_counted

REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5  # costs; CUT: of a truncated turn that stays
START, SYSTEM, USER, ASSISTANT = range(4)  # states: nothing yet, or the role of the last turn
STATES = (START, SYSTEM, USER, ASSISTANT)
ROLES = ("", "system", "user", "assistant")
ENDS = {START: 0, ASSISTANT: 0}
FOLLOWING = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
FAR = 1 << 40
BLOCK_TURNS = 1024
RANGE_CHARS = 256
DONE = ("", "blank", "duplicate", "truncated")  # a turn's first fault, by number


def incumbent(codes: Sequence[int], forced: Sequence[bool], extra: Sequence[int], entry: int, exits: Mapping[int, int],
              last: bool) -> int:
    """What a plain way costs: turn by turn the role that is due, at the end what is missing."""
    n, state, cost = len(codes), entry, 0
    for code, gone, more in zip(codes, forced, extra):
        if gone:
            cost += DELETE
        elif state == START and code == SYSTEM:
            state, cost = SYSTEM, cost + more
        else:
            state, cost = FOLLOWING[state], cost + more + (REROLE if code != FOLLOWING[state] else 0)
    ways = [cost + exits[state]] if state in exits else []
    while last and not ways:
        state, cost = FOLLOWING[state], cost + INSERT
        ways = [cost + exits[state]] if state in exits else []
    # Or everything goes, after at most two empty turns.
    return min(ways + [DELETE * n + 2 * INSERT + max(exits.values())])


def left_over(codes, forced, extra, end: int, bound: int, last: bool) -> tuple[np.ndarray, int]:
    """The table: in row i, at place r - (n - i) + low, the least cost of aligning the turns from i to the last
    r characters of the alternating string that ends in `end`. Empty turns behind the last turn of a
    block belong to the block after it."""
    n, low, high = len(codes), bound // DELETE, bound // INSERT
    k = np.arange(low + high + 1)
    slope = INSERT * k
    table = np.empty((n + 1, len(k)), np.int64)
    r = k - low
    table[n] = np.where(r == 0, 0, np.where((r > 0) & last, INSERT * r, FAR))
    other = FOLLOWING[end]
    for i in range(n - 1, -1, -1):
        before, here = table[i + 1], table[i]
        here[:-1] = before[1:] + DELETE
        here[-1] = FAR
        if not forced[i]:
            ends_so, ends_not = extra[i] + (codes[i] != end) * REROLE, extra[i] + (codes[i] != other) * REROLE
            odd = (n - i - low) % 2  # of r at the first place
            np.minimum(here[1 - odd::2], before[1 - odd::2] + ends_so, out=here[1 - odd::2])
            np.minimum(here[odd::2], before[odd::2] + ends_not, out=here[odd::2])
        np.minimum.accumulate(here - slope, out=here)
        here += slope
    return table, low


def traced(table: np.ndarray, low: int, codes, end: int, i: int, r: int) -> str:
    """The initials of the cheapest edits from a cell on that come first."""
    n, out = len(codes), []
    other = FOLLOWING[end]

    def cost(i: int, r: int) -> int:
        k = r - (n - i) + low
        return int(table[i, k]) if 0 <= k < table.shape[1] and r >= 0 else FAR

    while i < n or r:
        now = cost(i, r)
        if i < n and cost(i + 1, r) + DELETE == now:
            out.append("D")
            i += 1
        elif r and cost(i, r - 1) + INSERT == now:
            out.append("I")
            r -= 1
        else:
            out.append("K" if codes[i] == (end if r % 2 else other) else "R")
            i, r = i + 1, r - 1
    return "".join(out)


def aligned(codes: Sequence[int], forced: Sequence[bool], extra: Sequence[int], entries: Sequence[int], exits: Mapping[int, int],
            last: bool, audits: bool = True) -> dict[int, tuple[int, str, int]]:
    """From each entry state: the least cost of the turns and the exit, the audit that comes first, the exit state."""
    n = len(codes)
    bound = max(incumbent(codes, forced, extra, e, exits, last) for e in entries)
    tables = {x: left_over(codes, forced, extra, x, bound, last) for x in (USER, ASSISTANT) if x in exits}
    opening = [i for i in range(n) if codes[i] == SYSTEM and not forced[i]]
    found = {}
    for entry in entries:
        ways: list[tuple[int, int, int, int | None]] = []  # cost, exit, characters, place of the system turn
        if entry in (START, SYSTEM) and entry in exits:
            ways.append((DELETE * n + exits[entry], entry, 0, None))
        if entry == START and SYSTEM in exits and opening:
            i = min(opening, key=lambda i: (extra[i], -i))
            ways.append((DELETE * (n - 1) + extra[i] + exits[SYSTEM], SYSTEM, 0, i))
        for x, (table, low) in tables.items():
            r = np.arange(table.shape[1]) + n - low  # characters left at turn 0
            starts = np.where(r % 2 == 1, x, FOLLOWING[x]) == FOLLOWING[entry]
            fits = starts & (r > 0) | (r == 0) & (entry == x)
            ways += [(int(table[0, k]) + exits[x], x, int(r[k]), None) for k in np.flatnonzero(fits & (table[0] < FAR))]
            for i in opening if entry == START else ():
                left = r - i - 1  # characters left at turn i + 1, by place
                fits = (left > 0) & (np.where(left % 2 == 1, x, FOLLOWING[x]) == USER)
                cost = np.where(fits, table[i + 1], FAR) + (DELETE * i + extra[i] + exits[x])
                ways += [(int(cost[k]), x, int(left[k]), i) for k in np.flatnonzero(cost == min(cost.min(), FAR - 1))]
        if not ways:
            found[entry] = (FAR, "", entry)
            continue
        least = min(w[0] for w in ways)
        tied = [w for w in ways if w[0] == least]
        # Of the ways that keep a system turn those with the latest one come first, as "D" is before "K".
        latest = max((w[3] for w in tied if w[3] is not None), default=None)
        tied = [w for w in tied if w[3] is None or w[3] == latest]
        options = []
        for _, x, chars, system in tied if audits else tied[:1]:
            if not audits:
                options.append(("", x))
            elif x in (START, SYSTEM):
                options.append(("D" * n if system is None else "D" * system + "K" + "D" * (n - system - 1), x))
            elif system is None:
                options.append((traced(*tables[x], codes, x, 0, chars), x))
            else:
                options.append(("D" * system + "K" + traced(*tables[x], codes, x, system + 1, chars), x))
        audit, x = min(options)
        found[entry] = (least, audit, x)
    return found


def edits(codes: Sequence[int], audit: str, entry: int) -> list[tuple[int, str, str]]:
    """Of each edit: its turn (an empty one's is the turn before it, -1 before all), its initial, the role it leaves
    (empty: none, or the turn's own)."""
    out, i, state = [], -1, entry
    for letter in audit:
        i += letter != "I"
        if letter == "D":
            out.append((i, letter, ""))
            continue
        state = SYSTEM if letter == "K" and state == START and codes[i] == SYSTEM else FOLLOWING[state]
        out.append((i, letter, "" if letter == "K" else ROLES[state]))
    return out


BLOCK = ["key", "none", "part", "block"]


def given(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Equal rows folded, with their number `n` and their place; and, without texts, the places with the turns'
    roles and first faults. Both written.

    A place is the partition (upper bits) and the row in it, so it grows with the order."""
    blank = F.lit(" ")
    rows = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), blank).alias("role"),
                     F.coalesce(F.col(text_col), blank).alias("text")).groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumns({"key": F.coalesce(F.col("conv").cast("string"), F.lit("")), "none": F.col("conv").isNull(),
                             "late": F.col("turn").isNotNull(), "digest": F.unhex(F.sha2("text", 256))})
    order = ["key", "none", "late", "turn", "role"]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Ranges go by the first characters, as whole texts would be sampled; within them the whole text counts.
    dealt = rows.repartitionByRange(parts, *order, F.substring("text", 1, RANGE_CHARS))
    rows = dealt.sortWithinPartitions(*order, "text").drop("late")
    rows = written(rows.withColumn("place", F.monotonically_increasing_id()), "turns")
    said = ["key", "none", "role", "digest"]
    plain = F.when(~F.col("text").rlike(NO_SPACE), 1).when(~F.col("text").rlike(rf"[.!?]{SPACE}*\z"), 3).otherwise(0)
    narrow = rows.select(*said, "place", role_number(F.col("role")).alias("code"), plain.alias("fault"))
    firsts = narrow.groupBy(*said).agg(F.min("place").alias("first"))
    again = (F.col("place") > F.col("first")) & (F.col("fault") != 1)
    turns = narrow.join(firsts, said).select("key", "none", "place", "code", F.when(again, 2).otherwise(F.col("fault")).alias("fault"))
    return rows, written(turns, "turns_faults")


def role_number(role: Column) -> Column:
    initial = F.substring(role, 1, 1)
    return F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(START)


def block_of(pdf: pd.DataFrame) -> tuple[list[int], list[bool], list[int]]:
    fault = pdf["fault"].to_numpy()
    return pdf["code"].tolist(), np.isin(fault, (1, 2)).tolist(), np.where(fault == 3, CUT, 0).tolist()


def block_costs(pdf: pd.DataFrame) -> pd.DataFrame:
    """The costs of a block from state to state, row by row."""
    pdf = pdf.sort_values("place")
    lines = block_of(pdf)
    costs = np.full((4, 4), FAR)
    for x in STATES:
        for e, (cost, _, _) in aligned(*lines, STATES, {x: 0}, False, audits=False).items():
            costs[e, x] = min(cost, FAR)
    return pdf[BLOCK].head(1).assign(costs=[costs.ravel().tolist()])


def seam_costs(pdf: pd.DataFrame) -> pd.DataFrame:
    """What the rest of the conversation costs from each state at the end of each block but the last. The last
    block's costs count with what it takes to end."""
    pdf = pdf.sort_values(["part", "block"])
    ending = np.array([0, 2 * INSERT, INSERT, 0])
    after, rest = [None] * len(pdf), ending
    for at in range(len(pdf) - 1, -1, -1):
        after[at] = None if rest is ending else rest.tolist()
        rest = (np.array(pdf["costs"].iloc[at]).reshape(4, 4) + rest).min(1)
    return pdf[BLOCK].assign(after=after)


def exits_of(after) -> tuple[dict[int, int], bool]:
    return (ENDS, True) if after is None else ({x: int(c) for x, c in zip(STATES, after)}, False)


def block_exits(pdf: pd.DataFrame) -> pd.DataFrame:
    """The state a block is left in, by the state it is entered in."""
    pdf = pdf.sort_values("place")
    found = aligned(*block_of(pdf), STATES, *exits_of(pdf["after"].iloc[0]))
    return pdf[BLOCK].head(1).assign(exits=[[found[e][2] for e in STATES]])


def block_entries(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["part", "block"])
    state, entries = START, []
    for exits in pdf["exits"]:
        entries.append(state)
        state = int(exits[state])
    return pdf[BLOCK].assign(entry=entries)


def repaired(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
             block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row an edit: conv, place, step (order within the place), turn, role and text of the turn, fault (blank,
    duplicate, truncated or empty), edit (K, R, D, I), times, new_role and new_text (null where the turn goes).

    Turns are in the order of their numbers, nulls first, then by role and text. A turn is blank without
    any character but white space, else a duplicate if its role and text are seen earlier, else truncated if its
    last such character is not one of `.!?`. `times` above one stands for equal rows, one after the
    other: the first has the fault and the edit shown, the others are deleted as duplicates (blank ones as such). Roles go by
    their first letter, s, u or a; others, and empty ones, can only be changed or deleted. Null roles and texts
    are one space; rows without a conversation are one conversation. Texts of any length are whole. Other columns
    are not read. An empty table gives an empty result.
    """
    rows, turns = given(df, conv_col, turn_col, role_col, text_col)
    turns = turns.withColumns({
        "part": F.shiftright("place", 33), "block": F.floor(F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) / block_turns)})
    of_conv = Window.partitionBy("key", "none")
    seams = turns.select(BLOCK).distinct().withColumn("blocks", F.count(F.lit(1)).over(of_conv))
    cut, several = written_and_counted(seams.where("blocks > 1").select(BLOCK), "turns_cut")
    kinds = {f.name: f.dataType.simpleString() for f in cut.schema}
    block = ", ".join(f"{c} {kinds[c]}" for c in BLOCK)
    nothing = F.lit(None).cast("array<long>").alias("after")
    single = seams.where("blocks = 1").select(*BLOCK, nothing, F.lit(START).cast("long").alias("entry"))
    if several:
        long = turns.join(cut, BLOCK)
        costs = long.groupBy(BLOCK).applyInPandas(block_costs, f"{block}, costs array<long>")
        after = written(costs.groupBy("key", "none").applyInPandas(seam_costs, f"{block}, after array<long>"), "turns_seams")
        exits = long.join(after, BLOCK).groupBy(BLOCK).applyInPandas(block_exits, f"{block}, exits array<long>")
        entries = exits.groupBy("key", "none").applyInPandas(block_entries, f"{block}, entry long")
        single = single.unionByName(after.join(entries, BLOCK))
    # The window brings a block's rows into one task. The join does not: its plan may turn, as it runs, into one that
    # sends the entries to every executor and leaves the rows where they are, also where they are dealt out before.
    in_block = F.row_number().over(Window.partitionBy(*BLOCK).orderBy("place"))
    ready = turns.join(written(single, "turns_entries"), BLOCK).withColumn("row", in_block).sortWithinPartitions(*BLOCK, "place")
    schema = T.StructType().add("place", T.LongType()).add("edits", T.ArrayType(
        T.StructType().add("step", T.IntegerType()).add("edit", T.StringType()).add("given", T.StringType())))
    arrow = to_arrow_schema(schema)

    def traced_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The edits of each turn; rows of a block follow each other."""
        now, held = None, []

        def done() -> list[tuple]:
            entry, after = held[0][3:5]
            lines = [h[1] for h in held], [h[2] in (1, 2) for h in held], [CUT if h[2] == 3 else 0 for h in held]
            _, audit, _ = aligned(*lines, (entry,), *exits_of(after))[entry]
            out = [(h[0], []) for h in held]
            step, behind = -len(audit), -1
            for i, letter, role in edits(lines[0], audit, entry):
                # Empty turns before all others have negative steps at the first turn's place.
                step, behind = (step + 1, i) if i == behind else (0, i)
                out[max(i, 0)][1].append({"step": step, "edit": letter, "given": role})
            return out

        for batch in batches:
            ready = []
            columns = [batch.column(c).to_pylist() for c in (*BLOCK, "place", "code", "fault", "entry", "after")]
            for *block, place, code, fault, entry, after in zip(*columns):
                if block != now and held:
                    ready += done()
                    held.clear()
                now = block
                held.append((place, code, fault, entry, after))
            if ready:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*ready), arrow)], schema=arrow)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done()), arrow)], schema=arrow)

    found = ready.mapInArrow(traced_blocks, schema)
    faults = turns.select("place", "fault").join(found, "place")
    each = rows.join(faults, "place").select("*", F.explode("edits").alias("e"))
    empty = F.col("e.edit") == "I"
    fault = F.element_at(F.array(*[F.lit(d) for d in DONE]), F.col("fault") + 1)
    kept = F.col("e.edit").isin("K", "R")
    return each.select(
        "conv", "place", "e.step", *[F.when(~empty, F.col(c)).alias(c) for c in ("turn", "role", "text")],
        F.when(empty, "").otherwise(fault).alias("fault"), "e.edit", F.when(empty, 1).otherwise(F.col("n")).cast("long").alias("times"),
        F.when(F.col("e.edit") == "K", F.col("role")).when(F.col("e.edit") != "D", F.col("e.given")).alias("new_role"),
        F.when(empty, "").when(kept, F.col("text")).alias("new_text"))


LEGAL_PAIRS = frozenset(("su", "ua", "au"))


class Digest:
    """What is reported of a conversation, edit by edit."""

    def __init__(self):
        self.low = self.high = self.before = self.initial = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.audit: list[str] = []
        self.sha, self.lines = hashlib.sha256(), 0

    def add(self, turn, role, fault, edit, times, new_role, new_text) -> None:
        self.audit.append(edit + "D" * (times - 1))
        self.cost += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit] + DELETE * (times - 1)
        if edit != "D":
            self.cost += CUT if fault == "truncated" else 0
            self.sha.update(("\n" * (self.lines > 0) + f"{new_role}:{new_text}").encode("utf-8", "surrogatepass"))
            self.lines += 1
        if edit == "I":
            return
        if turn is not None:
            self.distinct += turn != self.before
            self.low, self.high, self.before = turn if self.low is None else self.low, turn, turn
        initial = role[:1]
        self.illegal += times - 1 + (self.initial is not None and self.initial + initial not in LEGAL_PAIRS)
        self.initial = initial
        self.blank += times if fault == "blank" else 0
        self.duplicate += (fault == "duplicate") + (times - 1 if fault != "blank" else 0)
        self.truncated += fault == "truncated"

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_report(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                  block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row a conversation: numbers missing between its turns, its faults, adjacent roles that may not follow each
    other, the least cost, the edits' initials and the SHA-256 of what is left, `role:text` by lines.

    The digest needs a conversation's rows in order; they pass through one task, edit by edit, without being held.
    """
    done = repaired(df, conv_col, turn_col, role_col, text_col, block_turns)
    taken = ["turn", "role", "fault", "edit", "times", "new_role", "new_text"]
    whole_numbers = F.col("turn").cast("long").alias("turn")
    ordered = done.select("conv", "place", "step", whole_numbers, *taken[1:]).repartition("conv").sortWithinPartitions("conv", "place", "step")
    schema = T.StructType([done.schema["conv"]] + [T.StructField(c, T.LongType()) for c in COUNTS] + [
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    arrow = to_arrow_schema(schema)

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            ready = []
            columns = [batch.column(c).to_pylist() for c in ("conv", *taken)]
            for conv, *edit in zip(*columns):
                if digest is None or conv != now:
                    if digest is not None:
                        ready.append((now, *digest.row()))
                    now, digest = conv, Digest()
                digest.add(*edit)
            if ready:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*ready), arrow)], schema=arrow)
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((now, *digest.row()), arrow)], schema=arrow)

    return ordered.drop("place", "step").mapInArrow(folded, schema).withColumnRenamed("conv", conv_col)


def damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows with faults put in by the CRC-32 of `conversation:turn`, modulo 20: 0 drops the row, 1 empties its text,
    2 takes out its `.!?`, 3 repeats it, 4 makes the user say it. Nulls are one space, in the key as in role and text."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), blank))
    fault = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce(F.col(role_col), blank), F.coalesce(F.col(text_col), blank)
    rows = df.select(F.col(conv_col), F.col(turn_col), role.alias(role_col), text.alias(text_col), fault.alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace(text_col, "[.!?]+", "")).otherwise(F.col(text_col))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col(role_col))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.select(conv_col, turn_col, role.alias(role_col), text.alias(text_col), copies.alias("copy")).drop("copy")


def damage_and_repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", block_turns: int = BLOCK_TURNS) -> DataFrame:
    """`repair_report` of the damaged rows, for every conversation of `df`: one that lost all rows has zeros, an
    empty audit and the hash of nothing."""
    report = repair_report(damaged(df, conv_col, turn_col, role_col, text_col), conv_col, turn_col, role_col, text_col, block_turns)
    given_to = df.select(F.col(conv_col).alias("conv")).distinct()
    joined = given_to.join(report, F.col("conv").eqNullSafe(F.col(conv_col)), "left")
    return joined.select(
        F.col("conv").alias(conv_col), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
