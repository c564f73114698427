"""Synthetic rows from a tree of pairwise dependencies; no row of the source is handed out.

For each pair of columns the mutual information follows from counts of their values. The greatest
spanning tree of it, grown from the conditions, says on which one column each other column hangs. A
synthetic row is drawn down the tree, each value given the value drawn for the column above it and
nothing else, so pairs along the tree have the shares of the source, and whole rows are put together
anew. Numbers hang on, and are hung on by, bands of fixed width, as exact amounts would point at
single rows; a cell with too few donors is left for the column's own shares for the same reason.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions.hashing import drawn_number
from veilframe.operators.ordering import ROWS_PER_BUCKET
from veilframe.operators.synth import EVERYTHING, band, draw_from_cells
from veilframe.session import written

ROOT = "*"  # the conditions
FLOOR_ROWS = 5
DIGITS = 6  # of the information by which pairs are compared


def codes(df: DataFrame, columns: Sequence[str], bands: Mapping[str, float] | None = None) -> dict[str, Column]:
    """What other columns hang on: the value, of a column with a band its band; empty where it is null."""
    bands = bands or {}
    value = {c: band(F.col(f"`{c}`"), bands[c]) if c in bands else F.col(f"`{c}`") for c in columns}
    return {c: F.coalesce(v.cast("string"), F.lit("")) for c, v in value.items()}


def pair_information(df: DataFrame, coded: Mapping[str, Column]) -> dict[tuple[str, str], float]:
    """The mutual information of each pair of columns, in nats, from the counts of values and pairs.

    Equal rows are counted first, and only their counts are spread over the columns and pairs; what comes back
    is one number for each column and pair."""
    names = sorted(coded)
    sets = [(c,) for c in names] + list(combinations(names, 2))
    at = {c: F.col(f"c{i}") for i, c in enumerate(names)}
    alike = df.groupBy(*[coded[c].alias(f"c{i}") for i, c in enumerate(names)]).agg(F.count(F.lit(1)).alias("alike"))
    each = [F.struct(F.lit(i).alias("set"), F.array(*[at[c] for c in s]).alias("values")) for i, s in enumerate(sets)]
    counts = alike.select("alike", F.explode(F.array(*each)).alias("e")).groupBy("e.set", "e.values").agg(F.sum("alike").alias("n"))
    sums = counts.groupBy("set").agg(F.sum(F.col("n") * F.log("n")).alias("e"), F.sum("n").alias("rows"))
    found = {sets[r["set"]]: (r["e"], r["rows"]) for r in sums.collect()}
    return {
        (a, b): round(math.log(found[a, b][1]) + (found[a, b][0] - found[(a,)][0] - found[(b,)][0]) / found[a, b][1], DIGITS)
        for a, b in combinations(names, 2) if (a, b) in found
    }


def dependency_tree(information: Mapping[tuple[str, str], float], names: Sequence[str], root: str = ROOT) -> list[tuple[str, str]]:
    """(column, the column it hangs on), from the root outwards: the greatest spanning tree. Equal
    pairs go by the names of the column and of the one it hangs on."""
    done, tree = [root], []
    while len(done) <= len(names):
        best = min((-information.get((min(a, b), max(a, b)), 0.0), a, b) for a in names if a not in done for b in done)
        tree.append(best[1:])
        done.append(best[1])
    return tree


def levels(tree: Sequence[tuple[str, str]], root: str = ROOT) -> list[list[tuple[str, str]]]:
    depth, out = {root: 0}, []
    for child, parent in tree:
        depth[child] = depth[parent] + 1
        if len(out) < depth[child]:
            out.append([])
        out[depth[child] - 1].append((child, parent))
    return out


def synthesise_tree(
    donors: DataFrame,
    conditions: DataFrame,
    row_key: str,
    cell: Column,
    targets: Sequence[str],
    seed: str,
    bands: Mapping[str, float] | None = None,
    floor_rows: int = FLOOR_ROWS,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    tree: Sequence[tuple[str, str]] | None = None,
) -> DataFrame:
    """One synthetic row of targets per condition row: `row_key` and the targets.

    `cell` is the combination of conditions, over donors as over conditions. The draws follow from seed,
    column and row key. Null values are drawn like others. An empty table of conditions gives no rows.
    """
    coded = codes(donors, targets, bands)
    if tree is None:
        tree = dependency_tree(pair_information(donors, {**coded, ROOT: cell}), targets)
    types = dict(donors.dtypes)
    state = written(conditions.select(row_key, cell.alias("_cell")), "tree_rows")
    alike = donors.select(cell.alias("_cell"), *[F.col(f"`{t}`") for t in targets])
    for level in levels(tree):
        def each(df: DataFrame, seeded: bool) -> DataFrame:
            above = {**codes(df, [p for _, p in level if p != ROOT], bands), ROOT: F.col("_cell")}
            more = (lambda t: drawn_number(f"{seed}|{t}", F.col(row_key)).alias("number")) if seeded else (
                lambda t: F.col(f"`{t}`").cast("string").alias("value"))
            parts = F.explode(F.array(*[F.struct(
                F.lit(t).alias("feature"), F.concat_ws("|", F.lit(t), above[p]).alias("cell"),
                F.concat_ws("|", F.lit(t), F.lit(EVERYTHING)).alias("wide_cell"), more(t)) for t, p in level]))
            return df.select(*([row_key] if seeded else []), parts.alias("e")).select(*([row_key] if seeded else []), "e.*")

        drawn = draw_from_cells(each(alike, False), each(state, True), ["value"], [row_key, "feature"], floor_rows, rows_per_bucket)
        wide = drawn.groupBy(row_key).agg(*[
            F.max(F.when(F.col("feature") == t, F.col("value"))).cast(types[t]).alias(t) for t, _ in level])
        state = written(state.join(wide, row_key), "tree_rows")
    return state.select(row_key, *[F.col(f"`{t}`") for t in targets])
