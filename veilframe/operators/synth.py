"""Synthetic columns, drawn from the observed values of rows that are alike.

Rows are put into cells by their condition columns. The target values of a cell are
laid end to end, each as wide as the number of rows that hold it; a row's draw is a
position on that line, and the value there is its synthetic one. The draw follows
from the seed and the row's key, so any retry gives the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.functions.hashing import drawn_number
from veilframe.operators.ordering import ROWS_PER_BUCKET, numbered, running_before
from veilframe.session import sent_if_small, written, written_and_counted, written_and_sized

# Positions per chunk: a cell of any size is looked up in pieces of about this many rows.
CHUNK = 100_000
EVERYTHING = "*"


def condition_cell(*parts: Column) -> Column:
    """One text per combination of conditions; missing parts keep their place."""
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def band(value: Column, width: float) -> Column:
    """The number of the fixed-width band a value lies in."""
    return F.floor(value / F.lit(width)).cast("bigint")


def interval_lookup(draws: DataFrame, intervals: DataFrame, row_key: Sequence[str]) -> DataFrame:
    """For each draw (cell, at), the `hit` of the interval [before, before + width) it falls in.

    No pairs are formed: both sides are sorted together within (cell, chunk, part), and each
    draw takes the last interval that starts at or before it. An interval is listed once
    in every chunk it touches, so a chunk needs nothing from its neighbours. A chunk with many
    draws is cut into parts by a hash of the row key, and its intervals are listed in each;
    chunks that no draw falls in are left out.
    """
    asked = draws.select("cell", F.expr(f"at div {CHUNK}").alias("chunk"), "at", *row_key)
    asked = written(asked, "draws")
    parts = asked.groupBy("cell", "chunk").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("parts"))
    parts, size = written_and_sized(parts, "draw_parts")
    parts = sent_if_small(parts, size)
    touched = F.expr(f"sequence(before div {CHUNK}, (before + width - 1) div {CHUNK})")
    starts = intervals.select("cell", "hit", "before", F.explode(touched).alias("chunk")).join(parts, ["cell", "chunk"]).select(
        "cell", "chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"),
        F.greatest("before", F.col("chunk") * CHUNK).alias("at"), "hit", F.lit(0).alias("side"),
    )
    placed = asked.join(parts, ["cell", "chunk"]).select(
        "cell", "chunk", F.pmod(F.xxhash64(*row_key), F.col("parts")).cast("bigint").alias("part"), "at",
        F.lit(1).alias("side"), *row_key
    )
    line = Window.partitionBy("cell", "chunk", "part").orderBy("at", "side")
    line = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = starts.unionByName(placed, allowMissingColumns=True)
    found = both.select(*row_key, "side", F.last("hit", ignorenulls=True).over(line).alias("hit"))
    return found.where(F.col("side") == 1).select(*row_key, "hit")


def draw_from_cells(
    donors: DataFrame,
    draws: DataFrame,
    values: Sequence[str],
    row_key: Sequence[str],
    floor_rows: int = 1,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """For each draw (cell, wide_cell, number) one observed combination of `values`.

    A cell with fewer than `floor_rows` donors is not used: its rows draw from the wide
    cell instead. Only cells that some draw needs are laid out.
    """
    counts = donors.groupBy("cell", "wide_cell", *values).agg(F.count(F.lit(1)).alias("width"))
    counts = written(counts, "cell_counts")
    wanted = draws.groupBy("cell", "wide_cell").agg(F.lit(1))
    sizes = counts.groupBy("cell").agg(F.sum("width").alias("size")).where(F.col("size") >= floor_rows)
    wanted = wanted.select("cell", "wide_cell").join(sizes, "cell", "left")
    wanted = written(wanted, "cell_sizes")
    sizes, size = written_and_sized(wanted.where(F.col("size").isNotNull()).select("cell", "size").distinct(), "cell_sizes")
    sizes = sent_if_small(sizes, size)
    # The wide cells are one, or one per target column: a small map.
    wides = [r[0] for r in wanted.where(F.col("size").isNull()).select("wide_cell").distinct().collect()]
    usable = counts.join(sizes, "cell", "left_semi").select("cell", *values, "width")
    wide = counts.where(F.col("wide_cell").isin(wides)).groupBy(F.col("wide_cell").alias("cell"), *values).agg(F.sum("width").alias("width"))
    cells, rows = written_and_counted(usable.unionByName(wide) if wides else usable, "cells")
    laid = running_before(cells, list(values), {"before": F.col("width")}, ["cell"], rows_per_bucket, rows)
    intervals = laid.select("cell", F.struct(*values).alias("hit"), "before", "width")

    wide_sizes = counts.groupBy("wide_cell").agg(F.sum("width").alias("size"))
    wide_sizes = wide_sizes.agg(
        F.map_from_entries(F.collect_list(F.struct("wide_cell", "size"))).alias("m")
    ).scalar()
    placed = draws.join(sizes, "cell", "left").select(
        *row_key,
        F.when(F.col("size").isNull(), F.col("wide_cell")).otherwise(F.col("cell")).alias("cell"),
        F.pmod("number", F.coalesce("size", wide_sizes[F.col("wide_cell")])).alias("at"),
    )
    return interval_lookup(placed, intervals, row_key).select(*row_key, "hit.*")


def synthesise(
    donors: DataFrame,
    conditions: DataFrame,
    row_key: str,
    cell: Column,
    targets: Sequence[str],
    seed: str,
    floor_rows: int = 1,
    mode: str = "joint",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """One synthetic row of targets per condition row: `row_key` and the targets.

    'joint' draws all targets of one donor together and keeps their correlations;
    'marginal' draws each on its own and replays no real combination.
    """
    if mode == "joint":
        alike = donors.select(cell.alias("cell"), F.lit(EVERYTHING).alias("wide_cell"), *targets)
        asked = conditions.select(
            row_key, cell.alias("cell"), F.lit(EVERYTHING).alias("wide_cell"),
            drawn_number(seed, F.col(row_key)).alias("number"),
        )
        return draw_from_cells(alike, asked, targets, [row_key], floor_rows, rows_per_bucket)

    def per_target(df, *more):
        each = F.explode(F.array(*[
            F.struct(F.lit(t).alias("feature"), *[make(t) for make in more]) for t in targets
        ]))
        parts = df.select(*([row_key] if df is conditions else []), cell.alias("_cell"), each.alias("e"))
        return parts.select(
            *([row_key] if df is conditions else []), "e.*",
            F.concat_ws("|", "e.feature", "_cell").alias("cell"),
            F.concat_ws("|", "e.feature", F.lit(EVERYTHING)).alias("wide_cell"),
        )

    alike = per_target(donors, lambda t: F.col(f"`{t}`").cast("string").alias("value"))
    asked = per_target(
        conditions, lambda t: drawn_number(f"{seed}|{t}", F.col(row_key)).alias("number")
    )
    drawn = draw_from_cells(alike, asked, ["value"], [row_key, "feature"], floor_rows, rows_per_bucket)
    types = dict(donors.dtypes)
    return drawn.groupBy(row_key).agg(*[
        F.max(F.when(F.col("feature") == t, F.col("value"))).cast(types[t]).alias(t) for t in targets
    ])


def cycled_conditions(
    conditions: DataFrame, order_key: str, samples: int, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """`samples` rows that go round the conditions in order: sample i takes row i mod n."""
    rows, size = written_and_sized(conditions, "conditions")
    count = rows.count()
    # Few conditions are few join keys, however many samples: they go to every executor.
    placed = sent_if_small(numbered(rows, [order_key], "_place", (), rows_per_bucket, count), size)
    wanted = conditions.sparkSession.range(samples).select(F.col("id").alias("sample"))
    wanted = wanted.withColumn("_at", F.col("sample") % F.lit(max(count, 1)) + 1)
    return wanted.join(placed, F.col("_at") == F.col("_place")).drop("_at", "_place")


def synthesise_samples(
    donors: DataFrame,
    conditions: DataFrame,
    order_key: str,
    samples: int,
    cell: Column,
    targets: Sequence[str],
    seed: str,
    floor_rows: int = 1,
) -> DataFrame:
    """Any number of synthetic rows, also more than there are conditions: `sample` and the targets."""
    asked = cycled_conditions(conditions, order_key, samples)
    return synthesise(donors, asked, "sample", cell, targets, seed, floor_rows)
