"""Running totals and numbers over a global order, without one task holding a group.

A window without partitioning, or partitioned by a column in which one value holds
most rows, sorts those rows in a single task. Here the rows are dealt out by ranges of
the whole order (group, order columns) and written with the number of their range; each
range is summed on its own and then shifted by the total of the ranges before it. There
is one plan for tables of any size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.session import sent_if_small, written, written_and_sized

# A range of this many rows is a small sort for one task.
ROWS_PER_BUCKET = 1_000_000


def _ranges(table: DataFrame, key: Sequence[str], rows: int, rows_per_bucket: int) -> DataFrame:
    least = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return table.repartitionByRange(max(least, -(-rows // rows_per_bucket)), *key)


def dealt_by_range(table: DataFrame, key: Sequence[str], rows: int, rows_per_bucket: int) -> DataFrame:
    """The rows in ranges of the key, written, with the number of the range as `_bucket`.

    Written at once: the ranges follow from a sample, and every reader has to see the same.
    """
    dealt = _ranges(table, key, rows, rows_per_bucket)
    return written(dealt.withColumn("_bucket", F.spark_partition_id()), "ranges")


def running_before(
    table: DataFrame,
    order: Sequence[str],
    weights: Mapping[str, Column],
    group: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
    rows: int | None = None,
) -> DataFrame:
    """Add, for each weight, its sum over the earlier rows of the same group.

    `table` must be a written table, (`group`, `order`) unique in it and `group` not null.
    Its `rows` are counted when not given; they only choose the number of ranges.
    """
    rows = table.count() if rows is None else rows
    bucketed = dealt_by_range(table, [*group, *order], rows, rows_per_bucket)
    totals = bucketed.groupBy(*group, "_bucket").agg(
        *[F.sum(w).alias(f"_total_{n}") for n, w in weights.items()]
    )
    # One row per range, and one more for each border between groups inside a range.
    earlier = (
        Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = totals.select(
        *[F.col(g).alias(f"_g_{g}") for g in group],
        F.col("_bucket").alias("_b"),
        *[
            F.coalesce(F.sum(f"_total_{n}").over(earlier), F.lit(0)).alias(f"_shift_{n}")
            for n in weights
        ],
    )
    within = Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = bucketed.select(
        "*", *[F.coalesce(F.sum(w).over(within), F.lit(0)).alias(f"_inside_{n}") for n, w in weights.items()]
    )
    same = F.col("_bucket") == F.col("_b")
    for g in group:
        same = same & (F.col(g) == F.col(f"_g_{g}"))
    return inside.join(shifts, same).select(
        *[F.col(f"`{c}`") for c in table.columns],
        *[(F.col(f"_inside_{n}") + F.col(f"_shift_{n}")).alias(n) for n in weights],
    )


def numbered(
    table: DataFrame,
    order: Sequence[str],
    name: str,
    group: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
    rows: int | None = None,
) -> DataFrame:
    """Number the rows of each group 1, 2, 3 … in the given order.

    Demands on `table` are those of `running_before`. The ranges are sorted as they are written and
    each row keeps its place, so the rows are shuffled once; what is added to the places
    has a row per range and group in it.
    """
    rows = table.count() if rows is None else rows
    key = [*group, *order]
    # Number of the range above, number of the row in it below.
    ordered = _ranges(table, key, rows, rows_per_bucket).sortWithinPartitions(*key)
    placed = written(ordered.withColumn("_at_place", F.monotonically_increasing_id()), "ranges")
    placed = placed.withColumn("_bucket", F.shiftright("_at_place", 33))
    firsts = placed.groupBy(*group, "_bucket").agg(F.min("_at_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = firsts.select(
        *[F.col(g).alias(f"_g_{g}") for g in group], F.col("_bucket").alias("_b"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) + 1 - F.col("_first")).alias("_shift"),
    )
    shifts, size = written_and_sized(shifts, "range_starts")
    same = F.col("_bucket") == F.col("_b")
    for g in group:
        same = same & (F.col(g) == F.col(f"_g_{g}"))
    return placed.join(sent_if_small(shifts, size), same).select(
        *[F.col(f"`{c}`") for c in table.columns], (F.col("_at_place") + F.col("_shift")).alias(name))


def following(
    table: DataFrame,
    order: Sequence[str],
    names: Mapping[str, str],
    group: Sequence[str] = (),
    rows_per_bucket: int = ROWS_PER_BUCKET,
    rows: int | None = None,
) -> DataFrame:
    """Add the columns `names` (new name: column) of the next row of the same group, null at its end.

    Demands on `table` are those of `running_before`.
    """
    rows = table.count() if rows is None else rows
    bucketed = dealt_by_range(table, [*group, *order], rows, rows_per_bucket)
    taken = F.struct(*[F.col(c).alias(n) for n, c in names.items()])
    firsts = bucketed.groupBy(*group, "_bucket").agg(F.min(F.struct(*order, taken.alias("_taken"))).alias("_first"))
    later = Window.partitionBy(*group).orderBy("_bucket")
    firsts = firsts.select(
        *[F.col(g).alias(f"_g_{g}") for g in group], F.col("_bucket").alias("_b"), F.lead("_first._taken").over(later).alias("_beyond"))
    within = Window.partitionBy(*group, "_bucket").orderBy(*order)
    inside = bucketed.select("*", F.lead(taken).over(within).alias("_next"))
    same = F.col("_bucket") == F.col("_b")
    for g in group:
        same = same & (F.col(g) == F.col(f"_g_{g}"))
    found = F.coalesce("_next", "_beyond")
    return inside.join(firsts, same).select(
        *[F.col(f"`{c}`") for c in table.columns], *[found[n].alias(n) for n in names])
