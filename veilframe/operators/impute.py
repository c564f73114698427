"""Filling missing cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.fixed_values import UNKNOWN
from veilframe.functions.guards import number_columns, text_columns
from veilframe.operators.ordering import ROWS_PER_BUCKET, running_before
from veilframe.operators.profile import one_row_per_column, total_missing
from veilframe.session import local_table, written

# Ranks within which the median lies for certain, and the rank error of the summaries (1 / accuracy).
BRACKET = (0.495, 0.505)
ACCURACY = 1000


def exact_medians(df: DataFrame, columns: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET,
                  bracket: tuple[float, float] | None = BRACKET) -> DataFrame:
    """feature, median: the exact median of each column; a column without values has none.

    Only cells near the median are shuffled. One scan brackets the median of every column by a
    quantile summary of the values it has, however few; tasks send their summaries, whose size is
    fixed. A second scan counts the cells below the bracket, and those inside are ranked. The
    counts prove that the median lies inside; a column where it does not, or every column
    without a `bracket`, is ranked over all its cells.
    """
    spark, columns = df.sparkSession, list(columns)
    schema = "feature string, median double"
    if not columns:
        return local_table(spark, [], schema)
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    sides = [F.percentile_approx(f"`{c}`", list(bracket), ACCURACY).alias(f"{i}_ends") for i, c in enumerate(columns)] if bracket else []
    seen = numbers.agg(*[F.count(f"`{c}`").alias(f"{i}_cells") for i, c in enumerate(columns)], *sides).first()
    totals = {c: seen[f"{i}_cells"] for i, c in enumerate(columns)}
    ends = {c: tuple(seen[f"{i}_ends"]) if bracket else (float("-inf"), float("inf")) for i, c in enumerate(columns) if totals[c]}
    columns = list(ends)
    if not columns:
        return local_table(spark, [], schema)

    # A null value stands for a cell below the bracket; cells above it are left out.
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.when(F.col(f"`{c}`") >= low, F.col(f"`{c}`")).alias("value"),
            (F.col(f"`{c}`") <= high).alias("kept"),
        )
        for c, (low, high) in ends.items()
    ]
    counted = numbers.select(F.explode(F.array(*cells)).alias("cell")).where("cell.kept")
    counted = counted.groupBy("cell.feature", "cell.value").agg(F.count(F.lit(1)).alias("cells"))
    counted = written(counted, "median_cells")
    found = counted.groupBy("feature").agg(
        F.count("value").alias("values"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("cells"))), F.lit(0)).alias("below"),
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("cells"))), F.lit(0)).alias("inside"),
    )
    places, values = [], 0
    for row in found.collect():  # one row per column
        values += row["values"]
        lower, upper = (totals[row.feature] - 1) // 2 - row.below, totals[row.feature] // 2 - row.below
        if 0 <= lower and upper < row.inside:
            places.append((row.feature, lower, upper))
    placed = {feature for feature, _, _ in places}
    missed = [c for c in columns if c not in placed]

    ranked = running_before(
        counted.where(F.col("value").isNotNull()), ["value"], {"before": F.col("cells")}, ["feature"],
        rows_per_bucket, values,
    )
    wanted = local_table(spark, places, "feature string, lower bigint, upper bigint")
    after = F.col("before") + F.col("cells")
    middle = ranked.join(wanted, "feature").where(
        ((F.col("before") <= F.col("lower")) & (F.col("lower") < after))
        | ((F.col("before") <= F.col("upper")) & (F.col("upper") < after))
    )
    medians = middle.groupBy("feature").agg(((F.min("value") + F.max("value")) / 2).alias("median"))
    if missed:
        medians = medians.unionByName(exact_medians(df, missed, rows_per_bucket, None))
    return medians


def approx_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """feature, median: an element close to the median, in one scan."""
    found = one_row_per_column(df, columns, {"median": lambda c: F.percentile_approx(c.cast("double"), 0.5)})
    return found.select(F.col("column").alias("feature"), "median")


def fill_text(df: DataFrame, columns: Sequence[str] | None = None, value: str = UNKNOWN) -> DataFrame:
    return df.na.fill(value, subset=list(text_columns(df) if columns is None else columns))


def fill_numbers(
    df: DataFrame, columns: Sequence[str] | None = None, medians: DataFrame | None = None
) -> DataFrame:
    """Fill with each column's median, or with 0 when no medians are given.

    Filled columns become doubles: the median of whole numbers may lie between two.
    """
    columns = number_columns(df) if columns is None else list(columns)
    if medians is None:
        return df.na.fill(0, subset=columns)
    known = {r.feature: r.median for r in medians.collect()}  # one number per column

    def filled(column):
        number = F.col(f"`{column}`").cast("double")
        if known.get(column) is not None:
            number = F.coalesce(number, F.lit(known[column]))
        return number.alias(column)

    return df.select(*[filled(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def missing_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """missing_before, missing_after, filled — one row."""
    first = before.agg(total_missing(before).alias("n")).scalar()
    return (
        after.agg(total_missing(after).alias("missing_after"))
        .select(first.alias("missing_before"), "missing_after")
        .withColumn("filled", F.col("missing_before") - F.col("missing_after"))
    )
