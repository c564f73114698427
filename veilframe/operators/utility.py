"""How much of the original a changed table keeps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.operators.ordering import ROWS_PER_BUCKET, running_before
from veilframe.operators.profile import one_row_per_column, unpivoted
from veilframe.session import written_and_counted


def _counted_sides(original, output, columns, cast):
    """(feature, value, before, after): cells of each value on both sides."""
    sides = unpivoted(original, columns, cast).withColumn("side", F.lit(0)).unionByName(
        unpivoted(output, columns, cast).withColumn("side", F.lit(1))
    )
    return sides.groupBy("feature", "value").agg(
        F.count_if(F.col("side") == 0).alias("n_original"), F.count_if(F.col("side") == 1).alias("n_output")
    )


def category_distance(original: DataFrame, output: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column the total variation distance: half the summed difference of shares."""
    counts = _counted_sides(original, output, columns, "string")
    # A null is a value like any other here. One row per column on the right.
    totals = counts.groupBy("feature").agg(
        F.sum("n_original").alias("all_original"), F.sum("n_output").alias("all_output")
    )
    shares = counts.join(F.broadcast(totals), "feature")
    gap = F.abs(F.col("n_original") / F.col("all_original") - F.col("n_output") / F.col("all_output"))
    return shares.groupBy("feature").agg((F.sum(gap) / 2).alias("distance"))


def number_distance(
    original: DataFrame, output: DataFrame, columns: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Per column the largest gap of the two cumulative distributions, and the change of
    mean and standard deviation. Missing cells are left out."""
    counts = _counted_sides(original, output, columns, "double").where(F.col("value").isNotNull())
    counts, rows = written_and_counted(counts, "value_counts")
    totals = counts.groupBy("feature").agg(
        F.sum("n_original").alias("all_original"), F.sum("n_output").alias("all_output")
    )
    placed = running_before(
        counts, ["value"], {"lower_original": F.col("n_original"), "lower_output": F.col("n_output")},
        ["feature"], rows_per_bucket, rows,
    ).join(F.broadcast(totals), "feature")  # one row per column
    reached = lambda side: (F.col(f"lower_{side}") + F.col(f"n_{side}")) / F.col(f"all_{side}")
    gaps = placed.groupBy("feature").agg(
        F.max(F.abs(reached("original") - reached("output"))).alias("ks_distance")
    )

    def moments(df, side):
        found = one_row_per_column(
            df, columns, {"mean": lambda c: F.avg(c.cast("double")), "std": lambda c: F.stddev_pop(c.cast("double"))}
        )
        return found.select(F.col("column").alias("feature"), F.col("mean").alias(f"mean_{side}"),
                            F.col("std").alias(f"std_{side}"))

    both = moments(original, "original").join(moments(output, "output"), "feature")
    return gaps.join(both, "feature").select(
        "feature", "ks_distance",
        (F.col("mean_output") - F.col("mean_original")).alias("mean_change"),
        (F.col("std_output") - F.col("std_original")).alias("std_change"),
    )


def completeness(original: DataFrame, output: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column the share of cells that hold a value, before and after."""
    share = {"share": lambda c: F.count(c) / F.count(F.lit(1))}
    before = one_row_per_column(original, columns, share).withColumnRenamed("share", "share_original")
    after = one_row_per_column(output, columns, share).withColumnRenamed("share", "share_output")
    return before.join(after, "column")


def number_range_validation(original: DataFrame, output: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column the cells outside the original's least and greatest value."""
    ends = original.agg(*[
        F.struct(F.min(f"`{c}`").alias("lo"), F.max(f"`{c}`").alias("hi")).alias(c) for c in columns
    ])
    ends = ends.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("e")).scalar()
    outside = output.agg(*[
        F.struct(
            F.count(f"`{c}`").alias("cells"),
            F.count_if((F.col(f"`{c}`") < ends[c]["lo"]) | (F.col(f"`{c}`") > ends[c]["hi"])).alias("outside"),
        ).alias(c)
        for c in columns
    ])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`.cells"), F.col(f"`{c}`.outside")) for c in columns]
    return outside.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def label_validation(original: DataFrame, output: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column the cells whose text the original does not have."""
    known = unpivoted(original, columns).where(F.col("value").isNotNull()).distinct()
    cells = unpivoted(output, columns).where(F.col("value").isNotNull())
    # Reduced to one row per value before the join.
    counts = cells.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    marked = counts.join(known.withColumn("known", F.lit(True)), ["feature", "value"], "left")
    return marked.groupBy(F.col("feature").alias("column")).agg(
        F.sum("n").alias("cells"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("outside"),
    )


def correlations(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    wide = df.agg(*[F.corr(f"`{a}`", f"`{b}`").alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias(name))
        for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def correlation_preservation(original: DataFrame, output: DataFrame, columns: Sequence[str]) -> DataFrame:
    """a, b, corr_original, corr_output, change for every pair of number columns."""
    both = correlations(original, columns, "corr_original").join(
        correlations(output, columns, "corr_output"), ["a", "b"]
    )
    return both.withColumn("change", F.col("corr_output") - F.col("corr_original"))
