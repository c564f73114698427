"""Column profiles: one row per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.plans.policy import role_by_name
from veilframe.session import local_table


def unpivoted(df: DataFrame, columns: Sequence[str], cast: str = "string", keep: Sequence[str] = ()) -> DataFrame:
    """One row per cell: `feature`, `value`, and the kept columns."""
    cells = [
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast(cast).alias("value")) for c in columns
    ]
    return df.select(*keep, F.explode(F.array(*cells)).alias("cell")).select(*keep, "cell.*")


def one_row_per_column(df: DataFrame, columns: Sequence[str], measures: dict) -> DataFrame:
    """All measures of all columns in one scan.

    `measures` maps a name to a function from column to aggregate. The scan ends in one
    wide row, which is turned on the driver: it has as many cells as the table has columns.
    """
    aggregates = [
        make(F.col(f"`{c}`")).alias(f"{name}_{i}")
        for i, c in enumerate(columns) for name, make in measures.items()
    ]
    wide = df.agg(*aggregates)
    values, width = wide.first(), len(measures)
    rows = [(c, *values[i * width:(i + 1) * width]) for i, c in enumerate(columns)]
    fields = [T.StructField(name, wide.schema[f"{name}_0"].dataType) for name in measures]
    schema = T.StructType([T.StructField("column", T.StringType()), *fields])
    return local_table(df.sparkSession, rows, schema)


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column, dtype, total_records, missing_values."""
    columns = list(columns or df.columns)
    counts = one_row_per_column(
        df, columns,
        {"total_records": lambda c: F.count(F.lit(1)), "missing_values": lambda c: F.count_if(c.isNull())},
    )
    types = [pair for pair in df.dtypes if pair[0] in columns]
    types = local_table(df.sparkSession, types, "column string, dtype string")
    return counts.join(types, "column").select("column", "dtype", "total_records", "missing_values")


def total_missing(df: DataFrame) -> Column:
    """Aggregate: missing cells over all columns."""
    cells = [F.col(f"`{c}`").isNull().cast("bigint") for c in df.columns]
    return F.coalesce(F.sum(sum(cells[1:], cells[0])), F.lit(0))


def distinct_counts(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """column, unique_values; nulls are no value.

    Exact: cells grouped by (column, value), then counted, so that no task holds the
    values of one column and no row is copied per distinct aggregate. Otherwise one
    sketch per column in a single scan.
    """
    if not exact:
        return one_row_per_column(df, columns, {"unique_values": F.approx_count_distinct})
    cells = unpivoted(df, columns)
    values = cells.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.lit(1))
    counted = values.groupBy("feature").agg(F.count(F.lit(1)).alias("unique_values"))
    return counted.select(F.col("feature").alias("column"), "unique_values")


def feature_metadata(df: DataFrame, mode: str = "token", exact: bool = True) -> DataFrame:
    """column, category, dtype, unique_values, missing_values."""
    profile = profile_columns(df)
    return profile.join(distinct_counts(df, df.columns, exact), "column", "left").select(
        "column",
        role_by_name(F.col("column"), mode).alias("category"),
        "dtype",
        F.coalesce("unique_values", F.lit(0)).alias("unique_values"),
        "missing_values",
    )
