"""Paired measurements per run and epoch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def read_history(spark, path: str) -> DataFrame:
    """A history file: one object of parallel arrays."""
    schema = "g_losses array<double>, d_losses array<double>, g_lr array<double>, d_lr array<double>, epochs array<int>"
    return spark.read.schema(schema).option("multiLine", True).json(path)


def unnest_series(df: DataFrame, arrays: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Parallel arrays to rows: the kept columns, `position`, and one column per array."""
    zipped = F.arrays_zip(*[F.col(a) for a in arrays])
    return df.select(*keep, F.posexplode(zipped).alias("position", "v")).select(*keep, "position", "v.*")


def rollup_series(df: DataFrame, run: str, epoch: str, values: Sequence[str]) -> DataFrame:
    """Mean of each value per run and epoch."""
    return df.groupBy(run, epoch).agg(*[F.avg(v).alias(v) for v in values])


def latest_values(df: DataFrame, run: str, epoch: str, values: Sequence[str]) -> DataFrame:
    """The last epoch of each run and the values there."""
    return df.groupBy(run).agg(
        F.max(epoch).alias(epoch), *[F.max_by(v, epoch).alias(v) for v in values]
    )


def paired_ratio(df: DataFrame, first: str, second: str) -> DataFrame:
    """Add first / second (0 where second is not positive) and the absolute difference."""
    a, b = F.col(first), F.col(second)
    return df.withColumn("ratio", F.when(b > 0, a / b).otherwise(0.0)).withColumn(
        "difference", F.abs(a - b)
    )
