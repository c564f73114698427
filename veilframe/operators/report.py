"""Reports about a finished job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.fixed_values import METHODS_APPLIED
from veilframe.operators.dictionary import NAMESPACES, namespace_sizes


def summary_report(
    output: DataFrame,
    dictionary: DataFrame,
    removed: Sequence[str],
    generalized: Sequence[str],
    namespaces: Sequence[str] = tuple(NAMESPACES),
    methods: Sequence[str] = tuple(METHODS_APPLIED),
) -> DataFrame:
    """One row: records, columns, entries per namespace, what was removed and generalised."""
    sizes = namespace_sizes(dictionary).agg(
        F.map_from_entries(F.collect_list(F.struct("namespace", "entries"))).alias("m")
    ).scalar()  # one entry per namespace
    return output.agg(F.count(F.lit(1)).alias("total_records")).select(
        "total_records",
        F.lit(len(output.columns)).cast("bigint").alias("total_columns"),
        F.struct(*[F.coalesce(sizes[F.lit(n)], F.lit(0)).alias(n) for n in namespaces]).alias(
            "mappings_generated"
        ),
        F.lit(len(removed)).alias("columns_removed"),
        F.lit(len(generalized)).alias("date_columns_generalized"),
        F.array(*[F.lit(m) for m in methods]).alias("anonymization_methods_applied"),
    )


def mapping_summary(dictionary: DataFrame) -> DataFrame:
    """Entries per namespace, and their total as the row 'total_mappings'."""
    counts = dictionary.rollup("namespace").agg(F.count(F.lit(1)).alias("entries"))
    return counts.select(F.coalesce("namespace", F.lit("total_mappings")).alias("namespace"), "entries")


def run_audit(rows_in: Column, output: DataFrame, parameters: Mapping[str, str], seed: str | None = None,
              finished: Column | None = None) -> DataFrame:
    """One row per run: its parameters, rows read and rows written, and where given the seed and the time."""
    more = {} if seed is None else {"seed": F.lit(seed)}
    if finished is not None:
        more["finished"] = finished
    return output.agg(F.count(F.lit(1)).alias("rows_out")).select(
        *[F.lit(v).alias(k) for k, v in parameters.items()], *[c.alias(n) for n, c in more.items()], rows_in.alias("rows_in"), "rows_out"
    )


def append_audit(audit: DataFrame, folder: str) -> None:
    """Add the row of a run to the log; the rows of earlier runs stay as they are."""
    audit.coalesce(1).write.mode("append").parquet(folder)


def load_audit(spark: SparkSession, folder: str) -> DataFrame:
    """All runs of a log, also where later ones have more columns."""
    return spark.read.option("mergeSchema", True).parquet(folder)
