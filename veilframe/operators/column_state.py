"""What is known of each column, kept as a small state that grows by batches without re-reading old rows.

A batch gives one row a column: counts, moments, ends and a sketch of its distinct values. States are added up
in any order; counts, ends and distinct estimates of ten batches are those of one pass to the digit, means
and deviations to rounding.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# 2^14 registers: the estimate is off by 0.8 % (one standard error).
SKETCH_BITS = 14
SCHEMA = ("column string, rows bigint, nulls bigint, numbers bigint, mean double, m2 double, least double, most double, "
          "first string, last string, sketch binary")


def column_state(df: DataFrame, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """One row a column: rows, nulls, and of number columns count, mean, sum of squared deviations, least and most;
    of all columns the first and last value as text, and a sketch of the distinct values. One scan."""
    columns = df.columns

    def cells(field: T.StructField):
        value = F.col(f"`{field.name}`")
        number = value.cast("double") if isinstance(field.dataType, T.NumericType) else F.lit(None).cast("double")
        number = F.when(~F.isnan(number), number)
        return F.struct(F.lit(field.name).alias("column"), value.cast("string").alias("text"), number.alias("number"))

    if not columns:
        return df.sparkSession.createDataFrame([], SCHEMA)
    each = df.select(F.explode(F.array(*[cells(f) for f in df.schema])).alias("c")).select("c.*")
    found = each.groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("text").isNull()).alias("nulls"), F.count("number").alias("numbers"),
        F.avg("number").alias("mean"), (F.var_pop("number") * F.count("number")).alias("m2"),
        F.min("number").alias("least"), F.max("number").alias("most"), F.min("text").alias("first"), F.max("text").alias("last"),
        F.hll_sketch_agg("text", sketch_bits).alias("sketch"))
    return found.select(*[f.name for f in T.StructType.fromDDL(SCHEMA)])


def merged_state(*states: DataFrame) -> DataFrame:
    """The states of several batches as one."""
    together = reduce(DataFrame.unionByName, states)
    weighted = F.sum(F.col("mean") * F.col("numbers"))
    mean = weighted / F.sum("numbers")
    m2 = F.sum("m2") + F.sum(F.col("numbers") * F.col("mean") * F.col("mean")) - weighted * weighted / F.sum("numbers")
    return together.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.sum("numbers").alias("numbers"),
        F.when(F.sum("numbers") > 0, mean).alias("mean"), F.when(F.sum("numbers") > 0, F.greatest(m2, F.lit(0.0))).alias("m2"),
        F.min("least").alias("least"), F.max("most").alias("most"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.hll_union_agg("sketch").alias("sketch"))


def append_state(state: DataFrame, folder: str, batch: int | str) -> None:
    """Save a batch's state; a batch that runs again takes the place of its first run."""
    state.coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch={batch}")


def load_state(spark: SparkSession, folder: str) -> DataFrame | None:
    """The state of all batches saved in the folder; None where there are none."""
    try:
        saved = spark.read.schema(SCHEMA).parquet(f"{folder}/batch=*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return merged_state(saved)


def state_report(state: DataFrame) -> DataFrame:
    """column, rows, nulls, distinct (estimate), mean, deviation (of the sample), least, most, first, last."""
    deviation = F.when(F.col("numbers") > 1, F.sqrt(F.col("m2") / (F.col("numbers") - 1)))
    return state.select("column", "rows", "nulls", F.hll_sketch_estimate("sketch").alias("distinct"), "mean",
                        deviation.alias("deviation"), "least", "most", "first", "last")


def scale_state_of(state: DataFrame) -> DataFrame:
    """feature, lo, hi, mean, std (of the whole population) of the number columns, as the scaling operators take it."""
    return state.where(F.col("numbers") > 0).select(
        F.col("column").alias("feature"), F.col("least").alias("lo"), F.col("most").alias("hi"), "mean",
        F.sqrt(F.col("m2") / F.col("numbers")).alias("std"))
