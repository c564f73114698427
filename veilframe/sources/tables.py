"""Reading tables: text first, then missing values and types."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.fixed_values import MISSING_TOKENS
from veilframe.operators.columns import first_rows
from veilframe.operators.profile import one_row_per_column
from veilframe.sources.quoted_lines import PLACE, read_quoted

POSITION = "source_position"

WHOLE = r"^\s*[+-]?[0-9]+\s*$"
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+|[Ii]nf(inity)?)([eE][+-]?[0-9]+)?\s*$"


def scan_csv(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str] | None = None,
    infer: bool = False,
    position: bool = False,
    rows: int | None = None,
    order_key: str | None = None,
    line_breaks: str = "none",
) -> DataFrame:
    """A CSV file with a header. Columns stay text unless `types` names them or `infer`
    is set. `position` adds the place in the source, to use as an order key.

    `line_breaks`: 'none' takes every line for a row, and a file is read in pieces by many
    tasks; 'quoted' lets quoted cells hold breaks, and each file is read by one task; 'parallel'
    gives the same rows from many tasks a file, where quotes are paired by the rules of the format;
    'escaped' undoes what `write_csv` did to them.
    """
    df = _read_csv(spark, path, line_breaks)
    if position:
        df = with_position(df)
        order_key = order_key or POSITION
    elif PLACE in df.columns:
        df = df.drop(PLACE)
    if rows is not None:
        if order_key is None:
            raise ValueError("the first rows need an order key or a position")
        df = first_rows(df, order_key, rows)
    df = missing_to_null(df)
    if infer:
        types = {**inferred_types(df), **(types or {})}
    return with_types(df, types or {})


def _read_csv(spark: SparkSession, path: str, line_breaks: str) -> DataFrame:
    if line_breaks not in ("none", "quoted", "parallel", "escaped"):
        raise ValueError(f"line_breaks cannot be {line_breaks!r}")
    if line_breaks == "parallel":
        return read_quoted(spark, path)
    df = spark.read.options(header=True, escape='"', nullValue="", multiLine=line_breaks == "quoted").csv(path)
    if line_breaks != "escaped":
        return df

    def unescaped(c):
        # The mark of an escaped backslash is set aside, so that what follows it is not taken for a break.
        aside = F.replace(c, F.lit("\\\\"), F.lit("\0"))
        return F.replace(F.replace(F.replace(aside, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")), F.lit("\0"), F.lit("\\"))

    return df.select(*[unescaped(F.col(f"`{c}`")).alias(c) for c in df.columns])


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return missing_to_null(spark.read.parquet(path))


def with_position(df: DataFrame) -> DataFrame:
    """Add where each row stands: file, block, row. Must be applied to the scan itself."""
    if PLACE in df.columns:
        lined = F.struct(F.col(f"{PLACE}.file").alias("file"), F.lit(0).cast("bigint").alias("block"), F.col(f"{PLACE}.line").alias("row"))
        return df.select(*[F.col(f"`{c}`") for c in df.columns if c != PLACE], lined.alias(POSITION))
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select("*", place.alias(POSITION))


def missing_to_null(df: DataFrame) -> DataFrame:
    """The texts that stand for a missing value, and NaN, become null."""
    def clean(field):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            column = F.when(~column.isin(MISSING_TOKENS), column)
        elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            column = F.when(~F.isnan(column), column)
        return column.alias(field.name)

    return df.select(*[clean(f) for f in df.schema])


def inferred_types(df: DataFrame) -> dict[str, str]:
    """Per text column the narrowest of bigint, double, string that keeps every cell apart. One scan.

    Whole numbers that a bigint cannot hold are names, and so are those beyond 15 digits in a
    column with fractions, as a double would merge them: such columns stay text.
    """
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    misfits = one_row_per_column(
        df, texts,
        {
            "cells": F.count,
            "not_bigint": lambda c: F.count_if(~c.rlike(WHOLE)),
            "too_long": lambda c: F.count_if(c.rlike(WHOLE) & c.try_cast("bigint").isNull()),
            "not_double": lambda c: F.count_if(~c.rlike(NUMBER)),
            "not_exact": lambda c: F.count_if(c.rlike(WHOLE) & (F.length(F.regexp_replace(c, r"^\s*[+-]?0*|\s", "")) > 15)),
        },
    )
    types = {}
    for row in misfits.collect():  # one row per column
        if row.not_double or row.too_long:
            continue
        if row.not_bigint == 0 and row.cells > 0:
            types[row.column] = "bigint"
        elif row.not_exact == 0:
            types[row.column] = "double"
    return types


def with_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; a cell that does not fit becomes null."""
    return df.select(*[
        F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns
    ])


def write_csv(df: DataFrame, path: str, line_breaks: str = "refuse") -> None:
    """A CSV file that is safe to read line by line: with 'refuse' a text that holds a line break
    ends the write, with 'escape' breaks and backslashes are written as \\n, \\r and \\\\. 'quoted'
    writes them as they are, for readers that take quoted breaks."""
    if line_breaks not in ("refuse", "escape", "quoted"):
        raise ValueError(f"line_breaks cannot be {line_breaks!r}")

    def safe(field):
        c = F.col(f"`{field.name}`")
        if not isinstance(field.dataType, T.StringType) or line_breaks == "quoted":
            return c.alias(field.name)
        if line_breaks == "refuse":
            message = F.lit(f"a line break in column {field.name}: write with line_breaks='escape' or 'quoted'")
            return F.when(c.rlike("[\\r\\n]"), F.raise_error(message)).otherwise(c).alias(field.name)
        out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
        return F.replace(F.replace(out, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")).alias(field.name)

    df.select(*[safe(f) for f in df.schema]).write.options(
        header=True, escape='"', nullValue="", emptyValue='""', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Reports and profiles."""
    df.write.option("ignoreNullFields", False).json(path)


def row_count(spark: SparkSession, path: str, line_breaks: str = "none") -> int:
    """Rows of a written CSV file; `line_breaks` as in `scan_csv`."""
    return _read_csv(spark, path, line_breaks).count()
