"""Missing values and key texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBERS = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
)
FRACTIONS = (T.FloatType, T.DoubleType, T.DecimalType)


def is_missing(text: Column) -> Column:
    return text.isNull() | (text == "")


def unless_missing(text: Column, changed: Column) -> Column:
    """Null and empty text pass through; everything else becomes `changed`."""
    return F.when(is_missing(text), text).otherwise(changed)


def key_text(df: DataFrame, column: str) -> Column:
    """The one text of a key, whatever type it was read as: 5, 5L and 5.0 are all '5'."""
    value = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, FRACTIONS):
        number = value.cast("double")
        whole = number.try_cast("bigint")
        return F.when(whole == number, whole.cast("string")).otherwise(number.cast("string"))
    return value.cast("string")


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def number_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NUMBERS)]
