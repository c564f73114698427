"""Dates, years and ages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilframe.fixed_values import (
    AGE_BANDS, AGE_REFERENCE_DATE, DAYS_PER_YEAR, OLDEST_AGE_BAND, UNKNOWN, YEAR_PATTERN,
)

DATE_FORMATS = ("yyyy-MM-dd", "dd-MM-yyyy", "yyyy-MM-dd'T'HH:mm:ss'Z'")


def year_of(text: Column) -> Column:
    """The first four digits in a row; null where there are none."""
    return F.nullif(F.regexp_extract(text, YEAR_PATTERN, 1), F.lit("")).try_cast("int")


def first_in_list(text: Column) -> Column:
    """The first element of a list kept as 'a; b; c' in one cell."""
    return F.trim(F.split_part(text, F.lit(";"), F.lit(1)))


# What every text of a format matches. A parse that fails costs many times the look at one character.
_SIGNS = {
    "yyyy-MM-dd": lambda text: F.substring(text, -3, 1) == "-",
    "dd-MM-yyyy": lambda text: F.substring(text, 3, 1) == "-",
    "yyyy-MM-dd'T'HH:mm:ss'Z'": lambda text: F.substring(text, -4, 1) == ":",
}


def _under_format(text: Column, form: str) -> Column:
    day = F.try_to_timestamp(text, F.lit(form)).cast("date")
    return F.when(_SIGNS[form](text), day) if form in _SIGNS else day


def lenient_date(text: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """The date under the first format that fits; null where none does."""
    return F.coalesce(*[_under_format(text, f) for f in formats])


def age_at_reference(birth: Column) -> Column:
    days = F.datediff(F.lit(AGE_REFERENCE_DATE).cast("date"), birth)
    return (days / F.lit(DAYS_PER_YEAR)).cast("int")


def age_range(age: Column) -> Column:
    bands = reduce(
        lambda chain, band: chain.when(age < band[0], band[1]), AGE_BANDS, F.when(age.isNull(), UNKNOWN)
    )
    return bands.otherwise(OLDEST_AGE_BAND)
