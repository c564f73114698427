"""The rule-based jobs: drop, fill, pseudonymise, generalise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe import fixed_values as fixed
from veilframe.functions.guards import key_text, number_columns
from veilframe.operators import impute
from veilframe.operators.columns import drop_identifiers, generalize_years
from veilframe.operators.dictionary import (
    NAMESPACES, Namespace, alternate_namespaces, apply_dictionary, new_entries,
)
from veilframe.operators.ledger import Ledger
from veilframe.plans.policy import present_columns

CODE_COLUMNS = ("REASONCODE", "ZIP", "ZIP_payer")


@dataclass(frozen=True)
class Deidentified:
    output: DataFrame
    dictionary: DataFrame
    new_entries: DataFrame
    removed: list[str]
    generalized: list[str]


def codes_as_text(df: DataFrame, columns: Sequence[str] = CODE_COLUMNS) -> DataFrame:
    """Codes are names, not amounts: they are kept as text whatever they were read as."""
    codes = present_columns(columns, df)
    return df.select(*[key_text(df, c).alias(c) if c in codes else F.col(f"`{c}`") for c in df.columns])


def fill_missing(df: DataFrame, order_key: str, approximate: bool = False, row_key: str | None = None) -> DataFrame:
    """'Unknown' for text, the column's median for numbers."""
    numbers = [c for c in number_columns(df) if c not in (order_key, row_key)]
    medians = (impute.approx_medians if approximate else impute.exact_medians)(df, numbers)
    return impute.fill_numbers(impute.fill_text(df), numbers, medians)


def deidentify_rules(
    df: DataFrame,
    order_key: str,
    *,
    as_published: bool = False,
    known: DataFrame | None = None,
    namespaces: Mapping[str, Namespace] = NAMESPACES,
    fill: bool = True,
    approximate_medians: bool = False,
    row_key: str | None = None,
    ledger: Ledger | None = None,
) -> Deidentified:
    """Drop identifiers, fill, replace keys by numbers in order of first sight, keep years.

    The identifiers go first, so a column that is not wanted is never read. With
    `as_published`, reason codes are amounts with a median, 'Unknown' gets a number like
    any key, and a date without a year stays as it is. `row_key` names a column unique
    per row (mostly the order key itself); it saves shuffles of the whole rows. With a
    `ledger` the keys are looked up and saved there; the dictionary is then that of the
    table's keys alone, which is also what `new_entries` holds.
    """
    removed = present_columns(fixed.DIRECT_IDENTIFIERS, df)
    generalized = present_columns(fixed.YEAR_COLUMNS, df)
    df = drop_identifiers(df)
    if not as_published:
        df = codes_as_text(df)
    if fill:
        df = fill_missing(df, order_key, approximate_medians, row_key)
    placeholder = None if as_published else fixed.UNKNOWN
    if ledger is not None:
        dictionary = fresh = ledger.extend(df, order_key, namespaces, placeholder)
    else:
        fresh = new_entries(df, order_key, namespaces, known, placeholder)
        dictionary = fresh if known is None else known.unionByName(fresh)
    df = generalize_years(df, as_text=as_published)
    output = apply_dictionary(df, dictionary, namespaces, placeholder, row_key)
    return Deidentified(output, dictionary, fresh, removed, generalized)


def deidentify_incremental(
    batch: DataFrame, order_key: str, known: DataFrame | Ledger | None, as_published: bool = False,
    row_key: str | None = None,
) -> Deidentified:
    """One batch under a dictionary that grows: nothing is filled, old keys keep their numbers.

    What is known is a table of entries, or a ledger: with it the cost follows the batch.
    """
    kept = {"ledger": known} if isinstance(known, Ledger) else {"known": known}
    return deidentify_rules(
        batch, order_key, as_published=as_published, namespaces=alternate_namespaces(), fill=False, row_key=row_key, **kept,
    )
