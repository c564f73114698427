"""Which column is what: roles from fixed lists, from name words, from a role file."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe import fixed_values as fixed
from veilframe.functions.guards import number_columns, text_columns
from veilframe.session import local_table

ROLE_LISTS = ("direct_identifiers", "quasi_identifiers", "clinical_data")
DIRECT, QUASI, CLINICAL = "direct_identifier", "quasi_identifier", "clinical_data"


def present_columns(wanted: Iterable[str], df: DataFrame) -> list[str]:
    """The wanted columns the table has, in the wanted order; names match exactly."""
    have = set(df.columns)
    if len({c.lower() for c in have}) < len(df.columns):
        raise ValueError("column names must differ by more than case")
    return [c for c in wanted if c in have]


def word_pattern(words: Sequence[str], mode: str = "token") -> str:
    """A pattern on the upper-cased name: whole words between underscores, or any part."""
    any_word = "|".join(words)
    return f"({any_word})" if mode == "substring" else f"(^|_)({any_word})(_|$)"


def role_by_name(name: Column, mode: str = "token") -> Column:
    """The role of a column name; a name that is both is a direct identifier."""
    upper = F.upper(name)
    return (
        F.when(upper.rlike(word_pattern(fixed.DIRECT_WORDS, mode)), DIRECT)
        .when(upper.rlike(word_pattern(fixed.QUASI_WORDS, mode)), QUASI)
        .otherwise(CLINICAL)
    )


def _has_word(name: str, words: Sequence[str], mode: str) -> bool:
    parts = name.upper().split("_")
    return any(w in (name.upper() if mode == "substring" else parts) for w in words)


@dataclass(frozen=True)
class Roles:
    direct: list[str]
    quasi: list[str]
    clinical: list[str]


def load_roles(spark: SparkSession, path: str | None) -> dict[str, list[str]]:
    """The role lists of a JSON file in any store that Spark reads; no file, no lists."""
    if path is None:
        return {}
    text = spark.read.text(path, wholetext=True).first()[0]
    return {k: v for k, v in json.loads(text).items() if k in ROLE_LISTS}


def resolve_roles(df: DataFrame, *layers: Mapping[str, Sequence[str]], mode: str = "token") -> Roles:
    """Roles for the columns the table has. Each later layer replaces the lists it names;
    lists nobody names come from the words in the column names. A column two lists
    claim goes to the first of direct, quasi, clinical."""
    lists = {name: layer[name] for layer in layers for name in ROLE_LISTS if name in layer}
    by_words = {
        "direct_identifiers": [c for c in df.columns if _has_word(c, fixed.DIRECT_WORDS, mode)],
        "quasi_identifiers": [c for c in df.columns if _has_word(c, fixed.QUASI_WORDS, mode)],
    }
    direct = present_columns(lists.get("direct_identifiers", by_words["direct_identifiers"]), df)
    quasi = present_columns(lists.get("quasi_identifiers", by_words["quasi_identifiers"]), df)
    quasi = [c for c in quasi if c not in direct]
    rest = [c for c in df.columns if c not in direct and c not in quasi]
    clinical = present_columns(lists.get("clinical_data", rest), df)
    return Roles(direct, quasi, [c for c in clinical if c not in direct and c not in quasi])


def route_direct(direct: Sequence[str], mode: str = "token") -> dict[str, list[str]]:
    """Which hash each direct identifier gets: the treatments, in the order applied.
    A column no word covers is listed under 'drop'."""
    routed = {kind: [c for c in direct if _has_word(c, words, mode)]
              for kind, words in fixed.ROUTING_WORDS.items()}
    covered = {c for columns in routed.values() for c in columns}
    return {**routed, "drop": [c for c in direct if c not in covered]}


def policy_rows(df: DataFrame, roles: Roles, mode: str = "token") -> list[tuple[str, str, str]]:
    """(column, role, treatment) of every column."""
    routed = route_direct(roles.direct, mode)
    rows = []
    for column in df.columns:
        if column in roles.direct:
            hashes = [kind for kind, columns in routed.items() if column in columns]
            rows.append((column, DIRECT, "+".join(hashes)))
        elif column in roles.quasi:
            rows.append((column, QUASI, "synthesise"))
        elif column in roles.clinical:
            year = column in fixed.YEAR_COLUMNS
            rows.append((column, CLINICAL, "year" if year else "keep"))
        else:
            rows.append((column, "unlisted", "drop"))
    return rows


def policy_table(spark: SparkSession, rows: Sequence[tuple[str, str, str]]) -> DataFrame:
    return local_table(spark, rows, "column string, role string, treatment string")


def column_types(df: DataFrame) -> dict[str, list[str]]:
    """The seven column groups of the fixed lists and the types."""
    direct = present_columns(fixed.DIRECT_IDENTIFIERS, df)
    return {
        "direct_identifiers": direct,
        "quasi_identifiers": present_columns(fixed.QUASI_IDENTIFIERS, df),
        "sensitive_attributes": present_columns(fixed.SENSITIVE_ATTRIBUTES, df),
        "date_columns": present_columns(fixed.DATE_COLUMNS, df),
        "id_columns": present_columns(fixed.ID_COLUMNS, df),
        "categorical_columns": [c for c in text_columns(df) if c not in direct],
        "numerical_columns": [c for c in number_columns(df) if c not in direct],
    }
