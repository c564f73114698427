"""The hybrid job, the clinical sample, and the run of all jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe import fixed_values as fixed
from veilframe.functions.dates import lenient_date
from veilframe.operators.columns import (
    add_age_range, assemble_output, first_rows, generalize_years, hash_identifiers,
)
from veilframe.operators.dictionary import Namespace, apply_dictionary, random_entries
from veilframe.operators.synth import band, condition_cell, synthesise
from veilframe.plans.features import prepare_for_sample, restore_sample
from veilframe.plans.policy import present_columns, resolve_roles, route_direct
from veilframe.plans.rules import Deidentified, deidentify_rules

COST_BAND = 100_000.0

# A cell with fewer rows would give a row little else than its own values.
FLOOR_ROWS = 5


def clinical_cell(df: DataFrame) -> Column:
    """Rows are alike when visit class and cost band are the same."""
    parts = [F.col(c) for c in present_columns(["ENCOUNTERCLASS"], df)]
    parts += [band(F.col(c), COST_BAND) for c in present_columns(["BASE_ENCOUNTER_COST"], df)]
    return condition_cell(*parts)


def deidentify_hybrid(
    df: DataFrame,
    row_key: str,
    *,
    role_file: Mapping[str, Sequence[str]] | None = None,
    cell: Column | None = None,
    seed: str = "42",
    ids: str = "random",
    known_ids: DataFrame | None = None,
    salt: str | None = None,
    floor_rows: int = FLOOR_ROWS,
    mode: str = "joint",
    name_matching: str = "token",
) -> DataFrame:
    """Hash the direct identifiers, draw the quasi-identifiers, keep the clinical columns.

    A direct identifier no hash covers is dropped, and clinical dates become years. Without a
    role file the default lists hold; a file takes their place, and lists that it does not name
    come from the words in the column names. `ids`: 'random' gives each id a UUID that nothing
    can be worked out from, the same in every id column and for `known_ids` (as `random_entries`
    gives them); 'hashed' gives what follows from the id, and so can be listed without a `salt`.
    """
    if ids not in ("random", "hashed"):
        raise ValueError(f"ids cannot be {ids!r}")
    roles = resolve_roles(df, fixed.DEFAULT_ROLES if role_file is None else role_file, mode=name_matching)
    if "BIRTHDATE" in df.columns and dict(df.dtypes)["BIRTHDATE"] == "string":
        df = df.withColumn("BIRTHDATE", lenient_date(F.col("BIRTHDATE")))
    df = add_age_range(df)
    quasi = [c for c in roles.quasi if c != "AGE_RANGE"]
    cell = clinical_cell(df) if cell is None else cell
    made = synthesise(df, df, row_key, cell, quasi, seed, floor_rows, mode)
    routed = route_direct([c for c in roles.direct if c != row_key], name_matching)
    kept = df.select(row_key, *[c for c in roles.direct if c != row_key], *present_columns(["AGE_RANGE"], df),
                     *[c for c in roles.clinical if c != row_key])
    if ids == "random" and routed["id"]:
        kept, routed = with_random_ids(kept, row_key, routed["id"], known_ids), {**routed, "id": []}
    kept = generalize_years(hash_identifiers(kept, routed, salt))
    clinical = [fixed.YEAR_COLUMNS.get(c, c) for c in roles.clinical if c != row_key]
    return assemble_output(kept, made, row_key, roles.direct, quasi, clinical)


def with_random_ids(df: DataFrame, row_key: str, columns: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """Every id replaced by its random UUID; an id stands for the same one in all the columns."""
    entries = random_entries(df, columns, known)
    if known is not None:
        entries = known.select(entries.columns).unionByName(entries)
    return apply_dictionary(df, entries, {"ids": Namespace(tuple(columns), "", 0)}, None, row_key)


def clinical_sample(
    df: DataFrame,
    row_key: str,
    *,
    rows: int | None = None,
    conditions: Sequence[str] = ("STATE",),
    seed: str = "42",
    floor_rows: int = FLOOR_ROWS,
) -> DataFrame:
    """Synthetic clinical and financial columns for all rows, or the first ones, given demographics.

    Drawn as codes and standard scores, then turned back into labels and units, so every
    label is a real one and every number lies in the observed range.
    """
    prepared = prepare_for_sample(df, row_key, conditions)
    alike = [F.col(c) for c in present_columns(conditions, prepared.conditions)]
    targets = prepared.targets.columns[1:]
    asked = first_rows(prepared.conditions, row_key, rows)
    drawn = synthesise(prepared.rows, asked, row_key, condition_cell(*alike), targets, seed, floor_rows)
    return restore_sample(drawn, prepared)


def run_all(
    df: DataFrame, row_key: str, *, synthesis: bool = True, sample: bool = True, sample_rows: int | None = None,
    ids: str = "random", salt: str | None = None,
) -> dict[str, DataFrame | Deidentified]:
    """Rule job, then synthesis, then sample, in one session; a failure ends the run."""
    done: dict[str, DataFrame | Deidentified] = {"rules": deidentify_rules(df, row_key, row_key=row_key)}
    if synthesis:
        done["hybrid"] = deidentify_hybrid(df, row_key, ids=ids, salt=salt)
    if sample:
        done["sample"] = clinical_sample(df, row_key, rows=sample_rows)
    return done
