"""Operators that choose, replace or glue columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe import fixed_values as fixed
from veilframe.functions import dates, hashing
from veilframe.functions.guards import key_text
from veilframe.operators.ordering import running_before
from veilframe.plans.policy import present_columns
from veilframe.session import written_and_counted


def drop_identifiers(df: DataFrame, identifiers: Sequence[str] = fixed.DIRECT_IDENTIFIERS) -> DataFrame:
    """Without the direct identifiers the table has."""
    gone = set(present_columns(identifiers, df))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in gone])


def generalize_years(
    df: DataFrame, columns: Mapping[str, str] = fixed.YEAR_COLUMNS, as_text: bool = False
) -> DataFrame:
    """Replace each date column by its year. As text, a cell without a year stays as it is."""
    there = present_columns(columns, df)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in there]
    years = []
    for column in there:
        year = dates.year_of(F.col(column).cast("string"))
        if as_text:
            year = F.coalesce(year.cast("string"), F.col(column).cast("string"))
        years.append(year.alias(columns[column]))
    return df.select(*kept, *years)


def add_age_range(df: DataFrame, birth: str = "BIRTHDATE", name: str = "AGE_RANGE") -> DataFrame:
    """Add the age band; a table without the birth date stays as it is."""
    if birth not in df.columns:
        return df
    day = F.col(birth)
    if dict(df.dtypes)[birth] == "string":
        day = dates.lenient_date(day)
    # The age stands in every band's condition: as a column of its own it is worked out once a row.
    aged = df.withColumn("_age", dates.age_at_reference(day))
    return aged.withColumn(name, dates.age_range(F.col("_age"))).drop("_age")


def hash_identifiers(df: DataFrame, routed: Mapping[str, Sequence[str]], salt: str | None = None,
                     id_salt: str = "") -> DataFrame:
    """Hash id, name, address and SSN columns; drop the ones routed to 'drop'.

    A column under several kinds is hashed by each, in this order. Ids and SSNs are glued of
    several parts of a digest, which is a column of its own first: it is worked out once.
    """
    hashes = {
        "id": lambda text, digest: hashing.keyed_uuid(text, salt or id_salt, digest),
        "name": lambda text, digest: hashing.hash_name(text, salt),
        "address": lambda text, digest: hashing.hash_address(text, salt),
        "ssn": lambda text, digest: hashing.hash_ssn(text, salt, digest),
    }
    salts = {"id": salt or id_salt, "ssn": salt}
    digests, result = {}, []
    for place, column in enumerate(df.columns):
        if column in routed.get("drop", ()):
            continue
        kinds = [k for k in hashes if column in routed.get(k, ())]
        value, digest = key_text(df, column) if kinds else F.col(f"`{column}`"), None
        if kinds and kinds[0] in salts:
            digests[f"_digest_{place}"] = hashing.salted_digest(value, salts[kinds[0]])
            digest = F.col(f"_digest_{place}")
        for kind in kinds:
            value, digest = hashes[kind](value, digest), None
        result.append(value.alias(column))
    return df.withColumns(digests).select(*result)


def condition_target_split(
    df: DataFrame, row_key: str, conditions: Sequence[str], targets: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Two tables with the same row key: conditions, and what is to be generated."""
    return (
        df.select(row_key, *present_columns(conditions, df)),
        df.select(row_key, *present_columns(targets, df)),
    )


def assemble_output(
    original: DataFrame,
    generated: DataFrame,
    row_key: str,
    direct: Sequence[str],
    quasi: Sequence[str],
    clinical: Sequence[str],
    carried: Sequence[str] = ("AGE_RANGE",),
) -> DataFrame:
    """Direct, generated, carried and clinical columns side by side, joined on the row key."""
    direct, clinical = present_columns(direct, original), present_columns(clinical, original)
    carried = present_columns(carried, original)
    kept = original.select(row_key, *direct, *carried, *clinical)
    made = generated.select(row_key, *present_columns(quasi, generated))
    return kept.join(made, row_key).select(row_key, *direct, *made.columns[1:], *carried, *clinical)


COPIES_AT_ONCE = 1 << 16


def _constant(value, kind: T.DataType) -> Column:
    """A value that was read from a table, as a column of its type; structs field by field."""
    if isinstance(kind, T.StructType) and value is not None:
        return F.struct(*[_constant(value[f.name], f.dataType).alias(f.name) for f in kind])
    return F.lit(value).cast(kind)


def _last_of(keys: DataFrame, rows: int) -> Row | None:
    """Where the first `rows` rows by `key` (nulls first) end: the key, how many rows are before it, how
    many have it. None where there are no more rows than that. Equal keys are counted before they travel."""
    counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).withColumn("late", F.col("key").isNotNull())
    counts, distinct = written_and_counted(counts, "first_rows")
    placed = running_before(counts, ["late", "key"], {"before": F.col("n")}, rows=distinct)
    return placed.where((F.col("before") < rows) & (F.col("before") + F.col("n") > rows)
                        | (F.col("before") + F.col("n") == rows)).first()


def first_rows(df: DataFrame, order_key: str, rows: int | None) -> DataFrame:
    """The first rows by the order key, nulls first; None is all, 0 is none.

    Exactly so many rows, also where keys repeat: of the rows with the last key, those whose content
    comes first by its hash. The last key is found from counts over ranges of the key, then the rows are
    chosen by one filter, so no task holds them all; of rows that are the same in all columns as many as are
    due are made from one of them. The result has no order.
    """
    if rows is None:
        return df
    if rows <= 0:
        return df.limit(0)
    key = F.col(f"`{order_key}`")
    edge = _last_of(df.select(key.alias("key")), rows)
    if edge is None:
        return df
    at = _constant(edge.key, df.schema[order_key].dataType)
    before, same = (F.lit(False), key.isNull()) if edge.key is None else (key.isNull() | (key < at), key == at)
    if edge.before + edge.n == rows:
        return df.where(before | same)
    content = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}), 256)
    tied = df.where(same)
    wanted = rows - edge.before
    last = _last_of(tied.select(content.alias("key")), wanted)
    chosen = df.where(before | (same & (content < last.key)))
    if last.before + last.n == wanted:
        return df.where(before | (same & (content <= last.key)))
    due = F.lit(wanted - last.before)
    blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((due - 1) / COPIES_AT_ONCE))).alias("_block")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(COPIES_AT_ONCE), due - F.col("_block") * COPIES_AT_ONCE)))
    one = tied.where(content == last.key).limit(1).select("*", blocks).repartition("_block")
    return chosen.unionByName(one.select("*", copies.alias("_copy")).drop("_block", "_copy"))
