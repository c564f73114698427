"""Pseudonym dictionaries as tables: build, extend, apply, save, load.

A dictionary holds `namespace, original, seq, pseudonym`, stored by namespace. The bytes
of each namespace are counted before a lookup: small namespaces are sent to every
executor, a large one is joined by a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe import fixed_values
from veilframe.functions.guards import is_missing, key_text
from veilframe.operators.ordering import ROWS_PER_BUCKET, numbered
from veilframe.session import BROADCAST_BYTES, all_small, row_bytes, written, written_and_counted

COLUMNS = ["namespace", "original", "seq", "pseudonym"]
# A namespace of a dictionary is written by up to so many tasks, and so into so many files.
FILES = 64
SCHEMA = "original string, seq bigint, pseudonym string, namespace string"


@dataclass(frozen=True)
class Namespace:
    """Key columns that share one numbering, in the order they are numbered."""

    columns: tuple[str, ...]
    prefix: str
    digits: int
    later_prefix: str | None = None  # for keys first met in a later column


NAMESPACES: dict[str, Namespace] = {
    name: Namespace(tuple(columns), prefix, digits)
    for name, (columns, prefix, digits) in fixed_values.NAMESPACES.items()
}


def alternate_namespaces() -> dict[str, Namespace]:
    """The incremental job's choice: no payer ids, and its own label for later patient ids."""
    patients = NAMESPACES["patients"]
    return {
        **{n: s for n, s in NAMESPACES.items() if n != "id_payers"},
        "patients": Namespace(
            patients.columns, patients.prefix, patients.digits, fixed_values.ALTERNATE_PATIENT_PREFIX
        ),
    }


def present(df: DataFrame, namespaces: Mapping[str, Namespace]) -> dict[str, Namespace]:
    """The namespaces whose columns the table has, with just those columns."""
    kept = {}
    for name, spec in namespaces.items():
        columns = tuple(c for c in spec.columns if c in df.columns)
        if columns:
            kept[name] = Namespace(columns, spec.prefix, spec.digits, spec.later_prefix)
    return kept


def _skipped(text: Column, placeholder: str | None) -> Column:
    skipped = is_missing(text)
    return skipped if placeholder is None else skipped | (text == placeholder)


def first_seen(
    df: DataFrame,
    order_key: str,
    namespaces: Mapping[str, Namespace],
    placeholder: str | None = fixed_values.UNKNOWN,
) -> DataFrame:
    """Each distinct key once, with where it is met first: column place, then row.

    One scan serves all namespaces, and a key that fills a third of the rows is
    reduced to one row per task before the shuffle. The earliest row is kept per
    place, as plain numbers, so that the aggregation stays a hash aggregation.
    """
    places = max(len(spec.columns) for spec in namespaces.values())
    entries = [
        F.struct(
            F.lit(name).alias("namespace"),
            F.lit(place).alias("place"),
            key_text(df, column).alias("original"),
        )
        for name, spec in namespaces.items()
        for place, column in enumerate(spec.columns)
    ]
    keys = df.select(F.col(order_key).alias("row"), F.explode(F.array(*entries)).alias("e"))
    keys = keys.select("row", "e.*").where(~_skipped(F.col("original"), placeholder))
    rows = [f"row_{p}" for p in range(places)]
    earliest = keys.groupBy("namespace", "original").agg(
        *[F.min(F.when(F.col("place") == p, F.col("row"))).alias(r) for p, r in enumerate(rows)]
    )
    place = F.coalesce(*[F.when(F.col(r).isNotNull(), F.lit(p)) for p, r in enumerate(rows)])
    return earliest.select(
        "namespace", "original", place.alias("place"), F.coalesce(*rows).alias("first_row")
    )


def _label(namespaces: Mapping[str, Namespace]) -> Column:
    """The pseudonym: prefix and number, padded with zeros but never cut."""
    label, number = F.lit(None).cast("string"), F.col("seq").cast("string")
    for name, spec in namespaces.items():
        padded = F.lpad(number, F.greatest(F.lit(spec.digits), F.length(number)), F.lit("0"))
        here = F.concat(F.lit(spec.prefix), padded)
        if spec.later_prefix:
            here = F.when(F.col("place") > 0, F.concat(F.lit(spec.later_prefix), padded)).otherwise(here)
        label = F.when(F.col("namespace") == name, here).otherwise(label)
    return label


def numbered_entries(
    keys: DataFrame, rows: int, namespaces: Mapping[str, Namespace], last: Mapping[str, int],
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Entries of so many written keys (rows of `first_seen`), numbered on from the `last` number of each namespace."""
    fresh = numbered(keys, ["place", "first_row", "original"], "seq", ["namespace"], rows_per_bucket, rows)
    shift = F.lit(0)
    for name, used in last.items():
        shift = F.when(F.col("namespace") == name, F.lit(used)).otherwise(shift)
    fresh = fresh.withColumn("seq", (F.col("seq") + shift).cast("bigint"))
    return fresh.select("namespace", "original", "seq", _label(namespaces).alias("pseudonym"))


def new_entries(
    df: DataFrame,
    order_key: str,
    namespaces: Mapping[str, Namespace] = NAMESPACES,
    known: DataFrame | None = None,
    placeholder: str | None = fixed_values.UNKNOWN,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """The keys a known dictionary lacks, numbered in the order they are first met.

    Numbers go on from the last one of the namespace; without a known dictionary they
    start at 1.
    """
    namespaces = present(df, namespaces)
    keys = first_seen(df, order_key, namespaces, placeholder)
    if known is not None:
        keys = keys.join(known.select("namespace", "original"), ["namespace", "original"], "left_anti")
    keys, rows = written_and_counted(keys, "first_seen")
    used = {} if known is None else dict(known.groupBy("namespace").agg(F.max("seq")).collect())  # one per namespace
    # They lie in ranges of the namespace already: a task that reads some writes few files.
    entries = numbered_entries(keys, rows, namespaces, used, rows_per_bucket)
    return written(entries, "dictionary", by="namespace").select(*COLUMNS)


def build_dictionary(
    df: DataFrame,
    order_key: str,
    namespaces: Mapping[str, Namespace] = NAMESPACES,
    known: DataFrame | None = None,
    placeholder: str | None = fixed_values.UNKNOWN,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """The known entries, unchanged, and those of the keys met here for the first time."""
    fresh = new_entries(df, order_key, namespaces, known, placeholder, rows_per_bucket)
    return fresh if known is None else known.select(*COLUMNS).unionByName(fresh)


def random_entries(
    df: DataFrame, columns: Sequence[str], known: DataFrame | None = None, namespace: str = "ids"
) -> DataFrame:
    """A random UUID for each distinct key of the columns, all in one namespace.

    The entries are written before anyone reads them: a UUID is made anew whenever it is
    computed again.
    """
    keys = df.select(F.explode(F.array(*[key_text(df, c) for c in columns])).alias("original"))
    keys = keys.where(~is_missing(F.col("original"))).distinct()
    if known is not None:
        here = known.where(F.col("namespace") == namespace).select("original")
        keys = keys.join(here, "original", "left_anti")
    entries = keys.select(
        F.lit(namespace).alias("namespace"), "original", F.lit(None).cast("bigint").alias("seq"),
        F.uuid().alias("pseudonym"),
    )
    return written(entries, "random", by="namespace").select(*COLUMNS)


# Keys that are looked up nowhere are dealt out under so many keys that match nothing.
SPREAD = 4096


def spread_key(text: Column, skipped: Column) -> Column:
    """What a row is looked up by: its key, and for a row that passes through one of SPREAD keys
    that no entry has, so that rows without a key do not meet in one task."""
    return F.when(skipped, F.concat(F.lit("\0"), F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("string"))).otherwise(text)


def _replaced(df, dictionary, columns, placeholder, sent):
    """Replace each (namespace, column) by its pseudonym."""
    for name, column in columns:
        entry = dictionary.where(F.col("namespace") == name).select(
            F.col("original").alias("_original"), F.col("pseudonym").alias("_pseudonym")
        )
        text = key_text(df, column)
        skipped = F.coalesce(_skipped(text, placeholder), F.lit(True))
        pseudonym = F.when(skipped, text).otherwise(F.col("_pseudonym"))
        kept = [pseudonym.alias(c) if c == column else F.col(f"`{c}`") for c in df.columns]
        if name in sent:
            df = df.join(F.broadcast(entry), text == F.col("_original"), "left").select(*kept)
        else:
            probed = df.withColumn("_probe", spread_key(text, skipped))
            df = probed.join(entry, F.col("_probe") == F.col("_original"), "left").select(*kept)
    return df


def apply_dictionary(
    df: DataFrame,
    dictionary: DataFrame,
    namespaces: Mapping[str, Namespace] = NAMESPACES,
    placeholder: str | None = fixed_values.UNKNOWN,
    row_key: str | None = None,
    sent_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Replace every key column by its pseudonym.

    Null, empty and placeholder keys pass through. A key the dictionary lacks becomes
    null: an original must never reach the output.

    The smallest namespaces, up to `sent_bytes` in sum, go to every executor. Each other one
    costs a shuffle of the table. With a `row_key` (a column unique per row) two or more of
    them are looked up on the key columns alone, and the wide rows are shuffled once, to take
    the result in.
    """
    columns = [(n, c) for n, spec in present(df, namespaces).items() for c in spec.columns]
    sizes = {n: 0 for n, _ in columns} | dict(namespace_bytes(dictionary).collect())  # one per namespace
    # A namespace is sent once for each of its columns.
    sent = all_small({n: size * sum(m == n for m, _ in columns) for n, size in sizes.items()}, sent_bytes)
    large = [(n, c) for n, c in columns if n not in sent]
    small = [pair for pair in columns if pair not in large]
    if row_key is None or len(large) < 2:
        # The small ones first: the rows are shorter when they have to be shuffled.
        return _replaced(df, dictionary, [*small, *large], placeholder, sent)
    moved = [c for _, c in large]
    narrow = _replaced(df.select(row_key, *moved), dictionary, large, placeholder, sent)
    wide = _replaced(df.drop(*moved), dictionary, small, placeholder, sent)
    return wide.join(narrow, row_key).select(*[F.col(f"`{c}`") for c in df.columns])


def namespace_bytes(dictionary: DataFrame) -> DataFrame:
    entries = dictionary.select("namespace", "original", "pseudonym")
    return entries.groupBy("namespace").agg(F.sum(row_bytes(entries)).alias("bytes"))


def namespace_sizes(dictionary: DataFrame) -> DataFrame:
    return dictionary.groupBy("namespace").agg(F.count(F.lit(1)).alias("entries"))


def append_entries(entries: DataFrame, folder: str) -> None:
    """Add new entries to a saved dictionary. Files already there are never rewritten."""
    entries.write.mode("append").partitionBy("namespace").parquet(folder)


def load_dictionary(spark: SparkSession, folder: str) -> DataFrame | None:
    """A saved dictionary; None where nothing has been saved yet."""
    try:
        return spark.read.schema(SCHEMA).parquet(folder).select(*COLUMNS)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def export_dictionary(dictionary: DataFrame, path: str, namespaces: Sequence[str] | None = None) -> None:
    """The dictionary as JSON lines, one folder per namespace."""
    if namespaces is not None:
        dictionary = dictionary.where(F.col("namespace").isin(*namespaces))
    dictionary.write.partitionBy("namespace").json(path)
