"""Label codes and scaling, with the fitted state kept as small tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.operators.dictionary import FILES, spread_key
from veilframe.operators.ordering import ROWS_PER_BUCKET, numbered
from veilframe.operators.profile import one_row_per_column, unpivoted
from veilframe.session import BROADCAST_BYTES, all_small, row_bytes, written, written_and_counted


def label_state(df: DataFrame, columns: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """feature, label, code: the distinct texts of each column numbered in sorted order from 0."""
    texts = unpivoted(df, columns).where(F.col("value").isNotNull())
    labels = texts.select("feature", F.col("value").alias("label")).distinct()
    labels, rows = written_and_counted(labels, "labels")
    coded = numbered(labels, ["label"], "code", ["feature"], rows_per_bucket, rows)
    coded = coded.select("feature", "label", (F.col("code") - 1).alias("code"))
    coded = coded.repartition("feature", F.col("code") % FILES)
    return written(coded, "label_codes", by="feature").select("feature", "label", "code")


def _label_sizes(state: DataFrame) -> dict[str, tuple[int, int]]:
    """Labels per column, as the codes run from 0, and their bytes."""
    found = state.groupBy("feature").agg((F.max("code") + 1).alias("labels"), F.sum(row_bytes(state)).alias("bytes"))
    return {r.feature: (r.labels, r.bytes) for r in found.collect()}  # one per column


def _swapped(df: DataFrame, state: DataFrame, column: str, probe: Column, key: str, value: str, sent: bool) -> DataFrame:
    """Replace a column by the `value` of the state row whose `key` is the probe."""
    entries = state.where(F.col("feature") == column).select(
        F.col(key).cast("string").alias("_key"), F.col(value).alias("_value")
    )
    kept = [F.col("_value").alias(c) if c == column else F.col(f"`{c}`") for c in df.columns]
    probe = probe.cast("string")
    if sent:
        return df.join(F.broadcast(entries), probe == F.col("_key"), "left").select(*kept)
    probed = df.withColumn("_probe", spread_key(probe, probe.isNull()))
    return probed.join(entries, F.col("_probe") == F.col("_key"), "left").select(*kept)


def _looked_up(df: DataFrame, state: DataFrame, columns: Sequence[str], sizes: Mapping[str, int], probe: Callable[[str], Column],
               key: str, value: str, row_key: str | None, sent_bytes: int) -> DataFrame:
    """The columns replaced one by one: small ones by what is sent, large ones by shuffles, of the wide rows or,
    where a row key is given and two or more are large, of their columns alone."""
    sent = all_small({c: sizes.get(c, 0) for c in columns}, sent_bytes)
    small, large = [c for c in columns if c in sent], [c for c in columns if c not in sent]

    def swapped(part: DataFrame, names: Sequence[str]) -> DataFrame:
        for column in names:
            part = _swapped(part, state, column, probe(column), key, value, column in sent)
        return part

    if row_key is None or len(large) < 2:
        return swapped(df, [*small, *large])  # the small ones first: shorter rows are shuffled
    narrow = swapped(df.select(row_key, *large), large)
    return swapped(df.drop(*large), small).join(narrow, row_key).select(*[F.col(f"`{c}`") for c in df.columns])


def encode_labels(df: DataFrame, state: DataFrame, columns: Sequence[str], row_key: str | None = None,
                  sent_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Replace texts by their codes; a text the state lacks becomes null.

    The smallest label sets, up to `sent_bytes` in sum, go to every executor; any other costs a
    shuffle of the table. With a `row_key` (a column unique per row) two or more of them are
    looked up on their columns alone, and the wide rows are shuffled once.
    """
    sizes = {c: size for c, (_, size) in _label_sizes(state).items()}
    return _looked_up(df, state, columns, sizes, lambda c: F.col(f"`{c}`").cast("string"), "label", "code", row_key, sent_bytes)


def decode_labels(df: DataFrame, state: DataFrame, columns: Sequence[str], clip: bool = True, row_key: str | None = None,
                  sent_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Replace codes by their texts.

    With `clip`, codes are rounded half to even and moved into the known range;
    otherwise they are cut to whole numbers and unknown ones become null. `row_key` and
    `sent_bytes` are those of `encode_labels`.
    """
    sizes = _label_sizes(state)

    def code_of(column: str) -> Column:
        number, known = F.col(f"`{column}`").cast("double"), sizes.get(column, (0, 0))[0]
        if not clip:
            return number.cast("bigint")
        code = F.least(F.greatest(F.rint(number).cast("bigint"), F.lit(0)), F.lit(known - 1))
        return F.when(number.isNotNull(), code)

    return _looked_up(df, state, columns, {c: size for c, (_, size) in sizes.items()}, code_of, "code", "label", row_key, sent_bytes)


def scale_state(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """feature, lo, hi, mean, std (of the whole population): one scan, one row per column."""
    state = one_row_per_column(
        df, columns,
        {
            "lo": lambda c: F.min(c.cast("double")), "hi": lambda c: F.max(c.cast("double")),
            "mean": lambda c: F.avg(c.cast("double")), "std": lambda c: F.stddev_pop(c.cast("double")),
        },
    )
    return state.withColumnRenamed("column", "feature")


def _scaled(df: DataFrame, state: DataFrame, columns: Sequence[str], formula) -> DataFrame:
    by_column = {r.feature: r for r in state.collect()}  # four numbers per column

    def scaled(column):
        if by_column[column].lo is None:  # no value to scale by
            return F.lit(None).cast("double").alias(column)
        return formula(F.col(f"`{column}`").cast("double"), by_column[column]).alias(column)

    return df.select(*[scaled(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def scale_minmax(df: DataFrame, state: DataFrame, columns: Sequence[str]) -> DataFrame:
    """To [-1, 1]; a constant column becomes -1."""
    def formula(x, s):
        if s.lo == s.hi:
            return F.when(x.isNotNull(), F.lit(-1.0))
        return 2 * (x - s.lo) / (s.hi - s.lo) - 1

    return _scaled(df, state, columns, formula)


def unscale_minmax(df: DataFrame, state: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _scaled(df, state, columns, lambda x, s: (x + 1) * (s.hi - s.lo) / 2 + s.lo)


def scale_standard(df: DataFrame, state: DataFrame, columns: Sequence[str]) -> DataFrame:
    """To mean 0 and population standard deviation 1; a constant column becomes 0."""
    return _scaled(df, state, columns, lambda x, s: (x - s.mean) / (s.std or 1.0))


def unscale_standard(df: DataFrame, state: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _scaled(df, state, columns, lambda x, s: x * (s.std or 1.0) + s.mean)


def save_prepared(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Prepared data and fitted state, one Parquet table each."""
    for name, table in tables.items():
        table.write.parquet(f"{folder}/{name}")


def load_prepared(spark, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}
