"""Feature preparation: the two published orders of fill, encode, scale and split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe import fixed_values as fixed
from veilframe.functions.dates import lenient_date
from veilframe.functions.guards import number_columns, text_columns
from veilframe.operators import encode, impute
from veilframe.operators.columns import add_age_range, condition_target_split, drop_identifiers
from veilframe.plans.policy import Roles, present_columns
from veilframe.session import written


@dataclass(frozen=True)
class Prepared:
    conditions: DataFrame
    targets: DataFrame
    labels: DataFrame
    scales: DataFrame
    labelled: list[str]  # the columns that hold label codes
    rows: DataFrame  # conditions and targets together
    carried: DataFrame | None = None

    def tables(self) -> dict[str, DataFrame]:
        named = {"conditions": self.conditions, "targets": self.targets, "labels": self.labels,
                 "scales": self.scales, "carried": self.carried}
        return {name: table for name, table in named.items() if table is not None}


def days_since_epoch(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Date columns, or texts that hold dates, as whole days since 1970-01-01."""
    def days(name):
        column = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, T.StringType):
            column = lenient_date(column)
        return F.datediff(column.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint").alias(name)

    return df.select(*[days(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def date_from_days(days: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))


def prepare_for_quasi(df: DataFrame, row_key: str, roles: Roles, dates: Sequence[str] = ("BIRTHDATE",)) -> Prepared:
    """Conditions are clinical, targets quasi-identifiers.

    Age band set aside, missing to '' and 0, texts to codes, targets to [-1, 1].
    """
    df = add_age_range(df)
    carried = df.select(row_key, "AGE_RANGE") if "AGE_RANGE" in df.columns else None
    quasi = [c for c in roles.quasi if c != "AGE_RANGE"]
    used = [row_key, *roles.clinical, *quasi]
    frame = days_since_epoch(df.select(*used), present_columns(dates, df))
    numbers = [c for c in number_columns(frame) if c != row_key]
    frame = impute.fill_numbers(impute.fill_text(frame, value=""), numbers)
    texts = [c for c in text_columns(frame) if c != row_key]
    labels = encode.label_state(frame, texts)
    frame = written(encode.encode_labels(frame, labels, texts, row_key), "encoded")
    scales = encode.scale_state(frame, quasi)
    rows = encode.scale_minmax(frame, scales, quasi)
    conditions, targets = condition_target_split(rows, row_key, roles.clinical, quasi)
    return Prepared(conditions, targets, labels, scales, texts, rows, carried)


def prepare_for_sample(
    df: DataFrame,
    row_key: str,
    conditions: Sequence[str] = fixed.SAMPLE_CONDITIONS,
    targets: Sequence[str] = fixed.SAMPLE_TARGETS,
) -> Prepared:
    """Conditions are demographic, targets clinical and financial.

    Missing to 'Unknown' and the median, direct identifiers dropped, texts to codes, and
    each side standardised by its own mean and deviation.
    """
    df = drop_identifiers(df)
    conditions, targets = present_columns(conditions, df), present_columns(targets, df)
    frame = df.select(row_key, *conditions, *targets)
    numbers = [c for c in number_columns(frame) if c != row_key]
    frame = impute.fill_numbers(impute.fill_text(frame), numbers, impute.exact_medians(frame, numbers))
    texts = [c for c in text_columns(frame) if c != row_key]
    labels = encode.label_state(frame, texts)
    frame = written(encode.encode_labels(frame, labels, texts, row_key), "encoded")
    scales = encode.scale_state(frame, [*conditions, *targets])
    rows = encode.scale_standard(frame, scales, [*conditions, *targets])
    x, y = condition_target_split(rows, row_key, conditions, targets)
    return Prepared(x, y, labels, scales, texts, rows)


def restore_quasi(generated: DataFrame, prepared: Prepared, dates: Sequence[str] = ("BIRTHDATE",)) -> DataFrame:
    """Scaled targets back to their units, codes back to texts, days back to dates."""
    quasi = generated.columns[1:]
    frame = encode.unscale_minmax(generated, prepared.scales, quasi)
    frame = encode.decode_labels(frame, prepared.labels, [c for c in quasi if c in prepared.labelled], row_key=generated.columns[0])
    for column in present_columns(dates, frame):
        frame = frame.withColumn(column, date_from_days(F.rint(column)))
    return frame


def restore_sample(generated: DataFrame, prepared: Prepared, clip: bool = True) -> DataFrame:
    """Standardised targets back to their units, codes back to texts."""
    targets = generated.columns[1:]
    frame = encode.unscale_standard(generated, prepared.scales, targets)
    labelled = [c for c in targets if c in prepared.labelled]
    return encode.decode_labels(frame, prepared.labels, labelled, clip, generated.columns[0])
