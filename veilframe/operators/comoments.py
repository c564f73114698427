"""Correlation of all number columns at once, from a matrix of co-moments that merges by addition.

A task reads its rows in batches and adds up, for every pair of columns, count, sums, squares and products over
the rows that have both, as products of matrices. The sums of all tasks are then added pair by pair. Columns
are taken in stripes of bounded width. A task reads its rows once for as many stripes as its sums have room for;
only a table too wide for that is read again for the next ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.functions.guards import number_columns

STRIPE = 256
PASS_BYTES = 64 << 20  # the sums a task holds at a time, unless a single stripe takes more
SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def passes(columns: int, stripe: int, pass_bytes: int) -> list[list[int]]:
    """The first columns of the stripes, by the reading of the table that takes them."""
    found, room = [], 0
    for first in range(0, max(1, columns), stripe):
        size = 8 * len(SUMS) * min(stripe, columns - first) * (columns - first)
        if not found or size > room:
            found.append([])
            room = pass_bytes
        found[-1].append(first)
        room -= size
    return found


def comoments(df: DataFrame, columns: Sequence[str] | None = None, stripe: int = STRIPE, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """a, b (a before b by place), n, sx, sy, sxx, syy, sxy: the sums over the rows that have both columns.

    Values are taken from the column's mean, so that large numbers with little spread do not cancel out. Null and
    NaN cells are left out pair by pair.
    """
    names = list(number_columns(df) if columns is None else columns)
    cells = {c: F.col(f"`{c}`").cast("double") for c in names}
    numbers = df.select(*[F.when(~F.isnan(x), x).alias(c) for c, x in cells.items()])
    means = numbers.agg(*[F.avg(f"`{c}`").alias(c) for c in names]).first()
    centre = np.array([0.0 if means[c] is None else means[c] for c in names])
    schema = "a int, b int, " + ", ".join(f"{s} double" for s in SUMS)

    def striped(firsts: list[int]):
        ends = {first: min(first + stripe, len(names)) for first in firsts}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Of a stripe the columns from its first one on: those before are in earlier stripes.
            sums = {first: {s: np.zeros((last - first, len(names) - first)) for s in SUMS} for first, last in ends.items()}
            for batch in batches:
                columns = [np.asarray(c.to_numpy(zero_copy_only=False), float) for c in batch.columns]
                values = np.stack(columns, axis=1) - centre if columns else np.zeros((0, 0))
                here = ~np.isnan(values)
                there = here.astype(float)
                values = np.where(here, values, 0.0)
                squares = values * values
                for first, last in ends.items():
                    x, xx, m = values[:, first:last].T, squares[:, first:last].T, there[:, first:last].T
                    y, yy, n = values[:, first:], squares[:, first:], there[:, first:]
                    for s, matrix in zip(SUMS, (m @ n, x @ n, m @ y, xx @ n, m @ yy, x @ y)):
                        sums[first][s] += matrix
            for first, last in ends.items():
                a, b = np.nonzero(np.arange(first, last)[:, None] < np.arange(first, len(names)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((a + first).astype(np.int32)), pa.array((b + first).astype(np.int32)),
                     *[pa.array(sums[first][s][a, b]) for s in SUMS]],
                    names=["a", "b", *SUMS])

        return numbers.mapInArrow(run, schema)

    parts = reduce(DataFrame.unionByName, [striped(firsts) for firsts in passes(len(names), stripe, pass_bytes)])
    merged = parts.groupBy("a", "b").agg(*[F.sum(s).alias(s) for s in SUMS])
    listed = F.array(*[F.lit(c) for c in names]).cast("array<string>")
    return merged.select(F.get(listed, F.col("a")).alias("a"), F.get(listed, F.col("b")).alias("b"), F.col("n").cast("bigint").alias("n"), *SUMS[1:])


def correlations(df: DataFrame, columns: Sequence[str] | None = None, stripe: int = STRIPE) -> DataFrame:
    """a, b, n, correlation of every pair of number columns, over the rows that have both; null where there are
    fewer than two such rows or one of the columns does not vary in them."""
    found = comoments(df, columns, stripe)
    xx = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    yy = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    xy = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    least = 1e-12
    varies = (F.col("n") > 1) & (xx > least * F.col("sxx")) & (yy > least * F.col("syy"))
    return found.select("a", "b", "n", F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), xy / F.sqrt(xx * yy)))).alias("correlation"))
