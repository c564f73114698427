"""Date columns read under one format a column, voted on by the cells that leave no doubt.

A cell that only one format fits is a vote for it; a cell that several fit, such as the fifth of
April, says nothing. The votes of a column are a few counts, so they are kept and added up batch by
batch, and all its cells are then read the same way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.session import local_table

FORMATS = ("yyyy-MM-dd", "dd-MM-yyyy", "MM-dd-yyyy", "dd/MM/yyyy", "MM/dd/yyyy", "dd.MM.yyyy", "yyyyMMdd", "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _read(text: Column, form: str) -> Column:
    return F.try_to_timestamp(text, F.lit(form)).cast("date")


def format_votes(df: DataFrame, columns: Sequence[str], formats: Sequence[str] = FORMATS) -> DataFrame:
    """column, format, fits (cells that the format reads), votes (cells that no other does). One scan."""
    cells = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("text")) for c in columns])).alias("c")).select("c.*")
    readable = cells.where(F.col("text").isNotNull()).select("column", F.array_compact(F.array(*[
        F.when(_read(F.col("text"), f).isNotNull(), F.lit(f)) for f in formats])).alias("formats"))
    each = readable.select("column", F.explode("formats").alias("format"), (F.size("formats") == 1).cast("long").alias("vote"))
    return each.groupBy("column", "format").agg(F.count(F.lit(1)).alias("fits"), F.sum("vote").alias("votes"))


def merged_votes(*votes: DataFrame) -> DataFrame:
    """The votes of several batches, added up."""
    together = votes[0]
    for more in votes[1:]:
        together = together.unionByName(more)
    return together.groupBy("column", "format").agg(F.sum("fits").alias("fits"), F.sum("votes").alias("votes"))


def settled_formats(votes: DataFrame, formats: Sequence[str] = FORMATS) -> dict[str, list[str]]:
    """Per column its formats: by votes, then by cells they fit, then in the order given."""
    rows = votes.collect()  # columns times formats
    out: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (-r.votes, -r.fits, formats.index(r.format))):
        out.setdefault(row.column, []).append(row.format)
    return out


def read_dates(df: DataFrame, settled: Mapping[str, Sequence[str]]) -> DataFrame:
    """The columns as dates, each under its first format; a cell that this cannot read goes by the next of the
    column's formats, and is null where none reads it. Other columns stay."""
    def read(column: str) -> Column:
        text = F.col(f"`{column}`").cast("string")
        return F.coalesce(*[_read(text, f) for f in settled[column]]).alias(column)

    return df.select(*[read(c) if settled.get(c) else F.col(f"`{c}`") for c in df.columns])


def votes_table(spark, rows: Sequence[tuple[str, str, int, int]]) -> DataFrame:
    """Votes kept elsewhere, as a table."""
    return local_table(spark, rows, "column string, format string, fits bigint, votes bigint")
