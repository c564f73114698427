"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.session import written_and_counted

# The white space of the contracts: space, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]"
NO_SPACE = r"[^\x20\x09-\x0D]"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Tables of keys up to this many bytes go to every executor; larger ones are joined by a shuffle.
SENT_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column | str) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Runs of characters that are not white space."""
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once a row, also where `body` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front where a column of `df` has the name already."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def sent_if_few(keys: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Marked for broadcast if so many rows of so many bytes are within SENT_BYTES."""
    return F.broadcast(keys) if rows * row_bytes <= SENT_BYTES else keys


def without_ids(df: DataFrame, id_col: str, ids: DataFrame, name: str) -> DataFrame:
    """Rows whose id is not among `ids` (one column). The ids are written and counted first:
    few are sent to the executors, so that wide rows stay where they are; many are shuffled."""
    key = free_names(df, "gone_id")[0]
    gone, rows = written_and_counted(ids.toDF(key), name)
    return df.join(sent_if_few(gone, rows, 64), F.col(key) == F.col(id_col), "left_anti")


def quoted(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]
