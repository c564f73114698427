"""Where intermediate tables are written, and how."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SHARED_FOLDER_SETTING = "spark.checkpoint.dir"

# Lookup tables are sent to every executor up to so many counted bytes, all tables of one job together.
BROADCAST_BYTES = 16 << 20

# Folders of intermediate tables that `drafts` is to delete, the innermost last.
_open_drafts: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    A local session without the setting uses its warehouse; a cluster must name a folder.
    """
    named = spark.conf.get(SHARED_FOLDER_SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SHARED_FOLDER_SETTING} to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/drafts"


@contextmanager
def drafts(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written within are deleted at the end, as they may hold clear text.

    Results have to be saved within, as they read these tables. Without it the tables are
    deleted when the session's process ends.
    """
    _open_drafts.append([])
    try:
        yield
    finally:
        for path in _open_drafts.pop():
            files, place = files_at(spark, path)
            files.delete(place, True)


def files_at(spark: SparkSession, path: str):
    """The file system of a path, and the path in it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _noted(spark: SparkSession, path: str) -> None:
    """Marks a written table for deletion, at the end of `drafts` or of the process."""
    if _open_drafts:
        _open_drafts[-1].append(path)
    files, place = files_at(spark, path)
    files.deleteOnExit(place)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/veilframe/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of redoing the work,
    every reader sees the same rows, and Catalyst knows the size when it picks a join.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    # Keys and digests are most of what is written; the default codec leaves them as long as they are.
    writer = df.write.option("compression", "zstd")
    if by:
        writer = writer.partitionBy(by)
    writer.parquet(path)
    _noted(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def written_and_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """`written`, and how many rows were written, without a second job."""
    seen = Observation()
    table = written(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return table, seen.get["rows"]


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in memory: texts by their length, the rest at a flat rate."""
    texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    return sum(texts, F.lit(32 + 16 * len(df.columns)))


def written_and_sized(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """`written`, and how many bytes its rows take, without a second job."""
    seen = Observation()
    table = written(df.observe(seen, F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")), name)
    return table, seen.get["bytes"]


def sent_if_small(df: DataFrame, size: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a table whose bytes have been counted, if they are few. Catalyst cannot
    tell by itself: it goes by the size of all files, not of the part that is read."""
    return F.broadcast(df) if size <= limit else df


def all_small(sizes: dict[str, int], limit: int = BROADCAST_BYTES) -> set[str]:
    """The names whose tables may be sent together: the smallest, up to `limit` bytes in sum."""
    chosen, total = set(), 0
    for name, size in sorted(sizes.items(), key=lambda item: item[1]):
        total += size
        if total > limit:
            break
        chosen.add(name)
    return chosen


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A few rows the driver holds, as a table whose size Catalyst knows."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = [list(c) for c in zip(*rows)] or [[] for _ in schema]
    fields = to_arrow_schema(schema)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=fields), schema)
