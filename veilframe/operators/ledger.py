"""A saved dictionary whose batches cost what the batch costs, however long its history.

Entries lie in parts, and a part in buckets by the first bits of a hash of the key, as many as keep a
bucket near `bucket_rows`. A batch reads the buckets that its keys fall in and no others. The last number of
each namespace stands in the ledger, so nothing is read to go on counting. A batch adds one part; parts
are merged when the newer ones have grown to half of the one before them, so there are few of them, and
an entry is rewritten a logarithmic number of times.

The ledger is a folder of small files, one a version. A version is made by renaming a file to a
name that must not exist yet: of two writers one succeeds, and the other numbers its keys again after
those it now finds. Parts of attempts that failed are never listed, and so never read.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veilframe import fixed_values
from veilframe.operators.dictionary import COLUMNS, NAMESPACES, SCHEMA, Namespace, first_seen, numbered_entries, present
from veilframe.session import files_at, written

DEEPEST = 12  # bits of the hash that buckets are told by at most
BUCKET_ROWS = 100_000
ROWS_PER_TASK = 1_000_000
TRIES = 20
KEY = ["namespace", "original"]


def _prefix(bits: int) -> Column:
    hashed = F.xxhash64("namespace", "original")
    return F.shiftrightunsigned(hashed, 64 - bits).cast("int") if bits else F.lit(0)


class Ledger:
    """A dictionary in `folder` that grows by batches."""

    def __init__(self, spark: SparkSession, folder: str, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.folder, self.bucket_rows = spark, folder.rstrip("/"), bucket_rows
        # Parts never change, so the files of each are listed once.
        self._listed: dict[str, DataFrame] = {}

    # ---- versions ----------------------------------------------------------------------

    def state(self) -> dict:
        """The last version: its number, the last number of each namespace, the parts from old to new."""
        files, place = files_at(self.spark, f"{self.folder}/ledger")
        names = [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []
        names = [n for n in names if n.endswith(".json")]
        if not names:
            return {"version": 0, "last": {}, "parts": []}
        return json.loads(self.spark.read.text(f"{self.folder}/ledger/{max(names)}", wholetext=True).first()[0])

    def _commit(self, state: dict) -> bool:
        """Whether this became the version it names; False where another writer was faster."""
        context = self.spark.sparkContext
        hadoop = context._jvm.org.apache.hadoop.fs
        draft = f"{self.folder}/ledger/draft-{uuid.uuid4().hex}"
        files, place = files_at(self.spark, draft)
        out = files.create(place, False)
        out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        out.close()
        target = hadoop.Path(f"{self.folder}/ledger/{state['version']:020d}.json")
        never_over = context._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            hadoop.FileContext.getFileContext(place.toUri(), context._jsc.hadoopConfiguration()).rename(place, target, never_over)
        except Py4JJavaError as error:
            files.delete(place, False)
            if "FileAlreadyExistsException" in error.java_exception.toString():
                return False
            raise
        return True

    # ---- parts -------------------------------------------------------------------------

    def _written_part(self, entries: DataFrame, rows: int) -> dict:
        """The entries as a new part: where it is, its rows and the bits of its buckets."""
        depth = min(DEEPEST, max(0, math.ceil(math.log2(max(1, rows) / self.bucket_rows))))
        path = f"{self.folder}/parts/{uuid.uuid4().hex}"
        bucketed = entries.select(*COLUMNS, _prefix(depth).alias("bucket"))
        if depth:
            # A task writes several buckets, one after the other: there are more of them than tasks are worth.
            tasks = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))
            bucketed = bucketed.repartition(min(1 << depth, tasks), "bucket")
        else:
            bucketed = bucketed.coalesce(1)
        bucketed.sortWithinPartitions("bucket", *KEY).write.partitionBy("bucket").parquet(path)
        return {"path": path.removeprefix(f"{self.folder}/"), "rows": rows, "depth": depth}

    def _part(self, part: dict) -> DataFrame:
        if part["path"] not in self._listed:
            self._listed[part["path"]] = self.spark.read.schema(f"{SCHEMA}, bucket int").parquet(f"{self.folder}/{part['path']}")
        return self._listed[part["path"]]

    def entries(self) -> DataFrame:
        """All entries."""
        found = self.spark.createDataFrame([], SCHEMA).select(*COLUMNS)
        for part in self.state()["parts"]:
            found = found.unionByName(self._part(part).select(*COLUMNS))
        return found

    def near(self, keys: DataFrame, state: dict | None = None) -> DataFrame:
        """The entries of all buckets that some of the keys (namespace, original) fall in.

        The buckets are listed on the driver, at most 4,096 of them."""
        prefixes = [r[0] for r in keys.select(_prefix(DEEPEST).alias("p")).distinct().collect()]
        found = self.spark.createDataFrame([], SCHEMA).select(*COLUMNS)
        for part in (self.state() if state is None else state)["parts"]:
            touched = sorted({p >> (DEEPEST - part["depth"]) for p in prefixes})
            rows = self._part(part)
            if len(touched) < 1 << part["depth"]:
                rows = rows.where(F.col("bucket").isin(touched))
            found = found.unionByName(rows.select(*COLUMNS))
        return found

    # ---- batches -----------------------------------------------------------------------

    def extend(
        self, df: DataFrame, order_key: str, namespaces: Mapping[str, Namespace] = NAMESPACES,
        placeholder: str | None = fixed_values.UNKNOWN,
    ) -> DataFrame:
        """The entries of the keys in `df`; those met for the first time are numbered and saved.

        A batch that runs again finds all its keys, and adds nothing. A key and a number are never given
        twice, also where several writers extend the dictionary at a time.
        """
        namespaces = present(df, namespaces)
        keys = written(first_seen(df, order_key, namespaces, placeholder), "batch_keys")
        for _ in range(TRIES):
            state = self.state()
            found = keys.join(self.near(keys, state), KEY, "left")
            fresh_rows = Observation()
            found = written(found.observe(fresh_rows, F.count_if(F.col("pseudonym").isNull()).alias("rows")), "batch_found")
            known, rows = found.where(F.col("pseudonym").isNotNull()).select(*COLUMNS), fresh_rows.get["rows"]
            fresh = found.where(F.col("pseudonym").isNull()).select(*keys.columns)
            if not rows:
                return known
            seen = Observation()
            numbered = numbered_entries(fresh, rows, namespaces, state["last"]).observe(
                seen, *[F.max(F.when(F.col("namespace") == n, F.col("seq"))).alias(n) for n in namespaces])
            part = self._written_part(numbered, rows)
            last = state["last"] | {n: v for n, v in seen.get.items() if v is not None}
            if self._commit({"version": state["version"] + 1, "last": last, "parts": [*state["parts"], part]}):
                self.compact()
                return known.unionByName(self._part(part).select(*COLUMNS))
        raise RuntimeError(f"{TRIES} times another writer was faster: {self.folder}")

    def compact(self) -> None:
        """Merge the newest parts that have together grown to half of the one before them."""
        state = self.state()
        parts = state["parts"]
        at = len(parts) - 1
        total = parts[at]["rows"] if parts else 0
        while at > 0 and parts[at - 1]["rows"] <= 2 * total:
            at -= 1
            total += parts[at]["rows"]
        if at >= len(parts) - 1:
            return
        merged = self._part(parts[at]).select(*COLUMNS)
        for part in parts[at + 1:]:
            merged = merged.unionByName(self._part(part).select(*COLUMNS))
        done = self._written_part(merged, total)
        self._commit(state | {"version": state["version"] + 1, "parts": [*parts[:at], done]})

    def clean(self) -> None:
        """Delete parts that the last version does not list. Only while nobody reads or writes."""
        live = {part["path"] for part in self.state()["parts"]}
        files, place = files_at(self.spark, f"{self.folder}/parts")
        for found in files.listStatus(place) if files.exists(place) else []:
            if f"parts/{found.getPath().getName()}" not in live:
                files.delete(found.getPath(), True)
