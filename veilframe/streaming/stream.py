"""The rule job on a stream.

Treatments that look at one row at a time run on the stream as they are. Numbered
pseudonyms need an order over all rows, so they run per micro-batch under a dictionary
that grows from batch to batch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from veilframe.operators.columns import add_age_range, drop_identifiers, generalize_years, hash_identifiers
from veilframe.operators.ledger import Ledger
from veilframe.plans.rules import deidentify_incremental


def row_treatments(stream: DataFrame, routed: Mapping[str, Sequence[str]], salt: str | None = None) -> DataFrame:
    """Hash, drop, age band and years, on a stream or a table."""
    hashed = hash_identifiers(stream, routed, salt)
    return generalize_years(add_age_range(drop_identifiers(hashed)))


def numbered_batches(stream: DataFrame, order_key: str, dictionaries: str, output: str,
                     row_key: str | None = None) -> DataStreamWriter:
    """A writer that numbers each micro-batch after all earlier ones.

    The dictionary is a ledger in the folder `dictionaries`, so a batch reads the buckets of its
    keys and not the history. It is saved before the rows, and each batch has its own output
    folder: a batch that runs again finds its keys numbered already and writes the same rows.
    """
    def one_batch(batch: DataFrame, batch_id: int) -> None:
        done = deidentify_incremental(batch, order_key, Ledger(batch.sparkSession, dictionaries), row_key=row_key)
        done.output.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    return stream.writeStream.foreachBatch(one_batch)
