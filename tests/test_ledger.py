"""The dictionary that grows by batches: cost, repeats, and writers at the same time."""

import pytest
from pyspark.sql import functions as F

from veilframe.catalog.keys import _ten_batches
from veilframe.operators.dictionary import Namespace
from veilframe.operators.ledger import Ledger

SPEC = {"people": Namespace(("who", "other"), "P_", 4, "Q_"), "places": Namespace(("place",), "L_", 3)}


def batch(spark, first, count, modulus=10**9):
    rows = spark.range(first, first + count)
    number = (F.col("id") % modulus).cast("string")
    return rows.select("id", F.concat(F.lit("p"), number).alias("who"), F.concat(F.lit("p"), number).alias("other"),
                       F.concat(F.lit("l"), (F.col("id") % 7).cast("string")).alias("place"))


def people(ledger):
    return {r.original: r.seq for r in ledger.entries().where("namespace = 'people'").collect()}


def test_rows_read_follow_the_batch_and_not_the_history(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "d"), bucket_rows=50)
    ledger.extend(batch(spark, 0, 4_000), "id", SPEC)
    read = []
    for i in range(10):
        again = batch(spark, 4_000 + 10 * i, 10).unionByName(batch(spark, 37 * i, 5))
        keys = again.select(F.lit("people").alias("namespace"), F.col("who").alias("original"))
        read.append(ledger.near(keys).count())
        found = ledger.extend(again, "id", SPEC)
        assert found.where("namespace = 'people'").count() == 15
    assert max(read) <= 15 * 2 * 50 + 200 and max(read) < 2_000 and read[-1] < 2 * read[0]
    assert sorted(people(ledger).values()) == list(range(1, 4_101))
    assert len(ledger.state()["parts"]) <= 7


def test_batches_equal_one_pass_and_repeats_add_nothing(spark, tmp_path):
    parts, whole = Ledger(spark, str(tmp_path / "a"), bucket_rows=20), Ledger(spark, str(tmp_path / "b"))
    whole.extend(batch(spark, 0, 300, 130), "id", SPEC)
    for first in range(0, 300, 60):
        parts.extend(batch(spark, first, 60, 130), "id", SPEC)
    assert sorted(map(tuple, parts.entries().collect())) == sorted(map(tuple, whole.entries().collect()))
    version = parts.state()["version"]
    again = parts.extend(batch(spark, 60, 60, 130), "id", SPEC)
    assert parts.state()["version"] == version and again.count() == 60 + 7
    parts.clean()
    assert people(parts) == people(whole)


@pytest.mark.parametrize("overlap", [0, 30])
def test_a_second_writer_gives_no_number_twice(spark, tmp_path, monkeypatch, overlap):
    first, second = Ledger(spark, str(tmp_path / "d")), Ledger(spark, str(tmp_path / "d"))
    commit, done = first._commit, []

    def late(state):
        if not done:  # the other writer comes first, between this one's reading and its commit
            done.append(second.extend(batch(spark, 50 - overlap, 50), "id", SPEC))
        return commit(state)

    monkeypatch.setattr(first, "_commit", late)
    found = first.extend(batch(spark, 0, 50), "id", SPEC)
    got = people(first)
    assert sorted(got.values()) == list(range(1, 101 - overlap)) and got[f"p{99 - overlap}"] <= 50
    assert {r.original: r.seq for r in found.where("namespace = 'people'").collect()} == {k: v for k, v in got.items() if int(k[1:]) < 50}


def test_a_part_is_listed_once_and_a_batch_read_alone(spark, tmp_path, sf_dir):
    ledger = Ledger(spark, str(tmp_path / "d"), bucket_rows=1)
    ledger.extend(batch(spark, 0, 100), "id", SPEC)
    part = ledger.state()["parts"][0]
    assert ledger._part(part) is ledger._part(part)
    batches = _ten_batches(spark, sf_dir, ["order_key"])
    orders = [r[0] for r in spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey").collect()]
    for i, df in enumerate(batches):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(_batch" in plan
        assert sorted(r[0] for r in df.collect()) == sorted(k for k in orders if k * 10 // (max(orders) + 1) == i)


def test_an_empty_ledger_and_an_empty_batch(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "d"))
    assert ledger.entries().count() == 0 and ledger.extend(batch(spark, 0, 0), "id", SPEC).count() == 0
    assert ledger.state()["version"] == 0
