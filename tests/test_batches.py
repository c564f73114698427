"""Parallel CSV, date votes, co-moments and column state against plain versions."""

import numpy as np
import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from veilframe.operators import encode
from veilframe.operators.column_state import append_state, column_state, load_state, merged_state, scale_state_of, state_report
from veilframe.operators.comoments import comoments, correlations
from veilframe.operators.date_formats import format_votes, merged_votes, read_dates, settled_formats
from veilframe.sources.tables import POSITION, row_count, scan_csv, write_csv


@pytest.mark.parametrize("bytes_a_task", ["128m", "700"])
def test_breaks_are_read_in_parallel(spark, tmp_path, bytes_a_task):
    texts = ["one\ntwo", "a\r\nb", 'say "x\ny"', '"', '""\n""', ",\n,", "back\\slash\n", "\n\n\n", "plain", "", None, " lead\n trail ", "é\n日"]
    df = spark.createDataFrame([(i, texts[i % len(texts)], f"v{i}") for i in range(400)], "n bigint, t string, `odd \"name\", x` string")
    write_csv(df.coalesce(1), str(tmp_path / "out"), line_breaks="quoted")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_a_task)
    try:
        path = str(tmp_path / "out")
        if bytes_a_task != "128m":
            assert spark.read.text(path).rdd.getNumPartitions() > 8
        one = scan_csv(spark, path, types={"n": "bigint"}, line_breaks="quoted")
        many = scan_csv(spark, path, types={"n": "bigint"}, line_breaks="parallel")
        assert many.columns == one.columns == df.columns and rows_of(many) == rows_of(one)
        assert row_count(spark, path, "parallel") == 400
        placed = scan_csv(spark, path, types={"n": "bigint"}, line_breaks="parallel", position=True)
        assert [r.n for r in placed.orderBy(POSITION).collect()] == list(range(400))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_files_with_and_without_headers_ends_and_pairs(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_bytes(b'x,"y\nz"\r\n1,"a\r\nb"\r\n\r\n2,c\r\n')
    (folder / "b.csv").write_bytes(b'x,"y\nz"\n3,"d ""\n"" e"\n4,f')
    (folder / "c.csv").write_bytes(b"")
    (folder / "d.csv").write_bytes(b'x,"y\nz"\n5,open "end\n6,g\n')
    got = scan_csv(spark, str(folder), line_breaks="parallel")
    assert got.columns == ["x", "y\nz"]
    rows = {tuple(r) for r in got.collect()}
    assert {("1", "a\r\nb"), ("2", "c"), ("3", 'd "\n" e'), ("4", "f"), ("6", "g")} <= rows and len(rows) == 6
    assert scan_csv(spark, str(folder / "c.csv"), line_breaks="parallel").count() == 0


def test_a_day_above_twelve_settles_the_column(spark):
    rows = [("03-04-2020", "03-04-2020", "2020-01-02", "x"), ("25-04-2020", "04-25-2020", None, None), ("05-06-2021", "05-06-2021", "03-04-2020", "")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    votes = [format_votes(df.where(p), ["a", "b", "c", "d"]) for p in (F.col("a") < "05", F.col("a") >= "05")]
    settled = settled_formats(merged_votes(*votes))
    assert settled["a"][0] == "dd-MM-yyyy" and settled["b"][0] == "MM-dd-yyyy" and settled["c"][0] == "yyyy-MM-dd" and "d" not in settled
    got = [tuple(map(str, r)) for r in read_dates(df, settled).collect()]
    assert got == [("2020-04-03", "2020-03-04", "2020-01-02", "x"), ("2020-04-25", "2020-04-25", "None", "None"),
                   ("2021-06-05", "2021-05-06", "2020-04-03", "")]
    assert settled_formats(format_votes(df.where("false"), ["a"])) == {}


@pytest.mark.parametrize("stripe", [1, 3, 256])
def test_correlations_equal_those_of_pandas(spark, stripe):
    rng = np.random.default_rng(1)
    table = pd.DataFrame(rng.normal(size=(300, 6)), columns=list("abcdef"))
    table["b"] = 1e6 + table["a"] * 1e-3 + table["b"] * 1e-3
    table["c"] = 5.0
    table.loc[rng.random(300) < 0.3, "d"] = np.nan
    table.loc[1:, "e"] = np.nan
    df = spark.createDataFrame(table).withColumn("d", F.when(~F.isnan("d"), F.col("d")))
    expected = table.corr()
    got = {(r.a, r.b): r for r in correlations(df, stripe=stripe).collect()}
    assert len(got) == 15
    for (a, b), r in got.items():
        assert r.n == table[[a, b]].dropna().shape[0]
        if "c" in (a, b) or "e" in (a, b):
            assert r.correlation is None
        else:
            assert abs(r.correlation - expected.loc[a, b]) < 1e-6
    assert all(r.n == 0 and r.correlation is None for r in correlations(df.where("false"), stripe=stripe).collect())


def test_correlations_read_the_table_once_for_many_stripes(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame(pd.DataFrame(rng.normal(size=(50, 7)), columns=list("abcdefg")))

    def readings(found):
        return found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")

    once, often = comoments(df, stripe=2), comoments(df, stripe=2, pass_bytes=1)
    assert readings(once) == 1 and readings(often) == 4
    told = [sorted((r.a, r.b, r.n, round(r.sxy, 9)) for r in found.collect()) for found in (once, often, comoments(df))]
    assert told[0] == told[1] == told[2] and len(told[0]) == 21


def test_states_of_batches_equal_one_pass(spark, tmp_path):
    df = spark.range(5_000).select("id", (F.col("id") % 700).alias("m"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), F.col("id") % 40)).alias("t"),
                                   (F.col("id") * 0.5 + 1e6).alias("x"), F.lit(None).cast("int").alias("none"))
    for i in [*range(10), 3]:  # the fourth batch runs again
        append_state(column_state(df.where(F.col("id") % 10 == i)), str(tmp_path / "s"), i)
    def told(state):
        return {r.column: (r.rows, r.nulls, r.distinct, r.least, r.most, r.first, r.last, round(r.mean, 6) if r.mean is not None else None,
                           round(r.deviation, 4) if r.deviation is not None else None) for r in state_report(state).collect()}
    batches, whole = told(load_state(spark, str(tmp_path / "s"))), told(column_state(df))
    without = {c: r[:2] + r[3:] for c, r in batches.items()}
    assert without == {c: r[:2] + r[3:] for c, r in whole.items()}
    assert all(abs(batches[c][2] - whole[c][2]) <= 0.03 * whole[c][2] for c in whole)
    assert whole["none"][:3] == (5_000, 5_000, 0) and whole["t"][1] == 1_667
    assert abs(whole["m"][2] - 700) <= 0.03 * 700 and whole["t"][2] == 40
    scales = {r.feature: r for r in scale_state_of(load_state(spark, str(tmp_path / "s"))).collect()}
    for r in encode.scale_state(df, ["id", "m", "x"]).collect():
        s = scales[r.feature]
        assert (s.lo, s.hi) == (r.lo, r.hi) and abs(s.mean - r.mean) < 1e-6 and abs(s.std - r.std) < 1e-4
    assert load_state(spark, str(tmp_path / "nothing")) is None
    empty = column_state(df.where("false"))
    assert merged_state(empty, empty).count() == 0
