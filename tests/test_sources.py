"""Reading, writing and saved state."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from veilframe.catalog.visits import visits
from veilframe.operators.dictionary import NAMESPACES, build_dictionary, export_dictionary
from veilframe.operators.encode import load_prepared, save_prepared
from veilframe.plans.features import prepare_for_quasi, prepare_for_sample, restore_quasi, restore_sample
from veilframe.plans.policy import resolve_roles
from veilframe.fixed_values import DEFAULT_ROLES, MISSING_TOKENS
from veilframe.sources.tables import (
    POSITION, inferred_types, missing_to_null, row_count, scan_csv, scan_parquet, write_csv, write_json,
)


def test_csv_missing_tokens_types_and_codes(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('a,b,ZIP,note\n1,1.5,02101,"x, ""y"""\nNA,nan,NULL,\n3,2,02102,Unknown\n')
    df = scan_csv(spark, str(path), infer=True, types={"ZIP": "string"})
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "ZIP": "string", "note": "string"}
    assert rows_of(df.select("a", "b", "ZIP", "note")) == rows_of(spark.createDataFrame(
        [(1, 1.5, "02101", 'x, "y"'), (None, None, None, None), (3, 2.0, "02102", "Unknown")],
        "a bigint, b double, ZIP string, note string"))


def test_every_missing_token_is_null(spark, tmp_path):
    df = spark.createDataFrame([(t, float("nan")) for t in MISSING_TOKENS], "t string, x double")
    assert missing_to_null(df).agg(F.count("t"), F.count("x")).first() == (0, 0)
    df.write.parquet(str(tmp_path / "p"))
    assert scan_parquet(spark, str(tmp_path / "p")).agg(F.count("t"), F.count("x")).first() == (0, 0)


def test_position_keeps_the_order_of_lines(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("PAYER\n" + "\n".join(f"key{(i * 7919) % 5000}" for i in range(20_000)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = scan_csv(spark, str(path), position=True)
        assert df.rdd.getNumPartitions() > 3
        spec = {"payers": NAMESPACES["payers"]}
        got = build_dictionary(df, POSITION, spec, rows_per_bucket=700)
        numbers = {r.original: r.seq for r in got.collect()}
        assert numbers == {f"key{(i * 7919) % 5000}": i + 1 for i in range(5000)}
        assert [r.PAYER for r in scan_csv(spark, str(path), position=True, rows=2).collect()] == ["key0", "key2919"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_written_csv_reads_back(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, None)], "n bigint, t string")
    write_csv(df, str(tmp_path / "out"))
    assert row_count(spark, str(tmp_path / "out")) == 2
    assert rows_of(scan_csv(spark, str(tmp_path / "out"), infer=True)) == rows_of(df)
    write_json(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2


@pytest.mark.parametrize("sink, source", [("quoted", "quoted"), ("escape", "escaped")])
def test_line_breaks_survive(spark, tmp_path, sink, source):
    texts = ["one\ntwo", "a\r\nb", "back\\nslash", '"quoted", \\', "\\\\n\n", None]
    df = spark.createDataFrame(list(enumerate(texts)), "n bigint, t string")
    write_csv(df, str(tmp_path / "out"), line_breaks=sink)
    assert rows_of(scan_csv(spark, str(tmp_path / "out"), types={"n": "bigint"}, line_breaks=source)) == rows_of(df)
    assert row_count(spark, str(tmp_path / "out"), source) == 6


def test_line_breaks_are_refused_unless_asked_for(spark, tmp_path):
    with pytest.raises(Exception, match="line break in column t"):
        write_csv(spark.createDataFrame([("a\nb",)], "t string"), str(tmp_path / "out"))


def test_long_whole_numbers_stay_apart(spark):
    rows = [("9000000000000000001", "90000000000000000001", "12345678901234567", "1"), ("9000000000000000002", "90000000000000000002", "1.5", "2.5")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    assert inferred_types(df) == {"a": "bigint", "d": "double"}


def test_inferred_types(spark):
    df = spark.createDataFrame([("1", "1.5", "x", None), ("-2", "3", "4", None)], "a string, b string, c string, d string")
    assert inferred_types(df) == {"a": "bigint", "b": "double", "d": "double"}


def test_dictionary_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n bigint, PAYER string")
    export_dictionary(build_dictionary(df, "n"), str(tmp_path / "x"), ["payers"])
    got = spark.read.json(str(tmp_path / "x"))
    assert {(r.namespace, r.original, r.pseudonym) for r in got.collect()} == {
        ("payers", "a", "Payer_0001"), ("payers", "b", "Payer_0002")}


def test_prepared_data_round_trip(spark, sf_dir, tmp_path):
    df = visits(spark, sf_dir)
    done = prepare_for_quasi(df, "order_key", resolve_roles(df, DEFAULT_ROLES))
    save_prepared(done.tables(), str(tmp_path / "prepared"))
    back = load_prepared(spark, str(tmp_path / "prepared"), list(done.tables()))
    assert set(back) == {"conditions", "targets", "labels", "scales", "carried"}
    for name, table in done.tables().items():
        assert rows_of(back[name]) == rows_of(table)


def test_restored_features_equal_the_originals(spark, sf_dir):
    df = visits(spark, sf_dir)
    quasi = prepare_for_quasi(df, "order_key", resolve_roles(df, DEFAULT_ROLES))
    restored = restore_quasi(quasi.targets, quasi).select(
        "order_key", F.date_format("BIRTHDATE", "dd-MM-yyyy").alias("BIRTHDATE"), "CITY",
        F.nullif("MARITAL", F.lit("")).alias("MARITAL"))
    assert rows_of(restored) == rows_of(df.select("order_key", "BIRTHDATE", "CITY", "MARITAL"))
    sample = prepare_for_sample(df, "order_key")
    restored = restore_sample(sample.targets, sample)
    assert rows_of(restored.select("order_key", "ENCOUNTERCLASS", F.round("BASE_ENCOUNTER_COST", 2))) == rows_of(
        df.select("order_key", "ENCOUNTERCLASS", F.round("BASE_ENCOUNTER_COST", 2)))
