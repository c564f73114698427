"""Small literal inputs for the edges of each operator."""

import datetime

import pytest
from pyspark.sql import functions as F

from veilframe.functions import dates, hashing
from veilframe.operators import encode, impute, privacy, series, utility
from veilframe.operators.columns import add_age_range, drop_identifiers, first_rows, generalize_years
from veilframe.operators.dictionary import (
    NAMESPACES, Namespace, alternate_namespaces, append_entries, apply_dictionary, build_dictionary,
    load_dictionary, new_entries,
)
from veilframe.operators.synth import cycled_conditions
from veilframe.plans.policy import column_types, load_roles, policy_rows, present_columns, resolve_roles
from veilframe.plans.rules import deidentify_rules


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def keyed(spark, columns, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n bigint, " + columns)


@pytest.mark.parametrize("text, year", [
    ("2011-10-08T21:45:38Z", 2011), ("30-01-1954", 1954), ("1976-04-03; 1989-06-03", 1976),
    ("12345", 1234), ("Unknown", None), ("", None), (None, None),
])
def test_year_is_the_first_four_digits(spark, text, year):
    assert one(spark, dates.year_of(F.lit(text).cast("string"))) == year


def test_years_as_text_keep_what_has_no_year(spark):
    df = keyed(spark, "START string", ("2011-10-08",), ("Unknown",), (None,))
    got = generalize_years(df, as_text=True).orderBy("n").collect()
    assert [r.start_year for r in got] == ["2011", "Unknown", None]


def test_numbers_follow_first_sight(spark):
    df = keyed(spark, "PAYER string", ("b",), ("a",), ("b",), ("c",), (None,), ("",))
    spec = {"payers": NAMESPACES["payers"]}
    got = apply_dictionary(df, build_dictionary(df, "n", spec), spec).orderBy("n").collect()
    assert [r.PAYER for r in got] == ["Payer_0001", "Payer_0002", "Payer_0001", "Payer_0003", None, ""]


def test_labels_widen_past_their_digits(spark):
    df = spark.range(1, 100_002).select(F.col("id").alias("n"), F.col("id").cast("string").alias("ORGANIZATION"),
                                        F.col("id").cast("string").alias("Id_encounter"))
    spec = {n: NAMESPACES[n] for n in ("organizations", "encounters")}
    got = apply_dictionary(df, build_dictionary(df, "n", spec, rows_per_bucket=9_000), spec)
    rows = {r.n: r for r in got.where(F.col("n").isin(1, 1000, 100_000)).collect()}
    assert (rows[1].ORGANIZATION, rows[1000].ORGANIZATION) == ("Org_001", "Org_1000")
    assert (rows[1].Id_encounter, rows[100_000].Id_encounter) == ("EN00001", "EN100000")


def test_two_columns_share_numbers(spark):
    df = keyed(spark, "PATIENT string, Id_patient string", ("x", "y"), ("y", "z"))
    for spec, last in ((NAMESPACES["patients"], "Patient_0003"), (alternate_namespaces()["patients"], "IDP_0003")):
        got = apply_dictionary(df, build_dictionary(df, "n", {"patients": spec}), {"patients": spec})
        assert [(r.PATIENT, r.Id_patient) for r in got.orderBy("n").collect()] == [
            ("Patient_0001", "Patient_0002"), ("Patient_0002", last)]


def test_separate_namespaces_may_give_equal_labels(spark):
    df = keyed(spark, "PAYER string, Id_payer string", ("p", "q"), ("q", "p"))
    spec = {n: NAMESPACES[n] for n in ("payers", "id_payers")}
    got = apply_dictionary(df, build_dictionary(df, "n", spec), spec).orderBy("n").collect()
    assert [(r.PAYER, r.Id_payer) for r in got] == [("Payer_0001", "Payer_0001"), ("Payer_0002", "Payer_0002")]
    shared = {"payers": Namespace(("PAYER", "Id_payer"), "Payer_", 4)}
    got = apply_dictionary(df, build_dictionary(df, "n", shared), shared).orderBy("n").collect()
    assert [(r.PAYER, r.Id_payer) for r in got] == [("Payer_0001", "Payer_0002"), ("Payer_0002", "Payer_0001")]


def test_second_batch_goes_on_counting(spark, tmp_path):
    spec, folder = {"payers": NAMESPACES["payers"]}, str(tmp_path / "dictionary")
    assert load_dictionary(spark, folder) is None
    first = keyed(spark, "PAYER string", ("a",), ("b",))
    append_entries(new_entries(first, "n", spec), folder)
    second = keyed(spark, "PAYER string", ("b",), ("c",))
    for _ in range(2):  # a batch that runs twice adds nothing the second time
        append_entries(new_entries(second, "n", spec, load_dictionary(spark, folder)), folder)
    assert load_dictionary(spark, folder).count() == 3
    got = {r.original: r.seq for r in load_dictionary(spark, folder).collect()}
    assert got == {"a": 1, "b": 2, "c": 3}


def test_large_namespaces_are_looked_up_on_the_keys_alone(spark):
    df = keyed(spark, "PATIENT string, Id_patient string, PAYER string, other string",
               ("x", "y", "p", "1"), ("y", None, "q", "2"), ("Unknown", "x", "p", None))
    known = build_dictionary(df, "n")
    direct, split = apply_dictionary(df, known), apply_dictionary(df, known, row_key="n", sent_bytes=0)
    assert split.columns == direct.columns == df.columns
    assert split.orderBy("n").collect() == direct.orderBy("n").collect()


def test_rows_that_pass_through_are_dealt_out(spark):
    """Half the rows hold the placeholder; none of the tasks of the shuffled lookup gets them all."""
    df = spark.range(20_000).select(F.col("id").alias("n"), F.when(F.col("id") % 2 == 0, "Unknown").otherwise(F.col("id").cast("string")).alias("PAYER"))
    spec = {"payers": NAMESPACES["payers"]}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        done = apply_dictionary(df, build_dictionary(df, "n", spec), spec, sent_bytes=0)
        sizes = [r["count"] for r in done.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) < 2 * 20_000 / len(sizes)
        assert done.where("PAYER = 'Unknown'").count() == 10_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_key_the_dictionary_lacks_never_leaks(spark):
    spec = {"payers": NAMESPACES["payers"]}
    known = build_dictionary(keyed(spark, "PAYER string", ("a",)), "n", spec)
    got = apply_dictionary(keyed(spark, "PAYER string", ("a",), ("new",)), known, spec).orderBy("n").collect()
    assert [r.PAYER for r in got] == ["Payer_0001", None]


def test_a_key_is_the_same_as_text_number_or_fraction(spark):
    spec = {"reason_codes": NAMESPACES["reason_codes"]}
    known = build_dictionary(keyed(spark, "REASONCODE double", (162864005.0,)), "n", spec)
    for kind, value in (("string", "162864005"), ("bigint", 162864005), ("double", 162864005.0)):
        got = apply_dictionary(keyed(spark, f"REASONCODE {kind}", (value,)), known, spec).first()
        assert got.REASONCODE == "RC_0001"


def test_hashes(spark):
    assert one(spark, hashing.hash_ssn(F.lit("999-65-9959"))) == "42d-da-debe"
    assert len(one(spark, hashing.hash_ssn(F.lit("999-65-9959"), "salt"))) == 26
    assert one(spark, hashing.hash_name(F.lit("Ammie189"))) == "Person_809b1fab"
    assert one(spark, hashing.hash_address(F.lit("901 Satterfield Pathway"))) == "Address_1c8d644b"
    assert one(spark, hashing.hash_name(F.lit(""))) == ""
    assert one(spark, hashing.keyed_uuid(F.lit(None).cast("string"), "s")) is None
    assert len(one(spark, hashing.keyed_uuid(F.lit("a"), "s"))) == 36


@pytest.mark.parametrize("bracket", [None, impute.BRACKET])
def test_medians(spark, bracket):
    df = keyed(spark, "a double, b bigint, c double", (1.0, 5, None), (2.0, 5, None), (3.0, 1, None), (10.0, None, None),
               (None, 7, None))
    medians = impute.exact_medians(df, ["a", "b", "c"], bracket=bracket)
    assert {r.feature: r.median for r in medians.collect()} == {"a": 2.5, "b": 5.0}
    filled = impute.fill_numbers(df, ["a", "c"], medians).orderBy("n").collect()
    assert [r.a for r in filled] == [1.0, 2.0, 3.0, 10.0, 2.5] and {r.c for r in filled} == {None}


@pytest.mark.parametrize("rows_per_bucket", [10, 1_000_000])
def test_bracketed_medians_are_exact(spark, rows_per_bucket):
    df = spark.range(5001).select(
        F.pmod(F.hash("id"), F.lit(997)).cast("double").alias("even"),
        F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.exp(F.col("id") / 500)).alias("hot"),
        F.lit(4.0).alias("same"), F.when(F.col("id") % 1000 == 7, F.col("id")).alias("sparse"),
        F.when(F.col("id") < 2, F.col("id")).alias("two"),
    )
    got = {r.feature: r.median for r in impute.exact_medians(df, df.columns, rows_per_bucket).collect()}
    expected = df.select(*[F.median(c).alias(c) for c in df.columns]).first().asDict()
    assert got == expected


@pytest.mark.parametrize("birth, age, band", [
    ("1954-01-30", 68, "65-74"), ("2011-01-01", 12, "12-17"), ("2005-01-01", 17, "12-17"),
    ("1998-01-01", 24, "18-24"), ("2023-03-01", 0, "<12"), ("1940-05-05", 82, "75+"), ("no date", None, "Unknown"),
])
def test_age(spark, birth, age, band):
    row = add_age_range(keyed(spark, "BIRTHDATE string", (birth,))).first()
    assert row.AGE_RANGE == band
    assert one(spark, dates.age_at_reference(dates.lenient_date(F.lit(birth)))) == age


def test_lenient_dates(spark):
    day = datetime.date(1954, 1, 30)
    assert one(spark, dates.lenient_date(F.lit("30-01-1954"))) == day
    assert one(spark, dates.lenient_date(F.lit("1954-01-30"))) == day
    assert one(spark, dates.lenient_date(F.lit("31-02-1954"))) is None


def test_scaling_of_a_constant_column(spark):
    df = keyed(spark, "x double", (3.0,), (3.0,), (None,))
    state = encode.scale_state(df, ["x"])
    assert [r.x for r in encode.scale_minmax(df, state, ["x"]).orderBy("n").collect()] == [-1.0, -1.0, None]
    assert [r.x for r in encode.scale_standard(df, state, ["x"]).orderBy("n").collect()] == [0.0, 0.0, None]


@pytest.mark.parametrize("rows_per_bucket", [1, 1_000_000])
def test_labels_are_numbered_in_sorted_order(spark, rows_per_bucket):
    df = keyed(spark, "g string", ("M",), ("F",), ("",))
    state = encode.label_state(df, ["g"], rows_per_bucket)
    assert [r.g for r in encode.encode_labels(df, state, ["g"]).orderBy("n").collect()] == [2, 1, 0]
    codes = keyed(spark, "g double", (-0.4,), (0.5,), (1.5,), (9.0,), (None,))
    assert [r.g for r in encode.decode_labels(codes, state, ["g"]).orderBy("n").collect()] == ["", "", "M", "M", None]
    cut = encode.decode_labels(codes, state, ["g"], clip=False).orderBy("n").collect()
    assert [r.g for r in cut] == ["", "", "F", None, None]


def test_sample_goes_round_the_conditions(spark):
    df = keyed(spark, "c string", ("x",), ("y",), ("z",))
    got = cycled_conditions(df, "n", 7).orderBy("sample").collect()
    assert [r.n for r in got] == [0, 1, 2, 0, 1, 2, 0]


@pytest.mark.parametrize("sent_bytes", [16 << 20, 0])
def test_originals_inside_texts(spark, sent_bytes):
    texts = [("Call 123-45-6789 now", "ann lee"), ("1234567890", None), ("", "ANN  LEE, Ann-Lee; annlee"), (None, "Lee Ann"),
             ("x" * 100_000 + " Straße 5b", "ann Lee ann"), ("123 45 6789 and 123-45-6789", "zoë")]
    df = spark.createDataFrame(texts, "a string, b string").withColumn("n", F.lit(7))
    keys = [("ssn", "123-45-6789"), ("ssn", "999-99-9999"), ("name", "Ann Lee"), ("name", "Ann Lee"), ("name", "ZOË"), ("name", None), ("name", " - "),
            ("street", "straße 5B")]
    found = privacy.originals_in_texts(df, spark.createDataFrame(keys, "namespace string, original string"), sent_bytes=sent_bytes)
    assert {tuple(r) for r in found.collect()} == {("a", "ssn", 2, 1), ("b", "name", 4, 2), ("a", "street", 1, 1)}
    assert found.columns == ["column", "namespace", "cells", "originals"]
    none = spark.createDataFrame([], "namespace string, original string")
    assert privacy.originals_in_texts(df, none).count() == 0 and privacy.originals_in_texts(df.select("n"), none).count() == 0


def test_first_rows(spark):
    df = spark.range(10)
    assert [first_rows(df, "id", n).count() for n in (None, 0, 3, 10, 11)] == [10, 0, 3, 10, 10]
    many = first_rows(spark.range(30_000), "id", 12_000)
    assert many.count() == 12_000 and many.agg(F.max("id")).first()[0] == 11_999
    assert first_rows(df.where("false"), "id", 3).count() == 0


@pytest.mark.parametrize("n", [1, 5, 11, 14, 25, 9_999, 10_001, 11_999])
def test_first_rows_over_nulls_and_ties(spark, n):
    """Ten null keys, then keys by twos, the second of each twice over in all columns."""
    rows = spark.range(12_000).select(
        F.when(F.col("id") >= 10, F.expr("id div 4")).alias("k"), F.when(F.col("id") % 4 == 0, F.lit("a")).otherwise(F.lit("b")).alias("x y"), F.lit(None).alias("z"))
    got = [tuple(r) for r in first_rows(rows.repartition(7), "k", n).collect()]
    assert got and len(got) == n
    assert sum(r[0] is None for r in got) == min(n, 10)
    whole = sorted((tuple(r) for r in rows.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    keys = lambda found: sorted((r[0] for r in found), key=lambda k: (k is not None, k or 0))
    assert keys(got) == keys(whole[:n])
    again = [tuple(r) for r in first_rows(rows.repartition(3), "k", n).collect()]
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_roles(spark, tmp_path):
    df = spark.createDataFrame([], "PROVIDER string, Id_encounter string, PAYER_COVERAGE double, CITY string, FIRST string")
    assert resolve_roles(df).direct == ["Id_encounter"]
    by_part = resolve_roles(df, mode="substring")
    assert by_part.direct == ["PROVIDER", "Id_encounter"] and by_part.quasi == ["PAYER_COVERAGE", "CITY"]
    path = tmp_path / "roles.json"
    path.write_text('{"direct_identifiers": ["FIRST", "ABSENT"], "other": 1}')
    roles = resolve_roles(df, load_roles(spark, str(path)))
    assert roles.direct == ["FIRST"] and "Id_encounter" in roles.clinical
    assert load_roles(spark, None) == {}
    treatments = {c: t for c, _, t in policy_rows(df, resolve_roles(df, {"direct_identifiers": ["FIRST", "PROVIDER"]}))}
    assert treatments["FIRST"] == "name" and treatments["PROVIDER"] == "drop"


def test_names_match_exactly(spark):
    df = spark.createDataFrame([], "ssn string, CONDITION_codes string")
    assert present_columns(["SSN"], df) == []
    assert drop_identifiers(df).columns == df.columns
    assert column_types(df)["sensitive_attributes"] == ["CONDITION_codes"]
    with pytest.raises(ValueError):
        present_columns(["a"], spark.createDataFrame([(1, 2)], ["a", "b"]).toDF("a", "A"))


def test_unknown_gets_a_number_only_as_published(spark):
    df = keyed(spark, "PAYER string, REASONCODE double, START string", ("a", 5.0, "2011-01-01"), (None, None, None),
               ("b", 7.0, "x"))
    plain = deidentify_rules(df, "n").output.orderBy("n").collect()
    assert [r.PAYER for r in plain] == ["Payer_0001", "Unknown", "Payer_0002"]
    assert [r.REASONCODE for r in plain] == ["RC_0001", "Unknown", "RC_0002"]
    assert [r.start_year for r in plain] == [2011, None, None]
    published = deidentify_rules(df, "n", as_published=True).output.orderBy("n").collect()
    assert [r.PAYER for r in published] == ["Payer_0001", "Payer_0002", "Payer_0003"]
    assert [r.REASONCODE for r in published] == ["RC_0001", "RC_0002", "RC_0003"]  # 5, median 6, 7
    assert [r.start_year for r in published] == ["2011", "Unknown", "x"]


def test_integrity_and_residue_are_found(spark):
    pairs = spark.createDataFrame(
        [("p", "a", "1"), ("p", "a", "2"), ("p", "b", "2"), ("q", "a", "1")],
        "namespace string, original string, pseudonym string")
    got = {r.namespace: tuple(r)[1:] for r in privacy.referential_integrity(pairs).collect()}
    assert got == {"p": (3, 1, 1), "q": (1, 0, 0)}
    before = keyed(spark, "PATIENT string, SSN string", ("a", "1"), ("b", "2"))
    after = keyed(spark, "PATIENT string, SSN string", ("Patient_0001", "1"), ("b", "2"))
    row = privacy.residual_identifiers(before, after, ["PATIENT"]).first()
    assert (row.distinct_values, row.original_keys_left, row.identifier_columns_left) == (2, 1, 1)


def test_closeness_by_hand(spark):
    df = keyed(spark, "q string, s string, v double", ("x", "1", 1.0), ("x", "1", 1.0), ("y", "2", 3.0), ("y", None, 3.0))
    row = privacy.t_closeness(df, ["q"], "s").first()
    assert (row.worst_distance, row.classes) == (0.5, 2)
    row = privacy.t_closeness_ordered(df, ["q"], "v", [2.0, 4.0]).first()
    assert (row.worst_distance, row.mean_distance) == (0.25, 0.25)
    row = privacy.l_diversity(df, ["q"], "s", 2).first()
    assert tuple(row) == (1, 2, 2)
    assert tuple(privacy.k_anonymity(df, ["q"], 3).first()) == (2, 2, 4, 2)


def test_distance_by_hand(spark):
    a = keyed(spark, "x double, c string", (1.0, "a"), (2.0, "a"), (3.0, None), (4.0, "b"))
    b = keyed(spark, "x double, c string", (1.0, "a"), (1.0, "b"), (1.0, "b"), (9.0, "z"))
    for rows_per_bucket in (1, 1000):
        row = utility.number_distance(a, b, ["x"], rows_per_bucket).first()
        assert (row.ks_distance, row.mean_change) == (0.5, 0.5)
    assert utility.category_distance(a, b, ["c"]).first().distance == 0.5
    got = {r.column: (r.cells, r.outside) for r in utility.label_validation(a, b, ["c"]).collect()}
    assert got == {"c": (4, 1)}
    got = {r.column: (r.cells, r.outside) for r in utility.number_range_validation(a, b, ["x"]).collect()}
    assert got == {"x": (4, 1)}


def test_history(spark, tmp_path):
    path = tmp_path / "training_history.json"
    path.write_text('{"g_losses": [0.7, 0.8],\n "d_losses": [1.4, 0.0], "g_lr": [0.1, 0.1],\n'
                    ' "d_lr": [0.1, 0.1], "epochs": [1, 2]}')
    points = series.unnest_series(series.read_history(spark, str(path)), ["epochs", "g_losses", "d_losses"])
    got = series.paired_ratio(points, "g_losses", "d_losses").orderBy("position").collect()
    assert [(r.epochs, r.ratio) for r in got] == [(1, 0.5), (2, 0.0)]
    last = series.latest_values(points.withColumn("run", F.lit("r")), "run", "epochs", ["g_losses"]).first()
    assert (last.epochs, last.g_losses) == (2, 0.8)
