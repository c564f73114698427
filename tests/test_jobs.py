"""Properties of the composed jobs, and the stream."""

from pyspark.sql import functions as F

from veilframe.catalog.visits import loaded_visits, visits
from veilframe.operators import privacy, utility
from veilframe.operators.ledger import Ledger
from veilframe.operators.tree_synth import codes, pair_information
from veilframe.plans.hybrid import clinical_sample, deidentify_hybrid, run_all
from veilframe.plans.policy import route_direct
from veilframe.plans.rules import deidentify_rules
from veilframe.streaming.stream import numbered_batches, row_treatments

KEYS = ["Id_encounter", "PATIENT", "Id_patient", "ORGANIZATION", "PAYER", "Id_payer", "REASONCODE"]


def test_rule_job_leaves_nothing_and_keeps_every_row(spark, sf_dir):
    df = visits(spark, sf_dir)
    done = deidentify_rules(df, "order_key")
    assert done.output.count() == df.count()
    assert len(done.output.columns) == len(df.columns) - len(done.removed)
    left = privacy.residual_identifiers(df, done.output, KEYS).collect()
    assert all(r.original_keys_left == 0 and r.identifier_columns_left == 0 for r in left)
    years = privacy.date_precision(done.output, ["start_year", "stop_year", "birth_year", "condition_year"])
    assert all(r.finer_than_year == 0 for r in years.collect())


def test_hybrid_job_stays_in_the_observed_range(spark, sf_dir):
    df = visits(spark, sf_dir)
    for mode in ("joint", "marginal"):
        out = deidentify_hybrid(df, "order_key", mode=mode, floor_rows=5)
        assert out.count() == df.count()
        assert "PATIENT" not in out.columns and "START" not in out.columns
        labels = utility.label_validation(df, out, ["MARITAL", "CITY", "STATE"]).collect()
        assert all(r.outside == 0 for r in labels)
        assert dict(out.dtypes)["BIRTHDATE"] == "date"


def test_sample_is_decoded(spark, sf_dir):
    df = visits(spark, sf_dir)
    sample = clinical_sample(df, "order_key", rows=30)
    assert sample.count() == 30
    assert all(r.outside == 0 for r in utility.label_validation(df, sample, ["ENCOUNTERCLASS", "PAYER"]).collect())


def test_stages_are_optional(spark, sf_dir):
    assert set(run_all(visits(spark, sf_dir), "order_key", synthesis=False, sample=False)) == {"rules"}


def _stream(spark, source, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)


def test_stream_numbers_batch_after_batch(spark, sf_dir, tmp_path):
    source, dictionaries, output = (str(tmp_path / n) for n in ("in", "dictionary", "out"))
    df = visits(spark, sf_dir, ["order_key", "PATIENT", "START", "SSN"])
    df.where("order_key < 700").coalesce(1).write.parquet(source)
    for bound in (700, 1500):
        if bound == 1500:
            df.where("order_key >= 700").coalesce(1).write.mode("append").parquet(source)
        writer = numbered_batches(_stream(spark, source, df.schema), "order_key", dictionaries, output)
        query = writer.option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start()
        query.awaitTermination()
    rows = spark.read.parquet(output)
    assert rows.count() == df.count() and "SSN" not in rows.columns
    whole = deidentify_rules(df, "order_key", fill=False)
    assert rows.select("order_key", "PATIENT").exceptAll(whole.output.select("order_key", "PATIENT")).count() == 0
    assert Ledger(spark, dictionaries).entries().count() == whole.dictionary.count()


def test_stream_of_row_treatments(spark, sf_dir, tmp_path):
    source = str(tmp_path / "in")
    df = visits(spark, sf_dir, ["order_key", "LAST", "SSN", "START", "BIRTHDATE"])
    df.write.parquet(source)
    routed = route_direct(["LAST"])
    stream = row_treatments(_stream(spark, source, df.schema), routed)
    out = str(tmp_path / "out")
    query = stream.writeStream.option("checkpointLocation", str(tmp_path / "progress")).trigger(
        availableNow=True).start(out, format="parquet")
    query.awaitTermination()
    expected = row_treatments(df, routed)
    assert spark.read.parquet(out).exceptAll(expected).count() == 0
    assert set(expected.columns) == {"order_key", "AGE_RANGE", "start_year", "birth_year"}
    assert expected.where(F.col("start_year").isNull()).count() == 0


def test_rows_told_apart_by_a_written_row_id(spark, sf_dir):
    """Rows that repeat keep their number and their cells; the id is not filled, and written tables are packed."""
    df = loaded_visits(spark, sf_dir, row_id="_row").where("order_key % 30 = 0")
    df = df.unionByName(df.withColumn("_row", -1 - df["_row"]))
    by_id = deidentify_rules(df, "order_key", row_key="_row").output
    assert dict(by_id.dtypes)["_row"] == "bigint" and by_id.count() == df.count() > 40
    plain = deidentify_rules(df.drop("_row"), "order_key").output
    columns = plain.columns
    assert sorted(map(repr, by_id.select(columns).collect())) == sorted(map(repr, plain.collect()))
    assert all(f.endswith(".zstd.parquet") for f in loaded_visits(spark, sf_dir, ["order_key"]).inputFiles())


def test_equal_rows_are_counted_before_the_pairs(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    plans, collect = [], Classic.collect
    monkeypatch.setattr(Classic, "collect", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or collect(df))
    df = spark.range(40).selectExpr("id % 2 AS a", "id % 2 AS b", "id % 3 AS c")
    found = pair_information(df, codes(df, ["a", "b", "c"]))
    assert found["a", "b"] == 0.693147 and abs(found["a", "c"]) < 0.01
    assert "Aggregate" in plans[0].split("Generate explode")[1]


def test_digests_and_dates_are_worked_out_once_a_row(spark):
    from veilframe.functions import hashing
    from veilframe.functions.dates import DATE_FORMATS, lenient_date
    from veilframe.operators.columns import add_age_range, hash_identifiers

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD")[0]

    texts = ["", None, "05-03-1960", "1960-03-05", "1960-03-05T01:02:03Z", "1960-03-05t01:02:03z", "+12345-01-02", "31-02-1960", "5-3-1960",
             "05-03-+12345", "1960-03-05 ", " 05-03-1960", "0-1", "-", "05-03-60", "1960-3-5", "1960-03-05T01:02:03", "1960-03-05T01:02:60Z", "x"]
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "n int, BIRTHDATE string, Id string")
    plain = F.coalesce(*[F.try_to_timestamp("BIRTHDATE", F.lit(f)).cast("date") for f in DATE_FORMATS])
    rows = df.select("n", plain.alias("plain"), lenient_date(F.col("BIRTHDATE")).alias("got")).selectExpr("n", "string(plain)", "string(got)").collect()
    assert all(r.plain == r.got for r in rows) and sum(r.got is not None for r in rows) >= 4
    aged = add_age_range(df)
    assert aged.columns == [*df.columns, "AGE_RANGE"] and plan(aged).count("gettimestamp") == len(DATE_FORMATS)
    for kind, one in (("id", lambda t: hashing.keyed_uuid(t, "s")), ("ssn", lambda t: hashing.hash_ssn(t, "s"))):
        hashed = hash_identifiers(df, {kind: ["Id"]}, "s")
        assert plan(hashed).count("sha2(") == 1 and hashed.columns == df.columns
        expected = df.select("n", "BIRTHDATE", one(F.col("Id")).alias("Id"))
        assert sorted(map(repr, hashed.collect())) == sorted(map(repr, expected.collect()))


def test_lines_of_an_order_are_gathered_after_the_shuffle(spark, sf_dir):
    """Sets of days are built once, not on both sides of the shuffle."""
    plan = visits(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    sets, shuffle = (next(i for i, line in enumerate(lines) if word in line) for word in ("partial_collect_set", "hashpartitioning(l_orderkey"))
    assert sets < shuffle and plan.count("hashpartitioning(l_orderkey") == 1
