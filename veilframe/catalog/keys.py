"""Sequential pseudonyms, dictionaries and the rule-based jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.catalog.registry import query
from veilframe.catalog.visits import COLUMNS, VISITS_SQL, loaded_visits, visits
from veilframe.operators.columns import drop_identifiers, first_rows, generalize_years
from veilframe.operators.dictionary import (
    NAMESPACES, SCHEMA, alternate_namespaces, append_entries, apply_dictionary, build_dictionary,
    export_dictionary, load_dictionary, new_entries,
)
from veilframe.operators.ledger import Ledger
from veilframe.operators.report import append_audit, load_audit, mapping_summary, run_audit, summary_report
from veilframe.plans.rules import deidentify_incremental, deidentify_rules
from veilframe.session import new_path, written
from veilframe.sources.tables import write_json

# ---- SQL parts -----------------------------------------------------------------------

KEY_COLUMNS = [
    (name, place, column) for name, spec in NAMESPACES.items() for place, column in enumerate(spec.columns)
]


def _key_sql(column: str) -> str:
    if column == "REASONCODE":
        return f'CAST(CAST("{column}" AS BIGINT) AS VARCHAR)'
    return f'"{column}"'


def keys_sql(source: str, names=None) -> str:
    """All keys of the source with namespace, column place and row."""
    parts = [
        f"SELECT '{n}' AS namespace, {p} AS place, order_key, {_key_sql(c)} AS original FROM {source}"
        for n, p, c in KEY_COLUMNS if names is None or n in names
    ]
    return " UNION ALL ".join(parts)


LABEL_SQL = """CASE namespace
    WHEN 'encounters' THEN printf('EN%05d', seq)
    WHEN 'patients' THEN printf('Patient_%04d', seq)
    WHEN 'organizations' THEN printf('Org_%03d', seq)
    WHEN 'payers' THEN printf('Payer_%04d', seq)
    WHEN 'id_payers' THEN printf('Payer_%04d', seq)
    WHEN 'reason_codes' THEN printf('RC_%04d', seq) END"""


def dictionary_sql(source: str, names=None, skip: str = "original <> 'Unknown'") -> str:
    """CTEs `seen` and `dict` after a WITH clause that defines `source`."""
    return f""", seen AS (
  SELECT namespace, original, min(place * 1000000000000 + order_key) AS first_row
  FROM ({keys_sql(source, names)}) WHERE original IS NOT NULL AND original <> '' AND {skip}
  GROUP BY ALL
), numbered AS (
  SELECT namespace, original, first_row,
         row_number() OVER (PARTITION BY namespace ORDER BY first_row, original) AS seq FROM seen
), dict AS (
  SELECT namespace, original, seq, {LABEL_SQL} AS pseudonym FROM numbered
)"""


def lookup_sql(name: str, column: str, alias: str) -> str:
    return (f"LEFT JOIN dict AS {alias} ON {alias}.namespace = '{name}' "
            f"AND {alias}.original = {_key_sql(column)}")


# ---- one namespace at a time ---------------------------------------------------------

SINGLE = {
    "pseudonymize_encounters": "encounters",
    "pseudonymize_organizations": "organizations",
    "pseudonymize_patients": "patients",
    "pseudonymize_payers": "payers",
    "pseudonymize_id_payers": "id_payers",
    "pseudonymize_reason_codes": "reason_codes",
}


def _register_single(query_name: str, name: str) -> None:
    spec = NAMESPACES[name]
    joins = " ".join(lookup_sql(name, c, f"d{i}") for i, c in enumerate(spec.columns))
    outs = ", ".join(f'd{i}.pseudonym AS "{c}"' for i, c in enumerate(spec.columns))
    sql = f"{VISITS_SQL}{dictionary_sql('visits', [name])} SELECT order_key, {outs} FROM visits {joins}"

    @query(query_name, sql)
    def run(spark, sf_dir):
        df = loaded_visits(spark, sf_dir, ["order_key", *spec.columns])
        return apply_dictionary(df, build_dictionary(df, "order_key", {name: spec}), {name: spec})


for _query_name, _name in SINGLE.items():
    _register_single(_query_name, _name)


# Two halves of the visits: the first feeds one id column, the second the other, so that
# some keys are met only in the second column.
TWO_ID_COLUMNS_SQL = f"""{VISITS_SQL}, ids AS (
  SELECT order_key, CASE WHEN order_key % 2 = 0 THEN "PATIENT" END AS "PATIENT", "Id_patient" FROM visits
), seen AS (
  SELECT original, min(place * 1000000000000 + order_key) AS first_row FROM (
    SELECT 0 AS place, order_key, "PATIENT" AS original FROM ids
    UNION ALL SELECT 1, order_key, "Id_patient" FROM ids)
  WHERE original IS NOT NULL GROUP BY original
), dict AS (
  SELECT original, row_number() OVER (ORDER BY first_row, original) AS seq,
         CASE WHEN first_row < 1000000000000 THEN 'Patient_' ELSE 'IDP_' END AS prefix FROM seen
)
SELECT order_key, a.prefix || printf('%04d', a.seq) AS "PATIENT", b.prefix || printf('%04d', b.seq) AS "Id_patient"
FROM ids LEFT JOIN dict a ON a.original = "PATIENT" LEFT JOIN dict b ON b.original = "Id_patient"
"""


@query("pseudonymize_id_patient", TWO_ID_COLUMNS_SQL)
def pseudonymize_id_patient(spark, sf_dir):
    df = loaded_visits(spark, sf_dir, ["order_key", "PATIENT", "Id_patient"])
    df = df.withColumn("PATIENT", F.when(F.col("order_key") % 2 == 0, F.col("PATIENT")))
    spec = {"patients": alternate_namespaces()["patients"]}
    return apply_dictionary(df, build_dictionary(df, "order_key", spec), spec)


# ---- dictionaries --------------------------------------------------------------------

KEYS = ["order_key", "Id_encounter", "PATIENT", "Id_patient", "ORGANIZATION", "PAYER", "Id_payer", "REASONCODE"]
DICT_SQL = f"{VISITS_SQL}{dictionary_sql('visits')} SELECT namespace, original, seq, pseudonym FROM dict"


@query("dict_build", DICT_SQL)
def dict_build(spark, sf_dir):
    return build_dictionary(visits(spark, sf_dir, KEYS), "order_key")


LOOKED_UP = ["Id_encounter", "PATIENT", "Id_patient", "ORGANIZATION", "PAYER"]


@query("pseudonymize_shuffled", f"""{VISITS_SQL}, holed AS (
  SELECT * REPLACE (CASE WHEN order_key % 2 = 0 THEN 'Unknown' ELSE "PATIENT" END AS "PATIENT") FROM visits
)""" + dictionary_sql("holed") + " SELECT v.order_key, " + ", ".join(
    f"""CASE WHEN v."{c}" = 'Unknown' THEN 'Unknown' ELSE d{i}.pseudonym END AS "{c}" """ for i, c in enumerate(LOOKED_UP)
) + " FROM holed AS v " + " ".join(
    f"""LEFT JOIN dict AS d{i} ON d{i}.namespace = '{n}' AND d{i}.original = v."{c}" """
    for i, (n, c) in enumerate(zip(("encounters", "patients", "patients", "organizations", "payers"), LOOKED_UP))))
def pseudonymize_shuffled(spark, sf_dir):
    """Every namespace is looked up by a shuffle, and half the rows hold the placeholder."""
    df = loaded_visits(spark, sf_dir, KEYS)
    df = df.withColumn("PATIENT", F.when(F.col("order_key") % 2 == 0, "Unknown").otherwise(F.col("PATIENT")))
    done = apply_dictionary(df, build_dictionary(df, "order_key"), row_key="order_key", sent_bytes=0)
    return done.select("order_key", *LOOKED_UP)


# Older orders first, then the rest: numbers go on where the first batch stopped.
BATCHES_SQL = f"""{VISITS_SQL}, batches AS (
  SELECT *, CASE WHEN "START" < '1998' THEN 0 ELSE 1 END AS batch FROM visits
), seen AS (
  SELECT namespace, original, min(batch * 1000000000000000 + place * 1000000000000 + order_key) AS first_row
  FROM ({keys_sql('batches').replace('order_key,', 'order_key, batch,')})
  WHERE original IS NOT NULL AND original <> '' GROUP BY ALL
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY namespace ORDER BY first_row, original) AS seq FROM seen
), dict AS (SELECT *, {LABEL_SQL} AS pseudonym FROM numbered)
"""


def _two_batches(spark, sf_dir, columns):
    df = loaded_visits(spark, sf_dir, columns)
    return df.where(F.col("START") < "1998"), df.where(~(F.col("START") < "1998"))


@query("dict_incremental", BATCHES_SQL + "SELECT namespace, original, seq, pseudonym FROM dict")
def dict_incremental(spark, sf_dir):
    older, newer = _two_batches(spark, sf_dir, [*KEYS, "START"])
    folder = new_path(spark, "saved")
    append_entries(new_entries(older, "order_key"), folder)
    append_entries(new_entries(newer, "order_key", known=load_dictionary(spark, folder)), folder)
    return load_dictionary(spark, folder)


def _ten_batches(spark, sf_dir, columns):
    """The visits in ten batches by their order, stored by batch, so that a batch is read alone."""
    last = visits(spark, sf_dir, ["order_key"]).agg(F.max("order_key")).first()[0]
    batch = F.expr(f"order_key * 10 div {last + 1}").alias("_batch")
    stored = written(visits(spark, sf_dir, columns).select("*", batch), "visits", by="_batch")
    return [stored.where(F.col("_batch") == i).drop("_batch") for i in range(10)]


@query("dict_ledger", DICT_SQL)
def dict_ledger(spark, sf_dir):
    """Ten batches, each reading the buckets of its keys, against one numbering of the whole."""
    ledger = Ledger(spark, new_path(spark, "ledger"), bucket_rows=2_000)
    for batch in _ten_batches(spark, sf_dir, KEYS):
        ledger.extend(batch, "order_key")
    return ledger.entries()


@query("dict_export", DICT_SQL)
def dict_export(spark, sf_dir):
    path = new_path(spark, "export")
    export_dictionary(build_dictionary(visits(spark, sf_dir, KEYS), "order_key"), path)
    return spark.read.schema(SCHEMA).json(path)


@query("mapping_summary", f"""{VISITS_SQL}{dictionary_sql('visits')}
SELECT coalesce(namespace, 'total_mappings') AS namespace, count(*) AS entries
FROM dict GROUP BY ROLLUP (namespace)""")
def mappings(spark, sf_dir):
    return mapping_summary(build_dictionary(visits(spark, sf_dir, KEYS), "order_key"))


# ---- columns -------------------------------------------------------------------------

DROPPED = ["SSN", "FIRST", "LAST", "ADDRESS"]


@query("drop_identifiers", f"""{VISITS_SQL}
SELECT * EXCLUDE ("SSN", "FIRST", "LAST", "ADDRESS") FROM visits""")
def dropped(spark, sf_dir):
    return drop_identifiers(visits(spark, sf_dir))


YEAR_SQL = "TRY_CAST(nullif(regexp_extract({0}, '([0-9]{{4}})', 1), '') AS INTEGER) AS {1}"
YEARS_SQL = ", ".join(YEAR_SQL.format(a, b) for a, b in [
    ('"START"', "start_year"), ('"STOP"', "stop_year"), ('"BIRTHDATE"', "birth_year"),
    ("condition_dates", "condition_year")])


@query("generalize_year", f"{VISITS_SQL} SELECT order_key, {YEARS_SQL} FROM visits")
def years(spark, sf_dir):
    return generalize_years(
        visits(spark, sf_dir, ["order_key", "START", "STOP", "BIRTHDATE", "condition_dates"])
    )


@query("first_n", f'{VISITS_SQL} SELECT order_key, "Id_encounter", "CITY" FROM visits ORDER BY order_key LIMIT 1000')
def first_n(spark, sf_dir):
    return first_rows(visits(spark, sf_dir, ["order_key", "Id_encounter", "CITY"]), "order_key", 1000)


@query("first_n_ties", f"""{VISITS_SQL}, tied AS (
  SELECT CASE WHEN order_key % 9 <> 0 THEN CAST(order_key // 4 AS VARCHAR) END AS k, "CITY" FROM visits)
SELECT k, count(*) AS n FROM (SELECT k FROM tied ORDER BY k NULLS FIRST LIMIT 12000) GROUP BY k
UNION ALL SELECT 'of five: ' || coalesce(k, 'none'), count(*) FROM (SELECT k FROM tied ORDER BY k NULLS FIRST LIMIT 5) GROUP BY k""")
def first_n_ties(spark, sf_dir):
    """Five and twelve thousand rows by a key with nulls and ties."""
    df = visits(spark, sf_dir, ["order_key", "CITY"]).select(
        F.when(F.col("order_key") % 9 != 0, F.expr("order_key div 4").cast("string")).alias("k"), "CITY")
    five, many = (first_rows(df, "k", n).groupBy("k").agg(F.count(F.lit(1)).alias("n")) for n in (5, 12_000))
    return many.unionByName(five.withColumn("k", F.concat(F.lit("of five: "), F.coalesce("k", F.lit("none")))))


# ---- jobs ----------------------------------------------------------------------------

NUMBERS = ["CODE", "BASE_ENCOUNTER_COST", "TOTAL_CLAIM_COST", "total_medication_cost"]


def _filled_sql(numbers):
    texts = ["Id_encounter", "PATIENT", "Id_patient", "ORGANIZATION", "PAYER", "Id_payer", "START", "STOP",
             "BIRTHDATE", "condition_dates", "MARITAL", "CITY", "STATE", "ENCOUNTERCLASS"]
    filled = [f"coalesce(\"{c}\", 'Unknown') AS \"{c}\"" for c in texts]
    filled += [f'coalesce(CAST("{c}" AS DOUBLE), (SELECT median("{c}") FROM visits)) AS "{c}"' for c in numbers]
    return ", ".join(filled)


KEPT_SQL = ", ".join(f'v."{c}"' for c in ["MARITAL", "CITY", "STATE", "ENCOUNTERCLASS", *NUMBERS])
LOOKUPS = [("encounters", "Id_encounter"), ("patients", "PATIENT"), ("patients", "Id_patient"),
           ("organizations", "ORGANIZATION"), ("payers", "PAYER"), ("id_payers", "Id_payer")]
LOOKUP_JOINS = " ".join(
    f"LEFT JOIN dict AS d{i} ON d{i}.namespace = '{n}' AND d{i}.original = v.\"{c}\""
    for i, (n, c) in enumerate(LOOKUPS))


def _replaced(placeholder: bool) -> str:
    if placeholder:
        return ", ".join(
            f"CASE WHEN v.\"{c}\" = 'Unknown' THEN 'Unknown' ELSE d{i}.pseudonym END AS \"{c}\""
            for i, (n, c) in enumerate(LOOKUPS))
    return ", ".join(f'd{i}.pseudonym AS "{c}"' for i, (n, c) in enumerate(LOOKUPS))


RULES_SQL = f"""{VISITS_SQL}, filled AS (
  SELECT order_key, {_filled_sql(NUMBERS)},
         coalesce(CAST(CAST("REASONCODE" AS BIGINT) AS VARCHAR), 'Unknown') AS reason FROM visits
){dictionary_sql('(SELECT * REPLACE (TRY_CAST(reason AS BIGINT) AS reason), TRY_CAST(reason AS BIGINT) AS "REASONCODE" FROM filled)')}
SELECT v.order_key, {_replaced(True)},
       CASE WHEN v.reason = 'Unknown' THEN 'Unknown' ELSE r.pseudonym END AS "REASONCODE",
       {KEPT_SQL}, {YEARS_SQL}
FROM filled AS v {LOOKUP_JOINS}
LEFT JOIN dict AS r ON r.namespace = 'reason_codes' AND r.original = v.reason"""


@query("deidentify_rules", RULES_SQL)
def rules(spark, sf_dir):
    return deidentify_rules(loaded_visits(spark, sf_dir), "order_key", row_key="order_key").output


YEARS_AS_TEXT_SQL = ", ".join(
    f"coalesce(nullif(regexp_extract({a}, '([0-9]{{4}})', 1), ''), {a}) AS {b}" for a, b in [
        ('"START"', "start_year"), ('"STOP"', "stop_year"), ('"BIRTHDATE"', "birth_year"),
        ("condition_dates", "condition_year")])

RULES_AS_PUBLISHED_SQL = f"""{VISITS_SQL}, filled AS (
  SELECT order_key, {_filled_sql([*NUMBERS, "REASONCODE"])} FROM visits
){dictionary_sql('filled', skip='true').replace('CAST(CAST("REASONCODE" AS BIGINT) AS VARCHAR)', 'CAST("REASONCODE" AS VARCHAR)')}
SELECT v.order_key, {_replaced(False)}, r.pseudonym AS "REASONCODE", {KEPT_SQL}, {YEARS_AS_TEXT_SQL}
FROM filled AS v {LOOKUP_JOINS}
LEFT JOIN dict AS r ON r.namespace = 'reason_codes' AND r.original = CAST(v."REASONCODE" AS VARCHAR)"""


@query("deidentify_rules_as_published", RULES_AS_PUBLISHED_SQL)
def rules_as_published(spark, sf_dir):
    df = loaded_visits(spark, sf_dir, row_id="_row")
    return deidentify_rules(df, "order_key", as_published=True, row_key="_row").output.drop("_row")


@query("deidentify_incremental", BATCHES_SQL.replace(
    "CASE namespace", "CASE WHEN namespace = 'patients' AND first_row % 1000000000000000 >= 1000000000000 "
    "THEN printf('IDP_%04d', seq) ELSE CASE namespace").replace(
    "printf('RC_%04d', seq) END", "printf('RC_%04d', seq) END END") + f"""
SELECT v.order_key, d0.pseudonym AS "Id_encounter", d1.pseudonym AS "PATIENT", d2.pseudonym AS "Id_patient",
       d3.pseudonym AS "ORGANIZATION", d4.pseudonym AS "PAYER", v."Id_payer", r.pseudonym AS "REASONCODE",
       {KEPT_SQL}, {YEARS_SQL}
FROM visits AS v {LOOKUP_JOINS}
LEFT JOIN dict AS r ON r.namespace = 'reason_codes' AND r.original = CAST(CAST(v."REASONCODE" AS BIGINT) AS VARCHAR)""")
def incremental(spark, sf_dir):
    older, newer = _two_batches(spark, sf_dir, COLUMNS)
    first = deidentify_incremental(older, "order_key", None, row_key="order_key")
    second = deidentify_incremental(newer, "order_key", first.dictionary, row_key="order_key")
    return first.output.unionByName(second.output)


@query("deidentify_ledger", f"""{VISITS_SQL}{dictionary_sql('visits', list(alternate_namespaces()))}
SELECT v.order_key, {", ".join(f'd{i}.pseudonym AS "{c}"' for i, (n, c) in enumerate(LOOKUPS[:5]))},
       r.pseudonym AS "REASONCODE", {YEARS_SQL}
FROM visits AS v {LOOKUP_JOINS}
LEFT JOIN dict AS r ON r.namespace = 'reason_codes' AND r.original = CAST(CAST(v."REASONCODE" AS BIGINT) AS VARCHAR)""")
def ledger_job(spark, sf_dir):
    """The job over ten batches, each under the ledger that the ones before it left."""
    columns = ["order_key", "Id_encounter", "PATIENT", "Id_patient", "ORGANIZATION", "PAYER", "REASONCODE",
               "START", "STOP", "BIRTHDATE", "condition_dates"]
    ledger = Ledger(spark, new_path(spark, "ledger"))
    done = [deidentify_incremental(batch, "order_key", ledger).output for batch in _ten_batches(spark, sf_dir, columns)]
    return reduce(DataFrame.unionByName, done)


@query("summary_report", f"""{VISITS_SQL}{dictionary_sql('visits')}
SELECT (SELECT count(*) FROM visits) AS total_records, CAST(20 AS BIGINT) AS total_columns,
       (SELECT count(*) FROM dict WHERE namespace = 'encounters') AS encounters,
       (SELECT count(*) FROM dict WHERE namespace = 'patients') AS patients,
       (SELECT count(*) FROM dict WHERE namespace = 'organizations') AS organizations,
       (SELECT count(*) FROM dict WHERE namespace = 'payers') AS payers,
       (SELECT count(*) FROM dict WHERE namespace = 'id_payers') AS id_payers,
       (SELECT count(*) FROM dict WHERE namespace = 'reason_codes') AS reason_codes,
       4 AS columns_removed, 4 AS date_columns_generalized,
       'Column Deletion, Encounter ID Pseudonymization, Date Generalization, Organization Grouping, '
       || 'Patient Pseudonymization, Payer Mapping, Id_payer Mapping, Reason Code Mapping' AS methods""")
def summary(spark, sf_dir):
    done = deidentify_rules(loaded_visits(spark, sf_dir, row_id="_row"), "order_key", row_key="_row")
    output = written(done.output.drop("_row"), "output")  # the result is made once, then reported on
    report = summary_report(output, done.dictionary, done.removed, done.generalized)
    return report.select(
        "total_records", "total_columns", "mappings_generated.*", "columns_removed",
        "date_columns_generalized", F.array_join("anonymization_methods_applied", ", ").alias("methods"),
    )


@query("summary_json_sink", """SELECT count(*) AS total_records, CAST(20 AS BIGINT) AS total_columns,
  CAST(4 AS BIGINT) AS columns_removed FROM orders""")
def summary_json_sink(spark, sf_dir):
    """The summary through its JSON file."""
    done = deidentify_rules(loaded_visits(spark, sf_dir), "order_key", fill=False)
    path = new_path(spark, "summary")
    write_json(summary_report(done.output, done.dictionary, done.removed, done.generalized), path)
    return spark.read.json(path).select("total_records", "total_columns", "columns_removed")


@query("run_audit", """SELECT 'visits' AS input, 'rules' AS job, '1' AS policy_version,
  (SELECT count(*) FROM orders) AS rows_in, (SELECT count(*) FROM orders) AS rows_out""")
def audit(spark, sf_dir):
    df = loaded_visits(spark, sf_dir, row_id="_row")
    done = deidentify_rules(df, "order_key", fill=False, row_key="_row")
    rows_in = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return run_audit(rows_in, written(done.output.drop("_row"), "output"), {"input": "visits", "job": "rules", "policy_version": "1"})


@query("run_audit_log", """SELECT 'visits' AS input, batch AS job, '42' AS seed, CAST(finished AS TIMESTAMP) AS finished,
  count(*) AS rows_in, count(*) AS rows_out FROM (
    SELECT CASE WHEN o_orderdate < DATE '1998-01-01' THEN 'older' ELSE 'newer' END AS batch,
           CASE WHEN o_orderdate < DATE '1998-01-01' THEN '2024-01-01 10:00:00' ELSE '2024-01-02 10:00:00' END AS finished FROM orders)
  GROUP BY ALL""")
def audit_log(spark, sf_dir):
    """Two runs appended to one log, each with its seed and time."""
    folder = new_path(spark, "audit")
    for job, batch, day in zip(("older", "newer"), _two_batches(spark, sf_dir, ["order_key", "START", "PATIENT"]), ("01", "02")):
        done = deidentify_incremental(batch, "order_key", None)
        rows_in = batch.agg(F.count(F.lit(1)).alias("n")).scalar()
        finished = F.lit(f"2024-01-{day} 10:00:00").cast("timestamp_ntz")
        append_audit(run_audit(rows_in, done.output, {"input": "visits", "job": job}, seed="42", finished=finished), folder)
    return load_audit(spark, folder)
