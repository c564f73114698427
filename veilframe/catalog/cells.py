"""Scan, fill, profile, roles, hashes and dates."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from veilframe import fixed_values as fixed
from veilframe.catalog.keys import NUMBERS
from veilframe.catalog.registry import query
from veilframe.catalog.visits import COLUMNS, VISITS_SQL, loaded_visits, table, visits
from veilframe.functions import dates, hashing
from veilframe.operators import impute, profile
from veilframe.operators.columns import add_age_range, condition_target_split, hash_identifiers
from veilframe.operators.column_state import append_state, column_state, load_state, state_report
from veilframe.operators.date_formats import format_votes, merged_votes, read_dates, settled_formats
from veilframe.operators.dictionary import Namespace, apply_dictionary, random_entries
from veilframe.plans.policy import (
    column_types, load_roles, policy_rows, policy_table, resolve_roles, role_by_name, route_direct,
)
from veilframe.session import local_table, new_path, written
from veilframe.sources.tables import row_count, scan_csv, write_csv, write_json

TYPES = {
    "order_key": "bigint", "REASONCODE": "double", "CODE": "bigint", "BASE_ENCOUNTER_COST": "double",
    "TOTAL_CLAIM_COST": "double", "total_medication_cost": "double",
}
TEXTS = [c for c in COLUMNS if c not in TYPES]

# ---- scan ----------------------------------------------------------------------------


@query("scan_normalize", f"{VISITS_SQL} SELECT * FROM visits")
def scan_normalize(spark, sf_dir):
    """Missing cells are written under several of their names, then read back as null."""
    df = visits(spark, sf_dir)
    tokens = F.array(*[F.lit(t) for t in fixed.MISSING_TOKENS if t])
    token = tokens[(F.col("order_key") % F.size(tokens)).cast("int")]
    path = new_path(spark, "scan")
    write_csv(df.select(*[F.coalesce(F.col(c).cast("string"), token).alias(c) for c in df.columns]), path)
    return scan_csv(spark, path, infer=True, types={"REASONCODE": "double"})


UNSAFE_SQL = """SELECT o_orderkey AS order_key, CAST(9000000000000000000 + o_orderkey AS VARCHAR) AS short_id,
  '1' || CAST(9000000000000000000 + o_orderkey AS VARCHAR) AS long_id,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority || chr(10) || o_orderstatus || chr(13) || chr(10) || '\\n'
       WHEN o_orderkey % 3 = 1 THEN '"' || o_orderpriority || '", ' || chr(92) || o_orderstatus END AS note FROM orders"""


def _unsafe(spark, sf_dir):
    """Ids of 19 and 20 digits, and notes with line breaks, quotes and backslashes."""
    number = (F.lit(9000000000000000000) + F.col("o_orderkey")).cast("string")
    broken = F.concat("o_orderpriority", F.lit("\n"), "o_orderstatus", F.lit("\r\n\\n"))
    quoted = F.concat(F.lit('"'), "o_orderpriority", F.lit('", \\'), "o_orderstatus")
    note = F.when(F.col("o_orderkey") % 3 == 0, broken).when(F.col("o_orderkey") % 3 == 1, quoted)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), number.alias("short_id"), F.concat(F.lit("1"), number).alias("long_id"), note.alias("note"))


def _as_read(df):
    """19 digits fit a bigint and 20 do not, so the ids come back as a number and as text."""
    return df.select("order_key", F.col("short_id").cast("string").alias("short_id"), "long_id", "note")


@query("scan_long_ids_and_breaks", UNSAFE_SQL)
def scan_long_ids_and_breaks(spark, sf_dir):
    path = new_path(spark, "scan")
    write_csv(_unsafe(spark, sf_dir), path, line_breaks="quoted")
    return _as_read(scan_csv(spark, path, infer=True, line_breaks="quoted"))


@query("scan_breaks_in_parallel", UNSAFE_SQL)
def scan_breaks_in_parallel(spark, sf_dir):
    """One file, read line by line by as many tasks as it has blocks."""
    path = new_path(spark, "scan")
    write_csv(_unsafe(spark, sf_dir).coalesce(1), path, line_breaks="quoted")
    return _as_read(scan_csv(spark, path, infer=True, line_breaks="parallel"))


@query("scan_escaped_breaks", UNSAFE_SQL)
def scan_escaped_breaks(spark, sf_dir):
    path = new_path(spark, "scan")
    write_csv(_unsafe(spark, sf_dir), path, line_breaks="escape")
    return _as_read(scan_csv(spark, path, infer=True, line_breaks="escaped"))


@query("written_rows", "SELECT count(*) AS rows_written, count(*) AS rows_escaped FROM orders")
def written_rows(spark, sf_dir):
    df, quoted, escaped = _unsafe(spark, sf_dir), new_path(spark, "scan"), new_path(spark, "scan")
    write_csv(df, quoted, line_breaks="quoted")
    write_csv(df, escaped, line_breaks="escape")
    rows = (row_count(spark, quoted, "quoted"), row_count(spark, escaped))
    return local_table(spark, [rows], "rows_written bigint, rows_escaped bigint")


# ---- fill ----------------------------------------------------------------------------

FILLED_TEXT = ["ORGANIZATION", "STOP", "condition_dates", "MARITAL"]


@query("impute_constant", f"""{VISITS_SQL} SELECT order_key,
  {", ".join(f"coalesce({c!r}, 'Unknown') AS {c}".replace("'" + c + "'", '"' + c + '"') for c in FILLED_TEXT)}
  FROM visits""")
def impute_constant(spark, sf_dir):
    return impute.fill_text(visits(spark, sf_dir, ["order_key", *FILLED_TEXT]))


MEDIANS = ["CODE", "TOTAL_CLAIM_COST", "REASONCODE", "total_medication_cost", "BASE_ENCOUNTER_COST"]


@query("impute_median", f"""{VISITS_SQL} SELECT order_key,
  {", ".join(f'coalesce(CAST("{c}" AS DOUBLE), (SELECT median("{c}") FROM visits)) AS "{c}"' for c in MEDIANS)}
  FROM visits""")
def impute_median(spark, sf_dir):
    df = loaded_visits(spark, sf_dir, ["order_key", *MEDIANS])
    return impute.fill_numbers(df, MEDIANS, impute.exact_medians(df, MEDIANS))


SPARSE = {"rare": 401, "rarer": 1009, "even_rarer": 4001}


@query("impute_median_sparse", f"""{VISITS_SQL}, thin AS (
  SELECT order_key, {", ".join(f'CASE WHEN order_key % {m} = 0 THEN "BASE_ENCOUNTER_COST" END AS {c}' for c, m in SPARSE.items())}
  FROM visits)
SELECT order_key, {", ".join(f'coalesce({c}, (SELECT median({c}) FROM thin)) AS {c}' for c in SPARSE)} FROM thin""")
def impute_median_sparse(spark, sf_dir):
    """Columns that are mostly null: each is bracketed by its own values."""
    df = loaded_visits(spark, sf_dir, ["order_key", "BASE_ENCOUNTER_COST"]).select(
        "order_key", *[F.when(F.col("order_key") % m == 0, F.col("BASE_ENCOUNTER_COST")).alias(c) for c, m in SPARSE.items()])
    return impute.fill_numbers(df, list(SPARSE), impute.exact_medians(df, list(SPARSE)))


def _nulls(columns):
    return " + ".join(f'count(*) FILTER ("{c}" IS NULL)' for c in columns)


@query("impute_delta", f"""{VISITS_SQL}
SELECT {_nulls(COLUMNS)} AS missing_before, CAST(0 AS BIGINT) AS missing_after,
       {_nulls(COLUMNS)} AS filled FROM visits""")
def impute_delta(spark, sf_dir):
    df = loaded_visits(spark, sf_dir)
    numbers = [*NUMBERS, "REASONCODE"]
    filled = impute.fill_numbers(impute.fill_text(df), numbers, impute.exact_medians(df, numbers))
    return impute.missing_delta(df, filled)


# ---- profile and roles ---------------------------------------------------------------

DTYPES = {c: TYPES.get(c, "string") for c in COLUMNS}
DIRECT_PATTERN = "(^|_)(" + "|".join(fixed.DIRECT_WORDS) + ")(_|$)"
QUASI_PATTERN = "(^|_)(" + "|".join(fixed.QUASI_WORDS) + ")(_|$)"


def _category(direct: str, quasi: str) -> str:
    return (f"CASE WHEN regexp_matches(upper(\"column\"), '{direct}') THEN 'direct_identifier' "
            f"WHEN regexp_matches(upper(\"column\"), '{quasi}') THEN 'quasi_identifier' "
            "ELSE 'clinical_data' END")


def _per_column(measures: str, columns=COLUMNS) -> str:
    """One row per column; {c} in the measures is the column."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{DTYPES[c]}' AS dtype, "
        + measures.replace("{c}", f'"{c}"') + " FROM visits" for c in columns)


@query("profile_columns", VISITS_SQL + _per_column(
    " count(*) AS total_records, count(*) FILTER ({c} IS NULL) AS missing_values"))
def profile_columns(spark, sf_dir):
    return profile.profile_columns(visits(spark, sf_dir))


@query("metadata_json_sink", VISITS_SQL + _per_column(
    " count(*) AS total_records, count(*) FILTER ({c} IS NULL) AS missing_values"))
def metadata_json_sink(spark, sf_dir):
    """The profile through its JSON file."""
    path = new_path(spark, "profile")
    write_json(profile.profile_columns(visits(spark, sf_dir)), path)
    return spark.read.json(path)


@query("feature_metadata", f"""{VISITS_SQL}, counted AS (
{_per_column(" count(DISTINCT {c}) AS unique_values, count(*) FILTER ({c} IS NULL) AS missing_values")})
SELECT "column", {_category(DIRECT_PATTERN, QUASI_PATTERN)} AS category, dtype, unique_values, missing_values
FROM counted""")
def feature_metadata(spark, sf_dir):
    return profile.feature_metadata(loaded_visits(spark, sf_dir))


@query("classify_columns", f"""{VISITS_SQL}, counted AS ({_per_column(" count({c}) AS cells")})
SELECT "column", {_category(DIRECT_PATTERN, QUASI_PATTERN)} AS whole_words,
       {_category('(' + '|'.join(fixed.DIRECT_WORDS) + ')', '(' + '|'.join(fixed.QUASI_WORDS) + ')')} AS any_part,
       cells FROM counted""")
def classify_columns(spark, sf_dir):
    df = visits(spark, sf_dir)
    cells = profile.one_row_per_column(df, df.columns, {"cells": F.count})
    return cells.select(
        "column", role_by_name(F.col("column")).alias("whole_words"),
        role_by_name(F.col("column"), "substring").alias("any_part"), "cells",
    )


IDENTIFIED = {
    "direct_identifiers": ["SSN", "FIRST", "LAST", "ADDRESS"],
    "quasi_identifiers": ["BIRTHDATE", "CITY", "STATE", "ORGANIZATION", "PATIENT"],
    "sensitive_attributes": ["REASONCODE", "PAYER"],
    "date_columns": ["START", "STOP", "BIRTHDATE"],
    "id_columns": ["Id_encounter", "Id_patient", "Id_payer"],
    "categorical_columns": [c for c in TEXTS if c not in ("SSN", "FIRST", "LAST", "ADDRESS")],
    "numerical_columns": list(TYPES),
}


@query("identify_roles", f"""{VISITS_SQL}, counted AS ({_per_column(" count({c}) AS cells")})
SELECT kind, count(*) AS columns, CAST(sum(cells) AS BIGINT) AS cells FROM counted JOIN (VALUES
{", ".join(f"('{k}', '{c}')" for k, cs in IDENTIFIED.items() for c in cs)}) AS r(kind, c) ON c = "column"
GROUP BY kind""")
def identify_roles(spark, sf_dir):
    df = visits(spark, sf_dir)
    kinds = [(k, c) for k, columns in column_types(df).items() for c in columns]
    roles = local_table(spark, kinds, "kind string, column string")
    cells = profile.one_row_per_column(df, df.columns, {"cells": F.count})
    return roles.join(cells, "column").groupBy("kind").agg(
        F.count(F.lit(1)).alias("columns"), F.sum("cells").alias("cells")
    )


OVERRIDE = {"quasi_identifiers": ["BIRTHDATE", "MARITAL", "CITY", "STATE", "ENCOUNTERCLASS", "ABSENT"]}
RESOLVED = [
    ("order_key", "unlisted", "drop"), ("Id_encounter", "direct_identifier", "id"),
    ("PATIENT", "direct_identifier", "drop"), ("Id_patient", "direct_identifier", "id"),
    ("ORGANIZATION", "clinical_data", "keep"), ("PAYER", "clinical_data", "keep"),
    ("Id_payer", "direct_identifier", "id"), ("REASONCODE", "clinical_data", "keep"),
    ("START", "clinical_data", "year"), ("STOP", "clinical_data", "year"),
    ("BIRTHDATE", "quasi_identifier", "synthesise"), ("condition_dates", "clinical_data", "year"),
    ("FIRST", "direct_identifier", "name"), ("LAST", "direct_identifier", "name"),
    ("SSN", "direct_identifier", "ssn"), ("ADDRESS", "direct_identifier", "address"),
    ("MARITAL", "quasi_identifier", "synthesise"), ("CITY", "quasi_identifier", "synthesise"),
    ("STATE", "quasi_identifier", "synthesise"), ("ENCOUNTERCLASS", "quasi_identifier", "synthesise"),
    ("CODE", "clinical_data", "keep"), ("BASE_ENCOUNTER_COST", "clinical_data", "keep"),
    ("TOTAL_CLAIM_COST", "clinical_data", "keep"), ("total_medication_cost", "clinical_data", "keep"),
]


@query("policy_resolve", f"""{VISITS_SQL}, counted AS ({_per_column(" count({c}) AS cells")})
SELECT "column", role, treatment, cells FROM counted JOIN (VALUES
{", ".join(str(r) for r in RESOLVED)}) AS r(c, role, treatment) ON c = "column" """)
def policy_resolve(spark, sf_dir):
    df = visits(spark, sf_dir)
    roles = resolve_roles(df, fixed.DEFAULT_ROLES, OVERRIDE)
    cells = profile.one_row_per_column(df, df.columns, {"cells": F.count})
    return policy_table(spark, policy_rows(df, roles)).join(cells, "column")


@query("role_file_resolve", f"""{VISITS_SQL}, counted AS ({_per_column(" count({c}) AS cells")})
SELECT "column", role, treatment, cells FROM counted JOIN (VALUES
{", ".join(str(r) for r in RESOLVED)}) AS r(c, role, treatment) ON c = "column" """)
def role_file_resolve(spark, sf_dir):
    """The roles through a JSON file in the shared folder."""
    df, path = visits(spark, sf_dir), new_path(spark, "roles")
    lists = json.dumps({**fixed.DEFAULT_ROLES, **OVERRIDE, "comment": "no role"}, indent=2)
    local_table(spark, [(lists,)], "value string").coalesce(1).write.text(path)
    cells = profile.one_row_per_column(df, df.columns, {"cells": F.count})
    return policy_table(spark, policy_rows(df, resolve_roles(df, load_roles(spark, path)))).join(cells, "column")


@query("condition_target_split", f"""{VISITS_SQL}
SELECT x.*, y.* EXCLUDE (order_key) FROM
  (SELECT order_key, "CITY", "STATE", "ORGANIZATION", "PATIENT", "MARITAL" FROM visits) AS x JOIN
  (SELECT order_key, "ENCOUNTERCLASS", "CODE", "BASE_ENCOUNTER_COST", "TOTAL_CLAIM_COST", "REASONCODE", "PAYER"
   FROM visits) AS y ON x.order_key = y.order_key""")
def split(spark, sf_dir):
    df = loaded_visits(spark, sf_dir)
    x, y = condition_target_split(df, "order_key", fixed.SAMPLE_CONDITIONS, fixed.SAMPLE_TARGETS)
    return x.join(y, "order_key")


# ---- hashes --------------------------------------------------------------------------


def _uuid_sql(text: str, salt: str) -> str:
    h = f"sha256('{salt}' || {text})"
    parts = [f"substr({h}, {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return " || '-' || ".join(parts)


def _ssn_sql(text: str, parts=((1, 3), (4, 2), (6, 4))) -> str:
    return " || '-' || ".join(f"substr(sha256({text}), {at}, {n})" for at, n in parts)


SALTED_PARTS = ((1, 8), (9, 8), (17, 8))


@query("hash_ssn", f'{VISITS_SQL} SELECT order_key, {_ssn_sql(chr(34) + "SSN" + chr(34))} AS "SSN" FROM visits')
def hash_ssn(spark, sf_dir):
    return visits(spark, sf_dir, ["order_key", "SSN"]).select("order_key", hashing.hash_ssn(F.col("SSN")).alias("SSN"))


@query("hash_name", """SELECT c_custkey, 'Person_' || substr(md5(c_name), 1, 8) AS customer FROM customer
UNION ALL SELECT s_suppkey, 'Person_' || substr(md5(s_name), 1, 8) FROM supplier""")
def hash_name(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("customer"))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return customers.union(suppliers).withColumn("customer", hashing.hash_name(F.col("customer")))


@query("hash_address", f"""{VISITS_SQL}
SELECT order_key, 'Address_' || substr(md5("ADDRESS"), 1, 8) AS "ADDRESS" FROM visits""")
def hash_address(spark, sf_dir):
    df = visits(spark, sf_dir, ["order_key", "ADDRESS"])
    return df.withColumn("ADDRESS", hashing.hash_address(F.col("ADDRESS")))


DIRECT = ["Id_encounter", "PATIENT", "Id_patient", "FIRST", "LAST", "SSN", "ADDRESS", "Id_payer"]


@query("hash_identifiers", f"""{VISITS_SQL}
SELECT order_key, {", ".join(f'{_uuid_sql(chr(34) + c + chr(34), "s1")} AS "{c}"' for c in ("Id_encounter", "Id_patient", "Id_payer"))},
  'Person_' || substr(md5("FIRST"), 1, 8) AS "FIRST", 'Person_' || substr(md5("LAST"), 1, 8) AS "LAST",
  {_ssn_sql('"SSN"')} AS "SSN", 'Address_' || substr(md5("ADDRESS"), 1, 8) AS "ADDRESS" FROM visits""")
def hash_all(spark, sf_dir):
    df = visits(spark, sf_dir, ["order_key", *DIRECT])
    return hash_identifiers(df, route_direct(DIRECT), id_salt="s1")


@query("hash_identifiers_keyed", f"""{VISITS_SQL}
SELECT order_key, 'Person_' || substr(sha256('s1' || "FIRST"), 1, 16) AS "FIRST",
  'Person_' || substr(sha256('s1' || "LAST"), 1, 16) AS "LAST", {_ssn_sql("'s1' || " + '"SSN"', SALTED_PARTS)} AS "SSN",
  'Address_' || substr(sha256('s1' || "ADDRESS"), 1, 16) AS "ADDRESS" FROM visits""")
def hash_all_keyed(spark, sf_dir):
    columns = ["FIRST", "LAST", "SSN", "ADDRESS"]
    return hash_identifiers(visits(spark, sf_dir, ["order_key", *columns]), route_direct(columns), salt="s1")


@query("pseudonymize_uuid", f"""{VISITS_SQL}
SELECT order_key, {", ".join(f'{_uuid_sql(chr(34) + c + chr(34), "s1")} AS "{c}"' for c in ("Id_encounter", "Id_patient", "Id_payer"))}
FROM visits""")
def pseudonymize_uuid(spark, sf_dir):
    columns = ["Id_encounter", "Id_patient", "Id_payer"]
    return hash_identifiers(visits(spark, sf_dir, ["order_key", *columns]), {"id": columns}, id_salt="s1")


ID_COLUMNS = ["Id_encounter", "PATIENT", "Id_payer"]


@query("pseudonymize_uuid_random", VISITS_SQL + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count("{c}") AS cells, count(DISTINCT "{c}") AS originals,
    count(DISTINCT "{c}") AS pseudonyms, CAST(0 AS BIGINT) AS unchanged FROM visits""" for c in ID_COLUMNS))
def pseudonymize_uuid_random(spark, sf_dir):
    """The UUIDs differ from run to run; what must hold is one per key, and no key left."""
    df = loaded_visits(spark, sf_dir, ["order_key", *ID_COLUMNS])
    spec = {"ids": Namespace(tuple(ID_COLUMNS), "", 0)}
    output = apply_dictionary(df, random_entries(df, ID_COLUMNS), spec)
    renamed = output.select("order_key", *[F.col(c).alias(f"new_{c}") for c in ID_COLUMNS])
    both = df.join(renamed, "order_key")
    cells = both.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("old"), F.col(f"new_{c}").alias("new"))
        for c in ID_COLUMNS
    ])).alias("c")).select("c.*").groupBy("column", "old", "new").agg(F.count(F.lit(1)).alias("n"))
    per_key = cells.groupBy("column", "old").agg(
        F.sum("n").alias("n"), F.count("new").alias("news"), F.count_if(F.col("old") == F.col("new")).alias("same"))
    return per_key.groupBy("column").agg(
        F.sum("n").alias("cells"), F.count("old").alias("originals"), F.sum("news").alias("pseudonyms"),
        F.sum("same").alias("unchanged"))


# ---- dates ---------------------------------------------------------------------------


@query("condition_year", f"""{VISITS_SQL}
SELECT order_key, trim(split_part(condition_dates, ';', 1)) AS first_date,
  TRY_CAST(nullif(regexp_extract(split_part(condition_dates, ';', 1), '([0-9]{{4}})', 1), '') AS INTEGER)
    AS condition_year FROM visits""")
def condition_year(spark, sf_dir):
    df = visits(spark, sf_dir, ["order_key", "condition_dates"])
    first = dates.first_in_list(F.col("condition_dates"))
    return df.select("order_key", first.alias("first_date"), dates.year_of(first).alias("condition_year"))


AGE_SQL = """CAST(trunc(date_diff('day', CAST(try_strptime("BIRTHDATE", '%d-%m-%Y') AS DATE), DATE '2023-01-01')
  / 365.25) AS INTEGER)"""
AGE_RANGE_SQL = f"""CASE WHEN "BIRTHDATE" IS NULL THEN 'Unknown' WHEN {AGE_SQL} < 12 THEN '<12'
  WHEN {AGE_SQL} < 18 THEN '12-17' WHEN {AGE_SQL} < 25 THEN '18-24' WHEN {AGE_SQL} < 35 THEN '25-34'
  WHEN {AGE_SQL} < 45 THEN '35-44' WHEN {AGE_SQL} < 55 THEN '45-54' WHEN {AGE_SQL} < 65 THEN '55-64'
  WHEN {AGE_SQL} < 75 THEN '65-74' ELSE '75+' END"""


@query("parse_dates", f"""{VISITS_SQL}
SELECT order_key, CAST(try_strptime("BIRTHDATE", '%d-%m-%Y') AS DATE) AS birth,
  CAST(try_strptime("START", '%Y-%m-%dT%H:%M:%SZ') AS DATE) AS started,
  CAST(try_strptime("CITY", '%Y-%m-%d') AS DATE) AS no_date FROM visits""")
def parse_dates(spark, sf_dir):
    df = visits(spark, sf_dir, ["order_key", "BIRTHDATE", "START", "CITY"])
    return df.select(
        "order_key", *[dates.lenient_date(F.col(c)).alias(n)
                       for c, n in (("BIRTHDATE", "birth"), ("START", "started"), ("CITY", "no_date"))]
    )


@query("parse_dates_by_vote", f"""{VISITS_SQL}
SELECT order_key, CAST(try_strptime("BIRTHDATE", '%d-%m-%Y') AS DATE) AS birth,
  CAST(o_orderdate AS DATE) AS ordered, CAST(NULL AS DATE) AS nothing
FROM visits JOIN orders ON order_key = o_orderkey""")
def parse_dates_by_vote(spark, sf_dir):
    """Day first in one column, month first in the other; votes of two batches, the first with few sure cells."""
    df = table(spark, sf_dir, "orders").join(visits(spark, sf_dir, ["order_key", "BIRTHDATE", "CITY"]), F.col("order_key") == F.col("o_orderkey"))
    df = df.select("order_key", F.col("BIRTHDATE").alias("birth"), F.date_format("o_orderdate", "MM-dd-yyyy").alias("ordered"), F.col("CITY").alias("nothing"))
    df = written(df, "dated")
    columns = ["birth", "ordered", "nothing"]
    unsure = F.substring("ordered", 4, 2).cast("int") <= 12
    votes = merged_votes(*[format_votes(df.where(part), columns) for part in (unsure, ~unsure)])
    return read_dates(df, settled_formats(votes)).withColumn("nothing", F.lit(None).cast("date"))


@query("age_range", f"""{VISITS_SQL}
SELECT order_key, {AGE_SQL} AS age, {AGE_RANGE_SQL} AS "AGE_RANGE" FROM visits""")
def age_range(spark, sf_dir):
    df = add_age_range(visits(spark, sf_dir, ["order_key", "BIRTHDATE"]))
    age = dates.age_at_reference(dates.lenient_date(F.col("BIRTHDATE")))
    return df.select("order_key", age.alias("age"), "AGE_RANGE")


# ---- column state --------------------------------------------------------------------

STATE_COLUMNS = ["order_key", "PATIENT", "MARITAL", "CITY", "CODE", "BASE_ENCOUNTER_COST", "REASONCODE"]
STATE_NUMBERS = ["order_key", "CODE", "BASE_ENCOUNTER_COST", "REASONCODE"]


def _state_sql(column: str) -> str:
    number = column in STATE_NUMBERS
    text = f'CAST("{column}" AS VARCHAR)' if column not in STATE_NUMBERS[2:] else "NULL"
    return f"""SELECT '{column}' AS "column", count(*) AS rows, count(*) - count("{column}") AS nulls,
  true AS distinct_close, {f'round(avg("{column}"), 6)' if number else 'NULL'} AS mean,
  {f'round(stddev_samp("{column}"), 4)' if number else 'NULL'} AS deviation,
  {f'CAST(min("{column}") AS DOUBLE)' if number else 'NULL'} AS least, {f'CAST(max("{column}") AS DOUBLE)' if number else 'NULL'} AS most,
  min({text}) AS first, max({text}) AS last FROM visits"""


@query("column_state_batches", f"{VISITS_SQL} {' UNION ALL '.join(map(_state_sql, STATE_COLUMNS))}")
def column_state_batches(spark, sf_dir):
    """The states of ten batches, saved one by one and added up; the estimate of distinct values is held
    against the exact count, within 4 %, five standard errors."""
    df = loaded_visits(spark, sf_dir, STATE_COLUMNS)
    folder = new_path(spark, "state")
    for i in range(10):
        append_state(column_state(df.where(F.col("order_key") % 10 == i)), folder, i)
    report = state_report(load_state(spark, folder))
    exact = profile.one_row_per_column(df, STATE_COLUMNS, {"exact": F.count_distinct})
    decimals = F.col("column").isin(STATE_NUMBERS[2:])  # written as text differently by each engine
    return report.join(exact, "column").select(
        "column", "rows", "nulls", (F.abs(F.col("distinct") - F.col("exact")) <= 0.04 * F.col("exact")).alias("distinct_close"),
        F.round("mean", 6).alias("mean"), F.round("deviation", 4).alias("deviation"), "least", "most",
        F.when(~decimals, F.col("first")).alias("first"), F.when(~decimals, F.col("last")).alias("last"))
