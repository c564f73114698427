"""A wide visits table over the driver's tables, in Spark and as SQL.

One row per order, with the column names of an encounter table. Only the joins that
the wanted columns need are planned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.session import written

STAMP = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _md5_of(tag: str, value: str):
    return F.md5(F.concat(F.lit(tag), F.col(value).cast("string")))


def _from_orders():
    birth = F.date_add(F.lit("1930-01-01").cast("date"), (F.col("o_custkey") * 37 % 30000).cast("int"))
    return {
        "order_key": F.col("o_orderkey"),
        "Id_encounter": _md5_of("enc", "o_orderkey"),
        "PATIENT": _md5_of("pat", "o_custkey"),
        "Id_patient": _md5_of("pat", "o_custkey"),
        "START": F.date_format("o_orderdate", STAMP),
        "BIRTHDATE": F.date_format(birth, "dd-MM-yyyy"),
        "ENCOUNTERCLASS": F.col("o_orderpriority"),
        "BASE_ENCOUNTER_COST": F.col("o_totalprice"),
        "total_medication_cost": F.when(F.col("o_orderkey") % 29 != 0, F.col("o_totalprice") / 10),
    }


def _from_lines():
    return {
        "ORGANIZATION": _md5_of("org", "first_supplier"),
        "REASONCODE": F.when(
            F.col("o_orderkey") % 5 == 0, (100000 + F.col("first_part") % 56).cast("double")
        ),
        "STOP": F.date_format("last_ship", STAMP),
        "condition_dates": F.array_join(F.sort_array("ship_days").cast("array<string>"), "; "),
        "CODE": F.col("first_part"),
        "TOTAL_CLAIM_COST": F.col("claim").cast("double") / 10000,
    }


def _line_totals():
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    percent = F.round(F.col("l_discount") * 100).cast("bigint")
    return {
        "first_supplier": F.min("l_suppkey"),
        "first_part": F.min("l_partkey"),
        "last_ship": F.max("l_shipdate"),
        # Distinct calendar days: bounded by the calendar, not by the number of lines.
        "ship_days": F.collect_set(F.col("l_shipdate").cast("date")),
        "claim": F.sum(cents * (100 - percent)),
    }


LINE_NEEDS = {
    "ORGANIZATION": "first_supplier",
    "REASONCODE": "first_part",
    "STOP": "last_ship",
    "condition_dates": "ship_days",
    "CODE": "first_part",
    "TOTAL_CLAIM_COST": "claim",
}


def _from_customer():
    number = F.col("c_custkey")
    return {
        "PAYER": F.md5(F.concat(F.lit("pay"), F.col("c_mktsegment"))),
        "Id_payer": F.md5(F.concat(F.lit("pay"), F.col("c_mktsegment"))),
        "FIRST": F.concat(F.lit("First"), (number % 97).cast("string")),
        "LAST": F.col("c_name"),
        "SSN": F.format_string(
            "%03d-%02d-%04d", (number % 900).cast("int"), (number % 97).cast("int"),
            (number % 9973).cast("int"),
        ),
        "ADDRESS": F.concat((number % 999).cast("string"), F.lit(" "), "c_mktsegment", F.lit(" Street")),
        "MARITAL": F.when(number % 14 != 0, F.col("c_mktsegment")),
    }


def _from_places():
    return {"CITY": F.col("n_name"), "STATE": F.col("r_name")}


COLUMNS = [
    "order_key", "Id_encounter", "PATIENT", "Id_patient", "ORGANIZATION", "PAYER", "Id_payer",
    "REASONCODE", "START", "STOP", "BIRTHDATE", "condition_dates", "FIRST", "LAST", "SSN",
    "ADDRESS", "MARITAL", "CITY", "STATE", "ENCOUNTERCLASS", "CODE", "BASE_ENCOUNTER_COST",
    "TOTAL_CLAIM_COST", "total_medication_cost",
]


# Stated, so that no file has to be opened to plan a query.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def visits(spark: SparkSession, sf_dir: str, columns: Sequence[str] = COLUMNS) -> DataFrame:
    orders, lines, customer, places = _from_orders(), _from_lines(), _from_customer(), _from_places()
    df = table(spark, sf_dir, "orders")
    needs = {LINE_NEEDS[c] for c in columns if c in lines}
    if needs:
        totals = [c.alias(n) for n, c in _line_totals().items() if n in needs]
        # Lines are dealt out as they are: an order has few, and sets of days built before the
        # shuffle are sorted and packed twice, to be hardly fewer.
        per_order = table(spark, sf_dir, "lineitem").repartition("l_orderkey").groupBy("l_orderkey").agg(*totals)
        # Two tables of facts: neither is ever small, and the totals are already
        # partitioned by the order.
        per_order = per_order.hint("merge")
        df = df.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    if any(c in customer or c in places for c in columns):
        df = df.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    if any(c in places for c in columns):
        # Countries and regions: a fixed 25 and 5 rows at every scale.
        nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
        df = df.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        df = df.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    made = {**orders, **lines, **customer, **places}
    return df.select(*[made[c].alias(c) for c in columns])


def loaded_visits(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = COLUMNS, row_id: str | None = None,
) -> DataFrame:
    """The visits as a written table, for jobs that read their input more than once:
    the joins that make it are then run once. `row_id` names a column that tells all rows apart, also
    those that are the same; it is written with them, so every reader sees the same."""
    df = visits(spark, sf_dir, columns)
    return written(df if row_id is None else df.withColumn(row_id, F.monotonically_increasing_id()), "visits")


# The same table for DuckDB. Starts a WITH clause.
VISITS_SQL = """
WITH line_totals AS (
  SELECT l_orderkey,
         min(l_suppkey) AS first_supplier,
         min(l_partkey) AS first_part,
         max(l_shipdate) AS last_ship,
         array_to_string(list_sort(list(DISTINCT strftime(l_shipdate, '%Y-%m-%d'))), '; ') AS ship_days,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)
                  * (100 - CAST(round(l_discount * 100) AS BIGINT))) AS DOUBLE) / 10000 AS claim
  FROM lineitem GROUP BY l_orderkey
), visits AS (
  SELECT o_orderkey AS order_key,
         md5(concat('enc', CAST(o_orderkey AS VARCHAR))) AS "Id_encounter",
         md5(concat('pat', CAST(o_custkey AS VARCHAR))) AS "PATIENT",
         md5(concat('pat', CAST(o_custkey AS VARCHAR))) AS "Id_patient",
         md5('org' || CAST(first_supplier AS VARCHAR)) AS "ORGANIZATION",
         md5('pay' || c_mktsegment) AS "PAYER",
         md5('pay' || c_mktsegment) AS "Id_payer",
         CASE WHEN o_orderkey % 5 = 0 THEN CAST(100000 + first_part % 56 AS DOUBLE) END AS "REASONCODE",
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS "START",
         strftime(last_ship, '%Y-%m-%dT%H:%M:%SZ') AS "STOP",
         strftime(DATE '1930-01-01' + CAST(o_custkey * 37 % 30000 AS INTEGER), '%d-%m-%Y') AS "BIRTHDATE",
         ship_days AS condition_dates,
         'First' || CAST(c_custkey % 97 AS VARCHAR) AS "FIRST",
         c_name AS "LAST",
         printf('%03d-%02d-%04d', CAST(c_custkey % 900 AS INTEGER), CAST(c_custkey % 97 AS INTEGER),
                CAST(c_custkey % 9973 AS INTEGER)) AS "SSN",
         CAST(c_custkey % 999 AS VARCHAR) || ' ' || c_mktsegment || ' Street' AS "ADDRESS",
         CASE WHEN c_custkey % 14 <> 0 THEN c_mktsegment END AS "MARITAL",
         n_name AS "CITY",
         r_name AS "STATE",
         o_orderpriority AS "ENCOUNTERCLASS",
         first_part AS "CODE",
         o_totalprice AS "BASE_ENCOUNTER_COST",
         claim AS "TOTAL_CLAIM_COST",
         CASE WHEN o_orderkey % 29 <> 0 THEN o_totalprice / 10 END AS total_medication_cost
  FROM orders
  LEFT JOIN line_totals ON o_orderkey = l_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
)"""
