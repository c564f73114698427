"""Synthetic columns, the hybrid job and the run of all jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilframe import fixed_values as fixed
from veilframe.catalog.cells import AGE_RANGE_SQL, SALTED_PARTS, _ssn_sql, _uuid_sql
from veilframe.catalog.keys import RULES_SQL
from veilframe.catalog.measures import Y_NUMBERS, Y_TEXT
from veilframe.catalog.registry import query
from veilframe.catalog.visits import VISITS_SQL, loaded_visits, table, visits
from veilframe.operators.columns import add_age_range, assemble_output
from veilframe.operators.synth import band, condition_cell, cycled_conditions, synthesise, synthesise_samples
from veilframe.operators.privacy import column_pairs
from veilframe.operators.tree_synth import codes, pair_information, synthesise_tree
from veilframe.session import local_table
from veilframe.plans.hybrid import COST_BAND, clinical_cell, clinical_sample, deidentify_hybrid, run_all

CELL_SQL = "\"ENCOUNTERCLASS\" || '|' || CAST(CAST(floor(\"BASE_ENCOUNTER_COST\" / 100000) AS BIGINT) AS VARCHAR)"


def _draw_sql(seed: str, key: str = "order_key") -> str:
    return f"CAST('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, 15) AS BIGINT)"


def synth_sql(source: str, cell: str, targets: list[str], seed: str, floor_rows: int = 1,
              asked: str | None = None, key: str = "order_key") -> str:
    """CTEs that end in `drawn` (key and targets): lay the values of each cell end to end
    and look up the interval each draw falls in."""
    columns = ", ".join(f'"{t}"' for t in targets)
    ordered = ", ".join(f'"{t}" NULLS FIRST' for t in targets)
    return f""", counts AS (
  SELECT {cell} AS cell, {columns}, count(*) AS width FROM {source} GROUP BY ALL
), sizes AS (SELECT cell, sum(width) AS size FROM counts GROUP BY cell HAVING sum(width) >= {floor_rows}
), both_cells AS (
  SELECT cell, {columns}, width FROM counts WHERE cell IN (SELECT cell FROM sizes)
  UNION ALL SELECT '*', {columns}, sum(width) FROM counts GROUP BY ALL
), laid AS (
  SELECT *, sum(width) OVER (PARTITION BY cell ORDER BY {ordered}) - width AS start FROM both_cells
), asked AS (SELECT {key}, {cell} AS own, {_draw_sql(seed, key)} AS number FROM {asked or source}
), placed AS (
  SELECT {key}, CASE WHEN size IS NULL THEN '*' ELSE own END AS cell,
         number % coalesce(size, (SELECT sum(width) FROM counts)) AS position
  FROM asked LEFT JOIN sizes ON own = sizes.cell
), drawn AS (
  SELECT {key}, {columns} FROM placed JOIN laid ON laid.cell = placed.cell
    AND start <= position AND position < start + width
)"""


TARGETS = ["MARITAL", "CITY", "STATE"]
NEEDED = ["order_key", "ENCOUNTERCLASS", "BASE_ENCOUNTER_COST", *TARGETS]


@query("synth_conditional", f'{VISITS_SQL}{synth_sql("visits", CELL_SQL, TARGETS, "42")} SELECT * FROM drawn')
def synth_conditional(spark, sf_dir):
    df = loaded_visits(spark, sf_dir, NEEDED)
    return synthesise(df, df, "order_key", clinical_cell(df), TARGETS, "42")


FINE_SQL = ("\"CITY\" || '|' || \"ENCOUNTERCLASS\" || '|' || "
            "CAST(CAST(floor(\"BASE_ENCOUNTER_COST\" / 50000) AS BIGINT) AS VARCHAR)")


@query("synth_backoff", f'{VISITS_SQL}{synth_sql("visits", FINE_SQL, ["MARITAL", "CODE"], "7", 12)} SELECT * FROM drawn')
def synth_backoff(spark, sf_dir):
    df = loaded_visits(spark, sf_dir, ["order_key", "CITY", "ENCOUNTERCLASS", "BASE_ENCOUNTER_COST", "MARITAL", "CODE"])
    cell = condition_cell(F.col("CITY"), F.col("ENCOUNTERCLASS"), band(F.col("BASE_ENCOUNTER_COST"), 50_000.0))
    return synthesise(df, df, "order_key", cell, ["MARITAL", "CODE"], "7", floor_rows=12)


def _marginal(target: str) -> str:
    part = synth_sql("visits", CELL_SQL, [target], f"42|{target}")
    for name in ("counts", "sizes", "both_cells", "laid", "asked", "placed", "drawn"):
        part = part.replace(f"{name} AS (", f"{name}_{target} AS (").replace(f"FROM {name}", f"FROM {name}_{target}")
        part = part.replace(f"JOIN {name}", f"JOIN {name}_{target}").replace(f"{name}.cell", f"{name}_{target}.cell")
    return part


@query("synth_marginal", f"""{VISITS_SQL}{"".join(_marginal(t) for t in TARGETS)}
SELECT * FROM drawn_MARITAL JOIN drawn_CITY USING (order_key) JOIN drawn_STATE USING (order_key)""")
def synth_marginal(spark, sf_dir):
    df = loaded_visits(spark, sf_dir, NEEDED)
    return synthesise(df, df, "order_key", clinical_cell(df), TARGETS, "42", mode="marginal")


# ---- trees of pairs ------------------------------------------------------------------

TREE_TARGETS = ["CITY", "CODE", "ENCOUNTERCLASS", "MARITAL", "STATE"]
TREE_BANDS = {"CODE": 400.0, "BASE_ENCOUNTER_COST": 100_000.0}
TREE_CELL_SQL = 'CAST(CAST(floor("BASE_ENCOUNTER_COST" / 100000) AS BIGINT) AS VARCHAR)'


def _code_sql(column: str) -> str:
    if column == "*":
        return TREE_CELL_SQL
    value = f'CAST(floor("{column}" / {TREE_BANDS[column]}) AS BIGINT)' if column in TREE_BANDS else f'"{column}"'
    return f"coalesce(CAST({value} AS VARCHAR), '')"


def _information_sql(names: list[str]) -> str:
    """CTEs that end in `information`: a, b and the mutual information of the two columns."""
    coded = " UNION ALL ".join(
        f"SELECT order_key, '{c}' AS name, {_code_sql(c)} AS code FROM visits" for c in sorted(names))
    return f""", coded AS ({coded}
), singles AS (
  SELECT name, sum(n * ln(n)) AS e, sum(n) AS rows FROM (SELECT name, code, count(*) AS n FROM coded GROUP BY ALL) GROUP BY name
), couples AS (
  SELECT a, b, sum(n * ln(n)) AS e FROM (
    SELECT x.name AS a, y.name AS b, x.code AS c, y.code AS d, count(*) AS n
    FROM coded x JOIN coded y ON x.order_key = y.order_key AND x.name < y.name GROUP BY ALL) GROUP BY ALL
), information AS (
  SELECT a, b, round(ln(x.rows) + (couples.e - x.e - y.e) / x.rows, 6) AS information
  FROM couples JOIN singles x ON x.name = a JOIN singles y ON y.name = b
)"""


@query("dependency_information", f"""{VISITS_SQL}{_information_sql(["*", *TREE_TARGETS])}
SELECT a, b, round(information, 5) + 0.0 AS information FROM information""")
def dependency_information(spark, sf_dir):
    df = loaded_visits(spark, sf_dir, ["BASE_ENCOUNTER_COST", *TREE_TARGETS])
    cell = codes(df, ["BASE_ENCOUNTER_COST"], TREE_BANDS)["BASE_ENCOUNTER_COST"]
    found = pair_information(df, {**codes(df, TREE_TARGETS, TREE_BANDS), "*": cell})
    rows = [(a, b, value) for (a, b), value in found.items()]
    return local_table(spark, rows, "a string, b string, information double").withColumn(
        "information", F.round("information", 5) + 0.0)


def _tree_sql(seed: str, floor_rows: int) -> str:
    """CTEs that end in `drawn` (order_key, column, value, code): Prim's tree, then one column after another,
    each given the code drawn for the column it hangs on."""
    n = len(TREE_TARGETS)
    sql = _information_sql(["*", *TREE_TARGETS]) + """, edges AS (
  SELECT a AS child, b AS parent, information FROM information UNION ALL SELECT b, a, information FROM information
), tree_0 AS (SELECT 0 AS step, '*' AS child, '' AS parent)"""
    for k in range(1, n + 1):
        sql += f""", tree_{k} AS (
  SELECT * FROM tree_{k - 1} UNION ALL (SELECT {k}, child, parent FROM edges
    WHERE parent IN (SELECT child FROM tree_{k - 1}) AND child NOT IN (SELECT child FROM tree_{k - 1})
    ORDER BY information DESC, child, parent LIMIT 1))"""
    plain = " UNION ALL ".join(
        f"""SELECT order_key, '{c}' AS name, CAST("{c}" AS VARCHAR) AS value, {_code_sql(c)} AS code FROM visits""" for c in TREE_TARGETS)
    sql += f""", plain AS ({plain}
), counts AS (
  SELECT t.child, above.code AS cell, p.value, any_value(p.code) AS code, count(*) AS width FROM tree_{n} t
  JOIN plain p ON p.name = t.child JOIN coded above ON above.name = t.parent AND above.order_key = p.order_key
  GROUP BY t.child, above.code, p.value
), sizes AS (SELECT child, cell, sum(width) AS size FROM counts GROUP BY ALL HAVING sum(width) >= {floor_rows}
), both_cells AS (
  SELECT child, cell, false AS wide, value, code, width FROM counts JOIN sizes USING (child, cell)
  UNION ALL SELECT child, '', true, value, any_value(code), sum(width) FROM counts GROUP BY child, value
), laid AS (
  SELECT *, sum(width) OVER (PARTITION BY child, wide, cell ORDER BY value NULLS FIRST) - width AS start FROM both_cells
), drawn_0 AS (SELECT order_key, '*' AS child, NULL::varchar AS value, {TREE_CELL_SQL} AS code FROM visits)"""
    for k in range(1, n + 1):
        number = f"CAST('0x' || substr(md5('{seed}|' || q.child || '|' || CAST(order_key AS VARCHAR)), 1, 15) AS BIGINT)"
        sql += f""", placed_{k} AS (
  SELECT order_key, q.child, size IS NULL AS wide, CASE WHEN size IS NULL THEN '' ELSE above END AS cell,
         {number} % coalesce(size, (SELECT count(*) FROM visits)) AS position
  FROM (SELECT d.order_key, t.child, d.code AS above FROM tree_{n} t JOIN drawn_{k - 1} d ON d.child = t.parent WHERE t.step = {k}) q
  LEFT JOIN sizes ON sizes.child = q.child AND sizes.cell = q.above
), drawn_{k} AS (
  SELECT * FROM drawn_{k - 1} UNION ALL
  SELECT order_key, p.child, value, code FROM placed_{k} p JOIN laid l
    ON l.child = p.child AND l.wide = p.wide AND l.cell = p.cell AND start <= position AND position < start + width)"""
    return sql


@query("synth_tree", f"""{VISITS_SQL}{_tree_sql("42", 5)}
SELECT order_key, {", ".join(f'max(value) FILTER (child = {chr(39)}{c}{chr(39)})' + ('::BIGINT' if c == 'CODE' else '') + f' AS "{c}"' for c in TREE_TARGETS)}
FROM drawn_{len(TREE_TARGETS)} GROUP BY order_key""")
def synth_tree(spark, sf_dir):
    df = loaded_visits(spark, sf_dir, ["order_key", "BASE_ENCOUNTER_COST", *TREE_TARGETS])
    cell = codes(df, ["BASE_ENCOUNTER_COST"], TREE_BANDS)["BASE_ENCOUNTER_COST"]
    return synthesise_tree(df, df, "order_key", cell, TREE_TARGETS, "42", TREE_BANDS)


SAMPLE_SQL = f"""{VISITS_SQL}, filled AS (
  SELECT order_key, "STATE", "ENCOUNTERCLASS", "PAYER", {", ".join(
    f'coalesce(CAST("{c}" AS DOUBLE), (SELECT median("{c}") FROM visits)) AS "{c}"' for c in Y_NUMBERS)}
  FROM visits
), first_rows AS (SELECT * FROM filled ORDER BY order_key LIMIT 100)
{synth_sql("filled", '"STATE"', ["ENCOUNTERCLASS", "CODE", "BASE_ENCOUNTER_COST", "TOTAL_CLAIM_COST", "REASONCODE", "PAYER"],
           "42", 5, "first_rows")}
SELECT order_key, "ENCOUNTERCLASS", "PAYER", {", ".join(f'round("{c}", 6) AS "{c}"' for c in Y_NUMBERS)} FROM drawn"""


@query("synth_sample_decode", SAMPLE_SQL)
def synth_sample_decode(spark, sf_dir):
    df = loaded_visits(spark, sf_dir, ["order_key", "STATE", *Y_TEXT, *Y_NUMBERS])
    sample = clinical_sample(df, "order_key", rows=fixed.SAMPLE_ROWS)
    return sample.select("order_key", *Y_TEXT, *[F.round(c, 6).alias(c) for c in Y_NUMBERS])


@query("sample_cycle", f"""{VISITS_SQL}, placed AS (
  SELECT *, row_number() OVER (ORDER BY order_key) - 1 AS place, count(*) OVER () AS n FROM visits)
SELECT sample, order_key, "CITY", "STATE" FROM placed JOIN (
  SELECT unnest(generate_series(0, 2 * (SELECT count(*) FROM orders) + 6)) AS sample) ON place = sample % n""")
def sample_cycle(spark, sf_dir):
    df = visits(spark, sf_dir, ["order_key", "CITY", "STATE"])
    samples = 2 * table(spark, sf_dir, "orders").count() + 7
    return cycled_conditions(df, "order_key", samples)


@query("synth_samples", f"""{VISITS_SQL}, places AS (
  SELECT *, row_number() OVER (ORDER BY order_key) - 1 AS place, count(*) OVER () AS n FROM visits
), cycled AS (
  SELECT sample, "ENCOUNTERCLASS", "BASE_ENCOUNTER_COST" FROM places JOIN (
    SELECT unnest(generate_series(0, (SELECT count(*) FROM orders) + 499)) AS sample) ON place = sample % n)
{synth_sql("visits", CELL_SQL, ["MARITAL", "STATE"], "5", 1, "cycled", "sample")} SELECT * FROM drawn""")
def synth_samples(spark, sf_dir):
    df = loaded_visits(spark, sf_dir, ["order_key", "ENCOUNTERCLASS", "BASE_ENCOUNTER_COST", "MARITAL", "STATE"])
    conditions = df.select("order_key", "ENCOUNTERCLASS", "BASE_ENCOUNTER_COST")
    samples = df.count() + 500
    return synthesise_samples(df, conditions, "order_key", samples, clinical_cell(df), ["MARITAL", "STATE"], "5")


@query("assemble_output", f"""{VISITS_SQL}{synth_sql("visits", CELL_SQL, TARGETS, "42")}
SELECT v.order_key, "Id_encounter", d."MARITAL", d."CITY", d."STATE", {AGE_RANGE_SQL} AS "AGE_RANGE",
  "ENCOUNTERCLASS", "BASE_ENCOUNTER_COST"
FROM visits AS v JOIN drawn AS d ON v.order_key = d.order_key""")
def assemble(spark, sf_dir):
    df = add_age_range(loaded_visits(spark, sf_dir, [*NEEDED, "Id_encounter", "BIRTHDATE"]))
    made = synthesise(df, df, "order_key", clinical_cell(df), TARGETS, "42")
    return assemble_output(df, made, "order_key", ["Id_encounter", "ABSENT"], TARGETS,
                           ["ENCOUNTERCLASS", "BASE_ENCOUNTER_COST"])


HYBRID_QUASI = ["BIRTHDATE", "MARITAL", "CITY", "STATE"]
HYBRID_SQL = f"""{VISITS_SQL}, dated AS (
  SELECT * REPLACE (CAST(try_strptime("BIRTHDATE", '%d-%m-%Y') AS DATE) AS "BIRTHDATE") FROM visits)
{synth_sql("dated", CELL_SQL, HYBRID_QUASI, "42", 5)}
SELECT v.order_key, {", ".join(f'{_uuid_sql(f"{chr(34)}{c}{chr(34)}", "")} AS "{c}"' for c in ("Id_encounter", "Id_patient", "Id_payer"))},
  {_ssn_sql('"SSN"')} AS "SSN", 'Person_' || substr(md5("FIRST"), 1, 8) AS "FIRST",
  'Person_' || substr(md5("LAST"), 1, 8) AS "LAST", 'Address_' || substr(md5("ADDRESS"), 1, 8) AS "ADDRESS",
  {", ".join(f'd."{c}"' for c in HYBRID_QUASI)}, {AGE_RANGE_SQL.replace(chr(34) + "BIRTHDATE" + chr(34), 'v."BIRTHDATE"')} AS "AGE_RANGE",
  "ORGANIZATION", "PAYER", "ENCOUNTERCLASS", "CODE", "BASE_ENCOUNTER_COST", "TOTAL_CLAIM_COST", "REASONCODE",
  total_medication_cost, TRY_CAST(nullif(regexp_extract("START", '([0-9]{{4}})', 1), '') AS INTEGER) AS start_year,
  TRY_CAST(nullif(regexp_extract("STOP", '([0-9]{{4}})', 1), '') AS INTEGER) AS stop_year,
  TRY_CAST(nullif(regexp_extract(condition_dates, '([0-9]{{4}})', 1), '') AS INTEGER) AS condition_year
FROM visits AS v JOIN drawn AS d ON v.order_key = d.order_key"""


@query("deidentify_hybrid", HYBRID_SQL)
def hybrid(spark, sf_dir):
    return deidentify_hybrid(loaded_visits(spark, sf_dir), "order_key", ids="hashed")


ID_COLUMNS = ["Id_encounter", "Id_patient", "Id_payer"]


@query("hybrid_random_ids", VISITS_SQL + f""" SELECT 'apart' AS ids, count(DISTINCT v) AS originals, count(DISTINCT v) AS pseudonyms,
  count(DISTINCT v) AS pairs, CAST(0 AS BIGINT) AS in_the_clear FROM (
  {" UNION ALL ".join(f'SELECT "{c}" AS v FROM visits' for c in ID_COLUMNS)})""")
def hybrid_random_ids(spark, sf_dir):
    """Random ids cannot be compared as such: they must stand one to one for the originals, in all columns."""
    df = loaded_visits(spark, sf_dir)
    out = deidentify_hybrid(df, "order_key")
    pairs = column_pairs(df, out, "order_key", {c: "ids" for c in ID_COLUMNS})
    return pairs.agg(
        F.countDistinct("original").alias("originals"), F.countDistinct("pseudonym").alias("pseudonyms"),
        F.countDistinct("original", "pseudonym").alias("pairs"), F.count_if(F.col("original") == F.col("pseudonym")).alias("in_the_clear"),
    ).select(F.lit("apart").alias("ids"), "*")


# The same table under names that no fixed list has; the words in the names give the roles.
RENAMED = {"order_key": "row_no", "Id_patient": "PERSON_ID", "SSN": "PERSON_SSN", "LAST": "PERSON_NAME", "ADDRESS": "HOME_ADDRESS",
           "CITY": "HOME_CITY", "STATE": "HOME_STATE", "CODE": "LAB_VALUE", "BASE_ENCOUNTER_COST": "VISIT_COST"}
WORD_CELL_SQL = "CAST(CAST(floor(\"VISIT_COST\" / 100000) AS BIGINT) AS VARCHAR)"


@query("hybrid_by_words", f"""{VISITS_SQL}, renamed AS (
  SELECT {", ".join(f'"{c}" AS "{n}"' for c, n in RENAMED.items())} FROM visits)
{synth_sql("renamed", WORD_CELL_SQL, ["HOME_CITY", "HOME_STATE"], "42", 5, key="row_no")}
SELECT v.row_no, {_uuid_sql('"PERSON_ID"', "s1")} AS "PERSON_ID", {_ssn_sql("'s1' || " + '"PERSON_SSN"', SALTED_PARTS)} AS "PERSON_SSN",
  'Person_' || substr(sha256('s1' || "PERSON_NAME"), 1, 16) AS "PERSON_NAME",
  'Address_' || substr(sha256('s1' || "HOME_ADDRESS"), 1, 16) AS "HOME_ADDRESS",
  d."HOME_CITY", d."HOME_STATE", "LAB_VALUE", "VISIT_COST"
FROM renamed AS v JOIN drawn AS d ON v.row_no = d.row_no""")
def hybrid_by_words(spark, sf_dir):
    df = loaded_visits(spark, sf_dir, list(RENAMED)).withColumnsRenamed(RENAMED)
    cell = condition_cell(band(F.col("VISIT_COST"), COST_BAND))
    return deidentify_hybrid(df, "row_no", role_file={}, cell=cell, ids="hashed", salt="s1")


@query("run_all", f"""SELECT 'rules' AS job, count(*) AS rows, CAST(20 AS BIGINT) AS columns FROM orders
UNION ALL SELECT 'hybrid', count(*), 24 FROM orders
UNION ALL SELECT 'sample', least(count(*), 100), 7 FROM orders""")
def everything(spark, sf_dir):
    """One row per job: the rows and columns it gave."""
    done = run_all(loaded_visits(spark, sf_dir), "order_key", sample_rows=fixed.SAMPLE_ROWS)
    outputs = {"rules": done["rules"].output, "hybrid": done["hybrid"], "sample": done["sample"]}
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(job).alias("job"), "rows", F.lit(len(df.columns)).cast("bigint").alias("columns"))
        for job, df in outputs.items()
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query("run_all_rules", RULES_SQL)
def run_all_rules(spark, sf_dir):
    """The whole output of the first job of a run."""
    return run_all(loaded_visits(spark, sf_dir), "order_key", synthesis=False, sample=False)["rules"].output


@query("run_all_hybrid", HYBRID_SQL)
def run_all_hybrid(spark, sf_dir):
    """The whole output of the second job of a run."""
    return run_all(loaded_visits(spark, sf_dir), "order_key", sample=False, ids="hashed")["hybrid"]


@query("run_all_sample", SAMPLE_SQL)
def run_all_sample(spark, sf_dir):
    """The whole output of the last job of a run, for its first rows."""
    sample = run_all(loaded_visits(spark, sf_dir), "order_key", sample_rows=fixed.SAMPLE_ROWS)["sample"]
    return sample.select("order_key", *Y_TEXT, *[F.round(c, 6).alias(c) for c in Y_NUMBERS])


FEW_CELLS = "\"STATE\""


@query("synth_many_samples", f"""{VISITS_SQL}, donors AS (
  SELECT order_key, "STATE", "MARITAL", "CODE" FROM visits WHERE order_key % 50 = 1
), places AS (
  SELECT *, row_number() OVER (ORDER BY order_key) - 1 AS place, count(*) OVER () AS n FROM donors
), cycled AS (
  SELECT sample, "STATE" FROM places JOIN (
    SELECT unnest(generate_series(0, 10 * (SELECT count(*) FROM orders) - 1)) AS sample) ON place = sample % n)
{synth_sql("donors", FEW_CELLS, ["MARITAL", "CODE"], "5", 1, "cycled", "sample")} SELECT * FROM drawn""")
def synth_many_samples(spark, sf_dir):
    """Samples far above the donors: five cells with a fifth of the draws each."""
    df = loaded_visits(spark, sf_dir, ["order_key", "STATE", "MARITAL", "CODE"]).where("order_key % 50 = 1")
    samples = 10 * table(spark, sf_dir, "orders").count()
    return synthesise_samples(df, df.select("order_key", "STATE"), "order_key", samples, condition_cell(F.col("STATE")), ["MARITAL", "CODE"], "5")
