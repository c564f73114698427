"""Encoding, scaling, privacy and utility measures, series."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilframe import fixed_values as fixed
from veilframe.catalog.cells import AGE_RANGE_SQL
from veilframe.catalog.keys import DICT_SQL
from veilframe.catalog.registry import query
from veilframe.catalog.visits import VISITS_SQL, loaded_visits, table, visits
from veilframe.operators import encode, privacy, series, utility
from veilframe.operators.columns import add_age_range, generalize_years
from veilframe.operators.comoments import correlations
from veilframe.operators.dictionary import NAMESPACES, apply_dictionary, build_dictionary
from veilframe.operators.synth import band
from veilframe.plans.features import prepare_for_quasi, prepare_for_sample
from veilframe.plans.policy import resolve_roles
from veilframe.session import new_path
from veilframe.sources.tables import write_json

ROUNDED = 6


def rounded(df, *columns):
    """Rounded, and without a negative zero, as the SQL does it too."""
    return df.select(*[
        (F.round(c, ROUNDED) + 0.0).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns
    ])


# ---- labels and scales ---------------------------------------------------------------


def codes_sql(source: str, columns, missing: str) -> str:
    """A CTE per text column with its sorted labels and their codes."""
    return "".join(
        f""", code_{c} AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS code
  FROM (SELECT DISTINCT coalesce("{c}", '{missing}') AS label FROM {source}))""" for c in columns)


def code_joins(columns, missing: str, source: str = "v") -> str:
    return " ".join(f"LEFT JOIN code_{c} ON code_{c}.label = coalesce({source}.\"{c}\", '{missing}')" for c in columns)


@query("label_encode", f"""{VISITS_SQL}{codes_sql('visits', ['MARITAL', 'CITY', 'PATIENT'], '')}
SELECT order_key, code_MARITAL.code AS "MARITAL", code_CITY.code AS "CITY", code_PATIENT.code AS "PATIENT"
FROM visits AS v {code_joins(['MARITAL', 'CITY', 'PATIENT'], '')}""")
def label_encode(spark, sf_dir):
    columns = ["MARITAL", "CITY", "PATIENT"]
    df = loaded_visits(spark, sf_dir, ["order_key", *columns]).na.fill("", subset=columns)
    return encode.encode_labels(df, encode.label_state(df, columns), columns)


SCALED = ["BASE_ENCOUNTER_COST", "TOTAL_CLAIM_COST", "CODE"]


@query("scale_minmax", f"""{VISITS_SQL} SELECT order_key, {", ".join(
    f'2 * (CAST("{c}" AS DOUBLE) - min("{c}") OVER ()) / (max("{c}") OVER () - min("{c}") OVER ()) - 1 AS "{c}"'
    for c in SCALED)} FROM visits""")
def scale_minmax(spark, sf_dir):
    df = loaded_visits(spark, sf_dir, ["order_key", *SCALED])
    return encode.scale_minmax(df, encode.scale_state(df, SCALED), SCALED)


@query("scale_standard", f"""{VISITS_SQL}, z AS (SELECT order_key, {", ".join(
    f'"{c}", ("{c}" - avg("{c}") OVER ()) / stddev_pop("{c}") OVER () AS "z_{c}"' for c in SCALED)} FROM visits)
SELECT order_key, {", ".join(f'round("z_{c}", 6) + 0.0 AS "z_{c}", round(CAST("{c}" AS DOUBLE), 6) AS "back_{c}"' for c in SCALED)} FROM z""")
def scale_standard(spark, sf_dir):
    df = loaded_visits(spark, sf_dir, ["order_key", *SCALED])
    state = encode.scale_state(df, SCALED)
    scaled = encode.scale_standard(df, state, SCALED)
    back = encode.unscale_standard(scaled, state, SCALED).select(
        "order_key", *[F.round(c, 6).alias(f"back_{c}") for c in SCALED])
    return rounded(scaled, *SCALED).select(
        "order_key", *[F.col(c).alias(f"z_{c}") for c in SCALED]).join(back, "order_key")


@query("label_roundtrip", f"""{VISITS_SQL}{codes_sql('visits', ['MARITAL', 'CITY'], '')}
SELECT order_key, coalesce("MARITAL", '') AS "MARITAL", "CITY", coalesce("MARITAL", '') AS cut_marital,
  (SELECT label FROM code_CITY AS c WHERE c.code = least(greatest(CAST(round_even(code_CITY.code + order_key % 7 - 2.5, 0)
     AS BIGINT), 0), (SELECT max(code) FROM code_CITY))) AS moved_city
FROM visits AS v {code_joins(['MARITAL', 'CITY'], '')}""")
def label_roundtrip(spark, sf_dir):
    """Encode, scale, back, decode; and decode codes that were moved off the grid."""
    columns = ["MARITAL", "CITY"]
    df = loaded_visits(spark, sf_dir, ["order_key", *columns]).na.fill("", subset=columns)
    labels = encode.label_state(df, columns)
    codes = encode.encode_labels(df, labels, columns)
    scales = encode.scale_state(codes, columns)
    back = encode.unscale_minmax(encode.scale_minmax(codes, scales, columns), scales, columns)
    decoded = encode.decode_labels(back, labels, columns, row_key="order_key", sent_bytes=0)  # both by shuffles
    cut = encode.decode_labels(codes, labels, ["MARITAL"], clip=False)
    moved = codes.withColumn("CITY", F.col("CITY") + F.col("order_key") % 7 - 2.5)
    moved = encode.decode_labels(moved, labels, ["CITY"])
    return decoded.join(cut.select("order_key", F.col("MARITAL").alias("cut_marital")), "order_key").join(
        moved.select("order_key", F.col("CITY").alias("moved_city")), "order_key")


QUASI_TEXT = ["MARITAL", "CITY", "STATE"]
CLINICAL_TEXT = ["START", "STOP", "ORGANIZATION", "PAYER", "ENCOUNTERCLASS", "condition_dates"]
CLINICAL_NUMBERS = ["CODE", "BASE_ENCOUNTER_COST", "TOTAL_CLAIM_COST", "REASONCODE", "total_medication_cost"]


def _minmax(expression: str) -> str:
    return f"2 * ({expression} - min({expression}) OVER ()) / (max({expression}) OVER () - min({expression}) OVER ()) - 1"


DAYS_SQL = "CAST(date_diff('day', DATE '1970-01-01', CAST(try_strptime(\"BIRTHDATE\", '%d-%m-%Y') AS DATE)) AS DOUBLE)"


PREPARED_SQL = f"""{VISITS_SQL}{codes_sql('visits', [*QUASI_TEXT, *CLINICAL_TEXT], '')}
SELECT order_key, {AGE_RANGE_SQL} AS "AGE_RANGE",
  {", ".join(f'code_{c}.code AS "{c}"' for c in CLINICAL_TEXT)},
  {", ".join(f'coalesce(v."{c}", 0) AS "{c}"' for c in CLINICAL_NUMBERS)},
  round({_minmax(DAYS_SQL)}, 6) + 0.0 AS "BIRTHDATE",
  {", ".join(f'round({_minmax(f"CAST(code_{c}.code AS DOUBLE)")}, 6) + 0.0 AS "{c}"' for c in QUASI_TEXT)}
FROM visits AS v {code_joins([*QUASI_TEXT, *CLINICAL_TEXT], '')}"""


@query("prepare_features_a", PREPARED_SQL)
def prepare_features_a(spark, sf_dir):
    df = loaded_visits(spark, sf_dir)
    done = prepare_for_quasi(df, "order_key", resolve_roles(df, fixed.DEFAULT_ROLES))
    targets = rounded(done.targets, "BIRTHDATE", *QUASI_TEXT)
    return done.conditions.join(targets, "order_key").join(done.carried, "order_key")


@query("prepared_saved_and_loaded", PREPARED_SQL)
def prepared_saved_and_loaded(spark, sf_dir):
    """Prepared data and fitted state through their files."""
    df = loaded_visits(spark, sf_dir)
    done, folder = prepare_for_quasi(df, "order_key", resolve_roles(df, fixed.DEFAULT_ROLES)), new_path(spark, "prepared")
    encode.save_prepared(done.tables(), folder)
    back = encode.load_prepared(spark, folder, list(done.tables()))
    targets = rounded(back["targets"], "BIRTHDATE", *QUASI_TEXT)
    return back["conditions"].join(targets, "order_key").join(back["carried"], "order_key")


X_TEXT, Y_TEXT = ["CITY", "STATE", "ORGANIZATION", "PATIENT", "MARITAL"], ["ENCOUNTERCLASS", "PAYER"]
Y_NUMBERS = ["CODE", "BASE_ENCOUNTER_COST", "TOTAL_CLAIM_COST", "REASONCODE"]


def _standard(expression: str) -> str:
    return f"round(({expression} - avg({expression}) OVER ()) / stddev_pop({expression}) OVER (), 6) + 0.0"


@query("prepare_features_b", f"""{VISITS_SQL}{codes_sql('visits', [*X_TEXT, *Y_TEXT], 'Unknown')}
SELECT order_key, {", ".join(f'{_standard(f"code_{c}.code")} AS "{c}"' for c in [*X_TEXT, *Y_TEXT])},
  {", ".join(_standard(f'coalesce(CAST(v."{c}" AS DOUBLE), (SELECT median(m."{c}") FROM visits AS m))') + f' AS "{c}"' for c in Y_NUMBERS)}
FROM visits AS v {code_joins([*X_TEXT, *Y_TEXT], 'Unknown')}""")
def prepare_features_b(spark, sf_dir):
    columns = ["order_key", *X_TEXT, *Y_TEXT, *Y_NUMBERS]
    done = prepare_for_sample(loaded_visits(spark, sf_dir, columns), "order_key")
    x, y = rounded(done.conditions, *X_TEXT), rounded(done.targets, *Y_TEXT, *Y_NUMBERS)
    return x.join(y, "order_key")


# ---- privacy -------------------------------------------------------------------------

QUASI = ["CITY", "AGE_RANGE", "MARITAL"]
AGED_SQL = f'{VISITS_SQL}, aged AS (SELECT *, {AGE_RANGE_SQL} AS "AGE_RANGE" FROM visits)'


def _aged(spark, sf_dir, *more):
    return add_age_range(visits(spark, sf_dir, ["order_key", "CITY", "MARITAL", "BIRTHDATE", *more]))


@query("k_anonymity", f"""{AGED_SQL}, classes AS (
  SELECT count(*) AS size FROM aged GROUP BY "CITY", "AGE_RANGE", "MARITAL")
SELECT min(size) AS smallest_class, count(*) AS classes,
  CAST(coalesce(sum(size) FILTER (size < 20), 0) AS BIGINT) AS rows_below_k,
  count(*) FILTER (size < 20) AS classes_below_k FROM classes""")
def k_anonymity(spark, sf_dir):
    return privacy.k_anonymity(_aged(spark, sf_dir), QUASI, 20)


@query("l_diversity", f"""{AGED_SQL}, classes AS (
  SELECT count(DISTINCT "REASONCODE") AS n FROM aged GROUP BY "CITY", "AGE_RANGE", "MARITAL")
SELECT min(n) AS least_values, count(*) AS classes, count(*) FILTER (n < 3) AS classes_below_l FROM classes""")
def l_diversity(spark, sf_dir):
    return privacy.l_diversity(_aged(spark, sf_dir, "REASONCODE"), QUASI, "REASONCODE", 3)


@query("t_closeness", f"""{AGED_SQL}, cells AS (
  SELECT "CITY", "AGE_RANGE", "MARITAL", "ENCOUNTERCLASS" AS v, count(*) AS n FROM aged GROUP BY ALL
), classes AS (SELECT "CITY", "AGE_RANGE", "MARITAL", sum(n) AS n_class FROM cells GROUP BY ALL
), overall AS (SELECT v, sum(n) / (SELECT count(*) FROM aged) AS q FROM cells GROUP BY v
), grid AS (
  SELECT c."CITY", c."AGE_RANGE", c."MARITAL", coalesce(n, 0) / n_class AS p, q
  FROM classes AS c CROSS JOIN overall AS o LEFT JOIN cells AS x ON x."CITY" = c."CITY"
    AND x."AGE_RANGE" = c."AGE_RANGE" AND x."MARITAL" IS NOT DISTINCT FROM c."MARITAL" AND x.v = o.v
), apart AS (SELECT sum(abs(p - q)) / 2 AS d FROM grid GROUP BY "CITY", "AGE_RANGE", "MARITAL")
SELECT round(max(d), 9) AS worst_distance, round(avg(d), 9) AS mean_distance, count(*) AS classes FROM apart""")
def t_closeness(spark, sf_dir):
    found = privacy.t_closeness(_aged(spark, sf_dir, "ENCOUNTERCLASS"), QUASI, "ENCOUNTERCLASS")
    return found.select(*[F.round(c, 9).alias(c) for c in ("worst_distance", "mean_distance")], "classes")


CUTS = [100_000.0, 200_000.0, 300_000.0, 400_000.0]


@query("t_closeness_ordered", f"""{AGED_SQL}, reached AS (
  SELECT "CITY", "AGE_RANGE", "MARITAL", cut, count(*) FILTER ("BASE_ENCOUNTER_COST" < cut) / count(*) AS p
  FROM aged, (VALUES {", ".join(f"(CAST({c} AS DOUBLE))" for c in CUTS)}) AS cuts(cut) GROUP BY ALL
), overall AS (
  SELECT cut, count(*) FILTER ("BASE_ENCOUNTER_COST" < cut) / count(*) AS q
  FROM aged, (VALUES {", ".join(f"(CAST({c} AS DOUBLE))" for c in CUTS)}) AS cuts(cut) GROUP BY cut
), apart AS (
  SELECT sum(abs(p - q)) / 4 AS d FROM reached JOIN overall USING (cut) GROUP BY "CITY", "AGE_RANGE", "MARITAL")
SELECT round(max(d), 9) AS worst_distance, round(avg(d), 9) AS mean_distance, count(*) AS classes FROM apart""")
def t_closeness_ordered(spark, sf_dir):
    df = _aged(spark, sf_dir, "BASE_ENCOUNTER_COST")
    found = privacy.t_closeness_ordered(df, QUASI, "BASE_ENCOUNTER_COST", CUTS)
    return found.select(*[F.round(c, 9).alias(c) for c in ("worst_distance", "mean_distance")], "classes")


@query("t_closeness_every_value", f"""{AGED_SQL}, known AS (
  SELECT "CITY", "AGE_RANGE", "MARITAL", floor("BASE_ENCOUNTER_COST" / 1000) AS v FROM aged WHERE "BASE_ENCOUNTER_COST" IS NOT NULL
), overall AS (
  SELECT v, CAST(sum(count(*)) OVER (ORDER BY v) AS DOUBLE) / sum(count(*)) OVER () AS q, count(*) OVER () AS m,
         row_number() OVER (ORDER BY v) AS place FROM known GROUP BY v
), grid AS (
  SELECT c.*, o.v, o.q, o.m, o.place FROM (SELECT "CITY", "AGE_RANGE", "MARITAL", count(*) AS size FROM known GROUP BY ALL) AS c, overall AS o
), own AS (SELECT "CITY", "AGE_RANGE", "MARITAL", v, count(*) AS n FROM known GROUP BY ALL
), reached AS (
  SELECT g."CITY", g."AGE_RANGE", g."MARITAL", m, place, q,
    CAST(sum(coalesce(n, 0)) OVER (PARTITION BY g."CITY", g."AGE_RANGE", g."MARITAL" ORDER BY g.v) AS DOUBLE) / size AS p
  FROM grid AS g LEFT JOIN own AS o ON g.v = o.v AND g."CITY" IS NOT DISTINCT FROM o."CITY"
    AND g."AGE_RANGE" IS NOT DISTINCT FROM o."AGE_RANGE" AND g."MARITAL" IS NOT DISTINCT FROM o."MARITAL"
), apart AS (
  SELECT sum(abs(p - q)) FILTER (place < m) / (max(m) - 1) AS d FROM reached GROUP BY "CITY", "AGE_RANGE", "MARITAL")
SELECT round(max(d), 9) AS worst_distance, round(avg(d), 9) AS mean_distance, count(*) AS classes FROM apart""")
def t_closeness_every_value(spark, sf_dir):
    df = _aged(spark, sf_dir, "BASE_ENCOUNTER_COST").withColumn("cost", F.floor(F.col("BASE_ENCOUNTER_COST") / 1000))
    found = privacy.t_closeness_every_value(df, QUASI, "cost")
    return found.select(*[F.round(c, 9).alias(c) for c in ("worst_distance", "mean_distance")], "classes")


KEY_NAMESPACES = {c: n for n, spec in NAMESPACES.items() for c in spec.columns}


@query("referential_integrity", DICT_SQL.replace(
    "SELECT namespace, original, seq, pseudonym FROM dict",
    """SELECT namespace, count(*) AS pairs, CAST(0 AS BIGINT) AS split_originals,
  CAST(0 AS BIGINT) AS split_pseudonyms FROM dict GROUP BY namespace"""))
def referential_integrity(spark, sf_dir):
    df = loaded_visits(spark, sf_dir, ["order_key", *KEY_NAMESPACES])
    output = apply_dictionary(df, build_dictionary(df, "order_key"))
    return privacy.referential_integrity(privacy.column_pairs(df, output, "order_key", KEY_NAMESPACES))


@query("residual_identifiers", f"""{VISITS_SQL}, cells AS (
  {" UNION ALL ".join(f'''SELECT '{c}' AS "column", "{c}" AS v FROM visits'''
                      for c in ("Id_encounter", "PATIENT", "ORGANIZATION", "PAYER"))})
SELECT "column", count(DISTINCT v) AS distinct_values,
  CASE WHEN "column" = 'ORGANIZATION' THEN count(DISTINCT v) ELSE 0 END AS original_keys_left,
  CAST(0 AS BIGINT) AS identifier_columns_left
FROM cells WHERE v IS NOT NULL GROUP BY "column" """)
def residual_identifiers(spark, sf_dir):
    """The organisation is left as it is on purpose: the check has to find it."""
    columns = ["Id_encounter", "PATIENT", "ORGANIZATION", "PAYER"]
    df = loaded_visits(spark, sf_dir, ["order_key", *columns])
    spec = {n: NAMESPACES[n] for n in ("encounters", "patients", "payers")}
    output = apply_dictionary(df, build_dictionary(df, "order_key", spec), spec)
    return privacy.residual_identifiers(df, output, columns)


HUNDRED = 100


def _hundred(k: int) -> str:
    return f"CASE WHEN (o_orderkey + {k}) % 17 <> 0 THEN CAST((o_orderkey * {2 * k + 1} + o_custkey * {k % 7}) % {1009 + k} AS DOUBLE) END"


@query("correlation_all_pairs", f"""WITH long AS (
  SELECT o_orderkey, unnest([{", ".join(f"{{'k': {k}, 'v': {_hundred(k)}}}" for k in range(HUNDRED))}], recursive := true) FROM orders)
SELECT 'c' || a.k AS a, 'c' || b.k AS b, count(*) AS n, round(corr(a.v, b.v), {ROUNDED}) + 0.0 AS correlation
FROM long a JOIN long b ON a.o_orderkey = b.o_orderkey AND a.k < b.k WHERE a.v IS NOT NULL AND b.v IS NOT NULL GROUP BY a.k, b.k""")
def correlation_all_pairs(spark, sf_dir):
    """All 4,950 pairs of a hundred columns, in stripes of forty."""
    df = table(spark, sf_dir, "orders").select(*[F.expr(_hundred(k)).alias(f"c{k}") for k in range(HUNDRED)])
    return rounded(correlations(df, stripe=40), "correlation")


NOTE_SQL = """CASE WHEN order_key % 7 = 0 THEN 'Referred: (' || upper("PATIENT") || '), see file ' || "Id_encounter" || '.'
  WHEN order_key % 11 = 0 THEN 'SSN: ' || "SSN" || '; call ' || "FIRST" ELSE 'Nothing new, ' || "CITY" || ' office.' END"""
PLAN_SQL = """CASE WHEN order_key % 13 = 0 THEN 'Lives at' || chr(10) || lower("ADDRESS") || ', ' || "ADDRESS" || '.' END"""
FOUND_KEYS = {"encounters": "Id_encounter", "patients": "PATIENT", "numbers": "SSN", "addresses": "ADDRESS"}


@query("residual_in_texts", rf"""{VISITS_SQL}, notes AS (
  SELECT order_key, {NOTE_SQL} AS "NOTE", {PLAN_SQL} AS "PLAN" FROM visits
), cells AS (
  SELECT 'NOTE' AS "column", order_key, "NOTE" AS t FROM notes UNION ALL SELECT 'PLAN', order_key, "PLAN" FROM notes
), worded AS (
  SELECT "column", order_key, list_filter(regexp_split_to_array(lower(t), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS w
  FROM cells WHERE t IS NOT NULL
), known AS (
  SELECT DISTINCT namespace, array_to_string(w, ' ') AS phrase, len(w) AS n FROM (
    SELECT namespace, list_filter(regexp_split_to_array(lower(original), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS w FROM (
      {" UNION ALL ".join(f"SELECT '{n}' AS namespace, {chr(34)}{c}{chr(34)} AS original FROM visits" for n, c in FOUND_KEYS.items())}))
), runs AS (
  SELECT "column", order_key, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM (
    SELECT "column", order_key, w, n, unnest(range(1, len(w) - n + 2)) AS i
    FROM worded, (SELECT DISTINCT n FROM known) WHERE len(w) >= n)
)
SELECT "column", namespace, count(DISTINCT order_key) AS cells, count(DISTINCT phrase) AS originals
FROM runs JOIN known USING (n, phrase) GROUP BY ALL""")
def residual_in_texts(spark, sf_dir):
    """Notes with patients, numbers and addresses planted in some of them."""
    df = loaded_visits(spark, sf_dir, ["order_key", "FIRST", "CITY", *FOUND_KEYS.values()])
    notes = df.select("order_key", F.expr(NOTE_SQL.replace('"', "`")).alias("NOTE"), F.expr(PLAN_SQL.replace('"', "`")).alias("PLAN"))
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("namespace"), F.col(c).alias("original")) for n, c in FOUND_KEYS.items()]))
    return privacy.originals_in_texts(notes, df.select(each.alias("o")).select("o.*"))


@query("date_precision", f"""{VISITS_SQL}
SELECT 'start_year' AS "column", count("START") AS cells, CAST(0 AS BIGINT) AS finer_than_year FROM visits
UNION ALL SELECT 'stop_year', count("STOP"), 0 FROM visits
UNION ALL SELECT 'condition_year', count(condition_dates), 0 FROM visits
UNION ALL SELECT 'BIRTHDATE', count("BIRTHDATE"), count("BIRTHDATE") FROM visits""")
def date_precision(spark, sf_dir):
    """The birth date is left as it is on purpose: the check has to find it."""
    df = visits(spark, sf_dir, ["START", "STOP", "BIRTHDATE", "condition_dates"])
    years = {c: n for c, n in fixed.YEAR_COLUMNS.items() if c != "BIRTHDATE"}
    output = generalize_years(df, years)
    return privacy.date_precision(output, output.columns)


# ---- utility -------------------------------------------------------------------------

# The changed table the measures compare with: costs cut to bands, some cells emptied.
CHANGED_SQL = f"""{VISITS_SQL}, changed AS (
  SELECT order_key, CASE WHEN order_key % 10 <> 0 THEN "MARITAL" END AS "MARITAL",
    CASE WHEN order_key % 3 = 0 THEN "STATE" ELSE 'ASIA' END AS "STATE",
    CAST(CAST(floor("BASE_ENCOUNTER_COST" / 1000) AS BIGINT) * 1000 AS DOUBLE) AS "BASE_ENCOUNTER_COST",
    "TOTAL_CLAIM_COST" * (1 + order_key % 2) AS "TOTAL_CLAIM_COST", "CODE" FROM visits)"""
COMPARED = ["MARITAL", "STATE", "BASE_ENCOUNTER_COST", "TOTAL_CLAIM_COST", "CODE"]
AMOUNTS = ["BASE_ENCOUNTER_COST", "TOTAL_CLAIM_COST", "CODE"]


def _compared(spark, sf_dir, columns=COMPARED):
    df = loaded_visits(spark, sf_dir, ["order_key", *columns])
    key = F.col("order_key")
    changes = {
        "MARITAL": F.when(key % 10 != 0, F.col("MARITAL")) if "MARITAL" in columns else None,
        "STATE": F.when(key % 3 == 0, F.col("STATE")).otherwise("ASIA") if "STATE" in columns else None,
        "BASE_ENCOUNTER_COST": (band(F.col("BASE_ENCOUNTER_COST"), 1000.0) * 1000).cast("double"),
        "TOTAL_CLAIM_COST": F.col("TOTAL_CLAIM_COST") * (1 + key % 2),
    }
    return df, df.withColumns({c: e for c, e in changes.items() if c in columns})


@query("dist_similarity", f"""{CHANGED_SQL}, counted AS (
  {" UNION ALL ".join(f'''SELECT '{c}' AS feature, v, count(*) FILTER (side = 0) / sum(count(*) FILTER (side = 0)) OVER ()
      AS p, count(*) FILTER (side = 1) / sum(count(*) FILTER (side = 1)) OVER () AS q
    FROM (SELECT "{c}" AS v, 0 AS side FROM visits UNION ALL SELECT "{c}", 1 FROM changed) GROUP BY v'''
    for c in ("MARITAL", "STATE"))})
SELECT feature, round(sum(abs(p - q)) / 2, 9) AS distance FROM counted GROUP BY feature""")
def dist_similarity(spark, sf_dir):
    return utility.category_distance(*_compared(spark, sf_dir, ["MARITAL", "STATE", "BASE_ENCOUNTER_COST", "TOTAL_CLAIM_COST"]),
                                     ["MARITAL", "STATE"]).select("feature", F.round("distance", 9).alias("distance"))


def _ks(c: str) -> str:
    return f"""SELECT '{c}' AS feature,
    (SELECT round(max(abs(f1 - f2)), 9) FROM (
      SELECT sum(count(*) FILTER (side = 0)) OVER (ORDER BY v) / (SELECT count("{c}") FROM visits) AS f1,
             sum(count(*) FILTER (side = 1)) OVER (ORDER BY v) / (SELECT count("{c}") FROM changed) AS f2
      FROM (SELECT CAST("{c}" AS DOUBLE) AS v, 0 AS side FROM visits UNION ALL SELECT CAST("{c}" AS DOUBLE), 1 FROM changed)
      WHERE v IS NOT NULL GROUP BY v)) AS ks_distance,
    round((SELECT avg("{c}") FROM changed) - (SELECT avg("{c}") FROM visits), 4) + 0.0 AS mean_change,
    round((SELECT stddev_pop("{c}") FROM changed) - (SELECT stddev_pop("{c}") FROM visits), 4) + 0.0 AS std_change"""


@query("dist_similarity_numbers", CHANGED_SQL + " UNION ALL ".join(_ks(c) for c in AMOUNTS))
def dist_similarity_numbers(spark, sf_dir):
    found = utility.number_distance(*_compared(spark, sf_dir, AMOUNTS), AMOUNTS)
    return found.select("feature", F.round("ks_distance", 9).alias("ks_distance"),
                        (F.round("mean_change", 4) + 0.0).alias("mean_change"),
                        (F.round("std_change", 4) + 0.0).alias("std_change"))  # no negative zero


@query("completeness", CHANGED_SQL + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", (SELECT count("{c}") / count(*) FROM visits) AS share_original,
    (SELECT count("{c}") / count(*) FROM changed) AS share_output""" for c in COMPARED))
def completeness(spark, sf_dir):
    return utility.completeness(*_compared(spark, sf_dir), COMPARED)


@query("range_validation", CHANGED_SQL + " UNION ALL ".join([
    f"""SELECT '{c}' AS "column", count("{c}") AS cells, count(*) FILTER ("{c}" < (SELECT min("{c}") FROM visits)
    OR "{c}" > (SELECT max("{c}") FROM visits)) AS outside FROM changed""" for c in AMOUNTS] + [
    f"""SELECT '{c}', count("{c}"), count(*) FILTER ("{c}" IS NOT NULL AND "{c}" NOT IN (
    SELECT "{c}" FROM visits WHERE "{c}" IS NOT NULL)) FROM changed""" for c in ("MARITAL", "STATE")]))
def range_validation(spark, sf_dir):
    original, output = _compared(spark, sf_dir)
    numbers = utility.number_range_validation(original, output, AMOUNTS)
    return numbers.unionByName(utility.label_validation(original, output, ["MARITAL", "STATE"]))


CORR_PAIRS = [(a, b) for i, a in enumerate(AMOUNTS) for b in AMOUNTS[i + 1:]]


@query("correlation_preservation", CHANGED_SQL + " UNION ALL ".join(
    f"""SELECT '{a}' AS a, '{b}' AS b, (SELECT round(corr("{a}", "{b}"), 6) + 0.0 FROM visits) AS corr_original,
    (SELECT round(corr("{a}", "{b}"), 6) + 0.0 FROM changed) AS corr_output""" for a, b in CORR_PAIRS))
def correlation_preservation(spark, sf_dir):
    found = utility.correlation_preservation(*_compared(spark, sf_dir, AMOUNTS), AMOUNTS)
    return rounded(found.drop("change"), "corr_original", "corr_output")


# ---- series --------------------------------------------------------------------------

# A user is a run, an hour an epoch, and two kinds of event are the pair of values.
EVENTS_SQL = """WITH points AS (
  SELECT user_id AS run, date_diff('hour', TIMESTAMP '2024-01-01', date_trunc('hour', ts)) AS epoch,
    CASE WHEN event_type = 'click' THEN value END AS g, CASE WHEN event_type = 'view' THEN value END AS d FROM events
), rolled AS (SELECT run, epoch, round(avg(g), 6) + 0.0 AS g, round(avg(d), 6) + 0.0 AS d FROM points GROUP BY run, epoch)"""


def _rolled(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    hour = F.timestamp_diff("HOUR", F.lit("2024-01-01").cast("timestamp_ntz"), F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    points = events.select(
        F.col("user_id").alias("run"), hour.alias("epoch"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("g"),
        F.when(F.col("event_type") == "view", F.col("value")).alias("d"),
    )
    return rounded(series.rollup_series(points, "run", "epoch", ["g", "d"]), "g", "d")


@query("series_rollup", f"{EVENTS_SQL} SELECT run, epoch, g, d FROM rolled")
def series_rollup(spark, sf_dir):
    return _rolled(spark, sf_dir)


@query("series_latest", f"""{EVENTS_SQL} SELECT run, max(epoch) AS epoch, arg_max_null(g, epoch) AS g,
  arg_max_null(d, epoch) AS d FROM rolled GROUP BY run""")
def series_latest(spark, sf_dir):
    return series.latest_values(_rolled(spark, sf_dir), "run", "epoch", ["g", "d"])


@query("series_ratio", f"""{EVENTS_SQL} SELECT run, epoch, g, d, round(CASE WHEN d > 0 THEN g / d ELSE 0 END, 6) + 0.0 AS ratio,
  round(abs(g - d), 6) + 0.0 AS difference FROM rolled""")
def series_ratio(spark, sf_dir):
    return rounded(series.paired_ratio(_rolled(spark, sf_dir), "g", "d"), "ratio", "difference")


@query("history_json", f"""{EVENTS_SQL}, kept AS (SELECT epoch, avg(g) AS g, avg(d) AS d FROM rolled GROUP BY epoch
  HAVING avg(g) IS NOT NULL AND avg(d) IS NOT NULL)
SELECT CAST(row_number() OVER (ORDER BY epoch) - 1 AS INTEGER) AS position, CAST(epoch AS INTEGER) AS epochs, round(g, 5) + 0.0 AS g_losses,
  round(d, 5) + 0.0 AS d_losses FROM kept""")
def history_json(spark, sf_dir):
    """A training history, one object of parallel arrays, written as JSON and read again."""
    points = series.rollup_series(_rolled(spark, sf_dir), "epoch", "epoch", ["g", "d"]).select("epoch", "g", "d").dropna()
    rows = F.array_sort(F.collect_list(F.struct("epoch", "g", "d")))
    one = points.agg(rows.alias("r")).select(
        F.col("r.g").alias("g_losses"), F.col("r.d").alias("d_losses"), F.col("r.epoch").alias("epochs"))
    path = new_path(spark, "history")
    write_json(one, path)
    back = series.unnest_series(series.read_history(spark, path), ["epochs", "g_losses", "d_losses"])
    return back.select("position", "epochs", *[(F.round(c, 5) + 0.0).alias(c) for c in ("g_losses", "d_losses")])


@query("series_unnest", """SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS position,
  CAST(unnest(embedding) AS DOUBLE) AS embedding FROM embeddings""")
def series_unnest(spark, sf_dir):
    points = series.unnest_series(table(spark, sf_dir, "embeddings"), ["embedding"], ["vec_id"])
    return points.withColumn("embedding", F.col("embedding").cast("double"))
