"""Same results whatever the partitions, buckets and hot keys."""

import pytest
from conftest import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from veilframe.operators import synth
from veilframe.operators.dictionary import NAMESPACES, apply_dictionary, build_dictionary
from veilframe.operators.ordering import dealt_by_range, following, numbered, running_before
from veilframe.session import drafts, shared_folder, written


def hot_rows(spark, rows=6000):
    """A third of the rows in one group, and ties in the first order column."""
    n = F.col("id")
    return spark.range(rows).select(
        n, F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (n % 41).cast("string"))).alias("g"),
        F.concat(F.lit("day"), (F.pmod(F.hash("id"), F.lit(5))).cast("string")).alias("day"),
        (F.pmod(F.hash("id"), F.lit(100))).cast("bigint").alias("w"),
    )


@pytest.mark.parametrize("rows_per_bucket", [37, 900, 1_000_000])
@pytest.mark.parametrize("group", [(), ("g",)])
def test_running_totals_equal_a_plain_window(spark, rows_per_bucket, group):
    table = written(hot_rows(spark), "t")
    window = Window.partitionBy(*group).orderBy("day", "id").rowsBetween(Window.unboundedPreceding, -1)
    expected = table.withColumn("b", F.coalesce(F.sum("w").over(window), F.lit(0)))
    got = running_before(table, ["day", "id"], {"b": F.col("w")}, group, rows_per_bucket)
    assert rows_of(got) == rows_of(expected)


def test_buckets_are_of_like_size(spark):
    """Also where one group and one day hold most rows: the split is on the whole order."""
    table = written(spark.range(20_000).select(F.lit("one").alias("g"), F.lit("day").alias("day"), "id"), "t")
    sizes = dealt_by_range(table, ["g", "day", "id"], 20_000, 1000).groupBy("_bucket").count().collect()
    assert len(sizes) > 10 and max(r["count"] for r in sizes) < 4000


def test_the_next_row_equals_a_plain_window(spark):
    table = written(hot_rows(spark), "t")
    window = Window.partitionBy("g").orderBy("day", "id")
    expected = table.withColumns({"d": F.lead("day").over(window), "i": F.lead("id").over(window)})
    assert rows_of(following(table, ["day", "id"], {"d": "day", "i": "id"}, ["g"], 50)) == rows_of(expected)


def test_many_draws_on_few_donors_are_cut(spark, monkeypatch):
    """The window of a hot cell is cut by draws: no part holds more than a few chunks."""
    monkeypatch.setattr(synth, "CHUNK", 500)
    donors = written(spark.range(20).select(F.lit("one").alias("g"), F.col("id").alias("w")), "t")
    asked = spark.range(10_000).select("id", F.lit("one").alias("g"))
    seen = []
    real = synth.Window.partitionBy

    class Spy(synth.Window):
        @staticmethod
        def partitionBy(*names):
            seen.append(names)
            return real(*names)

    monkeypatch.setattr(synth, "Window", Spy)
    got = synth.synthesise(donors, asked, "id", F.col("g"), ["w"], "1")
    assert got.count() == 10_000 and ("cell", "chunk", "part") in seen
    shares = [r["count"] for r in got.groupBy("w").count().collect()]
    assert len(shares) == 20 and min(shares) > 300


def test_drafts_are_deleted_at_the_end(spark):
    import os

    with drafts(spark):
        table = written(spark.range(5), "clear_text")
        place = table.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(place)
    assert not os.path.exists(os.path.dirname(place))


@pytest.mark.parametrize("partitions", [1, 8, 64])
def test_numbers_do_not_depend_on_partitions(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = hot_rows(spark).repartition(partitions, "day").select(
            F.col("id").alias("n"), F.col("g").alias("PATIENT"), F.reverse("g").alias("Id_patient"))
        spec = {"patients": NAMESPACES["patients"]}
        got = apply_dictionary(df, build_dictionary(df, "n", spec, rows_per_bucket=10), spec)
        assert got.where("n = 0").first().PATIENT == "Patient_0001"
        ids = got.groupBy("PATIENT").agg(F.min("n").alias("n")).orderBy("n").collect()
        assert [r.PATIENT for r in ids] == [f"Patient_{i + 1:04d}" for i in range(42)]
        assert got.count() == 6000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_batches_equal_one_shot(spark):
    df = hot_rows(spark).select(F.col("id").alias("n"), F.concat("g", F.col("w")).alias("PAYER"))
    spec = {"payers": NAMESPACES["payers"]}
    whole = build_dictionary(df, "n", spec)
    first = build_dictionary(df.where("n < 2500"), "n", spec, rows_per_bucket=50)
    second = build_dictionary(df.where("n >= 2500"), "n", spec, first, rows_per_bucket=50)
    assert rows_of(second) == rows_of(whole)
    assert second.select("pseudonym").distinct().count() == second.select("original").distinct().count()


def brute_draws(rows, seed, floor_rows):
    """The draw of each row, done by hand: sorted values of the cell, position by modulo."""
    import hashlib
    from collections import defaultdict

    cells = defaultdict(list)
    for r in rows:
        cells[r.g].append((r.day, r.w))
        cells["*"].append((r.day, r.w))
    for values in cells.values():
        values.sort()
    drawn = {}
    for r in rows:
        cell = cells[r.g] if len(cells[r.g]) >= floor_rows else cells["*"]
        number = int(hashlib.md5(f"{seed}|{r.id}".encode()).hexdigest()[:15], 16)
        drawn[r.id] = cell[number % len(cell)]
    return drawn


@pytest.mark.parametrize("chunk, rows_per_bucket, floor_rows", [(7, 40, 1), (100_000, 1_000_000, 101)])
def test_draws_equal_brute_force(spark, monkeypatch, chunk, rows_per_bucket, floor_rows):
    monkeypatch.setattr(synth, "CHUNK", chunk)
    df = written(hot_rows(spark), "t")
    got = synth.synthesise(df, df, "id", F.col("g"), ["day", "w"], "9", floor_rows,
                           rows_per_bucket=rows_per_bucket).collect()
    assert {r.id: (r.day, r.w) for r in got} == brute_draws(df.collect(), "9", floor_rows)
    assert len(got) == 6000


def test_conditions_nobody_shares_draw_from_everything(spark):
    donors = written(hot_rows(spark, 300), "t")
    asked = spark.range(1000, 1050).select("id", F.lit("new").alias("g"))
    got = synth.synthesise(donors, asked, "id", F.col("g"), ["w"], "1")
    assert got.count() == 50
    assert got.join(donors.select("w").distinct(), "w", "left_anti").count() == 0


def test_marginal_draws_keep_types_and_rows(spark):
    df = written(hot_rows(spark, 900).withColumn("w", F.when(F.col("w") > 9, F.col("w"))), "t")
    got = synth.synthesise(df, df, "id", F.col("g"), ["day", "w"], "3", mode="marginal")
    assert dict(got.dtypes) == {"id": "bigint", "day": "string", "w": "bigint"} and got.count() == 900
    assert got.join(df.select("g", "id"), "id").join(df.select("g", "day").distinct(), ["g", "day"], "left_anti").count() == 0


def test_a_cluster_must_name_its_shared_folder(spark):
    class Elsewhere:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError):
        shared_folder(Elsewhere())
    assert shared_folder(spark)


def test_number_helper(spark):
    table = written(spark.range(100), "t")
    assert {r.id: r.k for r in numbered(table, ["id"], "k", (), 9).collect()} == {i: i + 1 for i in range(100)}


@pytest.mark.parametrize("rows_per_bucket", [37, 1_000_000])
@pytest.mark.parametrize("group", [(), ("g",)])
def test_numbers_equal_a_plain_window_and_shuffle_once(spark, rows_per_bucket, group):
    table = written(hot_rows(spark), "t")
    expected = table.withColumn("k", F.row_number().over(Window.partitionBy(*group).orderBy("day", "id")).cast("bigint"))
    got = numbered(table, ["day", "id"], "k", group, rows_per_bucket)
    assert rows_of(got) == rows_of(expected)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan


def test_labels_are_padded_and_never_cut(spark):
    from veilframe.operators.dictionary import Namespace, numbered_entries

    keys = written(spark.range(1200).select(F.lit("n").alias("namespace"), F.col("id").cast("string").alias("original"),
                                            F.lit(0).alias("place"), F.col("id").alias("first_row")), "t")
    made = numbered_entries(keys, 1200, {"n": Namespace(("c",), "P_", 3)}, {"n": 5}).collect()
    assert {r.original: r.pseudonym for r in made} == {str(i): f"P_{i + 6:03d}" for i in range(1200)}


def test_trees_keep_pairs_and_replay_no_row(spark):
    """Pair shares stay near the source; a source row of its own kind comes back only by chance."""
    from collections import Counter

    from veilframe.operators import tree_synth

    rows = []
    for i in range(4_000):
        a = i % 8
        b = f"b{(a * 3 + (i // 8 % 10 == 0)) % 8}"  # follows a nine times in ten
        c = None if i // 80 % 7 == 0 else f"c{(int(b[1]) + (i // 560 % 5 == 0)) % 4}"
        rows.append((i, f"k{i % 3}", f"a{a}", b, c, 1_000.0 * a + i % 997))
    df = spark.createDataFrame(rows, "n bigint, k string, a string, b string, c string, cost double")
    bands = {"cost": 1_000.0}
    targets = ["a", "b", "c", "cost"]
    information = tree_synth.pair_information(df, {**tree_synth.codes(df, targets, bands), "*": df.k})
    tree = tree_synth.dependency_tree(information, targets)
    assert {frozenset(e) for e in tree} >= {frozenset(("a", "b")), frozenset(("b", "c"))}
    made = [tuple(r) for r in tree_synth.synthesise_tree(df, df, "n", df.k, targets, "1", bands).collect()]
    assert len(made) == len(rows) and all(isinstance(r[4], float) for r in made)
    for x, y in ((1, 2), (2, 3)):
        real, synthetic = (Counter((r[x], r[y]) for r in t) for t in ([r[:1] + r[2:] for r in rows], made))
        assert sum(abs(real[k] - synthetic[k]) for k in real | synthetic) / 2 < 0.06 * len(rows)
    own = {r[2:] for r in rows}
    # Each row is one of a kind; a draw of whole rows would give back 4,000 of them.
    assert len(own) == len(rows) and sum(r[1:] in own for r in made) < 0.5 * len(made)
    again = tree_synth.synthesise_tree(df.repartition(5), df, "n", df.k, targets, "1", bands)
    assert sorted(map(repr, (tuple(r) for r in again.collect()))) == sorted(map(repr, made))
    assert tree_synth.synthesise_tree(df, df.where("false"), "n", df.k, targets, "1", bands).count() == 0
