"""How well a table hides its rows, and whether a job left anything behind."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe import fixed_values as fixed
from veilframe.functions.guards import is_missing, key_text
from veilframe.operators.ordering import following, running_before
from veilframe.operators.profile import one_row_per_column
from veilframe.plans.policy import present_columns
from veilframe.session import BROADCAST_BYTES, sent_if_small, written, written_and_counted, written_and_sized


def k_anonymity(df: DataFrame, quasi: Sequence[str], k: int) -> DataFrame:
    """smallest_class, classes, rows_below_k, classes_below_k over the quasi-identifiers."""
    classes = df.groupBy(*quasi).agg(F.count(F.lit(1)).alias("size"))
    below = F.col("size") < k
    return classes.agg(
        F.min("size").alias("smallest_class"),
        F.count(F.lit(1)).alias("classes"),
        F.coalesce(F.sum(F.when(below, F.col("size"))), F.lit(0)).alias("rows_below_k"),
        F.count_if(below).alias("classes_below_k"),
    )


def l_diversity(df: DataFrame, quasi: Sequence[str], sensitive: str, l: int) -> DataFrame:
    """Distinct sensitive values per class: least_values, classes, classes_below_l.

    Rows are first reduced to (class, value), so a class that holds a third of the
    rows arrives as its distinct values only.
    """
    values = df.groupBy(*quasi, sensitive).agg(F.lit(1))
    classes = values.groupBy(*quasi).agg(F.count(sensitive).alias("n"))
    return classes.agg(
        F.min("n").alias("least_values"),
        F.count(F.lit(1)).alias("classes"),
        F.count_if(F.col("n") < l).alias("classes_below_l"),
    )


def t_closeness(df: DataFrame, quasi: Sequence[str], sensitive: str) -> DataFrame:
    """worst_distance, mean_distance, classes: half the summed difference between the
    shares of the sensitive values in a class and in the whole table.

    Values a class lacks add their whole-table share, which is what the values it has
    leave of 1; no grid of classes by values is needed. The rows are counted once, into
    (class, value), and everything else works on the counts.
    """
    named = [F.col(f"`{q}`").alias(f"_q{i}") for i, q in enumerate(quasi)]
    classes = [f"_q{i}" for i in range(len(named))]
    cells = df.groupBy(*named, F.col(f"`{sensitive}`").alias("_v")).agg(F.count(F.lit(1)).alias("n"))
    cells = written(cells, "class_values")
    rows = cells.agg(F.sum("n").alias("rows")).scalar()

    def total(keys, name):
        return cells.groupBy(*[F.col(k).alias(f"{k}_") for k in keys]).agg(F.sum("n").alias(name))

    def same(keys):
        return reduce(and_, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys])

    shares = cells.join(total(classes, "n_class"), same(classes)).join(total(["_v"], "n_value"), same(["_v"]))
    p, q = F.col("n") / F.col("n_class"), F.col("n_value") / rows
    distance = shares.groupBy(*classes).agg(((F.sum(F.abs(p - q) - q) + 1) / 2).alias("d"))
    return distance.agg(
        F.max("d").alias("worst_distance"), F.avg("d").alias("mean_distance"),
        F.count(F.lit(1)).alias("classes"),
    )


def t_closeness_ordered(
    df: DataFrame, quasi: Sequence[str], sensitive: str, cuts: Sequence[float]
) -> DataFrame:
    """worst_distance, mean_distance, classes for a number, over the bands between `cuts`.

    The distance is the mean difference of the cumulative shares. A class is reduced to
    one counter per band; rows without a number are left out.
    """
    value = F.col(f"`{sensitive}`").cast("double")
    known = df.where(value.isNotNull())
    # at_or_below_i counts the rows of the first i + 1 bands.
    reached = [F.count_if(value < cut) for cut in cuts]
    classes = known.groupBy(*quasi).agg(
        F.count(F.lit(1)).alias("size"), *[c.alias(f"at_{i}") for i, c in enumerate(reached)]
    )
    whole = known.agg(
        F.array(*[c / F.count(F.lit(1)) for c in reached]).alias("shares")
    ).scalar()
    apart = [F.abs(F.col(f"at_{i}") / F.col("size") - F.get(whole, F.lit(i))) for i in range(len(cuts))]
    distance = classes.select((sum(apart[1:], apart[0]) / len(cuts)).alias("d"))
    return distance.agg(
        F.max("d").alias("worst_distance"), F.avg("d").alias("mean_distance"),
        F.count(F.lit(1)).alias("classes"),
    )


def t_closeness_every_value(df: DataFrame, quasi: Sequence[str], sensitive: str) -> DataFrame:
    """worst_distance, mean_distance, classes for a number, over all the values it takes.

    The distance is the mean difference of the cumulative shares at each distinct value but the
    last. The share of a class stands still between two of its own values, while that of the table
    rises, so a stretch is summed from the rank and the running sum of the table's shares at both
    its ends and where they pass the share of the class. No grid of classes by values is made, and
    the table's values are ranked by ranges. Rows without a number are left out.
    """
    value = F.col(f"`{sensitive}`").cast("double")
    named = [F.col(f"`{q}`").alias(f"_q{i}") for i, q in enumerate(quasi)]
    classes = [f"_q{i}" for i in range(len(named))]
    cells = df.where(value.isNotNull()).groupBy(*named, value.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    cells = cells.withColumn("class", F.xxhash64(*classes) if classes else F.lit(0).cast("bigint"))
    cells = written(cells.withColumn("class", F.struct("class", *classes)), "class_values")
    values, count = written_and_counted(cells.groupBy("v").agg(F.sum("n").alias("n")), "values")
    if count < 2:
        one = cells.select("class").distinct().agg(F.count(F.lit(1)).alias("classes"))
        zero = F.when(F.col("classes") > 0, F.lit(0.0))
        return one.select(zero.alias("worst_distance"), zero.alias("mean_distance"), "classes")
    total = values.agg(F.sum("n")).first()[0]
    ranked = running_before(values, ["v"], {"rank": F.lit(1), "before": F.col("n")}, (), rows=count)
    # At the value of a rank (from 0): rows up to it, and the sum of such counts over the ranks before it.
    steps = written(ranked.select("v", "rank", (F.col("before") + F.col("n")).cast("decimal(38,0)").alias("upto")), "steps")
    table_steps = written(running_before(steps, ["v"], {"sum_before": F.col("upto")}, (), rows=count), "steps")

    # Each value of a class: the rows of the class up to it, and the next value's rank or the last rank.
    sized = cells.groupBy("class").agg(F.sum("n").alias("size"))
    placed = cells.select("class", "v", "n").join(table_steps.select("v", "rank", "sum_before"), "v")
    placed, rows = written_and_counted(placed, "class_steps")
    run = running_before(placed, ["v"], {"below": F.col("n")}, ["class"], rows=rows)
    run = following(written(run, "class_steps"), ["v"], {"next_rank": "rank", "next_sum": "sum_before"}, ["class"], rows=rows)
    stretch = run.join(sized, "class").select(
        "class", "size", "rank", "sum_before", (F.col("below") + F.col("n")).alias("reached"), "next_rank", "next_sum")
    end = table_steps.where(F.col("rank") == count - 1).select(F.col("sum_before").alias("s")).first()[0]
    stretch = stretch.withColumns({"next_rank": F.coalesce("next_rank", F.lit(count - 1)), "next_sum": F.coalesce("next_sum", F.lit(end))})
    stretch = written(stretch.withColumn("level", (F.col("reached").cast("decimal(38,10)") * total / F.col("size")).cast("double")), "stretches")

    # Where the table passes each level: how many of its steps are below, and their sum.
    levels = stretch.select("level").distinct().select(F.col("level").alias("at"), F.lit(0).alias("one"), F.lit(0).cast("decimal(38,0)").alias("upto"), F.lit(0).alias("side"))
    both = levels.unionByName(steps.select(F.col("upto").cast("double").alias("at"), F.lit(1).alias("one"), "upto", F.lit(1).alias("side")))
    both, lines = written_and_counted(both, "levels")
    passed = running_before(both, ["at", "side"], {"cross": F.col("one"), "cross_sum": F.col("upto")}, (), rows=lines).where("side = 0")
    joined = stretch.join(passed.select(F.col("at").alias("level"), "cross", "cross_sum"), "level")
    at = F.greatest(F.col("rank"), F.least(F.col("cross"), F.col("next_rank")))
    at_sum = F.when(F.col("cross") <= F.col("rank"), F.col("sum_before")).when(
        F.col("cross") >= F.col("next_rank"), F.col("next_sum")).otherwise(F.col("cross_sum")).cast("double")
    apart = F.col("level") * (2 * at - F.col("rank") - F.col("next_rank")) - 2 * at_sum + F.col("sum_before").cast("double") + F.col("next_sum").cast("double")
    distance = joined.groupBy("class").agg(
        ((F.sum(apart) + F.min("sum_before").cast("double")) / total / (count - 1)).alias("d"))  # before its first value a class has nothing
    return distance.agg(
        F.max("d").alias("worst_distance"), F.avg("d").alias("mean_distance"),
        F.count(F.lit(1)).alias("classes"),
    )


def referential_integrity(pairs: DataFrame) -> DataFrame:
    """Per namespace of (namespace, original, pseudonym): distinct pairs, originals with
    several pseudonyms, pseudonyms with several originals."""
    distinct = written(pairs.select("namespace", "original", "pseudonym").distinct(), "pairs")

    def several(side):
        return (
            distinct.groupBy("namespace", side).agg(F.count(F.lit(1)).alias("n"))
            .groupBy("namespace")
            .agg(F.count_if(F.col("n") > 1).alias(f"split_{side}s"), F.sum("n").alias("pairs"))
        )

    merged = several("pseudonym").drop("pairs")
    return several("original").join(merged, "namespace").select(
        "namespace", "pairs", "split_originals", "split_pseudonyms"
    )


def column_pairs(original: DataFrame, output: DataFrame, row_key: str, columns: Mapping[str, str]) -> DataFrame:
    """(namespace, original, pseudonym) of every row and key column, joined on the row key."""
    before = original.select(row_key, *[key_text(original, c).alias(f"_o_{c}") for c in columns])
    both = before.join(output.select(row_key, *columns), row_key)
    each = [
        F.struct(
            F.lit(n).alias("namespace"), F.col(f"_o_{c}").alias("original"),
            F.col(f"`{c}`").alias("pseudonym"),
        )
        for c, n in columns.items()
    ]
    pairs = both.select(F.explode(F.array(*each)).alias("p")).select("p.*")
    return pairs.where(~is_missing(F.col("original")))


def residual_identifiers(
    original: DataFrame, output: DataFrame, key_columns: Sequence[str],
    identifiers: Sequence[str] = fixed.DIRECT_IDENTIFIERS, placeholder: str = fixed.UNKNOWN,
) -> DataFrame:
    """Per key column: distinct output values, and how many of them are original keys;
    `identifier_columns_left` counts direct identifiers the output still has."""
    def keys(df, *more):
        there = present_columns(key_columns, df)
        cells = [F.struct(F.lit(c).alias("column"), key_text(df, c).alias("value")) for c in there]
        long = df.select(F.explode(F.array(*cells)).alias("c")).select(*more, F.col("c.value").alias("value"))
        return long.where(~is_missing(F.col("value")) & (F.col("value") != placeholder)).distinct()

    known = keys(original).withColumn("known", F.lit(1))
    found = keys(output, F.col("c.column").alias("column")).join(known, "value", "left")
    return found.groupBy("column").agg(
        F.count(F.lit(1)).alias("distinct_values"), F.count("known").alias("original_keys_left")
    ).withColumn(
        "identifier_columns_left", F.lit(len(present_columns(identifiers, output))).cast("bigint")
    )


WORD_GAP = r"[^\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), WORD_GAP), "")


def key_phrases(originals: DataFrame) -> DataFrame:
    """namespace, phrase, size: the originals as runs of words, whatever stands between the words."""
    words = originals.where(~is_missing(F.col("original"))).select("namespace", _words(F.col("original")).alias("words"))
    return words.where(F.size("words") > 0).select("namespace", F.array_join("words", " ").alias("phrase"), F.size("words").alias("size")).distinct()


def originals_in_texts(
    df: DataFrame, originals: DataFrame, columns: Sequence[str] | None = None, sent_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """column, namespace, cells, originals: in how many cells of each text column stand originals of a
    namespace (namespace, original), and how many different ones.

    Cells and originals are compared word by word, without regard to case and to what stands between words, so
    an original of any number of words is found inside any text. Every run of words as long as some original
    is looked up; equal ones of a cell once. Without `columns` all text columns are searched. Null and empty cells
    and originals match nothing; a column without any original has no row. Originals up to `sent_bytes` go to
    every executor, more are joined by a shuffle of the runs.
    """
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    columns = [c for c in (texts if columns is None else columns) if c in texts]
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, namespace string, cells bigint, originals bigint")
    known, size = written_and_sized(key_phrases(originals), "key_phrases")
    # How many words originals have: a few numbers.
    sizes = [r[0] for r in known.select("size").distinct().orderBy("size").collect()]
    cells = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("text")) for c in columns])).alias("c")).select("c.*")
    cells = cells.where(F.col("text").isNotNull()).withColumn("cell", F.monotonically_increasing_id())
    words = cells.select("column", "cell", _words(F.col("text")).alias("words"))

    def runs(n: int) -> Column:
        if n == 1:
            return F.array_distinct("words")
        made = F.transform(F.sequence(F.lit(1), F.size("words") - n + 1), lambda i: F.array_join(F.slice("words", i, n), " "))
        return F.when(F.size("words") >= n, F.array_distinct(made)).otherwise(F.array().cast("array<string>"))

    each = F.flatten(F.array(*[runs(n) for n in sizes])) if sizes else F.array().cast("array<string>")
    found = words.select("column", "cell", F.explode(each).alias("phrase")).join(sent_if_small(known, size, sent_bytes), "phrase")
    return found.groupBy("column", "namespace").agg(
        F.count_distinct("cell").alias("cells"), F.count_distinct("phrase").alias("originals"))


def date_precision(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per date column: cells, and cells that say more than a year."""
    return one_row_per_column(
        df, present_columns(columns, df),
        {
            "cells": lambda c: F.count(c),
            "finer_than_year": lambda c: F.count_if(~c.cast("string").rlike("^[0-9]{4}$")),
        },
    )
