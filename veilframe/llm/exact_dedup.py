"""Exact duplicates: group by a 128-bit hash of the content, compare bytes, keep one row a group.

A pass writes each row beside the hash, the digest and the length of its text. Groups are then
found on narrow columns alone, with partial aggregation, so a group that holds a third of all
rows leaves one row a task. Texts of rows whose hash occurs twice or more are grouped by (hash,
text), again partially: the grouping compares bytes, and equal texts are folded before they
travel. Only a hash that stands for two different texts sends its rows down a path that joins
on the text itself.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import SPACE, free_names, quoted, sent_if_few, whole
from veilframe.session import written, written_and_counted

HASH_ROW_BYTES = 160


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def squeezed(text: Column) -> Column:
    """The text without its white space."""
    return F.regexp_replace(whole(text), f"{SPACE}+", "")


@dataclass(frozen=True)
class Duplicates:
    """`staged`: the rows given, with the columns `hash`, `digest`, `points` named below.
    `classes`: for each group of two rows or more: hash, digest, keep_id, keep_points, group_size."""

    staged: DataFrame
    classes: DataFrame
    class_count: int
    hash: str
    digest: str
    points: str


def find_duplicates(df: DataFrame, id_col: str, text_col: str,
                    normalise: Callable[[Column], Column] = squeezed,
                    hashed: Callable[[Column], Column] = content_hash) -> Duplicates:
    """Groups of rows whose normalised texts have the same bytes.

    Of a group the row with the most code points in its text stays, then the smallest id;
    a row without an id stays only where no row has one. Null texts count as empty, and empty
    texts form a group like any other. The hash may be weak: texts are compared as well.
    """
    h, digest, points, text = free_names(df, "text_hash", "text_digest", "text_points", "text_bare")
    staged = df.withColumn(text, normalise(F.col(text_col)))
    staged = staged.withColumns({
        h: hashed(F.col(text)), digest: F.sha2(F.col(text), 256),
        points: F.length(whole(text_col)).cast("long"),
    }).drop(text)
    staged = written(staged, "exact_dedup")

    def folded(rows: DataFrame, *by: str) -> DataFrame:
        best = F.min(F.struct((-F.col(points)).alias("p"), F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i")))
        out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
        return out.where("group_size > 1").select(
            *by, F.col("best.i").alias("keep_id"), (-F.col("best.p")).alias("keep_points"), "group_size")

    repeated, count = written_and_counted(folded(staged, h), "exact_groups")
    candidates = staged.select(id_col, text_col, h, digest, points).join(
        sent_if_few(repeated.select(h), count, HASH_ROW_BYTES), h, "left_semi")
    texts = candidates.select(h, normalise(F.col(text_col)).alias(text)).groupBy(h, text).count()
    split = texts.groupBy(h).agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select(h)
    split, collisions = written_and_counted(split, "exact_collisions")
    sure = repeated if not collisions else repeated.join(sent_if_few(split, collisions, HASH_ROW_BYTES), h, "left_anti")
    # Within a hash that is not shared by two texts, the digest is that of the one text.
    if collisions:
        rows = candidates.join(sent_if_few(split, collisions, HASH_ROW_BYTES), h, "left_semi")
        rows = rows.withColumn(text, normalise(F.col(text_col)))
        apart = folded(rows.select(id_col, h, text, digest, points), h, text, digest).drop(text)
        sure = sure.withColumn(digest, F.lit(None).cast("string")).select(apart.columns).unionByName(apart)
        sure, count = written_and_counted(sure, "exact_classes")
    else:
        sure = sure.withColumn(digest, F.lit(None).cast("string"))
    return Duplicates(staged, sure, count, h, digest, points)


def labelled(found: Duplicates, wanted: DataFrame) -> DataFrame:
    """`wanted` (rows of `found.staged`) with keep_id, keep_points and group_size of the class, null if alone.

    A class is met by its hash; where a hash stands for several texts, by the digest as well.
    """
    names = free_names(wanted, "class_hash", "class_digest", "class_keep_id", "class_keep_points", "class_size")
    classes = found.classes.select(
        *[F.col(c).alias(n) for c, n in zip([found.hash, found.digest, "keep_id", "keep_points", "group_size"], names)])
    same = (F.col(names[0]) == F.col(found.hash)) & (
        F.col(names[1]).isNull() | (F.col(names[1]) == F.col(found.digest)))
    joined = wanted.join(sent_if_few(classes, found.class_count, HASH_ROW_BYTES), same, "left")
    return joined.drop(names[0], names[1])


def duplicate_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row given: its id, the id that stays, the size of its group, whether it
    stays, and the SHA-256 of its normalised text.

    Rows that repeat an id are rows of the group like others: of those with the id that stays only the ones with
    the most code points do, and rows that repeat id and length share one verdict. An empty table gives an
    empty report.
    """
    found = find_duplicates(df.select(id_col, text_col), id_col, text_col)
    rows = labelled(found, found.staged.select(id_col, found.hash, found.digest, found.points))
    alone = F.col("class_size").isNull()
    keep = F.when(alone, F.col(id_col)).otherwise(F.col("class_keep_id"))
    stays = alone | (F.col(id_col).eqNullSafe(F.col("class_keep_id")) & (F.col(found.points) == F.col("class_keep_points")))
    return rows.select(
        F.col(id_col), keep.alias("keep_id"), F.coalesce("class_size", F.lit(1)).cast("long").alias("group_size"),
        stays.alias("kept"), F.col(found.digest).alias("text_sha256"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` that stay, with its columns as they were.

    One row of a group stays, also where several rows repeat its id and text.
    """
    found = find_duplicates(df, id_col, text_col)
    rows = labelled(found, found.staged)
    keep, points, size = free_names(found.staged, "class_keep_id", "class_keep_points", "class_size")
    alone = rows.where(F.col(size).isNull())
    kept = rows.where(F.col(size).isNotNull() & F.col(id_col).eqNullSafe(F.col(keep))
                      & (F.col(found.points) == F.col(points)))
    kept = kept.dropDuplicates([found.hash, found.digest])
    return alone.select(quoted(df.columns)).unionByName(kept.select(quoted(df.columns)))
