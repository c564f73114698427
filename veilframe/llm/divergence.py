"""How far the sources of a language differ in their words: duplicate texts are collapsed first.

Rows are grouped by language and digest of their text, so a text that fills a third of the table
leaves one row a task. How often each source has it is counted beside that, on narrow columns, and
each text is tokenized once, wherever it occurs: its terms then count by those multiplicities, for
the frequencies of documents as for those of terms. Of these weighted counts the pairs of sources
are worked out sparsely, in blocks of terms: a source against all others starts as if none of them
had a term of the block, in closed form by distinct shares, and only the terms they have are set right.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.llm.common import ascii_lower, whole
from veilframe.session import sent_if_small, written, written_and_sized

NO_LETTERS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCUMENTS = 3
TERMS_REPORTED = 200
# Counts of terms by source that one task compares: about as many as it returns pairs, within these bounds.
LEAST_ROWS, MOST_ROWS = 1 << 16, 1 << 20
SOURCES_AT_ONCE = 256  # sources that one task compares with all others of their language
CELLS_AT_ONCE = 1 << 20


def quotient(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(count: Column, total: Column) -> Column:
    """1 + floor(1000000000 * count / total) for 0 < count <= total. The division is done three digits
    at a time, so that totals up to 9e15 stay within longs."""
    digits, rest = F.lit(1).cast("long"), count.cast("long")
    for scale in (1_000_000, 1_000, 1):
        digits = digits + quotient(rest * 1000, total) * scale
        rest = (rest * 1000) % total
    return digits


def distance(p: Column, q: Column) -> Column:
    return quotient((p - q) * (p - q), q)


def numbered_sources(rows: DataFrame) -> tuple[DataFrame, int]:
    """lang, source and a number `id` that stands for both in wide work; written, and their bytes."""
    return written_and_sized(rows.select("lang", "source").distinct().withColumn("id", F.monotonically_increasing_id()), "divergence_groups")


def term_counts(df: DataFrame, lang_col: str, source_col: str, text_col: str) -> tuple[DataFrame, int, DataFrame]:
    """(lang, source, id) of all groups and their bytes, and (id, term, count, docs): how often the term occurs in
    the group and in how many of its rows. Each distinct text of a language is tokenized once."""
    lang, source, text = whole(lang_col), whole(source_col), whole(text_col)
    digest = F.unhex(F.sha2(text, 256))
    copies = written(df.groupBy(lang.alias("lang"), digest.alias("digest"), source.alias("source")).agg(
        F.count(F.lit(1)).alias("n")), "divergence_copies")
    groups, size = numbered_sources(copies)
    holders = copies.join(sent_if_small(groups, size), ["lang", "source"]).groupBy("lang", "digest").agg(
        F.collect_list(F.struct("id", "n")).alias("holders"))
    texts = df.groupBy(lang.alias("lang"), digest.alias("digest")).agg(F.any_value(text).alias("text"))
    tokens = texts.join(holders, ["lang", "digest"]).select(
        "holders", F.array_remove(F.split(ascii_lower(F.col("text")), NO_LETTERS), "").alias("tokens"))
    # Each text twice: all its words count occurrences, its distinct words count rows.
    twice = tokens.select(F.explode("holders").alias("h"), "tokens").select("h.id", "h.n", F.explode(F.array(
        F.struct(F.col("tokens"), F.lit(False).alias("once")), F.struct(F.array_distinct("tokens").alias("tokens"), F.lit(True).alias("once")))).alias("t"))
    terms = twice.select("id", "n", "t.once", F.explode("t.tokens").alias("term"))
    counted = terms.groupBy("id", "term").agg(
        F.sum(F.when(F.col("once"), 0).otherwise(F.col("n"))).alias("count"), F.sum(F.when(F.col("once"), F.col("n")).otherwise(0)).alias("docs"))
    return groups, size, counted


def kept_terms(counted: DataFrame, langs: DataFrame, least_documents: int) -> DataFrame:
    """The counts of terms that are in enough rows of their language, with the language's count and
    whether the row is the term's first. A window holds as many rows as a language has sources."""
    of_term = Window.partitionBy("lang", "term")
    kept = counted.join(langs, "id").withColumns({
        "in_lang": F.sum("docs").over(of_term), "lang_count": F.sum("count").over(of_term),
        "first": F.row_number().over(of_term.orderBy("id")) == 1})
    return kept.where(F.col("in_lang") >= least_documents).select("id", "term", "count", "lang_count", "first")


def compared(key, held: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """source, item, value: the distances of the sources marked `mine` from all sources of their
    language, summed over the terms of one block. `held` has the shares of the terms sources have;
    `absent` is a source's share of any other term."""
    sources = sources.sort_values("source")
    names, absent = sources["source"].to_numpy(), sources["absent"].to_numpy(np.int64)
    mine = np.flatnonzero(sources["mine"].to_numpy(bool))
    total = np.zeros((len(mine), len(names)), np.int64)
    if len(held):
        who = pd.Index(names).get_indexer(held["source"])
        order = np.argsort(who, kind="stable")
        who, p = who[order], held["p"].to_numpy(np.int64)[order]
        term = pd.factorize(held["term"])[0][order]
        first = np.searchsorted(who, np.arange(len(names) + 1))
        there = np.flatnonzero(first[1:] > first[:-1])
        levels, level = np.unique(absent, return_inverse=True)
        for row, s in enumerate(mine):
            own = np.full(int(term.max()) + 1, absent[s])
            own[term[first[s]:first[s + 1]]] = p[first[s]:first[s + 1]]
            # As if no other source had any of the terms: by distinct shares here and there.
            shares, times = np.unique(own, return_counts=True)
            none = np.zeros(len(levels), np.int64)
            for at in range(0, len(shares), step := max(1, CELLS_AT_ONCE // len(levels))):
                apart = shares[at:at + step, None] - levels[None, :]
                none += (apart * apart // levels * times[at:at + step, None]).sum(0)
            total[row] = none[level]
            # The terms that other sources have are set right.
            here, empty = own[term], absent[who]
            mend = (here - p) ** 2 // p - (here - empty) ** 2 // empty
            total[row, there] += np.add.reduceat(mend, first[there])
    a, b = np.nonzero(mine[:, None] != np.arange(len(names)))
    return pd.DataFrame({"lang": key[0], "source": names[mine[a]], "item": names[b], "value": total[a, b]})


def source_divergence(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                      least_documents: int = LEAST_DOCUMENTS, terms_reported: int = TERMS_REPORTED) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from each other source of its
    language (part 'pair'), and the terms it uses more than its language does (part 'term', the first
    `terms_reported` of them).

    Terms are runs of letters, A-Z lower-cased; a term counts if `least_documents` rows of the language have it. A
    share is 1 + floor(10^9 (count + 1) / (all + terms)), a distance the floor of the squared difference of
    two shares by the second; all whole numbers, exact. Null languages, sources and texts are empty ones, and
    form groups like others; empty texts have no terms, and a language without terms has distances of zero.
    Texts of any length count whole, repeated rows count each. Equal values rank by item in byte order. Columns
    besides the three are not read. An empty table gives an empty result.
    """
    df = df.select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    groups, size, counted = term_counts(df, "lang", "source", "text")
    kept = written(kept_terms(counted, sent_if_small(groups.select("id", "lang"), size), least_documents), "divergence_terms")
    by_source = kept.groupBy("id").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("rows"), F.sum(F.col("first").cast("long")).alias("v"))
    in_lang = Window.partitionBy("lang")
    held_by = F.count(F.lit(1)).over(in_lang)
    block_rows = F.least(F.lit(MOST_ROWS), F.greatest(F.lit(LEAST_ROWS), F.least(held_by, F.lit(SOURCES_AT_ONCE)) * held_by))
    sources = groups.join(by_source, "id", "left").na.fill(0, ["n", "rows", "v"]).select(
        "id", "lang", "source", "n", F.sum("n").over(in_lang).alias("lang_n"), F.sum("v").over(in_lang).alias("v"),
        F.ceil(F.sum("rows").over(in_lang) / block_rows).alias("blocks"), F.ceil(held_by / SOURCES_AT_ONCE).alias("chunks"))
    sources, size = written_and_sized(sources.withColumn("blocks", F.greatest("blocks", F.lit(1))), "divergence_sources")

    shares = kept.join(sent_if_small(sources, size), "id").withColumn("p", share(F.col("count") + 1, F.col("n") + F.col("v")))
    q = share(F.col("lang_count") + 1, F.col("lang_n") + F.col("v"))
    above = shares.withColumn("q", q).where("p > q").select(
        "lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = above.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= terms_reported)

    def all_of(name: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(name).cast("long") - 1))

    held = shares.select("lang", "source", "term", "p", "chunks", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block")).select(
        "lang", "source", "term", "p", "block", all_of("chunks").alias("chunk"))
    absent = F.when(F.col("v") > 0, share(F.lit(1), F.greatest(F.col("n") + F.col("v"), F.lit(1)))).otherwise(F.lit(1))
    against = sources.select(F.col("lang").alias("lang"), F.col("source").alias("source"), "chunks", absent.alias("absent"), all_of("blocks").alias("block")).select(
        "lang", "source", "absent", "block", "chunks", all_of("chunks").alias("chunk")).withColumn(
        "mine", F.pmod(F.xxhash64("source"), F.col("chunks")) == F.col("chunk")).drop("chunks")
    by = ["lang", "block", "chunk"]
    parts = held.groupBy(*by).cogroup(against.groupBy(*by)).applyInPandas(compared, "lang string, source string, item string, value long")
    pairs = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(ranked))

    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(terms.withColumn("part", F.lit("term")).select(columns))
