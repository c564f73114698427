"""URL filter: rules by host and path, and a list of URLs behind a blocked Bloom filter.

URLs are brought to a canonical form. The listed ones set bits of a filter that is built by
grouping: a hash picks one block of 512 bits, a second one seven bits in it, so a test touches
one cache line. The filter has a largest size; a list that is too long for it only lets more
candidates through. Candidates go to a hash join with the list on the whole canonical URL, which
removes the false ones; all other rows never meet the list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from veilframe.llm.common import ascii_lower, whole
from veilframe.session import written, written_and_counted

ALLOW, BLOCK = "allow", "block"
WORDS = 8  # of 64 bits in a block
BITS_SET = 7
BITS_PER_URL = 16
MOST_BLOCKS = 1 << 18  # 16 MiB
AUTHORITY = r"(?s)^.*?://([^/?#]*)([^?#]*)"
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def host_of(url: Column) -> Column:
    """What follows the first `://`, A-Z lower-cased; empty without one, or for null."""
    return ascii_lower(F.regexp_extract(whole(url), AUTHORITY, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(whole(url), AUTHORITY, 2)


def canonical(url: Column) -> Column:
    """Host and path and the parameters in order, without the scheme, `www.`, a default port, a
    slash at the end, tracking parameters and the fragment; empty without a host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    asked = F.regexp_extract(whole(url), r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(asked, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host == "", F.lit("")).otherwise(F.concat(host, F.regexp_replace(path_of(url), "/+$", ""), query))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest of a few rules (verdict, `host/path`) that fits, and its verdict; else null.

    A rule fits its host and all hosts below it, if the path starts with the rule's."""
    rule = verdict = None
    for says, text in sorted(rules, key=lambda r: len(r[1]), reverse=True):
        top, slash, rest = text.partition("/")
        fits = ((host == top) | F.endswith(host, F.lit(f".{top}"))) & F.startswith(path, F.lit(slash + rest))
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    nothing = F.lit(None).cast("string")
    return (nothing, nothing) if rule is None else (rule, verdict)


def hashes(url: Column) -> tuple[Column, Column]:
    return F.xxhash64(url), F.xxhash64(url, F.lit(1))


def bloom(listed: DataFrame, count: int) -> np.ndarray:
    """The filter of the URLs (one column, distinct): a row a block, a column a word."""
    blocks = min(MOST_BLOCKS, max(1, math.ceil(count * BITS_PER_URL / (64 * WORDS))))
    url = F.col(listed.columns[0])
    first, second = hashes(url)
    spots = F.array(*[F.shiftrightunsigned("second", 9 * k).bitwiseAND(F.lit(511)) for k in range(BITS_SET)])
    bits = listed.select(F.pmod(first, F.lit(blocks)).cast("int").alias("block"), second.alias("second")).select(
        "block", F.explode(spots).alias("spot"))
    words = bits.groupBy("block", F.shiftright("spot", 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("mask"))
    rows = words.toPandas()  # no more than the largest filter has words
    out = np.zeros((blocks, WORDS), np.int64)
    out[rows["block"].to_numpy(int), rows["word"].to_numpy(int)] = rows["mask"].to_numpy(np.int64)
    return out.view(np.uint64)


def may_hold(filter_: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    block = np.mod(first, len(filter_))
    second = second.view(np.uint64)
    found = np.ones(len(first), bool)
    for k in range(BITS_SET):
        spot = (second >> np.uint64(9 * k)) & np.uint64(511)
        found &= (filter_[block, (spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
    return found


def filtered(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]] = (), id_col: str = "page_id",
             url_col: str = "url") -> DataFrame:
    """One row a page: id, host, path, rule, verdict, canonical URL, and whether that is listed.

    `listed`: URLs in its first column. The verdict is the rule's; without one, `block` for listed
    URLs and `allow` for others. Null URLs and those without `://` have empty host, path and
    canonical form, are never listed and so allowed. Repeated rows are judged alike; an empty table
    of pages gives an empty result, an empty list blocks nothing.
    """
    spark: SparkSession = pages.sparkSession
    held, count = written_and_counted(
        listed.select(canonical(F.col(listed.columns[0])).alias("url")).where("url <> ''").distinct(), "url_list")
    sent = spark.sparkContext.broadcast(bloom(held, count))

    @pandas_udf("boolean")
    def maybe(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for first, second in batches:
            yield pd.Series(may_hold(sent.value, first.to_numpy(np.int64), second.to_numpy(np.int64)))

    url = F.col("url")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).select(
        "id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    first, second = hashes(F.col("canonical"))
    rows = written(rows.select("*", rule.alias("rule"), verdict.alias("says"), maybe(first, second).alias("maybe")), "url_rows")
    other = rows.where(~F.col("maybe")).withColumn("listed", F.lit(False))
    exact = held.select(F.col("url").alias("canonical"), F.lit(True).alias("found")).hint("shuffle_hash")
    hits = rows.where("maybe").join(exact, "canonical", "left").withColumn("listed", F.coalesce("found", F.lit(False)))
    judged = other.unionByName(hits.select(other.columns))
    otherwise = F.when(F.col("listed"), BLOCK).otherwise(ALLOW)
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("says", otherwise).alias("verdict"),
                         "canonical", "listed")
