"""Quality of documents: what a classifier says of the text, weighed with what its host and path are like.

A logistic model on counts of the text is fitted to a bounded sample of labelled rows. Its
log-odds, less those of the sample, are the evidence of the document alone. Hosts and paths within
hosts are summed by grouped aggregation: documents and expected good ones, where a label counts
as it is. How far sites differ is estimated from these sums, and sets how strongly a path is shrunk
to its host and a host to the corpus. Each document is set against what the others of its path and
host show, and evidence and site together give its probability of being good.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import NO_SPACE, let, sent_if_few, whole, words_of
from veilframe.session import written, written_and_counted

FEATURES = ("words", "word_length", "distinct_share", "symbols", "capitals", "figures", "marks", "line_repeats", "long_words")
SITE_ROW_BYTES = 300
LEAST_SHARE = 1e-4


@dataclass(frozen=True)
class Model:
    """`sample`: the most labelled rows that are fitted on. `cut`: the least probability of a kept document."""

    sample: int = 20_000
    steps: int = 40
    penalty: float = 0.01
    cut: float = 0.5
    seed: int = 5


def described(text: Column) -> dict[str, Column]:
    """Rates of the text, between zero and one or on a logarithm; an empty text has zeros."""
    def share(pattern: str, of: Column) -> Column:
        return F.length(F.regexp_replace(text, pattern, "")) / F.greatest(of, F.lit(1))

    def by_word(words: Column) -> Column:
        n = F.size(words)
        return F.struct(
            F.log1p(n.cast("double")).alias("words"),
            (F.length(F.array_join(words, "")) / F.greatest(n, F.lit(1)) / 10.0).alias("word_length"),
            (F.size(F.array_distinct(words)) / F.greatest(n, F.lit(1))).alias("distinct_share"),
            (F.size(F.filter(words, lambda w: F.length(w) > 20)) / F.greatest(n, F.lit(1))).alias("long_words"))

    def by_line(lines: Column) -> Column:
        return 1.0 - F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1))

    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NO_SPACE))
    of_words, n = let(words_of(text), by_word), F.length(text)
    return {
        "by_word": of_words, "line_repeats": F.when(n > 0, let(lines, by_line)).otherwise(0.0),
        "symbols": share(r"[^#*$%&|<>{}\[\]\\^~=_/]+", n), "capitals": share("[^A-Z]+", n), "figures": share("[^0-9]+", n), "marks": share("[^!?.,;:]+", n),
    }


def with_features(df: DataFrame, id_col: str, text_col: str, host_col: str, path_col: str) -> DataFrame:
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
                     F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"), whole(text_col).alias("text"))
    parts = rows.select("id", "host", "path", *[c.alias(n) for n, c in described(F.col("text")).items()])
    return parts.select("id", "host", "path", *[
        F.col(f"by_word.{n}" if n in ("words", "word_length", "distinct_share", "long_words") else n).cast("double").alias(n) for n in FEATURES])


def evidence(rows: DataFrame, model: Model) -> DataFrame:
    """The rows with `evidence`: log-odds of the text alone, zero where labels are of one kind or none."""
    draw = F.xxhash64("id", F.lit(model.seed))
    sample, _ = written_and_counted(
        rows.where("label IS NOT NULL").withColumn("draw", draw).orderBy("draw", *FEATURES).limit(model.sample).coalesce(1), "quality_sample")
    counted = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(counted) != {0.0, 1.0}:
        return rows.withColumn("evidence", F.lit(0.0))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    fit = LogisticRegression(maxIter=model.steps, regParam=model.penalty, featuresCol="features", labelCol="label").fit(assembler.transform(sample))
    prior = math.log(counted[1.0] / counted[0.0])
    log_odds = F.lit(float(fit.intercept) - prior)
    for name, weight in zip(FEATURES, fit.coefficients.toArray().tolist()):
        log_odds += F.lit(weight) * F.col(name)
    return rows.withColumn("evidence", log_odds)


def strength(groups: DataFrame, mean: Column) -> float:
    """How many documents of prior the groups (n, good) are worth around their means: the moments of a
    beta-binomial. Groups that differ no more than chance allows are worth very many."""
    rate, n = F.col("good") / F.col("n"), F.col("n").cast("double")
    sums = groups.select(n.alias("n"), (n * F.pow(rate - mean, 2)).alias("spread"), (mean * (1 - mean)).alias("chance")).agg(
        F.sum("spread"), F.avg("chance"), F.sum("n"), F.sum(F.col("n") * F.col("n")), F.count(F.lit(1))).first()
    spread, chance, total, squares, count = (float(x or 0) for x in sums)
    if count < 2 or chance <= 0 or total <= 0:
        return 1e6
    room = total - squares / total
    between = (spread - (count - 1) * chance) / room if room > 0 else 0.0
    return min(1e6, max(1.0, chance / between - 1)) if between > 0 else 1e6


def bounded(p: Column) -> Column:
    return F.greatest(F.lit(LEAST_SHARE), F.least(F.lit(1 - LEAST_SHARE), p))


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def chance(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-log_odds))


def quality_report(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                   path_col: str = "lang", label_id: str = "doc_id", label_col: str = "quality", model: Model = Model(),
                   sites: DataFrame | None = None) -> DataFrame:
    """One row a document: id, host, path, evidence, site (what its host and path give it, itself left
    out), probability, kept. `sites` (id, host, path; an id once) has the host and path of documents found elsewhere;
    they take the place of the document's own columns, and are joined to its counts, not to its text.

    Null texts count as empty, texts of any length are read whole; null hosts and paths count as empty names. Other
    columns are not looked at, whatever their names. A probability that equals the cut is kept. Labels other than 0 and 1, and null
    ones, count as none; a row with several labels takes the lowest. Without labels of both kinds the
    evidence is zero, and without any the probability is one half and the document kept. Rows that repeat
    an id are judged each. An empty table gives an empty report.
    """
    given = labels.select(F.col(label_id).alias("id"), F.col(label_col).cast("double").alias("label")).where(
        "id IS NOT NULL AND label IN (0.0, 1.0)").groupBy("id").agg(F.min("label").alias("label"))
    rows = with_features(df, id_col, text_col, host_col, path_col).join(given, "id", "left")
    if sites is not None:
        found = sites.toDF("id", "host_found", "path_found")
        rows = rows.join(found, "id", "left").withColumns({
            c: F.when(F.col("host_found").isNotNull(), F.coalesce(f"{c}_found", F.lit(""))).otherwise(F.col(c)) for c in ("host", "path")})
    rows = written(rows, "quality_features")
    judged = evidence(rows, model).select("id", "host", "path", "label", "evidence")
    base = rows.agg(F.avg("label")).first()[0]
    base = 0.5 if base is None else min(1 - LEAST_SHARE, max(LEAST_SHARE, float(base)))
    own = F.coalesce("label", chance(F.col("evidence") + math.log(base / (1 - base))))
    judged = written(judged.withColumn("own", own), "quality_evidence")

    paths = judged.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("own").alias("good"))
    paths, path_count = written_and_counted(paths, "quality_paths")
    hosts = written(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")), "quality_hosts")
    n, good = hosts.agg(F.sum("n"), F.sum("good")).first()
    mean = min(1 - LEAST_SHARE, max(LEAST_SHARE, float(good) / n)) if n else 0.5
    of_host = strength(hosts, F.lit(mean))
    shrunk = (F.col("host_good") + of_host * mean) / (F.col("host_n") + of_host)
    sites = paths.join(hosts.select("host", F.col("n").alias("host_n"), F.col("good").alias("host_good")), "host")
    of_path = strength(sites, bounded(shrunk))

    sites = sites.withColumnsRenamed({"host": "site_host", "path": "site_path"})
    joined = judged.join(sent_if_few(sites, path_count, SITE_ROW_BYTES),
                         (F.col("host") == F.col("site_host")) & (F.col("path") == F.col("site_path")))
    # What the other documents of the host, and then of the path, show.
    of_others = bounded((F.col("host_good") - F.col("own") + of_host * mean) / (F.col("host_n") - 1 + of_host))
    joined = joined.withColumn("of_host", of_others)
    site = bounded((F.col("good") - F.col("own") + of_path * F.col("of_host")) / (F.col("n") - 1 + of_path))
    joined = joined.withColumn("site", site).withColumn("probability", chance(F.col("evidence") + logit(F.col("site"))))
    return joined.select(F.col("id").alias(id_col), "host", "path", "evidence", "site", "probability",
                         (F.col("probability") >= model.cut).alias("kept"))
