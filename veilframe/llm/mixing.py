"""Mixing a corpus to target weights by iterative proportional fitting.

Tokens are summed per cell (source, language, topic), with partial aggregation, so a source with
a third of all rows leaves a few rows a task. Languages and topics are named in the targets, and
all others form one group each, so a source has a bounded number of cells and is kept as one row.
A sweep solves for the factor of each source, in Spark, and sums their weighted cells to one figure per
language and topic; those two margins are then raked on the driver, from these few figures. The
fitted factors give each document the probability of its cell, and a hash of its id decides.
Probabilities stop at one within the fit, so the margins are calibrated with that bound in place.
What a target wants beyond the tokens there are goes to the other shares of its margin beforehand.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import free_names, let, quoted, sent_if_few, whole, words_of
from veilframe.session import written, written_and_counted

FACTOR_ROW_BYTES = 200
MOST_FACTOR = 1e9
# Shares so near to all there is count as all.
NEARLY = 1 - 1e-9

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Targets:
    """Shares of tokens. `sources`: named shares, or an exponent that present shares are raised to.
    Languages and topics: named shares. What is not named keeps its present share, and the named
    ones share the rest; a named one without tokens is left out. `budget`: the share of all tokens
    that the drawn documents are expected to hold. Targets that want more tokens of something than
    there are take all of it, and the others of its margin share the rest as their targets do; the fit ends when
    sweeps no longer bring it nearer. `mixing_shares` tells what was asked for and what comes of it."""

    sources: Mapping[str, float] | float = 0.9
    languages: Mapping[str, float] = field(default_factory=dict)
    topics: Mapping[str, float] = field(default_factory=dict)
    budget: float = 0.7
    sweeps: int = 30
    tolerance: float = 1e-4
    seed: int = 7


@dataclass(frozen=True)
class Share:
    """Of a language or topic (None: those not named): the share as asked for, as tokens allow, and as expected."""

    margin: str
    name: str | None
    asked: float
    target: float
    expected: float


@dataclass(frozen=True)
class Fit:
    """`factors`: source and its factor. A cell's probability is the product of the three factors, at most one.
    `shares`: of languages and topics; `source_shares`: source, asked, target, expected. `error`: how far
    the expected shares of all three margins are from what tokens allow; `missed`: from what was asked for."""

    factors: DataFrame
    languages: list[float]
    topics: list[float]
    shares: list[Share]
    source_shares: DataFrame
    error: float
    missed: float


def place(value: Column, names: Mapping[str, float]) -> Column:
    """0 for what is not named, null too; else the place of the name, from one."""
    if not names:
        return F.lit(0)
    return F.coalesce(F.array_position(F.array(*[F.lit(n) for n in names]), value).cast("int"), F.lit(0))


def margin(present: list[float], names: Mapping[str, float]) -> list[float]:
    """Target shares by place, from present sums by place."""
    total = sum(present) or 1.0
    wanted = [0.0] + [max(0.0, s) if present[i + 1] > 0 else 0.0 for i, s in enumerate(names.values())]
    other, named = present[0] / total, sum(wanted)
    if not named:
        return [p / total for p in present]
    return [other] + [w / named * (1 - other) for w in wanted[1:]]


def allowed(shares: list[float], most: list[float]) -> tuple[list[float], list[bool]]:
    """The shares with none beyond the most there is of it, the others raised alike to fill up; and which are all there is."""
    full = [False] * len(shares)
    while True:
        wanted = sum(s for s, f in zip(shares, full) if not f)
        room = max(0.0, 1 - sum(m for m, f in zip(most, full) if f))
        scale = room / wanted if wanted > 0 else 0.0
        over = [not f and s > 0 and s * scale >= m * NEARLY for s, m, f in zip(shares, most, full)]
        if not any(over):
            return [m if f else s * scale for s, m, f in zip(shares, most, full)], full
        full = [f or o for f, o in zip(full, over)]


def raked(mass: float, sure: float, target: float) -> float:
    """What brings a sum nearer to its target: upwards, only the part that is not sure (of probability one) can grow."""
    if target > mass > sure:
        return (target - sure) / (mass - sure)
    return target / mass if mass > 0 else 0.0


def fitted(cells: DataFrame, targets: Targets) -> Fit:
    """`cells`: source, lang (place), topic (place), tokens; one row a cell."""
    lang_n, topic_n = len(targets.languages) + 1, len(targets.topics) + 1
    held = cells.groupBy("source").agg(
        F.sum("tokens").alias("tokens"), F.collect_list(F.struct("lang", "topic", "tokens")).alias("cells"))
    if isinstance(targets.sources, Mapping):
        spot = place(F.col("source"), targets.sources)
        present = {r[0]: float(r[1] or 0) for r in held.groupBy(spot.alias("p")).agg(F.sum("tokens")).collect()}
        shares = margin([present.get(i, 0.0) for i in range(len(targets.sources) + 1)], targets.sources)
        # Sources that are not named share theirs by their tokens.
        want = F.when(spot > 0, F.get(F.array(*[F.lit(s) for s in shares]), spot)).otherwise(
            shares[0] * F.col("tokens") / F.lit(present.get(0) or 1.0))
    else:
        want = F.pow(F.col("tokens").cast("double"), F.lit(float(targets.sources)))
    held = written(held.withColumn("want", F.when(F.col("tokens") > 0, want)), "mixing_sources")
    sums = held.agg(F.sum("want"), F.sum("tokens")).first()
    scale, total = float(sums[0] or 1.0), float(sums[1] or 1.0)
    budget = total * min(1.0, targets.budget)

    # The level that all sources together reach the budget at, where none gives more than it has.
    level, full = budget / scale, -1
    while True:
        over = F.col("want") * level >= F.col("tokens") * NEARLY
        seen = held.agg(F.sum(F.when(over, F.col("tokens"))), F.sum(F.when(~over, F.col("want"))), F.count_if(over)).first()
        if int(seen[2]) == full:
            break
        full = int(seen[2])
        level = max(0.0, budget - float(seen[0] or 0)) / float(seen[1]) if seen[1] else level
    goal = F.coalesce(F.least(F.col("tokens").cast("double"), F.col("want") * level), F.lit(0.0))

    present = {(r["lang"], r["topic"]): float(r["n"]) for r in cells.groupBy("lang", "topic").agg(F.sum("tokens").alias("n")).collect()}
    lang_held = [sum(present.get((i, k), 0.0) for k in range(topic_n)) for i in range(lang_n)]
    topic_held = [sum(present.get((i, k), 0.0) for i in range(lang_n)) for k in range(topic_n)]
    asked_langs, asked_topics = margin(lang_held, targets.languages), margin(topic_held, targets.topics)
    langs, all_langs = allowed(asked_langs, [n / budget for n in lang_held])
    topics, all_topics = allowed(asked_topics, [n / budget for n in topic_held])

    def factor(v: list[float], t: list[float]) -> Column:
        """Of a source: what brings its expected tokens to its goal, where no probability passes one. Those
        tokens are the least, over the cells of smallest weight that stay below one, of what they give
        with all others taken whole; so the factor is the greatest that any such split asks for."""
        weighed = F.array_sort(F.transform("cells", lambda c: F.struct(
            (F.get(listed(v), c["lang"]) * F.get(listed(t), c["topic"])).alias("a"), c["tokens"].cast("double").alias("n"))))

        def split(state: Column, c: Column) -> Column:
            n, rest = state["n"] + c["n"], state["rest"] + c["n"] * c["a"]
            asks = F.when(rest > 0, (goal - (F.col("tokens") - n)) / rest).otherwise(F.lit(0.0))
            return F.struct(n.alias("n"), rest.alias("rest"), F.greatest(state["u"], asks).alias("u"))

        start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("rest"), F.lit(0.0).alias("u"))
        return F.least(F.lit(MOST_FACTOR), F.aggregate(weighed, start, split, lambda state: state["u"]))

    def chance(v: list[float], t: list[float], cell: Column) -> Column:
        return F.least(F.lit(1.0), F.col("u") * F.get(listed(v), cell["lang"]) * F.get(listed(t), cell["topic"]))

    def with_mass(v: list[float], t: list[float]) -> DataFrame:
        mass = F.aggregate(F.transform("cells", lambda c: c["tokens"] * chance(v, t, c)), F.lit(0.0), lambda x, y: x + y)
        return held.withColumn("u", factor(v, t)).withColumn("mass", mass)

    # What is wanted whole starts, and stays, at the greatest factor: raking would come near to it but slowly.
    v = [MOST_FACTOR if f else 1.0 for f in all_langs]
    t = [MOST_FACTOR if f else 1.0 for f in all_topics]
    asked = F.coalesce(F.col("want") / scale, F.lit(0.0))
    best, least, stalled = None, float("inf"), 0
    for _ in range(max(1, targets.sweeps)):
        spread = with_mass(v, t).select(
            "u", F.explode("cells").alias("c"), (F.abs(F.col("mass") - goal) / budget).alias("off"),
            F.abs(F.col("mass") / budget - asked).alias("missed"))
        likely = chance(v, t, F.col("c"))
        rows = spread.groupBy("c.lang", "c.topic").agg(
            F.sum(F.col("c.tokens") * likely).alias("n"), F.sum(F.when(likely >= 1, F.col("c.tokens"))).alias("sure"),
            F.max("off").alias("off"), F.max("missed").alias("missed")).collect()
        share = {(r["lang"], r["topic"]): float(r["n"] or 0) / budget for r in rows}
        sure = {(r["lang"], r["topic"]): float(r["sure"] or 0) / budget for r in rows}

        def by_lang(sums: dict) -> list[float]:
            return [sum(sums.get((i, k), 0.0) for k in range(topic_n)) for i in range(lang_n)]

        def by_topic(sums: dict) -> list[float]:
            return [sum(sums.get((i, k), 0.0) for i in range(lang_n)) for k in range(topic_n)]

        of_lang, of_topic = by_lang(share), by_topic(share)
        error = max([abs(x - y) for x, y in zip(of_lang + of_topic, langs + topics)] + [r["off"] or 0.0 for r in rows])
        missed = max([abs(x - y) for x, y in zip(of_lang + of_topic, asked_langs + asked_topics)] + [r["missed"] or 0.0 for r in rows])
        stalled = 0 if error < 0.99 * least else stalled + 1
        if error < least:
            best, least = (v, t, of_lang, of_topic, error, missed), error
        if error < targets.tolerance or stalled == 3:
            break
        step = [raked(x, y, z) for x, y, z in zip(of_lang, by_lang(sure), langs)]
        v = [x if f else min(MOST_FACTOR, x * y) for x, y, f in zip(v, step, all_langs)]
        share = {(i, k): n * step[i] if step[i] < 1 else sure[i, k] + (n - sure[i, k]) * step[i] for (i, k), n in share.items()}
        sure = {key: min(n, share[key]) for key, n in sure.items()}
        step = [raked(x, y, z) for x, y, z in zip(by_topic(share), by_topic(sure), topics)]
        t = [x if f else min(MOST_FACTOR, x * y) for x, y, f in zip(t, step, all_topics)]
    v, t, of_lang, of_topic, error, missed = best
    named = [Share("language", *row) for row in zip([None, *targets.languages], asked_langs, langs, of_lang)]
    named += [Share("topic", *row) for row in zip([None, *targets.topics], asked_topics, topics, of_topic)]
    done = with_mass(v, t)
    by_source = done.select("source", asked.alias("asked"), (goal / budget).alias("target"), (F.col("mass") / budget).alias("expected"))
    return Fit(done.select("source", "u"), v, t, named, by_source, error, missed)


def listed(values: list[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


def form_of(tokens: Column) -> Column:
    """The documents have no topic of their own: the form, by length, stands in for it."""
    return F.when(tokens < 200, "brief").when(tokens < 2000, "article").otherwise("long")


def placed(df: DataFrame, targets: Targets, text_col: str, lang_col: str, source_col: str,
           topic_col: str | None, keep_text: bool, id_col: str | None = None) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """The rows with their tokens, topic and places, and the hash of texts without an id, written; the cells of
    these; names by meaning."""
    keys = ("tokens", "topic", "probability", "selected", "lang_place", "topic_place", "factor_source", "factor", "of_text")
    name = dict(zip(keys, free_names(df, *keys)))
    tokens = F.col(name["tokens"])
    rows = df.withColumn(name["tokens"], F.size(words_of(whole(text_col))).cast("long"))
    rows = rows.withColumn(name["topic"], F.col(topic_col) if topic_col else form_of(tokens))
    rows = rows.withColumns({name["lang_place"]: place(F.col(lang_col), targets.languages),
                             name["topic_place"]: place(F.col(name["topic"]), targets.topics)})
    if id_col is not None:
        rows = rows.withColumn(name["of_text"], F.when(F.col(id_col).isNull(), F.xxhash64(F.col(text_col), F.lit(targets.seed))))
    rows = written(rows if keep_text else rows.drop(text_col), "mixing_rows")
    cells = written(rows.groupBy(
        F.col(source_col).alias("source"), F.col(name["lang_place"]).alias("lang"), F.col(name["topic_place"]).alias("topic"),
    ).agg(F.sum(tokens).alias("tokens")), "mixing_cells")
    return rows, cells, name


def drawn(df: DataFrame, targets: Targets, id_col: str, text_col: str, lang_col: str, source_col: str,
          topic_col: str | None, keep_text: bool = True) -> tuple[DataFrame, dict[str, str]]:
    """The rows with their tokens, topic, probability and whether they are drawn; names by meaning.
    Shares that will not be as asked for are logged as a warning."""
    rows, cells, name = placed(df, targets, text_col, lang_col, source_col, topic_col, keep_text, id_col)
    fit = fitted(cells, targets)
    if fit.missed > targets.tolerance:
        log.warning("mixing: shares miss what was asked for by up to %.4f (sources included), what tokens allow by up to %.4f: %s", fit.missed, fit.error,
                    ", ".join(f"{s.margin} {s.name or '(not named)'} {s.expected:.4f} for {s.asked:.4f}" for s in fit.shares
                              if abs(s.expected - s.asked) > targets.tolerance))
    factors, count = written_and_counted(fit.factors.toDF(name["factor_source"], name["factor"]), "mixing_factors")
    joined = rows.join(sent_if_few(factors, count, FACTOR_ROW_BYTES),
                       F.col(source_col).eqNullSafe(F.col(name["factor_source"])), "left")
    chance = F.col(name["factor"]) * F.get(listed(fit.languages), F.col(name["lang_place"])) * F.get(listed(fit.topics), F.col(name["topic_place"]))
    own = F.xxhash64(F.col(id_col), F.lit(targets.seed))
    draw = F.shiftrightunsigned(F.when(F.col(id_col).isNotNull(), own).otherwise(F.col(name["of_text"])), 11) / F.lit(float(1 << 53))
    joined = joined.withColumn(name["probability"], F.least(F.lit(1.0), F.coalesce(chance, F.lit(0.0))))
    return joined.withColumn(name["selected"], draw < F.col(name["probability"])), name


def mixing_report(df: DataFrame, targets: Targets, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source", topic_col: str | None = None) -> DataFrame:
    """One row a document: id, source, language, topic, tokens, probability, selected.

    Null sources are one source; null languages and topics count among those not named. A text
    without words adds no tokens and is drawn with its cell's probability, and never where its
    source has no tokens. Rows that repeat an id share one draw, as do rows without an id that
    repeat a text.
    An empty table gives an empty report.
    """
    wanted = list(dict.fromkeys([id_col, text_col, lang_col, source_col, *([topic_col] if topic_col else [])]))
    rows, name = drawn(df.select(wanted), targets, id_col, text_col, lang_col, source_col, topic_col, keep_text=False)
    return rows.select(id_col, source_col, lang_col, F.col(name["topic"]).alias("topic"), F.col(name["tokens"]).alias("tokens"),
                       F.col(name["probability"]).alias("probability"), F.col(name["selected"]).alias("selected"))


def mixed(df: DataFrame, targets: Targets, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", topic_col: str | None = None) -> DataFrame:
    """The rows of `df` that are drawn, with its columns as they were."""
    rows, name = drawn(df, targets, id_col, text_col, lang_col, source_col, topic_col)
    return rows.where(F.col(name["selected"])).select(quoted(df.columns))


def mixing_shares(df: DataFrame, targets: Targets, text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source", topic_col: str | None = None) -> DataFrame:
    """One row a language, topic and source: margin, name, and its share of tokens as asked for, as the
    tokens there are allow (target), and as expected of the draw. A language or topic without a name is all those not named."""
    wanted = list(dict.fromkeys([text_col, lang_col, source_col, *([topic_col] if topic_col else [])]))
    _, cells, _ = placed(df.select(wanted), targets, text_col, lang_col, source_col, topic_col, keep_text=False)
    fit = fitted(cells, targets)
    named = df.sparkSession.createDataFrame(
        [(s.margin, s.name, s.asked, s.target, s.expected) for s in fit.shares],
        "margin string, name string, asked double, target double, expected double")
    return named.unionByName(fit.source_shares.select(
        F.lit("source").alias("margin"), F.col("source").cast("string").alias("name"), "asked", "target", "expected"))
