"""Personal data: base patterns, wider generators, and boosted trees that choose among what these propose.

All of it is built-in expressions. Matches of a pattern come from the row alone: the text is split
by the pattern, and the lengths of gaps and matches give every place. Base matches that pass their
checks always stay. Generators of high recall propose further spans, which may overlap them and each
other. Every proposal gets features of its form and its surroundings.

What the base patterns miss has no labels of its own, so these are made: every base span is rewritten in its own
surroundings into a form that the base patterns do not match ("name (at) host", figures with dots, a card beside
another number), and into a lookalike of that form that is none (a price, a wrong check digit, a date).
Gradient-boosted trees are fitted on a bounded sample of these and of the real proposals that the base patterns
confirm or whose form rules them out. Real ones of the right form that the base patterns do not match
have no known label and are what the trees decide. The score from which a kind is redacted is
calibrated by precision on all rewritten spans, lookalikes and ruled-out proposals outside the fit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import let, whole
from veilframe.session import written, written_and_counted

KINDS = ("email", "ip", "card", "phone")

# The base patterns. Possessive and bounded forms match the same spans as the plain ones and take
# linear time: a try that fails at the start of a run of its characters fails within it as well.
LOCAL = r"A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

# The generators: addresses with a written or spaced "at", and runs of figures in any grouping.
# A block of figures beside others is proposed by itself as well, as the run around it may be too long for a card.
WIDE_EMAIL = rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++(?:\x20?(?:@|\(at\)|\[at\])\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]++)++"
WIDE_NUMBER = r"[0-9+(](?=[0-9().\x20/-]{5})(?:[().\x20/-]{0,8}+[0-9])++"
BLOCK_NUMBER = r"(?<=[0-9][\x20./-])[0-9]{13,19}(?![0-9])|(?<![0-9])[0-9]{13,19}(?=[\x20./-][0-9])"
SPACED_IP = r"^0*[0-9]{1,3}(?:\x20?\.\x20?0*[0-9]{1,3}){3}$"
LEAST_LENGTH = 7

BEFORE, AFTER = 24, 8
BLOCK = 128
CUES = {"cue_phone": "tel|phone|call|fax|mobil|cell", "cue_card": "card|visa|credit|karte|tarjeta|carte", "cue_mail": "mail|contact|write",
        "cue_net": r"\bip\b|host|server|addr", "cue_code": r"id|ref|no\.|key|token|version|isbn"}
FEATURES = ("is_email", "is_ip", "is_card", "is_phone", "length", "digits", "letters", "groups", "dots", "dashes", "spaces",
            "parens", "slashes", "plus_first", "at_sign", "host_name", "luhn", "octets", "joined_before", "joined_after", *CUES)


@dataclass(frozen=True)
class Choice:
    """`sample`: the most labelled proposals that are fitted on, of all kinds together; the others are held out. `leaf`: the fewest in
    a leaf of a tree, so that a rare form is judged by those like it and not by its own label. `precision`: what a score has to
    reach among held-out labelled proposals of its kind, of which `support` at least score as high; a kind with fewer takes
    the limit of all kinds together."""

    sample: int = 20_000
    trees: int = 10
    depth: int = 4
    leaf: int = 20
    precision: float = 0.99
    support: int = 20
    seed: int = 11


def found(text: Column, pattern: str) -> Column:
    """start, end (code points, end exclusive), match, and the text right before and after, leftmost first.

    Places are running sums of lengths, by blocks, so many matches in one text stay cheap.
    """
    def of(gaps: Column) -> Column:
        def spans(matches: Column) -> Column:
            sizes = F.transform(matches, lambda m, i: F.length(F.get(gaps, i)) + F.when(i > 0, F.length(F.get(matches, i - 1))).otherwise(0))

            def placed(sizes: Column) -> Column:
                def total(part: Column) -> Column:
                    return F.aggregate(part, F.lit(0), lambda x, y: x + y)

                blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int")),
                                     lambda b: total(F.slice(sizes, b * BLOCK + 1, BLOCK)))

                def summed(blocks: Column) -> Column:
                    befores = F.transform(blocks, lambda _, b: total(F.slice(blocks, F.lit(1), b)))

                    def each(befores: Column) -> Column:
                        def one(m: Column, i: Column) -> Column:
                            block = F.floor(i / BLOCK).cast("int")
                            start = F.get(befores, block) + total(F.slice(sizes, block * BLOCK + 1, i - block * BLOCK + 1))
                            return F.struct(
                                start.alias("start"), (start + F.length(m)).alias("end"), m.alias("match"),
                                F.right(F.get(gaps, i), F.lit(BEFORE)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(AFTER)).alias("after"))

                        return F.transform(matches, one)

                    return let(befores, each)

                return let(blocks, summed)

            return F.when(F.size(matches) > 0, let(sizes, placed))

        return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)

    return let(F.split(text, pattern, -1), of)


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """Whether the digits, every second from the right doubled, add up to a multiple of ten."""
    def of(d: Column) -> Column:
        def value(i: Column) -> Column:
            v = F.substring(d, -i, F.lit(1)).cast("int")
            return F.when(i % 2 == 1, v).when(v > 4, 2 * v - 9).otherwise(2 * v)

        places = F.sequence(F.lit(1), F.least(F.length(d), F.lit(40)))
        return F.aggregate(F.transform(places, value), F.lit(0), lambda x, y: x + y) % 10 == 0

    return F.when(F.length(digits(match)) > 0, let(digits(match), of)).otherwise(F.lit(False))


def base_spans(text: Column) -> dict[str, Column]:
    """The base matches of each kind that pass the checks of the kind; null where there are none."""
    def kept(pattern: str, needs: str, check) -> Column:
        spans = F.when(text.contains(needs) if needs else F.lit(True), found(text, pattern))
        return spans if check is None else F.filter(spans, lambda s: check(s["match"]))

    return {
        "email": kept(EMAIL, "@", None),
        "ip": kept(IP, ".", lambda m: m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")),
        "card": kept(CARD, "", lambda m: F.length(digits(m)).between(14, 19) & luhn(m)),
        "phone": kept(PHONE, "+", lambda m: F.length(digits(m)).between(10, 15)),
    }


def count_of(text: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{chars}]", ""))


def features(kind: Column, s: Column) -> dict[str, Column]:
    """Numbers that describe a proposal: its form, and what stands around it."""
    match, before, after = s["match"], F.lower(s["before"]), s["after"]
    out = {f"is_{k}": kind == k for k in KINDS}
    out |= {
        "length": F.length(match), "digits": count_of(match, "0-9"), "letters": count_of(match, "A-Za-z"),
        "groups": F.size(F.regexp_extract_all(match, F.lit("[0-9]+"), F.lit(0))), "dots": count_of(match, "."),
        "dashes": count_of(match, "-"), "spaces": count_of(match, r"\x20"), "parens": count_of(match, "()"),
        "slashes": count_of(match, "/"), "plus_first": match.startswith("+"), "at_sign": match.contains("@"),
        "host_name": match.rlike("[A-Za-z]{2,}$"), "luhn": luhn(match),
        "octets": match.rlike(rf"^{OCTET}(?:\x20?\.\x20?{OCTET}){{3}}$"),
        "joined_before": before.rlike(r"[\p{L}\p{N}_.]$"), "joined_after": after.rlike(r"^[\p{L}\p{N}_]"),
    }
    out |= {name: before.rlike(words) for name, words in CUES.items()}
    return {n: out[n].cast("double") for n in FEATURES}


def right_form() -> Column:
    """Whether proposals (with their features) have the form of their kind. Where the base patterns do
    not match such a one, it is neither confirmed nor ruled out."""
    return F.expr("""CASE kind WHEN 'email' THEN host_name = 1 WHEN 'ip' THEN octets = 1
        WHEN 'card' THEN digits BETWEEN 13 AND 19 AND luhn = 1
        ELSE digits BETWEEN 9 AND 17 AND joined_before = 0 AND joined_after = 0 AND (plus_first = 1 OR groups >= 2) END""")


def rewritten(kind: Column, match: Column, pick: Column) -> tuple[Column, Column]:
    """Arrays of (form, size) by which a base match may be written, of which `pick` takes one: its own, and a
    lookalike's. The first `size` characters of a form are the span, null for all of it."""
    local, host, d = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1), digits(match)

    def fours(figures: Column, between: str) -> Column:
        return F.regexp_replace(figures, "([0-9]{4})(?=[0-9])", f"$1{between}")

    def one(*forms: Column) -> Column:
        return F.get(F.array(*[f if f is None else F.struct(f.alias("form"), F.length(f).alias("size")) for f in forms]),
                     F.pmod(pick, F.lit(len(forms))).cast("int"))

    def beside(figures: Column) -> Column:
        return F.struct(F.concat(figures, F.lit(" "), F.reverse(figures)).alias("form"), F.length(figures).alias("size"))

    def card(figures: Column) -> Column:
        return F.when(F.pmod(pick, F.lit(4)) == 3, beside(figures)).otherwise(
            one(fours(figures, "."), fours(figures, "/"), fours(figures, "  "), fours(figures, " - ")))

    last = F.substring(d, F.length(d), F.lit(1)).cast("int")
    wrong = F.concat(F.substring(d, F.lit(1), F.length(d) - 1), F.pmod(last + 1 + F.pmod(F.shiftright(pick, 8), F.lit(9)), F.lit(10)).cast("string"))
    price = F.concat(F.pmod(F.shiftright(pick, 8), F.lit(90)).cast("string"), F.lit(".50"))
    date = F.concat(F.lit("20"), F.substring(d, 1, 2), F.lit("-0"), F.substring(d, 3, 1), F.lit("-1"), F.substring(d, 4, 1))
    more = F.concat(F.substring(d, 1, 4), F.lit(".00 / "), F.substring(d, 5, 3), F.lit(".00"))
    own = {
        "email": one(F.concat(local, F.lit(" (at) "), host), F.concat(local, F.lit("[at]"), F.replace(host, F.lit("."), F.lit("[dot]"))),
                     F.concat(local, F.lit(" @ "), host), F.concat(local, F.lit("(at)"), F.replace(host, F.lit("."), F.lit(" (dot) ")))),
        "ip": one(F.replace(match, F.lit("."), F.lit(" . ")), F.replace(match, F.lit("."), F.lit(". "))),
        "card": card(d),
        "phone": one(F.concat(F.lit("00"), F.substring(match, 2, 99)), F.substring(match, 2, 99),
                     F.regexp_replace(F.substring(match, 2, 99), r"[\x20()-]+", "."), F.regexp_replace(F.substring(match, 2, 99), r"[\x20()-]+", "/")),
    }
    other = {
        "email": one(F.concat(local, F.lit(" @ "), price), F.concat(local, F.lit("@"), price, F.lit(".2"))),
        "ip": one(F.concat(F.lit("7"), F.replace(F.concat(F.lit("31"), match), F.lit("."), F.lit(" . "))), F.concat(F.replace(match, F.lit("."), F.lit(". ")), F.lit("999"))),
        "card": card(wrong),
        "phone": one(date, more, F.concat(date, F.lit(" / "), date)),
    }

    def chosen(by_kind: dict[str, Column]) -> Column:
        found_ = F.when(kind == "email", by_kind["email"])
        for k in KINDS[1:]:
            found_ = found_.when(kind == k, by_kind[k])
        return found_

    return chosen(own), chosen(other)


def planted(rows: DataFrame, seed: int) -> DataFrame:
    """mark, row, kind, start, end, right, features: base spans rewritten, and their lookalikes, as the generators
    propose them in the surroundings of the span. A proposal that cuts a rewritten span otherwise is wrong."""
    spans = F.concat(*[F.coalesce(F.transform(k, lambda s: F.struct(F.lit(k).alias("kind"), s.alias("span"))), F.array()) for k in KINDS])
    each = rows.select("mark", "row", F.explode(spans).alias("b")).select("mark", "row", "b.kind", "b.span.*")
    own, other = rewritten(F.col("kind"), F.col("match"), F.xxhash64("match", "before", F.lit(seed)))
    forms = F.array(F.struct(F.lit(True).alias("right"), own.alias("of")), F.struct(F.lit(False).alias("right"), other.alias("of")))
    shown = each.select("mark", "row", "kind", "start", "before", "after", F.explode(forms).alias("f")).select(
        "mark", "row", "kind", F.col("start").alias("place"), F.length("before").alias("begin"), "f.right", "f.of.size",
        F.concat("before", "f.of.form", "after").alias("shown"))
    tried = shown.withColumn("p", F.explode(proposals(F.col("shown")))).where(
        "p.span.start < begin + size AND begin < p.span.end")
    exact = (F.col("p.kind") == F.col("kind")) & (F.col("p.span.start") == F.col("begin")) & (F.col("p.span.end") == F.col("begin") + F.col("size"))
    return tried.select("mark", "row", F.col("p.kind").alias("kind"), F.col("place").alias("start"),
                        (F.col("place") + F.col("p.span.end") - F.col("p.span.start")).alias("end"), (F.col("right") & exact).alias("right"),
                        *[c.alias(n) for n, c in features(F.col("p.kind"), F.col("p.span")).items()])


def overlaps(s: Column, spans: list[Column]) -> Column:
    hit = F.lit(False)
    for one in spans:
        hit |= F.coalesce(F.exists(one, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])), F.lit(False))
    return hit


def proposals(text: Column) -> Column:
    """kind and span of what the generators find; a run of figures is taken for what its form is nearest to."""
    runs = F.filter(found(text, WIDE_NUMBER), lambda s: s["end"] - s["start"] >= LEAST_LENGTH)
    numbers = F.transform(runs, lambda s: F.struct(
        F.when(s["match"].rlike(SPACED_IP), "ip").when(
            s["match"].rlike(r"^(?:\+|00[1-9])") & (F.length(digits(s["match"])) <= 17), "phone").when(F.length(digits(s["match"])) >= 13, "card").otherwise("phone").alias("kind"), s.alias("span")))
    emails = F.transform(F.when(text.rlike(r"@|\(at\)|\[at\]"), found(text, WIDE_EMAIL)),
                         lambda s: F.struct(F.lit("email").alias("kind"), s.alias("span")))
    blocks = F.transform(F.when(F.size(runs) > 0, found(text, BLOCK_NUMBER)), lambda s: F.struct(F.lit("card").alias("kind"), s.alias("span")))
    none = F.array().cast("array<struct<kind:string,span:struct<start:int,end:int,match:string,before:string,after:string>>>")
    return F.concat(F.coalesce(emails, none), F.coalesce(numbers, none), F.coalesce(blocks, none))


def shares_fitted(counts: dict[str, int], sample: int) -> dict[str, float]:
    """By kind, the part of its proposals that is fitted on: at most three quarters, and of all kinds about three
    quarters of `sample`. A kind with few gets its three quarters, and those with many divide what is left."""
    left, out = 0.75 * sample, {}
    for i, (kind, n) in enumerate(sorted(counts.items(), key=lambda item: item[1])):
        most = min(0.75 * n, left / (len(counts) - i))
        out[kind], left = most / n, left - most
    return out


def scored(rows: DataFrame, made: DataFrame, choice: Choice) -> DataFrame:
    """The proposals (mark, row, kind, start, end, agrees, features) that are chosen, with their scores. `made`: the
    rewritten spans and lookalikes, with `right`."""
    nothing = rows.select("row", "kind", "start", "end", F.lit(0.0).alias("score")).limit(0)
    known = F.col("agrees") | ~right_form()
    labelled = rows.withColumn("right", F.when(known, F.col("agrees"))).withColumn("real", F.lit(True)).drop("agrees").unionByName(
        made.withColumn("real", F.lit(False)))
    clear = labelled.where("right IS NOT NULL")
    counts = {r["kind"]: r["n"] for r in clear.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Which documents are fitted on follows from their text alone: the same in any layout, and copies fall on one side.
    draw = F.xxhash64("mark", F.lit(choice.seed))
    fitted = F.lit(False)
    for kind, share in shares_fitted(counts, choice.sample).items():
        fitted |= (F.col("kind") == kind) & (F.shiftrightunsigned(draw, 11) / F.lit(float(1 << 53)) < share)
    fit_on, _ = written_and_counted(
        clear.where(fitted).withColumn("draw", F.xxhash64("mark", "kind", "start", "end", "real", "right")).orderBy(
            "draw", *FEATURES).limit(choice.sample).coalesce(1), "personal_sample")
    seen = {r[0] for r in fit_on.select("right").distinct().collect()}
    if seen != {True, False}:
        return nothing
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    model = GBTClassifier(labelCol="label", featuresCol="features", maxIter=choice.trees, maxDepth=choice.depth,
                          minInstancesPerNode=choice.leaf, seed=choice.seed).fit(
        assembler.transform(fit_on.withColumn("label", F.col("right").cast("double"))))
    judged = labelled.withColumn("held_out", F.col("right").isNotNull() & ~fitted & ~(F.col("real") & F.col("right"))).where(
        "held_out OR right IS NULL")
    judged = written(model.transform(assembler.transform(judged)).select(
        "row", "kind", "start", "end", "right", "held_out", F.get(vector_to_array("probability"), F.lit(1)).alias("score")), "personal_scores")

    # The lowest score, in hundredths and from one half, from which on enough of the held-out ones are right. Base spans
    # are not among these: they stay whatever their score, and would hide what is wrong among those added.
    bins = judged.where("held_out").groupBy("kind", F.floor(100 * F.col("score")).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("right").cast("int")).alias("right")).collect()
    limit = {kind: thresholds([r for r in bins if r["kind"] == kind], choice) for kind in KINDS}
    of_all = thresholds(bins, choice)
    few = {kind for kind in KINDS if sum(r["n"] for r in bins if r["kind"] == kind) < choice.support}
    limit |= {kind: of_all for kind in few}
    enough = F.lit(False)
    for kind, score in limit.items():
        if score is not None:
            enough |= (F.col("kind") == kind) & (F.col("score") >= score)
    return judged.where("right IS NULL").where(enough).select("row", "kind", "start", "end", "score")


def thresholds(bins: list, choice: Choice) -> float | None:
    """The lowest score from which on the bins (bin, n, right) reach the precision with enough support."""
    lowest, n, right = None, 0, 0
    at = {b: [r for r in bins if r["bin"] == b] for b in range(50, 101)}
    for least in range(100, 49, -1):
        n, right = n + sum(r["n"] for r in at[least]), right + sum(r["right"] for r in at[least])
        if n >= choice.support and right >= choice.precision * n:
            lowest = least / 100
    return lowest


def personal_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", choice: Choice = Choice()) -> DataFrame:
    """id, `base` and `added`: arrays of (kind, start, end, place of the kind), in order of start and kind.

    Null and empty texts have no spans; texts of any length are read whole. Rows are told
    apart by their place, so repeated rows and rows without an id get their own. Added spans do not overlap base
    spans nor each other: of two, the one that starts first stays, then the higher score. Other columns
    of `df` are not looked at, whatever their names. An empty table gives an empty result.
    """
    return row_spans(df, id_col, text_col, choice, keep_text=False).select(F.col("id").alias(id_col), "base", "added")


def row_spans(df: DataFrame, id_col: str, text_col: str, choice: Choice, keep_text: bool) -> DataFrame:
    """`personal_spans` as id, base and added, and on demand each row's own text as it was."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("row", F.monotonically_increasing_id())
    text = whole("text")
    rows = rows.withColumn("mark", F.xxhash64(text))
    kinds = base_spans(text)
    kept = ["row", "id", "mark", *(["text"] if keep_text else [])]
    rows = written(rows.select(*kept, *[c.alias(k) for k, c in kinds.items()], proposals(text).alias("proposed")), "personal_spans")
    spans = [F.col(k) for k in KINDS]
    each = rows.where(F.size("proposed") > 0).select("mark", "row", F.explode(F.transform(
        "proposed", lambda p: p.withField("agrees", overlaps(p["span"], spans)))).alias("p"))
    described = each.select("mark", "row", "p.kind", "p.span.start", "p.span.end", "p.agrees",
                            *[c.alias(n) for n, c in features(F.col("p.kind"), F.col("p.span")).items()])
    chosen = scored(written(described, "personal_proposals"), written(planted(rows, choice.seed), "personal_planted"), choice)
    added = chosen.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", (-F.col("score")).alias("s"), "end", "kind"))).alias("found"))

    def listed(kind: str, s: Column) -> Column:
        return F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("place"), s["end"].alias("end"), F.lit(kind).alias("kind"))

    def none() -> Column:
        return F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")

    def of(kind: str) -> Column:
        return F.coalesce(F.transform(F.col(kind), lambda s: listed(kind, s)), none())

    places = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])

    def taken(state: Column, s: Column) -> Column:
        span = F.struct(s["start"].alias("start"), F.element_at(places, s["kind"]).alias("place"), s["end"].alias("end"), s["kind"].alias("kind"))
        free = s["start"] >= state["upto"]
        return F.struct(F.when(free, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
                        F.when(free, s["end"]).otherwise(state["upto"]).alias("upto"))

    more = F.aggregate("found", F.struct(none().alias("spans"), F.lit(0).alias("upto")), taken, lambda state: state["spans"])
    return rows.join(added, "row", "left").select(
        *[k for k in kept if k not in ("row", "mark")], F.array_sort(F.concat(*map(of, KINDS))).alias("base"), F.coalesce(more, none()).alias("added"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", choice: Choice = Choice()) -> DataFrame:
    """One row a document: counts and digest of the base spans, and all spans as `kind:start:end`."""
    found_ = personal_spans(df, id_col, text_col, choice)

    def counted(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = map(counted, KINDS)
    return found_.select(id_col, *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                         joined(F.array_sort(F.concat("base", "added"))).alias("spans"))


def redacted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", choice: Choice = Choice()) -> DataFrame:
    """id and text, one row for each, every span replaced by its kind in brackets. Spans that overlap
    are replaced as one, up to the last end, by the kind of the first. A null text stays null."""
    rows = row_spans(df, id_col, text_col, choice, keep_text=True)

    def cut(state: Column, s: Column) -> Column:
        skip = s["start"] < state["upto"]
        piece = F.concat(state["out"], F.substring("text", state["upto"] + 1, s["start"] - state["upto"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.when(skip, state["out"]).otherwise(piece).alias("out"), F.greatest(state["upto"], s["end"]).alias("upto"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("upto"))
    done = F.aggregate(F.array_sort(F.concat("base", "added")), start, cut)
    text = let(done, lambda d: F.concat(d["out"], F.substring("text", d["upto"] + 1, F.lit(2_147_483_647))))
    return rows.select(F.col("id").alias(id_col), text.alias(text_col))
