"""Quality rules, the quality classifier and mixing."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from veilframe.llm import mixing, quality_classifier, quality_rules

SCHEMA = "doc_id bigint, text string, lang string, source string, n_words string"
SPACES = re.compile("[ \t\n\v\f\r]+")


def plain_counts(text):
    text = text or ""
    words = [w for w in SPACES.split(text) if w]
    lines = [line for line in text.split("\n") if [w for w in SPACES.split(line) if w]]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + o for i, w in enumerate(windows) if often[w] > 1 for o in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " ", "a", "a b", "a b c", "a b c a b c", "a a a a a a a", "x\n\nx\nx \n y", "é b | # \v c\fd", "🙂 🙂 🙂 🙂 🙂 & <>"]
    texts += [" ".join(rng.choice("abcde") + rng.choice(["", "\n", "#"]) for _ in range(rng.randint(1, 120))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "en", "s", "clash") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality_rules.quality_report(df).collect()}
    assert got == {i: plain_counts(t) for i, t in enumerate(texts)}


def words(n, seed=0):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_cutoffs_follow_the_source(spark):
    """A source whose documents all hold symbols keeps them; in another they are far out."""
    plain = [(i, words(80, i), "en", "plain", None) for i in range(150)]
    code = [(1000 + i, " ".join(w + " #" * (1 + i % 2) for w in words(80, i).split()), "en", "code", None) for i in range(150)]
    odd = [(5000, code[0][1], "en", "plain", None), (5001, words(80, 9).upper(), "en", "plain", None), (5002, words(10), "en", "plain", None),
           (5003, words(60), None, None, None), (5004, code[0][1], "en", "few", None)]
    df = spark.createDataFrame(plain + code + odd, SCHEMA)
    kept = {r.doc_id for r in quality_rules.quality_filter(df).collect()}
    assert {r[0] for r in plain} <= kept and {r[0] for r in code} <= kept
    assert not kept & {5000, 5001, 5002} and 5003 in kept
    assert quality_rules.quality_filter(df).columns == df.columns


def test_cutoffs_do_not_jump_with_the_size_of_a_group(spark):
    """One more document in a group moves its cutoffs by no more than its share and the bins of the sketch."""
    def most(n):
        docs = [(i, "w " * (100 - i % 9) + "# " * (i % 9), "en", "own", None) for i in range(n)]
        docs += [(1000 + i, "w " * 60 + "# " * (i % 40), "en", "other", None) for i in range(300)]
        counted = quality_rules.measured(spark.createDataFrame(docs, SCHEMA), "text")
        found = quality_rules.cutoffs(quality_rules.sketches(counted, "lang", "source"), quality_rules.Rules())
        return found.where("source = 'own'").first().limits.symbols_1000_most

    at = [most(n) for n in (72, 81, 90, 99, 108)]
    assert all(abs(b - a) < 0.25 * a for a, b in zip(at, at[1:]))


def test_empty_rules(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quality_rules.quality_report(empty).count() == 0 and quality_rules.quality_filter(empty).count() == 0
    everything_fails = spark.createDataFrame([(1, None, None, None, None), (2, "short", "en", "a", None)], SCHEMA)
    assert {(r.doc_id, r.base_failed, r.kept) for r in quality_rules.quality_report(everything_fails).collect()} == {(1, True, False), (2, True, False)}


def test_classifier_on_held_out_labels(spark):
    """Fitted on labels of even documents, judged on those of odd ones."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = labels.withColumn("quality", F.when(F.col("doc_id") % 2 == 0, F.col("quality")))
    report = quality_classifier.quality_report(docs, seen)
    judged = report.join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    right = sum(r.kept == (r.quality == 1) for r in judged)
    good = [r for r in judged if r.quality == 1]
    assert len(judged) > 100 and right / len(judged) > 0.93
    assert sum(r.kept for r in good) / len(good) > 0.97
    assert report.count() == docs.count()


def test_sparse_sites_shrink_to_their_parents(spark):
    """Equal texts without telling features: the site decides, the more so the more it holds."""
    rows = [(i, "same text", "p", "bad" if i < 200 else "good", None) for i in range(400)]
    rows += [(900, "same text", "new", "bad", None), (901, "same text", "new", "good", None), (902, "same text", None, None, None)]
    labels = [(i, 0 if i < 200 else 1) for i in range(400)]
    df, given = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, quality int")
    site = {r.doc_id: r.site for r in quality_classifier.quality_report(df, given, host_col="source", path_col="lang").collect()}
    assert site[5] < 0.05 and site[300] > 0.95
    assert site[900] < 0.2 < 0.4 < site[902] < 0.6 < 0.8 < site[901]


def plain_strength(groups, means):
    """Moments of a beta-binomial over groups (n, good) around their means."""
    total, count = sum(n for n, _ in groups), len(groups)
    spread = sum(n * (good / n - m) ** 2 for (n, good), m in zip(groups, means))
    chance = sum(m * (1 - m) for m in means) / count
    between = (spread - (count - 1) * chance) / (total - sum(n * n for n, _ in groups) / total)
    return min(1e6, max(1.0, chance / between - 1)) if between > 0 else 1e6


def test_posteriors_equal_a_plain_version(spark):
    """Many sparse hosts and paths, one that holds a third of all, sites found elsewhere, repeated and absent labels."""
    rng = random.Random(17)
    rows, labels, sites = [], [], []
    for i in range(900):
        host = "hot" if i % 3 == 0 else f"h{int(rng.expovariate(0.05))}"
        good = (hash_of := sum(map(ord, host)) * 7 % 10) / 10 > rng.random()
        rows.append((i, words(30, i) if good else "$$ # " * 20 + words(10, i), f"/{hash_of % 2}{i % 4}", host, None))
        labels += [(i, int(good))] * (i % 2 + (i % 10 == 1))
        if i % 7 == 0:
            sites.append((i, f"site{i % 5}", None if i % 2 else "/x"))
    df, given = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, quality int")
    found = spark.createDataFrame(sites, "id bigint, host string, path string")
    got = quality_classifier.quality_report(df, given, sites=found).collect()
    known, elsewhere = dict(labels), {i: (h, p or "") for i, h, p in sites}
    base = sum(known.values()) / len(known)
    own, place = {}, {}
    for r in got:
        own[r.doc_id] = known.get(r.doc_id, 1 / (1 + math.exp(-(r.evidence + math.log(base / (1 - base))))))
        place[r.doc_id] = elsewhere.get(r.doc_id, (rows[r.doc_id][3], rows[r.doc_id][2]))
        assert (r.host, r.path) == place[r.doc_id]
    hosts, paths = {}, {}
    for i, (host, path) in place.items():
        for sums, key in ((hosts, host), (paths, (host, path))):
            n, good = sums.get(key, (0, 0.0))
            sums[key] = (n + 1, good + own[i])
    mean = sum(own.values()) / len(own)
    of_host = plain_strength(list(hosts.values()), [mean] * len(hosts))
    shrunk = {h: (good + of_host * mean) / (n + of_host) for h, (n, good) in hosts.items()}
    of_path = plain_strength(list(paths.values()), [shrunk[h] for h, _ in paths])
    for r in got:
        (hn, hg), (pn, pg), mine = hosts[r.host], paths[r.host, r.path], own[r.doc_id]
        above = min(1 - 1e-4, max(1e-4, (hg - mine + of_host * mean) / (hn - 1 + of_host)))
        site = min(1 - 1e-4, max(1e-4, (pg - mine + of_path * above) / (pn - 1 + of_path)))
        assert abs(r.site - site) < 1e-6
        assert abs(r.probability - 1 / (1 + math.exp(-(r.evidence + math.log(site / (1 - site)))))) < 1e-6
    assert 1 < of_host < 1e6 and len(hosts) > 30 and min(n for n, _ in hosts.values()) == 1


def test_classifier_without_labels_and_on_edges(spark):
    df = spark.createDataFrame([(1, None, None, None, None), (1, None, None, None, None), (None, "", "en", "a", "x")], SCHEMA)
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, quality int")
    got = quality_classifier.quality_report(df, none).collect()
    assert len(got) == 3 and all(r.kept and abs(r.probability - 0.5) < 1e-6 for r in got)
    assert quality_classifier.quality_report(df.where("false"), none).count() == 0


def brute_fit(cells, shares, langs, topics, budget):
    """Raking with a bound, on dictionaries: sources, then languages, then topics."""
    total = sum(cells.values())
    u, v, t = {c[0]: budget for c in cells}, {c[1]: 1.0 for c in cells}, {c[2]: 1.0 for c in cells}
    for _ in range(3000):
        for part, target, i in ((u, shares, 0), (v, langs, 1), (t, topics, 2)):
            now = Counter()
            for c, n in cells.items():
                now[c[i]] += n * min(1.0, u[c[0]] * v[c[1]] * t[c[2]])
            for k in part:
                part[k] *= target[k] * budget * total / now[k]
    return {c: min(1.0, u[c[0]] * v[c[1]] * t[c[2]]) for c in cells}


def mixed_docs(spark, n=3000):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(1, 9), rng.choice(["en", "en", "en", "de", "fr"]), rng.choice(["big"] * 3 + ["a", "b"]), rng.choice(["x", "y"])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, topic string")


def test_fit_equals_plain_raking(spark):
    rows, df = mixed_docs(spark)
    targets = mixing.Targets({"big": 0.5, "a": 0.3, "b": 0.2}, {"en": 0.5, "de": 0.3, "fr": 0.2}, {"x": 0.4, "y": 0.6}, budget=0.5, sweeps=200, tolerance=1e-9)
    report = mixing.mixing_report(df, targets, topic_col="topic").collect()
    cells = Counter()
    for _, text, lang, source, topic in rows:
        cells[source, lang, topic] += len(text.split())
    expected = brute_fit(cells, {"big": 0.5, "a": 0.3, "b": 0.2}, {"en": 0.5, "de": 0.3, "fr": 0.2}, {"x": 0.4, "y": 0.6}, 0.5)
    assert all(abs(r.probability - expected[r.source, r.lang, r.topic]) < 1e-4 for r in report)
    tokens = sum(r.tokens for r in report if r.selected)
    assert abs(tokens / sum(cells.values()) - 0.5) < 0.03
    assert abs(sum(r.tokens for r in report if r.selected and r.lang == "de") / tokens - 0.3) < 0.03


def test_drawing_is_a_function_of_the_id(spark):
    _, df = mixed_docs(spark, 500)
    targets = mixing.Targets(0.5, {"en": 0.5, "de": 0.3, "fr": 0.2})
    one = {r.doc_id for r in mixing.mixed(df, targets).collect()}
    assert one == {r.doc_id for r in mixing.mixed(df.repartition(7), targets).collect()} and 0 < len(one) < 500
    assert mixing.mixed(df, targets).columns == df.columns


def test_rows_without_an_id_are_drawn_one_by_one(spark):
    rows = [(None, f"text {i}", "en", "s") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    targets = mixing.Targets(1.0, {"en": 1.0}, budget=0.5)
    drawn = {r.text for r in mixing.mixed(df, targets).collect()}
    assert 120 < len(drawn) < 280 and drawn == {r.text for r in mixing.mixed(df.repartition(5), targets).collect()}


def test_mixing_edges(spark):
    rows = [(1, None, None, None, "t"), (2, "a b", "xx", None, None), (2, "a b", "xx", None, None), (None, "c", "en", "s", "t"), (3, "", "en", "void", "t")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, tokens string")
    got = mixing.mixing_report(df, mixing.Targets(0.9, {"en": 1.0, "absent": 0.5})).collect()
    assert len(got) == 5 and all(0 <= r.probability <= 1 for r in got)
    assert [r.probability for r in got if r.doc_id == 3] == [0.0]
    assert mixing.mixing_report(df.where("false"), mixing.Targets()).count() == 0


def test_targets_beyond_the_tokens_are_told_and_the_rest_is_met(spark):
    """Of topic y and source b there is less than asked for; all of it is taken, and the other shares keep their proportions."""
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(1, 9), rng.choice(["en", "en", "de"]), rng.choice(["big"] * 8 + ["a"] * 5 + ["b"]),
             rng.choice(["x"] * 6 + ["z"] * 6 + ["y"])) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, topic string")
    targets = mixing.Targets({"big": 0.4, "a": 0.4, "b": 0.2}, {"en": 0.6, "de": 0.4}, {"x": 0.4, "y": 0.3, "z": 0.3}, budget=0.6)
    total = sum(len(r[1].split()) for r in rows)
    most = {m: sum(len(r[1].split()) for r in rows if r[i] == m) / (0.6 * total) for m, i in (("y", 4), ("b", 3))}
    got = {r.name: r for r in mixing.mixing_shares(df, targets, topic_col="topic").collect() if r.name}
    expected = {"en": 0.6, "de": 0.4, "y": most["y"], "x": (1 - most["y"]) * 4 / 7, "z": (1 - most["y"]) * 3 / 7,
                "b": most["b"], "big": (1 - most["b"]) / 2, "a": (1 - most["b"]) / 2}
    assert most["y"] < 0.2 and most["b"] < 0.2 and got["y"].asked == 0.3 and got["b"].asked == 0.2
    assert all(abs(got[n].target - share) < 1e-6 and abs(got[n].expected - share) < 2e-4 for n, share in expected.items())
    report = mixing.mixing_report(df, targets, topic_col="topic").collect()
    assert all(r.probability == 1 for r in report if r.topic == "y" or r.source == "b")
    for name, share in expected.items():
        mass = sum(r.tokens * r.probability for r in report if name in (r.topic, r.lang, r.source))
        assert abs(mass / (0.6 * total) - share) < 2e-4
