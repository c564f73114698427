"""The divergence of sources against a plain version."""

import random
import re

import pytest
from pyspark.sql import functions as F

from veilframe.llm import divergence

SCHEMA = "doc_id bigint, text string, lang string, source string, term string, count int, n int"


def plain(rows, least=3, most=200):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(
        c.lower() if c.isascii() else c for c in text or ""))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == lang]
        every = {t for d in here for t in d[2]}
        kept = sorted(t for t in every if sum(t in d[2] for d in here) >= least)
        sources = sorted({d[1] for d in here})
        count = {s: {t: sum(d[2].count(t) for d in here if d[1] == s) for t in kept} for s in sources}
        p = {s: {t: 1 + 10**9 * (c + 1) // (sum(count[s].values()) + len(kept)) for t, c in count[s].items()} for s in sources}
        total = {t: sum(count[s][t] for s in sources) for t in kept}
        q = {t: 1 + 10**9 * (c + 1) // (sum(total.values()) + len(kept)) for t, c in total.items()}
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:most])):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, item) in enumerate(sorted(found, key=lambda x: (x[0], x[1].encode())))]
    return sorted(out)


def given(spark, rows):
    return spark.createDataFrame([(i, *r, "x", 1, 2) for i, r in enumerate(rows)], SCHEMA)


def corpus():
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "kMzé日" for b in ("a", "O", "ù")] + ["Straße", "ÀB"]
    rows = [(" ".join(rng.choices(words, weights=range(1, 18), k=rng.randint(0, 25))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None, "é"]))
            for _ in range(120)]
    rows += [("same text Here", "en", "a")] * 40 + [("same text Here", "en", "b")] * 3 + [("same text Here", "de", "b")]
    rows += [(None, "en", "a"), ("", "fr", "only"), ("1 2 3", "xx", "p"), (None, "xx", "q"), ("once", "xx", "q"), ("twice twice twice", "yy", "z")]
    return rows + [("long-" * 3000 + "long", "en", "huge")]


@pytest.mark.parametrize("least, most, at_once, cells", [(1 << 16, 1 << 20, 256, 1 << 20), (3, 7, 2, 3)])
def test_equals_the_plain_version(spark, monkeypatch, least, most, at_once, cells):
    monkeypatch.setattr(divergence, "LEAST_ROWS", least)
    monkeypatch.setattr(divergence, "MOST_ROWS", most)
    monkeypatch.setattr(divergence, "SOURCES_AT_ONCE", at_once)
    monkeypatch.setattr(divergence, "CELLS_AT_ONCE", cells)
    rows = corpus()
    got = divergence.source_divergence(given(spark, rows), terms_reported=6)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain(rows, most=6)


def test_a_text_is_tokenized_once_a_language(spark):
    rows = [("same words", "en", s) for s in "abab"] + [("same words", "de", "a"), ("same  words", "en", "a")]
    df = given(spark, rows)
    groups, _, counted = divergence.term_counts(df, "lang", "source", "text")
    assert groups.count() == 3
    counted = counted.join(groups, "id")
    assert {(r.lang, r.source, r.term): (r["count"], r.docs) for r in counted.collect()} == {
        (lang, s, t): (n, n) for lang, s, n in (("en", "a", 3), ("en", "b", 2), ("de", "a", 1)) for t in ("same", "words")}


def test_shares_of_great_counts_are_exact(spark):
    pairs = [(1, 1), (1, 3), (2, 3), (10**13 - 1, 10**13), (7 * 10**12 + 1, 9 * 10**14 + 7), (5 * 10**14, 9 * 10**14)]
    got = spark.createDataFrame(pairs, "a bigint, b bigint").select(divergence.share(F.col("a"), F.col("b")).alias("p"))
    assert [r.p for r in got.collect()] == [1 + 10**9 * a // b for a, b in pairs]


def test_empty_table(spark):
    assert divergence.source_divergence(given(spark, [])).count() == 0
