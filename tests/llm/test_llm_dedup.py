"""Exact duplicates, SimHash and connected components."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilframe.llm import exact_dedup, simhash
from veilframe.llm.connected import components

SCHEMA = "doc_id bigint, text string, text_hash string, kept int"


def test_report_of_edges(spark):
    rows = [(5, "a b", "x", 1), (3, "ab", "x", 2), (4, " a\tb\n", None, 3), (9, None, None, None), (8, "", None, None),
            (7, " \n", None, None), (None, "ab", None, None), (6, "é b", None, None), (6, "é b", None, None), (2, "A b", None, None)]
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.duplicate_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(5, 4, 4, False), (3, 4, 4, False), (4, 4, 4, True), (None, 4, 4, False),
                   (9, 7, 3, False), (8, 7, 3, False), (7, 7, 3, True), (6, 6, 2, True), (2, 2, 1, True)}


def test_of_a_repeated_id_the_longer_row_stays(spark):
    rows = [(5, "a b", "x", 1), (5, "a  b", "x", 2), (7, "ab", "x", 3)]
    report = exact_dedup.duplicate_report(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in report.collect()) == [(5, 5, 3, False), (5, 5, 3, True), (7, 5, 3, False)]


def test_one_row_of_a_group_stays_with_its_columns(spark):
    rows = [(6, "é b", "h", 1), (6, "é b", "h", 1), (1, "z", None, 5), (None, "q", None, None), (None, "q", None, None)]
    out = exact_dedup.exact_dedup(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "text_hash", "kept"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(6, "é b", "h", 1), (1, "z", None, 5), (None, "q", None, None)], key=repr)


def test_a_weak_hash_is_made_good_by_the_bytes(spark):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 90).cast("string")).alias("text"))
    weak = exact_dedup.find_duplicates(df, "doc_id", "text", hashed=lambda c: F.substring(F.md5(c), 1, 1))
    rows = exact_dedup.labelled(weak, weak.staged.select("doc_id", weak.hash, weak.digest)).collect()
    assert {(r.doc_id, r.class_keep_id, r.class_size) for r in rows} == {
        (i, i % 90, 4 if i % 90 < 30 else 3) for i in range(300)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup.duplicate_report(empty).count() == 0 and exact_dedup.exact_dedup(empty).count() == 0
    assert simhash.near_duplicate_report(empty).count() == 0 and simhash.near_dedup(empty).count() == 0


def plain_fingerprint(spark, text, k=4):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [r[0] & (2**64 - 1) for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s")).collect()]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", None, "one", "a b c", "A B c d É f", "x y z\tw\nv  u t s", "rep rep rep rep rep rep", " lead and trail "])
def test_fingerprints_equal_the_definition(spark, text):
    assert simhash.fingerprint(text) & (2**64 - 1) == plain_fingerprint(spark, text)


def brute_components(codes, radius):
    label = {c: c for c in codes}
    changed = True
    while changed:
        changed = False
        for a in codes:
            best = min(label[b] for b in codes if ((a ^ b) & (2**64 - 1)).bit_count() <= radius)
            if best < label[a]:
                label[a], changed = best, True
    return label


@pytest.mark.parametrize("tile_rows, block", [(None, 1 << 15), (23, 64)])
def test_tiles_lose_no_link(spark, monkeypatch, tile_rows, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(4)
    seeds = [int(x) for x in rng.integers(-2**63, 2**63, 60)]
    near = [s ^ int(sum(1 << int(b) for b in rng.choice(63, n, replace=False))) for s in seeds for n in (2, 4, 5)]
    chain = [sum(1 << b for b in range(3 * i)) for i in range(20)]  # each three bits from the next
    codes = sorted({*seeds, *near, *chain})
    df = spark.createDataFrame([(c,) for c in codes], "code bigint")
    roots = {r.node: r.root for r in components(simhash.near_links(df, 4, tile_rows)).collect()}
    expected = brute_components(codes, 4)
    assert {c: roots.get(c, c) for c in codes} == expected


def test_near_copies_of_edges(spark):
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(4, long, "", 0), (2, long + " more", "", 0), (9, None, "", 0), (7, " ", "", 0), (None, long, "", 0), (1, "unlike all others here", "", 0), (4, long, "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    report = simhash.near_duplicate_report(df)
    got = sorted(((r.doc_id, r.component_id) for r in report.collect()), key=repr)
    assert got == sorted([(4, 2), (4, 2), (2, 2), (9, 7), (7, 7), (None, 2), (1, 1)], key=repr)
    assert {r.fingerprint for r in report.where("doc_id IN (7, 9)").collect()} == {"0" * 16}
    kept = simhash.near_dedup(df)
    assert kept.columns == df.columns and sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([2, 7, None, 1], key=repr)


def test_rows_that_share_an_id_go_one_by_one(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(300)) for x in "abc")
    rows = [(1, a, "", 0), (5, a, "", 1), (5, b, "", 2), (6, b + " more", "", 3), (7, c, "", 4), (7, c, "", 5), (8, c, "", 6), (None, a, "", 7)]
    kept = simhash.near_dedup(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.kept for r in kept.collect()) == [0, 2, 4, 5, 7] and kept.columns == ["doc_id", "text", "text_hash", "kept"]


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    loop = [(5000, 5001), (5001, 5002), (5002, 5000), (5000, 5000)]
    links = spark.createDataFrame(path + star + loop, "a bigint, b bigint")
    roots = {r.node: r.root for r in components(links).collect()}
    assert all(roots[i] == 0 for i in range(61)) and all(roots[1000 + i] == 1000 for i in range(200))
    assert all(roots[i] == 5000 for i in (5000, 5001, 5002)) and len(roots) == 61 + 200 + 3
    assert components(links.where("false")).count() == 0
