"""Every registered query of the subpackage against its SQL twin, and the pipeline against a plain version."""

import pytest
from conftest import rows_of

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from veilframe.llm import mixing, simhash
from veilframe.llm.queries import MIX, PIECE_MODEL, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, spark, sf_dir, duck):
    found = queries()[name](spark, sf_dir)
    cursor = duck.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    assert sorted(names) == sorted(found.columns)
    assert rows_of(found) == sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)


def test_all_are_registered():
    names = queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14))


def test_stages_keep_what_plain_versions_keep(spark, sf_dir, duck):
    import sentencepiece

    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "simhash near-dedup", "mixing", "pieces"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")

    kept = {r[0] for r in duck.execute(f"SELECT doc_id FROM ({SQL['op9_quality_rules']}) WHERE kept").fetchall()}
    docs = stages["quality rules"](spark, docs, sf_dir)
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    rows = {r.doc_id: r for r in docs.collect()}
    assert set(rows) == kept and 20 < len(kept) < 200

    docs = stages["exact dedup"](spark, docs, sf_dir)
    groups = {}
    for r in rows.values():
        groups.setdefault("".join(c for c in r.text if c not in " \t\n\v\f\r"), []).append(r)
    kept = {max(g, key=lambda r: (len(r.text), -r.doc_id)).doc_id for g in groups.values()}
    assert {r.doc_id for r in docs.collect()} == kept

    near = stages["simhash near-dedup"](spark, docs, sf_dir)
    codes = {i: simhash.fingerprint(rows[i].text) & (2**64 - 1) for i in kept}
    component = {}
    for i in sorted(kept):
        if i in component:
            continue
        todo = [i]
        while todo:
            a = todo.pop()
            component[a] = i
            todo += [b for b in kept if b not in component and (codes[a] ^ codes[b]).bit_count() <= 4]
    kept = {i for i, c in component.items() if i == c}
    docs = near
    assert {r.doc_id for r in docs.collect()} == kept

    drawn = {r.doc_id for r in mixing.mixing_report(docs, MIX).where("selected").collect()}
    docs = stages["mixing"](spark, docs, sf_dir)
    assert {r.doc_id for r in docs.collect()} == drawn and drawn <= kept

    reader = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    out = stages["pieces"](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in out} == drawn
    assert all(r.ids == reader.encode(rows[r.doc_id].text) and r.n_tokens == len(r.ids) for r in out)


def test_stages_take_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() == 0
        docs = out if name != "pieces" else docs


def test_stages_take_nulls_repeats_and_clashing_columns(spark, sf_dir):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, text, "en", "a", 1, "x"), (1, text, "en", "a", 1, "x"), (2, text + " ", "en", None, None, None),
            (None, None, None, None, None, None), (3, "", "en", "a", 0, "y"), (4, " ".join(f"other{i}" for i in range(60)), None, "b", 2, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.columns
        docs = stage(spark, docs, sf_dir)
        if name != "pieces":
            assert docs.columns == before
        if name == "exact dedup":
            assert sorted(r.doc_id for r in docs.collect()) == [2, 4]
    assert docs.count() <= 2


def test_no_text_of_its_own_is_lost_with_a_repeated_id(spark, sf_dir):
    a, b = (" ".join(f"{x}{i}" for i in range(80)) for x in ("one", "two"))
    rows = [(1, a, "en", "a", 1), (5, a + " more", "en", "a", 1), (5, b, "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf_dir)
    assert sorted((r.doc_id, r.text[:3]) for r in docs.collect()) == [(1, "one"), (5, "two")]
