"""Pieces by suffix array, against the library that reads the same model."""

import random

import numpy as np
import pytest
import sentencepiece

from veilframe.llm import pieces
from veilframe.llm.queries import PIECE_MODEL

MODEL = pieces.read_model(PIECE_MODEL)
READER = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
EDGES = ["", " ", " a", "Hello  world\n\t  x ", "     " * 9 + "x", "日本語 テスト", "é́ ﬁ x", "a\x00b", "🙂🙂 ok", "a" * 300, " " * 1000, "\n", "<s> </s> <0x0A>"]


@pytest.fixture(scope="module")
def work():
    return pieces.encoder(b"test", MODEL)


def lists(work, texts):
    ids, ends = work.encode(texts)
    return [x.tolist() for x in np.split(ids, ends[:-1])] if texts else []


def test_ids_equal_the_library_s(work):
    rng = random.Random(3)
    texts = EDGES + ["".join(rng.choice("etaoinshrdlu éñß.,\n☃") for _ in range(rng.randint(1, 90))) for _ in range(800)]
    assert lists(work, texts) == [READER.encode(t) for t in texts]
    assert [work.decode(np.array(x, int)) for x in lists(work, texts)] == texts


def test_documents_equal_the_library_s(work, duck):
    texts = [r[0] for r in duck.execute("SELECT text FROM documents").fetchall()]
    assert lists(work, texts) == [READER.encode(t) for t in texts]


def test_small_bounds_change_nothing(monkeypatch):
    for name, value in (("BATCH_CHARS", 50), ("LEARN_CHARS", 40), ("MOST_REMEMBERED", 20), ("MOST_PAIRS", 10)):
        monkeypatch.setattr(pieces, name, value)
    work = pieces.Encoder(MODEL)
    texts = [" ".join(random.Random(i).choice(["internationalization", "the", "Überraschung", "a  b"]) for _ in range(40)) for i in range(20)]
    for part in (texts[:7], texts[7:], []):
        assert lists(work, part) == [READER.encode(t) for t in part]


def test_occurrences_are_those_of_a_search(work):
    text = "the thing that the other thinks"
    place, piece = work.occurrences(work.code_of[np.frombuffer(text.encode("utf-32-le"), np.uint32)])
    found = {(int(s), work.edge_pieces[p]) for s, p in zip(place, piece)}
    assert found == {(i, p) for p in work.edge_pieces for i in range(len(text)) if text.startswith(p, i)}


def test_tables(spark):
    rows = [(1, "Hello world", 5, "x"), (None, None, None, None), (2, "", 6, "y"), (2, "", 6, "y"), (3, "é\n", 7, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int, text_to_encode string")
    out = pieces.encoded(df, MODEL)
    assert out.columns == ["doc_id", "text", "text_to_encode", "ids", "n_tokens"]
    assert sorted((r.doc_id or 0, r.ids, r.n_tokens, r.text_to_encode) for r in out.collect() if r.text) == [
        (1, READER.encode("Hello world"), len(READER.encode("Hello world")), "x"), (3, READER.encode("é\n"), len(READER.encode("é\n")), None)]
    back = pieces.decoded(out, MODEL)
    assert all(r.decoded == (r.text or "") for r in back.collect()) and back.count() == 5
    report = {(r.doc_id, r.n_tokens, r.round_trip) for r in pieces.encoding_report(df, MODEL).collect()}
    assert (None, 0, True) in report and (2, 0, True) in report
    marked = spark.createDataFrame([(1, "a▁b")], "doc_id bigint, text string")
    assert not pieces.encoding_report(marked, MODEL).first().round_trip
    for made in (pieces.encoded, pieces.encoding_report):
        assert made(df.where("false"), MODEL).count() == 0


def test_bytes_that_are_no_text_are_replaced(work):
    first = work.words.bytes[0xC3]
    assert work.decode(np.array([first])) == "\ufffd"
