"""Personal data against plain regular expressions."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from veilframe.llm import personal

SCHEMA = "doc_id bigint, text string, base string, added int"
PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def passes(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind != "phone" or 10 <= len(digits) <= 15


def plain_spans(text):
    found = [(m.start(), i, m.end(), k) for i, k in enumerate(personal.KINDS) for m in PLAIN[k].finditer(text or "") if passes(k, m[0])]
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(found)]


TEXTS = [
    None, "", "mail me@x.com, a.b+c@d-e.co.uk. x@y a@b.c_d@e.f é@é.é ü.me@x.org", "@@ a@b@c.d .@-.- a@b..c", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1 00.0.0.0 1.2.3 9.9.9.9",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111 41111111111111110000000 1 2", "5500 0000 0000 0004 5500 0000 0000 0004",
    "+1 (555) 010-9999 +1 5 ++49 30 1234567 +4 +12345678901234567 (+1)5550109999x", "🙂🙂 me@x.com 🙂 +1 (555) 010-9999 8.8.8.8", "a@b." + "c." * 3000 + "d",
    "x" * 5000 + "@", "1" * 4000, "1." * 3000, "+1" + " " * 4000, "9" * 20, ("me@x.com " * 700), "\n".join(f"10.0.{i % 256}.{i % 300}" for i in range(500)),
]


def test_base_spans_equal_plain_matching(spark):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], SCHEMA)
    for r in personal.personal_report(df).collect():
        expected = plain_spans(TEXTS[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in expected) for k in personal.KINDS]
        assert set(expected) <= set(r.spans.split(",")) | {""}


def test_documents_equal_plain_matching(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    report = personal.personal_report(docs).collect()
    assert len(report) == len(texts)
    for r in report:
        expected = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest()
        assert len(r.spans.split(",")) - len(expected) <= 1  # what is added is rare


def trained(spark):
    """Many verified addresses and numbers after a cue, and as many figures that are none."""
    rows = [(i, f"text {i} call +1 (555) {i % 900 + 100}-{1000 + i} now") for i in range(400)]
    rows += [(1000 + i, f"order id {10000000 + 37 * i} shipped") for i in range(400)]
    return rows


def test_trees_add_what_looks_alike_and_leave_the_rest(spark):
    rows = trained(spark) + [(9000, "please call (555) 010-9999 today"), (9001, "order id 77777777 shipped")]
    df = spark.createDataFrame([(i, t, "", 0) for i, t in rows], SCHEMA)
    out = {r.doc_id: r.spans for r in personal.personal_report(df).where("doc_id >= 1000").collect()}
    assert out[9000].startswith("phone:12:") and out[9001] == ""
    assert all(s == "" for i, s in out.items() if i < 9000)


def luhn_number(rng, size=16):
    body = [rng.randint(0, 9) for _ in range(size - 1)]
    odd = sum(2 * d - 9 * (d > 4) if i % 2 == 0 else d for i, d in enumerate(reversed(body)))
    return "".join(map(str, [*body, -odd % 10]))


def corpus_with_planted_forms():
    """Base spans in invented prose, and in documents from 100,000 on forms that the base patterns miss (with
    the span that is to be found) or figures that are none (None)."""
    rng = random.Random(23)
    prose = [" ".join("".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(3, 9))) for _ in range(500)]

    def within(span):
        return f"{rng.choice(prose)} {span} {rng.choice(prose)}"

    def mail():
        return f"{rng.choice(prose).split()[0]}.{rng.randint(1, 99)}", f"mail{rng.randint(1, 9)}.example.{rng.choice(['com', 'org'])}"

    def phone():
        return f"({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"

    rows, hidden = [], {}
    for i in range(600):
        rows += [(4 * i, within("@".join(mail()))), (4 * i + 1, within(".".join(str(rng.randint(1, 255)) for _ in range(4)))),
                 (4 * i + 2, within(luhn_number(rng))), (4 * i + 3, within(f"+1 {phone()}"))]
    for i in range(400):
        name, host = mail()
        card, other = luhn_number(rng), luhn_number(rng)
        bad = card[:-1] + str((int(card[-1]) + rng.randint(1, 9)) % 10)
        fours = [card[j:j + 4] for j in range(0, 16, 4)]
        span, kind = [
            (f"{name} (at) {host}", "email"), (f"{name}[at]{host.replace('.', '[dot]')}", "email"), (".".join(fours), "card"), ("  ".join(fours), "card"),
            (f"001 {phone()}", "phone"), (bad, None), (f"{bad} {other[:5]}", None), (f"{rng.randint(1, 99)} @ 12.50", None),
            (f"2019-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}", None), (" . ".join(str(rng.randint(300, 900)) for _ in range(4)), None)][i % 10]
        text = within(span)
        rows.append((100_000 + i, text))
        at = text.index(span)
        hidden[100_000 + i] = f"{kind}:{at}:{at + len(span)}" if kind else None
    return rows, hidden


def test_precision_and_recall_of_added_spans_on_planted_forms(spark):
    rows, hidden = corpus_with_planted_forms()
    report = personal.personal_report(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    texts = dict(rows)
    added = {(r.doc_id, s) for r in report for s in set(r.spans.split(",")) - {""} - set(plain_spans(texts[r.doc_id]))}
    wanted = {(i, s) for i, s in hidden.items() if s}
    precision, recall = len(added & wanted) / max(len(added), 1), len(added & wanted) / len(wanted)
    assert precision > 0.95 and recall > 0.8, (precision, recall, sorted(added - wanted)[:5], sorted(wanted - added)[:5])


def test_added_spans_follow_from_texts_and_not_from_the_layout(spark):
    rows, _ = corpus_with_planted_forms()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    one, many = (sorted(map(tuple, personal.personal_report(d).collect())) for d in (df.coalesce(1), df.repartition(7, F.xxhash64("text"))))
    assert one == many


def test_a_card_beside_other_figures_is_proposed_by_itself(spark):
    text = "x 7536784127813050 4845168114407329 y"
    found = spark.createDataFrame([(text,)], "t string").select(personal.proposals(F.col("t")).alias("p")).first().p
    assert sorted((p.kind, p.span.start, p.span.end) for p in found) == [("card", 2, 18), ("card", 2, 35), ("card", 19, 35)]


def test_thresholds_equal_trying_each():
    rng = random.Random(5)
    for _ in range(50):
        bins = [{"bin": b, "n": (n := rng.randint(1, 30)), "right": rng.randint(n * b // 100, n)} for b in rng.sample(range(101), 30)]
        choice = personal.Choice(precision=rng.choice([0.7, 0.9, 0.99]), support=rng.choice([1, 50, 300]))
        tried = [b / 100 for b in range(50, 101)
                 if (n := sum(r["n"] for r in bins if r["bin"] >= b)) >= choice.support
                 and sum(r["right"] for r in bins if r["bin"] >= b) >= choice.precision * n]
        assert personal.thresholds(bins, choice) == (min(tried) if tried else None)


def test_added_spans_do_not_overlap(spark):
    rows = trained(spark) + [(9000, "call (555) 010-9999 or 8.8.8.8 or +1 (555) 010-9999 or me@x.com")]
    spans = personal.personal_spans(spark.createDataFrame([(i, t, "", 0) for i, t in rows], SCHEMA)).where("doc_id = 9000").first()
    taken = sorted((s.start, s.end) for s in [*spans.base, *spans.added])
    assert all(a[1] <= b[0] for a, b in zip(taken, taken[1:])) and len(spans.base) == 3


def test_a_rare_kind_gets_a_limit_from_all_its_proposals(spark):
    """A flood of figures, and an address in fifty proposals: the sample alone holds too few to calibrate on."""
    rows = [(i, f"order id {10000000 + 37 * i} shipped") for i in range(6000)]
    rows += [(10_000 + i, f"text {i} mail user{i}@example{i % 9}.com today") for i in range(120)] + [(20_000, "text mail someone @ example3.com today")]
    choice = personal.Choice(sample=400)
    out = personal.personal_report(spark.createDataFrame(rows, "doc_id bigint, text string"), choice=choice).collect()
    assert [r.spans for r in out if r.doc_id == 20_000] == ["email:10:32"]
    assert all(r.spans == "" for r in out if r.doc_id < 10_000)


def test_shares_of_the_fit():
    shares = personal.shares_fitted({"email": 100, "phone": 10 ** 9, "card": 10 ** 7}, 20_000)
    assert shares["email"] == 0.75 and round(shares["phone"] * 10 ** 9) == round(shares["card"] * 10 ** 7) == 7462
    assert set(personal.shares_fitted({"email": 8, "phone": 9000}, 20_000).values()) == {0.75}


def test_redaction_and_edges(spark):
    df = spark.createDataFrame([(1, "é me@x.com, 8.8.8.8", "", 0), (2, "nothing", "", 0), (3, None, "", 0)], SCHEMA)
    got = {r.doc_id: r.text for r in personal.redacted(df).collect()}
    assert got[1] == "é [EMAIL], [IP]" and got[2] == "nothing"
    assert personal.personal_report(df.where("false")).count() == 0
    twice = spark.createDataFrame([(1, "a@b.c", "", 0), (1, "a@b.c", "", 0), (None, "a@b.c", "", 0)], SCHEMA)
    assert [r.n_email for r in personal.personal_report(twice).collect()] == [1, 1, 1]


def test_redaction_goes_by_row(spark):
    """Rows without an id, rows that share an id, and spans that overlap in part or lie in one another."""
    rows = [(None, "é me@x.com"), (None, "8.8.8.8 up"), (None, None), (7, "to a@b.c"), (7, "a@b.c and 1.1.1.1"), (7, "nothing"),
            (8, "+1 2345678901.foo@x.com, so"), (9, "x 4111 1111 1111 1111@x.com 4111111111111111@x.com 8.8.8.8")]
    got = personal.redacted(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted([
        (None, "é [EMAIL]"), (None, "[IP] up"), (None, None), (7, "to [EMAIL]"), (7, "[EMAIL] and [IP]"), (7, "nothing"),
        (8, "[PHONE], so"), (9, "x [CARD] [EMAIL] [IP]")], key=repr)


def test_luhn(spark):
    df = spark.createDataFrame([("4111 1111 1111 1111",), ("4111111111111112",), ("x",), ("0",)], "m string")
    assert [r[0] for r in df.select(personal.luhn(F.col("m"))).collect()] == [True, False, False, True]
