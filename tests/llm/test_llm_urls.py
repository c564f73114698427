"""URL filter and WARC packages."""

import gzip
import io
import json
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilframe.llm import url_filter, warc, zip_reader
from veilframe.llm.queries import URL_RULES

PAGES = "page_id bigint, url string, listed string, maybe int"


def judged(spark, urls, listed=(), rules=URL_RULES):
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(urls)], PAGES)
    table = spark.createDataFrame([(u,) for u in listed], "url string")
    return {r.page_id: r for r in url_filter.filtered(pages, table, rules).collect()}


def test_hosts_paths_and_rules(spark):
    urls = ["http://a.ORG/x", "https://org", "http://EXAMPLE.org/es/1?q#f", "http://x.example.org/en/12", "http://b.com/fr/", "http://b.com/de/x",
            None, "no scheme", "ftp://h?x://y/z", "http://notexample.org/es/", "http://É.Com/fr/#a?b", "", "http://a.org"]
    got = judged(spark, urls)
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(len(urls))] == [
        ("a.org", "/x", "org/", "allow"), ("org", "", None, "allow"), ("example.org", "/es/1", "example.org/es/", "block"),
        ("x.example.org", "/en/12", "example.org/en/1", "block"), ("b.com", "/fr/", "com/fr/", "allow"), ("b.com", "/de/x", "com/de/", "block"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("h", "", None, "allow"), ("notexample.org", "/es/", "org/", "allow"),
        ("É.com", "/fr/", "com/fr/", "allow"), ("", "", None, "allow"), ("a.org", "", None, "allow")]


def test_listed_urls_are_met_in_any_spelling(spark):
    listed = ["https://www.Site.net/a/?b=2&a=1&utm_source=x#top", None, "nothing", "http://site.net/a?a=1&b=2"]
    urls = ["http://site.net:80/a?a=1&b=2", "http://site.net/a/?b=2&&a=1&ref=z", "http://site.net/a?a=1", "http://site.net/A?a=1&b=2", None]
    got = judged(spark, urls, listed)
    assert [got[i].verdict for i in range(5)] == ["block", "block", "allow", "allow", "allow"]


def test_a_full_filter_lets_candidates_through_but_no_false_verdict(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MOST_BLOCKS", 1)
    listed = [f"http://h{i}.net/p" for i in range(400)]
    got = judged(spark, [f"http://h{i}.net/p" for i in range(800)], listed, ())
    assert all(got[i].listed == (i < 400) for i in range(800))


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    urls = spark.range(4000).select(F.concat(F.lit("u"), F.col("id")).alias("url"))
    first, second = url_filter.hashes(F.col("url"))
    table = url_filter.bloom(urls.where("substr(url, 2) < 5"), urls.where("substr(url, 2) < 5").count())
    rows = urls.select("url", first.alias("a"), second.alias("b")).toPandas()
    hit = url_filter.may_hold(table, rows.a.to_numpy(np.int64), rows.b.to_numpy(np.int64))
    inside = rows.url.str[1:].astype(int) < 5
    assert hit[inside].all() and hit[~inside].mean() < 0.05


def test_empty_pages_and_repeats(spark):
    assert judged(spark, []) == {}
    pages = spark.createDataFrame([(1, "http://a.net/", "x", 1)] * 3 + [(None, "http://a.net/", "x", 1)], PAGES)
    out = url_filter.filtered(pages, spark.createDataFrame([("http://a.net",)], "url string")).collect()
    assert len(out) == 4 and all(r.verdict == "block" for r in out)


def packed(members, method=zipfile.ZIP_STORED, comment=b""):
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", method) as z:
        z.comment = comment
        for name, data in members:
            z.writestr(name, data)
    return held.getvalue()


def read_from(data):
    return lambda at, n: data[at:at + n]


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
def test_members_of_a_zip(method):
    members = [("a/x.txt", b"one" * 500), ("é.txt", b""), ("b.bin", bytes(range(256)) * 9)]
    data = packed(members, method, b"note PK\x05\x06 within")
    read = read_from(data)
    got = zip_reader.members(read, len(data))
    assert [(m.name, m.content(read)) for m in got] == members
    empty = packed([])
    assert zip_reader.members(read_from(empty), len(empty)) == []


def test_members_of_a_zip64(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    members = [(f"m{i}", bytes([65 + i]) * (30 * i)) for i in range(6)]
    data = packed(members)
    assert b"PK\x06\x06" in data and b"PK\x06\x07" in data
    read = read_from(data)
    assert [(m.name, m.content(read)) for m in zip_reader.members(read, len(data))] == members


def test_sizes_that_only_the_zip64_field_holds():
    extra = struct.pack("<HHH", 7, 2, 9) + struct.pack("<HHQQ", 1, 16, 5 << 32, 6 << 32)
    assert zip_reader.wide(extra, 0xFFFFFFFF, 3, 0xFFFFFFFF) == [5 << 32, 3, 6 << 32]
    with pytest.raises(ValueError):
        zip_reader.wide(b"", 0xFFFFFFFF)


@pytest.mark.parametrize("data", [b"", b"not a zip at all", b"PK\x05\x06" + b"\0" * 10])
def test_what_is_no_zip_is_refused(data):
    with pytest.raises(ValueError):
        zip_reader.members(read_from(data), len(data))


def test_records_survive_the_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "PACKAGE_RECORDS", 3)
    rows = [(1, "http://a/ x\r\ny", "same é"), (7, "http://b", "same é"), (3, None, "same é"), (4, "u", None), (5, "u", ""),
            (6, "u", "WARC/1.1\r\n\r\nlooks like one"), (None, "n", "same é"), (None, "m", "alone"), (8, "v", "x" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(2)
    made = warc.write_packages(pages, str(tmp_path / "archives"))
    assert made.count() >= 3 and made.agg(F.sum("records")).first()[0] == 9
    back = warc.read_packages(made).collect()
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in back}
    size = len("same é".encode())
    assert got == {(1, "revisit", 7, size), (7, "response", None, size), (3, "revisit", 7, size), (4, "revisit", 5, 0), (5, "response", None, 0),
                   (6, "response", None, 26), (None, "revisit", 7, size), (None, "response", None, 5), (8, "response", None, 300_000)}
    assert {bytes(r.payload) for r in back if r.page_id == 6} == {b"WARC/1.1\r\n\r\nlooks like one"}
    assert all(r.payload_digest == warc.digest_of(dict((p, (h or "").encode()) for p, _, h in rows)[r.page_id]) for r in back if r.page_id)
    names = zipfile.ZipFile(made.first().path.removeprefix("file:")).namelist()
    assert names == [warc.RECORDS, warc.INDEX]


def test_small_payloads_can_be_left_apart(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id bigint, url string, html string")
    made = warc.round_trip(pages, least_bytes=3).collect()
    assert {(r.page_id, r.record_type) for r in made} == {(1, "response"), (2, "response"), (3, "revisit"), (4, "response")}
    assert warc.round_trip(pages.where("false")).count() == 0


def test_a_damaged_payload_is_not_passed_on():
    raw = warc.record(1, "u", b"payload", None, False)
    with pytest.raises(ValueError):
        warc.parsed(raw.replace(b"payload", b"pay1oad"))


def test_indexes_of_other_forms_are_read_and_unlisted_archives_refused(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "one"), (2, "v", "two")], "page_id bigint, url string, html string").coalesce(1)
    made = zipfile.ZipFile(warc.write_packages(pages, str(tmp_path / "archives")).first().path.removeprefix("file:"))
    records, index = made.read(warc.RECORDS), made.read(warc.INDEX)
    lines = [json.loads(line.split(" ", 2)[2]) for line in index.decode().splitlines()]
    columns = " CDX N b S V g\n" + "".join(f"k 20200101000000 {e['length']} {e['offset']} {e['filename'].removeprefix('archive/')}\n" for e in lines)
    forms = {"a.cdxj.gz": gzip.compress(index), "a.cdx": columns.encode(), "a.cdx.gz": gzip.compress(columns.encode()), "a.cdxj": index}
    expected = sorted(warc.locate(iter([made.filename])))
    assert len(expected) == 2

    def package(name, members):
        with zipfile.ZipFile(tmp_path / name, "w", zipfile.ZIP_STORED) as out:
            for member, data in {warc.RECORDS: records, **members}.items():
                out.writestr(member, data)
        return str(tmp_path / name)

    for n, (form, data) in enumerate(forms.items()):
        path = package(f"{n}.wacz", {f"indexes/{form}": data})
        back = warc.read_packages(spark.createDataFrame([(path,)], "path string")).collect()
        assert sorted((r.page_id, bytes(r.payload)) for r in back) == [(1, b"one"), (2, b"two")]
    both = package("both.wacz", {f"indexes/{form}": data for form, data in forms.items()})
    assert len(list(warc.locate(iter([both])))) == 2
    for members in ({}, {"indexes/a.cdxj": index, "archive/other.warc.gz": records}):
        with pytest.raises(ValueError, match="lists archive/"):
            list(warc.locate(iter([package("lost.wacz", members)])))


def foreign(kind, block, **headers):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nContent-Length: {len(block)}\r\n"
    head += "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in headers.items())
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


@pytest.mark.parametrize("packed", [True, False])
def test_archives_of_other_writers(spark, tmp_path, packed):
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"
    records = [
        foreign("warcinfo", b"software: other\r\n", WARC_Record_ID="<urn:uuid:0>"),
        foreign("request", b"GET / HTTP/1.1\r\n\r\n", WARC_Record_ID="<urn:uuid:1>"),
        foreign("response", http + b"one", WARC_Record_ID="<urn:uuid:2>", WARC_Target_URI="<http://a/>"),
        foreign("response", http + b"two", WARC_Record_ID="<urn:uuid:3>", WARC_Payload_Digest="sha256:abc", X_Long="a\r\n b"),
        foreign("resource", b"three", WARC_Record_ID="<urn:uuid:4>", WARC_Payload_Digest=f"sha1:{warc.digest_of(b'three')}"),
        foreign("revisit", http, WARC_Record_ID="<urn:uuid:5>", WARC_Refers_To="<urn:uuid:2>"),
    ]
    member, at, index, data = "archive/x.warc" + ".gz" * packed, 0, "", b""
    for raw in records:
        raw = gzip.compress(raw) if packed else raw
        index += "k 2020 " + json.dumps({"filename": member, "offset": str(at), "length": str(len(raw))}) + "\n"
        at, data = at + len(raw), data + raw
    with zipfile.ZipFile(tmp_path / "x.wacz", "w", zipfile.ZIP_STORED) as out:
        out.writestr(member, data)
        out.writestr("indexes/x.cdxj", index)
    got = warc.read_packages(spark.createDataFrame([(str(tmp_path / "x.wacz"),)], "path string")).collect()
    found = {(r.record_id, r.record_type, r.payload and bytes(r.payload), r.payload_bytes, r.payload_digest, r.refers_to_id, r.page_id) for r in got}
    assert found == {("urn:uuid:2", "response", b"one", 3, warc.digest_of(b"one"), None, None),
                     ("urn:uuid:3", "response", b"two", 3, "sha256:abc", None, None),
                     ("urn:uuid:4", "resource", b"three", 5, warc.digest_of(b"three"), None, None),
                     ("urn:uuid:5", "revisit", None, None, None, "urn:uuid:2", None)}
    assert {r.url for r in got} == {None, "http://a/"}
