"""WARC records in ZIP packages: written by every task, found by directory and index, read by ranges.

Pages with equal payloads share one response record; the others become revisits of it. Digests are
grouped with partial aggregation, and only those that repeat are joined back. Each task writes
packages of bounded size to the shared folder: a stored member with the records, each compressed on
its own, and an index of where they begin. A written list names the packages of tasks that
ended well, so what a lost task left behind is never read. The reader parses the directories of
each package, locates the stored member and the index, deals out the records' places, and reads
each record by its range.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm import zip_reader
from veilframe.llm.common import SENT_BYTES, whole
from veilframe.session import new_path, written, written_and_counted

RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES = 64 << 20
PACKAGE_RECORDS = 50_000
READ_BYTES = 4 << 20
RECORDS_DEALT = 512
TASKS_A_PACKAGE = 4
DATE = "1970-01-01T00:00:00Z"  # pages have no time of their own
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:page:"


def opened(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path of Spark's, and the path in it."""
    if uri.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pa.fs.LocalFileSystem(), uri
    return pa.fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_line(name: str, value: str) -> str:
    """A header; control characters, which would end it, are written in percent form."""
    return f"{name}: " + re.sub(r"[\x00-\x1f\x7f]", lambda c: f"%{ord(c[0]):02X}", value) + "\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    if not revisit:
        block += payload
    head = "WARC/1.1\r\n" + header_line("WARC-Type", "revisit" if revisit else "response")
    head += header_line("WARC-Record-ID", f"<{ID}{'' if page_id is None else page_id}>") + header_line("WARC-Date", DATE)
    if url is not None:
        head += header_line("WARC-Target-URI", url)
    if revisit:
        head += header_line("WARC-Profile", PROFILE) + header_line("WARC-Refers-To", f"<{ID}{refers_to}>")
    head += header_line("WARC-Payload-Digest", f"sha1:{digest_of(payload)}")
    head += header_line("Content-Type", "application/http; msgtype=response") + header_line("Content-Length", str(len(block)))
    return head.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def unpacked(raw: bytes) -> bytes:
    """A record as it lies in an archive, compressed or plain."""
    return zlib.decompress(raw, 16 + zlib.MAX_WBITS) if raw[:2] == b"\x1f\x8b" else raw


def parsed(raw: bytes) -> dict | None:
    """What is read of a record; None of one that is neither a response, a resource nor a revisit.

    Ids are text; `page_id` and `refers_to` are the numbers of ids that this writer gives, and null for
    others. A missing digest is worked out, of a revisit it stays null; a SHA-1 that is there must be right.
    """
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogateescape").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    named: dict[str, str] = {}
    for line in lines[1:]:
        key, colon, value = line.partition(":")
        if colon:
            last = key.strip().lower()
            named[last] = value.strip()
        elif named:  # a header that goes on in the next line
            named[last] += " " + line.strip()
    kind = named.get("warc-type", "").lower()
    if kind not in ("response", "resource", "revisit"):
        return None
    block = rest[:int(named["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", block)
    revisit = kind == "revisit"
    given = named.get("warc-payload-digest")
    digest = given and given.removeprefix("sha1:")
    size: int | None = len(payload)
    if revisit:
        length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        size = int(length[1]) if length else None
    elif given is None:
        digest = digest_of(payload)
    elif given.startswith("sha1:") and len(digest) == 32 and digest_of(payload) != digest.upper():
        raise ValueError(f"the payload of {named.get('warc-record-id')} does not have its digest")

    def name(header: str) -> str | None:
        return named[header].strip("<>") if header in named else None

    def page(value: str | None) -> int | None:
        return int(value.removeprefix(ID)) if value and re.fullmatch(ID + "-?[0-9]{1,19}", value) else None

    own, other = name("warc-record-id"), name("warc-refers-to")
    return {"page_id": page(own), "url": name("warc-target-uri"), "payload_bytes": size, "payload_digest": digest,
            "record_type": kind, "refers_to": page(other), "record_id": own, "refers_to_id": other,
            "payload": None if revisit else payload}


class Package:
    """One ZIP package while it is written, front to back."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"
        system, place = opened(self.path)
        system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        self.stream = system.open_output_stream(place)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(RECORDS), "w", force_zip64=True)
        self.at, self.index = 0, io.StringIO()
        self.records = 0

    def add(self, raw: bytes, entry: dict) -> None:
        packer = zlib.compressobj(1, zlib.DEFLATED, 16 + zlib.MAX_WBITS)
        packed = packer.compress(raw) + packer.flush()
        self.member.write(packed)
        self.index.write(f"{entry.pop('key')} 19700101000000 " + json.dumps(entry | {"offset": self.at, "length": len(packed), "filename": RECORDS}) + "\n")
        self.at += len(packed)
        self.records += 1

    def close(self) -> tuple[str, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), self.index.getvalue())
        self.zip.close()
        self.stream.close()
        return self.path, self.records


def write_packages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   least_bytes: int = 0) -> DataFrame:
    """Writes a record for each row; returns the packages (path, records), themselves a written table.

    Of payloads that are equal and have at least `least_bytes` bytes, the row with the largest id
    is the response and the others are revisits of it; a null payload is an empty one. Rows that
    repeat the largest id are responses each; where no row has an id, all are.
    """
    html = F.encode(whole("html"), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).select(
        "id", "url", "html", F.unhex(F.sha1(html)).alias("digest"), F.octet_length(html).alias("bytes"))
    groups = rows.where(f"bytes >= {int(least_bytes)}").groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("largest"))
    repeated, count = written_and_counted(
        groups.where("n > 1 AND largest IS NOT NULL").select(F.col("digest").alias("same"), "largest"), "warc_repeated")
    if count * 128 <= SENT_BYTES:
        repeated = F.broadcast(repeated)
    joined = rows.join(repeated, F.col("digest") == F.col("same"), "left")
    revisit = F.col("largest").isNotNull() & ~F.col("id").eqNullSafe(F.col("largest"))
    joined = joined.select("id", "url", "html", "largest", revisit.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for id_, url, text, largest, again in zip(*(batch.column(k) for k in range(5))):
                package = package or Package(folder)
                payload, revisits = (text.as_py() or "").encode("utf-8", "surrogatepass"), again.as_py()
                key = re.sub(r"\s", "%20", (url.as_py() or "-").split("://")[-1]) or "-"
                package.add(record(id_.as_py(), url.as_py(), payload, largest.as_py() if revisits else None, revisits),
                            {"key": key, "url": url.as_py(), "mime": "warc/revisit" if revisits else "text/html"})
                if package.at >= PACKAGE_BYTES or package.records >= PACKAGE_RECORDS:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())],
                                         ["path", "records"])

    return written(joined.mapInArrow(run, "path string, records long"), "warc_packages")


def locate(paths: Iterator[str]) -> Iterator[tuple[str, int, int, int]]:
    """(path, start, length, number) of every record of the packages, by directory and index."""
    for path in paths:
        system, place = opened(path)
        with system.open_input_file(place) as file:
            read = lambda at, n: file.read_at(n, at)
            listed = {m.name: m for m in zip_reader.members(read, file.size())}
            starts = {}
            number = 0
            seen = set()
            for name, member in listed.items():
                if not re.fullmatch(r"indexes/.*\.cdxj?(\.gz)?", name):
                    continue
                index = member.content(read)
                for at, offset, length in entries((gzip.decompress(index) if name.endswith(".gz") else index).decode(), name):
                    at = at if at in listed else f"archive/{at}"
                    if at not in listed:
                        raise ValueError(f"{name} lists {at}, which is not in {path}")
                    if (at, offset) in seen:  # indexes may list a record twice
                        continue
                    seen.add((at, offset))
                    if at not in starts:
                        if listed[at].method != zip_reader.STORED:
                            raise ValueError(f"{at} is not stored, so it has no ranges")
                        starts[at] = listed[at].begin(read)
                    yield path, starts[at] + offset, length, number
                    number += 1
            lost = [n for n in listed if re.fullmatch(r"archive/.*\.warc(\.gz)?", n) and n not in starts]
            if lost:
                raise ValueError(f"no index of {path} lists {', '.join(lost)}")


def entries(index: str, name: str) -> Iterator[tuple[str, int, int]]:
    """(member, offset, length) of every line of an index: JSON behind key and time, or columns named by a CDX header."""
    columns = None
    for line in index.splitlines():
        if line.lstrip().startswith("CDX "):
            columns = line.split()[1:]
            if not {"g", "V", "S"} <= set(columns):
                raise ValueError(f"{name} names no member, offset and length of its records")
        elif line.strip() and not line.startswith("!"):
            if columns:
                found = dict(zip(columns, line.split()))
                yield found["g"], int(found["V"]), int(found["S"])
            else:
                entry = json.loads(line.split(" ", 2)[2])
                yield entry["filename"], int(entry["offset"]), int(entry["length"])


def read_packages(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """The responses, resources and revisits in the packages (`path`): page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, record_id, refers_to_id and, if asked for, the payload. Records of other types are
    passed over, plain archives are read like compressed ones, and a payload with a wrong SHA-1 fails the read."""
    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            held = []
            for row in locate(iter(pdf["path"])):
                held.append(row)
                if len(held) == 65536:
                    yield pd.DataFrame(held, columns=["path", "start", "length", "number"])
                    held = []
            if held:
                yield pd.DataFrame(held, columns=["path", "start", "length", "number"])

    # Places are small and what lies there is not, so the numbers of tasks follow the packages.
    count = packages.count()
    tasks = max(TASKS_A_PACKAGE * count, int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = packages.select("path").repartition(max(1, count), "path").mapInPandas(places, "path string, start long, length long, number long")
    dealt = found.repartition(tasks, "path", F.floor(F.col("number") / RECORDS_DEALT)).sortWithinPartitions("path", "start")
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()), ("refers_to_id", pa.string())] + [("payload", pa.binary())] * payloads
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, refers_to_id string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = name = None
        for batch in batches:
            rows = list(zip(*(batch.column(k).to_pylist() for k in range(3))))
            at = 0
            while at < len(rows):
                path, start, length = rows[at]
                stop = at + 1  # records that lie side by side are read at once
                while stop < len(rows) and rows[stop][0] == path and rows[stop][1] == start + length and length < READ_BYTES:
                    length += rows[stop][2]
                    stop += 1
                if path != name:
                    system, place = opened(path)
                    file, name = system.open_input_file(place), path
                raw = memoryview(file.read_at(length, start))
                records = [parsed(unpacked(bytes(raw[s - start:s - start + n]))) for _, s, n in rows[at:stop]]
                records = [r for r in records if r]
                yield pa.RecordBatch.from_arrays([pa.array([r[f] for r in records], kind) for f, kind in fields], [f for f, _ in fields])
                at = stop

    return dealt.mapInArrow(run, schema + ", payload binary" * payloads)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Writes the pages as packages in the shared folder and reads them back: one row a page, without payloads.

    An empty table writes no package and gives no rows. Repeated rows are records each.
    """
    folder = new_path(pages.sparkSession, "warc")
    packages = write_packages(pages, folder, id_col, url_col, html_col, least_bytes)
    return read_packages(packages, payloads=False).select(
        F.col("page_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to")
