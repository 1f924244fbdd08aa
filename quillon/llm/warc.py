"""WARC records in ZIP-packaged archives, and a reader that never unpacks them.

An archive is a ZIP file with stored (uncompressed) members: archive/data.warc.gz, a gzip member
per record, and indexes/index.cdxj, a line per record with its offset and length. The reader
takes the ZIP's end record (ZIP64's too) and central directory by range, finds where the stored
members' bytes begin, and then reads just the index and the records' ranges.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.common import byte_batches, written

RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def opened(uri: str, mode: str) -> BinaryIO:
    """A file of the shared folder, for random reads ("r") or for one sequential write ("w")."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return open(unquote(parts.path), mode + "b")
    system, path = pyarrow.fs.FileSystem.from_uri(uri)
    return system.open_input_file(path) if mode == "r" else system.open_output_stream(path)


# --- records -----------------------------------------------------------------------------------


def named(page: str | None) -> str:
    """A page's record id, without spaces or line breaks; a null id has a name of its own."""
    return "<urn:page>" if page is None else f"<urn:page:{quote(page, safe='')}>"


def page_of(name: str | None) -> str | None:
    return unquote(name[len("<urn:page:") : -1]) if name and name.startswith("<urn:page:") else None


def record(page: str | None, url: str | None, kind: str, digest: str, payload: bytes | None, n: int, refers_to: str | None, date: str) -> bytes:
    """A response record with its payload, or a revisit record with HTTP headers only; a null page or URL reads back as null."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {named(page)}", f"WARC-Date: {date}"]
    if url is not None:
        target = quote(url, safe=chr(37) + ":/?#[]@!$&()*+,;=~")
        head.append(f"WARC-Target-URI: {target}")
        if target != url:
            head.append(f"X-Page-URL: {json.dumps(url)}")  # as it was, on one line
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {n}"]
    if kind == "revisit":
        head += [f"WARC-Refers-To: {named(refers_to)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and payload of one record; a payload that doesn't fit its digest is an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    if fields["warc-type"] == "response" and f"sha1:{hashlib.sha1(payload).hexdigest()}" != fields["warc-payload-digest"]:
        raise ValueError(f"payload of {fields['warc-record-id']} doesn't fit its digest")
    return fields, payload


# --- ZIP directory ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    start: int  # of the member's bytes in the archive


def _range(f: BinaryIO, start: int, n: int) -> bytes:
    f.seek(start)
    out = f.read(n)
    if len(out) != n:
        raise ValueError("archive ends early")
    return out


def directory(f: BinaryIO) -> dict[str, Member]:
    """The members of a ZIP or ZIP64 archive, from its end record and central directory."""
    f.seek(0, 2)
    total = f.tell()
    tail = _range(f, max(0, total - 65_557), min(total, 65_557))
    at = tail.rfind(b"PK\x05\x06", 0, max(0, len(tail) - 18))
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no ZIP end record")
    count, size, start = struct.unpack_from("<HII", tail, at + 10)
    end = total - len(tail) + at
    if end >= 20 and (count == 0xFFFF or 0xFFFFFFFF in (size, start)) and (locator := _range(f, end - 20, 20))[:4] == b"PK\x06\x07":
        record64 = _range(f, struct.unpack_from("<Q", locator, 8)[0], 56)
        if record64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record where its locator points")
        count, size, start = struct.unpack_from("<QQQ", record64, 32)
    central, at, out = _range(f, start, size), 0, {}
    for _ in range(count):
        if central[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", central, at + 8)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", central, at + 20)
        offset = struct.unpack_from("<I", central, at + 42)[0]
        name = central[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra, x = central[at + 46 + n_name : at + 46 + n_name + n_extra], 0
        while x + 4 <= len(extra):
            tag, n = struct.unpack_from("<HH", extra, x)
            if tag == 1:  # ZIP64: only the values that don't fit above, in this order
                values = iter(struct.unpack_from(f"<{n // 8}Q", extra, x + 4))
                plain = next(values) if plain == 0xFFFFFFFF else plain
                packed = next(values) if packed == 0xFFFFFFFF else packed
                offset = next(values) if offset == 0xFFFFFFFF else offset
            x += 4 + n
        local = _range(f, offset, 30)
        if local[:4] != b"PK\x03\x04":
            raise ValueError(f"no local header for {name}")
        out[name] = Member(name, method, packed, offset + 30 + sum(struct.unpack_from("<HH", local, 26)))
        at += 46 + n_name + n_extra + n_comment
    return out


def stored_member(members: dict[str, Member], name: str) -> Member:
    if name not in members:
        raise ValueError(f"no member {name}")
    if members[name].method:
        raise ValueError(f"{name} is compressed; only stored members can be read by range")
    return members[name]


# --- Spark jobs ---------------------------------------------------------------------------------


def typed(pages: DataFrame, least: int = 1000, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page, url, html, n, digest, refers_to): refers_to is the response's page where this one revisits it.

    Of pages with equal payloads of `least` bytes or more the largest id is the response; rows that
    share that id are all responses, as are all where no id is known. Digests that occur once
    never reach the join, and of the others only one row each. A null html is an empty payload, a null url
    stays null, equal rows each have a record, and other columns are not read.
    """
    text = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), text.alias("html"), F.octet_length(text).cast("long").alias("n"), F.sha1(text.cast("binary")).alias("digest"))
    twice = rows.filter(F.col("n") >= least).groupBy("digest").agg(F.max("page").alias("keeper"), F.count(F.lit(1)).alias("k")).filter("k > 1").select("digest", "keeper")
    known = rows.join(twice, "digest", "left")
    again = (F.col("n") >= least) & (F.col("page").isNull() | (F.col("page") < F.col("keeper")))
    return known.select("page", "url", "html", "n", "digest", F.when(again, F.col("keeper")).alias("refers_to"))


def archived(records: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", roll: int = 256 << 20) -> DataFrame:
    """Write typed() rows into archives below `folder` of about `roll` bytes at most; the manifest (archive, records).

    Every attempt of a task writes files of its own name, and the manifest lists those of the
    attempts that counted, so retries and lost executors leave unlisted files at worst.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counts, out = [], [], None
        for batch in batches:
            for page, url, html, n, digest, ref in zip(*[batch.column(c) for c in ("page", "url", "html", "n", "digest", "refers_to")], strict=True):
                if out is None:
                    names.append(f"{folder.rstrip('/')}/{uuid.uuid4().hex}.zip")
                    counts.append(0)
                    out = _Writer(names[-1], date)
                out.add(page.as_py(), url.as_py(), html.as_buffer(), n.as_py(), digest.as_py(), ref.as_py())
                counts[-1] += 1
                if out.offset >= roll:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["archive", "records"])

    byte_batches(records.sparkSession)
    light = records.select(F.col("page").cast("string").alias("page"), "url", "html", "n", "digest", F.col("refers_to").cast("string").alias("refers_to"))
    return written(light.mapInArrow(run, "archive string, records long"), "manifest")


class _Writer:
    def __init__(self, uri: str, date: str):
        self.file, self.date, self.offset, self.lines = opened(uri, "w"), date, 0, []
        self.zip = zipfile.ZipFile(self.file, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(RECORDS), "w", force_zip64=True)

    def add(self, page: str | None, url: str | None, payload, n: int, digest: str, refers_to: str | None) -> None:
        kind = "response" if refers_to is None else "revisit"
        raw = record(page, url, kind, digest, bytes(payload) if refers_to is None else None, n, refers_to, self.date)
        squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
        data = squeeze.compress(raw) + squeeze.flush()
        self.member.write(data)
        self.lines.append(f"{named(page)} {self.date} " + json.dumps({"url": url, "digest": digest, "type": kind, "offset": self.offset, "length": len(data), "filename": RECORDS}))
        self.offset += len(data)

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join([*self.lines, ""]))
        self.zip.close()
        self.file.close()


def located(manifest: DataFrame, span: int = 4 << 20) -> DataFrame:
    """(archive, start, lengths): runs of neighbouring records of about `span` bytes, from the archives' indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                with opened(archive, "r") as f:
                    members = directory(f)
                    base, index = stored_member(members, RECORDS), stored_member(members, INDEX)
                    entries = [json.loads(x.split(b" ", 2)[2]) for x in _range(f, index.start, index.size).split(b"\n") if x]
                starts, lengths, end = [], [], None
                for e in sorted(entries, key=lambda e: e["offset"]):
                    if e["offset"] != end or sum(lengths[-1]) >= span:
                        starts.append(base.start + e["offset"])
                        lengths.append([])
                    lengths[-1].append(e["length"])
                    end = e["offset"] + e["length"]
                yield pa.RecordBatch.from_arrays([pa.array([archive] * len(starts), pa.string()), pa.array(starts, pa.int64()), pa.array(lengths, pa.list_(pa.int64()))], ["archive", "start", "lengths"])

    return manifest.select("archive").mapInArrow(run, "archive string, start long, lengths array<long>")


def read_back(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """A row per record of the archives: page, url, payload_bytes, payload_digest, record_type, refers_to (and payload).

    Ids and URLs come back as they were, whatever their characters; an empty manifest has no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * payloads]
        for batch in batches:
            for archive, start, lengths in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                with opened(archive, "r") as f:
                    raw = _range(f, start, sum(lengths))
                rows, at = [], 0
                for n in lengths:
                    fields, payload = parsed(zlib.decompress(raw[at : at + n], 31))
                    at += n
                    ids = [page_of(fields.get(x)) for x in ("warc-record-id", "warc-refers-to")]
                    url = json.loads(u) if (u := fields.get("x-page-url")) else fields.get("warc-target-uri")
                    kind = fields["warc-type"]
                    size = len(payload) if kind == "response" else int(fields["x-payload-length"])
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    rows.append((ids[0], url, size, digest, kind, ids[1], *[payload] * payloads))
                types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.binary()] * payloads]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    spans = located(manifest)
    n = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return spans.repartition(n).mapInArrow(run, "page string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string" + ", payload binary" * payloads)
