"""WARC archives of pages, and revisit resolution.

``write_archives`` writes a response record for each page, ``read_headers`` reads one row for each record of archives (its
place, type, ids and the size and SHA-1 of its payload), and ``deduplicate`` writes archives in which equal payloads are
kept once: headers are shuffled by payload digest, the response of smallest page_id is the original of its digest, and
all other records of that digest, revisit records of the given archives too, are joined to it. Each archive is then read
again by one task and written with fresh headers next to its resolved rows, so payloads are never shuffled.
``read_back`` joins revisit records to the responses they name.

Archives are gzip files with one member for each record (plain files can be read too), begin with a warcinfo record and
are closed at about ROLL bytes. They are written under a name of their own and renamed, so that a repeated task leaves
the same file; record ids come from the run and the record's place. Records of other types pass as they are.

Null html is an empty payload; a page without url has no target URI, one without page_id no Page-Id. Payloads of fewer
than ``least`` bytes are all responses. Without a page_id a record comes after all others of its digest, of equal
page_ids the earlier place comes first; equal rows are records of their own. Payloads of any length are whole, one at a
time; those of one SHA-1 are held equal. Control characters and spaces of urls are written as %XX. Extra columns are
ignored, whatever their names. An empty table gives no archive. An archive that is cut off or none is an error.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import itertools
import re
import time
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from atomframe.llm.common import chunks, column, give_back, parts, saved, shared_dir

#: Compressed bytes after which a new archive is begun.
ROLL = 64 << 20
#: Effort of packing: an archive that is read and written again soon is packed lightly.
LEVEL = 3
#: Tasks that read archives, at most.
READERS = 20_000
# The names and texts of the format.
VERSION, HTTP = "WARC/1.1", "application/http; msgtype=response"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "name string, records long, bytes long"
HEADERS = "file string, number long, type string, record_id string, uri string, date string, page_id string, n_bytes long, digest string, listed string, refers_id string"


def _open(folder: str):
    return pafs.FileSystem.from_uri(folder) if ":" in folder.split("/")[0] else (pafs.LocalFileSystem(), folder)


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record; fields without a value are left out."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def escaped_url(url: str | None) -> str | None:
    return url if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record_id(run: str, name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.UUID(run), name)}>"


class Archives:
    """Writes records to files of about ``roll`` bytes; ``files`` has those that are whole."""

    def __init__(self, folder: str, stem: str, run: str, date: str, roll: int):
        self.fs, self.base = _open(folder)
        self.stem, self.run, self.date, self.roll = stem, run, date, roll
        self.files: list[tuple[str, int, int]] = []
        self.out = None

    def add(self, fields: list[tuple[str, str | None]], block: bytes) -> None:
        if self.out is None:
            self.name, self.records, self.size = f"{self.stem}-{len(self.files):04d}.warc.gz", 0, 0
            self.aside = f"{self.base}/.{self.name}-{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(self.aside, compression=None)
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        data = packer.compress(record(fields, block)) + packer.flush()
        self.out.write(data)
        self.records += 1
        self.size += len(data)
        if self.size >= self.roll:
            self.close()

    def info(self) -> None:
        """The first record of an archive."""
        if self.out is None:
            block = b"software: atomframe\r\nformat: WARC File Format 1.1\r\n"
            self.add([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(self.run, f"{self.stem}/{len(self.files)}/info")), ("WARC-Date", self.date), ("Content-Type", "application/warc-fields")], block)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.aside, f"{self.base}/{self.name}")
            self.files.append((self.name, self.records, self.size))
            self.out = None

    def report(self) -> pa.RecordBatch:
        self.close()
        names, records, sizes = zip(*self.files, strict=True) if self.files else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())], ["name", "records", "bytes"])


def response_fields(new_id: str, date: str | None, uri: str | None, page_id: str | None, payload: bytes, block: bytes) -> list[tuple[str, str | None]]:
    return [
        ("WARC-Type", "response"), ("WARC-Record-ID", new_id), ("WARC-Date", date), ("WARC-Target-URI", uri), ("Page-Id", page_id),
        ("WARC-Payload-Digest", f"sha1:{sha1(payload)}"), ("WARC-Block-Digest", f"sha1:{sha1(block)}"), ("Content-Type", HTTP),
    ]


def _writer(folder: str, run: str, date: str, roll: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = Archives(folder, f"part-{TaskContext.get().partitionId():06d}", run, date, roll), itertools.count()
        for batch in chunks(batches, "html"):
            for page, url, html in zip(*(column(batch, c) for c in ("page_id", "url", "html")), strict=True):
                payload = (html.as_py() or "").encode()
                block = http_head(len(payload)) + payload
                out.info()
                out.add(response_fields(record_id(run, f"{out.stem}/{next(n)}"), date, escaped_url(url.as_py()), page.as_py(), payload, block), block)
        yield out.report()

    return write


def now() -> str:
    return time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())


def new_folder(folder: str) -> None:
    fs, base = _open(folder)
    fs.create_dir(base, recursive=True)


def write_archives(pages: DataFrame, folder: str, date: str | None = None, roll: int = ROLL) -> DataFrame:
    """A response record for each row (page_id, url, html), in archives below ``folder``, as the table's tasks read them.
    One row (name, records, bytes) for each archive."""
    new_folder(folder)
    rows = pages.select(F.col("page_id").cast("string").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return saved(rows.mapInArrow(_writer(folder, uuid.uuid4().hex, date or now(), roll), FILES), "archives")


def read_records(stream) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Fields and block of each record of an open (unpacked) archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields: list[tuple[str, str]] = []
        while (line := stream.readline()).strip():
            if line[:1] in b" \t" and fields:  # a value goes on
                fields[-1] = (fields[-1][0], f"{fields[-1][1]} {line.strip().decode()}".strip())
            else:
                name, _, value = line.partition(b":")
                fields.append((name.strip().decode(), value.strip().decode()))
        length = int(dict((k.lower(), v) for k, v in fields).get("content-length", "-1"))
        block = stream.read(length) if length >= 0 else b""
        if not line or len(block) != length:
            raise ValueError("a WARC record is cut off")
        yield [x for x in fields if x[0].lower() != "content-length"], block


def archive(fs: pafs.FileSystem, path: str) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """The records of a file, packed or not; errors name the file."""
    with fs.open_input_stream(path, compression=None) as f:
        plain = io.BufferedReader(f, 1 << 20)
        packed = plain.peek(2)[:2] == b"\x1f\x8b"
        try:
            yield from read_records(io.BufferedReader(gzip.GzipFile(fileobj=plain), 1 << 20) if packed else plain)
        except (EOFError, ValueError, OSError) as e:
            raise ValueError(f"{path}: {e}") from e


def payload_of(fields: dict[str, str], block: bytes) -> bytes:
    """What follows the HTTP head, or the block of a record without one."""
    return block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block


def _bare(digest: str | None) -> str | None:
    return digest and digest.rpartition(":")[2].upper()


def _headers(folder: str):
    names = [x.split()[0] for x in HEADERS.split(", ")]
    kinds = [pa.int64() if x.endswith("long") else pa.string() for x in HEADERS.split(", ")]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True) if rows else [()] * len(names), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        for batch in batches:
            for file in column(batch, "name").to_pylist():
                rows = []
                for number, (fields, block) in enumerate(archive(fs, f"{base}/{file}")):
                    f = {k.lower(): v for k, v in fields}
                    kind, listed = f.get("warc-type"), _bare(f.get("warc-payload-digest"))
                    payload = payload_of(f, block) if kind == "response" else None
                    n, digest = (None, listed) if payload is None else (len(payload), sha1(payload))
                    rows.append((file, number, kind, f.get("warc-record-id"), f.get("warc-target-uri"), f.get("warc-date"), f.get("page-id"), n, digest, listed, f.get("warc-refers-to")))
                    if len(rows) == 5000:
                        yield packed(rows)
                        rows = []
                yield packed(rows)
        give_back()

    return run


def read_headers(files: DataFrame, folder: str) -> DataFrame:
    """One row for each record of the archives (name) below ``folder``: file, number (its place there, from 0), type,
    record_id, uri, date, page_id, n_bytes and digest of a response's payload (of others, the digest they list), the
    listed digest, and the id of the record it refers to."""
    spread = files.select("name").repartition(max(1, min(files.count(), READERS)))
    return spread.mapInArrow(_headers(folder), HEADERS)


#: What a revisit says of its original.
ORIGINAL = ("record_id", "uri", "date")


def resolved(headers: DataFrame, least: int = 0) -> DataFrame:
    """``headers`` (a saved table) with the ``original`` of each record whose payload is that of an earlier one: the
    response of smallest page_id among those of its digest. One row for each digest is joined to all."""
    number = F.expr("try_cast(page_id as bigint)")
    order = F.struct(number.isNull().alias("odd"), number.alias("n"), F.col("page_id").isNull().alias("none"), "page_id", "file", "number", *ORIGINAL)
    firsts = headers.where("type = 'response'").where(F.col("n_bytes") >= least).groupBy("digest").agg(F.min(order).alias("first"))
    same = (F.col("first.file") == F.col("file")) & (F.col("first.number") == F.col("number"))
    original = F.when(F.col("type").isin("response", "revisit") & ~same, F.struct(*[F.col(f"first.{c}").alias(c) for c in ORIGINAL]))
    return headers.join(firsts, "digest", "left").select("file", "number", "digest", original.alias("original"))


def _rewriter(source: str, target: str, run: str, date: str, roll: int):
    def fresh(fields: list[tuple[str, str]], block: bytes, row: dict) -> tuple[list, bytes]:
        """Headers and block of a record in the new archive."""
        f = {k.lower(): v for k, v in fields}
        kind, own = f.get("warc-type"), record_id(run, f.get("warc-record-id", ""))
        if kind not in ("response", "revisit"):
            return fields, block
        if (first := row["original"]) is not None:
            head, gap, _ = block.partition(b"\r\n\r\n") if f.get("content-type", "").startswith("application/http") else (b"", b"", b"")
            return [
                ("WARC-Type", "revisit"), ("WARC-Record-ID", own), ("WARC-Date", f.get("warc-date")), ("WARC-Target-URI", f.get("warc-target-uri")), ("Page-Id", f.get("page-id")),
                ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(run, first["record_id"] or "")), ("WARC-Refers-To-Target-URI", first["uri"]), ("WARC-Refers-To-Date", first["date"]),
                ("WARC-Payload-Digest", f"sha1:{row['digest']}"), ("WARC-Block-Digest", f"sha1:{sha1(head + gap)}"), ("Content-Type", HTTP),
            ], head + gap
        if kind == "revisit":  # its original is in none of these archives
            return [(k, own if k.lower() == "warc-record-id" else v) for k, v in fields], block
        made = response_fields(own, f.get("warc-date"), f.get("warc-target-uri"), f.get("page-id"), payload_of(f, block), block)
        return [(k, f.get("content-type") if k == "Content-Type" else v) for k, v in made], block

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(source)
        rows = (r for batch in batches for r in batch.to_pylist())
        for file, own in itertools.groupby(rows, lambda r: r["file"]):
            out = Archives(target, file.split(".warc")[0], run, date, roll)
            for (number, (fields, block)), row in zip(enumerate(archive(fs, f"{base}/{file}")), own, strict=True):
                if number != row["number"]:
                    raise ValueError(f"{file}: record {number} is not {row['number']}")
                out.add(*fresh(fields, block, row))
            yield out.report()
        give_back()

    return rewrite


def deduplicate(files: DataFrame, source: str, target: str, least: int = 0, date: str | None = None, roll: int = ROLL) -> DataFrame:
    """Archives below ``target`` with the records of those below ``source``, in which a payload of at least ``least``
    bytes is kept once. One row for each archive."""
    new_folder(target)
    rows = saved(resolved(saved(read_headers(files, source), "headers"), least), "resolved")
    many = max(parts(files.sparkSession), min(files.count(), READERS))
    dealt = rows.repartition(many, "file").sortWithinPartitions("file", "number")
    return saved(dealt.mapInArrow(_rewriter(source, target, uuid.uuid4().hex, date or now(), roll), FILES), "archives")


def read_back(files: DataFrame, folder: str) -> DataFrame:
    """One row for each response and revisit record: page_id, record_type, payload_bytes and payload_digest of the full
    payload (a revisit's: that of the response it names, null without one), refers_to (that response's page_id), and
    intact: the digest is the one the record lists."""
    every = saved(read_headers(files, folder), "headers")
    named = every.where("type = 'response'").select(F.col("record_id").alias("refers_id"), F.struct("page_id", "n_bytes", "digest").alias("original"))
    response = every.where("type = 'response'").select("page_id", F.lit("response").alias("record_type"), "n_bytes", "digest", F.lit(None).cast("string").alias("refers_to"), "listed")
    revisit = every.where("type = 'revisit'").join(named, "refers_id", "left").select("page_id", F.lit("revisit").alias("record_type"), "original.n_bytes", "original.digest", F.col("original.page_id").alias("refers_to"), "listed")
    both = response.unionByName(revisit)
    return both.select("page_id", F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to", F.coalesce(F.col("digest") == F.col("listed"), F.lit(False)).alias("intact"))


def op12_warc(spark, sf_dir: str) -> DataFrame:
    pages, folder = spark.read.parquet(f"{sf_dir}/pages.parquet"), f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    raw = write_archives(pages, f"{folder}/raw")
    back = read_back(deduplicate(raw, f"{folder}/raw", f"{folder}/single"), f"{folder}/single")
    kind = pages.schema["page_id"].dataType
    return back.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


SQL = r"""
with p as (select page_id, coalesce(html, '') as html from pages),
h as (select page_id, html, strlen(html) as n, sha1(html) as s from p),
d as (select page_id, html, n, translate(array_to_string([upper(to_base(cast('0x' || s[5 * k + 1:5 * k + 5] as int), 32, 4)) for k in range(8)], ''), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') as b from h),
m as (select *, min(page_id) over (partition by html) as first from d)
select page_id, cast(n as bigint) as payload_bytes, b as payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to, true as intact from m
"""
