import base64
import glob
import gzip
import hashlib
from collections import Counter

import pytest

from atomframe.llm import warc as W

PAGES = [
    (5, "http://a/5", "<p>same</p>"),
    (3, "http://a/3 x\ny", "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (1, "http://a/1", None),
    (2, "http://a/2", ""),
    (7, "http://a/7", "é" * 70_000),
    (7, "http://a/7", "é" * 70_000),
    (8, "http://a/é", "\r\n\r\nWARC/1.1\r\n\r\n"),
    (None, "http://a/none", "<p>same</p>"),
    (None, "http://a/none", "alone"),
    (None, "http://a/none", "alone"),
    (10, "http://a/10", "ten"),
    (11, "http://a/10", "x" * 3_000_000),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(pages, least=0):
    first, out = {}, []
    for i, _, t in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        n = len((t or "").encode())
        if n >= least and (t or "") in first:
            out.append((i, n, digest(t), "revisit", first[t or ""][0]))
        else:
            first.setdefault(t or "", (i,))
            out.append((i, n, digest(t), "response", None))
    return Counter(out)


def table(spark, pages=PAGES):
    return spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, digest string, number int").repartition(3)


def rows(df):
    return Counter((r.page_id and int(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to and int(r.refers_to)) for r in df.collect())


@pytest.mark.parametrize("least,roll", [(0, W.ROLL), (4, W.ROLL), (12, 300), (0, 1)])
def test_equal_payloads_are_kept_once(spark, tmp_path, least, roll):
    raw = W.write_archives(table(spark), f"{tmp_path}/raw", roll=roll)
    every = W.read_back(raw, f"{tmp_path}/raw")
    assert Counter(r.record_type for r in every.collect()) == {"response": len(PAGES)}
    single = W.deduplicate(raw, f"{tmp_path}/raw", f"{tmp_path}/single", least, roll=roll)
    back = W.read_back(single, f"{tmp_path}/single").cache()
    assert rows(back) == brute(PAGES, least) and back.where("not intact").count() == 0
    # what is there already is found again: revisits of the given archives are joined to their original
    again = W.deduplicate(single, f"{tmp_path}/single", f"{tmp_path}/again", least, roll=roll)
    assert rows(W.read_back(again, f"{tmp_path}/again")) == brute(PAGES, least)
    assert sum(r.records for r in again.collect()) >= len(PAGES)


def test_records_follow_the_format(spark, tmp_path):
    raw = W.write_archives(table(spark).coalesce(1), f"{tmp_path}/raw", date="2020-01-02T03:04:05Z")
    W.deduplicate(raw, f"{tmp_path}/raw", f"{tmp_path}/single")
    (path,) = glob.glob(f"{tmp_path}/single/*.warc.gz")
    with gzip.open(path) as f:
        found = [(dict(h), b) for h, b in W.read_records(f)]
    assert found[0][0]["WARC-Type"] == "warcinfo" and len({h["WARC-Record-ID"] for h, _ in found}) == len(found)
    by_id = {h["WARC-Record-ID"]: (h, b) for h, b in found}
    revisits = [(h, b) for h, b in found if h["WARC-Type"] == "revisit"]
    assert len(revisits) == 6
    for h, b in revisits:
        first, block = by_id[h["WARC-Refers-To"]]
        assert first["WARC-Type"] == "response" and first["WARC-Payload-Digest"] == h["WARC-Payload-Digest"]
        assert h["WARC-Refers-To-Date"] == "2020-01-02T03:04:05Z" and h.get("WARC-Refers-To-Target-URI") == first.get("WARC-Target-URI")
        assert b.endswith(b"\r\n\r\n") and block.startswith(b) and h["WARC-Profile"] == W.PROFILE
        assert h["WARC-Block-Digest"] == f"sha1:{W.sha1(b)}"
    uris = {h.get("WARC-Target-URI") for h, _ in found[1:]}
    assert {None, "http://a/3%20x%0Ay", "http://a/é"} <= uris
    # each record is a gzip member of its own
    with open(path, "rb") as f:
        assert f.read().count(b"\x1f\x8b\x08\x00\x00\x00\x00\x00") >= len(found)


def test_other_archives(spark, tmp_path):
    """Plain files, other types, folded fields, records without HTTP, revisits with and without an original."""
    (tmp_path / "in").mkdir()
    http = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n"

    def rec(kind, rid, block, *more):
        head = [("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", "2021-01-01T00:00:00Z"), *more]
        return W.record(head, block)

    body = b"payload"
    http_type = ("Content-Type", W.HTTP)
    plain = rec("request", "<urn:q>", b"GET / HTTP/1.1\r\n\r\n") + rec("response", "<urn:b>", http + body, http_type, ("Page-Id", "8")) + rec("response", "<urn:c>", body, ("Content-Type", "text/plain"), ("Page-Id", "12"))
    other = rec("revisit", "<urn:d>", http, http_type, ("WARC-Payload-Digest", f"sha1:{W.sha1(body)}"), ("Page-Id", "1")) + rec("revisit", "<urn:e>", b"", ("WARC-Payload-Digest", "sha1:AAAA"), ("WARC-Refers-To", "<urn:far>"), ("Page-Id", "2"))
    (tmp_path / "in" / "a.warc").write_bytes(plain.replace(b"WARC-Date: 2021", b"WARC-Date:\r\n\t2021"))
    (tmp_path / "in" / "b.warc.gz").write_bytes(gzip.compress(other))
    files = spark.createDataFrame([("a.warc",), ("b.warc.gz",)], "name string")
    head = {(r.file, r.number): r for r in W.read_headers(files, f"{tmp_path}/in").collect()}
    assert head["a.warc", 1].date == "2021-01-01T00:00:00Z" and head["a.warc", 1].n_bytes == 7 and head["b.warc.gz", 0].digest == W.sha1(body)
    out = W.deduplicate(files, f"{tmp_path}/in", f"{tmp_path}/out")
    assert sorted(r.records for r in out.collect()) == [2, 3]
    got = {int(r.page_id): (r.record_type, r.payload_bytes, r.refers_to, r.intact) for r in W.read_back(out, f"{tmp_path}/out").collect()}
    assert got == {8: ("response", 7, None, True), 12: ("revisit", 7, "8", True), 1: ("revisit", 7, "8", True), 2: ("revisit", None, None, False)}


@pytest.mark.parametrize("cut", [-1, -12, 40])
def test_broken_archives_are_errors(spark, tmp_path, cut):
    raw = W.write_archives(table(spark, PAGES[:2]).coalesce(1), f"{tmp_path}/raw")
    (path,) = glob.glob(f"{tmp_path}/raw/*.warc.gz")
    data = open(path, "rb").read()
    with open(path, "wb") as f:
        f.write(data[:cut])
    with pytest.raises(Exception, match="part-000000-0000.warc.gz"):
        W.read_headers(raw, f"{tmp_path}/raw").collect()
    with open(path, "wb") as f:
        f.write(b"something else")
    with pytest.raises(Exception, match="not a WARC record"):
        W.read_headers(raw, f"{tmp_path}/raw").collect()


def test_empty_table(spark, tmp_path):
    raw = W.write_archives(table(spark).limit(0), f"{tmp_path}/raw")
    single = W.deduplicate(raw, f"{tmp_path}/raw", f"{tmp_path}/single")
    assert not raw.count() and not W.read_back(single, f"{tmp_path}/single").count()


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    pages = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    out = W.op12_warc(spark, sf)
    assert dict(out.dtypes)["refers_to"] == "bigint" and rows(out) == brute(pages)
