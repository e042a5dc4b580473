from __future__ import annotations

import base64
import gzip
import hashlib

from lakeloom.llm import warc as W
from tests.llm.data import frame

PAGES = "page_id long, url string, html string"
ROWS = [(1, "http://a.net/x", "<html><title>T  t</title><nav>menu</nav><p>Über &amp; <a href='/y'>link</a></p></html>"), (2, None, None),
        (3, "http://b.net/\r\nWARC-Type: evil", ""), (None, "http://c.net", "<p>" + "x " * 50_000), (1, "http://a.net/x", "<p>twice</p>")]


def sha(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def cut(data):
    """All records of a file, by their lengths."""
    found = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        n = int(fields["Content-Length"])
        assert rest[n:n + 4] == b"\r\n\r\n"
        found.append((fields, rest[:n]))
        data = rest[n + 4:]
    return found


def test_records_link_and_round_trip(spark):
    pages = frame(spark, ROWS, PAGES).selectExpr("*", "'x' AS record", "'y' AS _record", "'z' AS record_id")
    sent = W.responses(pages)
    rows = W.derive(sent, keep=("page_id",)).collect()
    assert len(rows) == 2 * len(ROWS)
    source = {}
    for r in sent.collect():
        (fields, block), = cut(bytes(r["record"]))
        assert fields["WARC-Type"] == "response" and fields["WARC-Block-Digest"] == sha(block)
        source[fields["WARC-Record-ID"]] = (fields, block)
    file = cut(b"".join(bytes(r["record"]) for r in rows))
    for (fields, block), r in zip(file, rows, strict=True):
        of, http = source[fields["WARC-Refers-To"]]
        assert fields["WARC-Refers-To-Target-URI"] == of["WARC-Target-URI"] == fields["WARC-Target-URI"] == r["target_uri"]
        assert fields["WARC-Refers-To-Date"] == of["WARC-Date"]
        assert fields["WARC-Block-Digest"] == sha(block) == r["block_digest"] and r["content_length"] == len(block)
        assert r["payload_digest"] == of["WARC-Payload-Digest"] == sha(http.partition(b"\r\n\r\n")[2])
        assert (fields["WARC-Type"], fields["WARC-Record-ID"]) == (r["record_type"], r["record_id"])
        if r["record_type"] == "metadata":
            notes = block.decode().split("\r\n")
            assert "fetchStatus: HTTP/1.1 200 OK" in notes and "http-Content-Type: text/html; charset=utf-8" in notes
            assert f"sourcePayloadDigest: {of['WARC-Payload-Digest']}" in notes
    ids = {fields["WARC-Record-ID"]: fields["WARC-Concurrent-To"] for fields, _ in file}
    assert all(ids[ids[i]] == i for i in ids)


def test_plain_text_and_links():
    _, record = W.response_of(*ROWS[0])
    meta, text = W.derivatives(record)
    assert cut(text["record"])[0][1].decode() == "menu\nÜber & link"
    assert b"title: T t\r\n" in meta["record"] and b"outlink: /y\r\n" in meta["record"]


def test_header_values_cannot_start_headers():
    _, record = W.response_of(*ROWS[2])
    assert [f["WARC-Type"] for f, _ in cut(record)] == ["response"]


def response(head, body):
    return W.record_bytes([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>"), ("WARC-Target-URI", "u"), ("WARC-Date", "d")], head + b"\r\n\r\n" + body)


def test_codings_and_charsets():
    page = "<p>Grüße</p>"
    cases = [
        (b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip", gzip.compress(page.encode())),
        (b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked", b"5\r\n" + page.encode()[:5] + b"\r\n%x;x=1\r\n" % (len(page.encode()) - 5) + page.encode()[5:] + b"\r\n0\r\n\r\n"),
        (b"HTTP/1.1 200 OK\r\nContent-Type: text/html;\r\n charset=iso-8859-1", page.encode("latin-1")),
        (b"HTTP/1.1 200 OK", b"<meta charset=latin-1>" + page.encode("latin-1")),
        (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=nonsense", page.encode()),
    ]
    for head, body in cases:
        _, text = W.derivatives(response(head, body))
        assert cut(text["record"])[0][1].decode() == "Grüße", head
        assert text["payload_digest"] == sha(body)
    for body in (b"\x1f\x8bbroken", b""):
        assert len(W.derivatives(response(b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip", body))) == 2


def test_other_records_give_none(spark):
    other = W.record_bytes([("WARC-Type", "request"), ("WARC-Record-ID", "<urn:x>")], b"GET /")
    df = frame(spark, [(bytearray(other),), (None,), (bytearray(b"junk"),), (bytearray(b""),), (bytearray(W.response_of(*ROWS[0])[1]),)], "record binary")
    assert [r["record_type"] for r in W.derive(df).collect()] == ["metadata", "conversion"]
    assert W.derive(frame(spark, [], "record binary")).count() == 0
    assert W.responses(frame(spark, [], PAGES)).count() == 0


def test_records_that_lie_about_their_size():
    for body in (b"-20\r\nabc", b"+5\r\nabcde", b"0x5\r\nabcde", b"5_0\r\nabc", b"zz\r\nabc", b"\r\n\r\n", b"5 \r\nabcde\r\n0\r\n\r\n", b"3;x=y\r\nabc\r\n"):
        want = {b"5 \r\nabcde\r\n0\r\n\r\n": b"abcde", b"3;x=y\r\nabc\r\n": b"abc"}.get(body, body)
        assert W._dechunked(body) == want
    for given in ("abc", "-4", "1e3", "9" * 40):
        fields, block = W.parse_record(f"WARC/1.1\r\nContent-Length: {given}\r\n\r\nhello\r\n\r\n".encode())
        assert block == b"hello" and fields["content-length"] == given


def test_several_codings_are_undone_in_reverse():
    import gzip
    import zlib
    raw = zlib.compress(b"<p>text</p>")[2:-4]  # deflate without its header
    twice = gzip.compress(raw)
    chunked = b"%x\r\n" % len(twice) + twice + b"\r\n0\r\n\r\n"
    for head in (b"Content-Encoding: deflate, gzip\r\nTransfer-Encoding: chunked", b"Content-Encoding: deflate\r\nTransfer-Encoding: gzip, chunked",
                 b"Content-Encoding: deflate\r\nContent-Encoding: x-gzip\r\nTransfer-Encoding: chunked"):
        _, _, payload, body = W.parse_response(b"HTTP/1.1 200 OK\r\n" + head + b"\r\n\r\n" + chunked)
        assert payload == chunked and body == b"<p>text</p>"
