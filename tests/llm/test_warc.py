"""WARC derivatives: the written records are read back and held against their sources."""

import base64
import gzip
import hashlib
import time
import zlib

from rightsweave.llm import warc
from rightsweave.llm.queries import responses

SCHEMA = "page_id long, record_id string, target_uri string, date string, headers map<string,string>, block binary, type string, record string"


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_records_of_all_pages_link_to_their_sources(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    source = {r.record_id: r for r in responses(pages).collect()}
    rows = warc.derivatives(responses(pages), ["page_id"]).collect()
    assert len(rows) == 2 * len(source) and len({r.record_id for r in rows}) == len(rows)
    for r in rows:
        (fields, block), = warc.read_records(r.record)
        of = source[r.refers_to]
        payload = of.block.split(b"\r\n\r\n", 1)[1]
        assert r.page_id == of.page_id and fields["WARC-Type"] == r.type and fields["WARC-Record-ID"] == r.record_id
        assert fields["WARC-Refers-To"] == of.record_id and fields["WARC-Refers-To-Target-URI"] == of.target_uri
        assert fields["WARC-Block-Digest"] == sha1(block) == r.block_digest and r.payload_digest == sha1(payload)
        if r.type == "metadata":
            said = dict(line.split(": ", 1) for line in block.decode().splitlines())
            assert said["source-record"] == of.record_id and said["status"] == "HTTP/1.1 200 OK"
            assert said["http-Content-Type"] == "text/html; charset=utf-8" and said["payload-digest"] == sha1(payload)
            assert said["source-warc-ip-address"] == "192.0.2.1"
        else:
            assert fields["Content-Type"].startswith("text/plain") and fields["WARC-Source-Payload-Digest"] == sha1(payload)
            text = block.decode()
            assert "<p>" not in text and "track(" not in text and "margin:0" not in text and "\r" not in text


def test_odd_rows(spark):
    http = b"HTTP/1.1 404 Not Found\r\nContent-Type: %s\r\nX-A: 1\r\n\r\n%s"
    rows = [(1, "<urn:a>", "http://x/\r\nWARC-Type: warcinfo", "d", None, http % (b"image/png", b"\x89PNG")),
            (2, "<urn:b>", None, None, {"WARC-Payload-Digest": "sha1:GIVEN", "b": None}, http % (b"text/plain; charset=latin-1", b"caf\xe9")),
            (3, None, "u", "d", {}, None), (4, "<urn:c>", "u", "d", {}, b"no http, but <b>text</b> &amp; more"),
            (5, "<urn:d>", "u", "d", {}, http % (b"text/html; charset=nonsense", "<title>T &lt;</title>é<script>if(a<b)</script>".encode())),
            (5, "<urn:d>", "u", "d", {}, http % (b"text/html", b"<p>" * 50_000))]
    frame = spark.createDataFrame([(*r, "t", "r") for r in rows], SCHEMA)
    got = warc.derivatives(frame, ["page_id"]).collect()
    texts = {}
    for r in got:
        (fields, block), = warc.read_records(r.record)
        texts.setdefault(r.page_id, {}).setdefault(r.type, []).append((fields, block.decode()))
    assert set(texts[1]) == {"metadata"} and texts[1]["metadata"][0][0]["WARC-Target-URI"] == "http://x/%0D%0AWARC-Type:%20warcinfo"
    assert "http-X-A: 1" in texts[1]["metadata"][0][1]
    assert texts[2]["conversion"][0][1] == "café" and "sha1:GIVEN" in texts[2]["metadata"][0][1]
    assert texts[3]["conversion"][0][1] == "" and texts[4]["conversion"][0][1] == "no http, but text & more"
    assert texts[5]["conversion"][0][1] in ("é", "") and "title: T <" in texts[5]["metadata"][0][1] + texts[5]["metadata"][1][1]
    assert len(texts[5]["conversion"]) == 2


def test_members_join_to_a_file_and_empty_table(spark):
    parts = [warc.record("metadata", f"<urn:{i}>", [], "text/plain", b"x" * i) for i in range(3)]
    data = gzip.decompress(b"".join(warc.member(p) for p in parts))
    assert [b for _, b in warc.read_records(data)] == [b"", b"x", b"xx"]
    assert warc.derivatives(spark.createDataFrame([], SCHEMA), ["page_id"]).count() == 0


def test_unclosed_heads_keep_the_page():
    page = "<html><head><title>T</title><style>p{}</style><body><p>text</p></body></html>"
    assert warc.text_of(page) == "text" and warc.title_of(page) == "T"
    assert warc.text_of("<head><meta name=a><title>T</title><link rel=b><p>one<p>two") == "one\ntwo"
    assert warc.text_of("<head><title>T</title></head><body>b") == "b" and warc.text_of("<header>h</header>") == "h"


def test_chunked_and_compressed_payloads():
    page = "<p>" + "caf\u00e9 " * 50
    body = page.encode()
    raw = zlib.compressobj(wbits=-15)
    plain, zipped = "caf\u00e9 " * 49 + "caf\u00e9", gzip.compress(body)
    chunked = b"".join(b"%x;a=b\r\n%s\r\n" % (len(p), p) for p in (zipped[:20], zipped[20:])) + b"0\r\nX: y\r\n\r\n"
    for head, data in ((b"Content-Encoding: gzip", zipped), (b"Content-Encoding: gzip\r\nTransfer-Encoding: chunked", chunked),
                       (b"Transfer-Encoding: gzip, chunked", chunked), (b"Content-Encoding: deflate", zlib.compress(body)),
                       (b"Content-Encoding: deflate", raw.compress(body) + raw.flush()),
                       (b"Content-Encoding: gzip\r\nTransfer-Encoding: chunked", body), (b"X: y", body)):
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + head + b"\r\n\r\n" + data
        made = list(warc.derive({"record_id": "<urn:a>", "target_uri": "u", "date": "d", "headers": None, "block": block}))
        (_, text), = warc.read_records(made[1]["record"])
        assert text.decode() == plain and made[0]["payload_digest"] == sha1(data), head
    block = b"HTTP/1.1 200 OK\r\nContent-Encoding: br\r\n\r\nxyz"
    assert [m["type"] for m in warc.derive({"record_id": "", "target_uri": "", "date": "", "headers": None, "block": block})] == ["metadata"]


def test_hostile_pages_take_linear_time():
    begun = time.monotonic()
    for unit in ("<title>", "<title ", "<script ", "<script>", "<!--", "<style x", "</script ", "<p", "&", "<title></title"):
        page = "<b>seen</b>" + unit * (1_000_000 // len(unit))
        assert warc.text_of(page).startswith("seen") and warc.title_of(page) == ""
    assert time.monotonic() - begun < 20  # 10 pages of a megabyte


def test_hidden_elements_by_hand():
    for page, text, title in [
            ("a<!-- <script> -->b<script>x</script >c", "a b c", ""), ("a<SCRIPT x>1</Script>b<!-- open", "a b", ""),
            ("a<script b <!-- c", "a<script b", ""), ("a<scripts>b</scripts>", "ab", ""), ("<!-->x-->y", "y", ""),
            ("<script><title>no</title></script><Title a=1>T <i>u</i></title>z", "z", "T u"),
            ("<title>open<p>z", "", ""), ("<!--<title>no</title>--><title>a</title><title>b</title>", "", "a")]:
        assert (warc.text_of(page), warc.title_of(page)) == (text, title)


def test_inflating_is_bounded_and_goes_through_members():
    many = b"".join(gzip.compress(b"%d " % i) for i in range(20_000))
    assert warc.content_of(many, [("Content-Encoding", "gzip")]) == b"".join(b"%d " % i for i in range(20_000))
    bomb = zlib.compress(bytes(64 << 20))
    deflate = [("content-encoding", "deflate")]
    assert warc.content_of(bomb, deflate) == bytes(64 << 20)
    assert warc.content_of(bomb, deflate, (64 << 20) - 1) is None
    raw = zlib.compressobj(wbits=-15)
    data = raw.compress(b"abc" * 9000) + raw.flush()
    assert warc.content_of(data, deflate) == b"abc" * 9000 and warc.content_of(b"plain", deflate) == b"plain"
    cut = gzip.compress(b"x" * 100_000)[:-20]
    assert set(warc.content_of(cut, [("content-encoding", "gzip")])) == set(b"x")


def test_metadata_tells_of_wrong_digests_and_missing_conversions():
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Encoding: br\r\n\r\nabc"
    row = {"record_id": " <urn:a> ", "target_uri": "u", "date": "d", "headers": {"WARC-Payload-Digest": "sha1:WRONG"}, "block": http}
    (made,) = warc.derive(row)
    text = made["record"].decode()
    assert made["payload_digest"] == "sha1:WRONG" and f"computed-payload-digest: {sha1(b'abc')}" in text
    assert "conversion: none" in text and made["refers_to"] == "<urn:a>"
    right = {**row, "headers": {"WARC-Payload-Digest": sha1(b"abc")}}
    assert "computed-payload-digest" not in next(warc.derive(right))["record"].decode()
