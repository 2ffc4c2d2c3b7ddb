"""Characterization and extraction of payloads of every format."""

import hashlib
import json

import pytest

from strataform.functions import urls
from strataform.operators import characterize, extract, inventory
from strataform.sources import catalog

PAYLOADS = [
    ("html", b"<!DOCTYPE html><html><head><title>T</title></head><body><nav>menu</nav><article><h1>Head</h1><p>Body text</p><a href='/x'>go</a></article></body></html>", "text/html", "http://a.com/p.html"),
    ("obj", b'{"a": 1, "b": "two", "c": null}', "application/json", "http://a.com/x.json"),
    ("recs", b'[{"id": 1, "n": "x"}, {"id": 2, "n": "y"}]', None, None),
    ("xml", b"<?xml version='1.0'?><root><item>one</item><item>two</item></root>", "text/xml", None),
    ("csv", b"a,b,c\n1,2,3\n4,5,6\n", "text/csv", "http://a.com/d.csv"),
    ("md", b"# Title\n\nSome text.\n\n```python\nx = 1\n```\n", None, "http://a.com/r.md"),
    ("txt", b"plain line one\nline two  \nline three", "text/plain", None),
    ("bin", bytes(range(128, 200)), None, None),
    ("latin", "caf\xe9 au lait".encode("latin-1"), "text/plain", None),
    ("bom", b"\xef\xbb\xbfhello there", "text/plain", None),
    ("empty", b"", None, None),
    ("null", None, None, None),
]


@pytest.fixture(scope="module")
def artifacts(spark):
    rows = [(n, u, c, bytearray(d) if d is not None else None, len(d or b""), hashlib.sha256(d or b"").hexdigest()) for n, d, c, u in PAYLOADS]
    return spark.createDataFrame(rows, "artifact_id string, url string, content_type string, raw_data binary, size_bytes long, checksum_sha256 string")


def test_characterize(artifacts):
    rows = {r.artifact_id: r for r in characterize.characterize(artifacts).collect()}
    want = {"html": "html", "obj": "json", "recs": "json", "xml": "xml", "csv": "csv", "md": "markdown", "txt": "plain_text", "latin": "plain_text", "bom": "plain_text", "bin": None}
    assert {k: rows[k].detected_format for k in want} == want
    assert (rows["html"].format_confidence, rows["html"].structural_type, rows["html"].document_types) == ("high", "article-like", ["article"])
    assert (rows["obj"].structural_type, rows["recs"].structural_type) == ("object", "array-of-records")
    assert json.loads(rows["recs"].schema_summary) == {"type": "array-of-records", "record_count": 2, "fields": {"id": "int", "n": "str"}}
    assert rows["xml"].item_count == 3 and rows["csv"].item_count == 2
    assert (rows["latin"].encoding, rows["bom"].encoding, rows["txt"].encoding, rows["empty"].encoding) == ("latin-1", "utf-8-sig", "utf-8", None)
    assert rows["latin"].character_count == 12 and rows["txt"].line_count == 3
    assert rows["null"].byte_count == 0 and rows["bin"].extraction_suitability == "unknown"


def test_extract(artifacts):
    known = characterize.characterize(artifacts)
    rows = {r.artifact_id: r for r in extract.extract(artifacts, known).collect()}
    assert rows["html"].canonical_text == "T\nHead\nBody text\ngo"
    assert json.loads(rows["html"].structured_data) == {"links": [{"href": "/x"}], "headings": [{"level": "h1", "text": "Head"}]}
    assert rows["obj"].canonical_text == json.dumps({"a": 1, "b": "two", "c": None}, sort_keys=True, indent=2)
    assert rows["xml"].canonical_text == "one\ntwo" and rows["csv"].canonical_text == "a\tb\tc\n1\t2\t3\n4\t5\t6"
    assert rows["txt"].canonical_text == "plain line one\nline two\nline three\n"
    assert json.loads(rows["md"].structured_data)["code_blocks"] == [["python", "x = 1"]]
    assert rows["bin"].error_category == "unknown_format" and rows["bin"].extraction_status == "failed"
    assert rows["csv"].canonical_checksum == hashlib.sha256(rows["csv"].canonical_text.encode()).hexdigest()


@pytest.mark.parametrize(("fmt", "data", "category"), [("json", b"{", "corrupted_format"), ("xml", b"<a>", "corrupted_format"), ("csv", b" ", "empty_content"), ("pdf", b"x", "unsupported_format"), (None, b"x", "unknown_format"), ("json", b"\xff", "encoding_error")])
def test_failures(fmt, data, category):
    found = extract.read_payload(data, None, fmt)
    assert (found[0], found[6]) == ("failed", category)
    assert extract.read_payload(b"<p></p>", None, "html")[0] == "partial"


def test_inventory(artifacts):
    known = characterize.characterize(artifacts)
    state = {r.artifact_id: r.availability for r in inventory.availability(artifacts).collect()}
    assert state["null"] == "unavailable" and state["csv"] == "available"
    counts = {(r.section, r.key): r.value for r in inventory.distributions(artifacts, known).collect()}
    assert counts["size", "<1KB"] == len(PAYLOADS) and counts["domain", "unknown"] == 8 and counts["format", "json"] == 2
    assert inventory.totals(artifacts, known).first().coverage == 1.0
    assert {r.status for r in catalog.materialize(artifacts).collect()} == {"completed", "missing"}


def test_urls(spark):
    rows = spark.createDataFrame([("http://10.0.0.1/x",), ("https://User@A.com:80/p.HTML?q#f",), ("ftp://a",), ("a.com/x",), (None,), ("http://8.8.8.8/",)], "url string")
    got = rows.select(urls.normalize_url(rows.url).alias("n"), urls.url_host(rows.url).alias("h"), urls.private_address(rows.url).alias("p"), urls.domain_allowed(rows.url, ["A.COM "]).alias("d"), urls.file_extension(rows.url).alias("e")).collect()
    assert [r.n for r in got] == ["http://10.0.0.1/x", "https://User@A.com:80/p.HTML?q#f", None, "http://a.com/x", None, "http://8.8.8.8/"]
    assert [r.p for r in got] == [True, False, False, False, False, False] and [r.d for r in got][1] and got[1].e == "html"
