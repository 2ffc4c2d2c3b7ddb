"""Lookups, limits, stored groups, reports and the ledger on small fixtures."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from strataform import config
from strataform.functions import urls
from strataform.operators import dedup, extract, inventory, language, quality
from strataform.plans import build, validate
from strataform.plans.spec import Specification
from strataform.sources import catalog, export
from strataform.sources.ledger import Ledger, StoredReports, StoredSpecs, migrate

SPEC = {"dataset": {"name": "small", "version": 1}, "source": {"allowed_formats": ["html"], "allowed_languages": ["English"]}, "content": {"minimum_characters": 3}, "deduplication": {"mode": "near"}}


def test_find_any_keeps_rows_with_the_same_keys(spark):
    rows = [("a", "k1", None, 1), ("b", "k1", None, 2), ("b", "k1", None, 2), ("c", None, "k2", 3), ("d", "k2", "k1", 4), ("e", "x", "y", 5), ("f", None, None, 6)]
    table = spark.createDataFrame(rows, "name string, one string, two string, id long")
    wanted = spark.createDataFrame([("k1",), ("k2",), ("k1",), (None,)], "id string")
    assert sorted(r.name for r in catalog.find_any(table, wanted, ["one", "two"]).collect()) == ["a", "b", "b", "c", "d"]
    assert catalog.find_any(table, wanted.limit(0), ["one", "two"]).count() == 0


def test_latest(spark):
    rows = [("a", 1, {"m": "x"}), ("a", 2, {"m": "y"}), ("a", None, None), ("b", None, {"m": "z"}), (None, 1, None), (None, 3, None)]
    table = spark.createDataFrame(rows, "key string, at int, extra map<string,string>")
    assert {(r.key, r.at) for r in catalog.latest(table, "key", "at").collect()} == {("a", 2), ("b", None), (None, 3)}
    assert catalog.latest(table.limit(0), "key", "at").count() == 0


def test_private_addresses_of_version_six(spark):
    hosts = {"::1": True, "::": True, "fc00::1": True, "fd12:3456::1": True, "fe80::1": True, "ff02::1": True, "2001:db8::1": True, "::ffff:10.0.0.1": True, "2606:4700::1111": False, "2a00:1450:4001::8": False}
    rows = spark.createDataFrame([(f"http://u@[{h}]:80/x", v) for h, v in hosts.items()], "url string, want boolean")
    assert rows.where(urls.private_address(F.col("url")) != F.col("want")).count() == 0
    assert not spark.createDataFrame([("http://[::1]/",)], "url string").select(urls.private_address(F.col("url"), ["::1"]).alias("x")).first().x


def test_label_codes(spark):
    labels = {"en": "en", " EN-gb ": "en", "Dutch": "nl", "pt_BR": "pt", "deu": None, "": None, None: None, "english": "en", "enx": None}
    rows = spark.createDataFrame([(k, v) for k, v in labels.items()], "label string, want string")
    assert rows.where(~language.label_code(F.col("label")).eqNullSafe(F.col("want"))).count() == 0


def test_artifact_states(spark):
    data = b"text"
    good = hashlib.sha256(data).hexdigest()
    artifacts = spark.createDataFrame([("a", bytearray(data), good), ("b", None, good), ("c", bytearray(data), "0"), ("d", bytearray(data), good), ("e", bytearray(data), good)], "artifact_id string, raw_data binary, checksum_sha256 string")
    known = spark.createDataFrame([("a", "html"), ("b", None), ("c", "html"), ("d", None)], "artifact_id string, detected_format string")
    got = {r.artifact_id: r.availability for r in inventory.artifact_states(artifacts, known).collect()}
    assert got == {"a": "available", "b": "unavailable", "c": "corrupted", "d": "unsupported", "e": "characterization_failed"}


def test_extraction_limits():
    body = "\n".join(f"{i},x" for i in range(1500))
    cut = extract.read_payload(f"n,v\n{body}".encode(), "utf-8", "csv")
    whole = extract.read_payload(f"n,v\n{body}".encode(), "utf-8", "csv", extract.UNLIMITED)
    assert cut[1].count("\n") == 1000 and cut[5] and whole[1].count("\n") == 1500 and not whole[5]
    deep = "<a>" * 9 + "x" * 900 + "</a>" * 9
    assert len(json.loads(extract.read_payload(deep.encode(), "utf-8", "xml", extract.UNLIMITED)[2])["children"][0]["children"]) == 1
    long = ("y" * 11 + " ") * 10**6
    assert len(extract.read_payload(long.encode(), "utf-8", "plain_text")[1]) == 10 << 20 and len(extract.read_payload(long.encode(), "utf-8", "plain_text", extract.UNLIMITED)[1]) == 12 * 10**6


def test_page_outline():
    page = "<html><body><nav><a href='/n'>Menu</a></nav><h2>Head<br>more</h2><p>Text <a href='#x'>here</a><a href='/l'>there</a><script>no</script><h1><b>Bold</b> rest</h1></div></body>"
    status, text, packed, shape, *_ = extract.read_payload(page.encode(), "utf-8", "html")
    assert status == "completed" and text == "Head\nmore\nText\nhere\nthere\nBold\nrest"
    assert json.loads(shape) == {"headings": [{"level": "h2", "text": "Head"}], "link_count": 2} and json.loads(packed)["links"] == [{"href": "/n"}, {"href": "/l"}]


def test_format_signals(spark):
    rows = [("json", '{"a": null, "b": "", "c": 1}'), ("json", "[1, 2]"), ("json", "{"), ("csv", "a,b\n1,\n,\n"), ("csv", ""), ("xml", '<r k="1"><a>x</a><b/></r>'), ("xml", "<r>"), ("html", "<p>"), (None, None)]
    frame = spark.createDataFrame(rows, "fmt string, text string")
    got = [tuple(r.s) for r in frame.select(quality.format_signals("fmt", "text").alias("s")).collect()]
    none = (None,) * 9
    assert got == [(3, 1, 1, None, None, 0.3333, 0.3333, None, None), (2, *none[1:]), none, (4, None, 3, 2, 2, None, 0.75, None, None), (0, None, 0, 0, 0, None, 0.0, None, None), (2, None, 1, None, None, None, 0.5, "r", True), none, none, none]


def test_stored_groups(spark):
    at = lambda n: __import__("datetime").datetime(2030, 1, n)
    rows = [("g", "d1", None, None, "raw_exact", True, at(1)), ("g", "d2", None, None, "raw_exact", False, at(1)), ("h", None, "d3", None, "other", None, at(1)), ("h", None, "d3", None, "normalized_exact", False, at(2)), ("i", None, None, "d1", "raw_exact", True, at(3)), (None, "d4", None, None, "raw_exact", False, at(1)), ("j", None, None, None, "raw_exact", False, at(1))]
    members = spark.createDataFrame(rows, "group_id string, normalized_document_id string, canonical_document_id string, artifact_id string, comparison_method string, is_representative boolean, created_at timestamp")
    corpus = spark.createDataFrame([(f"d{i}", "some text", None, None, 500, 0, "English", "html", None, "u") for i in range(1, 6)], "doc_id string, normalized_text string, raw_checksum string, normalized_checksum string, character_count long, warning_count long, language string, detected_format string, source_mime_type string, source_url string")
    got = {r.doc_id: (r.decision, r.reason_codes[0], r.representative_id) for r in build.decide(corpus, Specification(SPEC), build.stored_groups(members)).collect()}
    assert got == {"d1": ("accepted", "dedup_representative", "d1"), "d2": ("rejected", "exact_duplicate", "d1"), "d3": ("rejected", "normalized_duplicate", None), "d4": ("accepted", "dedup_unique", None), "d5": ("accepted", "dedup_unique", None)}


def test_near_tier_of_a_build(spark):
    words = " ".join(f"w{i}x{i * 7 % 13}" for i in range(80))
    rows = [("a", words, 1), ("b", words + " end", 0), ("c", "nothing of the kind stands in here", 0), ("d", None, 0)]
    corpus = spark.createDataFrame(rows, "doc_id string, normalized_text string, warning_count long").select(
        "*", F.sha2("normalized_text", 256).alias("raw_checksum"), F.sha2("normalized_text", 256).alias("normalized_checksum"), F.lit(700).alias("character_count"), F.lit("English").alias("language"), F.lit("html").alias("detected_format"), F.lit("text/html").alias("source_mime_type"), F.lit("u").alias("source_url")
    )
    decisions = build.decide(corpus, Specification(SPEC))
    got = {r.doc_id: r.reason_codes for r in decisions.collect()}
    assert got == {"a": ["near_duplicate"], "b": ["dedup_representative"], "c": ["dedup_unique"], "d": ["content_too_short"]}
    record = export.decision_rows(decisions, "b1", Specification(SPEC)).where("record_id = 'a'").first()
    assert record.thresholds.minimum_characters == 3 and record.thresholds.allowed_languages == ["English"] and record.thresholds.deduplication_mode == "near" and record.thresholds.maximum_records is None
    assert record.actual_values.character_count == len(words) and record.representative_record_id == "b"


def test_result_counts(spark):
    members = spark.createDataFrame([("raw_exact", 1, 1), ("raw_exact", 1, 2), ("near_duplicate", 3, 3), ("near_duplicate", 3, 4)], "tier string, group_id long, doc_id long")
    documents = spark.createDataFrame([(1, True), (2, True), (3, True), (4, True), (5, False), (6, None)], "doc_id long, has_text boolean")
    r = dedup.result_counts(members, documents).first()
    assert (r.total_documents, r.documents_skipped, r.warning, r.raw_exact_groups, r.normalized_exact_groups, r.near_duplicate_members) == (6, 2, "2 documents skipped (no normalized text)", 1, 0, 2)
    empty = dedup.result_counts(members.limit(0), documents.limit(0)).first()
    assert empty.total_documents == 0 and empty.warning is None and empty.raw_exact_groups == 0


def test_offenders_and_checksums(spark):
    rows = [(f"r{i:02d}", "x" * (2 if i < 30 else 9), "English" if i % 2 else "Latin", 0.5) for i in range(40)] + [("r00", "y" * 9, "English", 0.5)]
    records = spark.createDataFrame(rows, "normalized_record_id string, text string, language string, quality_score double")
    for name in validate.REQUIRED:
        if name not in records.columns:
            records = records.withColumn(name, F.lit("set"))
    found = [tuple(r) for r in validate.offenders(records, Specification(SPEC)).collect()]
    assert [i for c, i in found if c == "content_length"] == [f"r{i:02d}" for i in range(20)] and [i for c, i in found if c == "duplicate_leakage"] == ["r00"]
    assert [i for c, i in found if c == "language_compliance"] == [f"r{i:02d}" for i in range(0, 40, 2)]
    tree = validate.record_checksum(records)
    assert tree == validate.record_checksum(records.repartition(7)) and tree["canonical_record_count"] == 41
    assert tree["sha256"] != validate.record_checksum(records.where("normalized_record_id <> 'r05'"))["sha256"]
    serial = validate.record_checksum(records, serial=True)
    assert serial["sha256"] == hashlib.sha256(json.dumps(sorted(r[0] for r in rows)).encode()).hexdigest()


def test_ledger(spark, tmp_path):
    ledger = Ledger(spark, f"file://{tmp_path}/ledger")
    specs, reports = StoredSpecs(ledger), StoredReports(ledger)
    spec = specs.create(SPEC)
    specs.create(SPEC | {"dataset": {"name": "ünlike / name", "version": 1}}, "draft")
    with pytest.raises(ValueError, match="exists"):
        specs.create(SPEC)
    again = StoredSpecs(Ledger(spark, f"file://{tmp_path}/ledger"))
    assert again.get("small").hash == spec.hash and again.get("none") is None
    assert [s.name for s in again.list()] == ["small", "ünlike / name"] and [s.name for s in again.list("draft")] == ["ünlike / name"]
    reports.save("r1", spec, {"feasibility": "pass"})
    assert reports.get("r1")["report"] == {"feasibility": "pass"} and reports.list("small") == ["r1"] and reports.list("other") == []
    ran = []
    steps = [("001", lambda: ran.append(1)), ("002", lambda: ran.append(2))]
    assert migrate(ledger, steps[:1]) == ["001"] and migrate(ledger, steps) == ["002"] and migrate(ledger, steps) == [] and ran == [1, 2]


def test_configuration(tmp_path):
    (tmp_path / "a.toml").write_text('data = "/d"\nshuffle_partitions = 9\n')
    (tmp_path / "b.json").write_text('{"unknown": 1}')
    found = config.load(str(tmp_path / "a.toml"), {"STRATAFORM_SHUFFLE_PARTITIONS": "11", "STRATAFORM_WHOLE_TEXTS": "yes", "STRATAFORM_ALLOWED_DOMAINS": "a, b", "OTHER": "x"})
    assert (found["data"], found["shuffle_partitions"], found["whole_texts"], found["allowed_domains"], found["similarity_threshold"]) == ("/d", 11, True, ["a", "b"], 0.85)
    for environment in ({"STRATAFORM_SHUFFLE_PARTITIONS": "x"}, {"STRATAFORM_WHOLE_TEXTS": "perhaps"}):
        with pytest.raises(ValueError, match="must be of type"):
            config.load(None, environment)
    with pytest.raises(ValueError, match="Unknown settings"):
        config.load(str(tmp_path / "b.json"), {})


def test_registry_order_and_capabilities(spark):
    from strataform.plans.registry import Registry

    registry = Registry()
    assert {s.kind for s in map(registry.get, registry.names())} == {"fetch", "extract", "store", "normalize", "deduplicate", "export"}
    assert [s.name for s in registry.able("near_duplicate")] == ["trigram_jaccard"] and [s.name for s in registry.able("html")] == ["format_extractor"]
    data = b"Some plain text of a page\n"
    rows = [("a", "http://h.example/a.txt", "text/plain", bytearray(data), len(data), hashlib.sha256(data).hexdigest()), ("b", "http://h.example/b.txt", "text/plain", bytearray(data), len(data), "0")]
    artifacts = spark.createDataFrame(rows, "artifact_id string, url string, content_type string, raw_data binary, size_bytes long, checksum_sha256 string")
    out = registry.pipeline(artifacts, "jsonl_lines", "standard_normalizer", "format_extractor", "payload_reader", "shared_store").collect()
    assert [json.loads(r.value)["doc_id"] for r in out] == ["a"] and json.loads(out[0].value)["normalized_text"] == data.decode()
    with pytest.raises(ValueError, match="one stage of a kind"):
        registry.pipeline(artifacts, "format_extractor", "text_metrics")


def test_rewriting_duplicates(spark, tmp_path):
    groups = spark.createDataFrame([(1, 2)], "group_id long, size long")
    members = spark.createDataFrame([(1, 5), (1, 6)], "group_id long, doc_id long")
    for _ in range(2):
        export.rewrite_duplicates(f"file://{tmp_path}/d", groups, members)
    assert spark.read.parquet(f"file://{tmp_path}/d/duplicate_memberships.parquet").count() == 2 and spark.read.parquet(f"file://{tmp_path}/d/duplicate_groups.parquet").count() == 1


def test_sketch_links(spark):
    words = " ".join(f"w{i}x{i * 7 % 13}" for i in range(80))
    documents = spark.createDataFrame([(1, words), (2, words + " end"), (3, "something of another kind altogether"), (None, words), (4, None)], "doc_id long, text string")
    assert [(r.a, r.b) for r in dedup.sketch_links(documents).collect()] == [(1, 2)]
    assert dedup.sketch_links(documents, banding="sorted").where("similarity < 0.85").count() == 0


def test_scratch_drops_what_is_not_kept(spark):
    import os

    from strataform.runtime import scratch, store

    with scratch() as keep:
        gone, kept = store(spark.range(3), "gone"), keep(store(spark.range(4), "kept", counted=True))
    at = lambda stored: stored.path.removeprefix("file://")
    assert not os.path.exists(at(gone)) and os.path.exists(at(kept)) and kept.rows == kept.df.count() == 4
    kept.drop()
    assert not os.path.exists(at(kept))
