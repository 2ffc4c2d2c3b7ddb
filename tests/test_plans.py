"""Specifications, feasibility, building, validation and export."""

import copy
import json
from datetime import datetime

import pytest

from strataform.plans import build, feasibility, validate
from strataform.plans.registry import Registry, Stage
from strataform.plans.spec import Specification, SpecStore, errors, spec_hash
from strataform.sources import export

SPEC = {
    "dataset": {"name": "d", "version": 1}, "source": {"allowed_formats": ["html"], "allowed_languages": ["English"]}, "content": {"minimum_characters": 5, "maximum_characters": 50},
    "quality": {"minimum_score": 0.1}, "deduplication": {"mode": "normalized"}, "selection": {"maximum_records": 2}, "output": {"format": "jsonl"},
}


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [
        ("a", "good text one", "r1", "n1", 900, 0, "English", "html"), ("b", "good text one", "r1", "n1", 800, 0, "English", "html"), ("c", "good text two", "r2", "n2", 700, 0, "English", "html"),
        ("d", "good text six", "r6", "n6", 600, 0, "English", "html"), ("e", "no", "r3", "n3", 50, 1, "French", "pdf"), ("f", None, "r4", None, None, None, None, None), ("g", "x" * 60, "r5", "n5", 990, 0, "English", "html"),
    ]
    at = datetime(2030, 1, 1)
    full = [(*r, None, f"http://s/{r[0]}", f"cd-{r[0]}", f"ar-{r[0]}", at) for r in rows]
    names = "doc_id string, normalized_text string, raw_checksum string, normalized_checksum string, character_count long, warning_count long, language string, detected_format string, source_mime_type string, source_url string, canonical_document_id string, artifact_id string, created_at timestamp"
    return spark.createDataFrame(full, names)


@pytest.mark.parametrize(
    ("section", "key", "value", "said"),
    [
        ("dataset", "name", "", "non-empty"), ("dataset", "version", 0, "positive"), ("source", "allowed_formats", ["pdf"], "Unsupported format"), ("source", "allowed_formats", "html", "list"),
        ("content", "minimum_characters", -1, ">= 0"), ("content", "maximum_characters", 0, "> 0"), ("content", "minimum_characters", 99, "less than"), ("quality", "minimum_score", 2, "between"),
        ("quality", "minimum_score", "x", "number"), ("deduplication", "mode", "all", "Unsupported"), ("deduplication", "similarity_threshold", 2, "between"), ("selection", "maximum_records", 0, "positive"), ("output", "format", "xls", "Unsupported"),
    ],
)
def test_spec_errors(section, key, value, said):
    bad = copy.deepcopy(SPEC)
    bad[section][key] = value
    assert any(said in e for e in errors(bad))


def test_spec_identity():
    assert errors(SPEC) == [] and errors({}) == ["Missing 'dataset' section"]
    assert spec_hash(SPEC) == spec_hash(dict(reversed(SPEC.items())))
    held = SpecStore()
    held.create(SPEC)
    with pytest.raises(ValueError):
        held.create(SPEC)
    assert held.get("d").hash == spec_hash(SPEC) and len(held.list("active")) == 1


def test_decisions(corpus):
    spec = Specification(SPEC)
    got = {r.doc_id: (r.decision, tuple(r.reason_codes)) for r in build.decide(corpus, spec).collect()}
    assert got == {
        "a": ("accepted", ("dedup_representative",)), "b": ("rejected", ("exact_duplicate",)), "c": ("accepted", ("dedup_unique",)), "d": ("rejected", ("record_limit_reached",)),
        "e": ("rejected", ("unsupported_format", "wrong_language", "content_too_short", "quality_below_threshold")),
        "f": ("rejected", ("unsupported_format", "wrong_language", "content_too_short", "quality_below_threshold")), "g": ("rejected", ("content_too_long",)),
    }
    none = build.decide(corpus.limit(0), spec)
    assert build.build_statistics(none).first().asDict() == {"considered": 0, "accepted": 0, "rejected": 0, "acceptance_rate": 0.0}


def test_feasibility(corpus):
    spec = Specification(SPEC)
    rows = [(r.stage, r.input_count, r.output_count) for r in feasibility.stage_counts(corpus, spec).collect()]
    assert rows == [("format", 7, 5), ("language", 5, 5), ("length", 5, 4), ("quality", 4, 4)]
    reasons = {r.reason: r.rejected for r in feasibility.rejections(corpus, spec).collect()}
    assert reasons == {"format:pdf": 1, "format:unknown": 1, "above_maximum:50": 1}
    assert feasibility.report(corpus, spec)["feasibility"] == "pass" and feasibility.report(corpus.limit(0), spec)["feasibility"] == "blocked"
    assert feasibility.dedup_impact(feasibility.eligible(corpus, spec)).first().duplicates == 1


def test_validation_and_export(corpus, tmp_path):
    spec = Specification(SPEC)
    decisions = build.decide(corpus, spec)
    records = build.records(corpus, decisions, spec, "b1")
    n = build.build_statistics(decisions).first().asDict()
    checks = validate.checks(records, spec, n["considered"], n["accepted"], n["rejected"], spec.hash)
    assert validate.roll_up(checks).first().status == "pass" and checks.count() == 10
    bad = {r.check for r in validate.checks(records.union(records), spec, 9, n["accepted"], n["rejected"], "other").collect() if not r.passed}
    assert bad == {"record_counts", "duplicate_leakage", "specification_compliance", "rejection_accounting"}
    manifest = validate.manifest(spec, "b1", n, validate.record_checksum(records, serial=True))
    assert manifest["record_checksums"]["canonical_record_count"] == 2
    import hashlib

    assert manifest["record_checksums"]["sha256"] == hashlib.sha256(json.dumps(["a", "c"]).encode()).hexdigest()
    paths = export.export_package(str(tmp_path), records, decisions, "b1", manifest, n, None)
    lines = [json.loads(r.value) for r in corpus.sparkSession.read.text(paths["data"]).collect()]
    assert {x["normalized_record_id"] for x in lines} == {"a", "c"} and tuple(lines[0]) == export.RECORD
    assert corpus.sparkSession.read.text(paths["rejected"]).count() == 5
    for fmt in ("csv", "parquet"):
        export.write_rows(export.record_rows(records), str(tmp_path / fmt), fmt)


def test_build_state_and_registry(corpus):
    state = build.Build("b").move("validating", considered=3)
    with pytest.raises(ValueError):
        state.move("building")
    assert state.move("failed", "broken").counts == {"considered": 3}
    registry = Registry()
    registry.register(Stage("first", "store", lambda df: df.limit(1)))
    assert registry.run(corpus, "first").count() == 1 and "standard_normalizer" in registry.names()
    with pytest.raises(KeyError):
        registry.get("none")


def test_cli_codes(tmp_path, capsys):
    from strataform.cli import main

    path = tmp_path / "spec.json"
    path.write_text(json.dumps(SPEC))
    assert main(["spec", "--spec", str(path)]) == 0
    path.write_text("{}")
    assert main(["spec", "--spec", str(path)]) == 1
    assert main(["nothing"]) == 2
