"""Command line: python -m strataform.cli COMMAND ...; exit code 0 done, 1 refused, 2 wrong use."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataform import queries
from strataform.operators import characterize, dedup, extract, inventory, normalize, quality
from strataform.plans import build, feasibility, validate
from strataform.plans.spec import Specification, errors
from strataform.runtime import local_session
from strataform.sources import catalog, export


def _read_spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="strataform")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("inventory", "inspect", "extract", "quality", "deduplicate", "feasibility", "build", "validate", "export", "run", "query"):
        p = commands.add_parser(name)
        p.add_argument("--data", required=True, help="folder of the tables")
        p.add_argument("--out", help="folder for the result")
        if name in ("feasibility", "build", "validate", "export", "run"):
            p.add_argument("--spec", required=True)
            p.add_argument("--allow-invalid", action="store_true")
        if name == "inspect":
            p.add_argument("--artifact", required=True)
        if name == "deduplicate":
            p.add_argument("--mode", default="near", choices=["exact", "normalized", "near"])
        if name == "query":
            p.add_argument("--name", required=True)
    commands.add_parser("spec").add_argument("--spec", required=True)
    return parser


def _show(rows: DataFrame, out: str | None) -> int:
    if out:
        export.write_rows(rows, out)
    else:
        for row in export.json_lines(rows).limit(50).collect():
            print(row.value)
    return 0


def main(arguments: list[str] | None = None) -> int:
    try:
        a = _parser().parse_args(arguments)
    except SystemExit as e:
        return 2 if e.code else 0
    if a.command == "spec":
        found = errors(_read_spec(a.spec))
        print("\n".join(found) or "valid")
        return 1 if found else 0
    spark = local_session()
    tables = catalog.Catalog(spark, a.data)
    if a.command == "query":
        known = queries.queries()
        if a.name not in known:
            print(f"no query {a.name}", file=sys.stderr)
            return 2
        return _show(known[a.name](spark, a.data), a.out)
    if a.command in ("inventory", "inspect", "extract"):
        artifacts = tables.table("artifacts")
        if a.command == "inspect":
            artifacts = catalog.find(artifacts, "artifact_id", a.artifact)
        known = characterize.characterize(artifacts)
        if a.command == "inventory":
            return _show(inventory.distributions(artifacts, known), a.out)
        return _show(known if a.command == "inspect" else extract.extract(artifacts, known), a.out)
    if a.command in ("quality", "deduplicate"):
        documents = tables.table("documents").select("doc_id", "text")
        if a.command == "quality":
            return _show(quality.content_composition(quality.text_metrics(documents)).drop("text"), a.out)
        checked = normalize.normalize(documents.where("text is not null")).select("doc_id", "text", F.sha2("text", 256).alias("raw_checksum"), "normalized_checksum")
        return _show(dedup.memberships(checked, a.mode), a.out)
    try:
        spec = Specification(_read_spec(a.spec))
    except ValueError as e:
        print(e, file=sys.stderr)
        return 1
    corpus = catalog.corpus_view(tables.table("normalized_documents"))
    verdict = feasibility.report(corpus, spec)
    if a.command == "feasibility" or verdict["feasibility"] != "pass" and not a.allow_invalid:
        print(json.dumps(verdict, indent=1))
        return 0 if verdict["feasibility"] == "pass" else 1
    decisions = build.decide(corpus, spec)
    if a.command == "build":
        return _show(decisions, a.out)
    state = build.Build(f"build-{spec.hash[:12]}").move("validating")
    records = build.records(corpus, decisions, spec, state.id)
    n = build.build_statistics(decisions).first().asDict()
    checks = [r.asDict() for r in validate.checks(records, spec, n["considered"], n["accepted"], n["rejected"], spec.hash).collect()]
    status = "fail" if any(c["severity"] == "error" and not c["passed"] for c in checks) else "warn" if any(c["severity"] == "warning" and not c["passed"] for c in checks) else "pass"
    report = {"status": status, "checks": checks}
    state.move("failed" if status == "fail" else "accepted", **n)
    if a.command == "validate" or status == "fail" and not a.allow_invalid:
        print(json.dumps(report, indent=1))
        return 1 if status == "fail" else 0
    if not a.out:
        print("--out is needed", file=sys.stderr)
        return 2
    statistics = n | validate.export_statistics(records).first().asDict()
    manifest = validate.manifest(spec, state.id, n, validate.record_checksum(records), report)
    export.export_package(a.out, records, decisions, state.id, manifest, statistics, report, str(spec.get("output", "format", "jsonl")), spec)
    return 0


if __name__ == "__main__":
    sys.exit(main())
