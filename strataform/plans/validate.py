"""Validation of a built dataset: ten checks from one aggregation, and the roll-up."""

from __future__ import annotations

import hashlib
import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataform.operators.language import NAMES
from strataform.plans.spec import Specification

# Fields that every record must have.
REQUIRED = ("id", "build_id", "specification_id", "source_record_id", "normalized_record_id", "canonical_record_id", "raw_artifact_id", "source_url", "text", "language", "selection_reason")
LINEAGE = ("source_record_id", "normalized_record_id", "canonical_record_id", "raw_artifact_id")
PROVENANCE = ("source_url", "raw_artifact_id", "canonical_record_id")


def _missing(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name).cast("string") == "")


def checks(records: DataFrame, spec: Specification, considered: int, accepted: int, rejected: int, build_hash: str | None = None) -> DataFrame:
    """``(check, severity, passed, failures)`` for the ten checks.

    ``failures`` counts offending records, or 1 for a count or hash that differs.
    A missing language passes; checks the specification does not ask for pass as
    information.
    """
    low, high = spec.get("content", "minimum_characters"), spec.get("content", "maximum_characters")
    least = spec.get("quality", "minimum_score")
    allowed = _allowed(spec)
    size = F.length("text")
    any_of = lambda names: F.count_if(_or([_missing(n) for n in names]))
    outside = (F.coalesce(size < low, F.lit(False)) if low is not None else F.lit(False)) | (F.coalesce(size > high, F.lit(False)) if high is not None else F.lit(False))
    # Copies of an id are counted in a first aggregation, so no set of ids is held.
    once = records.groupBy("normalized_record_id").agg(
        F.count("*").alias("n"),
        any_of(REQUIRED).alias("schema"),
        any_of(LINEAGE).alias("lineage"),
        any_of(PROVENANCE).alias("provenance"),
        (F.count_if(F.col("language").isNotNull() & ~F.lower("language").isin(sorted(allowed))) if allowed else F.lit(0)).alias("language"),
        (F.count_if(F.col("quality_score") < float(least)) if least is not None else F.lit(0)).alias("quality"),
        F.count_if(outside).alias("length"),
    )
    total = once.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("n", "schema", "lineage", "provenance", "language", "quality", "length")], F.coalesce(F.sum(F.when(F.col("normalized_record_id").isNotNull(), F.col("n") - 1)), F.lit(0)).cast("long").alias("copies"))
    flag = lambda bad: F.when(bad, 1).otherwise(0).cast("long")
    severe = lambda asked: "error" if asked else "info"
    rows = [
        ("schema_validity", "error", F.col("schema")),
        ("required_fields", "error", F.col("lineage")),
        ("record_counts", "error", flag(F.col("n") != accepted)),
        ("duplicate_leakage", "error", F.col("copies")),
        ("language_compliance", severe(allowed), F.col("language")),
        ("quality_compliance", severe(least is not None), F.col("quality")),
        ("content_length", severe(low is not None or high is not None), F.col("length")),
        ("provenance_completeness", "warning", F.col("provenance")),
        ("specification_compliance", "error", flag(F.lit(build_hash is not None and build_hash != spec.hash))),
        ("rejection_accounting", "warning", flag(F.lit(accepted + rejected != considered))),
    ]
    out = [F.struct(F.lit(n).alias("check"), F.lit(s).alias("severity"), (f == 0).alias("passed"), f.alias("failures")) for n, s, f in rows]
    return total.select(F.inline(F.array(*out)))


#: Offending records that a report names for each check, at most.
MOST_DETAILS = 20


def offenders(records: DataFrame, spec: Specification, most: int = MOST_DETAILS) -> DataFrame:
    """``(check, record_id)``: the first offending records of each check on records, by id.

    At most ``most`` for each check; the counts of ``checks`` are whole.
    """
    low, high = spec.get("content", "minimum_characters"), spec.get("content", "maximum_characters")
    least, allowed, size = spec.get("quality", "minimum_score"), _allowed(spec), F.length("text")
    tests = {
        "schema_validity": _or([_missing(n) for n in REQUIRED]),
        "required_fields": _or([_missing(n) for n in LINEAGE]),
        "language_compliance": F.col("language").isNotNull() & ~F.lower("language").isin(sorted(allowed)) if allowed else None,
        "quality_compliance": F.col("quality_score") < float(least) if least is not None else None,
        "content_length": (size < low if low is not None else F.lit(False)) | (size > high if high is not None else F.lit(False)),
        "provenance_completeness": _or([_missing(n) for n in PROVENANCE]),
    }
    key = F.col("normalized_record_id").cast("string").alias("record_id")
    parts = [records.where(bad).select(F.lit(name).alias("check"), key).orderBy("record_id").limit(most) for name, bad in tests.items() if bad is not None]
    copies = records.where("normalized_record_id is not null").groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    parts.append(copies.select(F.lit("duplicate_leakage").alias("check"), "record_id").orderBy("record_id").limit(most))
    return reduce(DataFrame.unionByName, parts)


def _allowed(spec: Specification) -> set[str]:
    """The allowed languages by name and code, in lower case."""
    allowed = {str(x).lower() for x in spec.get("source", "allowed_languages", [])}
    return allowed | {c for c, n in NAMES.items() if n.lower() in allowed} | {n.lower() for c, n in NAMES.items() if c in allowed}


def _or(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def roll_up(found: DataFrame) -> DataFrame:
    """``(status, overall_status, error_count, warning_count, info_count)``."""
    bad = lambda s: F.count_if((F.col("severity") == s) & ~F.col("passed"))
    n = found.agg(bad("error").alias("error_count"), bad("warning").alias("warning_count"), bad("info").alias("info_count"))
    pick = lambda a, b, c: F.when(F.col("error_count") > 0, a).when(F.col("warning_count") > 0, b).otherwise(c)
    return n.select(pick("fail", "warn", "pass").alias("status"), pick("invalid", "warnings", "valid").alias("overall_status"), "error_count", "warning_count", "info_count")


def record_checksum(records: DataFrame, serial: bool = False) -> dict:
    """Number and hash of the record set, whatever its order.

    By default a tree: the ids fall into runs by their own hash, a run is hashed
    whole by the executors, and the hash of the runs' hashes in order is the
    result, so the driver sees 4,096 rows at most.  ``serial`` hashes the JSON
    list of all ids in order, as strings; that needs a global sort and one stream
    through the driver.
    """
    ids = records.select(F.col("normalized_record_id").cast("string").alias("id"))
    if not serial:
        # An id's own 256-bit hash is added by quarters, so a run is no list in memory.
        parts = [F.conv(F.substring(F.sha2("id", 256), 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)") for i in range(8)]
        run = F.conv(F.substring(F.sha2("id", 256), 1, 3), 16, 10).cast("int")
        rows = ids.groupBy(run.alias("run")).agg(F.count("*").alias("n"), F.concat_ws(",", *[F.coalesce(F.sum(p), F.lit(0)).cast("string") for p in parts]).alias("sums")).orderBy("run").collect()
        digest = hashlib.sha256("\n".join(f"{r.run}:{r.n}:{r.sums}" for r in rows).encode()).hexdigest()
        return {"canonical_record_count": sum(r.n for r in rows), "sha256": digest}
    digest, n = hashlib.sha256(b"["), 0
    for row in ids.orderBy("id").toLocalIterator():
        digest.update((", " if n else "").encode() + json.dumps(str(row.id)).encode())
        n += 1
    digest.update(b"]")
    return {"canonical_record_count": n, "sha256": digest.hexdigest()}


PIPELINE_VERSION = "2.0.0"


def manifest(spec: Specification, build_id: str, statistics: dict, checksum: dict, validation: dict | None = None) -> dict:
    """A dataset's manifest."""
    return {
        "dataset_name": spec.name, "dataset_version": spec.document["dataset"]["version"], "dataset_build_id": build_id, "dataset_spec_hash": spec.hash, "pipeline_version": PIPELINE_VERSION,
        "source_snapshot": f"spec-{spec.hash[:12]}", "records_considered": statistics["considered"], "records_accepted": statistics["accepted"], "records_rejected": statistics["rejected"],
        "validation_status": validation["status"] if validation else "not_validated", "export_format": spec.get("output", "format", "jsonl"), "specification": spec.document, "record_checksums": checksum,
    } | ({"validation_report": validation} if validation else {})


def manifest_hash(document: dict) -> str:
    return hashlib.sha256(json.dumps(document, sort_keys=True, default=str).encode()).hexdigest()


def export_statistics(records: DataFrame) -> DataFrame:
    """One row: records, characters, averages to two and four places."""
    size, n = F.length("text").cast("long"), F.count("*")
    total = F.coalesce(F.sum(size), F.lit(0))
    # Scores are summed as whole millionths, so the sum does not depend on row order.
    points = F.coalesce(F.sum(F.round(F.col("quality_score") * 1_000_000).cast("long")), F.lit(0))
    rounded = lambda x, p: F.when(n > 0, F.floor(x * p + 0.5) / p).otherwise(0.0)
    return records.agg(n.alias("records"), total.alias("total_characters"), rounded(total / n, 100).alias("average_characters"), rounded(points / n / 1_000_000, 10_000).alias("average_quality"))
