"""Export packages: accepted rows, rejected ones, provenance, statistics, validation and manifest."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataform.plans.spec import Specification

# The fields of exported rows, in order.
RECORD = ("id", "build_id", "specification_id", "source_record_id", "normalized_record_id", "canonical_record_id", "raw_artifact_id", "source_url", "text", "language", "quality_score", "dedup_group_id", "selection_reason", "created_at")
DECISION = ("id", "build_id", "record_id", "decision", "reason_codes", "actual_values", "thresholds", "representative_record_id", "source_url", "created_at")
PROVENANCE = ("record_id", "source_record_id", "normalized_record_id", "canonical_record_id", "raw_artifact_id", "source_url", "language", "quality_score", "selection_reason", "dedup_group_id")

#: Where a specification holds the thresholds of decisions, and their types.
THRESHOLDS = {
    "allowed_formats": ("source", "allowed_formats", "array<string>"),
    "allowed_languages": ("source", "allowed_languages", "array<string>"),
    "minimum_characters": ("content", "minimum_characters", "long"),
    "maximum_characters": ("content", "maximum_characters", "long"),
    "minimum_score": ("quality", "minimum_score", "double"),
    "deduplication_mode": ("deduplication", "mode", "string"),
    "similarity_threshold": ("deduplication", "similarity_threshold", "double"),
    "maximum_records": ("selection", "maximum_records", "long"),
    "minimum_records": ("selection", "minimum_records", "long"),
}


def _pick(rows: DataFrame, names: tuple[str, ...], renamed: dict[str, str]) -> DataFrame:
    """Fields in a fixed order; those the rows lack are null."""
    have = set(rows.columns)
    return rows.select(*[F.col(renamed.get(n, n)).alias(n) if renamed.get(n, n) in have else F.lit(None).cast("string").alias(n) for n in names])


def record_rows(records: DataFrame) -> DataFrame:
    return _pick(records, RECORD, {})


def provenance_rows(records: DataFrame) -> DataFrame:
    return _pick(records, PROVENANCE, {"record_id": "id"})


def thresholds(spec: Specification | None) -> Column:
    """What a specification asks for, as one struct; null without one."""
    fields = []
    for name, (section, key, kind) in THRESHOLDS.items():
        value = spec.get(section, key, "none" if name == "deduplication_mode" else None) if spec else None
        fields.append((F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value)).cast(kind).alias(name))
    return F.struct(*fields)


def decision_rows(decisions: DataFrame, build_id: str, spec: Specification | None = None) -> DataFrame:
    """Decisions with what was measured and what the specification asks for."""
    facts = decisions.select(
        "*",
        F.concat_ws("-", F.lit(build_id), F.col("doc_id").cast("string")).alias("id"),
        F.lit(build_id).alias("build_id"),
        F.struct(F.col("text_characters").alias("character_count"), "language", "quality_score", "detected_format", "canonical_checksum", "normalized_checksum", "extraction_status", "size_bytes").alias("actual_values"),
        thresholds(spec).alias("thresholds"),
    )
    return _pick(facts, DECISION, {"record_id": "doc_id", "representative_record_id": "representative_id"})


def json_lines(rows: DataFrame) -> DataFrame:
    """One JSON object a row, with null fields kept."""
    return rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_rows(rows: DataFrame, path: str, fmt: str = "jsonl") -> None:
    """Write rows as jsonl, csv or parquet; nested fields of a csv are JSON."""
    if fmt == "jsonl":
        json_lines(rows).write.mode("overwrite").text(path)
    elif fmt == "parquet":
        rows.write.mode("overwrite").parquet(path)
    elif fmt == "csv":
        nested = {f.name for f in rows.schema.fields if f.dataType.typeName() in ("array", "struct", "map")}
        rows.select(*[F.to_json(c).alias(c) if c in nested else F.col(c) for c in rows.columns]).write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
    else:
        raise ValueError(f"Unsupported output format: {fmt}")


def _write_json(spark, document: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(document, ensure_ascii=False, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def export_package(folder: str, records: DataFrame, decisions: DataFrame, build_id: str, manifest: dict, statistics: dict, validation: dict | None, fmt: str = "jsonl", spec: Specification | None = None) -> dict[str, str]:
    """Write the six parts of a package and name their paths; without a validation a stub says so."""
    spark, root = records.sparkSession, folder.rstrip("/")
    paths = {n: f"{root}/{n}" for n in ("data", "rejected", "provenance", "manifest", "statistics", "validation_report")}
    write_rows(record_rows(records), paths["data"], fmt)
    write_rows(decision_rows(decisions.where("decision = 'rejected'"), build_id, spec), paths["rejected"], fmt)
    write_rows(provenance_rows(records), paths["provenance"], fmt)
    _write_json(spark, manifest, paths["manifest"])
    _write_json(spark, statistics, paths["statistics"])
    _write_json(spark, validation or {"status": "not_validated"}, paths["validation_report"])
    return paths


def rewrite_duplicates(folder: str, groups: DataFrame, members: DataFrame) -> None:
    """Replace the stored duplicate groups and memberships of a folder, memberships first.

    Neither may be read from that folder: write them elsewhere before.
    """
    root = folder.rstrip("/")
    members.write.mode("overwrite").parquet(f"{root}/duplicate_memberships.parquet")
    groups.write.mode("overwrite").parquet(f"{root}/duplicate_groups.parquet")
