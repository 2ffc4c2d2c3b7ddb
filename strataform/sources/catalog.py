"""Catalogue views and reads: artifacts with provenance, the corpus view, lookups, upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataform.operators.language import NAMES
from strataform.runtime import BROADCAST_LIMIT_BYTES, store


class Catalog:
    """Tables of a folder by name, one Parquet table each."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def read_payloads(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files of a folder as artifacts: url, payload, size and checksum."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select(
        F.sha2(F.encode("path", "utf-8"), 256).alias("artifact_id"), F.col("path").alias("url"), F.lit(None).cast("string").alias("content_type"), F.col("content").alias("raw_data"),
        F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("checksum_sha256"), F.col("modificationTime").alias("created_at"),
    )


def latest(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key in an order; nulls come first and ties go by all values.

    Only keys that stand in several rows are compared and shuffled whole; a key
    that stands alone is left where it is.  Rows without a key count as one.
    """
    counted = rows.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("n")).where("n > 1").select("_key")
    copied = store(counted, "copied-keys")
    small = copied.size_bytes() * 4 <= BROADCAST_LIMIT_BYTES
    copies = F.broadcast(copied.df) if small else copied.df
    same = F.col(key).eqNullSafe(F.col("_key"))
    single, several = rows.join(copies, same, "left_anti"), rows.join(copies, same, "left_semi")
    rest = [c for c in rows.columns if c != key and c not in order]
    # Columns without an order (maps) ride along and never decide.
    kinds = {f.name: f.dataType.typeName() for f in rows.schema.fields}
    ranked = [c for c in [*order, *rest] if kinds[c] not in ("map", "variant")]
    carried = F.struct(*[c for c in rows.columns if c != key])
    picked = several.groupBy(key).agg(F.max_by(carried, F.struct(*ranked)).alias("r")).select(key, "r.*").select(*rows.columns)
    return single.unionByName(picked)


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``incoming`` replace those of ``current`` with the same keys."""
    return current.join(incoming.select(*keys).distinct(), keys, "left_anti").unionByName(incoming)


def ensure_resources(current: DataFrame, urls: DataFrame) -> DataFrame:
    """``current(id, url)`` with a row for each new URL; known URLs keep theirs."""
    new = urls.where("url is not null").select("url").distinct().join(current.select("url"), "url", "left_anti")
    return current.select("id", "url").unionByName(new.select(F.concat(F.lit("rs-"), F.substring(F.sha2("url", 256), 1, 16)).alias("id"), "url"))


def materialize(artifacts: DataFrame) -> DataFrame:
    """``(artifact_id, size_bytes, checksum_verified, status)``: whether the payload is there and whole."""
    same = F.sha2("raw_data", 256) == F.lower("checksum_sha256")
    return artifacts.select(
        "artifact_id",
        F.coalesce(F.octet_length("raw_data"), F.lit(0)).cast("long").alias("payload_bytes"),
        F.coalesce(same, F.lit(False)).alias("checksum_verified"),
        F.when(F.col("raw_data").isNull(), "missing").when(same, "completed").otherwise("failed").alias("status"),
    )


def artifacts_with_provenance(artifacts: DataFrame, resources: DataFrame) -> DataFrame:
    """Each artifact joined to its resource, the one seen last of several for a URL."""
    known = latest(resources.where("url is not null").select("url", F.col("id").alias("resource_id"), "domain", "first_seen_at", "last_seen_at"), "url", "last_seen_at")
    return artifacts.select("artifact_id", "url", "content_type", "size_bytes", "checksum_sha256", "created_at").join(known, "url")


def find(table: DataFrame, key: str, value: object) -> DataFrame:
    return table.where(F.col(key) == F.lit(value))


def find_any(table: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that a value of ``wanted(id)`` names by any of several keys, each row once.

    Rows that share all their keys are all found, and repeated rows stay repeated.
    """
    ids = wanted.where("id is not null").select("id").distinct()
    unmet, found = table, None
    for key in keys:
        # A row found by an earlier key takes no part any more.
        hit = unmet.join(ids.select(F.col("id").alias(key)), key, "left_semi").select(*table.columns)
        found = hit if found is None else found.unionByName(hit)
        unmet = unmet.join(ids.select(F.col("id").alias(key)), key, "left_anti").select(*table.columns)
    return table.where(F.lit(False)) if found is None else found


def candidate_scan(extractions: DataFrame, artifacts: DataFrame, resources: DataFrame) -> DataFrame:
    """Extraction results with what is known of their artifact and its resource, each result once.

    Results without an artifact, and artifacts without a resource, are kept with nulls.
    """
    results = extractions.select("artifact_id", "extraction_status", "detected_format", "canonical_checksum").distinct()
    payloads = latest(artifacts.where("artifact_id is not null").select("artifact_id", F.col("url").alias("artifact_url"), "content_type", "size_bytes"), "artifact_id")
    known = latest(resources.where("url is not null").select(F.col("url").alias("artifact_url"), F.col("id").alias("resource_id"), "domain", "last_seen_at"), "artifact_url", "last_seen_at")
    return results.join(payloads, "artifact_id", "left").join(known.drop("last_seen_at"), "artifact_url", "left")


def _language_name(code: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, F.lower(F.trim(code))), code)


def corpus_view(normalized: DataFrame) -> DataFrame:
    """Normalized documents as candidates, one row for each id.

    Rows repeated under an id count once, the one updated last; the language is
    a code's English name and null where the signal is.
    """
    rows = normalized.select(
        F.col("id").alias("doc_id"), "canonical_document_id", "artifact_id", F.lit(None).cast("string").alias("canonical_checksum"), "source_url", "detected_format", "source_mime_type", "normalized_text", F.col("original_checksum").alias("raw_checksum"),
        "normalized_checksum", "extraction_status", "size_bytes", _language_name(F.col("quality_signals.language.code")).alias("language"),
        F.col("canonical_quality_signals.text_metrics.character_count").alias("character_count"), F.coalesce(F.size("warnings"), F.lit(0)).cast("long").alias("warning_count"), "created_at", "updated_at",
    )
    return latest(rows, "doc_id", "updated_at")
