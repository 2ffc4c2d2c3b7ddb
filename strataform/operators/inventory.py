"""Corpus inventory: availability, distributions, conflicts and coverage.

Every report is an aggregation over artifacts joined to their characteristics,
in long form ``(section, key, value)`` so that it stays one small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataform.functions.urls import lookup, main_type, url_host

# The format a declared media type promises.
PROMISED = {
    "text/html": "html",
    "application/xhtml+xml": "html",
    "text/plain": "plain_text",
    "text/markdown": "markdown",
    "application/json": "json",
    "application/xml": "xml",
    "text/xml": "xml",
    "text/csv": "csv",
    "application/csv": "csv",
}


def availability(artifacts: DataFrame) -> DataFrame:
    """``(artifact_id, availability)``: unavailable without a payload, corrupted where the checksum differs."""
    return artifacts.select(
        "artifact_id",
        F.when(F.col("raw_data").isNull(), "unavailable")
        .when(F.lower("checksum_sha256") != F.sha2("raw_data", 256), "corrupted")
        .otherwise("available")
        .alias("availability"),
    )


def artifact_states(artifacts: DataFrame, characteristics: DataFrame) -> DataFrame:
    """``(artifact_id, availability)`` with all five states.

    Besides those of ``availability``: characterization_failed where an available
    payload has no characteristics, unsupported where they name no format.
    """
    known = characteristics.select("artifact_id", "detected_format", F.lit(True).alias("known"))
    joined = availability(artifacts).join(known, "artifact_id", "left")
    there = F.col("availability") == "available"
    state = F.when(there & F.col("known").isNull(), "characterization_failed").when(there & F.col("detected_format").isNull(), "unsupported").otherwise(F.col("availability"))
    return joined.select("artifact_id", state.alias("availability"))


def size_bucket(size: Column) -> Column:
    """The size class of a byte count; a missing count counts as 0."""
    n = F.coalesce(size, F.lit(0))
    return F.when(n < 1024, "<1KB").when(n < 10_240, "1KB-10KB").when(n < 102_400, "10KB-100KB").when(n < 1_048_576, "100KB-1MB").otherwise(">1MB")


def distributions(artifacts: DataFrame, characteristics: DataFrame) -> DataFrame:
    """``(section, key, value)`` counts by format, type, domain, size, encoding, structure and suitability.

    Nulls are dropped but for domains, which count as ``unknown``.
    """
    facts = {
        "format": F.col("detected_format"),
        "mime_type": F.col("content_type"),
        "domain": F.coalesce(url_host(F.col("url")), F.lit("unknown")),
        "size": size_bucket(F.col("size_bytes")),
        "encoding": F.col("encoding"),
        "structural_type": F.col("structural_type"),
        "extraction_suitability": F.col("extraction_suitability"),
    }
    joined = artifacts.join(characteristics, "artifact_id", "left").select(F.array(*[F.struct(F.lit(k).alias("section"), v.alias("key")) for k, v in facts.items()]).alias("facts"))
    return joined.select(F.inline("facts")).where("key is not null").groupBy("section", "key").agg(F.count("*").alias("value"))


def format_conflicts(artifacts: DataFrame, characteristics: DataFrame) -> DataFrame:
    """Artifacts whose declared type promises another format than was detected."""
    joined = artifacts.select("artifact_id", main_type(F.col("content_type")).alias("declared_mime")).join(characteristics, "artifact_id")
    promised = lookup(F.col("declared_mime"), PROMISED)
    return joined.where(promised.isNotNull() & (promised != F.col("detected_format"))).select(
        "artifact_id", "declared_mime", "detected_format", F.col("format_confidence").alias("confidence")
    )


def message_counts(characteristics: DataFrame) -> DataFrame:
    """``(kind, message, value)``: warnings and errors by number."""
    kinds = F.array(F.struct(F.lit("warning").alias("kind"), F.col("warnings").alias("messages")), F.struct(F.lit("error").alias("kind"), F.col("errors").alias("messages")))
    found = characteristics.select(F.inline(kinds)).select("kind", F.explode("messages").alias("message"))
    return found.groupBy("kind", "message").agg(F.count("*").alias("value"))


def totals(artifacts: DataFrame, characteristics: DataFrame) -> DataFrame:
    """One row: artifacts, characterized ones, bytes, characters and coverage."""
    joined = artifacts.select("artifact_id", "size_bytes").join(characteristics.select("artifact_id", "character_count", F.lit(1).alias("known")), "artifact_id", "left")
    return joined.agg(
        F.count("*").alias("total_artifacts"),
        F.count("known").alias("characterized_count"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_bytes"),
        F.coalesce(F.sum("character_count"), F.lit(0)).alias("total_characters"),
        (F.coalesce(F.sum("size_bytes"), F.lit(0)) / F.greatest(F.count("*"), F.lit(1))).alias("average_bytes"),
        (F.count("known") / F.greatest(F.count("*"), F.lit(1))).alias("coverage"),
    )
