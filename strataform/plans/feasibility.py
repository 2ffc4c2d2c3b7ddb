"""Feasibility of a specification: how many rows pass each stage, in one pass.

Each row gets the first stage it fails; the counts of all stages follow from the
counts of that one column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataform.functions.text import two_places
from strataform.plans.spec import Specification, below_score, format_rule, language_rule, length_of, score, too_long, too_short

STAGES = ("format", "language", "length", "quality")


def staged(corpus: DataFrame, spec: Specification) -> DataFrame:
    """Add ``stage``, the number of the first stage a row fails (null: eligible), and ``reason``."""
    low, high = spec.get("content", "minimum_characters"), spec.get("content", "maximum_characters")
    unknown = F.lit("unknown")
    fails = [
        (~format_rule(spec), F.concat(F.lit("format:"), F.coalesce(F.nullif("detected_format", F.lit("")), "source_mime_type", unknown))),
        (~language_rule(spec), F.concat(F.lit("language:"), F.coalesce("language", unknown))),
        (too_short(spec) | too_long(spec), F.when(too_short(spec), F.lit(f"below_minimum:{low}")).otherwise(F.lit(f"above_maximum:{high}"))),
        (below_score(spec), F.concat(F.lit("below_threshold:"), two_places(score()))),
    ]
    stage, reason = F.lit(None).cast("int"), F.lit(None).cast("string")
    for i in range(len(fails) - 1, -1, -1):
        stage = F.when(fails[i][0], i).otherwise(stage)
        reason = F.when(fails[i][0], fails[i][1]).otherwise(reason)
    return corpus.withColumn("stage", stage).withColumn("reason", reason)


def stage_counts(corpus: DataFrame, spec: Specification) -> DataFrame:
    """``(stage, input_count, output_count, rejected_count)`` for each stage in order."""
    at = staged(corpus, spec).agg(F.count("*").alias("n"), *[F.count_if(F.col("stage") == i).alias(f"r{i}") for i in range(len(STAGES))])
    rows, before = [], F.col("n")
    for i, name in enumerate(STAGES):
        after = before - F.col(f"r{i}")
        rows.append(F.struct(F.lit(name).alias("stage"), before.alias("input_count"), after.alias("output_count"), F.col(f"r{i}").alias("rejected_count")))
        before = after
    return at.select(F.inline(F.array(*rows)))


def rejections(corpus: DataFrame, spec: Specification) -> DataFrame:
    """``(stage, reason, rejected)``: first failures by reason."""
    names = F.array(*map(F.lit, STAGES))
    return staged(corpus, spec).where("stage is not null").groupBy(F.element_at(names, F.col("stage") + 1).alias("stage"), "reason").agg(F.count("*").alias("rejected"))


def eligible(corpus: DataFrame, spec: Specification) -> DataFrame:
    return staged(corpus, spec).where("stage is null").drop("stage", "reason")


def dedup_impact(rows: DataFrame) -> DataFrame:
    """One row: documents, distinct texts and those that deduplication would drop; no row is removed."""
    groups = rows.groupBy("normalized_checksum").agg(F.count("*").alias("n"))
    known = F.col("normalized_checksum").isNotNull()
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
        F.count_if(known & (F.col("n") > 1)).alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(known & (F.col("n") > 1), F.col("n") - 1)), F.lit(0)).alias("duplicates"),
    )


def language_distribution(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.coalesce("language", F.lit("unknown")).alias("language")).agg(F.count("*").alias("n"))


def quality_distribution(rows: DataFrame) -> DataFrame:
    """One row: rows, characters and the average rounded down, and the bytes an export would take."""
    return rows.agg(
        F.count("*").alias("records"),
        F.coalesce(F.sum(length_of().cast("long")), F.lit(0)).alias("total_characters"),
        F.coalesce(F.floor(F.sum(length_of().cast("long")) / F.count("*")), F.lit(0)).cast("long").alias("average_characters"),
        F.coalesce(F.sum(F.octet_length(F.coalesce("normalized_text", F.lit(""))).cast("long")), F.lit(0)).alias("estimated_bytes"),
    )


def report(corpus: DataFrame, spec: Specification) -> dict:
    """The verdict with blockers and warnings, from the stage counts alone."""
    stages = [r.asDict() for r in stage_counts(corpus, spec).collect()]
    considered, left = stages[0]["input_count"], stages[-1]["output_count"]
    least, most = spec.get("selection", "minimum_records"), spec.get("selection", "maximum_records")
    blockers, warnings = [], []
    if not considered:
        blockers.append("No normalized documents found in the corpus")
    if least is not None and left < least:
        blockers.append(f"Insufficient records: {left} eligible, minimum required is {least}")
    if most is not None and left > most:
        warnings.append(f"Record count exceeds maximum: {left} eligible, maximum is {most}")
    verdict = ("blocked" if not considered else "fail") if blockers else "pass"
    return {"specification_hash": spec.hash, "records_considered": considered, "eligible_count": left, "stages": stages, "blockers": blockers, "warnings": warnings, "feasibility": verdict}
