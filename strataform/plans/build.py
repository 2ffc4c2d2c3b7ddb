"""Building a dataset: a decision with reasons for every candidate.

Rows that pass the rules are deduplicated and capped; each candidate ends in
exactly one decision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataform.operators.dedup import TIERS, memberships, representatives
from strataform.plans.spec import Specification, below_score, format_rule, language_rule, length_of, score, too_long, too_short
from strataform.runtime import scratch, store

# Reason codes of decisions.
REJECTED_AS = {TIERS[0]: "exact_duplicate", TIERS[1]: "normalized_duplicate", TIERS[2]: "near_duplicate"}
KEPT_AS, UNIQUE, LIMIT = "dedup_representative", "dedup_unique", "record_limit_reached"


def rule_reasons(spec: Specification) -> Column:
    """All rules that a row fails."""
    return F.array_compact(
        F.array(
            F.when(~format_rule(spec), "unsupported_format"),
            F.when(~language_rule(spec), "wrong_language"),
            F.when(too_short(spec), "content_too_short"),
            F.when(too_long(spec), "content_too_long"),
            F.when(below_score(spec), "quality_below_threshold"),
        )
    )


#: Facts of a row that its decision records, beside those that are computed.
FACTS = ("language", "detected_format", "canonical_checksum", "normalized_checksum", "extraction_status", "size_bytes", "source_url")


def stored_groups(memberships: DataFrame) -> DataFrame:
    """``(doc_id, tier, group, representative_id, copy)``: groups found earlier, as a build takes them.

    A member is the first set of a membership's three references.  A document
    that any membership names as no representative is a copy; of several of its
    memberships the one created last names its group and method.  Missing marks
    count as no representative, unknown methods as near.
    """
    member = F.coalesce("normalized_document_id", "canonical_document_id", "artifact_id")
    rows = memberships.select(member.alias("doc_id"), "group_id", "comparison_method", F.coalesce("is_representative", F.lit(False)).alias("rep"), "created_at").where("doc_id is not null and group_id is not null")
    best = rows.where("rep").groupBy("group_id").agg(F.min("doc_id").alias("representative_id"))
    tier = F.when(F.col("comparison_method").isin(TIERS[0], TIERS[1]), F.col("comparison_method")).otherwise(TIERS[2])
    last = F.max(F.struct((~F.col("rep")).alias("copy"), "created_at", "group_id", tier.alias("tier")))
    found = rows.groupBy("doc_id").agg(last.alias("m")).select("doc_id", "m.tier", F.col("m.group_id").alias("group"), "m.copy")
    return found.join(best.withColumnRenamed("group_id", "group"), "group", "left").select("doc_id", "tier", "group", "representative_id", "copy")


def _found_groups(corpus: DataFrame, passed: DataFrame, spec: Specification, mode: str) -> DataFrame:
    """The same of groups found now among the rows that passed the rules."""
    texts = corpus.where(F.size(rule_reasons(spec)) == 0).select("doc_id", F.col("normalized_text").alias("text"))
    order = F.array_position(F.array(*map(F.lit, TIERS)), F.col("tier"))
    found = memberships(passed, mode, float(spec.get("deduplication", "similarity_threshold", 0.85)), texts)
    found = found.groupBy("doc_id").agg(F.min(F.struct(order.alias("at"), "tier", "group_id")).alias("m")).select("doc_id", "m.tier", "m.group_id")
    # A group is named by its tier too: the tiers number their groups alike.
    found = store(found.withColumn("group", F.concat_ws(":", "tier", F.col("group_id").cast("string"))), "members").df
    facts = passed.select("doc_id", "has_text", "quality_score", "warning_count")
    best = representatives(found.select(F.col("group").alias("group_id"), "doc_id").join(facts, "doc_id")).select(F.col("group_id").alias("group"), F.col("doc_id").alias("representative_id"))
    return found.join(best, "group").select("doc_id", "tier", "group", "representative_id", (F.col("representative_id") != F.col("doc_id")).alias("copy"))


def decide(corpus: DataFrame, spec: Specification, groups: DataFrame | None = None) -> DataFrame:
    """One decision for each row of the corpus.

    ``corpus(doc_id, normalized_text, raw_checksum, normalized_checksum,
    character_count, warning_count, language, detected_format, source_mime_type,
    source_url)``.  Adds decision, reason_codes, quality_score, dedup_group_id and
    representative_id.  A document in groups of several tiers is decided by the
    first; the better documents survive a cap, ties by id.  ``groups`` takes
    groups found earlier (see ``stored_groups``) instead of looking for them.

    Only narrow rows are kept and shuffled; texts are read where they lie, and
    shuffled by no mode.  The decisions are written; all else is dropped.
    """
    with scratch() as keep:
        there = [F.col(c) if c in corpus.columns else F.lit(None).cast("string").alias(c) for c in FACTS]
        facts = corpus.select(
            "doc_id", *there, "raw_checksum", "warning_count", F.col("normalized_text").isNotNull().alias("has_text"),
            length_of().cast("long").alias("text_characters"), score().alias("quality_score"), rule_reasons(spec).alias("reasons"),
        )
        judged = store(facts, "judged").df
        mode = str(spec.get("deduplication", "mode", "none"))
        passed = judged.where(F.size("reasons") == 0)
        found = groups if groups is not None else _found_groups(corpus, passed, spec, mode)
        joined = judged.join(found.select("doc_id", "tier", "group", "representative_id", "copy"), "doc_id", "left")
        tier_reason = F.when(F.col("tier") == TIERS[0], REJECTED_AS[TIERS[0]]).when(F.col("tier") == TIERS[1], REJECTED_AS[TIERS[1]]).otherwise(REJECTED_AS[TIERS[2]])
        copy = F.coalesce("copy", F.lit(False))
        failed = F.size("reasons") > 0
        kept_reason = F.array(F.when(F.lit(mode == "none" and groups is None), "accepted").when(F.col("group").isNotNull(), KEPT_AS).otherwise(UNIQUE))
        judged = joined.withColumn("accepted", ~failed & ~copy).withColumn("reason_codes", F.when(failed, F.col("reasons")).when(copy, F.array(tier_reason)).otherwise(kept_reason))
        most = spec.get("selection", "maximum_records")
        if most is not None:
            judged = _capped(judged, int(most))
        decided = judged.select(
            "doc_id", F.when(F.col("accepted"), "accepted").otherwise("rejected").alias("decision"), "reason_codes", "quality_score", "text_characters", *FACTS,
            F.col("group").alias("dedup_group_id"), "representative_id",
        )
        return keep(store(decided, "decisions")).df


def _capped(judged: DataFrame, most: int) -> DataFrame:
    """Reject what lies beyond the best ``most`` accepted rows.

    The best rows are taken by a top-k, which keeps k rows a partition; the
    border row then decides all others without a global order.
    """
    judged = store(judged, "decided").df
    top = judged.where("accepted").select("quality_score", "doc_id").orderBy(F.desc("quality_score"), "doc_id").limit(most)
    border = top.agg(F.max(F.struct((-F.col("quality_score")).alias("worse"), "doc_id")).alias("border"), F.count("*").alias("n")).first()
    if border.n < most:
        return judged
    worse, last = border.border
    beyond = (-F.col("quality_score") > F.lit(worse)) | ((-F.col("quality_score") == F.lit(worse)) & (F.col("doc_id") > F.lit(last)))
    over = F.col("accepted") & beyond
    return judged.withColumn("reason_codes", F.when(over, F.array(F.lit(LIMIT))).otherwise(F.col("reason_codes"))).withColumn("accepted", F.col("accepted") & ~over)


def top_k(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` rows with the highest score, ties by id."""
    return rows.orderBy(F.desc("quality_score"), "doc_id").limit(k)


def reason_counts(decisions: DataFrame) -> DataFrame:
    """``(reason, n)`` over all decisions; every accepted row counts under ``accepted`` as well."""
    codes = F.when(F.col("decision") == "accepted", F.array_union("reason_codes", F.array(F.lit("accepted")))).otherwise(F.col("reason_codes"))
    return decisions.select(F.explode(codes).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def build_statistics(decisions: DataFrame) -> DataFrame:
    """One row: considered, accepted, rejected and the acceptance rate to four places."""
    n, ok = F.count("*"), F.count_if(F.col("decision") == "accepted")
    return decisions.agg(n.alias("considered"), ok.alias("accepted"), (n - ok).alias("rejected"), F.when(n > 0, F.floor(ok / n * 10000 + 0.5) / 10000).otherwise(0.0).alias("acceptance_rate"))


def records(corpus: DataFrame, decisions: DataFrame, spec: Specification, build_id: str) -> DataFrame:
    """The accepted rows as dataset records."""
    kept = decisions.where("decision = 'accepted'").select("doc_id", "quality_score", "dedup_group_id", F.array_join("reason_codes", ",").alias("selection_reason"))
    key = F.col("doc_id").cast("string")
    lineage = lambda name: F.col(name) if name in corpus.columns else key
    return corpus.join(kept, "doc_id").select(
        F.concat_ws("-", F.lit(build_id), key).alias("id"), F.lit(build_id).alias("build_id"), F.lit(spec.hash).alias("specification_id"),
        lineage("source_record_id").alias("source_record_id"), key.alias("normalized_record_id"), lineage("canonical_document_id").alias("canonical_record_id"),
        lineage("artifact_id").alias("raw_artifact_id"), "source_url", F.col("normalized_text").alias("text"), "language", kept["quality_score"], "dedup_group_id", "selection_reason",
    )


class Build:
    """A build's state: building, validating, accepted, or failed with its error; counts are kept."""

    _NEXT = {"building": {"validating", "failed"}, "validating": {"accepted", "failed"}, "accepted": set(), "failed": set()}

    def __init__(self, build_id: str):
        self.id, self.status, self.error, self.counts = build_id, "building", None, {}

    def move(self, status: str, error: str | None = None, **counts: int) -> Build:
        if status not in self._NEXT[self.status]:
            raise ValueError(f"A build cannot go from {self.status} to {status}")
        self.status, self.error = status, error
        self.counts |= counts
        return self

