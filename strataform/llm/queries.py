"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataform.llm import groups, language, mainbody, mixing, packing, repetition, sitelines, splitting, survivors, textstats


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetition_signals(_table(spark, d, "documents")).where(F.col("repeated_share") >= repetition.COVERED_LIMIT).select("doc_id")


def p1_signals(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetition_signals(_table(spark, d, "documents"))


def p1_shares(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetition_signals(_table(spark, d, "documents")).select("doc_id", "n_words", "repeated_words", (F.floor(F.col("repeated_share") * 10000 + 0.5) / 10000).alias("repeated_share"))


def _site_lines(spark: SparkSession, d: str) -> sitelines.SiteLines:
    return sitelines.SiteLines(_table(spark, d, "normalized_documents"), _table(spark, d, "resources"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _site_lines(spark, d).occurrences().select("id", "line_no")


def p2_cleaned(spark: SparkSession, d: str) -> DataFrame:
    return _site_lines(spark, d).cleaned()


def p2_lines(spark: SparkSession, d: str) -> DataFrame:
    """What the test says of every line it compares."""
    rounded = F.floor(F.col("ratio") * 1000 + 0.5) / 1000
    return _site_lines(spark, d).report().select("n", "site_docs", "outside_n", "outside_docs", rounded.alias("ratio"), "frequent", "significant")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return mainbody.page_lines(_table(spark, d, "artifacts"), _table(spark, d, "extraction_results")).where("outside").select("artifact_id", "line_no")


def p3_main_body(spark: SparkSession, d: str) -> DataFrame:
    return mainbody.main_bodies(_table(spark, d, "artifacts"), _table(spark, d, "extraction_results"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    found = textstats.composition(_table(spark, d, "documents"))
    return found.where((F.col("chars") > 0) & (F.col("prose_share") < textstats.PROSE_SHARE)).select("doc_id")


def p4_statistics(spark: SparkSession, d: str) -> DataFrame:
    return textstats.composition(_table(spark, d, "documents"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return language.label_cases(language.detect_language(_table(spark, d, "documents")))


def p5_languages(spark: SparkSession, d: str) -> DataFrame:
    return language.detect_language(_table(spark, d, "documents")).select("doc_id", "label", "language", "confidence", F.size("mixed").alias("languages"))


def p5_segments(spark: SparkSession, d: str) -> DataFrame:
    return language.language_segments(_table(spark, d, "documents"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return groups.consolidate(_table(spark, d, "similarity_results"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.survivors(_table(spark, d, "dedup_documents"), _table(spark, d, "duplicate_memberships"))


def p7_records(spark: SparkSession, d: str) -> DataFrame:
    return survivors.surviving_records(_table(spark, d, "dedup_documents"), _table(spark, d, "duplicate_memberships"))


def p7_currency(spark: SparkSession, d: str) -> DataFrame:
    """How often reasoning finds the latest row of documents whose dates are hidden from it."""
    return survivors.currency_trial(_table(spark, d, "dedup_documents"))


def _packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(_table(spark, d, "documents"), _table(spark, d, "container_specs"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return packing.oversized(_packed(spark, d))


def p8_assignment(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    specs = packing.read_specs(_table(spark, d, "container_specs"), "capacity_tokens")
    return packing.fill_report(_packed(spark, d), specs)


def p8_invariants(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of every packing: all tokens placed, no container overfull, no text cut that fits."""
    specs = packing.read_specs(_table(spark, d, "container_specs"), "capacity_tokens")
    return packing.invariants(_packed(spark, d), specs)


def _mixture(spark: SparkSession, d: str) -> mixing.Mixture:
    return mixing.Mixture(_table(spark, d, "documents"), _table(spark, d, "mix_targets"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return mixing.short_sources(_mixture(spark, d).shares())


def p9_drawn(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d).drawn()


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d).shares()


def p9_invariants(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of every mixture: targets met where they can be, no text drawn too often, no shard overfull."""
    return mixing.invariants(_mixture(spark, d))


def _pieces(spark: SparkSession, d: str, with_text: bool) -> DataFrame:
    specs = packing.read_specs(_table(spark, d, "split_specs"), "max_tokens", "overlap_tokens")
    return splitting.split_documents(_table(spark, d, "documents"), specs, with_text)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.oversized(_pieces(spark, d, with_text=False))


def p10_pieces(spark: SparkSession, d: str) -> DataFrame:
    return _pieces(spark, d, with_text=True)


def p10_invariants(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of all pieces: within the limit, their text that of their tokens, nothing lost or doubled."""
    return splitting.invariants(p10_pieces(spark, d), packing.read_specs(_table(spark, d, "split_specs"), "max_tokens", "overlap_tokens"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        p1_found, p1_signals, p1_shares, p2_found, p2_cleaned, p2_lines, p3_found, p3_main_body, p4_found, p4_statistics, p5_found, p5_languages, p5_segments, p6_found, p7_found, p7_records, p7_currency, p8_found, p8_assignment, p8_fill,
        p8_invariants, p9_found, p9_drawn, p9_shares, p9_invariants, p10_found, p10_pieces, p10_invariants,
    ]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    from strataform.llm.oracles import SQL

    return dict(SQL)
