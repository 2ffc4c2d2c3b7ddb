"""The queries of the core operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataform.functions import urls
from strataform.operators import characterize as ch
from strataform.operators import dedup, extract, inventory, language, normalize, quality
from strataform.plans import build, feasibility, validate
from strataform.plans.spec import Specification
from strataform.runtime import BROADCAST_LIMIT_BYTES, spread, store
from strataform.sources import catalog, export

Query = Callable[[SparkSession, str], DataFrame]
_REGISTERED: dict[str, Query] = {}


def query(f: Query) -> Query:
    _REGISTERED[f.__name__] = f
    return f


#: The specification of the flagship build.
SPEC = {
    "dataset": {"name": "flagship", "version": 1},
    "source": {"allowed_formats": ["html", "plain_text", "markdown"], "allowed_languages": ["English", "French", "Spanish", "German", "Dutch"]},
    "content": {"minimum_characters": 100, "maximum_characters": 10_000},
    "quality": {"minimum_score": 0.5},
    "deduplication": {"mode": "normalized", "similarity_threshold": 0.85},
    "selection": {"maximum_records": 400, "minimum_records": 10},
    "output": {"format": "jsonl"},
}


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return catalog.Catalog(spark, d).table(name)


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(_table(spark, d, "documents").select("doc_id", "text", "lang", "source"))


def _checked(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the checksums of their texts as they are and normalized."""
    known = normalize.normalize(_documents(spark, d))
    return known.select("doc_id", "text", F.sha2("text", 256).alias("raw_checksum"), "normalized_checksum")


def _corpus(spark: SparkSession, d: str) -> DataFrame:
    return catalog.corpus_view(_table(spark, d, "normalized_documents"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Decisions of the flagship build by reason."""
    return build.reason_counts(build.decide(_corpus(spark, d), Specification(SPEC)))


# sources


@query
def url_normalize(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "resources").select("id", "url", urls.normalize_url(F.col("url")).alias("full_url"), urls.url_host(F.col("url")).alias("host"), urls.file_extension(F.col("url")).alias("file_extension")).distinct()


@query
def domain_policy(spark: SparkSession, d: str) -> DataFrame:
    allowed = ["harbor-ledger.example", " GA-TAN-VEL.example "]
    url = F.col("url")
    return _table(spark, d, "artifacts").select("artifact_id", urls.domain_allowed(url, allowed).alias("allowed"), urls.private_address(url, allowed).alias("private"))


@query
def content_type_policy(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("content_type")
    return _table(spark, d, "artifacts").select("artifact_id", urls.content_type_allowed(kind, ["text/*", "application/json"]).alias("allowed"), urls.resource_class(kind).alias("resource_class"))


@query
def materialized_artifacts(spark: SparkSession, d: str) -> DataFrame:
    return catalog.materialize(_table(spark, d, "artifacts"))


@query
def artifacts_with_provenance(spark: SparkSession, d: str) -> DataFrame:
    found = catalog.artifacts_with_provenance(_table(spark, d, "artifacts"), _table(spark, d, "resources"))
    return found.select("artifact_id", "url", "resource_id", "domain", "size_bytes", "checksum_sha256")


@query
def point_lookup(spark: SparkSession, d: str) -> DataFrame:
    return catalog.find(_table(spark, d, "resources"), "resource_type", "web").select("id", "url").distinct()


@query
def any_reference_lookup(spark: SparkSession, d: str) -> DataFrame:
    members = _table(spark, d, "duplicate_memberships")
    keys = ["normalized_document_id", "canonical_document_id", "artifact_id"]
    wanted = members.select(F.explode(F.array_compact(F.array(*keys))).alias("id"))
    return catalog.find_any(_table(spark, d, "dedup_documents").select("document_id", *keys).distinct(), wanted, keys).select("document_id")


@query
def candidate_scan(spark: SparkSession, d: str) -> DataFrame:
    found = catalog.candidate_scan(_table(spark, d, "extraction_results"), _table(spark, d, "artifacts"), _table(spark, d, "resources"))
    return found.select("artifact_id", "extraction_status", "artifact_url", "content_type", "size_bytes", "resource_id")


@query
def latest_documents(spark: SparkSession, d: str) -> DataFrame:
    return catalog.latest(_table(spark, d, "dedup_documents").select("document_id", "quality_score", "warning_count", "updated_at"), "document_id", "updated_at").select("document_id", "warning_count")


@query
def upserted_resources(spark: SparkSession, d: str) -> DataFrame:
    all_rows = catalog.latest(_table(spark, d, "resources").select("url", "id", "domain", "last_seen_at"), "url", "last_seen_at").select("url", "id", "domain")
    web = all_rows.where("domain like '%.test'").withColumn("domain", F.upper("domain"))
    return catalog.upsert(all_rows, web, ["url"])


@query
def ensured_resources(spark: SparkSession, d: str) -> DataFrame:
    return catalog.ensure_resources(_table(spark, d, "resources").select("id", "url").distinct(), _table(spark, d, "artifacts").unionByName(_table(spark, d, "documents"), allowMissingColumns=True).select("url"))


@query
def corpus_view(spark: SparkSession, d: str) -> DataFrame:
    return _corpus(spark, d).select("doc_id", "language", "character_count", "detected_format", F.length("normalized_text").alias("text_length"), "warning_count")


# characterization and inventory


def _characterized(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    artifacts = _table(spark, d, "artifacts")
    return artifacts, ch.characterize(artifacts)


@query
def format_detection(spark: SparkSession, d: str) -> DataFrame:
    return _characterized(spark, d)[1].select("artifact_id", "detected_format", "format_confidence", "vote_sources", "vote_count", "file_extension", "extraction_suitability")


@query
def encoding_detection(spark: SparkSession, d: str) -> DataFrame:
    return _characterized(spark, d)[1].select("artifact_id", "encoding", "encoding_confidence")


@query
def structure_and_type(spark: SparkSession, d: str) -> DataFrame:
    return _characterized(spark, d)[1].select("artifact_id", "structural_type", F.array_join("document_types", ",").alias("document_types"), "title_indicators", "encoding_declarations")


@query
def content_statistics(spark: SparkSession, d: str) -> DataFrame:
    return _characterized(spark, d)[1].select("artifact_id", "byte_count", "character_count", "line_count", "word_count", "non_ascii_count", "analysis_scope")


@query
def schema_summary(spark: SparkSession, d: str) -> DataFrame:
    return _characterized(spark, d)[1].where("schema_summary is not null").select("artifact_id", "schema_summary", "item_count")


@query
def artifact_availability(spark: SparkSession, d: str) -> DataFrame:
    return inventory.availability(_table(spark, d, "artifacts"))


@query
def artifact_states(spark: SparkSession, d: str) -> DataFrame:
    return inventory.artifact_states(*_characterized(spark, d))


@query
def inventory_distributions(spark: SparkSession, d: str) -> DataFrame:
    return inventory.distributions(*_characterized(spark, d))


@query
def format_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return inventory.format_conflicts(*_characterized(spark, d))


@query
def misdeclared_formats(spark: SparkSession, d: str) -> DataFrame:
    """The conflicts if every artifact were declared as JSON."""
    artifacts, known = _characterized(spark, d)
    return inventory.format_conflicts(artifacts.withColumn("content_type", F.lit("application/json; charset=utf-8")), known)


@query
def inventory_messages(spark: SparkSession, d: str) -> DataFrame:
    return inventory.message_counts(_characterized(spark, d)[1])


@query
def inventory_totals(spark: SparkSession, d: str) -> DataFrame:
    return inventory.totals(*_characterized(spark, d))


@query
def extraction(spark: SparkSession, d: str) -> DataFrame:
    return extract.extract(*_characterized(spark, d)).select("artifact_id", "extraction_status", "canonical_text", "extraction_method", "error_category", "canonical_checksum", "structured_checksum")


@query
def extraction_summary(spark: SparkSession, d: str) -> DataFrame:
    return extract.extraction_summary(extract.extract(*_characterized(spark, d)))


# text


@query
def normalized_documents(spark: SparkSession, d: str) -> DataFrame:
    rows = normalize.normalize(_documents(spark, d))
    return rows.select("doc_id", "normalized_text", "normalized_checksum", "content_changed", F.array_join("normalization_operations", ",").alias("operations"))


@query
def text_metrics(spark: SparkSession, d: str) -> DataFrame:
    names = ["character_count", "word_count", "line_count", "estimated_token_count", "avg_word_length", "avg_line_length", "min_line_length", "max_line_length"]
    return quality.text_metrics(_documents(spark, d)).select("doc_id", *names)


@query
def content_composition(spark: SparkSession, d: str) -> DataFrame:
    return quality.content_composition(_documents(spark, d)).drop("text", "lang", "source")


@query
def repetition_signals(spark: SparkSession, d: str) -> DataFrame:
    return quality.repetition_signals(_documents(spark, d)).drop("text", "lang", "source")


@query
def completeness_signals(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "extraction_results").select("artifact_id", "canonical_text", "warnings").distinct()
    return quality.completeness_signals(rows, "canonical_text", "warnings").drop("canonical_text", "warnings")


@query
def quality_scores(spark: SparkSession, d: str) -> DataFrame:
    return _documents(spark, d).select("doc_id", quality.quality_score(F.length("text")).alias("quality_score"))


@query
def html_quality(spark: SparkSession, d: str) -> DataFrame:
    artifacts, known = _characterized(spark, d)
    pages = extract.extract(artifacts, known).join(known.where("detected_format = 'html'").select("artifact_id", F.col("character_count").alias("raw_characters")), "artifact_id")
    return quality.html_signals(pages).select("artifact_id", "extracted_ratio", "link_density")


def _signals(rows: DataFrame, key: str, fmt: str, text: Column, *names: str) -> DataFrame:
    return rows.select(key, quality.format_signals(F.lit(fmt), text).alias("s")).select(key, *[f"s.{n}" for n in names])


@query
def structured_signals(spark: SparkSession, d: str) -> DataFrame:
    rows = _table(spark, d, "extraction_results").select("artifact_id", "structured_data").distinct()
    return _signals(rows, "artifact_id", "json", F.col("structured_data"), "items", "nulls", "empty", "null_ratio", "empty_ratio")


@query
def csv_signals(spark: SparkSession, d: str) -> DataFrame:
    """Resources as delimited files of one row."""
    rows = _table(spark, d, "resources").select("id", "domain", "resource_type", "discovered_from").distinct()
    cell = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    text = F.concat(F.lit("domain,resource_type,discovered_from\n"), F.concat_ws(",", *[cell(F.col(c)) for c in ("domain", "resource_type", "discovered_from")]))
    return _signals(rows, "id", "csv", text, "columns", "rows", "items", "empty", "empty_ratio").distinct()


@query
def xml_signals(spark: SparkSession, d: str) -> DataFrame:
    """Resources as documents with an element for each field that is there."""
    rows = _table(spark, d, "resources").select("id", "domain", "resource_type").distinct()
    safe = lambda c: F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    part = lambda c: F.coalesce(F.concat(F.lit(f"<{c}>"), safe(c), F.lit(f"</{c}>")), F.lit(""))
    text = F.concat(F.lit('<resource kind="row">'), part("domain"), part("resource_type"), F.lit("<note/></resource>"))
    return _signals(rows, "id", "xml", text, "root", "has_attributes", "items", "empty", "empty_ratio").distinct()


@query
def language_pairs(spark: SparkSession, d: str) -> DataFrame:
    rows = _documents(spark, d).withColumn("code", language.label_code(F.col("lang"))).where("code is not null")
    return language.pair_counts(rows, "code").select(F.col("by").alias("lang"), "pair", "n")


@query
def language_detect(spark: SparkSession, d: str) -> DataFrame:
    documents = _documents(spark, d)
    return language.detect(documents, language.learn_profiles(documents))


@query
def language_distribution(spark: SparkSession, d: str) -> DataFrame:
    return language_detect(spark, d).groupBy("language").agg(F.count("*").alias("n"))


# duplicates


@query
def raw_exact_groups(spark: SparkSession, d: str) -> DataFrame:
    return dedup.exact_groups(_checked(spark, d), "raw_checksum")


@query
def normalized_exact_groups(spark: SparkSession, d: str) -> DataFrame:
    return dedup.exact_groups(_checked(spark, d), "normalized_checksum")


@query
def raw_reference_groups(spark: SparkSession, d: str) -> DataFrame:
    """References with the same raw checksum, with a text or without."""
    rows = catalog.latest(_table(spark, d, "dedup_documents").select("document_id", "raw_checksum", "updated_at"), "document_id", "updated_at")
    return dedup.exact_groups(rows, "raw_checksum", "document_id")


@query
def trigram_counts(spark: SparkSession, d: str) -> DataFrame:
    return dedup.shingled(_documents(spark, d)).select("doc_id", F.col("n").cast("long").alias("trigrams"))


@query
def sketch_bands(spark: SparkSession, d: str) -> DataFrame:
    return dedup.band_groups(dedup.sketches(_documents(spark, d)))


def _similar(spark: SparkSession, d: str, threshold: float) -> DataFrame:
    found = dedup.similar_pairs(_documents(spark, d), threshold=threshold)
    return found.select("a", "b", (F.floor(F.col("similarity") * 10000 + 0.5) / 10000).alias("similarity"))


@query
def sketch_bands_sorted(spark: SparkSession, d: str) -> DataFrame:
    return dedup.band_groups(dedup.sketches(_documents(spark, d), banding="sorted"))


@query
def sketch_links(spark: SparkSession, d: str) -> DataFrame:
    return dedup.sketch_links(_documents(spark, d), threshold=0.6)


@query
def near_dup_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _similar(spark, d, dedup.THRESHOLD)


@query
def near_dup_pairs_060(spark: SparkSession, d: str) -> DataFrame:
    return _similar(spark, d, 0.6)


@query
def near_dup_groups(spark: SparkSession, d: str) -> DataFrame:
    return dedup.similar_classes(_documents(spark, d))


@query
def near_dup_groups_060(spark: SparkSession, d: str) -> DataFrame:
    return dedup.similar_classes(_documents(spark, d), threshold=0.6)


@query
def near_group_statistics(spark: SparkSession, d: str) -> DataFrame:
    pairs = store(_similar(spark, d, 0.6), "pairs").df
    return dedup.group_statistics(pairs, dedup.connected_components(pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))))


@query
def near_pair_bands(spark: SparkSession, d: str) -> DataFrame:
    pairs = store(_similar(spark, d, 0.6), "pairs").df
    # Only documents of a pair need a sketch.
    paired = store(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "paired")
    ids = F.broadcast(paired.df) if paired.size_bytes() * 4 <= BROADCAST_LIMIT_BYTES else paired.df
    # Written, or trigrams would be made of all texts before the join.
    texts = store(_documents(spark, d).join(ids, "doc_id", "left_semi").select("doc_id", "text"), "paired-texts").df
    return dedup.shared_bands(pairs, dedup.band_buckets(dedup.sketches(texts)))


@query
def duplicate_memberships(spark: SparkSession, d: str) -> DataFrame:
    return dedup.memberships(_checked(spark, d), "normalized")


@query
def tiered_memberships(spark: SparkSession, d: str) -> DataFrame:
    return dedup.memberships(_checked(spark, d), "near")


@query
def dedup_result(spark: SparkSession, d: str) -> DataFrame:
    rows = _checked(spark, d)
    return dedup.result_counts(dedup.memberships(rows, "normalized"), rows.select("doc_id", (F.col("text") != "").alias("has_text")))


@query
def representatives(spark: SparkSession, d: str) -> DataFrame:
    rows = store(_checked(spark, d), "checked").df
    facts = rows.select("doc_id", F.col("text").isNotNull().alias("has_text"), quality.quality_score(F.length("text")).alias("quality_score"), F.lit(0).cast("long").alias("warning_count"))
    members = dedup.exact_memberships(rows, "normalized_checksum", dedup.TIERS[1]).select("group_id", "doc_id")
    return dedup.representatives(members.join(facts, "doc_id"))


@query
def keep_first(spark: SparkSession, d: str) -> DataFrame:
    rows = _corpus(spark, d).select("doc_id", "normalized_checksum", "created_at")
    return dedup.keep_first(rows, "normalized_checksum", ["created_at", "doc_id"]).select("doc_id", "normalized_checksum")


# specifications, builds, validation


@query
def feasibility_stages(spark: SparkSession, d: str) -> DataFrame:
    return feasibility.stage_counts(_corpus(spark, d), Specification(SPEC))


@query
def feasibility_rejections(spark: SparkSession, d: str) -> DataFrame:
    return feasibility.rejections(_corpus(spark, d), Specification(SPEC))


@query
def feasibility_dedup_impact(spark: SparkSession, d: str) -> DataFrame:
    return feasibility.dedup_impact(feasibility.eligible(_corpus(spark, d), Specification(SPEC)))


@query
def feasibility_languages(spark: SparkSession, d: str) -> DataFrame:
    return feasibility.language_distribution(feasibility.eligible(_corpus(spark, d), Specification(SPEC)))


@query
def feasibility_quality(spark: SparkSession, d: str) -> DataFrame:
    return feasibility.quality_distribution(feasibility.eligible(_corpus(spark, d), Specification(SPEC)))


@query
def build_decisions(spark: SparkSession, d: str) -> DataFrame:
    found = build.decide(_corpus(spark, d), Specification(SPEC))
    return found.select("doc_id", "decision", F.array_join("reason_codes", ",").alias("reasons"))


@query
def decision_records(spark: SparkSession, d: str) -> DataFrame:
    spec = Specification(SPEC)
    rows = export.decision_rows(build.decide(_corpus(spark, d), spec), "build", spec)
    asked = ["minimum_characters", "maximum_characters", "minimum_score", "deduplication_mode", "similarity_threshold", "maximum_records", "minimum_records"]
    measured = ["character_count", "language", "quality_score", "detected_format", "normalized_checksum", "extraction_status", "size_bytes"]
    listed = [F.array_join(f"thresholds.{c}", ",").alias(c) for c in ("allowed_formats", "allowed_languages")]
    return rows.select("record_id", "decision", F.array_join("reason_codes", ",").alias("reasons"), *[f"actual_values.{c}" for c in measured], *listed, *[f"thresholds.{c}" for c in asked])


@query
def stored_build_decisions(spark: SparkSession, d: str) -> DataFrame:
    """A build over document references with the groups of duplicate_memberships, the least id of each standing for it."""
    rows = catalog.latest(_table(spark, d, "dedup_documents").drop("canonical_document_id", "artifact_id", "normalized_document_id"), "document_id", "updated_at")
    corpus = rows.select(
        F.col("document_id").alias("doc_id"), "normalized_text", "raw_checksum", "normalized_checksum", "canonical_checksum", (F.col("quality_score") * 1000).alias("character_count"), "warning_count", "source_url",
        F.lit("html").alias("detected_format"), F.lit(None).cast("string").alias("source_mime_type"), F.lit("English").alias("language"),
    )
    members = _table(spark, d, "duplicate_memberships").withColumn("member", F.coalesce("normalized_document_id", "canonical_document_id", "artifact_id"))
    first = members.groupBy("group_id").agg(F.min("member").alias("first"))
    marked = members.join(first, "group_id").withColumn("is_representative", F.col("member") == F.col("first"))
    spec = Specification({"dataset": {"name": "stored", "version": 1}, "content": {"minimum_characters": 20}})
    found = build.decide(corpus, spec, build.stored_groups(marked))
    return found.select("doc_id", "decision", F.array_join("reason_codes", ",").alias("reasons"), "representative_id")


@query
def rejection_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return flagship(spark, d)


@query
def build_statistics(spark: SparkSession, d: str) -> DataFrame:
    return build.build_statistics(build.decide(_corpus(spark, d), Specification(SPEC)))


@query
def top_k_selection(spark: SparkSession, d: str) -> DataFrame:
    return build.top_k(_corpus(spark, d).select("doc_id", quality.quality_score(F.col("character_count")).alias("quality_score")), 100)


def _built(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, Specification]:
    corpus, spec = _corpus(spark, d), Specification(SPEC)
    decisions = build.decide(corpus, spec)
    return build.records(corpus, decisions, spec, "build"), decisions, spec


@query
def build_records(spark: SparkSession, d: str) -> DataFrame:
    return _built(spark, d)[0].select("normalized_record_id", "language", "quality_score", F.length("text").alias("text_length"))


@query
def validation_checks(spark: SparkSession, d: str) -> DataFrame:
    records, decisions, spec = _built(spark, d)
    n = build.build_statistics(decisions).first()
    return validate.checks(records, spec, n.considered, n.accepted, n.rejected, spec.hash)


@query
def validation_details(spark: SparkSession, d: str) -> DataFrame:
    """Offending records by a specification stricter than the one of the build."""
    strict = SPEC | {"content": {"minimum_characters": 400, "maximum_characters": 900}, "source": {"allowed_languages": ["English"]}, "quality": {"minimum_score": 0.9}}
    return validate.offenders(_built(spark, d)[0], Specification(strict))


@query
def validation_status(spark: SparkSession, d: str) -> DataFrame:
    return validate.roll_up(validation_checks(spark, d))


@query
def manifest_checksum(spark: SparkSession, d: str) -> DataFrame:
    found = validate.record_checksum(_built(spark, d)[0], serial=True)
    return spark.createDataFrame([(found["canonical_record_count"], found["sha256"])], "canonical_record_count long, sha256 string")


@query
def manifest_tree_checksum(spark: SparkSession, d: str) -> DataFrame:
    found = validate.record_checksum(_built(spark, d)[0])
    return spark.createDataFrame([(found["canonical_record_count"], found["sha256"])], "canonical_record_count long, sha256 string")


@query
def export_statistics(spark: SparkSession, d: str) -> DataFrame:
    return validate.export_statistics(_built(spark, d)[0])


@query
def exported_rows(spark: SparkSession, d: str) -> DataFrame:
    return export.json_lines(export.provenance_rows(_built(spark, d)[0]))


@query
def acceptance_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = quality.text_metrics(_corpus(spark, d), "normalized_text")
    words, text = F.col("word_count"), F.col("normalized_text")
    reasons = F.concat_ws("; ", F.when(words < 50, "too_few_words"), F.when(words > 1500, "too_many_words"), F.when(~F.coalesce(F.col("language") == "English", F.lit(False)), "wrong_language"), F.when(F.coalesce(text, F.lit("")) == "", "empty_text"))
    return rows.select("doc_id", reasons.alias("reasons"))


@query
def acceptance_statistics(spark: SparkSession, d: str) -> DataFrame:
    rows = quality.text_metrics(_corpus(spark, d), "normalized_text").withColumn("source_domain", F.try_element_at(F.split("source_url", "/"), F.lit(3)))
    return rows.groupBy("source_domain").agg(F.count("*").alias("documents"), F.min("word_count").alias("min_words"), F.max("word_count").alias("max_words"), F.sum("word_count").alias("total_words"))


def queries() -> dict[str, Query]:
    return dict(_REGISTERED)


def oracle_sql() -> dict[str, str]:
    from strataform.oracles import SQL

    return dict(SQL)
