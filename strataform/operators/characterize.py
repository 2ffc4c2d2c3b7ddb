"""Characterization of raw artifacts: format, encoding, structure, document type, statistics.

One projection over ``artifacts(artifact_id, url, content_type, raw_data)``.  All
but four facts are column expressions; what needs a parser (is it JSON, is it
well-formed XML, their shapes) comes from one Arrow pass over the previews.
"""

from __future__ import annotations

import json
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataform.functions.text import word_count
from strataform.functions.urls import MIME_FORMATS, extension_format, file_extension, lookup, main_type, mime_format

#: Bytes of an artifact that are inspected.
PREVIEW_BYTES = 65_536

SUITABLE = ("html", "json", "xml", "csv", "markdown", "plain_text")

PARSED = "artifact_id string, json_kind string, json_size long, json_schema string, xml_schema string, xml_elements long"


def _json_facts(text: str) -> tuple[str | None, int | None, str | None]:
    try:
        data = json.loads(text)
    except (ValueError, RecursionError):
        return None, None, None
    if isinstance(data, dict):
        return "object", len(data), json.dumps({"type": "object", "top_level_keys": list(data)}, ensure_ascii=False)
    if isinstance(data, list):
        if data and isinstance(data[0], dict):
            fields = {k: type(v).__name__ for k, v in data[0].items()}
            return "array-of-records", len(data), json.dumps({"type": "array-of-records", "record_count": len(data), "fields": fields}, ensure_ascii=False)
        return "array", len(data), None
    return "scalar", None, None


def _xml_facts(text: str) -> tuple[str | None, int | None]:
    try:
        root = ET.fromstring(text)
    except (ET.ParseError, ValueError):
        return None, None
    children = list(root)
    facts = {"type": "hierarchy", "root_tag": root.tag, "child_count": len(children), "child_tags": sorted({c.tag for c in children})}
    return json.dumps(facts, ensure_ascii=False), sum(1 for _ in root.iter())


def parser_facts(artifacts: DataFrame, preview_bytes: int = PREVIEW_BYTES) -> DataFrame:
    """Add what only parsers can tell about the preview of each artifact."""
    names = [x.split()[0] for x in PARSED.split(", ")][1:]
    kept = artifacts.columns
    types = {f.name: f.dataType.simpleString() for f in artifacts.schema.fields}
    out = ", ".join(f"`{c}` {types[c]}" for c in kept) + ", " + ", ".join(PARSED.split(", ")[1:])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data in batch.column(kept.index("raw_data")).to_pylist():
                text = (data or b"")[:preview_bytes].decode("utf-8", "replace")
                start = text.strip()[:1]
                kind = _json_facts(text) if start and start in '{["-0123456789tfn' else (None, None, None)
                shape = _xml_facts(text) if start == "<" else (None, None)
                rows.append((*kind, *shape))
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))], names=[*kept, *names])

    return artifacts.mapInArrow(parse, out)


def _commas(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(","), F.lit("")))


def _any(*tests: Column) -> Column:
    return reduce(lambda a, b: a | b, tests)


def _views(artifacts: DataFrame, preview_bytes: int) -> DataFrame:
    """The preview as bytes and as text, and its first lines."""
    preview = F.substring("raw_data", 1, preview_bytes)
    return (
        artifacts.withColumn("preview", preview)
        .withColumn("utf8", F.expr("is_valid_utf8(cast(preview as string))"))
        .withColumn("text", F.expr("make_valid_utf8(cast(preview as string))"))
        .withColumn("first_lines", F.slice(F.split("text", "\n"), 1, 5))
    )


def format_votes() -> list[tuple[Column, Column]]:
    """Format and confidence by declared type, URL, signature and content, in this order."""
    text, head = F.col("text"), F.ltrim(F.regexp_replace("text", r"^[\s\x0b]+", ""))
    lines = F.col("first_lines")
    has_commas = _commas(text) >= 2
    two_alike = (F.size(F.split(text, "\n")) >= 2) & (_commas(F.try_element_at(lines, F.lit(1))) == _commas(F.try_element_at(lines, F.lit(2))))
    magic = (
        F.when(_any(*[head.startswith(x) for x in ("<!DOCTYPE", "<html", "<HTML")]), "html")
        .when(head.startswith("<?xml") | head.startswith("<xml"), "xml")
        .when((head.startswith("{") | head.startswith("[")) & F.col("json_kind").isNotNull(), "json")
        .when(has_commas & two_alike, "csv")
        .when(text.startswith("#"), "markdown")
    )
    header = _commas(F.try_element_at(lines, F.lit(1)))
    rows_alike = F.forall(F.filter(lines, lambda x: F.trim(F.regexp_replace(x, r"\s", "")) != ""), lambda x: _commas(x) == header)
    plain_start = F.expr("regexp_replace(cast(substring(preview, 1, 32) as string), '[\\\\x20-\\\\x7e\\\\t\\\\n\\\\r]', '') = ''")
    content = (
        F.when(~plain_start | ~F.col("utf8"), None)
        .when(F.col("json_kind").isNotNull(), "json")
        .when(F.col("xml_schema").isNotNull(), "xml")
        .when(head.startswith("<") & F.lower(text).rlike("<html|<body"), "html")
        .when(has_commas & (F.size(F.split(text, "\n")) >= 2) & (header >= 1) & rows_alike, "csv")
        .when(text.rlike(r"(?m)^#{1,6}\s") | text.rlike(r"(?m)^\s*[-*+]\s"), "markdown")
        .when(text.rlike("<[a-zA-Z][^>]*>"), "html")
        .otherwise("plain_text")
    )
    exact = lookup(main_type(F.col("content_type")), MIME_FORMATS).isNotNull()
    return [(mime_format(F.col("content_type")), F.when(exact, "high").otherwise("medium")), (extension_format(F.col("url")), F.lit("medium")), (magic, F.lit("high")), (content, F.lit("medium"))]


def _vote(df: DataFrame) -> DataFrame:
    """Majority of the votes, ties to the earliest; any source of high confidence raises the confidence."""
    votes = F.filter(F.array(*[F.struct(f.alias("format"), c.alias("confidence")) for f, c in format_votes()]), lambda v: v["format"].isNotNull())
    df = df.withColumn("votes", votes)
    tally = F.transform("votes", lambda v, i: F.struct(F.size(F.filter("votes", lambda w: w["format"] == v["format"])).alias("n"), (-i).alias("early"), v["format"].alias("format")))
    best = F.array_max(tally)
    high = F.exists("votes", lambda v: v["confidence"] == "high")
    return (
        df.withColumn("best", best)
        .withColumn("detected_format", F.col("best.format"))
        .withColumn(
            "format_confidence",
            F.when(F.size("votes") == 0, "unknown").when((F.col("best.n") >= 2) & high, "high").when((F.col("best.n") >= 2) | high, "medium").otherwise("low"),
        )
    )


def _structure() -> Column:
    text, fmt = F.col("text"), F.col("detected_format")
    tag = lambda *names: text.rlike(f"(?i)<(?:{'|'.join(names)})\\b")
    stripped = F.regexp_replace(text, r"^\s+|\s+$", "")
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return (
        F.when(F.octet_length("raw_data") == 0, None)
        .when(fmt == "html", F.when(tag("article", "main"), "article-like").when(tag("nav", "menu"), "navigation-heavy").when(tag("table"), "structured-page").otherwise("document"))
        .when(fmt == "json", F.when(F.col("json_kind").isin("object", "array", "array-of-records"), F.col("json_kind")).otherwise("unknown-structured"))
        .when(fmt == "csv", F.when(stripped.contains("\n"), "tabular").otherwise("unknown-structured"))
        .when(fmt == "xml", F.when(tag("record", "item"), "repeated-records").otherwise("hierarchy"))
        .when(fmt == "markdown", F.when(text.rlike(r"(?m)^#{1,6}\s"), "headings-paragraphs").when(text.rlike(r"(?m)^\s*[-*+]\s"), "list-structured").when(text.contains("```"), "code-document").otherwise("prose"))
        .when(fmt == "plain_text", F.when(breaks > 1, "multi-line").otherwise("single-line"))
    )


def _document_types() -> Column:
    text, fmt = F.col("text"), F.col("detected_format")
    has = lambda pattern, name: F.when(text.rlike(f"(?i){pattern}"), name)

    def first_of(found: Column, default: str) -> Column:
        return F.when(F.size(found) == 0, F.array(F.lit(default))).otherwise(found)

    html = F.array_compact(F.array(has(r"<article\b", "article"), has(r"<form\b", "form"), has(r"<table\b", "data-table"), has(r"<pre\b|<code\b", "code-documentation")))
    js = F.array_compact(F.array(has('"api"|"endpoint"|"route"', "api-response"), has('"error"|"message"|"stack"', "error-log"), has('"config"|"settings"', "configuration")))
    return (
        F.when(fmt == "html", first_of(html, "webpage")).when(fmt == "json", first_of(js, "structured-data")).when(fmt == "csv", F.array(F.lit("tabular-data")))
        .when(fmt == "xml", F.array_compact(F.array(has(r"<rss\b|<feed\b", "feed"), has(r"<sitemap\b", "sitemap"), F.lit("structured-data"))))
        .when(fmt == "markdown", F.array_compact(F.array(F.when(text.rlike(r"(?m)^#{1,6}\s"), "documentation"), F.lit("text"))))
        .when(fmt == "plain_text", F.array(F.lit("text"))).otherwise(F.array().cast("array<string>"))
    )


def characterize(artifacts: DataFrame, preview_bytes: int = PREVIEW_BYTES) -> DataFrame:
    """One row of characteristics for each artifact.

    A null payload counts as an empty one.  Statistics are those of the preview;
    an artifact without a format or payload has zeros.
    """
    rows = artifacts.select("artifact_id", "url", "content_type", F.coalesce("raw_data", F.lit(b"")).alias("raw_data"))
    df = _vote(_views(parser_facts(rows, preview_bytes), preview_bytes))
    whole_utf8 = F.expr("is_valid_utf8(cast(raw_data as string))")
    empty = F.octet_length("raw_data") == 0
    marked = F.hex(F.substring("raw_data", 1, 3)) == "EFBBBF"
    df = df.withColumn("encoding", F.when(empty, None).when(marked, "utf-8-sig").when(whole_utf8, "utf-8").otherwise("latin-1"))
    # Bytes that are not UTF-8 are read one character each.
    shown = F.when(F.col("encoding") == "latin-1", F.expr("decode(preview, 'ISO-8859-1')")).when(marked, F.substring("text", 2, preview_bytes)).otherwise(F.col("text"))
    df = df.withColumn("shown", shown).withColumn("structural_type", _structure()).withColumn("document_types", _document_types())
    counted = F.col("detected_format").isNotNull() & ~empty
    number = lambda c: F.when(counted, c).otherwise(F.lit(0)).cast("long")
    breaks = F.length("shown") - F.length(F.replace("shown", F.lit("\n"), F.lit("")))
    size = F.octet_length("raw_data")
    plain_content = format_votes()[3][0].isin("html", "xml")
    csv_lines = F.split(F.regexp_replace("shown", r"^\s+|\s+$", ""), "\n")
    return df.select(
        "artifact_id",
        "detected_format",
        "format_confidence",
        F.size("votes").alias("vote_sources"),
        F.coalesce("best.n", F.lit(0)).alias("vote_count"),
        file_extension(F.col("url")).alias("file_extension"),
        "encoding",
        F.when(empty, "unknown").when(F.col("encoding") == "latin-1", "low").otherwise("high").alias("encoding_confidence"),
        "structural_type",
        "document_types",
        F.when(F.col("detected_format") == "json", F.col("json_schema")).when(F.col("detected_format") == "xml", F.col("xml_schema"))
        .when((F.col("detected_format") == "csv") & ~empty, F.to_json(F.struct(F.lit("tabular").alias("type"), F.size(F.split(csv_lines[0], ",")).alias("column_count"), F.split(csv_lines[0], ",").alias("columns"), (F.size(csv_lines) - 1).alias("row_count")))).alias("schema_summary"),
        size.cast("long").alias("byte_count"),
        number(F.length("shown")).alias("character_count"),
        number(breaks + F.when((F.col("shown") != "") & ~F.col("shown").endswith("\n"), 1).otherwise(0)).alias("line_count"),
        number(word_count(F.col("shown"))).alias("word_count"),
        number(F.length(F.regexp_replace("shown", r"[\x00-\x7f]+", ""))).alias("non_ascii_count"),
        F.when(F.col("detected_format") == "json", F.col("json_size")).when(F.col("detected_format") == "xml", F.col("xml_elements"))
        .when(F.col("detected_format") == "csv", (F.size(csv_lines) - 1).cast("long")).alias("item_count"),
        F.when(~counted, "none").when(size > preview_bytes, "preview").otherwise("full").alias("analysis_scope"),
        F.coalesce(plain_content & F.col("text").rlike(r"(?i)<title\b"), F.lit(False)).alias("title_indicators"),
        F.coalesce(plain_content & F.col("text").rlike(r"(?i)charset\s*=\s*[\"']?[^\"';>\s]+"), F.lit(False)).alias("encoding_declarations"),
        F.when(F.col("detected_format").isNull(), "unknown").when(F.col("detected_format").isin(*SUITABLE), "suitable").otherwise("unsuitable").alias("extraction_suitability"),
        F.array_compact(F.array(F.when(F.col("detected_format").isNull(), "Unable to determine format"), F.when(F.col("encoding").isNull(), "Unable to determine encoding"))).alias("warnings"),
        F.array_compact(F.array(F.when(F.col("detected_format").isNull(), "unknown_format"))).alias("errors"),
    )

