"""Dataset specifications: validation, identity and compilation to column expressions."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataform.operators.language import NAMES
from strataform.operators.quality import quality_score

# The vocabulary of specifications.
FORMATS = ("html", "json", "xml", "csv", "markdown", "plain_text", "text")
OUTPUTS = ("jsonl", "csv", "parquet")
MODES = ("exact", "normalized", "near", "none")


def _whole(value: object) -> bool:
    return isinstance(value, int)


def _number(value: object) -> bool:
    return isinstance(value, int | float)


def errors(spec: dict) -> list[str]:
    """Every fault of a specification; a valid one has none."""
    out: list[str] = []

    def need(ok: bool, message: str) -> None:
        if not ok:
            out.append(message)

    section = lambda name: spec.get(name) or {}
    if spec.get("dataset") is None:
        out.append("Missing 'dataset' section")
    else:
        name, version = spec["dataset"].get("name"), spec["dataset"].get("version")
        need(isinstance(name, str) and bool(name.strip()), "dataset.name must be a non-empty string")
        need(_whole(version) and version > 0, "dataset.version must be a positive integer")
    formats = section("source").get("allowed_formats")
    if formats is not None and not isinstance(formats, list):
        out.append("source.allowed_formats must be a list")
    for fmt in formats if isinstance(formats, list) else []:
        need(fmt in FORMATS, f"Unsupported format: {fmt}. Supported: {', '.join(FORMATS)}")
    low, high = section("content").get("minimum_characters"), section("content").get("maximum_characters")
    need(low is None or _whole(low) and low >= 0, "content.minimum_characters must be >= 0")
    need(high is None or _whole(high) and high > 0, "content.maximum_characters must be > 0")
    if _whole(low) and _whole(high):
        need(low < high, "content.minimum_characters must be less than maximum_characters")
    for part, key, kind in (("quality", "minimum_score", "quality.minimum_score"), ("deduplication", "similarity_threshold", "deduplication.similarity_threshold")):
        value = section(part).get(key)
        if part == "deduplication":
            mode = section(part).get("mode")
            need(mode is None or mode in MODES, f"Unsupported deduplication mode: {mode}. Supported: {', '.join(MODES)}")
        if value is not None and not _number(value):
            out.append(f"{kind} must be a number")
        elif value is not None:
            need(0 <= value <= 1, f"{kind} must be between 0.0 and 1.0")
    most = section("selection").get("maximum_records")
    need(most is None or _whole(most) and most > 0, "selection.maximum_records must be a positive integer")
    output = section("output").get("format")
    need(output is None or output in OUTPUTS, f"Unsupported output format: {output}. Supported: {', '.join(OUTPUTS)}")
    return out


def spec_hash(spec: dict) -> str:
    """A hash of the canonical form, the same for any order of keys."""
    return hashlib.sha256(json.dumps(spec, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


@dataclass
class Specification:
    """A valid specification with its identity."""

    document: dict
    hash: str = field(init=False)

    def __post_init__(self) -> None:
        if found := errors(self.document):
            raise ValueError("; ".join(found))
        self.hash = spec_hash(self.document)

    def get(self, section: str, key: str, default: object = None) -> object:
        value = (self.document.get(section) or {}).get(key)
        return default if value is None else value

    @property
    def name(self) -> str:
        return self.document["dataset"]["name"]


class SpecStore:
    """Specifications by name; a name is taken once, as version 1."""

    def __init__(self) -> None:
        self._held: dict[str, tuple[Specification, str]] = {}

    def create(self, document: dict, status: str = "active") -> Specification:
        spec = Specification(document)
        if spec.name in self._held:
            raise ValueError(f"Specification {spec.name} version 1 exists")
        self._held[spec.name] = (spec, status)
        return spec

    def get(self, name: str) -> Specification | None:
        held = self._held.get(name)
        return held[0] if held else None

    def list(self, status: str | None = None) -> list[Specification]:
        return [s for s, at in self._held.values() if status in (None, at)]


# Columns of a corpus row that the rules read: detected_format, source_mime_type,
# language, normalized_text and character_count (of the canonical text).


def format_rule(spec: Specification) -> Column:
    """Whether an allowed format is part of the detected format or the declared type."""
    allowed = [f.lower() for f in spec.get("source", "allowed_formats", [])]
    if not allowed:
        return F.lit(True)
    fmt, mime = (F.lower(F.coalesce(F.col(c), F.lit(""))) for c in ("detected_format", "source_mime_type"))
    return F.exists(F.array(*map(F.lit, allowed)), lambda a: fmt.contains(a) | mime.contains(a))


def language_rule(spec: Specification) -> Column:
    """Whether the language is allowed, by name or code; a missing one never is."""
    allowed = {str(x).lower() for x in spec.get("source", "allowed_languages", [])}
    if not allowed:
        return F.lit(True)
    both = allowed | {c for c, n in NAMES.items() if n.lower() in allowed} | {n.lower() for c, n in NAMES.items() if c in allowed}
    return F.coalesce(F.lower("language").isin(sorted(both)), F.lit(False))


def length_of() -> Column:
    return F.length(F.coalesce("normalized_text", F.lit("")))


def too_short(spec: Specification) -> Column:
    low = spec.get("content", "minimum_characters")
    return F.lit(False) if low is None else length_of() < low


def too_long(spec: Specification) -> Column:
    high = spec.get("content", "maximum_characters")
    return F.lit(False) if high is None else length_of() > high


def score() -> Column:
    return quality_score(F.col("character_count"))


def below_score(spec: Specification) -> Column:
    least = spec.get("quality", "minimum_score")
    return F.lit(False) if least is None else score() < float(least)
