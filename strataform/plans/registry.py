"""Named stages: functions from DataFrame to DataFrame, found by name or kind."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from enum import StrEnum
from importlib.metadata import entry_points

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataform.operators import characterize, dedup, extract, normalize, quality
from strataform.runtime import store
from strataform.sources import catalog, export


class ErrorCode(StrEnum):
    """What can go wrong with a stage or a payload."""

    UNKNOWN_STAGE = "unknown_stage"
    DUPLICATE_STAGE = "duplicate_stage"
    UNKNOWN_FORMAT = "unknown_format"
    UNSUPPORTED_FORMAT = "unsupported_format"
    ENCODING = "encoding_error"
    CORRUPTED = "corrupted_format"
    EMPTY = "empty_content"
    PARSER = "parser_error"
    CHECKSUM = "checksum_mismatch"
    INVALID_SPECIFICATION = "invalid_specification"


KINDS = ("fetch", "extract", "store", "normalize", "deduplicate", "export")


@dataclass(frozen=True)
class Stage:
    """A stage with what it is and can do."""

    name: str
    kind: str
    run: Callable[..., DataFrame]
    version: str = "1.0.0"
    description: str = ""
    capabilities: tuple[str, ...] = ()


class Registry:
    """Stages by name; those of installed packages come first, then the built-in ones."""

    def __init__(self, group: str = "strataform.stages", builtin: bool = True):
        self._stages: dict[str, Stage] = {}
        for point in entry_points(group=group):
            self.register(point.load())
        for stage in _builtin() if builtin else ():
            if stage.name not in self._stages:
                self.register(stage)

    def register(self, stage: Stage) -> None:
        if stage.kind not in KINDS:
            raise ValueError(f"Unknown kind of stage: {stage.kind}")
        if stage.name in self._stages:
            raise ValueError(f"{ErrorCode.DUPLICATE_STAGE}: {stage.name}")
        self._stages[stage.name] = stage

    def names(self) -> list[str]:
        return sorted(self._stages)

    def get(self, name: str) -> Stage:
        if name not in self._stages:
            raise KeyError(f"{ErrorCode.UNKNOWN_STAGE}: {name}")
        return self._stages[name]

    def of_kind(self, kind: str) -> list[Stage]:
        return [s for s in self._stages.values() if s.kind == kind]

    def able(self, capability: str) -> list[Stage]:
        """The stages that name a capability."""
        return [s for s in self._stages.values() if capability in s.capabilities]

    def pipeline(self, rows: DataFrame, *names: str) -> DataFrame:
        """The rows through the named stages, at most one of a kind, in the order of kinds."""
        stages = [self.get(n) for n in names]
        if len({s.kind for s in stages}) < len(stages):
            raise ValueError("a pipeline takes one stage of a kind")
        return self.run(rows, *[s.name for s in sorted(stages, key=lambda s: KINDS.index(s.kind))])

    def run(self, rows: DataFrame, *names: str) -> DataFrame:
        """The rows through the named stages in order."""
        for name in names:
            rows = rows.transform(self.get(name).run)
        return rows


def _materialized(artifacts: DataFrame) -> DataFrame:
    """Artifacts whose payload is there and whole."""
    return artifacts.join(catalog.materialize(artifacts).where("status = 'completed'").select("artifact_id"), "artifact_id", "left_semi")


def _extracted(artifacts: DataFrame) -> DataFrame:
    """The text of each artifact as a document."""
    found = extract.extract(artifacts, characterize.characterize(artifacts))
    return found.select(F.col("artifact_id").alias("doc_id"), F.col("canonical_text").alias("text"), "extraction_status")


def _kept(documents: DataFrame) -> DataFrame:
    """Documents written to the shared folder."""
    return store(documents, "documents").df


def _builtin() -> list[Stage]:
    return [
        Stage("payload_reader", "fetch", _materialized, description="payloads that are there and whole", capabilities=("checksum",)),
        Stage("format_extractor", "extract", _extracted, description="text of payloads of six formats", capabilities=("html", "json", "xml", "csv", "markdown", "plain_text")),
        Stage("shared_store", "store", _kept, description="a table in the shared folder", capabilities=("parquet",)),
        Stage("standard_normalizer", "normalize", normalize.normalize, description="composition, line ends, blanks, control characters", capabilities=("text",)),
        Stage("text_metrics", "extract", quality.text_metrics, description="counts of characters, words and lines", capabilities=("metrics",)),
        Stage("trigram_jaccard", "deduplicate", dedup.similar_classes, description="groups of texts with similar trigram sets", capabilities=("near_duplicate",)),
        Stage("jsonl_lines", "export", export.json_lines, description="one JSON object a row", capabilities=("jsonl",)),
    ]
