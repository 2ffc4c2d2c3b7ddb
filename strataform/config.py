"""Configuration: defaults, then a file, then the environment, the last one that names a value wins."""

from __future__ import annotations

import json
import os
import tomllib
from collections.abc import Mapping
from pathlib import Path

#: Settings with their defaults, which give the types too.
DEFAULTS: dict[str, object] = {
    "data": "",
    "output": "",
    "checkpoint_dir": "",
    "shuffle_partitions": 200,
    "similarity_threshold": 0.85,
    "deduplication_mode": "near",
    "whole_texts": False,
    "allowed_domains": [],
}
PREFIX = "STRATAFORM_"


def _typed(name: str, value: object, example: object) -> object:
    """A value as the type of its default; text from the environment is read."""
    if isinstance(example, bool):
        if isinstance(value, str) and value.strip().lower() in ("true", "false", "1", "0", "yes", "no"):
            return value.strip().lower() in ("true", "1", "yes")
        if isinstance(value, bool):
            return value
    elif isinstance(example, list):
        parts = value.split(",") if isinstance(value, str) else value
        if isinstance(parts, list):
            return [str(p).strip() for p in parts if str(p).strip()]
    elif isinstance(example, int | float) and not isinstance(value, bool):
        try:
            return type(example)(value)
        except (TypeError, ValueError):
            pass
    elif isinstance(example, str) and isinstance(value, str):
        return value
    raise ValueError(f"{name} must be of type {type(example).__name__}")


def load(path: str | None = None, environment: Mapping[str, str] | None = None) -> dict[str, object]:
    """The settings; a file is TOML or JSON by its suffix, and unknown names are refused."""
    settings = dict(DEFAULTS)
    if path:
        text = Path(path).read_text(encoding="utf-8")
        found = tomllib.loads(text) if path.endswith(".toml") else json.loads(text)
        if unknown := sorted(set(found) - set(DEFAULTS)):
            raise ValueError(f"Unknown settings: {', '.join(unknown)}")
        settings |= {k: _typed(k, v, DEFAULTS[k]) for k, v in found.items()}
    for name, value in (os.environ if environment is None else environment).items():
        key = name.removeprefix(PREFIX).lower()
        if name.startswith(PREFIX) and key in DEFAULTS:
            settings[key] = _typed(name, value, DEFAULTS[key])
    return settings
