"""Small JSON documents kept in the shared folder: specifications, reports, schema versions.

Documents are written through the file system that Spark itself uses, so a
folder on any storage serves.  A name is written once: the file is created
without overwriting, which decides between two writers.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from strataform.plans.spec import Specification


class Ledger:
    """Documents by kind and name under a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.folder = folder.rstrip("/")

    def _at(self, *parts: str):
        path = self._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))
        return path.getFileSystem(self._conf), path

    @staticmethod
    def _file(name: str) -> str:
        # Any name makes a file name, and two names never the same one.
        return "".join(c if c.isalnum() and c.isascii() or c in "-." else f"_{ord(c):x}_" for c in name) + ".json"

    def put(self, kind: str, name: str, document: dict) -> None:
        files, path = self._at(kind, self._file(name))
        try:
            out = files.create(path, False)
        except Py4JJavaError as e:
            raise ValueError(f"{kind} {name} exists") from e
        out.write(bytearray(json.dumps({"name": name, "document": document}, sort_keys=True, ensure_ascii=False).encode()))
        out.close()

    def get(self, kind: str, name: str) -> dict | None:
        files, path = self._at(kind, self._file(name))
        return self._read(files, path)["document"] if files.exists(path) else None

    def _read(self, files, path) -> dict:
        stream = files.open(path)
        text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return json.loads(text)

    def names(self, kind: str) -> list[str]:
        files, path = self._at(kind)
        if not files.exists(path):
            return []
        return sorted(self._read(files, s.getPath())["name"] for s in files.listStatus(path) if s.getPath().getName().endswith(".json"))


class StoredSpecs:
    """Specifications by name, kept in a ledger; a name is taken once, as version 1."""

    def __init__(self, ledger: Ledger):
        self.ledger = ledger

    def create(self, document: dict, status: str = "active") -> Specification:
        spec = Specification(document)
        self.ledger.put("specifications", spec.name, {"document": document, "hash": spec.hash, "status": status})
        return spec

    def get(self, name: str) -> Specification | None:
        held = self.ledger.get("specifications", name)
        return Specification(held["document"]) if held else None

    def list(self, status: str | None = None) -> list[Specification]:
        held = [self.ledger.get("specifications", n) for n in self.ledger.names("specifications")]
        return [Specification(h["document"]) for h in held if status in (None, h["status"])]


class StoredReports:
    """Feasibility reports by identifier, kept in a ledger with the hash of their specification."""

    def __init__(self, ledger: Ledger):
        self.ledger = ledger

    def save(self, identifier: str, spec: Specification, report: dict) -> None:
        self.ledger.put("feasibility", identifier, {"specification": spec.name, "specification_hash": spec.hash, "report": report})

    def get(self, identifier: str) -> dict | None:
        return self.ledger.get("feasibility", identifier)

    def list(self, specification: str | None = None) -> list[str]:
        return [n for n in self.ledger.names("feasibility") if specification in (None, self.ledger.get("feasibility", n)["specification"])]


def migrate(ledger: Ledger, steps: list[tuple[str, Callable[[], None]]]) -> list[str]:
    """Run the steps whose versions the ledger lacks, in order; returns the versions run.

    A step is recorded when it has ended, so one that fails runs again.
    """
    done, ran = set(ledger.names("schema")), []
    for version, step in steps:
        if version not in done:
            step()
            ledger.put("schema", version, {"applied": True})
            ran.append(version)
    return ran
