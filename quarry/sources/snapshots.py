"""Versioned snapshots of named tables with a manifest that commits them.

A snapshot's tables are written to folders of their own; then one manifest file that names them is moved into place. Only that move commits:
readers list manifests, so a snapshot whose writer stopped half-way is never seen, and a committed one is never changed. Of
two writers of one number the move lets one win; the other tries the next number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: A manifest's name holds its number in so many digits, so that names sort by number.
DIGITS = 12


class Snapshots:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self._log = f"{self.base}/manifests"

    # -- files of the shared store, through Spark's own file system
    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.base).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _read(self, path: str) -> str:
        return "\n".join(r.value for r in self.spark.read.option("wholetext", True).text(path).collect())

    def _create(self, path: str, text: str) -> bool:
        """Write a file under a name of its own and move it to ``path``; False where ``path`` is taken."""
        fs, own = self._fs(), self._path(f"{self._log}/.{uuid.uuid4().hex}")
        out = fs.create(own, False)
        out.write(bytearray(text.encode()))
        out.close()
        hadoop, gateway = self.spark._jvm.org.apache.hadoop.fs, self.spark.sparkContext._gateway
        keep = gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
        keep[0] = getattr(hadoop, "Options$Rename").NONE                    # a move that fails where the target is there
        try:
            hadoop.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration()).rename(own, self._path(path), keep)
        except Py4JJavaError:
            if not fs.exists(self._path(path)):
                raise
            fs.delete(own, False)
            return False
        return True

    def _names(self) -> list[str]:
        fs, log = self._fs(), self._path(self._log)
        return sorted(s.getPath().getName() for s in fs.listStatus(log)) if fs.exists(log) else []

    # -- snapshots
    def versions(self) -> list[int]:
        """Numbers of the committed snapshots."""
        return [int(n[:-5]) for n in self._names() if n.endswith(".json") and n[:-5].isdigit()]

    def manifest(self, version: int | str | None = None) -> dict | None:
        """The manifest of a number, of a tag, or the newest one; None where there is none."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        if isinstance(version, str):
            if f"tag-{version}" not in self._names():
                return None
            version = int(self._read(f"{self._log}/tag-{version}"))
        if version not in self.versions():
            return None
        return json.loads(self._read(f"{self._log}/{version:0{DIGITS}d}.json"))

    def commit(self, tables: Mapping[str, DataFrame], *, kind: str = "run", parent: int | None = None) -> int:
        """Write the tables, then commit them together; returns the snapshot's number."""
        folder = f"{self.base}/data/{uuid.uuid4().hex}"
        entry = {"kind": kind, "parent": parent, "tables": {}}
        for name, df in tables.items():
            path = f"{folder}/{name}"
            df.write.mode("errorifexists").parquet(path)
            entry["tables"][name] = {"path": path, "schema": df.schema.json(), "rows": self.spark.read.schema(df.schema).parquet(path).count()}
        number = (self.versions() or [0])[-1]
        while True:
            number += 1
            if self._create(f"{self._log}/{number:0{DIGITS}d}.json", json.dumps(entry | {"version": number})):
                return number

    def read(self, table: str, version: int | str | None = None) -> DataFrame | None:
        """A table of a snapshot (the newest one); None where there is no such snapshot or table."""
        from pyspark.sql.types import StructType

        found = self.manifest(version)
        if found is None or table not in found["tables"]:
            return None
        entry = found["tables"][table]
        return self.spark.read.schema(StructType.fromJson(json.loads(entry["schema"]))).parquet(entry["path"])

    def backup(self, name: str, version: int | None = None) -> int:
        """K5: keep a snapshot (the newest) under a name. A committed snapshot never changes, so nothing is copied."""
        found = self.manifest(version)
        if found is None:
            raise FileNotFoundError(f"no snapshot in {self.base}")
        if not self._create(f"{self._log}/tag-{name}", str(found["version"])):
            raise FileExistsError(f"{name} is taken")
        return found["version"]

    def change(self, table: str, how: Callable[[DataFrame], DataFrame], *, kind: str = "change") -> int:
        """A new snapshot in which one table is ``how`` of what the newest one has; the others are taken over as they are."""
        found = self.manifest()
        if found is None:
            raise FileNotFoundError(f"no snapshot in {self.base}")
        tables = {name: self.read(name, found["version"]) for name in found["tables"]}
        return self.commit(tables | {table: how(tables[table])}, kind=kind, parent=found["version"])


def load_prior(snapshots: Snapshots) -> tuple[DataFrame | None, DataFrame | None]:
    """(succeeded, failed) of the newest committed run, None each where there is no run."""
    return snapshots.read("succeeded"), snapshots.read("failed")


def drop_invalid_cached(snapshots: Snapshots, valid: DataFrame, *, table: str = "succeeded", key: str = "repo_url") -> int:
    """a new snapshot without the cached repositories that are not among ``valid`` (a table with ``key``); a backup of the
    one before is kept as ``before-<number>``."""
    before = snapshots.manifest()
    if before is None:
        raise FileNotFoundError("no snapshot to clean")
    tag = f"before-{before['version'] + 1}"
    if snapshots.manifest(tag) is None:
        snapshots.backup(tag, before["version"])
    keep = valid.select(key).distinct()
    return snapshots.change(table, lambda rows: rows.join(keep, key, "left_semi"), kind="drop-invalid")
