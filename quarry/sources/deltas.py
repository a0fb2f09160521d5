"""Tables of parts with counts, and reports from the difference of two versions.

Every part of a table is a folder that never changes, with a small table of its counts by the report's columns beside it. A
version is a manifest that lists parts: appending adds one, removing rows writes the parts that hold some of them anew. A report
adds up counts, not rows; the report of a version follows from that of an earlier one by the parts that came and went.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources.snapshots import DIGITS, Snapshots


class CountedTable:
    """``by``: the columns that reports count by; ``schema``: the table's."""

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, by: list[str]):
        self.spark, self.base, self.schema, self.by = spark, base.rstrip("/"), schema, list(by)
        self.log = Snapshots(spark, base)
        self._counts = T.StructType([*[schema[c] for c in by], T.StructField("n", T.LongType())])

    def versions(self) -> list[int]:
        return self.log.versions()

    def parts(self, version: int | None = None) -> list[str]:
        """Names of a version's parts (the newest one's)."""
        found = self.log.manifest(version)
        return found["parts"] if found else []

    def _commit(self, parts: list[str]) -> int:
        number = (self.versions() or [0])[-1] + 1
        if not self.log._create(f"{self.log._log}/{number:0{DIGITS}d}.json", json.dumps({"version": number, "parts": parts})):
            raise RuntimeError(f"version {number} was committed by another writer; read it and try again")
        return number

    def _write(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex[:16]
        rows.select(*self.schema.names).write.parquet(f"{self.base}/rows/{name}")
        self._rows([name]).groupBy(*self.by).agg(F.count("*").alias("n")).write.parquet(f"{self.base}/counts/{name}")
        return name

    def _rows(self, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.base}/rows/{p}" for p in parts])

    def append(self, rows: DataFrame) -> int:
        """A new version with these rows, too."""
        return self._commit([*self.parts(), self._write(rows)])

    def remove(self, keys: DataFrame, key: str) -> int:
        """A new version without the rows whose ``key`` is among ``keys``; parts without such rows stay as they are."""
        parts, gone = self.parts(), keys.select(key).distinct()
        tagged = reduce(DataFrame.unionByName, [self._rows([p]).select(key, F.lit(p).alias("_part")) for p in parts]) if parts else None
        touched = {r["_part"] for r in tagged.join(gone, key, "left_semi").select("_part").distinct().collect()} if parts else set()      # names of parts
        return self._commit([self._write(self._rows([p]).join(gone, key, "left_anti")) if p in touched else p for p in parts])

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.parts(version))

    def _sum(self, parts: list[str], sign: int = 1) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self._counts)
        return self.spark.read.schema(self._counts).parquet(*[f"{self.base}/counts/{p}" for p in parts]).withColumn("n", F.col("n") * sign)

    def report(self, version: int | None = None) -> DataFrame:
        """(by..., n) from the counts of a version's parts."""
        return self._total(self._sum(self.parts(version)))

    def _total(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.by).agg(F.sum("n").alias("n")).filter("n <> 0")

    def change(self, before: int | None, after: int | None = None) -> DataFrame:
        """(by..., n): by how much the counts of ``after`` (the newest version) differ from those of ``before`` (None: an empty table)."""
        old, new = set(self.parts(before) if before else []), set(self.parts(after))
        return self._total(self._sum(sorted(new - old)).unionByName(self._sum(sorted(old - new), -1)))

    def updated(self, report: DataFrame, before: int, after: int | None = None) -> DataFrame:
        """The report of ``after`` from that of ``before``: only parts that came or went are looked at."""
        return self._total(report.select(*self.by, "n").unionByName(self.change(before, after)))
