"""Pages of a table in a total order through an index of ranges.

The rows are dealt by ranges of the order and written, one folder a range; the index knows how many rows stand
before each range. A page number leads to the ranges that hold it, and only these are read, so the last page costs what the first one does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import stage_path


@dataclass(frozen=True)
class PageIndex:
    """``ranges``: (range, rows before it, rows), one for each range that has rows; ``order``: the columns' names, and which descend."""

    spark: SparkSession
    path: str
    order: tuple[tuple[str, bool], ...]
    schema: object
    ranges: tuple[tuple[int, int, int], ...]

    @property
    def rows(self) -> int:
        return self.ranges[-1][1] + self.ranges[-1][2] if self.ranges else 0

    def _sorted(self) -> list[Column]:
        return [*(F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_first() for c, down in self.order), F.col("_tie").asc()]

    def ranked(self, ranges: tuple[tuple[int, int, int], ...] | None = None) -> DataFrame:
        """The rows of some ranges (all of them) with ``_place``, their place in the whole order, from 0."""
        ranges = self.ranges if ranges is None else ranges
        rows = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*[f"{self.path}/_range={r}" for r, _, _ in ranges]) if ranges \
            else self.spark.createDataFrame([], self.schema)
        before = self.spark.createDataFrame([(r, b) for r, b, _ in ranges], "_range int, _before long")     # one row a range
        within = Window.partitionBy("_range").orderBy(*self._sorted())
        return rows.join(F.broadcast(before), "_range").withColumn("_place", F.row_number().over(within) - 1 + F.col("_before")).drop("_before", "_range", "_tie")

    def slice(self, offset: int, limit: int) -> DataFrame:
        """Rows ``offset`` to ``offset + limit`` in order; reads the ranges that hold them and no others."""
        held = tuple(r for r in self.ranges if r[1] < offset + limit and r[1] + r[2] > offset)
        return self.ranked(held).filter((F.col("_place") >= offset) & (F.col("_place") < offset + limit)).orderBy("_place").drop("_place")

    def page(self, number: int, size: int) -> DataFrame:
        """Page ``number``, from 0."""
        return self.slice(number * size, size)

    def pages(self, size: int) -> Iterator[DataFrame]:
        """Page after page."""
        for number in range(-(-self.rows // size)):
            yield self.page(number, size)

    def numbered(self, size: int) -> DataFrame:
        """Every row with ``page`` and ``place`` in it: all pages at once, without a sort of the whole."""
        return self.ranked().withColumn("page", F.floor(F.col("_place") / size)).withColumn("place", (F.col("_place") % size).cast("int")).drop("_place")

    def each(self, size: int, do: Callable[[int, DataFrame], None]) -> int:
        """``do(number, rows)`` for each page; returns how many there were."""
        n = 0
        for n, rows in enumerate(self.pages(size), 1):
            do(n - 1, rows)
        return n


def page_index(df: DataFrame, order: list[tuple[str, bool]], *, ranges: int | None = None, path: str | None = None) -> PageIndex:
    """Index ``df`` by ``order``, pairs of a column and whether it descends; nulls come first where it ascends, last where it descends.
    Rows that tie are in the order of their hash; equal rows are alike, so any order of theirs is the same."""
    spark = df.sparkSession
    path = path or stage_path(spark, "pages")
    keys = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_first() for c, down in order]
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumn("_tie", F.xxhash64(*df.columns)).repartitionByRange(n, *keys, F.col("_tie")).withColumn("_range", F.spark_partition_id())
    rows.write.mode("errorifexists").partitionBy("_range").parquet(path)
    counts = spark.read.schema(rows.schema).parquet(path).groupBy("_range").agg(F.count("*").alias("n")).orderBy("_range").collect()      # at most n rows
    found, before = [], 0
    for r in counts:
        found.append((r["_range"], before, r["n"]))
        before += r["n"]
    return PageIndex(spark, path, tuple(order), rows.schema, tuple(found))
