"""Driver tables: one parquet file (or folder) per table under a scale directory."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one driver table; projections and filters reach the parquet reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Tables of a folder that were opened before, by session: opening one lists files and reads a footer.
_OPENED: dict[tuple[str, str, str], DataFrame] = {}


def register_tables(spark: SparkSession, sf_dir: str, names: Iterable[str] = TABLES) -> None:
    """Expose driver tables as temp views so shared SQL views resolve; each is opened once for a session and folder."""
    for name in names:
        key = (f"{spark.sparkContext.applicationId}/{spark._jsparkSession.hashCode()}", sf_dir, name)
        if key not in _OPENED:
            _OPENED[key] = table(spark, sf_dir, name)
        _OPENED[key].createOrReplaceTempView(name)
