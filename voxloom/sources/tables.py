"""Tables of one parquet path each, as the catalogue of this project lays them out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` in ``folder``; files and folders of part files read alike."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
