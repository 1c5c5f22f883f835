"""Sinks: shards that can be written again, exports, and the data set card."""

from __future__ import annotations

from collections.abc import Sequence
from html import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = ["id", "speaker_id", "language", "audio", "transcript", "length", "dataset_name", "confidence_score"]


def shard_numbers(spark: SparkSession, folder: str, split: str) -> list[int]:
    """Numbers of the shards that are committed."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{split}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    good = [n for n in names if n.startswith("shard=") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{folder}/{split}/{n}/_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in good)


def write_shard(df: DataFrame, folder: str, split: str, shard: int, key: str = "id", columns: Sequence[str] = tuple(SCHEMA)) -> None:
    """Write one shard: rows whose key no other shard has, once each.

    A shard's number is its identity: writing it again replaces what an earlier try left, so a batch that is
    tried again changes nothing. A shard counts from when its success file is there. Unknown columns are dropped.
    Of earlier shards only the keys between this one's smallest and largest are read, which the files' statistics find: with
    keys that grow from shard to shard the cost of a shard doesn't grow with their number.
    """
    spark = df.sparkSession
    rows = df.select(*[c for c in columns if c in df.columns]).where(F.col(key).isNotNull()).dropDuplicates([key])
    others = [n for n in shard_numbers(spark, folder, split) if n != shard]
    if others:
        ends = rows.agg(F.min(key), F.max(key)).first()
        done = spark.read.parquet(*[f"{folder}/{split}/shard={n:05d}" for n in others]).select(key).where(F.col(key).between(*ends))
        rows = rows.join(done, key, "left_anti")
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{split}/shard={shard:05d}")


def append_shard(df: DataFrame, folder: str, split: str, key: str = "id", columns: Sequence[str] = tuple(SCHEMA)) -> int:
    """Write the next shard and give its number."""
    number = max(shard_numbers(df.sparkSession, folder, split), default=-1) + 1
    write_shard(df, folder, split, number, key, columns)
    return number


def read_shards(spark: SparkSession, folder: str, split: str) -> DataFrame | None:
    numbers = shard_numbers(spark, folder, split)
    return spark.read.parquet(*[f"{folder}/{split}/shard={n:05d}" for n in numbers]) if numbers else None


def next_number(spark: SparkSession, folder: str, split: str, key: str = "id") -> int:
    """The number with which ids go on after all committed shards; 1 if there are none."""
    rows = read_shards(spark, folder, split)
    last = rows.agg(F.max(F.regexp_extract(key, r"^S(\d+)$", 1).try_cast("bigint"))).first()[0] if rows is not None else None
    return (last or 0) + 1


def wide_export(long: DataFrame, key: str, metric: str, value: str, names: Sequence[str], path: str) -> None:
    """Long metrics as CSV with one column for each name, in the order of the names."""
    long.groupBy(key).pivot(metric, sorted(names)).agg(F.first(value)).write.mode("overwrite").option("header", True).csv(path)


def embedding_export(df: DataFrame, path: str, key: str, vector: str, dataset: str) -> None:
    """Vectors as parquet, a folder for each data set: ``key``, ``vector`` as floats and its ``size``. Null vectors are left out."""
    rows = df.where(F.col(vector).isNotNull()).select(F.col(key), F.col(vector).cast("array<float>").alias("vector"), F.size(vector).alias("size"), F.col(dataset))
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy(dataset).parquet(path)


def json_export(df: DataFrame, path: str) -> None:
    """One JSON object for each row; nulls are left out."""
    df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")).write.mode("overwrite").text(path)


def card(totals: DataFrame, title: str) -> str:
    """A data set card from one row for each source: ``dataset``, ``n``, ``hours``."""
    rows = totals.select("dataset", "n", "hours").orderBy("dataset").collect()
    lines = [f"# {title}", "", f"- samples: {sum(r.n for r in rows)}", f"- hours: {sum(r.hours or 0 for r in rows):.2f}", ""]
    return "\n".join([*lines, *(f"{i}. {r.dataset}: {r.n} samples, {r.hours or 0:.2f} h" for i, r in enumerate(rows, 1)), ""])


MOST_LINES = 1000  # of a table in a report


def html_report(tables: dict[str, DataFrame], title: str) -> str:
    """A page with one table for each small result, ``MOST_LINES`` lines at most, which it says if there are more."""
    parts = [f"<!doctype html><meta charset=utf-8><title>{escape(title)}</title><h1>{escape(title)}</h1>"]
    for name, df in tables.items():
        rows = df.limit(MOST_LINES + 1).collect()
        cells = lambda values, tag: "<tr>" + "".join(f"<{tag}>{escape('' if v is None else str(v))}</{tag}>" for v in values) + "</tr>"
        parts.append(f"<h2>{escape(name)}</h2><table>" + cells(df.columns, "th") + "".join(cells(r, "td") for r in rows[:MOST_LINES]) + "</table>")
        if len(rows) > MOST_LINES:
            parts.append(f"<p>The first {MOST_LINES} lines.</p>")
    return "\n".join(parts) + "\n"
