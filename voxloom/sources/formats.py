"""Sources in other formats: side tables, archives, audio files, JSON and CSV."""

from __future__ import annotations

import io
import re
import tarfile
import wave
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Reader = Callable[[SparkSession], DataFrame]


class Sources:
    """Readers by name, in the order in which they were added."""

    def __init__(self) -> None:
        self._readers: dict[str, Reader] = {}

    def add(self, name: str, reader: Reader) -> None:
        self._readers[name] = reader

    def names(self) -> list[str]:
        return list(self._readers)

    def read(self, spark: SparkSession, names: Sequence[str] | None = None) -> DataFrame:
        """All named sources (all if none are named) in one frame, with ``source`` and ``source_ord``."""
        chosen = list(names or self._readers)
        if unknown := [n for n in chosen if n not in self._readers]:
            raise KeyError(f"unknown sources: {unknown}")
        parts = [self._readers[n](spark).withColumns({"source": F.lit(n), "source_ord": F.lit(i)}) for i, n in enumerate(chosen)]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def side_table(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``segment_id`` and ``transcript`` of tab-separated files, trimmed; of a repeated segment the last line of the last file wins.

    Lines with fewer than two fields are left out. Files are ranked by their order in ``paths``.
    """
    lines = [spark.read.text(p).select(F.split("value", "\t").alias("f"), F.lit(i).alias("file"), F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("line")) for i, p in enumerate(paths)]
    rows = reduce(DataFrame.unionByName, lines).where(F.size("f") >= 2)
    rows = rows.select(F.trim(F.col("f")[0]).alias("segment_id"), F.trim(F.col("f")[1]).alias("transcript"), "file", "path", "line").where("segment_id <> ''")
    return rows.groupBy("segment_id").agg(F.max_by("transcript", F.struct("file", "path", "line")).alias("transcript"))


def looked_up(df: DataFrame, key: str, own: Sequence[str], side: DataFrame) -> DataFrame:
    """Add the transcript of the side table, or else the first own column that has one.

    The join is left to the optimizer: a small side table is broadcast, a large one shuffled.
    """
    rows = df.join(side.select(F.col("segment_id").alias(key), F.col("transcript").alias("__found")), key, "left")
    given = [F.nullif(F.trim(F.col(c)), F.lit("")) for c in ("__found", *own)]
    return rows.withColumn("transcript", F.coalesce(*given)).drop("__found")


def archive_members(spark: SparkSession, pattern: str, wanted: str = r".*") -> DataFrame:
    """Files in tar archives that match ``pattern`` (a glob, so partitions by folder are pruned): ``archive``, ``member``, ``content``.

    Archives are read a task each, as streams, so their size is not limited; members that do not match are skipped. An archive that is
    damaged gives what comes before the damage, and a row with a null member.
    """
    form = re.compile(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    with _opened(path) as file, tarfile.open(fileobj=file, mode="r|*") as tar:
                        for member in tar:
                            if member.isfile() and form.fullmatch(member.name):
                                yield _member(path, member.name, tar.extractfile(member).read())
                except (tarfile.TarError, EOFError, OSError):
                    yield _member(path, None, None)

    files = spark.read.format("binaryFile").load(pattern).select("path")
    return files.repartition("path").mapInArrow(run, "archive string, member string, content binary")


def _opened(path: str):
    """A file of any file system that Arrow knows, for reading in order."""
    system, inner = fs.FileSystem.from_uri(path if "://" in path else re.sub("^file:", "file://", path))
    return system.open_input_file(inner)


def _member(archive: str, name: str | None, content: bytes | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"archive": pa.array([archive], pa.string()), "member": pa.array([name], pa.string()), "content": pa.array([content], pa.binary())})


def decode_wav(content: bytes) -> tuple[int, np.ndarray] | None:
    """Rate and mono samples in -1..1 of PCM wave data, null for anything else."""
    try:
        with wave.open(io.BytesIO(content)) as w:
            width, channels, rate = w.getsampwidth(), w.getnchannels(), w.getframerate()
            raw = w.readframes(w.getnframes())
    except (wave.Error, EOFError):
        return None
    return (rate, pcm_samples(raw, width, channels)) if width in (1, 2, 3, 4) else None


def pcm_samples(raw: bytes, width: int, channels: int) -> np.ndarray:
    """Mono samples in -1..1 of whole PCM frames, ``width`` bytes a sample."""
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float64) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) << 8 >> 8) / float(1 << 23)
    else:
        x = np.frombuffer(raw, f"<i{width}").astype(np.float64) / float(1 << (8 * width - 1))
    return x.reshape(-1, channels).mean(1) if channels > 1 else x


def encode_wav(x: np.ndarray, rate: int) -> bytes:
    """Mono samples in -1..1 as wave data of 16 bits."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.clip(np.round(np.asarray(x, float) * 32767), -32768, 32767).astype("<i2").tobytes())
    return out.getvalue()


def with_bytes(df: DataFrame, array: str, rate: str, content: str = "bytes") -> DataFrame:
    """Add ``content``: the bytes that are there, or else the samples of ``array`` as wave data; null without either or without a rate."""
    has = content in df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(content).to_pylist() if has else [None] * batch.num_rows
            rows = zip(given, batch.column(array), batch.column(rate).to_pylist(), strict=True)
            out = [b if b else encode_wav(x.values.to_numpy(zero_copy_only=False), r) if x.is_valid and len(x.values) and r and r > 0 else None for b, x, r in rows]
            kept = [n for n in batch.schema.names if n != content]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(out, pa.binary())], [*kept, content])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != content)
    return df.mapInArrow(run, f"{fields}, `{content}` binary")


def head_of(df: DataFrame, n: int, condition: Column | None = None) -> DataFrame:
    """Some ``n`` rows, of those that meet the condition: the scan ends when it has them."""
    return (df if condition is None else df.where(condition)).limit(n)


def results(spark: SparkSession, path: str) -> DataFrame:
    """Results that were written as JSON lines or as CSV with a header, by the path's ending."""
    if path.rstrip("/").endswith(".csv"):
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.read.json(path)


def wav_layout(head: bytes, size: int) -> tuple[int, int, int, int, int] | None:
    """Rate, channels, bytes a sample, and begin and length of the samples of PCM wave data that begins with ``head``; null for anything else."""
    if head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        return None
    at, form = 12, None
    while at + 8 <= len(head):
        name, length = head[at : at + 4], int.from_bytes(head[at + 4 : at + 8], "little")
        if name == b"fmt " and at + 24 <= len(head):
            kind, channels, rate = (int.from_bytes(head[at + i : at + j], "little") for i, j in ((8, 10), (10, 12), (12, 16)))
            form = (rate, channels, int.from_bytes(head[at + 22 : at + 24], "little") // 8) if kind in (1, 0xFFFE) else None
        if name == b"data":
            return (*form, at + 8, min(length, size - at - 8)) if form and form[0] and form[1] and form[2] in (1, 2, 3, 4) else None
        at += 8 + length + length % 2
    return None


def audio_chunks(spark: SparkSession, pattern: str, seconds: float = 30.0) -> DataFrame:
    """Wave files in chunks: ``path``, ``chunk`` from 0, ``start_time``, ``audio`` (``array`` of mono samples, ``sampling_rate``).

    Only the heads of files are read to lay the chunks out; a chunk's bytes are read where it is decoded, so a file of any
    length is shared out over tasks and nothing is read that isn't used. Files that are not PCM wave data, or hold no sample, give no chunk.
    """

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with _opened(path) as file:
                    layout = wav_layout(file.read(1 << 16), size)
                if layout:
                    rate, channels, width, begin, length = layout
                    frame = channels * width
                    step = max(1, int(seconds * rate)) * frame
                    rows += [(path, k, k * step / frame / rate, begin + k * step, min(step, length - k * step) // frame * frame, rate, channels, width) for k in range(-(-(length // frame * frame) // step))]
            names = ["path", "chunk", "start_time", "begin", "size", "rate", "channels", "width"]
            kinds = [pa.string(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("array", pa.list_(pa.float32())), ("sampling_rate", pa.int32())])
        for batch in batches:
            for r in batch.to_pylist():
                with _opened(r["path"]) as file:
                    file.seek(r["begin"])
                    x = pcm_samples(file.read(r["size"]), r["width"], r["channels"])
                audio = pa.array([{"array": x.astype(np.float32), "sampling_rate": r["rate"]}], kind)
                yield pa.RecordBatch.from_arrays([pa.array([r["path"]]), pa.array([r["chunk"]], pa.int32()), pa.array([r["start_time"]]), audio], ["path", "chunk", "start_time", "audio"])

    files = spark.read.format("binaryFile").load(pattern).select("path", "length")
    laid = files.mapInArrow(lay, "path string, chunk int, start_time double, begin bigint, size bigint, rate int, channels int, width int").repartition("path", "chunk")
    return laid.mapInArrow(decode, "path string, chunk int, start_time double, audio struct<array:array<float>,sampling_rate:int>")


def with_audio(df: DataFrame, content: str) -> DataFrame:
    """Add ``audio`` (``array``, ``sampling_rate``) decoded from wave data in ``content``; null if it is not PCM wave data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("array", pa.list_(pa.float32())), ("sampling_rate", pa.int32())])
        for batch in batches:
            out = [d and {"array": d[1].astype(np.float32), "sampling_rate": d[0]} for c in batch.column(content).to_pylist() for d in [decode_wav(c) if c else None]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], [*batch.schema.names, "audio"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, audio struct<array:array<float>,sampling_rate:int>")


def available_splits(spark: SparkSession, folder: str, known: Sequence[str] = ("train", "validation", "test")) -> list[str]:
    """Splits that have a folder with files in it, in the order given; ``train`` alone if none has."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = [s for s in known if fs.exists(new(f"{folder}/{s}")) and fs.listStatus(new(f"{folder}/{s}"))]
    return found or ["train"]


def estimated_size(df: DataFrame, bytes_of: str, seconds: str, total: int, n: int = 1000, seed: int = 1) -> dict[str, float]:
    """Bytes and hours of a whole source of ``total`` rows, from a random sample of about ``n`` of them."""
    share = min(1.0, n / max(total, 1))
    rows = df if share == 1.0 else df.sample(share, seed)
    r = rows.agg(F.avg(F.length(bytes_of)).alias("b"), F.avg(seconds).alias("s")).first()
    return {"bytes": (r.b or 0.0) * total, "hours": (r.s or 0.0) * total / 3600}


def settings(defaults: Mapping[str, object], own: Mapping[str, object], environment: Mapping[str, str], prefix: str) -> dict[str, object]:
    """Settings by default, overridden by own values and then by ``PREFIX_NAME`` in the environment, each of its default's type.

    Unknown names and values of another type are refused.
    """
    out = dict(defaults)
    for name, value in {**own, **{k[len(prefix) + 1 :].lower(): v for k, v in environment.items() if k.startswith(f"{prefix}_")}}.items():
        if name not in defaults:
            raise KeyError(f"unknown setting {name}")
        kind = type(defaults[name])
        if isinstance(value, str) and kind is bool:
            value = value.lower() in ("1", "true", "yes")
        if kind is not type(None):
            try:
                value = kind(value)
            except (TypeError, ValueError) as e:
                raise ValueError(f"setting {name} must be {kind.__name__}") from e
        out[name] = value
    return out
