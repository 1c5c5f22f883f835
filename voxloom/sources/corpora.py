"""Records of the source corpora in the target schema.

Each source has its own columns; what they say is brought into the eight columns of the schema by column expressions
alone. ``number`` (a bigint) is the row's place in its source, from which ids and names of unnamed speakers are made.
Columns that a source lacks may be missing from the frame, and other columns are passed by.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions import scalars as S

LANGUAGE = "th"  # fixed value: the language of the target schema
DEFAULT_LENGTH = 1.0  # fixed value: seconds of a stream's sample whose length is not known


def _optional(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def _given(*texts: Column) -> Column:
    """The first text that is not empty, else the empty text."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts], F.lit(""))


def numbered_speaker(number: Column, dataset: str) -> Column:
    """A stable five-digit name for a record whose speaker is not known, from its place in the source."""
    return S.hashed_speaker(number.cast("string"), dataset)


def target_record(df: DataFrame, dataset: str, speaker: Column, transcript: Column, confidence: Column, **other: Column) -> DataFrame:
    """The eight columns of the target schema; ``other`` replaces a column's usual value."""
    audio = F.col("audio") if "audio" in df.columns else F.lit(None).cast("struct<path:string,sampling_rate:int>")
    usual: Mapping[str, Column] = {
        "id": F.concat(F.lit("S"), F.col("number").cast("string")), "speaker_id": F.coalesce(speaker, numbered_speaker(F.col("number"), dataset)), "language": F.lit(LANGUAGE), "audio": audio,
        "transcript": transcript, "length": _optional(df, "length", "double"), "dataset_name": F.lit(dataset), "confidence_score": confidence,
    }
    return df.select(*[c.alias(name) for name, c in {**usual, **other}.items()])


def from_segments(df: DataFrame, side: DataFrame, dataset: str = "GigaSpeech2") -> DataFrame:
    """Records of a corpus of segments whose transcripts stand in a side table (``split``, ``segment_id``, ``transcript``).

    The segment is named by ``key``, ``own_id``, ``path`` or ``url``. The side table's transcript comes before the record's
    ``text`` and ``transcript``; a record without any has an empty one and confidence 0, else it has 1. The speaker is the second number of
    the segment's name. The join is left to the optimizer, and a repeated segment of a split counts once, with its largest text.
    """
    named = S.segment_id(*[_optional(df, c) for c in ("key", "own_id", "path", "url")])
    rows = df.withColumns({"__segment": named, "__split": F.coalesce(_optional(df, "split"), F.lit("train"))})
    side = side.groupBy(F.col("split").alias("__split"), F.col("segment_id").alias("__segment")).agg(F.max("transcript").alias("__found"))
    rows = rows.join(side, ["__split", "__segment"], "left")
    text = _given(F.col("__found"), _optional(rows, "text"), _optional(rows, "transcript"))
    return target_record(rows, dataset, S.speaker_of_segment(F.col("__segment")), text, F.when(text != "", 1.0).otherwise(0.0))


def from_sentences(df: DataFrame, dataset: str, prefix: str | None = None, client: str = "client_id") -> DataFrame:
    """Records of a corpus of read sentences (``sentence``), whose transcripts are sure.

    With ``prefix`` the speaker is a hash of the column ``client``; where that is missing or empty, or without ``prefix``, of the
    record's place.
    """
    speaker = S.hashed_speaker(F.nullif(_optional(df, client), F.lit("")), prefix) if prefix else F.lit(None).cast("string")
    return target_record(df, dataset, speaker, F.coalesce(_optional(df, "sentence"), F.lit("")), F.lit(1.0))


def stream_samples(df: DataFrame, dataset: str) -> DataFrame:
    """Records of a stream before they get their ids: ``temp_<number>``, a length of one second where it is not known, confidence 1."""
    length = F.coalesce(_optional(df, "length", "double"), F.lit(DEFAULT_LENGTH))
    known = F.nullif(_optional(df, "speaker_id"), F.lit(""))
    return target_record(df, dataset, known, F.coalesce(_optional(df, "transcript"), F.lit("")), F.lit(1.0), id=F.concat(F.lit("temp_"), F.col("number").cast("string")), length=length)


def own_speakers(df: DataFrame, identifier: str = "id", output: str = "speaker_id") -> DataFrame:
    """Every record as its own speaker, named by the number of its id; ids of another form give null."""
    number = S.id_number(F.col(identifier))
    return df.withColumn(output, F.when(number.isNotNull(), F.format_string("SPK_%05d", number)))

