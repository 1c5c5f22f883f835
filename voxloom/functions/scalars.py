"""Scalar functions on strings, numbers and hashes, as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the pipeline writes where there is no transcript.
MARKERS = ("[INAUDIBLE]", "[STT_ERROR]", "[NO_AUDIO]", "[NO_TRANSCRIPT]")
# Kinds of error in the order in which they are tried; a word of every list must stand in the message.
ERROR_WORDS = [
    ("network_error", [["connection", "network", "timeout", "unreachable"]]),
    ("memory_error", [["memory", "allocation", "out of memory"]]),
    ("unsupported_format", [["unsupported", "unknown", "invalid"], ["format", "codec"]]),
    ("encoding_error", [["format", "codec", "encoding", "decode", "decoding", "parsing"]]),
    ("corrupted_audio", [["corrupt", "invalid", "damaged", "truncated"]]),
    ("metadata_error", [["metadata", "tag", "header"]]),
]


def segment_id(key: Column, own: Column, path: Column, url: Column) -> Column:
    """The first that is not empty: last part of the key, own id, file name without its extension, file name of the URL up to a dot."""
    last = lambda c: F.element_at(F.split(c, "/"), -1)
    stem = F.regexp_replace(last(path), r"(?<=.)\.[^.]*$", "")
    named = [last(key), own, stem, F.element_at(F.split(last(url), r"\."), 1)]
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in named])


def speaker_of_segment(segment: Column) -> Column:
    """``SPK_`` and the second number of a segment id like 0-685-9, null if it has none."""
    number = F.try_element_at(F.split(segment, "-"), F.lit(2)).try_cast("int")
    return F.when(number.isNotNull(), F.format_string("SPK_%05d", number))


def hashed_speaker(value: Column, prefix: str) -> Column:
    """A stable five-digit speaker name from any string; null for null."""
    digest = F.substring(F.md5(F.concat(F.lit(f"{prefix}_"), value)), 1, 8)
    return F.when(value.isNotNull(), F.format_string("SPK_%05d", F.conv(digest, 16, 10).cast("bigint") % 100000))


def id_number(identifier: Column) -> Column:
    """The number of an id like S12, null for other forms."""
    return F.regexp_extract(identifier, r"^S(\d+)$", 1).try_cast("bigint")


def default_confidence(transcript: Column) -> Column:
    return F.when(F.trim(F.coalesce(transcript, F.lit(""))) != "", 1.0).otherwise(0.0)


def plain_name(name: Column) -> Column:
    """A name without the differences of case, blanks, hyphens and underscores; null if nothing is left."""
    return F.nullif(F.lower(F.regexp_replace(name, r"[\s_-]+", "")), F.lit(""))


def error_kind(message: Column) -> Column:
    """The first kind of error whose words stand in the message, else ``unknown_error``."""
    low = F.lower(F.coalesce(message, F.lit("")))
    out = F.when(F.lit(False), "")
    for kind, lists in ERROR_WORDS:
        hit = F.lit(True)
        for words in lists:
            hit = hit & low.rlike("|".join(words))
        out = out.when(hit, kind)
    return out.otherwise("unknown_error")


def retry_delay(base: Column, attempt: Column, strategy: Column) -> Column:
    """Seconds before the next attempt: linear, exponential or escalating."""
    return F.when(strategy == "linear", base * (attempt + 1)).when(strategy == "exponential", base * F.pow(F.lit(2.0), attempt)).otherwise(base / 2)


def hours_minutes(seconds: Column) -> Column:
    s = F.floor(seconds).cast("bigint")
    return F.when(s >= 3600, F.format_string("%dh %dm", F.floor(s / 3600), F.floor(s % 3600 / 60))).otherwise(F.format_string("%dm", F.floor(s / 60)))


def clipped(x: Column, low: float, high: float) -> Column:
    """``x`` between the bounds; null stays null."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(float(low))), F.lit(float(high))))


def ladder(x: Column, steps: Sequence[tuple[float, str]], otherwise: str, inclusive: bool = True) -> Column:
    """The name of the first step that ``x`` reaches, from the highest; null ``x`` gives null."""
    out = F.when(x.isNull(), F.lit(None).cast("string"))
    for least, name in steps:
        out = out.when((x >= least) if inclusive else (x > least), name)
    return out.otherwise(otherwise)
