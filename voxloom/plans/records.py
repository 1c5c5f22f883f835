"""Queries on the samples as records: validation, identity, duplicates, splits, totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions import scalars as S
from voxloom.operators import records as R
from voxloom.plans.registry import Registry
from voxloom.sources import corpora, table

RECORDS = Registry()
#: The order in which sources are read.
SOURCES = ("gigaspeech2", "processedvoiceth", "mozillacommonvoice")
PLAIN = "nullif(lower(regexp_replace(dataset_name, '[\\s_-]+', '', 'g')), '')"


def _samples(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "samples")


def _hour() -> Column:
    """A bucket of records in the order of time and id: the hour, or for records without a time the first digits of the id."""
    return F.struct(F.date_trunc("hour", "recorded_at").alias("hour"), F.when(F.col("recorded_at").isNull(), F.substring("id", 1, 7)).alias("prefix"))


def _once(spark: SparkSession, folder: str) -> DataFrame:
    """Each sample once, as first ingested."""
    return R.first_of_each(_samples(spark, folder), ["id"], ["ingested_at"])


ONCE = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at) AS rn FROM samples) WHERE rn = 1"

_RULES = """
SELECT id, ingested_at, unnest(list_filter([
  CASE WHEN id IS NULL THEN 'id:missing' WHEN NOT regexp_matches(id, '^(S\\d+|temp_\\d+)$') THEN 'id:form' END,
  CASE WHEN speaker_id IS NULL THEN 'speaker_id:missing' WHEN NOT regexp_matches(speaker_id, '^SPK_\\d{5}$') THEN 'speaker_id:form' END,
  CASE WHEN language IS NULL THEN 'language:missing' WHEN language <> 'th' THEN 'language:value' END,
  CASE WHEN audio IS NULL THEN 'audio:missing' END,
  CASE WHEN transcript IS NULL THEN 'transcript:missing' WHEN length(transcript) > 10000 THEN 'transcript:long' END,
  CASE WHEN length IS NULL THEN 'length:missing' WHEN length < 0.01::FLOAT OR length > 3600 OR isnan(length) THEN 'length:range' END,
  CASE WHEN dataset_name IS NULL THEN 'dataset_name:missing' END,
  CASE WHEN confidence_score IS NULL THEN 'confidence_score:missing' WHEN confidence_score < 0 OR confidence_score > 1 OR isnan(confidence_score) THEN 'confidence_score:range' END,
  CASE WHEN transcript = '' THEN 'transcript:short' END,
  CASE WHEN dataset_name = '' THEN 'dataset_name:short' END], lambda x: x IS NOT NULL)) AS error
FROM samples
"""


@RECORDS.query("validation_errors", f"SELECT error, count(*) AS n FROM ({_RULES}) GROUP BY error")
def validation_errors(spark: SparkSession, folder: str) -> DataFrame:
    """How many records break each rule of the target schema."""
    return _samples(spark, folder).select(F.explode(R.validation_errors()).alias("error")).groupBy("error").agg(F.count("*").alias("n"))


@RECORDS.query("validation_passed", f"SELECT s.id, s.ingested_at FROM samples s ANTI JOIN ({_RULES}) e ON s.id = e.id AND s.ingested_at = e.ingested_at")
def validation_passed(spark: SparkSession, folder: str) -> DataFrame:
    """Records that break no rule."""
    return _samples(spark, folder).where(F.size(R.validation_errors()) == 0).select("id", "ingested_at")


@RECORDS.query("quarantine", f"SELECT id, ingested_at, string_agg(error, '|' ORDER BY error) AS errors FROM ({_RULES}) GROUP BY id, ingested_at")
def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Records that break rules, with the rules."""
    rows = _samples(spark, folder).select("id", "ingested_at", R.validation_errors().alias("e")).where(F.size("e") > 0)
    rows = rows.groupBy("id", "ingested_at").agg(F.flatten(F.collect_list("e")).alias("e"))
    return rows.select("id", "ingested_at", F.array_join(F.array_sort("e"), "|").alias("errors"))


@RECORDS.query("segment_ids", r"""
SELECT id, ingested_at, CASE CAST(substr(id, 2) AS BIGINT) % 4 WHEN 0 THEN '0-1-' || id WHEN 1 THEN 'own-' || id WHEN 2 THEN regexp_replace(list_extract(string_split(audio.path, '/'), -1), '(.)\.[^.]*$', '\1') ELSE 'part' || id END AS segment_id FROM samples""")
def segment_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The segment id of each sample by the order of precedence: a key, an own id, a path or an address, each of which only some have."""
    turn = F.substring("id", 2, 20).cast("bigint") % 4
    key = F.when(turn == 0, F.concat(F.lit("a/b/0-1-"), F.col("id")))
    own = F.when(turn <= 1, F.concat(F.lit("own-"), F.col("id")))
    path = F.when(turn == 2, F.col("audio.path"))
    url = F.when(turn >= 2, F.concat(F.lit("http://host/part"), F.col("id"), F.lit(".tar.gz")))
    named = S.segment_id(key, own, path, url)
    return _samples(spark, folder).select("id", "ingested_at", F.when((turn == 2) & F.col("audio.path").isNull(), F.lit(None)).otherwise(named).alias("segment_id"))


_HASH = "'SPK_' || lpad(CAST(CAST('0x' || substr(md5({}), 1, 8) AS BIGINT) % 100000 AS VARCHAR), 5, '0')"
_NUMBER = "CAST(substr(id, 2) AS BIGINT)"
_COLUMNS = ["id", "speaker_id", "language", "transcript", "length", "dataset_name", "confidence_score"]


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    """Samples, once each, in the columns in which corpora deliver them."""
    number = F.substring("id", 2, 20).cast("bigint")
    rows = _once(spark, folder).select(number.alias("number"), "audio", "transcript", "length", "split", F.col("audio.path").alias("path"), F.col("speaker_id").alias("client_id"), F.col("transcript").alias("sentence"))
    number = F.col("number")
    segment = F.concat_ws("-", F.lit("0"), (number % 700).cast("string"), number.cast("string"))
    return rows.withColumn("key", F.when(number % 3 > 0, F.concat(F.lit("0/"), (number % 700).cast("string"), F.lit("/"), segment)))


@RECORDS.query("from_segments", f"""
WITH r AS (SELECT *, {_NUMBER} AS number, CASE WHEN {_NUMBER} % 3 > 0 THEN '0-' || ({_NUMBER} % 700) || '-' || {_NUMBER} END AS segment FROM ({ONCE})),
t AS (SELECT *, CASE WHEN split IN ('train', 'test') AND number % 3 = 1 AND number % 2 = 0 THEN 'side ' || number ELSE coalesce(transcript, '') END AS text FROM r)
SELECT 'S' || number AS id, CASE WHEN segment IS NOT NULL THEN 'SPK_' || lpad(CAST(number % 700 AS VARCHAR), 5, '0') ELSE {_HASH.format("'GigaSpeech2_' || number")} END AS speaker_id, 'th' AS language,
  text AS transcript, CAST(length AS DOUBLE) AS length, 'GigaSpeech2' AS dataset_name, CASE WHEN text <> '' THEN 1.0 ELSE 0.0 END AS confidence_score FROM t""")
def from_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Samples as a corpus of segments, every other of a third with its transcript in a side table."""
    raw = _raw(spark, folder)
    side = raw.where("split in ('train', 'test') and number % 3 = 1 and number % 2 = 0")
    side = side.select("split", F.element_at(F.split("key", "/"), -1).alias("segment_id"), F.concat(F.lit("side "), F.col("number").cast("string")).alias("transcript"))
    return corpora.from_segments(raw, side).select(*_COLUMNS)


@RECORDS.query("from_sentences", f"""
SELECT 'S' || {_NUMBER} AS id, CASE WHEN coalesce(speaker_id, '') <> '' THEN {_HASH.format("'mozilla_cv_' || speaker_id")} ELSE {_HASH.format("'MozillaCommonVoice_' || " + _NUMBER)} END AS speaker_id, 'th' AS language,
  coalesce(transcript, '') AS transcript, CAST(length AS DOUBLE) AS length, 'MozillaCommonVoice' AS dataset_name, 1.0 AS confidence_score FROM ({ONCE})""")
def from_sentences(spark: SparkSession, folder: str) -> DataFrame:
    """Samples as a corpus of read sentences with client ids."""
    return corpora.from_sentences(_raw(spark, folder), "MozillaCommonVoice", "mozilla_cv").select(*_COLUMNS)


@RECORDS.query("from_plain_sentences", f"""
SELECT 'S' || {_NUMBER} AS id, {_HASH.format("'ProcessedVoiceTH_' || " + _NUMBER)} AS speaker_id, 'th' AS language, coalesce(transcript, '') AS transcript, CAST(length AS DOUBLE) AS length,
  'ProcessedVoiceTH' AS dataset_name, 1.0 AS confidence_score FROM ({ONCE})""")
def from_plain_sentences(spark: SparkSession, folder: str) -> DataFrame:
    """Samples as a corpus of read sentences that doesn't name its speakers."""
    return corpora.from_sentences(_raw(spark, folder), "ProcessedVoiceTH").select(*_COLUMNS)


@RECORDS.query("stream_samples", f"""
SELECT 'temp_' || {_NUMBER} AS id, {_HASH.format("'GigaSpeech2_' || " + _NUMBER)} AS speaker_id, 'th' AS language, coalesce(transcript, '') AS transcript, coalesce(CAST(length AS DOUBLE), 1.0) AS length,
  'GigaSpeech2' AS dataset_name, 1.0 AS confidence_score FROM ({ONCE})""")
def stream_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Samples as a stream delivers them, before they get their ids."""
    return corpora.stream_samples(_raw(spark, folder), "GigaSpeech2").select(*_COLUMNS)


@RECORDS.query("own_speakers", f"SELECT id, 'SPK_' || CASE WHEN length(CAST({_NUMBER} AS VARCHAR)) < 5 THEN lpad(CAST({_NUMBER} AS VARCHAR), 5, '0') ELSE CAST({_NUMBER} AS VARCHAR) END AS speaker_id FROM ({ONCE})")
def own_speakers(spark: SparkSession, folder: str) -> DataFrame:
    """Every sample as its own speaker."""
    return corpora.own_speakers(_once(spark, folder).select("id"))


@RECORDS.query("hashed_speakers", """
SELECT DISTINCT speaker_id, 'SPK_' || lpad(CAST(CAST('0x' || substr(md5('cv_' || speaker_id), 1, 8) AS BIGINT) % 100000 AS VARCHAR), 5, '0') AS hashed
FROM samples WHERE speaker_id IS NOT NULL""")
def hashed_speakers(spark: SparkSession, folder: str) -> DataFrame:
    """Stable five-digit names for the client ids of a source."""
    return _samples(spark, folder).where("speaker_id is not null").select("speaker_id").distinct().withColumn("hashed", S.hashed_speaker(F.col("speaker_id"), "cv"))


@RECORDS.query("next_id", r"SELECT 'S' || (coalesce(max(TRY_CAST(regexp_extract(id, '^S(\d+)$', 1) AS BIGINT)), 0) + 1) AS next_id FROM samples")
def next_id(spark: SparkSession, folder: str) -> DataFrame:
    """The id with which an append goes on."""
    return _samples(spark, folder).agg(F.concat(F.lit("S"), (F.coalesce(F.max(S.id_number(F.col("id"))), F.lit(0)) + 1).cast("string")).alias("next_id"))


@RECORDS.query("sequential_ids", f"""
SELECT id, 'S' || (row_number() OVER (ORDER BY source_ord, day NULLS FIRST, recorded_at NULLS FIRST, id) + 100) AS new_id FROM (
  SELECT id, recorded_at, CAST(recorded_at AS DATE) AS day,
    CASE {PLAIN} WHEN 'gigaspeech2' THEN 0 WHEN 'processedvoiceth' THEN 1 WHEN 'mozillacommonvoice' THEN 2 ELSE 3 END AS source_ord
  FROM ({ONCE}))""")
def sequential_ids(spark: SparkSession, folder: str) -> DataFrame:
    """New ids without a gap, source after source, from S101 on."""
    plain = S.plain_name(F.col("dataset_name"))
    rows = _once(spark, folder).select("id", "recorded_at", F.coalesce(*[F.when(plain == s, F.lit(i)) for i, s in enumerate(SOURCES)], F.lit(len(SOURCES))).alias("source_ord"))
    # Records without a time go by id, a few thousand to a bucket; the others by the hour.
    bucket = F.struct("source_ord", F.date_trunc("hour", "recorded_at").alias("hour"), F.when(F.col("recorded_at").isNull(), F.substring("id", 1, 7)).alias("prefix"))
    return R.sequential(rows, ["source_ord", "recorded_at", "id"], bucket, 101, "new_id").select("id", "new_id")


@RECORDS.query("first_ingested", "SELECT id, min(ingested_at) AS ingested_at FROM samples GROUP BY id")
def first_ingested(spark: SparkSession, folder: str) -> DataFrame:
    """The first record of every id."""
    return _once(spark, folder).select("id", "ingested_at")


@RECORDS.query("unprocessed", """
SELECT DISTINCT id FROM samples WHERE audio.path NOT IN (SELECT file_path FROM error_records WHERE file_path IS NOT NULL)""")
def unprocessed(spark: SparkSession, folder: str) -> DataFrame:
    """Samples whose file is not among those that failed."""
    failed = table(spark, folder, "error_records").where("file_path is not null").select(F.col("file_path").alias("path"))
    return R.unprocessed(_samples(spark, folder).select("id", F.col("audio.path").alias("path")).where("path is not null"), failed, ["path"]).select("id").distinct()


@RECORDS.query("split_quota", f"""
SELECT id, split FROM (SELECT id, split, row_number() OVER (PARTITION BY split ORDER BY id) AS n FROM ({ONCE.replace('rn = 1', 'rn = 1 AND split IS NOT NULL')}))
WHERE n <= CASE split WHEN 'train' THEN 34 WHEN 'validation' THEN 33 WHEN 'test' THEN 33 END""")
def split_quota(spark: SparkSession, folder: str) -> DataFrame:
    """A hundred samples shared out over the splits, the rest of the division to the first."""
    return R.quota(_once(spark, folder), "split", ["id"], 100, ["train", "validation", "test"]).select("id", "split")


@RECORDS.query("last_errors", f"""
SELECT s.id, e.category, coalesce(e.retry_count, -1) AS retry_count FROM ({ONCE}) s LEFT JOIN (
  SELECT file_path, category, retry_count FROM (
    SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY occurred_at DESC NULLS LAST, retry_count DESC NULLS LAST, category DESC NULLS LAST) AS n FROM error_records)
  WHERE n = 1) e ON s.audio.path = e.file_path""")
def last_errors(spark: SparkSession, folder: str) -> DataFrame:
    """Samples with their file's last failure, if it had any: a lookup in which the last entry wins."""
    errors = table(spark, folder, "error_records")
    last = errors.groupBy("file_path").agg(F.max(F.struct("occurred_at", "retry_count", "category")).alias("e"))
    return _once(spark, folder).select("id", F.col("audio.path").alias("file_path")).join(last, "file_path", "left").select("id", "e.category", F.coalesce("e.retry_count", F.lit(-1)).alias("retry_count"))


@RECORDS.query("duration_rollup", f"""
SELECT {PLAIN} AS dataset, count(*) AS n, round(sum(CAST(length AS DOUBLE)) / 3600, 4) AS hours
FROM ({ONCE}) WHERE length BETWEEN 0.01 AND 3600 GROUP BY ROLLUP ({PLAIN})""")
def duration_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Hours of each source and of all."""
    rows = _once(spark, folder).where("length between 0.01 and 3600").select(S.plain_name(F.col("dataset_name")).alias("dataset"), F.col("length").cast("double").alias("length"))
    return rows.rollup("dataset").agg(F.count("*").alias("n"), F.round(F.sum("length") / 3600, 4).alias("hours"))


@RECORDS.query("dataset_card", f"""
SELECT {PLAIN} AS dataset, min(ingested_at) AS first_seen, count(DISTINCT id) AS n_samples, count(DISTINCT speaker_id) AS n_speakers,
  round(avg(CASE WHEN confidence_score BETWEEN 0 AND 1 THEN CAST(confidence_score AS DOUBLE) END), 4) AS mean_confidence
FROM samples WHERE {PLAIN} IS NOT NULL GROUP BY 1""")
def dataset_card(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of each source, in the order in which sources were first seen."""
    rows = _samples(spark, folder).withColumn("dataset", S.plain_name(F.col("dataset_name"))).where("dataset is not null")
    sure = F.when(F.col("confidence_score").between(0, 1), F.col("confidence_score").cast("double"))
    return rows.groupBy("dataset").agg(F.min("ingested_at").alias("first_seen"), F.count_distinct("id").alias("n_samples"), F.count_distinct("speaker_id").alias("n_speakers"), F.round(F.avg(sure), 4).alias("mean_confidence"))


@RECORDS.query("interleaved", f"""
SELECT id, round(row_number() OVER (PARTITION BY dataset ORDER BY day NULLS FIRST, recorded_at NULLS FIRST, id) / CASE dataset WHEN 'gigaspeech2' THEN 2.0 ELSE 1.0 END, 6) AS turn FROM (
  SELECT id, recorded_at, CAST(recorded_at AS DATE) AS day, {PLAIN} AS dataset FROM ({ONCE})) WHERE dataset IN ('gigaspeech2', 'processedvoiceth', 'mozillacommonvoice')""")
def interleaved(spark: SparkSession, folder: str) -> DataFrame:
    """Sources taking turns, one of them with double pace."""
    rows = _once(spark, folder).select("id", "recorded_at", S.plain_name(F.col("dataset_name")).alias("dataset")).where(F.col("dataset").isin(*SOURCES))
    return R.interleaved(rows, "dataset", ["recorded_at", "id"], _hour(), {s: 2.0 if s == SOURCES[0] else 1.0 for s in SOURCES}).select("id", "turn")


@RECORDS.query("interleaved_all", f"""
SELECT id, dataset, round(row_number() OVER (PARTITION BY dataset ORDER BY day NULLS FIRST, recorded_at NULLS FIRST, id) / CASE dataset WHEN 'gigaspeech2' THEN 2.0 ELSE 1.0 END, 6) AS turn FROM (
  SELECT id, recorded_at, CAST(recorded_at AS DATE) AS day, {PLAIN} AS dataset FROM ({ONCE}))""")
def interleaved_all(spark: SparkSession, folder: str) -> DataFrame:
    """Every source that is present taking turns, records without one as a source of their own."""
    rows = _once(spark, folder).select("id", "recorded_at", S.plain_name(F.col("dataset_name")).alias("dataset"))
    return R.interleaved(rows, "dataset", ["recorded_at", "id"], _hour(), {SOURCES[0]: 2.0}).select("id", "dataset", "turn")


@RECORDS.query("selectivity", f"""
SELECT count(*) AS n, round(avg(CASE WHEN language = 'th' THEN 1.0 ELSE 0.0 END) * 100, 4) AS thai_percent,
  round(avg(CASE WHEN length BETWEEN 0.01 AND 3600 THEN CAST(length AS DOUBLE) END), 4) AS mean_seconds FROM ({ONCE})""")
def selectivity(spark: SparkSession, folder: str) -> DataFrame:
    """Share of the wanted language and mean length over all samples."""
    return _once(spark, folder).agg(
        F.count("*").alias("n"), F.round(F.avg(F.when(F.col("language") == "th", 1.0).otherwise(0.0)) * 100, 4).alias("thai_percent"),
        F.round(F.avg(F.when(F.col("length").between(0.01, 3600), F.col("length").cast("double"))), 4).alias("mean_seconds"),
    )


@RECORDS.query("transcript_fill", """
SELECT source, count(*) AS n, CAST(sum(CASE WHEN confidence > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_kept FROM (
  SELECT CASE WHEN transcript IS NULL OR trim(transcript, ' ') = '' THEN 'empty' WHEN transcript IN ('[INAUDIBLE]', '[STT_ERROR]', '[NO_AUDIO]', '[NO_TRANSCRIPT]') THEN 'marker' ELSE 'text' END AS source,
    CASE WHEN trim(coalesce(transcript, ''), ' ') <> '' THEN 1.0 ELSE 0.0 END AS confidence FROM samples) GROUP BY source""")
def transcript_fill(spark: SparkSession, folder: str) -> DataFrame:
    """Where transcripts come from, and how many keep a default confidence."""
    t = F.col("transcript")
    source = F.when(S.default_confidence(t) == 0, "empty").when(t.isin(*S.MARKERS), "marker").otherwise("text")
    rows = _samples(spark, folder).select(source.alias("source"), S.default_confidence(t).alias("confidence"))
    return rows.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("confidence") > 0).alias("n_kept"))


@RECORDS.query("union_of_sources", """
SELECT kind, count(*) AS n FROM (SELECT id, 'sample' AS kind FROM samples UNION ALL SELECT CAST(doc_id AS VARCHAR), 'document' FROM documents UNION ALL SELECT CAST(item_id AS VARCHAR), 'item' FROM eval_items) GROUP BY kind""")
def union_of_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Records of three tables in one schema."""
    one = lambda name, key, kind: table(spark, folder, name).select(F.col(key).cast("string").alias("id"), F.lit(kind).alias("kind"))
    return one("samples", "id", "sample").unionByName(one("documents", "doc_id", "document")).unionByName(one("eval_items", "item_id", "item")).groupBy("kind").agg(F.count("*").alias("n"))


@RECORDS.query("shared_paths", "SELECT audio.path AS path FROM samples WHERE audio.path IS NOT NULL INTERSECT SELECT file_path FROM error_records")
def shared_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Files that are in both tables."""
    return _samples(spark, folder).where("audio.path is not null").select(F.col("audio.path").alias("path")).intersect(table(spark, folder, "error_records").select("file_path"))


@RECORDS.query("late_records", """
SELECT strftime(recorded_at, '%Y-%m') AS month, count(*) AS n, CAST(sum(CASE WHEN ingested_at - recorded_at > INTERVAL 1 DAY THEN 1 ELSE 0 END) AS BIGINT) AS n_late
FROM samples WHERE recorded_at IS NOT NULL GROUP BY 1""")
def late_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records of each month, and those that came more than a day late."""
    late = F.col("ingested_at") - F.col("recorded_at") > F.expr("INTERVAL 1 DAY")
    return _samples(spark, folder).where("recorded_at is not null").groupBy(F.date_format("recorded_at", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.count_if(late).alias("n_late"))


@RECORDS.query("resumed", f"""
SELECT id FROM (SELECT id, row_number() OVER (ORDER BY hour NULLS FIRST, recorded_at NULLS FIRST, id) AS n FROM (SELECT id, recorded_at, date_trunc('hour', recorded_at) AS hour FROM ({ONCE}))) WHERE n > 100 AND n <= 350""")
def resumed(spark: SparkSession, folder: str) -> DataFrame:
    """The 250 samples after the first hundred, in the order of time."""
    return R.skipped(_once(spark, folder).select("id", "recorded_at"), ["recorded_at", "id"], _hour(), 100, 250).select("id")


@RECORDS.query("exclusions", f"""
SELECT reason, count(*) AS n FROM (SELECT CASE WHEN confidence_score < 0.5 THEN 'unsure' WHEN length < 1 THEN 'short' WHEN language <> 'th' THEN 'language' END AS reason FROM ({ONCE})) WHERE reason IS NOT NULL GROUP BY reason""")
def exclusions(spark: SparkSession, folder: str) -> DataFrame:
    """How many samples each of a list of rules excludes, the first that holds counting; what is missing passes."""
    rules = {"unsure": F.col("confidence_score") < F.lit(0.5).cast("float"), "short": F.col("length") < 1, "language": F.col("language") != "th"}
    return R.excluded(_once(spark, folder), rules)[1].groupBy("reason").agg(F.count("*").alias("n"))


@RECORDS.query("last_month", """
SELECT dataset_name, count(*) AS n FROM samples, (SELECT max(ingested_at) AS until FROM samples) WHERE ingested_at >= until - INTERVAL 30 DAY AND ingested_at <= until GROUP BY dataset_name""")
def last_month(spark: SparkSession, folder: str) -> DataFrame:
    """Records of each source in the thirty days before the last one came."""
    rows = _samples(spark, folder).select("dataset_name", "ingested_at")
    both = rows.join(rows.agg(F.max("ingested_at").alias("until")), F.lit(True))  # one row
    return R.since(both, "ingested_at", F.col("until"), days=30).groupBy("dataset_name").agg(F.count("*").alias("n"))


@RECORDS.query("within_experiments", """
SELECT e.split, e.name, count(*) AS n FROM samples s JOIN (SELECT split, 'early' AS name, min(ingested_at) AS b, min(ingested_at) + INTERVAL 200 DAY AS e FROM samples WHERE split IS NOT NULL GROUP BY split UNION ALL
  SELECT split, 'late', max(ingested_at) - INTERVAL 30 DAY, NULL FROM samples WHERE split IS NOT NULL GROUP BY split) e ON s.split = e.split AND s.ingested_at >= e.b AND (e.e IS NULL OR s.ingested_at <= e.e) GROUP BY 1, 2""")
def within_experiments(spark: SparkSession, folder: str) -> DataFrame:
    """Records in two spans of time of each split, of which one has no end yet."""
    rows = _samples(spark, folder).select("id", "split", "ingested_at")
    ends = rows.where("split is not null").groupBy("split").agg(F.min("ingested_at").alias("lo"), F.max("ingested_at").alias("hi"))
    early = ends.select("split", F.lit("early").alias("name"), F.col("lo").alias("begin"), (F.col("lo") + F.expr("INTERVAL 200 DAY")).alias("end"))
    late = ends.select("split", F.lit("late").alias("name"), (F.col("hi") - F.expr("INTERVAL 30 DAY")).alias("begin"), F.lit(None).cast("timestamp_ntz").alias("end"))
    return R.within_experiments(rows, early.unionByName(late), ["split"], "ingested_at").groupBy("split", "name").agg(F.count("*").alias("n"))
