"""Queries of the training-data operators over the project's tables, whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.chunking import pieces
from voxloom.llm.clusters import similarity_clusters, typical_members
from voxloom.llm.langid import fit_language_model, language_passages, unnamed_languages
from voxloom.llm.leaks import leaked_items
from voxloom.llm.lookalike import consistent_text, lookalike_members, lookalike_pairs
from voxloom.llm.mixing import mixed, shares_reached
from voxloom.llm.packing import packed, token_sizes
from voxloom.llm.splits import assign_splits, speaker_name, speaker_number, with_components
from voxloom.plans.registry import Registry
from voxloom.sources import table

LLM = Registry()

DIMENSIONS = 128  # fixed value: size of a voice vector
BLOCK_SECONDS = 60.0
CAPACITY = 4096
LIMIT, OVERLAP = 512, 64


@LLM.query("p1_found")
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Samples whose transcripts are different strings that look the same."""
    return lookalike_pairs(table(spark, folder, "samples"), "id", "transcript")


@LLM.query("p1_classes")
def p1_classes(spark: SparkSession, folder: str) -> DataFrame:
    """The samples of p1_found in one row each: the class of equal-looking transcripts and the number of links."""
    return lookalike_members(table(spark, folder, "samples"), "id", "transcript")


@LLM.query("p1_consistent")
def p1_consistent(spark: SparkSession, folder: str) -> DataFrame:
    """Every transcript in its one consistent form."""
    return consistent_text(table(spark, folder, "samples").select("id", "ingested_at", "transcript"), "transcript", "consistent").drop("transcript")


_SPEAKERS = """
WITH s AS (
  SELECT nullif(regexp_extract(translate(speaker_id, '０１２３４５６７８９', '0123456789'), '(\\d+)', 1), '') AS digits, split
  FROM samples),
n AS (SELECT regexp_replace(digits, '^0+(\\d)', '\\1') AS number, split FROM s WHERE digits IS NOT NULL)
SELECT 'SPK_' || CASE WHEN length(number) < 5 THEN lpad(number, 5, '0') ELSE number END AS speaker_id
FROM n WHERE split IS NOT NULL GROUP BY number HAVING count(DISTINCT split) > 1
"""


@LLM.query("p3_found", _SPEAKERS)
def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Speakers whose samples carry more than one split: components that the given splits tear apart."""
    samples = table(spark, folder, "samples").select("id", "split", speaker_number(F.col("speaker_id")).alias("number"))
    rows = with_components(samples, "id", _entities()).where("number is not null and split is not null")
    # A component may hold several speakers, not all of them torn.
    torn = rows.groupBy("component", "number").agg(F.min("split").alias("lo"), F.max("split").alias("hi")).where("lo <> hi")
    return torn.select(speaker_name(F.col("number")).alias("speaker_id"))


def _entities() -> dict[str, Column]:
    # A record that was ingested again is linked to itself by its id, whatever its speaker says.
    return {"speaker": F.col("number"), "record": F.col("id")}


def _assigned(spark: SparkSession, folder: str) -> DataFrame:
    samples = table(spark, folder, "samples").select("id", F.col("split").alias("given"), speaker_number(F.col("speaker_id")).alias("number"))
    targets = [(r.split, r.target_share) for r in table(spark, folder, "split_targets").collect()]  # one row for each split
    return assign_splits(samples, "id", _entities(), targets, "split")


@LLM.query("p3_assigned")
def p3_assigned(spark: SparkSession, folder: str) -> DataFrame:
    """The split of every sample, one for all records of a speaker."""
    return _assigned(spark, folder).select("id", "component", "split").distinct()


@LLM.query("p3_shares")
def p3_shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares that the assignment reaches, beside the targets."""
    rows = _assigned(spark, folder).groupBy("split").agg(F.count("*").alias("n_records"), F.count_distinct("component").alias("n_components"))
    rows = table(spark, folder, "split_targets").join(rows, "split", "left").na.fill(0, ["n_records", "n_components"])
    whole = rows.agg(F.sum("n_records").alias("whole"))
    return rows.join(whole, F.lit(True)).select("split", "target_share", "n_records", "n_components", F.round(F.col("n_records") / F.nullif("whole", F.lit(0)), 6).alias("actual_share"))


@LLM.query("p4_found")
def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings of one voice, each with the first of its cluster."""
    members, _ = similarity_clusters(table(spark, folder, "speaker_embeddings"), "emb_id", "vector", DIMENSIONS)
    return members.where("emb_id <> cluster").select(F.col("cluster").alias("first_emb_id"), "emb_id")


@LLM.query("p4_clusters")
def p4_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Size and most typical members of every cluster."""
    rows = table(spark, folder, "speaker_embeddings")
    members, clusters = similarity_clusters(rows, "emb_id", "vector", DIMENSIONS)
    return typical_members(rows, "emb_id", "vector", DIMENSIONS, members, clusters)


def _mix(spark: SparkSession, folder: str) -> DataFrame:
    # Spellings of a data set's name differ in case, spaces, hyphens and underscores.
    plain = lambda c: F.lower(F.regexp_replace(c, r"[\s_-]+", ""))
    targets = table(spark, folder, "mix_targets")
    names = targets.select(F.col("dataset_name").alias("known"), plain(F.col("dataset_name")).alias("plain"))
    samples = table(spark, folder, "samples").select("id", "length", plain(F.col("dataset_name")).alias("plain"))
    samples = samples.where("length >= 0.01 and length <= 3600").join(names, "plain")
    return mixed(samples, "id", F.col("known"), F.round(F.col("length").cast("double") * 1000), targets, "dataset_name", "target_share", "max_repeats", BLOCK_SECONDS * 1000)


@LLM.query("p5_mix")
def p5_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The chosen samples with their repeats, and their places in the mix."""
    mix = _mix(spark, folder)
    return mix.select(F.col("source").alias("dataset_name"), F.col("key").alias("id"), "copy", (F.col("size") / 1000).alias("seconds"), "block", "slot", "release", "deadline", "position")


@LLM.query("p5_shares")
def p5_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Shares of the total length that the mix reaches, beside the targets."""
    reached = shares_reached(_mix(spark, folder)).withColumnRenamed("source", "dataset_name")
    return table(spark, folder, "mix_targets").join(reached, "dataset_name", "left").withColumn("seconds", F.col("size") / 1000).drop("size")


def _model(spark: SparkSession, folder: str):
    return fit_language_model(table(spark, folder, "lang_examples"), "text", "lang")


@LLM.query("p6_found")
def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Languages of each sample's transcript that its label doesn't name."""
    return unnamed_languages(table(spark, folder, "samples"), "id", "transcript", "language", _model(spark, folder))


@LLM.query("p6_passages")
def p6_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Every passage of every transcript with its language and confidence."""
    found = language_passages(table(spark, folder, "samples"), "id", "transcript", _model(spark, folder))
    return found.select("id", "passage", "lang", F.round("confidence", 4).alias("confidence"), "ambiguous", "n_letters")


def _packed(spark: SparkSession, folder: str) -> DataFrame:
    return packed(token_sizes(table(spark, folder, "documents"), "doc_id", "text"), "doc_id", "tokens", CAPACITY)


@LLM.query("p7_containers")
def p7_containers(spark: SparkSession, folder: str) -> DataFrame:
    """The container of every document or piece of an oversized one, and its fill."""
    return _packed(spark, folder).withColumnRenamed("size", "tokens")


@LLM.query("p7_fill")
def p7_fill(spark: SparkSession, folder: str) -> DataFrame:
    """How many containers are filled how far, in hundredths."""
    each = _packed(spark, folder).where("container is not null").groupBy("container").agg(F.max("fill").alias("fill"), F.count("*").alias("n"))
    return each.groupBy((F.floor(F.col("fill") * 100) / 100).alias("fill_from")).agg(F.count("*").alias("n_containers"), F.sum("n").alias("n_items"))


@LLM.query("p8_found")
def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and the evaluation items of which they hold half or more as one passage."""
    return p8_coverage(spark, folder).select("doc_id", "item_id")


@LLM.query("p8_coverage")
def p8_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """As p8_found, with the share of the item that is held."""
    found = leaked_items(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "eval_items"), "item_id", "text")
    return found.withColumn("coverage", F.round("coverage", 4))


@LLM.query("p9_pieces")
def p9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in pieces within the limit, with their places in the text."""
    return pieces(table(spark, folder, "documents"), "doc_id", "text", LIMIT, OVERLAP)
