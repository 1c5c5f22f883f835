"""Records of several sources in one schema: validation, identity, duplicates, splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.operators.aggregates import top_per_group
from voxloom.operators.series import numbered

# The rules of the target schema.
ID_FORM, SPEAKER_FORM, LANGUAGES = r"^(S\d+|temp_\d+)$", r"^SPK_\d{5}$", ("th",)
LENGTHS, CONFIDENCES, LONGEST_TRANSCRIPT = (0.01, 3600.0), (0.0, 1.0), 10_000


def validation_errors(strict: bool = True) -> Column:
    """All rules that a record breaks, as an array; a record is valid if it is empty.

    Without ``strict`` the least length of strings is not enforced.
    """
    c = F.col
    text = lambda name, form: F.when(c(name).isNull(), f"{name}:missing").when(~c(name).rlike(form), f"{name}:form")
    between = lambda name, low, high: F.when(c(name).isNull(), f"{name}:missing").when((c(name) < F.lit(low).cast("float")) | (c(name) > F.lit(high).cast("float")) | F.isnan(name), f"{name}:range")
    rules = [
        text("id", ID_FORM),
        text("speaker_id", SPEAKER_FORM),
        F.when(c("language").isNull(), "language:missing").when(~c("language").isin(*LANGUAGES), "language:value"),
        F.when(c("audio").isNull(), "audio:missing"),
        F.when(c("transcript").isNull(), "transcript:missing").when(F.length("transcript") > LONGEST_TRANSCRIPT, "transcript:long"),
        between("length", *LENGTHS),
        F.when(c("dataset_name").isNull(), "dataset_name:missing"),
        between("confidence_score", *CONFIDENCES),
    ]
    if strict:
        rules += [F.when(c("transcript") == "", "transcript:short"), F.when(c("dataset_name") == "", "dataset_name:short")]
    return F.array_compact(F.array(*rules))


def first_of_each(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key by ``order``, by partial aggregation: no group is sorted.

    ``order`` should name a unique order; rows of a null key are one group.
    """
    whole = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order], F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"))
    if any(f.dataType.simpleString().startswith("map") for f in df.schema.fields):
        rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn("__rn", rn).where("__rn = 1").drop("__rn")
    return df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.min(whole)["__row"].alias("__row")).select("__row.*")


def unprocessed(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among those done; null keys are kept."""
    return df.join(done.select(*keys).distinct(), list(keys), "left_anti")


def sequential(df: DataFrame, order: Sequence[str], bucket: Column, start: int, output: str) -> DataFrame:
    """Add ids ``S<start>``, ``S<start + 1>``, ... in ``order``, without a gap and without one global sort."""
    return numbered(df, [], order, bucket, "__number").withColumn(output, F.concat(F.lit("S"), (F.col("__number") + (start - 1)).cast("string"))).drop("__number")


def quota(df: DataFrame, split: str, order: Sequence[str], n: int, splits: Sequence[str]) -> DataFrame:
    """The first rows of each split: an equal part of ``n``, the rest of the division to the first split."""
    each, rest = divmod(n, len(splits))
    most = {s: max(1, each) + (rest if i == 0 else 0) for i, s in enumerate(splits)}
    allowed = F.coalesce(*[F.when(F.col(split) == s, F.lit(m)) for s, m in most.items()])
    # Parts of a split are cut to the largest quota first, so no task ranks a whole split.
    rows = top_per_group(df.where(F.col(split).isin(*splits)), [split], [F.col(c) for c in order], F.xxhash64(*order), max(most.values()), "__rn")
    return rows.where(F.col("__rn") <= allowed).drop("__rn")


def interleaved(df: DataFrame, source: str, order: Sequence[str], bucket: Column, weights: Mapping[str, float] | None = None) -> DataFrame:
    """Add ``turn``: the place of a row when sources take turns, by weight if weights are given; 1 for a source without one. A null source takes turns too."""
    rows = numbered(df, [source], order, bucket, "__rn")
    pace = F.lit(1.0)
    if weights:
        pace = F.coalesce(*[F.when(F.col(source) == s, F.lit(float(w))) for s, w in weights.items()], F.lit(1.0))
    return rows.withColumn("turn", F.round(F.col("__rn") / pace, 6)).drop("__rn")


def keep_best(df: DataFrame, key: str, name: str, value: str) -> DataFrame:
    """Of the rows of a key and name, the one of largest value."""
    return df.groupBy(key, name).agg(F.max(value).alias(value))


def ordered_distinct(df: DataFrame, value: str, position: str) -> DataFrame:
    """Distinct values with the position at which each first stands."""
    return df.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(position).alias(position))


def skipped(df: DataFrame, order: Sequence[str], bucket: Column, skip: int, take: int | None = None) -> DataFrame:
    """Rows after the first ``skip`` in ``order``, ``take`` of them at most: where a run goes on that stopped."""
    rows = numbered(df, [], order, bucket, "__n")
    kept = F.col("__n") > skip
    return rows.where(kept if take is None else kept & (F.col("__n") <= skip + take)).drop("__n")


def excluded(df: DataFrame, rules: Mapping[str, Column], reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """Rows that no rule excludes, and the others with the name of the first rule that does.

    A rule is a condition on the row; a null condition excludes nothing. An existing column ``reason`` is replaced.
    """
    first = F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in rules.items()], F.lit(None).cast("string"))
    rows = df.withColumn(reason, first)
    return rows.where(F.col(reason).isNull()).drop(reason), rows.where(F.col(reason).isNotNull())


def since(df: DataFrame, time: str, until: Column, hours: float = 0, days: float = 0) -> DataFrame:
    """Rows of the hours and days up to ``until``, both ends included; rows without a time are left out."""
    span = F.expr(f"INTERVAL {round((hours + 24 * days) * 3600)} SECOND")
    return df.where((F.col(time) >= until - span) & (F.col(time) <= until))


def within_experiments(history: DataFrame, experiments: DataFrame, keys: Sequence[str], time: str, begin: str = "begin", end: str = "end") -> DataFrame:
    """Rows of the history with each experiment on the same keys (a model and its version, say) in whose span their time falls, both ends included.

    An experiment without an end is still running. Columns of both are kept; names that clash are the history's.
    """
    mine = [c for c in experiments.columns if c not in history.columns or c in keys]
    named = experiments.select(*mine)
    inside = (F.col(time) >= F.col(begin)) & (F.col(end).isNull() | (F.col(time) <= F.col(end)))
    return history.join(named, list(keys)).where(inside)
