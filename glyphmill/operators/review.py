"""The human correction loop: uncertain words with context, ambiguous entries, recorded corrections, correction runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..profile import ScriptProfile
from .cascade import Resources, decide
from .evaluate import context


def pending(decisions: DataFrame, most: int = 3, around: int = 5) -> DataFrame:
    """Up to `most` places of each unconfident skeleton, in order of text and place, with the words around.

    Places are numbered by a window over unconfident words only; contexts are cut from each text's own array.
    """
    from pyspark.sql.functions import row_number

    words_ = decisions.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "original"))), lambda x: x["original"]).alias("w"))
    rows = decisions.where(~F.col("confident")).withColumn("r", row_number().over(Window.partitionBy("skeleton").orderBy("id", "idx"))).where(F.col("r") <= most)
    return rows.join(words_, "id").select("skeleton", F.col("id").alias("paragraph"), context(F.col("w"), F.col("idx"), around).alias("context"), F.col("idx").alias("position"), "note")


def from_lexicon(queue: DataFrame, most: int) -> DataFrame:
    return queue.orderBy(F.desc("count"), "skeleton").limit(most).select("skeleton", F.transform("variants", lambda v: v["form"]).alias("candidates"), "count")


def record(overrides: DataFrame, corrections: DataFrame, profile: ScriptProfile) -> DataFrame:
    """overrides with corrections (seq, scope, skeleton, form): those whose form strips to the skeleton; the last one wins."""
    valid = corrections.where(profile.strip(F.col("form")) == F.col("skeleton"))
    rows = overrides.withColumn("seq", F.lit(-1).cast("bigint")).unionByName(valid.select("scope", "skeleton", "form", F.col("seq").cast("bigint")))
    return rows.groupBy("scope", "skeleton").agg(F.max_by("form", "seq").alias("form"))


def remaining(pending_: DataFrame, overrides: DataFrame) -> DataFrame:
    return pending_.join(overrides.select("skeleton").distinct(), "skeleton", "left_anti")


def statistics(pending_: DataFrame, corrections: DataFrame, overrides: DataFrame) -> DataFrame:
    one = lambda df, name: df.agg(F.lit(name).alias("what"), F.count(F.lit(1)).alias("n"))
    return one(pending_, "pending").unionByName(one(corrections, "corrections")).unionByName(one(overrides, "overrides"))


def fix(texts: DataFrame, homographs: DataFrame, overrides: DataFrame, author_marked: DataFrame | None, profile: ScriptProfile) -> DataFrame:
    """A correction run: rules and overrides only, acronyms and author-marked (id, idx) words stay. (id, idx, old, new) of changed words."""
    d = decide(texts, Resources(homographs=homographs, overrides=overrides), profile, keep_marks=False, freeze_first=True)
    d = d.where(F.col("source").isin("homograph", "override") & (F.col("form") != F.col("original")))
    if author_marked is not None:
        d = d.join(author_marked.select("id", "idx"), ["id", "idx"], "left_anti")
    return d.select("id", "idx", F.col("original").alias("old"), F.col("form").alias("new"))


def changes(fixed: DataFrame, most: int = 60) -> DataFrame:
    return fixed.groupBy("old", "new").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "old", "new").limit(most)
