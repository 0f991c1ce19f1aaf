"""Sections to a clean, deduplicated, labelled corpus of sentences, and tokens of any text table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify, clean
from ..functions.text import is_acronym, normalize, words
from ..profile import HEBREW, ScriptProfile

START = "<s>"


def sentences(sections: DataFrame, profile: ScriptProfile = HEBREW, composed: bool = True) -> DataFrame:
    """(section_seq, ref, source, layer, license, line_idx, sent_idx, text, n_words): cleaned, cut, fully marked, labelled. Narrow."""
    lines = sections.select("section_seq", "ref", "source", "layer", "license", F.posexplode("lines").alias("line_idx", "line"))
    line = F.col("line") if composed else normalize(F.col("line"))
    cleaned = lines.withColumn("line", clean.clean_line(line, latin=profile is HEBREW))
    rows = cleaned.select("section_seq", "ref", "source", "layer", "license", "line_idx", F.posexplode(clean.sentences(F.col("line"), profile)).alias("sent_idx", "text"))
    rows = rows.where(clean.is_fully_marked(F.col("text"), profile))
    label = classify.layer(F.col("source"), F.col("layer"), F.col("text")) if profile is HEBREW else F.col("layer")
    return rows.withColumn("layer", label).withColumn("n_words", F.size(words(F.col("text"), profile)))


def drop_held_out(rows: DataFrame, held_out: DataFrame, key: str = "ref") -> DataFrame:
    return rows.join(held_out.select(key).distinct(), key, "left_anti")


def deduplicate(rows: DataFrame, profile: ScriptProfile = HEBREW) -> DataFrame:
    """The first sentence of each stripped text. A grouped minimum with map-side combine, so a sentence with a third of all rows is no hot group."""
    columns = rows.columns
    place = F.struct(F.col("section_seq").isNull(), "section_seq", "line_idx", "sent_idx")  # sections without a number come last
    return rows.withColumn("h", F.sha1(profile.key(F.col("text")))).groupBy("h").agg(F.min_by(F.struct(*columns), place).alias("r")).select("r.*")


def build_corpus(sections: DataFrame, held_out: DataFrame | None = None, profile: ScriptProfile = HEBREW, commercial_only: bool = False, composed: bool = True) -> DataFrame:
    """Cheap filters on sections come before any line is parsed."""
    if commercial_only:
        sections = sections.where(classify.commercial_ok(F.col("license")))
    if held_out is not None:
        sections = drop_held_out(sections, held_out)
    return deduplicate(sentences(sections, profile, composed), profile)


def statistics(corpus: DataFrame) -> DataFrame:
    """Sentences and words by layer and license, with subtotals."""
    return corpus.rollup("layer", "license").agg(F.count(F.lit(1)).alias("sentences"), F.sum("n_words").alias("words"))


def tokens(rows: DataFrame, profile: ScriptProfile, *keys: str, text: str = "text") -> DataFrame:
    """keys, idx, form, skeleton, prev, next, acronym. Neighbours come from the row's own array, so there is no window and no shuffle.

    Marks stand inside words only where they belong to them, so the words of the stripped text are the stripped words, in the same places.
    """
    rows = rows.select(*keys, words(F.col(text), profile).alias("form"), words(profile.strip(F.col(text)), profile).alias("skeleton"))
    n = F.size("form")
    rows = rows.select(*keys, "form", "skeleton", F.slice(F.concat(F.array(F.lit(START)), "skeleton"), F.lit(1), n).alias("prev"), F.slice("skeleton", F.lit(2), n).alias("next"))
    out = rows.select(*keys, F.posexplode(F.arrays_zip("form", "skeleton", "prev", "next")).alias("idx", "t")).select(*keys, "idx", "t.*")
    return out.withColumn("acronym", is_acronym(F.col("form")) if profile is HEBREW else F.lit(False))


def sample_eval(corpus: DataFrame, quota: int, seed: int = 20260916) -> DataFrame:
    """Per source, whole sections in seeded hash order until `quota` sentences are reached; the section that crosses it is cut."""
    from pyspark.sql import Window

    sizes = corpus.groupBy("source", "ref").count()
    order = Window.partitionBy("source").orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "ref").cast("binary")), "ref")
    starts = sizes.withColumn("before", F.coalesce(F.sum("count").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where(F.col("before") < quota)
    inside = Window.partitionBy("source", "ref").orderBy("section_seq", "line_idx", "sent_idx")
    picked = corpus.join(starts.select("source", "ref", "before"), ["source", "ref"]).withColumn("n", F.row_number().over(inside))
    return picked.where(F.col("before") + F.col("n") <= quota).withColumn("id", F.concat_ws("#", "ref", "n")).drop("before", "n")


def leaks(training: DataFrame, evaluation: DataFrame, profile: ScriptProfile = HEBREW) -> DataFrame:
    """Training rows whose stripped text is in the evaluation set."""
    key = profile.strip(F.col("text"))
    return training.withColumn("k", key).join(evaluation.select(key.alias("k")).distinct(), "k", "left_semi").drop("k")
