"""Word and character error rates by segment, confusions, contexts, spelling evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import char_errors, word_matches, words
from ..profile import HEBREW, ScriptProfile


def align(gold: DataFrame, predicted: DataFrame, profile: ScriptProfile) -> DataFrame:
    """(id, layer, idx, gold, predicted, failed): words by place; all words of a text are failed if stripping shows another text or another number of words."""
    g = gold.select("id", "layer", F.col("text").alias("g"))
    p = predicted.select("id", F.col("text").alias("p"))
    gw, pw = words(F.col("g"), profile), words(F.col("p"), profile)
    failed = ~(F.coalesce(profile.strip(F.col("g")) == profile.strip(F.col("p")), F.lit(False)) & F.coalesce(F.size(gw) == F.size(pw), F.lit(False)))
    rows = g.join(p, "id", "left").select("id", "layer", gw.alias("gw"), pw.alias("pw"), failed.alias("failed"))
    return rows.select("id", "layer", "failed", "pw", F.posexplode("gw").alias("idx", "gold")).select("id", "layer", "idx", "gold", F.when(~F.col("failed"), F.try_element_at("pw", F.col("idx") + 1)).alias("predicted"), "failed")


def measured(aligned: DataFrame, profile: ScriptProfile) -> DataFrame:
    """aligned with errors by strictness, slots and slot_errors; failed words are wrong in every way."""
    if profile is HEBREW:
        wrong = lambda **k: ~word_matches(F.col("gold"), F.col("predicted"), **k)
        e = char_errors(F.col("gold"), F.col("predicted"))
        slots, slot_errors = e["slots"], e["errors"]
    else:
        wrong = lambda **k: F.col("gold") != F.col("predicted")
        slots = F.length("gold")
        slot_errors = F.when(F.length("gold") == F.length("predicted"), F.size(F.filter(F.zip_with(F.split("gold", ""), F.split("predicted", ""), lambda a, b: a != b), lambda x: x))).otherwise(F.length("gold"))
    stripped = F.length(profile.strip(F.col("gold")))
    one = lambda c: F.when(F.col("failed"), 1).otherwise(c.cast("int"))
    return aligned.select(
        "*",
        one(wrong()).alias("wrong"),
        one(wrong(ignore_shin=True)).alias("wrong_no_shin"),
        one(wrong(lenient=True)).alias("wrong_lenient"),
        F.when(F.col("failed"), stripped).otherwise(slots).alias("slots"),
        F.when(F.col("failed"), stripped).otherwise(slot_errors).alias("slot_errors"),
    )


def buckets(rows: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Counters and rates per segment; a word is in overall and in every segment whose flag holds (failed words in overall only)."""
    names = F.filter(F.array(F.lit("overall"), *(F.when(f & ~F.col("failed"), n) for n, f in flags.items())), lambda x: x.isNotNull())
    out = rows.select("wrong", "wrong_no_shin", "wrong_lenient", "slots", "slot_errors", F.explode(names).alias("segment")).groupBy("segment").agg(F.count(F.lit(1)).alias("words"), *(F.sum(c).alias(c) for c in ("wrong", "wrong_no_shin", "wrong_lenient", "slots", "slot_errors")))
    return out.withColumn("wer", F.try_divide("wrong", "words")).withColumn("cer", F.try_divide("slot_errors", "slots"))


def confusions(rows: DataFrame, most: int = 25) -> DataFrame:
    """The most frequent wrong pairs; of equally frequent ones those seen first, in order of texts and places."""
    pairs = rows.where("wrong = 1 and not failed").groupBy("gold", "predicted").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "idx")).alias("first"))
    return pairs.orderBy(F.desc("n"), "first").limit(most).drop("first")


def context(words_: Column, i: Column, around: int) -> Column:
    """The words from i - around to i + around, i from 0."""
    low = F.greatest(i - around, F.lit(0))
    return F.array_join(F.slice(words_, low + 1, i + around - low + 1), " ")


def best(results: DataFrame) -> DataFrame:
    """The engine with the least error rate."""
    return results.agg(F.min_by("engine", "wer").alias("engine"), F.min("wer").alias("wer"))


def spelling(rows: DataFrame) -> DataFrame:
    """(mode, bucket): total, exact and right_spelling of rows (mode, is_mater, gold, predicted)."""
    exact, spelled = word_matches(F.col("gold"), F.col("predicted")), HEBREW.strip(F.col("gold")) == HEBREW.strip(F.col("predicted"))
    return rows.groupBy("mode", F.when(F.col("is_mater"), "mater").otherwise("plain").alias("bucket")).agg(F.count(F.lit(1)).alias("total"), F.sum(exact.cast("int")).alias("exact"), F.sum(spelled.cast("int")).alias("right_spelling"))


def percent(share: Column) -> Column:
    return F.format_string("%.2f%%", 100 * share)
