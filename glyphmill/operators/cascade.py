"""The decision cascade: the highest layer with an answer wins; an answer with another skeleton leaves the word unresolved."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import segments
from ..profile import ScriptProfile
from .corpus import tokens

SOURCES = ("override", "acronym", "preexisting", "homograph", "quote", "lexicon", "bigram", "model", "unresolved")


@dataclass
class Resources:
    """Tables of the layers; a layer without a table has no answers."""

    lexicon: DataFrame | None = None  # skeleton, category, best, rabbinic
    bigrams: DataFrame | None = None  # prev, skeleton, form
    homographs: DataFrame | None = None  # skeleton, fixed, default, after, before
    overrides: DataFrame | None = None  # scope ('*' or a paragraph), skeleton, form
    quotes: DataFrame | None = None  # id, idx, form, span_id
    model: DataFrame | None = None  # id, text: predictions


def homograph_form(fixed: Column, after: Column, before: Column, default: Column, prev: Column, next_: Column) -> Column:
    return F.coalesce(fixed, after[prev], before[next_], default)


def decide(texts: DataFrame, res: Resources, profile: ScriptProfile, keep_marks: bool = True, scope: Column | None = None, freeze_first: bool = False) -> DataFrame:
    """(id, idx, original, skeleton, form, source, confident, note) of each word of texts (id, text).

    freeze_first: acronyms and words that came with marks withstand overrides too, as in a correction run. Rules, overrides and bigrams are
    joined by key; Spark sends small sides whole and shuffles large ones.
    """
    base = texts.withColumn("scope", scope if scope is not None else F.lit("*"))
    t = tokens(base, profile, "id", "scope")
    nothing = F.lit(None).cast("string")
    some = lambda c: F.nullif(c, F.lit(""))
    if res.lexicon is not None:
        t = t.join(res.lexicon.select("skeleton", F.coalesce("rabbinic", F.when(F.col("category") == "unambiguous", F.col("best"))).alias("f_lexicon")), "skeleton", "left")
    if res.bigrams is not None:
        t = t.join(res.bigrams.withColumnRenamed("form", "f_bigram"), ["prev", "skeleton"], "left")
    if res.homographs is not None:
        t = t.join(res.homographs, "skeleton", "left").withColumn("f_homograph", homograph_form(F.col("fixed"), F.col("after"), F.col("before"), F.col("default"), F.col("prev"), F.col("next"))).drop("fixed", "after", "before", "default")
    if res.overrides is not None:
        all_ = res.overrides.where("scope = '*'").select("skeleton", F.col("form").alias("o_all"))
        own = res.overrides.where("scope != '*'").select("scope", "skeleton", F.col("form").alias("o_own"))
        t = t.join(all_, "skeleton", "left").join(own, ["scope", "skeleton"], "left").withColumn("f_override", F.coalesce(some(F.col("o_own")), some(F.col("o_all"))))
    if res.quotes is not None:
        t = t.join(res.quotes.select("id", "idx", F.col("form").alias("f_quote"), F.col("span_id").cast("string").alias("quoted")), ["id", "idx"], "left")
    if res.model is not None:
        from ..functions.text import words

        w = words(F.col("text"), profile)
        predicted = res.model.select("id", F.posexplode(w).alias("idx", "p"), F.size(w).alias("p_n"))
        sizes = texts.select("id", F.size(words(F.col("text"), profile)).alias("t_n"))
        t = t.join(predicted.join(sizes, "id").where("p_n = t_n").select("id", "idx", F.col("p").alias("f_model")), ["id", "idx"], "left")
        t = t.withColumn("f_model", F.when(profile.strip(F.col("f_model")) == F.col("skeleton"), F.col("f_model")))
    f = lambda name: some(F.col(f"f_{name}")) if f"f_{name}" in t.columns else nothing
    frozen = F.col("acronym") | (F.lit(keep_marks) & (F.col("form") != F.col("skeleton")))
    override = F.when(frozen & F.lit(freeze_first), None).otherwise(f("override"))
    answer = lambda form, name, note=nothing: F.when(form.isNotNull(), F.struct(form.alias("form"), F.lit(name).alias("source"), note.alias("note")))
    winner = F.coalesce(
        answer(override, "override"),
        F.when(F.col("acronym"), F.struct(F.col("form").alias("form"), F.lit("acronym").alias("source"), nothing.alias("note"))),
        F.when(frozen, F.struct(F.col("form").alias("form"), F.lit("preexisting").alias("source"), nothing.alias("note"))),
        answer(f("homograph"), "homograph"),
        answer(f("quote"), "quote", F.col("quoted") if "quoted" in t.columns else nothing),
        answer(f("lexicon"), "lexicon"),
        answer(f("bigram"), "bigram"),
        answer(f("model"), "model"),
    )
    t = t.withColumn("w", winner)
    good = F.col("w").isNotNull() & (profile.strip(F.col("w.form")) == F.col("skeleton"))
    return t.select(
        "id",
        "idx",
        F.col("form").alias("original"),
        "skeleton",
        F.when(good, F.col("w.form")).otherwise(F.col("form")).alias("form"),
        F.when(good, F.col("w.source")).otherwise("unresolved").alias("source"),
        good.alias("confident"),
        F.when(good, F.col("w.note")).when(F.col("w").isNotNull(), "skeleton").alias("note"),
    )


def reassemble(texts: DataFrame, decisions: DataFrame, profile: ScriptProfile, identity: bool = True) -> DataFrame:
    """(id, text): words replaced by their forms, everything else as it was; fails where stripping shows a difference."""
    forms = decisions.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "form"))), lambda x: x["form"]).alias("forms"))
    # Words and the rest alternate in a segmented text, so a piece's number gives its word's.
    seg = segments(F.col("text"), profile)
    word = lambda i: F.floor(i / 2).cast("int") + 1
    out = F.array_join(F.transform(seg, lambda s, i: F.when(s["is_word"], F.element_at("forms", word(i))).otherwise(s["piece"])), "")
    rows = texts.join(forms, "id", "left").withColumn("forms", F.coalesce("forms", F.array().cast("array<string>")))
    rows = rows.select("id", F.col("text").alias("source_text"), F.when(F.size("forms") > 0, out).otherwise(F.col("text")).alias("text"))
    if identity:
        ok = profile.strip(F.col("source_text")).eqNullSafe(profile.strip(F.col("text")))
        rows = rows.withColumn("text", F.when(ok, F.col("text")).otherwise(F.raise_error(F.concat(F.lit("identity broken in "), F.col("id").cast("string")))))
    return rows.select("id", "text")


def by_source(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


def engine(spec: str, res: Resources) -> Resources | None:
    """The resources that an engine name uses; None is the identity engine."""
    if spec == "null":
        return None
    if spec == "lexicon":
        return Resources(res.lexicon, res.bigrams, res.homographs, res.overrides)
    if spec == "quotes":
        return Resources(quotes=res.quotes)
    if spec == "lexicon+quotes":
        return Resources(res.lexicon, res.bigrams, res.homographs, res.overrides, res.quotes)
    if spec == "model":
        return Resources(model=res.model)
    if spec == "full":
        return res
    raise ValueError(f"unknown engine {spec}")
