"""Defective spelling from corpus evidence. Works on distinct forms: candidates are subsets of silent letters, evidence comes from joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.spelling import mater_positions, mechanical, restore
from ..functions.text import letter_slots, slots, word_matches
from ..profile import HEBREW, PREFIXES
from . import cascade

MOST, SUPPORT, RATIO, STRONG, VS_FULL = 4, 3, 0.50, 25, 0.35
ELIGIBLE = ("model", "lexicon", "bigram")


def _supports(form: Column, removed: Column) -> Column:
    """In a defective form the letter before each removed place carries the vowel that replaces it; places shift by earlier removals."""
    s = letter_slots(form)
    return F.forall(F.transform(removed, lambda r, k: F.coalesce(F.try_element_at(s, r["pos"] - k)["vowel"] == r["vowel"], F.lit(False))), lambda ok: ok)


def _marks(form: Column) -> Column:
    return F.aggregate(slots(form), F.lit(0), lambda n, s: n + (s["vowel"] != "").cast("int") + s["dagesh"].cast("int") + (s["shin"] != "").cast("int"))


def _pick(variants: Column) -> Column:
    """Variants grouped with the first group head that they match leniently; of the heaviest group the most marked, then most frequent form."""
    head = lambda g: F.element_at(g["members"], 1)["form"]
    start = F.array().cast("array<struct<n:bigint,members:array<struct<form:string,n:bigint>>>>")

    def step(groups: Column, v: Column) -> Column:
        at = F.array_position(F.transform(groups, lambda g: word_matches(head(g), v["form"], lenient=True)), True)
        grown = F.transform(groups, lambda g, i: F.when(i == at - 1, F.struct((g["n"] + v["n"]).alias("n"), F.concat(g["members"], F.array(v)).alias("members"))).otherwise(g))
        return F.when(at > 0, grown).otherwise(F.concat(groups, F.array(F.struct(v["n"].alias("n"), F.array(v).alias("members")))))

    groups = F.aggregate(variants, start, step)
    best = F.element_at(F.filter(groups, lambda g: g["n"] == F.array_max(F.transform(groups, lambda h: h["n"]))), 1)["members"]
    ranked = F.transform(best, lambda m: F.struct(_marks(m["form"]).alias("marks"), m["n"].alias("n"), m["form"].alias("form")))
    return F.array_max(ranked)["form"]


def convert(forms: DataFrame, lexicon: DataFrame, holam: bool = False) -> DataFrame:
    """(form) to (form, converted, removed array<(pos, vowel, letter)>, support) for the forms with evidence.

    Whole words first, then stems behind one to three prefix letters; the largest subset with any evidence wins.
    """
    skeleton = HEBREW.strip(F.col("form"))
    maters = forms.select("form").distinct().withColumn("skeleton", skeleton).withColumn("m", mater_positions(F.col("form"), holam=holam))
    maters = maters.where((F.size("m") > 0) & (F.size("m") <= MOST) & (F.length("skeleton") == F.size(letter_slots(F.col("form")))))
    masks = F.explode(F.expr("sequence(1, shiftleft(1, size(m)) - 1)"))
    cand = maters.select("form", "skeleton", "m", masks.alias("mask")).withColumn("removed", F.filter("m", lambda x, i: F.getbit(F.col("mask"), i) == 1))
    cand = cand.select("form", "skeleton", "removed", F.explode(F.array(*map(F.lit, range(4)))).alias("plen"))
    least = F.element_at("removed", 1)["pos"]
    stem = (least > F.col("plen")) & (F.length("skeleton") - F.col("plen") >= 3) & F.expr("substring(skeleton, 1, plen)").rlike(f"^[{PREFIXES}]*$")
    cand = cand.where((F.col("plen") == 0) | stem)
    cand = cand.withColumn("full", F.expr("substring(skeleton, plen + 1)")).withColumn("places", F.transform("removed", lambda r: F.struct((r["pos"] - F.col("plen")).alias("pos"), r["vowel"].alias("vowel"))))
    letters = F.filter(F.transform(F.split("full", ""), lambda c, i: F.struct(i.alias("i"), c.alias("c"))), lambda x: ~F.exists("places", lambda p: p["pos"] == x["i"]))
    cand = cand.withColumn("defective", F.array_join(F.transform(letters, lambda x: x["c"]), ""))
    lex = lexicon.select("skeleton", "variants")
    found = cand.join(lex.select(F.col("skeleton").alias("defective"), F.col("variants").alias("dv")), "defective").join(lex.select(F.col("skeleton").alias("full"), F.col("variants").alias("fv")), "full", "left")
    total = lambda v: F.aggregate(v, F.lit(0).cast("bigint"), lambda n, x: n + x["n"])
    found = found.withColumn("sv", F.filter("dv", lambda v: _supports(v["form"], F.col("places"))))
    found = found.withColumn("support", total(F.col("sv"))).withColumn("total", total(F.col("dv")))
    shaped = F.filter(F.coalesce("fv", F.array().cast("array<struct<form:string,n:bigint>>")), lambda v: F.forall("places", lambda p: F.exists(mater_positions(v["form"], holam=True), lambda q: (q["pos"] == p["pos"]) & (q["vowel"] == p["vowel"]))))
    found = found.withColumn("full_support", total(shaped))
    enough = (F.col("support") >= SUPPORT) & ((F.col("support") / F.col("total") >= RATIO) | (F.col("support") >= STRONG)) & ((F.col("full_support") == 0) | (F.col("support") >= VS_FULL * F.col("full_support")))
    found = found.where(enough)
    by_subset = Window.partitionBy("form", "removed").orderBy("plen")
    by_form = Window.partitionBy("form").orderBy(F.desc(F.size("removed")), F.desc("support"), F.transform("removed", lambda r: r["pos"]))
    best = found.withColumn("r", F.row_number().over(by_subset)).where("r = 1").withColumn("r", F.row_number().over(by_form)).where("r = 1")
    converted = F.when(F.col("plen") == 0, _pick(F.col("sv"))).otherwise(mechanical(F.col("form"), F.col("removed")))
    removed = F.transform("removed", lambda r: F.struct(r["pos"].alias("pos"), r["vowel"].alias("vowel"), F.substring("skeleton", r["pos"] + 1, F.lit(1)).alias("letter")))
    return best.select("form", converted.alias("converted"), removed.alias("removed"), "support")


def apply(decisions: DataFrame, conversions: DataFrame) -> DataFrame:
    """Decisions with the defective form and its removals where a convertible layer decided."""
    d = decisions.join(conversions.select(F.col("form"), "converted", "removed"), "form", "left")
    use = F.col("source").isin(list(ELIGIBLE)) & F.col("converted").isNotNull()
    return d.select("id", "idx", "original", "skeleton", F.when(use, F.col("converted")).otherwise(F.col("form")).alias("form"), F.when(use, "haser").otherwise(F.col("source")).alias("source"), "confident", "note", F.when(use, F.col("removed")).alias("removed"), F.when(use, F.col("source")).alias("from_layer"))


def assert_restorable(decisions: DataFrame) -> DataFrame:
    """decisions with an error in the form of each word whose letters, with the removed ones put back, aren't the source's."""
    places = F.transform("removed", lambda r: F.struct(r["pos"].alias("pos"), r["letter"].alias("letter")))
    bare = HEBREW.strip(F.col("form"))
    ok = F.when(F.col("removed").isNull(), bare).otherwise(restore(bare, places)) == F.col("skeleton")
    return decisions.withColumn("form", F.when(ok, F.col("form")).otherwise(F.raise_error(F.concat(F.lit("not restorable: "), F.col("original"), F.lit(" to "), F.col("form")))))


def vocalize(texts: DataFrame, res: cascade.Resources, ktiv: str = "male") -> tuple[DataFrame, DataFrame]:
    """((id, text), decisions) of texts (id, text) in full (male) or defective (haser) spelling; haser needs a lexicon with variants.

    Full spelling keeps the identity with the source; defective spelling is held to restorability instead, word by word.
    """
    if ktiv not in ("male", "haser"):
        raise ValueError(f"unknown spelling {ktiv}")
    decided = cascade.decide(texts, res, HEBREW)
    if ktiv == "male":
        return cascade.reassemble(texts, decided, HEBREW), decided
    eligible = decided.where(F.col("source").isin(list(ELIGIBLE))).select("form")
    decided = assert_restorable(apply(decided, convert(eligible, res.lexicon)))
    return cascade.reassemble(texts, decided, HEBREW, identity=False), decided
