"""Forms by skeleton: counts, categories, bigrams, preferred layers, names, review queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import NAME_TRIGGERS
from ..sources.store import stored

RATIO, LEAST, BIGRAM_LEAST, BIGRAM_RATIO, VARIANTS, REVIEW_ROWS = 0.98, 3, 2, 0.80, 6, 5000
RABBINIC = ("mishnaic", "aramaic", "liturgy")


def _best(*order: Column) -> Column:
    return F.min_by("form", F.struct(-F.col("n"), *order))


def _place(place: tuple[str, ...]) -> Column:
    """Where a token stands in scan order. One long column keeps the aggregation a hash aggregation; several are compared in turn."""
    return F.col(place[0]) if len(place) == 1 else F.struct(*place)


def pair_counts(tokens: DataFrame, *place: str, layers: tuple[str, ...] = ()) -> DataFrame:
    """(prev, skeleton, form, n, first, n_inside, first_inside): the one pass over tokens; everything else sums these up.

    first is the least place in scan order, which breaks ties; the last two count the given layers only.
    """
    inside = F.col("layer").isin(list(layers)) if layers else F.lit(False)
    at = _place(place)
    return tokens.where(~F.col("acronym")).groupBy("prev", "skeleton", "form").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first"), F.count_if(inside).alias("n_inside"), F.min(F.when(inside, at)).alias("first_inside"))


def counts_of(pairs: DataFrame) -> DataFrame:
    """(skeleton, form, n, first, n_inside, first_inside)."""
    return pairs.groupBy("skeleton", "form").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.sum("n_inside").alias("n_inside"), F.min("first_inside").alias("first_inside"))


def decisions_of(pairs: DataFrame) -> DataFrame:
    """(prev, skeleton, form): pairs seen often enough in which one form has its share."""
    decided = pairs.groupBy("prev", "skeleton").agg(F.sum("n").alias("total"), F.max("n").alias("most"), _best(F.col("first")).alias("form"))
    return decided.where((F.col("total") >= BIGRAM_LEAST) & (F.col("most") / F.col("total") >= BIGRAM_RATIO)).select("prev", "skeleton", "form")


def form_counts(tokens: DataFrame, *place: str) -> DataFrame:
    """(skeleton, form, n, first) alone."""
    return tokens.where(~F.col("acronym")).groupBy("skeleton", "form").agg(F.count(F.lit(1)).alias("n"), F.min(_place(place)).alias("first"))


def bigram_decisions(tokens: DataFrame, *place: str) -> DataFrame:
    return decisions_of(pair_counts(tokens, *place))


def entries(counts: DataFrame, decisions: DataFrame, least: int = 1) -> DataFrame:
    """(skeleton, category, best, count, ratio, variants, first): first is the skeleton's least place, which breaks ties of count."""
    by = counts.groupBy("skeleton").agg(F.sum("n").alias("count"), F.max("n").alias("most"), F.min("first").alias("first"), _best(F.col("first")).alias("best"), F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "first", "form"))).alias("v"))
    by = by.where(F.col("count") >= least).withColumn("ratio", F.col("most") / F.col("count"))
    resolvable = decisions.select("skeleton").distinct().withColumn("resolvable", F.lit(True))
    category = F.when((F.col("ratio") >= RATIO) & (F.col("count") >= LEAST), "unambiguous").when(F.coalesce("resolvable", F.lit(False)), "context").otherwise("ambiguous")
    variants = F.transform(F.slice("v", 1, VARIANTS), lambda x: F.struct(x["form"].alias("form"), (-x["k"]).alias("n")))
    return by.join(resolvable, "skeleton", "left").select("skeleton", category.alias("category"), "best", "count", "ratio", variants.alias("variants"), "first")


def preferred_of(counts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(skeleton, rabbinic): the form of the counted layers where it is decisive there and not the overall best."""
    inside = counts.where("n_inside > 0").select("skeleton", "form", F.col("n_inside").alias("n"), F.col("first_inside").alias("first"))
    by = inside.groupBy("skeleton").agg(F.sum("n").alias("total"), F.max("n").alias("most"), _best(F.col("first")).alias("form"))
    by = by.where((F.col("total") >= LEAST) & (F.col("most") / F.col("total") >= RATIO))
    return by.join(lexicon.select("skeleton", "best"), "skeleton").where("form != best").select("skeleton", F.col("form").alias("rabbinic"))


def build(tokens: DataFrame, *place: str, layers: tuple[str, ...] = RABBINIC, least: int = 1) -> tuple[DataFrame, DataFrame]:
    """(lexicon, bigrams): the bigrams whose target isn't unambiguous. Counts and decisions sum up the same pairs, which are stored, so tokens are read and grouped once."""
    pairs = stored(pair_counts(tokens, *place, layers=layers))
    counts, decisions = counts_of(pairs), decisions_of(pairs)
    lex = entries(counts, decisions, least)
    lex = stored(lex.join(preferred_of(counts, lex), "skeleton", "left"))
    bigrams = decisions.join(lex.where("category != 'unambiguous'").select("skeleton"), "skeleton", "left_semi")
    return lex, bigrams.select("prev", "skeleton", "form")


def most_common(lexicon: DataFrame) -> DataFrame:
    return lexicon.select("skeleton", F.coalesce("rabbinic", "best").alias("form"), "category")


def names(tokens: DataFrame, triggers: list[str] | None = None, least: int = 2) -> DataFrame:
    """(skeleton): words behind a name trigger often enough."""
    triggers = triggers or NAME_TRIGGERS
    return tokens.where(F.col("prev").isin(triggers) & ~F.col("skeleton").isin(triggers)).groupBy("skeleton").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def review_queue(lexicon: DataFrame, rows: int = REVIEW_ROWS) -> DataFrame:
    """The ambiguous entries with the most occurrences; of equal ones those seen first."""
    return lexicon.where("category = 'ambiguous'").orderBy(F.desc("count"), "first", "skeleton").limit(rows).select("skeleton", "count", "variants")


def homograph_skeletons(lexicon: DataFrame) -> DataFrame:
    return lexicon.where("category != 'unambiguous'").select("skeleton")


def layer_sizes(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("layer").agg(F.count_distinct("skeleton").alias("skeletons"), F.count(F.lit(1)).alias("tokens"))
