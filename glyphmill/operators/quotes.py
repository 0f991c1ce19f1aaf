"""Quotation index and matching: exact n-grams of skeletons, extended forward, chosen greedily from the left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N = 4


def _ngrams(skeletons: Column) -> Column:
    return F.when(F.size(skeletons) >= N, F.transform(F.sequence(F.lit(1), F.size(skeletons) - N + 1), lambda i: F.array_join(F.slice(skeletons, i, N), " ")))


def spans(rows: DataFrame, forms: Column, skeletons: Column, key: str) -> DataFrame:
    """(span_id, forms, skeletons) of the sources that are long enough to be quoted."""
    return rows.select(F.col(key).alias("span_id"), forms.alias("forms"), skeletons.alias("skeletons")).where(F.size("skeletons") >= N)


def index(source: DataFrame) -> DataFrame:
    """(key, span_id, off) of each n-gram's first place, without those that occur in different forms."""
    grams = source.select("span_id", F.col("forms"), F.posexplode(_ngrams(F.col("skeletons"))).alias("off", "key"))
    grams = grams.select("key", "span_id", "off", F.array_join(F.slice("forms", F.col("off") + 1, N), " ").alias("f"))
    by = grams.groupBy("key").agg(F.min("f").alias("lo"), F.max("f").alias("hi"), F.min(F.struct("span_id", "off")).alias("at"))
    return by.where("lo = hi").select("key", "at.span_id", "at.off")


def collisions(source: DataFrame) -> DataFrame:
    grams = source.select("forms", F.posexplode(_ngrams(F.col("skeletons"))).alias("off", "key")).select("key", F.array_join(F.slice("forms", F.col("off") + 1, N), " ").alias("f"))
    return grams.groupBy("key").agg(F.count_distinct("f").alias("n_forms")).where("n_forms > 1")


def hits(queries: DataFrame, idx: DataFrame) -> DataFrame:
    """(id, i, span_id, off): where a query's n-gram is in the index. An equi-join on the n-gram text, so hash collisions can't matter."""
    grams = queries.select("id", F.posexplode(_ngrams(F.col("skeletons"))).alias("i", "key"))
    return grams.join(idx, "key").select("id", "i", "span_id", "off")


def matches(queries: DataFrame, idx: DataFrame, source: DataFrame) -> DataFrame:
    """(id, start, end, span_id, off): greedy from the left; each match runs on while skeletons agree.

    A run of hits on one diagonal (span, off - i) carries a match forward; dropped n-grams inside it don't stop it, so the run is measured on
    the skeletons themselves. Only queries with hits meet the source.
    """
    found = hits(queries, idx)
    src = source.select("span_id", F.col("skeletons").alias("source"))
    measured = found.join(src, "span_id").join(queries.select("id", F.col("skeletons").alias("query")), "id")
    rest = F.zip_with(F.slice("query", F.col("i") + N + 1, F.size("query")), F.slice("source", F.col("off") + N + 1, F.size("source")), lambda a, b: ~a.eqNullSafe(b))
    stop = F.array_position(rest, True).cast("int")
    run = N + F.when(stop == 0, F.size(rest)).otherwise(stop - 1)
    cand = measured.select("id", "i", "span_id", "off", run.alias("run"))
    empty = F.array().cast("array<struct<start:int,end:int,span_id:bigint,off:int>>")

    def step(a: Column, c: Column) -> Column:
        take = c["i"] >= a["next"]
        item = F.struct(c["i"].alias("start"), (c["i"] + c["run"]).alias("end"), c["span_id"].cast("bigint").alias("span_id"), c["off"].alias("off"))
        return F.struct(F.when(take, c["i"] + c["run"]).otherwise(a["next"]).alias("next"), F.when(take, F.concat(a["out"], F.array(item))).otherwise(a["out"]).alias("out"))

    ordered = cand.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("i", "span_id", "off", "run"))).alias("c"))
    chosen = ordered.select("id", F.explode(F.aggregate("c", F.struct(F.lit(0).alias("next"), empty.alias("out")), step, lambda a: a["out"])).alias("m"))
    return chosen.select("id", "m.*")


def quoted_tokens(found: DataFrame, source: DataFrame) -> DataFrame:
    """(id, idx, form, span_id): the source's form for each token inside a match."""
    rows = found.join(source.select("span_id", "forms"), "span_id")
    return rows.select("id", "span_id", F.posexplode(F.slice("forms", F.col("off") + 1, F.col("end") - F.col("start"))).alias("k", "form"), "start").select("id", (F.col("start") + F.col("k")).alias("idx"), "form", "span_id")
