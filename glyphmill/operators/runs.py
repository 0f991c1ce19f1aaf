"""Giving a text's new form back to the runs of a document, and batches of like lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clusters
from ..profile import HEBREW


def redistribute(runs: Column, output: Column) -> Column:
    """array<string>: each run gets the clusters of output for as many characters as its stripped text has; no cluster is lost."""
    c = clusters(output)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, r: Column) -> Column:
        n = F.length(HEBREW.strip(r))
        last = F.size(a["out"]) == F.size(runs) - 1
        take = F.when(last, F.greatest(F.size(c) - a["at"], F.lit(0))).otherwise(n)
        return F.struct((a["at"] + take).alias("at"), F.concat(a["out"], F.array(F.array_join(F.slice(c, a["at"] + 1, take), ""))).alias("out"))

    return F.aggregate(runs, start, step, lambda a: a["out"])


def redistribute_segments(runs: Column, segments: Column) -> Column:
    """array<string>: whole segments (source, output) go to the run in which their source starts."""
    length = lambda t: F.length(HEBREW.strip(t))
    starts = F.aggregate(segments, F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,out:string>>").alias("v")), lambda a, s: F.struct((a["at"] + length(s["source"])).alias("at"), F.concat(a["v"], F.array(F.struct(a["at"].alias("at"), s["output"].alias("out")))).alias("v")), lambda a: a["v"])
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, r: Column) -> Column:
        low, high = a["at"], a["at"] + length(r)
        last = F.size(a["out"]) == F.size(runs) - 1
        mine = F.filter(starts, lambda s: (s["at"] >= low) & ((s["at"] < high) | last))
        return F.struct(high.alias("at"), F.concat(a["out"], F.array(F.array_join(F.transform(mine, lambda s: s["out"]), ""))).alias("out"))

    return F.aggregate(runs, begin, step, lambda a: a["out"])


def length_batches(rows: DataFrame, text: str, size: int, cells: int = 64) -> DataFrame:
    """rows with batch: neighbours by length, `size` each, numbered inside length cells so that no sort is global."""
    n = F.length(text)
    cell = F.conv(F.substring(F.md5(F.col(text).cast("binary")), 1, 4), 16, 10).cast("int") % cells
    order = Window.partitionBy("cell").orderBy("len", text)
    out = rows.withColumn("len", n).withColumn("cell", cell.cast("int")).withColumn("k", F.floor((F.row_number().over(order) - 1) / size))
    return out.withColumn("batch", F.concat_ws("-", "cell", F.col("k").cast("string"))).drop("k")


def padded(labels: Column, width: Column, ignore: int = -100) -> Column:
    return F.concat(labels, F.array_repeat(F.lit(ignore), F.greatest(width - F.size(labels), F.lit(0))))


def with_replay(train: DataFrame, replay: DataFrame, share: float) -> DataFrame:
    """train with about `share` times as many replay rows, repeated in turn where there are too few."""
    n, m = train.count(), replay.count()
    want = int(n * share)
    if not want or not m:
        return train
    copies = -(-want // m)
    rows = replay.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return train.unionByName(rows.orderBy("_copy", F.xxhash64(*replay.columns)).limit(want).drop("_copy").select(*train.columns))


def seeded_sample(rows: DataFrame, share: float, seed: int) -> DataFrame:
    """max(1, share of all) rows by seeded hash."""
    return rows.orderBy(F.xxhash64(F.lit(seed), *rows.columns)).limit(max(1, int(rows.count() * share)))
