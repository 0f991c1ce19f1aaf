"""Sharding by weighted rendezvous hashing, in DataFrame functions only.

Each record key draws a number for every shard, from a hash of key and shard; with weight w the draw u
in (0, 1) counts as -ln(u) / w, and the least wins. A shard that is added only takes the keys whose least draw is now its own, a share
of weight / total weight, and no key moves between old shards.

Slots number each shard's rows without gaps. No shard is ever sorted as one group: rows are numbered inside
(shard, cell), with 4096 cells by a hash of key and text, and a table of shard x cell counts gives each cell's first slot.

Defined results: a null key is the empty key; a null text has 0 bytes and crc32 0; rows with one key share a
shard and have slots of their own; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A row beside its text's bytes.
ROW_BYTES = 16


def draw(key: Column, shard: Column) -> Column:
    """A number in (0, 1) that depends on key and shard alone: the first 13 hex digits of an MD5."""
    digits = F.substring(F.md5(F.concat(key, F.lit(":"), shard.cast("string")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def bid(key: Column, shard: Column, weight: Column) -> Column:
    return -F.log(draw(key, shard)) / weight


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """struct(bid, shard) of the least weighted draw, the lower number if draws tie. Shards of weight 0 get nothing.

    One lambda over the shards instead of an expression for each: code generated for forty of them takes gigabytes to compile.
    """
    if any(w < 0 for w in weights) or not any(weights):
        raise ValueError("weights must not be negative, and one must be positive")
    places = F.array(*[F.struct(F.lit(k).alias("shard"), F.lit(float(w)).alias("weight")) for k, w in enumerate(weights) if w])
    return F.array_min(F.transform(places, lambda s: F.struct(bid(key, s["shard"], s["weight"]).alias("bid"), s["shard"].alias("shard"))))


def shards(docs: DataFrame, weights: Sequence[float] = (1.0,) * 40) -> DataFrame:
    """doc_id (the key), size, text_crc32, law ("key"), shard, slot, and grown_shard: the shard with one more shard of mean weight.

    Texts are read once and never shuffled. Whole rows that repeat meet as one row with a count, so a key with a
    third of all rows is no hot group; its distinct texts lie in different cells.
    """
    positive = [w for w in weights if w]
    new, new_weight = len(weights), sum(positive) / len(positive)
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    placed = (
        docs.select("doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
        .groupBy("doc_id", "size", "text_crc32")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("won", rendezvous(key, weights))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "copies",
            F.col("won.shard").alias("shard"),
            F.when(bid(key, F.lit(new), F.lit(float(new_weight))) < F.col("won.bid"), new).otherwise(F.col("won.shard")).alias("grown_shard"),
            F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), F.col("text_crc32").cast("string"), F.lit(":cell")).cast("binary")), 1, 3), 16, 10).cast("int").alias("cell"),
        )
    )
    order = Window.partitionBy("shard", "cell").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    inside = placed.withColumn("before", F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    # At most shards x 4096 rows, whatever the input.
    firsts = placed.groupBy("shard", "cell").agg(F.sum("copies").alias("rows"))
    firsts = firsts.select("shard", "cell", F.coalesce(F.sum("rows").over(Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    slot = F.col("first") + F.coalesce("before", F.lit(0))
    return (
        inside.join(firsts, ["shard", "cell"])
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.explode(F.sequence(slot, slot + F.col("copies") - 1)).alias("slot"), "grown_shard")
    )


#: DuckDB: the whole of shards() with 40 equal weights. crc32 goes over each text's bytes with the reflected polynomial 0xEDB88320.
ORACLE_SQL = """
with crc(t) as (
  select list(c order by i) from (
    select i, list_reduce(list_prepend(i::bigint, [1, 2, 3, 4, 5, 6, 7, 8]), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c from range(256) r(i))
), base as (
  select doc_id, coalesce(text, '') as text, coalesce(doc_id::varchar, '') as k, hex(encode(coalesce(text, ''))) as h from documents
), rows_ as (
  select doc_id, k, strlen(text) + 16 as size,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, length(h) // 2), lambda i: ('0x' || array_slice(h, 2 * i + 1, 2 * i + 2))::bigint)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as text_crc32
  from base, crc
), bids as (
  select k, s, -ln((('0x' || substr(md5(k || ':' || s), 1, 13))::bigint::double + 0.5) / 4503599627370496.0) / 1.0 as bid from (select distinct k from base), range(41) r(s)
), won as (
  select k, arg_min(s, bid) filter (s < 40) as shard, arg_min(s, bid) as grown_shard from bids group by k
)
select doc_id, size, text_crc32, 'key' as law, shard::int as shard,
  row_number() over (partition by shard order by ('0x' || substr(md5(k || ':' || text_crc32 || ':cell'), 1, 3))::int, doc_id nulls first, text_crc32, size) - 1 as slot, grown_shard::int as grown_shard
from rows_ join won using (k)
"""
