"""Near-duplicates: MinHash bands, sequential Bayesian verification, exact confirmation, components.

1. Each text becomes the set of its distinct word shingles (64-bit hashes) and a MinHash signature; documents with equal
   sets are one class, found by a grouped minimum. Everything else goes over classes.
2. Classes that agree in a band of signature rows share a bucket. No bucket's pairs are written out: each member
   is compared with CENTERS of the bucket's classes, the least ones in as many orders (stars); sizes and centers are pre-aggregated.
3. A pair's signatures are compared batch by batch. With m of n rows equal and a uniform prior, the similarity has a Beta(m + 1, n - m + 1) posterior;
   the pair is dropped as soon as P(similarity >= threshold) = P(Binomial(n + 1, threshold) <= m) is below
   the chosen miss probability. Survivors are confirmed on the full sets.
4. In a bucket whose members have not all met in one component, each member outside the bucket's largest component is
   compared with all members, block by block (at most BLOCK x BLOCK classes a block), in the first band
   that a pair shares. So every candidate pair is either inside one component or has been compared.

Defined results: texts without words (null or empty) have an empty set and link with nothing; fewer words than a shingle are one
shingle; a class's rows share their component however often a row repeats; a null id counts as larger than any
other; extra columns are ignored (kept by keep_first()); empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import PieceTable
from .common import bound_batches, checkpointed, lower_bytes, stored
from .components import components
from .quality import binomial_tail

BLOCK = 256
BATCH = 20
#: Stars of each bucket. In a bucket of at most CENTERS + 1 classes these are usually all pairs.
CENTERS = 4
MISS = 1e-7


@dataclass(frozen=True)
class Plan:
    """words: shingle length; percent: least 100 * intersection / union; bands x rows signature rows, a multiple of BATCH."""

    words: int = 3
    percent: int = 85
    bands: int = 24
    rows: int = 5
    miss: float = MISS

    @property
    def size(self) -> int:
        return self.bands * self.rows

    @property
    def least_set(self) -> int:
        """Smaller sets can't link with another set: one element more or less already costs too much."""
        n = 1
        while 100 * n < self.percent * (n + 1):
            n += 1
        return n


#: For the stage of a pipeline: five words and 0.8 or more.
FIVE_WORDS = Plan(words=5, percent=80, bands=30, rows=4)


@lru_cache(maxsize=4)
def _multipliers(size: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_501)
    return rng.integers(1, 1 << 63, size, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, size, np.uint64)


@lru_cache(maxsize=1)
def _word_hashes() -> PieceTable[int]:
    import xxhash

    return PieceTable(lambda batch: [xxhash.xxh3_64_intdigest(w) for w in batch], 600_000)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of the lower-cased (A-Z) words."""
    w = lower_bytes((text or "").encode()).split()
    if not w:
        return np.zeros(0, np.uint64)
    h = np.array(_word_hashes().values(w), np.uint64)
    n = min(words, len(h))
    out = np.full(len(h) - n + 1, 0x9E3779B97F4A7C15 * n & (1 << 64) - 1, np.uint64)
    for k in range(n):
        out = (out ^ h[k : len(h) - n + 1 + k]) * np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def signature(hashes: np.ndarray, size: int) -> np.ndarray:
    """size minima of multiply-add-shift hashes, 32 bits each."""
    a, b = _multipliers(size)
    out = np.full(size, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(hashes), 2048):
        part = (hashes[k : k + 2048, None] * a + b) >> np.uint64(32)
        np.minimum(out, part.min(axis=0).astype(np.uint32), out=out)
    return out


def set_key(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def least_matches(plan: Plan) -> list[int]:
    """For each batch's end n: the fewest equal rows at which P(similarity >= threshold) is not below the miss probability."""
    return [next(m for m in range(n + 1) if binomial_tail(m, n + 1, plan.percent / 100) >= plan.miss) for n in range(BATCH, plan.size + 1, BATCH)]


def plausible(a: np.ndarray, b: np.ndarray, plan: Plan) -> np.ndarray:
    """Which rows of two equally long signature matrices survive all batches; later batches look at survivors only."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k, least in enumerate(least_matches(plan)):
        batch = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (a[alive, batch] == b[alive, batch]).sum(axis=1)
        alive = alive[matches[alive] >= least]
        if not len(alive):
            break
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (small + large - both)


def similar_all(a: list[np.ndarray], b: list[np.ndarray], percent: int, width: int = 8192) -> np.ndarray:
    """similar() of all pairs of two bounded lists of sets, as a matrix: intersections are products of 0/1 matrices over the shingles
    that both lists have, `width` shingles at a time."""
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    shared = np.intersect1d(flat_a, flat_b)
    row_a, row_b = (np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (a, b))
    places = []
    for flat, row in ((flat_a, row_a), (flat_b, row_b)):
        at = np.minimum(np.searchsorted(shared, flat), max(len(shared) - 1, 0))
        ok = shared[at] == flat if len(shared) else np.zeros(len(flat), bool)
        places.append((row[ok], at[ok]))
    both = np.zeros((len(a), len(b)), np.float32)
    for low in range(0, len(shared), width):
        parts = []
        for (row, at), n in zip(places, (len(a), len(b)), strict=True):
            inside = (at >= low) & (at < low + width)
            m = np.zeros((n, min(width, len(shared) - low)), np.float32)
            m[row[inside], at[inside] - low] = 1
            parts.append(m)
        both += parts[0] @ parts[1].T
    both = both.astype(np.int64)
    sizes = np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in b])
    return 100 * both >= percent * (sizes - both)


def _signed(docs: DataFrame, plan: Plan) -> DataFrame:
    """doc_id, n_shingles, node (null: empty set) and signature (null: too small to link with another set)."""

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("text")
            sizes, nodes, signatures = [], [], []
            for k in range(batch.num_rows):
                h = shingles(texts[k].as_py(), plan.words)
                sizes.append(len(h))
                nodes.append(set_key(h) if len(h) else None)
                signatures.append(signature(h, plan.size).tobytes() if len(h) >= plan.least_set else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(signatures, pa.binary())], ["doc_id", "n_shingles", "node", "signature"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, node binary, signature binary")


def _with_texts(docs: DataFrame, nodes: DataFrame, plan: Plan) -> DataFrame:
    """node, signature, text: one text for each node. Ids needn't be unique, so a text counts only if it gives the node."""

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for batch in batches:
            texts, nodes = batch.column("text"), batch.column("node")
            yield batch.filter(pa.array([set_key(shingles(texts[k].as_py(), plan.words)) == nodes[k].as_py() for k in range(batch.num_rows)], pa.bool_()))

    ids = nodes.select("node", "signature", F.col("rep").alias("rep_id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.join(ids, texts["doc_id"].eqNullSafe(ids["rep_id"])).select("node", "signature", "text")
    return found.mapInArrow(run, "node binary, signature binary, text string").dropDuplicates(["node"])


def _rows(column) -> np.ndarray:  # noqa: ANN001
    return np.stack([np.frombuffer(s.as_py(), np.uint32) for s in column]) if len(column) else np.zeros((0, 0), np.uint32)


def _pruned(pairs: DataFrame, signatures: DataFrame, plan: Plan) -> DataFrame:
    """The pairs (u, v) that sequential verification leaves."""
    a = signatures.select(F.col("node").alias("u"), F.col("signature").alias("a"))
    b = signatures.select(F.col("node").alias("v"), F.col("signature").alias("b"))

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for batch in batches:
            keep = plausible(_rows(batch.column("a")), _rows(batch.column("b")), plan) if batch.num_rows else np.zeros(0, bool)
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b").mapInArrow(run, "u binary, v binary")


def _confirmed(pairs: DataFrame, texts: DataFrame, plan: Plan) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    a = texts.select(F.col("node").alias("u"), F.col("text").alias("a"))
    b = texts.select(F.col("node").alias("v"), F.col("text").alias("b"))

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for batch in batches:
            left, right = batch.column("a"), batch.column("b")
            keep = [similar(shingles(left[k].as_py(), plan.words), shingles(right[k].as_py(), plan.words), plan.percent) for k in range(batch.num_rows)]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b").mapInArrow(run, "u binary, v binary")


def _unsettled(members: DataFrame, roots: DataFrame, texts: DataFrame, plan: Plan) -> DataFrame:
    """Links (u, v) between components that still meet in some bucket where not every pair has a center."""
    labelled = checkpointed(members.where(F.col("n") > F.size("centers") + 1).join(roots.withColumnRenamed("node", "v"), "v", "left").select("bucket", "band", "centers", "n", "v", F.coalesce("root", "v").alias("root")))
    counts = labelled.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("k"))
    mixed = counts.groupBy("bucket").agg(F.max(F.struct("k", "root")).alias("most"), F.sum("k").alias("n")).where("most.k < n").select("bucket", F.col("most.root").alias("main"), (F.col("n") - F.col("most.k")).alias("others"))
    open_members = labelled.join(mixed, "bucket").join(texts.withColumnRenamed("node", "v"), "v")
    # A member outside the main component asks all blocks of members; blocks are dealt by hash.
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    askers = F.ceil(F.col("others") / BLOCK).cast("int")
    of = lambda n: F.pmod(F.xxhash64("v"), n).cast("int")
    asking = open_members.where("root != main").select("bucket", "band", "centers", "v", "root", "signature", "text", of(askers).alias("asker"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(True).alias("asks"))
    asked = open_members.select("bucket", "band", "centers", "v", "root", "signature", "text", F.explode(F.sequence(F.lit(0), askers - 1)).alias("asker"), of(blocks).alias("block"), F.lit(False).alias("asks"))

    def compare(rows):  # noqa: ANN001, ANN202
        import pyarrow as pa
        import pyarrow.compute  # noqa: F401

        asks = rows.column("asks")
        ask, all_ = rows.filter(asks), rows.filter(pa.compute.invert(asks))
        found: list[tuple[bytes, bytes]] = []
        if len(ask) and len(all_):
            band, centers = rows.column("band")[0].as_py(), set(rows.column("centers")[0].as_py())
            sa, sb = (_rows(x.column("signature")) for x in (ask, all_))
            va, vb, ra, rb, ta, tb = (x.column(c).to_pylist() for c in ("v", "root", "text") for x in (ask, all_))
            number = {r: k for k, r in enumerate({*ra, *rb})}
            na, nb = np.array([number[r] for r in ra]), np.array([number[r] for r in rb])
            open_ = (na[:, None] != nb) & np.array([v not in centers for v in va])[:, None] & np.array([v not in centers for v in vb])
            for i in range(len(va)):
                rest = np.flatnonzero(open_[i])
                if band and len(rest):  # pairs that met in an earlier band were compared there
                    met = (sb[rest, : band * plan.rows] == sa[i, : band * plan.rows]).reshape(len(rest), band, plan.rows).all(axis=2).any(axis=1)
                    rest = rest[~met]
                open_[i] = False
                if len(rest):
                    open_[i, rest[plausible(np.broadcast_to(sa[i], (len(rest), plan.size)), sb[rest], plan)]] = True
            ia, ib = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
            if len(ia):
                linked = open_[np.ix_(ia, ib)] & similar_all([shingles(ta[i], plan.words) for i in ia], [shingles(tb[j], plan.words) for j in ib], plan.percent)
                top = list(range(len(number)))
                for i, j in np.argwhere(linked):  # one link for each pair of components that meet is enough
                    x, y = na[ia[i]], nb[ib[j]]
                    while top[x] != x:
                        x = top[x]
                    while top[y] != y:
                        y = top[y]
                    if x != y:
                        top[x] = y
                        found.append((va[ia[i]], vb[ib[j]]))
        return pa.table({"u": pa.array([u for u, _ in found], pa.binary()), "v": pa.array([v for _, v in found], pa.binary())})

    spread = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # small rows, much work: not to be coalesced
    return asking.unionByName(asked).repartition(spread, "bucket", "asker", "block").groupBy("bucket", "asker", "block").applyInArrow(compare, "u binary, v binary")


def link(docs: DataFrame, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, node) of every row, and (node, root) of every linked node."""
    bound_batches(docs.sparkSession)
    signed = checkpointed(_signed(docs, plan))
    classes = signed.where("signature is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"))
    width = 4 * plan.rows
    bands = F.transform(F.sequence(F.lit(0), F.lit(plan.bands - 1)), lambda k: F.struct(k.alias("band"), F.xxhash64(k, F.substring("signature", k * width + 1, F.lit(width))).alias("bucket")))
    rows = classes.select("node", F.explode(bands).alias("b")).select("b.bucket", "b.band", F.col("node").alias("v"))
    # Buckets of one class, nearly all of them, go before anything but a count is gathered.
    counts = rows.groupBy("bucket", "band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = checkpointed(rows.join(counts, ["bucket", "band"]))
    centers = F.array_distinct(F.array(F.min("v"), *(F.min_by("v", F.xxhash64("v", F.lit(k))) for k in range(1, CENTERS))))
    members = checkpointed(shared.join(shared.groupBy("bucket", "band").agg(centers.alias("centers")), ["bucket", "band"]))
    candidates = stored(_with_texts(docs, members.select("v").distinct().join(classes.withColumnRenamed("node", "v"), "v").withColumnRenamed("v", "node"), plan))
    signatures, texts = candidates.select("node", "signature"), candidates.select("node", "text")
    pairs = members.select(F.explode("centers").alias("u"), "v").where("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    roots = components(_confirmed(_pruned(pairs, signatures, plan), texts, plan))
    more = checkpointed(_unsettled(members, roots, candidates, plan))
    if not more.isEmpty():
        roots = components(roots.toDF("u", "v").union(more))
    return signed.select("doc_id", "n_shingles", "node"), roots


def near_duplicates(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:  # noqa: B008
    """doc_id, n_shingles, component_id, kept (doc_id = component_id), class_rows (rows with an equal set)."""
    signed, roots = link(docs, plan)
    classes = signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("class_rows"))
    rooted = classes.join(roots, "node", "left").select("node", "rep", "class_rows", "root")
    least = rooted.where("root is not null").groupBy("root").agg(F.min("rep").alias("component"))
    ids = rooted.join(least, "root", "left").select("node", "class_rows", F.coalesce("component", "rep").alias("component"))
    out = signed.join(ids, "node", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), F.coalesce("class_rows", F.lit(1)).alias("class_rows"))
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"), "class_rows")


def keep_first(docs: DataFrame, plan: Plan) -> DataFrame:
    """The rows of docs whose id is the least of their component, one row of each component, with all their columns.

    A text without words is no duplicate of anything and stays. Rows are told apart by id and set, so where an id
    repeats, one of its rows with the component's least id stays. Null ids come last.
    """
    signed, roots = link(docs, plan)
    classes = signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"))
    # The class with the least id stands for its component; ties by set.
    first = classes.join(roots, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root")).groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("last"), "rep", "node")).alias("f")).select("f.rep", "f.node")
    return _first_rows(docs, checkpointed(first), plan)


def _first_rows(docs: DataFrame, first: DataFrame, plan: Plan) -> DataFrame:
    from pyspark.sql.types import BinaryType

    columns = docs.columns
    node = "_glyphmill_node"

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("text")
            sets = [shingles(texts[k].as_py(), plan.words) for k in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([set_key(h) if len(h) else None for h in sets], pa.binary())], [*batch.schema.names, node])

    rows = docs.mapInArrow(run, type(docs.schema)([*docs.schema.fields]).add(node, BinaryType()))
    empty = rows.where(f"{node} is null").select(*columns)
    chosen = first.select(F.col("rep").alias("_glyphmill_rep"), F.col("node").alias("_glyphmill_first"))
    # Rows of one class with the least id: usually one; repeats of it are dropped where they meet.
    kept = rows.join(chosen, (rows[node] == chosen["_glyphmill_first"]) & rows["doc_id"].cast("long").eqNullSafe(chosen["_glyphmill_rep"])).select(*columns, node)
    return empty.unionByName(kept.dropDuplicates([node]).select(*columns))
