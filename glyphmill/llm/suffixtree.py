"""Language-model scoring by a probabilistic suffix tree over words.

Symbols are the lower-cased (A-Z) words of a text and one end symbol behind them. The root holds the additive estimate of every training word,
known or not. A context of one or more words that occurs at least LEAST_CONTEXT times becomes a state if its suffix is one (or the root) and its next
symbols diverge from those of the suffix by more than they cost to store: a pair (context, next) is kept if it occurs twice and its count times the
log ratio of both estimates is at least ln N, and a context if the sum over its kept pairs, less what its other symbols lose, is at least ln N too.
Contexts grow by a word as long as any state of the last length was kept. Next-symbol distributions are smoothed by absolute discounting:
P(w|s) = (c(s, w) - D) / c(s) for kept pairs, plus what is left over times P(w | suffix of s). A text is scored with the longest suffix state at each place.

Texts are read once: neighbouring rows become a group of a few million words, stored as the group's distinct words (64-bit hashes) and a code for each
place. Training rows and others are in groups of their own, so that counting reads only the former. Everything later works on groups. Word counts, contexts, states and pairs are tables keyed by 64-bit hashes, so nothing of the tree is bounded or
dropped at any size. To score, each group asks a joined table for the distinct keys that it holds. Two broadcast things decide nothing but speed: the
CACHE keys that occur most often with their values, and a Bloom filter of all keys, which spares questions about what the tree doesn't have.

Defined results: a null or empty text is the end symbol alone; with no training rows N is 0 and every word has probability 1; a null id counts
as training (its fold is 0); repeated rows are scored each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, fold, release, remove, stored, stored_by

FOLDS, HELD_OUT = 5, 1
CACHE = 1_000_000
LEAST_CONTEXT = 8
FILTER_BITS = 28
#: Of the filter of the last length's pairs, which only spares sending pairs that occur once.
SEEN_BITS = 26
#: Up to this length all frequent contexts are followed, as they begin longer ones; beyond it those behind a state.
CHAIN = 3
DISCOUNT = 0.75
GROUP_CHARS = 4_000_000
PART_PLACES = 2_000_000
#: A context's hash is the polynomial of its words' hashes with this base modulo 2^64; the last word has power 0.
POWER = np.int64(-7046029254386353131)
#: Keys of words and of pairs in the joined table; a state's key is its context's hash.
WORD, PAIR = np.int64(0x5851F42D4C957F2D), np.int64(0x14057B7EF767814F)


def word_hash(word: bytes) -> int:
    """A signed 64-bit hash; the end symbol is the empty word, which no text has."""
    out = xxhash.xxh3_64_intdigest(word)
    return out - (1 << 64) if out >> 63 else out


END = word_hash(b"")
#: Longer words are hashed one by one, shorter ones together.
LONG_WORD = 64


def _mixed(keys: np.ndarray) -> np.ndarray:
    """Each key of 64 bits goes to another one, and each of its bits changes all of them (the finalizer of MurmurHash3)."""
    keys = (keys ^ keys >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    keys = (keys ^ keys >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return keys ^ keys >> np.uint64(33)


def word_hashes(words) -> np.ndarray:  # noqa: ANN001
    """Signed 64-bit hashes of an Arrow array of binary words, by eight bytes at a time of all words; words of one length up to eight bytes never clash."""
    if not len(words):
        return np.zeros(0, np.int64)
    offsets = np.frombuffer(words.buffers()[1], "<i4")[words.offset : words.offset + len(words) + 1].astype(np.int64)
    start, size = offsets[:-1], np.diff(offsets)
    data = np.zeros(offsets[-1] + 8, np.uint8)
    data[: offsets[-1]] = np.frombuffer(words.buffers()[2] or b"", np.uint8)[: offsets[-1]]
    eight = np.ndarray(offsets[-1] + 1, "<u8", data, strides=(1,))
    out = _mixed(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    for k in range(0, LONG_WORD, 8):
        at = np.flatnonzero(size > k)
        if not len(at):
            break
        bits = np.minimum(size[at] - k, 8).astype(np.uint64) << np.uint64(3)
        out[at] = _mixed(out[at] ^ eight[start[at] + k] & np.uint64(0xFFFFFFFFFFFFFFFF) >> np.uint64(64) - bits)
    out = out.view(np.int64)
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = word_hash(data[start[i] : offsets[i + 1]].tobytes())
    return out


def distinct(keys: np.ndarray) -> np.ndarray:
    """The distinct keys in order; np.unique's hash table takes more than ten times as long."""
    keys = np.sort(keys)
    return keys[np.r_[True, keys[1:] != keys[:-1]][: len(keys)]]


def _masks() -> np.ndarray:
    """2^14 words of 64 bits, of which up to three are set."""
    x = _mixed(np.arange(1, (1 << 14) + 1, dtype=np.uint64))
    one, low = np.uint64(1), np.uint64(63)
    return one << (x & low) | one << (x >> np.uint64(6) & low) | one << (x >> np.uint64(12) & low)


MASKS = _masks()


class Filter:
    """A Bloom filter of three bits a key, all in one word of 64 bits, so that a look costs one place of memory."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    @staticmethod
    def places(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The word of each key in a filter of 2^size bits, and the key's bits in it. Keys are hashes, so their low bits serve as they are."""
        mixed = keys.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return (mixed >> np.uint64(70 - size)).view(np.int64), MASKS.take(keys & np.int64(len(MASKS) - 1), mode="clip")

    @classmethod
    def of(cls, keys: DataFrame, n: int, most: int = 64) -> Filter:
        """Of n keys, one column of longs or the two of pairs, 2^FILTER_BITS or 2^most bits at most; built in tasks, of which a few partial filters reach the driver one by one."""
        size = min(FILTER_BITS, most, max(16, (16 * n).bit_length()))

        def run(batches):  # noqa: ANN001, ANN202
            import pyarrow as pa

            words = np.zeros(1 << size - 6, np.uint64)
            for batch in batches:
                key, *nxt = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                at, bits = cls.places(key * POWER + nxt[0] if nxt else key, size)
                np.bitwise_or.at(words, at, bits)
            yield pa.RecordBatch.from_arrays([pa.array([words.tobytes()], pa.binary())], ["bits"])

        out = np.zeros(1 << size - 6, np.uint64)
        for row in keys.coalesce(4).mapInArrow(run, "bits binary").toLocalIterator():
            out |= np.frombuffer(row[0], np.uint64)
        return cls(out)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at, bits = self.places(keys, len(self.words).bit_length() + 5)
        return self.words.take(at, mode="clip") & bits == bits


class Values:
    """Distinct keys with their values, in an open hash table of more than two slots a key."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        size = max(2, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - size), np.int64((1 << size) - 1)
        self.keys, self.values = np.zeros(1 << size, np.int64), np.full(1 << size, np.nan)
        at, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = np.isnan(self.values[at[left]])
            put = left[free]
            self.keys[at[put]], self.values[at[put]] = keys[put], values[put]
            left = np.concatenate([left[~free], put[self.keys[at[put]] != keys[put]]])
            at[left] = at[left] + 1 & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """NaN where a key is missing."""
        at = self._slots(keys)
        out = self.values.take(at, mode="clip")
        left = np.flatnonzero(self.keys.take(at, mode="clip") != keys)
        left = left[~np.isnan(out[left])]
        keys, at = keys[left], at[left]
        while len(left):
            at = at + 1 & self.mask
            value = out[left] = self.values.take(at, mode="clip")
            other = np.flatnonzero((self.keys.take(at, mode="clip") != keys) & ~np.isnan(value))
            left, keys, at = left[other], keys[other], at[other]
        return out


class Group:
    """Some neighbouring texts, all for training or none: hash of each place's word, and the texts' ids and lengths (with the end symbol)."""

    def __init__(self, row: dict) -> None:
        self.number, self.ids = row["group"], row["ids"]
        self.train = row["train"]
        self.sizes = np.frombuffer(row["sizes"], "<i8")
        self.words = np.frombuffer(row["words"], "<i8")
        self.codes = np.frombuffer(row["low"], "<u2") | np.frombuffer(row["high"], "<u2").astype(np.uint32) << np.uint32(16)
        self.hashes = self.words[self.codes]

    def behind(self, least: int) -> np.ndarray:
        """Whether each place has `least` words before it in its text."""
        out = np.ones(len(self.codes), bool)
        starts, sizes = np.cumsum(self.sizes) - self.sizes, self.sizes
        for k in range(least):
            starts, sizes = starts[sizes > k], sizes[sizes > k]
            out[starts + k] = False
        return out

    def contexts(self, most: int):  # noqa: ANN201
        """For each length up to `most`: the hash of the words before each place (where its text has that many)."""
        out, power = np.zeros(len(self.hashes), np.int64), np.ones(1, np.int64)
        for depth in range(1, most + 1):
            out[depth:] += self.hashes[:-depth] * power
            power = power * POWER
            yield out

    def ends(self, *lengths: int) -> list[np.ndarray]:
        """contexts() of some lengths, in ascending order."""
        return [c.copy() for n, c in enumerate(self.contexts(lengths[-1]), 1) for x in lengths if x == n]


GROUP_SCHEMA = "group long, ids array<long>, train boolean, sizes binary, words binary, low binary, high binary"


def _pack(number: int, parts: list):  # noqa: ANN202
    """One row of GROUP_SCHEMA from Arrow batches of doc_id, text, train."""
    import pyarrow as pa
    import pyarrow.compute as pc

    table = pa.Table.from_batches(parts).combine_chunks()
    texts = pc.ascii_lower(pc.fill_null(table["text"].combine_chunks(), ""))
    lists = pc.ascii_split_whitespace(texts)  # at exactly space and U+0009 to U+000D
    offsets = lists.offsets.to_numpy()
    coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    flat = coded.indices.to_numpy()
    real = flat != pc.index(coded.dictionary, "").as_py()  # white space at a text's ends leaves empty strings
    before = np.concatenate([[0], np.cumsum(real)])
    sizes = np.diff(before[offsets - offsets[0]]).astype("<i8")
    words = np.r_[word_hashes(coded.dictionary.cast(pa.binary())), END]
    codes = np.full(before[-1] + len(sizes), len(words) - 1, np.uint32)
    inner = np.ones(len(codes), bool)
    inner[np.cumsum(sizes + 1) - 1] = False
    codes[inner] = flat[real]
    blob = lambda a: pa.array([a.tobytes()], pa.binary())
    ids = pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), table["doc_id"].combine_chunks())
    train = table["train"].combine_chunks()[:1]
    values = [pa.array([number], pa.int64()), ids, train, blob(sizes + 1), blob(words.astype("<i8")), blob(codes.astype("<u2")), blob((codes >> np.uint32(16)).astype("<u2"))]
    return pa.RecordBatch.from_arrays(values, ["group", "ids", "train", "sizes", "words", "low", "high"])


def groups_of(docs: DataFrame) -> DataFrame:
    """The texts as groups, stored. Two byte planes of the codes compress better than one; codes have 32 bits."""
    bound_batches(docs.sparkSession, "8m")

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow.compute as pc
        from pyspark import TaskContext

        number, held = TaskContext.get().partitionId() << 32, {True: [], False: []}
        for batch in batches:
            train = batch.column("train")
            for kind, rows in ((True, batch.filter(train)), (False, batch.filter(pc.invert(train)))):
                held[kind].append(rows)
                if sum(b.column("text").nbytes for b in held[kind]) >= GROUP_CHARS:
                    yield _pack(number, held[kind])
                    number, held[kind] = number + 1, []
        for parts in held.values():
            if sum(b.num_rows for b in parts):
                yield _pack(number, parts)
                number += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (fold(F.col("doc_id"), FOLDS) != HELD_OUT).alias("train"))
    return stored_by(rows.mapInArrow(run, GROUP_SCHEMA), "train")


def _each(batches):  # noqa: ANN001, ANN202
    for batch in batches:
        for k in range(batch.num_rows):
            yield Group({n: batch.column(n)[k].values if n == "ids" else batch.column(n)[k].as_py() for n in ("group", "ids", "train", "sizes", "words", "low", "high")})


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The hash class of each key."""
    out = (keys.view(np.uint64) * np.uint64(0xA0761D6478BD642F) >> np.uint64(33)) % np.uint64(parts)
    return out.astype(np.uint16 if parts <= 1 << 16 else np.uint32)


def _dealt(part: np.ndarray, parts: int, *columns: np.ndarray):  # noqa: ANN202
    """(part, block of its rows' columns) for each part that has rows."""
    order = np.argsort(part, kind="stable")
    ends = np.searchsorted(part[order], np.arange(parts + 1))
    for k in np.flatnonzero(np.diff(ends)):
        at = order[ends[k] : ends[k + 1]]
        yield int(k), b"".join(c[at].tobytes() for c in columns)


def _undealt(blocks: list[bytes], *types: str) -> list[np.ndarray]:
    """The columns of several blocks."""
    width = sum(np.dtype(t).itemsize for t in types)
    out: list[list[np.ndarray]] = [[] for _ in types]
    for block in blocks:
        n, at = len(block) // width, 0
        for column, t in zip(out, types, strict=True):
            column.append(np.frombuffer(block, t, n, at))
            at += n * np.dtype(t).itemsize
    return [np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(out, types, strict=True)]


def _counted(groups: DataFrame, pairs_of, least: tuple[int, ...], parts: int) -> DataFrame:  # noqa: ANN001
    """(kind, a, b, count) over the training groups for those of the pairs whose counts sum to at least `least` of their kind; pairs_of(group) gives a, b and counts of each kind.

    A group sends one block for each of `parts` hash classes that it has; rows of their own would cost the JVM far more. `parts` follows
    the number of words, so what meets in one place is bounded; a frequent context's pairs lie in all classes.
    """

    def deal(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for g in _each(batches):
            rows = [(kind * parts + part, block) for kind, (a, b, n) in enumerate(pairs_of(g)) for part, block in _dealt(part_of(a * POWER + b, parts), parts, a, b, n.astype("<u4"))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["part", "block"])

    def add(rows):  # noqa: ANN001, ANN202
        import pyarrow as pa

        kind = rows["part"][0].as_py() // parts
        a, b, n = _undealt(rows["block"].to_pylist(), "<i8", "<i8", "<u4")
        key = a * POWER + b
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sums = np.add.reduceat(n[order].astype(np.int64), first)
        ok = sums >= least[kind]
        at = order[first[ok]]
        return pa.table({"kind": np.full(len(at), kind, np.int32), "a": a[at], "b": b[at], "count": sums[ok]})

    return groups.where("train").mapInArrow(deal, "part long, block binary").groupBy("part").applyInArrow(add, "kind int, a long, b long, count long")


def word_counts(groups: DataFrame, parts: int) -> DataFrame:
    """(word, count) over all training rows, by hashes."""

    def words(g: Group):  # noqa: ANN202
        n = np.bincount(g.codes, minlength=len(g.words))
        return [(np.zeros(np.count_nonzero(n), np.int64), g.words[n > 0], n[n > 0])]

    return _counted(groups, words, (1,), parts).select(F.col("b").alias("word"), "count")


def pair_counts(groups: DataFrame, shared, depth: int, parts: int) -> DataFrame:  # noqa: ANN001
    """(context, next, count) by hashes, for pairs that occur twice, of contexts of one length and next words that the filters have.

    Beyond length 1 the pair of the suffix must occur twice too, so that most pairs that occur once are never sent.
    """

    def pairs(g: Group):  # noqa: ANN202
        contexts, twice = shared.value["contexts"], shared.value["twice"].has(g.words)
        ok = g.behind(depth) & twice[g.codes]
        if depth == 1:  # a context is a word of the group
            at = np.flatnonzero(ok[1:] & contexts.has(g.words)[g.codes[:-1]]) + 1
            names, before = g.words, g.codes[at - 1].astype(np.int64)
        else:
            suffix, context = g.ends(depth - 1, depth)
            at = np.flatnonzero(ok)
            at = at[contexts.has(context[at])]
            at = at[shared.value["seen"].has(suffix[at] * POWER + g.hashes[at])]
            names, before = np.unique(context[at], return_inverse=True)
        pair, n = np.unique(before << 32 | g.codes[at], return_counts=True)
        return [(names[pair >> 32], g.words[pair & 0xFFFFFFFF], n)]

    return _counted(groups, pairs, (2,), parts).select(F.col("a").alias("context"), F.col("b").alias("next"), "count")


def state_counts(groups: DataFrame, shared, depth: int, parts: int) -> DataFrame:  # noqa: ANN001
    """(kind, a, b, count) beyond length CHAIN. Kind 0: contexts one word longer than a state, with that state as suffix, which occur LEAST_CONTEXT times;
    kind 1: their pairs that occur twice. Contexts behind which no state can come, such as those of long copied passages, are never sent."""

    def pairs(g: Group):  # noqa: ANN202
        (start,) = g.ends(CHAIN)
        at = np.flatnonzero(g.behind(depth))
        context = start[at - depth + CHAIN]
        ok = shared.value["starts"].has(context)  # a part of a frequent context is frequent
        at, context = at[ok], context[ok]
        for k in range(depth - CHAIN, 0, -1):
            context = context * POWER + g.hashes[at - k]
        suffix = context - g.hashes[at - depth] * np.full(1, POWER) ** (depth - 1)
        ok = shared.value["states"].has(suffix)
        at, context, suffix = at[ok], context[ok], suffix[ok]
        names, first, before, total = np.unique(context, return_index=True, return_inverse=True, return_counts=True)
        ok = shared.value["seen"].has(suffix * POWER + g.hashes[at])
        pair, n = np.unique(before[ok] << 32 | g.codes[at[ok]], return_counts=True)
        return [(names, suffix[first], total), (names[pair >> 32], g.words[pair & 0xFFFFFFFF], n)]

    return _counted(groups, pairs, (LEAST_CONTEXT, 2), parts)


def _longer(pairs: DataFrame) -> DataFrame:
    """(context, suffix, total) one word longer: the frequent pairs of the last length. A part of a frequent context is frequent, so none is missed."""

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for batch in batches:
            context, suffix, nxt, count = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("context", "suffix", "next", "count"))
            yield pa.RecordBatch.from_arrays([pa.array(context * POWER + nxt), pa.array(suffix * POWER + nxt), pa.array(count)], ["context", "suffix", "total"])

    rows = pairs.where((F.col("count") >= LEAST_CONTEXT) & (F.col("next") != END))
    return rows.select("context", "suffix", "next", "count").mapInArrow(run, "context long, suffix long, total long")


def _pair_keys(pairs: DataFrame) -> DataFrame:
    """(key, value, weight) of kept pairs (context, next, share, count)."""

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for batch in batches:
            context, nxt = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("context", "next"))
            yield pa.RecordBatch.from_arrays([pa.array(context * POWER + nxt ^ PAIR), batch.column("share"), batch.column("count")], ["key", "value", "weight"])

    return pairs.select("context", "next", "share", "count").mapInArrow(run, "key long, value double, weight long")


def grow(groups: DataFrame, counts: DataFrame, tokens: int, total: float, parts: int) -> tuple[list[DataFrame], int]:
    """Tables (key, value, weight) of all states (what is left for the suffix) and kept pairs (discounted shares), until none of a length is kept; and the greatest length."""
    spark = groups.sparkSession
    cost = math.log(max(tokens, 3))
    contexts = counts.where((F.col("count") >= LEAST_CONTEXT) & (F.col("word") != END)).select(F.col("word").alias("context"), F.lit(0).cast("long").alias("suffix"), F.col("count").alias("total"))
    often = counts.where("count > 1").select(F.col("word").alias("next"), ((F.col("count") + 0.5) / total).alias("below"))
    twice = Filter.of(often.select("next"), often.count())
    below, on = often, ["next"]
    tables: list[DataFrame] = []
    depth, seen, starts, state = 0, None, None, None
    small = lambda rows: rows.hint("shuffle_hash")  # noqa: E731  fewer rows than the pairs, one for each key: these need no sort
    while True:
        if depth < CHAIN:
            if not (n := contexts.count()):
                break
            shared = spark.sparkContext.broadcast({"contexts": Filter.of(contexts.select("context"), n), "twice": twice, "seen": seen})
            found = pair_counts(groups, shared, depth + 1, parts)
        else:
            shared = spark.sparkContext.broadcast({"states": Filter.of(state.select("context"), state.count()), "starts": starts, "seen": seen})
            both = stored(state_counts(groups, shared, depth + 1, parts))
            contexts = both.where("kind = 0").select(F.col("a").alias("context"), F.col("b").alias("suffix"), F.col("count").alias("total"))
            found = both.where("kind = 1").select(F.col("a").alias("context"), F.col("b").alias("next"), "count")
        # Pairs behind a suffix that is no state have no `below`: they only lead to longer contexts.
        pairs = stored(found.join(small(below), on, "left").join(small(contexts), "context") if depth == 0 else found.join(small(contexts), "context").join(small(below), on, "left" if depth + 1 < CHAIN else "inner"))
        shared.destroy()
        share = (F.col("count") - DISCOUNT) / F.col("total")
        gain = F.col("count") * F.log(share / F.col("below"))
        telling = pairs.withColumn("share", share).withColumn("gain", gain).where(F.col("gain") >= cost)
        state = telling.groupBy("context").agg(F.sum("share").alias("shares"), F.sum("count").alias("counts"), F.sum("below").alias("belows"), F.sum("gain").alias("gains"), F.first("total").alias("total"))
        left = F.greatest(1.0 - F.col("shares"), F.lit(0.0))
        rest = (F.col("total") - F.col("counts")) * F.log(F.greatest(left, F.lit(1e-12)) / F.greatest(1.0 - F.col("belows"), F.lit(1e-12)))
        state = stored(state.where(F.col("gains") + rest >= cost).select("context", left.alias("left"), "total"))
        if state.isEmpty():
            break
        depth += 1
        tables.append(state.select(F.col("context").alias("key"), F.col("left").alias("value"), F.col("total").alias("weight")))
        tables.append(_pair_keys(telling.join(small(state.select("context")), "context", "left_semi")))
        p = F.when(gain >= cost, share).otherwise(0.0) + F.col("left") * F.col("below")
        below, on = pairs.join(small(state.select("context", "left")), "context").select(F.col("context").alias("suffix"), "next", p.alias("below")), ["suffix", "next"]
        if depth < CHAIN:
            contexts = stored(_longer(pairs))
            if depth + 1 == CHAIN:
                starts = Filter.of(contexts.select("context"), contexts.count())
                contexts = contexts.join(state.select(F.col("context").alias("suffix")), "suffix", "left_semi")
        seen = Filter.of(pairs.select("context", "next"), pairs.count(), SEEN_BITS)
        release(spark)
    return tables, depth


def _most_used(table: DataFrame, most: int) -> DataFrame:
    """About `most` keys of the greatest weights; of the last step of equal (above 4096: alike) weights, a share by key."""
    weight = F.col("weight")
    step = F.when(weight < 4096, weight).otherwise(F.pow(F.lit(2.0), F.floor(F.log2(weight))).cast("long"))
    total = 0
    for value, n in sorted(((r[0], r[1]) for r in table.groupBy(step).count().collect()), reverse=True):
        if total + n > most:
            part = F.pmod(F.col("key"), F.lit(1024)) < 1024 * (most - total) // n
            return table.where((step > value) | (step == value) & part)
        total += n
    return table


class Found:
    """Values of keys from the broadcast cache (NaN: not there), and which of the others the tree may have: these are asked for."""

    def __init__(self, keys: np.ndarray, shared) -> None:  # noqa: ANN001
        self.values = np.full(len(keys), np.nan)
        at = np.flatnonzero(shared["known"].has(keys))
        known = keys[at]
        values = self.values[at] = shared["cache"].get(known)
        left = np.isnan(values)
        self.open, self.keys = at[left], known[left]

    def may(self) -> np.ndarray:
        out = ~np.isnan(self.values)
        out[self.open] = True
        return out

    def close(self, answers: Values) -> None:
        self.values[self.open] = answers.get(self.keys)


class Walk:
    """A group's words, and for each length of context the places where it may be a state, with that state and the pair of the place's word."""

    def __init__(self, g: Group, shared, depth: int) -> None:  # noqa: ANN001
        if "cache" not in shared:  # once a worker
            shared["cache"] = Values(shared["keys"], shared["values"])
        self.group = g
        self.words, self.steps = Found(g.words ^ WORD, shared), []
        for length, context in enumerate(g.contexts(depth), 1):
            if length == 1:  # each word of the group once
                at = np.flatnonzero(g.behind(1))
                left, index = Found(g.words, shared), g.codes[at - 1]
                ok = np.flatnonzero(left.may()[index])
                index = index[ok]
            else:
                at = at[g.behind(length)[at]]
                left = Found(context[at], shared)
                ok = index = np.flatnonzero(left.may())
            at = at[ok]  # a state's suffix is a state
            self.steps.append((at, left, index, Found(context[at] * POWER + g.hashes[at] ^ PAIR, shared)))

    def questions(self) -> np.ndarray:
        return distinct(np.concatenate([self.words.keys, *(f.keys for _, left, _, share in self.steps for f in (left, share))]))

    def score(self, answers: Values, total: float):  # noqa: ANN201
        """(whether each place's word is known, log10 P at the root, P at the longest state)."""
        self.words.close(answers)
        counts, codes = np.fmax(self.words.values, 0.0), self.group.codes
        root = (counts + 0.5) / total
        p = root[codes]
        for at, state, index, share in self.steps:
            state.close(answers)
            share.close(answers)
            left = state.values[index]
            ok = ~np.isnan(left)
            at = at[ok]
            p[at] = np.fmax(share.values[ok], 0.0) + left[ok] * p[at]
        return (counts > 0)[codes], np.log10(root)[codes], p


def _answers(groups: DataFrame, tree: DataFrame, shared, depth: int, parts: int) -> DataFrame:  # noqa: ANN001
    """(group, answers): for each hash class of a group's questions, in order, the values (NaN: not in the tree)."""

    def ask(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for g in _each(batches):
            keys = Walk(g, shared.value, depth).questions()
            rows = list(zip(*_dealt(part_of(keys, parts), parts, keys), strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array([g.number] * len(rows[0]), pa.int64()), pa.array(rows[1], pa.binary())], ["part", "group", "block"])

    def deal(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for batch in batches:
            keys, values = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            rows = list(zip(*_dealt(part_of(keys, parts), parts, keys, values), strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.nulls(len(rows[0]), pa.int64()), pa.array(rows[1], pa.binary())], ["part", "group", "block"])

    def answer(rows):  # noqa: ANN001, ANN202
        import pyarrow as pa

        part, names, blocks = rows["part"][0].as_py(), rows["group"].to_pylist(), rows["block"].to_pylist()
        tree = Values(*_undealt([b for g, b in zip(names, blocks, strict=True) if g is None], "<i8", "<f8"))
        asked = [(g, tree.get(np.frombuffer(b, "<i8"))) for g, b in zip(names, blocks, strict=True) if g is not None]
        return pa.table({"group": pa.array([g for g, _ in asked], pa.int64()), "part": pa.array([part] * len(asked), pa.int64()), "block": pa.array([v.tobytes() for _, v in asked], pa.binary())})

    schema = "part long, group long, block binary"
    met = groups.mapInArrow(ask, schema).union(tree.select("key", "value").mapInArrow(deal, schema))
    found = met.groupBy("part").applyInArrow(answer, "group long, part long, block binary")
    return found.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("part", "block"))).alias("a")).select("group", F.col("a.block").alias("answers"))


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    release(spark)
    groups = groups_of(docs)
    places = groups.agg(F.coalesce(F.sum(F.octet_length("low")), F.lit(0))).first()[0] // 2
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-places // PART_PLACES))
    counts = stored(word_counts(groups, parts))
    tokens, distinct = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count(F.lit(1))).first()
    total = tokens + 0.5 * (distinct + 1)
    tables, depth = grow(groups, counts, tokens, total, parts)
    tree = counts.select(F.col("word").bitwiseXOR(F.lit(int(WORD))).alias("key"), F.col("count").cast("double").alias("value"), F.col("count").alias("weight"))
    for t in tables:
        tree = tree.unionByName(t)
    tree = stored(tree)
    for t in {f for t in [counts, *tables] for f in t.inputFiles()}:
        remove(spark, t)
    release(spark)
    keys, values = (c.to_numpy() for c in _most_used(tree, CACHE).select("key", "value").toArrow().columns)
    shared = spark.sparkContext.broadcast({"keys": keys, "values": values, "known": Filter.of(tree.select("key"), tree.count())})

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for batch in batches:
            for k, g in enumerate(_each([batch])):
                walk = Walk(g, shared.value, depth)
                keys = walk.questions()
                keys = keys[np.argsort(part_of(keys, parts), kind="stable")]
                (values,) = _undealt(batch.column("answers")[k].as_py() or [], "<f8")
                found = ~np.isnan(values)
                known, base, p = walk.score(Values(keys[found], values[found]), total)
                starts = np.cumsum(g.sizes) - g.sizes
                of = lambda x: pa.array(np.add.reduceat(x, starts))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([g.ids, pa.array(np.full(len(g.sizes), not g.train)), pa.array(g.sizes), of(known.astype(np.int64)), of(base), of(np.log10(p))], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    answers = _answers(groups, tree, shared, depth, parts)
    out = groups.join(answers, "group", "left").mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
