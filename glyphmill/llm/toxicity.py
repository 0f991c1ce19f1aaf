"""Toxicity by compression distance: two zstandard dictionaries, one of ordinary and one of toxic text.

A window is one lower-cased word between blanks, followed by a fixed trailer that both dictionaries end with (zstandard seeks no
match in a block's last bytes). Its gain is its compressed length under the ordinary dictionary minus that under the toxic one.
Both dictionaries begin with the same common words, so ordinary windows gain nothing; they differ in their last few KB:

* toxic: words that hold a segment (4 to 6 bytes, or the whole word) which toxic documents have far more often. Counts go
  by distinct (word before, word, word behind), so that copies of one document count once;
* ordinary: ordinary words that would gain under the toxic dictionary, found in rounds by compressing them with both.

A document's score is a logistic function of its numbers of windows by gain and its length, calibrated on labelled
documents. Only rows outside the held-out fold teach anything; labels, language, source and id are no inputs of a score.

Defined results: null and empty texts have no windows and get the score of length 0; without both classes among the
labelled rows every score is 0; repeated rows get equal scores; extra columns are ignored (kept by filter_documents()).
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chunks import PieceTable
from .common import bound_batches, checkpointed, fold, hash_sample, lower_bytes
from .quality import fit_logistic

#: The dictionaries are trained on about so many labelled documents of each class (those of the least hashes),
#: and on about so many windows of each; the calibration on at most so many labelled documents.
TRAIN_DOCUMENTS = 2500
TRAIN_WINDOWS = 150
CALIBRATION_ROWS = 20_000
BASE_BYTES = 60_000
TAIL_BYTES = 4096
ROUNDS = 4
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
PREFIX = "_glyphmill_"
GAINS = (1, 3, 4, 6)
COUNTS = ["n_windows", *(f"gain{g}" for g in GAINS)]
EDGES = b".,!?;:'\"()"
GAP = b"\2" * 8
TRAILER = bytes(range(14, 30))


def window(word: bytes) -> bytes:
    return b" " + word.strip(EDGES) + b" " + TRAILER


def words(text: str | None) -> list[bytes]:
    return lower_bytes((text or "").encode()).split()


def segments(word: bytes) -> set[bytes]:
    w = b" " + word.strip(EDGES) + b" "
    return {w, *(w[i : i + n] for n in (4, 5, 6) for i in range(len(w) - n + 1))}


@dataclass(frozen=True)
class Dictionaries:
    ordinary: bytes
    toxic: bytes


@lru_cache(maxsize=2)
def compressor(content: bytes):  # noqa: ANN201
    """A function from a window to its compressed length."""
    params = zstandard.ZstdCompressionParameters(window_log=18, hash_log=16, chain_log=16, search_log=6, target_length=64, strategy=zstandard.STRATEGY_BTOPT, min_match=3, write_content_size=False, write_dict_id=False, write_checksum=False)
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=params)
    compress = zstandard.ZstdCompressor(compression_params=params, dict_data=dictionary).compress
    return lambda data: len(compress(data))


def gains(windows: list[bytes], dictionaries: Dictionaries) -> list[int]:
    ordinary, toxic = compressor(dictionaries.ordinary), compressor(dictionaries.toxic)
    return [ordinary(w) - toxic(w) for w in windows]


def train(toxic: Counter[bytes], ordinary: Counter[bytes]) -> Dictionaries:
    """Dictionaries from the words of either class, each with its number of distinct (before, word, behind) triples."""
    n_toxic, n_ordinary = max(1, toxic.total()), max(1, ordinary.total())
    often: Counter[bytes] = Counter()
    for w, n in toxic.items():
        for s in segments(w):
            often[s] += n
    often = Counter({s: a for s, a in often.items() if a >= 5})
    elsewhere = dict.fromkeys(often, 0)
    for w, n in ordinary.items():
        for s in segments(w):
            if s in elsewhere:
                elsewhere[s] += n

    def telling(segment: bytes, a: int) -> bool:
        b = elsewhere[segment]
        p = (a + b) / (n_toxic + n_ordinary)
        z = (a / n_toxic - b / n_ordinary) / math.sqrt(p * (1 - p) * (1 / n_toxic + 1 / n_ordinary)) if p < 1 else 0.0
        return z >= 4.5 and a / n_toxic > 50 * (b + 0.5) / n_ordinary

    marks = {s for s, a in often.items() if telling(s, a)}
    marked = sorted((w for w in toxic if segments(w) & marks), key=lambda w: (toxic[w], w))
    plain = sorted((w for w in ordinary if not segments(w) & marks), key=lambda w: (-ordinary[w], w))
    base = b" ".join(reversed(plain[:100_000]))[-BASE_BYTES:]

    def content(tail: list[bytes]) -> bytes:
        joined = (b" " + b" ".join(tail) + b" ")[-TAIL_BYTES:]
        return base + b" " + GAP + b"\2" * (TAIL_BYTES - len(joined)) + joined + GAP + TRAILER

    hard: Counter[bytes] = Counter()
    out = Dictionaries(content([]), content(marked))
    for _ in range(ROUNDS):
        tail, size = [], 0
        for w, g in zip(plain, gains([window(w) for w in plain], out), strict=True):
            if g > 0:
                hard[w] += g * ordinary[w]
        for w, _ in hard.most_common():
            if (size := size + len(w) + 1) > TAIL_BYTES - 2:
                break
            tail.append(w)
        out = Dictionaries(content(tail[::-1]), out.toxic)
    return out


def training_fold(doc_id: Column) -> Column:
    return fold(doc_id, FOLDS) != HELD_OUT


def sample_words(docs: DataFrame, labels: DataFrame) -> tuple[list[Counter[bytes]], set]:
    """[ordinary, toxic] words of a bounded sample of labelled documents, and the ids of these. Only the ids are sent out; no text is shuffled."""
    classes = []
    for c in (0, 1):
        rows = labels.where(training_fold(F.col("doc_id")) & (F.col("toxic") == c)).select("doc_id").distinct()
        classes.append({r[0] for r in hash_sample(rows, "doc_id", TRAIN_DOCUMENTS).collect() if r[0] is not None})
    class_of = {i: c for c, ids in enumerate(classes) for i in ids}

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for batch in batches:
            out: list[list] = [[], [], []]
            texts = batch.column("text")
            for k, i in enumerate(batch.column("doc_id").to_pylist()):
                c = class_of.get(i)
                if c is None:
                    continue
                w = [b"", *words(texts[k].as_py()), b""]
                most = (1 << 32) * min(1.0, TRAIN_WINDOWS / max(1, len(w) - 2))
                for triple in zip(w, w[1:], w[2:], strict=False):
                    row = b" ".join(triple)
                    if zlib.crc32(row) < most and len(row) < 256:
                        for column, value in zip(out, (c, triple[1].strip(EDGES), row), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], ["class", "word", "triple"])

    # Ids of the sample (bounded) are sent out, so only its texts reach Python.
    ids = docs.sparkSession.createDataFrame([(i,) for i in class_of] or [], "doc_id long")
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id", "left_semi")
    triples = chosen.mapInArrow(run, "class int, word binary, triple binary").distinct()
    found: list[Counter[bytes]] = [Counter(), Counter()]
    for c, word, n in triples.groupBy("class", "word").count().toPandas().itertuples(index=False):
        found[c][bytes(word)] = n
    return found, set(class_of)


def with_counts(docs: DataFrame, dictionaries: Dictionaries, keep: bool = True) -> DataFrame:
    """docs with PREFIX + name for each of COUNTS: the windows, and those that gain at least so much. Without keep: doc_id and these only."""
    from pyspark.sql.types import LongType, StructType

    if not keep:
        docs = docs.select("doc_id", "text")
    schema = StructType([f for f in docs.schema.fields if keep or f.name != "text"])
    for c in COUNTS:
        schema = schema.add(f"{PREFIX}{c}", LongType())

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        table = _gain_table(dictionaries)
        for batch in batches:
            columns: list[list[int]] = [[] for _ in COUNTS]
            texts = batch.column("text")
            for k in range(batch.num_rows):
                by_gain = Counter(table.values(words(texts[k].as_py())))
                columns[0].append(sum(by_gain.values()))
                for column, least in zip(columns[1:], GAINS, strict=True):
                    column.append(sum(n for g, n in by_gain.items() if g >= least))
            old = [n for n in batch.schema.names if keep or n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in old), *(pa.array(c, pa.int64()) for c in columns)], [*old, *(f"{PREFIX}{c}" for c in COUNTS)])

    return docs.mapInArrow(run, schema)


@lru_cache(maxsize=1)
def _gain_table(dictionaries: Dictionaries) -> PieceTable[int]:
    return PieceTable(lambda batch: gains([window(w) for w in batch], dictionaries), 600_000)


def _inputs() -> list[Column]:
    of = lambda c: F.col(PREFIX + c).cast("double")
    counts = [F.least(of(f"gain{g}"), F.lit(5.0)) for g in GAINS]
    return [*counts, F.least(100 * of("gain3") / F.greatest(of("n_windows"), F.lit(1.0)), F.lit(5.0)), F.log1p(of("n_windows"))]


@dataclass(frozen=True)
class Model:
    dictionaries: Dictionaries
    weights: list[float] | None

    def score(self) -> Column:
        if self.weights is None:
            return F.lit(0.0)
        linear = F.lit(self.weights[-1])
        for w, x in zip(self.weights, _inputs(), strict=False):
            linear = linear + F.lit(w) * x
        return 1 / (1 + F.exp(-linear))


def learn(docs: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and the counts of all documents (checkpointed)."""
    bound_batches(docs.sparkSession)
    labels = labels.where("toxic is not null")
    (ordinary, toxic), used = sample_words(docs, labels)
    dictionaries = train(toxic, ordinary)
    counted = checkpointed(with_counts(docs, dictionaries, keep=False))
    known = counted.where(training_fold(F.col("doc_id"))).join(labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id")
    sample = hash_sample(known, "doc_id", CALIBRATION_ROWS).select("doc_id", F.array(*_inputs()).alias("x"), "toxic").toPandas().sort_values("doc_id")
    fresh = sample[~sample["doc_id"].isin(used)]
    if len(fresh) and min(fresh["toxic"].eq(0).sum(), fresh["toxic"].eq(1).sum()) >= 100:  # documents that the dictionaries haven't seen, where there are enough
        sample = fresh
    weights = fit_logistic(np.array(sample["x"].tolist(), float), sample["toxic"].to_numpy(float)).tolist() if sample["toxic"].nunique() == 2 else None
    return Model(dictionaries, weights), counted


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_windows and the windows by gain."""
    model, counted = learn(docs, labels)
    score = model.score()
    return counted.select(F.col("doc_id").cast("long"), (~training_fold(F.col("doc_id"))).alias("held_out"), score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"), *(F.col(PREFIX + c).alias(c) for c in COUNTS))


def filter_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that aren't predicted toxic, with all their columns. Texts are scored twice, and never shuffled or checkpointed."""
    columns = docs.columns
    model, _ = learn(docs, labels)
    return with_counts(docs, model.dictionaries).where(model.score() < THRESHOLD).select(*columns)
