"""Quality rules with risk-controlled thresholds.

Counts over whole texts give each document a fixed base verdict and a learned badness score. The score's cutoff is chosen per
stratum (language) on labelled holdouts: cutoffs are tested from the strictest to the laxest, and each must
show by the exact binomial tail that at most `risk` of the good documents fail it. Testing in this fixed order and stopping at the first cutoff that can't
be shown keeps the error within a stratum at its level, and the level is confidence / number of strata
(Bonferroni), so with probability 1 - confidence the limit holds in every stratum at once. Of the shown cutoffs the one with the best
balance of caught bad and lost good holdout documents is taken; with too few labels nothing can be shown, and the method rejects nothing.

Defined results: a null or empty text has no words and fails the base rules; a null language is a stratum of its own;
repeated rows are counted each; a document with several labels counts as bad if any is; extra columns are ignored
(kept by filter_documents()); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, checkpointed, fold, hash_sample

SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
DIGITS = b"0123456789"
WINDOW = 5
#: The score is learned from about so many labelled rows at most, those of the least hashes.
SAMPLE_ROWS = 20_000
RISK = 0.01
CONFIDENCE = 0.05
#: Cutoffs run from 1 down to 1/2: what is likelier good than bad is never rejected.
CUTOFFS = 100
PREFIX = "_glyphmill_"
MAX_STRATA_SENT = 1024
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaim", "n_digits", "n_distinct"]
SHARES = ["symbols", "upper", "exclaim", "digits", "dup_lines", "repeats", "word_length", "distinct", "words_a_line"]


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in some window of so many words which the text has at least twice."""
    grams = list(zip(*(words[k:] for k in range(window)), strict=False))
    if len(set(grams)) == len(grams):
        return 0
    counts = Counter(grams)
    covered = until = 0
    for i, g in enumerate(grams):
        if counts[g] > 1:
            covered += i + window - max(i, until)
            until = i + window
    return covered


def count_text(text: str | None) -> tuple[int, ...]:
    """COUNTS of one text."""
    text = text or ""
    data = text.encode()
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip(WHITE)]
    without = lambda chars: len(data) - len(data.translate(None, chars))
    return (len(words), len(text) - without(WHITE), without(SYMBOLS), len(lines) - len(set(lines)), repeat_words(words), len(lines), sum(map(bytes.isupper, words)), data.count(b"!"), without(DIGITS), len(set(words)))


def with_counts(docs: DataFrame, stratum: str = "lang", keep: bool = True) -> DataFrame:
    """docs with PREFIX + name for each of COUNTS and the stratum; without keep, doc_id and these only. Narrow, no shuffle."""
    from pyspark.sql.types import LongType, StringType, StructType

    bound_batches(docs.sparkSession)
    docs = docs.withColumn(f"{PREFIX}stratum", F.coalesce(F.col(stratum).cast("string"), F.lit("")))
    if not keep:
        docs = docs.select("doc_id", f"{PREFIX}stratum", "text")
    schema = StructType([f for f in docs.schema.fields if keep or f.name != "text"])
    for c in COUNTS:
        schema = schema.add(f"{PREFIX}{c}", LongType())

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("text")
            rows = [count_text(texts[i].as_py()) for i in range(batch.num_rows)]
            columns = list(zip(*rows, strict=True)) or [()] * len(COUNTS)
            old = [n for n in batch.schema.names if keep or n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in old), *(pa.array(c, pa.int64()) for c in columns)], [*old, *(f"{PREFIX}{c}" for c in COUNTS)])

    return docs.mapInArrow(run, schema)


def _shares() -> list[Column]:
    of = lambda c: F.col(PREFIX + c)
    per = lambda a, b: F.least(of(a) / F.greatest(of(b), F.lit(1)), F.lit(1.0))
    capped = lambda c, most: F.least(c / most, F.lit(1.0))
    return [
        per("n_symbols", "word_chars"),
        per("n_upper", "n_words"),
        per("n_exclaim", "n_words"),
        per("n_digits", "word_chars"),
        per("n_dup_lines", "n_lines"),
        per("n_repeat_words", "n_words"),
        capped(of("word_chars") / F.greatest(of("n_words"), F.lit(1)), 20.0),
        per("n_distinct", "n_words"),
        capped(of("n_words") / F.greatest(of("n_lines"), F.lit(1)), 200.0),
    ]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights with the intercept last, by Newton steps; both classes weigh the same, so 1/2 is the even score."""
    x = np.column_stack([x, np.ones(len(x))])
    share = max(y.mean(), 1e-9)
    weight = np.where(y == 1, 0.5 / share, 0.5 / max(1 - share, 1e-9)) / len(y)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for n trials of probability p, exactly summed."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(v - top) for v in logs))


def certified_cutoff(good: list[int], bad: list[int], risk: float, level: float) -> float | None:
    """good and bad: holdout documents by step, 0 the strictest, the last one never rejected; a cutoff at step j rejects steps 0 to j. None: nothing can be shown."""
    total, lost, caught, best = sum(good), 0, 0, (0, None)
    for j, (g, b) in enumerate(zip(good[:-1], bad[:-1], strict=True)):
        lost, caught = lost + g, caught + b
        if lost > risk * total or binomial_tail(lost, total, risk) > level:
            break
        best = max(best, (caught - lost, j), key=lambda x: x[0])
    return best[1]


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows with bad: 1 if any label of the document has quality 0."""
    return rows.join(labels.where("quality is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 0).cast("int")).alias("bad")), "doc_id")


@dataclass(frozen=True)
class Rules:
    """What was learned: the score's weights (None: too few labels) and each stratum's cutoff step."""

    weights: list[float] | None
    cutoffs: dict[str, int | None] | DataFrame

    def score(self) -> Column:
        if self.weights is None:
            return F.lit(0.0)
        linear = F.lit(self.weights[-1])
        for w, share in zip(self.weights, _shares(), strict=False):
            linear = linear + F.lit(w) * share
        return 1 / (1 + F.exp(-linear))

    def step(self) -> Column:
        """0 for the worst scores up to CUTOFFS for those that are never rejected."""
        return F.greatest(F.lit(0), F.least(F.floor((1 - self.score()) * 2 * CUTOFFS), F.lit(CUTOFFS))).cast("int")

    def apply(self, counted: DataFrame) -> DataFrame:
        """counted with PREFIX + score, cut, base_failed and kept."""
        of = lambda c: F.col(PREFIX + c)
        if isinstance(self.cutoffs, dict):
            shown = {k: v for k, v in self.cutoffs.items() if v is not None}
            counted = counted.withColumn(f"{PREFIX}cut", F.create_map(*[F.lit(v) for kv in shown.items() for v in kv])[of("stratum")] if shown else F.lit(None).cast("int"))
        else:
            counted = counted.join(self.cutoffs.toDF(f"{PREFIX}stratum", f"{PREFIX}cut"), f"{PREFIX}stratum", "left")
        failed = (of("n_words") < 10) | (100 * of("n_repeat_words") > 20 * of("n_words"))
        kept = ~failed & ~F.coalesce(self.step() <= of("cut"), F.lit(False))
        return counted.withColumn(f"{PREFIX}score", self.score()).withColumn(f"{PREFIX}base_failed", failed).withColumn(f"{PREFIX}kept", kept)


def learn(counted: DataFrame, labels: DataFrame, risk: float = RISK, confidence: float = CONFIDENCE) -> Rules:
    """The score from a bounded sample of one half of the labelled rows, the cutoffs from all rows of the other half."""
    known = labelled(counted, labels)
    half = fold(F.col("doc_id"), 2)
    sample = hash_sample(known.where(half == 0), "doc_id", SAMPLE_ROWS).select("doc_id", F.array(*_shares()).alias("x"), "bad").toPandas().sort_values("doc_id")
    weights = None
    if len(sample) and sample["bad"].nunique() == 2:
        weights = fit_logistic(np.array(sample["x"].tolist(), float), sample["bad"].to_numpy(float)).tolist()
    step = Rules(weights, {}).step()
    steps = known.where(half == 1).groupBy(F.col(f"{PREFIX}stratum").alias("stratum"), step.alias("step")).agg(F.sum(1 - F.col("bad")).alias("good"), F.sum("bad").alias("bad"))
    return Rules(weights, _cutoffs(steps, risk, confidence))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score, cutoff (null: none shown)."""
    counted = checkpointed(with_counts(docs, stratum, keep=False))
    out = learn(counted, labels, risk, confidence).apply(counted)
    of = lambda c: F.col(PREFIX + c).alias(c)
    return out.select("doc_id", *map(of, COUNTS[:5]), of("base_failed"), of("kept"), of("score"), (1 - (F.col(f"{PREFIX}cut") + 1) / (2 * CUTOFFS)).alias("cutoff"))


def filter_documents(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The rows of docs that are kept, with all their columns. Texts are counted twice, and never shuffled or checkpointed."""
    columns = docs.columns
    rules = learn(checkpointed(with_counts(docs, stratum, keep=False)), labels)
    return rules.apply(with_counts(docs, stratum)).where(f"{PREFIX}kept").select(*columns)


def _cutoffs(steps: DataFrame, risk: float, confidence: float) -> dict[str, int | None] | DataFrame:
    """Cutoff step by stratum: as a dict up to MAX_STRATA_SENT strata (at most 100 rows each), else as a table (stratum, cut)."""
    strata = steps.select("stratum").distinct().count()
    level = confidence / max(1, strata)

    def of(rows) -> int | None:  # noqa: ANN001
        good, bad = [0] * (CUTOFFS + 1), [0] * (CUTOFFS + 1)
        for s, g, b in rows:
            good[s] += int(g)
            bad[s] += int(b)
        return certified_cutoff(good, bad, risk, level)

    if strata <= MAX_STRATA_SENT:
        by: dict[str, list] = {}
        for r in steps.collect():
            by.setdefault(r["stratum"], []).append((r["step"], r["good"], r["bad"]))
        return {k: of(v) for k, v in by.items()}

    def group(rows):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.DataFrame({"stratum": [rows["stratum"].iloc[0]], "cut": pd.array([of(zip(rows["step"], rows["good"], rows["bad"], strict=True))], dtype="Int32")})

    return steps.groupBy("stratum").applyInPandas(group, "stratum string, cut int")
