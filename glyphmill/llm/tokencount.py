"""Token counts: batch encoding inside Arrow functions that give lengths only.

Neighbouring texts form groups of about equal bytes. Their texts are cut at safe boundaries into pieces; each distinct piece of a group
that isn't known yet goes to the library once, in batches of equal bytes, and only its number of ids is kept. A long text is a group of
its own and is cut into slabs first.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows give repeated results;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from . import chunks
from .chunks import PieceTable
from .common import byte_groups, id_and_text

GROUP_BYTES = 1 << 20


@lru_cache(maxsize=4)
def _counter(path: str):  # noqa: ANN202
    """(numbers of tokens of a list of pieces, pieces of a text)."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        # No token goes on behind a blank, so a single blank between two letters or digits ends a piece; the next one gets its blank back as the model's own first one.
        safe = all("\u2581" not in model.id_to_piece(i).lstrip("\u2581") for i in range(model.vocab_size())) and model.encode("a b") == model.encode("a") + model.encode("b")
        count = lambda batch: [len(ids) for ids in model.encode(batch, num_threads=1)]
        return PieceTable(count).values, lambda text: _BETWEEN.split(text) if safe else [text]
    tokenizer = chunks.library(path)
    cut = chunks.spaced if tokenizer.normalizer is None else chunks.words  # byte-level: spaces belong to the words behind them
    known = PieceTable(lambda batch: [len(e) for e in tokenizer.encode_batch_fast(batch, add_special_tokens=False)])
    return known.values, cut


_BETWEEN = re.compile("(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of each whole text."""

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        values, cut = _counter(vocabulary)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sizes = [0 if t is None else chunks.n_bytes(t) for t in texts]
            counts = [0] * len(texts)
            for group in byte_groups(sizes, GROUP_BYTES):
                pieces: list[str] = []
                ends = [0]
                for i in group:
                    text = texts[i] or ""
                    if sizes[i] > GROUP_BYTES:  # alone in its group
                        counts[i] = sum(sum(values(cut(part))) for part in (chunks.slabs(text, GROUP_BYTES) if cut in (chunks.words, chunks.spaced) else (text,)))
                    else:
                        pieces += cut(text) if text else []
                    ends.append(len(pieces))
                before = np.concatenate([[0], np.cumsum(values(pieces), dtype=np.int64)])
                for i, a, b in zip(group, ends, ends[1:], strict=False):
                    counts[i] += int(before[b] - before[a])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return id_and_text(docs).selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
