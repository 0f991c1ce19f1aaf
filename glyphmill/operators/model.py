"""The model layer: a backend loads once per Python worker and marks texts in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import model_chunks
from ..profile import ScriptProfile


class Backend(Protocol):
    def vocalize_batch(self, texts: list[str]) -> list[str | None]: ...


class NullBackend:
    """Knows nothing."""

    def vocalize_batch(self, texts: list[str]) -> list[str | None]:
        return [None] * len(texts)


def predict(texts: DataFrame, factory: Callable[[], Backend], profile: ScriptProfile, size: int = 1800, batch: int = 16) -> DataFrame:
    """(id, text) of the stripped texts' predictions, chunk by chunk; a text with a chunk that isn't answered or whose letters change has none."""
    chunks = texts.select("id", profile.strip(F.col("text")).alias("text")).select("id", F.posexplode(model_chunks(F.col("text"), size)).alias("k", "chunk"))
    key = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        backend = factory()
        for pdf in batches:
            out: list[str | None] = []
            for i in range(0, len(pdf), batch):
                out += backend.vocalize_batch(pdf["chunk"].iloc[i : i + batch].tolist())
            yield pd.DataFrame({"id": pdf["id"], "k": pdf["k"], "chunk": pdf["chunk"], "out": pd.Series(out, dtype=object)})

    done = chunks.mapInPandas(run, f"id {key}, k int, chunk string, out string")
    ok = F.coalesce(profile.strip(F.col("out")) == F.col("chunk"), F.lit(False))
    rows = done.groupBy("id").agg(F.min(ok.cast("int")).alias("ok"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "out"))), lambda x: x["out"]), "").alias("text"))
    return rows.where("ok = 1").select("id", "text")
