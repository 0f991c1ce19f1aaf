"""Incremental ingest: new section files to the corpus, once each, with running form counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.corpus import sentences, tokens
from ..operators.lexicon import form_counts
from ..profile import ScriptProfile
from ..sources.tables import SECTIONS


def sections(spark: SparkSession, landing: str, files: int = 100) -> DataFrame:
    """New JSON-lines files of the landing folder; the checkpoint remembers the finished ones."""
    return spark.readStream.schema(SECTIONS).option("maxFilesPerTrigger", files).json(landing)


def corpus_stream(stream: DataFrame, profile: ScriptProfile) -> DataFrame:
    """Stateless: each batch's clean, cut and labelled sentences, with the key that deduplicates them."""
    return sentences(stream, profile).withColumn("skeleton_hash", F.sha1(profile.key(F.col("text"))))


def ingest(stream: DataFrame, out: str, checkpoint: str, profile: ScriptProfile) -> StreamingQuery:
    """Appends sentences by layer. A batch that runs again replaces its own folder, so a crash leaves no doubles."""

    def write(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates(["skeleton_hash"]).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return corpus_stream(stream, profile).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_sentences(corpus: DataFrame) -> DataFrame:
    """The first sentence of each stripped text over all batches."""
    columns = [c for c in corpus.columns if c not in ("batch", "skeleton_hash")]
    return corpus.groupBy("skeleton_hash").agg(F.min_by(F.struct(*columns), F.struct("batch", "section_seq", "line_idx", "sent_idx")).alias("r")).select("r.*")


def counts(corpus: DataFrame, profile: ScriptProfile) -> DataFrame:
    keys = ["section_seq", "line_idx", "sent_idx"]
    return form_counts(tokens(corpus, profile, *keys, "layer"), *keys, "idx")
