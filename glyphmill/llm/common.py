"""Shared helpers of the training-data operators: tables, words, fixed folds and checkpoints."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space; bytes.split() cuts at exactly these bytes.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id and text only: extra columns never reach an operator, so their names can't clash with its own."""
    bound_batches(docs.sparkSession)
    return docs.select("doc_id", "text")


def bound_batches(spark: SparkSession, size: str = "16m") -> None:
    """Arrow batches end at this many bytes as well as at the usual number of rows: ten thousand rows of long texts are no batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds. A null id has fold 0, as crc32 of the empty string is 0."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


_FOLD_CASE = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def lower_bytes(data: bytes) -> bytes:
    """Lower-cases A-Z only, in UTF-8 bytes."""
    return data.translate(_FOLD_CASE)


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which the driver and all executors share. Where it is unset, one is chosen in local mode; on a cluster that is an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.match(r"local($|\[)", context.master):
                raise ValueError("spark.checkpoint.dir is not set: it must name a folder that the driver and the executors share")
            folder = tempfile.mkdtemp(prefix="glyphmill-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts lineage through the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """checkpointed() as a compressed table in the shared folder, for large rows and for tables that are read more than once."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, column: str) -> DataFrame:
    """stored() in a folder for each value of a column, so that a filter on it reads only its own."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4()}"
    df.write.partitionBy(column).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file of the shared folder that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files and checkpoints of frames that are gone; it waits for the driver's garbage collector."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def hash_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """About `most` rows, those of the least hashes of `key`, by a threshold from the count: no partition sends more than its share to the driver."""
    n = rows.count()
    return rows if n <= most else rows.where(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < (1 << 40) * most // n)


def byte_groups(sizes: list[int], limit: int) -> Iterator[range]:
    """Runs of neighbouring rows with these sizes that hold about `limit` together (a larger row is a run of its own)."""
    start = size = 0
    for i, n in enumerate(sizes):
        if i > start and size + n > limit:
            yield range(start, i)
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield range(start, len(sizes))
