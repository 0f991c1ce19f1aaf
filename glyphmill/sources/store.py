"""Intermediate tables in the folder that the driver and the executors share, for frames that a plan reads more than once."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, one is chosen in local mode; on a cluster that is an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.match(r"local($|\[)", context.master):
                raise ValueError("spark.checkpoint.dir is not set: it must name a folder that the driver and the executors share")
            folder = tempfile.mkdtemp(prefix="glyphmill-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Scanned rows dealt by key over all cores where the files give fewer tasks than there are cores; on larger input they stay where they were read, without a shuffle."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores, key) if rows.rdd.getNumPartitions() < cores else rows


def stored(df: DataFrame) -> DataFrame:
    """df, written once and read again: its lineage ends here, and a lost executor costs no more than its own tasks."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
