"""Cutting a plan where several branches read the same intermediate rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Where driver and executors share files: ``spark.checkpoint.dir``, else the folder given to ``setCheckpointDir``.

    Only a local session may have neither; it uses a folder below its warehouse. A cluster is refused, since
    each of its machines would write to a disk of its own.
    """
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that lost executors change nothing."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As ``settled``, for large rows: a compressed Parquet table of its own in the shared folder, read by column and by split."""
    path = f"{shared_folder(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, nbytes: int = 4 << 20) -> None:
    """Bound the memory of Python workers on long texts: batches of about ``nbytes`` bytes, or a single longer row."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(nbytes))


def byte_slices(batch: pa.RecordBatch, columns: tuple[str, ...], budget: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch where the bytes of ``columns`` reach ``budget``: slices share its memory, and a row is never cut."""
    if not batch.num_rows:
        return
    sizes = sum(np.asarray(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(c))), 0), dtype=np.int64) for c in columns)
    before = np.cumsum(sizes) - sizes
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(before, before[start] + budget))
        end = max(end, start + 1)
        yield batch.slice(start, end - start)
        start = end
