"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platter.operators.steps import settled, shared_folder

#: Characters that separate words in every contract of this subpackage.
SPACE_CLASS = "\\x20\\x09-\\x0D"


def reliable(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a checkpoint in the shared folder, which outlives lost executors."""
    return settled(df)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: as ``reliable``, but compressed and read by column."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.toDF(*[f"c{k}" for k in range(len(df.columns))]).write.parquet(path)  # names may differ in case only
    return df.sparkSession.read.parquet(path).toDF(*df.columns)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def text_or_empty(column: str = "text") -> Column:
    """The text as a string, a null text as the empty one."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def complete_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 16384, nbytes: int = 64 << 20) -> Iterator[pa.Table]:
    """Cut a stream sorted by ``keys`` into tables that never split a group.

    A table is handed on once it has ``rows`` rows or ``nbytes`` bytes; what may continue in the next batch is kept
    back, so memory is bounded by these, one batch and one group.
    """
    held: list[pa.RecordBatch] = []
    count = size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count, size = count + batch.num_rows, size + batch.nbytes
        if count < rows and size < nbytes:
            continue
        table = pa.Table.from_batches(held)
        edges = group_edges(table, keys)
        if len(edges) <= 2:
            rows, nbytes = max(rows, 2 * count), max(nbytes, 2 * size)
            continue
        cut = int(edges[-2])
        yield table.slice(0, cut)
        rest = table.slice(cut).combine_chunks()
        held, count, size = rest.to_batches(), rest.num_rows, rest.nbytes
    if held:
        yield pa.Table.from_batches(held)


def group_edges(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which a new group of ``keys`` starts, plus the number of rows."""
    change = np.zeros(table.num_rows, dtype=bool)
    change[:1] = True
    for key in keys:
        values = table.column(key).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(change), table.num_rows)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound the memory of Python workers on tables of long texts: at most ``rows`` texts a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def hash_sample(df: DataFrame, rows: int, hash_col: str = "__hash") -> DataFrame:
    """About ``rows`` rows of ``df``: those whose hash lies below the quantile that leaves so many.

    Used only to fit models on a bounded sample. The choice repeats in every run and needs no sort.
    """
    share = min(1.0, rows / max(df.select(hash_col).count(), 1))
    kept = df if share >= 1 else df.filter(F.pmod(F.col(hash_col), F.lit(1 << 30)) < int(share * (1 << 30)))
    return kept.drop(hash_col)
