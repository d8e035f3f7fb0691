"""A snapshot clustered by key: tables that later jobs group and join by that key without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more than this many buckets' worth of rows would make one task of the readers too long.
HOT_BUCKETS = 2
#: Rows of a bucket, which one task sorts and one task reads.
BUCKET_ROWS = 1 << 20


def hot_keys(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Keys (null is one) that hold more rows than ``HOT_BUCKETS`` even buckets: fewer than ``buckets`` of them, so they may be broadcast."""
    counts = df.groupBy(F.col(key).alias("__hot")).agg(F.count(F.lit(1)).alias("__n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.filter(F.col("__n") * buckets > total * HOT_BUCKETS).select("__hot")


def buckets_for(rows: int, least: int = 16) -> int:
    """How many buckets hold ``rows`` rows with about ``BUCKET_ROWS`` each: a power of two, so that few sizes occur."""
    return max(least, 1 << max(0, -(-rows // BUCKET_ROWS) - 1).bit_length())


def write_clustered(df: DataFrame, table: str, buckets: int, key: str = "_key", order: Sequence[str] = ("review_date",)) -> None:
    """Write ``df`` as ``table``, a file a bucket of ``key``, sorted by key and ``order``; rows of hot keys as ``{table}_hot``.

    A bucket is read by one task, so rows of hot keys, which no number of buckets divides, lie apart and
    unclustered. Both tables together hold every row once; an empty input gives two empty tables. ``df`` is read
    four times: keep one that is dear (``steps.stored``).
    """
    heavy = F.broadcast(hot_keys(df, key, buckets))
    hot = F.col(key).eqNullSafe(F.col("__hot"))
    # Dealt by the hash that bucketing itself uses: each task writes one bucket.
    even = df.join(heavy, hot, "left_anti").repartition(buckets, key)
    even.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key, *order).saveAsTable(table)
    df.join(heavy, hot, "left_semi").write.mode("overwrite").format("parquet").saveAsTable(f"{table}_hot")


def clustered(spark: SparkSession, table: str) -> tuple[DataFrame, DataFrame]:
    """The clustered rows and those of hot keys."""
    return spark.table(table), spark.table(f"{table}_hot")


def per_key(spark: SparkSession, table: str, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``operator`` over the store, for operators that treat every key by itself: only the hot keys' partial results are shuffled."""
    even, hot = clustered(spark, table)
    return operator(even).unionByName(operator(hot))


def absent(spark: SparkSession, table: str, others: str, key: str = "_key") -> DataFrame:
    """Rows of the store ``table`` whose key the store ``others`` hasn't got (null keys stay).

    Stores of equally many buckets meet bucket by bucket. Hot keys of either side are few and are broadcast, as
    distinct keys.
    """
    even, hot = clustered(spark, table)
    there, there_hot = clustered(spark, others)
    heavy = F.broadcast(there_hot.select(key).distinct())
    fresh = even.join(there.select(key), key, "left_anti").join(heavy, key, "left_anti").select(*even.columns)
    mine = F.broadcast(hot.select(key).distinct())
    known = there.select(key).join(mine, key, "left_semi").distinct().unionByName(there_hot.select(key).distinct()).distinct()
    return fresh.unionByName(hot.join(F.broadcast(known.join(mine, key, "left_semi")), key, "left_anti").select(*even.columns))
