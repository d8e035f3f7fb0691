"""Links inside buckets and connected components, for the near-duplicate operators.

Both near-duplicate operators reduce their search to "rows that share a bucket". A bucket may hold a
large part of all rows, so buckets beyond ``BLOCK`` rows are cut into sub-blocks and every pair of
sub-blocks becomes a task-sized work item: no pair is lost, no bucket meets in one task, and no pair
is emitted as a row. A work item yields only a spanning star of each component that it saw.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platter.llm.common import reliable

#: Rows of a sub-block; a work item compares one sub-block with itself or with one other.
BLOCK = 1024


def work_items(rows: DataFrame, bucket: list[str], spread_by: str, block: int = BLOCK, weight: Column | None = None) -> DataFrame:
    """Add ``sub``, ``left_block``, ``right_block``: rows of big buckets go once to each pair of sub-blocks.

    ``weight`` is a row's size as a number of ordinary rows (1 or more), where rows differ much: sub-blocks then hold
    about ``block`` by weight.

    Buckets of a single row have no pair and are dropped. The side table holds only buckets of two or
    more rows; Spark broadcasts it when its measured size allows and joins it by shuffle otherwise.
    """
    n = F.count(F.lit(1)).alias("__n")
    counts = rows.groupBy(*bucket).agg(n).filter("__n > 1") if weight is None else rows.groupBy(*bucket).agg(n, F.ceil(F.sum(weight)).alias("__w")).filter("__n > 1").select(*bucket, F.col("__w").alias("__n"))
    return _paired(rows.join(counts, bucket), spread_by, block)


def split_hot(rows: DataFrame, bucket: list[str], spread_by: str, block: int = BLOCK, broadcast_rows: int = 200_000) -> DataFrame:
    """As ``work_items``, for wide rows whose buckets nearly all hold several: only buckets over ``block`` rows are looked up.

    There is at most one such bucket a ``block`` of rows. They are counted before they are joined: up to
    ``broadcast_rows`` (a few MB) are broadcast, so the rows are shuffled once; more are joined by shuffle.
    """
    hot = reliable(rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > block))
    side = F.broadcast(hot) if hot.count() <= broadcast_rows else hot
    return _paired(rows.join(side, bucket, "left").withColumn("__n", F.coalesce("__n", F.lit(1))), spread_by, block)


def _paired(counted: DataFrame, spread_by: str, block: int) -> DataFrame:
    """Deal the rows of each bucket of ``__n`` rows to the pairs of its sub-blocks."""
    sized = counted.withColumn("__blocks", F.ceil(F.col("__n") / F.lit(block)).cast("int")).drop("__n")
    sub = F.pmod(F.xxhash64(spread_by), F.col("__blocks")).cast("int")
    paired = sized.withColumn("sub", sub).withColumn(
        "__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1))
    )
    return (
        paired.withColumn("left_block", F.least("sub", "__other"))
        .withColumn("right_block", F.greatest("sub", "__other"))
        .drop("__other", "__blocks")
    )


def dealt(items: DataFrame, bucket: list[str]) -> DataFrame:
    """Bring each work item together and sort the items of a partition one after another."""
    keys = [*bucket, "left_block", "right_block"]
    return items.repartition(*keys).sortWithinPartitions(*keys)


def roots_of(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For a symmetric link matrix, the smallest id of each row's component."""
    labels = ids.copy()
    reach = linked | np.eye(len(ids), dtype=bool)
    top = np.iinfo(ids.dtype).max
    while True:
        lower = np.where(reach, labels[None, :], top).min(axis=1)
        if np.array_equal(lower, labels):
            return labels
        labels = lower


def connected_components(edges: DataFrame) -> DataFrame:
    """Label the nodes of ``edges`` (``u``, ``v``: non-null, comparable) with the smallest node they reach.

    Returns ``node``, ``component`` for every node that is not itself the smallest of its component. Large-star and
    small-star steps alternate until the edges are stars; each step is a grouped minimum (combined on
    the map side, so a hub is no hot key) and a join that adaptive execution may split. Each round is
    checkpointed: a lost executor costs one round at most, and the plan never grows. Rounds grow with the logarithm
    of the nodes and end when the edges no longer change; there is no limit to them.
    """
    def fingerprint(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    current = reliable(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = fingerprint(current)
    while state[0]:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stepped = small.union(lowest.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        current = reliable(stepped)
        was, state = state, fingerprint(current)
        if was == state:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
