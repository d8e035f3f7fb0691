"""Capture indexes, pending work and page statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platter.functions.text import url_key
from platter.operators.membership import anti_join

# Fixed value: addresses that look like reviews.
REVIEW_URL = r"(review|record|album|rec_|/r/|index|archive|home|^https?://[^/]+/?$)"


def filter_captures(index: DataFrame, pattern: str | None = REVIEW_URL, start: int | None = None, end: int | None = None) -> DataFrame:
    """Successful HTML captures whose address matches (case-insensitive; None: all), within the years.

    Without a mimetype column everything counts as HTML; a null mimetype or status is dropped.
    """
    keep: Column = F.lit(True)
    if "mimetype" in index.columns:
        keep = keep & (F.col("mimetype").contains("html") | (F.col("mimetype") == "unk"))
    if "statuscode" in index.columns:
        keep = keep & (F.col("statuscode") == "200")
    if pattern is not None:
        keep = keep & F.col("original").rlike(f"(?i){pattern}")
    year = F.substring("timestamp", 1, 4).try_cast("int")
    if start is not None:
        keep = keep & (year >= start)
    if end is not None:
        keep = keep & (year <= end)
    return index.filter(keep)


def without_recaptures(df: DataFrame) -> DataFrame:
    """Of captures of one address that follow each other with the same digest, the first.

    A digest that comes back after another one is a change and stays, and so does an equal page at
    another address.
    """
    timeline = Window.partitionBy("original").orderBy("timestamp", "digest")
    before = df.withColumn("__before", F.lag("digest").over(timeline))
    return before.filter(~F.col("digest").eqNullSafe(F.col("__before")) | F.col("digest").isNull()).drop("__before")


def distinct_captures(df: DataFrame, by_digest: bool = False) -> DataFrame:
    """``timestamp, url, digest``, one row per timestamp and address; ``by_digest`` drops unchanged re-captures first."""
    rows = without_recaptures(df) if by_digest else df
    return rows.groupBy("timestamp", F.col("original").alias("url")).agg(F.min("digest").alias("digest"))


def manifest_order(df: DataFrame) -> DataFrame:
    return df.orderBy("timestamp", "url")


def pending_captures(manifest: DataFrame, done: DataFrame, filtered: bool = False) -> DataFrame:
    """Captures of the manifest whose timestamp and address key are not among ``done``; ``filtered``: by a Bloom filter first."""
    keyed = manifest.withColumn("url_key", url_key("url"))
    if filtered:
        return anti_join(keyed, done, ["timestamp", "url_key"])
    return keyed.join(done.select("timestamp", "url_key").distinct(), ["timestamp", "url_key"], "left_anti")


def captures_per_year(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy(F.substring("timestamp", 1, 4).alias("year")).agg(F.count(F.lit(1)).alias("n"))


def tag_counts(pages: DataFrame, html_col: str = "html", by: str | None = None) -> DataFrame:
    """How often each tag opens, over all pages or per value of ``by``."""
    tags = F.regexp_extract_all(F.col(html_col), F.lit("<([a-zA-Z][a-zA-Z0-9]*)"), F.lit(1))
    keys = [by] if by else []
    opened = pages.select(*keys, F.explode(tags).alias("tag")).withColumn("tag", F.lower("tag"))
    return opened.groupBy(*keys, "tag").agg(F.count(F.lit(1)).alias("n"))


def tag_histogram(pages: DataFrame, n: int = 15, html_col: str = "html") -> DataFrame:
    return tag_counts(pages, html_col).orderBy(F.desc("n"), "tag").limit(n)


def rows_per_extractor(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Rows of each extractor in ``names``, those without rows included."""
    counts = rows.groupBy("extractor").agg(F.count(F.lit(1)).alias("__n"))
    return names.join(counts, "extractor", "left").select("extractor", F.coalesce("__n", F.lit(0)).alias("n"))


def capture_yield(captures: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows and page size of each capture; ``n = 0`` marks the captures that gave nothing."""
    counts = rows.groupBy("capture_file").agg(F.count(F.lit(1)).alias("__n"))
    return captures.join(counts, "capture_file", "left").select(
        "capture_file", F.octet_length("html").cast("long").alias("bytes"), F.coalesce("__n", F.lit(0)).alias("n")
    )
