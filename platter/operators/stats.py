"""Summary statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platter.operators.quantiles import exact_quantiles
from platter.operators.select import genre_list
from platter.operators.steps import settled, stored


def summarize_reviews(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row of corpus figures; null countries and reviewers are not counted."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        F.count(F.lit(1)).alias("reviews"),
        F.min("review_year").alias("first_year"),
        F.max("review_year").alias("last_year"),
        F.count_if("is_new_release").alias("new_releases"),
        F.count_if("is_reissue").alias("reissues"),
        F.count_if("bnm").alias("bnm"),
        F.count_if(F.col("score") == 10).alias("perfect"),
        F.count_if(F.coalesce("score", F.lit(0.0)) >= 9).alias("nine_plus"),
        distinct("country").alias("countries"),
        distinct("reviewer").alias("reviewers"),
    )


def exploded_genres(df: DataFrame, untagged: str | None = "(untagged)") -> DataFrame:
    """A row per review and genre, in column ``value``; reviews without genre under ``untagged``, or dropped."""
    own = genre_list()
    if untagged is not None:
        own = F.when(F.size(own) == 0, F.array(F.lit(untagged))).otherwise(own)
    return df.withColumn("value", F.explode(own))


def genre_counts(df: DataFrame) -> DataFrame:
    return exploded_genres(df).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def first_genre_counts(df: DataFrame, null_label: str = "(untagged)") -> DataFrame:
    """Reviews by their first genre, as the build's summary counts them."""
    return value_counts(df, "genre", null_label)


def value_counts(df: DataFrame, column: str, null_label: str = "(unknown)") -> DataFrame:
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(null_label)).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def reviews_per_year(df: DataFrame) -> DataFrame:
    return df.filter("review_year IS NOT NULL").groupBy("review_year").agg(F.count(F.lit(1)).alias("n"))


def score_stats_by(
    df: DataFrame, key: str = "review_year", value: str = "score", approximate: bool = False, many_values: bool = False
) -> DataFrame:
    """Mean, median and quartiles per key; exact with linear interpolation, or approximate by option.

    ``many_values``: exact too, for columns of more distinct values a key than one buffer should hold.
    """
    if many_values:
        rows = df.filter(F.col(key).isNotNull()).select(key, value)
        at_ranks = exact_quantiles(rows, [key], value, [0.5, 0.25, 0.75]).select(F.col(key).alias("__key"), "quantiles")
        means = rows.groupBy(key).agg(F.avg(value).alias("mean"))
        joined = means.join(at_ranks, F.col(key) == F.col("__key"), "left")
        return joined.select(key, "mean", *[F.get("quantiles", F.lit(j)).alias(n) for j, n in enumerate(("median", "q1", "q3"))])
    at = F.percentile_approx if approximate else F.percentile
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.avg(value).alias("mean"), at(value, F.lit(0.5)).alias("median"), at(value, F.lit(0.25)).alias("q1"), at(value, F.lit(0.75)).alias("q3")
    )


def top_values(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent rows of ``genre_counts`` or ``value_counts``, ties by value."""
    return counts.orderBy(F.desc("n"), "value").limit(n)


def restrict_to_top(df: DataFrame, top: DataFrame, column: str = "value") -> DataFrame:
    """Rows whose value is among ``top``; a limited top is small, and Spark broadcasts it by its measured size."""
    return df.join(top.select(column), column, "left_semi")


def box_stats(df: DataFrame, value: str = "score", top_n: int = 10, whisker: float = 1.5, many_values: bool = False) -> DataFrame:
    """Quartiles and whiskers of ``value`` for the most frequent genres; ``many_values`` as in ``score_stats_by``, with ``df`` computed once."""
    exploded = exploded_genres(df, untagged=None).select("value", F.col(value).alias("x"))
    if many_values:
        exploded = stored(exploded)
    top = top_values(exploded.groupBy("value").agg(F.count(F.lit(1)).alias("n")), top_n)
    rows = exploded.filter("x IS NOT NULL")
    if many_values:
        rows = restrict_to_top(rows, settled(top))  # read in every pass
        quartiles = exact_quantiles(rows, ["value"], "x", [0.25, 0.5, 0.75])
        box = quartiles.select("value", *[F.get("quantiles", F.lit(j)).alias(n) for j, n in enumerate(("q1", "median", "q3"))])
        return _whiskers(rows, box, whisker)
    rows = restrict_to_top(rows, top)
    # Scores have few distinct values: one row per genre and value carries all that follows.
    small = rows.groupBy("value", "x").agg(F.count(F.lit(1)).alias("n"))
    box = small.groupBy("value").agg(
        F.percentile("x", F.lit(0.25), F.col("n")).alias("q1"),
        F.percentile("x", F.lit(0.5), F.col("n")).alias("median"),
        F.percentile("x", F.lit(0.75), F.col("n")).alias("q3"),
    )
    return _whiskers(small, box, whisker)


def _whiskers(rows: DataFrame, box: DataFrame, whisker: float) -> DataFrame:
    fence = whisker * (F.col("q3") - F.col("q1"))
    # One row a genre, of the few that ``box_stats`` takes: without the hint all rows are shuffled before their size is known.
    inside = rows.join(F.broadcast(box), "value").filter(F.col("x").between(F.col("q1") - fence, F.col("q3") + fence))
    return inside.groupBy("value", "q1", "median", "q3").agg(F.min("x").alias("whisker_low"), F.max("x").alias("whisker_high"))


def badges_per_year(df: DataFrame) -> DataFrame:
    return df.filter("review_year IS NOT NULL").groupBy("review_year").agg(F.count_if("bnm").alias("bnm"), F.count_if("bnr").alias("bnr"))


def histogram(df: DataFrame, column: str = "score", bins: int = 40) -> DataFrame:
    """Counts in equal bins over the column's range, the last bin closed; all in bin 1 if there is one value only."""
    rows = df.select(F.col(column).cast("double").alias("x")).filter("x IS NOT NULL AND NOT isnan(x)")
    ends = rows.agg(F.struct(F.min("x").alias("low"), F.max("x").alias("high")).alias("e")).scalar()
    spread = rows.withColumn("e", ends)
    at = F.least(F.width_bucket("x", F.col("e.low"), F.col("e.high"), F.lit(bins)), F.lit(bins))
    return spread.select(F.when(F.col("e.low") < F.col("e.high"), at).otherwise(1).cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
