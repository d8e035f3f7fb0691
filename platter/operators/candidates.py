"""Voting on extracted records, validation against known truth, merging into the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platter.functions.text import album_key, loose_key
from platter.operators.membership import anti_join, semi_join
from platter.operators.reviews import conform, corpus_order
from platter.operators.steps import settled
from platter.schemas import REVIEW


def loose_keyed(df: DataFrame) -> DataFrame:
    return df.withColumns({"key_artist": loose_key("artist"), "key_album": loose_key("album")})


def collapse_candidates(rows: DataFrame, base: float = 0.4, per_row: float = 0.2, agreement: float = 0.2) -> DataFrame:
    """One candidate per loose artist and album: the score with most votes (first seen on ties) and its confidence.

    Two grouped levels (key and score, then key) combine on the map side; the second groups by a
    prefix of the first's key. ``n_captures`` counts rows; ``n_distinct_captures`` counts files, as rows
    of (key, file), so that no key's files are ever gathered.
    """
    order = F.struct("capture_file", "extractor_idx", "pos")
    # Two aggregations read the extractors' rows. The condition follows the settled keys: before, it would work them out again, in a Python worker of its own.
    keyed = settled(loose_keyed(rows)).filter("key_artist <> '' AND key_album <> ''")
    keys = ["key_artist", "key_album"]
    blank = lambda c: F.nullif(F.trim(F.coalesce(F.col(c), F.lit(""))), F.lit(""))
    names = F.struct((-(F.length("artist") + F.length("album"))).alias("l"), order.alias("o"))
    texts = F.struct((-F.length(blank("blurb"))).alias("l"), order.alias("o"))
    votes = keyed.groupBy(*keys, "score").agg(
        F.count(F.lit(1)).alias("votes"),
        F.min(order).alias("first"),
        F.min(F.struct(names.alias("n"), "artist", "album")).alias("name"),
        F.min("review_date_approx").alias("month"),
        F.min(F.when(blank("reviewer").isNotNull(), F.struct(order.alias("o"), "reviewer"))).alias("reviewer"),
        F.min(F.when(blank("blurb").isNotNull(), F.struct(texts.alias("t"), "blurb"))).alias("blurb"),
        F.collect_set("extractor").alias("extractors"),
    )
    joined = votes.groupBy(*keys).agg(
        F.min_by(F.struct("score", "votes"), F.struct((-F.col("votes")).alias("v"), "first")).alias("best"),
        F.sum("votes").alias("n"),
        F.min("name").alias("name"),
        F.min("month").alias("month"),
        F.min("reviewer").alias("reviewer"),
        F.min("blurb").alias("blurb"),
        F.array_sort(F.collect_set("score")).alias("scores"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("extractors")))).alias("extractors"),
    )
    files = keyed.groupBy(*keys, "capture_file").agg(F.count(F.lit(1))).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_distinct_captures"))
    joined = joined.join(files, keys)
    share = F.col("best.votes") / F.col("n")
    confidence = F.least(F.lit(1.0), base + per_row * F.least("n", F.lit(2)) + agreement * share)
    return joined.select(
        *keys,
        F.col("name.artist").alias("artist"),
        F.col("name.album").alias("album"),
        F.col("best.score").alias("score"),
        F.col("month").alias("review_date_approx"),
        F.col("reviewer.reviewer").alias("reviewer"),
        F.col("blurb.blurb").alias("blurb"),
        F.col("n").alias("n_captures"),
        "n_distinct_captures",
        F.bround(share, 2).alias("score_agreement"),
        F.when(F.size("scores") > 1, F.col("scores")).alias("score_variants"),
        "extractors",
        F.bround(confidence, 2).alias("confidence"),
        F.lit("wayback").alias("source"),
    )


def candidate_order(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("confidence"), F.lower("artist"), F.lower("album"))


def score_disagreements(candidates: DataFrame) -> DataFrame:
    return candidates.filter(F.col("score_variants").isNotNull())


def compare_to_truth(candidates: DataFrame, truth: DataFrame, tolerance: float = 0.05, order: str | None = None) -> DataFrame:
    """Truth rows with ``status`` hit, wrong_score or miss.

    Of truth rows with equal keys the last one counts: by ``order``, or as Spark reads the rows (a file's
    rows in their order, files by their place in the scan).
    """
    keyed = loose_keyed(truth.withColumn("__at", F.col(order) if order else F.monotonically_increasing_id()))
    last = F.max_by(F.struct(*truth.columns), F.col("__at"))
    keyed = keyed.groupBy("key_artist", "key_album").agg(last.alias("t")).select("key_artist", "key_album", "t.*")
    side = loose_keyed(candidates).groupBy("key_artist", "key_album").agg(F.max(F.struct("confidence", "score")).alias("c"))
    joined = keyed.join(side, ["key_artist", "key_album"], "left")
    close = F.abs(F.col("c.score") - F.col("score")) <= tolerance + 1e-9
    status = F.when(F.col("c").isNull(), "miss").when(close, "hit").otherwise("wrong_score")
    return joined.select(*truth.columns, F.col("c.score").alias("found_score"), status.alias("status"))


def unverified_low_confidence(candidates: DataFrame, truth: DataFrame, below: float = 0.7) -> DataFrame:
    known = loose_keyed(truth).select("key_artist", "key_album").distinct()
    low = loose_keyed(candidates.filter(F.col("confidence") < below).drop("key_artist", "key_album"))
    return low.join(known, ["key_artist", "key_album"], "left_anti")


def validation_scorecard(compared: DataFrame, candidates: DataFrame, below: float = 0.7) -> DataFrame:
    """One row: hits, wrong scores, misses, recall in percent, candidates, low-confidence candidates."""
    side = candidates.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col("confidence") < below).alias("low")).alias("s")).scalar()
    counted = compared.agg(*[F.count_if(F.col("status") == s).alias(n) for s, n in (("hit", "hits"), ("wrong_score", "wrong_scores"), ("miss", "misses"))])
    total = F.col("hits") + F.col("wrong_scores") + F.col("misses")
    return counted.withColumn("__s", side).select(
        "hits", "wrong_scores", "misses", F.try_divide(100.0 * F.col("hits"), total).alias("recall"),
        F.col("__s.n").alias("candidates"), F.col("__s.low").alias("low_confidence"),
    )


def misses_by_year(compared: DataFrame) -> DataFrame:
    return compared.filter("status = 'miss'").groupBy("release_year").agg(F.count(F.lit(1)).alias("n"))


def keyed_candidates(candidates: DataFrame) -> DataFrame:
    return candidates.withColumn("_key", album_key("artist", "album"))


def first_per_key(candidates: DataFrame) -> DataFrame:
    """One candidate per album key: highest confidence, then artist and album."""
    order = F.struct((-F.col("confidence")).alias("a"), F.lower("artist").alias("b"), F.lower("album").alias("c"), F.col("score").alias("d"))
    keyed = keyed_candidates(candidates) if "_key" not in candidates.columns else candidates
    return keyed.groupBy("_key").agg(F.min_by(F.struct(*keyed.columns), order).alias("r")).select("r.*")


def drop_existing(candidates: DataFrame, reviews: DataFrame, allow_duplicates: bool = False, filtered: bool = False) -> DataFrame:
    """Candidates whose album key the corpus doesn't have; ``filtered`` asks a Bloom filter of the corpus's keys first."""
    keyed = candidates if "_key" in candidates.columns else keyed_candidates(candidates)
    if allow_duplicates:
        return keyed
    if filtered:
        return anti_join(keyed, reviews, ["_key"])
    return keyed.join(reviews.select("_key").filter("_key IS NOT NULL").distinct(), "_key", "left_anti")


def already_known(candidates: DataFrame, reviews: DataFrame, filtered: bool = False) -> DataFrame:
    """Candidates whose album key the corpus has; ``filtered`` as in ``drop_existing``."""
    keyed = candidates if "_key" in candidates.columns else keyed_candidates(candidates)
    if filtered:
        return semi_join(keyed, reviews, ["_key"])
    return keyed.join(reviews.select("_key"), "_key", "left_semi")


def candidates_to_reviews(candidates: DataFrame) -> DataFrame:
    """Accepted candidates as review rows; what a page can't tell is null or false."""
    keyed = candidates if "_key" in candidates.columns else keyed_candidates(candidates)
    month = F.col("review_date_approx")
    rows = keyed.select(
        F.concat(F.lit("wayback__"), "_key").alias("id"), "artist", "album", "score",
        F.when(month.isNotNull(), F.concat(month, F.lit("-01"))).alias("review_date"),
        F.substring(month, 1, 4).try_cast("int").alias("review_year"),
        "reviewer", "blurb", *[F.lit(False).alias(c) for c in ("bnm", "bnr", "is_new_release", "is_reissue")], "_key",
    )
    return conform(rows)


def append_reviews(existing: DataFrame, new: DataFrame, schema: str = REVIEW) -> DataFrame:
    return corpus_order(conform(existing, schema).unionByName(conform(new, schema)))


def merge_candidates(candidates: DataFrame, reviews: DataFrame, min_confidence: float = 0.7, allow_duplicates: bool = False) -> DataFrame:
    """The review rows to add; run again after adding them, there are none."""
    kept = keyed_candidates(candidates.filter(F.col("confidence") >= min_confidence))
    fresh = drop_existing(kept if allow_duplicates else first_per_key(kept), reviews, allow_duplicates)
    return candidates_to_reviews(fresh)


def merge_counters(candidates: DataFrame, added: DataFrame, min_confidence: float = 0.7) -> DataFrame:
    n = added.agg(F.count(F.lit(1)).alias("n")).scalar()
    kept = candidates.agg(F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("confidence") >= min_confidence).alias("kept"))
    return kept.select("candidates", "kept", n.alias("added"), (F.col("kept") - n).alias("skipped"))
