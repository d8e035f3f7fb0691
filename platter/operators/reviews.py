"""Building the review table: enrichment, derived columns, formatting, dedupe, genre filling, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from platter.functions.genres import canonical_genres
from platter.functions.text import album_key, clean_text
from platter.schemas import GENRE_SEPARATOR, REVIEW

VARIOUS = "Various Artists"


def enrich_reviews(raw: DataFrame, enrichment: DataFrame) -> DataFrame:
    """Left join of the enrichment by address; a blank address matches nothing."""
    keyed = raw.withColumn("__url", F.when(F.col("url") != "", F.col("url")))
    side = enrichment.select(F.col("url").alias("__url"), "country", "language", "mbid")
    return keyed.join(side, "__url", "left").drop("__url")


def year_of(date: Column) -> Column:
    return F.when(date.rlike("^[0-9]{4}"), F.substring(date, 1, 4).try_cast("int"))


def reissue_flag(bnr: Column, original_year: Column, gap: Column) -> Column:
    return F.coalesce(bnr, F.lit(False)) | F.coalesce(original_year != 0, F.lit(False)) | F.coalesce(gap >= 2, F.lit(False))


def new_release_flag(reissue: Column, gap: Column, tolerance: int = 1) -> Column:
    """Known gap within the tolerance and no reissue; a gap of -2 or an unknown one gives neither flag."""
    return ~reissue & F.coalesce(F.abs(gap) <= tolerance, F.lit(False))


def build_reviews(raw: DataFrame, enrichment: DataFrame, base_url: str = "https://reviews.example", tolerance: int = 1) -> DataFrame:
    """The review table from raw reviews and their enrichment, in one projection over one join."""
    url = F.coalesce("url", F.lit(""))
    joined = enrich_reviews(raw, enrichment).withColumns({"__artist": clean_text("artist"), "__album": clean_text("title")})
    artist = F.when(F.lower("__artist").isin("unknown", ""), VARIOUS).otherwise(F.col("__artist"))
    joined = joined.withColumn("__artist", artist).withColumn("__year", year_of(F.col("date")))
    gap = F.nullif(F.col("__year"), F.lit(0)) - F.col("releaseYear")
    reissue = reissue_flag(F.col("bnr"), F.col("originalYear"), gap)
    return joined.select(
        "id",
        F.col("__artist").alias("artist"),
        F.col("__album").alias("album"),
        "score",
        F.nullif(F.substring("date", 1, 10), F.lit("")).alias("review_date"),
        F.col("__year").alias("review_year"),
        F.col("releaseYear").alias("release_year"),
        F.col("originalYear").alias("original_year"),
        F.array_join("genres", GENRE_SEPARATOR).alias("genres"),
        F.try_element_at("genres", F.lit(1)).alias("genre"),
        F.nullif(clean_text("reviewer"), F.lit("")).alias("reviewer"),
        F.coalesce("bnm", F.lit(False)).alias("bnm"),
        F.coalesce("bnr", F.lit(False)).alias("bnr"),
        new_release_flag(reissue, gap, tolerance).alias("is_new_release"),
        reissue.alias("is_reissue"),
        "country",
        "language",
        "mbid",
        clean_text("description").alias("blurb"),
        F.when(url != "", F.concat(F.lit(base_url), url)).otherwise("").alias("url"),
        F.coalesce("image", F.lit("")).alias("image"),
        album_key("__artist", "__album").alias("_key"),
    )


def conform(df: DataFrame, schema: str = REVIEW) -> DataFrame:
    """Exactly the columns of ``schema``, in its order and types; missing ones are null."""
    fields = [field.split(" ", 1) for field in schema.split(", ")]
    return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in fields])


def missing_genre(c: Column | str = "genres") -> Column:
    value = F.col(c) if isinstance(c, str) else c
    return value.isNull() | (F.trim(value) == "")


def format_reviews(df: DataFrame, schema: str = REVIEW, untagged: str = "Untagged") -> DataFrame:
    """Fixed columns, a label for rows without genre, the corpus's order."""
    full = conform(df, schema)
    missing = missing_genre(F.col("genres"))
    named = full.withColumn("__m", missing).withColumns(
        {c: F.when(F.col("__m"), untagged).otherwise(F.col(c)) for c in ("genres", "genre")}
    )
    return corpus_order(named.drop("__m"))


CORPUS_ORDER = ["review_date", "artist", "id"]


def corpus_order(df: DataFrame) -> DataFrame:
    return df.orderBy(F.asc_nulls_last("review_date"), F.asc_nulls_last("artist"), "id")


def dedupe_albums(df: DataFrame, key: str = "_key", tie: str = "id", keep_unkeyed: bool = False) -> DataFrame:
    """One row per key: highest score (nulls last), then earliest date (nulls last), then ``tie``.

    A grouped minimum, which combines on the map side, so a hot key is no hot task. ``keep_unkeyed``
    keys rows whose key is only the separator by ``tie`` instead of collapsing them.
    """
    keyed = F.when(F.col(key).isin("|", ""), F.concat(F.lit("|"), F.col(tie).cast("string"))).otherwise(F.col(key)) if keep_unkeyed else F.col(key)
    order = F.struct(
        F.col("score").isNull().alias("a"), (-F.col("score")).alias("b"), F.col("review_date").isNull().alias("c"),
        F.col("review_date").alias("d"), F.col(tie).alias("e"),
    )
    best = df.groupBy(keyed.alias("__k")).agg(F.min_by(F.struct(*df.columns), order).alias("row"))
    return best.select("row.*")


def fill_genres(reviews: DataFrame, tags: DataFrame, limit: int | None = None) -> DataFrame:
    """Fill missing genres from crowd tags; only rows without genre are joined.

    ``limit`` tries the first N missing rows by date, artist and id only (0: none). Adds ``filled``.
    """
    missing = reviews.filter(missing_genre())
    if limit is not None:
        chosen = corpus_order(missing).limit(limit)
        rest = missing.join(chosen.select("id"), "id", "left_anti").unionByName(reviews.filter(~missing_genre()))
    else:
        chosen, rest = missing, reviews.filter(~missing_genre())
    # The rules run once a tag row, not once a review.
    mapped = canonical_genres(F.col("album_tags"), F.col("artist_tags"), F.col("artist"), F.col("album"))
    named = tags.select("artist", "album", F.nullif(mapped, F.lit("")).alias("__g"))
    joined = chosen.join(named, ["artist", "album"], "left")
    filled = joined.withColumns(
        {"genres": F.coalesce("__g", "genres"), "genre": F.coalesce(F.substring_index("__g", GENRE_SEPARATOR, 1), "genre"), "filled": F.col("__g").isNotNull()}
    )
    columns = [*reviews.columns, "filled"]
    return filled.select(columns).unionByName(rest.withColumn("filled", F.lit(False)).select(columns))


def _filling() -> dict[str, Column]:
    """What ``fill_genres`` did, told by its own rows: a row it filled had no genre before."""
    return {"missing": F.count_if(F.col("filled") | missing_genre()), "filled": F.count_if("filled"), "unresolved": F.count_if(missing_genre())}


def fill_counters(after: DataFrame) -> DataFrame:
    """One row: ``missing``, ``filled``, ``unresolved``, from the filled rows alone."""
    return after.agg(*[c.alias(n) for n, c in _filling().items()])


def write_filled(after: DataFrame, path: str) -> DataFrame:
    """Write the filled rows as Parquet and return ``fill_counters`` of them, counted by the pass that writes.

    No shuffle lies between the count and the writer, so it runs in the tasks that write: Spark takes each of
    those into account once, also when lost executors make it run some again.
    """
    seen = Observation()
    after.observe(seen, *[c.alias(n) for n, c in _filling().items()]).write.parquet(path)
    counted = seen.get
    return after.sparkSession.createDataFrame([tuple(counted[n] for n in _filling())], "missing long, filled long, unresolved long")
