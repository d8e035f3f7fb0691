"""The registered queries of the library and their SQL equivalents."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platter.functions import text
from platter.functions.genres import canonical_genres
from platter.operators import candidates, captures, extract, match, membership, reviews as build, select, stats
from platter.operators.select import Selection
from platter.operators.steps import bounded_batches, shared_folder, stored
from platter.plans import views
from platter.plans.views import CAPTURES_SQL, EXTRACTIONS_SQL, GENRES_SQL, REVIEWS_SQL, sql_key
from platter.sources import readers, sinks, store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
SHOWN = ["id", "artist", "album", "score", "review_date"]
SHOWN_SQL = "id, artist, album, score, review_date"


def register(sql: str | None = None, also: str | None = None) -> Callable[[Query], Query]:
    """Add a query, and under a second name where an earlier round registered it twice."""

    def add(query: Query) -> Query:
        for name in filter(None, (query.__name__, also)):
            QUERIES[name] = query
            if sql is not None:
                ORACLES[name] = sql
        return query

    return add


_BEST = "score DESC NULLS LAST, review_date ASC NULLS LAST, id"

# --- selections -------------------------------------------------------------------------------------


@register(REVIEWS_SQL + f""", chosen AS (SELECT * FROM reviews WHERE score >= 2 AND NOT coalesce(list_contains(string_split(lower(genres), '; '), '5-low'), false)),
one AS (SELECT * FROM chosen QUALIFY row_number() OVER (PARTITION BY _key ORDER BY {_BEST}) = 1)
SELECT review_year, {SHOWN_SQL} FROM one QUALIFY row_number() OVER (PARTITION BY review_year ORDER BY score DESC, artist, id) <= 3""")
def top_albums(spark, sf_dir):
    """Flagship: filtered, one row per album, the best three of each year, by score."""
    spec = Selection(min_score=2.0, exclude_genres=["5-LOW"], dedupe=True, top_per_review_year=3)
    return select.run_selection(views.reviews(spark, sf_dir, keyed=True), spec).select("review_year", *SHOWN)


def _selection(name: str, spec: Selection, where: str) -> None:
    def query(spark, sf_dir):
        return select.select_reviews(views.reviews(spark, sf_dir), spec).select(SHOWN)

    query.__name__ = name
    register(f"{REVIEWS_SQL} SELECT {SHOWN_SQL} FROM reviews WHERE score IS NOT NULL AND {where}")(query)


_GENRES = "string_split(lower(coalesce(genres, '')), '; ')"
_selection("filter_score_range", Selection(min_score=3.0, max_score=7.4), "score BETWEEN 3.0 AND 7.4")
_selection("filter_years", Selection(review_year="1994,1996-1997", release_year="1993-1996"),
           "(review_year = 1994 OR review_year BETWEEN 1996 AND 1997) AND release_year BETWEEN 1993 AND 1996")
_selection("filter_genres", Selection(genres=["1-urgent", "ECONOMY"]), f"(list_contains({_GENRES}, '1-urgent') OR list_contains({_GENRES}, 'economy'))")
_selection("filter_exclude_genres", Selection(exclude_genres=["1-URGENT"]), f"NOT list_contains({_GENRES}, '1-urgent')")
_selection("filter_no_genre", Selection(no_genre=True), "coalesce(genres, '') = ''")
_selection("filter_places", Selection(countries=["nation_1", "Nation_7", "france"], languages=["ASIA", "europe"]),
           "upper(country) IN ('NATION_1', 'NATION_7', 'FRANCE') AND lower(language) IN ('asia', 'europe')")
_selection("filter_flags", Selection(bnm=False, new_releases=True), "NOT bnm AND is_new_release")
_selection("filter_reissues", Selection(bnr=True, reissues=True), "bnr AND is_reissue")
_selection("filter_names", Selection(artist="00001", reviewer="BUILD"), "lower(artist) LIKE '%00001%' AND lower(reviewer) LIKE '%build%'")
_selection("filter_search", Selection(search="1 B"), "lower(artist || ' ' || album || ' ' || blurb || ' ' || reviewer) LIKE '%1 b%'")


@register(REVIEWS_SQL + f"SELECT {SHOWN_SQL}, _key FROM reviews QUALIFY row_number() OVER (PARTITION BY _key ORDER BY {_BEST}) = 1")
def dedupe_albums(spark, sf_dir):
    return build.dedupe_albums(views.reviews(spark, sf_dir, keyed=True)).select(*SHOWN, "_key")


def _top(name: str, column: str) -> None:
    def query(spark, sf_dir):
        return select.top_per(views.reviews(spark, sf_dir), column, 5).select(column, *SHOWN)

    query.__name__ = name
    register(f"{REVIEWS_SQL} SELECT {column}, {SHOWN_SQL} FROM reviews "
             f"QUALIFY row_number() OVER (PARTITION BY {column} ORDER BY score DESC, artist, id) <= 5")(query)


_top("top_per_review_year", "review_year")
_top("top_per_release_year", "release_year")


def _sorted(name: str, how: str, order: str) -> None:
    def query(spark, sf_dir):
        return select.run_selection(views.reviews(spark, sf_dir), Selection(sort=how)).select(SHOWN)

    query.__name__ = name
    register(f"{REVIEWS_SQL} SELECT {SHOWN_SQL} FROM reviews WHERE score IS NOT NULL ORDER BY {order}, id", also=f"full_{name}")(query)


_sorted("sort_score", "score", "score DESC NULLS LAST, artist")
_sorted("sort_score_asc", "score-asc", "score ASC NULLS LAST, artist")
_sorted("sort_date", "date", "review_date, artist")
_sorted("sort_date_desc", "date-desc", "review_date DESC NULLS LAST, artist")
_sorted("sort_release", "release", "release_year ASC NULLS FIRST, artist ASC NULLS FIRST")
_sorted("sort_artist", "artist", "lower(artist), lower(album)")


@register(f"{REVIEWS_SQL} SELECT {SHOWN_SQL} FROM reviews WHERE score IS NOT NULL ORDER BY score DESC NULLS LAST, artist, id LIMIT 200")
def top_reviews(spark, sf_dir):
    """The best 200 reviews: a top-k report."""
    return select.run_selection(views.reviews(spark, sf_dir), Selection(sort="score", limit=200)).select(SHOWN)


@register()
def sort_random(spark, sf_dir):
    """A repeatable shuffle; SQL engines share no hash, so it is tested for repeatability."""
    return select.sort_reviews(views.reviews(spark, sf_dir), "random", seed=7).select(SHOWN)


# --- building ---------------------------------------------------------------------------------------


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review view in the shape of raw records, with entities, blanks and missing values."""
    r = views.reviews(spark, sf_dir)
    hot = F.col("score") >= 9.8
    return r.select(
        "id",
        F.when(F.col("score") == 0.2, "Unknown").otherwise(F.concat(F.col("artist"), F.lit(" &amp;amp; Co​"))).alias("artist"),
        F.concat(F.lit("  "), F.col("album"), F.lit(" ")).alias("title"),
        F.when(hot, "").otherwise(F.concat(F.lit("/r/"), F.col("country"))).alias("url"),
        F.concat("review_date", F.lit("T00:00:00")).alias("date"), F.col("release_year").alias("releaseYear"),
        F.col("original_year").alias("originalYear"), "score", F.split("genres", "; ").alias("genres"), "reviewer", "bnm", "bnr",
        F.col("blurb").alias("description"), F.lit(None).cast("string").alias("image"),
    )


def enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = views.table(spark, sf_dir, "nation"), views.table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("/r/"), F.col("n_name")).alias("url"), F.col("n_name").alias("country"), F.col("r_name").alias("language"),
        F.concat(F.lit("m"), F.col("n_nationkey").cast("string")).alias("mbid"),
    )


@register(REVIEWS_SQL + f"""SELECT id, CASE WHEN score = 0.2 THEN 'Various Artists' ELSE artist || ' & Co' END AS artist, album, score, review_date, review_year,
  release_year, coalesce(original_year, 0) AS original_year, genres, genre, bnm, bnr, is_new_release, is_reissue,
  CASE WHEN score < 9.8 THEN country END AS country, CASE WHEN score < 9.8 THEN language END AS language,
  CASE WHEN score < 9.8 THEN 'https://reviews.example/r/' || country ELSE '' END AS url, '' AS image,
  reviewer, blurb, CASE WHEN score < 9.8 THEN 'm' || n_nationkey END AS mbid,
  CASE WHEN score = 0.2 THEN 'variousartists' ELSE {sql_key("artist")} || 'co' END || '|' || {sql_key("album")} AS _key
  FROM reviews JOIN nation ON n_name = country""")
def build_reviews(spark, sf_dir):
    built = build.build_reviews(raw_reviews(spark, sf_dir), enrichment(spark, sf_dir))
    return built.withColumn("original_year", F.coalesce("original_year", F.lit(0)))


@register(REVIEWS_SQL + """SELECT id, artist, coalesce(genres, 'Untagged') AS genres, coalesce(genre, 'Untagged') AS genre, NULL::VARCHAR AS mbid FROM reviews""")
def format_reviews(spark, sf_dir):
    return build.format_reviews(views.reviews(spark, sf_dir)).select("id", "artist", "genres", "genre", "mbid")


@register(REVIEWS_SQL + f""", t AS (SELECT *, {GENRES_SQL} AS g FROM reviews)
SELECT id, CASE WHEN genres IS NULL THEN nullif(g, '') ELSE genres END AS genres,
  CASE WHEN genres IS NULL THEN nullif(split_part(g, '; ', 1), '') ELSE genre END AS genre, (genres IS NULL AND g <> '') AS filled FROM t""")
def fill_genres(spark, sf_dir):
    return build.fill_genres(views.reviews(spark, sf_dir), views.crowd_tags(spark, sf_dir)).select("id", "genres", "genre", "filled")


_FILLING = REVIEWS_SQL + f"""SELECT count(*) AS missing, count(*) FILTER ({GENRES_SQL} <> '') AS filled,
  count(*) FILTER ({GENRES_SQL} = '') AS unresolved FROM reviews WHERE genres IS NULL"""


@register(_FILLING)
def fill_counters(spark, sf_dir):
    return build.fill_counters(build.fill_genres(views.reviews(spark, sf_dir), views.crowd_tags(spark, sf_dir)))


@register(_FILLING)
def fill_written(spark, sf_dir):
    """The filled table is written, and counted while it is."""
    return build.write_filled(build.fill_genres(views.reviews(spark, sf_dir), views.crowd_tags(spark, sf_dir)), _folder(spark))


#: Buckets and junk of a user: what the fixed lists would name otherwise, or not at all.
_USER_BUCKETS = [("Live", ["live"]), ("Beats", ["rap", "trap", "house"]), ("Guitars", ["rock", "punk", "indie"])]
_USER_JUNK = ["folk", "jazz"]


@register(REVIEWS_SQL + """SELECT DISTINCT artist, album, CASE (length(album) + try_cast(right(artist, 1) AS INT)) % 6
  WHEN 0 THEN 'Live; Beats' WHEN 2 THEN 'Beats' WHEN 3 THEN 'Live' WHEN 4 THEN 'Guitars; Beats' ELSE '' END AS genres FROM reviews""")
def user_genre_rules(spark, sf_dir):
    """Genres by rules that the user hands over."""
    tags = views.crowd_tags(spark, sf_dir).withColumn("album_tags", F.when(F.array_contains("album_tags", "pop rap"), F.reverse("album_tags")).otherwise(F.col("album_tags")))
    named = canonical_genres(F.col("album_tags"), F.col("artist_tags"), F.col("artist"), F.col("album"), _USER_BUCKETS, _USER_JUNK)
    return tags.select("artist", "album", named.alias("genres"))


@register(REVIEWS_SQL + f"SELECT DISTINCT artist, album, {GENRES_SQL} AS genres FROM reviews")
def canonical_genre_tags(spark, sf_dir):
    tags = views.crowd_tags(spark, sf_dir)
    return tags.select("artist", "album", canonical_genres(F.col("album_tags"), F.col("artist_tags"), F.col("artist"), F.col("album")).alias("genres"))


@register(REVIEWS_SQL + "SELECT review_year, max(review_date) AS latest, count(*) AS n FROM reviews WHERE review_year = (SELECT max(review_year) FROM reviews) GROUP BY 1")
def latest_snapshot(spark, sf_dir):
    rows = readers.latest_snapshot(views.reviews(spark, sf_dir), "review_year")
    return rows.groupBy("review_year").agg(F.max("review_date").alias("latest"), F.count(F.lit(1)).alias("n"))


@register(REVIEWS_SQL + """SELECT '| ' || concat_ws(' | ', score::VARCHAR, artist, album, release_year::VARCHAR, coalesce(genre, '')) || ' |' AS value FROM reviews""")
def export_markdown(spark, sf_dir):
    return sinks.export_markdown(views.reviews(spark, sf_dir))


@register(REVIEWS_SQL + "SELECT artist || ' - ' || album AS value, count(*) AS n FROM reviews GROUP BY 1")
def export_lines(spark, sf_dir):
    return sinks.export_lines(views.reviews(spark, sf_dir)).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@register(REVIEWS_SQL + "SELECT id, CASE WHEN bnm THEN 'BNM' WHEN bnr THEN 'BNR' ELSE '' END AS badge FROM reviews")
def badges(spark, sf_dir):
    return views.reviews(spark, sf_dir).select("id", select.badge(F.col("bnm"), F.col("bnr")).alias("badge"))


# --- statistics -------------------------------------------------------------------------------------


@register(REVIEWS_SQL + """SELECT count(*) AS reviews, min(review_year) AS first_year, max(review_year) AS last_year,
  count(*) FILTER (is_new_release) AS new_releases, count(*) FILTER (is_reissue) AS reissues, count(*) FILTER (bnm) AS bnm,
  count(*) FILTER (score = 10) AS perfect, count(*) FILTER (score >= 9) AS nine_plus,
  count(DISTINCT country) AS countries, count(DISTINCT reviewer) AS reviewers FROM reviews""")
def summarize_reviews(spark, sf_dir):
    return stats.summarize_reviews(views.reviews(spark, sf_dir))


_EXPLODED = REVIEWS_SQL + ", exploded AS (SELECT *, unnest(CASE WHEN genres IS NULL THEN ['(untagged)'] ELSE string_split(genres, '; ') END) AS value FROM reviews) "


@register(_EXPLODED + "SELECT value, count(*) AS n FROM exploded GROUP BY 1")
def genre_counts(spark, sf_dir):
    return stats.genre_counts(views.reviews(spark, sf_dir))


@register(REVIEWS_SQL + "SELECT coalesce(genre, '(untagged)') AS value, count(*) AS n FROM reviews GROUP BY 1")
def first_genre_counts(spark, sf_dir):
    return stats.first_genre_counts(views.reviews(spark, sf_dir))


@register(REVIEWS_SQL + "SELECT country AS value, count(*) AS n FROM reviews GROUP BY 1")
def country_counts(spark, sf_dir):
    return stats.value_counts(views.reviews(spark, sf_dir), "country")


@register(REVIEWS_SQL + "SELECT coalesce(original_year::VARCHAR, '(unknown)') AS value, count(*) AS n FROM reviews GROUP BY 1")
def unknown_value_counts(spark, sf_dir):
    return stats.value_counts(views.reviews(spark, sf_dir), "original_year")


@register(REVIEWS_SQL + "SELECT review_year, count(*) AS n FROM reviews GROUP BY 1")
def reviews_per_year(spark, sf_dir):
    return stats.reviews_per_year(views.reviews(spark, sf_dir))


@register(REVIEWS_SQL + """SELECT review_year, round(avg(score), 6) AS mean, round(quantile_cont(score, 0.5), 6) AS median,
  round(quantile_cont(score, 0.25), 6) AS q1, round(quantile_cont(score, 0.75), 6) AS q3 FROM reviews GROUP BY 1""")
def score_stats_per_year(spark, sf_dir):
    found = stats.score_stats_by(views.reviews(spark, sf_dir))
    return found.select("review_year", *[F.round(c, 6).alias(c) for c in ("mean", "median", "q1", "q3")])


@register(_EXPLODED + "SELECT value, count(*) AS n FROM exploded GROUP BY 1 ORDER BY n DESC, value LIMIT 10")
def top_genres(spark, sf_dir):
    return stats.top_values(stats.genre_counts(views.reviews(spark, sf_dir)), 10)


@register(REVIEWS_SQL + "SELECT country AS value, count(*) AS n FROM reviews GROUP BY 1 ORDER BY n DESC, value LIMIT 15")
def top_countries(spark, sf_dir):
    return stats.top_values(stats.value_counts(views.reviews(spark, sf_dir), "country"), 15)


@register(REVIEWS_SQL + """, e AS (SELECT unnest(string_split(genres, '; ')) AS value, score FROM reviews WHERE genres IS NOT NULL),
top AS (SELECT value FROM e GROUP BY 1 ORDER BY count(*) DESC, value LIMIT 10),
b AS (SELECT value, quantile_cont(score, 0.25) AS q1, quantile_cont(score, 0.5) AS median, quantile_cont(score, 0.75) AS q3 FROM e SEMI JOIN top USING (value) GROUP BY 1)
SELECT value, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
  min(score) AS whisker_low, max(score) AS whisker_high FROM e JOIN b USING (value)
WHERE score BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY value""")
def genre_box_stats(spark, sf_dir):
    found = stats.box_stats(views.reviews(spark, sf_dir))
    return found.select("value", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")], "whisker_low", "whisker_high")


_PRICE_STATS = """SELECT year(l_shipdate)::INTEGER AS review_year, round(avg(l_extendedprice), 4) AS mean, round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
  round(quantile_cont(l_extendedprice, 0.25), 4) AS q1, round(quantile_cont(l_extendedprice, 0.75), 4) AS q3 FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1"""


@register(_PRICE_STATS)
def price_stats_per_year(spark, sf_dir):
    """Quartiles of a column with a distinct value in nearly every row."""
    lines = views.table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("review_year"), F.col("l_extendedprice").cast("double").alias("price"))
    found = stats.score_stats_by(lines, value="price", many_values=True)
    return found.select("review_year", *[F.round(c, 4).alias(c) for c in ("mean", "median", "q1", "q3")])


@register("""WITH e AS (SELECT unnest([p_type, l_returnflag]) AS value, l_extendedprice::DOUBLE AS price FROM lineitem JOIN part ON l_partkey = p_partkey),
top AS (SELECT value FROM e GROUP BY 1 ORDER BY count(*) DESC, value LIMIT 10),
b AS (SELECT value, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median, quantile_cont(price, 0.75) AS q3 FROM e SEMI JOIN top USING (value) GROUP BY 1)
SELECT value, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3,
  min(price) AS whisker_low, max(price) AS whisker_high FROM e JOIN b USING (value)
WHERE price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY value""")
def price_box_stats(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem").join(views.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = lines.select(F.concat_ws("; ", "p_type", "l_returnflag").alias("genres"), F.col("l_extendedprice").cast("double").alias("price"))
    found = stats.box_stats(rows, "price", many_values=True)
    return found.select("value", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")], "whisker_low", "whisker_high")


@register(REVIEWS_SQL + "SELECT review_year, count(*) FILTER (bnm) AS bnm, count(*) FILTER (bnr) AS bnr FROM reviews GROUP BY 1")
def badges_per_year(spark, sf_dir):
    return stats.badges_per_year(views.reviews(spark, sf_dir))


@register("""SELECT least(floor((l_extendedprice - lo) / ((hi - lo) / 40)) + 1, 40)::INTEGER AS bin, count(*) AS n
  FROM lineitem, (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem) GROUP BY 1""")
def price_histogram(spark, sf_dir):
    return stats.histogram(views.table(spark, sf_dir, "lineitem"), "l_extendedprice", 40)


# --- captures, extraction, candidates -----------------------------------------------------------------


def _manifest(spark, sf_dir):
    kept = captures.filter_captures(views.captures_index(spark, sf_dir), "/(en|fr)/", 1997, 2002)
    return captures.distinct_captures(kept)


@register(CAPTURES_SQL + "SELECT * FROM manifest")
def capture_manifest(spark, sf_dir):
    return captures.manifest_order(_manifest(spark, sf_dir))


@register(CAPTURES_SQL + """, timeline AS (SELECT *, lag(digest) OVER (PARTITION BY original ORDER BY timestamp, digest) AS before FROM filtered)
SELECT timestamp, original AS url, min(digest) AS digest FROM timeline WHERE before IS DISTINCT FROM digest GROUP BY ALL""")
def captures_by_digest(spark, sf_dir):
    kept = captures.filter_captures(views.captures_index(spark, sf_dir), "/(en|fr)/", 1997, 2002)
    return captures.distinct_captures(kept, by_digest=True)


_URL_KEY = "right(regexp_replace(url, '[^A-Za-z0-9]+', '_', 'g'), 90)"


@register(CAPTURES_SQL + f"SELECT timestamp, {_URL_KEY} AS url_key, url, digest FROM manifest WHERE digest NOT LIKE '%3'")
def pending_captures(spark, sf_dir):
    manifest = _manifest(spark, sf_dir)
    done = manifest.filter(F.col("digest").endswith("3")).select("timestamp", text.url_key("url").alias("url_key"))
    return captures.pending_captures(manifest, done)


@register(CAPTURES_SQL + f"SELECT timestamp, {_URL_KEY} AS url_key, url, digest FROM manifest WHERE digest NOT LIKE '%3'")
def pending_captures_filtered(spark, sf_dir):
    """A Bloom filter of the finished captures tells most pending ones before any shuffle."""
    manifest = _manifest(spark, sf_dir)
    done = manifest.filter(F.col("digest").endswith("3")).select("timestamp", text.url_key("url").alias("url_key"))
    return captures.pending_captures(manifest, done, filtered=True)


@register(CAPTURES_SQL + "SELECT timestamp[1:4] AS year, count(*) AS n FROM manifest GROUP BY 1")
def captures_per_year(spark, sf_dir):
    return captures.captures_per_year(_manifest(spark, sf_dir))


@register("SELECT lower(t) AS tag, count(*) AS n FROM (SELECT unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS t FROM pages) GROUP BY 1 ORDER BY n DESC, tag LIMIT 15")
def tag_histogram(spark, sf_dir):
    return captures.tag_histogram(views.table(spark, sf_dir, "pages"))


@register("SELECT page_id, lower(t) AS tag, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS t FROM pages) GROUP BY page_id, lower(t)")
def page_tag_counts(spark, sf_dir):
    return captures.tag_counts(views.table(spark, sf_dir, "pages"), by="page_id")


def _extracted(spark, sf_dir):
    return extract.extracted(extract.extract_records(views.page_rows(spark, sf_dir)))


@register(EXTRACTIONS_SQL + "SELECT * FROM extractions")
def extract_records(spark, sf_dir):
    return _extracted(spark, sf_dir).select("capture_file", "capture_timestamp", "review_date_approx", "extractor", "artist", "album", "score")


@register("""SELECT '19980301_' || p_partkey AS capture_file, ['meta_comment', 'rating_label', 'heading_score', 'score_out_of_ten'][p_partkey % 4 + 1] AS extractor,
  p_brand AS artist, p_name AS album, (p_size % 10)::DOUBLE AS score, CASE WHEN p_partkey % 4 < 2 THEN 'Ann Example' END AS reviewer,
  CASE WHEN p_partkey % 4 = 0 THEN p_type END AS label, '1998-03' AS review_date_approx FROM part""")
def extract_layouts(spark, sf_dir):
    """The four layouts that tables of links don't have, a page a part."""
    found = extract.extracted(extract.extract_records(views.layout_pages(spark, sf_dir)))
    return found.select("capture_file", "extractor", "artist", "album", "score", "reviewer", "label", "review_date_approx")


@register(EXTRACTIONS_SQL + ", c AS (SELECT extractor, count(*) AS n FROM extractions GROUP BY 1) SELECT * FROM c UNION ALL SELECT x, 0 FROM (VALUES ('meta_comment'), ('rating_label'), ('heading_score'), ('score_out_of_ten')) v(x)")
def rows_per_extractor(spark, sf_dir):
    names = spark.createDataFrame([(e.__name__,) for e in extract.EXTRACTORS], "extractor string")
    return captures.rows_per_extractor(_extracted(spark, sf_dir), names)


@register(EXTRACTIONS_SQL + "SELECT capture_file, count(*) AS n FROM extractions GROUP BY 1")
def capture_yield(spark, sf_dir):
    return captures.capture_yield(views.page_rows(spark, sf_dir), _extracted(spark, sf_dir)).select("capture_file", "n")


_LAYOUTS = r"""SELECT '19980301_' || p_partkey AS capture_file, CASE p_partkey % 4
  WHEN 0 THEN concat_ws(chr(10), '<!--', '1_artist: ' || p_brand, '2_title: ' || p_name, '3_label: ' || p_type, '4_rating: ' || p_size % 10 || '.0', '5_author: Ann Example', '-->')
  WHEN 1 THEN '<p>' || p_brand || ': ' || p_name || '</p><p>Reviewed by Ann Example, who</p><p>wrote of 1997.</p><p>Rating: ' || p_size % 10 || '.0</p>'
  WHEN 2 THEN '<h3>' || p_brand || ': ' || p_name || '</h3><p>some words.</p><p>' || p_size % 10 || '.0</p>'
  ELSE '<p>' || p_brand || ': ' || p_name || '</p><p>some words.</p><p>' || p_size % 10 || '.0 / 10</p>' END AS html FROM part"""


@register(f"SELECT capture_file, strlen(html) AS bytes, 1::BIGINT AS n FROM ({_LAYOUTS}) UNION ALL SELECT 'p' || page_id, strlen(html), 0 FROM pages")
def capture_yield_mixed(spark, sf_dir):
    """Sizes and records of captures of which many hold no record."""
    empty = views.table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("capture_file"), F.lit("20000101").alias("timestamp"), "html")
    pages = views.layout_pages(spark, sf_dir).unionByName(empty)
    return captures.capture_yield(pages, extract.extracted(extract.extract_records(pages)))


@register("""WITH pairs AS (SELECT p_brand AS artist, p_name AS album, p_partkey % 5 AS s, p_partkey AS k FROM part)
SELECT artist, album, arg_max(s, k)::DOUBLE AS score, (1990 + max(k) % 9)::INTEGER AS release_year, 0.0::DOUBLE AS found_score,
  CASE WHEN arg_max(s, k) = 0 THEN 'hit' ELSE 'wrong_score' END AS status FROM pairs GROUP BY ALL""")
def compare_to_last_truth(spark, sf_dir):
    """Of several truth rows of an album, the last one counts."""
    part = views.table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    truth = part.select(F.col("p_brand").alias("artist"), F.col("p_name").alias("album"), (k % 5).cast("double").alias("score"), (F.lit(1990) + k % 9).cast("int").alias("release_year"), k.alias("k"))
    found = part.select(F.col("p_brand").alias("artist"), F.col("p_name").alias("album"), F.lit(0.0).alias("score"), F.lit(0.9).alias("confidence")).distinct()
    return candidates.compare_to_truth(found, truth, order="k").drop("k")


_CANDIDATES = EXTRACTIONS_SQL + r""", keyed AS (SELECT *, regexp_replace(lower(artist), '[^a-z0-9]+', '', 'g') AS ka,
  regexp_replace(regexp_replace(lower(album), '\b(the|a|an|ep|lp|and)\b', ' ', 'g'), '[^a-z0-9]+', '', 'g') AS kb FROM extractions),
votes AS (SELECT ka, kb, score, count(*) AS v, min(capture_file) AS f, any_value(artist) AS artist, any_value(album) AS album, min(review_date_approx) AS m FROM keyed GROUP BY ALL),
candidates AS (SELECT any_value(artist) AS artist, any_value(album) AS album, arg_min(score, (-v, f)) AS score, sum(v)::BIGINT AS n_captures,
  max(v) / sum(v) AS share, min(m) AS review_date_approx, count(*) AS n_scores,
  array_to_string(list_transform(list_sort(list(score)), lambda x: x::VARCHAR), ' ') AS scores FROM votes GROUP BY ka, kb),
rated AS (SELECT *, round_even(least(1.0, 0.4 + 0.2 * least(n_captures, 2) + 0.2 * share), 2) AS confidence FROM candidates) """


def _collapsed(spark, sf_dir):
    return candidates.collapse_candidates(_extracted(spark, sf_dir))


@register(_CANDIDATES + """SELECT artist, album, score, n_captures, f.n_distinct_captures, review_date_approx, 'anchor_then_score; table_rows' AS extractors,
  CASE WHEN n_scores > 1 THEN scores END AS score_variants, round_even(share, 2) AS score_agreement, confidence,
  NULL::VARCHAR AS reviewer, NULL::VARCHAR AS blurb, 'wayback' AS source
  FROM rated JOIN (SELECT ka, kb, count(DISTINCT capture_file) AS n_distinct_captures FROM keyed GROUP BY ALL) f
  ON ka = regexp_replace(lower(artist), '[^a-z0-9]+', '', 'g')
  AND kb = regexp_replace(regexp_replace(lower(album), '\\b(the|a|an|ep|lp|and)\\b', ' ', 'g'), '[^a-z0-9]+', '', 'g')""")
def collapse_candidates(spark, sf_dir):
    variants = F.array_join(F.transform("score_variants", lambda x: x.cast("string")), " ").alias("score_variants")
    return _collapsed(spark, sf_dir).select(
        "artist", "album", "score", "n_captures", "n_distinct_captures", "review_date_approx", F.array_join("extractors", "; ").alias("extractors"),
        variants, "score_agreement", "confidence", "reviewer", "blurb", "source",
    )


@register(_CANDIDATES + "SELECT artist, album, confidence FROM rated ORDER BY confidence DESC, lower(artist), lower(album)")
def candidate_order(spark, sf_dir):
    return candidates.candidate_order(_collapsed(spark, sf_dir)).select("artist", "album", "confidence")


@register(_CANDIDATES + "SELECT artist, album FROM candidates WHERE n_scores > 1")
def score_disagreements(spark, sf_dir):
    return candidates.score_disagreements(_collapsed(spark, sf_dir)).select("artist", "album")


def _truth(spark, sf_dir):
    """Known scores of all parts; some are off, every tenth album is unknown to the pages."""
    part = views.table(spark, sf_dir, "part")
    known = part.groupBy("p_brand", "p_name").agg(F.max("p_partkey").alias("k"), F.max_by(F.col("p_size") % 10, "p_partkey").alias("s"))
    album = F.when(F.col("k") % 10 == 0, F.concat(F.lit("Lost "), F.col("p_name"))).otherwise(F.col("p_name"))
    score = (F.col("s") + F.when(F.col("k") % 4 == 0, 1).otherwise(0)).cast("double").alias("score")
    return known.select(F.upper("p_brand").alias("artist"), album.alias("album"), score, (F.lit(1990) + F.col("k") % 9).cast("int").alias("release_year"))


_TRUTH = _CANDIDATES + r""", known AS (SELECT p_brand, p_name, max(p_partkey) AS k, arg_max(p_size % 10, p_partkey) AS s FROM part GROUP BY ALL),
truth AS (SELECT upper(p_brand) AS artist, CASE WHEN k % 10 = 0 THEN 'Lost ' || p_name ELSE p_name END AS album,
  (s + CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END)::DOUBLE AS score, (1990 + k % 9)::INTEGER AS release_year FROM known),
compared AS (SELECT t.*, c.score AS found_score, CASE WHEN c.score IS NULL THEN 'miss' WHEN abs(c.score - t.score) <= 0.05 THEN 'hit' ELSE 'wrong_score' END AS status
  FROM truth t LEFT JOIN candidates c ON lower(c.artist) = lower(t.artist) AND c.album = t.album) """
#: A share of three votes in four or less is low here, so that the given tables have candidates on both sides.
_LOW = 0.95


@register(_TRUTH + "SELECT * FROM compared", also="compare_to_whole_truth")
def compare_to_truth(spark, sf_dir):
    return candidates.compare_to_truth(_collapsed(spark, sf_dir), _truth(spark, sf_dir))


@register(_TRUTH + f"""SELECT count(*) FILTER (status = 'hit') AS hits, count(*) FILTER (status = 'wrong_score') AS wrong_scores,
  count(*) FILTER (status = 'miss') AS misses, 100.0::DOUBLE * count(*) FILTER (status = 'hit') / count(*) AS recall,
  (SELECT count(*) FROM candidates) AS candidates, (SELECT count(*) FROM rated WHERE confidence < {_LOW}) AS low_confidence FROM compared""",
  also="validation_scorecard_whole")
def validation_scorecard(spark, sf_dir):
    found = _collapsed(spark, sf_dir)
    return candidates.validation_scorecard(candidates.compare_to_truth(found, _truth(spark, sf_dir)), found, below=_LOW)


@register(_TRUTH + "SELECT release_year, count(*) AS n FROM compared WHERE status = 'miss' GROUP BY 1", also="misses_by_year_whole")
def misses_by_year(spark, sf_dir):
    return candidates.misses_by_year(candidates.compare_to_truth(_collapsed(spark, sf_dir), _truth(spark, sf_dir)))


@register(_TRUTH + f"""SELECT c.artist, c.album FROM rated c WHERE confidence < {_LOW}
  AND NOT EXISTS (SELECT 1 FROM truth t WHERE lower(t.artist) = lower(c.artist) AND t.album = c.album)""", also="unverified_candidates_whole")
def unverified_candidates(spark, sf_dir):
    return candidates.unverified_low_confidence(_collapsed(spark, sf_dir), _truth(spark, sf_dir), below=_LOW).select("artist", "album")


def _corpus(spark, sf_dir):
    """Every fourth candidate's album is already in the corpus."""
    part = views.table(spark, sf_dir, "part").select("p_brand", "p_name").distinct().filter(F.length("p_name") % 4 == 0)
    return part.select(F.concat_ws("/", "p_brand", "p_name").alias("id"), F.col("p_brand").alias("artist"), F.col("p_name").alias("album"), text.album_key("p_brand", "p_name").alias("_key"))


_MERGED = _CANDIDATES + f""", fresh AS (SELECT *, {sql_key('artist')} || '|' || {sql_key('album')} AS _key FROM candidates WHERE length(album) % 4 <> 0) """


@register(_MERGED + """SELECT 'wayback__' || _key AS id, artist, album, score, review_date_approx || '-01' AS review_date,
  review_date_approx[1:4]::INTEGER AS review_year, false AS bnm, NULL::VARCHAR AS genres, _key FROM fresh""")
def merge_candidates(spark, sf_dir):
    added = candidates.merge_candidates(_collapsed(spark, sf_dir), _corpus(spark, sf_dir))
    return added.select("id", "artist", "album", "score", "review_date", "review_year", "bnm", "genres", "_key")


@register(_CANDIDATES + f"SELECT artist, album, score FROM rated WHERE confidence >= {_LOW} AND length(album) % 4 <> 0")
def merge_confident(spark, sf_dir):
    """Only candidates on which the captures agree are added."""
    return candidates.merge_candidates(_collapsed(spark, sf_dir), _corpus(spark, sf_dir), min_confidence=_LOW).select("artist", "album", "score")


@register(_CANDIDATES + "SELECT artist, album FROM candidates WHERE length(album) % 4 = 0")
def already_known(spark, sf_dir):
    return candidates.already_known(_collapsed(spark, sf_dir), _corpus(spark, sf_dir)).select("artist", "album")


_LINE_KEYS = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE {} (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderdate >= DATE '1997-01-01')"


def _recent_orders(spark, sf_dir):
    return views.table(spark, sf_dir, "orders").filter("o_orderdate >= DATE '1997-01-01'").select(F.col("o_orderkey").alias("l_orderkey"))


def _line_keys(spark, sf_dir):
    return views.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@register(_LINE_KEYS.format("NOT EXISTS"))
def lines_not_known(spark, sf_dir):
    """Anti join of a large table with many keys, behind a Bloom filter."""
    return membership.anti_join(_line_keys(spark, sf_dir), _recent_orders(spark, sf_dir), ["l_orderkey"])


@register(_LINE_KEYS.format("EXISTS"))
def lines_known(spark, sf_dir):
    return membership.semi_join(_line_keys(spark, sf_dir), _recent_orders(spark, sf_dir), ["l_orderkey"])


@register(_CANDIDATES + "SELECT artist, album FROM candidates WHERE length(album) % 4 = 0")
def already_known_filtered(spark, sf_dir):
    return candidates.already_known(_collapsed(spark, sf_dir), _corpus(spark, sf_dir), filtered=True).select("artist", "album")


@register(_MERGED + "SELECT 'wayback__' || _key AS id, artist, album FROM fresh UNION ALL SELECT DISTINCT p_brand || '/' || p_name, p_brand, p_name FROM part WHERE length(p_name) % 4 = 0")
def append_reviews(spark, sf_dir):
    corpus = _corpus(spark, sf_dir)
    return candidates.append_reviews(corpus, candidates.merge_candidates(_collapsed(spark, sf_dir), corpus)).select("id", "artist", "album")


@register(_MERGED + "SELECT (SELECT count(*) FROM candidates) AS candidates, (SELECT count(*) FROM candidates) AS kept, count(*) AS added, (SELECT count(*) FROM candidates) - count(*) AS skipped FROM fresh")
def merge_counters(spark, sf_dir):
    found = _collapsed(spark, sf_dir)
    return candidates.merge_counters(found, candidates.merge_candidates(found, _corpus(spark, sf_dir)))


@register("SELECT page_id AS key, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(regexp_replace(html, '[0-9.]*[0-9][0-9.]*', '\\0 ', 'g'), '[0-9.]*[0-9][0-9.]*')) AS t FROM pages) WHERE regexp_full_match(t, '10(\\.0)?|[0-9](\\.[0-9])?') GROUP BY 1")
def score_snippets(spark, sf_dir):
    found = extract.score_snippets(views.table(spark, sf_dir, "pages"), "page_id", "html")
    return found.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


_MARKED = "'Score 7.' || (p_size % 10) || chr(10) || p_name || repeat(' ', 60 + p_size % 50) || 'then ' || p_brand || ': 10.0 of ten'"


@register(f"""WITH t AS (SELECT p_partkey AS key, {_MARKED} AS text FROM part),
n AS (SELECT key, text, 7 AS spot, 3 AS width, 'first' AS place FROM t UNION ALL SELECT key, text, strpos(text, ': 10.0') + 2, 4, 'last' FROM t)
SELECT key, place, replace(substr(text, greatest(1, spot - 200), spot + width + 80 - greatest(1, spot - 200)), chr(10), ' ') AS snippet FROM n""")
def snippet_windows(spark, sf_dir):
    """The surroundings of the first and last number of each text."""
    size = F.col("p_size")
    gap = F.repeat(F.lit(" "), (F.lit(60) + size % 50).cast("int"))
    value = F.concat(F.lit("Score 7."), (size % 10).cast("string"), F.lit("\n"), F.col("p_name"), gap, F.lit("then "), F.col("p_brand"), F.lit(": 10.0 of ten"))
    found = extract.score_snippets(views.table(spark, sf_dir, "part").select("p_partkey", value.alias("text")), "p_partkey", "text")
    ends = found.groupBy("key").agg(F.min_by("snippet", "pos").alias("first"), F.max_by("snippet", "pos").alias("last"))
    return ends.unpivot("key", ["first", "last"], "place", "snippet")


# --- matching ---------------------------------------------------------------------------------------


def _sql_holds(short: str, long: str) -> str:
    """Whether the tagged title ``long`` holds ``short`` of three words or more, and no other volume's number."""
    word = "split_part(x, '#', 1)"
    numbers = ", ".join(f"'{w}'" for w in text.NUMBER_WORDS)
    return f"""(len({short}) >= 3 AND len({short}) <= len({long}) AND len(list_filter({short}, lambda x: NOT list_contains({long}, x))) = 0
    AND len(list_filter({long}, lambda x: NOT list_contains({short}, x) AND (regexp_full_match({word}, '[0-9]+') AND {word} <> '1' OR {word} IN ({numbers})))) = 0)"""


_TAGGED = "list_transform(title, lambda x, i: x || '#' || (i - list_position(title, x) + 1))"

_MATCH = f"""
WITH base AS (SELECT p_partkey AS k, p_partkey % 9 = 0 AS comp, p_brand,
  list_filter(string_split(lower(regexp_replace(p_name || ' ' || p_type, '[^A-Za-z0-9]+', ' ', 'g')), ' '), lambda w: w <> 'the') AS words FROM part),
cat AS (SELECT *, {_TAGGED} AS tags FROM (SELECT k, comp, p_brand, list_sort(words) AS title FROM base)),
want AS (SELECT *, {_TAGGED} AS tags FROM (SELECT k, comp, p_brand, list_sort(CASE WHEN k % 7 = 0 THEN list_concat(['no', 'such'], words) ELSE words END) AS title FROM base)),
exact AS (SELECT w.k AS want_id, min(c.k) AS k FROM want w JOIN cat c ON w.title = c.title AND w.comp = c.comp AND (w.comp OR w.p_brand = c.p_brand) GROUP BY 1),
rest AS (SELECT * FROM want WHERE k NOT IN (SELECT want_id FROM exact)),
beside AS (SELECT w.k AS want_id, w.tags AS wt, c.k, c.tags AS ct FROM rest w JOIN cat c ON w.p_brand = c.p_brand AND NOT w.comp AND NOT c.comp
  UNION ALL SELECT w.k, w.tags, c.k, c.tags FROM rest w JOIN cat c ON w.comp = c.comp AND w.comp),
fuzzy AS (SELECT want_id, min(k) AS k FROM beside WHERE {_sql_holds("wt", "ct")} OR {_sql_holds("ct", "wt")} GROUP BY 1),
hits AS (SELECT *, 'exact' AS confidence FROM exact UNION ALL SELECT *, 'fuzzy' FROM fuzzy),
tr AS (SELECT l_partkey AS k, arg_min(l_orderkey || '-' || l_linenumber || '-' || l_suppkey, (-(l_quantity::INT), l_orderkey * 8 + l_linenumber, l_orderkey || '-' || l_linenumber || '-' || l_suppkey)) AS track_id,
  max(l_quantity::INT) AS popularity FROM lineitem GROUP BY 1),
report AS (SELECT c.k AS want_id, h.k AS album, confidence, track_id, popularity FROM cat c LEFT JOIN hits h ON c.k = h.want_id LEFT JOIN tr ON tr.k = h.k)
"""


def _fuzzy_report(spark, sf_dir):
    """Every want with its match: equal titles first, else containment from three words on."""
    wanted = views.wants(spark, sf_dir)
    matches = match.best_matches(wanted, views.catalogue(spark, sf_dir))
    return match.match_report(wanted, matches, match.best_track(views.tracks(spark, sf_dir)))


@register(_MATCH + "SELECT want_id, track_id IS NOT NULL AS matched, confidence, track_id, coalesce(popularity, -1) AS popularity FROM report", also="match_report_fuzzy")
def match_report(spark, sf_dir):
    popularity = F.coalesce("popularity", F.lit(-1)).alias("popularity")
    return _fuzzy_report(spark, sf_dir).select("want_id", "matched", "confidence", "track_id", popularity)


@register(_MATCH + "SELECT track_id, min(want_id) AS pos FROM report WHERE track_id IS NOT NULL GROUP BY 1", also="track_list_fuzzy")
def track_list(spark, sf_dir):
    return match.track_list(_fuzzy_report(spark, sf_dir))


@register(_MATCH + "SELECT track_id, min(want_id) AS pos FROM report WHERE track_id IS NOT NULL AND confidence = 'exact' GROUP BY 1")
def track_list_exact(spark, sf_dir):
    return match.track_list(_fuzzy_report(spark, sf_dir), exact_only=True)


@register(_MATCH + "SELECT count(*) AS albums, count(track_id) AS matched, count(*) FILTER (confidence = 'fuzzy') AS fuzzy, count(DISTINCT track_id) AS tracks FROM report", also="match_summary_fuzzy")
def match_summary(spark, sf_dir):
    return match.match_summary(_fuzzy_report(spark, sf_dir))


@register(_MATCH + ", t AS (SELECT track_id, min(want_id) AS pos FROM report WHERE track_id IS NOT NULL GROUP BY 1) SELECT track_id, pos, (row_number() OVER (ORDER BY pos) - 1)::BIGINT AS ordinal, ((row_number() OVER (ORDER BY pos) - 1) // 100)::BIGINT AS batch FROM t", also="delivery_batches_fuzzy")
def delivery_batches(spark, sf_dir):
    return match.assign_batches(match.track_list(_fuzzy_report(spark, sf_dir)))


@register(_MATCH + "SELECT k::VARCHAR AS album_id, track_id, popularity FROM tr")
def best_track(spark, sf_dir):
    return match.best_track(views.tracks(spark, sf_dir)).select("album_id", "track_id", "popularity")


@register("SELECT p_brand AS artist, p_name AS album, min(p_partkey) AS pos FROM part GROUP BY ALL")
def first_pairs(spark, sf_dir):
    part = views.table(spark, sf_dir, "part")
    return match.first_pairs(part.select(F.col("p_brand").alias("artist"), F.col("p_name").alias("album"), F.col("p_partkey").alias("pos")))


@register("SELECT p_partkey AS want_id, CASE WHEN p_partkey % 7 <> 0 THEN 'exact' END AS verdict FROM part")
def revalidate_matches(spark, sf_dir):
    """Stored matches judged anew: a want's own album passes unless its title names another release."""
    stored = views.wants(spark, sf_dir).join(views.catalogue(spark, sf_dir).withColumn("want_id", F.col("ordinal")).drop("ordinal"), "want_id")
    stored = stored.withColumn("name", F.when(F.col("want_id") % 7 == 0, F.concat(F.lit("Vol. 10 "), F.col("name"))).otherwise(F.col("name")))
    return match.classify_matches(stored).select("want_id", "verdict")


# --- text -------------------------------------------------------------------------------------------


@register(f"SELECT p_partkey, {sql_key('p_brand')} || '|' || {sql_key('p_name')} AS album_key, regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g') AS strict_key FROM part")
def name_keys(spark, sf_dir):
    part = views.table(spark, sf_dir, "part")
    return part.select("p_partkey", text.album_key("p_brand", "p_name").alias("album_key"), text.strict_key("p_name").alias("strict_key"))


_ACCENTS = ("aeioun", "áèîöüñ")


@register(f"""SELECT p_partkey, {sql_key('p_brand')} || '|' || {sql_key("p_name || ' fin'")} AS album_key, regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g') AS strict_key FROM part""")
def accented_keys(spark, sf_dir):
    """Names with accents, a ligature and words in brackets have the keys of their plain forms."""
    plain, accented = _ACCENTS
    name = F.translate("p_name", plain, accented)
    part = views.table(spark, sf_dir, "part").withColumn("brand", F.translate("p_brand", plain, accented))
    return part.select("p_partkey", text.album_key("brand", F.concat(name, F.lit(" \ufb01n"))).alias("album_key"), text.strict_key(F.concat(name, F.lit(" (live)"))).alias("strict_key"))


@register(r"""SELECT doc_id, regexp_replace(regexp_replace(lower(lang || ' ' || source), '\b(the|a|an|ep|lp|and)\b', ' ', 'g'), '[^a-z0-9]+', '', 'g') AS loose FROM documents""")
def loose_keys(spark, sf_dir):
    """Keys of short names; ``loose_keys_full`` has those of the texts."""
    docs = views.table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.loose_key(F.concat_ws(" ", "lang", "source")).alias("loose"))


def _sql_resolved(value: str) -> str:
    """``value`` with the entities that the given tables may hold resolved, the ampersand's last."""
    for entity, plain in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "chr(34)"), ("&#39;", "chr(39)"), ("&nbsp;", "' '"), ("&amp;", "'&'")):
        value = f"replace({value}, '{entity}', {plain})"
    return value


@register(rf"SELECT doc_id, trim(regexp_replace({_sql_resolved(_sql_resolved('text'))}, '[\s]+', ' ', 'g')) AS clean FROM documents", also="clean_texts_full")
def clean_texts(spark, sf_dir):
    return views.table(spark, sf_dir, "documents").select("doc_id", text.clean_text("text").alias("clean"))


@register()
def loose_keys_full(spark, sf_dir):
    """Keys of the texts themselves; tested by brute force, since DuckDB can't decompose letters."""
    return views.table(spark, sf_dir, "documents").select("doc_id", text.loose_key("text").alias("loose"))


@register(also="page_texts_full")
def page_texts(spark, sf_dir):
    """Text, reviewer and cleaned field of every whole page; tested by brute force."""
    bounded_batches(spark)
    pages = views.table(spark, sf_dir, "pages").select("page_id", text.strip_tags("html").alias("text"))
    return pages.select("page_id", "text", text.find_reviewer("text").alias("reviewer"), text.clean_field("text").alias("head"))


@register("""SELECT p_partkey, CASE WHEN try_cast(p_size / 4.0 AS DOUBLE) BETWEEN 0 AND 10 THEN p_size / 4.0 END AS score,
  NULL::DOUBLE AS named FROM part""")
def plausible_scores(spark, sf_dir):
    part = views.table(spark, sf_dir, "part")
    score = text.plausible_score((F.col("p_size") / 4.0).cast("string")).alias("score")
    return part.select("p_partkey", score, text.plausible_score("p_name").alias("named"))


@register(r"""WITH n AS (SELECT p_partkey::VARCHAR AS id, unnest([p_name, p_brand, ' Home ', p_partkey::VARCHAR, 'a', repeat(p_name, 20), 'see http://x', '--- a1 ---']) AS name FROM part
  UNION ALL SELECT 'page-' || page_id, url FROM pages)
SELECT id, name, length(name) BETWEEN 2 AND 140 AND regexp_matches(name, '[A-Za-z]') AND lower(trim(name)) <> 'home' AND lower(name) NOT LIKE '%http%'
  AND lower(name) NOT LIKE '%copyright%' AND length(regexp_replace(name, '[^A-Za-z]', '', 'g')) >= greatest(2.0, 0.4 * length(name)) AS fine FROM n""")
def name_verdicts(spark, sf_dir):
    name = [F.col("p_name"), F.col("p_brand"), F.lit(" Home "), F.col("p_partkey").cast("string"), F.lit("a"), F.repeat("p_name", F.lit(20)), F.lit("see http://x"), F.lit("--- a1 ---")]
    parts = views.table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.explode(F.array(*name)).alias("name"))
    pages = views.table(spark, sf_dir, "pages").select(F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("id"), F.col("url").alias("name"))
    return parts.unionByName(pages).select("id", "name", text.looks_like_name("name").alias("fine"))


@register("""SELECT '19980301_' || p_partkey AS capture_file, CASE p_partkey % 4 WHEN 0 THEN ''
    WHEN 1 THEN p_brand || ': ' || p_name || chr(10) || ' Reviewed by Ann Example, who' || chr(10) || ' wrote of 1997.' || chr(10) || ' Rating: ' || p_size % 10 || '.0'
    WHEN 2 THEN p_brand || ': ' || p_name || chr(10) || ' some words.' || chr(10) || ' ' || p_size % 10 || '.0'
    ELSE p_brand || ': ' || p_name || chr(10) || ' some words.' || chr(10) || ' ' || p_size % 10 || '.0 / 10' END AS text,
  CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN p_brand || ': ' || p_name
    ELSE p_brand || ': ' || p_name || ' some words. ' || p_size % 10 || '.0' || CASE p_partkey % 4 WHEN 3 THEN ' / 10' ELSE '' END END AS field FROM part""")
def layout_texts(spark, sf_dir):
    """Pages without their tags, and cleaned as one field."""
    pages = views.layout_pages(spark, sf_dir).select("capture_file", text.strip_tags("html").alias("text"))
    return pages.select("capture_file", "text", text.clean_field("text").alias("field"))


@register(f"""WITH t AS (SELECT p_partkey, list_sort(string_split(lower(p_name || ' ' || p_name || ' ' || p_type), ' ')) AS title FROM part),
u AS (SELECT p_partkey, list_sort(string_split(lower(p_name), ' ')) AS title FROM part),
a AS (SELECT p_partkey, {_TAGGED} AS tags FROM t), b AS (SELECT p_partkey, {_TAGGED} AS other FROM u)
SELECT p_partkey, array_to_string(list_sort(list_filter(tags, lambda x: NOT list_contains(other, x))), ' ') AS extra FROM a JOIN b USING (p_partkey)""")
def token_differences(spark, sf_dir):
    """What a title with a doubled name has beyond the name, as a multiset of words."""
    longer, shorter = F.split(F.lower(F.concat_ws(" ", "p_name", "p_name", "p_type")), " "), F.split(F.lower("p_name"), " ")
    part = views.table(spark, sf_dir, "part").select("p_partkey", longer.alias("longer"), shorter.alias("shorter"))
    return part.select("p_partkey", F.array_join(F.array_sort(text.token_difference("longer", "shorter")), " ").alias("extra"))


@register("""SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'russian rock' ELSE replace(lower(p_name), ' ', ',') || ',pop rap' END AS genre FROM part""")
def filename_genres(spark, sf_dir):
    name = F.concat(F.lit("lists/"), F.replace("p_name", F.lit(" "), F.lit("__")), F.lit("__Pop_Rap.v2.csv"))
    path = F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("lists/Aquarium_"), F.col("p_partkey").cast("string"), F.lit(".csv"))).otherwise(name)
    return views.table(spark, sf_dir, "part").select("p_partkey", text.genre_from_filename(path).alias("genre"))


@register(f"SELECT page_id, {_URL_KEY} AS url_key FROM pages")
def url_keys(spark, sf_dir):
    return views.table(spark, sf_dir, "pages").select("page_id", text.url_key("url").alias("url_key"))


# --- files: what is written is read back ------------------------------------------------------------


def _folder(spark: SparkSession) -> str:
    """A new folder where the cluster keeps what its nodes share."""
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


_FILED = "id, artist, album, score, review_year, original_year, genres, country, bnm"


@register(REVIEWS_SQL + f"SELECT {_FILED} FROM reviews")
def selection_round_trip(spark, sf_dir):
    """The review table as tab-separated text."""
    path = _folder(spark)
    sinks.write_selection(build.conform(views.reviews(spark, sf_dir)), path)
    return readers.read_reviews_tsv(spark, path).select(*_FILED.split(", "))


@register(REVIEWS_SQL + "SELECT id, kind, snapshot_date FROM reviews, (VALUES ('prepared', '2024-02-01'), ('raw', '2024-03-01')) v(kind, snapshot_date) WHERE (kind = 'raw') = (review_year % 2 = 0)")
def snapshot_round_trip(spark, sf_dir):
    """Dated snapshots of two kinds; the latest of each is read, and a second write of a date replaces the first."""
    path, rows = _folder(spark), views.reviews(spark, sf_dir).select("id", "review_year")
    sinks.write_snapshot(rows, path, "2024-01-01")
    for _ in range(2):
        sinks.write_snapshot(rows.filter("review_year % 2 = 1"), path, "2024-02-01")
    sinks.write_snapshot(rows.filter("review_year % 2 = 0"), path, "2024-03-01", kind="raw")
    stored = spark.read.parquet(path)
    latest = [readers.latest_snapshot(stored, kind=kind) for kind in ("prepared", "raw")]
    return latest[0].unionByName(latest[1]).select("id", "kind", F.col("snapshot_date").cast("string").alias("snapshot_date"))


@register(_CANDIDATES + "SELECT artist, album, score, n_captures, confidence FROM rated")
def candidates_round_trip(spark, sf_dir):
    path = _folder(spark)
    sinks.write_json(_collapsed(spark, sf_dir), path)
    return readers.read_candidates(spark, path, "artist string, album string, score double, n_captures long, confidence double")


def _clustered(*parts: DataFrame) -> list[str]:
    """A store of each of ``parts``, all of equally many buckets."""
    buckets = store.buckets_for(max(rows.count() for rows in parts))
    tables = [f"reviews_{uuid.uuid4().hex}" for _ in parts]
    for rows, table in zip(parts, tables):
        store.write_clustered(rows, table, buckets)
    return tables


@register(REVIEWS_SQL + f"SELECT {SHOWN_SQL} FROM reviews QUALIFY row_number() OVER (PARTITION BY _key ORDER BY {_BEST}) = 1")
def clustered_dedupe(spark, sf_dir):
    """Albums from a store that is clustered by their key."""
    [table] = _clustered(stored(views.reviews(spark, sf_dir, keyed=True).select(*SHOWN, "_key")))
    return store.per_key(spark, table, build.dedupe_albums).select(*SHOWN)


@register(REVIEWS_SQL + "SELECT id, _key FROM reviews WHERE review_year >= 1997 AND _key NOT IN (SELECT _key FROM reviews WHERE review_year < 1995)")
def clustered_new(spark, sf_dir):
    """Reviews of albums that an older store does not hold, store against store."""
    rows = stored(views.reviews(spark, sf_dir, keyed=True).filter("review_year < 1995 OR review_year >= 1997").select("id", "review_date", "review_year", "_key"))
    older, newer = _clustered(rows.filter("review_year < 1995"), rows.filter("review_year >= 1997"))
    return store.absent(spark, newer, older).select("id", "_key")


def _json_files(rows: DataFrame, value, path: str, ends: str = "[]", head: str = "", most: int = 2000) -> None:
    """Files of JSON arrays or objects of some thousand members each."""
    groups = max(1, -(-rows.count() // most))
    joined = F.array_join(F.collect_list("v"), ",\n")
    lines = rows.select(value.alias("v")).groupBy(F.pmod(F.xxhash64("v"), F.lit(groups)).alias("g")).agg(joined.alias("m"))
    lines.select(F.concat(F.lit(ends[0] + head), "m", F.lit(ends[1])).alias("value")).write.text(path)


#: Small, so that one file is read by several tasks in every query.
_SPLIT = 50_000


@register(REVIEWS_SQL + """SELECT id, artist || ' "[x], \\' || album AS title, score, review_year AS "releaseYear", CASE WHEN genres IS NULL THEN 0 ELSE 2 END AS n_genres FROM reviews""")
def raw_reviews_round_trip(spark, sf_dir):
    """Raw reviews written as JSON arrays, with quotes and brackets in their titles, and read by byte ranges."""
    path, rows = _folder(spark), views.reviews(spark, sf_dir)
    raw = F.struct(
        "id", F.concat("artist", F.lit(' "[x], \\'), "album").alias("title"), "score", F.col("review_year").alias("releaseYear"), F.split("genres", "; ").alias("genres")
    )
    _json_files(rows, F.to_json(raw), path)
    found = readers.read_reviews_json(spark, path, _SPLIT)
    return found.select("id", "title", "score", "releaseYear", F.coalesce(F.size("genres"), F.lit(0)).alias("n_genres"))


@register("SELECT c_custkey || '/{\"' AS url, n_name AS country, c_mktsegment AS language, 'm' || c_custkey AS mbid FROM customer JOIN nation ON c_nationkey = n_nationkey")
def enrichment_round_trip(spark, sf_dir):
    """Facts keyed by address, written as JSON objects and read by byte ranges."""
    path = _folder(spark)
    rows = views.table(spark, sf_dir, "customer").join(views.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    url = F.concat(F.col("c_custkey").cast("string"), F.lit('/{"'))
    facts = F.struct(F.col("n_name").alias("country"), F.col("c_mktsegment").alias("language"), F.concat(F.lit("m"), F.col("c_custkey").cast("string")).alias("mbid"))
    member = F.to_json(F.create_map(url, facts))
    _json_files(rows, F.substring(member, F.lit(2), F.length(member) - 2), path, "{}")
    return readers.read_enrichment_json(spark, path, _SPLIT)


@register(CAPTURES_SQL + "SELECT timestamp, original, digest, statuscode, mimetype FROM captures WHERE statuscode = '200' AND timestamp >= '1998' AND timestamp < '2001'")
def capture_index_round_trip(spark, sf_dir):
    """A capture index with header rows, filtered while its byte ranges are read."""
    path = _folder(spark)
    columns = ["timestamp", "original", "digest", "statuscode", "mimetype"]
    head = "[" + ",".join(f'"{c}"' for c in columns) + "],"
    _json_files(views.captures_index(spark, sf_dir), F.to_json(F.array(*columns)), path, head=head)
    return readers.read_capture_index(spark, path, _SPLIT).filter("statuscode = '200' AND timestamp >= '1998' AND timestamp < '2001'")


@register(REVIEWS_SQL + """SELECT row_number() OVER (ORDER BY review_date ASC NULLS LAST, artist ASC NULLS LAST, id) - 1 AS ordinal, artist || ' - ' || album AS value FROM reviews""")
def ordered_lines(spark, sf_dir):
    """Playlist lines in the corpus's order, written as part files and read back with their numbers."""
    path = _folder(spark)
    sinks.write_ordered(views.reviews(spark, sf_dir), build.CORPUS_ORDER, path)
    return readers.read_ordered(spark, path)


@register("""SELECT '1998030' || page_id % 10 || '_' || page_id || '.html' || CASE WHEN page_id % 3 = 0 THEN '.gz' ELSE '' END AS capture_file, '1998030' || page_id % 10 AS timestamp,
  html || CASE page_id % 2 WHEN 0 THEN chr(233) || chr(8364) ELSE '' END AS html FROM pages""")
def captures_round_trip(spark, sf_dir):
    """Pages written as capture files, zipped or plain, in UTF-8 or Windows-1252, and read back."""
    path, key = _folder(spark), F.col("page_id").cast("string")
    stamp = F.concat(F.lit("1998030"), (F.col("page_id") % 10).cast("string"))
    ending = F.when(F.col("page_id") % 3 == 0, ".gz").otherwise("")
    marked = F.concat("html", F.when(F.col("page_id") % 2 == 0, "\u00e9\u20ac").otherwise(""))
    pages = views.table(spark, sf_dir, "pages").select(
        F.concat(stamp, F.lit("_"), key, F.lit(".html"), ending).alias("capture_file"), marked.alias("html"), F.when(F.col("page_id") % 4 == 0, "cp1252").otherwise("utf-8").alias("encoding")
    )
    sinks.write_captures(pages, path)
    return readers.read_captures(spark, path)


def _exported(kind: str, separator: str) -> None:
    def query(spark, sf_dir):
        path = _folder(spark)
        sinks.write_export(views.reviews(spark, sf_dir), path, kind, ["score", "artist", "album", "review_date", "genre", "bnm"])
        return spark.read.csv(path, sep=separator, header=True, escape='"')

    query.__name__ = f"export_{kind}"
    register(REVIEWS_SQL + "SELECT score::VARCHAR AS score, artist, album, review_date, genre, bnm::VARCHAR AS bnm FROM reviews")(query)


_exported("csv", ",")
_exported("tsv", "\t")


@register(_MATCH + "SELECT want_id::VARCHAR AS want_id, (track_id IS NOT NULL)::VARCHAR AS matched, confidence, track_id FROM report")
def report_round_trip(spark, sf_dir):
    """The match report as a file, unmatched wants included."""
    path = _folder(spark)
    sinks.write_report(_fuzzy_report(spark, sf_dir).select("want_id", "matched", "confidence", "track_id"), path)
    return spark.read.csv(path, sep="\t", header=True)
