"""Views over the given tables in the shapes that the operators expect, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platter.functions.text import EDITION_DROP, album_key_part
from platter.operators.reviews import new_release_flag, reissue_flag


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined_lines(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """Line items with their order, part, supplier, place and customer; ``keyed`` adds the names' keys to the small sides."""

    def read(name: str) -> DataFrame:
        named = {"supplier": "s_name", "part": "p_name"}.get(name) if keyed else None
        rows = table(spark, sf_dir, name)
        return rows.withColumn(f"__key_{named}", album_key_part(named)) if named else rows

    places = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    sellers = read("supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey"))
    orders = read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
    lines = read("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.join(read("part"), F.col("l_partkey") == F.col("p_partkey")).join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))


def reviews(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """The review view; ``keyed`` adds the album key."""
    year = F.year("o_orderdate")
    gap = F.year("l_shipdate") - year
    original = F.when(F.col("p_size") % 10 == 0, year - 1)
    bnr = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    reissue = reissue_flag(bnr, original, gap)
    tagged = F.col("p_size") % 7 != 0
    key = [F.concat("__key_s_name", F.lit("|"), "__key_p_name").alias("_key")] if keyed else []
    return joined_lines(spark, sf_dir, keyed).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd")).alias("id"),
        F.col("s_name").alias("artist"),
        F.col("p_name").alias("album"),
        (F.col("l_quantity") / 5.0).alias("score"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("review_date"),
        F.year("l_shipdate").alias("review_year"),
        year.alias("release_year"),
        original.alias("original_year"),
        F.when(tagged, F.concat_ws("; ", "p_type", "o_orderpriority")).alias("genres"),
        F.when(tagged, F.col("p_type")).alias("genre"),
        F.col("c_mktsegment").alias("reviewer"),
        (F.col("l_returnflag") == "A").alias("bnm"),
        bnr.alias("bnr"),
        new_release_flag(reissue, gap).alias("is_new_release"),
        reissue.alias("is_reissue"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("language"),
        F.col("p_brand").alias("blurb"),
        *key,
    )


def sql_key(column: str) -> str:
    return rf"regexp_replace(regexp_replace(lower({column}), '\b({'|'.join(EDITION_DROP)})\b', ' ', 'g'), '[^a-z0-9]+', '', 'g')"


REVIEWS_SQL = rf"""
WITH base AS (
  SELECT *, year(l_shipdate) - year(o_orderdate) AS gap,
         (l_returnflag = 'R' AND l_linestatus = 'F') AS bnr_flag, p_size % 10 = 0 AS has_original
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), reviews AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS id,
         s_name AS artist, p_name AS album, l_quantity / 5.0 AS score,
         strftime(l_shipdate, '%Y-%m-%d') AS review_date, year(l_shipdate)::INTEGER AS review_year,
         year(o_orderdate)::INTEGER AS release_year,
         CASE WHEN has_original THEN (year(o_orderdate) - 1)::INTEGER END AS original_year,
         CASE WHEN p_size % 7 <> 0 THEN p_type || '; ' || o_orderpriority END AS genres,
         CASE WHEN p_size % 7 <> 0 THEN p_type END AS genre,
         c_mktsegment AS reviewer, l_returnflag = 'A' AS bnm, bnr_flag AS bnr,
         NOT (bnr_flag OR has_original OR gap >= 2) AND abs(gap) <= 1 AS is_new_release,
         (bnr_flag OR has_original OR gap >= 2) AS is_reissue,
         n_name AS country, r_name AS language, p_brand AS blurb,
         {sql_key('s_name')} || '|' || {sql_key('p_name')} AS _key
  FROM base
)
"""


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review pages rendered from parts: one capture per brand and size, a table row per part."""
    score = F.format_string("%.1f", (F.col("p_size") % 10).cast("double"))
    row = F.concat(F.lit('<tr><td><a href="/r">'), "p_brand", F.lit(": "), "p_name", F.lit("</a></td><td>"), score, F.lit("</td></tr>"))
    # A fixed number of tasks: adaptive execution would read few long pages by one, though extractors cost far more than their bytes.
    parts = table(spark, sf_dir, "part").repartition(2 * spark.sparkContext.defaultParallelism, "p_brand", "p_size")
    grouped = parts.groupBy("p_brand", "p_size").agg(F.array_join(F.array_sort(F.collect_list(row)), "\n").alias("rows"))
    stamp = F.concat((F.lit(1996) + F.col("p_size") % 5).cast("string"), F.lit("0615"))
    return grouped.select(
        F.concat_ws("_", stamp, F.replace("p_brand", F.lit("#"), F.lit("")), F.col("p_size").cast("string")).alias("capture_file"),
        stamp.alias("timestamp"),
        F.concat(F.lit("<html><body><table>"), "rows", F.lit("</table></body></html>")).alias("html"),
    )


#: Each part's row gives one record by its table row and one by its link.
EXTRACTIONS_SQL = """
WITH extractions AS (
  SELECT concat_ws('_', (1996 + p_size % 5) || '0615', replace(p_brand, '#', ''), p_size) AS capture_file,
         (1996 + p_size % 5) || '0615' AS capture_timestamp, (1996 + p_size % 5) || '-06' AS review_date_approx,
         e.extractor, p_brand AS artist, p_name AS album, (p_size % 10)::DOUBLE AS score
  FROM part, (VALUES ('table_rows'), ('anchor_then_score')) e(extractor)
)
"""


def layout_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per part in one of four old layouts: hidden comment, rating line, heading, score out of ten."""
    score = F.format_string("%.1f", (F.col("p_size") % 10).cast("double"))
    line = F.concat("p_brand", F.lit(": "), "p_name")
    comment = F.concat(F.lit("<!--\n1_artist: "), "p_brand", F.lit("\n2_title: "), "p_name", F.lit("\n3_label: "), "p_type", F.lit("\n4_rating: "), score, F.lit("\n5_author: Ann Example\n-->"))
    rated = F.concat(F.lit("<p>"), line, F.lit("</p><p>Reviewed by Ann Example, who</p><p>wrote of 1997.</p><p>Rating: "), score, F.lit("</p>"))
    heading = F.concat(F.lit("<h3>"), line, F.lit("</h3><p>some words.</p><p>"), score, F.lit("</p>"))
    of_ten = F.concat(F.lit("<p>"), line, F.lit("</p><p>some words.</p><p>"), score, F.lit(" / 10</p>"))
    kind = F.col("p_partkey") % 4
    page = F.when(kind == 0, comment).when(kind == 1, rated).when(kind == 2, heading).otherwise(of_ten)
    stamp = F.lit("19980301").alias("timestamp")
    return table(spark, sf_dir, "part").select(F.concat(F.lit("19980301_"), F.col("p_partkey").cast("string")).alias("capture_file"), stamp, page.alias("html"))


def captures_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a capture index; every fourth one is listed twice, some failed or are no HTML."""
    pages = table(spark, sf_dir, "pages")
    k = F.col("page_id")
    listed = pages.withColumn("copy", F.explode(F.when(k % 4 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return listed.select(
        F.concat((F.lit(1996) + k % 8).cast("string"), F.lit("0101"), F.lpad((k % 1000000).cast("string"), 6, "0")).alias("timestamp"),
        F.col("url").alias("original"),
        F.concat(F.lit("D"), (k % 97).cast("string")).alias("digest"),
        F.when(k % 11 == 0, "404").otherwise("200").alias("statuscode"),
        F.when(k % 13 == 0, "image/png").when(k % 17 == 0, "unk").otherwise("text/html").alias("mimetype"),
    )


CAPTURES_SQL = """
WITH captures AS (
  SELECT (1996 + page_id % 8) || '0101' || lpad((page_id % 1000000)::VARCHAR, 6, '0') AS timestamp, url AS original,
         'D' || (page_id % 97) AS digest, CASE WHEN page_id % 11 = 0 THEN '404' ELSE '200' END AS statuscode,
         CASE WHEN page_id % 13 = 0 THEN 'image/png' WHEN page_id % 17 = 0 THEN 'unk' ELSE 'text/html' END AS mimetype
  FROM pages, (VALUES (0), (1)) c(copy) WHERE copy = 0 OR page_id % 4 = 0
), filtered AS (
  SELECT * FROM captures WHERE (mimetype LIKE '%html%' OR mimetype = 'unk') AND statuscode = '200'
    AND regexp_matches(lower(original), '/(en|fr)/') AND timestamp[1:4]::INT BETWEEN 1997 AND 2002
), manifest AS (
  SELECT timestamp, original AS url, min(digest) AS digest FROM filtered GROUP BY ALL
)
"""


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as albums: the brand is the artist, every ninth album is a compilation."""
    various = F.col("p_partkey") % 9 == 0
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.concat_ws(" ", "p_name", "p_type").alias("name"),
        F.array(F.when(various, "Various Artists").otherwise(F.col("p_brand"))).alias("artists"),
        F.when(various, "compilation").otherwise("album").alias("album_type"),
        F.col("p_partkey").alias("ordinal"),
    )


def wants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted albums: names decorated so that normalisation must undo it, and every seventh that must not match."""
    k = F.col("p_partkey")
    name = F.concat_ws(" ", "p_name", "p_type")
    decorated = (
        F.when(k % 7 == 0, F.concat(F.lit("No Such "), name))
        .when(k % 5 == 0, F.upper(name))
        .when(k % 5 == 1, F.concat(F.lit("The "), name, F.lit(" (Remastered)")))
        .when(k % 5 == 2, F.concat(name, F.lit(" EP")))
        .otherwise(name)
    )
    return table(spark, sf_dir, "part").select(
        k.alias("want_id"), F.when(k % 9 == 0, "Various Artists").otherwise(F.col("p_brand")).alias("artist"), decorated.alias("album")
    )


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as tracks of the part's album."""
    number = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("album_id"), number.alias("track_no"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey").alias("id"),
        F.concat(F.lit("Track "), number.cast("string")).alias("name"), F.col("l_quantity").cast("int").alias("popularity"),
    )


def crowd_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of every artist and album of the review view, from a small vocabulary chosen by their names' lengths."""
    pairs = reviews(spark, sf_dir).select("artist", "album").distinct()
    pick = (F.length("album") + F.substring("artist", -1, 1).try_cast("int")) % 6
    lists = [["pop rap", "seen live"], ["electropop", "1990s"], ["house", "us"], ["seen live"], ["indie pop", "trap", "folk rock"], []]
    album = F.get(F.array(*[F.array(*[F.lit(t) for t in tags]).cast("array<string>") for tags in lists]), pick)
    artist = F.when(pick == 3, F.array(F.lit("post-punk"), F.lit("jazz")))
    return pairs.select("artist", "album", album.alias("album_tags"), artist.alias("artist_tags"))


#: What the rules make of each list of ``crowd_tags``.
GENRES_SQL = """
CASE (length(album) + try_cast(right(artist, 1) AS INT)) % 6
  WHEN 0 THEN 'Rap' WHEN 1 THEN 'Electronic' WHEN 3 THEN 'Rock; Jazz' WHEN 4 THEN 'Rock; Rap; Folk/Country' ELSE '' END
"""
