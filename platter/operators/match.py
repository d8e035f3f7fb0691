"""Matching wanted albums to a catalogue and picking their most popular tracks.

Wants: ``want_id, artist, album``. Catalogue: ``id, name, artists, album_type, ordinal``. Artists match
through exploded keys (an equi-join), titles by equal word multisets or by containment. The
placeholder artist of compilations never enters the artist join, where it would be a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platter.functions.text import NUMBER_WORDS, strict_key, tag_occurrences, title_key, title_tokens, want_keys
from platter.operators.containment import ITEM, by_rarity, candidates, filed, items
from platter.operators.ordering import numbered
from platter.operators.steps import settled

VARIOUS = "variousartists"


def prepared_wants(wants: DataFrame) -> DataFrame:
    base = wants.select("want_id", "artist", "album", title_tokens("album").alias("want_tokens"), want_keys("artist").alias("want_keys"))
    named = base.withColumns({"various": strict_key("artist") == VARIOUS, "title": title_key("want_tokens")})
    return named.withColumn("tags", tag_occurrences("want_tokens"))


def prepared_catalogue(catalogue: DataFrame) -> DataFrame:
    """Catalogue with title tokens and credited keys. Each credit is normalised on its own row, then regrouped
    per album, because the normaliser leaves the JVM and can't run inside an array lambda."""
    credits = catalogue.select("id", F.posexplode("artists").alias("k", "name")).select("id", "k", "name", strict_key("name").alias("key"))
    keys = credits.groupBy("id").agg(
        F.array_sort(F.collect_set("key")).alias("credited"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "name"))), lambda s: s["name"]), " and ").alias("line"),
    )
    full = catalogue.join(keys, "id", "left")
    credited = F.array_distinct(F.concat(F.coalesce("credited", F.expr("cast(array() as array<string>)")), F.array(strict_key("line"))))
    full = full.withColumn("credited", F.array_remove(credited, "")).withColumn("tokens", title_tokens("name"))
    compilation = F.coalesce(F.col("album_type") == "compilation", F.lit(False)) | F.array_contains("credited", VARIOUS)
    return full.withColumns({"compilation": compilation, "title": title_key("tokens"), "tags": tag_occurrences("tokens")}).drop("line")


def related(a: Column, b: Column, least: int = 3) -> Column:
    """Whether one title holds the other, which has ``least`` words or more, without a volume number extra.

    Both are occurrence-tagged (``tag_occurrences``), so that sets of tags are multisets of words.
    """
    swap = F.size(a) <= F.size(b)
    short, long = F.when(swap, a).otherwise(b), F.when(swap, b).otherwise(a)
    extra = F.transform(F.array_except(long, short), lambda t: F.substring_index(t, "#", 1))
    volume = F.exists(extra, lambda t: (t.rlike("^[0-9]+$") & (t != "1")) | t.isin(NUMBER_WORDS))
    return (F.size(short) >= least) & (F.size(F.array_except(short, long)) == 0) & ~volume


def _rows_as_sets(rows: DataFrame, tokens: str, block: list[str], least: int) -> DataFrame:
    """``block``, ``title`` and ``tags`` of rows with ``least`` words or more; tags come from ``tokens`` where they are missing."""
    tags = F.col("tags") if "tags" in rows.columns else tag_occurrences(tokens)
    return rows.select("*", tags.alias("__tags")).filter(F.size("__tags") >= least).select(
        *[c for c in ("want_id", "id", "ordinal") if c in rows.columns], *block, F.array_join("__tags", " ").alias("title"), F.col("__tags").alias("tags")
    )


def filed_sets(wants: DataFrame, catalogue: DataFrame, block: list[str]) -> tuple[DataFrame, DataFrame]:
    """The distinct sets of both sides (``block``, ``title``, ``tags``) with their words by rarity, settled."""
    w, c = (side.select(*block, "title", "tags").dropDuplicates([*block, "title"]) for side in (wants, catalogue))
    ranked = by_rarity(w.select("title", "tags").unionByName(c.select("title", "tags")).dropDuplicates(["title"])).select("title", "rare")
    return settled(w.join(ranked, "title")), settled(c.join(ranked, "title"))


def candidate_sets(w: DataFrame, c: DataFrame, block: list[str], item: int = ITEM) -> DataFrame:
    """Pairs of sets that may hold one another, before their words are compared: ``block``, ``want``, ``album``, their words."""
    inside = candidates(filed(w, True, block), filed(c, False, block), block, item)
    around = candidates(filed(c, True, block), filed(w, False, block), block, item).filter(F.size("small_tags") < F.size("large_tags"))
    named = [{"small": "want", "large": "album"}, {"small": "album", "large": "want"}]
    pairs = [p.withColumnsRenamed(n | {f"{k}_tags": f"{v}_tags" for k, v in n.items()}) for p, n in zip((inside, around), named)]
    return pairs[0].unionByName(pairs[1])


def contained_sets(wants: DataFrame, catalogue: DataFrame, block: list[str], least: int = 3, item: int = ITEM) -> DataFrame:
    """Titles (``block``, ``want``, ``album``) of which one holds the other; ``least`` is 3 or more (the index relies on it)."""
    if least < 3:
        raise ValueError("titles of fewer than three words hold one another by chance")
    found = candidate_sets(*filed_sets(wants, catalogue, block), block, item)
    return found.filter(related(F.col("want_tags"), F.col("album_tags"), least)).select(*block, "want", "album")


def containment_load(wants: DataFrame, catalogue: DataFrame, least: int = 3, block: list[str] | None = None, item: int = ITEM) -> DataFrame:
    """One row on what the search does: sets of either side, candidate pairs, and the largest item (sets by sets)."""
    block = block or []
    sides = _rows_as_sets(wants, "want_tokens", block, least), _rows_as_sets(catalogue, "tokens", block, least)
    w, c = filed_sets(*sides, block)
    both = [items(filed(a, True, block), filed(b, False, block), block, item) for a, b in ((w, c), (c, w))]
    largest = F.coalesce(F.max(F.ceil(F.col("ns") / F.col("cs")) * F.ceil(F.col("nl") / F.col("cl"))), F.lit(0)).alias("largest_item")
    pairs = candidate_sets(w, c, block, item).agg(F.count(F.lit(1)).alias("candidates"))
    sizes = [s.agg(F.count(F.lit(1)).alias(n)) for s, n in ((w, "want_sets"), (c, "album_sets"))]
    return sizes[0].join(sizes[1]).join(pairs).join(both[0].unionByName(both[1]).agg(largest))  # one row each


def contained_pairs(wants: DataFrame, catalogue: DataFrame, least: int = 3, block: list[str] | None = None) -> DataFrame:
    """All (want_id, id) whose titles contain one another, within equal ``block`` columns.

    The search runs over distinct titles; sides without ``tags`` get them from ``want_tokens`` and ``tokens``.
    """
    block = block or []
    w, c = _rows_as_sets(wants, "want_tokens", block, least), _rows_as_sets(catalogue, "tokens", block, least)
    found = contained_sets(w, c, block, least)
    pairs = w.withColumnRenamed("title", "want").join(found, [*block, "want"]).join(c.withColumnRenamed("title", "album"), [*block, "album"])
    return pairs.select("want_id", "id").distinct()


def _search(wants: DataFrame, catalogue: DataFrame, least: int) -> DataFrame:
    """The first album (``want_id``, ``id``, ``ordinal``, ``confidence``) of each want (``want_id``, ``artist_key``, ``title``, ``tags``).

    Albums with equal words under an artist key are one, the first in the catalogue's order; equal titles
    come before contained ones.
    """
    block = ["artist_key"]
    first = F.struct("ordinal", "id")
    albums = settled(catalogue.filter("title <> ''").groupBy(*block, "title").agg(F.min(first).alias("m"), F.first("tags").alias("tags")))
    wanted = wants.filter("title <> ''")
    exact = settled(wanted.join(albums.drop("tags"), [*block, "title"]).groupBy("want_id").agg(F.min("m").alias("m")))
    rest = wanted.join(exact.select("want_id"), "want_id", "left_anti")
    sides = [_rows_as_sets(side.drop("title"), "tags", block, least) for side in (rest, albums.select("artist_key", "tags", "m.*"))]
    found = contained_sets(*sides, block, least)
    best = found.join(sides[1].withColumnRenamed("title", "album"), [*block, "album"]).groupBy(*block, "want").agg(F.min(first).alias("m"))
    fuzzy = sides[0].withColumnRenamed("title", "want").join(best, [*block, "want"]).groupBy("want_id").agg(F.min("m").alias("m"))
    both = exact.withColumn("confidence", F.lit("exact")).unionByName(fuzzy.withColumn("confidence", F.lit("fuzzy")))
    return both.select("want_id", "m.id", "m.ordinal", "confidence")


def _want_keys(wants: DataFrame) -> DataFrame:
    """A row per artist key; wants by the placeholder have it as their only key, and no other want has it."""
    keys = F.when(F.col("various"), F.array(F.lit(VARIOUS))).otherwise(F.array_remove("want_keys", VARIOUS))
    return wants.select("want_id", "title", "tags", "various", F.explode(keys).alias("artist_key"))


def _album_keys(catalogue: DataFrame) -> DataFrame:
    """A row per credited key; compilations stand under the placeholder too."""
    none = F.expr("cast(array() as array<string>)")
    keys = F.concat(F.array_remove("credited", VARIOUS), F.when(F.col("compilation"), F.array(F.lit(VARIOUS))).otherwise(none))
    return catalogue.select("id", "ordinal", "title", "tags", F.explode(keys).alias("artist_key"))


def match_by_artist(wants: DataFrame, catalogue: DataFrame, least: int = 3) -> DataFrame:
    """The first match (``want_id``, ``id``, ``ordinal``, ``confidence``) of ordinary wants, within equal artist keys."""
    return _search(_want_keys(wants.filter("NOT various")), _album_keys(catalogue).filter(F.col("artist_key") != VARIOUS), least)


def match_compilations(wants: DataFrame, catalogue: DataFrame, least: int = 3) -> DataFrame:
    """The first match of wants by the placeholder artist: titles only, among compilations."""
    return _search(_want_keys(wants.filter("various")), _album_keys(catalogue.filter("compilation")).filter(F.col("artist_key") == VARIOUS), least)


def best_matches(wants: DataFrame, catalogue: DataFrame, least: int = 3) -> DataFrame:
    """The best catalogue album of each want that has one: exact before fuzzy, then the catalogue's order.

    Both searches run as one, compilations under a key of their own. Names leave the JVM to be
    normalised, so both sides are settled first and never normalised again.
    """
    w, c = settled(prepared_wants(wants)), settled(prepared_catalogue(catalogue))
    return _search(_want_keys(w), _album_keys(c), least).drop("ordinal").join(c.select("id", "name", "artists", "ordinal"), "id")


def pool_candidates(*frames: DataFrame) -> DataFrame:
    """Candidates of several searches, one row per want and album."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.dropDuplicates(["want_id", "id"])


def best_track(tracks: DataFrame) -> DataFrame:
    """The most popular track per album, the first on ties; reduced before any join."""
    order = F.struct((-F.col("popularity")).alias("p"), "track_no", "id")
    row = F.struct(F.col("id").alias("track_id"), F.col("name").alias("track_name"), "popularity")
    return tracks.groupBy("album_id").agg(F.min_by(row, order).alias("t")).select("album_id", "t.*")


def first_pairs(df: DataFrame, columns: tuple[str, ...] = ("artist", "album"), pos: str = "pos", limit: int | None = None) -> DataFrame:
    """Each combination once, at its first position; the first N of them if asked for (0: none)."""
    out = df.groupBy(*columns).agg(F.min(pos).alias(pos))
    return out if limit is None else out.orderBy(pos).limit(limit)


def match_report(wants: DataFrame, matches: DataFrame, best: DataFrame) -> DataFrame:
    """Every want with its match and track, unmatched ones included."""
    m = matches.select("want_id", F.col("id").alias("album_id"), F.col("name").alias("matched_album"), F.array_join("artists", ", ").alias("matched_artist"), "confidence")
    joined = wants.join(m, "want_id", "left").join(best, "album_id", "left")
    return joined.select(
        "want_id", "artist", "album", F.col("track_id").isNotNull().alias("matched"), "confidence",
        "matched_artist", "matched_album", "track_name", "track_id", "popularity",
    )


def classify_matches(stored: DataFrame) -> DataFrame:
    """Today's verdict on stored matches (``want_id, artist, album, id, name, artists, album_type``): exact, fuzzy or null."""
    c = prepared_catalogue(stored.select(F.col("want_id").alias("id"), "name", "artists", "album_type").withColumn("ordinal", F.lit(0)))
    side = c.select(F.col("id").alias("want_id"), "credited", "title", "tags", "compilation")
    w = prepared_wants(stored).select("want_id", F.col("title").alias("want_title"), F.col("tags").alias("want_tags"), "want_keys", "various")
    joined = stored.join(w, "want_id").join(side, "want_id")
    artist_fits = F.when(F.col("various"), F.col("compilation")).otherwise(F.arrays_overlap("want_keys", "credited"))
    equal = (F.col("want_title") != "") & (F.col("want_title") == F.col("title"))
    verdict = F.when(equal, "exact").when(related(F.col("want_tags"), F.col("tags")), "fuzzy")
    return joined.withColumn("verdict", F.when(F.coalesce(artist_fits, F.lit(False)), verdict)).select(*stored.columns, "verdict")


def revalidate_matches(stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored matches that still pass, with fresh labels, and those to match again."""
    judged = classify_matches(stored)
    valid = judged.filter("verdict IS NOT NULL").drop("confidence").withColumnRenamed("verdict", "confidence")
    return valid, judged.filter("verdict IS NULL").drop("verdict")


def with_track(report: DataFrame, exact_only: bool = False) -> DataFrame:
    kept = report.filter(F.col("track_id").isNotNull())
    return kept.filter("confidence = 'exact'") if exact_only else kept


def track_list(report: DataFrame, pos: str = "want_id", exact_only: bool = False) -> DataFrame:
    """Each track once, at the first position of the report that has it."""
    return with_track(report, exact_only).groupBy("track_id").agg(F.min(pos).alias("pos"))


def match_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("albums"), F.count_if("matched").alias("matched"),
        F.count_if(F.col("confidence") == "fuzzy").alias("fuzzy"), F.count_distinct("track_id").alias("tracks"),
    )


def assign_batches(df: DataFrame, pos: str = "pos", size: int = 100) -> DataFrame:
    """Delivery batches in order of ``pos`` (unique), with exact ranks from counted ranges; ``df`` is read three times."""
    ranked = numbered(df, [pos])
    return ranked.withColumn("batch", F.floor(F.col("ordinal") / size))
