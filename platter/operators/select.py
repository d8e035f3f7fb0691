"""Selections: composable filters, top N per year, sort orders, limits."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platter.operators.reviews import dedupe_albums
from platter.schemas import GENRE_SEPARATOR


@dataclass
class Selection:
    """What to select; unset fields filter nothing."""

    min_score: float | None = None
    max_score: float | None = None
    review_year: str | None = None
    release_year: str | None = None
    genres: list[str] = field(default_factory=list)
    exclude_genres: list[str] = field(default_factory=list)
    no_genre: bool = False
    untagged_label: str | None = None
    countries: list[str] = field(default_factory=list)
    languages: list[str] = field(default_factory=list)
    bnm: bool | None = None
    bnr: bool = False
    new_releases: bool = False
    reissues: bool = False
    artist: str | None = None
    reviewer: str | None = None
    search: str | None = None
    dedupe: bool = False
    top_per_review_year: int = 0
    top_per_release_year: int = 0
    sort: str = "score"
    seed: int = 0
    limit: int = 0


def genre_list(c: str = "genres") -> Column:
    """The genres of a joined string as an array, empty parts dropped."""
    return F.filter(F.split(F.coalesce(F.col(c), F.lit("")), GENRE_SEPARATOR), lambda g: g != "")


def year_predicate(spec: str | None, year: Column) -> Column | None:
    """``2015``, ``2010-2019``, ``1999,2003``. A bad part raises; a spec that selects no year filters nothing."""
    ranges: list[tuple[int, int]] = []
    for part in (spec or "").split(","):
        if not part.strip():
            continue
        low, dash, high = part.strip().partition("-")
        try:
            first = int(low)
            last = int(high) if dash else first
        except ValueError:
            raise ValueError(f"not a year or a range of years: {part!r}") from None
        if first <= last:
            ranges.append((first, last))
    if not ranges:
        return None
    return reduce(lambda a, b: a | b, [F.coalesce(year.between(a, b), F.lit(False)) for a, b in ranges])


def contains(c: Column | str, text: str) -> Column:
    """Literal, case-insensitive; null contains nothing."""
    value = F.col(c) if isinstance(c, str) else c
    return F.lower(F.coalesce(value, F.lit(""))).contains(F.lit(text.lower()))


def predicates(spec: Selection) -> list[Column]:
    """The filters of ``spec``; all must hold. Rows without score never pass."""
    true, out = F.lit(True), [F.col("score").isNotNull()]
    if spec.min_score is not None:
        out.append(F.col("score") >= spec.min_score)
    if spec.max_score is not None:
        out.append(F.col("score") <= spec.max_score)
    out += [p for p in (year_predicate(spec.review_year, F.col("review_year")), year_predicate(spec.release_year, F.col("release_year"))) if p is not None]
    own = F.transform(genre_list(), lambda g: F.lower(g))
    overlap = lambda names: F.coalesce(F.arrays_overlap(own, F.array(*[F.lit(n.lower()) for n in names])), F.lit(False))
    if spec.no_genre:
        none = F.size(genre_list()) == 0
        out.append(none | (F.col("genres") == spec.untagged_label) if spec.untagged_label else none)
    elif spec.genres:
        out.append(overlap(spec.genres))
    if spec.exclude_genres:
        out.append(~overlap(spec.exclude_genres))
    if spec.countries:
        out.append(F.upper(F.coalesce("country", F.lit(""))).isin([c.upper() for c in spec.countries]))
    if spec.languages:
        out.append(F.lower(F.coalesce("language", F.lit(""))).isin([x.lower() for x in spec.languages]))
    if spec.bnm is not None:
        out.append(F.col("bnm") if spec.bnm else ~F.coalesce("bnm", F.lit(False)))
    out += [F.col(c) for c, on in (("bnr", spec.bnr), ("is_new_release", spec.new_releases), ("is_reissue", spec.reissues)) if on]
    out += [contains(c, text) for c, text in (("artist", spec.artist), ("reviewer", spec.reviewer)) if text]
    if spec.search:
        parts = [F.coalesce(F.col(c), F.lit("")) for c in ("artist", "album", "blurb", "reviewer")]
        line = F.concat(parts[0], *[x for p in parts[1:] for x in (F.lit(" "), p)])
        out.append(contains(line, spec.search))
    return out or [true]


def select_reviews(df: DataFrame, spec: Selection) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, predicates(spec)))


def top_per(df: DataFrame, column: str, n: int, tie: str = "id") -> DataFrame:
    """Exactly the best ``n`` rows per value of ``column`` (null dropped): score, then artist, then ``tie``."""
    order = Window.partitionBy(column).orderBy(F.desc_nulls_last("score"), F.asc_nulls_last("artist"), tie)
    ranked = df.filter(F.col(column).isNotNull()).withColumn("__rank", F.row_number().over(order))
    return ranked.filter(F.col("__rank") <= n).drop("__rank")


def sort_keys(how: str, seed: int = 0, tie: str = "id") -> list[Column]:
    last, first = F.asc_nulls_last, F.asc_nulls_first
    keys = {
        "score": [F.desc_nulls_last("score"), last("artist")],
        "score-asc": [last("score"), last("artist")],
        "date": [last("review_date"), last("artist")],
        "date-desc": [F.desc_nulls_last("review_date"), last("artist")],
        "release": [first("release_year"), first("artist")],
        "artist": [F.lower("artist").asc_nulls_last(), F.lower("album").asc_nulls_last()],
        "random": [F.xxhash64(F.col(tie), F.lit(seed)).asc()],
    }
    return [*keys[how], F.col(tie).asc()]


def sort_reviews(df: DataFrame, how: str = "score", seed: int = 0, tie: str = "id") -> DataFrame:
    """A total order; ``random`` repeats for a seed under any partitioning."""
    return df.orderBy(*sort_keys(how, seed, tie))


def run_selection(df: DataFrame, spec: Selection) -> DataFrame:
    """Filter, dedupe, top per review year, top per release year, sort, limit (0: none), in this order."""
    out = select_reviews(df, spec)
    if spec.dedupe:
        out = dedupe_albums(out)
    for column, n in (("review_year", spec.top_per_review_year), ("release_year", spec.top_per_release_year)):
        if n:
            out = top_per(out, column, n)
    out = sort_reviews(out, spec.sort, spec.seed)
    return out.limit(spec.limit) if spec.limit else out


def badge(bnm: Column, bnr: Column) -> Column:
    return F.when(bnm, "BNM").when(bnr, "BNR").otherwise("")
