"""Mapping of crowd tags onto genre buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, complete and in order: the first bucket with a keyword inside the tag wins.
BUCKETS: list[tuple[str, list[str]]] = [
    ("Metal", [
        "metal", "grindcore", "thrash", "doom", "sludge", "industrial", "black metal", "death metal", "heavy metal",
        "metalcore", "post-metal", "post metal", "nu metal", "slowcore", "mathcore", "power metal", "progressive metal",
        "prog metal", "gammarec", "neocrust",
    ]),
    ("Rap", ["rap", "hip hop", "hip-hop", "hiphop", "grime", "totec radio"]),
    ("Jazz", [
        "jazz", "bebop", "swing", "jazzfanatics", "jazz fusion", "free jazz", "smooth jazz", "vocal jazz", "latin jazz",
        "jazz funk", "jazz rock", "jazz rap", "jazzcore", "jazz blues", "jazz pop", "jazz soul",
    ]),
    ("Experimental", [
        "experimental", "noise", "avant-garde", "avant garde", "drone", "psychedelic", "krautrock", "neo-psychedelia",
        "avantgarde", "avantgarde rock", "avantgarde jazz", "contemporary classical", "modern classical",
        "electroacoustic", "musique concrète", "minimalistic",
    ]),
    ("Electronic", [
        "electronic", "electronica", "techno", "house", "idm", "edm", "drum and bass", "dnb", "trance", "downtempo",
        "trip hop", "trip-hop", "synth", "electro", "lo-fi", "lo fi", "chillwave", "chill wave", "synthwave", "synth wave",
        "minimal", "glitch", "future bass", "vaporwave", "vapor wave", "chillout", "chill out", "breakbeat", "hardstyle",
        "hard trance", "hard trance", "acid house", "acid", "electroclash", "electro clash", "jungle", "gabber", "gabba",
        "big beat", "dubstep", "drumstep", "trapstep", "future garage", "ghetto house",
    ]),
    ("Folk/Country", [
        "folk", "country", "americana", "bluegrass", "singer-songwriter", "singer songwriter", "americana folk",
        "folk rock", "alt-country", "alt country",
    ]),
    ("Global", [
        "world music", "afrobeat", "afrobeats", "reggae", "latin", "cumbia", "bossa nova", "reggaeton", "highlife", "dub",
        "african", "africa", "afro", "roots reggae",
    ]),
    ("Rock", [
        "rock", "punk", "grunge", "shoegaze", "emo", "emocore", "indie rock", "post-punk", "post punk", "garage rock",
        "hard rock", "new wave", "psychedelic rock", "prog rock", "progressive rock", "post-rock", "post rock", "indie",
        "alt rock", "alternative rock", "classic rock", "blues rock", "folk rock", "surf rock", "alternative", "pop punk",
        "glam rock", "goth rock", "garage punk", "math rock", "noise rock", "post hardcore", "post-hardcore",
        "stoner rock", "southern rock", "garage", "blues", "progressive", "pop rock", "hardcore", "hardcore punk",
        "emo rock",
    ]),
    ("Pop/R&B", [
        "pop", "r&b", "rnb", "r n b", "r and b", "soul", "funk", "disco", "indie pop", "synthpop", "synth pop", "dance",
        "dance pop", "electropop", "electro pop", "new wave pop", "bubblegum pop", "k-pop", "dream pop", "pop soul",
        "pop rap", "pop r&b", "trap",
    ]),
]

# Fixed values, complete and in order: a tag with one of these inside is no genre.
JUNK = [
    "seen live", "favourite", "favorite", "best of", "of all time", "check out", "listen to", "spotify", "amazing",
    "awesome", "masterpiece", "perfect album", "under rated", "under-rated", "underrated", "overrated", "beautiful",
    "classic album", "album of the year", "flawless", "10/10", "american", "canadian", "australian", "all",
    "female vocalist", "male vocalist", "female vocals", "male vocals", "female singer", "male singer", "japanese",
    "french", "german", "italian", "spanish", "swedish", "norwegian", "dutch", "chicago", "new york", "london", "paris",
    "berlin", "tokyo", "seoul", "moscow", "brazilian", "soundtrack", "sound track", "score", "instrumental",
    "instrumentals", "cover", "covers", "remix", "remixes", "canada", "usa", "uk", "us", "british", "american",
    "canadian", "australian", "united states", "united kingdom", "european", "europe", "bass", "guitar", "drums", "piano",
    "violin", "saxophone", "trumpet", "flute", "free improvisation", "compilation", "california", "texas", "florida",
    "new jersey", "new mexico", "new england", "japan", "improvisation", "my albums", "my music", "my collection",
    "my library", "my playlist", "my favorite albums", "atmospheric", "relaxing", "relaxation", "mellow",
    "ambient music", "new zealand", "austria", "switzerland", "belgium", "finland", "denmark", "norway", "sweden",
    "classical", "lounge", "beats",
]


def _shortest(phrases: list[str]) -> list[str]:
    """The phrases that contain no other one: a tag that holds a longer one holds its part too."""
    kept: list[str] = []
    for phrase in sorted(dict.fromkeys(phrases), key=len):
        if not any(k in phrase for k in kept):
            kept.append(phrase)
    return kept


def _any_inside(tag: Column, phrases: list[str]) -> Column:
    """One pattern for all phrases: a plan with a comparison a phrase would be larger than its data."""
    return tag.rlike("|".join(rf"\Q{phrase}\E" for phrase in _shortest(phrases)))


def is_genre_like(tag: Column, artist: Column, album: Column | None = None, junk: list[str] | None = None) -> Column:
    """Whether a tag can be a genre: not blank, not the artist or album, no year or decade, no junk phrase."""
    t = F.trim(F.lower(tag))
    fine = (t != "") & (t != F.trim(F.lower(F.coalesce(artist, F.lit("")))))
    if album is not None:
        title = F.trim(F.lower(F.coalesce(album, F.lit(""))))
        fine = fine & ((title == "") | (t != title))
    return F.coalesce(fine & ~t.rlike("^[0-9]{1,4}s?$") & ~_any_inside(t, JUNK if junk is None else junk), F.lit(False))


def bucket_of(tag: Column, buckets: list[tuple[str, list[str]]] | None = None) -> Column:
    """The first bucket with a keyword inside the tag, or null."""
    t, found = F.trim(F.lower(tag)), F.lit(None).cast("string")
    for name, keywords in reversed(BUCKETS if buckets is None else buckets):
        found = F.when(_any_inside(t, keywords), F.lit(name)).otherwise(found)
    return found


def canonical_genres(
    album_tags: Column, artist_tags: Column, artist: Column, album: Column,
    buckets: list[tuple[str, list[str]]] | None = None, junk: list[str] | None = None, most: int = 6,
) -> Column:
    """Buckets of the album's genre-like tags, else of the artist's (tested against the artist's name only), joined."""
    empty = F.expr("cast(array() as array<string>)")

    def mapped(tags: Column, title: Column | None) -> Column:
        like = F.filter(F.coalesce(tags, empty), lambda t: is_genre_like(t, artist, title, junk))
        return F.filter(F.transform(like, lambda t: bucket_of(t, buckets)), lambda b: b.isNotNull())

    own = mapped(album_tags, album)
    chosen = F.when(F.size(own) > 0, own).otherwise(mapped(artist_tags, None))
    return F.array_join(F.slice(F.array_distinct(chosen), 1, most), "; ")
