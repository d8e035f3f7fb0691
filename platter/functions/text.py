"""Text normalisers and scalar helpers as column functions.

There are four normalisers that must not be mixed: ``album_key`` (dedupe, merge), ``loose_key`` (vote,
validation), ``strict_key`` (artists) and ``title_tokens`` (titles). Only HTML unescaping, Unicode
normalisation and legacy decoding leave the JVM, as Arrow-batched helpers.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that the normalisers drop or treat as edition marks.
EDITION_DROP = "deluxe expanded remaster remastered reissue anniversary edition super box set collector collectors vinyl ep lp".split()
LOOSE_DROP = "the a an ep lp and".split()
EDITION_END = "ep edition deluxe remastered remaster version".split()
EDITION_TAIL = [*EDITION_END, *"expanded anniversary collectors collector special bonus track tracks limited super".split()]
NUMBER_WORDS = "two three four five six seven eight nine ten ii iii iv vi vii viii ix".split()
EXACT_JUNK = (
    "home search next previous prev back top index more email e-mail links news about contact staff archive archives "
    "reviews review features interviews menu main here n/a tbd various untitled"
).split()
SUBSTRING_JUNK = [
    "click here", "next page", "all rights", "copyright", "mailto", "http://", "https://", "subscribe",
    "back to", "top of page", "site design", "webmaster", "advertise", "javascript",
]
SCORE = r"(?<![\d.])(10(?:\.0)?|[0-9](?:\.[0-9])?)(?![\d.])"

_NO_WORD_BEFORE, _NO_WORD_AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def _each_once(values: pa.Array, change: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """``change`` applied to the distinct values of a batch: names repeat a lot."""
    coded = values.dictionary_encode()
    return change(coded.dictionary).take(coded.indices)


@F.arrow_udf(T.StringType())
def unescape(texts: pa.Array) -> pa.Array:
    """HTML entities to characters, once."""
    plain = lambda own: pa.array([html.unescape(t) if "&" in t else t for t in own.to_pylist()], pa.string())
    return _each_once(texts, plain)


@F.arrow_udf(T.StringType())
def unescape_twice(texts: pa.Array) -> pa.Array:
    """HTML entities to characters, and what entities that gives to characters again."""
    plain = lambda own: pa.array([html.unescape(html.unescape(t)) if "&" in t else t for t in own.to_pylist()], pa.string())
    return _each_once(texts, plain)


@F.arrow_udf(T.StringType())
def _cleaned(texts: pa.Array) -> pa.Array:
    """The steps of ``clean_text`` on the distinct values of a batch."""

    def plain(own: pa.Array) -> pa.Array:
        resolved = (html.unescape(html.unescape(t)) if "&" in t else t for t in own.to_pylist())
        return pa.array([" ".join(t.replace("\u200b", "").split()) for t in resolved], pa.string())

    return _each_once(texts, plain)


@F.arrow_udf(T.StringType())
def nfkd(texts: pa.Array) -> pa.Array:
    """Unicode compatibility decomposition."""
    return _each_once(texts, lambda own: pc.utf8_normalize(own, form="NFKD"))


def _decode(raw: bytes) -> str:
    for encoding in ("utf-8", "cp1252"):
        try:
            return raw.decode(encoding)
        except UnicodeDecodeError:
            pass
    return raw.decode("latin-1")


@F.arrow_udf(T.StringType())
def decode_bytes(blobs: pa.Array) -> pa.Array:
    """Bytes of old pages as text: UTF-8, else Windows-1252, else Latin-1."""
    return pa.array([None if b is None else _decode(b) for b in blobs.to_pylist()], pa.string())


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _words(words: list[str]) -> str:
    return f"{_NO_WORD_BEFORE}(?:{'|'.join(sorted(words, key=len, reverse=True))}){_NO_WORD_AFTER}"


def _unbracketed(c: Column) -> Column:
    return F.regexp_replace(c, r"\[[^\n]*?\]|\([^\n]*?\)", " ")


def _alnum(c: Column) -> Column:
    return F.regexp_replace(c, "[^a-z0-9]+", "")


def clean_text(c: Column | str) -> Column:
    """Null as '', entities resolved twice, zero-width spaces dropped, white space collapsed and trimmed."""
    return _cleaned(F.coalesce(_col(c), F.lit("")))


def album_key_part(c: Column | str) -> Column:
    base = _unbracketed(nfkd(F.lower(F.coalesce(_col(c), F.lit("")))))
    return _alnum(F.regexp_replace(base, _words(EDITION_DROP), " "))


def album_key(artist: Column | str, album: Column | str) -> Column:
    """The key by which editions of an album are one."""
    return F.concat(album_key_part(artist), F.lit("|"), album_key_part(album))


def loose_key(c: Column | str) -> Column:
    base = _unbracketed(nfkd(F.lower(F.coalesce(_col(c), F.lit("")))))
    return _alnum(F.regexp_replace(base, _words(LOOSE_DROP), " "))


def strict_clean(c: Column | str) -> Column:
    """Lower case without accents, ligatures, apostrophes and brackets; '&' and '+' read 'and', 'St.' 'street'."""
    s = F.regexp_replace(nfkd(F.lower(F.coalesce(_col(c), F.lit("")))), r"\p{M}", "")
    s = F.translate(s, "øðłđ", "odld")
    for ligature, plain in (("æ", "ae"), ("œ", "oe"), ("þ", "th"), ("ß", "ss")):
        s = F.replace(s, F.lit(ligature), F.lit(plain))
    s = F.regexp_replace(s, "['’`´]", "")
    s = _unbracketed(F.regexp_replace(s, "[&+]", " and "))
    return F.regexp_replace(s, rf"{_NO_WORD_BEFORE}st{_NO_WORD_AFTER}\.?", "street")


def strict_key(c: Column | str) -> Column:
    return _alnum(F.regexp_replace(F.trim(strict_clean(c)), "^the ", ""))


def title_tokens(c: Column | str) -> Column:
    """Words of a title without 'the'; edition words and ordinals at an edition mark's end are cut, never to nothing."""
    words = F.filter(F.regexp_extract_all(strict_clean(c), F.lit("[a-z0-9]+"), F.lit(0)), lambda w: w != "the")
    line = F.array_join(words, " ")
    short = F.regexp_replace(line, rf"(?:(?:^| )(?:{'|'.join(EDITION_TAIL)}|[0-9]+(?:st|nd|rd|th)))+$", "")
    cut = F.when(line.rlike(rf"(?:^| )(?:{'|'.join(EDITION_END)})$") & (short != ""), short).otherwise(line)
    return F.when(cut == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(cut, " "))


def title_key(tokens: Column | str) -> Column:
    """Equal for titles of the same words in any order; '' for none."""
    return F.array_join(F.array_sort(_col(tokens)), " ")


_CONNECTOR = r"(?i)(?U)\s*(?:,|/|;|\s&\s|\s\+\s|\sand\s|\swith\s|\sfeat\.?\s|\sfeaturing\s|\svs\.?\s)\s*"


def want_keys(c: Column | str) -> Column:
    """Keys of a wanted artist: the full name, the name before a connector, its stem before a possessive."""
    name = F.coalesce(_col(c), F.lit(""))
    main = F.get(F.split(name, _CONNECTOR, 2), F.lit(0))
    stem = F.get(F.split(main, rf"[’']s{_NO_WORD_AFTER}", 2), F.lit(0))
    return F.array_remove(F.array_distinct(F.array(strict_key(name), strict_key(main), strict_key(stem))), "")


def tag_occurrences(tokens: Column | str) -> Column:
    """Sorted tokens numbered per word, so that set operations act on multisets."""
    ordered = F.array_sort(_col(tokens))
    return F.transform(ordered, lambda x, i: F.concat(x, F.lit("#"), (i - F.array_position(ordered, x) + 2).cast("string")))


def token_difference(a: Column | str, b: Column | str) -> Column:
    """Multiset difference of two token arrays, as occurrence-tagged tokens."""
    return F.array_except(tag_occurrences(a), tag_occurrences(b))


def plausible_score(c: Column | str) -> Column:
    value = _col(c).try_cast("double")
    return F.when(value.between(0.0, 10.0), value)


def looks_like_name(c: Column | str) -> Column:
    s = _col(c)
    low = F.trim(F.lower(s))
    letters = F.length(F.regexp_replace(s, r"[^\p{L}]", ""))
    junk = low.rlike("|".join(rf"\Q{phrase}\E" for phrase in SUBSTRING_JUNK))
    fine = (
        F.length(s).between(2, 140) & s.rlike("[A-Za-z]") & ~low.isin(EXACT_JUNK) & ~junk
        & (letters >= F.greatest(F.lit(2.0), F.length(s) * F.lit(0.4)))
    )
    return F.coalesce(fine, F.lit(False))


def url_key(c: Column | str) -> Column:
    return F.right(F.regexp_replace(_col(c), "[^A-Za-z0-9]+", "_"), F.lit(90))


def genre_from_filename(path: Column | str) -> Column:
    """The genre that a file's name spells: up to its first dot, '__' as comma, '_' as space."""
    name = F.substring_index(F.substring_index(_col(path), "/", -1), ".", 1)
    name = F.lower(F.replace(F.replace(name, F.lit("__"), F.lit(",")), F.lit("_"), F.lit(" ")))
    russian = name.startswith("aquarium") | name.startswith("songs of protest")
    return F.when(russian, "russian rock").otherwise(F.coalesce(name, F.lit("")))


def strip_tags(c: Column | str) -> Column:
    """Page text: scripts dropped, line-ending tags as newlines, other tags as spaces, entities resolved twice."""
    s = F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    s = F.regexp_replace(s, r"(?i)<br\s*/?>|</(?:p|tr|div|li|h[1-6]|td|th|b|strong|table|ul|ol|dt|dd)\s*>", "\n")
    s = unescape_twice(F.regexp_replace(s, "<[^>]+>", " "))
    s = F.regexp_replace(F.replace(s, F.lit(" "), F.lit(" ")), "[ \t]+", " ")
    return F.regexp_replace(F.regexp_replace(s, r"(?U)\n\s*\n+", "\n"), r"(?U)^\s+|\s+$", "")


_SCRIPT = re.compile(r"<(script|style)[^>]*>.*?</\1>", re.I | re.S | re.A)
_LINE_END = re.compile(r"<br\s*/?>|</(?:p|tr|div|li|h[1-6]|td|th|b|strong|table|ul|ol|dt|dd)\s*>", re.I | re.A)
#: What Java's Unicode classes take for white space.
_WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_BLANK_LINES = re.compile(f"\n[{_WHITE}]*\n+")
_REVIEWER = r"(?:by|reviewed by)\s+([A-Z][A-Za-z.'-]+(?:\s+[A-Z][A-Za-z.'-]+){1,3})"


def stripped(page: str) -> str:
    """``strip_tags`` of one string, for tasks that hold pages in Python anyway."""
    s = re.sub("<[^>]+>", " ", _LINE_END.sub("\n", _SCRIPT.sub(" ", page)))
    if "&" in s:
        s = html.unescape(html.unescape(s))
    return _BLANK_LINES.sub("\n", re.sub("[ \t]+", " ", s.replace("\xa0", " "))).strip(_WHITE)


def reviewer_of(page_text: str) -> str:
    """The name that ``find_reviewer`` cleans, '' for none."""
    found = re.search(_REVIEWER, page_text, re.A)
    return found[1] if found else ""


def clean_field(c: Column | str, longest: int = 140) -> Column:
    """A field as extracted: entities resolved once, cut at bylines and ratings, outer punctuation trimmed."""
    return trim_field(unescape(F.coalesce(_col(c), F.lit(""))), longest)


def trim_field(c: Column | str, longest: int = 140) -> Column:
    """``clean_field`` of a field whose entities are resolved."""
    s = F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"(?U)\s+", " ")
    s = F.get(F.split(s, r"(?i)(?U)\s+(?:reviewed by|review by|rating\s*[:=]|posted|by\s+[A-Z])", 2), F.lit(0))
    return F.substring(F.regexp_replace(s, "^[ \t\n\r\\-–—:·|*]+|[ \t\n\r\\-–—:·|*]+$", ""), 1, longest)


def find_reviewer(c: Column | str) -> Column:
    name = F.regexp_extract(_col(c), _REVIEWER, 1)
    return F.when(name != "", clean_field(name, 60))
