"""Language identification of web pages by Bayesian evidence fusion.

Four kinds of evidence meet in log space: the text (character trigrams of words, naive Bayes, its
weight bounded because words of one text depend on each other), the language that the markup
declares, the suffix of the address (last label of the host, and a language code as first part of the
path), and a prior for the host. The likelihoods of declarations and suffixes and the host priors are
grouped counts over all pages of the languages that the texts suggest; a host's counts are smoothed
towards its site's, those towards the corpus's, and a page's own text is taken out of its host's counts.

The trigram model is fitted on about ``FIT_DOCS`` documents of known language, those of small hash.
Trigrams that the fitting sample holds once are left out of it.
Edge cases: a page without words suggests no language (``text_lang`` null) and is in no count, languages
that tie share a page's vote (``text_lang`` null); a null or empty address or declaration is evidence of
its own kind ("none declared"); without any labelled document the result is empty of languages (null); null ids
and repeated rows are kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platter.llm.common import hash_sample, reliable, text_or_empty

FIT_DOCS = 2000
#: A text counts as at most so many words of evidence.
MOST_WORDS = 40.0
_WORD = re.compile(r"[^\W\d_]+")
_HIDDEN = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;", re.S | re.I)


def trigrams(word: str) -> list[str]:
    padded = f" {word} "
    return [padded[k : k + 3] for k in range(len(padded) - 2)]


@dataclass
class TrigramModel:
    languages: list[str]
    logs: dict[str, np.ndarray]
    unseen: np.ndarray

    @staticmethod
    def fit(rows: list[tuple[str, str, int]]) -> "TrigramModel":
        """``rows``: language, trigram, count."""
        languages = sorted({lang for lang, _, _ in rows})
        place = {lang: n for n, lang in enumerate(languages)}
        counts: dict[str, np.ndarray] = {}
        for lang, gram, n in rows:
            counts.setdefault(gram, np.zeros(len(languages)))[place[lang]] += n
        total = sum(counts.values(), np.zeros(len(languages))) + 0.5 * (len(counts) + 1)
        return TrigramModel(languages, {g: np.log((c + 0.5) / total) for g, c in counts.items()}, np.log(0.5 / total))

    def word(self, word: str) -> np.ndarray:
        return sum((self.logs.get(g, self.unseen) for g in trigrams(word)), np.zeros(len(self.languages)))

    def text(self, text: str, memory: dict[str, np.ndarray]) -> np.ndarray:
        """Log-likelihoods of a text's words, weighted down to ``MOST_WORDS`` words."""
        words = Counter(_WORD.findall(text.lower()))
        total = np.zeros(len(self.languages))
        for word, n in words.items():
            known = memory.get(word)
            if known is None:
                if len(memory) > 200_000:
                    memory.clear()
                known = memory[word] = self.word(word)
            total += n * known
        size = sum(words.values())
        return total * min(1.0, MOST_WORDS / size) if size else total


def fit_trigrams(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> TrigramModel:
    sample = hash_sample(
        docs.filter(F.col(lang_col).isNotNull()).select(F.xxhash64(id_col).alias("__hash"), lang_col, text_or_empty(text_col).alias("__text")),
        FIT_DOCS,
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams: Counter = Counter()
            for lang, text in zip(*(batch.column(k).to_pylist() for k in range(2))):
                for word, n in Counter(_WORD.findall(text.lower())).items():
                    for gram in trigrams(word):
                        grams[lang, gram] += n
            keys = sorted(grams)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([grams[k] for k in keys], pa.int64())],
                ["lang", "gram", "n"],
            )

    counted = sample.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return TrigramModel.fit(sorted((r["lang"], r["gram"], r["n"]) for r in counted.filter("n > 1").collect()))


def text_evidence(pages: DataFrame, model: TrigramModel, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``id_col``, ``host``, ``site``, ``suffix``, ``path_code``, ``declared`` and ``loglik`` of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, memory = shared.value, {}
        for batch in batches:
            logs = [own.text(_HIDDEN.sub(" ", t), memory).tolist() for t in batch.column(batch.num_columns - 1).to_pylist()]
            keep = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(logs, pa.list_(pa.float64()))], [*batch.schema.names[:-1], "loglik"])

    codes = "|".join(re.escape(x.lower()) for x in model.languages) or "-"
    url, html = F.lower(text_or_empty(url_col)), text_or_empty(html_col)
    host = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1)
    taken = pages.select(
        F.col(id_col),
        host.alias("host"),
        F.substring_index(host, ".", -2).alias("site"),
        F.substring_index(host, ".", -1).alias("suffix"),
        F.regexp_extract(url, rf"^[^:]*://[^/]*/({codes})(?:[/?#]|$)", 1).alias("path_code"),
        F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-z]+)", 1)).alias("declared"),
        html.alias("__html"),
    )
    kind = pages.schema[id_col].dataType.simpleString()
    return taken.mapInArrow(
        run, f"`{id_col}` {kind}, host string, site string, suffix string, path_code string, declared string, loglik array<double>"
    )


#: Keys beyond this many are not broadcast as a whole.
BROADCAST_KEYS = 200_000


def with_counts(evidence: DataFrame, key: str, size: int, name: str, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """Add ``name``: per value of ``key``, how many texts suggest each language, as one array.

    The counts are one row a value and are counted before they are joined. Few values are broadcast.
    Of many, only the hot ones are, those with more than a ``broadcast_keys``-th part of the rows each,
    of which there are fewer than ``broadcast_keys``; rows of the others meet their counts by a shuffle
    in which no value is large. So no hot host is ever one task.
    """
    each = F.array(*[F.sum(F.get("votes", F.lit(k))) for k in range(size)])
    counts = reliable(evidence.groupBy(F.col(key).alias("__key")).agg(each.alias(name), F.count(F.lit(1)).alias("__rows")))
    totals = counts.agg(F.count(F.lit(1)), F.sum("__rows")).first()
    on = F.col(key) == F.col("__key")
    if totals[0] <= broadcast_keys:
        return evidence.join(F.broadcast(counts.drop("__rows")), on, "left").drop("__key")
    large = totals[1] // broadcast_keys
    hot = evidence.join(F.broadcast(counts.filter(F.col("__rows") > large).drop("__rows")), on, "left").drop("__key")
    cold = hot.filter(F.col(name).isNull()).drop(name).join(counts.drop("__rows"), on, "left").drop("__key")
    return hot.filter(F.col(name).isNotNull()).unionByName(cold)


def _smoothed(counts: Column, prior: Column, strength: float) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(counts, prior, lambda n, p: (n + strength * p) / (total + strength))


def identify(
    pages: DataFrame,
    model: TrigramModel,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    strength: float = 10.0,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """Per page: ``id_col``, ``lang``, ``posterior``, ``text_lang``, ``declared``, ``host``, ``host_prior``."""
    size = len(model.languages)
    names = F.array(*[F.lit(x) for x in model.languages]) if size else F.expr("cast(array() as array<string>)")
    found = text_evidence(pages, model, id_col, url_col, html_col)
    peak = F.array_max("loglik")
    # Words make every likelihood negative: a page whose best is zero has none, and no vote anywhere.
    best = F.transform("loglik", lambda x: ((x == peak) & (peak < 0)).cast("double"))
    shared = F.greatest(F.aggregate(best, F.lit(0.0), lambda a, x: a + x), F.lit(1.0))
    evidence = found.withColumn("votes", F.transform(best, lambda x: x / shared))  # languages that tie share the vote
    evidence = reliable(evidence.withColumn("guess", F.array_position("votes", F.lit(1.0)).cast("int") - 1))
    if not size:
        null = F.lit(None)
        return evidence.select(
            id_col, null.cast("string").alias("lang"), null.cast("double").alias("posterior"), null.cast("string").alias("text_lang"),
            "declared", "host", null.cast("double").alias("host_prior"))

    whole = evidence.agg(F.array(*[F.coalesce(F.sum(F.get("votes", F.lit(k))), F.lit(0.0)) for k in range(size)]).alias("c"))
    whole = reliable(whole.select(_smoothed(F.col("c"), F.array(*[F.lit(1.0 / size)] * size), strength).alias("p")))
    corpus = whole.select("p").scalar()
    joined = evidence
    for key in ("host", "site", "declared", "suffix", "path_code"):
        joined = with_counts(joined, key, size, f"n_{key}", broadcast_keys)
    less = lambda name: F.zip_with(name, "votes", lambda n, x: F.greatest(n - x, F.lit(0.0)))
    joined = joined.withColumn("__corpus", corpus)
    joined = joined.withColumn("__site", _smoothed(less("n_site"), F.col("__corpus"), strength))
    joined = joined.withColumn("prior", _smoothed(less("n_host"), F.col("__site"), strength))
    terms = F.zip_with("loglik", F.transform("prior", lambda p: F.log(p)), lambda a, b: a + b)
    for key in ("declared", "suffix", "path_code"):
        # P(value | language) up to a factor that all languages share: P(language | value) / P(language).
        ratio = F.zip_with(_smoothed(less(f"n_{key}"), F.col("__corpus"), strength), F.col("__corpus"), lambda a, b: F.log(a / b))
        terms = F.zip_with(terms, ratio, lambda a, b: a + b)
    joined = joined.withColumn("terms", terms).withColumn("best", F.array_max("terms"))
    total = F.aggregate("terms", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("best")))
    at = F.array_position("terms", F.col("best")).cast("int")
    return joined.select(
        id_col,
        F.get(names, at - 1).alias("lang"),
        (F.lit(1.0) / total).alias("posterior"),
        F.when(F.col("guess") >= 0, F.get(names, F.greatest("guess", F.lit(0)))).alias("text_lang"),
        "declared",
        "host",
        F.get("prior", at - 1).alias("host_prior"),
    )
