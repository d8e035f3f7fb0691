"""Toxic passages by maximum-scoring segments.

A token is read as its word and as the word's beginnings of 4 to 7 letters, so that forms of one stem
count together; the best of these scores is the token's. A score is the lower confidence bound of its log-odds between toxic and other documents with
an informative Dirichlet prior, kept only where its z-score is significant; every other token costs ``drift``. In a text, a
linear-time scan finds all maximal-scoring segments. The best segment's score is set against what
clean texts of that length reach by chance: for those, the maximum follows an extreme-value law with
E = K * n * exp(-lambda * score), whose two parameters are fitted to clean labelled documents (as is
the level of significance, by log-loss on documents that the log-odds haven't seen).
Passages with E below ``PASSAGE_E`` are reported; a logistic curve over -log E, fitted to labelled
documents that the log-odds haven't seen, turns the best passage into a probability.

The fit reads about ``fit_rows`` labelled documents, those of small hash, so what reaches the
driver is bounded; equal texts count once. Edge cases: a null or blank text has the score of a text
without passages; a null id or a label without document is never learned from; with no toxic label
every score is 0; repeated rows are scored alike; an empty table gives an empty result; other columns
are ignored by ``score_toxicity`` and kept by ``drop_toxic``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platter.llm.common import hash_sample, reliable, text_or_empty

FIT_ROWS = 20_000
PASSAGE_E = 0.01
#: Lengths of the beginnings that stand for a word's stem.
STEMS = range(4, 8)
_WORD = re.compile(r"[^\W\d_]+")


def tokens_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def forms_of(word: str) -> list[str]:
    """The word, and its beginnings (marked by a hyphen)."""
    return [word, *(f"{word[:k]}-" for k in STEMS if k < len(word))]


def token_places(text: str) -> list[tuple[int, int]]:
    """Where the tokens of ``tokens_of`` lie in the text."""
    return [m.span() for m in _WORD.finditer(text)]


def fold_of(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; rows of fold 0 are held out."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5))


def maximal_segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, first token, last token) in one pass over the positive tokens.

    Tokens between the ``hits`` cost ``drift`` each. Candidates are kept with the total before and
    after them and a link to the last earlier candidate that starts lower (Ruzzo and Tompa's scan); a
    new token follows the links, so every candidate is passed once and the scan is linear.
    """
    kept: list[tuple[float, float, int, int, int]] = []  # total before, total after, first, last, link
    total, at = 0.0, 0
    for place, score in hits:
        total -= drift * (place - at)
        before, total, at = total, total + score, place + 1
        first, k = place, len(kept) - 1
        while True:
            while k >= 0 and kept[k][0] >= before:
                k = kept[k][4]
            if k < 0 or kept[k][1] >= total:
                kept.append((before, total, first, place, k))
                break
            before, _, first, _, link = kept[k]
            del kept[k:]
            k = link
    return [(after - before, first, last) for before, after, first, last, _ in kept]


@dataclass
class ToxicModel:
    scores: dict[str, float] = field(default_factory=dict)
    drift: float = 0.5
    rate: float = 1.0
    log_k: float = 0.0
    slope: float = 0.0
    intercept: float = -50.0
    memory: dict[str, float] = field(default_factory=dict, repr=False, compare=False)

    def token_score(self, token: str) -> float:
        """The best score among the token's forms; 0 where none is known."""
        found = self.memory.get(token)
        if found is None:
            if len(self.memory) > 500_000:
                self.memory.clear()
            found = self.memory[token] = max((self.scores.get(f, 0.0) for f in forms_of(token)), default=0.0)
        return found

    def passages(self, tokens: list[str]) -> tuple[int, list[tuple[float, int, int]]]:
        """The number of tokens, and the maximal segments."""
        hits = [(n, s) for n, s in enumerate(map(self.token_score, tokens)) if s]
        return len(tokens), maximal_segments(hits, self.drift) if hits else []

    def minus_log_e(self, score: float, tokens: int) -> float:
        return self.rate * score - math.log(max(tokens, 1)) - self.log_k

    def judge(self, text: str) -> tuple[float, int, float]:
        """Probability, number of significant passages, and -log E of the best one."""
        tokens, segments = self.passages(tokens_of(text))
        values = [self.minus_log_e(s, tokens) for s, _, _ in segments]
        best = max(values, default=self.minus_log_e(0.0, tokens))
        p = 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * best + self.intercept))))
        return p if self.slope else 0.0, sum(v > -math.log(PASSAGE_E) for v in values), best


def dirichlet_log_odds(
    toxic: np.ndarray, other: np.ndarray, all_toxic: float, all_other: float, strength: float = 0.05
) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of each token between two counts, and z-scores; the totals are those of all tokens.

    The prior is ``strength`` times the counts of both together, so a token needs a handful of
    documents on one side, and none on the other, to be significant.
    """
    prior, whole = strength * (toxic + other), strength * (all_toxic + all_other)
    a, b = toxic + prior, other + prior
    delta = np.log(a / (all_toxic + whole - a)) - np.log(b / (all_other + whole - b))
    return delta, delta / np.sqrt(1 / a + 1 / b)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and intercept of P(y = 1 | x) by Newton steps."""
    centre, scale = x.mean(), x.std() or 1.0
    design, w = np.stack([(x - centre) / scale, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (y - p) - ridge * w
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2), gradient)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w[0] / scale, w[1] - w[0] * centre / scale


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    fit_rows: int = FIT_ROWS,
    least_z: tuple[float, ...] = (2.5, 3.5, 5.0, 7.0),
    drifts: tuple[float, ...] = (0.5, 0.15, 0.05, 0.015),
) -> ToxicModel:
    """Learn from labelled rows outside fold 0: folds 1 to 3 give the log-odds, fold 4 the calibration."""
    chosen = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold_of(id_col) != 0))
        .groupBy(id_col)
        .agg((F.max(label_col) > 0).cast("int").alias("__y"))
        .select(id_col, "__y", F.xxhash64(id_col).alias("__hash"))
    )
    chosen = hash_sample(chosen, fit_rows)
    # About ``fit_rows`` ids whatever the input: a bounded side, so the texts are read in place and not shuffled.
    sample = docs.select(id_col, text_or_empty(text_col).alias("__text")).join(F.broadcast(chosen), id_col)
    sample = sample.withColumn("__fold", fold_of(id_col)).select("__fold", "__y", "__text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold, y, hashes, words = [], [], [], []
            for f, label, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                found = sorted(f for t in set(tokens_of(text)) for f in forms_of(t))
                fold.append(f), y.append(label), words.append(found), hashes.append(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(fold, pa.int64()), pa.array(y, pa.int32()), pa.array(hashes, pa.string()), pa.array(words, pa.list_(pa.string()))],
                ["fold", "y", "text", "words"],
            )

    rows = sample.mapInArrow(counted, "fold long, y int, text string, words array<string>")
    distinct = reliable(rows.withColumn("h", F.xxhash64("text")).drop("text").groupBy("h").agg(
        F.min("fold").alias("fold"), F.max("y").alias("y"), F.first("words").alias("words")))
    counts = reliable(
        distinct.filter("fold < 4")
        .select("y", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("other"))
        .filter("toxic + other >= 3")
    )
    model = ToxicModel()
    totals = counts.agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).first()
    if not totals["toxic"]:
        return model
    # Only words commoner among the toxic ones can score, so only they are fetched.
    likely = counts.filter(F.col("toxic") * int(totals["other"]) > F.col("other") * int(totals["toxic"])).orderBy("word").toPandas()
    delta, z = dirichlet_log_odds(
        likely["toxic"].to_numpy(float), likely["other"].to_numpy(float), float(totals["toxic"]), float(totals["other"])
    )
    # The lower end of the log-odds' 95 % interval: rare tokens count less than well-attested ones.
    lower = delta - 1.96 * delta / np.where(z == 0, 1.0, z)
    drafts = []
    for least in least_z:
        keep = (z >= least) & (lower > 0)
        scores = dict(zip(likely["word"][keep], lower[keep].tolist()))
        drafts += [ToxicModel(scores, drift) for drift in drifts]
    shared = docs.sparkSession.sparkContext.broadcast(drafts)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (y, n, k, max((s for s, _, _ in segments), default=0.0))
                for y, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
                for tokens in [tokens_of(text)]
                for k, own in enumerate(shared.value)
                for n, segments in [own.passages(tokens)]
            ]
            columns = list(zip(*rows)) or [[]] * 4
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], ["y", "n", "draft", "best"])

    seen = sample.filter("__fold = 4").mapInArrow(scanned, "y int, n long, draft int, best double").toPandas()
    fitted = [_calibrated(own, seen[seen["draft"] == k]) for k, own in enumerate(drafts)]
    return min(fitted, key=lambda pair: pair[0])[1]


def _calibrated(model: ToxicModel, seen) -> tuple[float, ToxicModel]:
    """Fit the extreme-value law and the logistic curve to held-out rows; the log-loss there and the model."""
    seen = seen.sort_values(["y", "n", "best"])
    clean = seen[(seen["y"] == 0) & (seen["n"] > 0)]
    if len(clean) < 10 or not seen["y"].any() or not model.scores:
        return math.inf, model
    # Gumbel by moments over the maxima of clean texts, after taking out their length.
    best, n = clean["best"].to_numpy(), clean["n"].to_numpy(float)
    model.rate = math.pi / (math.sqrt(6) * max(float(best.std()), 0.25))
    model.log_k = float(np.mean(model.rate * best - np.log(n))) - 0.5772156649
    x = np.array([model.minus_log_e(s, k) for s, k in zip(seen["best"], seen["n"])])
    y = seen["y"].to_numpy(float)
    model.slope, model.intercept = fit_logistic(x, y)
    p = 1 / (1 + np.exp(-np.clip(model.slope * x + model.intercept, -30, 30)))
    return float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))), model


def score_toxicity(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, ``held_out``, ``score``, ``predicted`` and ``n_passages``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            found = [own.judge(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([p for p, _, _ in found], pa.float64()),
                    pa.array([int(p >= 0.5) for p, _, _ in found], pa.int32()),
                    pa.array([k for _, k, _ in found], pa.int32()),
                ],
                [id_col, "held_out", "score", "predicted", "n_passages"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, (fold_of(id_col) == 0).alias("held_out"), text_or_empty(text_col).alias("__text")).mapInArrow(
        run, f"`{id_col}` {kind}, held_out boolean, score double, predicted int, n_passages int"
    )


def toxic_passages(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per significant passage: ``id_col``, ``start``, ``end`` (code points, end exclusive), ``segment_score``, ``e_value``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            row, starts, ends, scores, values = [], [], [], [], []
            for n, text in enumerate(batch.column(1).to_pylist()):
                count, segments = own.passages(tokens_of(text))
                found = [(s, a, b, math.exp(-own.minus_log_e(s, count))) for s, a, b in segments]
                found = [f for f in found if f[3] < PASSAGE_E]
                if found:
                    places = token_places(text)
                    for s, a, b, e in found:
                        row.append(n), starts.append(places[a][0]), ends.append(places[b][1]), scores.append(s), values.append(e)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(starts, pa.int64()),
                    pa.array(ends, pa.int64()),
                    pa.array(scores, pa.float64()),
                    pa.array(values, pa.float64()),
                ],
                [id_col, "start", "end", "segment_score", "e_value"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_or_empty(text_col).alias("__text")).mapInArrow(
        run, f"`{id_col}` {kind}, start long, end long, segment_score double, e_value double"
    )


def drop_toxic(docs: DataFrame, model: ToxicModel, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows whose score is below ``limit``, with their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            yield batch.filter(pa.array([own.judge(t or "")[0] < limit for t in batch.column(place).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
