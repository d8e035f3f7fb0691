"""Phrase collocation mining over count streams in prefix and suffix order.

Phrases of one to four words are counted per language, one length after another. A phrase can only
reach ``least`` occurrences if both phrases one word shorter have, so each pass over the texts counts
only such phrases; it knows them by a bit filter whose size is bounded, and which may let others
through but holds back none, so counts stay exact. Counts are combined on the map side.

What reaches ``least`` is then laid out twice, sorted by its words (prefix order) and by its words from
the last to the first (suffix order), as range-partitioned streams. In prefix order a phrase follows
the phrases that it continues, so one pass that keeps at most four open phrases gives every phrase the
counts of its first words, and the greatest count of a continuation by one word; suffix order gives
the same for its last words. A partition may start inside a family: the open phrases of its first row
(three at most) are handed to it, and what it adds to them is joined back. Both streams are then
merged by phrase.

A phrase inside any longer candidate is inside one that is a single word longer and no rarer, so the
greatest continuation on either side decides whether it is dropped.

Edge cases: a null text is empty, a null language ``und``; words are runs of anything but white space
and the marks that end a piece; repeated rows count as often as they occur; a null or missing id
doesn't matter; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platter.llm.common import reliable, text_or_empty, written

LONGEST = 4
#: Bytes of text that are counted together.
SLICE = 4 << 20
#: The bit filter of a length has at most so many bits (32 MB), however many phrases there are.
FILTER_BITS = 1 << 28

# What a byte is: 0 of a word, 1 white space, 2 the end of a piece.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


class PhraseFilter:
    """Which phrases may have reached the least count, by two bits of their 64-bit hash."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, len(words) * 64 - 1

    def holds(self, lang: str, phrases: list[bytes]) -> np.ndarray:
        import xxhash

        seed = xxhash.xxh64_intdigest(lang.encode(), 42)
        found = np.fromiter((xxhash.xxh64_intdigest(p, seed) for p in phrases), np.uint64, len(phrases))
        out = np.ones(len(phrases), dtype=bool)
        for place in (found & np.uint64(self.mask), (found >> np.uint64(32)) & np.uint64(self.mask)):
            out &= (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return out


def phrase_filter(frequent: DataFrame) -> PhraseFilter:
    """The filter of ``frequent`` (``lang``, ``phrase``), made by grouped bit-ors; its size is bounded, whatever the count."""
    size = 1 << 12
    count = frequent.count()
    while size < min(16 * count, FILTER_BITS):
        size *= 2
    hashed = frequent.select(F.xxhash64("lang", "phrase").alias("h"))
    place = hashed.select(F.explode(F.array("h", F.shiftrightunsigned("h", 32))).alias("p")).select(F.col("p").bitwiseAND(F.lit(size - 1)).alias("p"))
    bit = F.expr("shiftleft(1L, cast(p & 63 as int))")
    rows = place.groupBy(F.shiftright("p", 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(size // 64, dtype=np.int64)
    words[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return PhraseFilter(words.view(np.uint64))


class Slice:
    """The words of some texts of one language: dictionary, codes, and the piece that each word lies in."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts).lower(), dtype=np.uint8)  # bytes: A-Z only
        kind = _KIND[raw]
        inside = np.concatenate([[False], kind == 0, [False]])
        starts, ends = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
        self.piece = np.cumsum(kind == 2)[starts]
        edges = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        letters = np.ascontiguousarray(raw[kind == 0])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(letters)])
        coded = words.dictionary_encode()
        self.code, self.words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()

    def counts(self, size: int, lang: str, filters: list[PhraseFilter]) -> tuple[list[bytes], np.ndarray]:
        """Phrases of ``size`` words and their counts; only those whose shorter phrases pass ``filters`` (one per length)."""
        code, names = self.code, self.words
        at = np.arange(len(code))  # where the phrases of the present length start
        for length in range(1, size + 1):
            if length > 1:
                # Two phrases a word shorter, the second a word later, in the same piece.
                follows = np.flatnonzero((at[1:] == at[:-1] + 1) & (self.piece[at[:-1]] == self.piece[np.minimum(at[1:] + length - 2, len(self.piece) - 1)]))
                pair = code[follows] * np.int64(len(self.words)) + self.code[at[follows] + length - 1]
                at = at[follows]
                found, code = np.unique(pair, return_inverse=True)
                names = [names[k] + b" " + self.words[w] for k, w in zip((found // max(len(self.words), 1)).tolist(), (found % max(len(self.words), 1)).tolist())]
            if length < size:
                fine = filters[length - 1].holds(lang, names)
                keep = fine[code] if len(code) else np.zeros(0, bool)
                at, code = at[keep], code[keep]
                kept, code = np.unique(code, return_inverse=True)
                names = [names[k] for k in kept.tolist()]
        return names, np.bincount(code, minlength=len(names))


def phrase_counts(docs: DataFrame, size: int, filters: list[PhraseFilter], text_col: str, lang_col: str) -> DataFrame:
    """``lang``, ``phrase`` (words joined by a space), ``n`` for all phrases of ``size`` words that may reach the least count."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        weight: dict[str, int] = {}

        def counted(lang: str) -> pa.RecordBatch:
            names, n = Slice(held.pop(lang)).counts(size, lang, shared.value)
            weight.pop(lang)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(names), pa.string()), pa.array(names, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], ["lang", "phrase", "n"]
            )

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode()
                held.setdefault(lang, []).append(raw)
                weight[lang] = weight.get(lang, 0) + len(raw)
                if weight[lang] >= SLICE:
                    yield counted(lang)
                elif sum(weight.values()) >= 4 * SLICE:  # many languages at once
                    yield counted(max(weight, key=weight.get))
        for lang in list(held):
            yield counted(lang)

    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_or_empty(text_col).alias("text"))
    return texts.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def continued(counts: DataFrame, suffix: bool = False) -> DataFrame:
    """``lang``, ``phrase``, ``n``, ``before`` (counts of its first 1, 2, 3 words) and ``more`` (the greatest count of it
    with one word after it); ``suffix`` reads phrases from the last word to the first."""
    words = F.split("phrase", " ")
    stream = counts.select("lang", F.reverse(words).alias("w") if suffix else words.alias("w"), "phrase", "n")
    stream = stream.repartitionByRange("lang", "w").sortWithinPartitions("lang", "w")
    stream = reliable(stream.withColumn("part", F.spark_partition_id()))
    firsts = stream.groupBy("part").agg(F.min(F.struct("lang", "w")).alias("f"))  # a row per partition
    size = F.size("f.w")
    heads = F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.slice("f.w", 1, k))
    open_keys = firsts.filter(size > 1).select("part", F.col("f.lang").alias("lang"), F.explode(heads).alias("w"))
    handed: dict[int, list[tuple]] = {}
    found = stream.select("lang", "w", "phrase", "n").join(F.broadcast(open_keys), ["lang", "w"])  # three per partition at most
    for row in found.select("part", "lang", "w", "phrase", "n").collect():
        handed.setdefault(row["part"], []).append((row["lang"], row["w"], row["phrase"], row["n"]))
    shared = counts.sparkSession.sparkContext.broadcast({part: sorted(rows, key=lambda r: len(r[1])) for part, rows in handed.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "phrase", "n", "before", "more", "handed"]
        kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.bool_())
        stack: list[list] = []  # open phrases: lang, words, phrase, n, counts before, greatest continuation, handed over
        done: list[tuple] = []
        fresh = True

        def close(down_to: int) -> None:
            while len(stack) > down_to:
                lang, _, phrase, n, before, more, given = stack.pop()
                done.append((lang, phrase, n, before, more, given))

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
            done.clear()
            return out

        for batch in batches:
            for lang, own, phrase, n, part in zip(*(c.to_pylist() for c in batch.columns)):
                if fresh:
                    for head in shared.value.get(part, []):
                        stack.append([*head, [x[3] for x in stack], 0, True])
                    fresh = False
                level = len(own) - 1
                close(level)
                while stack and (stack[-1][0] != lang or own[: len(stack[-1][1])] != stack[-1][1]):
                    close(len(stack) - 1)
                if level:
                    stack[-1][5] = max(stack[-1][5], n)
                stack.append([lang, own, phrase, n, [x[3] for x in stack], 0, False])
            if done:
                yield flush()
        close(0)
        if done:
            yield flush()

    schema = "lang string, phrase string, n long, before array<long>, more long, handed boolean"
    rows = reliable(stream.select("lang", "w", "phrase", "n", "part").mapInArrow(run, schema))
    later = rows.filter("handed").groupBy("lang", "phrase").agg(F.max("more").alias("__more"))  # three per partition at most
    own = rows.filter("NOT handed").join(F.broadcast(later), ["lang", "phrase"], "left")
    return own.select("lang", "phrase", "n", "before", F.greatest("more", F.coalesce("__more", F.lit(0))).alias("more"))


def collocations(
    docs: DataFrame, least: int = 30, top: int = 2000, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    single = written(phrase_counts(docs, 1, [], text_col, lang_col))
    totals = single.groupBy("lang").agg(F.sum("n").alias("words"))
    levels, filters = [single.filter(F.col("n") >= least)], []
    for size in range(2, LONGEST + 1):
        filters.append(phrase_filter(levels[-1]))
        levels.append(written(phrase_counts(docs, size, filters, text_col, lang_col).filter(F.col("n") >= least)))
    counts = levels[0]
    for level in levels[1:]:
        counts = counts.unionByName(level)
    first = continued(counts).withColumnsRenamed({"before": "l", "more": "right"})
    last = continued(counts, suffix=True).select("lang", "phrase", F.col("before").alias("r"), F.col("more").alias("left"))
    merged = first.join(last.hint("merge"), ["lang", "phrase"]).filter(F.size("l") > 0)
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    # Cut k leaves the first k words and the last size - k; SQL's integer division is exact.
    cuts = F.transform(
        F.sequence(F.lit(1), F.size("l")),
        lambda k: F.struct(F.element_at("l", k).alias("l"), F.element_at("r", F.size("l") + 1 - k).alias("r"), k.alias("k")),
    )
    scored = F.expr(
        "array_min(transform(cuts, c -> named_struct('score', cast(2000000 as decimal(20,0)) * cast(n as decimal(18,0)) div (c.l + c.r), 'k', c.k, 'l', c.l, 'r', c.r)))"
    )
    kept = merged.filter(F.greatest("left", "right").cast("decimal(38,0)") * 100 < wide("n") * 80)
    found = kept.withColumn("cuts", cuts).withColumn("best", scored).select("lang", "phrase", F.col("n").alias("a"), "best.l", "best.r", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), F.col("score").cast("long").alias("score")
    )
