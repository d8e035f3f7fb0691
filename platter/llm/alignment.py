"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Tokenizer A (a ``tokenizers`` file, byte-level) encodes a space and the text, tokenizer B (a
``sentencepiece`` file with byte fallback) the text, to which it adds the space itself. The spans that
the libraries give (character offsets of A, proto spans of B, which are bytes) are the coarse ends of
the tokens. Where a span is not what its token decodes to, because a character of several bytes is cut
between tokens, the ends are refined by counting decoded bytes from the last coarse end that holds.
Bytes at which tokens of both end cut the tokens into groups; all A-B pairs in a group are linked.

Corpus-wide counts (how many rows hold an id pair linked) are one grouped count over the distinct
pairs of every row. They come back to the rows in two ways: a pair that holds a share of 1 / ``HEAVY``
of all (row, pair) entries or more is looked up in a broadcast table, which has ``HEAVY`` rows at most
by that definition; the others, none of which can be a hot key, by a join.

Texts are cut at lone spaces between other characters, where tokens of both sides end, since neither tokenizer
has a token across the start of a word (a B file with such a piece is refused). The groups of such a chunk are
found once per task.

Edge cases: null and empty texts, and texts whose joined A or B bytes differ from space and text, have
no tokens: zeros and an empty ``groups_sha256``. Repeated rows count as rows; null ids stay; further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platter.llm.bpe import splitter, text_slices
from platter.llm.common import sha256_hex, text_or_empty, written
from platter.operators.steps import bounded_batches

#: A pair with at least this share of all entries is looked up instead of joined; there are at most so many.
HEAVY = 1 << 16
#: Groups with more links than this are paired by distinct ids.
WIDE = 4096
#: Words that a tokenizer is given at once: a call for each costs more than its tokens, and long answers keep the garbage collector busy.
LINE = 512
#: Chunks that are learned at once.
LEARN = 8192
#: Where tokens of both sides end whatever stands around: a lone space between other than white space.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_WORD = re.compile(" +[^ ]*|[^ ]+")
#: Ids of words one after another, their ends within their word, and for every word how many it has and its length.
Encoded = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _byte_table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    return np.frombuffer(b"".join(tokens), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes


def _sizes(items: list) -> np.ndarray:
    return np.fromiter(map(len, items), np.int64, len(items))


def _ends(offsets: list[tuple[int, int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(offsets), np.int64, 2 * len(offsets))[1::2]


def blocks(items: Sequence, size: int) -> Iterator[Sequence]:
    return (items[k : k + size] for k in range(0, len(items), size))


def _byte_ends(chunks: list[str]) -> np.ndarray:
    return np.cumsum(_sizes(chunks if all(map(str.isascii, chunks)) else [c.encode() for c in chunks]))


def _byte_letters() -> dict[str, int]:
    """The letter by which byte-level vocabularies write each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class SideA:
    """The byte-level tokenizer: ids, coarse ends in characters, bytes of every id."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters, vocabulary = _byte_letters(), self.tokenizer.get_vocab()
        entries = [b""] * (max(vocabulary.values()) + 1)
        for entry, number in vocabulary.items():
            entries[number] = bytes(letters[x] for x in entry) if all(x in letters for x in entry) else entry.encode()
        self.table = _byte_table(entries)
        self.words = splitter(pattern)

    def encode(self, words: list[str]) -> Encoded:
        """``LINE`` words a call, as words that are already cut: the library gives ends within each."""
        known: dict[str, int] = defaultdict(count().__next__)
        rows = np.fromiter(map(known.__getitem__, words), np.int64, len(words))  # marks and endings are words of many chunks
        distinct, flat, last, counts = list(known), [], [], []
        for own in blocks(distinct, LINE):
            made = self.tokenizer.encode(own, is_pretokenized=True, add_special_tokens=False)
            flat.append(np.array(made.ids, np.int64)), last.append(_ends(made.offsets))
            counts.append(np.bincount(np.array(made.word_ids, np.int64), minlength=len(own)))
        ids, ends, counts = map(np.concatenate, (flat, last, counts))
        sizes = counts[rows]
        place = np.arange(sizes.sum()) + np.repeat((np.cumsum(counts) - counts)[rows] - np.cumsum(sizes) + sizes, sizes)
        return ids[place], ends[place], sizes, _sizes(distinct)[rows]


class SideB:
    """The sentencepiece tokenizer: ids, coarse ends in bytes, bytes of every id."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = []
        for number in range(model.get_piece_size()):
            piece = model.id_to_piece(number)
            if re.search("[^▁]▁", piece) and not (model.is_control(number) or model.is_unknown(number)):
                raise ValueError(f"piece {number} runs across the start of a word")
            entries.append(bytes([int(piece[3:5], 16)]) if model.is_byte(number) else piece.replace("▁", " ").encode())
        self.table, self.space = _byte_table(entries), model.piece_to_id("▁")
        trained = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto())
        plain = not (trained.normalizer_spec.precompiled_charsmap or trained.normalizer_spec.remove_extra_whitespaces)
        self.joins = plain and trained.trainer_spec.model_type == trained.trainer_spec.BPE

    def encode(self, words: list[str]) -> Encoded:
        """Of words that start with a space, which the model adds to what it is given.

        ``LINE`` words are handed over in a line where the model treats them alike there: merges of pairs in a
        fixed order, on texts as they stand, of which none crosses the start of a word. A word of nothing but
        spaces, or with the letter that stands for them, goes alone.
        """
        alone = [n for n, w in enumerate(words) if not self.joins or w[-1] == " " or "\u2581" in w]
        apart = set(alone)
        others = [n for n in range(len(words)) if n not in apart] if alone else range(len(words))
        order = np.array([*others, *alone], np.int64)
        flat, last, counts, lengths = [], [], [], []
        for numbers in chain(blocks(others, LINE), blocks(alone, 1)):
            own = [words[n] for n in numbers]
            line = "".join(own)
            spans = _sizes(own) if line.isascii() else _sizes([w.encode() for w in own])
            if line == " ":
                ids, ends = [self.space], np.array([1])
            else:
                made = self.model.encode(line[1:], return_type="offset_mapping", return_bytes=True, num_threads=1)
                ids, ends = made["ids"], _ends(made["offsets"]) + 1
            bounds = np.cumsum(spans)
            place = np.searchsorted(bounds, ends)
            flat.append(np.array(ids, np.int64)), last.append(ends - (bounds - spans)[place])
            counts.append(np.bincount(place, minlength=len(own))), lengths.append(spans)
        ids, ends, sizes, lengths = map(np.concatenate, (flat, last, counts, lengths))
        if alone:  # back into the words' order
            back = np.argsort(np.repeat(order, sizes), kind="stable")
            ids, ends, back = ids[back], ends[back], np.argsort(order)
            sizes, lengths = sizes[back], lengths[back]
        return ids, ends, sizes, lengths

    words = staticmethod(_WORD.findall)


def refined(ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Exact byte ends from coarse ones: a token that does not span as many bytes as it decodes to ends where
    its decoded bytes do, counted from the last token before it whose span fits."""
    starts = np.concatenate([[0], ends[:-1]])
    fits = (ends - starts == sizes) & (ends > starts)
    done = np.cumsum(sizes)
    if fits.all():
        return ends
    fits &= ends == done  # a span that fits by chance inside a cut character must not move the count
    last = np.maximum.accumulate(np.where(fits, np.arange(len(ends)), -1))
    base_end = np.where(last >= 0, ends[last], 0)
    base_done = np.where(last >= 0, done[last], 0)
    return base_end + done - base_done


def decoded(ids: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[bytes, np.ndarray]:
    """The bytes of ``ids`` joined, and how many each has."""
    flat, starts, sizes = table
    own = sizes[ids]
    place = np.arange(own.sum()) + np.repeat(starts[ids] - np.cumsum(own) + own, own)
    return flat[place].tobytes(), own


class Groups:
    """The groups of one text: ids and group numbers of both sides."""

    def __init__(self, a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray):
        self.cuts = cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        self.count, self.a, self.b = len(cuts), a, b
        self.ga, self.gb = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        self.na, self.nb = np.bincount(self.ga, minlength=self.count), np.bincount(self.gb, minlength=self.count)
        self.links = int((self.na * self.nb).sum())

    def line(self, numbers: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3``; ``numbers`` holds the decimal of every id."""
        side = np.concatenate([self.ga * 2, self.gb * 2 + 1])
        order = np.argsort(side, kind="stable")
        side = side[order]
        out = np.empty(2 * len(order), dtype=object)
        out[0::2] = numbers[np.concatenate([self.a, self.b])[order]]
        last = np.append(side[1:] != side[:-1], True)
        out[1::2] = np.array([",", "|", ";"], dtype=object)[np.where(last, 1 + side % 2, 0)]
        return "".join(out[:-1].tolist()).encode()

    def linked(self, width: int, most: int | None = None) -> np.ndarray:
        """The pairs of all groups, or those of at most ``most`` links, one a link, group by group, as ``a * width + b``."""
        first_b = np.cumsum(self.nb) - self.nb
        groups, ids = self.ga, self.a
        if most is not None:
            small = (self.na * self.nb <= most)[groups]
            groups, ids = groups[small], ids[small]
        times = self.nb[groups]
        ahead = np.cumsum(times) - times
        place = np.arange(times.sum()) + np.repeat(first_b[groups] - ahead, times)
        return np.repeat(ids, times) * width + self.b[place]

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs as ``a * width + b``, and the number of links of each."""
        first_b = np.cumsum(self.nb) - self.nb
        wide = self.na * self.nb > WIDE
        found, n = np.unique(self.linked(width, WIDE), return_counts=True)
        if not wide.any():
            return found, n
        keys, counts = [found], [n]
        first_a = np.cumsum(self.na) - self.na
        for g in np.flatnonzero(wide):
            ua, ca = np.unique(self.a[first_a[g] : first_a[g] + self.na[g]], return_counts=True)
            ub, cb = np.unique(self.b[first_b[g] : first_b[g] + self.nb[g]], return_counts=True)
            keys.append((ua[:, None] * width + ub[None, :]).ravel())
            counts.append((ca[:, None] * cb[None, :]).ravel())
        found, place = np.unique(np.concatenate(keys), return_inverse=True)
        return found, np.bincount(place, weights=np.concatenate(counts)).astype(np.int64)


class Aligner:
    """Both tokenizers of a task, and the groups of texts.

    Texts are cut into chunks at whose ends tokens of both sides end; what a chunk adds to its text is found once
    while at most ``most`` pairs are remembered. A text with a chunk that can't be told apart is taken whole.
    """

    def __init__(self, a_path: str, b_path: str, pattern: str, most: int = 1_500_000):
        self.a, self.b = SideA(a_path, pattern), SideB(b_path)
        self.width = len(self.b.table[2])
        self.numbers = np.array([str(n) for n in range(max(len(self.a.table[2]), self.width))], dtype=object)
        self.most = most
        self._reset()

    def groups(self, chunks: list[str]) -> Groups | None:
        """The groups of the chunks as one text, None if a side does not give its bytes back or has no end between two chunks."""
        text = "".join(chunks)
        target, found = text.encode(), []
        for side in (self.a, self.b):
            ids, ends, sizes, lengths = side.encode([w for c in chunks for w in side.words(c)])
            coarse = ends + np.repeat(np.cumsum(lengths) - lengths, sizes)
            if side is self.a and len(target) != len(text):  # characters to bytes
                lead = (np.frombuffer(target, dtype=np.uint8) & 0xC0) != 0x80
                coarse = np.append(np.flatnonzero(lead), len(target))[coarse]
            joined, sizes = decoded(ids, side.table)
            if joined != target:
                return None
            found += [ids, refined(coarse, sizes)]
        made = Groups(*found)
        return made if len(chunks) == 1 or np.isin(_byte_ends(chunks), made.cuts, assume_unique=True).all() else None

    def _reset(self) -> None:
        self.index: dict[str, int] = defaultdict(count().__next__)  # an unknown chunk gets the next number
        self.lines: list[str | None] = []
        self.told, self.pairs = np.zeros((0, 5), np.int64), np.zeros(0, np.int64)

    def _learn(self, chunks: list[str]) -> None:
        """Note of each chunk its line, the numbers of A, B, groups and links, where its pairs start, and its pairs, repeats included.

        A chunk that can't be told apart from its text, or holds a wide group, has no line.
        """
        made = None if len(chunks) == 1 and "\u2581" in chunks[0] else self.groups(chunks)
        if len(chunks) > 1 and made is None:
            half = len(chunks) // 2
            self._learn(chunks[:half]), self._learn(chunks[half:])
            return
        if made is None or made.links and int((made.na * made.nb).max()) > WIDE:
            if len(chunks) > 1:
                half = len(chunks) // 2
                self._learn(chunks[:half]), self._learn(chunks[half:])
                return
            self.lines.append(None)
            self.told = np.concatenate([self.told, [[0, 0, 0, 0, len(self.pairs)]]])
            return
        edges = np.concatenate([[0], np.searchsorted(made.cuts, _byte_ends(chunks)) + 1])
        each = made.line(self.numbers).decode().split(";")
        self.lines += [";".join(each[s:e]) for s, e in zip(edges[:-1].tolist(), edges[1:].tolist())]
        links = np.concatenate([[0], np.cumsum(made.na * made.nb)])
        told = [np.add.reduceat(n, edges[:-1]) for n in (made.na, made.nb, np.ones(made.count, np.int64))]
        self.told = np.concatenate([self.told, np.column_stack([*told, np.diff(links[edges]), len(self.pairs) + links[edges[:-1]]])])
        self.pairs = np.concatenate([self.pairs, made.linked(self.width)])

    def rows(self, texts: list[str]) -> Iterator[tuple[tuple[int, ...], bytes | None, np.ndarray, np.ndarray]]:
        """Of each text its numbers of A, B, groups and links, its line (None without tokens), its distinct pairs and their links."""
        if len(self.pairs) > self.most:
            self._reset()
        cut = [_CUT.split(t) if t else [] for t in texts]
        sizes = _sizes(cut)
        numbers = np.fromiter(map(self.index.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        fresh = len(self.index) - len(self.lines)
        if fresh:
            new = [" " + c for c in islice(reversed(self.index), fresh)][::-1]
            for own in blocks(new, LEARN):
                self._learn(own)
        for end, size, text in zip(np.cumsum(sizes).tolist(), sizes.tolist(), texts):
            own = numbers[end - size : end]
            lines = [self.lines[n] for n in own.tolist()]
            if None in lines or not lines:
                g = self.groups([" " + text]) if text else None
                if g is None:
                    yield (0, 0, 0, 0), None, np.zeros(0, np.int64), np.zeros(0, np.int64)
                else:
                    yield (len(g.a), len(g.b), g.count, g.links), g.line(self.numbers), *g.pairs(self.width)
                continue
            told = self.told[own]
            links = told[:, 3]
            ahead = np.cumsum(links) - links
            place = np.arange(links.sum()) + np.repeat(told[:, 4] - ahead, links)
            yield tuple(told[:, :4].sum(axis=0).tolist()), ";".join(lines).encode(), *np.unique(self.pairs[place], return_counts=True)


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str, pattern: str) -> Aligner:
    return Aligner(a_path, b_path, pattern)


def link_rows(docs: DataFrame, a_path: str, b_path: str, pattern: str, id_col: str, text_col: str) -> DataFrame:
    """Per row its numbers, digest, and distinct linked pairs (``a * width of B + b``) with their links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for s, e in text_slices(texts):
                numbers, digests, keys, counts = [], [], [], []
                for told, line, pair, n in own.rows(texts[s:e]):
                    numbers.append(told), digests.append("" if line is None else sha256_hex(line))
                    keys.append(pair), counts.append(n)
                ends = pa.array(np.cumsum([0, *map(len, keys)]), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x), pa.int64())) for x in (keys, counts)]
                columns = [pa.array(x, pa.int64()) for x in zip(*numbers)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s, e - s), *columns, pa.array(digests, pa.string()), *lists],
                    [id_col, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"],
                )

    bounded_batches(docs.sparkSession)  # a batch's texts are Python strings all at once
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, links array<long>"
    return docs.select(id_col, text_or_empty(text_col).alias("__text")).mapInArrow(run, schema)


def pair_counts(linked: DataFrame, width: int) -> DataFrame:
    """``pair``, ``n`` (rows that hold it) and ``best`` (no pair of its A id has more)."""
    counts = written(linked.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")))
    of_a = F.expr(f"pair div {width}L")
    most = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("most"))  # one row per A id: bounded by its vocabulary
    judged = counts.withColumn("a", of_a).join(F.broadcast(most), "a")
    return judged.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(
    docs: DataFrame, a_path: str, b_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY
) -> DataFrame:
    """Per row ``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``."""
    made = link_rows(docs, a_path, b_path, pattern, id_col, text_col)
    linked = written(made.withColumn("row", F.monotonically_increasing_id()))
    counts = written(pair_counts(linked, aligner(a_path, b_path, pattern).width))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t")).first()["t"]
    is_heavy = F.col("n").cast("decimal(38,0)") * heavy >= F.lit(total)
    top = counts.filter(is_heavy).toArrow()  # at most ``heavy`` rows: each holds 1 / ``heavy`` of all entries
    order = np.argsort(top.column("pair").to_numpy())
    shared = docs.sparkSession.sparkContext.broadcast(
        tuple(top.column(c).to_numpy()[order].astype(np.int64) for c in ("pair", "n", "best"))
    )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums over a row's heavy pairs, and what is left to join."""
        pair, n, best = shared.value
        for batch in batches:
            lists = [batch.column(batch.schema.get_field_index(c)) for c in ("pairs", "links")]
            keys, links = (x.flatten().to_numpy() for x in lists)
            rows = np.repeat(np.arange(batch.num_rows), lists[0].value_lengths().to_numpy())
            at = np.minimum(np.searchsorted(pair, keys), max(len(pair) - 1, 0))
            hit = pair[at] == keys if len(pair) else np.zeros(len(keys), bool)
            at, own, row = at[hit], links[hit], rows[hit]
            sums = []
            for values in (n, best):
                out = np.zeros(batch.num_rows, np.int64)
                np.add.at(out, row, own * values[at])
                sums.append(pa.array(out))
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows[~hit], minlength=batch.num_rows))]), pa.int32())
            rest = [pa.ListArray.from_arrays(ends, pa.array(x[~hit], pa.int64())) for x in (keys, links)]
            kept = [batch.column(k) for k in range(batch.num_columns - 2)]
            yield pa.RecordBatch.from_arrays([*kept, *sums, *rest], [*batch.schema.names[:-2], "heavy_sum", "heavy_best", "pairs", "links"])

    kind = docs.schema[id_col].dataType.simpleString()
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    schema = (
        f"row long, `{id_col}` {kind}, {', '.join(f'{c} long' for c in numbers)}, groups_sha256 string, "
        "heavy_sum long, heavy_best long, pairs array<long>, links array<long>"
    )
    ready = written(linked.select("row", id_col, *numbers, "groups_sha256", "pairs", "links").mapInArrow(look_up, schema))
    light = ready.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("p")).select("row", "p.pairs", "p.links")
    joined = light.join(counts.filter(~is_heavy).withColumnRenamed("pair", "pairs"), "pairs")
    sums = joined.groupBy("row").agg(
        F.sum(F.col("links") * F.col("n")).alias("light_sum"), F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("light_best")
    )
    plus = lambda kind: (F.col(f"heavy_{kind}") + F.coalesce(F.col(f"light_{kind}"), F.lit(0)))
    return ready.join(sums, "row", "left").select(
        id_col, *numbers, plus("best").alias("n_best"), plus("sum").alias("count_sum"), "groups_sha256"
    )
