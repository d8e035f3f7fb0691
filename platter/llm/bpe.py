"""Byte-level BPE encoding and decoding on padded numpy matrices.

Texts are split into words by the public pattern. New words are put into matrices of similar length,
one word a row, padded on the right; in each round every row merges its leftmost pair of minimum
rank, the pair's rank being looked up in an open-addressing hash table of all mergeable pairs, and
the row is compacted. Rows without a mergeable pair leave the matrix. Words already met by a task are
taken from a bounded memory. Decoding gathers the ids' bytes from one flat array.

A word longer than ``LONGEST_ROW`` bytes would make a matrix of as many rounds as bytes, each of that
width; it is merged with a heap instead, in the same order (leftmost minimum first).
"""

from __future__ import annotations

import base64
import heapq
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import count, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from platter.llm.common import sha256_hex, text_or_empty

LONGEST_ROW = 512
NO_RANK = np.int32(2**31 - 1)

_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACES = " \t-\r\x85\xa0"
#: The public pattern with its classes spelled out for the code points that ``_OTHER`` doesn't find.
_PLAIN = re.compile(
    f"[{_LETTERS}]+| [{_LETTERS}]+| ?[{_NUMBERS}]+|'s|'t|'re|'ve|'m|'ll|'d"
    f"| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)
_OTHER = re.compile("[^\x00-ɏ‐-‧€]")


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Cut a text into words by ``pattern``; a plain equivalent serves texts of Latin letters only."""
    import public_tokenizers

    full = regex.compile(pattern)
    if pattern != public_tokenizers.PATTERN:
        return full.findall
    return lambda text: full.findall(text) if _OTHER.search(text) else _PLAIN.findall(text)


class PairTable:
    """Rank of a pair of ids: open addressing with linear probing over ``left << 16 | right``."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, rank = [], [], []
        for token, value in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(value)
        if ranks and max(ranks.values()) >= 1 << 16:
            raise ValueError("ids must fit in 16 bits")
        keys = self._key(np.array(left, dtype=np.int64), np.array(right, dtype=np.int64))
        self.bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 4))))
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << self.bits, NO_RANK, dtype=np.int32)
        open_keys, open_ranks, slots = keys, np.array(rank, dtype=np.int32), self._slot(keys)
        self.probes = 0
        while len(open_keys):
            self.probes += 1
            free = self.keys[slots] < 0
            _, first = np.unique(slots[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.keys[slots[won]], self.ranks[slots[won]] = open_keys[won], open_ranks[won]
            lost = np.ones(len(open_keys), dtype=bool)
            lost[won] = False
            open_keys, open_ranks = open_keys[lost], open_ranks[lost]
            slots = (slots[lost] + 1) & ((1 << self.bits) - 1)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 16) | right

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; ``NO_RANK`` where a pair doesn't merge or a side is padding (-1)."""
        shape = left.shape
        keys = self._key(left.ravel(), right.ravel())
        out = np.full(len(keys), NO_RANK, dtype=np.int32)
        at = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slots = self._slot(keys[at])
        for _ in range(self.probes):
            if not len(at):
                break
            there = self.keys[slots]
            hit = there == keys[at]
            out[at[hit]] = self.ranks[slots[hit]]
            on = ~hit & (there >= 0)
            at, slots = at[on], (slots[on] + 1) & ((1 << self.bits) - 1)
        return out.reshape(shape)


class ByteCodec:
    """Encodes words by merge ranks (id = rank) and decodes ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.pairs = PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each word. A word that is itself in the vocabulary is one id, without merging."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        out: list[np.ndarray | None] = [None] * len(raw)
        by_width: dict[int, list[int]] = {}
        for n, word in enumerate(raw):
            whole = self.ranks.get(word)
            if whole is not None:
                out[n] = np.array([whole], dtype=np.int32)
            elif len(word) > LONGEST_ROW:
                out[n] = self._merge_long(word)
            else:
                by_width.setdefault(max(4, 1 << (len(word) - 1).bit_length()), []).append(n)
        for width, members in by_width.items():
            step = max(1, (1 << 17) // width)
            for k in range(0, len(members), step):
                part = members[k : k + step]
                for n, ids in zip(part, self._merge_matrix([raw[n] for n in part], width)):
                    out[n] = ids
        return out

    def encode_flat(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after another, and the number of ids of each word."""
        made = self.encode_words(words)
        return np.concatenate(made) if made else np.zeros(0, np.int32), np.array([len(m) for m in made], dtype=np.int64)

    def _merge_matrix(self, words: list[bytes], width: int) -> list[np.ndarray]:
        padded = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(-1, width)
        sizes = np.array([len(w) for w in words])
        ids = np.where(np.arange(width) < sizes[:, None], self.byte_ids[padded], np.int32(-1))
        ranks = self.pairs.lookup(ids[:, :-1], ids[:, 1:])
        done: list[np.ndarray | None] = [None] * len(words)
        rows = np.arange(len(words))
        while len(rows):
            at = ranks.argmin(axis=1)  # the first of equal minima: the leftmost
            best = ranks[np.arange(len(rows)), at]
            over = best == NO_RANK
            if over.any():
                for n, row in zip(rows[over], ids[over]):
                    done[n] = row[row >= 0]
                on = ~over
                rows, ids, ranks, at, best = rows[on], ids[on], ranks[on], at[on], best[on]
                if not len(rows):
                    break
                used = int((ids >= 0).sum(axis=1).max())
                ids, ranks = ids[:, :used], ranks[:, : used - 1]
            line = np.arange(len(rows))
            column = np.arange(ids.shape[1] - 1)
            shifted = np.where(column[None, :] > at[:, None], ids[:, 1:], ids[:, :-1])
            shifted[line, at] = best
            if ranks.shape[1] == 1:
                ids, ranks = shifted, np.full((len(rows), 1), NO_RANK, dtype=np.int32)
                continue
            moved = np.where(column[None, :-1] >= at[:, None], ranks[:, 1:], ranks[:, :-1])
            before = at > 0
            moved[line[before], at[before] - 1] = self.pairs.lookup(shifted[line[before], at[before] - 1], best[before])
            after = at < shifted.shape[1] - 1
            moved[line[after], at[after]] = self.pairs.lookup(best[after], shifted[line[after], at[after] + 1])
            ids, ranks = shifted, moved
        return done

    def _merge_long(self, word: bytes) -> np.ndarray:
        ids = self.byte_ids[np.frombuffer(word, dtype=np.uint8)].tolist()
        count = len(ids)
        following, previous = list(range(1, count + 1)), list(range(-1, count - 1))
        array = np.array(ids)
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(self.pairs.lookup(array[:-1], array[1:]).tolist()) if r != NO_RANK]
        heapq.heapify(heap)
        tokens, ranks = self.bytes, self.ranks

        def text(i: int) -> bytes:
            s = self.starts[ids[i]]
            return tokens[s : s + self.lengths[ids[i]]].tobytes()

        def push(i: int, j: int) -> None:
            rank = ranks.get(text(i) + text(j))
            if rank is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = following[i]
            if ids[i] != a or j >= count or ids[j] != b:
                continue  # a side has merged since
            ids[i], ids[j] = rank, -1
            following[i] = following[j]
            if following[j] < count:
                previous[following[j]] = i
                push(i, following[j])
            if previous[i] >= 0:
                push(previous[i], i)
        return np.array([x for x in ids if x >= 0], dtype=np.int32)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes of ``ids`` one after another, and the number of bytes of each id."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - ends + sizes, sizes)
        return self.bytes[place], sizes


class WordMemory:
    """Encodes lists of words through a bounded memory of words met before.

    ``encode`` gives the ids of a list of words one after another, and the number of ids of each word.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = 1_000_000):
        self.encode, self.most = encode, most
        self._reset()

    def _reset(self) -> None:
        # A word that isn't known yet gets the next number by being looked up.
        self.index: dict[str, int] = defaultdict(count().__next__)
        self.flat, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``words`` one after another, and the number of ids of each word."""
        if len(self.index) > self.most:
            self._reset()
        rows = np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words))
        fresh = len(self.index) - len(self.starts)
        if fresh:
            made, sizes = self.encode(list(islice(reversed(self.index), fresh))[::-1])
            starts = len(self.flat) + np.cumsum(sizes) - sizes
            self.flat = np.concatenate([self.flat, made]).astype(np.int32, copy=False)
            self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[rows] - ends + sizes, sizes)
        return self.flat[place], sizes


def batched_ids(texts: list[str], split: Callable[[str], list[str]], memory: WordMemory) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts one after another, and the place where each text's ids end."""
    words: list[str] = []
    ends = []
    for text in texts:
        words += split(text)
        ends.append(len(words))
    ids, sizes = memory.ids(words)
    return ids, np.concatenate([[0], np.cumsum(sizes)])[ends]


def text_slices(texts: list[str], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Cut a batch into runs of whole texts of about ``most`` characters, to bound memory."""
    start, total = 0, 0
    for n, text in enumerate(texts):
        total += len(text)
        if total >= most:
            yield start, n + 1
            start, total = n + 1, 0
    if start < len(texts):
        yield start, len(texts)


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@lru_cache(maxsize=2)
def codec(path: str) -> ByteCodec:
    return ByteCodec(read_ranks(path))


def encode_decode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Per row: ``id_col``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked for, ``ids``.

    ``ranks_path`` names a rank file that every executor has. A null text is empty: no tokens and the
    digests of nothing. Null ids and repeated rows are kept as they are; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path)
        split, memory = splitter(pattern), WordMemory(own.encode_flat)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in text_slices(texts):
                ids, ends = batched_ids(texts[a:b], split, memory)
                raw, sizes = own.decode(ids)
                byte_ends = np.concatenate([[0], np.cumsum(sizes)])[ends]
                starts, byte_starts = np.concatenate([[0], ends[:-1]]), np.concatenate([[0], byte_ends[:-1]])
                wide = ids.astype("<u4")
                columns = [
                    batch.column(0).slice(a, b - a),
                    pa.array(ends - starts, pa.int64()),
                    pa.array([sha256_hex(wide[s:e].tobytes()) for s, e in zip(starts, ends)], pa.string()),
                    pa.array([sha256_hex(raw[s:e].tobytes()) for s, e in zip(byte_starts, byte_ends)], pa.string()),
                ]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.array([ids[s:e] for s, e in zip(starts, ends)], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(id_col, text_or_empty(text_col).alias("__text")).mapInArrow(run, schema)
