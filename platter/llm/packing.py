"""Best-fit packing by a configuration linear program over the length histogram.

Documents become token pieces of at most ``capacity`` tokens. Only the histogram of piece lengths
(at most ``capacity`` numbers) reaches the driver, where the packing is planned: the covering program
"fewest sequences so that every length is covered as often as it occurs", one variable for each way
to fill a sequence, is solved by multiplicative weights. Each round prices all lengths that are still short by their
weights, finds the best configurations by a knapsack dynamic program over the capacity, and lowers
the weights of the lengths that they cover. The same weights solve the dual program and bound the optimum
from below. The fractional solution is rounded, what remains is solved again, and the rounding rest goes
by best fit, still as counts per length.

The plan is a table of runs ("these pieces of length L, by rank, go to these sequences at this
offset"), whose size depends on the number of lengths, not on the documents. Ranks come from
counters kept while tokenizing (per partition and length, frozen by a checkpoint) plus grouped
offsets, so no length, however frequent, meets in one task.

Edge cases: a null or empty text is one piece, the end id alone; repeated rows and null ids are
packed like others; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from platter.llm.bpe import WordMemory, batched_ids, splitter, text_slices
from platter.llm.common import reliable, text_or_empty

#: Weights start at this power of the length, which saves the short pieces for the gaps beside long ones.
TILT = 1.5
#: How fast a weight falls with the share covered, and the share of its demand that a length may gain in a round.
RATE, STEP = 6.0, 1.0
#: Shares of the tokens that rounding leaves to best fit.
REST = (0.05, 0.1, 0.2)
PIECES = "piece int, start long, length long, ids_crc32 long"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    # A task has one core; the library's own threads would only share it.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


class TextTokenizer:
    """Ids of whole texts as the tokenizer file gives them; words are encoded once per task.

    A byte-level tokenizer encodes every word of the split on its own, so equal words have equal ids.
    A text that holds the string of a special token is given to the tokenizer whole.
    """

    def __init__(self, path: str, pattern: str):
        self.tokenizer = _tokenizer(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = splitter(pattern)
        self.memory = WordMemory(self._words)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = [m.ids for m in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, made), dtype=np.int64, count=len(made))
        return np.fromiter(chain.from_iterable(made), dtype=np.int32, count=int(sizes.sum())), sizes

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        plain = [t if not any(s in t for s in self.special) else "" for t in texts]
        flat, ends = batched_ids(plain, self.split, self.memory)
        out = np.split(flat, ends[:-1]) if len(ends) else []
        for n, (text, own) in enumerate(zip(texts, plain)):
            if text and not own:
                out[n] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.int32)
        return out


def cut(ids: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: whole if it fits, else a shorter first piece and full ones."""
    if len(ids) <= capacity:
        return [(0, len(ids))]
    first = len(ids) % capacity
    return ([(0, first)] if first else []) + [(s, capacity) for s in range(first, len(ids), capacity)]


def pieces(docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int, id_col: str, text_col: str, end_id: int = 0) -> DataFrame:
    """The pieces of every row with the partition they were made in and their rank there among equals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = TextTokenizer(tokenizer_path, pattern)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in text_slices(texts):
                row, number, start, length, crc, rank = [], [], [], [], [], []
                for n, body in enumerate(tokenizer.ids(texts[a:b]), a):
                    ids = np.append(body, end_id).astype("<u4")
                    for k, (s, size) in enumerate(cut(ids, capacity)):
                        row.append(n), number.append(k), start.append(s), length.append(size)
                        crc.append(zlib.crc32(ids[s : s + size].tobytes()))
                        rank.append(seen[size])
                        seen[size] += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row, pa.int64())),
                        pa.array(number, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                        pa.array([part] * len(row), pa.int32()),
                        pa.array(rank, pa.int64()),
                    ],
                    [id_col, "piece", "start", "length", "ids_crc32", "part", "part_rank"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_or_empty(text_col).alias("__text")).mapInArrow(
        run, f"`{id_col}` {kind}, {PIECES}, part int, part_rank long"
    )


class Knapsack:
    """Best fillings of every capacity by bounded copies of some lengths, for given prices.

    ``best[c]`` is the greatest price of pieces that add up to exactly ``c`` tokens (minus infinity
    where none do). Copies are bounded by binary splitting, so each length costs a few vector steps.
    """

    def __init__(self, price: np.ndarray, lengths: np.ndarray, limit: np.ndarray, capacity: int):
        self.best = np.full(capacity + 1, -np.inf)
        self.best[0] = 0.0
        self.steps: list[tuple[int, int]] = []  # (index of the length, copies)
        taken = []
        for k, size in enumerate(lengths.tolist()):
            room, copies = min(int(limit[k]), capacity // size), 1
            while room > 0:
                n = min(copies, room)
                room, copies = room - n, copies * 2
                gain = self.best[: capacity + 1 - n * size] + n * price[k]
                better = np.zeros(capacity + 1, dtype=bool)
                better[n * size :] = gain > self.best[n * size :]
                self.best[n * size :] = np.maximum(self.best[n * size :], gain)
                self.steps.append((k, n))
                taken.append(better)
        self.lengths, self.limit, self.taken = lengths, limit, taken
        filled = np.where(np.isfinite(self.best), np.arange(capacity + 1), 0)
        self.fullest = np.maximum.accumulate(filled)

    def fillings(self, totals: np.ndarray) -> np.ndarray:
        """Copies ``[totals, lengths]`` of the best fillings of reachable ``totals``, traced back together."""
        left, out = totals.copy(), np.zeros((len(totals), len(self.lengths)), dtype=np.int64)
        for (k, n), better in zip(reversed(self.steps), reversed(self.taken)):
            used = better[left]
            out[used, k] += n
            left = left - used * (n * self.lengths[k])
        return out


def columns_of(table: Knapsack, price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Configurations ``[columns, lengths]``, those of the dearest lengths (a token) first, and those that had to
    leave out a copy because their own length is limited.

    One dynamic program prices them all: for every length, the dearest of the fullest configurations
    that hold it.
    """
    order = np.lexsort((-table.lengths, -price / table.lengths))
    found = table.fillings(table.fullest[capacity - table.lengths[order]])
    found[np.arange(len(order)), order] += 1
    fits = (found <= table.limit).all(axis=1)
    return found[fits], np.minimum(found[~fits], table.limit.astype(np.int64))


def fractional(
    lengths: np.ndarray, demand: np.ndarray, capacity: int, rate: float = RATE, step: float = STEP
) -> tuple[list[tuple[tuple[tuple[int, int], ...], float]], float]:
    """Multiplicative weights for the covering program: configurations with their (fractional) amounts, which cover
    all demand, and the best lower bound on any solution.

    A length's weight falls with the share of its demand that is covered, so all shares rise together.
    Each round prices every length that is still short, with one dynamic program, and uses its
    configurations until no length gains more than ``step`` of its demand, nor more than it lacks:
    nothing is covered twice, and what a solution wastes is the room in its configurations. Weights
    over the dearest configuration's price are a solution of the dual program, so each round in which all
    lengths are short bounds the optimum from below; so do the prices "length / capacity".
    """
    covered, bound = np.zeros(len(lengths)), float((lengths * demand).sum()) / capacity
    used: dict[tuple[tuple[int, int], ...], float] = {}
    while True:
        lack = demand - covered
        short = np.flatnonzero(lack > 1e-4 * demand)
        if not len(short):
            return list(used.items()), bound
        share = covered[short] / demand[short]
        weights = lengths[short] ** TILT * np.exp(-rate * (share - share.min()))
        table = Knapsack(weights, lengths[short], np.ceil(demand[short]), capacity)
        if len(short) == len(lengths):
            bound = max(bound, float((weights * demand).sum() / table.best.max()))
        allowed, before = np.minimum(step * demand[short], lack[short]), covered.sum()
        for columns in columns_of(table, weights, capacity):
            if covered.sum() - before > 0.01 * lack.sum():
                break  # configurations with room to spare only where the others get nowhere
            for column in columns:
                at = np.flatnonzero(column)
                times = float((allowed[at] / column[at]).min())
                if times > 1e-9 * demand[short[at]].max():
                    allowed[at] -= times * column[at]
                    key = tuple((int(lengths[short[k]]), int(column[k])) for k in at)
                    used[key] = used.get(key, 0.0) + times
                    covered[short[at]] += times * column[at]


def plan(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, int, dict[str, float]]:
    """Runs ``(length, first rank, end rank, first sequence, copies in a sequence, offset)``, the number of sequences,
    and figures: the program's ``value`` and ``bound``, and the pieces left to best fit (``rest``).

    The program is solved and rounded with each share of ``REST`` left to best fit, until no packing
    could need fewer sequences; the fewest count, and of equals the smallest share.
    """
    full = {size: count for size, count in histogram.items() if count > 0}
    solved = _program({size: count for size, count in full.items() if size < capacity}, capacity)
    figures = {"value": sum(amount for _, amount in solved[0]), "bound": solved[1]}
    least = -(-sum(size * n for size, n in full.items()) // capacity)
    best: tuple | None = None
    for share in REST:
        found = _rounded(full, capacity, solved[0], share)
        if best is None or found[1] < best[1]:
            best = found
        if best[1] <= least:
            break
    table, sequences, rest = best
    return table, sequences, figures | {"rest": rest}


def _program(left: dict[int, int], capacity: int) -> tuple[list, float]:
    lengths = np.array(sorted(size for size, count in left.items() if count), dtype=np.int64)
    return fractional(lengths, np.array([left[int(size)] for size in lengths], dtype=float), capacity)


def _rounded(histogram: dict[int, int], capacity: int, solved: list, share: float) -> tuple[np.ndarray, int, int]:
    """The runs, the sequences, and the pieces left to best fit.

    The whole parts of the amounts are used, then single uses of configurations while their pieces are
    left, largest pieces and amounts first; of these only configurations no emptier than the program's
    mean. What remains is solved again, until ``share`` of the tokens is left (or a pass places
    little): that rest still has all kinds of lengths, and best fit packs it with little waste.
    """
    left, found = dict(histogram), list(solved)
    taken: dict[int, int] = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int, int]] = []
    sequences = 0

    def use(config: dict[int, int], times: int) -> None:
        nonlocal sequences
        offset = 0
        for size, copies in sorted(config.items(), reverse=True):
            runs.append((size, taken[size], taken[size] + copies * times, sequences, copies, offset))
            taken[size] += copies * times
            left[size] -= copies * times
            offset += size * copies
        sequences += times

    if left.get(capacity):
        use({capacity: 1}, left[capacity])
    tokens = sum(size * n for size, n in left.items())
    stop = share * tokens
    while tokens > stop:
        before = tokens
        fill = {key: sum(size * n for size, n in key) for key, _ in found}
        mean = int(sum(fill[key] * amount for key, amount in found) / max(sum(amount for _, amount in found), 1e-9))
        found.sort(key=lambda c: (-c[0][-1][0], -c[1], c[0]))
        for single in (False, True):
            for key, amount in found:
                times = min([1 if single else int(amount), *(left[size] // n for size, n in key)])
                if times > 0 and tokens > stop and (not single or fill[key] >= mean):
                    use(dict(key), times)
                    tokens -= times * fill[key]
        if before - tokens < before / 20:
            break
        if tokens > stop:
            found, _ = _program(left, capacity)
    rest = sum(left.values())
    for config, times in best_fit(left, capacity):
        use(config, times)
    table = np.array(runs, dtype=np.int64).reshape(-1, 6)
    return table[np.lexsort((table[:, 1], table[:, 0]))], sequences, rest


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best fit decreasing on counts: configurations and how often each is used.

    Pieces of a length fill the sequences with the least room for them, as many each as fit; sequences
    filled alike are one group, so the work depends on the number of lengths and not of pieces.
    """
    room: dict[int, list[tuple[dict[int, int], int]]] = {}
    spaces: list[int] = []  # those of ``room`` in order
    def put(space: int, config: dict[int, int], times: int) -> None:
        if times:
            if space not in room:
                room[space] = []
                insort(spaces, space)
            room[space].append((config, times))

    for size in sorted(histogram, reverse=True):
        n = histogram[size]
        while n:
            at = bisect_left(spaces, size)
            fresh = at == len(spaces)
            space = capacity if fresh else spaces[at]
            config, times = ({}, n) if fresh else room[space].pop()
            if not fresh and not room[space]:
                del room[space], spaces[at]
            most = space // size
            filled, some = min(n // most, times), 0
            put(space - most * size, config | {size: most}, filled)
            n -= filled * most
            if filled < times and 0 < n < most:
                put(space - n * size, config | {size: n}, 1)
                n, some = 0, 1
            if not fresh:
                put(space, config, times - filled - some)
    return [group for space in spaces for group in room[space]]


def pack(
    docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: ``id_col``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``."""
    made = reliable(pieces(docs, tokenizer_path, pattern, capacity, id_col, text_col))
    counts = made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = reliable(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    histogram = {r["length"]: r["n"] for r in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    runs, _, _ = plan(histogram, capacity)
    shared = docs.sparkSession.sparkContext.broadcast(runs)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        big = int(table[:, 2].max()) + 1 if len(table) else 1
        edge = table[:, 0] * big + table[:, 1]
        for batch in batches:
            size = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("__rank")).to_numpy()
            run = table[np.searchsorted(edge, size * big + rank, side="right") - 1]
            nth = rank - run[:, 1]
            keep = [batch.column(k) for k in range(5)]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(run[:, 3] + nth // run[:, 4]), pa.array(run[:, 5] + nth % run[:, 4] * size)],
                [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    ranked = made.join(offsets.select("part", "length", "before"), ["part", "length"]).select(
        id_col, "piece", "start", "length", "ids_crc32", (F.col("part_rank") + F.col("before")).alias("__rank")
    )
    return ranked.mapInArrow(place, f"`{id_col}` {kind}, {PIECES}, sequence_id long, offset long")
