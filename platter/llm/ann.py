"""Approximate nearest neighbours with a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample (at most ``SAMPLE`` vectors, and ``SAMPLE_NUMBERS`` numbers), so it
has at most ``SAMPLE / 16`` leaves; every vector is assigned to a leaf. A query walks the tree through a
priority queue: the nearest node so far is opened, its children queued by the distance of their
centres, and a leaf is visited when it comes to the front. How many leaves a query visits is
calibrated: at most ``PROBES`` sample vectors are compared with all rows, and the visits widen until the share
``recall`` of their true neighbours lies in the leaves visited. A query also goes on until its leaves hold
more than ``k`` vectors. Where leaves tell little, the calibrated visits include all of them, and the
search is exact.

The work is dealt by leaf. Leaves beyond ``BLOCK`` vectors, and those that more than ``BLOCK`` queries
visit, are cut on either side, so an item compares at most about ``BLOCK`` vectors with as many queries,
in double precision on the original vectors; a task keeps the ``k + 1`` nearest of each query over its items and
yields them at its end, or once it holds ``HELD`` queries.

Equal vectors are one query and one candidate with its ``k + 1`` smallest ids, so groups of copies cost
nothing; no query can need more of them. Edge cases: vectors null, empty, zero or with null or
non-finite components take no part, nor do those of another length than the most common one (the
shortest of several); rows alike in id and vector are one row, rows alike in id alone are two; null ids
take no part; ties go to the smaller id; an empty table gives an empty result; distances beyond the
double range are infinite; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platter.llm.common import complete_groups, group_edges, hash_sample, written

SAMPLE, SAMPLE_NUMBERS = 131_072, 1 << 24
BLOCK = 4096
PROBES = 256
#: Queries whose nearest a task keeps before it hands them on.
HELD = 20_000
BRANCHES = 16


class Tree:
    """Centres of all nodes and, for each, its children (a range of nodes) or the number of its leaf."""

    def __init__(self, centres: np.ndarray, first: np.ndarray, count: np.ndarray, leaf: np.ndarray):
        self.centres, self.first, self.count, self.leaf = centres, first, count, leaf
        self.leaves = int((leaf >= 0).sum())

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector, going to the nearest child at every node."""
        at = np.zeros(len(vectors), dtype=np.int64)
        while True:
            inner = np.flatnonzero(self.leaf[at] < 0)
            if not len(inner):
                return self.leaf[at]
            for node in np.unique(at[inner]):
                rows = inner[at[inner] == node]
                a, n = self.first[node], self.count[node]
                at[rows] = a + _nearest(vectors[rows], self.centres[a : a + n])

    def order(self, query: np.ndarray) -> Iterator[int]:
        """The leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                yield int(self.leaf[node])
                continue
            a, n = self.first[node], self.count[node]
            for gap, child in zip(np.square(self.centres[a : a + n] - query).sum(axis=1).tolist(), range(a, a + n)):
                heapq.heappush(queue, (gap, child))


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (np.square(centres).sum(axis=1)[None, :] - 2 * vectors @ centres.T).argmin(axis=1)


def _split(vectors: np.ndarray, branches: int, draw: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Lloyd's rounds: centres that hold vectors, and the centre of each vector."""
    centres = vectors[draw.choice(len(vectors), branches, replace=False)]
    for _ in range(rounds):
        near = _nearest(vectors, centres)
        kept, near = np.unique(near, return_inverse=True)
        sums = np.zeros((len(kept), vectors.shape[1]))
        np.add.at(sums, near, vectors)
        centres = sums / np.bincount(near)[:, None]
    return centres, _nearest(vectors, centres)


def fit_tree(sample: np.ndarray, rows: int, leaf_rows: int = 256, least: int = 16, seed: int = 11) -> Tree:
    """A node is split while it stands for more than ``leaf_rows`` of ``rows`` and has ``2 * least`` sample vectors."""
    draw = np.random.default_rng(seed)
    weight = rows / max(len(sample), 1)
    centres, first, count, leaf = [np.zeros(sample.shape[1])], [0], [0], [-1]
    todo = [(0, np.arange(len(sample)))]
    leaves = 0
    for node, own in todo:
        part = sample[own]
        branches = min(BRANCHES, len(own) // least, int(np.ceil(len(own) * weight / leaf_rows)))
        if branches >= 2:
            found, near = _split(part, branches, draw)
            used = np.unique(near)
        if branches < 2 or len(used) < 2:
            leaf[node], leaves = leaves, leaves + 1
            continue
        first[node], count[node] = len(centres), len(used)
        for k in used:
            todo.append((len(centres), own[near == k]))
            centres.append(found[k]), first.append(0), count.append(0), leaf.append(-1)
    return Tree(np.array(centres), np.array(first), np.array(count), np.array(leaf))


def distances(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Euclidean distances of one query in double precision."""
    with np.errstate(over="ignore"):
        return np.sqrt(np.square(vectors - query).sum(axis=1))


def nearest_of(
    query: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, known: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distances, ids and places of the ``k`` nearest, ties to the smaller id, together with those ``known`` before
    (whose ``k``-th distance turns others away; their places mean nothing)."""
    gaps = distances(query, vectors)
    most = known[0][k - 1] if known is not None and len(known[0]) >= k else np.inf
    if len(gaps) > k:
        most = min(most, np.partition(gaps, k - 1)[k - 1])
    near = np.flatnonzero(gaps <= most)
    if known is not None and not len(near):
        return known
    found = (gaps[near], ids[near], near)
    if known is not None:
        found = tuple(np.concatenate(pair) for pair in zip(known, found))
    order = np.lexsort((found[1], found[0]))[:k]
    return tuple(part[order] for part in found)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _whole(table: pa.Table, name: str) -> pa.Array:
    held = table.column(name).combine_chunks()
    return held


def usable_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id``, ``v`` (double) and its 128-bit name ``h1, h2``, each row once; rows that take no part are left out."""
    plain = F.transform(F.col(vec_col).cast("array<double>"), lambda x: x + F.lit(0.0))  # one zero
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).alias("id"), plain.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0.0)
    )
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    first = sizes.orderBy(F.desc("n"), "dim").limit(1).toArrow().to_pydict()["dim"]
    rows = rows.filter(F.size("v") == (first[0] if first else 0))
    return rows.select("id", "v", *[F.xxhash64("v", F.lit(k)).alias(f"h{k}") for k in (1, 2)])


def candidates_of(rows: DataFrame, k: int) -> DataFrame:
    """The ``k + 1`` smallest ids of every distinct vector; the limit works before the shuffle, so copies don't travel."""
    once = rows.groupBy("id", "h1", "h2", "v").agg(F.lit(1).alias("__one")).drop("__one")
    nth = F.row_number().over(Window.partitionBy("h1", "h2", "v").orderBy("id"))
    return once.withColumn("nth", nth).filter(F.col("nth") <= k + 1)


def _probe(assigned: DataFrame, queries: np.ndarray, k: int) -> list[np.ndarray]:
    """The leaves of the true ``k`` nearest of each of a few queries, by comparing them with every row."""
    shared = assigned.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[float, int, int]]] = [[] for _ in shared.value]
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, leaves, raw = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2))
            for n, query in enumerate(shared.value):
                gaps, own, near = nearest_of(query, raw, ids, k)
                held[n] = heapq.nsmallest(k, [*held[n], *zip(gaps.tolist(), own.tolist(), leaves[near].tolist())])
        rows = [(n, *row) for n, own in enumerate(held) for row in own]
        if rows:
            kinds = (pa.int32(), pa.float64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["probe", "gap", "id", "leaf"])

    found = assigned.select(F.col("id").cast("long"), "leaf", "v").mapInArrow(run, "probe int, gap double, id long, leaf int")
    nth = F.row_number().over(Window.partitionBy("probe").orderBy("gap", "id"))
    best = found.withColumn("nth", nth).filter(F.col("nth") <= k).select("probe", "leaf").toArrow()  # PROBES * k rows at most
    probe, leaf = (best.column(c).to_numpy() for c in ("probe", "leaf"))
    return [leaf[probe == n] for n in range(len(queries))]


def calibrated_visits(tree: Tree, queries: np.ndarray, truth: list[np.ndarray], recall: float) -> int:
    """The fewest visits whose leaves hold the share ``recall`` of the true neighbours of all probes."""
    place = []
    for query, leaves in zip(queries, truth):
        turn = {leaf: n for n, leaf in enumerate(tree.order(query), 1)}
        place += [turn[int(leaf)] for leaf in leaves]
    if not place:
        return tree.leaves
    visits, held = 1, np.sort(np.array(place))
    while visits < tree.leaves and np.searchsorted(held, visits, side="right") < recall * len(held):  # widen by one leaf
        visits += 1
    return visits


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 10, recall: float = 0.97, id_col: str = "vec_id", vec_col: str = "embedding",
    leaf_rows: int = 256, block: int = BLOCK, sample_rows: int = SAMPLE,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id_col``, ``score`` (Euclidean distance) for the rows of which ``is_query`` (on ``id``) holds."""
    spark = vectors.sparkSession
    rows = usable_vectors(vectors, id_col, vec_col)
    kind = rows.schema["id"].dataType.simpleString()
    held = written(candidates_of(rows, k))
    distinct = held.filter("nth = 1")
    size = distinct.count()
    probes = hash_sample(distinct.withColumn("__hash", F.xxhash64("h1", F.lit("probe"))), PROBES).select("v").toArrow()
    if not size:
        return held.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias(id_col), F.lit(0.0).alias("score")).limit(0)
    dim = len(distinct.select("v").first()["v"])
    some = min(sample_rows, max(SAMPLE_NUMBERS // dim, 32))
    sample = hash_sample(distinct.withColumn("__hash", F.xxhash64("h2", F.lit("tree"))), some).select("v").toArrow()
    tree = fit_tree(_matrix(_whole(sample, "v")) if len(sample) else np.zeros((1, dim)), size, leaf_rows)
    shared = spark.sparkContext.broadcast(tree)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = shared.value.assign(_matrix(batch.column(3))) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.int32())], ["id", "h1", "h2", "v", "leaf"])

    columns = f"id {kind}, h1 long, h2 long, v array<double>, leaf int"
    assigned = written(held.select("id", "h1", "h2", "v").mapInArrow(assign, columns))
    asked = _matrix(_whole(probes, "v")) if len(probes) else np.zeros((0, dim))
    visits = calibrated_visits(tree, asked, _probe(assigned, asked, k), recall)

    filled = {r["leaf"]: r["n"] for r in assigned.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per leaf
    in_leaf = np.array([filled.get(leaf, 0) for leaf in range(tree.leaves)])
    blocks = np.maximum(-(-in_leaf // block), 1)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            row, leaf, part = [], [], []
            for n, query in enumerate(_matrix(batch.column(2)) if batch.num_rows else []):
                met = 0
                for turn, at in enumerate(own.order(query)):
                    if turn >= visits and met > k:
                        break
                    met += int(in_leaf[at])
                    if in_leaf[at]:
                        row += [n] * int(blocks[at])
                        leaf += [at] * int(blocks[at])
                        part += range(int(blocks[at]))
            taken = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(leaf, pa.int32()), pa.array(part, pa.int32())], ["h1", "h2", "v", "leaf", "part"])

    asking = written(rows.filter(is_query).select("id", "h1", "h2", "v"))
    classes = asking.groupBy("h1", "h2").agg(F.any_value("v").alias("v"))
    walks = written(classes.mapInArrow(walk, "h1 long, h2 long, v array<double>, leaf int, part int"))
    sides = walks.filter("part = 0").groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("sides"))
    sizes = F.broadcast(sides)  # a row per leaf, of which there are SAMPLE / 16 at most
    cuts = F.broadcast(spark.createDataFrame(pa.table({"leaf": pa.array(range(tree.leaves), pa.int32()), "blocks": pa.array(blocks, pa.int32())})))
    item = ["leaf", "part", "side"]
    stored = (
        assigned.join(sizes, "leaf").join(cuts, "leaf")
        .withColumn("part", F.pmod(F.xxhash64("id", "h1"), F.col("blocks")).cast("int"))
        .withColumn("side", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
        .select(*item, F.lit(False).alias("asks"), "id", F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"), "v")
    )
    queries = walks.join(sizes, "leaf").withColumn("side", F.pmod(F.xxhash64("h1", "h2"), F.col("sides")).cast("int")).select(
        *item, F.lit(True).alias("asks"), F.lit(None).cast(kind).alias("id"), "h1", "h2", "v"
    )
    items = stored.unionByName(queries).repartition(*item).sortWithinPartitions(*item, "asks")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The ``k + 1`` nearest of each query over all items of the task, as in a combine before a shuffle."""
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

        def flush() -> pa.RecordBatch:
            sizes = [len(own[0]) for own in best.values()]
            names = [np.repeat(np.array([key[n] for key in best], np.int64), sizes) for n in (0, 1)]
            ids = pa.array(np.concatenate([own[1] for own in best.values()]), id_type)
            gaps = np.concatenate([own[0] for own in best.values()])
            best.clear()
            return pa.RecordBatch.from_arrays([*map(pa.array, names), ids, pa.array(gaps)], ["h1", "h2", "id", "score"])

        for table in complete_groups(batches, item, 8192):
            edges, asks = group_edges(table, item), table.column("asks").to_numpy(zero_copy_only=False)
            ids, whole = _whole(table, "id"), _whole(table, "v")
            id_type = ids.type
            h1, h2 = (table.column(c).to_numpy().tolist() for c in ("h1", "h2"))
            for a, b in zip(edges[:-1], edges[1:]):
                cut = a + int(np.searchsorted(asks[a:b], True))
                if cut in (a, b):
                    continue
                raw, own = _matrix(whole.slice(a, cut - a)), ids.slice(a, cut - a).to_numpy(zero_copy_only=False)
                for n, query in enumerate(_matrix(whole.slice(cut, b - cut)), cut):
                    key = h1[n], h2[n]
                    best[key] = nearest_of(query, raw, own, k + 1, best.get(key))
                if len(best) >= HELD:
                    yield flush()
        if best:
            yield flush()

    found = items.mapInArrow(compare, f"h1 long, h2 long, id {kind}, score double")
    nth = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("score", "id"))
    best = found.withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    # A class of equal queries shares its answer; each query leaves itself out and moves up what follows.
    listed = best.groupBy("h1", "h2").agg(F.array_sort(F.collect_list(F.struct("nth", "id", "score"))).alias("near"))  # k + 1 at most
    each = asking.select("id", "h1", "h2").distinct().join(listed, ["h1", "h2"])
    others = F.filter("near", lambda x: (x["id"] != F.col("id")) | (x["score"] != 0.0))
    ranked = each.select(F.col("id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("pos", "r"))
    return ranked.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("r.id").alias(id_col), F.col("r.score").alias("score"))
