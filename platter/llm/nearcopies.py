"""Near copies by word shingles: every pair of texts whose sets of five-word shingles have Jaccard 0.8 or more.

Candidates come from minhash tables: a table's key is ``rows`` minimum hashes, so a pair of similarity
``s`` shares none of ``tables`` keys with probability ``(1 - s ** rows) ** tables``: 3e-6 at 0.8 with
the defaults, less above. Rows that share a key are compared by the exact Jaccard of their sets of
64-bit shingle hashes, so no link below the threshold is made. Texts of the same set are one node from
the start. A bucket that holds the same nodes as another one is compared once, and a bucket of many
rows is cut into pairs of sub-blocks (see ``components``).

Edge cases: words are cut at ASCII spaces and only A-Z is lowered; a text under five words has one
shingle, the whole sequence; null and blank texts are copies of one another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platter.llm.common import complete_groups, group_edges, reliable, text_or_empty
from platter.llm.components import connected_components, dealt, roots_of, work_items
from platter.llm.simhash import fingerprint_links, fingerprint_of, first_of_each

#: Rows of a sub-block; their shingle sets are in memory at once. A set over ``PLAIN`` shingles counts as several
#: rows, so a sub-block holds about ``BLOCK * PLAIN`` shingles (16 MB), or a single longer text.
BLOCK, PLAIN = 512, 4096
TABLES, ROWS, WIDTH, SIMILARITY = 24, 4, 5, 0.8
_ODD = np.random.default_rng(42).integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles_of(text: str, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(w, 42) for w in words), dtype=np.uint64, count=len(words))
    size = min(width, len(words))
    total = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        total += hashes[k : k + len(total)] * _ODD[k]
    return np.unique(_mixed(total))


def table_keys(grams: np.ndarray, tables: int = TABLES, rows: int = ROWS) -> np.ndarray:
    """A key a table: a hash of ``rows`` minima of the set under multiplications by odd numbers."""
    if not len(grams):
        return np.zeros(tables, dtype=np.uint64)
    factors = _ODD[16 : 16 + tables * rows, None]
    least = np.full(tables * rows, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(grams), 256):  # a piece and its products stay in the cache
        np.minimum(least, (factors * grams[None, start : start + 256]).min(axis=1), out=least)
    least = _mixed(least).reshape(tables, rows)
    return _mixed((least * _ODD[8 : 8 + rows]).sum(axis=1, dtype=np.uint64))


def node_of(grams: np.ndarray) -> int:
    """The signed 64-bit name of a set."""
    return int(np.uint64(xxhash.xxh64_intdigest(grams.tobytes(), 42)).view(np.int64)) if len(grams) else 0


def prints_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``node``, ``size`` (distinct shingles) and ``keys`` (one a table) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles_of(t) for t in batch.column(1).to_pylist()]
            nodes = pa.array([node_of(s) for s in sets], pa.int64())
            keys = pa.array([table_keys(s).view(np.int64) for s in sets], pa.list_(pa.int64()))
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), nodes, sizes, keys], [id_col, "node", "size", "keys"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_or_empty(text_col).alias("__text")).mapInArrow(run, f"`{id_col}` {kind}, node long, size long, keys array<long>")


def sets_of(docs: DataFrame, wanted: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = 200_000) -> DataFrame:
    """``node`` and ``grams`` (the set as bytes) of the nodes of ``wanted``, whose rows name a document of each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles_of(t) for t in batch.column(1).to_pylist()]
            same = [k for k, node in enumerate(batch.column(0).to_pylist()) if node_of(sets[k]) == node]  # an id may occur with several texts
            grams = pa.array([sets[k].tobytes() for k in same], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(same, pa.int64())), grams], ["node", "grams"])

    side = F.broadcast(wanted) if wanted.count() <= broadcast_rows else wanted
    texts = docs.select(id_col, text_or_empty(text_col).alias("__text")).join(side, id_col).select("node", "__text")
    return texts.mapInArrow(run, "node long, grams binary").groupBy("node").agg(F.first("grams").alias("grams"))


def linked_sets(sets: list[np.ndarray], similarity: float = SIMILARITY) -> np.ndarray:
    """The matrix of pairs whose exact Jaccard is ``similarity`` or more."""
    sizes = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    grams = np.concatenate(sets)
    order = np.argsort(grams, kind="stable")
    grams, row = grams[order], row[order]
    edges = np.append(np.flatnonzero(np.append(True, grams[1:] != grams[:-1])), len(grams))
    lengths = np.diff(edges)
    shared = np.flatnonzero(lengths > 1)
    row, lengths = row[np.repeat(lengths > 1, lengths)], lengths[shared]
    common, ends = np.zeros((len(sets), len(sets)), dtype=np.int64), np.append(0, np.cumsum(lengths))
    for start in range(0, len(lengths), 4096):  # bounded memory; single precision counts 4,096 exactly
        stop = min(start + 4096, len(lengths))
        hold = np.zeros((stop - start, len(sets)), dtype=np.float32)
        hold[np.repeat(np.arange(stop - start), lengths[start:stop]), row[ends[start] : ends[stop]]] = 1
        common += (hold.T @ hold).astype(np.int64)
    np.fill_diagonal(common, sizes)
    return common >= similarity * (sizes[:, None] + sizes[None, :] - common) - 1e-9


def similar_links(items: DataFrame, order: list[str], similarity: float = SIMILARITY) -> DataFrame:
    """Spanning edges ``u``, ``v`` of the pairs in each work item (``node`` and ``grams``, sorted by ``order``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in complete_groups(batches, order, 1024):
            edges = group_edges(table, order)
            nodes, grams = table.column("node").to_numpy(), table.column("grams").to_pylist()
            for a, b in zip(edges[:-1], edges[1:]):
                if b - a < 2:
                    continue
                root = roots_of(linked_sets([np.frombuffer(g, dtype=np.uint64) for g in grams[a:b]], similarity), nodes[a:b])
                moved = root != nodes[a:b]
                if moved.any():
                    yield pa.RecordBatch.from_arrays([pa.array(nodes[a:b][moved]), pa.array(root[moved])], ["u", "v"])

    return items.mapInArrow(run, "u long, v long")


def similar_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, block: int = BLOCK, radius: int | None = None
) -> DataFrame:
    """Every row's ``id_col``, ``component_id`` (the smallest id among the texts that links reach) and ``node``; ids are non-null.

    With a ``radius``, texts whose SimHash fingerprints differ in so many bits or fewer are linked too (see ``simhash``).
    """
    prints = reliable(prints_of(docs, id_col, text_col))
    classes = reliable(prints.groupBy("node").agg(F.min(id_col).alias("__least"), F.first("size").alias("size"), F.first("keys").alias("keys")))
    bucket = ["tab", "key"]
    rows = classes.select("node", "size", F.posexplode("keys").alias(*bucket))
    # Near copies meet in many tables: of the buckets with the same nodes, by a 128-bit hash, one is kept.
    whole = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"__h{k}") for k in (1, 2)]
    buckets = rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("__n"), *whole).filter("__n > 1")
    kept = buckets.groupBy("__n", "__h1", "__h2").agg(F.min(F.struct(*bucket)).alias("b")).select("b.*")
    weight = F.greatest(F.lit(1.0), F.col("size") / F.lit(PLAIN))
    members = reliable(work_items(rows.join(kept, bucket, "left_semi"), bucket, "node", block, weight).drop("size"))
    wanted = reliable(classes.join(members.select("node").distinct(), "node").select("node", F.col("__least").alias(id_col)))
    items = dealt(members.join(sets_of(docs, wanted, id_col, text_col), "node"), bucket)
    links = similar_links(items, [*bucket, "left_block", "right_block"], similarity)
    if radius is not None:
        links = links.unionByName(fingerprint_node_links(docs, radius, id_col, text_col))
    labels = connected_components(links)
    labelled = classes.join(labels, "node", "left").select("node", "__least", F.coalesce("component", "node").alias("__label"))
    least = labelled.groupBy("__label").agg(F.min("__least").alias("component_id"))
    by_node = labelled.join(least, "__label").select("node", "component_id")
    return prints.join(by_node, "node").select(id_col, "component_id", "node")


def fingerprint_node_links(docs: DataFrame, radius: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spanning edges ``u``, ``v`` between the nodes of texts whose SimHash fingerprints differ in ``radius`` bits or fewer."""
    text = text_or_empty(text_col).alias("__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            nodes = pa.array([node_of(shingles_of(t)) for t in texts], pa.int64())
            prints = np.fromiter((fingerprint_of(t) for t in texts), dtype=np.uint64, count=len(texts))
            yield pa.RecordBatch.from_arrays([nodes, pa.array(prints.view(np.int64))], ["node", "fp"])

    both = reliable(docs.select(text).mapInArrow(run, "node long, fp long").distinct())
    first = reliable(both.groupBy("fp").agg(F.min("node").alias("first")))
    same = both.join(first, "fp").filter("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v"))
    near = fingerprint_links(first.select("fp"), radius)
    for end in ("u", "v"):
        near = near.join(first.select(F.col("fp").alias(end), F.col("first").alias(f"__{end}")), end)
    return same.unionByName(near.select(F.col("__u").alias("u"), F.col("__v").alias("v")).filter("u <> v"))


def keep_one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, radius: int | None = None
) -> DataFrame:
    """One document of each component, with all its columns; rows without an id are kept as they are. ``radius`` as in ``similar_components``.

    Where an id occurs on several rows, each is judged by its own text (see ``simhash.first_of_each``).
    """
    found = similar_components(docs.filter(F.col(id_col).isNotNull()), id_col, text_col, similarity, radius=radius)
    prints = found.select(id_col, "component_id", F.col("node").alias("print"))
    return first_of_each(docs, prints, lambda t: node_of(shingles_of(t)), id_col, text_col)
