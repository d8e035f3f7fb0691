"""Embedding near-dedup with randomised-rotation binary codes.

Every vector is normalised and rotated by random orthogonal matrices; the signs of the rotated
coordinates are its binary codes, and slices of them are bucket keys, in as many tables as keep the
chance to miss a pair that lies exactly at the threshold below ``miss`` (pairs above it are missed
less often still). Only sketches travel to the buckets: the packed codes of ``CODES`` rotations, the
stored correction factor and the vector at four bits a coordinate, in which it plays the query.

With ``c`` the mean of a vector's codes, turned back, and ``f = <c, vector>`` its factor, ``<c, q> / f``
is an unbiased estimate of the inner product with any ``q``: what ``c`` has beside ``f * vector`` points
in a random direction, so ``z * sqrt((|c|^2 - f^2) / (d - 1)) / f`` bounds the error (the rounding of
``q`` to four bits, whose length is stored, is added to it). A pair stays undecided if the upper bounds
of both directions reach the threshold. Whole vectors are fetched only for the rows of a bucket that
have an undecided pair, and their cosines are recomputed in double precision. No pair is accepted by
its lower bound: a link must be certain.

Equal vectors are one class: copies are never expanded into pairs, yet count as links. Edge cases:
null, empty, zero or non-finite vectors link with nothing and are their own component; vectors of
different lengths never link; a null id gets a row but is never a component's id; repeated rows keep
one row each and link with each other; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from platter.llm.common import complete_groups, group_edges, reliable
from platter.llm.components import BLOCK, connected_components, dealt, roots_of, split_hot

#: What single precision may lose in an estimate.
ROUNDING = 1e-3
#: Rotations whose codes make up a sketch.
CODES = 4


@lru_cache(maxsize=32)
def rotation(dim: int, index: int, seed: int = 7) -> np.ndarray:
    """The ``index``-th random orthogonal matrix for vectors of ``dim`` numbers."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim, index]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def table_plan(rows: int, threshold: float, miss: float, bucket_rows: int = 256) -> tuple[int, int]:
    """Key width in bits and number of tables: about ``bucket_rows`` rows a bucket, and at most ``miss`` at the threshold.

    Every table ships every row once, while a comparison inside a bucket is a few dozen multiplications,
    so wide buckets and few tables are the cheaper choice.
    """
    bits = max(4, min(28, round(math.log2(max(rows, 2) / bucket_rows))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-agree)))


def normalised(raw: np.ndarray) -> np.ndarray:
    """The rows of ``raw`` at unit length in double precision, without overflow or underflow on the way."""
    unit = raw.astype(np.float64)
    unit /= np.abs(unit).max(axis=1, keepdims=True)
    return unit / np.linalg.norm(unit, axis=1, keepdims=True)


def sign_bits(unit: np.ndarray, count: int, seed: int = 7) -> np.ndarray:
    """The first ``count`` sign bits ``[rows, count]`` of as many rotations as needed; the first ``dim`` are the code."""
    dim = unit.shape[1]
    turns = range(math.ceil(count / dim))
    return np.concatenate([unit @ rotation(dim, k, seed) > 0 for k in turns], axis=1)[:, :count]


def keys_of(signs: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Keys ``[rows, tables]``: consecutive slices of the sign bits."""
    return signs[:, : bits * tables].reshape(len(signs), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def four_bits(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Levels 1 to 15 of every coordinate, 8 for zero, and the size of a step in every row."""
    step = (np.abs(turned).max(axis=1) / 7).astype(np.float32)
    return np.clip(np.rint(turned / step[:, None]) + 8, 1, 15).astype(np.uint8), step


def mean_codes(signs: np.ndarray, dim: int, seed: int = 7) -> np.ndarray:
    """The mean of the codes ``[rows, CODES * dim]``, turned back into the frame of the first rotation."""
    first = rotation(dim, 0, seed)
    back = np.concatenate([rotation(dim, k, seed).T @ first for k in range(signs.shape[1] // dim)])
    value = np.float32(dim / (signs.shape[1] * math.sqrt(dim)))
    return np.where(signs > 0, value, -value) @ back.astype(np.float32)


def sketches(unit: np.ndarray, signs: np.ndarray, seed: int = 7) -> list[bytes]:
    """A row's packed codes, its coordinates at four bits, and the factor, the step and the length of the rounding."""
    dim = unit.shape[1]
    turned = unit @ rotation(dim, 0, seed)
    level, step = four_bits(turned)
    rest = np.linalg.norm(turned - (level - 8.0) * step[:, None], axis=1)
    factor = np.einsum("ij,ij->i", mean_codes(signs, dim, seed), turned)
    level = np.pad(level, ((0, 0), (0, dim % 2)))
    numbers = np.stack([factor, step, rest], axis=1).astype("<f4").view(np.uint8)
    return [row.tobytes() for row in np.concatenate([np.packbits(signs, axis=1), level[:, ::2] << 4 | level[:, 1::2], numbers], axis=1)]


def unpacked(packed: list[bytes], dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The signs, the four-bit vectors in the frame of the first rotation, and ``[factor, step, rest]`` of every row."""
    raw = np.frombuffer(b"".join(packed), dtype=np.uint8).reshape(len(packed), -1)
    code, half = (CODES * dim + 7) // 8, (dim + 1) // 2
    signs = np.unpackbits(raw[:, :code], axis=1)[:, : CODES * dim]
    pairs = raw[:, code : code + half]
    level = np.stack([pairs >> 4, pairs & 15], axis=2).reshape(len(raw), -1)[:, :dim]
    numbers = np.ascontiguousarray(raw[:, code + half :]).view("<f4")
    return signs, (level.astype(np.float32) - 8) * numbers[:, 1:2], numbers


def undecided(signs: np.ndarray, query: np.ndarray, numbers: np.ndarray, threshold: float, z: float, seed: int = 7) -> np.ndarray:
    """The symmetric matrix of the pairs that both upper confidence bounds let reach the threshold."""
    dim = query.shape[1]
    code = mean_codes(signs, dim, seed)
    length, factor, rest = np.einsum("ij,ij->i", code, code), numbers[:, 0], numbers[:, 2]
    own = np.maximum(length - factor**2, 0) / max(dim - 1, 1)  # variances of <c, q>
    added = length[:, None] * (rest**2)[None, :] / dim
    reach = code @ query.T + np.float32(z) * np.sqrt(own[:, None] + added)
    may = reach >= np.float32(threshold - ROUNDING) * factor[:, None]
    return may & may.T


def vector_components(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    threshold: float = 0.9,
    miss: float = 0.01,
    z: float = 4.0,
    block: int = BLOCK,
) -> DataFrame:
    """Every row's ``id_col``, ``n_links``, ``component_id`` and ``kept`` (see the module's text)."""
    held = vectors.schema[vec_col].dataType
    single = isinstance(held, ArrayType) and isinstance(held.elementType, FloatType)
    value = F.col(vec_col) if single else F.col(vec_col).cast("array<double>")  # floats are widened where they are used
    plus = F.lit(0.0).cast("float" if single else "double")
    bad = F.exists("__v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists("__v", lambda x: x != 0.0)
    rows = vectors.select(F.col(id_col), F.transform(value, lambda x: x + plus).alias("__v")).withColumn(
        "__v", F.when(F.col("__v").isNotNull() & ~bad & ~zero, F.col("__v"))
    )
    usable = rows.filter(F.col("__v").isNotNull())
    name = [F.xxhash64("__v", F.lit(k)).alias(f"__h{k}") for k in (1, 2)]  # 128 bits name a vector in the last join
    classes = reliable(
        usable.groupBy("__v")
        .agg(F.min(id_col).alias("least"), F.count(F.lit(1)).alias("copies"))
        .select("*", F.monotonically_increasing_id().alias("class"), *name)
    )
    bits, tables = table_plan(classes.count(), threshold, miss)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = pa.Table.from_batches([batch])
            sizes = frame.column("__v").combine_chunks().value_lengths().to_numpy()
            for dim in np.unique(sizes):
                part = frame.filter(pa.array(sizes == dim))
                raw = part.column("__v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                unit = normalised(raw)
                signs = sign_bits(unit, max(CODES * dim, bits * tables))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("class").combine_chunks(),
                        pa.array(np.full(len(unit), dim, dtype=np.int32)),
                        pa.array(sketches(unit, signs[:, : CODES * dim]), pa.binary()),
                        pa.array(list(keys_of(signs, bits, tables)), pa.list_(pa.int64())),
                    ],
                    ["class", "dim", "sketch", "keys"],
                )

    coded = classes.select("class", "__v").mapInArrow(encode, "class long, dim int, sketch binary, keys array<long>")
    tabled = coded.select("class", "dim", "sketch", F.posexplode("keys").alias("tab", "key"))
    bucket = ["dim", "tab", "key"]
    order = [*bucket, "left_block", "right_block"]
    items = dealt(split_hot(tabled, bucket, "class", block), bucket)

    def fresh(signs: np.ndarray, tab: int, pairs: np.ndarray) -> np.ndarray:
        """``pairs`` without those that share the key of one of the first ``tab`` tables, which has compared them."""
        at = np.flatnonzero(pairs.any(axis=1))
        part = pairs[np.ix_(at, at)]
        for key in keys_of(signs[at], bits, min(tab, signs.shape[1] // bits)).T:
            part &= key[:, None] != key[None, :]
        pairs[np.ix_(at, at)] = part
        return pairs

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of each work item that have an undecided pair in it."""
        for table in complete_groups(batches, order, 8192):
            edges = group_edges(table, order)
            dims, tab, sub = (table.column(name).to_numpy() for name in ("dim", "tab", "sub"))
            left, right = table.column("left_block").to_numpy(), table.column("right_block").to_numpy()
            packed, touched = table.column("sketch").combine_chunks(), np.zeros(table.num_rows, dtype=bool)
            for a, b in zip(edges[:-1], edges[1:]):
                if b - a < 2:
                    continue
                signs, query, numbers = unpacked(packed[a:b].to_pylist(), int(dims[a]))
                maybe = undecided(signs, query, numbers, threshold, z)
                np.fill_diagonal(maybe, False)
                if left[a] != right[a]:
                    maybe &= sub[a:b, None] != sub[None, a:b]
                if maybe.any():
                    touched[a:b] = fresh(signs, int(tab[a]), maybe).any(axis=1)
            yield from table.drop_columns("sketch").filter(pa.array(touched)).to_batches()

    kept_columns = "class long, dim int, tab int, key long, sub int, left_block int, right_block int"
    asked = items.select("class", *bucket, "sub", "left_block", "right_block", "sketch").mapInArrow(screen, kept_columns)
    fetched = dealt(asked.join(classes.select("class", "copies", "__v"), "class"), bucket)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in complete_groups(batches, order, 8192):
            edges = group_edges(table, order)
            ids, copies = table.column("class").to_numpy(), table.column("copies").to_numpy()
            tab, sub = table.column("tab").to_numpy(), table.column("sub").to_numpy()
            left, right = table.column("left_block").to_numpy(), table.column("right_block").to_numpy()
            whole = table.column("__v").combine_chunks()
            for a, b in zip(edges[:-1], edges[1:]):
                if b - a < 2:
                    continue
                unit = normalised(whole[a:b].flatten().to_numpy(zero_copy_only=False).reshape(b - a, -1))
                linked = unit @ unit.T >= threshold
                np.fill_diagonal(linked, False)
                if left[a] != right[a]:
                    linked &= sub[a:b, None] != sub[None, a:b]
                if tab[a] and linked.any():
                    linked = fresh(sign_bits(unit, bits * int(tab[a])), int(tab[a]), linked)
                touched = np.flatnonzero(linked.any(axis=1))
                if not len(touched):
                    continue
                inner = linked[np.ix_(touched, touched)]
                root = roots_of(inner, ids[a:b][touched])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a:b][touched]), pa.array(root), pa.array(inner @ copies[a:b][touched])], ["u", "v", "links"]
                )

    stars = reliable(fetched.mapInArrow(search, "u long, v long, links long"))
    labels = connected_components(stars.select("u", "v"))
    links = stars.groupBy("u").agg(F.sum("links").alias("links"))
    per_class = (
        classes.select("class", "least", "copies", "__h1", "__h2")
        .join(labels, F.col("class") == labels["node"], "left")
        .join(links, F.col("class") == links["u"], "left")
        .select("least", "copies", "__h1", "__h2", F.coalesce("component", "class").alias("label"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    least = per_class.groupBy("label").agg(F.min("least").alias("component_id"))
    settled = per_class.join(least, "label").select(
        "__h1", "__h2", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    linked = usable.select(id_col, *name).join(settled, ["__h1", "__h2"]).select(id_col, "n_links", "component_id")
    alone = rows.filter(F.col("__v").isNull()).select(id_col, F.lit(0).cast("long").alias("n_links"), F.col(id_col).alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
