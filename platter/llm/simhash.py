"""SimHash near-dedup by covering locality-sensitive hashing.

A document's 64-bit fingerprint is the bitwise majority of the XXH64 hashes (seed 42) of its
three-word shingles. Every bit position carries a vector of ``radius + 1`` bits; table ``v`` keeps the
positions whose vector has an odd inner product with ``v``. Positions in which two fingerprints
differ are at most ``radius`` vectors, so some non-zero ``v`` is orthogonal to all of them and the
fingerprints agree on everything that table keeps: each pair within the radius collides in at least
one of the ``2 ** (radius + 1) - 1`` tables. The exact distance is then checked.

Edge cases: a null or blank text has fingerprint zero and links like any other; a text of one or two
words has one shingle, the whole sequence; repeated rows keep one output row each; a row whose
``doc_id`` is null gets its fingerprint and the smallest non-null id of its component (null if none);
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platter.llm.common import complete_groups, group_edges, reliable, text_or_empty
from platter.llm.components import BLOCK, connected_components, dealt, roots_of, work_items


def fingerprint_of(text: str, width: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, only ASCII spaces
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        hashes = [digest(b" ".join(words), seed)]
    else:
        hashes = [digest(b" ".join(gram), seed) for gram in zip(*(words[i:] for i in range(width)))]
    total = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 65536):  # bounded memory on a very long text
        part = np.array(hashes[start : start + 65536], dtype="<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * total > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``id_col`` and ``fp`` (the fingerprint's bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint_of(t, width) for t in batch.column(1).to_pylist()), dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], [id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_or_empty(text_col).alias("__text")).mapInArrow(run, f"`{id_col}` {kind}, fp long")


def covering_masks(radius: int = 2) -> list[int]:
    """The bit masks of the tables; position ``i`` carries the vector ``1 + i mod (2 ** (radius + 1) - 1)``."""
    tables = 2 ** (radius + 1) - 1
    return [sum(1 << i for i in range(64) if ((1 + i % tables) & v).bit_count() % 2) for v in range(1, tables + 1)]


def fingerprint_links(distinct: DataFrame, radius: int = 2, block: int = BLOCK) -> DataFrame:
    """Spanning edges ``u``, ``v`` between distinct fingerprints within ``radius`` bits of each other."""
    signed = [m - (1 << 64) if m >> 63 else m for m in covering_masks(radius)]
    tables = F.explode(
        F.array(*[F.struct(F.lit(k).alias("tab"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(signed)])
    )
    rows = distinct.select("fp", tables.alias("t")).select("t.tab", "t.key", "fp")
    bucket = ["tab", "key"]
    items = dealt(work_items(rows, bucket, "fp", block), bucket)
    order = [*bucket, "left_block", "right_block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in complete_groups(batches, order):
            edges = group_edges(table, order)
            signed_fp = table.column("fp").to_numpy()
            bits = signed_fp.view(np.uint64)
            found: list[np.ndarray] = []
            for a, b in zip(edges[:-1], edges[1:]):
                if b - a < 2:
                    continue
                near = np.bitwise_count(bits[a:b, None] ^ bits[None, a:b]) <= radius
                if near.sum() == b - a:
                    continue
                root = roots_of(near, signed_fp[a:b])
                moved = root != signed_fp[a:b]
                found.append(np.stack([signed_fp[a:b][moved], root[moved]]))
            if found:
                pairs = np.unique(np.concatenate(found, axis=1), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["u", "v"])

    return items.mapInArrow(run, "u long, v long")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2, width: int = 3, block: int = BLOCK
) -> DataFrame:
    """Every row's ``id_col``, ``fp``, ``fingerprint`` (16 hex digits) and ``component_id``."""
    prints = reliable(fingerprints(docs, id_col, text_col, width))
    classes = reliable(prints.groupBy("fp").agg(F.min(id_col).alias("__least")))
    labels = connected_components(fingerprint_links(classes.select("fp"), radius, block))
    labelled = classes.join(labels, classes["fp"] == labels["node"], "left").select(
        "fp", "__least", F.coalesce("component", "fp").alias("__label")
    )
    least = labelled.groupBy("__label").agg(F.min("__least").alias("component_id"))
    by_print = labelled.join(least, "__label").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        id_col, "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2) -> DataFrame:
    """One document of each component, with all its columns; rows without an id are kept as they are.

    Where an id occurs on several rows, each is judged by its own text (see ``first_of_each``).
    """
    found = simhash_components(docs.filter(F.col(id_col).isNotNull()), id_col, text_col, radius)
    return first_of_each(docs, found.select(id_col, "component_id", F.col("fp").alias("print")), lambda t: _signed(fingerprint_of(t)), id_col, text_col)


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def first_of_each(
    docs: DataFrame, found: DataFrame, print_of: Callable[[str], int], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The first row of each component of ``found`` (``id_col``, ``component_id``, ``print``), and the rows without an id.

    The first row has the component's least id. An id on several rows names several candidates: the
    one of the least ``print`` stays, of rows that agree in both the one with the least text. Prints
    are computed again for the rows of such ids only.
    """
    own = F.when(F.col(id_col) == F.col("component_id"), F.col("print"))
    ids = reliable(found.groupBy(id_col).agg(F.count(F.lit(1)).alias("__rows"), F.min(own).alias("__print")).filter("__print IS NOT NULL"))
    kept = docs.join(ids.filter("__rows = 1").select(id_col), id_col, "left_semi").select(docs.columns)
    repeated = ids.filter("__rows > 1").select(F.col(id_col).alias("__id"), "__print")
    if repeated.limit(1).count():
        names = [f"c{k}" for k in range(len(docs.columns))]
        key, text = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                prints = [print_of(t or "") for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
                yield batch.append_column("__own", pa.array(prints, pa.int64()))

        rows = docs.toDF(*names)
        rows = rows.join(repeated, F.col(key) == F.col("__id"))
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", __own long"
        same = rows.mapInArrow(run, schema).filter("__own = __print")
        least = same.groupBy(key).agg(F.min_by(F.struct(*names), F.struct(text_or_empty(text), F.col(text).isNotNull())).alias("r"))
        kept = kept.union(least.select("r.*").toDF(*docs.columns))
    return kept.union(docs.filter(F.col(id_col).isNull()))
