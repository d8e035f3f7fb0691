"""Semi and anti joins against a corpus of keys that is much larger than the matches: a Bloom filter goes first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platter.operators.steps import settled

#: A block is four words of 64 bits; a key sets two bits in each, so it is looked up by one row of the filter.
WORDS = 4
BITS_PER_KEY = 16
#: Most blocks that are broadcast: about 64 MB as rows, enough for 16 million keys. Beyond, joins go without a filter.
MOST_BLOCKS = 1 << 20


def _hash(on: list[str], salt: int) -> Column:
    return F.xxhash64(F.lit(salt), *[F.col(c) for c in on])


def _block(on: list[str], blocks: int) -> Column:
    """The block of a key; a key with a null has none and so meets nothing."""
    whole = F.lit(True)
    for c in on:
        whole = whole & F.col(c).isNotNull()
    return F.when(whole, F.pmod(_hash(on, 0), F.lit(blocks))).alias("__block")


def _masks(on: list[str]) -> list[Column]:
    """The bits of a key in each word of its block: 12 of the second hash's bits choose two of 64."""
    one, chosen = F.lit(1).cast("long"), _hash(on, 1)
    # The functions shift by constants only; there are 64 places, so a power of two is looked up.
    powers = F.array(*[F.shiftleft(one, k) for k in range(64)])

    def bit(k: int) -> Column:
        return F.get(powers, F.shiftrightunsigned(chosen, 6 * k).bitwiseAND(F.lit(63)).cast("int"))

    return [bit(2 * w).bitwiseOR(bit(2 * w + 1)).alias(f"__m{w}") for w in range(WORDS)]


def bloom_filter(keys: DataFrame, on: list[str], most_blocks: int = MOST_BLOCKS) -> DataFrame | None:
    """Rows ``__block, __b0 … __b3`` that hold every key's bits; None if the keys need more than ``most_blocks`` blocks.

    Sized by the number of distinct keys (``BITS_PER_KEY`` each, about one stranger in 1,000 passes) and built by
    ``bit_or``, which combines on the map side: what is shuffled is the filter, never the keys. Null keys set
    no bits, as they equal nothing.
    """
    known = keys.select(*on).dropna()
    # Sized by an estimate (2 % off at most, nearly always): a smaller filter passes more strangers, and loses no key.
    count = known.agg(F.approx_count_distinct(F.struct(*on), 0.02)).first()[0]
    blocks = max(1, -(-count * BITS_PER_KEY // (64 * WORDS)))
    if blocks > most_blocks:
        return None
    marked = known.select(_block(on, blocks), *_masks(on))
    rows = marked.groupBy("__block").agg(*[F.bit_or(f"__m{w}").alias(f"__b{w}") for w in range(WORDS)])
    return settled(rows.withColumn("__blocks", F.lit(blocks).cast("long")))


def _blocks(found: DataFrame) -> int:
    return found.select("__blocks").first()[0] if not found.isEmpty() else 1


def _looked_up(rows: DataFrame, found: DataFrame, on: list[str], how: str) -> DataFrame:
    """The rows that may be (``left_semi``) or certainly are not (``left_anti``) among the filter's keys."""
    # Packed, the rows may have columns of any name.
    marked = rows.select(F.struct(*rows.columns).alias("__row"), _block(on, _blocks(found)), *_masks(on))
    side = F.broadcast(found.withColumnRenamed("__block", "__at"))  # at most MOST_BLOCKS rows
    fits = F.col("__block") == F.col("__at")
    for w in range(WORDS):
        fits = fits & (F.col(f"__b{w}").bitwiseAND(F.col(f"__m{w}")) == F.col(f"__m{w}"))
    return marked.join(side, fits, how).select("__row.*")


def semi_join(rows: DataFrame, keys: DataFrame, on: list[str], most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """``rows`` whose ``on`` columns are among ``keys``, as a left semi join gives them: strangers stay where they are read."""
    found = bloom_filter(keys, on, most_blocks)
    known = keys.select(*on)
    if found is None:
        return rows.join(known, on, "left_semi").select(*rows.columns)
    return _looked_up(rows, found, on, "left_semi").join(known, on, "left_semi").select(*rows.columns)


def anti_join(rows: DataFrame, keys: DataFrame, on: list[str], most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """``rows`` whose ``on`` columns are not among ``keys``, as a left anti join gives them (rows with null keys stay).

    Rows that the filter turns away are strangers for certain and skip the shuffle; the few others take the
    exact join. Both parts read ``rows``: settle one that is dear.
    """
    found = bloom_filter(keys, on, most_blocks)
    known = keys.select(*on)
    if found is None:
        return rows.join(known, on, "left_anti").select(*rows.columns)
    strangers = _looked_up(rows, found, on, "left_anti")
    unsure = _looked_up(rows, found, on, "left_semi").join(known, on, "left_anti").select(*rows.columns)
    return strangers.unionByName(unsure)


def filter_load(rows: DataFrame, keys: DataFrame, on: list[str], most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """One row: ``rows``, ``shuffled`` (those that take the exact join) and ``known`` (those among the keys)."""
    found = bloom_filter(keys, on, most_blocks)
    count = F.count(F.lit(1))
    passed = (rows if found is None else _looked_up(rows, found, on, "left_semi")).agg(count).scalar()
    known = rows.join(keys.select(*on), on, "left_semi").agg(count).scalar()
    return rows.agg(count.alias("rows")).select("rows", passed.alias("shuffled"), known.alias("known"))
