"""Set containment between many titles: who holds whom, without comparing all with all.

Titles are sets of occurrence-tagged words (``tag_occurrences``), so sets stand for multisets. Three
things keep the work near the size of the input:

- *Distinct sets.* Rows with equal words in the same block are one set; what they stand for is joined
  back, or reduced to the best, only after the search.
- *An index on pairs of rare words.* If a set lies in another, its two rarest words do too. A smaller
  set is filed under that pair alone, a larger one under every pair of its words (beyond ``WIDE`` words
  under each word, where all smaller sets are filed a second time). A pair whose second word is the
  larger set's most frequent one is left out: three words or more don't end there. Pairs that survive
  are held against lengths and 64-bit signatures of their words before the words themselves.
- *Bounded items.* Entries that very many sets share are cut into blocks on both sides, and every pair
  of blocks is an item of at most ``ITEM`` by ``ITEM`` sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sets of one side in an item.
ITEM = 1024
#: Larger sets are filed under single words.
WIDE = 16


def signature(tags: Column) -> Column:
    """64 bits in which each word of a set sets one: a set inside another has no bit that the other lacks."""
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(t), F.lit(64)).cast("int"))
    return F.aggregate(tags, F.lit(0).cast("long"), lambda bits, t: bits.bitwiseOR(bit(t)))


def by_rarity(titles: DataFrame) -> DataFrame:
    """``title``, ``tags`` and ``rare``, its words from the rarest among all ``titles`` (each once) to the most frequent."""
    words = titles.select("title", F.explode("tags").alias("tag"))
    frequency = words.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("n", "tag"))), lambda s: s["tag"])
    rare = words.join(frequency, "tag").groupBy("title").agg(ordered.alias("rare"))  # the words of one title
    return titles.join(rare, "title")


def _smaller_keys(rare: Column) -> Column:
    """The entries of a set as the smaller one: its two rarest words, and the rarest for very large others."""
    first, second = F.get(rare, F.lit(0)), F.get(rare, F.lit(1))
    return F.array(F.concat_ws(" ", first, second), F.concat(F.lit("1 "), first))


def _larger_keys(rare: Column) -> Column:
    """The entries of a set as the larger one: pairs of its words in order of rarity, or single words if they are many."""
    pairs = F.flatten(
        F.transform(
            F.slice(rare, 1, F.greatest(F.size(rare) - 2, F.lit(0))),
            lambda a, i: F.transform(F.slice(rare, i + 2, F.greatest(F.size(rare) - i - 2, F.lit(0))), lambda b: F.concat_ws(" ", a, b)),
        )
    )
    single = F.transform(rare, lambda a: F.concat(F.lit("1 "), a))
    return F.when(F.size(rare) > WIDE, single).otherwise(pairs)


def filed(sets: DataFrame, smaller: bool, block: list[str]) -> DataFrame:
    """A row per entry of every set (``block`` columns, ``title``, ``tags``, ``rare``)."""
    keys = _smaller_keys(F.col("rare")) if smaller else _larger_keys(F.col("rare"))
    return sets.select(*block, F.explode(keys).alias("key"), "title", F.size("tags").alias("size"), signature(F.col("tags")).alias("bits"), "tags")


def items(small: DataFrame, large: DataFrame, block: list[str], item: int = ITEM) -> DataFrame:
    """Per entry that both sides have: its sets ``ns`` and ``nl`` and the blocks ``cs`` and ``cl`` that they are cut into."""
    entry = [*block, "key"]
    count = lambda df, name: df.groupBy(*entry).agg(F.count(F.lit(1)).alias(name))
    both = count(small, "ns").join(count(large, "nl"), entry)
    return both.withColumns({"cs": F.ceil(F.col("ns") / item), "cl": F.ceil(F.col("nl") / item)})


def candidates(small: DataFrame, large: DataFrame, block: list[str], item: int = ITEM) -> DataFrame:
    """Filed sets that share an entry and pass lengths and signatures: ``block``, ``small``, ``large`` (titles) and their words.

    Each pair of sets meets once: a larger set is filed either under pairs or under single words.
    """
    entry = [*block, "key"]
    hot = items(small, large, block, item).filter("cs > 1 OR cl > 1").select(*entry, "cs", "cl")

    def dealt(df: DataFrame, name: str, cut: str, other: str) -> DataFrame:
        sized = df.join(hot, entry, "left").withColumns({"cs": F.coalesce("cs", F.lit(1)), "cl": F.coalesce("cl", F.lit(1))})
        own = F.pmod(F.xxhash64("title"), F.col(cut)).alias(f"of_{cut}")
        turns = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(f"of_{other}")
        return sized.select(*entry, own, turns, *[F.col(c).alias(f"{name}_{c}") for c in ("title", "size", "bits", "tags")])

    met = dealt(small, "small", "cs", "cl").join(dealt(large, "large", "cl", "cs"), [*entry, "of_cs", "of_cl"])
    fits = (F.col("small_size") <= F.col("large_size")) & (F.col("small_bits").bitwiseAND(F.bitwise_not("large_bits")) == 0)
    return met.filter(fits).select(*block, F.col("small_title").alias("small"), "small_tags", F.col("large_title").alias("large"), "large_tags")
