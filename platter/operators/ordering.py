"""Exact ranks of all rows, and partitions that lie in order: no global window, no checkpoint.

A range shuffle takes its borders from a random sample, so partitions hold unknown numbers of rows and may
differ when a lost one is computed again. Here borders are values: candidates are drawn by hash, rows
between them are counted exactly, and neighbours are joined to parts of at most ``most`` rows. A row's part
follows from the row alone, and its rank is the part's offset plus its place inside.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Candidates for borders that are drawn for each part; below ``LEAST`` rows one part is enough.
PER_PART, LEAST = 8, 10_000


@dataclass(frozen=True)
class Parts:
    """Borders as one JSON array of keys, the number of parts and the rows before each; ``schema`` is that of the array."""

    borders: str
    schema: str
    offsets: tuple[int, ...]
    largest: int


def sort_key(order: list[str]) -> Column:
    """A struct that compares as the columns ascending, nulls last."""
    return F.struct(*[c for k, name in enumerate(order) for c in (F.col(name).isNull().alias(f"n{k}"), F.col(name).alias(f"v{k}"))])


def _placed(df: DataFrame, key: Column, borders: str, schema: str, name: str) -> DataFrame:
    """``df`` with ``name``: how many borders are at or below the key, by bisection.

    The array of borders is a scalar subquery, so it is parsed and sorted once a query, not once a row. Every step of the
    bisection is a column of its own, which Spark compiles; a lambda over the steps would be interpreted row by row.
    """
    steps = [1 << k for k in reversed(range(len(json.loads(borders)).bit_length()))]
    if not steps:
        return df.withColumn(name, F.lit(0))
    parsed = df.sparkSession.range(1).select(F.array_sort(F.from_json(F.lit(borders), schema)).alias("b")).scalar()
    placed = df.withColumns({"__borders": parsed, "__at": key, name: F.lit(0)})
    for step in steps:
        below = F.get("__borders", F.col(name) + F.lit(step - 1)) <= F.col("__at")
        placed = placed.withColumn(name, F.col(name) + F.when(below, step).otherwise(0))
    return placed.drop("__borders", "__at")


def exact_parts(df: DataFrame, order: list[str], parts: int | None = None, least: int = LEAST) -> Parts:
    """Parts of about even sizes, whose rows are counted: none over ``max(least, 2 * rows / parts)``, unless one key alone has more.

    ``parts`` defaults to the session's shuffle partitions. About ``PER_PART`` keys and numbers a part reach
    the driver, whatever the rows. ``order`` should be unique: rows of equal keys can't be parted.
    """
    spark = df.sparkSession
    keyed = df.select(sort_key(order).alias("key"))
    schema = f"array<{keyed.schema['key'].dataType.simpleString()}>"
    total = keyed.count()
    most = max(least, -(-2 * total // max(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), 1)))
    borders: set[str] = set()
    counts, heavy, factor = {0: total}, [0] if total > most else [], 1
    while heavy:
        text = "[" + ",".join(sorted(borders)) + "]"
        share = min(1.0, factor * 2 * PER_PART / most)
        drawn = keyed.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 40)) < int(share * (1 << 40)))
        if borders:
            drawn = _placed(drawn, F.col("key"), text, schema, "i").filter(F.col("i").isin(heavy))
        fresh = {r[0] for r in drawn.select(F.to_json("key")).distinct().collect()} - borders
        if not fresh and share >= 1:
            break
        borders |= fresh
        factor *= 1 if fresh else 16
        text = "[" + ",".join(sorted(borders)) + "]"
        placed = _placed(keyed, F.col("key"), text, schema, "i")
        counts = {r["i"]: r["n"] for r in placed.groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}
        heavy = [i for i, n in counts.items() if n > most]
        if heavy:  # an interval of one key can't be parted; keys as aggregates are sorted for, so only these rows are asked
            several = placed.filter(F.col("i").isin(heavy)).groupBy("i").agg((F.min("key") < F.max("key")).alias("several"))
            heavy = [r["i"] for r in several.filter("several").collect()]
    return _joined(df, borders, schema, counts, most)


def _joined(df: DataFrame, borders: set[str], schema: str, counts: dict[int, int], most: int) -> Parts:
    """Join neighbouring intervals while they hold at most ``most`` rows; the borders between parts stay."""
    spark = df.sparkSession
    text = "[" + ",".join(borders) + "]"
    ordered = spark.range(1).select(F.transform(F.array_sort(F.from_json(F.lit(text), schema)), lambda key: F.to_json(key)).alias("b")).first()["b"] if borders else []
    kept, sizes = [], [0]
    for i in range(len(ordered) + 1):
        n = counts.get(i, 0)
        if sizes[-1] and sizes[-1] + n > most:
            kept.append(ordered[i - 1])
            sizes.append(0)
        sizes[-1] += n
    offsets, before = [], 0
    for n in sizes:
        offsets.append(before)
        before += n
    return Parts("[" + ",".join(kept) + "]", schema, tuple(offsets), max(sizes))


def in_parts(df: DataFrame, order: list[str], plan: Parts) -> DataFrame:
    """The rows with ``__part``, each part a partition of its number, sorted by ``order`` (nulls last)."""
    placed = _placed(df, sort_key(order), plan.borders, plan.schema, "__part")
    return placed.repartitionById(len(plan.offsets), "__part").sortWithinPartitions(*[F.asc_nulls_last(c) for c in order])


def numbered(df: DataFrame, order: list[str], name: str = "ordinal", parts: int | None = None, least: int = LEAST) -> DataFrame:
    """All rows with their exact rank from 0 in ``order`` (ascending, nulls last; rows of equal keys in any order).

    One shuffle; ``df`` is read once more to draw borders and once to count, so it must yield the same rows each
    time (a table, or a checkpoint of what is dear to compute). An empty input stays empty.
    """
    plan = exact_parts(df, order, parts, least)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    offsets = df.sparkSession.range(1).select(F.from_json(F.lit(json.dumps(plan.offsets)), "array<long>").alias("o")).scalar()
    local = in_parts(df, order, plan).withColumn("__row", row).withColumn("__offsets", offsets)
    return local.withColumn(name, F.get("__offsets", F.col("__part")) + F.col("__row")).drop("__part", "__row", "__offsets")


def order_breaks(rows: DataFrame, order: list[str], ordinal: str = "ordinal") -> DataFrame:
    """One row, ``breaks``: how many rows stand before a smaller one, or miss their successor, when read by ``ordinal`` (unique, from 0).

    Each row meets the next one by number, so no row needs a window over all.
    """
    key = sort_key(order)
    mine = rows.select(F.col(ordinal).alias("o"), key.alias("k"))
    previous = rows.select((F.col(ordinal) + 1).alias("o"), key.alias("p"))
    met = mine.join(previous, "o", "full")
    wrong = F.col("k").isNotNull() & (F.col("o") > 0) & (F.col("p").isNull() | (F.col("p") > F.col("k")))
    ends = F.col("k").isNull()
    return met.agg((F.count_if(wrong) + F.greatest(F.count_if(ends) - 1, F.lit(0))).alias("breaks"))
