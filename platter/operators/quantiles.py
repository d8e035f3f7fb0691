"""Exact quantiles of columns with many distinct values: a sketch brackets each rank, counting settles it."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from platter.operators.steps import settled

#: Ranges that a round has narrowed may hold so many rows: their values are shuffled, which costs less than another reading of all rows.
NARROWED = 1 << 20
#: Keys whose brackets are broadcast: some MB.
FEW_KEYS = 20_000


def _keyed(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The rows with a value, under names that clash with no column: ``__k0``…, ``__x``."""
    named = [F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)] or [F.lit(0).alias("__k0")]
    return df.select(*named, F.col(value).cast("double").alias("__x")).filter("__x IS NOT NULL")


def _beside(rows: DataFrame, brackets: DataFrame, names: list[str]) -> DataFrame:
    """Every row with its key's brackets (settled ones); null keys meet.

    Brackets of few keys are broadcast. Those of many are not, and neither are the rows: as a Parquet table, rows of few
    bytes may be so many that they are the larger side all the same.
    """
    side = brackets.select(*[F.col(n).alias(f"{n}b") for n in names], "__n", "__b")
    side = F.broadcast(side) if brackets.count() <= FEW_KEYS else side.hint("merge")
    on = F.lit(True)
    for n in names:
        on = on & F.col(n).eqNullSafe(F.col(f"{n}b"))
    return rows.join(side, on).drop(*[f"{n}b" for n in names])


def _rank(p: float) -> Column:
    return F.lit(float(p)) * (F.col("__n") - 1)


def quantile_brackets(
    df: DataFrame, keys: list[str], value: str, probabilities: list[float], accuracy: int = 10_000, most: int = 10_000, rounds: int = 8, narrowed: int = 0
) -> DataFrame:
    """Per key: ``__n`` rows and, per probability, a range of values ``low..high`` that holds its rank.

    Once a round has narrowed the ranges, they may hold ``narrowed`` rows instead of ``most``.

    Every element of ``__b`` has ``low``, ``high``, ``below`` (rows less than ``low``) and ``inside`` (rows within the
    range). A round takes two ranks around the wanted one from a mergeable sketch of the rows that are still
    inside (``percentile_approx``, rank error ``inside / accuracy``), counts the rows below and inside, and keeps
    the narrower range only if the counts prove that the rank is in it. Rounds end once no range of two values or more
    holds more than ``most`` rows, or none gets smaller: ``rounds`` bounds work, never the result's exactness. Each
    divides the rows inside by about ``accuracy / 40``, so three rounds serve 10^12 rows a key. The input is read
    once, and twice more a round: settle one that is dear.
    """
    names = [f"__k{i}" for i in range(max(1, len(keys)))]
    rows = _keyed(df, keys, value)
    parts = range(len(probabilities))
    whole = F.array(*[F.struct(F.col("__low").alias("low"), F.col("__high").alias("high"), F.lit(0).cast("long").alias("below"), F.col("__n").alias("inside")) for _ in parts])
    first = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"), F.min("__x").alias("__low"), F.max("__x").alias("__high"))
    found = settled(first.select(*names, "__n", whole.alias("__b")))
    left = None
    for _ in range(rounds):
        open_rows = F.aggregate("__b", F.lit(0).cast("long"), lambda a, b: F.greatest(a, F.when(b["low"] < b["high"], b["inside"]).otherwise(0)))
        largest = found.agg(F.max(open_rows)).first()[0] or 0
        if largest <= (most if left is None else max(most, narrowed)) or (left is not None and largest >= left):
            break
        found = settled(_narrowed(rows, found, names, probabilities, accuracy, whole=left is None))
        left = largest
    return found


def _narrowed(rows: DataFrame, found: DataFrame, names: list[str], probabilities: list[float], accuracy: int, whole: bool) -> DataFrame:
    """``found`` with narrower ranges; ``whole`` says that all of a key's ranges still are its whole range, so one sketch serves them."""
    parts = range(len(probabilities))
    joined = _beside(rows, found, names)
    inside = [F.col("__x").between(F.col("__b")[j]["low"], F.col("__b")[j]["high"]) for j in parts]
    # The wanted rank within a range differs by key, so the sketch gives a grid of ranks, and the key picks from it.
    steps = max(8, accuracy // 8)
    grid = [k / steps for k in range(steps + 1)]
    wanted = [F.col("__x")] if whole else [F.when(inside[j], F.col("__x")) for j in parts]
    sketches = [F.percentile_approx(x, grid, F.lit(accuracy)).alias(f"__s{j}") for j, x in enumerate(wanted)]
    sketched = joined.groupBy(*names, "__n", "__b").agg(*sketches)
    ranges = []
    for j, p in enumerate(probabilities):
        old, sketch = F.col("__b")[j], "__s0" if whole else f"__s{j}"
        at = (_rank(p) - old["below"]) / old["inside"] * steps
        low = F.get(sketch, F.greatest(F.floor(at) - 2, F.lit(0)).cast("int"))
        high = F.get(sketch, F.least(F.ceil(at) + 2, F.lit(steps)).cast("int"))
        ranges.append(F.struct(F.when(at >= 3, low).otherwise(old["low"]).alias("low"), F.when(at <= steps - 3, high).otherwise(old["high"]).alias("high")))
    tried = settled(sketched.select(*names, "__n", F.col("__b").alias("__old"), F.array(*ranges).alias("__b")))
    counted = _beside(rows, tried, names).groupBy(*names).agg(
        *[F.count_if(F.col("__x") < F.col("__b")[j]["low"]).alias(f"__l{j}") for j in parts],
        *[F.count_if(F.col("__x").between(F.col("__b")[j]["low"], F.col("__b")[j]["high"])).alias(f"__i{j}") for j in parts],
    )
    same = F.lit(True)
    for n in names:
        same = same & F.col(f"{n}b").eqNullSafe(F.col(n))
    counted = counted.select(*[F.col(n).alias(f"{n}b") for n in names], *[f"__l{j}" for j in parts], *[f"__i{j}" for j in parts])
    both = tried.join(counted, same)
    kept = []
    for j, p in enumerate(probabilities):
        new = F.struct(F.col("__b")[j]["low"].alias("low"), F.col("__b")[j]["high"].alias("high"), F.col(f"__l{j}").alias("below"), F.col(f"__i{j}").alias("inside"))
        proven = (F.col(f"__l{j}") <= F.floor(_rank(p))) & (F.ceil(_rank(p)) < F.col(f"__l{j}") + F.col(f"__i{j}"))
        kept.append(F.when(proven, new).otherwise(F.col("__old")[j]))
    return both.select(*names, "__n", F.array(*kept).alias("__b"))


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probabilities: list[float], accuracy: int = 10_000, most: int = 10_000
) -> DataFrame:
    """Quantiles of ``value`` per key with linear interpolation: the keys, ``n`` and an array ``quantiles``.

    Equal to ``percentile``, which holds every distinct value of a group in one buffer; here a group holds a sketch,
    and only rows inside a rank's bracket are shuffled, as counted values. Null values don't count, NaN is the largest
    number, a key without values has no row, null keys are a group, ``keys`` may be empty (one row, none for no rows).
    """
    names = [f"__k{i}" for i in range(max(1, len(keys)))]
    parts = range(len(probabilities))
    found = quantile_brackets(df, keys, value, probabilities, accuracy, most, narrowed=NARROWED)
    within = [F.col("__x").between(F.col("__b")[j]["low"], F.col("__b")[j]["high"]) for j in parts]
    joined = _beside(_keyed(df, keys, value), found, names).filter(reduce(or_, within, F.lit(False)))  # few rows are listed by range
    hits = F.filter(F.array(*[F.when(w, F.lit(j)) for j, w in enumerate(within)]), lambda j: j.isNotNull())
    rank = F.element_at(F.array(*[_rank(p) for p in probabilities]), F.col("__j") + 1)
    inside = joined.select(*names, "__n", "__x", "__b", F.explode(hits).alias("__j"))
    inside = inside.select(*names, "__n", "__x", "__j", F.get("__b", F.col("__j"))["below"].alias("__below"))
    counts = inside.groupBy(*names, "__n", "__j", "__below", "__x").agg(F.count(F.lit(1)).alias("__c"))
    upwards = Window.partitionBy(*names, "__j").orderBy("__x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = F.sum("__c").over(upwards)
    ranked = counts.select(*names, "__n", "__j", "__x", rank.alias("__r"), (F.col("__below") + running).alias("__upto"))
    ends = ranked.groupBy(*names, "__n", "__j", "__r").agg(
        F.min(F.when(F.col("__upto") > F.floor("__r"), F.col("__x"))).alias("__low"),
        F.min(F.when(F.col("__upto") > F.ceil("__r"), F.col("__x"))).alias("__high"),
    )
    share = F.col("__r") - F.floor("__r")
    between = F.when(F.col("__low") == F.col("__high"), F.col("__low")).otherwise(F.col("__low") * (1 - share) + F.col("__high") * share)
    gathered = ends.groupBy(*names, "__n").agg(F.array_sort(F.collect_list(F.struct("__j", between.alias("q")))).alias("__q"))
    named = [F.col(n).alias(k) for n, k in zip(names, keys)]
    return gathered.select(*named, F.col("__n").alias("n"), F.transform("__q", lambda s: s["q"]).alias("quantiles"))

