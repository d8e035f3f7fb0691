"""Operators that exist for large inputs: exact quantiles, filtered joins, clustered stores, counters of one pass."""

import math
import random
import uuid

import pytest
from pyspark.sql import functions as F

from platter.operators import membership, quantiles, reviews, stats
from platter.sources import store


def expected(values, p):
    """A quantile by its definition; NaN is the largest number."""
    ordered = sorted(values, key=lambda x: (math.isnan(x), x))
    at = p * (len(ordered) - 1)
    low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
    return low if low == high else low + (high - low) * (at - math.floor(at))


@pytest.fixture(scope="module")
def measured(spark):
    rng = random.Random(5)
    rows = [("hot", rng.gauss(0, 1000)) for _ in range(6000)]
    rows += [("hot", 7.0)] * 1500 + [("ties", 3.0)] * 2500 + [("ties", 4.0)] * 10 + [("one", -1.5)]
    rows += [(None, float(k)) for k in range(11)] + [("hot", None), ("none", None), ("odd", float("nan")), ("odd", 1.0), ("odd", math.inf)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, v double").repartition(4).withColumn("__x", F.lit("clash"))


WANTED = [0.0, 0.01, 0.25, 0.5, 0.999, 1.0]


@pytest.mark.parametrize("most", [50, 100_000])
def test_quantiles(measured, most):
    rows, df = measured
    found = {r["k"]: r for r in quantiles.exact_quantiles(df, ["k"], "v", WANTED, accuracy=400, most=most).collect()}
    groups = {k: [v for key, v in rows if key == k and v is not None] for k in {k for k, _ in rows}}
    assert set(found) == {k for k, v in groups.items() if v}
    for k, r in found.items():
        assert r["n"] == len(groups[k])
        for p, q in zip(WANTED, r["quantiles"], strict=True):
            want = expected(groups[k], p)
            assert math.isnan(q) and math.isnan(want) or q == pytest.approx(want, rel=1e-12), (k, p)


def test_brackets_are_small_and_hold_their_rank(measured):
    rows, df = measured
    hot = sorted(v for k, v in rows if k == "hot" and v is not None)
    found = {r["__k0"]: r for r in quantiles.quantile_brackets(df, ["k"], "v", WANTED, accuracy=4000, most=50).collect()}
    for p, b in zip(WANTED, found["hot"]["__b"], strict=True):
        assert b["below"] == sum(v < b["low"] for v in hot) and b["inside"] == sum(b["low"] <= v <= b["high"] for v in hot)
        assert b["below"] <= math.floor(p * (len(hot) - 1)) and math.ceil(p * (len(hot) - 1)) < b["below"] + b["inside"]
        assert b["inside"] <= 50 or b["low"] == b["high"] or b["low"] <= 7.0 <= b["high"]  # 1,500 ties lie at 7


def test_quantiles_without_keys_or_rows(measured):
    rows, df = measured
    all_values = [v for _, v in rows if v is not None]
    found = quantiles.exact_quantiles(df, [], "v", [0.5], most=100).collect()
    assert [(r["n"], r["quantiles"]) for r in found] == [(len(all_values), [pytest.approx(expected(all_values, 0.5))])]
    assert quantiles.exact_quantiles(df.limit(0), ["k"], "v", [0.5]).collect() == []


def test_statistics_by_brackets_equal_those_by_buffers(measured):
    rows = measured[1].filter("k IN ('hot', 'ties', 'one')").drop("__x").withColumn("genres", F.col("k"))
    plain, bracketed = (stats.score_stats_by(rows, "k", "v", many_values=m).orderBy("k").collect() for m in (False, True))
    assert [tuple(r) for r in plain] == [pytest.approx(tuple(r)) for r in bracketed]
    plain, bracketed = (stats.box_stats(rows, "v", many_values=m).orderBy("value").collect() for m in (False, True))
    assert [tuple(r) for r in plain] == [pytest.approx(tuple(r)) for r in bracketed]


def test_box_statistics_read_their_rows_once(spark):
    """Quantiles pass over the rows several times, but compute them once; rows of few bytes are not broadcast to the brackets."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(30_000).select(F.concat_ws("; ", F.concat(F.lit("g"), (F.col("id") % 3).cast("string")), F.lit("all")).alias("genres"), (F.col("id") * 7919 % 30_011).cast("double").alias("v"))
    found = stats.box_stats(rows.mapInArrow(count, rows.schema), "v", many_values=True)
    got = {r["value"]: r for r in found.collect()}
    assert seen.value == 30_000
    every = [float(k * 7919 % 30_011) for k in range(30_000)]
    assert [got["all"][c] for c in ("q1", "median", "q3", "whisker_low", "whisker_high")] == [pytest.approx(x) for x in (*[expected(every, p) for p in (0.25, 0.5, 0.75)], min(every), max(every))]
    side = spark.range(3).select(F.col("id").alias("__k0"), F.lit(1).alias("__n"), F.array(F.lit(1.0)).alias("__b"))
    joined = plan(quantiles._beside(spark.range(5).select(F.col("id").alias("__k0"), F.lit(1.0).alias("__x")), side, ["__k0"]))
    assert "BuildRight" in joined and "BuildLeft" not in joined


@pytest.fixture(scope="module")
def strangers(spark):
    hot = spark.range(3000).select(F.lit(5).cast("long").alias("a"), F.lit("x").alias("b"), F.col("id").alias("__block"))
    many = spark.range(20_000).select(F.col("id").alias("a"), F.when(F.col("id") % 50 != 0, F.lit("x")).alias("b"), F.col("id").alias("__block"))
    keys = spark.range(0, 40_000, 20).select(F.col("id").alias("a"), F.when(F.col("id") % 40 != 0, F.lit("x")).alias("b"), F.lit(1).alias("extra"))
    return hot.unionByName(many), keys.unionByName(keys)


@pytest.mark.parametrize("most", [1 << 20, 1])
def test_filtered_joins_equal_plain_ones(strangers, most):
    rows, keys = strangers
    for joined, how in ((membership.semi_join, "left_semi"), (membership.anti_join, "left_anti")):
        ours = joined(rows, keys, ["a", "b"], most)
        assert ours.columns == rows.columns
        theirs = rows.join(keys.select("a", "b"), ["a", "b"], how).select(rows.columns)
        assert sorted(map(repr, ours.collect())) == sorted(map(repr, theirs.collect()))


def test_filter_turns_strangers_away(strangers):
    rows, keys = strangers
    load = membership.filter_load(rows, keys, ["a", "b"]).first()
    assert load["rows"] == 23_000 and load["known"] <= load["shuffled"] <= load["known"] + 230  # 1 % of the rows
    unfiltered = membership.filter_load(rows, keys, ["a", "b"], 1).first()
    assert unfiltered["shuffled"] == 23_000 and unfiltered["known"] == load["known"]


def test_filtered_joins_of_empty_tables(strangers):
    rows, keys = strangers
    assert membership.anti_join(rows, keys.limit(0), ["a", "b"]).count() == 23_000
    assert membership.semi_join(rows, keys.limit(0), ["a", "b"]).count() == 0
    assert membership.anti_join(rows.limit(0), keys, ["a", "b"]).count() == 0


@pytest.fixture(scope="module")
def stores(spark):
    def rows(many, salt):
        hot = spark.range(many).select(F.lit("hot").alias("_key"), F.col("id"))
        nothing = spark.range(many // 2).select(F.lit(None).cast("string").alias("_key"), (F.col("id") + 10**6).alias("id"))
        rest = spark.range(many).select(F.concat(F.lit("k"), ((F.col("id") * salt) % 700).cast("string")).alias("_key"), (F.col("id") + 2 * 10**6).alias("id"))
        one = hot.unionByName(nothing).unionByName(rest)
        return one.select("_key", "id", (F.col("id") % 9).cast("double").alias("score"), F.lit("2001-01-01").alias("review_date"))

    made = {}
    for name, df in (("mine", rows(2000, 3)), ("theirs", rows(1500, 14)), ("empty", rows(10, 1).limit(0))):
        made[name] = (f"{name}_{uuid.uuid4().hex}", df)
        store.write_clustered(df, made[name][0], 8)
    return made


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_store_needs_no_exchange(spark, stores):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        mine, theirs = (store.clustered(spark, stores[n][0])[0] for n in ("mine", "theirs"))
        for df in (reviews.dedupe_albums(mine), mine.join(theirs.select("_key"), "_key", "left_anti"), mine.join(theirs.select("_key"), "_key", "left_semi")):
            assert "Exchange hashpartitioning" not in plan(df)
        assert "Exchange hashpartitioning" in plan(reviews.dedupe_albums(stores["mine"][1]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_store_keeps_rows_and_sets_hot_keys_apart(spark, stores):
    table, df = stores["mine"]
    even, hot = store.clustered(spark, table)
    assert {r[0] for r in hot.select("_key").distinct().collect()} == {"hot"}
    assert even.count() + hot.count() == df.count()
    ours = store.per_key(spark, table, reviews.dedupe_albums).select(df.columns).collect()
    assert sorted(map(repr, ours)) == sorted(map(repr, reviews.dedupe_albums(df).select(df.columns).collect()))


@pytest.mark.parametrize("one, other", [("mine", "theirs"), ("theirs", "mine"), ("mine", "empty"), ("empty", "mine")])
def test_store_against_store(spark, stores, one, other):
    ours = store.absent(spark, stores[one][0], stores[other][0]).select("id").collect()
    theirs = stores[one][1].join(stores[other][1].select("_key"), "_key", "left_anti").select("id").collect()
    assert sorted(r[0] for r in ours) == sorted(r[0] for r in theirs)


def test_counters_of_the_pass_that_writes(spark, tmp_path):
    df = spark.createDataFrame([(1, "Rock", False), (2, "Jazz", True), (3, None, False), (4, " ", False)], "id int, genres string, filled boolean")
    counted = reviews.write_filled(df, str(tmp_path / "out")).first().asDict()
    assert counted == reviews.fill_counters(df).first().asDict() == {"missing": 3, "filled": 1, "unresolved": 2}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    assert reviews.write_filled(df.limit(0), str(tmp_path / "none")).first().asDict() == {"missing": 0, "filled": 0, "unresolved": 0}


@pytest.mark.parametrize("name", ["clustered_dedupe", "clustered_new"])
def test_stores_compute_their_rows_once(spark, monkeypatch, name):
    """Counting hot keys, writing them apart and writing the buckets compute the chain of joins once, for all stores together."""
    from platter.plans import queries, views

    seen, plain = spark.sparkContext.accumulator(0), views.reviews

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def counted(*args, **kwargs):
        rows = plain(*args, **kwargs)
        return rows.mapInArrow(count, rows.schema)

    folder = "/root/testdata/sf0.001"
    total = plain(spark, folder).count()
    monkeypatch.setattr(views, "reviews", counted)
    assert queries.QUERIES[name](spark, folder).count() > 0
    assert seen.value == total


def test_buckets_grow_with_the_rows():
    assert [store.buckets_for(n) for n in (0, 1, 1 << 24, (1 << 24) + 1, 216_000_000)] == [16, 16, 16, 32, 256]
