"""Exact ranks, files in order, capture files, and extraction from SQL."""

import random
import time
import uuid

import pytest
from pyspark.sql import functions as F

from platter.operators import ordering
from platter.operators.steps import shared_folder
from platter.sources import readers, sinks


def by_rank(rows):
    """Plain order: nulls last in every column."""
    return sorted(rows, key=lambda r: tuple((v is None, "" if v is None else v) for v in r))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    days = [None, "1999-01-01", "2001-05-05", *[f"2000-{m:02d}-01" for m in range(1, 13)]]
    made = [(rng.choice(days) if k % 3 else "2000-06-06", rng.choice(["A", "É", "z中", None, ""]), k) for k in range(6000)]  # a third of all rows on one day
    rng.shuffle(made)
    return made


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "d string, a string, id long").withColumn("__part", F.lit("clash")).withColumn("__row", F.lit(1)).repartition(7)


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_ranks_are_exact(table, rows, parts):
    df = table.drop("__part", "__row")
    plan = ordering.exact_parts(df, ["d", "a", "id"], parts, least=1)
    sizes = [b - a for a, b in zip(plan.offsets, [*plan.offsets[1:], len(rows)])]
    assert max(sizes) == plan.largest <= -(-2 * len(rows) // parts) and min(sizes) > 0
    assert len(sizes) <= parts + 1 and (parts < 3 or len(sizes) > parts / 3)
    found = ordering.numbered(df, ["d", "a", "id"], parts=parts, least=1)
    assert [(r["d"], r["a"], r["id"]) for r in sorted(found.collect(), key=lambda r: r["ordinal"])] == by_rank(rows)
    assert sorted(r["ordinal"] for r in found.collect()) == list(range(len(rows)))
    assert ordering.order_breaks(found, ["d", "a", "id"]).first()["breaks"] == 0
    assert ordering.order_breaks(found, ["id"]).first()["breaks"] > 0


def test_ranks_of_odd_tables(spark):
    same = spark.createDataFrame([("x", 1)] * 500 + [("y", 2), (None, 3)], "k string, v int")
    found = ordering.numbered(same, ["k"], parts=8, least=1)
    assert sorted((r["ordinal"], r["k"]) for r in found.collect())[499:] == [(499, "x"), (500, "y"), (501, None)]
    assert ordering.numbered(same.limit(0), ["k"]).count() == 0
    numbers = spark.createDataFrame([(float("nan"),), (None,), (float("-inf"),), (0.1,), (0.1 + 1e-16,)] * 40, "v double")
    got = [r["v"] for r in sorted(ordering.numbered(numbers, ["v"], parts=9, least=1).collect(), key=lambda r: r["ordinal"])]
    assert got[:40] == [float("-inf")] * 40 and got[-40:] == [None] * 40 and all(v != v for v in got[120:160])


def test_ranks_need_no_window_and_one_shuffle(table):
    plan = ordering.numbered(table.drop("__part", "__row"), ["d", "id"], parts=4, least=1)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Repartition") == 2  # the input's own, and the one by part


def test_many_borders_are_parsed_once(spark):
    """Hundreds of borders cost a row a bisection; were they parsed for each row, this would take minutes."""
    df = spark.range(200_000).select(F.xxhash64("id").alias("v"))
    start = time.time()
    found = ordering.numbered(df, ["v"], parts=400, least=1)
    got = found.agg(F.count_distinct("ordinal").alias("n"), F.max("ordinal").alias("m")).first()
    assert (got["n"], got["m"]) == (200_000, 199_999)
    assert time.time() - start < 60


def test_lines_read_back_in_order(spark, table, rows, tmp_path):
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    df = table.drop("__part", "__row")
    line = F.when(F.col("id") == 5, F.lit("two\nlines")).when(F.col("id") == 6, F.lit(None).cast("string")).otherwise(F.col("id").cast("string"))
    sinks.write_ordered(df, ["d", "a", "id"], path, line, parts=6, least=1)
    assert spark.read.text(path).select(F.col("_metadata.file_name")).distinct().count() > 2
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")  # files are split
    try:
        found = readers.read_ordered(spark, path)
        got = sorted(tuple(r) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = [{5: "two lines", 6: ""}.get(r[2], str(r[2])) for r in by_rank(rows)]
    assert got == list(enumerate(want))
    first = sorted(p for p in tmp_path.rglob("part-*.txt"))[1]
    first.rename(first.with_name("_gone"))
    with pytest.raises(ValueError, match="missing"):
        readers.read_ordered(spark, path)


def test_ordered_lines_compute_their_rows_once(spark, tmp_path):
    """What is dear to compute is not computed again for drawing, counting and placing."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(3000).select(F.concat(F.lit("a"), (F.col("id") % 7).cast("string")).alias("artist"), F.lit("x").alias("album"), "id")
    sinks.write_ordered(rows.mapInArrow(count, rows.schema), ["artist", "id"], f"{tmp_path}/once", parts=5, least=1)
    assert seen.value == 3000
    got = [r["value"] for r in readers.read_ordered(spark, f"{tmp_path}/once").orderBy("ordinal").collect()]
    assert got == sorted(got) and len(got) == 3000


def test_capture_files(spark, tmp_path):
    pages = [("1_a.html", "café €", "cp1252"), ("2_b.html.gz", "中" * 1000, None), ("3_c.html", None, "utf-8"), ("4_d.html", "中", "cp1252")]
    sinks.write_captures(spark.createDataFrame(pages, "capture_file string, html string, encoding string"), str(tmp_path / "c"))
    got = {r["capture_file"]: (r["timestamp"], r["html"]) for r in readers.read_captures(spark, str(tmp_path / "c")).collect()}
    assert got == {"1_a.html": ("1", "café €"), "2_b.html.gz": ("2", "中" * 1000), "4_d.html": ("4", "?")}


class Session:
    """The settings that a session tells of."""

    def __init__(self, master, given=None, **conf):
        self.sparkContext, self.conf = self, conf
        self.master, self.getCheckpointDir = master, lambda: given


def test_shared_folder():
    kept = {"spark.sql.warehouse.dir": "/w"}
    assert shared_folder(Session("spark://m", "s://given/id", **kept)) == "s://given/id"
    assert shared_folder(Session("spark://m", "s://given/id", **kept, **{"spark.checkpoint.dir": "s://set/"})) == "s://set"
    assert shared_folder(Session("local[4]", **kept)) == "/w/_checkpoints"
    with pytest.raises(ValueError, match="share"):
        shared_folder(Session("yarn", **kept))
