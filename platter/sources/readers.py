"""Readers of the library's inputs."""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from platter.functions.text import decode_bytes
from platter.schemas import ENRICHMENT, RAW_REVIEW, REVIEW
from platter.sources.members import SPLIT_BYTES, capture_index, json_members


def read_reviews_json(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Raw reviews: JSON arrays of objects with optional fields, a file read by a task per ``split_bytes``."""
    rows = json_members(spark, path, split_bytes)
    return rows.select(F.from_json("value", RAW_REVIEW).alias("r")).filter("r IS NOT NULL").select("r.*")


def read_enrichment_json(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """JSON objects keyed by address as rows ``url, country, language, mbid``, a file read by a task per ``split_bytes``."""
    rows = json_members(spark, path, split_bytes)
    return rows.select(F.explode(F.from_json("value", ENRICHMENT)).alias("url", "v")).select("url", "v.*")


def read_reviews_tsv(spark: SparkSession, path: str) -> DataFrame:
    """The review table with a header; years written as decimals are read as integers, 'NA' stays a country."""
    years = ("review_year", "release_year", "original_year")
    schema = REVIEW
    for year in years:
        schema = schema.replace(f"{year} int", f"{year} double")
    raw = spark.read.csv(path, sep="\t", header=True, quote='"', escape='"', multiLine=True, schema=schema)
    return raw.withColumns({year: F.col(year).cast("int") for year in years})


def latest_snapshot(df: DataFrame, date_col: str = "snapshot_date", kind: str | None = None, kind_col: str = "kind") -> DataFrame:
    """The rows of the latest snapshot, of one kind if asked for; the partition column prunes the scan."""
    chosen = df if kind is None else df.filter(F.col(kind_col) == kind)
    return chosen.filter(F.col(date_col) == chosen.agg(F.max(date_col).alias("latest")).scalar())


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages, gzipped or not, as ``capture_file, timestamp, html``; the timestamp is the name up to '_'."""
    @F.arrow_udf(T.BinaryType())
    def unzipped(blobs: pa.Array) -> pa.Array:
        raw = blobs.to_pylist()
        return pa.array([gzip.decompress(b) if b is not None and b[:2] == b"\x1f\x8b" else b for b in raw], pa.binary())

    name = F.substring_index("path", "/", -1)
    files = spark.read.format("binaryFile").load(path).select(name.alias("capture_file"), "content")
    return files.select("capture_file", F.substring_index("capture_file", "_", 1).alias("timestamp"), decode_bytes(unzipped("content")).alias("html"))


def read_capture_index(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A capture index (array of arrays with a header row) as named string columns, by byte ranges."""
    return capture_index(spark, path, split_bytes)


def read_candidates(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Candidates, ground truth, tags or stored matches as JSON, with an explicit schema."""
    return spark.read.schema(schema).json(path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """Lines of ``write_ordered`` as ``ordinal`` (from 0, over all files) and ``value``.

    Files are split as usual; a first pass counts the lines of each split, and only these counts reach the driver.
    A part that is missing between others, or there twice, is an error.
    """
    raw = spark.read.text(path, lineSep="\n")
    lines = raw.select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"))
    number = F.regexp_extract("file", "^part-([0-9]+)", 1).cast("long")
    splits = lines.groupBy("file", "start").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).withColumn("part", number)
    found = sorted(splits.collect(), key=lambda r: (r["part"], r["file"], r["start"]))
    files = sorted({(r["part"], r["file"]) for r in found})
    if [part for part, _ in files] != list(range(len(files))):
        raise ValueError(f"parts of {path} are missing or doubled: {len(files)} files, numbers {[p for p, _ in files][:5]} to {files[-1][0]}")
    shifts, before = [], 0
    for r in found:
        shifts.append((r["file"], r["start"], before - r["first"]))
        before += r["n"]
    side = F.broadcast(spark.createDataFrame(shifts, "file string, start long, shift long"))
    return lines.join(side, ["file", "start"]).select((F.col("id") + F.col("shift")).alias("ordinal"), "value")
