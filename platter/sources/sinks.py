"""Writers of the library's outputs."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platter.operators.ordering import LEAST, exact_parts, in_parts
from platter.operators.steps import byte_slices, stored
from platter.sources.members import located

EXPORT_COLUMNS = [
    "score", "artist", "album", "release_year", "review_date", "genre", "reviewer", "country", "bnm", "bnr", "url",
]


def write_snapshot(df: DataFrame, path: str, date: str, kind: str = "prepared") -> None:
    """Add the table as a dated snapshot; an earlier write of the same date and kind is replaced."""
    tagged = df.withColumn("snapshot_date", F.lit(date)).withColumn("kind", F.lit(kind))
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "snapshot_date").parquet(path)


def write_selection(df: DataFrame, path: str) -> None:
    df.write.csv(path, sep="\t", header=True, quote='"', escape='"')


def export_table(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The columns of an export, as strings."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in (columns or EXPORT_COLUMNS)])


def write_export(df: DataFrame, path: str, kind: str = "csv", columns: list[str] | None = None) -> None:
    """The export as comma- or tab-separated text with a header; ``kind`` is csv or tsv."""
    separator = {"csv": ",", "tsv": "\t"}[kind]
    export_table(df, columns).write.csv(path, sep=separator, header=True, quote='"', escape='"')


def export_lines(df: DataFrame) -> DataFrame:
    """Playlist lines ``artist - album``."""
    return df.select(F.concat_ws(" - ", "artist", "album").alias("value"))


def export_markdown(df: DataFrame) -> DataFrame:
    """Markdown rows; a missing year or genre is blank."""
    cells: list[Column] = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("score", "artist", "album", "release_year", "genre")]
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("value"))


def write_text(lines: DataFrame, path: str) -> None:
    lines.write.text(path)


def write_ordered(df: DataFrame, order: list[str], path: str, line: Column | None = None, parts: int | None = None, least: int = LEAST) -> None:
    """Lines in ``order`` (ascending, nulls last) over all part files together; ``read_ordered`` reads them back.

    ``line`` is the text of a row, by default the playlist line. A line feed in it becomes a space, a null an
    empty line; a part file holds a counted number of lines. ``df`` is computed once: its keys and what makes the lines
    are kept while they are ranked.
    """
    own = ["artist", "album"] if line is None else [line.alias("__line")]
    rows = stored(df.select(*dict.fromkeys(order), *[c for c in own if not isinstance(c, str) or c not in order]))
    placed = in_parts(rows, order, exact_parts(rows, order, parts, least))
    text = F.concat_ws(" - ", "artist", "album") if line is None else F.col("__line")
    write_text(placed.select(F.replace(text, F.lit("\n"), F.lit(" ")).alias("value")), path)


def write_captures(pages: DataFrame, path: str) -> None:
    """A file a page in the folder ``path``: ``capture_file`` (unique, not null), ``html`` in ``encoding``, zipped where the name ends in ``.gz``.

    Characters that an encoding lacks become question marks; a null page is an empty file, which Spark does not list. A page is written whole, under a name of its own,
    so a task that runs again writes the same files. Stores are those that ``pyarrow.fs`` knows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = located(path)
        system.create_dir(folder, recursive=True)
        for batch in batches:
            for part in byte_slices(batch, ("html",), 8 << 20):
                for name, html, encoding in zip(*(c.to_pylist() for c in part.columns)):
                    raw = (html or "").encode(encoding or "utf-8", "replace")
                    with system.open_output_stream(f"{folder}/{name}", compression=None) as out:
                        out.write(gzip.compress(raw, mtime=0) if name.endswith(".gz") else raw)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    pages.select("capture_file", "html", "encoding").mapInArrow(run, "n long").agg(F.sum("n")).collect()


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_report(df: DataFrame, path: str) -> None:
    """The match report, unmatched rows included."""
    df.write.csv(path, sep="\t", header=True, quote='"', escape='"')
