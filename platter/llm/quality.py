"""Quality rules with host verdicts, in DataFrame operations only.

Base rules reject single documents. Softer rules (symbol share, repeated lines, mean word length)
are counted per host; a host's failure rate is shrunk towards the corpus by a beta prior whose mean
and strength are fitted to the hosts themselves (method of moments), so a host with few documents
is judged mostly by the corpus. A host is suspect where its posterior rate exceeds the corpus's rate
with ``CONFIDENCE`` standard deviations to spare. The verdicts are joined back: on a suspect host, a
document that fails a soft rule itself is rejected; clean documents of any host stay.

Edge cases: a null or blank text has no words and fails; a null host is a host of its own; repeated
rows are judged alike and all returned; an empty table gives an empty result; other columns are
ignored by ``judge`` and kept by ``keep_good``, whose own columns are dropped again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platter.llm.common import SPACE_CLASS, reliable, text_or_empty, written

SYMBOLS = "#*$%&|<>"
#: One-sided 95 %.
CONFIDENCE = 1.645


def _window_columns(docs: DataFrame, words: Column) -> DataFrame:
    """Add ``n_repeat_words``: words inside three-word windows that occur twice or more in the text.

    Only texts whose windows' 64-bit hashes repeat are looked at closely: there the windows themselves
    are sorted by hash and words (n log n) and neighbours compared word by word.
    """
    hashed = docs.withColumn("__w", words).withColumn("__n", F.size("__w"))
    hashed = hashed.withColumn(
        "__h",
        F.when(
            F.col("__n") >= 3,
            F.transform(
                F.sequence(F.lit(0), F.col("__n") - 3),
                lambda i: F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)),
            ),
        ).otherwise(F.expr("cast(array() as array<bigint>)")),
    )
    window = lambda i: F.concat_ws(" ", F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2))
    tagged = F.array_sort(F.transform("__h", lambda h, i: F.struct(h.alias("h"), window(i).alias("g"), i.alias("i"))))
    hashed = hashed.withColumn("__s", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), tagged))
    same = lambda a, b: a["h"].eqNullSafe(b["h"]) & a["g"].eqNullSafe(b["g"])
    repeated = F.filter(
        "__s",
        lambda s, k: ((k > 0) & same(F.get("__s", k - 1), s)) | same(F.get("__s", k + 1), s),
    )
    covered = F.array_distinct(F.flatten(F.transform(repeated, lambda s: F.array(s["i"], s["i"] + 1, s["i"] + 2))))
    return hashed.withColumn("__repeat", F.when(F.col("__s").isNotNull(), F.size(covered)).otherwise(0).cast("long"))


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base figures and the soft rules of each row, in columns named ``__q_...``."""
    text = text_or_empty(text_col)
    base = docs.withColumn("__t", text)
    words = F.filter(F.split("__t", f"[{SPACE_CLASS}]+"), lambda w: w != "")
    base = _window_columns(base, words)
    lines = F.filter(F.split("__t", "\n"), lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", "    ")) != "")
    base = base.withColumn("__l", lines)
    base = base.select(
        *docs.columns,
        F.col("__n").cast("long").alias("__q_words"),
        F.length(F.translate("__t", " \t\n\x0b\x0c\r", "")).cast("long").alias("__q_chars"),
        (F.length("__t") - F.length(F.translate("__t", SYMBOLS, ""))).cast("long").alias("__q_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("__q_dup"),
        F.size("__l").cast("long").alias("__q_lines"),
        F.col("__repeat").alias("__q_repeat"),
        # A filter that reads this column stays above this projection; below it, every use of an array
        # would compute the array again.
        F.monotonically_increasing_id().alias("__q_row"),
    )
    words_n, chars = F.col("__q_words"), F.col("__q_chars")
    return base.withColumns(
        {
            "__q_base": (words_n < 50) | (100 * F.col("__q_repeat") > 50 * words_n),
            "__q_soft": (10 * F.col("__q_symbols") > words_n)
            | (10 * F.col("__q_dup") > 3 * F.col("__q_lines"))
            | (chars < 3 * words_n)
            | (chars > 15 * words_n),
        }
    )


def host_verdicts(figures: DataFrame, host_col: str = "source", confidence: float = CONFIDENCE) -> DataFrame:
    """One row per host: documents, failures, shrunk failure rate and whether the host is suspect.

    Suspect: the mean of the rate's posterior lies ``confidence`` of its standard deviations above the
    corpus's rate, so a host is measured by its neighbours and not by a fixed rate.

    ``figures`` needs the columns of ``measured``. The prior of the rate is Beta(m * s, (1 - m) * s)
    with the mean ``m`` of the corpus and the strength ``s`` that the spread of the hosts' rates beyond
    binomial noise implies (kept between 2 and 10,000).
    """
    failed = (F.col("__q_base") | F.col("__q_soft")).cast("long")
    # A row per host, written once: the prior and the rates read it without another pass over the texts.
    hosts = reliable(
        figures.groupBy(F.col(host_col).alias("__host")).agg(F.count(F.lit(1)).alias("docs"), F.sum(failed).alias("failed"))
    )
    overall = hosts.agg(
        F.sum("docs").alias("n"), F.sum("failed").alias("k"), F.count(F.lit(1)).alias("hosts"),
        F.sum(F.col("failed") * F.col("failed") / F.col("docs")).alias("kk"),
    ).select("n", "k", "hosts", "kk", (F.col("k") / F.col("n")).alias("m"))
    # Weighted between-host variance, less what binomial noise alone would give.
    spread = (F.col("kk") - F.col("n") * F.col("m") * F.col("m") - (F.col("hosts") - 1) * F.col("m") * (1 - F.col("m"))) / F.col("n")
    prior = overall.select(
        "m", F.when(spread > 0, F.least(F.greatest(F.col("m") * (1 - F.col("m")) / spread - 1, F.lit(2.0)), F.lit(10000.0))).otherwise(10000.0).alias("s")
    )
    fitted = prior.select(F.struct("m", "s")).scalar()
    hosts = hosts.withColumn("__p", fitted)
    rate = (F.col("failed") + F.col("__p.m") * F.col("__p.s")) / (F.col("docs") + F.col("__p.s"))
    spread = F.sqrt(rate * (1 - rate) / (F.col("docs") + F.col("__p.s") + 1))
    suspect = rate - F.col("__p.m") > confidence * spread
    return hosts.select("__host", "docs", "failed", rate.alias("host_rate"), suspect.alias("host_suspect"))


def _joined(figures: DataFrame, verdicts: DataFrame, host_col: str, broadcast_bytes: int = 16 << 20) -> DataFrame:
    """Figures with their host's verdict; the hosts are measured, and only up to ``broadcast_bytes`` broadcast.

    Beyond that the join shuffles, and adaptive execution splits the partition of a hot host.
    """
    verdicts = verdicts.select("__host", "host_suspect")
    size = verdicts.agg(F.sum(F.coalesce(F.octet_length("__host"), F.lit(0)) + 64)).first()[0] or 0
    if size <= broadcast_bytes:
        verdicts = F.broadcast(verdicts)
    kept = ~F.col("__q_base") & ~(F.col("host_suspect") & F.col("__q_soft"))
    return figures.join(verdicts, figures[host_col].eqNullSafe(verdicts["__host"]), "left").withColumn("__q_kept", kept)


def _positional(docs: DataFrame) -> DataFrame:
    """``docs`` with columns c0, c1, ...: no name of the caller's can clash with one of ours."""
    return docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", confidence: float = CONFIDENCE
) -> DataFrame:
    """Figures and verdict of every row; the texts are read once and their figures checkpointed."""
    figures = reliable(measured(_positional(docs.select(id_col, text_col, host_col)), "c1").drop("c1"))
    return _joined(figures, host_verdicts(figures, "c2", confidence), "c2").select(
        F.col("c0").alias(id_col),
        F.col("__q_words").alias("n_words"),
        F.col("__q_chars").alias("word_chars"),
        F.col("__q_symbols").alias("n_symbols"),
        F.col("__q_dup").alias("n_dup_lines"),
        F.col("__q_repeat").alias("n_repeat_words"),
        F.col("__q_base").alias("base_failed"),
        F.col("__q_kept").alias("kept"),
        F.col("__q_soft").alias("soft_failed"),
        F.col("host_suspect").alias("host_suspect"),
    )


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source", confidence: float = CONFIDENCE) -> DataFrame:
    """The rows that pass, with their columns; the rows and their flags are written once, so no text is judged twice."""
    plain = _positional(docs)
    text, host = (f"c{docs.columns.index(c)}" for c in (text_col, host_col))
    flagged = written(measured(plain, text).select(*plain.columns, "__q_base", "__q_soft"))
    verdicts = host_verdicts(flagged, host, confidence)
    return _joined(flagged, verdicts, host).filter("__q_kept").select(plain.columns).toDF(*docs.columns)
