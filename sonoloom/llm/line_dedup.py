"""Line dedup over levelled, sorted runs of line hashes.

A run is a Parquet table (h, n) sorted by h: line hash, and documents that hold the line.  New batches become level-0 runs;
when a level has ``fanout`` runs they are merged into one of the next level.  A new batch is merge-anti-joined with the keys
that the runs have already settled (found in enough documents), so a line that is everywhere is written once and not again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoloom.llm.common import BLANKS, ascii_lower, content_key, packed, unpacked
from sonoloom.session import checkpointed, work_path

BATCHES = 4
FANOUT = 4


def lines(text: Column) -> Column:
    """The text cut at \\n; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    return F.btrim(ascii_lower(line), F.lit(BLANKS))


def line_hashes(text: Column, min_chars: int) -> Column:
    """64-bit hashes of the different line keys of at least ``min_chars`` code points in one text.

    Among 10^11 different lines the chance that any of them meets one of 10^7 frequent ones is about 0.05.
    """
    keys = F.filter(F.transform(lines(text), _key), lambda k: F.char_length(k) >= min_chars)
    return F.array_distinct(F.transform(keys, lambda k: F.xxhash64(k)))


class LineRuns:
    """Document counts of line hashes in levelled runs below ``root``."""

    def __init__(self, spark: SparkSession, root: str, min_docs: int, fanout: int = FANOUT):
        self.spark, self.root, self.min_docs, self.fanout = spark, root, min_docs, fanout
        self.levels: list[list[str]] = []
        self.written = 0

    def counts(self) -> DataFrame | None:
        """(h, n) over all runs."""
        paths = [p for level in self.levels for p in level]
        if not paths:
            return None
        rows = self.spark.read.parquet(*paths)
        return rows if len(paths) == 1 else rows.groupBy("h").agg(F.sum("n").alias("n"))

    def settled(self) -> DataFrame | None:
        """Hashes found in at least ``min_docs`` documents so far."""
        counts = self.counts()
        return None if counts is None else counts.filter(F.col("n") >= self.min_docs).select("h")

    def _write(self, rows: DataFrame, level: int) -> None:
        path = f"{self.root}/level={level}/run={self.written}"
        self.written += 1
        rows.select("h", "n").sortWithinPartitions("h").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def add(self, batch: DataFrame) -> None:
        """Add a batch's (h, n), each h once; then merge levels that are full."""
        known = self.settled()
        self._write(batch if known is None else batch.join(known, "h", "left_anti"), 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            merged = self.spark.read.parquet(*self.levels[level]).groupBy("h").agg(F.sum("n").alias("n"))
            self.levels[level] = []
            self._write(merged, level + 1)
            level += 1


def dedup_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, *, batches: int = BATCHES, fanout: int = FANOUT
) -> DataFrame:
    """(doc_id, text, _row, lines, dropped, kept) of every row: line count before, lines dropped, and the text without them.

    Lines whose key (stripped of blanks, A-Z lower-cased) has at least ``min_chars`` code points and is found in at least
    ``min_docs`` documents lose all their copies everywhere.  A row is a document: repeated rows count each.  Null and empty texts
    are one empty line, which is never dropped.  An empty table gives no rows; other columns wait in ``_row``.  Ties do not
    arise: a line is dropped or kept by its count alone.
    """
    spark = docs.sparkSession
    keyed = docs.select(content_key().alias("_key"), F.explode(line_hashes(F.col("text"), min_chars)).alias("h"))
    batch = F.pmod(F.col("_key.a"), F.lit(batches)).alias("batch")
    counted = checkpointed(keyed.groupBy(batch, "h").agg(F.count(F.lit(1)).alias("n")))
    runs = LineRuns(spark, work_path(spark, "line-runs"), min_docs, fanout)
    for i in range(batches):
        runs.add(counted.filter(F.col("batch") == i).select("h", "n"))
    drops = (
        keyed.join(runs.settled(), "h", "left_semi")
        .groupBy("_key")
        .agg(F.collect_set("h").alias("_drop"))
    )
    drop = F.coalesce(F.col("_drop"), F.array().cast("array<bigint>"))
    joined = packed(docs).withColumn("_key", content_key()).join(drops, "_key", "left").withColumn("_all", lines(F.col("text")))
    kept = joined.withColumn(
        "_some",
        F.when(F.col("_drop").isNull(), F.col("_all")).otherwise(
            F.filter("_all", lambda x: ~F.array_contains(drop, F.xxhash64(_key(x))))
        ),
    )
    return kept.select(
        "doc_id",
        "text",
        "_row",
        F.size("_all").cast("bigint").alias("lines"),
        (F.size("_all") - F.size("_some")).cast("bigint").alias("dropped"),
        F.array_join("_some", "\n").alias("kept"),
    )


def without_repeated_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, **options: int) -> DataFrame:
    """``docs`` with the kept lines as text; ``n_chars`` follows where there is such a column, all else stays.

    A null text with nothing to drop stays null, and a document that loses every line stays with an empty text.
    """
    done = dedup_lines(docs, min_docs, min_chars, **options)
    changed = F.col("dropped") > 0
    replaced = {"text": F.when(changed, F.col("kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        length = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
        replaced["n_chars"] = F.when(changed, length).otherwise(F.col("_row.n_chars"))
    return done.select(*unpacked(docs.columns, **replaced))
