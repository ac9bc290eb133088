"""CSV folders whose files differ in their columns and whose quoted values hold line breaks, read in splits.

``spark.read.text`` deals the lines of every file to tasks by byte range.  Whether a line starts inside quotes depends on the number
of quotes before it, so the quotes are counted per split, and the parity at the start of each split follows from a running
sum over the splits of its file.  With that every split joins its own lines to records; a record that a boundary cuts comes out
in pieces, which are put together by file and split.  Each file's own header names its columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sonoloom.session import checkpointed

SMALL_ROWS = 100_000
WHOLE, HEAD, TAIL = 0, 1, 2
SPLIT = ["file", "block"]


def _lines(spark: SparkSession, path: str, pattern: str | None) -> DataFrame:
    """(file, block, quotes, value): the lines of all files, in order within a partition."""
    options = {"lineSep": "\n", **({"pathGlobFilter": pattern, "recursiveFileLookup": True} if pattern else {})}
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.options(**options).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), quotes.alias("quotes"), "value"
    )


def _is_small(table: DataFrame) -> bool:
    return table.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS


def _splits(lines: DataFrame) -> DataFrame:
    """(file, block, start, first): quote parity at the start of each split, and its first line that is not blank."""
    first = F.min_by("value", F.when(F.trim("value", F.lit(" \r\t")) != "", F.col("_i")))
    # With a collected set beside it the aggregate keeps its few splits in a hash map; with texts alone it would sort all lines.
    odd = F.collect_set(F.col("quotes") % 2)
    facts = lines.withColumn("_i", F.monotonically_increasing_id()).groupBy(*SPLIT).agg(
        (F.sum("quotes") % 2).alias("parity"), first.alias("first"), F.array_contains(odd, 1).alias("odd")
    )
    facts = facts.withColumn("parity", F.when(F.col("odd"), F.col("parity")).otherwise(0))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return facts.select(*SPLIT, F.coalesce(F.sum("parity").over(before) % 2, F.lit(0)).cast("int").alias("start"), "first")


def _split_of(batch: pa.RecordBatch, row: int) -> tuple[str, int]:
    return batch.column("file")[row].as_py(), batch.column("block")[row].as_py()


def _has_whole_lines(batch: pa.RecordBatch, where: tuple[str, int] | None) -> bool:
    """All rows are of one split, and every line begins and ends outside quotes; ``where`` is the split before, outside quotes."""
    if not batch.num_rows or _split_of(batch, 0) != _split_of(batch, batch.num_rows - 1):
        return False
    if _split_of(batch, 0) != where and batch.column("start")[0].as_py():
        return False
    return not pc.any(pc.not_equal(pc.bit_wise_and(batch.column("quotes"), 1), 0)).as_py()


def _joiner(cut: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Records of each split in order, either the whole ones or the pieces of cut ones.

    The lines of a cut record are a TAIL of the split where it starts and a HEAD of those that follow.  ``first`` marks the header.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, inside, kind, fresh = None, 0, WHOLE, False
        lines: list[str] = []
        rows: list[tuple] = []

        def close(at: int) -> None:
            nonlocal fresh
            text = "\n".join(lines)
            lines.clear()
            if at != WHOLE or text.strip():
                if (at != WHOLE) == cut:
                    rows.append((*where, at, fresh, text))
                fresh = False

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 5
            rows.clear()
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*SPLIT, "kind", "first", "record"])

        for batch in batches:
            if not lines and not inside and _has_whole_lines(batch, where):
                # no record goes over a line break here: the lines that are not blank are the records
                if _split_of(batch, 0) != where:
                    where, kind, fresh = _split_of(batch, 0), WHOLE, batch.column("block")[0].as_py() == 0
                kept = batch.filter(pc.not_equal(pc.utf8_trim_whitespace(batch.column("value")), ""))
                if kept.num_rows and not cut:
                    firsts = pa.array([fresh] + [False] * (kept.num_rows - 1), pa.bool_())
                    whole = pa.array([WHOLE] * kept.num_rows, pa.int32())
                    columns = [kept.column("file"), kept.column("block"), whole, firsts, kept.column("value")]
                    yield pa.RecordBatch.from_arrays(columns, [*SPLIT, "kind", "first", "record"])
                fresh = fresh and not kept.num_rows
                continue
            for file, block, start, quotes, value in zip(*(batch.column(c).to_pylist() for c in (*SPLIT, "start", "quotes", "value"))):
                if (file, block) != where:
                    if lines:
                        close(HEAD if kind == HEAD else TAIL)
                    where, inside, fresh = (file, block), start, block == 0
                    kind = HEAD if inside else WHOLE
                lines.append(value)
                inside ^= quotes & 1
                if not inside:
                    close(kind)
                    kind = WHOLE
            yield flush()
        if lines:
            close(HEAD if kind == HEAD else TAIL)
        yield flush()

    return join


def _stitched(pieces: DataFrame) -> DataFrame:
    """(file, first, record) of the records that split boundaries cut."""
    order = Window.partitionBy("file").orderBy("block", "kind")
    numbered = pieces.withColumn("_k", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", "record")))
    joined = F.array_join(F.transform(parts, lambda p: p["record"]), "\n")
    return numbered.groupBy("file", "_k").agg(F.max("first").alias("first"), joined.alias("record")).select("file", "first", "record")


def csv_records(spark: SparkSession, path: str, pattern: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Records (file, record) as text, and headers (file, names) of all files.

    ``path`` is a file or a folder; with ``pattern`` the files below the folder that match it, at any depth.  Line breaks inside quotes
    belong to the record; blank lines are no records.  A header is one line.  A file with a header only has no records, and
    an empty file not even a header.  A last quote that is never closed ends the file in one record.  Records come in no order.
    """
    lines = _lines(spark, path, pattern)
    splits = checkpointed(_splits(lines))
    opened = splits.filter("start = 1").select(*SPLIT, "start")
    any_open, few = not opened.isEmpty(), _is_small(opened)
    if any_open and few:
        marked = lines.join(F.broadcast(opened), SPLIT, "left").withColumn("start", F.coalesce("start", F.lit(0)))
    elif any_open:
        # many splits start inside quotes: the join shuffles, so the lines are put back in order
        sided = lines.withColumn("_i", F.monotonically_increasing_id()).join(splits.select(*SPLIT, "start"), SPLIT)
        marked = sided.repartition(*SPLIT).sortWithinPartitions(*SPLIT, "_i")
    else:
        marked = lines.withColumn("start", F.lit(0))
    marked = marked.select(*SPLIT, "start", "quotes", "value")
    schema = "file string, block bigint, kind int, first boolean, record string"
    records = marked.mapInArrow(_joiner(False), schema).select("file", "first", "record")
    if any_open:
        records = records.unionByName(_stitched(marked.mapInArrow(_joiner(True), schema)))
    names = F.transform(F.split(F.ltrim("first", F.lit("\ufeff")), ","), lambda c: F.trim(c, F.lit('" \t\r')))
    headers = splits.filter("block = 0 AND first IS NOT NULL").select("file", names.alias("names"))
    return records.filter("NOT first").select("file", F.rtrim("record", F.lit("\r")).alias("record")), headers


def values_by_file(records: DataFrame, facts: DataFrame, width: int) -> DataFrame:
    """``records`` with ``_v``, their first ``width`` values as strings, and the ``facts`` of their file.

    The values go through a generator, so that a record is parsed once and not once for each column.
    """
    schema = ", ".join(f"c{i} string" for i in range(width))
    parsed = records.select("file", F.explode(F.array(F.from_csv("record", schema, {"escape": '"'}))).alias("_c"))
    listed = parsed.select("file", F.array(*[F.col(f"_c.c{i}") for i in range(width)]).alias("_v"))
    return listed.join(F.broadcast(facts) if _is_small(facts) else facts, "file")
