"""Writers: tables as directories written by many tasks, reports, corpora and batch lists as files under their exact names."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoloom.operators.ordered import row_index
from sonoloom.operators.publishing import public_records
from sonoloom.sources.store import write_lines

ROWS_PER_FILE = 1_000_000


def report_name(source: str, moment: datetime) -> str:
    return f"Final_Report_{moment:%m_%d_%Y_%H_%M_%S}_{source}.csv"


def _numbered(rows: DataFrame, name: str, order_by: Sequence[str], per_file: int) -> DataFrame:
    """Add ``_at``, the position in the order, and ``_file``: ``name``, then ``name`` with _2, _3, ... for every ``per_file`` rows more."""
    stem, dot, extension = name.rpartition(".")
    block = F.floor(F.col("_at") / F.lit(per_file)).cast("bigint")
    file = F.when(block == 0, name).otherwise(F.concat(F.lit(f"{stem}_"), (block + 1).cast("string"), F.lit(dot + extension)))
    return row_index(rows, order_by, output="_at").withColumn("_file", file)


def _write_one(spark: SparkSession, text: str, name: str, root: str) -> None:
    write_lines(spark.createDataFrame([(text,)], "value string"), root, F.lit(name), F.col("value"), [])


def _csv_value(column: str, kind: str) -> Column:
    return F.to_json(column).alias(column) if kind.startswith(("map", "array", "struct")) else F.col(column)


def write_final_report(
    final: DataFrame, root: str, source: str, moment: datetime, order_by: Sequence[str] | None = None, rows_per_file: int = ROWS_PER_FILE
) -> list[str]:
    """CSV with a header under its exact name, in the given order (else that of its plain columns); lists and maps as JSON.

    Rows beyond ``rows_per_file`` go to further files with a header, so no task writes an unbounded report.  Without rows the
    file holds the header.  Returns the files, the first under the report's name.
    """
    name, header = report_name(source, moment), ",".join(final.columns)
    order = list(order_by or [c for c, t in final.dtypes if not t.startswith(("map", "array", "struct"))])
    flat = final.select(F.struct(*[_csv_value(c, t) for c, t in final.dtypes]).alias("_row"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(order)])
    numbered = _numbered(flat, name, [f"_k{i}" for i in range(len(order))], rows_per_file)
    line = F.to_csv("_row", {"escape": '"', "emptyValue": ""})
    headed = F.when(F.col("_at") % rows_per_file == 0, F.concat(F.lit(header + "\n"), line)).otherwise(line)
    write_lines(numbered, root, F.col("_file"), headed, ["_at"])
    files = -(-numbered.count() // rows_per_file)  # of the checkpointed rows: ``final`` would run once more
    if not files:
        _write_one(final.sparkSession, header, name, root)
    stem = name.removesuffix(".csv")
    return [f"{root}/{name}", *[f"{root}/{stem}_{i}.csv" for i in range(2, files + 1)]]


def write_report_tables(tables: dict[str, DataFrame], root: str, stage: str) -> list[str]:
    """One directory per report table; only a ``pre`` stage writes them."""
    if "pre" not in stage:
        return []
    written = []
    for name, table in tables.items():
        path = f"{root}/{name}"
        table.write.parquet(path)
        written.append(path)
    return written


def write_corpus(
    records: DataFrame, params: dict, root: str, order_by: Sequence[str] = ("audioFilename",), records_per_file: int = ROWS_PER_FILE
) -> None:
    """``data.json`` (a JSON array without the internal columns, in order) and ``params.json``, each one file of that name.

    Records beyond ``records_per_file`` go to ``data_2.json`` and so on, each an array of its own.
    """
    _write_one(records.sparkSession, json.dumps(params, indent=4), "params.json", root)
    public = public_records(records)
    keyed = public.select(F.to_json(F.struct(*public.columns)).alias("_json"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(order_by)])
    numbered = _numbered(keyed, "data.json", [f"_k{i}" for i in range(len(order_by))], records_per_file)
    total = numbered.count()
    if not total:
        _write_one(records.sparkSession, "[]", "data.json", root)
        return
    first = F.when(F.col("_at") % records_per_file == 0, "[\n").otherwise("")
    ends = (F.col("_at") % records_per_file == records_per_file - 1) | (F.col("_at") == total - 1)
    write_lines(numbered, root, F.col("_file"), F.concat(first, "_json", F.when(ends, "\n]").otherwise(",")), ["_at"])


def write_snapshot(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    rows.write.format(fmt).option("header", True).save(path)


def write_embeddings(rows: DataFrame, path: str) -> None:
    rows.write.parquet(path)


def write_transcripts(rows: DataFrame, path: str) -> None:
    """``transcript``, and ``original_transcript`` where sanitising changed the text."""
    rows.select("audio_id", "clipped_utterance_file_name", "transcript", "original_transcript").write.parquet(path)


def write_batches(batches: DataFrame, path: str, order_by: Sequence[str] = ("line",)) -> None:
    """One file for each ``batch_file``, under that name, holding its lines in order."""
    write_lines(batches, path, F.col("batch_file"), F.col("line"), order_by)


def write_speaker_map(members: DataFrame, path: str) -> None:
    members.write.json(path)


def write_gender_predictions(rows: DataFrame, path: str) -> None:
    rows.write.option("header", True).csv(path)


def write_version(rows: DataFrame, root: str, version: int) -> str:
    """Write a new snapshot beside the old ones, then append it to the version list.

    The list grows only after the data is complete, so a failed write leaves the old snapshot
    in use; nothing is overwritten.
    """
    path = f"{root}/v={version}"
    rows.write.parquet(path)
    entry = rows.sparkSession.createDataFrame([(version, path)], "version bigint, path string")
    entry.coalesce(1).write.mode("append").json(f"{root}/versions")
    return path


def current_table(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete snapshot."""
    versions = spark.read.schema("version bigint, path string").json(f"{root}/versions")
    return spark.read.parquet(versions.agg(F.max_by("path", "version")).first()[0])
