"""Readers of catalogue files, transcripts, embeddings and storage listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoloom.functions.text import first_stem
from sonoloom.schemas import MANIFEST, METADATA_COLUMNS, SOURCE_SUMMARY, metadata_schema
from sonoloom.session import load_moment
from sonoloom.sources.csv_records import csv_records, values_by_file
from sonoloom.sources.store import is_folder, is_reachable, list_levels, read_files

SELECTION_DDL = "speaker_id double, clipped_utterance_file_name string, clipped_utterance_duration double, audio_id bigint, snr double"


def read_metadata_csv(spark: SparkSession, path: str) -> DataFrame:
    """Recording metadata, bound by position; the ``license`` column is optional, file by file.

    ``path`` is a file or a folder of files with and without that column; large files are read in splits, line breaks inside
    quotes included.  Values that do not fit their type are null.  New rows get the load time and are not normalised.
    """
    records, headers = csv_records(spark, path)
    layouts = headers.select("file", F.array_contains("names", "license").alias("_with"))
    rows = values_by_file(records, layouts, len(METADATA_COLUMNS))
    license_at = METADATA_COLUMNS.index("license")
    picked = []
    for i, field in enumerate(metadata_schema().fields):
        short = F.lit(None) if i == license_at else F.get("_v", F.lit(i if i < license_at else i - 1))
        value = F.when(F.col("_with"), F.get("_v", F.lit(i))).otherwise(short)
        picked.append(value.try_cast(field.dataType).alias(field.name))
    return rows.select(*picked).withColumn("load_datetime", load_moment(spark)).withColumn("is_normalized", F.lit(False))


def read_source_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SOURCE_SUMMARY).option("header", True).csv(path)


def read_selection(spark: SparkSession, path: str) -> DataFrame:
    """Pre-filtered utterances: five columns by the name they have in each file's header, integer speaker ids.

    A file without one of the columns is an error, and so is a folder without utterances.
    """
    types = dict(c.strip().split(" ") for c in SELECTION_DDL.split(","))
    records, headers = csv_records(spark, path)
    places = {n: F.array_position("names", n).cast("int") for n in types}
    short = headers.filter(F.least(*places.values()) == 0).select("file", "names").first()
    width = headers.agg(F.max(F.size("names"))).first()[0]
    if short is not None or width is None:
        raise ValueError(f"{path if short is None else short.file}: missing columns {sorted(set(types) - set(short.names if short else []))}")
    rows = values_by_file(records, headers.select("file", F.struct(*[p.alias(n) for n, p in places.items()]).alias("_at")), width)
    rows = rows.select(*[F.get("_v", F.col(f"_at.{n}") - 1).try_cast(t).alias(n) for n, t in types.items()])
    if not rows.take(1):  # reads a task's first batch; ``isEmpty`` starts every task
        raise ValueError(f"{path}: no utterances")
    return rows.withColumn("speaker_id", F.col("speaker_id").cast("int"))


def read_batch_list(spark: SparkSession, path: str) -> DataFrame:
    """(path): one path per line."""
    return spark.read.text(path).select(F.trim("value").alias("path")).filter("path <> ''")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).csv(path)


def read_experiment_chunks(spark: SparkSession, prefix: str) -> DataFrame:
    """All ``.csv`` chunks below a prefix."""
    schema = "audio_id bigint, source string, experiment_name string, clipped_utterance_file_name string"
    return (
        spark.read.schema(schema)
        .options(header=True, escape='"', recursiveFileLookup=True, pathGlobFilter="*.csv")
        .csv(prefix)
    )


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """(stem, text) of whole ``.txt`` files at any depth; many small ones are packed into one task.

    A folder is listed and read by tasks.  Only another path, or a store that tasks cannot reach by themselves, is listed by
    Spark's file index, on the driver.
    """
    if is_folder(path):
        files = read_files(spark, path, "*.txt")
        return files.select(first_stem(F.col("file_name")).alias("stem"), F.col("content").cast("string").alias("text"))
    files = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    )
    return files.select(first_stem(F.col("_metadata.file_name")).alias("stem"), F.col("value").alias("text"))


def read_embeddings(spark: SparkSession, *paths: str) -> DataFrame:
    """Embedding parts with their paths, from one or more directories."""
    parts = [spark.read.parquet(p) for p in paths]
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part)
    return joined


def list_store(spark: SparkSession, path: str, pattern: str = "*.wav") -> DataFrame:
    """(path, length, modificationTime) of stored files; file contents are never read.

    Folders are listed by tasks, level by level.  Only a store that tasks cannot reach by themselves is listed by Spark's
    file index, on the driver.
    """
    if is_reachable(path):
        return list_levels(spark, path, pattern)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return files.load(path).select("path", "length", "modificationTime")


def list_children(listing: DataFrame, source_path: str, include_folders: bool = True) -> DataFrame:
    """(name): immediate ``.wav`` children of a path; deeper ones fold to ``first/`` or are dropped."""
    prefix = source_path.rstrip("/") + "/"
    rest = F.substring("path", len(prefix) + 1, 1_000_000)
    below = listing.filter(F.startswith(F.col("path"), F.lit(prefix)) & F.col("path").contains(".wav")).select(
        rest.alias("_rest")
    )
    deep = F.col("_rest").contains("/")
    if not include_folders:
        below = below.filter(~deep)
    folded = F.when(deep, F.concat(F.substring_index("_rest", "/", 1), F.lit("/"))).otherwise(F.col("_rest"))
    return below.filter("_rest <> ''").select(folded.alias("name")).distinct()
