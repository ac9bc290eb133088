"""Corpus export: records with provenance, external corpora, download lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoloom.functions.text import base_name, first_stem, gender_name


def corpus_records(rows: DataFrame, source: str, transcripts: DataFrame | None = None) -> DataFrame:
    """Nested corpus records.

    With ``transcripts`` (stem, text) the export is labelled and keeps only rows that have one;
    without, every row is kept and there is no text.
    """
    fields = [
        F.col("audio_file_name").alias("audioFilename"),
        F.array(F.lit(source), F.col("collection_source"), F.col("main_source")).alias("collectionSource"),
        F.struct(F.lit("WadaSnr").alias("methodType"), F.struct("snr").alias("methodDetails")).alias("snr"),
        "duration",
        F.col("speaker_name").alias("speaker"),
        gender_name(F.col("gender")).alias("gender"),
        F.col("audio_id").alias("audioId"),
    ]
    if transcripts is None:
        return rows.select(*fields)
    stemmed = rows.withColumn("stem", first_stem(F.col("audio_file_name")))
    return stemmed.join(transcripts.select("stem", "text"), "stem").select(*fields, "text")


def external_rows(listing: DataFrame) -> DataFrame:
    """Export rows for every listed ``wav`` of a corpus that is not catalogued (fixed values)."""
    return listing.filter(F.col("path").contains("wav")).select(
        base_name(F.col("path")).alias("audio_file_name"),
        F.lit(5.0).alias("duration"),
        F.lit(15.0).alias("snr"),
        F.lit("1").alias("speaker_name"),
        F.lit("unknown").alias("collection_source"),
        F.lit("unknown").alias("main_source"),
        F.lit("non-specified").alias("gender"),
        F.lit(123).cast("bigint").alias("audio_id"),
        F.lit("Clean").alias("status"),
    )


def download_manifest(rows: DataFrame, source_path: str, target: str, *, labelled: bool, external: bool) -> DataFrame:
    """(src, dst): the wav of every row, and its txt when the export is labelled."""
    stem = first_stem(F.col("audio_file_name"))
    folder = F.lit(source_path)
    if not external:
        folder = F.concat_ws("/", folder, F.col("audio_id").cast("string"), F.lower("status"))
    extensions = F.array(*[F.lit(e) for e in (("wav", "txt") if labelled else ("wav",))])
    name = F.when(F.col("_ext") == "wav", F.col("audio_file_name")).otherwise(F.concat(stem, F.lit(".txt")))
    return rows.withColumn("_ext", F.explode(extensions)).select(
        F.concat_ws("/", folder, name).alias("src"), F.concat(F.lit(target + "/"), stem, F.lit("."), "_ext").alias("dst")
    )


def fetched_only(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows whose file was fetched; ``files`` is (name)."""
    return rows.join(files.select(F.col("name").alias("audio_file_name")).distinct(), "audio_file_name", "left_semi")


def surplus_files(files: DataFrame, records: DataFrame) -> DataFrame:
    """Fetched ``.wav`` files that no record names."""
    named = records.select(F.col("audioFilename").alias("name")).distinct()
    return files.filter(F.endswith(F.col("name"), F.lit(".wav"))).join(named, "name", "left_anti")


def public_records(records: DataFrame) -> DataFrame:
    """Records as published, without the internal id and the speaker."""
    return records.drop("audioId", "speaker")
