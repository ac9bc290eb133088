"""Work plans: smallest files, paired files, fixed and quota batches, manifests and paths."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoloom.functions.text import base_name, companion_name, extension, extension_matches, first_stem, parent_dir
from sonoloom.operators.ordered import blocks, first_rows, row_index, running_total


def smallest_files(listing: DataFrame, count: int) -> DataFrame:
    """The ``count`` smallest files by size, then path."""
    return first_rows(listing, count, ["length", "path"])


def require_rows(df: DataFrame, message: str = "file not found") -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


def paired_files(listing: DataFrame, audio_format: str, meta_extension: str) -> DataFrame:
    """Audio files whose companion metadata file lies in the same directory."""
    named = listing.withColumn("_dir", parent_dir(F.col("path"))).withColumn("_name", base_name(F.col("path")))
    audio = named.filter(extension_matches(extension(F.col("_name")), audio_format)).withColumn(
        "_meta", companion_name(F.col("_name"), meta_extension)
    )
    meta = named.filter(F.endswith(F.col("_name"), F.lit(meta_extension))).select("_dir", F.col("_name").alias("_meta"))
    return audio.join(meta, ["_dir", "_meta"], "left_semi").select(*listing.columns)


def first_ids(listing: DataFrame, count: int) -> DataFrame:
    """The first ``count`` distinct audio ids, by path, that hold a ``.wav`` file."""
    found = listing.filter(F.col("path").contains(".wav")).select(
        F.element_at(F.split("path", "/"), -3).alias("audio_id"), "path"
    )
    return first_rows(found.groupBy("audio_id").agg(F.min("path").alias("first_path")), count, ["first_path"])


def first_chunks(listing: DataFrame, count: int, suffix: str = ".csv") -> DataFrame:
    """The first ``count`` chunk files by path."""
    return first_rows(listing.filter(F.endswith(F.col("path"), F.lit(suffix))), count, ["path"])


def batches_without_embeddings(listing: DataFrame) -> DataFrame:
    """(stem, has_embeddings): stems present as only one of ``.txt`` and ``.npz``.

    ``has_embeddings`` says whether the listing holds any embedding file at all.
    """
    stems = listing.filter(F.col("path").contains("txt") | F.col("path").contains("npz")).select(
        F.replace(F.replace("path", F.lit(".txt"), F.lit("")), F.lit(".npz"), F.lit("")).alias("stem"),
        F.col("path").contains("npz").alias("is_npz"),
    )
    odd = stems.groupBy("stem").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") % 2 == 1)
    return odd.select("stem", F.lit(not stems.filter("is_npz").isEmpty()).alias("has_embeddings"))


def audio_batches(listing: DataFrame, audio_format: str, size: int, bucket: str, **sizes: int) -> DataFrame:
    """(batch, batch_file, line): clean audio paths in fixed-size batches, first batch 1."""
    wanted = listing.filter(
        extension_matches(extension(base_name(F.col("path"))), audio_format) & F.col("path").contains("clean")
    ).select("path", F.concat(F.lit(bucket + "/"), "path").alias("line"))
    return fixed_batches(wanted, size, ["path"], **sizes).select("batch", "batch_file", "line")


def fixed_batches(df: DataFrame, size: int, order_by: Sequence[str], **sizes: int) -> DataFrame:
    """Add ``batch`` (from 1) and its file name for consecutive runs of ``size`` rows."""
    numbered = blocks(df, size, order_by, "batch", **sizes).withColumn("batch", F.col("batch") + 1)
    return numbered.withColumn("batch_file", F.concat(F.lit("batch_file_"), F.col("batch").cast("string"), F.lit(".txt")))


def even_chunks(df: DataFrame, parallelism: int, order_by: Sequence[str], **sizes: int) -> DataFrame:
    """Add ``batch`` (from 0): contiguous chunks of ``ceil(n / parallelism)`` rows."""
    return blocks(df, max(1, ceil(df.count() / parallelism)), order_by, "batch", **sizes)


def held_out_split(df: DataFrame, share: float, order_by: Sequence[str], **sizes: int) -> DataFrame:
    """Add ``held_out``: false for the first ``int(share * n)`` rows of the order, true for the rest."""
    kept = int(share * df.count())
    return row_index(df, order_by, output="_index", **sizes).withColumn("held_out", F.col("_index") >= kept).drop("_index")


def worker_quota(counts: DataFrame, parallelism: int, count: str = "utterance_count") -> DataFrame:
    """One row: utterances per worker, rounded up."""
    total = F.coalesce(F.sum(count), F.lit(0))
    return counts.agg(F.ceil(total / F.lit(parallelism)).cast("bigint").alias("quota"))


def quota_batches(counts: DataFrame, parallelism: int, count: str = "utterance_count", **sizes: int) -> DataFrame:
    """(batch, audio_id): ids by descending count packed into batches of the worker quota.

    An id whose utterances straddle a boundary is in both batches.  With the running interval
    [start, end) of an id, its batches are ``start div q`` to ``(end - 1) div q``.
    """
    quota = worker_quota(counts, parallelism, count).first()["quota"]
    if not quota:
        return counts.select(F.lit(0).cast("bigint").alias("batch"), "audio_id").limit(0)
    placed = running_total(
        counts.filter(F.col(count) > 0), F.col(count), [F.col(count).desc(), F.col("audio_id").asc()], output="_end", **sizes
    )
    first = F.floor((F.col("_end") - F.col(count)) / F.lit(quota)).cast("bigint")
    last = F.floor((F.col("_end") - 1) / F.lit(quota)).cast("bigint")
    return placed.select(F.explode(F.sequence(first, last)).alias("batch"), "audio_id")


def clip_path(base: str, audio_id: Column, name: Column) -> Column:
    return F.concat_ws("/", F.lit(base), audio_id.cast("string"), F.lit("clean"), name)


def recording_path(base: str, audio_id: Column) -> Column:
    return F.concat_ws("/", F.lit(base), audio_id.cast("string"))


def move_manifest(files: DataFrame, landing: str, path: str = "path") -> DataFrame:
    """(src, dst) of clip files: the last two directories and the file below ``landing``."""
    parts = F.split(F.col(path), "/")
    return files.select(
        F.col(path).alias("src"), F.concat_ws("/", F.lit(landing), F.array_join(F.slice(parts, -3, 3), "/")).alias("dst")
    )


def move_path_manifest(paths: DataFrame, landing: str, path: str = "path") -> DataFrame:
    """(src, dst) of recording directories."""
    return paths.select(F.col(path).alias("src"), F.concat_ws("/", F.lit(landing), base_name(F.col(path))).alias("dst"))


def experiment_manifest(rows: DataFrame, base: str, output: str) -> DataFrame:
    """(src, dst) of the wav and the txt file of every experiment utterance."""
    stem = first_stem(F.col("clipped_utterance_file_name"))
    audio_id = F.col("audio_id").cast("string")
    return rows.withColumn("_ext", F.explode(F.array(F.lit("wav"), F.lit("txt")))).select(
        F.concat(F.lit(base), F.lower("source"), F.lit("/"), audio_id, F.lit("/clean/"), stem, F.lit("."), "_ext").alias("src"),
        F.concat(F.lit(output), "experiment_name", F.lit("/"), audio_id, F.lit("/"), stem, F.lit("."), "_ext").alias("dst"),
    )


def stt_paths(ids: DataFrame, base: str, output: str, source: str, engine: str, data_set: str) -> DataFrame:
    """(audio_id, input_path, output_path) of a transcription run."""
    inner = F.lit(data_set)
    audio_id = F.col("audio_id").cast("string")
    return ids.select(
        "audio_id",
        F.concat_ws("/", F.lit(base), F.lit(source), F.when(inner != "", inner), audio_id, F.lit("clean")).alias("input_path"),
        F.concat_ws(
            "/", F.lit(output), F.lit(engine), F.lit(source), F.when(inner == "", "train").otherwise(inner), audio_id
        ).alias("output_path"),
    )
