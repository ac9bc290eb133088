"""Every sink behind a query: the rows of another query are written, read back and compared with that query's SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from sonoloom.plans import batching, io_queries, publishing_queries, quality_queries, reconciling  # noqa: F401
from sonoloom.plans.registry import CHECKS, QUERIES, query
from sonoloom.plans.views import embeddings, members, sql
from sonoloom.session import work_path
from sonoloom.sources import sinks

MOMENT = datetime(2021, 3, 4, 5, 6, 7)


@query(CHECKS["cleaned_with_mapping"])
def final_report_written(spark, sf_dir):
    rows = QUERIES["cleaned_with_mapping"](spark, sf_dir)
    files = sinks.write_final_report(rows, work_path(spark, "final"), "src", MOMENT)
    return spark.read.schema(rows.schema).options(header=True, escape='"').csv(files)


@query(CHECKS["invalid_duration"])
def report_tables_written(spark, sf_dir):
    rows = QUERIES["invalid_duration"](spark, sf_dir)
    (path,) = sinks.write_report_tables({"invalid_duration": rows}, work_path(spark, "report"), "pre")
    return spark.read.parquet(path)


@query(
    "SELECT *, row_number() OVER (ORDER BY audio_file_name) - 1 AS position, 'Telugu' AS language FROM ("
    + CHECKS["fetched_only"].replace("SELECT audio_file_name FROM (", "SELECT audio_file_name, duration, snr, status FROM (", 1)
    + ")"
)
def corpus_written(spark, sf_dir):
    """``data.json`` and ``params.json`` read back by name: the array holds the corpus in order, without internal columns."""
    rows = publishing_queries._export(spark, sf_dir, count=None)
    files = publishing_queries.listing(spark, sf_dir).select(publishing_queries.base_name(F.col("path")).alias("name"))
    kept = publishing_queries.pub.fetched_only(rows, files)
    path = work_path(spark, "corpus")
    marked = kept.withColumn("audioId", F.lit(1)).withColumn("speaker", F.lit("x"))
    sinks.write_corpus(marked, {"language": "Telugu"}, path, ["audio_file_name"])
    names = "audio_file_name string, duration double, snr double, status string, audioId int, speaker string"
    data = spark.read.text(f"{path}/data.json", wholetext=True).select(F.posexplode(F.from_json("value", f"array<struct<{names.replace(' ', ':').replace(',:', ',')}>>")))
    if not data.filter("col.audioId IS NOT NULL OR col.speaker IS NOT NULL").isEmpty():
        raise ValueError("internal columns were written")
    params = spark.read.option("multiLine", True).schema("language string").json(f"{path}/params.json")
    read = data.select(F.col("pos").cast("bigint").alias("position"), "col.*").drop("audioId", "speaker")
    return read.join(F.broadcast(params))


@query(CHECKS["distinct_audio_ids"])
def snapshot_written(spark, sf_dir):
    path = work_path(spark, "snapshot")
    sinks.write_snapshot(QUERIES["distinct_audio_ids"](spark, sf_dir), path)
    return spark.read.parquet(path)


@query("SELECT vec_id, concat('store/', vec_id) AS path, embedding[1]::DOUBLE AS first, len(embedding)::INTEGER AS size FROM embeddings")
def embeddings_written(spark, sf_dir):
    path = work_path(spark, "vectors")
    sinks.write_embeddings(embeddings(spark, sf_dir).withColumn("path", F.concat(F.lit("store/"), "vec_id")), path)
    first = F.get("embedding", F.lit(0)).cast("double").alias("first")
    return spark.read.parquet(path).select("vec_id", "path", first, F.size("embedding").alias("size"))


@query(f"SELECT *, row_number() OVER (PARTITION BY batch_file ORDER BY line) - 1 AS position FROM ({CHECKS['fixed_batches']})")
def batches_written(spark, sf_dir):
    """Batch lists read back from ``batch_file_<n>.txt``, with the place of each line in its file."""
    path = work_path(spark, "batches")
    sinks.write_batches(QUERIES["fixed_batches"](spark, sf_dir), path)
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("batch_file"), F.split(F.rtrim("value", F.lit("\n")), "\n").alias("lines"))
    lines = files.select("batch_file", F.posexplode("lines").alias("position", "line"))
    number = F.regexp_extract("batch_file", r"^batch_file_(\d+)\.txt$", 1).cast("bigint")
    return lines.select(number.alias("batch"), "batch_file", "line", F.col("position").cast("bigint").alias("position"))


@query(sql("B", "SELECT speaker_name, path, was_noise, audio_id FROM B"))
def speaker_map_written(spark, sf_dir):
    path = work_path(spark, "speaker-map")
    rows = members(spark, sf_dir).select("speaker_name", "path", "was_noise", "audio_id")
    sinks.write_speaker_map(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query(sql("B", "SELECT path, CASE WHEN was_noise THEN 'm' ELSE 'f' END AS gender FROM B"))
def gender_predictions_written(spark, sf_dir):
    path = work_path(spark, "genders")
    sinks.write_gender_predictions(members(spark, sf_dir).select("path", F.when(F.col("was_noise"), "m").otherwise("f").alias("gender")), path)
    return spark.read.option("header", True).csv(path)


@query(
    """SELECT doc_id AS audio_id, source AS clipped_utterance_file_name, lang AS transcript,
  CASE WHEN n_chars > 500 THEN source END AS original_transcript FROM documents"""
)
def transcripts_written(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").alias("audio_id"),
        F.col("source").alias("clipped_utterance_file_name"),
        F.col("lang").alias("transcript"),
        F.when(F.col("n_chars") > 500, F.col("source")).alias("original_transcript"),
    )
    path = work_path(spark, "transcripts")
    sinks.write_transcripts(rows, path)
    return spark.read.parquet(path)
