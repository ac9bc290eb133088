"""Queries of corpus export and of speaker/file maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from sonoloom.functions.text import base_name, first_stem
from sonoloom.operators import catalog as cat
from sonoloom.operators import publishing as pub
from sonoloom.operators.mutations import gender_letter
from sonoloom.operators.ordered import list_parts
from sonoloom.plans.registry import query
from sonoloom.plans.views import listing, members, recordings, speakers, sql, table, utterances

NAME = "clipped_utterance_file_name"

EXPORT = f"""SELECT U.{NAME} AS audio_file_name, clipped_utterance_duration AS duration, snr, P.speaker_name,
  source_url AS collection_source, source_website AS main_source, U.speaker_gender AS gender, U.audio_id, U.status
FROM U JOIN S ON U.audio_id = S.audio_id LEFT JOIN P ON P.speaker_id = U.speaker_id
WHERE S.source = 'src1' AND S.language = 'Telugu' AND staged_for_transcription"""
LABELLED = f"{EXPORT} AND U.status = 'Clean' AND is_transcribed AND labelled_artifact_name IS NULL"
UNLABELLED = f"""{EXPORT} AND U.status IN ('Clean', 'Rejected') AND (NOT is_transcribed OR is_transcribed IS NULL)
  AND unlabelled_artifact_name IS NULL"""
COLUMNS = """audio_file_name AS "audioFilename", concat_ws(',', 'src1', collection_source, main_source) AS collection_source,
  'WadaSnr' AS method, snr, duration, speaker_name AS speaker, CASE gender WHEN 'm' THEN 'male' WHEN 'f' THEN 'female'
  ELSE 'non-specified' END AS gender, audio_id AS "audioId\""""


def _export(spark, sf_dir, **options):
    staging = recordings(spark, sf_dir)
    return cat.export_rows(utterances(spark, sf_dir), staging, speakers(staging), "src1", "Telugu", **options)


def transcripts(spark, sf_dir):
    """(stem, text): every document is the transcript of the utterances of one audio id."""
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("audio_id"), "text")
    named = utterances(spark, sf_dir).select("audio_id", first_stem(F.col(NAME)).alias("stem"))
    return named.join(texts, "audio_id").select("stem", "text")


def _flat(records):
    return records.select(
        "audioFilename",
        F.concat_ws(",", "collectionSource").alias("collection_source"),
        F.col("snr.methodType").alias("method"),
        F.col("snr.methodDetails.snr").alias("snr"),
        "duration",
        "speaker",
        "gender",
        "audioId",
        *([F.md5("text").alias("text_md5")] if "text" in records.columns else []),
    )


@query(
    sql(
        "USP",
        f"""SELECT {COLUMNS}, md5(text) AS text_md5 FROM ({LABELLED}) JOIN (SELECT doc_id AS audio_id, text FROM documents) USING (audio_id)""",
    )
)
def publish_labelled(spark, sf_dir):
    rows = _export(spark, sf_dir, count=None)
    return _flat(pub.corpus_records(rows, "src1", transcripts(spark, sf_dir)))


@query(sql("USP", f"SELECT {COLUMNS} FROM ({UNLABELLED})"))
def publish_unlabelled(spark, sf_dir):
    rows = _export(spark, sf_dir, count=None, is_transcribed=False, is_labelled=False, include_rejected=True)
    return _flat(pub.corpus_records(rows, "src1"))


@query(sql("USP", f"SELECT * FROM ({EXPORT} AND U.status = 'Clean' AND is_transcribed AND labelled_artifact_name IS NULL) ORDER BY audio_id, audio_file_name LIMIT 40"))
def export_limit(spark, sf_dir):
    """The export count is a limit over a total order."""
    return _export(spark, sf_dir, count=40)


@query(
    sql(
        "L",
        """SELECT string_split(path, '/')[-1] AS audio_file_name, 5.0::DOUBLE AS duration, 15.0::DOUBLE AS snr, '1' AS speaker_name,
  'unknown' AS collection_source, 'unknown' AS main_source, 'non-specified' AS gender, 123::BIGINT AS audio_id, 'Clean' AS status FROM L""",
    )
)
def external_corpus(spark, sf_dir):
    return pub.external_rows(listing(spark, sf_dir))


@query(
    sql(
        "USPL",
        f"SELECT audio_file_name FROM ({LABELLED}) WHERE audio_file_name IN (SELECT string_split(path, '/')[-1] FROM L)",
    )
)
def fetched_only(spark, sf_dir):
    files = listing(spark, sf_dir).select(base_name(F.col("path")).alias("name"))
    return pub.fetched_only(_export(spark, sf_dir, count=None), files).select("audio_file_name")


@query(
    sql(
        "USPL",
        f"""SELECT string_split(path, '/')[-1] AS name FROM L
WHERE string_split(path, '/')[-1] NOT IN (SELECT audio_file_name FROM ({LABELLED}))""",
    )
)
def surplus_files(spark, sf_dir):
    files = listing(spark, sf_dir).select(base_name(F.col("path")).alias("name"))
    return pub.surplus_files(files, pub.corpus_records(_export(spark, sf_dir, count=None), "src1"))


@query(sql("B", "SELECT string_split(path, '/')[-1] AS file_name, speaker_name FROM B"))
def file_to_speaker(spark, sf_dir):
    return members(spark, sf_dir).select(base_name(F.col("path")).alias("file_name"), "speaker_name")


@query(
    sql(
        "B",
        f"""SELECT speaker_name, was_noise, CAST((rn - 1) // 10000 AS BIGINT) AS part, count(*) AS files,
  md5(string_agg({NAME}, ',' ORDER BY {NAME})) AS files_md5 FROM (
  SELECT *, row_number() OVER (PARTITION BY speaker_name, was_noise ORDER BY {NAME}) AS rn FROM B) GROUP BY speaker_name, was_noise, (rn - 1) // 10000""",
    )
)
def speaker_files(spark, sf_dir):
    """Files of each speaker, by noise flag, as ordered lists of bounded length."""
    lists = list_parts(members(spark, sf_dir), ["speaker_name", "was_noise"], F.col(NAME), [NAME], "files", items=10_000)
    return lists.select(
        "speaker_name",
        "was_noise",
        "part",
        F.size("files").cast("bigint").alias("files"),
        F.md5(F.concat_ws(",", "files")).alias("files_md5"),
    )


@query(
    sql(
        "B",
        f"""SELECT speaker_name, CAST((rn - 1) // 100 AS BIGINT) AS part, md5(string_agg({NAME}, ',' ORDER BY {NAME})) AS files_md5 FROM (
  SELECT *, row_number() OVER (PARTITION BY speaker_name ORDER BY {NAME}) AS rn FROM B) GROUP BY speaker_name, (rn - 1) // 100""",
    )
)
def speaker_file_parts(spark, sf_dir):
    """The same lists cut into parts of 100 names."""
    lists = list_parts(members(spark, sf_dir), ["speaker_name"], F.col(NAME), [NAME], "files", items=100)
    return lists.select("speaker_name", "part", F.md5(F.concat_ws(",", "files")).alias("files_md5"))


@query(sql("U", f"SELECT audio_id, string_agg({NAME}, ',' ORDER BY {NAME}) AS names FROM U WHERE status = 'Clean' GROUP BY audio_id"))
def names_per_audio(spark, sf_dir):
    """File names per audio id of an export."""
    clean = utterances(spark, sf_dir).filter("status = 'Clean'")
    lists = list_parts(clean, ["audio_id"], F.col(NAME), [NAME], "names")
    return lists.select("audio_id", F.concat_ws(",", "names").alias("names"))


@query(
    sql(
        "U",
        f"""SELECT letter, count(*) AS files, min({NAME}) AS first_file FROM (
  SELECT *, CASE WHEN speaker_gender = 'm' THEN 'm' ELSE 'f' END AS letter FROM U) GROUP BY letter""",
    )
)
def gender_lists(spark, sf_dir):
    """Files by gender: ``m``, and everything else ``f``."""
    rows = utterances(spark, sf_dir).select(NAME, gender_letter(F.col("speaker_gender")).alias("letter"))
    return rows.groupBy("letter").agg(F.count(F.lit(1)).alias("files"), F.min(NAME).alias("first_file"))
