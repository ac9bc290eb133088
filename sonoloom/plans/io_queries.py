"""Queries of the readers: files are written from the given tables, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from sonoloom.functions.text import base_name
from sonoloom.functions.utterance_json import list_elements
from sonoloom.operators.hooks import encode
from sonoloom.operators.mutations import transcription_outcome
from sonoloom.operators.planning import held_out_split
from sonoloom.operators.transcription import outcome, transcribe
from sonoloom.operators.transcription import transcribe_once as transcribe_with_ledger
from sonoloom.plans.cataloguing import mapping
from sonoloom.plans.registry import query
from sonoloom.plans.views import STORE, embeddings, listing, recordings, sql, table, utterances, with_lists
from sonoloom.schemas import METADATA_COLUMNS, metadata_schema
from sonoloom.session import work_path
from sonoloom.sources import readers
from sonoloom.sources.store import write_lines

NAME = "clipped_utterance_file_name"
SECONDS = "clipped_utterance_duration"


def _metadata(spark, sf_dir, with_license):
    staging = with_lists(spark, sf_dir)
    schema = metadata_schema(with_license)
    filled = {"license": F.lit("cc-by")}
    return staging.select(
        *[
            (F.col(f.name) if f.name in staging.columns else filled.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def _metadata_round_trip(spark, sf_dir, with_license):
    path = work_path(spark, "metadata")
    _metadata(spark, sf_dir, with_license).write.options(header=True, escape='"').csv(path)
    return _metadata_read(spark, path)


def _metadata_read(spark, path):
    rows = readers.read_metadata_csv(spark, path)
    assert set(METADATA_COLUMNS) <= set(rows.columns)
    elements = F.greatest(F.coalesce(F.size(list_elements(F.col("utterances_files_list"))), F.lit(-1)), F.lit(-1)).cast("bigint")
    return rows.select(
        "audio_id", "raw_file_name", "speaker_name", "duration", "license", elements.alias("elements"), "is_normalized"
    )


METADATA = """SELECT S.audio_id, raw_file_name, speaker_name, duration, {license} AS license,
  CASE WHEN S.audio_id % 50 = 1 THEN -1 WHEN S.audio_id % 50 = 2 THEN 0 ELSE coalesce(n, -1) END AS elements,
  false AS is_normalized FROM S LEFT JOIN (SELECT audio_id, count(*) AS n FROM U GROUP BY audio_id) USING (audio_id)"""


@query(sql("SU", METADATA.format(license="'cc-by'")))
def read_metadata_csv(spark, sf_dir):
    return _metadata_round_trip(spark, sf_dir, True)


@query(sql("SU", METADATA.format(license="CAST(NULL AS VARCHAR)")))
def read_metadata_csv_short(spark, sf_dir):
    """A file without the ``license`` column."""
    return _metadata_round_trip(spark, sf_dir, False)


@query(
    sql(
        "SU",
        f"""SELECT * REPLACE (concat(raw_file_name, chr(10), '"', audio_id, '"') AS raw_file_name) FROM (
  {METADATA.format(license="CASE WHEN S.audio_id % 2 = 0 THEN 'cc-by' END")})""",
    )
)
def read_metadata_mixed(spark, sf_dir):
    """One folder of files with and without ``license``, written by many tasks, with line breaks inside quotes."""
    path = work_path(spark, "metadata")
    broken = F.concat("raw_file_name", F.lit('\n"'), F.col("audio_id").cast("string"), F.lit('"'))
    for rest in (0, 1):
        rows = _metadata(spark, sf_dir, rest == 0).filter(F.col("audio_id") % 2 == rest).withColumn("raw_file_name", broken)
        rows.write.mode("append").options(header=True, escape='"').csv(path)
    return _metadata_read(spark, path)


SUMMARY = """SELECT source, CAST(count(DISTINCT speaker_name) AS INTEGER) AS num_speaker, sum(audio_id) / 2.0::DOUBLE AS total_duration,
  CAST(count(*) AS INTEGER) AS num_of_audio FROM S GROUP BY source"""


@query(sql("S", SUMMARY))
def read_source_summary(spark, sf_dir):
    path = work_path(spark, "summary")
    recordings(spark, sf_dir).groupBy("source").agg(
        F.count_distinct("speaker_name").alias("num_speaker"),
        (F.sum("audio_id") / 2).alias("total_duration"),
        F.count(F.lit(1)).alias("num_of_audio"),
    ).write.option("header", True).csv(path)
    return readers.read_source_summary(spark, path)


@query(sql("U", f"SELECT speaker_id, {NAME}, {SECONDS}, audio_id, snr FROM U"))
def read_selection(spark, sf_dir):
    path = work_path(spark, "selection")
    rows = utterances(spark, sf_dir).select("audio_id", "status", "snr", NAME, SECONDS, F.col("speaker_id").cast("double").alias("speaker_id"))
    rows.write.option("header", True).csv(path)
    return readers.read_selection(spark, path)


@query(sql("L", "SELECT path FROM L"))
def read_batch_list(spark, sf_dir):
    path = work_path(spark, "batch")
    listing(spark, sf_dir).select("path").write.text(path)
    return readers.read_batch_list(spark, path)


@query(sql("L", "SELECT path, CAST(length % 2 AS INTEGER) AS label FROM L"))
def read_manifest(spark, sf_dir):
    path = work_path(spark, "manifest")
    listing(spark, sf_dir).select("path", F.col("length") % 2).write.csv(path)
    return readers.read_manifest(spark, path)


@query(sql("US", f"SELECT audio_id, source, language AS experiment_name, {NAME} FROM U JOIN (SELECT audio_id, source, language FROM S) USING (audio_id)"))
def read_experiment_chunks(spark, sf_dir):
    path = work_path(spark, "experiment")
    rows = utterances(spark, sf_dir).join(recordings(spark, sf_dir).select("audio_id", "source", "language"), "audio_id")
    rows.select("audio_id", "source", F.col("language").alias("experiment_name"), NAME).write.option("header", True).csv(f"{path}/a")
    return readers.read_experiment_chunks(spark, path)


@query("SELECT CAST(doc_id AS VARCHAR) AS stem, md5(concat(text, chr(10))) AS text_md5 FROM documents WHERE text IS NOT NULL")
def read_transcripts(spark, sf_dir):
    """One text file for each document, in folders by source, read back as (stem, text)."""
    path = work_path(spark, "texts")
    docs = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    write_lines(docs, path, F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".v1.txt")), F.col("text"), [])
    return readers.read_transcripts(spark, path).select("stem", F.md5("text").alias("text_md5"))


@query("SELECT vec_id, label, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total FROM embeddings")
def read_embeddings(spark, sf_dir):
    """Parts in two directories with their columns in another order."""
    first, second = work_path(spark, "parts"), work_path(spark, "parts")
    rows = embeddings(spark, sf_dir)
    rows.filter("vec_id % 2 = 0").write.parquet(first)
    rows.filter("vec_id % 2 = 1").select("label", "embedding", "vec_id").write.parquet(second)
    read = readers.read_embeddings(spark, first, second)
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return read.select("vec_id", "label", F.round(total, 6).alias("total"))


AUDIO = r"/(\d+)/[a-z]+/[^/]*$"
FOLDER = f"""concat(split_part(path, '/', 4), '/', CAST(regexp_extract(path, '{AUDIO}', 1) AS BIGINT) % 100, '/', string_split(path, '/')[-2])"""


@query(sql("L", f"SELECT concat({FOLDER}, '/list.txt') AS path, CAST(sum(strlen(path) + 1) AS BIGINT) AS length FROM L GROUP BY 1"))
def list_store(spark, sf_dir):
    """Listing of a real store: a file in each of many folders, three levels deep, holding that folder's paths."""
    path = work_path(spark, "store")
    parts, audio = F.split("path", "/"), F.regexp_extract("path", AUDIO, 1).cast("bigint") % 100
    folder = F.concat_ws("/", F.get(parts, F.lit(3)), audio.cast("string"), F.element_at(parts, F.lit(-2)))
    write_lines(listing(spark, sf_dir), path, F.concat(folder, F.lit("/list.txt")), F.col("path"), ["path"])
    files = readers.list_store(spark, path, "*.txt")
    return files.select(F.substring("path", len(path) + 2, 10_000).alias("path"), "length")


def _echo(path: str) -> str:
    """A stand-in engine: it fails on some files and otherwise returns a text of the file name."""
    stem = path.rsplit("/", 1)[-1].split(".")[0]
    if stem.endswith("7"):
        raise RuntimeError("no match")
    return f" clip-{stem.replace('_', ' ')}. " + ("$" if stem.endswith("3") else "")


ECHO = f"""SELECT *, split_part({NAME}, '.', 1) LIKE '%7' AS failed, split_part({NAME}, '.', 1) LIKE '%3' AS odd FROM U
WHERE status = 'Clean'"""


@query(
    sql(
        "U",
        f"""SELECT audio_id, {NAME}, CASE WHEN NOT failed AND NOT odd THEN concat('clip ', replace(split_part({NAME}, '.', 1), '_', ' ')) END AS transcript,
  NOT failed AND NOT odd AS is_transcribed, CASE WHEN failed OR odd THEN 'Rejected' ELSE 'Clean' END AS status,
  CASE WHEN failed THEN 'STT API error:no match'
    WHEN odd THEN 'sanitization error:transcription has a character outside its language' END AS reason FROM ({ECHO})""",
    )
)
def transcribe_hook(spark, sf_dir):
    """The transcriber hook with sanitising and outcome routing."""
    clips = utterances(spark, sf_dir).filter("status = 'Clean'").select("audio_id", NAME, F.col(NAME).alias("path"))
    done = outcome(transcribe(clips, _echo), "indian_english", "azure")
    return done.select("audio_id", NAME, "transcript", "is_transcribed", "status", "reason")


@query(
    sql(
        "U",
        f"""SELECT U.audio_id, U.{NAME}, CASE WHEN Q.audio_id IS NULL THEN U.status WHEN failed THEN 'Rejected' ELSE 'Clean' END AS status,
  CASE WHEN Q.audio_id IS NULL THEN U.is_transcribed WHEN U.is_transcribed THEN true ELSE NOT failed END AS is_transcribed
FROM U LEFT JOIN ({ECHO}) Q ON U.audio_id = Q.audio_id AND U.{NAME} = Q.{NAME}""",
    )
)
def transcribe_and_record(spark, sf_dir):
    """Outcomes of an engine whose text is kept as it comes, written to the mapping."""
    rows = mapping(spark, sf_dir)
    clips = rows.filter("status = 'Clean'").select("audio_id", NAME, F.col(NAME).alias("path"))
    done = outcome(transcribe(clips, _echo), "hindi", "inhouse")
    return transcription_outcome(rows, done).select("audio_id", NAME, "status", "is_transcribed")


@query(
    sql(
        "U",
        f"""SELECT audio_id, {NAME}, CASE WHEN NOT failed THEN concat(' clip-', replace(split_part({NAME}, '.', 1), '_', ' '), '. ', CASE WHEN odd THEN '$' ELSE '' END) END AS raw_text,
  CASE WHEN failed THEN 'no match' END AS engine_error FROM ({ECHO})""",
    )
)
def transcribe_once(spark, sf_dir):
    """One call per clip over two runs with one ledger: the first over half of the clips, the second over all."""
    clips = utterances(spark, sf_dir).filter("status = 'Clean'").select("audio_id", NAME, F.col(NAME).alias("path"))
    ledger = work_path(spark, "calls")
    transcribe_with_ledger(clips.filter("audio_id % 2 = 0"), _echo, ledger, "azure", chunk=500)
    return transcribe_with_ledger(clips, _echo, ledger, "azure", chunk=500).drop("path")


def _load_encoder():
    import numpy as np

    return lambda paths: np.array([[len(p), p.count("/"), p.count("1")] for p in paths], dtype="float32")


@query(
    sql(
        "L",
        """SELECT path, CAST(length(path) AS DOUBLE) AS e0, CAST(length(path) - length(replace(path, '/', '')) AS DOUBLE) AS e1,
  CAST(length(path) - length(replace(path, '1', '')) AS DOUBLE) AS e2 FROM L""",
    )
)
def encode_hook(spark, sf_dir):
    """The encoder hook with a stand-in model."""
    coded = encode(listing(spark, sf_dir), _load_encoder)
    return coded.select("path", *[F.get("embedding", i).cast("double").alias(f"e{i}") for i in range(3)])


@query(sql("L", "SELECT string_split(path, '/')[-1] AS name, split_part(string_split(path, '/')[-1], '.', 1) AS stem FROM L"))
def stems(spark, sf_dir):
    name = base_name(F.col("path"))
    return listing(spark, sf_dir).select(name.alias("name"), F.split_part(name, F.lit("."), F.lit(1)).alias("stem"))


@query("SELECT doc_id, row_number() OVER (ORDER BY h, doc_id) > floor(0.9 * count(*) OVER ()) AS held_out FROM (SELECT doc_id, md5(concat_ws('|', '11', doc_id)) AS h FROM documents)")
def random_split(spark, sf_dir):
    """A seeded 90/10 split: the first ``int(0.9 n)`` rows of a hashed order are for training."""
    rows = table(spark, sf_dir, "documents").select("doc_id")
    hashed = rows.withColumn("h", F.md5(F.concat_ws("|", F.lit("11"), F.col("doc_id").cast("string"))))
    return held_out_split(hashed, 0.9, ["h", "doc_id"]).select("doc_id", "held_out")
