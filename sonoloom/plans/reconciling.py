"""Queries of the validation report and of the storage listing."""

from __future__ import annotations

from pyspark.sql import functions as F

from sonoloom.functions.utterance_json import explode_utterances
from sonoloom.operators import reconcile as rec
from sonoloom.operators.ordered import row_index
from sonoloom.plans.registry import query
from sonoloom.plans.views import STORE, listing, recordings, sql, utterances, with_lists
from sonoloom.sources.readers import list_children as children_of

BASE = STORE
NAME = "clipped_utterance_file_name"


def stored(spark, sf_dir):
    return rec.path_attributes(listing(spark, sf_dir), BASE)


def exploded(spark, sf_dir):
    staging = with_lists(spark, sf_dir)
    return explode_utterances(staging.select("audio_id", "raw_file_name", "source", "utterances_files_list"))


def matched(spark, sf_dir):
    return rec.stored_and_catalogued(rec.clean_listing(stored(spark, sf_dir)), exploded(spark, sf_dir))


@query(sql("A", "SELECT bucket_file_path, source, audio_id, raw_file_name, utterances_file_name, status FROM A"))
def path_attributes(spark, sf_dir):
    return stored(spark, sf_dir)


@query(
    sql(
        "A",
        "SELECT concat_ws(',', bucket_file_path, source, audio_id, raw_file_name, utterances_file_name, status) AS line FROM A",
    )
)
def listing_table(spark, sf_dir):
    rows = stored(spark, sf_dir)
    return rows.select(rec.listing_row(rows).alias("line"))


@query(
    sql(
        "AX",
        """SELECT bucket_file_path, source, audio_id, status, CAST(NULL AS VARCHAR) AS catalogued_source,
  CAST(NULL AS DOUBLE) AS utterances_file_duration FROM A
WHERE NOT EXISTS (SELECT 1 FROM X WHERE X.audio_id = A.audio_id AND X.utterances_file_name = A.utterances_file_name)""",
    )
)
def bucket_not_in_catalog(spark, sf_dir):
    # The listing is a union, and the anti-join runs once per branch; both read one exchange of the catalogue.
    rows = rec.stored_not_catalogued(stored(spark, sf_dir), exploded(spark, sf_dir))
    named = [F.col("source_x").alias("source"), F.col("source").alias("catalogued_source")]
    return rows.select("bucket_file_path", "audio_id", "status", *named, "utterances_file_duration")


@query(
    sql(
        "AX",
        """SELECT audio_id, raw_file_name, utterances_file_name, utterances_file_duration, CAST(NULL AS VARCHAR) AS bucket_file_path,
  CAST(NULL AS VARCHAR) AS source_x FROM X
WHERE NOT EXISTS (SELECT 1 FROM A WHERE X.audio_id = A.audio_id AND X.utterances_file_name = A.utterances_file_name)""",
    )
)
def catalog_not_in_bucket(spark, sf_dir):
    rows = rec.catalogued_not_stored(exploded(spark, sf_dir), stored(spark, sf_dir))
    return rows.select(
        "audio_id", "raw_file_name", "utterances_file_name", "utterances_file_duration", "bucket_file_path", "source_x"
    )


@query(
    sql(
        "AX",
        """SELECT A.audio_id, A.utterances_file_name, bucket_file_path, A.source AS source_x, A.raw_file_name AS raw_file_name_x,
  A.status, X.source, X.raw_file_name, utterances_file_duration, utterances_file_status
FROM A JOIN X ON X.audio_id = A.audio_id AND X.utterances_file_name = A.utterances_file_name""",
    )
)
def bucket_in_catalog(spark, sf_dir):
    rows = rec.stored_and_catalogued(stored(spark, sf_dir), exploded(spark, sf_dir))
    return rows.select(
        "audio_id", "utterances_file_name", "bucket_file_path", "source_x", "raw_file_name_x", "status", "source",
        "raw_file_name", "utterances_file_duration", "utterances_file_status",
    )


@query(sql("S", "SELECT audio_id, raw_file_name FROM S WHERE raw_file_name IN (SELECT raw_file_name FROM S GROUP BY raw_file_name HAVING count(*) > 1)"))
def dup_groups(spark, sf_dir):
    return rec.duplicate_names(recordings(spark, sf_dir).select("audio_id", "raw_file_name"))


UNIQUE = "SELECT raw_file_name, min(audio_id) AS audio_id FROM S GROUP BY raw_file_name"


@query(sql("S", UNIQUE))
def first_per_name(spark, sf_dir):
    return rec.unique_names(recordings(spark, sf_dir).select("raw_file_name", "audio_id"), ["audio_id"])


CLEAN_MATCH = """(SELECT X.*, bucket_file_path, A.status AS stored_status FROM A JOIN X
  ON X.audio_id = A.audio_id AND X.utterances_file_name = A.utterances_file_name WHERE A.status = 'clean')"""


@query(
    sql(
        "AX",
        f"""SELECT audio_id, raw_file_name, utterances_file_name, utterances_file_duration FROM (
  SELECT X.*, A.status AS stored_status FROM A JOIN X ON X.audio_id = A.audio_id AND X.utterances_file_name = A.utterances_file_name)
WHERE utterances_file_duration NOT BETWEEN 0.5 AND 15""",
    )
)
def invalid_duration(spark, sf_dir):
    rows = rec.invalid_durations(rec.stored_and_catalogued(stored(spark, sf_dir), exploded(spark, sf_dir)))
    return rows.select("audio_id", "raw_file_name", "utterances_file_name", "utterances_file_duration")


@query(
    sql(
        "AX",
        """SELECT raw_file_name, utterances_file_name, row_number() OVER (ORDER BY raw_file_name, utterances_file_name) - 1 AS position
FROM X WHERE utterances_file_duration NOT BETWEEN 0.5 AND 15""",
    )
)
def sorted_report(spark, sf_dir):
    """The report order as a column."""
    rows = exploded(spark, sf_dir).filter(~rec.valid_duration() & F.col("utterances_file_name").isNotNull())
    names = ["raw_file_name", "utterances_file_name"]
    return row_index(rows.select(*names), names, output="position")


VALID = f"""(SELECT * FROM {CLEAN_MATCH} WHERE utterances_file_duration BETWEEN 0.5 AND 15
  AND lower(utterances_file_status) <> 'rejected')"""


@query(
    sql(
        "AX",
        f"""SELECT audio_id, sum(utterances_file_duration) / 60 AS cleaned_duration,
  string_agg(utterances_file_name, ',' ORDER BY utterances_file_name) AS names FROM {VALID} GROUP BY audio_id""",
    )
)
def valid_per_audio(spark, sf_dir):
    rows = rec.valid_per_audio(matched(spark, sf_dir))
    name = F.transform("utterances_files_list", lambda u: F.get_json_object(u, "$.name"))
    return rows.select("audio_id", "cleaned_duration", F.concat_ws(",", name).alias("names"))


@query(
    sql(
        "AX",
        f"""SELECT V.audio_id, V.cleaned_duration, V.names, Q.raw_file_name FROM (
  SELECT audio_id, sum(utterances_file_duration) / 60 AS cleaned_duration,
    string_agg(utterances_file_name, ',' ORDER BY utterances_file_name) AS names FROM {VALID} GROUP BY audio_id) V
JOIN ({UNIQUE}) Q ON V.audio_id = Q.audio_id""",
    )
)
def valid_and_unique(spark, sf_dir):
    unique = rec.unique_names(recordings(spark, sf_dir).select("raw_file_name", "audio_id"), ["audio_id"])
    rows = rec.valid_and_unique(rec.valid_per_audio(matched(spark, sf_dir)), unique)
    name = F.transform("utterances_files_list", lambda u: F.get_json_object(u, "$.name"))
    return rows.select("audio_id", "cleaned_duration", "raw_file_name", F.concat_ws(",", name).alias("names"))


CLEANED = f"""SELECT audio_id, concat('gs://corpus/', bucket_file_path) AS wav_path_bucket,
  concat('gs://corpus/', replace(bucket_file_path, 'wav', 'txt')) AS transcriptions_path_bucket,
  utterances_file_duration AS duration, utterances_file_name FROM {VALID}
WHERE audio_id IN (SELECT audio_id FROM ({UNIQUE}))"""


def cleaned(spark, sf_dir):
    unique = rec.unique_names(recordings(spark, sf_dir).select("raw_file_name", "audio_id"), ["audio_id"])
    return rec.cleaned_dataset(matched(spark, sf_dir), unique, "post", "corpus")


@query(sql("AX", f"SELECT audio_id, wav_path_bucket, transcriptions_path_bucket, duration FROM ({CLEANED})"))
def cleaned_dataset(spark, sf_dir):
    return cleaned(spark, sf_dir)


@query(
    sql(
        "AXU",
        f"""SELECT C.audio_id, wav_path_bucket, duration, speaker_id, speaker_gender, snr, status, staged_for_transcription
FROM ({CLEANED}) C JOIN U ON C.audio_id = U.audio_id AND C.utterances_file_name = U.{NAME}""",
    )
)
def cleaned_with_mapping(spark, sf_dir):
    rows = rec.with_mapping(cleaned(spark, sf_dir), utterances(spark, sf_dir))
    return rows.select(
        "audio_id", "wav_path_bucket", "duration", "speaker_id", "speaker_gender", "snr", "status", "staged_for_transcription"
    )


@query(sql("A", "SELECT bucket_file_path FROM A WHERE status = 'clean'"))
def clean_only(spark, sf_dir):
    return rec.clean_listing(stored(spark, sf_dir)).select("bucket_file_path")


@query(
    sql(
        "U",
        f"""SELECT {NAME} FROM (SELECT *, CASE audio_id % 4 WHEN 0 THEN NULL WHEN 1 THEN upper(status) ELSE status END AS spelled FROM U)
WHERE spelled IS NULL OR lower(spelled) <> 'rejected'""",
    )
)
def not_rejected(spark, sf_dir):
    spelled = F.when(F.col("audio_id") % 4 == 1, F.upper("status")).when(F.col("audio_id") % 4 != 0, F.col("status"))
    return utterances(spark, sf_dir).withColumn("spelled", spelled).filter(rec.not_rejected("spelled")).select(NAME)


@query(sql("X", "SELECT audio_id, utterances_file_name FROM X WHERE utterances_file_duration BETWEEN 0.5 AND 15"))
def valid_duration(spark, sf_dir):
    return exploded(spark, sf_dir).filter(rec.valid_duration()).select("audio_id", "utterances_file_name")


@query(sql("SL", "SELECT (SELECT count(*) FROM S) > 0 AS catalogue_rows, (SELECT count(*) FROM L) > 0 AS listing_rows"))
def input_check(spark, sf_dir):
    """Both inputs hold rows; an empty one raises."""
    catalogue, files = recordings(spark, sf_dir), listing(spark, sf_dir)
    rec.check_inputs(catalogue, files)
    any_row = F.count(F.lit(1)) > 0
    left = catalogue.agg(any_row.alias("catalogue_rows"), F.lit(1).alias("k"))
    return left.join(files.agg(any_row.alias("listing_rows"), F.lit(1).alias("k")), "k").drop("k")


CHILD = f"substr(path, length('{STORE}/src1/') + 1)"


@query(
    sql(
        "L",
        f"""SELECT DISTINCT CASE WHEN instr(rest, '/') > 0 THEN concat(split_part(rest, '/', 1), '/') ELSE rest END AS name
FROM (SELECT {CHILD} AS rest FROM L WHERE path LIKE '{STORE}/src1/%' AND path LIKE '%.wav%')""",
    )
)
def list_children(spark, sf_dir):
    return children_of(listing(spark, sf_dir), f"{STORE}/src1")


@query(
    sql(
        "L",
        f"""SELECT DISTINCT split_part(path, '/', -1) AS name FROM L
WHERE path LIKE '{STORE}/src0/900000020/clean/%'""",
    )
)
def list_children_flat(spark, sf_dir):
    return children_of(listing(spark, sf_dir), f"{STORE}/src0/900000020/clean", include_folders=False)
