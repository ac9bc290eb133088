"""Queries of work planning: top-k, batches, quotas, manifests and paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from sonoloom.functions import text as tx
from sonoloom.operators import catalog as cat
from sonoloom.operators import planning as plan
from sonoloom.operators import publishing as pub
from sonoloom.operators import reconcile as rec
from sonoloom.operators.ordered import first_rows
from sonoloom.plans.registry import query
from sonoloom.plans.views import listing, recordings, sql, table, utterances

NAME = "clipped_utterance_file_name"
STT_COUNTS = """SELECT audio_id, count(*) AS c FROM U WHERE staged_for_transcription
  AND NOT list_contains(stt_api_used, 'google') AND coalesce(data_type, '') = 'train' GROUP BY audio_id"""


def counts(spark, sf_dir):
    rows = cat.stt_eligible(utterances(spark, sf_dir), "google", "train")
    return rows.groupBy("audio_id").agg(F.count(F.lit(1)).alias("utterance_count"))


@query(sql("U", f"SELECT CAST(ceil(sum(c) / 7.0) AS BIGINT) AS quota FROM ({STT_COUNTS})"))
def worker_quota(spark, sf_dir):
    return plan.worker_quota(counts(spark, sf_dir), 7)


@query(
    sql(
        "U",
        f"""SELECT unnest(generate_series(s // q, (e - 1) // q)) AS batch, audio_id FROM (
  SELECT audio_id, CAST(sum(c) OVER w AS BIGINT) AS e, CAST(sum(c) OVER w - c AS BIGINT) AS s,
    CAST(ceil(sum(c) OVER () / 7.0) AS BIGINT) AS q
  FROM ({STT_COUNTS}) WINDOW w AS (ORDER BY c DESC, audio_id ROWS UNBOUNDED PRECEDING))""",
    )
)
def quota_batches(spark, sf_dir):
    return plan.quota_batches(counts(spark, sf_dir), 7)


@query(
    sql(
        "L",
        """SELECT CAST((rn - 1) // 500 + 1 AS BIGINT) AS batch, concat('batch_file_', (rn - 1) // 500 + 1, '.txt') AS batch_file,
  concat('corpus/', path) AS line FROM (
  SELECT path, row_number() OVER (ORDER BY path) AS rn FROM L WHERE path LIKE '%.wav' AND path LIKE '%clean%')""",
    )
)
def fixed_batches(spark, sf_dir):
    return plan.audio_batches(listing(spark, sf_dir), "wav", 500, "corpus")


@query(
    sql(
        "U",
        """SELECT audio_id, CAST(floor((rn - 1) / ceil(n / 5.0)) AS BIGINT) AS batch FROM (
  SELECT audio_id, row_number() OVER (ORDER BY audio_id) AS rn, count(*) OVER () AS n FROM (SELECT DISTINCT audio_id FROM U))""",
    )
)
def even_chunks(spark, sf_dir):
    return plan.even_chunks(utterances(spark, sf_dir).select("audio_id").distinct(), 5, ["audio_id"])


@query(sql("L", "SELECT path, length FROM L ORDER BY length, path LIMIT 100"))
def smallest_k(spark, sf_dir):
    return plan.require_rows(plan.smallest_files(listing(spark, sf_dir), 100))


@query(sql("L", "SELECT path, length FROM (SELECT *, row_number() OVER (ORDER BY length, path) AS rn FROM L) WHERE rn <= 2000"))
def limit_total_order(spark, sf_dir):
    return first_rows(listing(spark, sf_dir), 2_000, ["length", "path"])


def with_companions(spark, sf_dir):
    """The listing plus a ``.csv`` beside some of the files."""
    files = listing(spark, sf_dir)
    meta = files.filter(F.length("path") % 3 == 1).select(
        F.replace("path", F.lit(".wav"), F.lit(".csv")).alias("path"), F.lit(10).cast("bigint").alias("length")
    )
    return files.unionByName(meta)


@query(sql("L", "SELECT path, length FROM L WHERE length(path) % 3 = 1"))
def paired_files(spark, sf_dir):
    return plan.paired_files(with_companions(spark, sf_dir), "wav", ".csv")


@query(
    sql(
        "L",
        """SELECT string_split(path, '/')[-3] AS audio_id, min(path) AS first_path FROM L WHERE path LIKE '%.wav%'
GROUP BY 1 ORDER BY first_path LIMIT 50""",
    )
)
def first_k_ids(spark, sf_dir):
    return plan.first_ids(listing(spark, sf_dir), 50)


@query(sql("L", "SELECT replace(path, '.wav', '.csv') AS path FROM L WHERE length(path) % 3 = 1 ORDER BY path LIMIT 25"))
def first_chunks(spark, sf_dir):
    return plan.first_chunks(with_companions(spark, sf_dir), 25).select("path")


@query(
    sql(
        "L",
        """SELECT replace(path, '.wav', '') AS stem, true AS has_embeddings FROM (
  SELECT path FROM L WHERE length % 4 <> 3 UNION ALL SELECT path FROM L WHERE length % 4 IN (0, 3))
GROUP BY path HAVING count(*) % 2 = 1""",
    )
)
def missing_embeddings(spark, sf_dir):
    """Batch lists without their embedding file, and embeddings without a list."""
    files, quarter = listing(spark, sf_dir), F.col("length") % 4
    lists = files.filter(quarter != 3).select(F.replace("path", F.lit(".wav"), F.lit(".txt")).alias("path"))
    parts = files.filter((quarter == 0) | (quarter == 3)).select(F.replace("path", F.lit(".wav"), F.lit(".npz")).alias("path"))
    return plan.batches_without_embeddings(lists.unionByName(parts))


@query(
    sql(
        "L",
        """SELECT path AS src, concat('landing/src1/', string_split(path, '/')[-3], '/', string_split(path, '/')[-2], '/',
  string_split(path, '/')[-1]) AS dst FROM L""",
    )
)
def move_manifest(spark, sf_dir):
    return plan.move_manifest(listing(spark, sf_dir), "landing/src1")


@query(sql("U", "SELECT DISTINCT concat('base/src1/', audio_id) AS src, concat('landing/src1/', audio_id) AS dst FROM U WHERE status = 'Clean'"))
def move_path_manifest(spark, sf_dir):
    ids = utterances(spark, sf_dir).filter("status = 'Clean'").select("audio_id").distinct()
    paths = ids.select(plan.recording_path("base/src1", F.col("audio_id")).alias("path"))
    return plan.move_path_manifest(paths, "landing/src1")


@query(
    sql(
        "US",
        f"""SELECT concat('data/', lower(source), '/', audio_id, '/clean/', stem, '.', ext) AS src,
  concat('exp/', language, '/', audio_id, '/', stem, '.', ext) AS dst
FROM (SELECT audio_id, split_part({NAME}, '.', 1) AS stem, unnest(['wav', 'txt']) AS ext FROM U WHERE status = 'Clean')
JOIN (SELECT audio_id, source, language FROM S) USING (audio_id)""",
    )
)
def copy_manifest(spark, sf_dir):
    clips = utterances(spark, sf_dir).filter("status = 'Clean'").select("audio_id", NAME)
    named = clips.join(recordings(spark, sf_dir).select("audio_id", F.upper("source").alias("source"), F.col("language").alias("experiment_name")), "audio_id")
    return plan.experiment_manifest(named, "data/", "exp/")


@query(
    sql(
        "U",
        """SELECT audio_id, concat('stt/src1/', audio_id, '/clean') AS input_path, concat('out/azure/src1/train/', audio_id) AS output_path,
  concat('stt/src1/test/', audio_id, '/clean') AS input_test, concat('out/azure/src1/test/', audio_id) AS output_test
FROM (SELECT DISTINCT audio_id FROM U)""",
    )
)
def stt_paths(spark, sf_dir):
    """Paths without and with a data set."""
    ids = utterances(spark, sf_dir).select("audio_id").distinct()
    plain = plan.stt_paths(ids, "stt", "out", "src1", "azure", "")
    test = plan.stt_paths(plain, "stt", "out", "src1", "azure", "test").select(
        "audio_id", F.col("input_path").alias("input_test"), F.col("output_path").alias("output_test")
    )
    return plain.join(test, "audio_id")


@query(
    sql(
        "UA",
        f"""SELECT audio_id, {NAME}, concat('base/', audio_id, '/clean/', {NAME}) AS clip_path, concat('base/', audio_id) AS recording_path,
  split_part({NAME}, '.', 1) AS stem, 'wav' AS ext, concat(split_part({NAME}, '.', 1), '.csv') AS companion,
  concat({NAME}, ':', CAST(clipped_utterance_duration AS VARCHAR)) AS name_and_duration,
  concat('gs/', CASE status WHEN 'Clean' THEN 'hindi' ELSE 'tamil' END, '/x') AS templated,
  data_type = 'train' AS is_train, false AS is_csv, 'corpus' AS bucket, concat(audio_id, '/', {NAME}) AS in_bucket FROM U""",
    )
)
def path_columns(spark, sf_dir):
    """Path and name columns of every utterance."""
    name, audio_id = F.col(NAME), F.col("audio_id")
    language = F.when(F.col("status") == "Clean", "hindi").otherwise("tamil")
    full = F.concat_ws("/", F.lit("corpus//"), audio_id.cast("string"), name)
    return utterances(spark, sf_dir).select(
        "audio_id",
        NAME,
        plan.clip_path("base", audio_id, name).alias("clip_path"),
        plan.recording_path("base", audio_id).alias("recording_path"),
        tx.first_stem(name).alias("stem"),
        tx.extension(name).alias("ext"),
        tx.companion_name(name, ".csv").alias("companion"),
        F.concat(name, F.lit(":"), F.col("clipped_utterance_duration").cast("string")).alias("name_and_duration"),
        tx.fill_language(F.lit("gs/{language}/x"), language).alias("templated"),
        (F.lower("data_type") == "train").alias("is_train"),
        tx.is_csv_path(name).alias("is_csv"),
        tx.bucket_of(full).alias("bucket"),
        tx.path_in_bucket(full).alias("in_bucket"),
    )


@query(
    sql(
        "U",
        f"""SELECT audio_id, {NAME}, coalesce(lower(spelled) = 'true', false) AS flag, CASE speaker_gender WHEN 'm' THEN 'male' WHEN 'f' THEN 'female'
  ELSE 'non-specified' END AS gender, CASE WHEN speaker_gender = 'm' THEN 'm' ELSE 'f' END AS letter
FROM (SELECT *, CASE audio_id % 4 WHEN 0 THEN 'True' WHEN 1 THEN 'TRUE' WHEN 2 THEN 'no' END AS spelled FROM U)""",
    )
)
def gender_map(spark, sf_dir):
    rest = F.col("audio_id") % 4
    spelled = F.when(rest == 0, "True").when(rest == 1, "TRUE").when(rest == 2, "no")
    gender = F.col("speaker_gender")
    return utterances(spark, sf_dir).select(
        "audio_id",
        NAME,
        tx.is_true(spelled).alias("flag"),
        tx.gender_name(gender).alias("gender"),
        F.when(gender == "m", "m").otherwise("f").alias("letter"),
    )


@query(
    """SELECT event_id, strftime(ts, '%d-%m-%Y_%H-%M') AS export_stamp, strftime(ts, '%m_%d_%Y_%H_%M_%S') AS report_stamp,
  substr(strftime(ts, '%Y%m%d%H%M%S%f'), 1, 18) AS time_id,
  concat('hindi_src1_', strftime(ts, '%d-%m-%Y_%H-%M'), '.zip') AS artifact FROM events"""
)
def date_labels(spark, sf_dir):
    ts = F.col("ts")
    stamp = tx.export_stamp(ts)
    return table(spark, sf_dir, "events").select(
        "event_id",
        stamp.alias("export_stamp"),
        tx.report_stamp(ts).alias("report_stamp"),
        tx.id_from_time(ts).alias("time_id"),
        tx.artifact_name(F.lit("hindi"), F.lit("src1"), stamp).alias("artifact"),
    )


@query(sql("L", "SELECT path, replace(path, 'wav', 'txt') AS text_path FROM L"))
def companion_texts(spark, sf_dir):
    return listing(spark, sf_dir).select("path", rec.companion_text(F.col("path")).alias("text_path"))


@query(sql("US", "SELECT DISTINCT audio_id FROM U WHERE status = 'Clean' AND NOT staged_for_transcription"))
def distinct_audio_ids(spark, sf_dir):
    rows = utterances(spark, sf_dir).filter("status = 'Clean' AND NOT staged_for_transcription")
    return rows.select("audio_id").distinct()


@query(
    sql(
        "UL",
        f"""SELECT concat('base/', audio_id, '/', lower(status), '/', CASE ext WHEN 'wav' THEN {NAME} ELSE concat(split_part({NAME}, '.', 1), '.txt') END) AS src,
  concat('work/', split_part({NAME}, '.', 1), '.', ext) AS dst FROM (SELECT *, unnest(['wav', 'txt']) AS ext FROM U)""",
    )
)
def download_manifest(spark, sf_dir):
    rows = utterances(spark, sf_dir).select(F.col(NAME).alias("audio_file_name"), "audio_id", "status")
    return pub.download_manifest(rows, "base", "work", labelled=True, external=False)
