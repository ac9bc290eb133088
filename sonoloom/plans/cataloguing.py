"""Queries of the catalogue: scans, eligibility, increments, speakers, state changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from sonoloom.functions.utterance_json import list_elements
from sonoloom.operators import catalog as cat
from sonoloom.operators import dedup
from sonoloom.operators import mutations as mut
from sonoloom.plans.registry import query
from sonoloom.plans.views import (
    media,
    members,
    recordings,
    reloads,
    speakers,
    sql,
    utterances,
    with_lists,
)

NAME = "clipped_utterance_file_name"
SECONDS = "clipped_utterance_duration"
MINE = "SELECT audio_id FROM S WHERE source = 'src1' AND language = 'Hindi'"


def day(column: str = "load_datetime"):
    return F.date_format(column, "yyyy-MM-dd").alias("load_day")


@query(sql("S", "SELECT audio_id, raw_file_name, source FROM S WHERE source = 'src2'"))
def scan_source(spark, sf_dir):
    return cat.scan_source(recordings(spark, sf_dir), "src2").select("audio_id", "raw_file_name", "source")


@query(sql("S", "SELECT source, count(*) AS recordings FROM S GROUP BY source"))
def scan_all_sources(spark, sf_dir):
    return cat.scan_source(recordings(spark, sf_dir), "").groupBy("source").agg(F.count(F.lit(1)).alias("recordings"))


@query(sql("US", f"SELECT audio_id, {NAME}, snr FROM U WHERE audio_id IN (SELECT audio_id FROM S WHERE source = 'src2')"))
def scan_ids(spark, sf_dir):
    ids = recordings(spark, sf_dir).filter("source = 'src2'")
    return cat.scan_ids(utterances(spark, sf_dir).select("audio_id", NAME, "snr"), ids)


@query(
    sql(
        "US",
        f"""SELECT speaker_id, {SECONDS}, snr, speaker_gender FROM U
WHERE status = 'Clean' AND staged_for_transcription AND audio_id IN ({MINE})""",
    )
)
def snapshot(spark, sf_dir):
    return cat.snapshot(utterances(spark, sf_dir), recordings(spark, sf_dir), "src1", "Hindi")


ELIGIBLE = f"""staged_for_transcription AND NOT list_contains(stt_api_used, 'google') AND coalesce(data_type, '') = 'train'"""


@query(sql("U", f"SELECT audio_id, {NAME}, {SECONDS}, snr, status FROM U WHERE {ELIGIBLE}"))
def stt_eligible(spark, sf_dir):
    rows = cat.stt_eligible(utterances(spark, sf_dir), "google", "train")
    return rows.select("audio_id", NAME, SECONDS, "snr", "status")


@query(sql("U", f"SELECT audio_id, {NAME} FROM U WHERE NOT list_contains(stt_api_used, 'azure')"))
def engine_membership(spark, sf_dir):
    return utterances(spark, sf_dir).filter(cat.engine_unused("azure")).select("audio_id", NAME)


@query(
    sql("US", f"SELECT audio_id, count(*) AS utterance_count FROM U WHERE {ELIGIBLE} AND audio_id IN ({MINE}) GROUP BY audio_id")
)
def stt_counts(spark, sf_dir):
    return cat.stt_counts(utterances(spark, sf_dir), recordings(spark, sf_dir), "src1", "Hindi", "google", "train")


@query(
    sql(
        "U",
        f"""SELECT audio_id, utterance_count, row_number() OVER (ORDER BY utterance_count DESC, audio_id) - 1 AS position
FROM (SELECT audio_id, count(*) AS utterance_count FROM U WHERE {ELIGIBLE} GROUP BY audio_id)""",
    )
)
def ids_by_count(spark, sf_dir):
    counts = (
        cat.stt_eligible(utterances(spark, sf_dir), "google", "train")
        .groupBy("audio_id")
        .agg(F.count(F.lit(1)).alias("utterance_count"))
    )
    return cat.row_index(counts, [F.col("utterance_count").desc(), F.col("audio_id").asc()], output="position")


@query(
    sql(
        "US",
        f"""SELECT S.audio_id, coalesce(n, 0) AS utterances, coalesce(seconds, 0) AS seconds FROM S LEFT JOIN (
  SELECT audio_id, count(*) AS n, sum({SECONDS}) AS seconds FROM U WHERE {ELIGIBLE} GROUP BY audio_id) USING (audio_id)
WHERE source = 'src1'""",
    )
)
def eligible_json(spark, sf_dir):
    """Eligible utterances of each recording as JSON, counted from the text."""
    ids = recordings(spark, sf_dir).filter("source = 'src1'")
    lists = cat.eligible_json(utterances(spark, sf_dir), ids, "google", "train")
    parsed = F.from_json("utterances_files_list", "array<struct<name:string,duration:double,snr_value:double,status:string>>")
    total = F.aggregate(parsed, F.lit(0.0), lambda s, u: s + u["duration"])
    return lists.groupBy("audio_id").agg(
        F.sum(F.size(parsed)).cast("bigint").alias("utterances"), F.sum(total).alias("seconds")
    )


@query(
    sql(
        "U",
        f"""SELECT {NAME}, min(audio_id) AS audio_id, min_by(snr, audio_id) AS snr FROM (
  SELECT {NAME} FROM U WHERE audio_id % 40 = 0
  UNION SELECT concat('absent_', audio_id, '.wav') FROM U WHERE audio_id % 400 = 0)
LEFT JOIN U USING ({NAME}) GROUP BY {NAME}""",
    )
)
def find_by_name(spark, sf_dir):
    clips = utterances(spark, sf_dir).select(NAME, "audio_id", "snr")
    wanted = clips.filter("audio_id % 40 = 0").select(NAME)
    absent = clips.filter("audio_id % 400 = 0").select(F.concat(F.lit("absent_"), F.col("audio_id").cast("string"), F.lit(".wav")).alias(NAME))
    return cat.find_by_name(clips, wanted.unionByName(absent), ["audio_id"])


@query(sql("M", "SELECT strftime(max(load_datetime), '%Y-%m-%d') AS load_day FROM M"))
def load_high_water(spark, sf_dir):
    return cat.load_high_water(media(recordings(spark, sf_dir))).select(day("high_water"))


@query(
    sql(
        "RM",
        """SELECT audio_id, raw_file_name, strftime(load_datetime, '%Y-%m-%d') AS load_day FROM R
WHERE load_datetime = (SELECT max(load_datetime) FROM R AS r2 WHERE r2.audio_id = R.audio_id)
  AND speaker_name IS NOT NULL AND load_datetime > (SELECT max(load_datetime) FROM M)""",
    )
)
def media_increment(spark, sf_dir):
    staging = recordings(spark, sf_dir)
    rows = cat.media_increment(reloads(staging), media(staging))
    return rows.select("audio_id", "raw_file_name", day())


@query(
    sql(
        "R",
        """SELECT audio_id, raw_file_name FROM R
WHERE load_datetime = (SELECT max(load_datetime) FROM R AS r2 WHERE r2.audio_id = R.audio_id)
  AND speaker_name IS NOT NULL""",
    )
)
def media_first_load(spark, sf_dir):
    """First load: with no media yet, everything is copied."""
    staging = recordings(spark, sf_dir)
    return cat.media_increment(reloads(staging), staging.limit(0)).select("audio_id", "raw_file_name")


@query(
    sql(
        "R",
        """SELECT audio_id, raw_file_name, strftime(load_datetime, '%Y-%m-%d') AS load_day, speaker_name FROM R
WHERE load_datetime = (SELECT max(load_datetime) FROM R AS r2 WHERE r2.audio_id = R.audio_id)""",
    )
)
def latest_load(spark, sf_dir):
    rows = dedup.latest_with_ties(reloads(recordings(spark, sf_dir)), "audio_id", "load_datetime")
    return rows.select("audio_id", "raw_file_name", day(), "speaker_name")


NEW_SPEAKERS = """SELECT speaker_name, source, min(speaker_gender) AS gender, min(mother_tongue) AS mother_tongue,
  min(age_group) AS age_group, strftime(min(load_datetime), '%Y-%m-%d') AS load_day
FROM S WHERE speaker_name IS NOT NULL AND speaker_name NOT IN (SELECT speaker_name FROM P) GROUP BY speaker_name, source"""


@query(sql("SP", NEW_SPEAKERS))
def new_speakers(spark, sf_dir):
    staging = recordings(spark, sf_dir)
    rows = cat.new_speakers(staging, speakers(staging))
    return rows.select("speaker_name", "source", "gender", "mother_tongue", "age_group", day())


@query(
    sql(
        "SP",
        f"""SELECT CAST(row_number() OVER (ORDER BY speaker_name, source) + (SELECT max(speaker_id) FROM P) AS BIGINT) AS speaker_id,
  speaker_name, source FROM ({NEW_SPEAKERS})""",
    )
)
def surrogate_keys(spark, sf_dir):
    staging = recordings(spark, sf_dir)
    known = speakers(staging)
    rows = cat.assign_ids(cat.new_speakers(staging, known), known, "speaker_id", ["speaker_name", "source"])
    return rows.select(F.col("speaker_id").cast("bigint").alias("speaker_id"), "speaker_name", "source")


@query(sql("S", "SELECT raw_file_name, audio_id AS natural_key, 100 + row_number() OVER (ORDER BY raw_file_name, audio_id) AS audio_id FROM S"))
def audio_id_sequence(spark, sf_dir):
    """New audio ids from 101 in natural-key order."""
    rows = recordings(spark, sf_dir).select("raw_file_name", F.col("audio_id").alias("natural_key"))
    return cat.assign_ids(rows, None, "audio_id", ["raw_file_name", "natural_key"], cat.FIRST_AUDIO_ID)


@query(
    sql(
        "SP",
        """SELECT speaker_id, speaker_name, source FROM P UNION ALL
SELECT CAST(row_number() OVER (ORDER BY speaker_name, source) + (SELECT max(speaker_id) FROM P) AS INTEGER), speaker_name, source
FROM (SELECT DISTINCT speaker_name, source FROM S WHERE speaker_name IS NOT NULL
      AND speaker_name NOT IN (SELECT speaker_name FROM P))""",
    )
)
def speaker_table(spark, sf_dir):
    """The speaker table after unseen speakers were added."""
    staging = recordings(spark, sf_dir)
    known = speakers(staging)
    for name, kind in (("gender", "string"), ("mother_tongue", "string"), ("age_group", "string"), ("voice_signature", "string"), ("load_datetime", "timestamp_ntz")):
        known = known.withColumn(name, F.lit(None).cast(kind))
    return mut.add_speakers(known, staging).select("speaker_id", "speaker_name", "source")


LOOKUP = """SELECT S.audio_id, min(P.speaker_id) AS speaker_id FROM S JOIN P ON S.speaker_name = P.speaker_name GROUP BY S.audio_id"""


@query(sql("SP", LOOKUP))
def speaker_lookup(spark, sf_dir):
    staging = recordings(spark, sf_dir)
    return cat.speaker_lookup(staging, speakers(staging))


@query(
    sql(
        "SKMP",
        f"""SELECT K.audio_id, Q.speaker_id, K.{NAME}, K.{SECONDS}, strftime(M.load_datetime, '%Y-%m-%d') AS load_day,
  K.snr, K.status, coalesce(K.fail_reason, '') AS fail_reason
FROM M JOIN K ON M.audio_id = K.audio_id JOIN ({LOOKUP}) Q ON Q.audio_id = M.audio_id
WHERE M.audio_id IN (SELECT audio_id FROM S WHERE NOT is_normalized AND speaker_name IS NOT NULL)""",
    )
)
def mapping_rows(spark, sf_dir):
    staging = with_lists(spark, sf_dir)
    rows = cat.mapping_known_speaker(staging, media(staging), speakers(staging))
    return rows.select("audio_id", "speaker_id", NAME, SECONDS, day(), "snr", "status", "fail_reason")


@query(
    sql(
        "SK",
        f"""SELECT K.audio_id, CAST(NULL AS INTEGER) AS speaker_id, K.{NAME}, K.{SECONDS},
  strftime(S.load_datetime, '%Y-%m-%d') AS load_day, K.snr, K.status, coalesce(K.fail_reason, '') AS fail_reason
FROM S JOIN K USING (audio_id) WHERE NOT is_normalized AND speaker_name IS NULL""",
    )
)
def mapping_rows_unknown(spark, sf_dir):
    rows = cat.mapping_unknown_speaker(with_lists(spark, sf_dir))
    return rows.select("audio_id", "speaker_id", NAME, SECONDS, day(), "snr", "status", "fail_reason")


@query(
    sql(
        "SUK",
        """SELECT audio_id, is_normalized OR (speaker_name IS NULL AND (audio_id % 50 IN (1, 2)
    OR audio_id IN (SELECT audio_id FROM U))) AS is_normalized FROM S""",
    )
)
def normalised_flags(spark, sf_dir):
    """Flags after the load of recordings without a speaker."""
    staging = with_lists(spark, sf_dir).select("audio_id", "speaker_name", "is_normalized", "utterances_files_list", "load_datetime")
    return mut.mark_normalised(staging, cat.normalised_ids(staging, False)).select("audio_id", "is_normalized")


@query(
    sql(
        "SK",
        f"""SELECT K.audio_id, K.{NAME} FROM S JOIN K USING (audio_id)
WHERE NOT is_normalized AND speaker_name IS NULL AND snr % 2 = 1""",
    )
)
def insert_absent(spark, sf_dir):
    """A rerun adds only the rows that are missing."""
    rows = cat.mapping_unknown_speaker(with_lists(spark, sf_dir))
    present = rows.filter("snr % 2 = 0")
    return cat.insert_absent(present, rows).select("audio_id", NAME)


OLD = "(SELECT * FROM S WHERE load_datetime < TIMESTAMP '1995-02-01')"
IS_KNOWN = f"(raw_file_name IN (SELECT raw_file_name FROM {OLD}) OR media_hash_code IN (SELECT media_hash_code FROM {OLD}))"
INCOMING = "SELECT audio_id FROM S WHERE load_datetime >= TIMESTAMP '1995-02-01' AND"


def _known(spark, sf_dir):
    """The recordings of the first month as catalogue, all later ones as incoming."""
    staging = recordings(spark, sf_dir).select("audio_id", "raw_file_name", "media_hash_code", "load_datetime")
    early = F.col("load_datetime") < F.expr("timestamp_ntz '1995-02-01'")
    return staging.filter(~early).drop("load_datetime"), staging.filter(early)


@query(sql("S", f"{INCOMING} {IS_KNOWN}"))
def dup_by_name_or_hash(spark, sf_dir):
    return dedup.known_by_name_or_hash(*_known(spark, sf_dir)).select("audio_id")


@query(sql("S", f"{INCOMING} NOT {IS_KNOWN}"))
def new_by_name_and_hash(spark, sf_dir):
    return dedup.unknown_by_name_or_hash(*_known(spark, sf_dir)).select("audio_id")


# rows are taken one by one in order, with the names and hashes accepted so far as lists of their numbers
IN_ORDER = """, D AS MATERIALIZED (SELECT audio_id, raw_file_name, n, h, row_number() OVER (ORDER BY load_datetime, audio_id) AS k FROM (
  SELECT *, dense_rank() OVER (ORDER BY raw_file_name) AS n, dense_rank() OVER (ORDER BY media_hash_code) AS h FROM S
  QUALIFY row_number() OVER (PARTITION BY raw_file_name, media_hash_code ORDER BY load_datetime, audio_id) = 1)),
W AS (
  SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS names, CAST([] AS BIGINT[]) AS hashes, CAST(NULL AS BIGINT) AS audio_id, CAST(NULL AS VARCHAR) AS raw_file_name
  UNION ALL
  SELECT D.k, CASE WHEN fresh THEN list_append(names, n) ELSE names END, CASE WHEN fresh THEN list_append(hashes, h) ELSE hashes END,
    CASE WHEN fresh THEN D.audio_id END, CASE WHEN fresh THEN D.raw_file_name END
  FROM (SELECT W.k, names, hashes, D.*, NOT list_contains(names, n) AND NOT list_contains(hashes, h) AS fresh FROM W JOIN D ON D.k = W.k + 1) D)
SELECT audio_id, raw_file_name FROM W WHERE audio_id IS NOT NULL"""


@query(sql("S", "").replace("WITH ", "WITH RECURSIVE ", 1) + IN_ORDER.replace("SELECT W.k, names, hashes, D.*,", "SELECT names, hashes, D.*,"))
def batch_dedup_exact(spark, sf_dir):
    """Recordings accepted when taken in load order, each against those accepted before it."""
    batch = recordings(spark, sf_dir).select("audio_id", "raw_file_name", "media_hash_code", "load_datetime")
    return dedup.reject_in_order(batch, "audio_id", ["load_datetime", "audio_id"]).select("audio_id", "raw_file_name")


MAPPING = ["audio_id", NAME, "speaker_id", "snr", "status", "fail_reason", "staged_for_transcription", "data_type",
           "is_transcribed", "stt_api_used", "was_noise", "speaker_gender", "labelled_artifact_name"]


def mapping(spark, sf_dir):
    return utterances(spark, sf_dir).select(*MAPPING)


@query(
    sql(
        "US",
        f"""SELECT audio_id, {NAME}, hit OR staged_for_transcription AS staged_for_transcription,
  CASE WHEN hit THEN 'valid' ELSE data_type END AS data_type FROM (
  SELECT *, snr > 40 AND audio_id IN ({MINE}) AS hit FROM U)""",
    )
)
def stage_update(spark, sf_dir):
    rows = mapping(spark, sf_dir)
    chosen = rows.filter("snr > 40").select(NAME)
    changed = mut.stage_utterances(rows, recordings(spark, sf_dir), chosen, "src1", "Hindi", "valid")
    return changed.select("audio_id", NAME, "staged_for_transcription", "data_type")


@query(
    sql(
        "S",
        """SELECT audio_id, CASE WHEN source = 'src1' AND language = 'Hindi' AND audio_id % 3 = 0 THEN 'valid'
  ELSE data_set_used_for END AS data_set_used_for FROM S""",
    )
)
def name_list_update(spark, sf_dir):
    """Data set noted on the recordings of a list, within one source and language."""
    staging = recordings(spark, sf_dir).select("audio_id", "source", "language", "data_set_used_for")
    ids = staging.filter("audio_id % 3 = 0").select("audio_id")
    return mut.tag_recordings(staging, ids, "src1", "Hindi", "valid").select("audio_id", "data_set_used_for")


@query(
    sql(
        "U",
        f"""SELECT audio_id, {NAME}, CASE WHEN hit THEN CASE WHEN bad THEN 'Rejected' ELSE 'Clean' END ELSE status END AS status,
  CASE WHEN hit AND bad THEN 'STT API error:no match' ELSE NULL END AS fail_reason,
  CASE WHEN hit THEN CASE WHEN is_transcribed THEN true ELSE NOT bad END ELSE is_transcribed END AS is_transcribed,
  array_to_string(CASE WHEN hit THEN list_sort(list_distinct(list_append(stt_api_used, 'azure'))) ELSE stt_api_used END, ',') AS engines
FROM (SELECT *, audio_id % 4 = 1 AS hit, snr < 10 AS bad FROM U)""",
    )
)
def transcribe_update(spark, sf_dir):
    rows = mapping(spark, sf_dir)
    bad = F.col("snr") < 10
    outcomes = rows.filter("audio_id % 4 = 1").select(
        "audio_id",
        NAME,
        F.when(bad, "Rejected").otherwise("Clean").alias("status"),
        F.when(bad, "STT API error:no match").alias("reason"),
        (~bad).alias("is_transcribed"),
        F.lit("azure").alias("engine"),
    )
    changed = mut.transcription_outcome(rows, outcomes)
    return changed.select(
        "audio_id", NAME, "status", "fail_reason", "is_transcribed", F.concat_ws(",", "stt_api_used").alias("engines")
    )


@query(
    sql(
        "UB",
        f"""SELECT U.audio_id, U.{NAME}, coalesce(CAST(U.speaker_id + 5000 AS INTEGER), U.speaker_id) AS speaker_id,
  B.was_noise FROM U LEFT JOIN B USING ({NAME})""",
    )
)
def speaker_assign(spark, sf_dir):
    """Cluster membership written to the utterances by file name."""
    found = members(spark, sf_dir)
    number = F.substring_index("speaker_name", "_", -1).cast("int")
    ids = found.select("speaker_name").distinct().withColumn("speaker_id", number + 5000)
    changed = mut.assign_speakers(mapping(spark, sf_dir), ids, found.select("speaker_name", NAME, "was_noise"))
    return changed.select("audio_id", NAME, "speaker_id", "was_noise")


@query(
    sql(
        "B",
        """SELECT speaker_name, 'src0' AS source, CAST(CASE WHEN n % 2 = 0 THEN n + 1
    ELSE max(CASE WHEN n % 2 = 0 THEN n + 1 END) OVER () + row_number() OVER (PARTITION BY n % 2 ORDER BY speaker_name) END AS INTEGER) AS speaker_id
  FROM (SELECT DISTINCT speaker_name, CAST(split_part(speaker_name, '_', 3) AS INTEGER) AS n FROM B)""",
    )
)
def speaker_upsert(spark, sf_dir):
    """Cluster names added once per source with ids after the greatest; names it already has keep theirs."""
    names = members(spark, sf_dir).select("speaker_name").distinct()
    number = F.substring_index("speaker_name", "_", -1).cast("int")
    known = names.filter(number % 2 == 0).select((number + 1).alias("speaker_id"), "speaker_name", F.lit("src0").alias("source"))
    return mut.upsert_speakers(known, names, "src0").select("speaker_name", "source", "speaker_id")


@query(
    sql(
        "SU",
        f"""SELECT S.audio_id, CASE WHEN C.audio_id IS NULL THEN S.language ELSE last_status END AS language,
  coalesce(S.is_normalized, false) OR coalesce(any_true, false) AS is_normalized, array_to_string(coalesce(engines, []), ',') AS engines
FROM S LEFT JOIN (
  SELECT audio_id, (max({{'seq': seq, 'status': status}})).status AS last_status, bool_or(is_transcribed) AS any_true, list_sort(list_distinct(flatten(list(stt_api_used)))) AS engines
  FROM (SELECT *, CAST(split_part({NAME}, '_', 1) AS BIGINT) AS seq FROM U) GROUP BY audio_id) C USING (audio_id)""",
    )
)
def changes_in_turn(spark, sf_dir):
    """Several changes of one recording in one log, by sequence: the last value, a flag that stays true, a growing set."""
    log = utterances(spark, sf_dir).select(
        "audio_id",
        F.split_part(NAME, F.lit("_"), F.lit(1)).cast("bigint").alias("seq"),
        F.col("status").alias("language"),
        F.col("is_transcribed").alias("is_normalized"),
        F.col("stt_api_used").alias("engines"),
    )
    rows = recordings(spark, sf_dir).select("audio_id", "language", "is_normalized", F.array().cast("array<string>").alias("engines"))
    rules = {"language": mut.take_new, "is_normalized": mut.STICKY_TRUE, "engines": mut.ENGINE_UNION}
    done = mut.apply_changes(rows, log, ["audio_id"], rules, ["seq"])
    return done.select("audio_id", "language", F.coalesce("is_normalized", F.lit(False)).alias("is_normalized"), F.concat_ws(",", "engines").alias("engines"))


@query(
    sql(
        "U",
        f"""SELECT audio_id, {NAME}, 'spk_' || split_part({NAME}, '_', 1) AS speaker_name, CASE WHEN snr % 2 = 0 THEN 'm' ELSE 'f' END AS speaker_gender FROM U""",
    )
)
def assigned_in_turn(spark, sf_dir):
    """Speaker and gender given several times for each file; the later assignment stands."""
    rows = mapping(spark, sf_dir)
    number = F.split_part(NAME, F.lit("_"), F.lit(1)).cast("int")
    ids = rows.select(F.concat(F.lit("spk_"), number.cast("string")).alias("speaker_name"), number.alias("speaker_id")).distinct()
    wrong = F.concat(F.lit("spk_"), (number % 3 + 1).cast("string"))
    named = [rows.select(NAME, who.alias("speaker_name"), F.lit(False).alias("was_noise")) for who in (wrong, F.concat(F.lit("spk_"), number.cast("string")))]
    placed = mut.assign_speakers(rows, ids, mut.change_log(named), ["change"])
    letters = [rows.select(NAME, letter.alias("gender")) for letter in (F.lit("m"), F.when(F.col("snr") % 2 == 0, "m").otherwise("f"))]
    done = mut.assign_gender(placed, mut.change_log(letters), ["change"])
    return done.select("audio_id", NAME, F.concat(F.lit("spk_"), F.col("speaker_id").cast("string")).alias("speaker_name"), "speaker_gender")


@query(
    sql(
        "U",
        f"""SELECT audio_id, {NAME}, CASE WHEN snr % 5 = 0 THEN 'm' WHEN snr % 5 IN (1, 2) THEN 'f' ELSE speaker_gender END AS speaker_gender FROM U""",
    )
)
def gender_assign(spark, sf_dir):
    rows = mapping(spark, sf_dir)
    predicted = rows.filter("snr % 5 < 3").select(
        NAME, F.when(F.col("snr") % 5 == 0, "m").when(F.col("snr") % 5 == 1, "f").otherwise("?").alias("gender")
    )
    return mut.assign_gender(rows, predicted).select("audio_id", NAME, "speaker_gender")


@query(
    sql(
        "U",
        f"""SELECT audio_id, {NAME}, CASE WHEN status = 'Clean' AND audio_id % 3 = 0 THEN 'hindi_src1_now.zip'
  ELSE labelled_artifact_name END AS labelled_artifact_name FROM U""",
    )
)
def artifact_update(spark, sf_dir):
    rows = mapping(spark, sf_dir)
    exported = rows.filter("status = 'Clean' AND audio_id % 3 = 0").select("audio_id", NAME)
    return mut.record_artifact(rows, exported, "hindi_src1_now.zip", True).select("audio_id", NAME, "labelled_artifact_name")


@query(
    sql(
        "U",
        f"""SELECT audio_id, {NAME}, CASE WHEN audio_id % 6 = 0 THEN 'b' WHEN audio_id % 2 = 0 THEN 'a' ELSE status END AS status FROM U""",
    )
)
def bulk_apply(spark, sf_dir):
    """Two change sets in one pass; the later one wins."""
    rows = utterances(spark, sf_dir).select("audio_id", NAME, "status")
    first = rows.filter("audio_id % 2 = 0").withColumn("status", F.lit("a"))
    second = rows.filter("audio_id % 6 = 0").withColumn("status", F.lit("b"))
    return mut.bulk_apply(rows, [first, second], ["audio_id", NAME], ["status"])


@query(sql("U", "SELECT count(*) AS changed FROM U WHERE audio_id % 2 = 0"))
def bulk_apply_count(spark, sf_dir):
    rows = utterances(spark, sf_dir).select("audio_id", NAME, "status")
    return mut.changed_count(rows, rows.filter("audio_id % 2 = 0"), ["audio_id", NAME])


@query(
    sql(
        "SU",
        f"""SELECT S.audio_id, CASE WHEN S.audio_id % 50 = 1 THEN -1 WHEN S.audio_id % 50 = 2 THEN 0
  ELSE coalesce(n, -1) END AS elements FROM S LEFT JOIN (SELECT audio_id, count(*) AS n FROM U GROUP BY audio_id) USING (audio_id)""",
    )
)
def list_lengths(spark, sf_dir):
    staging = with_lists(spark, sf_dir)
    elements = F.coalesce(F.size(list_elements(F.col("utterances_files_list"))), F.lit(-1))
    return staging.select("audio_id", F.greatest(elements, F.lit(-1)).cast("bigint").alias("elements"))
