"""Catalogue-shaped views over the given tables, in Spark and, for checking, in SQL.

The given tables hold no speech catalogue, so utterances come from ``lineitem``, recordings
from ``orders``, stored files from both, frames from ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STORE = "data/processed/hindi"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    name = F.concat_ws("_", "l_linenumber", "l_orderkey", "l_partkey", "l_suppkey")
    snr, duration = (F.col("l_partkey") % 61).cast("double"), F.col("l_quantity") / 2
    flag = F.col("l_returnflag")
    third = F.col("l_linenumber") % 3
    return rows.select(
        F.col("l_orderkey").alias("audio_id"),
        F.concat(name, F.lit(".wav")).alias("clipped_utterance_file_name"),
        F.when(F.col("l_suppkey") % 11 != 0, F.col("l_suppkey").cast("int")).alias("speaker_id"),
        duration.alias("clipped_utterance_duration"),
        snr.alias("snr"),
        F.when((snr < 15) | (duration > 15), "Rejected").otherwise("Clean").alias("status"),
        (F.col("l_linestatus") == "F").alias("staged_for_transcription"),
        F.when(flag == "A", F.array(F.lit("azure")))
        .when(flag == "N", F.array(F.lit("google")))
        .otherwise(F.array().cast("array<string>"))
        .alias("stt_api_used"),
        F.when(flag == "A", True).when(flag == "N", False).alias("is_transcribed"),
        F.when(third == 1, "train").when(third == 2, "test").alias("data_type"),
        F.when(F.col("l_suppkey") % 3 == 0, "m").when(F.col("l_suppkey") % 3 == 1, "f").alias("speaker_gender"),
        F.lit(None).cast("string").alias("fail_reason"),
        F.lit(None).cast("boolean").alias("was_noise"),
        F.when(F.col("l_partkey") % 7 == 0, "old.zip").alias("labelled_artifact_name"),
        F.when(F.col("l_partkey") % 5 == 0, "old.zip").alias("unlabelled_artifact_name"),
    )


UTTERANCES_SQL = """U AS (
  SELECT l_orderkey AS audio_id,
    concat(l_linenumber, '_', l_orderkey, '_', l_partkey, '_', l_suppkey, '.wav') AS clipped_utterance_file_name,
    CASE WHEN l_suppkey % 11 <> 0 THEN CAST(l_suppkey AS INTEGER) END AS speaker_id,
    l_quantity / 2 AS clipped_utterance_duration,
    CAST(l_partkey % 61 AS DOUBLE) AS snr,
    CASE WHEN l_partkey % 61 < 15 OR l_quantity / 2 > 15 THEN 'Rejected' ELSE 'Clean' END AS status,
    l_linestatus = 'F' AS staged_for_transcription,
    CASE l_returnflag WHEN 'A' THEN ['azure'] WHEN 'N' THEN ['google'] ELSE CAST([] AS VARCHAR[]) END AS stt_api_used,
    CASE l_returnflag WHEN 'A' THEN true WHEN 'N' THEN false END AS is_transcribed,
    CASE l_linenumber % 3 WHEN 1 THEN 'train' WHEN 2 THEN 'test' END AS data_type,
    CASE l_suppkey % 3 WHEN 0 THEN 'm' WHEN 1 THEN 'f' END AS speaker_gender,
    CAST(NULL AS VARCHAR) AS fail_reason,
    CAST(NULL AS BOOLEAN) AS was_noise,
    CASE WHEN l_partkey % 7 = 0 THEN 'old.zip' END AS labelled_artifact_name,
    CASE WHEN l_partkey % 5 = 0 THEN 'old.zip' END AS unlabelled_artifact_name
  FROM lineitem)"""


def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging rows without their utterance lists."""
    cust, status = F.col("o_custkey"), F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("audio_id"),
        F.concat(F.lit("rec_"), (cust % 500).cast("string"), F.lit("_"), F.substring("o_orderpriority", 1, 1), F.lit(".mp4")).alias(
            "raw_file_name"
        ),
        F.concat(F.lit("src"), (cust % 5).cast("string")).alias("source"),
        F.when(status == "P", "Hindi").when(status == "O", "Tamil").otherwise("Telugu").alias("language"),
        F.when(cust % 7 != 0, F.concat(F.lit("spk_"), (cust % 300).cast("string"))).alias("speaker_name"),
        F.when(cust % 3 == 0, "train").when(cust % 3 == 2, "test").alias("data_set_used_for"),
        F.md5((cust % 800).cast("string")).alias("media_hash_code"),
        F.col("o_orderdate").alias("load_datetime"),
        (F.col("o_orderkey") % 4 == 0).alias("is_normalized"),
        F.concat(F.lit("http://host/"), (cust % 50).cast("string")).alias("source_url"),
        F.concat(F.lit("site"), (cust % 9).cast("string")).alias("source_website"),
        F.when(cust % 2 == 0, "m").otherwise("f").alias("speaker_gender"),
        F.when(cust % 4 != 0, F.concat(F.lit("tongue"), (cust % 6).cast("string"))).alias("mother_tongue"),
        F.concat((cust % 5 * 10).cast("string"), F.lit("+")).alias("age_group"),
        F.col("o_totalprice").alias("duration"),
    )


RECORDINGS_SQL = """S AS (
  SELECT o_orderkey AS audio_id,
    concat('rec_', o_custkey % 500, '_', substr(o_orderpriority, 1, 1), '.mp4') AS raw_file_name,
    concat('src', o_custkey % 5) AS source,
    CASE o_orderstatus WHEN 'P' THEN 'Hindi' WHEN 'O' THEN 'Tamil' ELSE 'Telugu' END AS language,
    CASE WHEN o_custkey % 7 <> 0 THEN concat('spk_', o_custkey % 300) END AS speaker_name,
    CASE o_custkey % 3 WHEN 0 THEN 'train' WHEN 2 THEN 'test' END AS data_set_used_for,
    md5(CAST(o_custkey % 800 AS VARCHAR)) AS media_hash_code,
    o_orderdate AS load_datetime,
    o_orderkey % 4 = 0 AS is_normalized,
    concat('http://host/', o_custkey % 50) AS source_url,
    concat('site', o_custkey % 9) AS source_website,
    CASE WHEN o_custkey % 2 = 0 THEN 'm' ELSE 'f' END AS speaker_gender,
    CASE WHEN o_custkey % 4 <> 0 THEN concat('tongue', o_custkey % 6) END AS mother_tongue,
    concat(o_custkey % 5 * 10, '+') AS age_group,
    o_totalprice AS duration
  FROM orders)"""


def reloads(staging: DataFrame) -> DataFrame:
    """Staging plus a second load, five days later, of every tenth recording."""
    again = staging.filter(F.col("audio_id") % 10 == 0).select(
        *[
            (F.col(c) + F.expr("interval 5 days")).alias(c)
            if c == "load_datetime"
            else F.when(F.col("audio_id") % 20 != 0, F.col(c)).alias(c)
            if c == "speaker_name"
            else F.col(c)
            for c in staging.columns
        ]
    )
    return staging.unionByName(again)


RELOADS_SQL = """R AS (
  SELECT * FROM S UNION ALL
  SELECT * REPLACE (load_datetime + INTERVAL 5 DAY AS load_datetime,
                    CASE WHEN audio_id % 20 <> 0 THEN speaker_name END AS speaker_name)
  FROM S WHERE audio_id % 10 = 0)"""


def with_lists(spark: SparkSession, sf_dir: str, staging: DataFrame | None = None) -> DataFrame:
    """Staging with the utterance JSON of each recording.

    Some recordings have no list, an empty one, or the old ``name:duration`` form.  A recording
    is one staging row, however many utterances it has.
    """
    rows = staging if staging is not None else recordings(spark, sf_dir)
    status, snr, name = F.col("status"), F.col("snr"), F.col("clipped_utterance_file_name")
    element = F.struct(
        name.alias("name"),
        F.col("clipped_utterance_duration").cast("string").alias("duration"),
        F.when(snr == 7, F.lit(float("nan"))).otherwise(snr).alias("snr_value"),
        status.alias("status"),
        F.when(status == "Rejected", F.when(snr < 15, "High-SNR").otherwise("High Audio Duration")).alias("reason"),
    )
    old_form = F.transform("_list", lambda u: F.concat_ws(":", u["name"], u["duration"]))
    lists = (
        utterances(spark, sf_dir)
        .groupBy("audio_id")
        .agg(F.sort_array(F.collect_list(element)).alias("_list"))
        .withColumn("_list", F.when(F.col("audio_id") % 50 == 3, F.to_json(old_form)).otherwise(F.to_json("_list")))
    )
    special = F.when(F.col("audio_id") % 50 == 1, "null").when(F.col("audio_id") % 50 == 2, "[]")
    # The list texts are the bulk of the data and compress well: keep adaptive execution from broadcasting them.
    joined = rows.join(lists.hint("merge"), "audio_id", "left").withColumn("utterances_files_list", F.coalesce(special, F.col("_list")))
    return joined.drop("_list")


# Utterances that an unreadable, empty or missing list does not hold are left out; the old
# form has no status and no quality.
LISTED_SQL = """K AS (
  SELECT audio_id, clipped_utterance_file_name, clipped_utterance_duration,
    CASE WHEN audio_id % 50 = 3 THEN '' ELSE status END AS status,
    CASE WHEN audio_id % 50 = 3 OR snr = 7 THEN 0.0 ELSE snr END AS snr,
    CASE WHEN audio_id % 50 <> 3 AND status = 'Rejected'
         THEN CASE WHEN snr < 15 THEN 'High-SNR' ELSE 'High Audio Duration' END END AS fail_reason
  FROM U WHERE audio_id % 50 NOT IN (1, 2))"""


def media(staging: DataFrame) -> DataFrame:
    """The part of staging that was loaded before."""
    return staging.filter(F.col("load_datetime") < F.expr("timestamp_ntz '1997-01-01'"))


MEDIA_SQL = "M AS (SELECT * FROM S WHERE load_datetime < TIMESTAMP '1997-01-01')"


def speakers(staging: DataFrame) -> DataFrame:
    """Speaker rows ``spk_0`` .. ``spk_149`` with ids from 1, of the names that staging has."""
    number = F.substring_index("speaker_name", "_", -1).cast("int")
    return (
        staging.filter(F.col("speaker_name").isNotNull())
        .select((number + 1).alias("speaker_id"), "speaker_name")
        .filter(number < 150)
        .distinct()
        .withColumn("source", F.lit("src0"))
    )


SPEAKERS_SQL = """P AS (
  SELECT DISTINCT CAST(split_part(speaker_name, '_', 2) AS INTEGER) + 1 AS speaker_id, speaker_name, 'src0' AS source
  FROM S WHERE CAST(split_part(speaker_name, '_', 2) AS INTEGER) < 150)"""


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored files: most utterances, and orphans that no recording knows."""
    sources = recordings(spark, sf_dir).select("audio_id", "source")
    name, audio_id = F.col("clipped_utterance_file_name"), F.col("audio_id")
    kept = utterances(spark, sf_dir).filter(F.col("snr") % 10 != 3).join(sources, "audio_id")
    level = F.when(audio_id % 2 == 0, "train")
    path = F.concat_ws("/", F.lit(STORE), "source", level, audio_id.cast("string"), F.lower("status"), name)
    stored = kept.select(path.alias("path"), (F.length(name) * 100 + audio_id % 97).cast("bigint").alias("length"))
    event = F.col("event_id")
    orphans = table(spark, sf_dir, "events").select(
        F.concat(
            F.lit(f"{STORE}/src0/"), (event + 900_000_000).cast("string"), F.lit("/clean/"), event.cast("string"), F.lit("_orphan.wav")
        ).alias("path"),
        (F.length(event.cast("string")) * 100).cast("bigint").alias("length"),
    )
    return stored.unionByName(orphans)


LISTING_SQL = f"""L AS (
  SELECT concat_ws('/', '{STORE}', source, CASE WHEN audio_id % 2 = 0 THEN 'train' END, audio_id,
                   lower(status), clipped_utterance_file_name) AS path,
    CAST(length(clipped_utterance_file_name) * 100 + audio_id % 97 AS BIGINT) AS length
  FROM U JOIN (SELECT audio_id, source FROM S) USING (audio_id) WHERE snr % 10 <> 3
  UNION ALL
  SELECT concat('{STORE}/src0/', event_id + 900000000, '/clean/', event_id, '_orphan.wav'),
    CAST(length(CAST(event_id AS VARCHAR)) * 100 AS BIGINT)
  FROM events)"""

ATTRIBUTES_SQL = f"""A0 AS (
  SELECT path, string_split(substr(path, length('{STORE}/') + 1), '/') AS p FROM L),
A AS (
  SELECT path AS bucket_file_path, p[1] AS source,
    CAST(CASE WHEN p[2] = 'train' THEN p[3] ELSE p[2] END AS BIGINT) AS audio_id,
    split_part(substr(p[-1], instr(p[-1], '_') + 1), '.', 1) AS raw_file_name,
    p[-1] AS utterances_file_name,
    CASE WHEN p[2] = 'train' THEN p[4] ELSE p[3] END AS status
  FROM A0)"""

# Exploded catalogue: a recording without elements keeps one empty row.
EXPLODED_SQL = """X AS (
  SELECT S.*, K.clipped_utterance_file_name AS utterances_file_name,
    K.clipped_utterance_duration AS utterances_file_duration, K.status AS utterances_file_status,
    coalesce(K.snr, 0.0) AS snr, K.fail_reason
  FROM S LEFT JOIN K ON S.audio_id = K.audio_id)"""


def flag_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", (F.col("value") > 20).alias("flag"), (F.col("value") > 40).alias("strict_flag")
    )


FLAGS_SQL = """F AS (
  SELECT user_id, ts, event_id, value > 20 AS flag, value > 40 AS strict_flag,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx
  FROM events)"""


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Utterances with a cluster name, a stored path and a noise flag."""
    name = F.col("clipped_utterance_file_name")
    return utterances(spark, sf_dir).filter(F.col("speaker_id").isNotNull()).select(
        F.concat(F.lit("src0_sp_"), F.col("speaker_id").cast("string")).alias("speaker_name"),
        F.concat_ws("/", F.lit(STORE), F.col("audio_id").cast("string"), name).alias("path"),
        (F.col("snr") % 2 == 0).alias("was_noise"),
        name,
        "audio_id",
    )


MEMBERS_SQL = f"""B AS (
  SELECT concat('src0_sp_', speaker_id) AS speaker_name,
    concat_ws('/', '{STORE}', audio_id, clipped_utterance_file_name) AS path,
    snr % 2 = 0 AS was_noise, clipped_utterance_file_name, audio_id
  FROM U WHERE speaker_id IS NOT NULL)"""

CTES = {
    "U": (UTTERANCES_SQL, ""),
    "S": (RECORDINGS_SQL, ""),
    "R": (RELOADS_SQL, "S"),
    "K": (LISTED_SQL, "U"),
    "X": (EXPLODED_SQL, "SUK"),
    "M": (MEDIA_SQL, "S"),
    "P": (SPEAKERS_SQL, "S"),
    "L": (LISTING_SQL, "US"),
    "A": (ATTRIBUTES_SQL, "USL"),
    "F": (FLAGS_SQL, ""),
    "B": (MEMBERS_SQL, "U"),
}


def sql(names: str, body: str) -> str:
    """``body`` with the named views, and those they need, in front of it."""
    needed: list[str] = []

    def add(name: str) -> None:
        for other in CTES[name][1]:
            add(other)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    return ("WITH " + ",\n".join(CTES[n][0] for n in needed) + "\n" if needed else "") + body
