"""Queries of the quality gate, the utterance lists and the text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sonoloom.functions import text as tx
from sonoloom.functions import utterance_json as uj
from sonoloom.operators import quality
from sonoloom.operators.mutations import replace_utterances
from sonoloom.operators.ordered import list_parts
from sonoloom.operators.reconcile import cleanse
from sonoloom.operators.transcription import outcome_reason, transcription_gate
from sonoloom.plans.registry import query
from sonoloom.plans.views import flag_events, listing, recordings, sql, table, utterances, with_lists

NAME = "clipped_utterance_file_name"
SECONDS = "clipped_utterance_duration"


@query(
    sql(
        "U",
        f"""SELECT audio_id, {NAME}, snr, CASE WHEN snr < 15 OR {SECONDS} > 15 THEN 'Rejected' ELSE 'Clean' END AS status,
  CASE WHEN snr < 15 THEN 'High-SNR' WHEN {SECONDS} > 15 THEN 'High Audio Duration' END AS reason,
  CASE WHEN snr < 15 THEN 15.0::DOUBLE END AS snr_threshold,
  CASE WHEN snr >= 15 AND {SECONDS} > 15 THEN 15.0::DOUBLE END AS max_duration FROM U""",
    )
)
def quality_gate(spark, sf_dir):
    clips = utterances(spark, sf_dir).select("audio_id", NAME, SECONDS, "snr")
    return quality.quality_gate(clips).drop(SECONDS)


@query(
    sql(
        "U",
        f"""SELECT audio_id, round_even(coalesce(sum(CASE WHEN status = 'Clean' THEN {SECONDS} END), 0) / 60 * 100, 0) / 100
  AS cleaned_duration FROM U GROUP BY audio_id""",
    )
)
def cleaned_minutes(spark, sf_dir):
    return quality.cleaned_minutes(utterances(spark, sf_dir).select("audio_id", "status", SECONDS))


@query(
    sql(
        "X",
        """SELECT audio_id, raw_file_name, utterances_file_name, utterances_file_duration,
  utterances_file_status, snr FROM X""",
    )
)
def utterances_exploded(spark, sf_dir):
    staging = with_lists(spark, sf_dir).select("audio_id", "raw_file_name", "utterances_files_list")
    return uj.explode_utterances(staging).select(
        "audio_id", "raw_file_name", "utterances_file_name", "utterances_file_duration", "utterances_file_status", "snr"
    )


@query(
    sql(
        "SU",
        """SELECT audio_id, CASE WHEN audio_id % 97 = 5 THEN 'corrupt' WHEN audio_id % 50 = 1 THEN 'json_null'
  WHEN audio_id % 50 <> 2 AND audio_id NOT IN (SELECT audio_id FROM U) THEN 'missing' ELSE 'ok' END AS list_state FROM S""",
    )
)
def list_states(spark, sf_dir):
    """State of every utterance list, with some of them cut short."""
    staging = with_lists(spark, sf_dir).select("audio_id", "utterances_files_list")
    broken = F.when(F.col("audio_id") % 97 == 5, F.lit('[{"name": ')).otherwise(F.col("utterances_files_list"))
    return staging.select("audio_id", uj.list_state(broken).alias("list_state"))


@query(sql("S", "SELECT audio_id, concat('[{\"name\": ', audio_id) AS raw_text FROM S WHERE audio_id % 97 = 5"))
def json_quarantine(spark, sf_dir):
    staging = with_lists(spark, sf_dir).select("audio_id", "utterances_files_list")
    cut = F.concat(F.lit('[{"name": '), F.col("audio_id").cast("string"))
    broken = staging.withColumn(
        "utterances_files_list", F.when(F.col("audio_id") % 97 == 5, cut).otherwise(F.col("utterances_files_list"))
    )
    return uj.quarantine(broken).select("audio_id", F.col("utterances_files_list").alias("raw_text"))


@query(
    sql(
        "X",
        """SELECT audio_id, count(utterances_file_name) AS utterances,
  coalesce(sum(utterances_file_duration), 0) AS seconds FROM X GROUP BY audio_id""",
    )
)
def json_single_quotes(spark, sf_dir):
    """Lists written with single quotes are read as well."""
    staging = with_lists(spark, sf_dir)
    quoted = staging.select("audio_id", F.replace("utterances_files_list", F.lit('"'), F.lit("'")).alias("utterances_files_list"))
    return (
        uj.explode_utterances(quoted)
        .groupBy("audio_id")
        .agg(
            F.count("utterances_file_name").alias("utterances"),
            F.coalesce(F.sum("utterances_file_duration"), F.lit(0.0)).alias("seconds"),
        )
    )


@query(
    sql(
        "SU",
        f"""SELECT S.audio_id, count(U.{NAME}) AS utterances, coalesce(sum({SECONDS}), 0) AS seconds
  FROM S LEFT JOIN U ON S.audio_id = U.audio_id GROUP BY S.audio_id""",
    )
)
def json_rewrite(spark, sf_dir):
    """Every recording's list replaced by a fresh one, then read back."""
    clips = utterances(spark, sf_dir).select("audio_id", NAME, SECONDS, "snr", "status")
    fields = {"name": NAME, "duration": F.col(SECONDS).cast("string"), "snr_value": "snr", "status": "status"}
    fresh = uj.utterances_as_json(clips, ["audio_id"], fields, [NAME])
    staging = recordings(spark, sf_dir).select("audio_id").withColumn("utterances_files_list", F.lit(None).cast("string"))
    rewritten = uj.explode_utterances(replace_utterances(staging, fresh))
    return rewritten.groupBy("audio_id").agg(
        F.count("utterances_file_name").alias("utterances"),
        F.coalesce(F.sum("utterances_file_duration"), F.lit(0.0)).alias("seconds"),
    )


SPACE = r"\t\n\x0b\f\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _sanitise_sql(language: str) -> str:
    """The sanitiser written with DuckDB's own functions."""
    rule = tx.RULES[language]
    deleted = rule.punctuation.replace("'", "''")
    valid = "".join("-".join(rf"\x{{{end}}}" for end in part.split("-")) for part in rule.code_points.split())
    strip = rf"'^[{SPACE}]+|[{SPACE}]+$', '', 'g'"
    colon = "instr(t1, ':') > 0" if rule.reject_colon else "false"
    return rf"""WITH T1 AS (SELECT doc_id, regexp_replace(text, {strip}) AS t1 FROM documents),
T2 AS (SELECT doc_id, t1, regexp_replace(translate(replace(t1, '-', ' '), '{deleted}', ''), {strip}) AS t2 FROM T1),
T3 AS (SELECT doc_id, t2, CASE WHEN {colon} THEN 'transcription has :'
  WHEN length(t2) = 0 THEN 'transcription is empty'
  WHEN regexp_matches(t2, '[^{valid}{SPACE}]') THEN 'transcription has a character outside its language' END AS reason FROM T2)
SELECT doc_id, CASE WHEN reason IS NULL THEN md5(t2) END AS clean_md5, reason FROM T3"""


def _checked(documents):
    return documents.select("doc_id", F.md5("_s.clean").alias("clean_md5"), F.col("_s.reason").alias("reason"))


def _sanitise(language: str):
    def run(spark, sf_dir):
        return _checked(table(spark, sf_dir, "documents").withColumn("_s", tx.sanitise(F.col("text"), language)))

    return run


for _language in tx.VALID_CODE_POINTS:
    _key = "sanitize_en" if _language == "indian_english" else f"sanitize_{_language}"
    query(_sanitise_sql(_language), _key)(_sanitise(_language))


@query(
    rf"""WITH E AS ({_sanitise_sql("indian_english")}), H AS ({_sanitise_sql("hindi")})
SELECT doc_id, CASE WHEN lang = 'en' THEN E.clean_md5 ELSE H.clean_md5 END AS clean_md5,
  CASE WHEN lang = 'en' THEN E.reason ELSE H.reason END AS reason
FROM documents JOIN E USING (doc_id) JOIN H USING (doc_id)"""
)
def sanitize_by_language(spark, sf_dir):
    """Each row by its own language; languages without a rule use the default one."""
    language = F.when(F.col("lang") == "en", "indian_english").otherwise(F.col("lang"))
    return _checked(table(spark, sf_dir, "documents").withColumn("_s", tx.sanitise_by(F.col("text"), language)))


@query("SELECT doc_id, md5(text) AS media_hash_code, count(*) OVER (PARTITION BY md5(text)) AS copies FROM documents")
def content_hash(spark, sf_dir):
    hashed = table(spark, sf_dir, "documents").select(
        "doc_id", quality.content_hash(F.encode("text", "UTF-8")).alias("media_hash_code")
    )
    copies = hashed.groupBy("media_hash_code").agg(F.count(F.lit(1)).alias("copies"))
    return hashed.join(copies, "media_hash_code").select("doc_id", "media_hash_code", "copies")


@query(
    sql(
        "L",
        r"""SELECT path, CASE WHEN instr(n, '.') = 0 THEN concat('.', n)
  ELSE concat(replace(substr(n, 1, length(n) - instr(reverse(n), '.')), '.', '_'), '.', string_split(n, '.')[-1]) END AS name
FROM (SELECT path, replace(replace(replace(replace(concat(string_split(path, '/')[-1], ' (copy) & ''v1.2''.wav'),
  '(', ''), ')', ''), '&', ''), '''', '') AS n FROM L)""",
    )
)
def name_cleanup(spark, sf_dir):
    messy = F.concat(tx.base_name(F.col("path")), F.lit(" (copy) & 'v1.2'.wav"))
    return listing(spark, sf_dir).select("path", tx.condition_file_name(messy).alias("name"))


@query(
    """SELECT conv_id, CAST(0 AS BIGINT) AS part, md5(string_agg(text, ' ' ORDER BY turn)) AS transcript_md5 FROM conversations
WHERE text IS NOT NULL GROUP BY conv_id"""
)
def stt_text_join(spark, sf_dir):
    """First alternative of every recogniser result, joined; a conversation stands for one call."""
    turns = table(spark, sf_dir, "conversations").filter(F.col("text").isNotNull())
    alternatives = F.array(
        F.struct(F.col("text").alias("transcript"), F.lit(0.9).alias("confidence")),
        F.struct(F.upper("text").alias("transcript"), F.lit(0.4).alias("confidence")),
    )
    results = list_parts(turns, ["conv_id"], F.struct(alternatives.alias("alternatives")), ["turn"], "results")
    return results.select("conv_id", "part", F.md5(tx.join_alternatives(F.col("results"))).alias("transcript_md5"))


@query(
    sql(
        "F",
        """SELECT user_id, count(*) AS frames, count(*) * 480 / 16000.0::DOUBLE AS seconds FROM F GROUP BY user_id""",
    )
)
def clip_duration(spark, sf_dir):
    frames = flag_events(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("frames"))
    return frames.select("user_id", "frames", quality.clip_duration(F.col("frames") * 480, F.lit(16000.0)).alias("seconds"))


@query(
    sql(
        "U",
        f"""SELECT {NAME}, CASE WHEN audio_id % 13 = 4 THEN -1.0::DOUBLE WHEN audio_id % 13 = 5 THEN 0.0::DOUBLE ELSE snr END AS snr FROM U""",
    )
)
def tool_output_parse(spark, sf_dir):
    """Quality values read from the tool's text output, one line per clip."""
    value = F.when(F.col("audio_id") % 13 == 5, "nan").otherwise(F.col("snr").cast("string"))
    line = F.when(F.col("audio_id") % 13 == 4, "failed").otherwise(
        F.concat(F.lit("file "), F.col(NAME), F.lit("  SNR "), value, F.lit(" dB done\n"))
    )
    return utterances(spark, sf_dir).select(NAME, tx.parse_tool_output(line).alias("snr"))


@query(
    sql(
        "SL",
        """SELECT path, lower(string_split(path, '.')[-1]) = 'wav' AND audio_ext IN ('wav', 'WAV') AS matches FROM (
  SELECT path, CASE length(path) % 3 WHEN 0 THEN 'wav' WHEN 1 THEN 'WAV' ELSE 'Wav' END AS audio_ext FROM L)""",
    )
)
def ext_match(spark, sf_dir):
    spelled = F.when(F.length("path") % 3 == 0, "wav").when(F.length("path") % 3 == 1, "WAV").otherwise("Wav")
    return listing(spark, sf_dir).select("path", tx.extension_matches(spelled, "wav").alias("matches"))


@query(
    sql(
        "S",
        """SELECT CAST(audio_id AS BIGINT) AS audio_id, replace(raw_file_name, '_', '') AS raw_file_name FROM S
WHERE audio_id % 9 <> 0""",
    )
)
def cleansed(spark, sf_dir):
    """Catalogue rows with commas in the name and some missing ids, cleansed."""
    dirty = recordings(spark, sf_dir).select(
        F.when(F.col("audio_id") % 9 != 0, F.col("audio_id").cast("double")).alias("audio_id"),
        F.replace("raw_file_name", F.lit("_"), F.lit(",")).alias("raw_file_name"),
    )
    return cleanse(dirty, "raw_file_name")


GATE = f"""SELECT audio_id, {NAME}, CASE WHEN status = 'Rejected' THEN 'Clean' ELSE status END AS status,
  CASE WHEN status = 'Rejected' THEN 'redacted' END AS reason FROM U
WHERE {SECONDS} BETWEEN 0.5 AND 15 AND length({NAME}) % 4 <> 0"""


def _gate(spark, sf_dir, skip_rejected):
    clips = utterances(spark, sf_dir).select("audio_id", NAME, SECONDS, "status")
    files = clips.select(NAME).filter(F.length(NAME) % 4 != 0)
    return transcription_gate(files, clips, skip_rejected).drop(SECONDS)


@query(sql("U", GATE))
def transcription_gate_reset(spark, sf_dir):
    return _gate(spark, sf_dir, False)


@query(sql("U", f"{GATE} AND status <> 'Rejected'"))
def transcription_gate_skip(spark, sf_dir):
    return _gate(spark, sf_dir, True)


@query(
    rf"""WITH T AS ({_sanitise_sql("indian_english")})
SELECT doc_id, CASE WHEN failed THEN 'Rejected' WHEN reason IS NOT NULL THEN 'Rejected' ELSE 'Clean' END AS status,
  CASE WHEN failed THEN 'STT API error:no match' WHEN reason IS NOT NULL THEN concat('sanitization error:', reason) END AS reason,
  NOT failed AND reason IS NULL AS is_transcribed
FROM (SELECT doc_id, reason, doc_id % 11 = 3 AS failed FROM T)"""
)
def outcome_routing(spark, sf_dir):
    """State and reason after recognition: engine failures first, then the sanitiser."""
    failed = F.when(F.col("doc_id") % 11 == 3, "no match")
    text = F.when(failed.isNull(), F.col("text"))
    documents = table(spark, sf_dir, "documents").withColumn("_s", tx.sanitise(text, "indian_english"))
    reason = outcome_reason(failed, F.col("_s.reason"))
    return documents.select(
        "doc_id",
        F.when(reason.isNull(), "Clean").otherwise("Rejected").alias("status"),
        reason.alias("reason"),
        reason.isNull().alias("is_transcribed"),
    )
