"""Queries of the selection step."""

from __future__ import annotations

from pyspark.sql import functions as F

from sonoloom.operators import selection as sel
from sonoloom.operators.ordered import micros, running_total
from sonoloom.plans.registry import query
from sonoloom.plans.views import recordings, sql, utterances

KEY = ["audio_id", "clipped_utterance_file_name"]
COLS = "speaker_id, clipped_utterance_file_name, clipped_utterance_duration, audio_id, snr"
BASE = ["speaker_id", "clipped_utterance_file_name", "clipped_utterance_duration", "audio_id", "snr"]

CANDIDATES = f"""SELECT {COLS} FROM U
WHERE audio_id IN (SELECT audio_id FROM S WHERE source = 'src1' AND language = 'Hindi'
                   AND (data_set_used_for IS NULL OR data_set_used_for = 'train'))
  AND status = 'Clean' AND NOT staged_for_transcription AND clipped_utterance_duration BETWEEN 0.5 AND 15"""


@query(sql("US", CANDIDATES))
def select_candidates(spark, sf_dir):
    return sel.candidates(utterances(spark, sf_dir), recordings(spark, sf_dir), "src1", "Hindi")


def flagship(spark, sf_dir):
    """Up to one hour of clean speech, at most two minutes per speaker."""
    spec = sel.FilterSpec.from_dict(
        {
            "by_utterance_duration": {"gte": 1, "lte": 12},
            "by_snr": {"gte": 20, "lte": 55},
            "by_speaker": {"gte_per_speaker_duration": 0.1, "lte_per_speaker_duration": 2, "with_threshold": 0},
            "by_duration": 1.0,
        }
    )
    return spec.apply(select_candidates(spark, sf_dir), KEY)


@query(
    sql(
        "US",
        f"""SELECT {COLS} FROM (
  SELECT *, sum(clipped_utterance_duration) OVER (ORDER BY audio_id, clipped_utterance_file_name
           ROWS UNBOUNDED PRECEDING) AS total FROM (
    SELECT *, max(cum BETWEEN 6 AND 120) OVER (PARTITION BY speaker_id) AS ok FROM (
      SELECT *, sum(clipped_utterance_duration) OVER (PARTITION BY speaker_id
             ORDER BY audio_id, clipped_utterance_file_name ROWS UNBOUNDED PRECEDING) AS cum
      FROM ({CANDIDATES}) WHERE clipped_utterance_duration BETWEEN 1 AND 12 AND snr BETWEEN 20 AND 55
        AND speaker_id IS NOT NULL))
  WHERE ok AND cum <= 120)
WHERE total <= 3600""",
    )
)
def filter_spec_candidates(spark, sf_dir):
    return flagship(spark, sf_dir)


@query(
    sql(
        "U",
        f"SELECT {COLS} FROM U WHERE clipped_utterance_duration BETWEEN 2 AND 4 AND snr BETWEEN 13 AND 19",
    )
)
def filter_ranges(spark, sf_dir):
    rows = utterances(spark, sf_dir).select(*BASE)
    return rows.filter(
        sel.within("clipped_utterance_duration", {"gte": 2, "lte": 4}) & sel.within("snr", {"gte": 13, "lte": 19})
    )


EXCLUDED = list(range(0, 60, 7))


@query(
    sql(
        "U",
        f"""SELECT {COLS} FROM U WHERE coalesce(speaker_id NOT IN ({", ".join(map(str, EXCLUDED))}), true)
  AND coalesce(audio_id NOT IN (3, 5, 7), true)""",
    )
)
def exclude_ids(spark, sf_dir):
    rows = sel.exclude_ids(utterances(spark, sf_dir).select(*BASE), "speaker_id", EXCLUDED)
    return sel.exclude_ids(rows, "audio_id", [3, 5, 7])


BUDGET = """SELECT *, max(cum BETWEEN 30 AND 630) OVER (PARTITION BY speaker_id) AS ok FROM (
    SELECT *, sum(clipped_utterance_duration) OVER (PARTITION BY speaker_id
           ORDER BY audio_id, clipped_utterance_file_name ROWS UNBOUNDED PRECEDING) AS cum
    FROM {rows} WHERE speaker_id IS NOT NULL)"""


@query(sql("U", f"SELECT {COLS} FROM ({BUDGET.format(rows='U')}) WHERE ok AND cum <= 630"))
def speaker_budget(spark, sf_dir):
    return sel.speaker_budget(
        utterances(spark, sf_dir).select(*BASE),
        KEY,
        gte_per_speaker_duration=1,
        lte_per_speaker_duration=10,
        with_threshold=0.5,
    )


@query(
    sql(
        "U",
        f"""SELECT {COLS} FROM (SELECT *, sum(clipped_utterance_duration) OVER (
  ORDER BY audio_id, clipped_utterance_file_name ROWS UNBOUNDED PRECEDING) AS cum FROM U) WHERE cum <= 18000""",
    )
)
def total_cap(spark, sf_dir):
    return sel.cap_total(utterances(spark, sf_dir).select(*BASE), 5, KEY)


@query(
    sql(
        "U",
        """SELECT audio_id, clipped_utterance_file_name, speaker_id,
  sum(clipped_utterance_duration) OVER (PARTITION BY speaker_id
      ORDER BY audio_id, clipped_utterance_file_name ROWS UNBOUNDED PRECEDING) AS running_seconds FROM U""",
    )
)
def running_by_speaker(spark, sf_dir):
    """The split form of the running total, on every speaker (a NULL speaker is a third form of one key)."""
    rows = running_total(
        utterances(spark, sf_dir).select(*KEY, "speaker_id", "clipped_utterance_duration"),
        micros("clipped_utterance_duration"),
        KEY,
        ["speaker_id"],
        "_total",
        max_group_rows=0,
        partitions=12,
    )
    return rows.select(*KEY, "speaker_id", (F.col("_total") / 1e6).alias("running_seconds"))


SPEC = {
    "by_source": "ignored",
    "by_utterance_duration": {"gte": 1, "lte": 14},
    "by_snr": {"gte": 10, "lte": 50},
    "by_speaker": {"gte_per_speaker_duration": 1, "lte_per_speaker_duration": 10, "with_threshold": 0.5},
    "by_duration": 2.0,
    "exclude_speaker_ids": [1, 2, 3],
    "exclude_audio_ids": [10, 20, 30],
}


def _spec_sql(excluded: str) -> str:
    filtered = f"""(SELECT * FROM U WHERE {excluded}
    AND clipped_utterance_duration BETWEEN 1 AND 14 AND snr BETWEEN 10 AND 50)"""
    return sql(
        "U",
        f"""SELECT {COLS} FROM (SELECT *, sum(clipped_utterance_duration) OVER (
  ORDER BY audio_id, clipped_utterance_file_name ROWS UNBOUNDED PRECEDING) AS total
  FROM ({BUDGET.format(rows=filtered)}) WHERE ok AND cum <= 630) WHERE total <= 7200""",
    )


@query(_spec_sql("coalesce(speaker_id NOT IN (1, 2, 3), true) AND audio_id NOT IN (10, 20, 30)"))
def filter_spec_full(spark, sf_dir):
    return sel.FilterSpec.from_dict(SPEC).apply(utterances(spark, sf_dir).select(*BASE), KEY)


@query(_spec_sql("coalesce(speaker_id NOT IN (10, 20, 30), true)"))
def filter_spec_compat(spark, sf_dir):
    """The old form of the audio exclusion."""
    return sel.FilterSpec.from_dict(SPEC).apply(utterances(spark, sf_dir).select(*BASE), KEY, compat=True)


SHUFFLED = "md5(concat_ws('|', '7', audio_id, clipped_utterance_file_name))"


@query(
    sql(
        "U",
        f"""SELECT audio_id, clipped_utterance_file_name FROM (
  SELECT *, row_number() OVER (ORDER BY {SHUFFLED}, audio_id, clipped_utterance_file_name) AS rn,
    count(*) OVER () AS n FROM U) WHERE rn <= round_even(0.1 * n, 0)""",
    )
)
def random_sample(spark, sf_dir):
    return sel.sample_rows(utterances(spark, sf_dir).select(*KEY), 0.1, KEY, seed=7).drop("_shuffle")


@query(
    sql(
        "U",
        f"""SELECT audio_id, clipped_utterance_file_name FROM (
  SELECT *, sum(clipped_utterance_duration) OVER (ORDER BY {SHUFFLED}, audio_id, clipped_utterance_file_name
      ROWS UNBOUNDED PRECEDING) AS cum FROM (
    SELECT *, row_number() OVER (ORDER BY {SHUFFLED}, audio_id, clipped_utterance_file_name) AS rn,
      count(*) OVER () AS n FROM U) WHERE rn <= round_even(0.5 * n, 0)) WHERE cum <= 3600""",
    )
)
def random_cap(spark, sf_dir):
    """A shuffled selection: sample half, then cap the running total of the random order."""
    spec = sel.FilterSpec(by_duration=1.0, with_randomness=True, with_fraction=0.5)
    return spec.apply(utterances(spark, sf_dir).select(*BASE), KEY, seed=7).select(*KEY)
