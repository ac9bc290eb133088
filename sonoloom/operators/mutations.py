"""Catalogue changes as pure functions: old snapshot x change set -> new snapshot."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sonoloom.functions.utterance_json import join_parts
from sonoloom.operators.catalog import assign_ids, new_speakers
from sonoloom.operators.selection import FILE_NAME
from sonoloom.schemas import SPEAKER


class Rule(NamedTuple):
    """How a column takes changes.

    ``merge`` makes one change of all changes of a key, given (value, order): an aggregate, combined before the shuffle, so
    a key with any number of changes stays one row.  ``apply`` is the new value of (old value, merged change).  Applying the merged
    change must equal applying the changes in turn.
    """

    merge: Callable[[Column, Column], Column]
    apply: Callable[[Column, Column], Column]


def apply_changes(
    table: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    assign: Mapping[str, Rule | Callable[[Column, Column], Column]],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """``table`` with columns reassigned where a change row has the same keys.

    ``assign`` maps a column to a function of (old value, change value), or to a ``Rule``.  Several changes of one key are applied
    in turn, in the order of the change columns ``order_by`` (at a tie, of all change columns): with a plain function the
    last one counts, a null included.  Without an order the least of them counts, so that reruns agree.  A change set of
    keys alone is only made distinct.
    """
    columns = [c for c in changes.columns if c not in keys and c not in order_by]
    rules = {c: r if isinstance(r, Rule) else Rule(F.max_by if order_by else F.min_by, r) for c, r in assign.items()}
    if columns:
        order = F.struct(*order_by, *columns)
        plain = Rule(F.max_by if order_by else F.min_by, take_new)
        merged = [rules.get(c, plain).merge(F.col(c), order).alias(c) for c in columns]
        one = changes.groupBy(*keys).agg(*merged).select(*keys, F.struct(*columns, F.lit(True).alias("_hit")).alias("_c"))
    else:
        one = changes.select(*keys).distinct().withColumn("_c", F.struct(F.lit(True).alias("_hit")))
    joined = table.join(one, list(keys), "left")
    hit = F.coalesce(F.col("_c._hit"), F.lit(False))
    updated = {
        name: F.when(hit, rule.apply(F.col(name), F.col(f"_c.{name}") if name in columns else F.lit(None))).otherwise(F.col(name))
        for name, rule in rules.items()
    }
    return joined.select(*[updated[c].alias(c) if c in updated else F.col(c) for c in table.columns])


def change_log(change_sets: Sequence[DataFrame], order: str = "change") -> DataFrame:
    """Change sets as one log: ``order`` is the place of a row's set, so later sets come later."""
    numbered = [changes.withColumn(order, F.lit(place)) for place, changes in enumerate(change_sets)]
    log = numbered[0]
    for changes in numbered[1:]:
        log = log.unionByName(changes)
    return log


def take_new(_old: Column, new: Column) -> Column:
    return new


def changed_count(table: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many table rows a change set touches."""
    touched = table.join(changes.select(*keys).distinct(), list(keys), "left_semi")
    return touched.agg(F.count(F.lit(1)).alias("changed"))


def bulk_apply(
    table: DataFrame, change_sets: Sequence[DataFrame], keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Many row changes in one pass; on a repeated key the later change set wins."""
    if not change_sets:
        return table
    log = change_log([c.select(*keys, *columns) for c in change_sets], "_change")
    return apply_changes(table, log, keys, {c: take_new for c in columns}, ["_change"])


def stage_utterances(
    mapping: DataFrame, staging: DataFrame, names: DataFrame, source: str, language: str, data_set: str
) -> DataFrame:
    """Mark the selected file names of one source and language as staged for ``data_set``."""
    recordings = staging.filter((F.col("source") == source) & (F.col("language") == language)).select("audio_id").distinct()
    chosen = names.select(FILE_NAME).distinct()
    flagged = mapping.join(recordings.withColumn("_in", F.lit(True)), "audio_id", "left").join(
        chosen.withColumn("_named", F.lit(True)), FILE_NAME, "left"
    )
    hit = F.coalesce(F.col("_in") & F.col("_named"), F.lit(False))
    new = {"staged_for_transcription": F.lit(True), "data_type": F.lit(data_set)}
    return flagged.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in mapping.columns])


def tag_recordings(staging: DataFrame, ids: DataFrame, source: str, language: str, data_set: str) -> DataFrame:
    """Record the data set a recording is used for, within one source and language."""
    mine = (F.col("source") == source) & (F.col("language") == language)
    return apply_changes(
        staging,
        ids.select("audio_id"),
        ["audio_id"],
        {"data_set_used_for": lambda o, n: F.when(mine, F.lit(data_set)).otherwise(o)},
    )


def transcription_outcome(mapping: DataFrame, outcomes: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """Apply (audio_id, name, status, reason, is_transcribed, engine) outcomes.

    All outcomes of a clip count: ``is_transcribed`` once true stays true, every engine joins
    the sorted set of engines used, and the status is that of the last outcome in ``order_by``
    (ties, and no order: the least engine's).
    """
    last = F.struct(*[F.col(o) for o in order_by], F.struct("status", F.col("reason").alias("fail_reason")).alias("_s"))
    first_engine = F.min_by(F.struct("status", F.col("reason").alias("fail_reason")), F.struct("engine", "status", "reason"))
    told = F.max(last)["_s"] if order_by else first_engine
    changes = (
        outcomes.groupBy("audio_id", FILE_NAME)
        .agg(told.alias("_s"), F.max("is_transcribed").alias("is_transcribed"), F.collect_set("engine").alias("stt_api_used"))
        .select("audio_id", FILE_NAME, "_s.status", "_s.fail_reason", "is_transcribed", "stt_api_used")
    )
    return apply_changes(
        mapping,
        changes,
        ["audio_id", FILE_NAME],
        {"status": take_new, "fail_reason": take_new, "is_transcribed": sticky_true, "stt_api_used": engine_union},
    )


def sticky_true(old: Column, new: Column) -> Column:
    return F.when(old, F.lit(True)).otherwise(new)


def engine_union(old: Column, new: Column) -> Column:
    return F.array_sort(F.array_union(F.coalesce(old, F.array().cast("array<string>")), new))


STICKY_TRUE = Rule(lambda value, _: F.max(value), sticky_true)
ENGINE_UNION = Rule(lambda value, _: F.array_distinct(F.flatten(F.collect_set(value))), engine_union)


def add_speakers(speakers: DataFrame, staging: DataFrame, **sizes: int) -> DataFrame:
    """Speaker table with the unseen speakers of staging appended."""
    fresh = assign_ids(new_speakers(staging, speakers), speakers, "speaker_id", ["speaker_name", "source"], **sizes)
    fresh = fresh.withColumn("voice_signature", F.lit(None).cast("string"))
    schema = StructType.fromDDL(SPEAKER)
    typed = fresh.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return speakers.select(*schema.names).unionByName(typed)


def upsert_speakers(speakers: DataFrame, names: DataFrame, source: str, **sizes: int) -> DataFrame:
    """Append the cluster names that the source does not have yet."""
    mine = speakers.filter(F.col("source") == source).select("speaker_name")
    fresh = names.select("speaker_name").distinct().join(mine, "speaker_name", "left_anti").withColumn("source", F.lit(source))
    numbered = assign_ids(fresh, speakers, "speaker_id", ["speaker_name"], **sizes)
    return speakers.unionByName(numbered.withColumn("speaker_id", F.col("speaker_id").cast("int")), allowMissingColumns=True)


def assign_speakers(mapping: DataFrame, speakers: DataFrame, members: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """Set speaker and noise flag by file name alone, across recordings.

    ``members`` is (speaker_name, file name, was_noise); a name owned by several speaker rows
    takes the least id.  A file named by several members takes the last one in ``order_by``.
    """
    ids = speakers.groupBy("speaker_name").agg(F.min("speaker_id").alias("speaker_id"))
    changes = members.join(ids, "speaker_name").select(FILE_NAME, "speaker_id", "was_noise", *order_by)
    return apply_changes(mapping, changes, [FILE_NAME], {"speaker_id": take_new, "was_noise": take_new}, order_by)


def assign_gender(mapping: DataFrame, genders: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """Set the gender by file name alone; anything but ``m`` is ``f``; of several the last in ``order_by``."""
    changes = genders.select(FILE_NAME, gender_letter(F.col("gender")).alias("speaker_gender"), *order_by)
    return apply_changes(mapping, changes, [FILE_NAME], {"speaker_gender": take_new}, order_by)


def gender_letter(gender: Column) -> Column:
    return F.when(gender == "m", "m").otherwise("f")


def record_artifact(mapping: DataFrame, exported: DataFrame, artifact: str, is_labelled: bool) -> DataFrame:
    """Note the artifact on the (audio_id, name) rows it holds."""
    column = "labelled_artifact_name" if is_labelled else "unlabelled_artifact_name"
    changes = exported.select("audio_id", FILE_NAME)
    return apply_changes(mapping, changes, ["audio_id", FILE_NAME], {column: lambda o, n: F.lit(artifact)})


def replace_utterances(staging: DataFrame, lists: DataFrame) -> DataFrame:
    """Replace the utterance JSON of recordings; lists that come in parts are joined first."""
    whole = join_parts(lists, ["audio_id"]) if "part" in lists.columns else lists
    changes = whole.select("audio_id", "utterances_files_list")
    return apply_changes(staging, changes, ["audio_id"], {"utterances_files_list": take_new})


def mark_normalised(staging: DataFrame, ids: DataFrame) -> DataFrame:
    return apply_changes(staging, ids.select("audio_id"), ["audio_id"], {"is_normalized": lambda o, n: F.lit(True)})
