"""The nested utterance list of a recording: parse, normalise, explode, write back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoloom.operators.ordered import list_parts
from sonoloom.schemas import UTTERANCE_DDL


def list_elements(raw: Column) -> Column:
    """The list as an array of element texts (objects stay JSON text); NULL if unreadable."""
    return F.from_json(raw, "array<string>")


def list_state(raw: Column) -> Column:
    """``missing``, ``json_null``, ``corrupt`` or ``ok``."""
    return (
        F.when(raw.isNull(), "missing")
        .when(F.trim(raw) == "null", "json_null")
        .when(list_elements(raw).isNull(), "corrupt")
        .otherwise("ok")
    )


def clean_snr(value: Column) -> Column:
    """``nan``, missing or unreadable becomes 0."""
    number = F.trim(F.replace(value, F.lit('"'), F.lit(""))).try_cast("double")
    return F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0))


def clean_duration(value: Column) -> Column:
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def _plain_element(element: Column) -> Column:
    """An element of a mixed or old list: JSON text, or ``name:duration``."""
    text = F.replace(element, F.lit(","), F.lit(""))
    plain = F.struct(
        F.substring_index(text, ":", 1).alias("name"),
        F.substring_index(text, ":", -1).alias("duration"),
        F.lit(None).cast("string").alias("snr_value"),
        F.lit("").alias("status"),
        F.lit(None).cast("string").alias("reason"),
        F.lit(None).cast("double").alias("snr_threshold"),
        F.lit(None).cast("double").alias("max_duration"),
        F.lit(None).cast("map<string,string>").alias("language_confidence_score"),
    )
    return F.when(F.startswith(F.ltrim(element), F.lit("{")), F.from_json(element, UTTERANCE_DDL)).otherwise(plain)


def explode_utterances(recordings: DataFrame, raw: str = "utterances_files_list", keep_empty: bool = True) -> DataFrame:
    """One row per utterance with typed columns; a list without elements keeps one empty row.

    A list of objects is parsed once.  Only a list that is not one is read again, element by
    element.
    """
    text = F.col(raw)
    parsed = F.when(F.startswith(F.ltrim(text), F.lit("[")), F.from_json(text, f"array<struct<{UTTERANCE_DDL}>>"))
    again = F.transform(list_elements(text), _plain_element)
    explode = F.explode_outer if keep_empty else F.explode
    rows = recordings.withColumn("_list", parsed).withColumn("_u", explode(F.coalesce("_list", again)))
    return rows.select(
        *[c for c in recordings.columns if c != raw],
        F.to_json("_u").alias("utterance_json"),
        F.replace("_u.name", F.lit(","), F.lit("")).alias("utterances_file_name"),
        clean_duration(F.col("_u.duration")).alias("utterances_file_duration"),
        F.col("_u.status").alias("utterances_file_status"),
        clean_snr(F.col("_u.snr_value")).alias("snr"),
        F.col("_u.reason").alias("fail_reason"),
        F.col("_u.language_confidence_score").alias("language_confidence_score"),
    )


def quarantine(recordings: DataFrame, raw: str = "utterances_files_list") -> DataFrame:
    """Recordings whose list could not be read, with the raw text kept."""
    return recordings.withColumn("list_state", list_state(F.col(raw))).filter(F.col("list_state") == "corrupt")


def utterances_as_json(
    utterances: DataFrame, keys: Sequence[str], fields: dict[str, str | Column], order_by: Sequence[str], **sizes: int
) -> DataFrame:
    """Per key the utterances as a JSON array text; with ``items`` in parts of bounded length."""
    element = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in fields.items()])
    parts = list_parts(utterances, keys, element, order_by, "_list", **sizes)
    return parts.select(*keys, "part", F.to_json("_list").alias("utterances_files_list"))


def join_parts(lists: DataFrame, keys: Sequence[str], raw: str = "utterances_files_list") -> DataFrame:
    """One JSON array per key out of its ``part`` rows, in their order."""
    inner = F.regexp_extract(raw, r"(?s)^\s*\[(.*)\]\s*$", 1)
    parts = F.array_sort(F.collect_list(F.struct("part", inner.alias("text"))))
    filled = F.filter(F.transform(parts, lambda p: p["text"]), lambda t: F.trim(t) != "")
    return lists.groupBy(*keys).agg(F.concat(F.lit("["), F.array_join(filled, ","), F.lit("]")).alias(raw))
