"""What several of the operators share: reading tables, text rules, content keys and bounded filters."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
FILTER_SLOTS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character left as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of the text, A-Z lower-cased; an empty array for null or blank texts."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), "[ \\t\\n\\x0B\\f\\r]+"), "")


def with_words(rows: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and the row's words as ``_w``.

    The array goes through a generator, so that no later filter or lambda makes the optimizer cut the text again per element.
    """
    return rows.select(*columns, F.explode(F.array(words(F.col("text")))).alias("_w"))


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, _row): all columns but the text wait in ``_row``, so no name of theirs can clash with one used here."""
    others = [F.col(f"`{c}`").alias(c) for c in docs.columns if c != "text"]
    return docs.select("doc_id", "text", F.struct(*others).alias("_row"))


def unpacked(columns: list[str], **changed: Column) -> list[Column]:
    """The columns as they were before ``packed``, but for those ``changed``."""
    whole = {"text": F.col("text"), **changed}
    return [(whole[c] if c in whole else F.col("_row").getField(c)).alias(c) for c in columns]


def content_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits of (doc_id, text) as a struct of two longs, never null.

    Rows that agree in both are one document for every decision made from its text, so the key stands for a row
    also where ids are null or repeated.
    """
    identity, body = F.coalesce(F.col(doc_id).cast("string"), F.lit("~")), F.coalesce(F.col(text), F.lit("~"))
    return F.struct(F.xxhash64(identity, body).alias("a"), F.xxhash64(body, F.lit(7), identity).alias("b"))


def keep_possible(rows: DataFrame, key: str, wanted: DataFrame, slots: int = FILTER_SLOTS) -> DataFrame:
    """``rows`` without most of those whose long ``key`` is not among the ``key`` values of ``wanted``.

    ``wanted`` is folded to at most ``slots`` numbers before it is broadcast, so the broadcast has a proven bound
    (``slots`` longs) however many keys there are.  Rows that pass by chance are left to an exact join.
    """
    folded = wanted.select(F.pmod(F.col(key), F.lit(slots)).alias("_slot")).distinct()
    return (
        rows.withColumn("_slot", F.pmod(F.col(key), F.lit(slots))).join(F.broadcast(folded), "_slot", "left_semi").drop("_slot")
    )
