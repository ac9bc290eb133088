"""Benchmark decontamination: which documents contain (nearly) all five-word shingles of a test item.

Containment of a short item in a long document is found without sketching the document.  An item's MinHash signature is the
lowest hashes of its own shingles.  Of an item with n shingles at most n - ceil(t n) may be missing from a document that
contains a share t, so one of any n - ceil(t n) + 1 shingles must be in it: a signature of that length finds every match.
Items are partitioned by size, and a partition's signature length follows from the largest size in it, as in containment
search with partitioned domains.  Candidates are then verified on all shingles of the item and the document.
Only DataFrame functions run.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoloom.llm.common import content_key, keep_possible, packed, unpacked, with_words

SHINGLE = 5
CONTAINMENT = 0.8


def shingle_texts(words_column: str, size: int = SHINGLE) -> Column:
    """All shingles as text, joined by one blank; fewer words than ``size`` are one shingle, no words none."""
    w = F.col(words_column)
    starts = F.sequence(F.lit(0), F.greatest(F.size(w) - size, F.lit(0)))
    many = F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(size)]))
    return F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(many)


def shingle_hashes(words_column: str, size: int = SHINGLE) -> Column:
    """64-bit hashes of all shingles, by position; fewer words than ``size`` are one shingle, no words none."""
    w = F.col(words_column)
    starts = F.sequence(F.lit(0), F.greatest(F.size(w) - size, F.lit(0)))
    many = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))
    return F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(many)


def signature_length(n: Column, containment: float) -> Column:
    """MinHashes that an item of n shingles needs; set by the largest size of its partition [2^k, 2^(k+1))."""
    largest = F.pow(F.lit(2.0), F.floor(F.log2(n)) + 1) - 1
    return F.least(n, (F.floor(largest * F.lit(1 - containment) + 1e-9) + 1).cast("int"))


def containments(
    docs: DataFrame, benchmark: DataFrame, *, containment: float = CONTAINMENT, size: int = SHINGLE
) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment, _key) of every document and item with n_shared >= t * n_shingles.

    Sets are the different shingles of A-Z lower-cased words.  Items with fewer than ``size`` words are one shingle, which only a
    document of just these words has.  Null, empty and blank texts match nothing; rows repeated in either table, and rows whose ids
    are null, are matched like others and reported once per (doc_id, text, item_id); empty tables give no rows.
    """
    percent = math.ceil(containment * 1000)
    items = (
        with_words(benchmark.select("item_id", "text", F.xxhash64("text").alias("_t")), "item_id", "_t")
        .filter(F.size("_w") > 0)
        .select("item_id", "_t", F.array_sort(F.array_distinct(shingle_hashes("_w", size))).alias("_h"), "_w")
        .withColumn("_item", F.struct(F.coalesce(F.col("item_id").cast("string"), F.lit("~")).alias("i"), F.col("_t").alias("t")))
        .dropDuplicates(["_item"])
    )
    signed = items.select(
        "_item", F.explode(F.slice("_h", F.lit(1), signature_length(F.size("_h"), containment))).alias("_s")
    )
    texts = docs.select("doc_id", "text", content_key().alias("_key"))
    hashes = with_words(texts, "_key").select("_key", F.explode(shingle_hashes("_w", size)).alias("_s"))
    candidates = keep_possible(hashes, "_s", signed).join(signed, "_s").select("_key", "_item").distinct()

    item_shingles = items.select(
        "_item", "item_id", F.array_distinct(shingle_texts("_w", size)).alias("_x")
    ).withColumn("_n", F.size("_x"))
    wanted = candidates.join(item_shingles, "_item").select("_key", "_item", "item_id", "_n", F.explode("_x").alias("_x"))
    probable = keep_possible(
        texts.withColumn("_k", F.col("_key.a")), "_k", candidates.select(F.col("_key.a").alias("_k"))
    ).drop("_k")
    found = with_words(probable.dropDuplicates(["_key"]), "_key", "doc_id").select(
        "_key", "doc_id", F.explode(F.array_distinct(shingle_texts("_w", size))).alias("_x")
    )
    shared = wanted.join(found, ["_key", "_x"]).groupBy("_key", "_item").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("item_id").alias("item_id"),
        F.first("_n").cast("bigint").alias("n_shingles"),
        F.count(F.lit(1)).alias("n_shared"),
    )
    return shared.filter(F.col("n_shared") * 1000 >= F.col("n_shingles") * percent).select(
        "doc_id",
        "item_id",
        "n_shingles",
        "n_shared",
        F.round(F.col("n_shared") / F.col("n_shingles"), 6).alias("containment"),
        "_key",
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options: float) -> DataFrame:
    """``docs`` without the documents that contain a test item; all columns pass through."""
    leaks = containments(docs, benchmark, **options).select("_key").distinct()
    rest = packed(docs).withColumn("_key", content_key()).join(leaks, "_key", "left_anti")
    return rest.select(*unpacked(docs.columns))
