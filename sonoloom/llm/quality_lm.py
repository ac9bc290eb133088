"""Quality by perplexity under interpolated modified Kneser-Ney character models of trusted text, one per language.

All documents are counted once: the n-grams of trusted documents train the model, and the n-grams of all documents are the ones
whose probabilities are needed.  Both are tables sharded by (language, n-gram).  From order 1 up, a level's probabilities come
from equi-joins of the needed n-grams with the level's counts, its context totals and the level below.  The finished table has
one row per n-gram that occurs anywhere; documents are scored with it, broadcast if it is within ``BROADCAST_ROWS`` and by a
sharded join of each document's n-grams beyond that.  A document passes if its perplexity is within its language's threshold.
For the thresholds, trusted texts are dealt to ``FOLDS`` folds and each is scored with its own fold's counts left out; the
threshold is a quantile over all trusted documents of the language times a slack.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoloom.llm.chargrams import CLASS_BITS, CLASSES, count_grams, grams, pieces, print_classes, sums_by_row
from sonoloom.llm.answers import written
from sonoloom.llm.common import keep_possible
from sonoloom.session import checkpointed

ORDER = 5
QUANTILE = 0.995
SLACK = 1.1
FOLDS = 5
BROADCAST_ROWS = 4_000_000
UNNAMED = "und"


def _tail(gram: str, order: int) -> Column:
    """The last ``order`` characters of a packed n-gram."""
    return F.col(gram).bitwiseAND(F.lit((1 << (CLASS_BITS * order)) - 1))


def _discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) after Chen and Goodman from the numbers of n-grams seen once to four times; 0.5, 1, 1.5 where undefined."""
    seen = [F.count(F.when(F.col("n") == i, 1)).alias(f"c{i}") for i in range(1, 5)]
    y = F.try_divide(F.col("c1"), F.col("c1") + 2 * F.col("c2"))

    def discount(i: int) -> Column:
        value = i - (i + 1) * y * F.try_divide(F.col(f"c{i + 1}"), F.col(f"c{i}"))
        usable = (F.col(f"c{i + 1}") > 0) & (value > 0) & (value < i)
        return F.when(usable, value).otherwise(F.lit(i * 0.5))

    return counts.groupBy("lang").agg(*seen).select("lang", *[discount(i).alias(f"d{i}") for i in (1, 2, 3)])


def _level(needed: DataFrame, counts: DataFrame, lower: DataFrame | None, order: int) -> DataFrame:
    """(lang, gram, p) for the ``needed`` n-grams of one order.

    P(c|h) = (n(hc) - D(n(hc))) / n(h) + gamma(h) P(c|h'), gamma(h) = (D1 N1(h) + D2 N2(h) + D3 N3+(h)) / n(h); where the context
    was never seen, P(c|h').
    """
    d = _discounts(counts)
    cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    priced = counts.join(F.broadcast(d), "lang").select("lang", "gram", "n", cut.alias("cut"))
    context = F.shiftright("gram", CLASS_BITS).alias("context")
    totals = priced.groupBy("lang", context).agg(F.sum("n").alias("total"), F.sum("cut").alias("saved"))
    rows = needed.select("lang", "gram", context, _tail("gram", order - 1).alias("below"))
    rows = rows.join(priced, ["lang", "gram"], "left").join(totals, ["lang", "context"], "left")
    if lower is None:
        rows = rows.withColumn("q", F.lit(1.0 / CLASSES))
    else:
        rows = rows.join(lower.select("lang", F.col("gram").alias("below"), F.col("p").alias("q")), ["lang", "below"])
    own = F.coalesce((F.col("n") - F.col("cut")) / F.col("total"), F.lit(0.0))
    p = own + F.coalesce(F.col("saved") / F.col("total"), F.lit(1.0)) * F.col("q")
    return rows.select("lang", "gram", p.alias("p"))


def log_probabilities(counted: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(lang, gram, log_p) of every n-gram in ``wanted`` (lang, gram), or else in ``counted``.

    ``counted`` is (lang, gram, trusted: count in trusted text, 0 for none).
    """
    counts = {ORDER: counted.filter("trusted > 0").select("lang", "gram", F.col("trusted").alias("n"))}
    needed = {ORDER: (counted if wanted is None else wanted).select("lang", "gram")}
    for order in range(ORDER - 1, 0, -1):
        tail = _tail("gram", order).alias("gram")
        counts[order] = written(counts[order + 1].groupBy("lang", tail).agg(F.count(F.lit(1)).alias("n")), "counts")
        needed[order] = needed[order + 1].select("lang", tail).distinct()
    level = None
    for order in range(1, ORDER + 1):
        level = written(_level(needed[order], counts[order], level, order), "level")
    return level.select("lang", "gram", F.log("p").alias("log_p"))


def _sums(logs: dict[str, tuple[np.ndarray, np.ndarray]]):
    """A function (langs, texts) -> (characters, summed log-probabilities) of whole texts."""
    classes = print_classes()
    none = (np.empty(0, np.int64), np.empty(0, np.float32))

    def sums(langs: pd.Series, texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        chars, total = np.zeros(len(texts)), np.zeros(len(texts))
        names = langs.to_numpy(object)
        for name in sorted(set(names)):
            at = np.flatnonzero(names == name)
            keys, values = logs.get(name, none)  # a language without a visible character has no n-grams
            for rows, parts, context in pieces((texts.iat[i] for i in at), ORDER - 1):
                packed, sizes = grams(parts, context, classes, ORDER, True)
                if not len(packed):
                    continue
                codes, unique = pd.factorize(packed)
                found = values[np.minimum(np.searchsorted(keys, unique), len(keys) - 1)].astype(np.float64)
                sums_by_row(found[codes], sizes, [at[r] for r in rows], total)
                np.add.at(chars, at[np.asarray(rows)], sizes)
        return chars, total

    return sums


def _scored_broadcast(docs: DataFrame, table: DataFrame) -> DataFrame:
    logs = {}
    for name in sorted(r["lang"] for r in table.select("lang").distinct().collect()):
        # columns, not rows, come to the driver: 12 bytes for each of at most BROADCAST_ROWS
        part = table.filter(F.col("lang") == name).select("gram", F.col("log_p").cast("float")).toArrow()
        keys, values = part["gram"].to_numpy(), part["log_p"].to_numpy()
        order = np.argsort(keys)
        logs[name] = (keys[order], values[order])
    shared = docs.sparkSession.sparkContext.broadcast(logs)

    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        sums = _sums(shared.value)
        for langs, texts in batches:
            chars, total = sums(langs, texts)
            yield pd.DataFrame({"chars": chars.astype(np.int64), "logs": total})

    return docs.withColumn("_s", F.pandas_udf(score, "chars bigint, logs double")("_lang", "text"))


def _scored_join(docs: DataFrame, table: DataFrame) -> DataFrame:
    """The same by a sharded join: every document's different n-grams with their counts meet the table's rows."""
    key = F.monotonically_increasing_id()
    rows = checkpointed(docs.withColumn("_row", key))

    def own_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classes = print_classes()
        for batch in batches:
            for row, lang, text in zip(batch["_row"], batch["_lang"], batch["text"]):
                for _, parts, context in pieces([text], ORDER - 1):
                    keys, n = np.unique(grams(parts, context, classes, ORDER, True)[0], return_counts=True)
                    if len(keys):
                        yield pd.DataFrame({"_row": row, "lang": lang, "gram": keys, "n": n})

    each = rows.select("_row", "_lang", "text").mapInPandas(own_grams, "_row bigint, lang string, gram bigint, n bigint")
    sums = (
        each.join(table, ["lang", "gram"])
        .groupBy("_row")
        .agg(F.sum("n").alias("chars"), F.sum(F.col("n") * F.col("log_p").cast("float").cast("double")).alias("logs"))
    )
    zero = F.struct(F.lit(0).cast("bigint").alias("chars"), F.lit(0.0).alias("logs"))
    joined = rows.join(sums.select("_row", F.struct("chars", "logs").alias("_s")), "_row", "left")
    return joined.withColumn("_s", F.coalesce("_s", zero)).drop("_row")


def _perplexities(docs: DataFrame, table: DataFrame, n: int, broadcast_rows: int) -> DataFrame:
    """(doc_id, _lang, perplexity) of ``docs`` by the ``n`` rows of ``table``."""
    scored = _scored_broadcast(docs, table) if n <= broadcast_rows else _scored_join(docs, table)
    perplexity = F.when(F.col("_s.chars") > 0, F.exp(-F.col("_s.logs") / F.col("_s.chars")))
    return scored.select("doc_id", "_lang", perplexity.alias("perplexity"))


def judge_quality(
    docs: DataFrame, trusted: DataFrame, *, quantile: float = QUANTILE, slack: float = SLACK, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """(doc_id, lang, perplexity, threshold, keep) of every row of ``docs``; ``trusted`` has the doc_ids of trusted documents.

    Perplexity is per character.  A null language is the language 'und'.  Texts without a visible character (null and empty
    too) have a null perplexity and are not kept; languages without trusted text have a null threshold and keep all others.
    A language whose trusted texts are all in one fold gives them the uniform model's perplexity as a threshold.
    Repeated rows are judged alike, and each counts; null ids are never trusted; empty tables give no rows.
    """
    ids = trusted.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast(docs.schema["doc_id"].dataType)).distinct()
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit(UNNAMED)).alias("_lang"), "text")
    key = F.xxhash64("doc_id").alias("_key")
    good = keep_possible(rows.select("*", key), "_key", ids.select(key)).join(ids, "doc_id", "left_semi")
    fold = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(FOLDS)).cast("string")  # by text: copies share a fold
    good = checkpointed(good.select("doc_id", F.concat(fold, "_lang").alias("_lang"), "text"))
    own = count_grams(good, "_lang", ORDER, print_classes)
    own = written(own.select(F.substring("_lang", 1, 1).alias("fold"), F.substring("_lang", 2, 1 << 30).alias("lang"), "gram", "n"), "own")
    seen = count_grams(rows, "_lang", ORDER, print_classes).select(F.col("_lang").alias("lang"), "gram", F.lit(0).cast("bigint").alias("n"))
    counted = written(seen.unionByName(own.drop("fold")).groupBy("lang", "gram").agg(F.sum("n").alias("trusted")), "counted")
    judged = checkpointed(_perplexities(rows, log_probabilities(counted), counted.count(), broadcast_rows))
    by_fold = own.groupBy("lang", "gram").agg(*[F.sum(F.when(F.col("fold") == str(f), F.col("n")).otherwise(0)).alias(f"n{f}") for f in range(FOLDS)])
    total = sum(F.col(f"n{f}") for f in range(FOLDS))
    left = F.explode(F.array(*[F.struct(F.lit(str(f)).alias("fold"), (total - F.col(f"n{f}")).alias("trusted"), (F.col(f"n{f}") > 0).alias("own")) for f in range(FOLDS)]))
    others = by_fold.select("lang", "gram", left.alias("z")).select(F.concat("z.fold", "lang").alias("lang"), "gram", "z.trusted", "z.own")
    others = written(others, "others")
    wanted = others.filter("own")
    held_out = _perplexities(good, log_probabilities(others, wanted), wanted.count(), broadcast_rows)
    limits = held_out.groupBy(F.substring("_lang", 2, 1 << 30).alias("_lang")).agg(
        (F.percentile_approx("perplexity", quantile, 10_000) * slack).alias("threshold")
    )
    named = judged.join(F.broadcast(limits), "_lang", "left")
    keep = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return named.select(
        "doc_id",
        F.col("_lang").alias("lang"),
        F.round("perplexity", 6).alias("perplexity"),
        F.round("threshold", 6).alias("threshold"),
        keep.alias("keep"),
    )
