"""Language ID by interpolated Kneser-Ney character models, one per language, held in sorted hash arrays.

Counting, continuation counts and context totals are aggregations over all training documents.  What is broadcast are the
smoothed models: per language at most 2^SLOT_BITS hashed 4-grams, as many hashed 3-grams, 2^14 bigrams and 2^7 characters, each
with a context weight, about 25 MB however large the corpus, for at most ``max_languages`` languages.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoloom.llm.chargrams import CLASS_BITS, CLASSES, count_grams, grams, letter_classes, pieces, sums_by_row
from sonoloom.llm.common import packed, unpacked
from sonoloom.session import checkpointed

ORDER = 4
SLOT_BITS = 19
MAX_LANGUAGES = 32
UNKNOWN = "und"


def slot(gram, order: int):
    """Hash slot of a packed n-gram (numpy array or Spark column of longs); orders 1 and 2 keep their exact codes."""
    if order <= 2:
        return gram
    mixed = gram * 0x5851F42D
    if isinstance(gram, Column):
        return F.shiftright(mixed, 17).bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
    return (mixed >> 17) & ((1 << SLOT_BITS) - 1)


@dataclass
class LanguageModel:
    """Sorted arrays per order: n-gram slots with log-probabilities, context slots with log interpolation weights."""

    language: str
    gram_slots: list[np.ndarray]
    gram_logs: list[np.ndarray]
    context_slots: list[np.ndarray]
    context_logs: list[np.ndarray]
    mean: float
    variance: float

    def logs(self, packed: np.ndarray) -> np.ndarray:
        """Log-probability of the last character of each packed n-gram given those before it."""
        result = np.full(len(packed), -math.log(CLASSES))
        for order in range(1, len(self.gram_slots) + 1):
            gram = packed & ((1 << (CLASS_BITS * order)) - 1)
            if order > 1:
                weight, found = look_up(self.context_slots[order - 1], self.context_logs[order - 1], slot(gram >> CLASS_BITS, order - 1))
                result = np.where(found, result + weight, result)
            known, found = look_up(self.gram_slots[order - 1], self.gram_logs[order - 1], slot(gram, order))
            result = np.where(found, known, result)
        return result


def look_up(slots: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(slots):
        return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(slots, wanted), len(slots) - 1)
    return values[at], slots[at] == wanted


def _smoothed(counts: pd.DataFrame, contexts: pd.DataFrame, order: int, lower: LanguageModel) -> None:
    """Add one order to ``lower``: P(c|h) = max(n(hc) - D, 0) / n(h) + D types(h) / n(h) * P(c|h')."""
    ones, twos = (counts["n"] == 1).sum(), (counts["n"] == 2).sum()
    discount = float(ones / (ones + 2 * twos)) if ones and twos else 0.5
    contexts = contexts.sort_values("slot")
    total, types = contexts["total"].to_numpy(float), contexts["types"].to_numpy(float)
    counts = counts.sort_values("slot")
    back = lower.logs(counts["gram"].to_numpy()) if order > 1 else np.full(len(counts), -math.log(CLASSES))
    at = np.searchsorted(contexts["slot"].to_numpy(), counts["context"].to_numpy())
    share = np.maximum(counts["n"].to_numpy(float) - discount, 0) / total[at]
    weight = np.minimum(discount * types / total, 1.0)
    lower.gram_slots.append(counts["slot"].to_numpy())
    lower.gram_logs.append(np.log(np.minimum(share + weight[at] * np.exp(back), 1.0)))
    lower.context_slots.append(contexts["slot"].to_numpy())
    lower.context_logs.append(np.log(weight))


def fit(docs: DataFrame, *, lang: str = "lang", max_languages: int = MAX_LANGUAGES) -> list[LanguageModel]:
    """Models of the languages named in ``docs``; rows with a null language or text teach nothing.

    Only the ``max_languages`` most frequent languages are learned (ties by name), which bounds the models' size.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col("text").isNotNull()).select(F.col(lang).cast("string").alias("_lang"), "text")
    found = checkpointed(count_grams(known, "_lang", ORDER, letter_classes))
    sizes = found.groupBy("_lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "_lang").limit(max_languages).collect()
    names = sorted(r["_lang"] for r in sizes)
    found = found.filter(F.col("_lang").isin(names))
    tables = []
    level = found
    for order in range(ORDER, 0, -1):
        keyed = level.withColumn("context", F.shiftright("gram", CLASS_BITS))
        by_gram = keyed.groupBy("_lang", slot(F.col("gram"), order).alias("slot")).agg(
            F.sum("n").alias("n"), F.min(F.struct("gram", "context")).alias("g")
        )
        by_context = keyed.groupBy("_lang", slot(F.col("context"), order - 1).alias("slot")).agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("types")
        )
        one = by_gram.select("_lang", "slot", "n", "g.gram", "g.context").toArrow().to_pandas()  # bounded by languages and slots
        one["context"] = slot(one["context"].to_numpy(), order - 1)
        tables.append((order, one, by_context.toArrow().to_pandas()))
        level = level.groupBy("_lang", F.col("gram").bitwiseAND(F.lit((1 << (CLASS_BITS * (order - 1))) - 1)).alias("gram")).agg(
            F.count(F.lit(1)).alias("n")
        )
    models = []
    for name in names:
        model = LanguageModel(name, [], [], [], [], 0.0, 0.0)
        for order, counts, contexts in reversed(tables):
            _smoothed(counts[counts["_lang"] == name], contexts[contexts["_lang"] == name], order, model)
        top = tables[0][1]
        top = top[top["_lang"] == name]
        n, cost = top["n"].to_numpy(float), -model.logs(top["gram"].to_numpy())
        model.mean = float((n * cost).sum() / n.sum())
        model.variance = float((n * (cost - model.mean) ** 2).sum() / n.sum())
        models.append(model)
    return models


SCORED = "lang_pred string, score double, entropy double, rejected boolean"


def scorer(docs: DataFrame, models: list[LanguageModel], *, sigmas: float = 12.0, slack: float = 1.0, evidence: int = 40):
    """A column function text -> struct(lang_pred, score, entropy, rejected).

    ``lang_pred`` has the lowest cross-entropy per character (ties: first by name), ``und`` for texts without a letter (null
    and empty ones too), which are rejected with score 0.  ``score`` is that language's share under equal priors when the
    text's mean log-likelihood stands for at most ``evidence`` characters.  ``rejected`` is calibrated on the training counts:
    a language's own text has a known mean and variance of the cost per character, and a text is rejected if it costs more
    than the mean by ``slack`` nats and by ``sigmas`` standard errors.
    """
    shared = docs.sparkSession.sparkContext.broadcast([vars(m) for m in models])

    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        models, classes = [LanguageModel(**m) for m in shared.value], letter_classes()
        names = np.array([m.language for m in models] + [UNKNOWN], object)
        for series in texts:
            sums, chars, letters = np.zeros((len(series), len(models))), np.zeros(len(series)), np.zeros(len(series))
            for rows, parts, context in pieces((x if isinstance(x, str) else "" for x in series), ORDER - 1):
                packed, sizes = grams(parts, context, classes, ORDER, True)
                at, keys = pd.factorize(packed)
                logs = np.stack([m.logs(keys) for m in models] + [(keys & (CLASSES - 1)) > 0], axis=1).astype(np.float64)
                total = np.zeros((len(series), len(models) + 1))
                sums_by_row(logs[at], sizes, rows, total)
                sums, letters = sums + total[:, :-1], letters + total[:, -1]
                np.add.at(chars, rows, sizes)
            some = (letters > 0) & (len(models) > 0)
            mean = -sums / np.maximum(chars, 1)[:, None]
            best = np.where(some, mean.argmin(axis=1) if len(models) else 0, len(models))
            low = np.where(some, mean.min(axis=1, initial=np.inf), 0.0)
            weight = np.exp(-(mean - low[:, None]) * np.minimum(chars, evidence)[:, None])
            share = np.where(some, 1.0 / np.maximum(weight.sum(axis=1), 1.0), 0.0)
            expected = np.array([m.mean for m in models] + [0.0])[best]
            spread = np.sqrt(np.array([m.variance for m in models] + [0.0])[best] / np.maximum(chars, 1))
            rejected = ~some | (low > expected + np.maximum(sigmas * spread, slack))
            yield pd.DataFrame(
                {"lang_pred": names[best], "score": np.round(share, 6), "entropy": np.round(low, 6), "rejected": rejected}
            )

    return F.pandas_udf(score, SCORED)


def identify(docs: DataFrame, models: list[LanguageModel], **options: float) -> DataFrame:
    """``docs`` with ``_language``, the struct that ``scorer`` gives; any other columns pass through, nulls included.

    Empty tables give no rows; without a model every text is ``und``.
    """
    return docs.withColumn("_language", scorer(docs, models, **options)(F.col("text")))


def in_learned_language(docs: DataFrame, models: list[LanguageModel], **options: float) -> DataFrame:
    """``docs`` without the rows that language ID rejects; the columns stay."""
    kept = identify(packed(docs), models, **options).filter(~F.col("_language.rejected"))
    return kept.select(*unpacked(docs.columns))
