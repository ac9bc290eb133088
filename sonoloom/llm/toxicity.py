"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, and distance-weighted votes.

The classifier is fitted on a bounded sample of labelled rows: at most ``per_class`` examples of each label make the index, as
many more calibrate the votes.  Terms are those whose rate differs between the labels in that sample by a factor of at least
``LEAST_RATIO`` and beyond chance (log-likelihood ratio), at most ``TERMS``.  Document frequencies are counted over all documents.  So the broadcast index has a proven bound (2 * per_class
examples by TERMS weights), and every other step is one pass over the texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoloom.session import checkpointed

PER_CLASS = 2_000
TERMS = 2_048
NEIGHBOURS = 16
BLOCK = 64
LEAST_G = 16.0
LEAST_RATIO = 3.0
EVIDENCE = 3
PUNCTUATION = bytes(c if chr(c).isalnum() or c >= 128 or c == 39 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The text's words, A-Z lower-cased, ASCII punctuation taken as blank."""
    return text.encode("utf-8", "surrogatepass").lower().translate(PUNCTUATION).split() if text else []


class BlockMaxIndex:
    """Unit vectors of examples in blocks of ``BLOCK``; for every term and block the largest weight."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, width: int):
        blocks = -(-len(vectors) // BLOCK)
        self.labels = labels
        self.postings = np.zeros((blocks, width, BLOCK), np.float32)
        for i, (at, weight) in enumerate(vectors):
            self.postings[i // BLOCK, at, i % BLOCK] = weight
        self.most = self.postings.max(axis=2).T.copy() if blocks else np.zeros((width, 0), np.float32)

    def nearest(self, at: np.ndarray, weight: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest with a cosine above 0, ties to the smaller number, without ``skip``.

        Blocks are visited by falling bound and left out once the bound is below the k-th cosine: the result is exact.
        """
        bounds = weight @ self.most[at]
        best_i, best_c = np.empty(0, np.int64), np.empty(0, np.float32)
        for block in np.argsort(-bounds, kind="stable"):
            if bounds[block] <= 0 or (len(best_c) == k and bounds[block] < best_c[-1]):
                break
            cosines = weight @ self.postings[block][at]
            hit = np.flatnonzero(cosines > 0)
            who = block * BLOCK + hit
            use = who != skip
            best_i, best_c = np.concatenate([best_i, who[use]]), np.concatenate([best_c, cosines[hit][use]])
            order = np.lexsort((best_i, -best_c))[:k]
            best_i, best_c = best_i[order], best_c[order]
        return best_i, best_c


def vector(found: Counter, vocabulary: dict[bytes, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit TF-IDF vector, weights (1 + ln tf) * idf, over the vocabulary."""
    pairs = sorted((vocabulary[t], n) for t, n in found.items())
    at = np.array([p[0] for p in pairs], np.int64)
    weight = (1 + np.log(np.array([p[1] for p in pairs], float))) * idf[at] if pairs else np.empty(0)
    return at, (weight / np.linalg.norm(weight) if pairs else weight).astype(np.float32)


def known_terms(text: str | None, vocabulary: dict[bytes, int]) -> Counter:
    return Counter(w for w in terms_of(text) if w in vocabulary)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted non-decreasing fit (pool adjacent violators): steps (x, value)."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for i in order:
        pools.append([x[i], y[i] * w[i], w[i]])
        while len(pools) > 1 and (pools[-2][0] == pools[-1][0] or pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]):
            last = pools.pop()
            pools[-1] = [max(pools[-1][0], last[0]) if pools[-1][0] == last[0] else pools[-1][0], pools[-1][1] + last[1], pools[-1][2] + last[2]]
    return np.array([p[0] for p in pools]), np.array([p[1] / p[2] for p in pools])


def _sample(labels: DataFrame, label: str, per_class: int) -> list:
    """Up to 2 * per_class labelled ids of each class by hash: (doc_id, label, use); use 0 is index, 1 is calibration."""
    picked = []
    for value in (0, 1):
        rows = labels.filter(F.col(label) == value).select("doc_id", F.xxhash64(F.col("doc_id").cast("string")).alias("h"))
        found = rows.orderBy("h", "doc_id").limit(2 * per_class).collect()  # bounded by the parameter
        picked += [(r["doc_id"], value, i % 2) for i, r in enumerate(found)]
    return picked


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", per_class: int = PER_CLASS) -> dict:
    """The fitted model as plain arrays: vocabulary, idf, examples and calibration.

    Labels other than 0 and 1, null ids and ids labelled both ways are left out; so are labelled ids without a document.
    Without any example of either class every score is that class's share, 0 if there are no labels at all.
    """
    spark = docs.sparkSession
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min(label).alias(label), F.max(label).alias("_most"))
        .filter(F.col(label) == F.col("_most"))
    )
    known = checkpointed(known.select("doc_id", label))
    counts = {r[label]: r["count"] for r in known.groupBy(label).count().collect()}
    total = sum(counts.values())
    prior = counts.get(1, 0) / total if total else 0.0
    picked = _sample(known, label, per_class)
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = spark.createDataFrame(picked, f"doc_id {kind}, _label int, _use int")
    texts = checkpointed(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]))

    def rates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (Counter(), Counter())
        for batch in batches:
            for text, side in zip(batch.column("text"), batch.column("_label").to_pylist()):
                found[side].update(set(terms_of(text.as_py())))
        names = list(found[0] | found[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), *[pa.array([c[t] for t in names], pa.int64()) for c in found]], ["term", "n0", "n1"]
        )

    sizes = {r["_label"]: r["count"] for r in texts.groupBy("_label").count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    by_term = texts.select("text", "_label").mapInArrow(rates, "term binary, n0 bigint, n1 bigint").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    seen = F.col("n0") + F.col("n1")
    surprise = sum(F.coalesce(F.col(c) * F.log(F.col(c) * (n0 + n1) / (seen * F.greatest(F.lit(n), F.lit(1)))), F.lit(0.0)) for c, n in (("n0", n0), ("n1", n1)))
    ratio = F.abs(F.log((F.col("n1") + 0.5) / (n1 + 1) / ((F.col("n0") + 0.5) / (n0 + 1))))
    telling = by_term.withColumn("g", 2 * surprise).filter((F.col("g") >= LEAST_G) & (ratio >= np.log(LEAST_RATIO)))
    chosen = sorted(bytes(r["term"]) for r in telling.orderBy(F.desc("g"), "term").limit(TERMS).collect())
    vocabulary = {t: i for i, t in enumerate(chosen)}
    shared = spark.sparkContext.broadcast(vocabulary)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, found, rows = shared.value, Counter(), 0
        for batch in batches:
            rows += batch.num_rows
            for text in batch.column("text"):
                found.update({w for w in terms_of(text.as_py()) if w in wanted})
        terms = [wanted[t] for t in found]
        yield pa.RecordBatch.from_arrays([pa.array([-1, *terms], pa.int32()), pa.array([rows, *found.values()], pa.int64())], ["term", "n"])

    counted = docs.select("text").mapInArrow(frequencies, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    by_id = {r["term"]: r["n"] for r in counted}
    idf = np.log((1 + by_id.get(-1, 0)) / (1 + np.array([by_id.get(i, 0) for i in range(len(chosen))], float))) + 1

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            made = [vector(known_terms(t.as_py(), wanted), wanted, idf) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("_label"),
                    batch.column("_use"),
                    pa.array([m[0] for m in made], pa.list_(pa.int64())),
                    pa.array([m[1] for m in made], pa.list_(pa.float32())),
                ],
                ["doc_id", "_label", "_use", "at", "weight"],
            )

    made = texts.select("doc_id", "_label", "_use", "text").mapInArrow(
        vectors, f"doc_id {kind}, _label int, _use int, at array<bigint>, weight array<float>"
    )
    rows = sorted(made.collect(), key=lambda r: (r["_label"], str(r["doc_id"])))  # at most 4 * per_class sparse vectors
    pack = lambda r: (np.array(r["at"], np.int64), np.array(r["weight"], np.float32))
    examples = [r for r in rows if r["_use"] == 0]
    index = BlockMaxIndex([pack(r) for r in examples], np.array([r["_label"] for r in examples], np.int64), len(chosen))
    held = [r for r in rows if r["_use"] == 1]
    x = np.array([vote(index, *pack(r))[0] for r in held])
    y = np.array([r["_label"] for r in held], float)
    share = {1: prior / max(y.sum(), 1), 0: (1 - prior) / max((1 - y).sum(), 1)}
    steps = isotonic(x, y, np.array([share[int(v)] for v in y]) + 1e-12) if len(held) else (np.array([-1.0]), np.array([prior]))
    return {
        "vocabulary": vocabulary,
        "idf": idf,
        "index": vars(index),
        "ids": [r["doc_id"] for r in examples],
        "steps": steps,
    }


def vote(index: BlockMaxIndex, at: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Share of label 1 among the nearest examples, weighted by cosine; -1 where no example shares a term."""
    if not len(at):
        return -1.0, np.empty(0, np.int64), np.empty(0, np.float32)
    near, cosine = index.nearest(at, weight, NEIGHBOURS)
    if not len(near):
        return -1.0, near, cosine
    w = cosine.astype(float) ** 2
    return float((w * index.labels[near]).sum() / w.sum()), near, cosine


def score_toxicity(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``_toxicity``: struct(score, predicted, evidence) of every text.

    The score is the calibrated vote, ``predicted`` 1 from 0.5 on; ``evidence`` lists the nearest examples by id and cosine.
    Texts without a known term (null and empty ones too) get the calibrated share of such texts.  Rows are scored one by
    one, so repeated rows agree; other columns pass through; an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        index = BlockMaxIndex.__new__(BlockMaxIndex)
        index.__dict__.update(model["index"])
        steps_x, steps_y = model["steps"]
        for texts in batches:
            scores, evidence = [], []
            for text in texts:
                at, weight = vector(known_terms(text, model["vocabulary"]), model["vocabulary"], model["idf"])
                value, near, cosine = vote(index, at, weight)
                scores.append(round(float(steps_y[max(np.searchsorted(steps_x, value + 1e-9, side="right") - 1, 0)]), 6))
                evidence.append([{"doc_id": model["ids"][i], "cosine": round(float(c), 5)} for i, c in zip(near[:EVIDENCE], cosine)])
            yield pd.DataFrame({"score": scores, "predicted": [int(s >= 0.5) for s in scores], "evidence": evidence})

    udf = F.pandas_udf(score, f"score double, predicted int, evidence array<struct<doc_id:{kind},cosine:double>>")
    return docs.withColumn("_toxicity", udf(F.col("text")))
