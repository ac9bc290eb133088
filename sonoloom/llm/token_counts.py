"""Token counts kept up to date by signed deltas and maintained rollups.

Every batch writes per-document deltas: +count for an insert, -count for a delete, both for a revised document; and their
sums by source, language and tokenizer version.  Totals are sums of these rollups only.  A log kept with the data gives every batch
its place at its first commit.  A batch that is committed again keeps that place and computes its deltas from the
batches before it, so a replay changes nothing, whichever batches came since and whichever driver does it.
"""

from __future__ import annotations

import base64
import sys
import types
import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

TOKENIZERS = {"byte_bpe_50k": "/opt/tokenizers/byte_bpe_50k.tiktoken", "byte_bpe_multi_50k": "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"}
# fixed value: the vocabulary's published split pattern
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHED_CHARS = 9_000_000
KEYS = ("source", "lang", "tokenizer")
SUMS = ("docs", "tokens", "bytes")
DELTAS = "doc_id {}, source string, lang string, tokenizer string, docs bigint, tokens bigint, bytes bigint"
LOG = "seq bigint, attempt bigint, batch string, deltas string, rollup string"
GROUP_CHARS = 1_000_000


class WordCounter:
    """Token counts of texts by one or more vocabularies.

    The split pattern never joins a word to the blank after it, so words are counted once and kept.  The counts by all vocabularies
    are kept in one integer, 32 bits each.  Words that are empty, or have other white space at an end, may belong to a longer
    stretch of white space: their texts are encoded whole.
    """

    def __init__(self, *vocabularies: bytes):
        self.encodings, self.begins = [], []
        for vocabulary in vocabularies:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
            self.encodings.append(tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}))
            begins = np.zeros(max(ranks.values()) + 1, bool)
            begins[[n for token, n in ranks.items() if token.startswith(b" ")]] = True
            self.begins.append(begins)
        self.encoding = self.encodings[0]
        self.whole = -(1 << 32 * (len(vocabularies) + 1))  # for words whose texts are encoded whole: no sum of counts makes up for it
        self.known: dict[str, int] = {}
        self.held = 0

    def count(self, text: str | None) -> int:
        """Tokens of a text by the first vocabulary."""
        return self.counts([text])[0][0]

    def counts(self, texts: Sequence[str | None]) -> list[list[int]]:
        """Tokens of each text by each vocabulary."""
        found, group, held = [], [], 0
        for text in texts:
            group.append(text or "")
            held += len(group[-1])
            if held >= GROUP_CHARS:
                found += self._counted(group)
                group, held = [], 0
        return found + self._counted(group)

    def _counted(self, texts: list[str]) -> list[list[int]]:
        split = [t.split(" ") for t in texts]
        if self.held > CACHED_CHARS:
            self.known.clear()
            self.held = 0
        self._learn([w for w in set(chain.from_iterable(split)) if w not in self.known])
        found, mask = [], (1 << 32) - 1
        for text, words in zip(texts, split):
            packed = sum(map(self.known.__getitem__, words))
            alone = text if packed < 0 else words[0]  # nothing comes before the first word
            packed = 0 if packed < 0 else packed - self.known[alone]
            found.append([(packed >> 32 * i & mask) + len(e.encode_ordinary(alone)) for i, e in enumerate(self.encodings)])
        return found

    def _learn(self, words: list[str]) -> None:
        """Count new words, each after a blank, all in one text: a token that begins with a blank begins a word."""
        self.held += sum(map(len, words)) + 20 * len(words)
        self.known.update((w, self.whole) for w in words if not w or w[0].isspace() or w[-1].isspace())
        plain = [w for w in words if w not in self.known]
        if not plain:
            return
        packed = [0] * len(plain)
        for i, (encoding, begins) in enumerate(zip(self.encodings, self.begins)):
            tokens = np.array(encoding.encode_ordinary(" " + " ".join(plain)), np.int64)
            at = np.append(np.flatnonzero(begins[tokens]), len(tokens))
            packed = [p + (n << 32 * i) for p, n in zip(packed, np.diff(at).tolist(), strict=True)]
        self.known.update(zip(plain, packed))


def read_vocabularies(paths: dict[str, str]) -> dict[str, bytes]:
    found = {}
    for name, path in paths.items():
        with open(path, "rb") as file:
            found[name] = file.read()
    return found


def counter(spark: SparkSession, tokenizers: dict[str, str] | None = None) -> Column | Callable:
    """A column function text -> array<bigint>: tokens of the text by each tokenizer in name order; 0 for null and empty texts."""
    paths = repr(sorted((tokenizers or TOKENIZERS).items()))
    shared = spark.sparkContext.broadcast(read_vocabularies(tokenizers or TOKENIZERS))

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # a vocabulary takes long to build and much memory, so a worker process keeps its counter from task to task
        kept = sys.modules.setdefault("_sonoloom_worker", types.ModuleType("_sonoloom_worker")).__dict__
        if paths not in kept:
            kept[paths] = WordCounter(*[v for _, v in sorted(shared.value.items())])
        for texts in batches:
            yield pa.array(kept[paths].counts(texts.to_pylist()), pa.list_(pa.int64()))

    return F.arrow_udf(count, "array<bigint>")


class TokenLedger:
    """Deltas (doc_id, source, lang, tokenizer, docs, tokens, bytes) and rollups of committed batches below ``root``.

    A ledger opened again on the same folder goes on where the last one stopped.  A batch that is committed again must hold the
    same rows.  Batches are committed one at a time.
    """

    def __init__(self, spark: SparkSession, root: str, tokenizers: dict[str, str] | None = None):
        self.spark, self.root, self.tokenizers = spark, root, tokenizers or TOKENIZERS

    def counted(self, docs: DataFrame) -> DataFrame:
        """One row per document and tokenizer; the texts are read once for all tokenizers."""
        names = sorted(self.tokenizers)
        many = docs.select(
            "doc_id",
            F.col("source").cast("string").alias("source"),
            F.col("lang").cast("string").alias("lang"),
            F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("bytes"),
            counter(self.spark, self.tokenizers)(F.col("text")).alias("_n"),
        )
        labels = F.array(*[F.lit(n) for n in names])
        return many.select("doc_id", "source", "lang", F.lit(1).cast("bigint").alias("docs"), "bytes", F.explode(F.arrays_zip(labels.alias("t"), F.col("_n").alias("n"))).alias("z")).select(
            "doc_id", "source", "lang", F.col("z.t").alias("tokenizer"), "docs", F.col("z.n").alias("tokens"), "bytes"
        )

    def entries(self) -> list[Row]:
        """The last attempt of every batch, in the order of their first commits."""
        try:
            rows = self.spark.read.schema(LOG).json(f"{self.root}/log").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        last = {r.batch: r for r in sorted(rows, key=lambda r: r.attempt)}
        return sorted(last.values(), key=lambda r: r.seq)

    def _commit(self, batch: str, deltas_of: Callable[[DataFrame | None], DataFrame]) -> None:
        """Write a batch's deltas and their rollup to new folders, then name them in the log: it counts from there on, or not at all."""
        entries = self.entries()
        mine = next((e for e in entries if e.batch == batch), None)
        seq = mine.seq if mine else max((e.seq for e in entries), default=0) + 1
        earlier = [e.deltas for e in entries if e.seq < seq]
        deltas, rollup = (f"{self.root}/{kind}/{uuid.uuid4().hex}" for kind in ("deltas", "rollups"))
        deltas_of(self._standing(self.spark.read.parquet(*earlier)) if earlier else None).write.parquet(deltas)
        self.spark.read.parquet(deltas).groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).write.parquet(rollup)
        entry = (seq, mine.attempt + 1 if mine else 0, batch, deltas, rollup)
        self.spark.createDataFrame([entry], LOG).coalesce(1).write.mode("append").json(f"{self.root}/log")

    @staticmethod
    def _standing(deltas: DataFrame) -> DataFrame:
        """What stands for each document after these deltas."""
        sums = deltas.groupBy("doc_id", *KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
        return sums.filter("docs <> 0 OR tokens <> 0 OR bytes <> 0")

    @staticmethod
    def _negative(now: DataFrame, ids: DataFrame) -> DataFrame:
        gone = now.join(ids.select("doc_id").distinct(), "doc_id", "left_semi")
        return gone.select("doc_id", *KEYS, *[(-F.col(c)).alias(c) for c in SUMS])

    def insert(self, batch: str, docs: DataFrame) -> None:
        """Add documents."""
        self._commit(batch, lambda _: self.counted(docs))

    def delete(self, batch: str, ids: DataFrame) -> None:
        """Take documents back; ids that are unknown or null change nothing."""
        none = self.spark.createDataFrame([], DELTAS.format(ids.schema["doc_id"].dataType.simpleString()))
        self._commit(batch, lambda now: none if now is None else self._negative(now, ids))

    def revise(self, batch: str, docs: DataFrame) -> None:
        """Replace documents: the old counts go, the new ones come, in one commit."""

        def deltas(now: DataFrame | None) -> DataFrame:
            new = self.counted(docs)
            return new if now is None else new.unionByName(self._negative(now, docs))

        self._commit(batch, deltas)

    def totals(self) -> DataFrame | None:
        """(source, lang, tokenizer, docs, tokens, bytes); nulls in a key are a key of their own, empty keys are left out."""
        rollups = [e.rollup for e in self.entries()]
        if not rollups:
            return None
        sums = self.spark.read.parquet(*rollups).groupBy(*KEYS).agg(*[F.sum(c).cast("bigint").alias(c) for c in SUMS])
        return sums.filter("docs <> 0 OR tokens <> 0 OR bytes <> 0")
