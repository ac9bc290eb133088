"""The queries of the numbered operators and their check SQL; ``__spark_entry__`` adds them where this package is present."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoloom.llm.common import table
from sonoloom.llm.decontaminate import containments
from sonoloom.llm.fill_in_middle import fill_in_middle, restored
from sonoloom.llm.kd_shards import kd_shards
from sonoloom.llm.language_id import fit as fit_languages
from sonoloom.llm.language_id import identify
from sonoloom.llm.line_dedup import dedup_lines
from sonoloom.llm.maxscore import top_k
from sonoloom.llm.near_dup import near_duplicates
from sonoloom.llm.quality_lm import judge_quality
from sonoloom.llm.sentencepiece_lattice import segmentations
from sonoloom.llm.token_counts import TokenLedger
from sonoloom.llm.set_relations import jaccard_groups
from sonoloom.llm.toxicity import fit as fit_toxicity
from sonoloom.llm.toxicity import score_toxicity
from sonoloom.llm.whitening import whiten
from sonoloom.session import work_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents").withColumn("_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)))
    models = fit_languages(docs.filter(~F.col("_out")))
    return identify(docs, models).select(
        "doc_id", F.col("_out").alias("held_out"), "_language.lang_pred", "_language.score", "_language.entropy"
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in at least 10 documents, dropped everywhere."""
    done = dedup_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return done.select(
        "doc_id",
        F.col("lines").alias("n_lines"),
        F.col("dropped").alias("n_dropped"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


OP2_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
  FROM documents),
k AS (
  SELECT doc_id, i, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (f.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY doc_id
"""


def op3_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose five-word shingles agree to 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), 85).select("doc_id", "n_shingles", "component_id", "kept")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens by source, language and tokenizer after inserts, a revision, deletes, their return, and replays of these three."""
    docs = table(spark, sf_dir, "documents")
    share = F.pmod(F.xxhash64("doc_id"), F.lit(10))
    named = docs.filter("doc_id IS NOT NULL")
    ledger = TokenLedger(spark, work_path(spark, "token-ledger"))
    batches = [
        lambda: ledger.insert("even", docs.filter(share % 2 == 0)),
        lambda: ledger.insert("odd", docs.filter(share % 2 == 1)),
        lambda: ledger.revise("revised", named.filter(share == 7)),
        lambda: ledger.delete("deleted", named.filter(share == 3)),
        lambda: ledger.insert("again", named.filter(share == 3)),
    ]
    for commit in [*batches, *batches[2:]]:
        commit()
    return ledger.totals()


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain at least 0.8 of a test item's five-word shingles."""
    found = containments(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_shared", "containment")


OP5_SQL = r"""
WITH w AS (
  SELECT 'd' AS side, doc_id AS id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') FROM benchmark),
s AS (
  SELECT DISTINCT side, id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
         lambda i: array_to_string(w[i:i + 4], ' '))) AS x FROM w WHERE len(w) > 0),
n AS (SELECT id, count(*) AS n FROM s WHERE side = 'b' GROUP BY id),
c AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS m FROM s d JOIN s b ON d.x = b.x AND d.side = 'd' AND b.side = 'b'
      GROUP BY 1, 2)
SELECT doc_id, item_id, n AS n_shingles, m AS n_shared, round(m / n, 6) AS containment
FROM c JOIN n ON n.id = c.item_id WHERE m * 10 >= n * 8
"""


def op6_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best and sampled segmentations of every document with inclusion scores, and their counts and checksums."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return segmentations(docs, digest=True)


def op7_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest inner products of every fiftieth vector with all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), 5)


OP7_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


def op8_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    placed = kd_shards(table(spark, sf_dir, "documents"), 24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from four fifths of the labelled ones."""
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", out.alias("_out"))
    labels = table(spark, sf_dir, "labels").filter(~out)
    return score_toxicity(docs, fit_toxicity(docs, labels)).select(
        "doc_id", F.col("_out").alias("held_out"), "_toxicity.score", "_toxicity.predicted", "_toxicity.evidence"
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under models of the documents labelled good, and whether it passes."""
    trusted = table(spark, sf_dir, "labels").filter(F.col("quality") == 1)
    return judge_quality(table(spark, sf_dir, "documents"), trusted)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every usable embedding."""
    white = whiten(table(spark, sf_dir, "embeddings"), 4).select("vec_id", "_white.*")
    parts = white.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("pos", "part"))
    return parts.select(
        "vec_id",
        (F.col("pos") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        "part.whitened",
        "part.explained",
        "identity_error",
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into prefix, middle and suffix, half of them rearranged, and the text got back."""
    done = fill_in_middle(table(spark, sf_dir, "documents")).select("doc_id", "_fim.*")
    return done.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM d),
c AS (
  SELECT doc_id, t, u, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM u),
p AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(u[b + 1:], ''), '') AS s
  FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


def op13_set_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose three-word shingles agree to 0.9."""
    return jaccard_groups(table(spark, sf_dir, "documents"), 90)


OP13_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 2, 1) + 1),
         lambda i: array_to_string(w[i:i + 2], ' '))) AS x FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 90 * (x.n + y.n - m)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT r.a AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a
"""


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_line_dedup,
        op3_setsketch_near_dedup,
        op4_token_counts,
        op5_benchmark_decontamination,
        op6_sentencepiece_sampling,
        op7_maxscore_topk,
        op8_kd_sharding,
        op9_toxicity,
        op10_quality_classifier,
        op11_whitening,
        op12_fill_in_middle,
        op13_set_relations,
    )
}
CHECKS: dict[str, str] = {
    "op2_line_dedup": OP2_SQL,
    "op5_benchmark_decontamination": OP5_SQL,
    "op7_maxscore_topk": OP7_SQL,
    "op12_fill_in_middle": OP12_SQL,
    "op13_set_relations": OP13_SQL,
}
