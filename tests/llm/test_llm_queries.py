"""The registered queries on the smallest tables: against SQL, brute force, exact round trips or held-out accuracy."""

import collections
import zlib

import pytest
from check import compare, duck

from sonoloom.llm import queries, sentencepiece_lattice, token_counts


@pytest.fixture(scope="module")
def texts(spark, tiny):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()}


def words(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def groups(sets, percent):
    """doc_id -> least doc_id reachable over pairs whose sets agree, by comparing all pairs."""
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if 100 * min(len(sets[i]), len(sets[j])) < percent * max(len(sets[i]), len(sets[j])):
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_against_sql(spark, tiny, name):
    verdict, _, _ = compare(spark, duck(tiny), name, queries.QUERIES[name], queries.CHECKS[name], tiny)
    assert verdict.startswith("ok") and "TYPES" not in verdict, verdict


def held_out(doc_id, modulus, rest):
    return zlib.crc32(str(doc_id).encode()) % modulus == rest


def test_op1(spark, tiny, texts):
    rows = queries.op1_language_id(spark, tiny).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "lang").collect()}
    assert {r.doc_id for r in rows} == set(texts) and all(r.held_out == held_out(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in rows)
    unseen = [r for r in rows if r.held_out and langs[r.doc_id]]
    assert sum(r.lang_pred == langs[r.doc_id] for r in unseen) >= 0.95 * len(unseen)


def test_op3(spark, tiny, texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    want = groups(sets, 85)
    rows = queries.op3_setsketch_near_dedup(spark, tiny).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def test_op4(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").collect()
    want = collections.Counter()
    for name, data in token_counts.read_vocabularies(token_counts.TOKENIZERS).items():
        encoding = token_counts.WordCounter(data).encoding
        for d in docs:
            for column, n in (("docs", 1), ("tokens", len(encoding.encode_ordinary(d.text or ""))), ("bytes", len((d.text or "").encode()))):
                want[(d.source, d.lang, name, column)] += n
    rows = queries.op4_token_counts(spark, tiny).collect()
    assert {(r.source, r.lang, r.tokenizer, c): r[c] for r in rows for c in ("docs", "tokens", "bytes")} == dict(want)


def test_op6(spark, tiny, texts):
    processor = sentencepiece_lattice.Encoder(sentencepiece_lattice.read_model()).processor
    import numpy as np

    rows = queries.op6_sentencepiece_sampling(spark, tiny).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        ids = np.array(processor.encode(texts[r.doc_id] or ""), np.int32)
        assert (r.n_tokens, r.ids_crc32, r.round_trip) == (len(ids), zlib.crc32(ids.tobytes()), True)
        assert len(r.samples) == len({s.ids_crc32 for s in r.samples}) == 2
    again = queries.op6_sentencepiece_sampling(spark, tiny).collect()
    assert {r.doc_id: r for r in rows} == {r.doc_id: r for r in again}


def test_op8(spark, tiny, texts):
    rows = queries.op8_kd_sharding(spark, tiny).collect()
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == {
        i: (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts.items()
    }
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(24))
    assert max(size.values()) - min(size.values()) <= 2 * max(r["size"] for r in rows)


def test_op9(spark, tiny, texts):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{tiny}/labels.parquet").collect()}
    rows = queries.op9_toxicity(spark, tiny).collect()
    assert {r.doc_id for r in rows} == set(texts)
    assert all(r.held_out == held_out(r.doc_id, 5, 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    known = [r for r in rows if r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in known) >= 0.85 * len(known)


def test_op10(spark, tiny, texts):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{tiny}/labels.parquet").collect()}
    rows = queries.op10_quality_classifier(spark, tiny).collect()
    assert {r.doc_id for r in rows} == set(texts)
    good = [r for r in rows if labels.get(r.doc_id) == 1]
    assert sum(r.keep for r in good) >= 0.97 * len(good) and all(r.perplexity > 1 for r in rows)


def test_pipeline_stages(spark, tiny, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        stage(spark, docs, tiny).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r for r in docs.collect()}
        assert len(after) == docs.count() and (name == "sentencepiece" or docs.columns == columns)
        if name == "language_id":
            assert len(after) >= 0.98 * len(before)
        elif name == "line_dedup":
            key = lambda line: line.strip(" \t\n\x0b\f\r").encode().lower()
            seen = collections.Counter(k for r in before.values() for k in {key(x) for x in r.text.split("\n")} if k)
            for i, r in before.items():
                kept = "\n".join(x for x in r.text.split("\n") if seen[key(x)] < 10)
                assert (after[i].text, after[i].n_chars) == (kept, len(kept) if kept != r.text else r.n_chars)
        elif name == "near_dedup":
            found = groups({i: shingles(r.text) for i, r in before.items()}, 80)
            assert set(after) == {i for i, first in found.items() if i == first}
        elif name == "decontaminate":
            sets = [shingles(t) for t in items]
            leaks = {i for i, r in before.items() if any(s and 10 * len(s & shingles(r.text)) >= 8 * len(s) for s in sets)}
            assert set(after) == set(before) - leaks and leaks
        else:
            assert set(after) == set(before) and all(r.round_trip for r in after.values())
