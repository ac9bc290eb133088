"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import collections
import math
import random
import zlib

import numpy as np
import pytest

from sonoloom.llm import (
    answers,
    chargrams,
    decontaminate,
    kd_shards,
    language_id,
    line_dedup,
    maxscore,
    near_dup,
    quality_lm,
    sentencepiece_lattice,
    token_counts,
    toxicity,
)

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, _row string, _key int, h string, bucket int,"
    " kept string, node string, size string, _language string, label string"
)
A = " ".join(f"river{i} stone{i % 7} the" for i in range(30))
B = "Une phrase tout à fait différente, écrite en français.\nEt une autre ligne.\nShared line"
LONG = "\n".join(f"line {i} of a very long text" for i in range(60_000))
TEXTS = [
    (1, None, "en"),
    (2, "", "en"),
    (3, " \t\n ", None),
    (4, "word", "fr"),
    (5, LONG, "en"),
    (6, A, "en"),
    (6, A, "en"),
    (7, A.upper(), "en"),
    (8, A + " tail", None),
    (None, B, "fr"),
    (9, B, "fr"),
    (10, "!!! 123 ???", "de"),
    (11, "Shared line\nown line", "en"),
    (None, None, None),
]


def table(spark, rows=TEXTS):
    filled = [(i, t, la, "s", len(t or ""), "r", 1, "h", 2, "k", "n", "z", "x", "y") for i, t, la in rows]
    return spark.createDataFrame(filled, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, A), (1, A), (2, None), (3, ""), (4, "word"), (None, B.replace("\n", " ")), (5, "line 7 of a very long text line 8 of")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def same_columns(before, after):
    assert after.columns == before.columns and after.dtypes == before.dtypes


def test_language_id(spark, docs, none):
    models = language_id.fit(docs)
    assert [m.language for m in models] == ["en", "fr"]  # the German text has no letter
    rows = language_id.identify(docs.drop("_language"), models).select("doc_id", "text", "_language.*").collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert 0 < r.score <= 1
    assert {r.lang_pred for r in rows if r.text == B} == {"fr"} and {r.lang_pred for r in rows if r.text == A} == {"en"}
    kept = language_id.in_learned_language(docs, models)
    same_columns(docs, kept)
    assert {r.doc_id for r in kept.collect()} >= {5, 9}
    assert language_id.fit(none) == []
    assert {r[0] for r in language_id.identify(docs.drop("_language"), []).select("_language.lang_pred").collect()} == {"und"}
    assert language_id.in_learned_language(none, models).count() == 0


def expected_lines(texts, least):
    def key(line):
        stripped = line.strip(" \t\n\x0b\f\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in stripped)

    counts = collections.Counter()
    for t in texts:
        counts.update({key(x) for x in (t or "").split("\n")})
    result = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or counts[key(x)] < least]
        result.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return result


@pytest.mark.parametrize("fanout", [2, 4])
def test_line_dedup(spark, docs, none, fanout):
    done = line_dedup.dedup_lines(docs, min_docs=3, fanout=fanout).select("doc_id", "text", "lines", "dropped", "kept").collect()
    want = expected_lines([t for _, t, _ in TEXTS], 3)
    by_text = {(i, t): w for (i, t, _), w in zip(TEXTS, want)}
    assert len(done) == len(TEXTS)
    for r in done:
        assert (r.lines, r.dropped, r.kept) == by_text[(r.doc_id, r.text)]
    stage = line_dedup.without_repeated_lines(docs, min_docs=3)
    same_columns(docs, stage)
    rows = stage.collect()
    assert all(r.n_chars == len(r.text or "") for r in rows) and {r.text for r in rows if r.doc_id == 11} == {"own line"}
    assert line_dedup.without_repeated_lines(none).count() == 0


def test_line_runs_compact_and_skip_settled_keys(spark, tmp_path):
    runs = line_dedup.LineRuns(spark, str(tmp_path), min_docs=5, fanout=2)
    total = collections.Counter()
    for batch in ({1: 5, 2: 1}, {1: 9, 2: 2}, {2: 2, 3: 1}, {3: 4, 1: 1}):
        runs.add(spark.createDataFrame(list(batch.items()), "h bigint, n bigint"))
        for k, n in batch.items():
            if total[k] < 5:
                total[k] += n
    assert [len(x) for x in runs.levels] == [0, 0, 1]
    assert {r.h: r.n for r in runs.counts().collect()} == total
    assert {r.h for r in runs.settled().collect()} == {1, 2, 3}


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def test_near_duplicates(spark, docs, none):
    rows = near_dup.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert len(rows) == len(TEXTS)
    by_id = collections.defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append(r)
    assert {r.component_id for i in (6, 7, 8) for r in by_id[i]} == {6} and len(by_id[6]) == 2
    assert by_id[9][0].component_id == 9 and {r.component_id for r in by_id[None]} == {9, None}
    assert by_id[1][0].component_id == 1 and by_id[1][0].kept and by_id[1][0].n_shingles == 0
    for i, t, _ in TEXTS:
        assert {r.n_shingles for r in by_id[i]} >= {len(shingles(t))} or i is None
    kept = near_dup.without_near_duplicates(docs)
    same_columns(docs, kept)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "6", "9", "10", "11", "None"])
    assert near_dup.near_duplicates(none).count() == 0 and near_dup.without_near_duplicates(none).count() == 0


def test_near_duplicates_where_the_first_node_is_not_close_to_all(spark, monkeypatch):
    """A chain of drifting copies, and two crowds that only their edges join, against all pairs."""
    import random

    monkeypatch.setattr(answers, "ROUNDS", 1)
    random.seed(4)
    base, texts = [f"w{i}" for i in range(200)], []
    for step in range(40):
        texts.append(" ".join(base))
        for k in range(3):
            copy = list(base)
            copy[random.randrange(len(copy))] = f"x{step}_{k}"
            texts.append(" ".join(copy))
        base[step * 5 : step * 5 + 2] = [f"y{step}", f"z{step}"]
    rows = list(enumerate(texts, 100))
    random.shuffle(rows)
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            both = len(sets[i] & sets[j])
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    assert got == {i: find(i) for i in ids} and len(set(got.values())) < len(ids) / 3


def test_decontaminate(spark, docs, none, items):
    rows = decontaminate.containments(docs, items).select("doc_id", "item_id", "n_shingles", "n_shared").collect()
    want = set()
    for d, t, _ in TEXTS:
        for i, x in ((1, A), (2, None), (3, ""), (4, "word"), (None, B.replace("\n", " ")), (5, "line 7 of a very long text line 8 of")):
            mine = shingles(x)
            if mine and 10 * len(mine & shingles(t)) >= 8 * len(mine):
                want.add((d, i, len(mine), len(mine & shingles(t))))
    assert {tuple(r) for r in rows} == want and len(rows) == len(want) and {w[0] for w in want} == {4, 5, 6, 7, 8, 9, None}
    kept = decontaminate.without_leaks(docs, items)
    same_columns(docs, kept)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "10", "11", "None"])
    assert decontaminate.containments(docs, items.limit(0)).count() == 0 and decontaminate.containments(none, items).count() == 0


def test_kd_shards(spark, docs, none):
    rows = kd_shards.kd_shards(docs, 3).collect()
    assert sorted(r["size"] for r in rows) == sorted(len((t or "").encode()) + 8 for _, t, _ in TEXTS)
    assert sorted(r.text_crc32 for r in rows) == sorted(zlib.crc32((t or "").encode()) for _, t, _ in TEXTS)
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= {0, 1, 2}
    assert kd_shards.kd_shards(none, 24).count() == 0
    assert {r.shard for r in kd_shards.kd_shards(docs, target_bytes=1 << 40).collect()} == {0}


def test_kd_shards_split_one_group_of_copies(spark):
    rows = [(i, "same text", "en") for i in range(400)] + [(1000 + i, f"text number {i}", "de") for i in range(200)] + [(7, "same text", "en")] * 5
    found = kd_shards.kd_shards(table(spark, rows), 24).collect()
    sizes = collections.Counter()
    for r in found:
        sizes[r.shard] += r["size"]
    assert len(sizes) == 24 and max(sizes.values()) - min(sizes.values()) <= 4 * max(r["size"] for r in found)


def test_token_counts(spark, docs, none, tmp_path):
    one = {"bpe": token_counts.TOKENIZERS["byte_bpe_50k"]}
    ledger = token_counts.TokenLedger(spark, str(tmp_path), one)
    assert ledger.totals() is None
    counter = token_counts.WordCounter(token_counts.read_vocabularies(one)["bpe"])

    def want(rows):
        sums = collections.Counter()
        for _, t, la in rows:
            sums[(la, "docs")] += 1
            sums[(la, "tokens")] += len(counter.encoding.encode_ordinary(t or ""))
            sums[(la, "bytes")] += len((t or "").encode())
        return {k: v for k, v in sums.items() if v}

    def got():
        return {(r.lang, k): r[k] for r in ledger.totals().collect() for k in ("docs", "tokens", "bytes") if r[k]}

    ledger.insert("a", docs)
    assert got() == want(TEXTS)
    ledger.insert("a", docs)
    assert got() == want(TEXTS)
    ledger.delete("b", spark.createDataFrame([(6,), (404,), (None,)], "doc_id bigint"))
    rest = [r for r in TEXTS if r[0] != 6]
    assert got() == want(rest)
    ledger.delete("b", spark.createDataFrame([(6,), (404,), (None,)], "doc_id bigint"))
    assert got() == want(rest)
    new = [(4, "two words", "es"), (50, "a new one", "en")]
    for _ in range(2):
        ledger.revise("c", table(spark, new))
        assert got() == want([r for r in rest if r[0] != 4] + new)
    ledger.insert("d", none)
    assert got() == want([r for r in rest if r[0] != 4] + new)


def test_ledger_replays_of_earlier_batches(spark, tmp_path):
    one = {"bpe": token_counts.TOKENIZERS["byte_bpe_50k"]}
    length = token_counts.WordCounter(token_counts.read_vocabularies(one)["bpe"]).count

    def doc(text):
        return table(spark, [(1, text, "en")])

    def tokens(path):
        return sum(r.tokens for r in token_counts.TokenLedger(spark, path, one).totals().collect())

    path = str(tmp_path / "a")
    first, second, third = "five words are in here", "now seven words are all in here", "and then nine words are all put in here"
    steps = [("insert", "a", first), ("revise", "b", second), ("revise", "c", third)]
    for name, batch, text in steps:
        getattr(token_counts.TokenLedger(spark, path, one), name)(batch, doc(text))
        assert tokens(path) == length(text)
    for name, batch, text in steps[::-1] + steps:
        getattr(token_counts.TokenLedger(spark, path, one), name)(batch, doc(text))
        assert tokens(path) == length(third)
    path = str(tmp_path / "b")
    ledger = token_counts.TokenLedger(spark, path, one)
    ledger.insert("a", doc(first))
    ledger.delete("b", doc(first))
    assert ledger.totals().count() == 0
    ledger.insert("c", doc("two words"))
    for _ in range(2):
        ledger.delete("b", doc(first))
        assert tokens(path) == length("two words")


def test_top_k_of_odd_vectors(spark):
    big, inf, nan = 1 << 60, float("inf"), float("nan")
    rows = [
        (None, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (big + 1, [1.0, 2.0], 1), (big + 3, [1.0, 2.0], 1), (big + 3, [1.0, 2.0], 2),
        (50, [1.0, 2.0], 1), (50, [1.0, 2.0], 1), (100, [-1.0], 1), (150, [], 1), (200, None, 1), (250, [1.0, None], 1), (300, [nan, 1.0], 1),
        (350, [inf, 1.0], 1), (7, [0.5, 0.001], 1), ((1 << 63) - 1, [1.0, 2.0], 1),
    ]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score int")
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for own, q in sorted({(i, tuple(v)) for i, v in usable if i is not None and i % 50 == 0}):
        scored = [(-sum(a * b for a, b in zip(q, v)), i is None, i or 0) for i, v in usable if i != own]
        want += [(own, rank, None if none else i, -score) for rank, (score, none, i) in enumerate(sorted(scored)[:5], 1)]
    got = maxscore.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == sorted(want, key=lambda r: r[:2])
    assert maxscore.top_k(vectors.limit(0), vectors, 5).count() == maxscore.top_k(vectors, vectors.limit(0), 5).count() == 0


def test_grams_do_not_depend_on_the_texts_beside(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(" .abcé\n") for _ in range(rng.randrange(9))) for _ in range(300)] + [" xyz", "", " ", ". a"]
    for classes in (chargrams.letter_classes(), chargrams.print_classes()):
        alone = [chargrams.grams([t], [0], classes, 4, True)[0].tolist() for t in texts]
        for _ in range(3):
            order = rng.sample(range(len(texts)), len(texts))
            found, sizes = chargrams.grams([texts[i] for i in order], [0] * len(texts), classes, 4, True)
            parts = np.split(found, np.cumsum(sizes)[:-1])
            assert [p.tolist() for p in parts] == [alone[i] for i in order]


@pytest.mark.parametrize("text", ["a  b", " a", "a ", "a\n b", "it's 12 o'clock,\tnow… x", "é\r\n\r\nx y", "a 　b"])
def test_word_counter_agrees_with_the_tokenizer(text):
    counter = token_counts.WordCounter(token_counts.read_vocabularies({"t": token_counts.TOKENIZERS["byte_bpe_50k"]})["t"])
    assert counter.count(text) == len(counter.encoding.encode_ordinary(text))


def test_word_counter_encodes_new_words_together():
    counter = token_counts.WordCounter(*[v for _, v in sorted(token_counts.read_vocabularies(token_counts.TOKENIZERS).items())])
    rng = random.Random(1)
    texts = ["".join(rng.choice("   ab's1\n\u3000\x1c\x85é!Z中") for _ in range(rng.randrange(15))) for _ in range(3000)] + [None, "", "one", "one " * 9 + "two"]
    assert counter.counts(texts) == [[len(e.encode_ordinary(t or "")) for e in counter.encodings] for t in texts]

    class Counted:
        def __init__(self, encoding):
            self.encoding, self.calls = encoding, 0

        def encode_ordinary(self, text):
            self.calls += 1
            return self.encoding.encode_ordinary(text)

    counter.encodings = [Counted(e) for e in counter.encodings]
    new = [" ".join(f"w{i}x{j}" for j in range(500)) for i in range(4)]
    assert counter.counts(new) == [[len(e.encoding.encode_ordinary(t)) for e in counter.encodings] for t in new]
    assert all(e.calls <= len(new) + 1 for e in counter.encodings)


def test_segmentations(spark, docs, none):
    full = {(r.doc_id, r.decoded): r for r in sentencepiece_lattice.segmentations(docs, k=3).collect()}
    assert {k for k in full} == {(i, t or "") for i, t, _ in TEXTS}
    encoder = sentencepiece_lattice.Encoder(sentencepiece_lattice.read_model())
    for (_, text), r in full.items():
        assert r.ids == encoder.processor.encode(text)
        assert len({tuple(s["ids"]) for s in r.samples}) == len(r.samples)
        assert all(encoder.processor.decode(s["ids"]) == text and s.log_inclusion <= 0 for s in r.samples)
        assert len(r.samples) == 3 or len(text) < 12
    digest = sentencepiece_lattice.segmentations(docs, digest=True)
    assert [c for c in docs.columns if c != "text"] == digest.columns[: len(docs.columns) - 1]
    assert [r.round_trip for r in digest.collect()].count(False) == 0
    assert sentencepiece_lattice.segmentations(none).count() == 0


def test_digest_stands_beside_the_segmentations(spark, docs):
    whole = sentencepiece_lattice.segmentations(docs, digest=True).select("doc_id", "decoded", "ids", "ids_crc32", "samples", "n_tokens")
    plain = {(r.doc_id, r.decoded): r for r in sentencepiece_lattice.segmentations(docs).collect()}
    for r in whole.collect():
        other = plain[(r.doc_id, r.decoded)]
        assert r.ids == other.ids and [s.ids for s in r.samples] == [s.ids for s in other.samples] and r.n_tokens == len(r.ids)
        for ids, crc in [(r.ids, r.ids_crc32), *[(s.ids, s.ids_crc32) for s in r.samples]]:
            assert crc == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


@pytest.mark.parametrize("text", ["the", "a the", "x  y", "r\u1234z"])
def test_samples_follow_the_whole_lattice(text):
    import math

    encoder = sentencepiece_lattice.Encoder(sentencepiece_lattice.read_model())
    sp = encoder.processor
    lattice = sentencepiece_lattice.PieceLattice(sp, 0.5)
    pieces = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    spelt = "\u2581" + text.replace(" ", "\u2581")

    def ways(at):
        if at == len(spelt):
            yield ()
        heads = [(spelt[at:end], (pieces[spelt[at:end]],)) for end in range(at + 1, len(spelt) + 1) if spelt[at:end] in pieces]
        if at < len(spelt) and spelt[at] not in pieces:
            heads.append((spelt[at], tuple(sp.piece_to_id(f"<0x{b:02X}>") for b in spelt[at].encode())))
        for head, ids in heads:
            for rest in ways(at + len(head)):
                yield ids + rest

    weight = {w: math.prod((1 + i) ** -0.5 for i in w) for w in ways(0)}
    share = {w: v / sum(weight.values()) for w, v in weight.items()}
    words, runs = lattice.chains([text])[0], 4000
    first, estimate = collections.Counter(), collections.Counter()
    for seed in range(runs):
        samples, scores = lattice.sample(words, 2, seed)
        assert len({tuple(s) for s in samples}) == len(samples) == min(2, len(share))
        first[tuple(samples[0].tolist())] += 1
        for s, score in zip(samples, scores):
            estimate[tuple(s.tolist())] += share[tuple(s.tolist())] / math.exp(score) / runs
    assert all(abs(first[w] / runs - p) < 0.03 and abs(estimate[w] - p) < 0.03 for w, p in share.items())
    every, scores = lattice.sample(words, len(share) + 1, 1)
    assert {tuple(s.tolist()) for s in every} == set(share) and set(scores) == {0.0}


def test_toxicity(spark, docs, none):
    bad, good = [], []
    for i in range(60):
        bad.append((1000 + i, f"you awful{i % 3} rotten{i % 4} thing number n{i} of the day", "en"))
        good.append((2000 + i, f"a calm day number n{i} of the year with thing t{i % 5}", "en"))
    everything = table(spark, TEXTS + bad + good)
    labels = spark.createDataFrame(
        [(i, 1, "x") for i, _, _ in bad] + [(i, 0, "x") for i, _, _ in good] + [(None, 1, "x"), (6, None, "x"), (9, 7, "x"), (404, 1, "x"), (6, 1, "x"), (6, 0, "x")],
        "doc_id bigint, toxic int, text string",
    )
    model = toxicity.fit(everything, labels)
    scored = {(r.doc_id, r.text): r for r in toxicity.score_toxicity(everything, model).select("doc_id", "text", "_toxicity.*").collect()}
    assert all(scored[(i, t)].predicted == 1 and scored[(i, t)].evidence for i, t, _ in bad)
    assert all(scored[(i, t)].predicted == 0 for i, t, _ in good) and scored[(1, None)].predicted == scored[(2, "")].predicted == 0
    assert all(0 <= r.score <= 1 for r in scored.values())
    blank = toxicity.fit(everything, labels.limit(0))
    assert {r[0] for r in toxicity.score_toxicity(docs, blank).select("_toxicity.score").collect()} == {0.0}
    assert toxicity.score_toxicity(none, model).count() == 0 and toxicity.fit(none, labels)["ids"] == []


def test_block_max_index_is_exact():
    import numpy as np

    random = np.random.default_rng(3)
    dense = np.where(random.random((500, 40)) < 0.1, random.random((500, 40)), 0).astype(np.float32)
    dense[7] = dense[8]
    index = toxicity.BlockMaxIndex([(np.flatnonzero(v), v[v > 0]) for v in dense], np.zeros(500, int), 40)
    for query in dense[:60]:
        at = np.flatnonzero(query)
        near, cosine = index.nearest(at, query[at], 9)
        full = dense[:, at] @ query[at]
        order = np.lexsort((np.arange(500), -full))
        want = [i for i in order[:9] if full[i] > 0]
        assert np.allclose(cosine, full[want], atol=1e-6) and len(near) == len(want)


def test_quality_checkpoints_no_gram_tables(spark, docs, monkeypatch):
    """Checkpoints are not compressed, so n-grams are written as Parquet."""
    held, whole = [], quality_lm.checkpointed
    monkeypatch.setattr(quality_lm, "checkpointed", lambda df: held.append(df.columns) or whole(df))
    trusted = spark.createDataFrame([(5,), (6,), (9,)], "doc_id bigint")
    assert quality_lm.judge_quality(docs, trusted).count() == docs.count()
    assert held and not any("gram" in columns for columns in held)


def test_quality(spark, docs, none):
    trusted = spark.createDataFrame([(5,), (6,), (9,), (None,), (404,)], "doc_id bigint")
    rows = quality_lm.judge_quality(docs, trusted).collect()
    by_join = quality_lm.judge_quality(docs, trusted, broadcast_rows=0).collect()
    key = lambda r: (str(r.doc_id), str(r.perplexity), r.lang)
    assert len(rows) == len(TEXTS)
    for a, b in zip(sorted(rows, key=key), sorted(by_join, key=key)):
        assert (a.doc_id, a.lang, a.keep) == (b.doc_id, b.lang, b.keep)
        assert a.perplexity is None and b.perplexity is None or abs(a.perplexity - b.perplexity) < 1e-4
    by_id = {(r.doc_id, r.lang): r for r in rows}
    assert by_id[(1, "en")].perplexity is None and not by_id[(2, "en")].keep and by_id[(10, "de")].threshold is None and by_id[(10, "de")].keep
    assert by_id[(6, "en")].keep and by_id[(5, "en")].keep
    assert quality_lm.judge_quality(none, trusted).count() == 0


def test_quality_of_very_short_texts_and_blank_languages(spark):
    short = [(i, "abcde"[:i], f"l{i}") for i in range(6)] + [(10 + i, "abcde"[:i], "en") for i in range(6)]
    rows = [*short, (20, " \t\n ", "blank"), (21, None, "blank"), (22, "Re.", "fr")]
    trusted = spark.createDataFrame([(3,), (14,), (22,)], "doc_id bigint")
    found = [
        {r.doc_id: r for r in quality_lm.judge_quality(table(spark, rows), trusted, broadcast_rows=n).collect()} for n in (quality_lm.BROADCAST_ROWS, 0)
    ]
    assert set(found[0]) == set(found[1]) == {r[0] for r in rows}
    for i, text, _ in rows:
        a, b = found[0][i].perplexity, found[1][i].perplexity
        assert a is b is None if not (text or "").strip() else abs(a - b) < 1e-4


def test_quality_keeps_held_out_good_documents_where_little_is_trusted(spark):
    import random

    rng = random.Random(5)
    words = ["".join(rng.choice("bdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(2000)]
    weight = [1 / (i + 1) ** 0.8 for i in range(len(words))]
    text = lambda: " ".join(rng.choices(words, weight, k=80))
    noise = lambda: "".join(rng.choice("qxzjkvwyQXZ0123456789#$%&") for _ in range(400))
    good = [(i, text(), "es") for i in range(111)]
    bad = [(1000 + i, noise(), "es") for i in range(40)]
    trusted = spark.createDataFrame([(i,) for i in range(11)], "doc_id bigint")
    kept = {r.doc_id: r.keep for r in quality_lm.judge_quality(table(spark, good + bad), trusted).collect()}
    assert sum(kept[i] for i in range(11, 111)) >= 90 and not any(kept[r[0]] for r in bad)


def test_probabilities_of_a_context_add_up(spark):
    from pyspark.sql import functions as F

    text = "the cat sat on the mat and the dog sat on the log " * 3
    seen = quality_lm.count_grams(spark.createDataFrame([("x", text)], "lang string, text string"), "lang", quality_lm.ORDER, quality_lm.print_classes)
    context = seen.orderBy(F.desc("n"), "gram").first()["gram"] >> 7
    every = spark.range(128).select(F.lit("x").alias("lang"), (F.lit(context << 7) + F.col("id")).alias("gram"))
    table_ = seen.join(every, ["lang", "gram"], "outer").select("lang", "gram", F.coalesce("n", F.lit(0)).alias("trusted"))
    logs = quality_lm.log_probabilities(table_).filter(F.shiftright("gram", 7) == context)
    assert abs(logs.agg(F.sum(F.exp("log_p"))).first()[0] - 1) < 1e-9

