"""Whitening, fill-in-the-middle and the set join on odd rows and against brute force."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonoloom.llm import answers, fill_in_middle, queries, set_relations, whitening
from sonoloom.operators.components import components

TOKENS = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def cut(doc_id, text):
    """(n, form, prefix, middle, suffix) by the contract, in a loop."""
    text = text or ""
    units = TOKENS.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    plain = not text or any(m in text for m in fill_in_middle.MARKERS) or h[2] % 100 >= 50
    form = "plain" if plain else "spm" if h[3] % 100 < 80 else "psm"
    return len(units), form, "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])


def output(form, text, p, m, s):
    return {"plain": text or "", "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]


def test_fill_in_middle(spark):
    rng = random.Random(5)
    odd = ["a", " ", "\n", "\x0b", "\x0c", "\r", "$1", "\\", "é", "𝔘", "　", "<P", "<S>", "{2}", "\x00", "word "]
    rows = [(i, "".join(rng.choices(odd, k=rng.randrange(30))), "x") for i in range(300)]
    rows += [(None, "two words", "x"), (None, None, None), (1000, None, "x"), (1001, "", "x"), (1002, " " * 50_000, "x"), (1003, "w " * 200_000, "x"), (2, "b c d", "x"), (2, "b c d", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _n string").withColumn("_row", F.lit(1)).withColumn("_fim", F.lit(0))
    done = fill_in_middle.fill_in_middle(docs)
    assert done.columns == ["doc_id", "text", "_n", "_row", "_fim"]
    got = done.select("doc_id", "text", "_fim.*", fill_in_middle.restored(F.col("_fim.output"), F.col("_fim.form")).alias("again")).collect()
    assert len(got) == len(rows) and {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        n, form, p, m, s = cut(r.doc_id, r.text)
        assert (r.n, r.form, r.output, r.again) == (n, form, output(form, r.text, p, m, s), r.text or "")
        assert (r.prefix_chars, r.middle_chars) == ((None, None) if form == "plain" else (len(p), len(m)))
    assert fill_in_middle.fill_in_middle(docs.limit(0)).count() == 0


def expected_white(vectors, k):
    """vec_id and the whitened coordinates, deviation and explained shares by numpy's own eigenvectors."""
    x = np.floor(256 * np.array([v for _, v in vectors])).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    z = fit - sums / n
    values, axes = np.linalg.eigh(z.T @ z / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return (x - sums / n) @ axes / np.sqrt(values), ((n * x - sums) ** 2).sum(axis=1), values / np.trace(z.T @ z / n), n


@pytest.mark.parametrize("shift", [0, 4_000])
def test_whitening_against_numpy(spark, shift):
    rng = np.random.default_rng(3)
    data = rng.standard_normal((300, 7)) * [5, 3, 2, 1, 0.5, 0.2, 0.1] @ np.linalg.qr(rng.standard_normal((7, 7)))[0] + shift
    vectors = [(i, v.tolist()) for i, v in enumerate(data)] + [(1000, data[0].tolist()), (None, data[1].tolist()), (1000, data[0].tolist())]
    bad = [(2000, None), (2001, [1.0, None] + [0.0] * 5), (2002, [float("nan")] + [0.0] * 6), (2003, [float("-inf")] * 7), (2004, []), (2005, [1.0, 2.0])]
    rows = spark.createDataFrame([(i, v, 1) for i, v in vectors + bad], "vec_id bigint, embedding array<double>, n int")
    done = whitening.whiten(rows, 4)
    assert done.columns == ["vec_id", "embedding", "n", "_white"]
    got = done.select("vec_id", "embedding", "_white.*").collect()
    white, deviation, explained, n = expected_white(vectors, 4)
    want = {tuple(v): (w, d) for (_, v), w, d in zip(vectors, white, deviation)}
    signs = np.sign((np.array([r.whitened for r in got]) * np.array([want[tuple(r.embedding)][0] for r in got])).sum(axis=0))
    assert len(got) == len(vectors) and {r.n for r in got} == {n} and got[0].identity_error < 1e-9
    for r in got:
        assert np.allclose(np.array(r.whitened) * signs, want[tuple(r.embedding)][0], atol=1e-8) and r.deviation == want[tuple(r.embedding)][1]
        assert np.allclose(r.explained, explained, rtol=1e-10)


def test_whitening_without_variance_and_beyond_64_bits(spark):
    schema = "vec_id bigint, embedding array<double>"
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).select("vec_id", "_white.*").collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, [], [], None)] * 2
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(3)], schema)).select("_white.*").collect()
    assert all(len(r.whitened) == 1 and abs(r.explained[0] - 1) < 1e-12 for r in line)
    large = [(0, [0.0, 0.0]), (1, [2.0**30, 0.0]), (2, [2.0**22, 2.0**5])]
    got = {r.vec_id: r for r in whitening.whiten(spark.createDataFrame(large, schema)).select("vec_id", "_white.*").collect()}
    x = [[int(256 * c) for c in v] for _, v in large]
    sums = [sum(c) for c in zip(*x)]
    exact = [sum((3 * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    assert [got[i].deviation for i in range(3)] == [d if d < 1 << 63 else None for d in exact] and None in [got[i].deviation for i in range(3)]
    none = whitening.whiten(spark.createDataFrame([(1, None), (2, [])], schema))
    assert none.count() == 0 and none.schema["_white"].dataType.simpleString().startswith("struct<n:bigint,deviation:bigint,whitened:array<double>")


@pytest.mark.parametrize(
    "v", [np.diag([3.0, 3, 1, 1]), np.eye(5), np.ones((4, 4)), np.diag([1e8, 1e-8, 2e-8]), np.diag([5, 5 - 1e-9, 4, 4]), np.array([[2.0]])]
)
def test_eigenpairs_of_awkward_matrices(v):
    values, axes = whitening.eigenpairs(v, len(v))
    assert np.allclose(values, np.linalg.eigvalsh(v)[::-1], atol=1e-13 * np.linalg.norm(v))
    assert np.allclose(axes @ axes.T, np.eye(len(v)), atol=1e-13)
    assert np.linalg.norm(v @ axes.T - axes.T * values) <= 1e-12 * np.linalg.norm(v)


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 3]) for i in range(max(len(w) - 2, 1))) if w else frozenset()


def brute_groups(rows, percent):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((repr(d), len(s), repr(least.get(find(i)) if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("seed", range(3))
def test_set_join_finds_every_group(spark, seed, monkeypatch):
    """Chains and crowds of near copies around the bound, boilerplate, short texts: with lists short and long."""
    monkeypatch.setattr(set_relations, "COMMON", [4, 32, 2][seed])
    monkeypatch.setattr(answers, "ROUNDS", [2, 1, 1][seed])
    rng = random.Random(seed)
    rows = []
    for crowd in range(4):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([40, 120, 300]))]
        for _ in range(40):
            rows.append(edited(rng, base, rng.choice([0, 1, 2, 3, len(base) // 25, len(base) // 12])))
    step = [f"c{i}" for i in range(150)]
    for _ in range(25):
        step = edited(rng, step, 2).split()
        rows.append(" ".join(step))
    phrase = " ".join(f"p{i}" for i in range(50))
    rows += [f"{phrase} " + " ".join(f"u{rng.randrange(50)}" for _ in range(rng.randrange(12))) for _ in range(40)]
    rows += [" ".join(rng.choices("abc", k=rng.randrange(6))) for _ in range(40)] + [" ".join(f"k{i}" for i in range(n)) for n in range(2, 30)]
    rows += ["A b\tC", "a B c", "x" * 5, None, "", " \n"]
    rng.shuffle(rows)
    rows = [(i if i % 9 else None, t) for i, t in enumerate(rows)] + [(3, rows[3]), (3, "another text of some words")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, component int, id string")
    got = set_relations.jaccard_groups(docs, 90).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in got) == brute_groups(rows, 90)


def test_set_join_of_long_and_missing_texts(spark):
    long = " ".join(f"word{i}" for i in range(60_000))
    rows = [(1, long), (2, long + " tail"), (3, long.upper()), (4, None)]
    schema = "doc_id bigint, text string"
    got = set_relations.jaccard_groups(spark.createDataFrame(rows, schema), 90).collect()
    assert sorted(map(tuple, got)) == [(1, 59_998, 1), (2, 59_999, 1), (3, 59_998, 1), (4, 0, 4)]
    assert set_relations.jaccard_groups(spark.createDataFrame([], schema), 90).count() == 0
    assert sorted(map(tuple, set_relations.jaccard_groups(spark.createDataFrame([(5, None), (None, "")], schema), 90).collect()), key=repr) == [(5, 0, 5), (None, 0, None)]


def test_op11(spark, tiny):
    rows = queries.op11_whitening(spark, tiny).collect()
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{tiny}/embeddings.parquet").select("vec_id", "embedding").collect()]
    white, deviation, explained, n = expected_white(vectors, 4)
    assert len(rows) == 4 * len(vectors)
    at = {v: i for i, (v, _) in enumerate(vectors)}
    signs = np.zeros(4)
    for r in rows:
        signs[r.component - 1] += r.whitened * white[at[r.vec_id], r.component - 1]
    for r in rows:
        i, c = at[r.vec_id], r.component - 1
        assert math.isclose(r.whitened * np.sign(signs[c]), white[i, c], abs_tol=1e-9) and math.isclose(r.explained, explained[c], rel_tol=1e-9)
        assert (r.n, r.deviation) == (n, deviation[i]) and r.identity_error < 1e-9


def test_near_copies_apart_from_the_pivot_are_linked_by_one_pair_each(spark):
    """A family whose sets are linked to each other but not to their list's pivot is not compared all with all."""
    base, family = [f"w{i}" for i in range(100)], 60
    texts = [base] + [[*(f"v{j}" for j in range(8)), *base[8:-1], f"own{i}"] for i in range(family)]
    docs = spark.createDataFrame([(i, " ".join(words)) for i, words in enumerate(texts)], "doc_id bigint, text string")
    nodes = docs.select(F.col("doc_id").alias("id"), F.lit(98).cast("bigint").alias("n"), F.xxhash64("text").alias("text_hash"))
    place = F.when(F.col("id") == 0, 0).otherwise(1).alias("pos")
    entries = nodes.select(F.lit(1).cast("bigint").alias("token"), F.lit(0).alias("block"), F.lit(True).alias("own"), "id", "n", place)
    asked = []

    def maybe(pairs):
        asked.append(pairs.count())
        return pairs

    found = components(answers.links(entries, docs, nodes, 3, 90, maybe)).collect()
    assert {(r.node, r.component) for r in found} == {(i, 1) for i in range(1, family + 1)}
    assert sum(asked) <= 4 * family
