"""Links between sets that share a list, by the answers of one pivot per list.

The pivot of a list is compared with its other entries: the sets within its reach, and how they differ from it, are its answers.  Linked
sets are contracted.  Two sets among one pivot's answers have the symmetric difference of their differences D to it, so
they are linked iff |D_x| + |D_y| - 2 |D_x & D_y| is small enough: either the sizes alone decide, then one link to the set with the
most slack stands for all, or they share some of their differences.  These are listed by position, rare ones first, in
blocks by slack, and a block without room for a link is skipped as a whole.  The set with the most slack of those that share a difference
is compared with the others first and what it links is contracted.  So groups of near copies meet only where they share edits
and are not linked yet.  By the triangle inequality a set beyond a pivot's reach is linked only to sets less than one radius inside it: lists go on
with these and a new pivot for a few turns, and what is left then is compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonoloom.llm.common import keep_possible
from sonoloom.operators.components import components
from sonoloom.session import checkpointed, work_path

# (largest pivot, reach in hundredths): wide where sketches of unrelated sets still tell them apart
REACHES = ((500, 40), (2_500, 20), (1 << 40, 10))
ROUNDS = 2
LIST = ["token", "block"]
CACHED_BYTES = 50_000_000


class WordHashes(dict):
    """64-bit hashes of words, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self.held = getattr(self, "held", 0) + len(word) + 100
        if self.held > CACHED_BYTES:
            self.clear()
            self.held = 0
        self[word] = value
        return value


def shingle_set(text: str | None, hashes: WordHashes, size: int) -> np.ndarray:
    """Sorted different hashes of the text's word shingles; fewer words than ``size`` are one shingle, no words none."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    take = min(size, len(w))
    rolled = np.full(len(w) - take + 1, take, np.uint64)
    for k in range(take):
        rolled = (rolled ^ w[k : len(w) - take + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(29)
    return np.unique(rolled)


def written(df: DataFrame, name: str) -> DataFrame:
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _near(pivot_size: Column, percent: int, reaches: tuple) -> Column:
    """Least similarity, in hundredths, of a pivot's answers."""
    reach = F.lit(reaches[-1][1])
    for largest, wider in reaches[-2::-1]:
        reach = F.when(pivot_size <= largest, F.lit(wider)).otherwise(reach)
    return F.greatest(F.lit(percent) - reach, F.lit(1))


def texts_of(docs: DataFrame, hashes: DataFrame) -> DataFrame:
    """(text_hash, text) of the wanted hashes, one row each."""
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text")
    return keep_possible(texts, "text_hash", hashes).join(hashes, "text_hash", "left_semi").groupBy("text_hash").agg(F.first("text").alias("text"))


def room(n1: Column, i1: Column, n2: Column, i2: Column, percent: int | Column) -> Column:
    """Whether two sets that share a shingle at these positions may have a Jaccard similarity of ``percent``."""
    need = percent * (n1 + n2) / (percent + 100.0) - 1e-9
    return F.least(i1, i2) + 1 + F.least(n1 - i1, n2 - i2) - 1 >= need


def _compared(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """(a, b, n_a, n_b, shared, gone, new) of the pairs with similarity of at least ``least``: ``gone`` is a - b, ``new`` is b - a."""
    hashes = nodes.select("id", "text_hash")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(hashes, "id")
    texts = written(wanted.join(texts_of(docs, wanted.select("text_hash").distinct()), "text_hash").select("id", "text"), "texts")
    sided = pairs.select("a", "b", "least")
    for side in ("b", "a"):
        sided = sided.join(texts.select(F.col("id").alias(side), F.col("text").alias(f"text_{side}")), side)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, last, first = WordHashes(), None, None
        for rows in batches:
            found = []
            for a, b, least, left, right in zip(*(rows[c] for c in ("a", "b", "least", "text_a", "text_b"))):
                if a != last:
                    last, first = a, shingle_set(left, hashes, size)
                second = shingle_set(right, hashes, size)
                gone, new = np.setdiff1d(first, second, True), np.setdiff1d(second, first, True)
                shared = len(first) - len(gone)
                if 100 * shared >= least * (shared + len(gone) + len(new)):
                    found.append((a, b, len(first), len(second), shared, gone.view(np.int64), new.view(np.int64)))
            yield pd.DataFrame(found, columns=["a", "b", "n_a", "n_b", "shared", "gone", "new"])

    schema = "a bigint, b bigint, n_a bigint, n_b bigint, shared bigint, gone array<bigint>, new array<bigint>"
    return sided.select("a", "b", "least", "text_a", "text_b").mapInPandas(compare, schema)


def _is_link(shared: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    return 100 * shared >= percent * (n_a + n_b - shared)


def _derived(pairs: DataFrame, answers: DataFrame, percent: int) -> DataFrame:
    """The linked ones among pairs (p, a, b, ...) by their differences to the pivot p both are highly similar to."""
    parts, columns = answers.select(F.col("a").alias("p"), "n_a", "n_b", "b", "gone", "new"), pairs.columns
    left = parts.select("p", F.col("n_a").alias("n_p"), F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("gone").alias("gone_a"), F.col("new").alias("new_a"))
    right = parts.select("p", "b", "n_b", F.col("gone").alias("gone_b"), F.col("new").alias("new_b"))

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            good = []
            for n, n_a, n_b, gone_a, gone_b, new_a, new_b in zip(*(rows[c] for c in ("n_p", "n_a", "n_b", "gone_a", "gone_b", "new_a", "new_b"))):
                shared = n - len(np.union1d(gone_a, gone_b)) + len(np.intersect1d(new_a, new_b, True))
                good.append(100 * shared >= percent * (n_a + n_b - shared))
            yield rows.loc[np.array(good, bool), columns]

    return pairs.join(left, ["p", "a"]).join(right, ["p", "b"]).mapInPandas(answer, pairs.schema)


def links(
    entries: DataFrame,
    docs: DataFrame,
    nodes: DataFrame,
    size: int,
    percent: int,
    maybe: Callable[[DataFrame], DataFrame],
    reaches: tuple = REACHES,
) -> DataFrame:
    """Links (a, b) between the ids of nodes that share a list: enough for the components of all such links.

    ``entries`` is (token, block, own, id, n, pos), ``nodes`` (id, n, text_hash); ``maybe`` keeps the pairs (a, b, least) that may have a
    similarity of ``least`` hundredths.
    """
    lists = _with_pivots(entries.withColumn("near", F.lit(0)), F.col("own"), "lists")
    answers, named, near = None, None, _near(F.col("p.n"), percent, reaches)
    for turn in range(ROUNDS):
        others = lists.filter("id <> p.id")
        sized = 100 * F.least("n", "p.n") >= near * F.greatest("n", "p.n")
        stars = others.filter(sized & room(F.col("n"), F.col("pos"), F.col("p.n"), F.col("p.pos"), near))
        pairs = stars.select(F.col("p.id").alias("a"), F.col("id").alias("b"), near.cast("bigint").alias("least")).distinct()
        if answers is not None:
            pairs = pairs.join(answers.select("a", "b"), ["a", "b"], "left_anti")
        told = written(_compared(docs, nodes, checkpointed(maybe(pairs)), size), "answers")
        answers = told if answers is None else answers.unionByName(told)
        direct = answers.filter(_is_link(F.col("shared"), F.col("n_a"), F.col("n_b"), percent)).select("a", "b")
        named = checkpointed(components(direct)).select(F.col("node").alias("id"), "component")
        lists = _beyond(lists, answers, named, turn, percent, reaches)
    sure, derived = _between_answers(answers, named, percent, maybe)
    far = checkpointed(maybe(_far_pairs(lists, percent)))
    compared = _compared(docs, nodes, far, size)
    return direct.unionByName(sure).unionByName(derived).unionByName(compared.select("a", "b"))


def _with_pivots(entries: DataFrame, candidate: Column, name: str) -> DataFrame:
    """The entries of lists that have others beside a pivot, with that pivot ``p``: the candidate with the least position."""
    pivots = entries.groupBy(*LIST).agg(F.count(F.lit(1)).alias("_n"), F.min(F.when(candidate, F.struct("pos", "n", "id"))).alias("p"))
    return written(entries.join(pivots.filter("_n > 1 AND p IS NOT NULL").drop("_n"), LIST), name)


def _beyond(lists: DataFrame, answers: DataFrame, named: DataFrame, turn: int, percent: int, reaches: tuple) -> DataFrame:
    """What is left of the lists after their pivots' answers, with new pivots.

    ``near`` has a bit for every turn in whose pivot's answers the entry was; two entries with a common bit are covered by these.
    An entry that is not among the answers is beyond the pivot's reach, so by the triangle inequality it is not
    linked to entries that are one radius inside: those leave the list.  Lists go on where entries of different components have no
    bit in common; the next pivot is an entry far from this one.
    """
    distance = F.lit(1.0) - F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))
    told = answers.select(F.col("a").alias("_p"), F.col("b").alias("id"), distance.alias("away"))
    left = (
        lists.withColumn("_p", F.col("p.id"))
        .withColumn("_close", (F.lit(percent) - _near(F.col("p.n"), percent, reaches)) / 100.0 + 1e-9)
        .drop("p", "component")
        .filter("id <> _p")
        .join(told, ["_p", "id"], "left")
        .filter(F.col("away").isNull() | (F.col("away") > F.col("_close")))
        .withColumn("near", F.when(F.col("away").isNull(), F.col("near")).otherwise(F.col("near").bitwiseOR(F.lit(1 << turn))))
        .join(named, "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
        .withColumn("far", F.col("away").isNull())
        .drop("away", "_p", "_close")
    )
    mixed = left.groupBy(*LIST).agg(
        F.max("far").alias("_far"), F.min("component").alias("_x"), F.max("component").alias("_y"), F.bit_and("near").alias("_all"), F.max("own").alias("_own")
    )
    left = written(left.join(mixed.filter("_far AND _own AND _x <> _y AND _all = 0").select(*LIST), LIST), "beyond")
    return _with_pivots(left, F.col("far"), "lists")


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _between_answers(answers: DataFrame, named: DataFrame, percent: int, maybe: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between answers of one pivot p in different components: those that are sure by the sizes, and those derived.

    x and y are linked iff |x - y| + |y - x| <= c (|x| + |y|) with c = (1 - t) / (1 + t).  With slack = c |x| - |D_x|, all in units
    of 1 / (100 + percent), that is 2 |D_x & D_y| >= -(slack_x + slack_y).  Sets that share a difference are a list; its apart
    set with the most slack is compared with all others first and what it links is contracted, so that a group of near copies
    apart from the pivot costs one pair a set.  What is still in different components is compared then.
    """
    unit = 100 + percent
    slack = (100 - percent) * F.col("n") - unit * F.col("d")
    own, centre = named.select("id", "component"), named.select(F.col("id").alias("p"), F.col("component").alias("main"))
    balls = (
        answers.select(F.col("a").alias("p"), F.col("b").alias("id"), F.col("n_b").alias("n"), F.concat("gone", "new").alias("_d"))
        .withColumn("d", F.size("_d").cast("bigint"))
        .join(own, "id", "left")
        .join(centre, "p", "left")
        .withColumn("component", F.coalesce("component", "id"))
        .withColumn("apart", F.col("component") != F.coalesce("main", "p"))
        .select("p", "id", "component", "apart", "d", slack.alias("slack"), "_d")
    )
    tops = balls.groupBy("p").agg(
        F.max(F.struct("slack", "id", "component")).alias("best"), F.max(F.when(F.col("apart"), F.col("slack"))).alias("best_apart"), F.max("apart").alias("_open")
    )
    balls = written(balls.join(tops.filter("_open").drop("_open"), "p"), "balls")
    sure = balls.filter("apart AND id <> best.id AND slack + best.slack >= 0")

    def needed(slacks: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(-slacks / (2.0 * unit) - 1e-9)).cast("int")

    other = F.when(F.col("apart"), F.col("best.slack")).otherwise(F.col("best_apart"))
    tokens = balls.select("p", "id", "component", "apart", "d", "slack", needed(F.col("slack") + other).alias("_need"), F.explode("_d").alias("token"))
    often = tokens.groupBy("p", "token").agg(F.count(F.lit(1)).alias("_f"), F.max("apart").alias("_hit"))
    place = F.row_number().over(Window.partitionBy("p", "id").orderBy("_f", "token")) - 1
    entries = written(
        tokens.join(often, ["p", "token"])
        .withColumn("room", (F.col("d") - place).cast("int"))
        .filter("room >= _need AND _f > 1 AND _hit")
        .select("p", "token", F.floor(F.col("slack") / (8.0 * unit)).cast("int").alias("block"), "id", "component", "apart", "slack", "room"),
        "differences",
    )
    least = F.lit(percent).cast("bigint").alias("least")
    firsts = entries.filter("apart").groupBy("p", "token").agg(F.max(F.struct("slack", "id", "component", "room")).alias("x"))
    meet = (F.col("component") != F.col("x.component")) & (F.least("room", "x.room") >= needed(F.col("slack") + F.col("x.slack")))
    stars = entries.join(firsts, ["p", "token"]).filter(meet)
    stars = stars.select(*_ordered(F.col("x.id"), F.col("id")), "p", F.col("x.component").alias("ca"), F.col("component").alias("cb"))
    stars = stars.groupBy("a", "b").agg(F.max("p").alias("p"), F.min(F.least("ca", "cb")).alias("ca"), F.max(F.greatest("ca", "cb")).alias("cb"))
    told = written(_derived(checkpointed(maybe(stars.withColumn("least", least))), answers, percent), "stars")
    joined = told.select(F.col("ca").alias("a"), F.col("cb").alias("b")).unionByName(sure.select(F.col("component").alias("a"), F.col("best.component").alias("b")))
    merged = checkpointed(components(joined)).select(F.col("node").alias("component"), F.col("component").alias("_to"))
    left = (
        entries.join(firsts.select("p", "token", F.col("x.id").alias("_x")), ["p", "token"])
        .filter("id <> _x")
        .drop("_x")
        .join(merged, "component", "left")
        .withColumn("component", F.coalesce("_to", "component"))
        .drop("_to")
    )
    mixed = left.groupBy("p", "token").agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.max("apart").alias("_hit"))
    left = written(left.join(mixed.filter("_hit AND _low <> _high").select("p", "token"), ["p", "token"], "left_semi"), "differences")
    blocks = left.groupBy("p", "token", "block").agg(F.max("room").alias("most"), F.max("slack").alias("top"))
    probes = (
        left.filter("apart")
        .select("p", "token", F.col("id").alias("x"), F.col("component").alias("_cx"), F.col("slack").alias("_sx"), F.col("room").alias("_rx"))
        .join(blocks, ["p", "token"])
        .filter(F.least("_rx", "most") >= needed(F.col("_sx") + F.col("top")))
    )
    meet = (
        (F.col("component") != F.col("_cx"))
        & (~F.col("apart") | (F.col("x") < F.col("id")))
        & (F.least("_rx", "room") >= needed(F.col("_sx") + F.col("slack")))
    )
    shared = probes.join(left, ["p", "token", "block"]).filter(meet)
    pairs = shared.select("p", *_ordered(F.col("x"), F.col("id"))).groupBy("a", "b").agg(F.max("p").alias("p"))
    derived = _derived(checkpointed(maybe(pairs.withColumn("least", least))), answers, percent)
    sure = sure.select(*_ordered(F.col("id"), F.col("best.id")))
    return sure, told.select("a", "b").unionByName(derived.select("a", "b"))


def _far_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b, least): pairs in what is left of a list, in different components and near no common pivot."""
    x, y = lists.filter("far").alias("x"), lists.alias("y")
    meet = (
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.block") == F.col("y.block"))
        & (F.col("x.component") != F.col("y.component"))
        & (F.col("x.near").bitwiseAND(F.col("y.near")) == 0)
        & (~F.col("y.far") | (F.col("x.id") < F.col("y.id")))
        & (F.col("x.own") | F.col("y.own"))
        & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
        & room(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"), percent)
    )
    return x.join(y, meet).select(*_ordered(F.col("x.id"), F.col("y.id"))).distinct().withColumn("least", F.lit(percent).cast("bigint"))
