"""SentencePiece encoding, decoding, and distinct sampled segmentations by Gumbel top-k over the lattice.

The lattice of a text has every vocabulary piece at every position; a character without a piece is spelt by its bytes.  A piece
weighs 1 / (1 + id) ** alpha, since ids follow the merge order and so the frequency.  No piece goes on over a blank, so the
lattice of a text is the chain of its words' lattices, which are made once per word and kept.  Their weights are normalised
backwards, so a walk from the left is an exact draw.

Sampling without replacement is a best-first search by perturbed log-probability.  The search's regions are sets of
segmentations with one Gumbel maximum each: the first region holds all of them; when a region's maximum is drawn, the rest of
it falls into one region per lattice step (same steps before, another edge here), whose maxima are Gumbels at their log mass
truncated at the maximum just drawn.  The next sample comes from the open region with the largest maximum.  The k-th and the
following maximum give each sample's inclusion score (Kool et al., 2019).
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
ALPHA = 0.5
CACHED_WORDS = 120_000
CACHED_IDS = 1_000_000
CACHED_EDGES = 800_000
GROUP_CHARS = 200_000
SPACE = "▁"
WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class PieceLattice:
    """Lattices of words over all vocabulary pieces.  States are what is left of a word; a chain of words is a text.

    A state has one edge for each piece that spells the next characters; a character without a piece has the chain of its
    bytes.  Edges of a state are stored together: ``piece``, ``target`` (-1 when the word is spelt), ``p`` (the edge's share of
    the state's mass), ``log_p`` and ``log_rest`` (log of 1 - p), and ``upto``, cumulative shares offset by the state for one
    search over all.  Words are added many at a time, once each, and kept while there is room.
    """

    def __init__(self, processor: sentencepiece.SentencePieceProcessor, alpha: float):
        n = processor.get_piece_size()
        self.weight = -alpha * np.log(1.0 + np.arange(n))
        self.byte_ids = [0] * 256
        plain = {}
        for i in range(n):
            name = processor.id_to_piece(i)
            if processor.is_byte(i):
                self.byte_ids[int(name[3:5], 16)] = i
            elif not (processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i)):
                if SPACE in name.lstrip(SPACE):
                    raise ValueError(f"piece {name!r} goes on over a blank")
                plain[name] = i
        self.longest = max(map(len, plain))
        # a trie of the pieces: node 0 is the root; (node, character) -> node in sorted arrays
        nodes = {"": 0}
        for name in plain:
            for end in range(1, len(name) + 1):
                nodes.setdefault(name[:end], len(nodes))
        self.node_piece = np.array([plain.get(prefix, -1) for prefix in nodes], np.int64)
        steps = sorted((nodes[prefix[:-1]] << 21 | ord(prefix[-1]), node) for prefix, node in nodes.items() if prefix)
        self.step_keys, self.step_nodes = np.array(steps, np.int64).T.copy()
        self.reset()

    def reset(self) -> None:
        self.words: dict[str, int] = {}
        self.n_states = self.n_edges = 0
        self.first, self.last = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64)
        self.p_first = np.empty(1 << 12)
        self.piece, self.target = np.empty(1 << 14, np.int32), np.empty(1 << 14, np.int64)
        self.p, self.upto, self.log_p, self.log_rest = (np.empty(1 << 14) for _ in range(4))

    def _append(self, name: str, at: int, values: np.ndarray) -> None:
        held = getattr(self, name)
        if at + len(values) > len(held):
            held = np.concatenate([held[:at], np.empty(max(at // 2, len(values)) + len(values), held.dtype)])
            setattr(self, name, held)
        held[at : at + len(values)] = values

    def chains(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the first states of its words in turn; good until the next call."""
        split = [WORDS.findall(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        if self.n_edges > CACHED_EDGES:
            self.reset()
        missing = [w for w in dict.fromkeys(chain.from_iterable(split)) if w not in self.words]
        if missing:
            self._add(missing)
        return [np.fromiter(map(self.words.__getitem__, words), np.int64, len(words)) for words in split]

    def _add(self, words: list[str]) -> None:
        base = self.n_states
        text = "".join(words)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        n = len(codes)
        sizes = np.array([len(w) for w in words])
        ends = np.cumsum(sizes)
        self.words.update(zip(words, (base + ends - sizes).tolist()))
        end_of = np.repeat(ends, sizes)
        at, node, found = np.arange(n), np.zeros(n, np.int64), []
        for length in range(1, self.longest + 1):
            inside = at + length <= end_of[at]
            at, node = at[inside], node[inside]
            key = node << 21 | codes[at + length - 1]
            step = np.minimum(np.searchsorted(self.step_keys, key), len(self.step_keys) - 1)
            hit = self.step_keys[step] == key
            at, node = at[hit], self.step_nodes[step[hit]]
            piece = self.node_piece[node]
            whole = piece >= 0
            found.append((at[whole], at[whole] + length, piece[whole], self.weight[piece[whole]]))
        spelt = np.ones(n, bool)
        spelt[found[0][0]] = False
        links: list[tuple[int, int]] = []  # (piece, target) of the states between bytes
        by_byte = np.flatnonzero(spelt)
        begun, heads = {}, []
        for i in by_byte.tolist():
            ids = [self.byte_ids[b] for b in text[i].encode("utf-8", "surrogatepass")]
            follow = -1 if i + 1 == end_of[i] else base + i + 1
            for b in ids[:0:-1]:
                links.append((b, follow))
                follow = base + n + len(links) - 1
            begun[i] = follow
            heads.append((ids[0], float(self.weight[ids].sum())))
        if heads:
            found.append((by_byte, by_byte + 1, np.array([h[0] for h in heads], np.int64), np.array([h[1] for h in heads])))
        source, to, piece, cost = (np.concatenate(c) for c in zip(*found[::-1]))
        order = np.argsort(source, kind="stable")
        source, to, piece, cost = source[order], to[order], piece[order], cost[order]
        ended = to == end_of[source]
        target = np.where(ended, -1, base + to)
        if heads:
            mine = spelt[source] & (to == source + 1)
            target[mine] = [begun[i] for i in source[mine].tolist()]
        # log mass of all ways to spell the rest of the word, all words together from their ends on
        mass, after = np.zeros(n + 1), np.where(ended, n, to)
        left = end_of[source] - source
        by_left = np.argsort(left, kind="stable")
        bounds = np.concatenate([[0], np.cumsum(np.bincount(left)[1:])])
        for low, high in zip(bounds[:-1], bounds[1:]):
            edges = by_left[low:high]
            where = source[edges]
            begin = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
            many = np.diff(np.concatenate([begin, [len(edges)]]))
            logs = cost[edges] + mass[after[edges]]
            top = np.maximum.reduceat(logs, begin)
            mass[where[begin]] = top + np.log(np.add.reduceat(np.exp(logs - np.repeat(top, many)), begin))
        log_p = np.minimum(cost + mass[after] - mass[source], 0.0)
        counts = np.concatenate([np.bincount(source, minlength=n), np.ones(len(links), np.int64)])
        log_p = np.concatenate([log_p, np.zeros(len(links))])
        piece = np.concatenate([piece, np.array([b for b, _ in links], np.int64)])
        target = np.concatenate([target, np.array([t for _, t in links], np.int64)])
        begin = np.cumsum(counts) - counts
        log_p[begin[counts == 1]] = 0.0
        shares = np.exp(log_p)
        # 1 - p is summed from the other edges where p is large
        large = shares > 0.5
        others = np.where(large, np.repeat(np.add.reduceat(np.where(large, 0.0, shares), begin), counts), 1 - shares)
        total = np.cumsum(shares)
        upto = total + np.repeat(base + np.arange(len(counts)) - (total - shares)[begin], counts)
        with np.errstate(divide="ignore"):
            rest = np.log(others)
        first = self.n_edges + begin
        for name, values in (("first", first), ("last", first + counts - 1), ("p_first", shares[begin])):
            self._append(name, base, values)
        for name, values in (("piece", piece), ("target", target), ("p", shares), ("upto", upto), ("log_p", log_p), ("log_rest", rest)):
            self._append(name, self.n_edges, values)
        self.n_states, self.n_edges = base + len(counts), self.n_edges + len(piece)

    def edges(self, states: np.ndarray, random: np.random.Generator) -> np.ndarray:
        """One edge drawn for each state."""
        u = random.random(len(states))
        edge = self.first[states]
        other = np.flatnonzero(u >= self.p_first[states])
        if len(other):
            at = states[other]
            edge[other] = np.minimum(np.searchsorted(self.upto[: self.n_edges], at + u[other], side="right"), self.last[at])
        return edge

    def walk(self, states: np.ndarray, random: np.random.Generator) -> np.ndarray:
        """Edges of a draw that finishes each of ``states`` in turn, in text order."""
        place, found, where = np.arange(len(states)), [], []
        while len(states):
            edge = self.edges(states, random)
            found.append(edge)
            where.append(place)
            target = self.target[edge]
            open_ = target >= 0
            states, place = target[open_], place[open_]
        if len(found) == 1:
            return found[0]
        return np.concatenate(found)[np.argsort(np.concatenate(where), kind="stable")] if found else np.empty(0, np.int64)

    def sample(self, words: np.ndarray, k: int, seed: int) -> tuple[list[np.ndarray], list[float]]:
        """Up to k distinct segmentations of the chain of ``words`` (first states) as piece ids, with log inclusion scores.

        Fewer come back only if there are no more.  The same words and seed give the same samples.
        """
        random = np.random.default_rng(seed & ((1 << 63) - 1))
        top = -np.log(-np.log(random.random()))
        heap: list = [(-top, 0, None, 0)]
        done, logs, number = [], [], 1
        while heap and len(done) < k:
            negative, _, parent, at = heapq.heappop(heap)
            bound = -negative
            if parent is None:
                path, fixed = self.walk(words, random), 0
            else:
                path, fixed = self._other(parent, at, words, random), at
            steps = self.log_p[path]
            ahead = np.concatenate([[0.0], np.cumsum(steps)])
            done.append(path)
            logs.append(float(ahead[-1]))
            rest = self.log_rest[path]
            if parent is not None:
                rest[at] = self._left_mass(parent, at, path[at])
            mass = ahead[:-1] + rest
            some = np.flatnonzero(np.isfinite(mass[fixed:])) + fixed
            u = random.random(len(some))
            with np.errstate(over="ignore"):
                maxima = mass[some] - np.logaddexp(mass[some] - bound, np.log(-np.log(u)))
            # only as many regions as samples are still wanted, and one for the threshold, can come to the top
            keep = np.argsort(-maxima, kind="stable")[: k - len(done) + 1]
            used = self._used(parent, at)
            for i in keep:
                step = int(some[i])
                heapq.heappush(heap, (-float(maxima[i]), number, (path, step, used if parent is not None and step == at else ()), step))
                number += 1
        pieces = [self.piece[path] for path in done]
        if not heap:
            return pieces, [0.0] * len(done)
        threshold = -heap[0][0]
        return pieces, [float(np.log(-np.expm1(-np.exp(min(x - threshold, 700.0))))) if x - threshold > -30 else x - threshold for x in logs]

    def _used(self, parent, at: int) -> tuple:
        return () if parent is None else (*parent[2], int(parent[0][at]))

    def _left_mass(self, parent, at: int, chosen: int) -> float:
        """Log of the share of a state's edges that neither earlier samples of this region nor this one took."""
        state_edges = self._choices(parent, at)
        left = sum(self.p[e] for e in state_edges if e != chosen)
        return float(np.log(left)) if left > 0 else -np.inf

    def _choices(self, parent, at: int) -> list[int]:
        edge = int(parent[0][at])
        state = int(np.searchsorted(self.first[: self.n_states], edge, side="right")) - 1
        taken = set(self._used(parent, at))
        return [e for e in range(self.first[state], self.last[state] + 1) if e not in taken]

    def _other(self, parent, at: int, words: np.ndarray, random: np.random.Generator) -> np.ndarray:
        """A path of the region: the parent's steps before ``at``, an edge not taken yet there, and a free draw behind it."""
        path = parent[0]
        choices = self._choices(parent, at)
        p = np.array([self.p[e] for e in choices])
        edge = choices[int(np.searchsorted(np.cumsum(p / p.sum()), random.random(), side="right").clip(0, len(choices) - 1))]
        begun = int((self.target[path[:at]] < 0).sum())  # words spelt before this step
        follow = np.array([edge])
        if self.target[edge] >= 0:
            follow = np.concatenate([follow, self.walk(np.array([self.target[edge]]), random)])
        return np.concatenate([path[:at], follow, self.walk(words[begun + 1 :], random)])


class Encoder:
    """Best segmentation of whole texts.  No piece goes on over a blank, so words are encoded once.

    The ids of known words lie end to end in one array; ``words`` gives a word's number.  Both are emptied when they are full.
    """

    def __init__(self, model: bytes):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.reset()

    def reset(self) -> None:
        self.words: dict[str, int] = {}
        self.ids, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; texts with blanks that belong to no word go to the processor as they are."""
        split = [t.split(" ") if t and not ("  " in t or t[0] == " " or t[-1] == " " or SPACE in t) else None for t in texts]
        if len(self.words) > CACHED_WORDS or len(self.ids) > CACHED_IDS:
            self.reset()
        missing = [w for w in dict.fromkeys(chain.from_iterable(filter(None, split))) if w not in self.words]
        if missing:
            fresh = self.processor.encode(missing, num_threads=1)
            self.words.update(zip(missing, range(len(self.words), len(self.words) + len(missing))))
            sizes = np.fromiter(map(len, fresh), np.int64, len(fresh))
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(fresh), np.int32, int(sizes.sum()))])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        return [self._gathered(words) if words else np.array(self.processor.encode(text) if text else [], np.int32) for text, words in zip(texts, split)]

    def _gathered(self, words: list[str]) -> np.ndarray:
        number = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        first, sizes = self.ends[number], self.ends[number + 1] - self.ends[number]
        total = np.cumsum(sizes)
        return self.ids[np.arange(total[-1]) + np.repeat(first - (total - sizes), sizes)]

    def piece_bytes(self) -> list[bytes]:
        """What each id adds to the decoded text; the blank put before every text is to be cut off."""
        sp = self.processor
        out = []
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                out.append(bytes([int(sp.id_to_piece(i)[3:5], 16)]))
            else:
                out.append(b"" if sp.is_control(i) else sp.id_to_piece(i).replace(SPACE, " ").encode())
        return out


def decode(ids: list[int], piece_bytes: list[bytes]) -> str:
    """The text of token ids; bytes that are not UTF-8 become U+FFFD."""
    return b"".join(map(piece_bytes.__getitem__, ids))[1:].decode("utf-8", "replace")


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as file:
        return file.read()


OUTPUT = (
    "ids array<int>, ids_crc32 bigint, samples array<struct<ids:array<int>,ids_crc32:bigint,log_inclusion:double>>, decoded string"
)


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Stretches of rows with about ``GROUP_CHARS`` characters, one row at least."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > GROUP_CHARS:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays).astype(np.int32) if arrays else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _checksums(arrays: list[np.ndarray]) -> pa.Array:
    """CRC32 of each array as little-endian 32-bit integers."""
    return pa.array([zlib.crc32(a.astype("<i4", copy=False).tobytes()) for a in arrays], pa.int64())


def _run(rows: DataFrame, seed: Column, model: bytes, k: int, alpha: float) -> DataFrame:
    names = [c for c in rows.columns if c != "_seed"]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names) + ", " + OUTPUT
    shared = rows.sparkSession.sparkContext.broadcast((model, vars(PieceLattice(Encoder(model).processor, alpha))))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, arrays = shared.value
        lattice = PieceLattice.__new__(PieceLattice)
        lattice.__dict__.update(arrays)
        lattice.reset()
        encoder = Encoder(model)
        spelt = encoder.piece_bytes()
        for batch in batches:
            texts = [t or "" for t in batch.column("_text").to_pylist()]
            seeds = batch.column("_seed").to_pylist()
            for low, high in _groups(texts):
                here = texts[low:high]
                ids, samples, scores, sizes, decoded = [], [], [], [], []
                for best, words, row_seed in zip(encoder.encode(here), lattice.chains(here), seeds[low:high]):
                    ids.append(best)
                    drawn, logs = lattice.sample(words, k, row_seed) if len(words) else ([], [])
                    samples += drawn
                    scores += logs
                    sizes.append(len(drawn))
                    decoded.append(decode((drawn[0] if drawn else ids[-1]).tolist(), spelt))
                each = pa.StructArray.from_arrays([_lists(samples), _checksums(samples), pa.array(scores, pa.float64())], ["ids", "ids_crc32", "log_inclusion"])
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                made = [_lists(ids), _checksums(ids), pa.ListArray.from_arrays(pa.array(offsets), each), pa.array(decoded, pa.string())]
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], *made], [*names, "ids", "ids_crc32", "samples", "decoded"])

    return rows.withColumn("_seed", seed).mapInArrow(encode, schema)


def segmentations(
    docs: DataFrame, *, model: str = MODEL, k: int = SAMPLES, alpha: float = ALPHA, digest: bool = False
) -> DataFrame:
    """``docs`` without its text, plus ``ids`` (best segmentation), ``samples`` (k distinct ones with log inclusion
    scores, the first the likeliest under the row's noise) and ``decoded`` (the text got back from the first sample).

    With ``digest`` counts and checksums of the ids stand beside them, and ``round_trip`` tells whether the decoded
    text is the input.  Samples depend on doc_id (the text where it is null) and on nothing else in the table.  Null and empty
    texts have no tokens and samples, and decode to ''; a text with fewer than k segmentations gives them all, with log score 0.
    Repeated rows give repeated results; an empty table gives no rows; columns that bear an output's name are replaced.
    """
    outputs = {"ids", "ids_crc32", "samples", "decoded", "_text", "_seed"} | ({"n_tokens", "round_trip"} if digest else set())
    others = [c for c in docs.columns if c != "text" and c not in outputs]
    rows = docs.select(*[F.col(f"`{c}`") for c in others], F.col("text").alias("_text"))
    seed = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.col("_text")))
    found = _run(rows, seed, read_model(model), k, alpha)
    named = [F.col(f"`{c}`") for c in others]
    if not digest:
        bare = F.transform("samples", lambda s: F.struct(s["ids"].alias("ids"), s["log_inclusion"].alias("log_inclusion")))
        return found.select(*named, "ids", bare.alias("samples"), "decoded")

    def described(sample: Column) -> Column:
        ids = sample["ids"]
        size, score = F.size(ids), F.round(sample["log_inclusion"], 6)
        return F.struct(size.alias("n_tokens"), sample["ids_crc32"].alias("ids_crc32"), score.alias("log_inclusion"), ids.alias("ids"))

    return found.select(
        *named,
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids_crc32",
        (F.col("decoded") == F.coalesce("_text", F.lit(""))).alias("round_trip"),
        F.transform("samples", described).alias("samples"),
        "ids",
        "decoded",
    )
