"""Character n-grams of whole texts as packed integers, for tasks that count or score them.

Characters fall into 128 classes (7 bits); an n-gram is n classes packed into one integer, the last character lowest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLASS_BITS = 7
CLASSES = 1 << CLASS_BITS
PIECE_CHARS = 1 << 20
FLUSH_ROWS = 1 << 20
CODE_POINTS = 0x110000


def letter_classes() -> np.ndarray:
    """Class of every code point: 0 for all but letters, 1-26 for a-z in either case, 27-127 for other letters by code."""
    table = np.zeros(CODE_POINTS, np.uint8)
    for point in range(0x3000):
        char = chr(point)
        if char.isalpha():
            low = ord(char.lower()[0])
            table[point] = low - 96 if 97 <= low <= 122 else 27 + low % 101
    rest = np.arange(0x3000, CODE_POINTS)
    table[0x3000:] = 27 + rest % 101
    return table


def print_classes() -> np.ndarray:
    """Class of every code point with case, digits and punctuation kept apart; blanks are 0."""
    table = (96 + np.arange(CODE_POINTS) % 32).astype(np.uint8)
    table[33:127] = np.arange(1, 95)
    table[:33] = 0
    return table


def pieces(texts: Iterable[str | None], overlap: int) -> Iterator[tuple[list[int], list[str], list[int]]]:
    """Texts in groups of about a million characters: row numbers, strings, and leading characters that are context only.

    A longer text comes in several strings, each with the last ``overlap`` characters before it.
    """
    rows, parts, context, held = [], [], [], 0
    for row, text in enumerate(texts):
        text = text or ""
        for start in range(0, max(len(text), 1), PIECE_CHARS):
            before = min(start, overlap)
            rows.append(row)
            parts.append(text[start - before : start + PIECE_CHARS])
            context.append(before)
            held += len(parts[-1])
            if held >= PIECE_CHARS:
                yield rows, parts, context
                rows, parts, context, held = [], [], [], 0
    if rows:
        yield rows, parts, context


def grams(parts: list[str], context: list[int], classes: np.ndarray, order: int, squeeze: bool) -> tuple[np.ndarray, np.ndarray]:
    """(packed n-grams of all strings in turn, how many each string has).

    A string begins as if blanks came before it.  With ``squeeze`` a blank after a blank is passed over.
    """
    joined = "".join(parts).encode("utf-32-le", "surrogatepass")
    codes = classes[np.frombuffer(joined, np.uint32)]
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - np.array([len(p) for p in parts])
    counted = np.ones(len(codes), bool)
    for start, skip in zip(starts, context):
        counted[start : start + skip] = False
    if squeeze and len(codes):
        keep = codes != 0
        after = np.concatenate([[False], codes[:-1] != 0])
        after[starts[starts < len(codes)]] = False  # what lies before a string's first character is another string
        keep |= after
        total = np.concatenate([[0], np.cumsum(keep)])
        starts, ends, codes, counted = total[starts], total[ends], codes[keep], counted[keep]
    packed = codes.astype(np.int64)
    for back in range(1, min(order, len(codes))):
        packed[back:] |= codes[: len(codes) - back].astype(np.int64) << (CLASS_BITS * back)
    for offset in range(order - 1):
        at = starts[starts + offset < ends] + offset
        packed[at] &= (1 << (CLASS_BITS * (offset + 1))) - 1
    total = np.concatenate([[0], np.cumsum(counted)])
    return packed[counted], total[ends] - total[starts]


def sums_by_row(values: np.ndarray, sizes: np.ndarray, rows: list[int], out: np.ndarray) -> None:
    """Add to ``out[row]`` the sum over each string's stretch of ``values``."""
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        np.add.at(out, np.asarray(rows)[full], np.add.reduceat(values, starts, axis=0))


def count_grams(texts: DataFrame, label: str, order: int, classes_of: Callable[[], np.ndarray]) -> DataFrame:
    """(label, gram, n) of all character n-grams of ``texts`` (string label, text); tasks add up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = classes_of()
        held: dict[str, list] = {}
        rows = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for name, found in held.items():
                keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
                n = np.bincount(at, np.concatenate([c for _, c in found])).astype(np.int64)
                labels = pa.array([name] * len(keys), pa.string())
                yield pa.RecordBatch.from_arrays([labels, pa.array(keys, pa.int64()), pa.array(n)], [label, "gram", "n"])
            held.clear()

        for batch in batches:
            names = np.array(batch.column(label).to_pylist(), object)
            here = batch.column("text").to_pylist()
            for name in sorted(set(names)):
                for _, parts, context in pieces((here[i] for i in np.flatnonzero(names == name)), order - 1):
                    packed, _ = grams(parts, context, classes, order, True)
                    keys, n = np.unique(packed, return_counts=True)
                    held.setdefault(name, []).append((keys, n))
                    rows += len(keys)
                    if rows >= FLUSH_ROWS:
                        yield from flush()
                        rows = 0
        yield from flush()

    part = texts.select(label, "text").mapInArrow(count, f"{label} string, gram bigint, n bigint")
    return part.groupBy(label, "gram").agg(F.sum("n").alias("n"))
