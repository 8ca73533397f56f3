"""Packing of token sequences into windows by non-negative least squares.

Each document's ids are cut into whole windows and a remainder. Remainders of a group of
documents are counted by length class. All shallow combinations of classes that fill a window
are enumerated, their repeat counts are solved against the histogram by non-negative least
squares and rounded, and remainders are drawn for them. What the combinations leave open is
filled greedily with cuts of the remainders that were not drawn, and the rest of those is laid
end to end. Only the last sequence of a task is short; it is cut at powers of two, which need no
padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import tokens
from .support import release

WINDOW = 2048
# Width of a length class, and how many remainders a combination may hold.
CLASS = 32
DEPTH = 4
# Ids of a group: groups bound the memory of a task and are packed each on its own.
GROUP_IDS = 1 << 20
END = 1

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class Part(NamedTuple):
    """A run of a document's ids: index of the document in its group, first id, number of ids."""

    doc: int
    start: int
    length: int


def combinations(total: int, depth: int, most: int | None = None) -> Iterator[tuple[int, ...]]:
    """Multisets of at most ``depth`` classes that add up to ``total``, largest class first."""
    if total == 0:
        yield ()
    elif depth:
        for first in range(min(total, most or total), (total - 1) // depth, -1):
            for others in combinations(total - first, depth - 1, first):
                yield (first, *others)


@lru_cache(maxsize=4)
def combination_table(classes: int, depth: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All combinations that fill ``classes`` classes, and how often each holds each class."""
    found = list(combinations(classes, depth))
    table = np.zeros((classes, len(found)))
    for k, combination in enumerate(found):
        for c in combination:
            table[c - 1, k] += 1
    return found, table


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 with least ||a x - b||, by the active-set method."""
    gram, target = a.T @ a, a.T @ b
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    small = 1e-9 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(6 * a.shape[0]):
        slope = np.where(used, -np.inf, target - gram @ x)
        if (best := int(slope.argmax())) < 0 or slope[best] <= small:
            break
        used[best] = True
        while True:
            at = np.flatnonzero(used)
            s = np.linalg.lstsq(gram[np.ix_(at, at)], target[at], rcond=None)[0]
            low = s <= small
            if not low.any():
                break
            old = x[at]
            step = (old[low] / np.maximum(old[low] - s[low], 1e-300)).min()
            x[at] = old + step * (s - old)
            used[at[x[at] <= small]] = False
            x[~used] = 0
            if not used.any():
                return x
        x[:] = 0
        x[at] = s
    return x


def repeat_counts(histogram: np.ndarray, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """Rounded repeat counts of the combinations, which together never exceed the histogram."""
    found, table = combination_table(len(histogram), depth)
    there = np.flatnonzero((table[histogram == 0] == 0).all(axis=0))
    if not len(there):
        return []
    x, left, out = nnls(table[:, there], histogram.astype(float)), histogram.copy(), []
    for k in np.argsort(-x, kind="stable"):
        if x[k] < 0.5:
            break
        column = table[:, there[k]].astype(np.int64)
        held = column > 0
        n = min(int(x[k] + 0.5), int((left[held] // column[held]).min()))
        if n:
            left -= n * column
            out.append((found[there[k]], n))
    return out


def pack_group(parts: list[Part], window: int, width: int, depth: int) -> tuple[list[list[Part]], list[Part]]:
    """Full sequences of remainders (each shorter than a window), and under a window of ids left over."""
    pools: list[list[Part]] = [[] for _ in range(window // width)]
    for p in sorted(parts, key=lambda p: (p.length, p.doc), reverse=True):
        pools[(p.length - 1) // width].append(p)
    sequences = []
    for combination, n in repeat_counts(np.array([len(p) for p in pools]), depth):
        for _ in range(n):
            sequences.append([pools[c - 1].pop() for c in combination])
    rest = list(chain.from_iterable(reversed(pools)))
    gaps = [window - sum(p.length for p in s) for s in sequences]
    have, need = sum(p.length for p in rest), sum(gaps)
    while have < need:  # too little to fill the gaps: give sequences back
        have += window - gaps[-1]
        need -= gaps.pop()
        rest += sequences.pop()
    feed = _Feed(rest)
    for s, gap in zip(sequences, gaps, strict=True):
        s += feed.take(gap)
    have -= need
    while have >= window:
        sequences.append(feed.take(window))
        have -= window
    return sequences, feed.take(have)


class _Feed:
    """Parts laid end to end, cut where asked."""

    def __init__(self, parts: list[Part]):
        self.parts = parts[::-1]

    def take(self, n: int) -> list[Part]:
        out = []
        while n:
            p = self.parts.pop()
            if p.length > n:
                self.parts.append(Part(p.doc, p.start + n, p.length - n))
                p = Part(p.doc, p.start, n)
            out.append(p)
            n -= p.length
        return out


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, width: int = CLASS, depth: int = DEPTH,
         group_ids: int = GROUP_IDS, end: int = END) -> DataFrame:
    """Pack the ids of ``docs(doc_id, text)``, each followed by the id ``end``, into sequences.

    One row per piece: doc_id, start (ids of the document before it), length, doc_tokens (with the
    end id), sequence_id, offset in the sequence, and ids as little-endian unsigned 32-bit
    integers. Each id lies in exactly one piece and offsets of a sequence have no gap. Every
    sequence is ``window`` long or, for the last ids of a task, a power of two below it.

    Tasks pack their own rows in groups of about ``group_ids`` ids; nothing is shuffled. Rows of a
    task must come in the same order if it runs again, as they do from a table's files. Null text
    is an empty text (one piece: the end id); null and repeated doc_ids are packed row by row; an
    empty table gives no rows; other columns are not read.
    """
    if window % width or window & (window - 1):
        raise ValueError("the window is a power of two and a multiple of the class width")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.byte_bpe(vocabulary)
        first = TaskContext.get().partitionId() << 36
        group = _Group(window, width, depth, first)
        for batch in batches:
            ids, texts, done = batch.column(0).to_pylist(), batch.column(1), 0
            for some in tokens.slices(texts):
                flat, bounds = encoder.encode(some)
                for k in range(len(some)):
                    group.add(ids[done + k], np.append(flat[bounds[k]:bounds[k + 1]], np.uint32(end)))
                    if group.n >= group_ids:
                        yield group.flush()
                done += len(some)
            release()
        yield group.flush(last=True)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


class _Group:
    def __init__(self, window: int, width: int, depth: int, sequence: int):
        self.window, self.width, self.depth, self.sequence = window, width, depth, sequence
        self.docs: list[tuple[int | None, np.ndarray]] = []
        self.left: list[Part] = []
        self.n = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, ids))
        self.n += len(ids)

    def flush(self, last: bool = False) -> pa.RecordBatch:
        w, parts, sequences = self.window, self.left, []
        seen = {p.doc for p in parts}
        for k, (_, ids) in enumerate(self.docs):
            if k in seen:  # what the group before has left over
                continue
            whole = len(ids) - len(ids) % w
            sequences += [[Part(k, at, w)] for at in range(0, whole, w)]
            if whole < len(ids):
                parts.append(Part(k, whole, len(ids) - whole))
        packed, left = pack_group(parts, w, self.width, self.depth)
        sequences += packed
        if last:
            feed, n = _Feed(left), sum(p.length for p in left)
            sequences += [feed.take(1 << bit) for bit in range(w.bit_length() - 1, -1, -1) if n >> bit & 1]
            left = []
        rows = [(p, self.sequence + k, offset) for k, s in enumerate(sequences) for p, offset in zip(s, _offsets(s), strict=True)]
        self.sequence += len(sequences)
        out = pa.RecordBatch.from_arrays([
            pa.array([self.docs[p.doc][0] for p, _, _ in rows], pa.int64()),
            pa.array([p.start for p, _, _ in rows], pa.int64()), pa.array([p.length for p, _, _ in rows], pa.int64()),
            pa.array([len(self.docs[p.doc][1]) for p, _, _ in rows], pa.int64()),
            pa.array([s for _, s, _ in rows], pa.int64()), pa.array([o for _, _, o in rows], pa.int64()),
            pa.array([self.docs[p.doc][1][p.start:p.start + p.length].tobytes() for p, _, _ in rows], pa.binary()),
        ], names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
        # documents of which something is left go first in the next group
        kept = sorted({p.doc for p in left})
        self.docs = [self.docs[k] for k in kept]
        self.left = [Part(kept.index(p.doc), p.start, p.length) for p in left]
        self.n = sum(p.length for p in left)
        return out


def _offsets(sequence: list[Part]) -> list[int]:
    ends = np.cumsum([p.length for p in sequence])
    return [0, *ends[:-1].tolist()]
