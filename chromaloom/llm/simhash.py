"""SimHash fingerprints and exact near-duplicate classes through vantage-point trees.

Two 64-bit fingerprints link at ``RADIUS`` or fewer differing bits. Distances of unrelated
fingerprints to any one vantage point crowd at 32 bits, so a tree over all 64 bits would visit
most of its branches. The trees are therefore grown over fingerprints that agree on some blocks
of bits: of k blocks, two linked fingerprints agree on k - RADIUS at least, so a shard for each
choice of that many blocks and their value meets every pair. A shard that is still large is split
by Hamming distance to a vantage point: the near side holds distances up to the median plus the
radius, the far side those above the median, and by the triangle inequality every linked pair
lies whole in one side. Leaves emit a spanning forest of their links, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .support import HOT_PARTS, by_batch, components, cut, cut_measuring, join_hot
from .tokens import slices

WORDS = 3
SEED = 42
RADIUS = 3
# Fingerprints of a shard above which it is split, and of a leaf that is searched whole.
SHARD = 4096
LEAF = 512
# Fingerprints of a large shard that its tree is grown from.
TREE_SAMPLE = 512
# Vantage points that are tried for a split.
POINTS = 8
LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """XXH64 of all shingles of a text in lower-case ASCII; none if the text has no word."""
    joined = b" ".join(text.encode().lower().split())
    if not joined:
        return np.empty(0, np.uint64)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    if len(spaces) + 1 <= words:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    starts, ends = np.append(0, spaces + 1)[:1 - words], np.append(spaces, len(joined))[words - 1:]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], np.uint64)


def majority(hashes: list[np.ndarray]) -> np.ndarray:
    """Per list of hashes the bits set in more than half of it; zero for an empty list."""
    counts = np.array([len(h) for h in hashes])
    out = np.zeros(len(hashes), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    flat, n = np.concatenate(hashes), counts[full]
    # bits are counted in byte lanes, 255 hashes at a time
    runs = -(-n // 255)
    first = np.cumsum(runs) - runs
    within = np.arange(runs.sum()) - np.repeat(first, runs)
    at = np.repeat(np.cumsum(n) - n, runs) + 255 * within
    for bit in range(8):
        lanes = np.add.reduceat((flat >> np.uint64(bit)) & LANES, at).view(np.uint8).reshape(-1, 8)
        sums = np.add.reduceat(lanes.astype(np.int64), first, axis=0)
        for lane in range(8):
            out[full] |= (2 * sums[:, lane] > n).astype(np.uint64) << np.uint64(8 * lane + bit)
    return out


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) per row of ``docs(doc_id, text)``."""
    def task():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [majority([shingle_hashes(t or "", words, seed) for t in some.to_pylist()]) for some in slices(batch.column(1), 2 << 20)]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found).view(np.int64))], names=["doc_id", "fp"])
        return one
    return by_batch(docs.select("doc_id", "text"), "doc_id long, fp long", task)


def hexadecimal(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def blocks_for(n: int, radius: int = RADIUS) -> int:
    """Blocks such that a shard of ``n`` spread fingerprints holds about a hundred at most."""
    for k in (radius + 1, radius + 2):
        if n >> (64 * (k - radius) // k) < 128:
            return k
    return radius + 3


def shard_keys(k: int, radius: int = RADIUS, fp: str = "fp") -> Column:
    """One key per choice of ``k - radius`` of ``k`` blocks: the choice and the blocks' values."""
    edges = [64 * i // k for i in range(k + 1)]

    def value(i: int) -> Column:
        return F.shiftrightunsigned(fp, edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1))

    keys = []
    for c, chosen in enumerate(combinations(range(k), k - radius)):
        key, used = F.lit(c).cast("long"), 0
        for i in chosen:
            key = F.shiftleft(key, edges[i + 1] - edges[i]).bitwiseOR(value(i))
            used += edges[i + 1] - edges[i]
        # choices differ in width by a few bits; the choice goes on top so that keys never meet
        keys.append(F.shiftleft(F.lit(c).cast("long"), 48).bitwiseOR(key.bitwiseAND(F.lit((1 << used) - 1))))
    return F.explode(F.array(*keys))


def distances(fps: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(fps ^ point).astype(np.int64)


def _halves(fps: np.ndarray, point: np.uint64, radius: int) -> tuple[np.uint64, int, np.ndarray, np.ndarray]:
    """Near and far side of a vantage point; the near side reaches ``radius`` over the median."""
    d = distances(fps, point)
    middle = int(np.median(d))
    return point, middle, fps[d <= middle + radius], fps[d > middle]


def grow(sample: np.ndarray, size: float, radius: int = RADIUS, most: int = SHARD) -> tuple | None:
    """Vantage-point tree (point, median, near, far) over a sample; None is a leaf."""
    if size <= most or len(sample) < 8:
        return None
    point, middle, near, far = min((_halves(sample, p, radius) for p in sample[:: max(len(sample) // POINTS, 1)]), key=lambda h: max(len(h[2]), len(h[3])))
    if max(len(near), len(far)) > 0.9 * len(sample):  # all within a few bits of each other
        return None
    share = size / len(sample)
    return (int(point), middle, grow(near[near != point], share * len(near), radius, most), grow(far, share * len(far), radius, most))


def route(tree: tuple | None, fps: np.ndarray, at: np.ndarray, radius: int = RADIUS, leaf: int = 1) -> Iterator[tuple[int, np.ndarray]]:
    """Leaves of a tree with the places of the fingerprints each must see, overlaps included."""
    if tree is None:
        yield leaf, at
        return
    point, middle, near, far = tree
    d = distances(fps[at], np.uint64(point))
    yield from route(near, fps, at[d <= middle + radius], radius, 2 * leaf)
    yield from route(far, fps, at[d > middle], radius, 2 * leaf + 1)


def links(fps: np.ndarray, radius: int = RADIUS, most: int = LEAF) -> list[tuple[int, int]]:
    """Places of linked fingerprints: a spanning forest of each leaf of a tree over them."""
    found = []
    todo = [np.arange(len(fps))]
    while todo:
        at = todo.pop()
        if len(at) > most:
            d = distances(fps[at], fps[at[0]])
            middle = int(np.median(d))
            near, far = at[d <= middle + radius], at[d > middle]
            if max(len(near), len(far)) <= 0.9 * len(at):
                todo += [near, far]
                continue
        found += _forest(fps, at, radius)
    return found


def _forest(fps: np.ndarray, at: np.ndarray, radius: int) -> list[tuple[int, int]]:
    found, left = [], at
    while len(left):
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            x = todo.pop()
            close = np.bitwise_count(fps[left] ^ fps[x]) <= radius
            if close.any():
                new = left[close].tolist()
                found += [(x, y) for y in new]
                todo += new
                left = left[~close]
    return found


def search(keys: np.ndarray, fps: np.ndarray, radius: int = RADIUS, small: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Places of linked fingerprints among rows of equal key (rows sorted by key)."""
    left, right = [], []
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    sizes = np.diff(np.append(starts, len(keys)))
    within = np.repeat(sizes <= small, sizes)
    for shift in range(1, min(small, int(sizes.max(initial=0)))):
        a = np.flatnonzero((keys[shift:] == keys[:-shift]) & within[:-shift])
        a = a[np.bitwise_count(fps[a] ^ fps[a + shift]) <= radius]
        left.append(a)
        right.append(a + shift)
    for s, n in zip(starts[sizes > small].tolist(), sizes[sizes > small].tolist(), strict=True):
        pairs = np.array(links(fps[s:s + n], radius), np.int64).reshape(-1, 2) + s
        left.append(pairs[:, 0])
        right.append(pairs[:, 1])
    none = [np.empty(0, np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def linked(distinct: DataFrame, n: int, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """Links a, b between representatives of ``distinct(fp, rep)``, a table of ``n`` distinct fingerprints."""
    rows = cut(distinct.select("fp", "rep", shard_keys(blocks_for(n, radius), radius).alias("key")))
    counts = rows.groupBy("key").agg(F.count("*").alias("_n"))
    total = rows.count()
    # at most HOT_PARTS shards are above this size, so their samples fit the driver
    hot = cut(counts.where(F.col("_n") > max(shard, total // HOT_PARTS)))
    every = F.greatest(F.lit(1), F.col("_n") / TREE_SAMPLE).cast("long")
    sampled = (rows.join(F.broadcast(hot), "key").where(F.pmod(F.xxhash64("fp"), every) == 0)
               .select("key", "fp", "_n").orderBy("key", F.xxhash64("fp")).collect())
    samples: dict[int, tuple[int, list[int]]] = {}
    for r in sampled:
        samples.setdefault(r["key"], (r["_n"], []))[1].append(r["fp"])
    trees = {k: grow(np.array(s, np.int64).view(np.uint64), size, radius, shard) for k, (size, s) in samples.items()}

    def dealt():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            fp, rep, key = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            special = np.isin(key, np.array(list(trees), np.int64))
            at, leaves = [np.flatnonzero(~special)], [np.zeros((~special).sum(), np.int64)]
            for k in np.unique(key[special]).tolist():
                for leaf, places in route(trees[k], fp.view(np.uint64), np.flatnonzero(key == k), radius):
                    at.append(places)
                    leaves.append(np.full(len(places), leaf))
            place = np.concatenate(at)
            return pa.RecordBatch.from_arrays([pa.array(key[place]), pa.array(np.concatenate(leaves)), pa.array(fp[place]), pa.array(rep[place])],
                                              names=["key", "leaf", "fp", "rep"])
        return one

    placed = by_batch(rows.where("rep is not null").select("fp", "rep", "key"), "key long, leaf long, fp long, rep long", dealt)
    together = placed.repartition("key", "leaf").sortWithinPartitions("key", "leaf", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.empty((4, 0), np.int64)  # the last group so far: it may go on in the next batch

        def found(block: np.ndarray) -> pa.RecordBatch:
            mixed = np.cumsum(np.append(0, (block[:2, 1:] != block[:2, :-1]).any(axis=0)))[:block.shape[1]]
            a, b = search(mixed, block[2].view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(block[3][a]), pa.array(block[3][b])], names=["a", "b"])

        for batch in batches:
            block = np.concatenate([kept, np.array([c.to_numpy(zero_copy_only=False) for c in batch.columns])], axis=1)
            if not block.shape[1]:
                continue
            last = int(np.flatnonzero(np.append(True, (block[:2, 1:] != block[:2, :-1]).any(axis=0)))[-1])
            kept = block[:, last:]
            if last:
                yield found(np.ascontiguousarray(block[:, :last]))
        if kept.shape[1]:
            yield found(np.ascontiguousarray(kept))

    return together.mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, words: int = WORDS, seed: int = SEED, radius: int = RADIUS) -> DataFrame:
    """Near-duplicate classes of ``docs(doc_id, text)``: doc_id, fp, component_id.

    One row per row. component_id is the smallest doc_id reachable over links, its own included.
    Null and empty texts, and texts of white space, have fingerprint zero and are linked like any
    other; a text of fewer than ``words`` words is one shingle. Rows with a null doc_id get the
    class of their fingerprint (null if it has no doc_id); repeated rows are classed alike; an
    empty table gives no rows; other columns are not read.
    """
    fps, total = cut_measuring(fingerprints(docs, words, seed), F.count("*"))
    distinct, n = cut_measuring(fps.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("_n")), F.count("*"))
    found = components(cut(linked(distinct, n, radius)))
    named = distinct.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    table = cut(named.select("fp", F.coalesce("root", "rep").alias("component_id"), "_n"))
    return join_hot(fps, table, "fp", total).select("doc_id", "fp", "component_id")
