"""Spelling variants: words at one edit from each other, found in a trie of letter-group counts.

A word is arranged by how often it has letters of each of ``GROUPS``, one group after another. Two
words that differ by one inserted, deleted or replaced letter have counts that differ by one
surplus, one deficit, or one of each at most. Each pair is looked for from one side only: from the
shorter word, or from the one whose surplus comes before its deficit, so a search spends the surplus
first and the deficit then. Words are dealt to shards by their first counts; a word is sent as a
query to its own shard and to those one surplus and one deficit away. Inside a shard a depth-first
search walks the trie of the other groups with all queries at once, and pairs of words at its
leaves are verified.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import cut, cut_measuring, release

RUN = "[A-Za-zÀ-ÿ]"
LEAST_CHARS = 6
LEAST_COUNT = 5
# A word's form is this many times as frequent.
RATIO = 5
# Letters of a group; any other letter is of the last one. Common letters come first, so that
# shards and the upper levels of the trie divide well.
GROUPS = ("e", "n", "t", "i", "a", "r", "o", "h", "s", "u", "l", "c", "d", "m", "g", "p", "b", "f", "vw", "yz", "jkqx",
          "àáâãäåæ", "çèéêëÈÉÊË", "ìíîïñòóôõöøÑÓÖ", "")
# Words of a shard above which shards are made by more counts; larger vocabularies have larger shards.
SHARD = 4096
SHARES = 1000
# Pairs of queries and words that are compared without going further down the trie.
LEAF = 2048
# Words that one task counts before it hands them on; code points of a text that are split at a time.
HELD = 200_000
CHUNK = 4 << 20
# Longest word that is compared in a matrix.
WIDE = 64


def runs(text: str, least: int = LEAST_CHARS) -> Iterator[list[str]]:
    """Maximal runs of letters of at least ``least``, with A-Z in lower case; long texts in parts."""
    word, gap = re.compile(f"{RUN}{{{least},}}"), re.compile(RUN.replace("[", "[^"))
    text, at = text.encode().lower().decode(), 0
    while at < len(text):
        end = gap.search(text, at + CHUNK) if len(text) - at > CHUNK else None
        stop = end.start() if end else len(text)
        yield word.findall(text[at:stop])
        at = stop


def word_counts(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT,
                spelt: Callable[[int | None], Callable[[str], str]] | None = None) -> DataFrame:
    """word and n of all words of ``docs(doc_id, text)`` that are long and frequent enough.

    ``spelt`` makes, of a doc_id, a function from a run of letters to the word it counts as. It may
    shorten a run, not lengthen it. Null texts have no words; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found: Counter[str] = Counter()
                for some in runs(text.as_py() or "", least_chars):
                    found.update(some)
                change = spelt(doc_id) if spelt else str
                for word, n in found.items():
                    held[change(word)] += n
                if len(held) > HELD:
                    yield out()
            release()
        yield out()

    each = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where((F.col("n") >= least_count) & (F.length("word") >= least_chars))


def vectors(words: list[bytes]) -> np.ndarray:
    """Counts of the letters of each group for words in Latin-1."""
    group = np.full(256, len(GROUPS) - 1, np.int64)
    for k, letters in enumerate(GROUPS):
        group[np.frombuffer(letters.encode("latin-1"), np.uint8)] = k
    lengths = np.array([len(w) for w in words], np.int64)
    at = np.repeat(np.arange(len(words)) * len(GROUPS), lengths) + group[np.frombuffer(b"".join(words), np.uint8)]
    return np.bincount(at, minlength=len(words) * len(GROUPS)).reshape(-1, len(GROUPS)).astype(np.int32)


def shard_keys(counts: np.ndarray) -> np.ndarray:
    """A key of the counts of each row, 32 bits a count."""
    return np.ascontiguousarray(counts.astype(">u4")).view(f"S{4 * counts.shape[1]}").ravel() if len(counts) else np.empty(0, "S4")


def _keys_array(counts: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(counts.astype(">u4")).tobytes()
    return pa.Array.from_buffers(pa.binary(4 * counts.shape[1]), len(counts), [None, pa.py_buffer(raw)]).cast(pa.binary())


def sent(words: DataFrame, depth: int) -> DataFrame:
    """Rows shard, kind, word, n: words to be found (kind -1) and queries (what they have spent: 0, 1 or 2)."""
    moves = [(0, np.zeros(depth, np.int32))]
    for i in range(depth):
        more = np.zeros(depth, np.int32)
        more[i] = 1
        moves.append((1, more))
        for j in range(i + 1, depth):
            both = more.copy()
            both[j] = -1
            moves.append((2, both))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                counts = vectors([w.encode("latin-1") for w in batch.column(0).to_pylist()])[:, :depth]
                for kind, move in [(-1, moves[0][1]), *moves]:
                    there = counts + move
                    real = np.flatnonzero((there >= 0).all(axis=1))
                    yield pa.RecordBatch.from_arrays([_keys_array(there[real]), pa.array(np.full(len(real), kind, np.int32)), batch.column(0).take(pa.array(real)), batch.column(1).take(pa.array(real))],
                                                     names=["shard", "kind", "word", "n"])
    return words.select("word", "n").mapInArrow(run, "shard binary, kind int, word string, n long")


def _fits(diff: np.ndarray, spent: int) -> np.ndarray:
    """Which differences of counts (word less query, last axis) can be paid by what is left."""
    more, less = (diff == 1).sum(-1), (diff == -1).sum(-1)
    plain = (np.abs(diff) <= 1).all(-1)
    if spent == 2:
        return plain & (more == 0) & (less == 0)
    if spent == 1:
        return plain & (more == 0) & (less <= 1)
    ordered = (diff == 1).argmax(-1) < (diff == -1).argmax(-1)
    return plain & (((more == 0) & (less == 0)) | ((more == 1) & ((less == 0) | ((less == 1) & ordered))))


def candidates(counts: np.ndarray, asked: np.ndarray, spent: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of queries and of words whose counts from ``level`` on can be paid. Rows of ``counts`` are in order."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    stack = [(level, 0, len(counts), tuple(np.flatnonzero(spent == s) for s in range(3)))]
    while stack:
        level, low, high, sets = stack.pop()
        n = sum(map(len, sets))
        if not n or low == high:
            continue
        if level == counts.shape[1]:
            for some in sets:
                found.append((np.repeat(some, high - low), np.tile(np.arange(low, high), len(some))))
            continue
        if n * (high - low) <= LEAF:
            for s, some in enumerate(sets):
                if len(some):
                    q, w = np.nonzero(_fits(counts[None, low:high, level:] - asked[some][:, None, level:], s))
                    found.append((some[q], w + low))
            continue
        column = counts[low:high, level]
        edges = np.append(np.flatnonzero(np.diff(column, prepend=-1)), high - low)
        own = [asked[some, level] for some in sets]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            c = column[a]
            same = [some[o == c] for some, o in zip(sets, own, strict=True)]
            stack.append((level + 1, low + a, low + b, (same[0], np.concatenate([same[1], sets[0][own[0] == c - 1]]), np.concatenate([same[2], sets[1][own[1] == c + 1]]))))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _matrix(words: list[bytes]) -> np.ndarray:
    """Words of at most WIDE letters, left-aligned and padded."""
    return np.array([w if len(w) <= WIDE else b"" for w in words], f"S{WIDE}").view(np.uint8).reshape(-1, WIDE)


def near(query: bytes, word: bytes) -> bool:
    """Whether exactly one inserted, deleted or replaced letter parts two words."""
    short, long = sorted((query, word), key=len)
    if len(long) - len(short) > 1 or short == long:
        return False
    k = next((i for i, (a, b) in enumerate(zip(short, long)) if a != b), len(short))  # noqa: B905  one is longer
    return short[k + (len(short) == len(long)):] == long[k + 1:]


def verified(queries: list[bytes], words: list[bytes], q: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Which candidates are one edit apart; equal counts are looked at from the smaller word."""
    a, b = _matrix(queries), _matrix(words)
    la, lb = np.array([len(x) for x in queries]), np.array([len(x) for x in words])
    keep = np.zeros(len(q), bool)
    for at in range(0, len(q), 1 << 15):
        i, j = q[at:at + (1 << 15)], w[at:at + (1 << 15)]
        same = a[i] == b[j]
        first = np.where(same.all(1), WIDE, same.argmin(1))
        replaced = (la[i] == lb[j]) & ((~same).sum(1) == 1)
        after = np.arange(WIDE - 1) >= first[:, None]
        inserted = (lb[j] == la[i] + 1) & ~((a[i][:, :-1] != b[j][:, 1:]) & after).any(1)
        keep[at:at + (1 << 15)] = replaced | inserted
    for k in np.flatnonzero((la[q] > WIDE) | (lb[w] > WIDE)).tolist():
        keep[k] = near(queries[q[k]], words[w[k]])
    return keep


def pairs(words: DataFrame, total: int) -> DataFrame:
    """Near words: word, other, n_other, one row in each direction, of ``words(word, n)`` (a written table)."""
    limit, depth = max(SHARD, total // SHARES), 2
    while depth < len(GROUPS) - 1:
        largest = sent(words, depth).where("kind = -1").groupBy("shard").count().agg(F.max("count")).first()[0] or 0
        if largest <= limit:
            break
        depth += 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # the last shard so far: it may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([batch] if kept is None else [kept, batch])
            if not table.num_rows:
                continue
            table = table.combine_chunks()
            shards = table.column(0).combine_chunks().dictionary_encode().indices.to_numpy()
            edges = np.append(np.flatnonzero(np.diff(shards, prepend=-1)), len(shards)).tolist()
            for a, b in zip(edges[:-2], edges[1:-1], strict=True):
                yield from _searched(table.slice(a, b - a), depth)
            kept = table.slice(edges[-2]).combine_chunks().to_batches()[0]
        if kept is not None:
            yield from _searched(pa.Table.from_batches([kept]), depth)
            release()

    found = sent(words, depth).repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(run, "word string, n long, other string, n_other long")
    return found.select("word", "other", "n_other").unionByName(found.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("n_other")))


def _searched(shard: pa.Table, depth: int) -> Iterator[pa.RecordBatch]:
    kind, n = (shard.column(c).to_numpy() for c in ("kind", "n"))
    members = int((kind == -1).sum())
    if not members or members == len(kind):
        return
    names = [w.encode("latin-1") for w in shard.column("word").to_pylist()]
    counts = vectors(names)
    order = np.lexsort(counts[:members, ::-1].T)
    words, asked = [names[k] for k in order.tolist()], names[members:]
    q, w = candidates(counts[:members][order], counts[members:], kind[members:], depth)
    good = verified(asked, words, q, w)
    q, w = q[good], w[good]
    # replaced within one group: both words ask for each other
    once = np.fromiter((len(asked[i]) != len(words[j]) or asked[i] < words[j] for i, j in zip(q.tolist(), w.tolist(), strict=True)), bool, len(q)) \
        | (counts[members:][q] != counts[:members][order][w]).any(1)
    q, w = q[once], w[once]
    column = shard.column("word").combine_chunks()
    yield pa.RecordBatch.from_arrays([column.take(pa.array(q + members)), pa.array(n[members:][q]), column.take(pa.array(order[w])), pa.array(n[:members][order][w])],
                                     names=["word", "n", "other", "n_other"])


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of each of the different ``words(word, n)``.

    n_near counts the words one edit away. The form is the most frequent of them (of equal ones the
    smallest), if it is at least ``ratio`` times as frequent, else null; root is where forms lead
    to. Words are in Latin-1 letters; no words give no rows.
    """
    words, total = cut_measuring(words.select("word", "n"), F.count("*"))
    best = pairs(words, total).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_other")).alias("m"), "other")).alias("best"))
    known = cut(words.join(best, "word", "left").withColumn("formed", -F.col("best.m") >= ratio * F.col("n")).select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("formed"), F.col("best.other")).alias("form"), F.when(F.col("formed"), -F.col("best.m")).alias("form_n")))
    # forms are ever more frequent, so a chain is short; each round doubles the step
    hooks, moved = cut(known.where("form is not null").select("word", F.col("form").alias("root"))), 1
    while moved:
        above = hooks.select(F.col("word").alias("root"), F.col("root").alias("_up"))
        hooks, moved = cut_measuring(hooks.join(above, "root", "left").select("word", F.coalesce("_up", "root").alias("root"), F.col("_up").isNotNull().cast("long").alias("_moved")), F.sum("_moved"))
        hooks = hooks.drop("_moved")
    return known.join(hooks, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
