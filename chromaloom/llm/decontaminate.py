"""Benchmark passages in documents, found by a generalised suffix automaton of the test items.

The automaton accepts every run of words of every item. A document's words are streamed through
it; the state and the length of the longest match that ends at a word tell which windows of items
end there. A window is ``WINDOW`` consecutive words of an item, or the whole of an item that has
fewer. Words inside an occurrence of a window are hit; spans of hit words can be removed, and
documents dropped whose share of hit words is over a limit.

Words are runs of letters and digits of ASCII, in lower case, and of any other characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import by_batch, cut, cut_measuring

WINDOW = 10
# Words of the items of one automaton, which takes about 0.5 KB a word. A larger set of items is
# dealt to several automata, one after another.
MOST_WORDS = 200_000
# Bytes of a text that are split into words at a time.
CHUNK = 4 << 20
# Share of hit words above which a document is dropped.
MOST_SHARE = 0.5

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SPACED = bytes(b if WORD.match(bytes([b])) else 32 for b in bytes(range(256)).lower())


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(SPACED).split()


class Automaton:
    """Suffix automaton of lists of words, with the windows that end in each of its states."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.numbers: dict[bytes, int] = {}
        self.length, self.link, self.step = [0], [-1], [{}]
        coded = [(name, [self.numbers.setdefault(w, len(self.numbers)) for w in words]) for name, words in items if words]
        for _, words in coded:
            last = 0
            for w in words:
                last = self._extend(last, w)
        # longest first link upwards: the state of the last ``window`` words of any state's words
        self.whole = [0] * len(self.length)
        for v in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            if self.length[v] >= window:
                self.whole[v] = v if self.length[self.link[v]] < window else self.whole[self.link[v]]
        self.named: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        self.least = min((min(len(words), window) for _, words in coded), default=window)
        for name, words in coded:
            v = 0
            for n, w in enumerate(words, 1):
                v = self.step[v][w]
                if n >= window:
                    self.named.setdefault(self.whole[v], set()).add(name)
            if len(words) < window:
                self.short.setdefault(v, []).append((len(words), name))

    def _extend(self, last: int, w: int) -> int:
        length, link, step = self.length, self.link, self.step

        def split(p: int, q: int) -> int:
            """The state of the words of p and then w, parted from the longer ones of q."""
            if length[q] == length[p] + 1:
                return q
            new = self._state(length[p] + 1, link[q], dict(step[q]))
            while p >= 0 and step[p].get(w) == q:
                step[p][w] = new
                p = link[p]
            link[q] = new
            return new

        if w in step[last]:
            return split(last, step[last][w])
        new = self._state(length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in step[p]:
            step[p][w] = new
            p = link[p]
        if p >= 0:
            link[new] = split(p, step[p][w])
        return new

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        return len(self.length) - 1

    def numbered(self, text: str) -> np.ndarray:
        """The number of each word of a text, -1 for words of no item."""
        plain, parts, at = text.encode().translate(SPACED), [], 0
        while at < len(plain):
            end = len(plain) if len(plain) - at <= CHUNK else plain.rfind(b" ", at, at + CHUNK) + 1 or len(plain)
            if end <= at:
                end = plain.find(b" ", at) + 1 or len(plain)
            found = plain[at:end].split()
            parts.append(np.fromiter(map(self.numbers.get, found, repeat(-1)), np.int32, len(found)))
            at = end
        return np.concatenate(parts) if parts else np.empty(0, np.int32)

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, set[str]]:
        """Which of the words are hit, and the items whose windows occur."""
        edges = np.zeros(len(numbers) + 1, np.int32)
        names: set[str] = set()
        known = np.diff(np.concatenate([[0], (numbers >= 0).view(np.int8), [0]]))
        starts, ends = np.flatnonzero(known == 1), np.flatnonzero(known == -1)
        long = ends - starts >= self.least  # a match lies within a run of words of the items
        for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            for end, n, state in self._matches(numbers[a:b].tolist()):
                edges[a + end - n] += 1
                edges[a + end] -= 1
                names |= self.named[state] if n == self.window else {name for k, name in self.short[state] if k == n}
        return np.cumsum(edges[:-1]) > 0, names

    def _matches(self, words: list[int]) -> Iterator[tuple[int, int, int]]:
        """End, length and state of each occurrence of a window."""
        step, link, length, window = self.step, self.link, self.length, self.window
        v = n = 0
        for end, w in enumerate(words, 1):
            while v and w not in step[v]:
                v = link[v]
                n = length[v]
            if w in step[v]:
                v = step[v][w]
                n += 1
            if n >= window:
                yield end, window, self.whole[v]
            if self.short:
                up = v
                while up > 0:
                    for k in {k for k, _ in self.short.get(up, ()) if k <= n}:
                        yield end, k, up
                    up = link[up]


def automata(items: DataFrame, window: int = WINDOW, most: int = MOST_WORDS) -> list[Broadcast]:
    """Automata of ``items(item_id, text)``, each of about ``most`` words of text and broadcast.

    Words are counted first and no more than one automaton's items are collected at a time. A
    null item_id is named "null"; items that share an id are one item with several texts; null
    texts have no words.
    """
    spark = items.sparkSession
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    table, total = cut_measuring(rows.withColumn("n", F.size(F.split("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))), F.sum("n"))
    groups = max(-(-(total or 0) // most), 1)
    dealt = table.withColumn("part", F.pmod(F.xxhash64("name", "text"), F.lit(groups)))
    return [spark.sparkContext.broadcast(Automaton([(r.name, words_of(r.text)) for r in dealt.where(F.col("part") == g).select("name", "text").collect()], window))
            for g in range(groups)]


def _spans(hit: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    return [{"first": a, "length": b - a} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]


def _texts(column: pa.Array) -> Iterator[str]:
    for value in column:
        yield value.as_py() or ""


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, most: int = MOST_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, spans (runs of hit words: first from 0, length) and items (sorted names).

    One row per row of ``docs(doc_id, text)``, repeated rows and null ids included; null and empty
    texts have no words; other columns are not read. An empty table of items hits nothing.
    """
    schema = "doc_id long, n_words long, n_hit long, spans array<struct<first: long, length: long>>, items array<string>"
    arrow = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                       ("spans", pa.list_(pa.struct([("first", pa.int64()), ("length", pa.int64())]))), ("items", pa.list_(pa.string()))])

    def task(automaton: Broadcast, last: bool):
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for k, text in enumerate(_texts(batch.column(1))):
                numbers = automaton.value.numbered(text)
                hit, names = automaton.value.hits(numbers)
                if batch.num_columns > 2:  # what earlier automata have found
                    for s in batch.column(2)[k].as_py():
                        hit[s["first"]:s["first"] + s["length"]] = True
                    names |= set(batch.column(3)[k].as_py())
                rows.append((len(numbers), int(hit.sum()), _spans(hit), sorted(names)))
            columns = list(zip(*rows, strict=True))
            found = [pa.array(c, t) for c, t in zip(columns, arrow.types[1:], strict=True)]
            return pa.RecordBatch.from_arrays([batch.column(0), *found] + ([] if last else [batch.column(1)]), names=[*arrow.names, *([] if last else ["text"])])
        return one

    rows, built = docs.select("doc_id", "text"), automata(items, window, most)
    for k, automaton in enumerate(built):
        last = k + 1 == len(built)
        rows = by_batch(rows, schema if last else schema + ", text string", lambda a=automaton, end=last: task(a, end))
        if not last:  # one automaton at a time in a task
            rows = cut(rows).select("doc_id", "text", "spans", "items")
    return rows


def cleaned(docs: DataFrame, items: DataFrame, window: int = WINDOW, most_share: float = MOST_SHARE, most: int = MOST_WORDS) -> DataFrame:
    """``docs`` without the hit spans in their texts, and without documents that have more than ``most_share`` hit words.

    A span goes from the start of its first word to the end of its last. All columns are kept and
    none is added; texts without hits stay as they are, null ones null.
    """
    at, built = docs.columns.index("text"), automata(items, window, most)

    def task(automaton: Broadcast):
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, keep = [], []
            for value in batch.column(at):
                text = value.as_py()
                hit, _ = automaton.value.hits(automaton.value.numbered(text or ""))
                keep.append(hit.sum() <= most_share * len(hit))
                texts.append(without_spans(text, hit) if hit.any() and keep[-1] else text)
            columns = [pa.array(texts, f.type) if k == at else batch.column(k) for k, f in enumerate(batch.schema)]
            return pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(keep))
        return one

    for k, automaton in enumerate(built):
        docs = by_batch(docs, docs.schema, lambda a=automaton: task(a))
        docs = cut(docs) if k + 1 < len(built) else docs
    return docs


def without_spans(text: str, hit: np.ndarray) -> str:
    raw = text.encode()
    bounds = [m.span() for m in WORD.finditer(raw.lower())]
    ends = [0]
    for s in _spans(hit):
        ends += [bounds[s["first"]][0], bounds[s["first"] + s["length"] - 1][1]]
    ends.append(len(raw))
    return b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)).decode()
