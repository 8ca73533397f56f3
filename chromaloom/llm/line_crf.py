"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad. Its features are shares of character classes, lengths and repetition,
of the line itself and of its neighbours. The forward-backward marginals of the lines, weighted by
their lengths, are the quality of the document. Training reads a bounded sample of labelled
documents, whose lines take the label of the document; scoring reads whole texts, those of very
many lines in runs, so that beside the text a few numbers a line are held.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .support import by_batch, cut, release
from .tokens import slices

# Labelled documents of each label that the model is fitted on, at most.
SAMPLE = 1500
# A document is predicted good from this score on.
THRESHOLD = 0.3
# Classes of bytes: spaces, lower case, upper case, digits, full stops and commas, exclamation marks, bars,
# symbols, other signs, bytes of other scripts, and the line break.
CLASSES = (b" \t\r\x0b\x0c", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b".,", b"!?", b"|", b"#*$%&<>@~^=+_\\/{}[]", b"\n")
N_CLASSES = len(CLASSES) + 2
STEP = 1 << 20
ROUNDS = 250
# Lines of a text above which it is scored in runs of as many lines.
RUN = 10_000
RATE = 0.05
DECAY = 1e-3


def _byte_classes() -> np.ndarray:
    out = np.full(256, len(CLASSES), np.uint8)
    out[128:] = len(CLASSES) + 1
    for k, letters in enumerate(CLASSES):
        out[list(letters)] = k
    return out


BYTE_CLASS = _byte_classes()
SIGNS = np.isin(BYTE_CLASS, [4, 5, 6, 7, 9])


def word_features(texts: list[str], known: set[int] | None = None) -> np.ndarray:
    """Per line: share of words equal to the one before, share of different words, and whether the text had the line before.

    ``known`` holds hashes of the lines before, if the texts are runs of one; they are added to it.
    """
    out = []
    for text in texts:
        seen = set() if known is None else known
        for line in text.split("\n"):
            words = line.split()
            n, mark = len(words) or 1, hash(line)
            out.append((sum(map(eq, words, words[1:])) / n, len(set(words)) / n, mark in seen and bool(words)))
            seen.add(mark)
    return np.array(out, float).reshape(-1, 3)


def own_features(texts: list[str], known: set[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the lines of texts by themselves, one after another, their lengths in bytes, and lines per text.

    Lines are split at line breaks; a text has one line at least. Bytes are counted in runs of
    bounded size, so a text of any length takes memory for its lines only.
    """
    data = np.frombuffer("\n".join(texts).encode() + b"\n", np.uint8)
    n_lines = np.array([t.count("\n") + 1 for t in texts])
    total = int(n_lines.sum())
    counts, doubled, line = np.zeros(total * N_CLASSES), np.zeros(total), 0
    ends = np.empty(total, np.int64)
    for at in range(0, len(data), STEP):
        block = data[at:at + STEP]
        breaks = block == 10
        of = line + np.cumsum(breaks) - breaks
        ends[of[breaks]] = at + np.flatnonzero(breaks)
        low, high = int(of[0]), int(of[-1]) + 1
        counts[low * N_CLASSES:high * N_CLASSES] += np.bincount((of - low) * N_CLASSES + BYTE_CLASS[block], minlength=(high - low) * N_CLASSES)
        after = data[at + 1:at + STEP + 1]
        pair = block[:len(after)]
        same = (pair == after) & SIGNS[pair]
        doubled[low:high] += np.bincount(of[:len(after)][same] - low, minlength=high - low)
        line += int(breaks.sum())
    counts = counts.reshape(total, N_CLASSES)
    counts = np.delete(counts, 8, axis=1)  # each line has one break
    lengths = np.diff(ends, prepend=-1) - 1
    some = np.maximum(lengths, 1)[:, None]
    words = counts[:, 0] + 1
    own = np.column_stack([counts / some, doubled / some[:, 0], np.log1p(lengths), np.minimum(lengths / words, 40) / 10,
                           np.minimum(counts[:, 4] / words, 2), np.minimum((counts[:, 5] + counts[:, 6] + counts[:, 7] + counts[:, 8]) / words, 4), lengths == 0])
    return np.column_stack([own, word_features(texts, known)]), lengths, n_lines


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the lines of texts and of their neighbours, their lengths in bytes, and lines per text."""
    own, lengths, n_lines = own_features(texts)
    # neighbours within the text; lines beyond its ends are all zero
    firsts = np.cumsum(n_lines) - n_lines
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[firsts] = 0
    after[firsts + n_lines - 1] = 0
    return np.column_stack([own, before, after, np.ones(len(own))]).astype(np.float32), lengths, n_lines


def runs_of(text: str, lines: int) -> Iterator[str]:
    """A text in runs of ``lines`` lines, without the breaks between them."""
    at = 0
    while True:
        end = at - 1
        for _ in range(lines):
            end = text.find("\n", end + 1)
            if end < 0:
                yield text[at:]
                return
        yield text[at:end]
        at = end + 1


@dataclass
class Crf:
    """Weights of the good state, transition scores [from, to], start scores, feature scaling, and the exponent of scores."""

    weights: np.ndarray
    moves: np.ndarray
    starts: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    power: float = 1.0

    def states(self, features: np.ndarray) -> np.ndarray:
        good = ((features - self.mean) / self.scale) @ self.weights
        return np.column_stack([np.zeros_like(good), good])

    def _good_lines(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Score of the good state, and length, of each line of a text, from one run of lines at a time."""
        known: set[int] = set()
        found, sizes, held, last = [], [], None, None

        def scored(own: np.ndarray, first: np.ndarray | None, then: np.ndarray | None) -> np.ndarray:
            none = np.zeros((1, own.shape[1]))
            before = np.concatenate([none if first is None else first, own[:-1]])
            after = np.concatenate([own[1:], none if then is None else then])
            return self.states(np.column_stack([own, before, after, np.ones(len(own))]).astype(np.float32))[:, 1]

        for run in runs_of(text, RUN):
            own, lengths, _ = own_features([run], known)
            if held is not None:
                found.append(scored(held, last, own[:1]))
                last = held[-1:]
            held = own
            sizes.append(lengths)
        found.append(scored(held, last, None))
        return np.concatenate(found), np.concatenate(sizes)

    def _score_long(self, text: str) -> float:
        """Quality of a text of many lines. With two states a pass holds one number a line: the odds of good."""
        good, lengths = self._good_lines(text)
        (a, b), (c, d) = np.exp(self.moves - self.moves.max()).tolist()  # from bad to bad, to good; from good to bad, to good
        emit = np.exp(np.clip(good, -300, 300)).tolist()
        forward, f = [], emit[0] * float(np.exp(np.clip(self.starts[1] - self.starts[0], -300, 300)))
        forward.append(f)
        for e in emit[1:]:
            f = min(max(e * (b + d * f) / (a + c * f), 1e-300), 1e300) if f < 1e200 else e * d / c if c else 1e300
            forward.append(f)
        total, s, weights = 0.0, 1.0, (lengths + 1.0).tolist()
        for t in range(len(emit) - 1, -1, -1):
            odds = forward[t] * s
            total += weights[t] * (odds / (1 + odds) if odds < 1e300 else 1.0)
            es = emit[t] * s
            s = (c + d * es) / (a + b * es) if es < 1e200 else d / b if b else 1e300
        return min(max(total / sum(weights), 0.0), 1.0) ** self.power

    def score(self, texts: list[str]) -> np.ndarray:
        """Quality of each text, from 0 to 1."""
        long = np.array([t.count("\n") >= RUN for t in texts], bool)
        if long.any():
            out = np.empty(len(texts))
            out[long] = [self._score_long(t) for t, x in zip(texts, long, strict=True) if x]
            if not long.all():
                out[~long] = self.score([t for t, x in zip(texts, long, strict=True) if not x])
            return out
        features, lengths, n_lines = line_features(texts)
        good = marginals(self.states(features), n_lines, self.moves, self.starts)[0][:, 1]
        weights = lengths + 1.0
        firsts = np.cumsum(n_lines) - n_lines
        return (np.add.reduceat(good * weights, firsts) / np.add.reduceat(weights, firsts)).clip(0, 1) ** self.power


def marginals(states: np.ndarray, n_lines: np.ndarray, moves: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of each line, expected moves between neighbours, and the log normaliser of all texts.

    Texts are taken in order of length and walked together, line by line.
    """
    order = np.argsort(-n_lines, kind="stable")
    firsts, counts = (np.cumsum(n_lines) - n_lines)[order], n_lines[order]
    depth = int(counts[0])
    active = np.searchsorted(-counts, -np.arange(depth), "left")  # texts with more than t lines
    emit, step = np.exp(states - states.max(axis=1, keepdims=True)), np.exp(moves)
    forward, norm = np.empty_like(emit), np.empty(len(states))
    f = emit[firsts] * np.exp(starts)
    for t in range(depth):
        at = firsts[:active[t]] + t
        if t:
            f = (f[:active[t]] @ step) * emit[at]
        z = f.sum(axis=1)
        f = f / z[:, None]
        forward[at], norm[at] = f, z
    backward = np.ones_like(emit)
    pairs = np.zeros((2, 2))
    for t in range(depth - 1, 0, -1):
        at = firsts[:active[t]] + t
        b = backward[at] * emit[at] / norm[at][:, None]
        backward[at - 1] = b @ step.T
        pairs += step * (forward[at - 1].T @ b)
    both = forward * backward
    return both / both.sum(axis=1, keepdims=True), pairs, float(np.log(norm).sum() + states.max(axis=1).sum())


def train(texts: list[str], labels: np.ndarray, rounds: int = ROUNDS) -> Crf:
    """Fit by gradient ascent on the likelihood of line labels, each class of texts with equal weight."""
    parts = [line_features(texts[k:k + 200]) for k in range(0, len(texts), 200)]
    features, lengths, n_lines = (np.concatenate(x) for x in zip(*parts, strict=True))
    mean, scale = features.mean(axis=0), features.std(axis=0)
    mean[-1], scale[scale < 1e-6] = 0, 1
    x = (features - mean) / scale
    y = np.repeat(labels, n_lines).astype(int)
    target = np.zeros((len(y), 2))
    target[np.arange(len(y)), y] = 1
    firsts = np.cumsum(n_lines) - n_lines
    inner = np.delete(np.arange(len(y)), firsts)
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (y[inner - 1], y[inner]), 1)
    begins = np.bincount(y[firsts], minlength=2)
    model = Crf(np.zeros(x.shape[1], np.float32), np.zeros((2, 2)), np.zeros(2), mean, scale)
    values = [model.weights, model.moves, model.starts]
    moments = [(np.zeros_like(v, float), np.zeros_like(v, float)) for v in values]
    for k in range(1, rounds + 1):
        own, moved, _ = marginals(np.column_stack([np.zeros(len(x)), x @ model.weights]), n_lines, model.moves, model.starts)
        slopes = [x.T @ (target - own)[:, 1] / len(y) - DECAY * model.weights, (pairs - moved) / len(y) - DECAY * model.moves,
                  (begins - own[firsts].sum(axis=0)) / len(firsts) - DECAY * model.starts]
        for v, g, (m, s) in zip(values, slopes, moments, strict=True):
            m[:] = 0.9 * m + 0.1 * g
            s[:] = 0.99 * s + 0.01 * g * g
            v += RATE * (m / (1 - 0.9 ** k)) / (np.sqrt(s / (1 - 0.99 ** k)) + 1e-8)
    # a power of the score puts the best cut of the training scores at the threshold
    found = np.concatenate([model.score(texts[k:k + 200]) for k in range(0, len(texts), 200)])
    cut_at = best_cut(found, labels)
    model.power = float(np.log(THRESHOLD) / np.log(cut_at))
    return model


def best_cut(scores: np.ndarray, labels: np.ndarray) -> float:
    """Middle of the widest range of cuts with the fewest errors, errors of both labels weighing alike."""
    points = np.unique(np.concatenate([[0.02, 0.98], scores.clip(0.02, 0.98)]))
    cuts = (points[1:] + points[:-1]) / 2
    good, bad = np.sort(scores[labels == 1]), np.sort(scores[labels == 0])
    lost = np.searchsorted(good, cuts) / max(len(good), 1) + 1 - np.searchsorted(bad, cuts) / max(len(bad), 1)
    least = np.flatnonzero(lost <= lost.min() + 1e-12)
    widest = least[np.argmax((points[1:] - points[:-1])[least])]
    return float(cuts[widest])


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are never learnt from: crc32 of the id as text is a multiple of 5. A null id is."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Crf:
    """Model of ``labels(doc_id, quality)`` over ``docs(doc_id, text)``.

    Of each label the ``sample`` ids that hash lowest are learnt from, without held-out ids; their
    texts come to the driver, whatever the size of the tables; its memory holds the texts of so many
    documents, however long they are. Null labels and ids are left out; a
    document labelled more than once counts once. Without documents of both labels the model says
    1 for every text.
    """
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("quality in (0, 1) and doc_id is not null").where(~held_out())
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [usable.where(F.col("quality") == q).groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(*order).limit(sample) for q in (0, 1)]
    ids = cut(chosen[0].unionByName(chosen[1]).groupBy("doc_id").agg(F.max("quality").alias("quality")))
    # ids is bounded by the sample; a repeated document counts once, by its smallest text
    rows = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "quality")
            .agg(F.min(F.coalesce("text", F.lit(""))).alias("text")).orderBy("doc_id").collect())
    marks = np.array([r["quality"] for r in rows], int)
    if len(set(marks.tolist())) < 2:
        texts, marks = ["a", "a"], np.array([0, 1])
        model = train(texts, marks, 1)
        model.starts[:] = [0.0, 60.0]
        model.moves[:] = [[0, 60], [0, 60]]
        model.power = 1.0
        return model
    return train([r["text"] for r in rows], marks)


def scores(docs: DataFrame, model: Crf, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score and predicted (1 from ``threshold`` on) of each row of ``docs(doc_id, text)``.

    Null text is an empty text, which is one empty line; null and repeated doc_ids are rows like
    others; an empty table gives no rows; other columns are not read.
    """
    def task():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [model.score([t or "" for t in some.to_pylist()]) for some in slices(batch.column(1), 4 << 20)]
            score = np.concatenate(found)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                              names=["doc_id", "score", "predicted"])
        return one
    return by_batch(docs.select("doc_id", "text"), "doc_id long, score double, predicted int", task)


def good_documents(docs: DataFrame, model: Crf, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` predicted good, with all their columns and no other."""
    schema = docs.schema
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for some in slices(batch.column(at), 4 << 20):
                score = model.score([t or "" for t in some.to_pylist()])
                yield batch.slice(done, len(some)).filter(pa.array(score >= threshold))
                done += len(some)
            release()
    return docs.mapInArrow(run, schema)
