"""Prefix trie, spelling variants and decontamination against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from chromaloom.llm import decontaminate, prefix_trie, queries, spellings
from test_operators import LONG, ODD, empty, frame

TURNS = "conv_id long, turn long, role string, text string"


# prefix trie

def brute_trie(conversations):
    """Rows of the trie of {conv_id: [(role, text), ...]}."""
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = Counter(path[:-1] for path in members if path)
    leaves, saved = Counter(), Counter()
    for path, ids in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += (len(ids) - 1) * len(path[-1][1]) if path else 0
    rows = []
    for path, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(conversations[c]) == len(path))
        rows.append((min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids), kids[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(rows)


def collected(df):
    return Counter(tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


@pytest.mark.parametrize("width", [1, 3, 6])
def test_trie(spark, width, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 4)
    rng = random.Random(width)
    shared = [("user", "ab"), ("assistant", "xyz")] * 6  # copies of several blocks
    convs = {c: [(rng.choice(["user", "assistant"]), rng.choice(["", "a", "bb"])) for _ in range(rng.randrange(0, 6))] for c in range(-3, 40)}
    convs |= {50 + k: shared for k in range(9)} | {60: shared[:7] + [("user", "q")] * 6, 61: shared[:7]} | {70: [("user", f"t{k}") for k in range(40)]}
    rows = [(c, k, r, t) for c, turns in convs.items() for k, (r, t) in enumerate(turns)]
    turns = spark.createDataFrame(rows, "conv_id long, pos long, role string, text string").withColumns({c: F.lit("x") for c in ("up", "path", "n_convs", "level", "first", "tid")})
    got = prefix_trie.nodes(turns, spark.createDataFrame([(c,) for c in [*convs, None, 0]], "conv_id long"), width)
    assert collected(got) == brute_trie(convs)


def test_trie_rows(spark):
    rows = [(1, None, None, "b"), (1, 0, "user", None), (1, 0, "user", None), (2, 5, "", "b"), (2, 6, "user", ""), (None, 1, "user", "x"), (3, 1, "a:b", "c"), (4, 1, "a", "b:c"), (5, 0, "user", LONG)]
    placed = prefix_trie.placed(spark.createDataFrame(rows, TURNS).withColumn("pos", F.lit("x")))
    assert {(r.conv_id, r.pos) for r in placed.collect()} == {(1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (3, 0), (4, 0), (5, 0)}
    want = {1: [("", "b"), ("user", ""), ("user", "")], 2: [("", "b"), ("user", "")], 3: [("a:b", "c")], 4: [("a", "b:c")], 5: [("user", LONG)]}
    assert collected(prefix_trie.nodes(placed, placed)) == brute_trie(want)
    none = placed.where("false")
    assert prefix_trie.nodes(none, none).count() == 0
    assert collected(prefix_trie.nodes(none, placed.select("conv_id"))) == brute_trie({c: [] for c in want})


def test_rebuilt_conversations(spark):
    rng = random.Random(3)
    convs = {c: [(rng.choice(["user", "assistant"]), f"{c}-{k}") for k in range(rng.randrange(1, 9))] for c in [*range(100, 140), *range(205, 230), *range(300, 330)]}
    rows = [(c, k, r, t) for c, turns in convs.items() for k, (r, t) in enumerate(turns)]
    placed = prefix_trie.placed(spark.createDataFrame(rows, TURNS))
    got = defaultdict(list)
    for r in queries.shared_starts(placed).collect():
        got[r.conv_id].append((r.pos, r.role, r.text))
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        want = convs.get(c - c % 100, [])[:h] + turns[h:]
        assert sorted(got[c]) == [(k, *t) for k, t in enumerate(want)]


# spelling variants

def brute_variants(counts, ratio=5):
    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(a) + 1 == len(b) and any(b[:k] + b[k + 1:] == a for k in range(len(b)))
    near = {w: [x for x in counts if x != w and one_edit(w, x)] for w in counts}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
    rows = []
    for w in counts:
        top = w
        while form[top]:
            top = form[top]
        rows.append((w, form[w], top, counts[w], len(near[w]), form[w] and counts[form[w]]))
    return Counter(rows)


@pytest.mark.parametrize(("shard", "leaf"), [(4096, 2048), (8, 1)])
def test_variants(spark, monkeypatch, shard, leaf):
    monkeypatch.setattr(spellings, "SHARD", shard)
    monkeypatch.setattr(spellings, "LEAF", leaf)
    rng = random.Random(shard)
    letters = "abeéÀvwz×"
    words = {"".join(rng.choice(letters[:3 + k % 7]) for _ in range(rng.choice([6, 6, 7, 8]))) for k in range(500)}
    words |= {"x" * k for k in (6, 7, 8, 70, 71, 73)} | {"y" * 69 + "z", "y" * 70, "y" * 70 + "z", "zzzéa" + "w" * 70}
    counts = {w: rng.choice([5, 6, 30, 150, 800]) for w in words}
    table = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    got = spellings.variants(table.withColumns({"root": F.lit("x"), "other": F.lit("y")})).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert Counter(map(tuple, got)) == brute_variants(counts)
    assert spellings.variants(table.where("false")).count() == 0


def test_word_counts(spark, monkeypatch):
    monkeypatch.setattr(spellings, "HELD", 3)
    monkeypatch.setattr(spellings, "CHUNK", 50)
    texts = [*ODD, (20, "Éclair ÉCLAIR éclair eclairs1eclairs Straße-straße"), (21, "abcdefgh " * 40), (22, "q" * 500)]
    want = Counter()
    for d, t in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            want[run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    got = spellings.word_counts(frame(spark, texts), 4, 2, queries.loses_letters).collect()
    assert {r.word: r.n for r in got} == {w: n for w, n in want.items() if len(w) >= 4 and n >= 2}
    assert spellings.word_counts(empty(spark)).count() == 0


# decontamination

def brute_hits(words, items, window):
    hit, names = [False] * len(words), set()
    for name, item in items:
        k = min(window, len(item))
        wins = {tuple(item[i:i + k]) for i in range(len(item) - k + 1)} if item else set()
        for i in range(len(words) - k + 1):
            if tuple(words[i:i + k]) in wins:
                hit[i:i + k] = [True] * k
                names.add(name)
    return hit, names


def test_automaton():
    rng = random.Random(4)
    for _ in range(400):
        letters, window = rng.choice([2, 3, 5]), rng.choice([1, 2, 3, 4, 6])
        items = [(str(k % 5), [b"w%d" % rng.randrange(letters) for _ in range(rng.randrange(12))]) for k in range(rng.randrange(7))]
        words = [b"w%d" % rng.randrange(letters + 1) for _ in range(rng.randrange(40))]
        made = decontaminate.Automaton(items, window)
        hit, names = made.hits(made.numbered(b" ".join(words).decode()))
        assert (hit.tolist(), names) == brute_hits(words, items, window)


ITEMS = [(7, "One two three FOUR five"), (10, "a b"), (10, "The quick, brown fox jumps over a lazy dog"), (2, None), (3, "--- !"), (None, "日本語の テキスト")]


@pytest.mark.parametrize("most", [200_000, 4])
def test_matches(spark, most, monkeypatch):
    monkeypatch.setattr(decontaminate, "CHUNK", 64)
    docs = [*ODD, (30, "x One, two\tTHREE four five y"), (31, "za b"), (32, "a b a b"), (33, "a-b")]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    split = [("null" if i is None else str(i), decontaminate.words_of(t or "")) for i, t in ITEMS]
    got = decontaminate.matches(frame(spark, docs), items, 4, most).collect()
    want = Counter()
    for d, t in docs:
        words = re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower())
        hit, names = brute_hits(words, split, 4)
        want[d, len(words), sum(hit), tuple(k for k, h in enumerate(hit) if h), tuple(sorted(names))] += 1
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(p for s in r.spans for p in range(s.first, s.first + s.length)), tuple(r["items"])) for r in got) == want
    assert decontaminate.matches(empty(spark), items).count() == 0
    assert all(r.n_hit == 0 for r in decontaminate.matches(frame(spark, docs), items.where("false")).collect())


def test_cleaned(spark):
    docs = [(1, "x One, two\tTHREE four five y z w v u t s"), (2, "one two three four"), (3, None), (4, "clean É")]
    df, items = frame(spark, docs), spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.cleaned(df, items, 4, 0.5)
    assert got.columns == df.columns
    assert {r.doc_id: r.text for r in got.collect()} == {1: "x  y z w v u t s", 3: None, 4: "clean É"}
    assert np.array_equal(sorted(r.doc_id for r in decontaminate.cleaned(df, items, 4, 0.5, 4).collect()), [1, 3, 4])
