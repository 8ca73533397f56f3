"""Operators of the subpackage against brute force, on small tables with awkward rows."""

import base64
import hashlib
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chromaloom.llm import (chat, host_rules, html_text, line_crf, orc_tokens, packing, queries, simhash, support, tokens, warc,
                            winnowing, word_bpe)

SF = "/root/testdata/sf0.001"
BYTES, WORDS = tokens.default_vocabulary(), word_bpe.default_vocabulary()
LONG = "the quick brown fox jumps over a lazy dog and runs away from it again " * 900
# null and empty texts, ties, repeated rows, control characters, special strings, a long text, another script
ODD = [(1, None), (2, ""), (3, "  two  spaces\n\n x "), (4, "a<|endoftext|>b <|endoftext|>"), (5, "same text here once more"),
       (6, "same text here once more"), (6, "same text here once more"), (None, "no id at all"), (8, LONG), (9, "日本語のテキスト 🙂 ÉÀ été"),
       (10, "\x1c \x85\xa0tab\tend"), (11, "   "), (12, "SAME text HERE once more"), (13, "it's we'll 12345 ²½ ª")]


def frame(spark, rows=ODD, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:  # columns that clash with names used inside
        df = df.withColumns({c: F.lit("x") for c in ("key", "_n", "fp", "component_id", "part", "row", "start", "score", "kept", "_text", "_words", "_host", "_hash")})
    return df.withColumn("source", F.lit("a"))


def empty(spark):
    return frame(spark, ODD[:1]).where("false")


def ids_of(path, text, end):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + end


# HTML

@pytest.mark.parametrize(("html", "text"), [
    ("<p>One<p>Two <b>bold</b>text<br>next<div>x</div>y", "One\n\nTwo boldtext\nnext\n\nx\ny"),
    ("<ul><li>a<li>b<ol start=3><li>c<li value=9>d</ol><li>e</ul>after", "- a\n- b\n  3. c\n  9. d\n- e\n\nafter"),
    ("<table><tr><th>Name<th>Qty<tr><td>apple<td>12<tr><td>kiwi fruit<td>3</table>", "Name        Qty\napple       12\nkiwi fruit  3"),
    ("<table><tfoot><tr><td>f<tbody><tr><td rowspan=2>A<td>b1<tr><td>b2</table>", "A  b1\n   b2\nf"),
    ("<pre>\n a\n   b</pre>x<i hidden>n</i><b style='visibility:hidden'>n<u style='visibility: visible'>y</u></b>", " a\n   b\n\nxy"),
    ("<title>t</title><script>var a='</p>'</script>body&amp;&nbsp;<style>p{}</style>text", "body& text"),
    ("<select><option>a<option selected>b</select><details><summary>S</summary>hidden</details>", "b\nS"),
    ("</i>a</p>b<![x y>c<!d>e<!-- f -->g", "a\n\nbceg"), ("", ""), ("<div>" * 3000 + "deep", "deep"), ("<script>never closed", ""),
    # text in tables outside of cells, forms between rows, drawings, hidden elements below the depth limit, unfinished parts
    ("<table><tbody>Foo<div>bar</div><tr><td>a</table>", "Foo\nbar\n\na"), ("<table><tbody><form><tr><td>x</td></tr></form></tbody></table>", "x"),
    ("<p>a<svg><title>t</title><text>lab</text></svg>b<math><mi>x</mi></math>", "a lab bx"), ("<font>" * 201 + "<script>var x=1</script>t", "t"),
    ("<div>" * 250 + "<script>var x=1</script>s<div hidden><div>no</div>no</div>t<div style='visibility:hidden'>n", "s\nt"),
    ("a<!-- x <b>y", "a"), ("a<b title='x>y", "a"), ("a <!--> b <!--->c", "a b c"), ("1 < 2 <3 </ x>&lt;b>", "1 < 2 <3 <b>"),
    ("<span style='display:none'>n<span>n</span>n</span>y<b hidden>n<i>n</b>z", "yz"), ("<table><tr><td>1<table><tr><td>n</table><td>2</table>", "1  2\nn"),
    ("<table><colgroup>c<tr><td>x<tr>y<td>z</table>", "cy\n\nx\nz"), ("<noscript><p>no</noscript>yes<textarea>a &amp; <b></textarea>", "yesa & <b>"),
])
def test_html(html, text):
    assert html_text.render(html) == text


def random_page(rng, depth=0):
    """A page and the words a browser shows of it, made together."""
    html, words = [], []

    def text(visible):
        word = f"w{rng.integers(1 << 40)}"
        html.append(f" {word} " if rng.random() < 0.7 else f" &#{ord(word[0])};{word[1:]}\n")
        if visible:
            words.append(word)

    def inner(visible, depth, kinds):
        for _ in range(rng.integers(0, 4)):
            kind = rng.choice(kinds)
            if kind == "text":
                text(visible)
            elif kind in ("div", "p", "span", "b", "blockquote", "section"):
                hides = rng.choice(["", "", "", " hidden", " style='display: none'"])
                html.append(f"<{kind}{hides}>")
                below = ("text", "span", "b") if kind in ("p", "span", "b") else KINDS
                if depth < 7:
                    inner(visible and not hides, depth + 1, below)
                html.append(f"</{kind}>" if kind != "p" or hides or rng.random() < 0.5 else "")
            elif kind == "list":
                html.append("<ul>")
                for _ in range(rng.integers(1, 4)):
                    html.append("<li>")
                    text(visible)
                    if depth < 7:
                        inner(visible, depth + 1, KINDS)
                html.append("</ul>")
            elif kind == "table":
                html.append("<table>")
                for _ in range(rng.integers(1, 3)):
                    html.append("<tr>" if rng.random() < 0.8 else "<tbody>")
                    if rng.random() < 0.2:
                        text(visible)  # in no cell
                    for _ in range(rng.integers(1, 4)):
                        html.append(rng.choice(["<td>", "<th>", "<td colspan=2>", "<td rowspan=3>"]))
                        if depth < 7:
                            inner(visible, depth + 1, KINDS)
                html.append("</table>")
            else:
                html.append(rng.choice(["<script>var a = '<p>' </script>", "<style>b{}</style>", "<!-- <b>x</b> -->", "<template><p>t</p></template>", "<br>", "<img alt=x>"]))

    KINDS = ("text", "text", "div", "p", "span", "b", "list", "table", "blockquote", "section", "none")
    inner(True, 0, KINDS)
    return "".join(html), words


def test_html_shows_the_words_a_browser_shows():
    rng = np.random.default_rng(11)
    for _ in range(400):
        html, words = random_page(rng)
        assert Counter(html_text.render(html).replace("- ", " ").split()) == Counter(words), html


def test_html_of_pages(spark):
    """Words of whole pages against a plain walk that only counts hidden elements."""
    from html.parser import HTMLParser

    class Walk(HTMLParser):
        def __init__(self):
            super().__init__()
            self.hidden, self.words = 0, Counter()

        def handle_starttag(self, tag, attrs):
            self.hidden += tag in html_text.HIDDEN

        def handle_endtag(self, tag):
            self.hidden -= tag in html_text.HIDDEN

        def handle_data(self, data):
            if not self.hidden:
                self.words.update(re.findall(r"\w{3,}", data))

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    html = {r.page_id: r.html or "" for r in pages.collect()}
    for r in queries.op1_html_text(spark, SF).collect():
        walk = Walk()
        walk.feed(html[r.page_id])
        walk.close()
        assert Counter(re.findall(r"\w{3,}", r.text)) == walk.words, r.page_id


@pytest.mark.parametrize("html", ["<a " * 300_000, "<!--" * 250_000, "<a t='\">" * 100_000, "<div>" * 150_000, "<b hidden><b>" * 60_000, "<td><table>" * 60_000,
                                  "<tr><td colspan=1000 rowspan=9>x" * 15_000, "<ul><li>" * 90_000])
def test_html_takes_time_by_length(html):
    start = time.process_time()
    assert len(html_text.render(html)) <= 5 * len(html)
    assert time.process_time() - start < 10


def test_html_tables_grow_with_their_text():
    html = "<table><tr><td>" + "w" * 20_000 + "<td>y" + "<tr><td>a<td>b" * 2_000 + "</table>"
    text = html_text.render(html)
    assert len(text) < 200_000 and text.count("a  b") == 2_000 and "w" * 20_000 in text
    wide = "".join(f"<td>{'c' * 90}" for _ in range(40))
    assert len(html_text.render(f"<table><tr>{wide}" + "<tr><td colspan=39><td>x" * 3_000)) < 50_000


def test_html_rows(spark):
    df = spark.createDataFrame([(1, None), (1, "<p>a"), (None, "b")], "page_id long, html string").withColumn("text", F.lit("z"))
    assert Counter(tuple(r) for r in html_text.extract(df).collect()) == Counter([(1, ""), (1, "a"), (None, "b")])
    assert html_text.extract(df.where("false")).count() == 0


# byte-level ids: packing and ORC

def check_packing(rows, docs, window):
    want = Counter((d, np.array(ids_of(BYTES, t, [1]), "<u4").tobytes()) for d, t in docs)
    whole = {}
    for r in rows:
        whole.setdefault(r.doc_id, []).append(r)
    got = Counter()
    for d, pieces in whole.items():
        texts = [v for (k, v), n in want.items() if k == d for _ in range(n)]
        assert sum(p.length for p in pieces) == sum(len(v) // 4 for v in texts)
        if len(texts) == 1:
            pieces.sort(key=lambda p: p.start)
            assert all(p.doc_tokens == len(texts[0]) // 4 and p.length == len(p.ids) // 4 for p in pieces)
            assert [p.start for p in pieces] == np.cumsum([0, *(p.length for p in pieces[:-1])]).tolist()
            got[d, b"".join(bytes(p.ids) for p in pieces)] += 1
    assert all(got[k] == 1 for k in got) and len(got) >= 1
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in sequences.values():
        s.sort()
        ends = np.cumsum([n for _, n in s])
        assert [o for o, _ in s] == [0, *ends[:-1].tolist()] and (ends[-1] == window or ends[-1] & (ends[-1] - 1) == 0) and ends[-1] <= window


@pytest.mark.parametrize("window", [64, 2048])
def test_packing(spark, window):
    rows = packing.pack(frame(spark).coalesce(1), BYTES, window=window, group_ids=500).collect()
    check_packing(rows, ODD, window)
    assert packing.pack(empty(spark), BYTES).count() == 0


def test_packing_solves_counts():
    assert sorted(packing.combinations(4, 2)) == [(2, 2), (3, 1), (4,)]
    # 30 remainders of 3 classes go with 30 of 1; nothing else fills the window
    assert packing.repeat_counts(np.array([30, 0, 30, 0]), 2) == [((3, 1), 30)]
    rng = np.random.default_rng(1)
    a, x = rng.random((12, 6)), np.array([0, 2.0, 0, 1, 3, 0])
    assert np.allclose(packing.nnls(a, a @ x), x, atol=1e-6)
    low = packing.nnls(a, -np.ones(12))
    assert (low >= 0).all()
    parts = [packing.Part(k, 0, int(n)) for k, n in enumerate(rng.integers(1, 256, 400))]
    found, left = packing.pack_group(parts, 256, 16, 4)
    assert all(sum(p.length for p in s) == 256 for s in found) and sum(p.length for p in left) < 256
    assert sum(p.length for s in [*found, left] for p in s) == sum(p.length for p in parts)


def test_orc(spark, tmp_path):
    path = str(tmp_path / "ids")
    orc_tokens.write_ids(frame(spark), path, BYTES, parts=3)
    rows = orc_tokens.positions(spark, path).collect()
    order = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted((d for d, _ in ODD), key=lambda d: (d is not None, d))
    at = 0
    for r in order:
        texts = [t for d, t in ODD if d == r.doc_id]
        assert r.start == at and (r.n_tokens, r.ids_crc32) in {(len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for i in (ids_of(BYTES, t, [2]) for t in texts)}
        at += r.n_tokens
    assert {r.doc_id: list(r.ids) for r in orc_tokens.lookup(spark, path, [4, 9, 77]).collect()} == {d: ids_of(BYTES, dict(ODD)[d], [2]) for d in (4, 9)}
    plan = orc_tokens.lookup(spark, path, [4])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id" in plan or "EqualTo(doc_id" in plan
    orc_tokens.write_ids(empty(spark), path + "0", BYTES)
    assert orc_tokens.positions(spark, path + "0").count() == 0


PIECES = ["a", "'s", "'", " ", "  ", "\n", "é", "é", "<|endoftext|>", "<|startoftext|>", "<|endof", "1", "²", "!", "日", "　", "\x1c", "\x00", "\x85", "'ll", "_",
          "x y", "İ", "Σ", "ΑΣ", "ẞ", "Ǆ", "aaaa", "the", "!!!!", "</w>", "ing", "①", "🙂", "́", "<|endoftext", "|>"]


def awkward(seed, n):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(PIECES, rng.integers(0, 9))) for _ in range(n)]


def test_byte_ids_equal_the_library():
    library, own, texts = Tokenizer.from_file(BYTES), tokens.ByteBpe(BYTES), awkward(1, 3000)
    for k in range(0, len(texts), 10):
        flat, bounds = own.encode(pa.array(texts[k:k + 10], pa.string()))
        assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts[k:k + 10]]


def test_word_ids_equal_the_library():
    library, own = Tokenizer.from_file(WORDS), word_bpe.WordBpe(WORDS)
    rng = np.random.default_rng(3)
    texts = awkward(2, 3000) + ["".join(rng.choice(list("abcdeinorst"), rng.integers(1, 15))) for _ in range(3000)]
    ids, decoded, counts = own.encode(pa.array(texts, pa.string()))
    for t, i, d, n in zip(texts, ids.to_pylist(), decoded.to_pylist(), counts.to_pylist()):
        want = library.encode(t, add_special_tokens=False).ids
        assert (i, d, n) == (" ".join(map(str, want)), library.decode(want, skip_special_tokens=False), len(want))
    assert 0 < own.n_failed < own.n_words  # some words are settled by the checks alone, some are merged


def test_word_rows(spark):
    encoded = word_bpe.encode(frame(spark), WORDS)
    library = Tokenizer.from_file(WORDS)
    want = Counter((d, " ".join(map(str, library.encode(t or "", add_special_tokens=False).ids))) for d, t in ODD)
    assert Counter((r.doc_id, r.ids) for r in encoded.collect()) == want
    back = word_bpe.decode(encoded, WORDS)
    assert Counter(tuple(r) for r in back.collect()) == Counter(tuple(r) for r in encoded.select("doc_id", "decoded").collect())
    assert word_bpe.encode(empty(spark), WORDS).count() == 0


# SimHash

def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(rows):
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if (a ^ b).bit_count() <= 3:
                parent[top(i)] = top(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[top(i)] = min(best.get(top(i), d), d)
    return Counter((d, f, best.get(top(i))) for i, (d, f) in enumerate(rows))


def test_simhash(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(300)]
    rows = list(ODD)
    for k in range(60):  # near copies of a few long texts
        base = np.random.default_rng(k % 7).choice(words, 400)
        base[rng.integers(0, 400, k % 4)] = "changed"
        rows.append((100 + k, " ".join(base)))
    got = simhash.classes(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == brute_classes([(d, fingerprint(t)) for d, t in rows])
    assert simhash.classes(empty(spark)).count() == 0


@pytest.mark.parametrize("blocks", [4, 5, 6])
def test_links_are_exact_in_split_shards(spark, monkeypatch, blocks):
    rng = np.random.default_rng(9)
    near = rng.integers(0, 1 << 63, 6, dtype=np.int64).view(np.uint64)
    fps = np.unique(np.concatenate([near ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (4, 6)).astype(np.uint64), axis=0) for _ in range(60)]))
    # one large group that agrees on many blocks
    fps = np.unique(np.concatenate([fps, near[0] ^ rng.integers(0, 1 << 12, 900).astype(np.uint64)]))
    monkeypatch.setattr(simhash, "blocks_for", lambda n, radius=3: blocks)
    monkeypatch.setattr(simhash, "HOT_PARTS", 1 << 40)
    df = spark.createDataFrame([(int(f), k) for k, f in enumerate(fps.view(np.int64))], "fp long, rep long")
    got = support.components(simhash.linked(df, len(fps), shard=100)).collect()
    want = brute_classes([(k, int(f)) for k, f in enumerate(fps)])
    roots = dict.fromkeys(range(len(fps)))
    roots.update({r.node: r.root for r in got})
    assert all((k if roots[k] is None else roots[k]) == c for k, _, c in want)


def test_every_linked_pair_is_whole_in_a_leaf():
    rng = np.random.default_rng(4)
    fps = rng.integers(0, 1 << 63, 300, dtype=np.int64).view(np.uint64)
    fps = np.unique(np.concatenate([fps, *(fps ^ (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) for _ in range(2))]))
    tree = simhash.grow(fps, len(fps), most=50)
    leaves = list(simhash.route(tree, fps, np.arange(len(fps))))
    assert tree is not None and len(leaves) > 4 and len({leaf for leaf, _ in leaves}) == len(leaves) and max(len(at) for _, at in leaves) < len(fps)
    held = {(i, j) for _, at in leaves for i in at.tolist() for j in at.tolist()}
    assert all((i, j) in held for i in range(len(fps)) for j in range(len(fps)) if (int(fps[i]) ^ int(fps[j])).bit_count() <= 3)
    found = {frozenset(p) for p in simhash.links(fps, most=64)}
    assert found and all((int(fps[i]) ^ int(fps[j])).bit_count() <= 3 for i, j in map(tuple, found))


def test_components_of_long_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(200, 700)] + [(1, k) for k in range(1000, 1400)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in support.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 200 for k in range(200, 701)}, 1: 1, **{k: 1 for k in range(1000, 1400)}}


# winnowing

def winnow_tokens(text):
    """Tokens as runs of words or code points; a run of letters is a tuple of them."""
    words = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]

    def letters(t):
        return [tuple(t[i:i + 4]) for i in range(len(t) - 3)] if len(t) >= 4 else [t]
    if 0 < len(words) < winnowing.W + winnowing.K - 1:
        return letters(" ".join(words))
    return [x for word in words for x in (letters(word) if len(word) > winnowing.LONG else [word])]


def token_hashes(spark, tokens):
    plain = sorted({p for t in tokens for p in (t if isinstance(t, tuple) else (t,))})
    value = {r.p: r.h for r in spark.createDataFrame([(p,) for p in plain], "p string").select("p", F.expr(f"cast(hash(p) & {winnowing.BITS} as long)").alias("h")).collect()}
    base, prime = winnowing.BASE, winnowing.PRIME
    return {t: sum(value[c] * pow(base, 3 - i, prime) for i, c in enumerate(t)) % prime if isinstance(t, tuple) else value[t] for t in tokens}


def test_winnowing(spark):
    rows = [(d, t) for d, t in ODD if t != LONG] + [(20, " ".join(f"w{k % 23}" for k in range(200))), (21, "x " * 40), (22, "日本語の文章" * 50), (23, "one two " + "q" * 60 + " three " * 9)]
    df = frame(spark, rows, extra=False).select("doc_id", "text")
    found = winnowing.fingerprints(df).collect()
    value = token_hashes(spark, {x for _, t in rows for x in winnow_tokens(t)})
    for r in found:
        tokens, k, w = winnow_tokens(r.text), winnowing.K, winnowing.W
        hs = [sum(value[tokens[i + j]] * (pow(winnowing.BASE, k - 1 - j, winnowing.PRIME) & winnowing.BITS) for j in range(k)) % winnowing.PRIME for i in range(len(tokens) - k + 1)]
        want = []
        for s in range(max(len(hs) - w + 1, min(len(hs), 1))):
            at = min(range(s, min(s + w, len(hs))), key=lambda i: (hs[i], -i))
            if (hs[at], at) not in want:
                want.append((hs[at], at))
        got = [(-(-x // winnowing.PLACES), -x % winnowing.PLACES) for x in r.kept]
        assert got == want if len(tokens) >= k else len(got) == min(len(tokens), 1)
    placed = winnowing.positions(df).collect()
    assert len(placed) == sum(len(r.kept) for r in found) and {r.position for r in placed if r.doc_id == 20} <= set(range(198))


def test_edits(spark):
    rows = [(1, None), (2, "abc def ghi jkl mno pqr"), (3, "é" * 10), (5, "short"), (8, LONG)]
    got = {r.doc_id: r for r in winnowing.edits(frame(spark, rows, extra=False)).collect()}
    order = sorted(rows, reverse=True)
    for k, (d, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        n = len(t) // 3
        assert (got[d].n_chars, got[d].edited) == (len(t), t[:len(t) - n] + after[:n])
        assert 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1
    assert winnowing.edits(empty(spark)).count() == 0


def test_edits_of_texts_without_ten_words(spark):
    rng = np.random.default_rng(6)
    rows = [(10, "".join(chr(c) for c in rng.integers(0x3042, 0x3090, 300))), (9, "".join(chr(c) for c in rng.integers(97, 123, 600))),
            (8, "eight words are here and that is few"), (7, " ".join("".join(chr(c) for c in rng.integers(97, 123, 6)) for _ in range(9)))]
    for r in winnowing.edits(frame(spark, rows, extra=False)).collect():
        assert r.near_edited > (0.5 if r.n_chars > 200 else 0.2) and r.near_next < 0.1


def test_edits_keep_every_row(spark):
    """Shared, repeated and null ids, and an id that is the smallest long."""
    rows = [(3, "bbbbbb"), (3, "aaaaaa"), (3, "aaaaaa"), (3, "aaaaaa"), (None, "cccccc"), (None, "cccccc"), (None, None), (-(1 << 63), "cccccc"), (5, "")]
    got = winnowing.edits(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((d, len(t or "")) for d, t in rows)
    # an equal row before an equal row is edited with its own start
    same = [r for r in got if r.doc_id == 3 and r.edited == "aaaaaa"]
    assert len(same) == 2 and all(r.near_next == 1.0 for r in same)
    assert {r.edited[4:] for r in got if r.doc_id == 5} == {""}


# line CRF

def test_crf_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    n_lines = np.array([3, 1, 5])
    states, moves, starts = rng.normal(size=(9, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    got, pairs, norm = line_crf.marginals(states, n_lines, moves, starts)
    at, want_pairs, want_norm = 0, np.zeros((2, 2)), 0.0
    for n in n_lines:
        total, own, moved = 0.0, np.zeros((n, 2)), np.zeros((2, 2))
        for code in range(1 << n):
            y = [code >> k & 1 for k in range(n)]
            p = np.exp(starts[y[0]] + sum(states[at + k, y[k]] for k in range(n)) + sum(moves[y[k], y[k + 1]] for k in range(n - 1)))
            total += p
            for k in range(n):
                own[k, y[k]] += p
            for k in range(n - 1):
                moved[y[k], y[k + 1]] += p
        assert np.allclose(got[at:at + n], own / total)
        want_pairs += moved / total
        want_norm += np.log(total)
        at += n
    assert np.allclose(pairs, want_pairs) and np.isclose(norm, want_norm)


def test_crf_features_do_not_depend_on_runs(monkeypatch):
    texts = ["", "a\n\nB!! cc", "x | y\n" * 5, "é\n 12 $$ "]
    whole = line_crf.line_features(texts)
    monkeypatch.setattr(line_crf, "STEP", 3)
    parts = line_crf.line_features(texts)
    assert all(np.allclose(a, b) for a, b in zip(whole, parts)) and whole[2].tolist() == [t.count("\n") + 1 for t in texts]


def test_crf_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = line_crf.fit(docs, labels)
    got = line_crf.scores(docs, model).withColumn("held_out", line_crf.held_out()).join(labels, "doc_id").where("held_out").collect()
    right = [r.predicted == r.quality for r in got]
    assert len(right) > 30 and np.mean(right) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    assert line_crf.scores(frame(spark), model).count() == len(ODD)
    assert line_crf.good_documents(frame(spark), model).columns == frame(spark).columns
    assert line_crf.scores(empty(spark), model).count() == 0
    none = line_crf.fit(docs, labels.where("quality = 1"))
    assert {r.predicted for r in line_crf.scores(frame(spark), none).collect()} == {1}


def test_crf_scores_long_texts_in_runs(monkeypatch):
    """Texts of many lines get the scores they get whole, from a few numbers a line."""
    rng = np.random.default_rng(3)
    lines = ["good words in a line of some length here", "!!! $$$ ### win win win", "", "x", "The end of it, then."]
    texts = ["\n".join(rng.choice(lines, n)) for n in (1, 2, 5, 6, 31, 200, 47)]
    model = line_crf.train(texts, np.array([0, 1, 0, 1, 0, 1, 1]), 20)
    whole = model.score(texts)
    for run in (1, 3, 7, 46):
        monkeypatch.setattr(line_crf, "RUN", run)
        assert np.allclose(model.score(texts), whole, atol=1e-9)
    assert [t for t in line_crf.runs_of("a\nb\n\nc\n", 2)] == ["a\nb", "\nc", ""]
    monkeypatch.setattr(line_crf, "RUN", 3)
    sure = line_crf.Crf(model.weights, np.array([[0.0, 60], [0, 60]]), np.array([0.0, 60]), model.mean, model.scale)
    assert np.allclose(sure.score(texts), 1)
    monkeypatch.setattr(line_crf, "RUN", 10_000)
    start = time.process_time()
    assert 0 <= model.score(["\n".join(lines * 60_000)])[0] <= 1
    assert time.process_time() - start < 20


# archive

def test_archive(spark, tmp_path):
    path = str(tmp_path / "archive")
    rows = [(3, "http://a/%\n", "same"), (1, None, "same"), (1, "u", "same"), (None, "v", "same"), (5, "w", None), (4, "x", ""), (6, "y", "élan")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("address", F.lit(1))
    warc.write_archive(pages, path)
    records = warc.reconstruct(spark, path).collect()
    got = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in records)
    assert got == Counter([(3, 4, "revisit", 1), (1, 4, "response", None), (1, 4, "revisit", 1), (None, 4, "revisit", 1), (4, 0, "response", None),
                           (5, 0, "revisit", 4), (6, 5, "response", None)])
    assert spark.read.parquet(path + "/payloads").count() == 3
    html = {(d, u or ""): (h or "").encode() for d, u, h in rows}
    for r in records:
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        payload = html[r.page_id, r.url]
        assert block == (payload if r.record_type == "response" else b"") + b"\r\n\r\n" and length == len(block) - 4
        assert b"sha1:" + base64.b32encode(hashlib.sha1(payload).digest()) in head and r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert re.search(rb"\r\nWARC-Date: \d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ\r\n", head + b"\r\n")
    assert {r.url for r in records} >= {"http://a/%\n", "u", ""}
    warc.write_archive(pages, path + "2", least=5, date="2020-01-02T03:04:05Z")
    again = warc.reconstruct(spark, path + "2").collect()
    assert {r.record_type for r in again} == {"response"} and all(b"2020-01-02T03:04:05Z" in r.record for r in again)
    warc.write_archive(pages.where("false"), path + "0")
    assert warc.reconstruct(spark, path + "0").count() == 0


@pytest.mark.parametrize("few", [True, False])
def test_archive_of_a_payload_of_many_pages(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 200_000 if few else 0)
    pages = spark.range(1500).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 5 > 0, "shared").otherwise(F.concat(F.lit("own text "), F.col("id").cast("string"))).alias("html"))
    for least, revisits in ((0, 1199), (8, 0)):
        warc.write_archive(pages, str(tmp_path / f"a{least}"), least)
        got = warc.reconstruct(spark, str(tmp_path / f"a{least}"))
        assert got.count() == 1500 and got.where("record_type = 'revisit' and refers_to = 1").count() == revisits
        assert got.where("record_type = 'response'").where(~F.col("record").cast("string").rlike("(shared|own text [0-9]+)\r\n\r\n$")).isEmpty()


def test_changed_payload_is_found(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archive(spark.createDataFrame([(1, "u", "a")], "page_id long, url string, html string"), path)
    spark.createDataFrame([(hashlib.sha256(b"a").hexdigest(), bytearray(b"b"))], "address string, payload binary").write.mode("overwrite").parquet(path + "/payloads")
    with pytest.raises(Exception, match="differs from its digest"):
        warc.reconstruct(spark, path).collect()
    spark.createDataFrame([], "address string, payload binary").write.mode("overwrite").parquet(path + "/payloads")
    with pytest.raises(Exception, match="record differs"):
        warc.reconstruct(spark, path).collect()


# host rules

def test_host_rules(spark):
    good, bad = " ".join(f"w{k}" for k in range(60)), "word " * 60
    rows = [(k, good if k % 10 else bad, "fine") for k in range(40)] + [(100 + k, bad if k else good, "spam") for k in range(40)]
    rows += [(200, good, None), (201, bad, None), (202, None, "fine"), (203, good + "\nx\nx\n \nx", "small"), (203, good, "small"), (204, bad, "new")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"_host": F.lit(1), "kept": F.lit(1), "rate": F.lit(1)})
    got = {(r.doc_id, r.n_words): r for r in host_rules.verdicts(docs, F.col("source"), "doc_id").collect()}
    assert got[1, 60].kept and not got[0, 60].kept and not got[100, 60].kept and not got[100, 60].base_failed
    assert got[200, 60].kept and not got[201, 60].kept and got[202, 0].base_failed
    assert (got[203, 63].n_dup_lines, got[203, 63].n_repeat_words, got[203, 60].kept) == (2, 0, True)
    kept = host_rules.kept_documents(docs, F.col("source"))
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for (d, _), r in got.items() if r.kept)
    assert host_rules.verdicts(docs.where("false"), F.col("source"), "doc_id").count() == 0
    assert host_rules.kept_documents(docs.where("false"), F.col("source")).count() == 0


def test_hot_keys_join_like_others(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 3000, F.lit(1)).otherwise(F.col("id")).alias("k"), "id")
    table = rows.groupBy("k").agg(F.count("*").alias("_n"), F.max("id").alias("v"))
    got = support.join_hot(rows, table, "k", 5000)
    assert sorted(map(tuple, got.select("id", "v").collect())) == sorted(map(tuple, rows.join(table, "k").select("id", "v").collect()))


# chat

def test_reply_trees(spark):
    #      1          a root with two branches; 9 replies to a message that is not there; 20 and 21 form a circle
    rows = [("t", 1, None, "user", "q", 1.0), ("t", 2, 1, "assistant", "a", 0.5), ("t", 3, 1, "assistant", "b", 2.0), ("t", 4, 3, "user", "c", None),
            ("t", 5, 2, "user", "d", 0.2), ("t", 9, 8, "assistant", "alone", 1.5), ("t", 20, 21, "x", "x", 9.0), ("t", 21, 20, "x", "x", 9.0),
            (None, 1, None, None, None, 1.0), (None, 1, None, None, None, 1.0)]
    messages = spark.createDataFrame(rows, "tree string, message long, parent long, role string, text string, score double").withColumn("branch", F.lit(0))
    paths = chat.ranked_paths(messages.where("tree = 't'"), best=3).collect()
    found = {}
    for r in sorted(paths, key=lambda r: r.depth):
        found.setdefault(r.branch, []).append(r.message)
    assert found == {1: [1, 3, 4], 2: [1, 2, 5], 3: [9]}
    turns = chat.read_turns(chat.best_conversations(messages)).collect()
    assert sorted((r.tree or "", r.depth, r.role, r.text, r.loss_text) for r in turns) == [
        ("", 0, "", "", None), ("t", 0, "user", "q", None), ("t", 1, "assistant", "b", "b"), ("t", 2, "user", "c", None)]
    assert chat.best_conversations(messages.where("false")).count() == 0


def test_deep_chain(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", f"text {k}") for k in range(300)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.digests(chat.read_turns(chat.best_conversations(chat.chains(turns)))).collect()
    assert [(r.n_turns, r.loss_sha256) for r in got] == [(300, hashlib.sha256("".join(t for _, _, role, t in rows if role == "assistant").encode()).hexdigest())]


def test_template_is_reversible(spark):
    texts = ["<|im_end|>", "<\\|x", "<\\\\|im_start|>\n", "", "a<|<|b", "<", "|>", "\\", "🙂<|"]
    rows = [(1, 1, k, role, t) for k, (role, t) in enumerate([*(("assistant", t) for t in texts), ("a b\n<|im_start|>", "x"), ("user", "y")])]
    df = spark.createDataFrame(rows, "tree long, branch int, depth long, role string, text string")
    pieces = chat.formatted_turns(df)
    back = sorted(chat.read_turns(pieces).collect(), key=lambda r: r.depth)
    assert [(r.role, r.text) for r in back] == [(r[3], r[4]) for r in rows]
    assert [r.loss_text for r in back] == [t or None for t in texts] + [None, None]
    assert all(r.piece.count("<|") == 2 for r in back)


@pytest.mark.parametrize("turns", [2, 256])
def test_chat_conversations(spark, turns):
    """A path is one text (or one for each few turns) whose spans and turns come back."""
    hard = "<|im_end|>\n<|im_start|>user\n<\\|im_end|>"
    rows = [(t, 1, k, r, x) for t in (1, None) for k, (r, x) in enumerate([("user", hard), ("assistant", "ok" + hard), ("", ""), ("assistant", ""), ("assistant", "é🙂")])]
    formatted = chat.formatted_turns(spark.createDataFrame(rows, "tree long, branch int, depth long, role string, text string"))
    whole = chat.conversations(formatted, turns).collect()
    assert Counter((r.tree, r.part) for r in whole) == Counter((t, p) for t in (1, None) for p in range(-(-5 // turns)))
    pieces = {(r.tree, r.depth): r for r in formatted.collect()}
    for r in whole:
        own = [pieces[r.tree, r.part * turns + k] for k in range(len(r.spans))]
        assert r.text == "".join(p.piece for p in own)
        for p, s in zip(own, r.spans):
            assert r.text[s.loss_from:s.loss_to] == p.piece[p.loss_from:p.loss_to] and r.text[s.start:].startswith(p.piece)
    back = chat.read_turns(chat.turns_of(chat.conversations(formatted, turns), turns)).collect()
    assert Counter((r.tree, 1, r.depth, r.role, r.text) for r in back) == Counter(rows)
    assert {r.depth: r.loss_text for r in back} == {0: None, 1: "ok" + hard, 2: None, 3: None, 4: "é🙂"}



# queries

@pytest.mark.parametrize("name", sorted(queries.TWINS))
def test_query_equals_twin(spark, name):
    from compare import compare, database
    assert compare(queries.QUERIES[name](spark, SF), database(SF), queries.TWINS[name]) == ""


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.TWINS)))
def test_query_covers_its_table(spark, name):
    got = queries.QUERIES[name](spark, SF)
    key = "page_id" if "page_id" in got.columns else "doc_id"
    table = spark.read.parquet(f"{SF}/{'pages' if key == 'page_id' else 'documents'}.parquet")
    assert {r[0] for r in got.select(key).distinct().collect()} == {r[0] for r in table.select(key).collect()}
