"""BPE with word ends by speculation: propose, verify all neighbours, merge only what fails.

A greedy longest match proposes the tokens of a word. A sequence of tokens is the BPE result
exactly if every token is the BPE result of its own string and no merge crosses the border of a
neighbouring pair. The second is decided for all new pairs of a batch at once: on the left side
only symbols on the right edge of the token's merge tree can touch the border, on the right side
only those on the left edge. A merge (x, y) of rank r crosses if x is still unmerged before rank r
(r below the rank of the merge that takes x in) and y is so too (r not above that of y: of equal
merges the leftmost goes first). Words with a token or a pair that fails are merged exactly.

The vocabulary file is a tokenizers JSON of this kind: NFC, white space folded, lower case, a
split pattern, byte letters and a word-end suffix.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .support import by_batch
from .tokens import byte_letters, slices

SCHEMA = "doc_id long, n_tokens long, ids string, decoded string"
# Entries of one generation of the tables of words; two generations are held.
KEPT = 200_000
BLOCK = 4096
NEVER = 1 << 30
# The split pattern of the vocabulary (fixed value), for characters below U+0250.
LATIN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[^\\W\\d_\xb2\xb3\xb9\xbc-\xbe]+|[\\d\xb2\xb3\xb9\xbc-\xbe]|(?:[^\\s\\w]|_)+")
BEYOND = re.compile("[^\x00-\x1b\x20-ɏ]")


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class WordBpe:
    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            parsed = json.load(f)
        model = parsed["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.strings = {i: s for s, i in (self.vocab | self.special).items()}
        self.letters = byte_letters()
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = {(self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.by_key = {a << 32 | b: made for (a, b), made in self.merges.items()}
        keys = np.array([a << 32 | b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.array([r for r, _ in self.merges.values()], np.int64)[order]
        # longest tokens by their first three letters: inside a word, and with the word end
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        for token in self.vocab:
            at_end = token.endswith(self.suffix) and len(token) > len(self.suffix)
            letters = token.removesuffix(self.suffix) if at_end else token
            reach = self.final if at_end else self.inner
            reach[letters[:3]] = max(reach.get(letters[:3], 0), len(letters))
        self.edges: dict[int, tuple | None] = {}
        self.fits: dict[int, bool] = {}
        self.recent: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}
        self.words: dict[str, tuple[str, str]] = {}
        self.older_words: dict[str, tuple[str, str]] = {}
        self.n_words = self.n_failed = 0

    def symbols(self, letters: str) -> list[int]:
        """The first symbols of a word; those the vocabulary does not have are left out."""
        last = len(letters) - 1
        found = (self.vocab.get(c + self.suffix if k == last else c) for k, c in enumerate(letters))
        return [s for s in found if s is not None]

    def merged(self, ids: list[int]) -> list[int]:
        """Exact BPE of a word: the leftmost pair of the lowest rank is merged until no pair has a rank."""
        get, none = self.by_key.get, (NEVER, 0)
        found = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best is none:
                break
            k = found.index(best)
            ids[k] = best[1]
            del ids[k + 1], found[k]
            if k:
                found[k - 1] = get(ids[k - 1] << 32 | best[1], none)
            if k < len(found):
                found[k] = get(best[1] << 32 | ids[k + 1], none)
        return ids

    def tree(self, symbols: list[int]) -> tuple[list[int], list]:
        """``merged`` with the merge trees of its tokens: (rank, left tree, right tree) or None."""
        ids, trees = list(symbols), [None] * len(symbols)
        while len(ids) > 1:
            best = min(((*self.merges[p], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.merges), default=None,
                       key=lambda m: (m[0], m[2]))
            if best is None:
                break
            rank, made, k = best
            trees[k:k + 2] = [(rank, (ids[k], trees[k]), (ids[k + 1], trees[k + 1]))]
            ids[k:k + 2] = [made]
        return ids, trees

    def edge(self, token: int) -> tuple | None:
        """Symbols on the right and on the left edge of a token's tree with the rank that takes each in.

        None where BPE of the token's string is not the token.
        """
        if token not in self.edges:
            s = self.strings[token]
            if s.endswith(self.suffix):
                start = self.symbols(s.removesuffix(self.suffix))
            else:
                start = [self.vocab[c] for c in s]
            ids, trees = self.tree(start)
            if ids != [token]:
                self.edges[token] = None
            else:
                sides = []
                for side in (2, 1):
                    node, taken, found = (token, trees[0]), NEVER, []
                    while node:
                        found.append((node[0], taken))
                        taken, node = (node[1][0], node[1][side]) if node[1] else (0, None)
                    sides.append(found)
                self.edges[token] = tuple(sides)
        return self.edges[token]

    def greedy(self, letters: str) -> list[int]:
        """Longest match from the left; a letter without a token is left out."""
        out, at, n, vocab = [], 0, len(letters), self.vocab
        inner, final, suffix = self.inner.get, self.final.get, self.suffix
        while at < n:
            head = letters[at:at + 3]
            if n - at <= final(head, 0):
                token = vocab.get(letters[at:] + suffix)
                if token is not None:
                    out.append(token)
                    break
            for stop in range(min(n - 1, at + inner(head, 2)), at, -1):
                token = vocab.get(letters[at:stop])
                if token is not None:
                    out.append(token)
                    at = stop
                    break
            else:
                at += 1
        return out

    def verify(self, pairs: np.ndarray) -> np.ndarray:
        """Whether no merge crosses the border of each pair of tokens (left << 32 | right)."""
        out = np.empty(len(pairs), bool)
        for at in range(0, len(pairs), BLOCK):
            block = pairs[at:at + BLOCK]
            sides = []
            for tokens, side in ((block >> 32, 0), (block & 0xFFFFFFFF, 1)):
                own, place = np.unique(tokens, return_inverse=True)
                edges = [(self.edge(int(t)) or ([(0, -1)],) * 2)[side] for t in own]
                depth = max(map(len, edges))
                table = np.array([e + [(0, -1)] * (depth - len(e)) for e in edges], np.int64)
                sides.append(table[place])
            x, y = sides[0][:, :, None, :], sides[1][:, None, :, :]
            keys = x[..., 0] << 32 | y[..., 0]
            found = np.searchsorted(self.keys, keys)
            np.minimum(found, len(self.keys) - 1, out=found)
            rank = np.where(self.keys[found] == keys, self.ranks[found], NEVER)
            out[at:at + BLOCK] = ~((rank < x[..., 1]) & (rank <= y[..., 1])).any(axis=(1, 2))
        return out

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of words in byte letters."""
        proposed = [self.greedy(w) for w in words]
        counts = np.array([len(p) for p in proposed], np.int64)
        flat = np.array([t for p in proposed for t in p], np.int64)
        bad = np.zeros(len(words), bool)
        if len(flat):
            owner = np.repeat(np.arange(len(words)), counts)
            alone = np.unique(flat)
            lost = alone[[self.edge(int(t)) is None for t in alone]]
            bad[owner[np.isin(flat, lost)]] = True
            inner = owner[1:] == owner[:-1]
            pairs = (flat[:-1] << 32 | flat[1:])[inner]
            own, place = np.unique(pairs, return_inverse=True)
            fits = np.fromiter((self.fits.get(k, None) is True for k in own.tolist()), bool, len(own))
            new = np.fromiter((k not in self.fits for k in own.tolist()), bool, len(own))
            fits[new] = self.verify(own[new])
            if len(self.fits) > 8 * KEPT:
                self.fits.clear()
            self.fits.update(zip(own[new].tolist(), fits[new].tolist(), strict=True))
            bad[owner[1:][inner][~fits[place]]] = True
        for k in np.flatnonzero(bad).tolist():
            proposed[k] = self.merged(self.symbols(words[k]))
        self.n_words += len(words)
        self.n_failed += int(bad.sum())
        return proposed

    def pieces(self, chunk: str) -> list[str]:
        """Words of a chunk in byte letters; a special token's string is a word of its own."""
        if "|>" in chunk and self.at_special and self.at_special.search(chunk):
            return [w for part in self.at_special.split(chunk) for w in ([part] if part in self.special else self.pieces(part))]
        if BEYOND.search(chunk):
            normal = self.library.normalizer.normalize_str(chunk)
            return [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk)
        found = LATIN.findall(chunk.lower())
        if chunk.isascii() and chunk.isprintable():
            return found
        letters = self.letters
        return ["".join(letters[b] for b in w.encode()) for w in found]

    def of_words(self, words: list[str]) -> dict[str, tuple[str, str]]:
        """``of_chunks`` for words in byte letters."""
        recent, older, strings = self.words, self.older_words, self.strings
        made = {w: got for w in words if (got := recent.get(w) or older.get(w))}
        made |= {w: (f"{self.special[w]} ", w + " ") for w in words if w in self.special}
        new = [w for w in words if w not in made]
        fresh = {w: ("".join([f"{i} " for i in ids]), "".join([strings[i] + " " for i in ids]))
                 for w, ids in zip(new, self.encode_words(new), strict=True)}
        if len(recent) + len(new) > KEPT:
            self.words, self.older_words = {}, recent
        if len(new) <= KEPT:
            self.words.update(fresh)
        return made | fresh

    def of_chunks(self, chunks: list[str]) -> list[tuple[str, str]]:
        """Ids and decoded tokens of chunks, each joined by spaces and with a space at the end."""
        known: dict[str, tuple[str, str]] = {}
        for c in chunks:
            got = self.recent.get(c) or self.older.get(c)
            if got is not None:
                known[c] = got
        new = [c for c in dict.fromkeys(chunks) if c not in known]
        parts = [self.pieces(c) for c in new]
        made = self.of_words(list(dict.fromkeys([w for p in parts for w in p])))
        for c, p in zip(new, parts, strict=True):
            if len(p) == 1:
                known[c] = made[p[0]]
            else:
                known[c] = ("".join([made[w][0] for w in p]), "".join([made[w][1] for w in p]))
        if len(self.recent) + len(new) > KEPT:
            self.recent, self.older = {}, self.recent
        if len(new) <= KEPT:
            self.recent.update((c, known[c]) for c in new)
        return [known[c] for c in chunks]

    def encode(self, texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
        """Per text of a slice: decimal ids and decoded tokens, each joined by one space, and the count."""
        lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
        first = lists.offsets[0].as_py()
        offsets = pa.array(lists.offsets.to_numpy() - first)
        coded = lists.flatten().dictionary_encode()
        gc.disable()  # millions of small tuples and no cycles: collections would take a fifth of the time
        try:
            made = self.of_chunks(coded.dictionary.to_pylist()) or [("", "")]
        finally:
            gc.enable()
        ids, decoded = (pc.utf8_rtrim(pc.binary_join(pa.ListArray.from_arrays(offsets, pa.array(m, pa.string()).take(coded.indices)), ""), " ")
                        for m in zip(*made, strict=True))
        counts = pc.add(pc.count_substring(ids, " "), pc.cast(pc.not_equal(ids, ""), pa.int32()))
        return ids, decoded, counts.cast(pa.int64())


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """One encoder per Python worker and file."""
    return WordBpe(path)


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encode and decode ``docs(doc_id, text)``.

    One row per row: doc_id, n_tokens, ids (decimal, joined by one space) and decoded (the tokens'
    strings joined by one space, special tokens kept). Null text is an empty text, which has no
    ids; null and repeated doc_ids are rows like others; an empty table gives no rows; other
    columns are not read.
    """
    def task():
        encoder = word_bpe(vocabulary)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, decoded, counts = (pa.concat_arrays(x) for x in zip(*map(encoder.encode, slices(batch.column(1))), strict=True))
            return pa.RecordBatch.from_arrays([batch.column(0), counts, ids, decoded], names=["doc_id", "n_tokens", "ids", "decoded"])
        return one
    return by_batch(docs.select("doc_id", "text"), SCHEMA, task)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Texts of ``encoded(doc_id, ids)`` with decimal ids joined by one space: doc_id, decoded.

    Tokens are joined by one space as the file has no decoder; null or empty ids give an empty text.
    """
    def task():
        strings = word_bpe(vocabulary).strings

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [" ".join([strings[int(i)] for i in ids.split()]) for ids in pc.fill_null(batch.column(1), "").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "decoded"])
        return one
    return by_batch(encoded.select("doc_id", "ids"), "doc_id long, decoded string", task)
