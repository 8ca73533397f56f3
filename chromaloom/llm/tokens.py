"""Byte-level BPE with the ids of the tokenizers library.

The vocabulary file is a tokenizers JSON; its path is a parameter. Texts are cut before single
spaces, which is always a border of the file's word pattern. Arrow splits a slice of texts and
finds its distinct cuts, tiktoken encodes these over the ranks of the same file, which gives the
same ids in a fraction of the time, and numpy puts the ids in the places of the cuts. Where a cut would not be a border (white space
beside the space), and where a special token's string occurs, the tokenizers library encodes the
whole text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

# Bytes of text that are split at a time; one longer text is a slice of its own.
SLICE = 2 << 20
# The word pattern of byte-level BPE files (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[int, str]:
    """The printable letter of each byte in byte-level vocabularies.

    Printable bytes of Latin-1 stand for themselves, the others for letters from U+0100 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(others)}


def slices(texts: pa.Array, most: int = SLICE) -> Iterator[pa.Array]:
    """Runs of texts of about ``most`` bytes, so that memory does not grow with the batch."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield texts.slice(start, stop - start)
        start = stop


class ByteBpe:
    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            parsed = json.load(f)
        self.special = tuple(t["content"] for t in parsed["added_tokens"])
        of_letter = {c: b for b, c in byte_letters().items()}
        special = set(self.special)
        ranks = {bytes(of_letter[c] for c in token): rank for token, rank in parsed["model"]["vocab"].items() if token not in special}
        self.plain = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.n_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.n_bytes[rank] = len(token)

    def _of_words(self, words: list[str], lead: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words, each after ``lead``: all ids, where each word's end, and the words that are no cuts.

        Words that are no cuts get no ids. The words are encoded as one text, in which every
        space is a border, and the ids are dealt to the words by the bytes they stand for.
        """
        odd = np.fromiter((w.strip() != w or not w for w in words), bool, len(words))
        text = lead.join(words)
        if any(s in text for s in self.special):
            odd |= np.fromiter((any(s in w for s in self.special) for w in words), bool, len(words))
        if odd.any():
            words = ["" if o else w for w, o in zip(words, odd.tolist(), strict=True)]
        spans = [lead + w if w else "" for w in words]
        text = "".join(spans)
        ids = self.plain.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)
        n_bytes = pc.binary_length(pa.array(spans, pa.string())).to_numpy()
        return ids, np.searchsorted(np.cumsum(self.n_bytes[ids]), np.cumsum(n_bytes), "left") + (n_bytes.cumsum() > 0), odd

    @cached_property
    def library(self) -> Tokenizer:
        """The tokenizer itself, read when a text needs it."""
        found = Tokenizer.from_file(self.path)
        found.no_truncation()
        found.no_padding()
        return found

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice one after another, and the borders between the texts' ids."""
        lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
        starts = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        cuts = lists.flatten()
        coded = cuts.dictionary_encode()
        codes = coded.indices.to_numpy().copy()
        ids, ends, odd = self._of_words(coded.dictionary.to_pylist(), " ")
        # a text's first cut has no space before it: it gets an entry after those of the dictionary
        firsts = [self._first(w) for w in cuts.take(pa.array(starts)).to_pylist()]
        codes[starts] = len(ends) + np.arange(len(starts), dtype=codes.dtype)
        ids = np.concatenate([ids, *(f for f in firsts if f is not None)])
        lengths = np.append(np.diff(ends, prepend=0), [0 if f is None else len(f) for f in firsts]).astype(np.int32)
        odd = np.append(odd, [f is None for f in firsts])
        each = lengths[codes]
        ends = np.cumsum(each, dtype=np.int64)
        total = int(ends[-1])
        shift = ((np.cumsum(lengths, dtype=np.int64) - lengths)[codes] - ends + each).astype(np.int32)
        out = ids[np.repeat(shift, each) + np.arange(total, dtype=np.int32)]
        bounds = np.append((ends - each)[starts], total)
        if not odd.any():
            return out, bounds
        parts, done, counts = [], 0, np.diff(bounds)
        for k in np.unique(np.searchsorted(starts, np.flatnonzero(odd[codes]), "right") - 1).tolist():
            found = self._whole(texts[k].as_py() or "")
            parts += [out[bounds[done]:bounds[k]], found]
            counts[k], done = len(found), k + 1
        return np.concatenate([*parts, out[bounds[done]:]]), np.append(0, np.cumsum(counts))

    def _first(self, word: str) -> np.ndarray | None:
        """Ids of a text's start up to its first space; None where that is no cut."""
        if word != word.rstrip() or any(s in word for s in self.special):
            return None
        return np.array(self.plain.encode_ordinary(word), np.uint32)


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """One encoder per Python worker and file."""
    return ByteBpe(path)
