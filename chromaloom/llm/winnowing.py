"""Document fingerprints by winnowing, with DataFrame functions only.

A text is a run of tokens, each hashed once: its words, but for words longer than ``LONG`` and
texts of too few words the runs of ``LETTERS`` code points at every place. Hashes of K tokens roll
over them as polynomials. Of each window of W hashes the smallest is kept, of equal ones the
rightmost, with its position. So any run of W + K - 1 tokens that two texts share is found, and a
kept hash needs no more than its window to be chosen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .support import body, cut, cut_measuring, numbered

K = 3
W = 8
# Code points of a word above which it is taken by letters, and of a letter token (a power of two).
LONG = 24
LETTERS = 4
# What stands between words (fixed value).
BLANKS = r"[\x20\x09-\x0D]+"
# Token hashes have 30 bits; the hash of K tokens is a polynomial in BASE modulo a prime (fixed value).
BITS = (1 << 30) - 1
PRIME = 1_073_741_789
BASE = 610_839_777
# A hash and its position as one long: the smaller hash is smaller, of equal ones the rightmost.
PLACES = 1 << 31


def _hash(token: Column) -> Column:
    return F.hash(token).bitwiseAND(F.lit(BITS)).cast("long")


def _joined(power: int):
    return lambda x, y: (x * power + y) % PRIME


def letter_tokens(text: Column, letters: int = LETTERS) -> Column:
    """Hashes of the runs of ``letters`` code points at every place, from those of half as long ones; a shorter text is one token."""
    found, width = F.transform(F.split(text, ""), _hash), 1
    while width < letters:
        power, left = pow(BASE, width, PRIME), F.greatest(F.length(text) - (2 * width - 1), F.lit(0))
        found = F.zip_with(F.slice(found, F.lit(1), left), F.slice(found, F.lit(width + 1), left), _joined(power))
        width *= 2
    return F.when(F.length(text) >= letters, found).otherwise(F.array(_hash(text)))


def tokens_of(text: Column, k: int = K, w: int = W) -> tuple[Column, Column]:
    """Words of a text, and the token hashes of a column ``_words`` of words."""
    words = F.filter(F.split(text, BLANKS, -1), lambda x: x != "")
    column = F.col("_words")
    plain = F.transform(column, _hash)
    mixed = F.flatten(F.transform(column, lambda x: F.when(F.length(x) > LONG, letter_tokens(x)).otherwise(F.array(_hash(x)))))
    few = F.size(column) < w + k - 1
    tokens = F.when(few & (F.size(column) > 0), letter_tokens(F.array_join(column, " "))).when(
        F.exists(column, lambda x: F.length(x) > LONG), mixed).otherwise(plain)
    return words, tokens


def keys_of(tokens: Column, k: int = K) -> Column:
    """Hash and position of every run of ``k`` token hashes, as longs; fewer tokens are one run, no token none."""
    n = F.size(tokens)
    powers = [pow(BASE, k - 1 - j, PRIME) & BITS for j in range(k)]

    def rolled(x: Column, i: Column) -> Column:
        total = x * powers[0]
        for j in range(1, k):
            total = total + F.get(tokens, i + j) * powers[j]
            if j % 4 == 3:  # a sum of a few products of 30 bits fits a long
                total = total % PRIME
        return (total % PRIME) * PLACES - i

    runs = F.transform(F.slice(tokens, F.lit(1), F.greatest(n - (k - 1), F.lit(0))), rolled)
    short = F.array(F.hash(tokens).bitwiseAND(F.lit(BITS)).cast("long") * PLACES)
    return F.when(n >= k, runs).when(n > 0, short).otherwise(F.array().cast("array<long>"))


def minima(keys: Column, w: int = W) -> Column:
    """The kept keys of all windows of ``w`` (a power of two) in order of position; fewer are one window.

    Minima of 2, 4, 8 … keys come from those of half as many.
    """
    found, width = keys, 1
    while width < w:
        found = F.zip_with(found, F.slice(found, F.lit(width + 1), F.greatest(F.size(found) - width, F.lit(0))), lambda x, y: F.least(x, y))
        width *= 2
    whole = F.slice(found, F.lit(1), F.greatest(F.size(keys) - (w - 1), F.least(F.size(keys), F.lit(1))))
    return F.array_distinct(whole)


def position(key: Column) -> Column:
    return F.pmod(-key, F.lit(PLACES))


def hash_of(key: Column) -> Column:
    return ((key + position(key)) / PLACES).cast("int")


def fingerprints(rows: DataFrame, text: str = "text", out: str = "kept", k: int = K, w: int = W) -> DataFrame:
    """``rows`` with the kept keys of ``text`` as the array ``out``. Null is an empty text, which has none."""
    words, tokens = tokens_of(body(text), k, w)
    step = rows.withColumn("_words", words).withColumn("_tokens", tokens).drop("_words")
    return step.withColumn("_keys", keys_of(F.col("_tokens"), k)).drop("_tokens").withColumn(out, minima(F.col("_keys"), w)).drop("_keys")


def positions(rows: DataFrame, text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """One row per kept hash: the other columns of ``rows``, hash and position (in tokens, from 0)."""
    found = fingerprints(rows, text, "_kept", k, w).drop(text)
    return found.withColumn("_key", F.explode("_kept")).withColumns({"hash": hash_of(F.col("_key")), "position": position(F.col("_key"))}).drop("_kept", "_key")


def hashes(kept: str) -> Column:
    """Hashes of a fingerprint in order of position."""
    return F.transform(kept, lambda x: F.shiftright(x + (PLACES - 1), 31).cast("int"))


def string(found: str) -> Column:
    """Hashes of a fingerprint, eight hexadecimal digits each."""
    return F.array_join(F.transform(found, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: str, b: str) -> Column:
    """Twice the shared different hashes over those of both fingerprints, from 0 to 1; two empty ones are alike."""
    shared, every = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(every == 0, 1.0).otherwise(2 * shared / F.greatest(every + shared, F.lit(1)))


def edits(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of ``docs(doc_id, text)``, of their edited texts and their likeness.

    The next document is that of the next smaller doc_id, after the smallest the largest. The
    edited text has the last floor(n_chars / 3) code points replaced by as many first ones of the
    next document, or all it has. Columns: doc_id, n_chars, edited, kept, edited_kept (hashes in
    order of position), and near_edited, near_next.

    One row per row. Null text is an empty text. Rows that share a doc_id follow each other in the
    order of a hash of their texts, equal ones side by side; null doc_ids come after all others. An
    empty table gives no rows; other columns are not read.
    """
    name = ["key", "hash"]
    texts = docs.select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("key"), body().alias("text")).withColumn("hash", F.xxhash64("text", F.col("doc_id").isNull()))
    ids = cut(texts.select("doc_id", *name, F.length("text").alias("n")))
    repeated, n_repeated = cut_measuring(ids.groupBy(*name).agg(F.count("*").alias("times"), F.any_value("n").alias("n"), F.any_value("doc_id").alias("doc_id")).where("times > 1"), F.count("*"))
    if n_repeated:
        texts, ids = texts.dropDuplicates(name), ids.dropDuplicates(name)
    # each document goes to the one before it, with as many code points as that one replaces
    order, total = numbered(ids, [F.col("doc_id").desc_nulls_last(), F.col("hash")], "at")
    order, third = cut(order), F.floor(F.col("n") / 3).cast("int").alias("take")
    to = [F.col(c).alias(f"to_{c}") for c in (*name, "doc_id")]
    before = order.select(F.pmod(F.col("at") + 1, F.lit(max(total, 1))).alias("at"), *to, third)
    sent = order.select("at", *name).join(before, "at").select(*name, "to_key", "to_hash", "to_doc_id", "take", F.lit(1).cast("long").alias("times"))
    if n_repeated:  # all but the last of equal rows go before one of their own kind
        sent = sent.unionByName(repeated.select(*name, *to, third, (F.col("times") - 1).alias("times")))
    # one exchange of the texts serves both joins
    own = fingerprints(texts, "text", "_kept", k, w).select(*name, "text", hashes("_kept").alias("kept")).hint("shuffle_merge")
    heads = own.join(sent.hint("shuffle_merge"), name).select(
        F.col("to_key").alias("key"), F.col("to_hash").alias("hash"), F.col("to_doc_id").alias("doc_id"), F.substring("text", F.lit(1), F.col("take")).alias("head"), F.col("kept").alias("next_kept"), "times")
    joined = own.join(heads.hint("shuffle_merge"), name)
    n = F.length("text")
    changed = joined.select("doc_id", n.cast("long").alias("n_chars"), F.concat(F.substring("text", F.lit(1), n - F.floor(n / 3).cast("int")), "head").alias("edited"), "kept", "next_kept", "times")
    found = fingerprints(changed, "edited", "_kept", k, w).withColumn("edited_kept", hashes("_kept"))
    out = found.select("doc_id", "n_chars", "edited", "kept", "edited_kept", likeness("kept", "edited_kept").alias("near_edited"), likeness("kept", "next_kept").alias("near_next"), "times")
    return (out.withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), "times"))) if n_repeated else out).drop("times")
