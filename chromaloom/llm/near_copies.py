"""Near-duplicate classes of texts by the Jaccard likeness of their word shingles.

Two texts link if they share at least ``LEAST`` (in fifths) of all their different shingles of
``WORDS`` words. SimHash fingerprints of the shingles, searched through vantage-point trees,
propose the closest pairs. At 0.8 two 64-bit fingerprints differ in ten bits on average, which no
block of bits survives; so min-hashes propose the others: two texts with likeness s meet in a band
of ``ROWS`` of them with chance s**ROWS, and of ``BANDS`` bands a pair at 0.8 misses all with chance
2e-7. Every proposed pair is then decided by its shingles, not by its hashes.

What a text has alone bounds its likeness to any other: a shingle that no other candidate has is
never shared. Texts that have too many of them leave, and pairs are compared only where both
texts' own shingles leave room for the likeness.

The texts of a band's bucket are first compared with a few of them, the centres, those with the
fewest shingles of their own, so a large class of copies is connected by a few comparisons a text. Texts
of buckets that are still apart are then joined by prefixes: of two texts that are alike enough, with
their shingles ordered from rare to common, the first fifth of each has a shingle of the other's. A text
that is not quite alike a large class has rare shingles enough to meet almost none of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import simhash
from .support import BROADCAST_ROWS, body, by_batch, components, cut, cut_measuring, join_hot, own_tables
from .tokens import slices

WORDS = 5
# Least likeness, as numerator and denominator: shared shingles of all.
LEAST = (4, 5)
BANDS = 40
ROWS = 5
SEED = 7
# Centres of a bucket in each round of comparisons.
CENTRES = (1, 8)
# Largest list of longs that is broadcast; it is counted first.
BROADCAST_LONGS = 1_000_000

MARKS = "doc_id long, hash long, set_id long, n long, fp long, keys array<long>"


def band_keys(sets: list[np.ndarray], bands: int = BANDS, rows: int = ROWS, seed: int = SEED) -> np.ndarray:
    """One key per band for every set of hashes; no set may be empty."""
    rng = np.random.default_rng(seed)
    spread = rng.integers(0, 1 << 32, bands * rows, np.uint32) | np.uint32(1)
    moved = rng.integers(0, 1 << 32, bands * rows, np.uint32)
    mixed = rng.integers(0, 1 << 63, (bands, rows), np.uint64) | np.uint64(1)
    keys = np.empty((len(sets), bands), np.uint64)
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    at = np.cumsum([0, *(len(s) for s in sets[:-1])])
    for b in range(bands):
        key = np.full(len(sets), b + 1, np.uint64)
        for r in range(rows):
            k = b * rows + r
            least = np.minimum.reduceat(flat * spread[k] + moved[k], at)
            key = (key ^ (key >> np.uint64(29))) * mixed[b, r] + least
        keys[:, b] = key
    return keys.view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(p) for p in parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts).view(np.int64)))


def _set_ids(sets: list[np.ndarray]) -> pa.Array:
    return pa.array(np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64))


def marks(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, a hash of the text, and of its different shingles a hash, number, fingerprint and band keys, per row."""
    def task():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns: list[list[pa.Array]] = [[], [], [], []]
            for some in slices(batch.column(2), 2 << 20):
                found = [np.unique(simhash.shingle_hashes(t, words)) for t in some.to_pylist()]
                full = [s for s in found if len(s)]
                made = iter(band_keys(full)) if full else iter(())
                parts = (_set_ids(found), pa.array([len(s) for s in found], pa.int64()), pa.array(simhash.majority(found).view(np.int64)),
                         _lists([next(made) if len(s) else np.empty(0, np.int64) for s in found]))
                for column, part in zip(columns, parts, strict=True):
                    column.append(part)
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.concat_arrays, columns)], names=["doc_id", "hash", "set_id", "n", "fp", "keys"])
        return one
    return by_batch(docs.select("doc_id", F.xxhash64(body()).alias("hash"), body().alias("text")), MARKS, task)


def _shingles(docs: DataFrame, names: DataFrame, n: int, words: int) -> DataFrame:
    """set_id and shingles of the texts that ``names(doc_id, hash)``, ``n`` rows, name: one row a set."""
    def task():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [np.unique(simhash.shingle_hashes(t, words)) for some in slices(batch.column(0), 2 << 20) for t in some.to_pylist()]
            return pa.RecordBatch.from_arrays([_set_ids(found), _lists(found)], names=["set_id", "shingles"])
        return one
    return by_batch(_named(docs, names, n, "left_semi").select(body().alias("text")), "set_id long, shingles array<long>", task).dropDuplicates(["set_id"])


def _named(docs: DataFrame, names: DataFrame, n: int, how: str) -> DataFrame:
    """Semi or anti join of rows to ``names``: doc_id, null included, and the hash of the text."""
    same = docs["doc_id"].eqNullSafe(names["doc_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == names["hash"])
    return docs.join(F.broadcast(names) if n <= BROADCAST_ROWS else names.hint("shuffle_merge"), same, how)


def _only(rows: DataFrame, ids: DataFrame, key: str, n: int) -> DataFrame:
    return rows.join(F.broadcast(ids) if n <= BROADCAST_LONGS else ids.hint("shuffle_merge"), key, "left_semi")


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b whose shingles are alike enough."""
    both = (pairs.join(sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("_a")), "a")
            .join(sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("_b")), "b"))
    shared = F.size(F.array_intersect("_a", "_b"))
    return both.where(LEAST[1] * shared >= LEAST[0] * (F.size("_a") + F.size("_b") - shared)).select("a", "b")


def _room(n: Column, common: Column, other_n: Column, other_common: Column) -> Column:
    """Whether sets of n shingles, some of them not theirs alone, can be alike enough."""
    shared = F.least(common, other_common)
    return LEAST[1] * shared >= LEAST[0] * (n + other_n - shared)


def _close(firsts: DataFrame) -> DataFrame:
    """Pairs a, b of sets of ``firsts(set_id, n, fp)`` whose fingerprints differ by a few bits."""
    full = firsts.where("n > 0").select("set_id", "fp")
    distinct, n = cut_measuring(full.groupBy("fp").agg(F.min("set_id").alias("rep")), F.count("*"))
    equal = full.join(distinct, "fp").where("set_id != rep").select(F.col("rep").alias("a"), F.col("set_id").alias("b"))
    return simhash.linked(distinct, n).unionByName(equal).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def linked(docs: DataFrame, firsts: DataFrame, words: int = WORDS) -> DataFrame:
    """node and root (longs) of the sets that are linked to another.

    ``firsts`` (a written table) has a row per set: set_id, n, fp, keys, and doc_id and hash of one row with its text.
    """
    rows = firsts.select("set_id", F.explode("keys").alias("key"))
    shared, n = cut_measuring(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), F.count("*"))
    members = cut(_only(rows, shared, "key", n))
    close = cut(_close(firsts))
    wanted = members.select("set_id").unionByName(close.select(F.explode(F.array("a", "b")).alias("set_id"))).distinct()
    names, n = cut_measuring(firsts.select("set_id", "doc_id", "hash").join(wanted, "set_id"), F.count("*"))
    sets = cut(_shingles(docs, names, n, words))

    # shingles that one candidate alone has
    alone = sets.select("set_id", F.explode("shingles").alias("s")).groupBy("s").agg(F.min("set_id").alias("set_id"), F.count("*").alias("n")).where("n = 1")
    own = alone.groupBy("set_id").agg(F.count("*").alias("own"))
    sizes = sets.select("set_id", F.size("shingles").cast("long").alias("n")).join(own, "set_id", "left").select(
        "set_id", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("common"))
    sizes = cut(sizes.where(_room(F.col("n"), F.col("common"), F.col("common"), F.col("common"))))
    everyone = cut(members.join(sizes, "set_id"))

    found = cut(_alike(close, sets))
    compared, roots = close, components(found)

    def apart(members: DataFrame) -> DataFrame:
        """Members, with their present roots, of buckets that hold several."""
        named = roots.select(F.col("node").alias("set_id"), F.col("root").alias("_new"))
        rooted = cut(members.drop("root").join(named, "set_id", "left").withColumn("root", F.coalesce("_new", "set_id")).drop("_new"))
        several = rooted.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a != b").select("key")
        return cut(rooted.join(several, "key", "left_semi"))

    members = everyone
    for n_centres in CENTRES:
        members = apart(members)
        placed = F.row_number().over(Window.partitionBy("key").orderBy(F.col("common").desc(), "set_id"))
        centres = cut(members.withColumn("_at", placed).where(F.col("_at") <= n_centres).select(
            "key", F.col("set_id").alias("_set"), F.col("n").alias("_n"), F.col("common").alias("_common"), F.col("root").alias("_root")))
        near = (F.col("root") != F.col("_root")) & _room(F.col("n"), F.col("common"), F.col("_n"), F.col("_common"))
        pairs = members.join(centres, "key").where(near).select(F.least("set_id", "_set").alias("a"), F.greatest("set_id", "_set").alias("b")).distinct()
        pairs = cut(pairs.join(compared, ["a", "b"], "left_anti"))
        compared = compared.unionByName(pairs)
        found = found.unionByName(cut(_alike(pairs, sets)))
        roots = components(found)
        members = members.join(centres.select("key", F.col("_set").alias("set_id")), ["key", "set_id"], "left_anti")
    # centres come back: a text that is left may be alike one that was compared with others only
    members = apart(everyone)
    if members.isEmpty():
        return roots
    pairs = cut(_by_prefix(members.select("set_id", "root").distinct(), sets).join(compared, ["a", "b"], "left_anti"))
    return components(found.unionByName(cut(_alike(pairs, sets))))


def _by_prefix(some: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs a, b of ``some(set_id, root)`` of different roots that may be alike enough, all that are among them."""
    rows = cut(sets.join(some, "set_id").select("set_id", "root", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("s")))
    shared = rows.groupBy("s").agg(F.count("*").alias("df"))
    order = F.row_number().over(Window.partitionBy("set_id").orderBy("df", "s"))
    # if n - need + 1 shingles of a set are not shared, less than need are
    need = F.ceil(F.col("n") * LEAST[0] / LEAST[1])
    first = rows.join(shared, "s").withColumn("at", order - 1).where((F.col("at") <= F.col("n") - need) & (F.col("df") > 1)).select("s", "set_id", "root", "n", "at")
    first = cut(first)
    # the largest class of a shingle is not compared with itself
    main = first.groupBy("s", "root").agg(F.count("*").alias("m")).groupBy("s").agg(F.max(F.struct("m", "root")).alias("main")).select("s", F.col("main.root").alias("main"))
    others = first.join(main, "s").where("root != main").select("s", *(F.col(c).alias(f"_{c}") for c in ("set_id", "root", "n", "at")))
    left = F.least(F.col("n") - F.col("at"), F.col("_n") - F.col("_at"))
    room = LEAST[1] * left >= LEAST[0] * (F.col("n") + F.col("_n") - left)
    return first.join(others, "s").where((F.col("root") != F.col("_root")) & room).select(
        F.least("set_id", "_set_id").alias("a"), F.greatest("set_id", "_set_id").alias("b")).distinct()


def _copies(docs: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """Names (doc_id, hash) of rows that go, and of those of which one of several equal rows stays."""
    marked, total = cut_measuring(marks(docs, words), F.count("*"))
    name = F.struct("doc_id", "hash")
    firsts = cut(marked.groupBy("set_id").agg(F.min(name).alias("name"), *(F.any_value(c).alias(c) for c in ("n", "fp", "keys"))).select("set_id", "name.*", "n", "fp", "keys"))
    roots = linked(docs, firsts, words)
    named = marked.where("doc_id is not null").select("doc_id", "hash", "set_id")
    sets, n_sets = cut_measuring(named.groupBy("set_id").agg(F.count("*").alias("rows"), F.min(name).alias("first"))
                                 .join(roots.select(F.col("node").alias("set_id"), "root"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id")), F.count("*"))
    whole = cut(sets.groupBy("root").agg(F.sum("rows").alias("all"), F.min("first").alias("kept"), F.count("*").alias("_n")).where("all > 1").drop("all"))
    table = cut(join_hot(sets, whole, "root", n_sets, "inner").select("set_id", F.col("rows").alias("_n"), "kept"))
    several = cut(join_hot(named, table, "set_id", total, "inner"))
    drop = several.where(name != F.col("kept")).select("doc_id", "hash").distinct()
    again = several.where(name == F.col("kept")).groupBy("doc_id", "hash").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "hash")
    return drop, again


def one_of_each(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` with one row of each class: that with the smallest doc_id, of those the smallest hash of the text.

    Texts with equal shingles are one set: null and empty texts and those of white space, and
    repeated rows. A text of fewer than ``words`` words is one shingle, and so linked to equal texts
    only. Rows with a null doc_id stay. All columns are kept and no column is added. Rows are named
    by doc_id and a hash of the text, so those that share a doc_id are told apart. Only the lists
    of names outlast the call; its other tables are deleted.
    """
    with own_tables(docs.sparkSession) as keep:
        drop, again = map(keep, _copies(docs, words))
    kept, n = _named(docs, drop, drop.count(), "left_anti"), again.count()
    if not n:
        return kept
    repeated = _named(kept, again, n, "left_semi").withColumn("_whole_text", body()).dropDuplicates(["doc_id", "_whole_text"]).drop("_whole_text")
    return _named(kept, again, n, "left_anti").unionByName(repeated)
