"""Prefix trie of conversations by SQL ROLLUP over columns of turn ids.

The turns of a conversation are dealt to blocks of ``WIDTH`` columns. ``rollup`` over the columns of
a block aggregates all its prefixes together; ``grouping_id`` tells their depth. Longer
conversations go on in the next block, keyed by the node of the block before, which its depth and
its smallest member name. A conversation that shares its node with no other has no prefix to share
any more: the rest of its turns is a chain that is written without a rollup, so the number of
rollups follows the longest shared prefix, not the longest conversation. Sums over subtrees are
rollups as well, over the nodes, from the last block to the first.

Equal conversations are one class with a count: copies are not aggregated turn by turn.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .support import cut, cut_measuring, join_hot, numbered

WIDTH = 6
# Members of a piece of a list that is digested; rows of a chain that are added up at a time.
PIECE = 4096
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def placed(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 0 in each conversation), role, text of ``turns(conv_id, turn, role, text)``.

    Null turns come first; turns of one number follow each other by role and text, repeated rows
    too; null roles and texts are empty; rows with a null conv_id are of no conversation and left
    out. A conversation that holds a third of all rows is dealt over many tasks.
    """
    rows = turns.where("conv_id is not null").select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows, total = numbered(rows, [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")])
    firsts = cut(rows.groupBy("conv_id").agg(F.min("_index").alias("_first"), F.count("*").alias("_n")))
    return join_hot(rows, firsts, "conv_id", total).select("conv_id", (F.col("_index") - F.col("_first")).alias("pos"), "role", "text")


def turn_id() -> Column:
    """Length of the text, in code points, and a strong digest of role and text."""
    return F.concat_ws(":", F.length("text").cast("string"), F.substring(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256), 1, 32))


def chars(turn: Column) -> Column:
    return F.substring_index(turn, ":", 1).cast("long")


def classes(cells: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Equal conversations: conv_id and first (the class) of each, and first, n_turns, weight of each class."""
    marks = [F.xxhash64("pos", "tid"), F.xxhash64("tid", F.lit(7), "pos")]
    own = cells.select("conv_id", F.lit(1).cast("long").alias("one"), marks[0].alias("a"), marks[1].alias("b")).unionByName(
        members.select("conv_id", *(F.lit(0).cast("long").alias(c) for c in ("one", "a", "b"))))
    marked, total = cut_measuring(own.groupBy("conv_id").agg(F.sum("one").alias("n_turns"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
                                  .select("conv_id", F.struct("n_turns", "a", "b").alias("same")), F.count("*"))
    found = cut(marked.groupBy("same").agg(F.min("conv_id").alias("first"), F.count("*").alias("_n")))
    whole = found.select("first", F.col("same.n_turns").alias("n_turns"), F.col("_n").alias("weight"))
    return join_hot(marked, found.where("_n > 1"), "same", total, "inner").select("conv_id", "first"), whole


def list_digests(members: DataFrame) -> DataFrame:
    """first and ends_sha256 of each list of members (first, conv_id): ids in order, joined by commas.

    Lists are joined in pieces; a list of several pieces is streamed through one digest, which
    cannot be split. No list is held whole.
    """
    rows, _ = numbered(members, [F.col("first"), F.col("conv_id")])
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = cut(rows.groupBy("first", F.floor(F.col("_index") / PIECE).alias("piece")).agg(ids.alias("ids")))
    several = pieces.groupBy("first").count().where("count > 1").select("first", F.lit(True).alias("several"))
    marked = cut(pieces.join(several, "first", "left"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for first, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if first != key:
                    done += [] if key is None else [(key, digest.hexdigest())]
                    key, digest = first, sha256()
                else:
                    digest.update(b",")
                digest.update(ids.as_py().encode())
            yield _rows(done)
        yield _rows([] if key is None else [(key, digest.hexdigest())])

    def _rows(done: list[tuple[int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["first", "ends_sha256"])

    long = marked.where("several").select("first", "ids", "piece").repartition("first").sortWithinPartitions("first", "piece")
    return marked.where("several is null").select("first", F.sha2("ids", 256).alias("ends_sha256")).unionByName(
        long.select("first", "ids").mapInArrow(run, "first long, ends_sha256 string"))


def _rolled(rows: DataFrame, sums: str, width: int) -> DataFrame:
    """up, path (turn ids of the block from its start) and ``sums`` of every prefix of ``rows(up, t0, ...)``."""
    names = ", ".join(f"t{k}" for k in range(width))
    found = rows.sparkSession.sql(f"select up, {width} - bit_count(grouping_id()) as level, array({names}) as turns, {sums} from {{rows}} group by up, rollup({names})", rows=rows)
    return found.where("level > 0 and turns[level - 1] is not null").withColumn("path", F.expr("slice(turns, 1, level)")).drop("turns", "level")


def _above(path: str = "path") -> Column:
    return F.slice(path, F.lit(1), F.size(path) - 1)


def _tails(cells: DataFrame, alone: list[DataFrame], total: int) -> DataFrame:
    """Chains of the classes that share no node any more: conv_id, pos, from, n_turns, weight, rest (characters from pos on)."""
    ends = cut(reduce(DataFrame.unionByName, alone))
    rows = cut(join_hot(cells, ends, "conv_id", total, "inner").where("pos >= from").select(
        "conv_id", "pos", "from", "n_turns", "weight", chars(F.col("tid")).alias("chars"), F.floor(F.col("pos") / PIECE).alias("chunk")))
    # what follows a turn: the later chunks of its chain, and later turns of its own chunk
    copied = rows.where("weight > 1")
    later = Window.partitionBy("conv_id").orderBy(F.col("chunk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    chunks = copied.groupBy("conv_id", "chunk").agg(F.sum("chars").alias("_chars")).withColumn("_later", F.coalesce(F.sum("_chars").over(later), F.lit(0))).drop("_chars")
    here = Window.partitionBy("conv_id", "chunk").orderBy(F.col("pos").desc())
    summed = copied.withColumn("_here", F.sum("chars").over(here)).join(chunks, ["conv_id", "chunk"]).withColumn("rest", F.col("_here") + F.col("_later"))
    columns = ["conv_id", "pos", "from", "n_turns", "weight", "rest"]
    return cut(summed.select(*columns).unionByName(rows.where("weight = 1").withColumn("rest", F.lit(0).cast("long")).select(*columns)))


def nodes(turns: DataFrame, members: DataFrame, width: int = WIDTH) -> DataFrame:
    """The nodes of the trie of ``turns(conv_id, pos, role, text)`` and ``members(conv_id)``.

    ``turns`` as ``placed`` gives them: positions of each conversation from 0 without gaps. All
    conv_ids of turns are members; members without turns end at the root. Per node: conv_id (the
    smallest member, which with the depth names it), depth, parent_conv_id (null for the root),
    n_convs, n_children, n_leaves (childless nodes of the subtree, itself included), saved_tokens (the
    sum over the subtree of n_convs - 1 times the characters of the last text), ends_sha256 (of the
    members that end there). Without members there are no nodes; other columns are not read.
    """
    spark = turns.sparkSession
    members = cut(members.where("conv_id is not null").select("conv_id").distinct())
    cells, total = cut_measuring(turns.select("conv_id", F.col("pos").cast("long").alias("pos"), turn_id().alias("tid")), F.count("*"))
    copies, whole = classes(cells, members)
    copies, whole = cut(copies), cut(whole)
    top = whole.agg(F.min("first"), F.sum("weight"), F.min(F.when(F.col("n_turns") == 0, F.col("first")))).first()
    if top[1] is None:
        return spark.createDataFrame([], NODES)
    own = cut(join_hot(cells, whole.where("n_turns > 0").select(F.col("first").alias("conv_id"), "n_turns", "weight", F.col("n_turns").alias("_n")), "conv_id", total, "inner"))
    names = [f"t{k}" for k in range(width)]
    at = [F.max(F.when(F.col("pos") % width == k, F.col("tid"))).alias(names[k]) for k in range(width)]
    blocks = cut(own.groupBy("conv_id", "n_turns", "weight", F.floor(F.col("pos") / width).alias("block")).agg(*at))

    layers, alone, b = [], [], 0
    rows = blocks.where("block = 0").withColumn("up", F.lit(top[0]))
    while not rows.isEmpty():
        found = cut(_rolled(rows, "min(conv_id) as conv_id, sum(weight) as n_convs, count(*) as n_rows", width))
        ended = rows.where(F.col("n_turns") <= (b + 1) * width).select(
            "up", F.slice(F.array(*names), F.lit(1), (F.col("n_turns") - b * width).cast("int")).alias("path"), F.col("conv_id").alias("ends"))
        layers.append((found, cut(ended)))
        longer = rows.where(F.col("n_turns") > (b + 1) * width).select("conv_id", "n_turns", "weight", F.struct("up", F.array(*names).alias("path")).alias("key"))
        full = cut(found.where(F.size("path") == width).select(F.struct("up", "path").alias("key"), F.col("conv_id").alias("new"), "n_convs", F.col("n_rows").alias("_n")))
        on = cut(join_hot(longer, full, "key", total, "inner").select("conv_id", "n_turns", "weight", F.col("new").alias("up"), (F.col("n_convs") == F.col("weight")).alias("alone")))
        alone.append(on.where("alone").select("conv_id", F.lit((b + 1) * width).cast("long").alias("from"), F.col("n_turns").alias("_n")))
        b += 1
        rows = blocks.where(F.col("block") == b).join(on.where("not alone").select("conv_id", "up"), "conv_id")

    results = []
    below = {}  # by block: what lies under its last nodes, by their smallest member
    if layers:
        tails = _tails(own.select("conv_id", "pos", "tid", "n_turns", "weight"), alone, total)
        results.append(tails.select(
            "conv_id", (F.col("pos") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"), F.col("weight").alias("n_convs"),
            (F.col("pos") + 1 < F.col("n_turns")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
            ((F.col("weight") - 1) * F.col("rest")).alias("saved_tokens"), F.when(F.col("pos") + 1 == F.col("n_turns"), F.col("conv_id")).alias("ends")))
        starts = tails.where(F.col("pos") == F.col("from")).select(
            F.col("conv_id").alias("up"), F.col("from").alias("depth"), F.lit(1).cast("long").alias("kids"), F.lit(1).cast("long").alias("leaves"),
            ((F.col("weight") - 1) * F.col("rest")).alias("saved"))
        below = {k: starts.where(F.col("depth") == (k + 1) * width).drop("depth") for k in range(len(layers))}
    under = None
    for k in reversed(range(len(layers))):
        found, ended = layers[k]
        hung = below[k] if under is None else below[k].unionByName(under)
        none = [F.lit(None).cast("long").alias(c) for c in ("n_convs", "conv_id", "ends", "kids", "leaves", "saved")]

        def part(df: DataFrame, **given: Column) -> DataFrame:
            return df.select("up", "path", *(given[c].cast("long").alias(c) if c in given else n for c, n in zip(("n_convs", "conv_id", "ends", "kids", "leaves", "saved"), none, strict=True)))

        inner = found.where(F.size("path") > 1).groupBy("up", _above().alias("path")).agg(F.count("*").alias("kids"))
        outer = found.where(F.size("path") == width).select("up", "path", "conv_id").join(hung.withColumnRenamed("up", "conv_id"), "conv_id")
        parts = [part(found, n_convs=F.col("n_convs"), conv_id=F.col("conv_id")), part(ended, ends=F.col("ends")), part(inner, kids=F.col("kids")),
                 part(outer, kids=F.col("kids"), leaves=F.col("leaves"), saved=F.col("saved"))]
        known = cut(reduce(DataFrame.unionByName, parts).groupBy("up", "path").agg(*(F.max(c).alias(c) for c in ("n_convs", "conv_id", "ends", "kids", "leaves", "saved"))))
        # every node adds its own share to the prefixes above it
        shares = known.select("up", *(F.get("path", F.lit(i)).alias(names[i]) for i in range(width)),
                              F.when(F.col("kids").isNull(), 1).otherwise(F.coalesce("leaves", F.lit(0))).alias("leaves"),
                              ((F.col("n_convs") - 1) * chars(F.element_at("path", -1)) + F.coalesce("saved", F.lit(0))).alias("saved"))
        sums = _rolled(shares, "sum(leaves) as n_leaves, sum(saved) as saved_tokens", width)
        table = cut(known.drop("leaves", "saved").join(sums, ["up", "path"]))
        parents = cut(table.where("kids is not null").select(F.struct("up", "path").alias("key"), F.col("conv_id").alias("parent_conv_id"), F.col("kids").alias("_n")))
        deep = table.where(F.size("path") > 1).withColumn("key", F.struct("up", _above().alias("path")))
        named = join_hot(deep, parents, "key", total).drop("key").unionByName(table.where(F.size("path") == 1).withColumn("parent_conv_id", F.col("up")))
        results.append(named.select("conv_id", (F.size("path") + k * width).cast("long").alias("depth"), "parent_conv_id", "n_convs", F.coalesce("kids", F.lit(0)).cast("long").alias("n_children"),
                                    "n_leaves", "saved_tokens", "ends"))
        under = cut(table.where(F.size("path") == 1).groupBy("up").agg(F.count("*").alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")))
    first = (under.select("kids", "leaves", "saved").first() if under is not None else None) or (0, 1, 0)
    results.append(spark.createDataFrame([(top[0], 0, None, top[1], *first, top[2])], NODES.replace("ends_sha256 string", "ends long")))

    digests = list_digests(copies).unionByName(
        whole.where("weight = 1").select("first", F.sha2(F.col("first").cast("string"), 256).alias("ends_sha256")))
    return reduce(DataFrame.unionByName, results).join(digests.withColumnRenamed("first", "ends"), "ends", "left").drop("ends").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)))
