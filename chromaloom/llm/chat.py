"""Reply trees to training conversations with a reversible template and a loss mask.

Messages name their parent. Distances to the root, path scores and the ancestors of chosen
leaves come from self-joins that double their step each round, so a conversation of depth d takes
about log2(d) rounds. Branches are ranked by the sum of their messages' scores. Every chosen path
becomes one conversation, a text with the spans that the loss is taken on; one of more than
``PART`` turns has a row for each so many, which bounds what a row gathers.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .support import cut, cut_measuring, numbered

# Strings of the template (fixed values).
START, END = "<|im_start|>", "<|im_end|>"
LEARNT = "assistant"
# Turns of a row of a conversation.
PART = 256


def escape(text: Column) -> Column:
    """Control strings begin with "<|"; a backslash goes between, and one more where there are some."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def chains(turns: DataFrame) -> DataFrame:
    """Conversations by turn as reply trees: each message replies to the one of the turn before.

    Reads conv_id, turn, role, text; gives tree, message, parent, role, text, score. Messages are
    numbered over all conversations in the order of a range sort, so a conversation that holds a
    third of all rows is dealt over many tasks. Turns that share a number are ordered by role and
    text, so repeated rows follow each other; null turns come first, null conv_ids are one
    conversation; null roles and texts are empty.
    """
    rows = turns.select(F.col("conv_id").alias("tree"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows, _ = numbered(rows, [F.col("tree").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "message")
    before = rows.select((F.col("message") + 1).alias("message"), F.col("tree").alias("_tree"), F.col("message").alias("_parent"))
    return rows.join(before, "message", "left").select(
        "tree", "message", F.when(F.col("tree").eqNullSafe(F.col("_tree")), F.col("_parent")).alias("parent"), "role", "text", F.lit(1.0).alias("score"))


def ranked_paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """The ``best`` root-to-leaf paths of each tree: tree, branch (rank from 1), message, depth (root 0).

    ``messages``: tree, message, parent (null or absent for a root), score; tree and message
    together are unique. Branches are ranked by the sum of scores on their path, then by the
    smaller leaf. Messages on a circle have no root and are left out. A null tree is a tree like
    others, a null score counts nothing.
    """
    own = cut(messages.select(F.coalesce(F.concat(F.lit("k"), F.col("tree").cast("string")), F.lit("")).alias("tree_key"), "tree", "message", "parent",
                              F.coalesce("score", F.lit(0.0)).cast("double").alias("score")))
    there = own.select("tree_key", F.col("message").alias("parent"), F.lit(True).alias("there"))
    # up: the message 2**k steps above; depth and score: what lies below it
    steps, n = cut_measuring(own.join(there, ["tree_key", "parent"], "left").select(
        "tree_key", "tree", "message", F.when(F.col("there"), F.col("parent")).alias("up"),
        F.when(F.col("there"), 1).otherwise(0).cast("long").alias("depth"), "score"), F.count("*"))
    # messages that have reached their root take no part in further rounds
    jumps, moving, arrived = [], steps.where("up is not null"), steps.where("up is null")
    while not moving.isEmpty() and 1 << len(jumps) <= 2 * n:
        jumps.append(moving.select("tree_key", "message", "up"))
        above = arrived.unionByName(moving).select(
            "tree_key", F.col("message").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"), F.col("score").alias("_score"))
        steps = cut(moving.join(above, ["tree_key", "up"]).select(
            "tree_key", "tree", "message", F.col("_up").alias("up"),
            (F.col("depth") + F.col("_depth")).alias("depth"), (F.col("score") + F.col("_score")).alias("score")))
        moving, arrived = steps.where("up is not null"), arrived.unionByName(steps.where("up is null"))
    rooted = arrived
    leaves = rooted.join(jumps[0].select("tree_key", F.col("up").alias("message")), ["tree_key", "message"], "left_anti") if jumps else rooted
    marked = cut(_ranked(leaves, best))
    # ancestors at every distance, as a sum of powers of two
    for jump in reversed(jumps):
        further = marked.join(jump, ["tree_key", "message"]).select("tree_key", "branch", F.col("up").alias("message"))
        marked = cut(marked.unionByName(further).distinct())
    return marked.join(rooted.select("tree_key", "tree", "message", "depth"), ["tree_key", "message"]).select("tree", "branch", "message", "depth")


def _ranked(leaves: DataFrame, best: int) -> DataFrame:
    """The best leaves per tree. Only the best few of each part of a tree are compared at the end."""
    order = [F.col("score").desc(), F.col("message").asc()]
    part = F.pmod(F.xxhash64("message"), F.lit(64))
    some = leaves.withColumn("_part", part)
    some = some.withColumn("_r", F.row_number().over(W.partitionBy("tree_key", "_part").orderBy(*order))).where(F.col("_r") <= best)
    return (some.withColumn("branch", F.row_number().over(W.partitionBy("tree_key").orderBy(*order)))
            .where(F.col("branch") <= best).select("tree_key", "branch", "message"))


def formatted_turns(paths: DataFrame) -> DataFrame:
    """Formatted turns of paths (tree, branch, depth, role, text).

    Columns tree, branch, depth, piece and loss_from, loss_to: the run of the piece, in code
    points, that the loss is taken on (empty unless the role is the learnt one). Roles are
    written in URL encoding, which leaves plain names as they are and holds any other.
    """
    head = F.concat(F.lit(START), F.url_encode("role"), F.lit("\n"))
    inner = escape(F.col("text"))
    learnt = F.col("role") == LEARNT
    at = F.length(head).cast("long")
    return paths.select("tree", "branch", "depth", F.concat(head, inner, F.lit(END + "\n")).alias("piece"),
                        at.alias("loss_from"), F.when(learnt, at + F.length(inner)).otherwise(at).alias("loss_to"))


def read_turns(formatted: DataFrame) -> DataFrame:
    """Roles and texts back from formatted turns: adds role, text and loss_text (null outside the mask)."""
    head = F.substring_index("piece", "\n", 1)
    role = F.url_decode(F.substring(head, F.lit(len(START) + 1), F.length(head)))
    start = F.length(head) + 2
    text = unescape(F.substring("piece", start, F.length("piece") - F.length(head) - len(END) - 2))
    masked = F.substring("piece", (F.col("loss_from") + 1).cast("int"), (F.col("loss_to") - F.col("loss_from")).cast("int"))
    return formatted.select("*", role.alias("role"), text.alias("text"), F.when(F.col("loss_to") > F.col("loss_from"), unescape(masked)).alias("loss_text"))


def best_conversations(messages: DataFrame, best: int = 1) -> DataFrame:
    """Formatted turns of the best branches of ``messages(tree, message, parent, role, text, score)``.

    Null roles and texts are empty; of a repeated message (same tree and message) the smallest row
    counts; an empty table gives no rows; other columns are not read.
    """
    columns = ["parent", "role", "text", "score"]
    whole = cut(messages.select("tree", "message", *columns))
    if not whole.groupBy("tree", "message").count().where("count > 1").isEmpty():
        whole = cut(whole.groupBy("tree", "message").agg(F.min(F.struct(*columns)).alias("_m")).select("tree", "message", "_m.*"))
    paths = cut(ranked_paths(whole, best)).alias("p")
    joined = paths.join(whole.alias("m"), F.col("p.tree").eqNullSafe(F.col("m.tree")) & (F.col("p.message") == F.col("m.message")))
    return formatted_turns(joined.select("p.tree", "branch", "depth", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))


def conversations(formatted: DataFrame, turns: int = PART) -> DataFrame:
    """Formatted turns as conversations: tree, branch, part, text, and spans in the order of turns.

    A span has the start of its turn in the text and the run that the loss is taken on, loss_from
    to loss_to, in code points. Parts are numbered from 0; up to ``turns`` turns there is one.
    """
    turn = F.struct("depth", "piece", "loss_from", "loss_to")
    rows = formatted.groupBy("tree", "branch", F.floor(F.col("depth") / turns).alias("part")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    spans = F.expr("""aggregate(turns, struct(0L as at, cast(array() as array<struct<start: bigint, loss_from: bigint, loss_to: bigint>>) as spans),
        (acc, x) -> struct(acc.at + length(x.piece) as at, concat(acc.spans, array(struct(acc.at as start, acc.at + x.loss_from as loss_from, acc.at + x.loss_to as loss_to))) as spans),
        acc -> acc.spans)""")
    return rows.select("tree", "branch", "part", F.array_join(F.transform("turns", lambda x: x["piece"]), "").alias("text"), spans.alias("spans"))


def turns_of(whole: DataFrame, turns: int = PART) -> DataFrame:
    """Formatted turns back from conversations, whose text is cut where turns end."""
    ends = F.split("text", r"(?<=<\|im_end\|>\n)(?=<\|im_start\|>)")
    rows = whole.select("tree", "branch", "part", F.posexplode(F.arrays_zip(ends.alias("piece"), F.col("spans"))).alias("at", "x"))
    return rows.select("tree", "branch", (F.col("part") * turns + F.col("at")).alias("depth"), "x.piece",
                       (F.col("x.spans.loss_from") - F.col("x.spans.start")).alias("loss_from"), (F.col("x.spans.loss_to") - F.col("x.spans.start")).alias("loss_to"))


def digests(read: DataFrame) -> DataFrame:
    """Per branch of ``read_turns``: n_turns, digests of its turns and of the text under the loss mask.

    Turns are streamed in order through running digests, so memory does not grow with a branch.
    """
    schema = "tree long, branch int, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    rows = read.select("tree", "branch", "depth", "role", "text", "loss_text", F.length("piece").alias("n_chars"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, turns, loss, counts, out = None, None, None, [0, 0, 0], []

        def close() -> None:
            if key is not None:
                out.append((*key, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=types)
            out.clear()
            return batch

        names = ["tree", "branch", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = pa.schema([(n, pa.string() if n.endswith("sha256") else pa.int32() if n == "branch" else pa.int64()) for n in names])
        for batch in batches:
            for tree, branch, _, role, text, loss_text, n_chars in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (tree, branch) != key:
                    close()
                    key, turns, loss, counts = (tree, branch), sha256(), sha256(), [0, 0, 0]
                turns.update(f"{role}\n{text}\n".encode())
                loss.update((loss_text or "").encode())
                counts = [counts[0] + 1, counts[1] + len(loss_text or ""), counts[2] + n_chars]
            yield flush()
        close()
        yield flush()

    return rows.repartition("tree", "branch").sortWithinPartitions("tree", "branch", "depth").mapInArrow(run, schema)
