"""Quality rules of documents, and verdicts on hosts from shrunken failure rates.

DataFrame functions only. Hosts with few documents are drawn towards the rate of all hosts: the
rates get a beta prior whose mean and weight are estimated from all hosts by moments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .support import BROADCAST_ROWS, body, cut, cut_measuring, join_hot

# Words, what stands between them, and symbols (fixed values).
WORD, BLANKS = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
# A host is rejected if the shrunken share of its documents that fail is above this.
MAX_HOST_RATE = 0.5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(placed: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur twice or more, first occurrences included.

    ``placed`` holds the windows with their places (g, i) in order, so that equal ones are
    neighbours; the places that any of these covers are counted once.
    """
    def covers(g: Column, i: Column) -> Column:
        same = F.coalesce(F.get(placed, i - 1)["g"] == g["g"], F.lit(False)) | F.coalesce(F.get(placed, i + 1)["g"] == g["g"], F.lit(False))
        return F.when(same, F.sequence(g["i"], g["i"] + window - 1)).otherwise(F.array().cast("array<int>"))
    return F.size(F.array_distinct(F.flatten(F.transform(placed, covers))))


def measures(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The columns ``keep`` and the five counts of each row of ``docs``."""
    base = docs.select(*keep, body(text).alias("_text"))
    lines = F.filter(F.split("_text", "\n", -1), lambda s: s.rlike(WORD))
    cut_up = base.select(
        *keep, F.filter(F.split("_text", BLANKS, -1), lambda w: w != "").alias("_words"), lines.alias("_lines"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    last = F.size("_words") - WINDOW
    grams = F.when(last >= 0, F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.concat_ws(" ", *(F.get("_words", i + k) for k in range(WINDOW))))).otherwise(F.array().cast("array<string>"))
    found = cut_up.select(
        *keep, F.size("_words").cast("long").alias("n_words"), F.length(F.array_join("_words", "")).cast("long").alias("word_chars"), "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"), grams.alias("_grams"))
    # most texts repeat no window: only the others sort theirs
    placed = F.sort_array(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    some = F.size(F.array_distinct("_grams")) < F.size("_grams")
    found = found.select(*keep, *MEASURES[:4], F.when(some, placed).alias("_placed"))
    return found.select(*keep, *MEASURES[:4], F.when(F.col("_placed").isNull(), F.lit(0)).otherwise(
        repeated_words(F.col("_placed"))).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def host_rates(judged: DataFrame, host: str = "_host", failed: str = "base_failed") -> DataFrame:
    """Per host: documents, failures and the failure rate under the estimated beta prior.

    The prior's mean is the share of all documents that fail; its weight is found from the spread
    of the hosts' rates beyond what chance gives. Without such spread the weight is the number of
    documents of the mean host.
    """
    hosts = cut(judged.where(F.col(host).isNotNull()).groupBy(host).agg(
        F.count("*").alias("_n"), F.sum(F.col(failed).cast("long")).alias("n_failed")))
    whole = hosts.agg(F.sum("_n").alias("n"), F.sum("n_failed").alias("k"), F.count("*").alias("hosts"),
                      F.sum(F.col("_n") * F.pow(F.col("n_failed") / F.col("_n"), 2)).alias("squares"),
                      F.sum(F.col("_n") * F.col("_n")).alias("n2")).first()
    if not whole["n"]:
        return hosts.withColumn("rate", F.lit(0.0))
    n, mean = whole["n"], whole["k"] / whole["n"]
    chance = mean * (1 - mean)
    # spread of rates weighted by documents, less the binomial share of it
    between = whole["squares"] / n - mean * mean
    room = 1 - whole["n2"] / n / n
    extra = (between - chance * (whole["hosts"] - 1) / n) / (room or 1)
    weight = chance / extra - 1 if extra > 0 and chance > extra else n / whole["hosts"]
    return hosts.withColumn("rate", (F.col("n_failed") + mean * weight) / (F.col("_n") + F.lit(weight)))


def verdicts(docs: DataFrame, host: Column, *keep: str, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``keep``, the five counts, base_failed and kept of each row of ``docs``.

    A document is kept if it passes the base rules and its host's shrunken failure rate is at
    most ``max_rate``. A null text is an empty text, which fails. A null host is no host: such
    rows are judged by the base rules alone. Repeated rows are judged, and counted for their
    host, one by one. An empty table gives no rows. Other columns, whatever their names, are not
    read.
    """
    named = docs.select(*keep, host.alias("_host"), F.col("text").alias("_body"))
    judged, total = cut_measuring(
        measures(named, *keep, "_host", text="_body").withColumn("base_failed", base_failed()), F.count("*"))
    rejected, n = cut_measuring(host_rates(judged).where(F.col("rate") > max_rate).select(
        "_host", "_n", F.lit(True).alias("_rejected")), F.count("*"))
    if n <= BROADCAST_ROWS:
        joined = judged.join(F.broadcast(rejected.drop("_n")), "_host", "left")
    else:
        joined = join_hot(judged, rejected, "_host", total)
    return joined.select(*keep, *MEASURES, "base_failed", (~F.col("base_failed") & F.col("_rejected").isNull()).alias("kept"))


def kept_documents(docs: DataFrame, host: Column, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Rows of ``docs(doc_id, text)`` that ``verdicts`` keeps, with all their columns and no other.

    Rejected rows are named by doc_id and host, null included, and a hash of the text.
    """
    named = docs.select("doc_id", "text", F.xxhash64(body()).alias("_hash"), host.alias("_from"))
    judged = verdicts(named, F.col("_from"), "doc_id", "_hash", "_from", max_rate=max_rate)
    rejected, n = cut_measuring(judged.where("not kept").select("doc_id", "_hash", "_from").distinct(), F.count("*"))
    gone = F.broadcast(rejected) if n <= BROADCAST_ROWS else rejected.hint("shuffle_merge")
    same = docs["doc_id"].eqNullSafe(gone["doc_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == gone["_hash"])
    return docs.join(gone, same & host.eqNullSafe(gone["_from"]), "left_anti")
