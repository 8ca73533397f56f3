"""Content-addressed archive of WARC records.

Payload bytes are stored once under their SHA-256; exact record headers are stored separately,
one row per record. Joins put the original records together again. Payloads are checked against
their digest when they are read. DataFrame functions only.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .support import BROADCAST_ROWS, HOT_PARTS, cut_measuring, join_hot

# Alphabets of base 32: of the digits Spark writes, and of RFC 4648 (fixed values).
DIGITS, RFC4648 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_PREFIX = "urn:page:"


def base32(hexadecimal: Column, digits: int = 40) -> Column:
    """RFC 4648 base 32 of hexadecimal digits, five of which are four letters."""
    groups = [F.lpad(F.conv(F.substring(hexadecimal, at, 5), 16, 32), 4, "0") for at in range(1, digits, 5)]
    return F.translate(F.concat(*groups), DIGITS, RFC4648)


def digested(pages: DataFrame) -> DataFrame:
    """page_id, url and payload of ``pages(page_id, url, html)`` with length and digests."""
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    return rows.select("page_id", "url", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
                       F.sha2("payload", 256).alias("address"), base32(F.sha1("payload")).alias("payload_digest"))


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit(RECORD_PREFIX), F.coalesce(page_id.cast("string"), F.lit("")))


def header(kind: Column, date: str) -> Column:
    """The exact header of a record of ``date`` (UTC, ISO 8601), up to the empty line before its block."""
    def line(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(name + ": "), F.lit(value) if isinstance(value, str) else value, F.lit(CRLF))

    response = kind == "response"
    # a line break in a url would end the header line
    url = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "%", "%25"), "\r", "%0D"), "\n", "%0A")
    return F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", kind), line("WARC-Record-ID", F.concat(F.lit("<"), record_id(F.col("page_id")), F.lit(">"))),
        line("WARC-Date", date), line("WARC-Target-URI", F.when(F.col("url").rlike("[%\r\n]"), url).otherwise(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(response, "").otherwise(F.concat(line("WARC-Profile", PROFILE), line("WARC-Refers-To", F.concat(F.lit("<"), record_id(F.col("refers_to")), F.lit(">"))))),
        line("Content-Length", F.when(response, F.col("payload_bytes")).otherwise(0).cast("string")), F.lit(CRLF))


def write_archive(pages: DataFrame, path: str, least: int = 0, date: str | None = None) -> None:
    """Write ``pages(page_id, url, html)`` as an archive: tables ``payloads`` and ``records`` under ``path``.

    Of records with equal payloads of at least ``least`` bytes the one with the smallest page_id
    is the response and the others are revisits; shorter ones are responses, whose payload is
    still stored once. Null html is an empty payload, a null url an empty one; null page_ids come
    after all others; of rows that share the smallest page_id the first read is the response; an
    empty table gives an empty archive; other columns are not read. ``date`` is that of all
    records, the present one by default.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    narrow, total = cut_measuring(
        digested(pages).select("page_id", "url", "payload_bytes", "address", "payload_digest", F.monotonically_increasing_id().alias("row")), F.count("*"))
    same_page = narrow.groupBy("address", "page_id", "payload_bytes").agg(F.count("*").alias("times"), F.min("row").alias("row"))
    first, n_payloads = cut_measuring(
        same_page.groupBy("address").agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row", "times", "payload_bytes")).alias("_first"), F.sum("times").alias("_n"))
        .select("address", F.col("_first.page_id").alias("_page"), F.col("_first.row").alias("_row"), F.col("_first.times").alias("_times"), F.col("_first.payload_bytes").alias("_bytes"), "_n"),
        F.count("*"))
    _payloads(pages, first, n_payloads).write.parquet(f"{path}/payloads")
    kinds = join_hot(narrow, first.where((F.col("_n") > 1) & (F.col("_bytes") >= least)).select("address", "_page", "_row", "_n"), "address", total)
    revisit = F.col("_row").isNotNull() & (F.col("_row") != F.col("row"))
    records = kinds.withColumn("kind", F.when(revisit, "revisit").otherwise("response")).withColumn("refers_to", F.when(revisit, F.col("_page")))
    records.select("page_id", "address", header(F.col("kind"), date).cast("binary").alias("header")).write.parquet(f"{path}/records")


def _payloads(pages: DataFrame, first: DataFrame, n: int) -> DataFrame:
    """address and payload, once each. Up to a number of payloads the rows that hold them are picked without an exchange."""
    rows = digested(pages).select("address", "page_id", "payload")
    if n > BROADCAST_ROWS:
        return rows.select("address", "payload").dropDuplicates(["address"])
    picked = rows.join(F.broadcast(first.select(F.col("address").alias("_address"), "_page", "_times")),
                       (F.col("address") == F.col("_address")) & F.col("page_id").eqNullSafe(F.col("_page")))
    once = picked.where("_times = 1").select("address", "payload")
    if first.where("_times > 1").isEmpty():
        return once
    return once.unionByName(picked.where("_times > 1").select("address", "payload").dropDuplicates(["address"]))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records with what their headers say: page_id, url, payload_bytes, payload_digest, record_type, refers_to, address."""
    rows = spark.read.schema("page_id long, address string, header binary").parquet(f"{path}/records")
    text = F.decode("header", "UTF-8")

    def field(name: str) -> Column:
        return F.regexp_extract(text, rf"\r\n{name}: ([^\r]*)\r\n", 1)

    def page(name: str) -> Column:
        return F.regexp_extract(field(name), rf"^<{RECORD_PREFIX}(-?[0-9]+)>$", 1)

    def number(c: Column) -> Column:
        return F.when(c != "", c).cast("long")

    url = F.regexp_replace(F.regexp_replace(F.regexp_replace(field("WARC-Target-URI"), "%0A", "\n"), "%0D", "\r"), "%25", "%")
    return rows.select(number(page("WARC-Record-ID")).alias("page_id"), url.alias("url"), number(field("X-Payload-Length")).alias("payload_bytes"),
                       F.regexp_extract(field("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("payload_digest"), field("WARC-Type").alias("record_type"),
                       number(page("WARC-Refers-To")).alias("refers_to"), "address", "header")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Payloads with the digests of the bytes as they are now; a payload that changed ends the job."""
    rows = spark.read.schema("address string, payload binary").parquet(f"{path}/payloads")
    checked = F.when(F.sha2("payload", 256) == F.col("address"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payload differs from its digest: "), "address")))
    return rows.select("address", checked.alias("payload"))


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """Every record as it was written, put together from its header and its payload.

    Columns: page_id, url, record_type, refers_to, record (its exact bytes), and payload_bytes and
    payload_digest, taken of a response's block in the record and, for a revisit, of the stored
    payload it stands for. A record without its payload, or whose header says otherwise, ends the job.
    A payload travels to its response only; what many revisits share is its length and digest.
    """
    records, total = cut_measuring(read_records(spark, path), F.count("*"))
    counts, _ = cut_measuring(records.groupBy("address", "record_type").agg(F.count("*").alias("_n")), F.count("*"))
    payloads, end = read_payloads(spark, path), F.lit(CRLF + CRLF).cast("binary")

    def own(kind: str) -> DataFrame:
        return counts.where(F.col("record_type") == kind).select("address", "_n")

    # only payloads too short to be revisited have several responses
    responses = records.where("record_type = 'response'")
    if own("response").where(F.col("_n") > max(total // HOT_PARTS, 1000)).isEmpty():
        whole = responses.join(payloads, "address", "left")
    else:
        whole = join_hot(responses, payloads.join(own("response"), "address"), "address", total)
    whole = whole.withColumn("record", F.concat("header", "payload", end))
    block = F.substring("record", F.octet_length("header") + 1, F.octet_length("record") - F.octet_length("header") - 4)
    whole = whole.withColumn("block", block).withColumns({"_bytes": F.octet_length("block").cast("long"), "_digest": base32(F.sha1("block"))})
    revisits = join_hot(records.where("record_type = 'revisit'"), payloads.select("address", F.octet_length("payload").cast("long").alias("_bytes"), base32(F.sha1("payload")).alias("_digest"))
                        .join(own("revisit"), "address"), "address", total).withColumn("record", F.concat("header", end))
    right = F.col("_bytes").eqNullSafe(F.col("payload_bytes")) & F.col("_digest").eqNullSafe(F.col("payload_digest"))
    wrong = F.raise_error(F.concat(F.lit("record differs from its payload: "), "address")).cast("long")
    columns = ["page_id", "url", "record_type", "refers_to", "record", F.when(right, F.col("_bytes")).otherwise(wrong).alias("payload_bytes"), "payload_digest"]
    return whole.select(*columns).unionByName(revisits.select(*columns))
