"""Queries of this subpackage over the given tables, and their SQL twins."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, decontaminate, host_rules, html_text, line_crf, orc_tokens, packing, prefix_trie, simhash, spellings, tokens, warc,
               winnowing, word_bpe)
from .support import cut, cut_measuring, join_hot, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of all pages in its layout."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of 2048 tokens."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokens.default_vocabulary())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op5_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents written to ORC files and read back."""
    path = new_folder(spark, "ids")
    orc_tokens.write_ids(table(spark, sf_dir, "documents"), path, tokens.default_vocabulary())
    return orc_tokens.positions(spark, path)


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate classes of all documents."""
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


@query
def op6_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents and their decoded texts, as digests."""
    encoded = word_bpe.encode(table(spark, sf_dir, "documents"), word_bpe.default_vocabulary())
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of an archive of all pages, put together again from its files."""
    path = new_folder(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.reconstruct(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


TWINS["op8_warc"] = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, strlen(html) as payload_bytes, sha1(html) as h, min(page_id) over (partition by sha256(html)) as first from p),
g as (select page_id, payload_bytes, first, i, cast('0x' || substr(h, cast(i * 5 + 1 as bigint), 5) as bigint) as v from d, range(8) as r(i)),
c as (select page_id, payload_bytes, first, string_agg(
 substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 15) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 10) & 31) + 1, 1)
 || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 5) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v & 31) + 1, 1), '' order by i) as payload_digest
 from g group by 1, 2, 3)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type,
 case when page_id <> first then first end as refers_to from c
"""


@query
def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents; the host of a document is its source."""
    found = host_rules.verdicts(table(spark, sf_dir, "documents"), F.col("source"), "doc_id")
    return found.select("doc_id", *host_rules.MEASURES, "base_failed", "kept")


TWINS["op9_host_rules"] = r"""
with t as (select doc_id, source, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
 list_filter(string_split(text, chr(10)), lambda s: length(regexp_replace(s, '[\x20\x09-\x0D]', '', 'g')) > 0) as lines from t),
g as (select doc_id, source, unnest(range(1, len(words) - 1)) as i, words from w),
h as (select doc_id, i, count(*) over (partition by doc_id, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) as n from g),
r as (select doc_id, count(distinct p) as n_repeat_words from (select doc_id, unnest([i, i + 1, i + 2]) as p from h where n > 1) group by 1),
m as (select w.doc_id, source, cast(len(words) as bigint) as n_words,
 cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
 cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
 cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words
 from w left join r using (doc_id)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m),
s as (select source, count(*) as n, cast(count(*) filter (where base_failed) as bigint) as k from b where source is not null group by 1),
a as (select sum(n) as n, sum(k) / sum(n) as mean, count(*) as hosts, sum(n * pow(k / n, 2)) / sum(n) as squares, sum(n * n) as n2 from s),
e as (select *, mean * (1 - mean) as chance, (squares - mean * mean - mean * (1 - mean) * (hosts - 1) / n)
 / case when 1 - n2 / n / n = 0 then 1 else 1 - n2 / n / n end as extra from a),
q as (select mean, case when extra > 0 and chance > extra then chance / extra - 1 else n / hosts end as weight from e),
v as (select source, (k + mean * weight) / (n + weight) > 0.5 as rejected from s, q)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not coalesce(rejected, false) as kept
from b left join v using (source)
"""


@query
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted, written and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    written = cut(chat.conversations(chat.best_conversations(chat.chains(turns.unionByName(more)))))
    return chat.digests(chat.read_turns(chat.turns_of(written))).drop("branch").withColumnRenamed("tree", "conv_id")


TWINS["op10_chat"] = r"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
 union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
 cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
 sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
 cast(sum(length('<|im_start|>') + length(role) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + length('<|im_end|>') + 1) as bigint) as formatted_chars
from t group by conv_id
"""


@query
def op7_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = line_crf.fit(docs, table(spark, sf_dir, "labels"))
    return line_crf.scores(docs, model).select("doc_id", line_crf.held_out().alias("held_out"), "score", "predicted")


@query
def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    found = winnowing.edits(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), winnowing.string("kept").alias("fingerprint"),
                        winnowing.string("edited_kept").alias("edited_fingerprint"), "near_edited", "near_next")


def shared_starts(rows: DataFrame) -> DataFrame:
    """Conversations rebuilt: up to five turns of the conversation at the hundred below, then their own."""
    rows, total = cut_measuring(rows.withColumns({"base": F.col("conv_id") - F.col("conv_id") % 100,
                                                  "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6}), F.count("*"))
    ids = rows.select("conv_id", "base", "h").distinct()
    heads = rows.where("conv_id = base and pos < 5").select("base", "pos", "role", "text")
    lent = ids.join(heads, "base").where("pos < h").select("conv_id", "pos", "role", "text")
    bases = cut(rows.groupBy("base").agg(F.count("*").alias("_n"), F.coalesce(F.sum(F.expr("if(conv_id = base, 1, 0)")), F.lit(0)).alias("there")))
    own = join_hot(rows.where("pos >= h"), bases, "base", total)
    return lent.unionByName(own.select("conv_id", (F.col("pos") - F.col("h") + F.least("h", "there")).alias("pos"), "role", "text"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all conversations, rebuilt so that they share starts."""
    rows = cut(prefix_trie.placed(table(spark, sf_dir, "conversations")))
    return prefix_trie.nodes(shared_starts(rows), rows)


# a list t of the 256 entries of the table of crc32, and the unsigned crc32 of a text by it
CRC_TABLE = "c8 as (select list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: xor(a >> 1, 3988292384 * (a & 1))) order by i) as t from range(256) as r(i))"


def crc(text: str) -> str:
    each = f"list_transform(range(octet_length(encode({text}))), lambda k: cast('0x' || substr(hex({text}), 2 * k + 1, 2) as bigint))"
    return f"xor(list_reduce(list_prepend(cast(4294967295 as bigint), {each}), lambda a, z: xor(a >> 8, t[(xor(a, z) & 255) + 1])), 4294967295)"


TWINS["op11_prefix_trie"] = f"""
with {CRC_TABLE},
o as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as pos, coalesce(role, '') as role, coalesce(text, '') as text
 from conversations where conv_id is not null),
c as (select conv_id, count(*) as n, {crc("cast(conv_id as varchar)")} % 6 as h, conv_id - conv_id % 100 as base from o, c8 group by conv_id, t),
r as (select c.conv_id, pos, role, text from c join o on o.conv_id = c.base where pos < h
 union all select o.conv_id, pos - c.h + least(c.h, coalesce(b.n, 0)), role, text from o join c on o.conv_id = c.conv_id left join c as b on b.conv_id = c.base where pos >= c.h),
w as (select conv_id, coalesce(list({{'role': role, 'text': text}} order by pos) filter (where pos is not null), []) as turns from c left join r using (conv_id) group by conv_id),
p as (select conv_id, unnest(range(0, len(turns) + 1)) as depth, turns from w),
g as (select depth, turns[1:depth] as path, min(conv_id) as conv_id, count(*) as n_convs, string_agg(conv_id, ',' order by conv_id) filter (where len(turns) = depth) as ends from p group by 1, 2),
k as (select depth - 1 as depth, path[1:depth - 1] as path, count(*) as n_children from g where depth > 0 group by 1, 2),
f as (select g.*, coalesce(n_children, 0) as n_children, case when g.depth = 0 then 0 else (n_convs - 1) * length(g.path[g.depth].text) end as saved from g left join k using (depth, path)),
s as (select d as depth, path[1:d] as path, sum(saved) as saved_tokens, count(*) filter (where n_children = 0) as n_leaves from (select *, unnest(range(0, depth + 1)) as d from f) group by 1, 2)
select f.conv_id, f.depth, q.conv_id as parent_conv_id, f.n_convs, f.n_children, n_leaves, cast(saved_tokens as bigint) as saved_tokens, sha256(coalesce(f.ends, '')) as ends_sha256
from f join s using (depth, path) left join g as q on q.depth = f.depth - 1 and q.path = f.path[1:f.depth - 1]
"""


def loses_letters(doc_id: int | None) -> Callable[[str], str]:
    """One of 199 different runs of a document loses a letter."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())

    def word(run: str) -> str:
        h = zlib.crc32(run.encode(), start)
        if h % 199:
            return run
        return run[:h % len(run)] + run[h % len(run) + 1:]
    return word


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, some made to lose a letter, with their near words, forms and roots."""
    return spellings.variants(spellings.word_counts(table(spark, sf_dir, "documents"), spelt=loses_letters))


TWINS["op12_spelling_variants"] = f"""
with recursive {CRC_TABLE},
r as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) as run from documents),
u as (select doc_id, run, count(*) as n from r where length(run) >= 6 group by 1, 2),
h as (select run, n, {crc("coalesce(cast(doc_id as varchar), '') || ':' || run")} as h from u, c8),
w as (select case when h % 199 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, cast(sum(n) as bigint) as n from h group by 1 having sum(n) >= 5 and length(word) >= 6),
d as (select word, n, i, substr(word, 1, i) || substr(word, i + 2) as less from (select word, n, unnest(range(length(word))) as i from w)),
e as (select a.word, b.word as other, b.n as n_other from d a join d b on a.i = b.i and a.less = b.less and a.word <> b.word
 union select d.word, w.word, w.n from d join w on d.less = w.word union select w.word, d.word, d.n from d join w on d.less = w.word),
b as (select word, count(*) as n_near, first(other order by n_other desc, other) as other, max(n_other) as m from e group by 1),
f as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when m >= 5 * w.n then other end as form, case when m >= 5 * w.n then m end as form_n from w left join b using (word)),
s as (select word, word as top, form from f union all select s.word, f.word, f.form from s join f on f.word = s.form)
select f.word, f.form, top as root, n, n_near, form_n from f join s on s.word = f.word and s.form is null
"""


TWINS["op13_decontamination"] = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
i as (select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
p as (select item, w, unnest(range(1, greatest(len(w) - 8, 2))) as p from i where len(w) > 0),
g as (select distinct item, least(len(w), 10) as n, array_to_string(w[p:p + 9], ' ') as s from p),
o as (select doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') as s from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as p from d, (select distinct n from g))),
f as (select doc_id, item, n, p from o join g using (n, s)),
h as (select doc_id, count(distinct p + j) as n_hit from (select doc_id, p, unnest(range(n)) as j from f) group by 1),
m as (select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256 from (select distinct doc_id, item from f) group by 1)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
 coalesce(items_sha256, sha256('')) as items_sha256, n_hit is not null as contaminated from d left join h using (doc_id) left join m using (doc_id)
"""


@query
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that lie in a window of a benchmark item, and these items."""
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
