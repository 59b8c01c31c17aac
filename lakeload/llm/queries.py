"""The operators as queries over whole tables, with SQL where it can say the same."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.llm import chat_windows, decontaminate, fixity, importance, interpolation, line_spread, link_trust, lsh_forest, multiset_hash, packing, piece_agenda, spelling_variants, token_alignment
from lakeload.llm.scratch import prepare, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, Callable[[str], DataFrame]], DataFrame]) -> Callable:
    """Register ``build(spark, table)`` under its name; ``table(name)`` reads a table of the scale folder."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return build(spark, lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

    QUERIES[build.__name__] = run
    return build


# ---- 1: chat formatting ------------------------------------------------------
CHAT_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"


class Digest:
    """What is read back from the windows of one conversation."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.n_turns, self.loss_chars, self.formatted_chars, self.n_windows = conv_id, 0, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, window) -> None:
        turns = chat_windows.read_turns(window.formatted)
        system = turns[: window.n_system] if self.n_windows == 0 else []
        for role, text in [*system, *turns[window.n_system + window.n_history :]]:
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        for span in window.loss_spans:
            text = chat_windows.plain(window.formatted[span["start"] : span["start"] + span["length"]])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.formatted_chars += len(window.formatted)
        self.n_windows += 1

    def row(self) -> tuple:
        return self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars, self.n_windows


def chat_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Windows sorted by conversation and span -> a row per conversation; holds one batch at a time."""
    names = [c.split(" ")[0] for c in CHAT_DIGEST.split(", ")]
    current = None
    for batch in batches:
        done = []
        for window in batch.itertuples(index=False):
            conv_id = None if pd.isna(window.conv_id) else int(window.conv_id)
            if current is None or current.conv_id != conv_id:
                done += [current.row()] if current else []
                current = Digest(conv_id)
            current.add(window)
        yield pd.DataFrame(done, columns=names)
    if current:
        yield pd.DataFrame([current.row()], columns=names)


@query
def op1_chat_windows(spark: SparkSession, table: Callable[[str], DataFrame]) -> DataFrame:
    """Digests of all conversations as read back from their windows."""
    text = "</s>[INST] ok [/INST]"
    marked = spark.sql("select -7L conv_id, col1 turn, col2 role, col3 text from values (0L, 'user', :text), (1L, 'assistant', :text)", args={"text": text})
    turns = table("conversations").select("conv_id", "turn", "role", "text").unionByName(marked)
    found = chat_windows.windows(turns)
    ordered = found.repartition("conv_id").sortWithinPartitions("conv_id", "first_position")
    return ordered.mapInPandas(chat_digests, CHAT_DIGEST)


# ---- 2: quality --------------------------------------------------------------
@query
def op2_importance_resampling(spark: SparkSession, table: Callable[[str], DataFrame]) -> DataFrame:
    """The documents drawn, with their log weights."""
    return importance.resample(table("documents"), table("labels")).filter("selected").select("doc_id", "log_weight", "key")


# ---- 3: packing --------------------------------------------------------------
@query
def op3_certified_packing(spark: SparkSession, table: Callable[[str], DataFrame]) -> DataFrame:
    """Each piece of every document with its place in a sequence."""
    packed = packing.pack_documents(table("documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


# ---- 4: near-duplicates ------------------------------------------------------
@query
def op4_lsh_forest(spark: SparkSession, table: Callable[[str], DataFrame]) -> DataFrame:
    """Components of documents whose sets of two-word shingles are similar."""
    return lsh_forest.near_duplicates(table("documents"), width=2, percent=80)


# SQL counts the common shingles of all pairs that share one.
ORACLE_SQL["op4_lsh_forest"] = r"""
with recursive words as (
  select doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents),
sets as (
  select doc_id, list_distinct(case when w is null or len(w) = 0 then [] when len(w) = 1 then [w[1]]
                                    else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as s
  from words),
sizes as (select doc_id, len(s) as n, list_sort(s) as s from sets),
nodes as (select min(doc_id) as node, n, s from sizes where n > 0 group by n, s),
shingles as (select node, n, unnest(s) as shingle from nodes),
links as (
  select a.node as a, b.node as b
  from shingles a join shingles b on a.shingle = b.shingle and a.node < b.node and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  group by a.node, b.node, a.n, b.n
  having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways as (select a, b from links union all select b, a from links),
reached as (select a as node, a as other from both_ways union select r.node, e.b from reached r join both_ways e on e.a = r.other),
parts as (select node, min(other) as part from reached group by node)
select d.doc_id, d.n as n_shingles, coalesce(p.part, k.node, d.doc_id) as component_id, d.doc_id = coalesce(p.part, k.node, d.doc_id) as kept
from sizes d left join nodes k on d.n > 0 and k.n = d.n and k.s = d.s left join parts p on p.node = k.node"""


# ---- 5: url filters ----------------------------------------------------------
@query
def op5_link_trust(spark: SparkSession, table: Callable[[str], DataFrame]) -> DataFrame:
    """Verdict on every page's url."""
    rules = spark.sql("select * from values {} as r(verdict, rule_host, rule_path)".format(", ".join(map(str, link_trust.RULES))))
    return link_trust.judged_pages(table("pages"), rules).select("page_id", "host", "path", "rule", "verdict")


# ---- 6: fixity ---------------------------------------------------------------
@query
def op6_merkle_audit(spark: SparkSession, table: Callable[[str], DataFrame]) -> DataFrame:
    """Damage in a replica of all pages: every 97th record has another first sign, every 89th is lost."""
    pages = table("pages")
    flipped = F.concat(F.when(F.startswith("html", F.lit("~")), "!").otherwise("~"), F.substr("html", F.lit(2)))
    hit = (F.col("page_id") % 97 == 5) & (F.ascii("html").between(1, 127))
    replica = fixity.page_records(pages.withColumn("html", F.when(hit, flipped).otherwise(F.col("html"))))
    lost = F.coalesce(F.col("record_id") % 89 == 7, F.lit(False))
    return fixity.audit(fixity.page_records(pages), replica.filter(~lost))


ORACLE_SQL["op6_merkle_audit"] = r"""
with record as (
  select page_id as record_id, coalesce(html, '') as html,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
         || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '
         || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) as head
  from pages),
both_copies as (
  select record_id, head || html || chr(13) || chr(10) || chr(13) || chr(10) as payload,
         case when record_id % 89 = 7 then null
              when record_id % 97 = 5 and html <> '' and ascii(html) < 128
                then head || case when html like '~%' then '!' else '~' end || substr(html, 2) || chr(13) || chr(10) || chr(13) || chr(10)
              else head || html || chr(13) || chr(10) || chr(13) || chr(10) end as found
  from record),
placed as (
  select record_id, record_id // 512 as file_no, strlen(payload) as length, sha256(payload) as digest, sha256(found) as found_digest,
         coalesce(sum(strlen(payload)) over (partition by record_id // 512 order by record_id rows between unbounded preceding and 1 preceding), 0) as place
  from both_copies)
select record_id, file_no, cast(place as bigint) as "offset", length, digest, found_digest,
       case when found_digest is null then 'missing' else 'corrupt' end as status
from placed where found_digest is null or found_digest <> digest"""


# ---- 7: language-model scores ------------------------------------------------
@query
def op7_deleted_interpolation(spark: SparkSession, table: Callable[[str], DataFrame]) -> DataFrame:
    """Scores of all documents by a model of those whose id does not have the remainder 2."""
    remainder = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7
    return interpolation.score_texts(table("documents"), remainder == 2)


# ---- 8: line dedup -----------------------------------------------------------
@query
def op8_line_spread(spark: SparkSession, table: Callable[[str], DataFrame]) -> DataFrame:
    """What cross-site boilerplate removal leaves of each document."""
    left = line_spread.without_boilerplate(table("documents"))
    text = F.coalesce("text", F.lit(""))
    return left.select("doc_id", "n_removed_lines", F.length(text).cast("long").alias("n_chars"), F.sha2(text, 256).alias("text_sha256"))


ORACLE_SQL["op8_line_spread"] = r"""
with lines as (
  select doc_id, source, text, unnest(string_split(text, chr(10))) as raw_line, unnest(range(0, len(string_split(text, chr(10))))) as place
  from documents),
long_lines as (
  select doc_id, source, text, raw_line, place, trim(raw_line, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) as line,
         length(trim(raw_line, ' ' || chr(9) || chr(13) || chr(12) || chr(11))) >= 20 as counts
  from lines),
spread as (select line, min(doc_id) as keeper from long_lines where counts
           group by line having count(distinct coalesce(source, '')) >= 8 and count(distinct text) >= 2),
judged as (select l.doc_id, l.place, l.raw_line, s.keeper is not null and s.keeper <> l.doc_id as lost
           from long_lines l left join spread s on l.counts and s.line = l.line),
left_over as (select doc_id, count(*) filter (lost) as n_removed_lines, coalesce(string_agg(raw_line, chr(10) order by place) filter (not lost), '') as text
              from judged group by doc_id)
select d.doc_id, coalesce(n_removed_lines, 0) as n_removed_lines, coalesce(length(l.text), 0) as n_chars, sha256(coalesce(l.text, '')) as text_sha256
from documents d left join left_over l using (doc_id)"""


# ---- 9: fingerprints ---------------------------------------------------------
@query
def op9_multiset_hash(spark: SparkSession, table: Callable[[str], DataFrame]) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses."""
    return multiset_hash.edited_fingerprints(table("documents"))


# ---- 10: decontamination -----------------------------------------------------
@query
def op10_prefix_decontamination(spark: SparkSession, table: Callable[[str], DataFrame]) -> DataFrame:
    """Words of each document inside windows of benchmark items."""
    found = decontaminate.benchmark_hits(table("documents"), table("benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    n_hit = decontaminate.hit_words(F.col("hits"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


ORACLE_SQL["op10_prefix_decontamination"] = r"""
with doc_words as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
item_words as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
item_windows as (
  select distinct item_id, unnest(case when len(w) between 1 and 9 then [array_to_string(w, ' ')]
                                       else list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' ')) end) as run
  from item_words),
widths as (select distinct len(string_split(run, ' ')) as width from item_windows),
doc_windows as (
  select doc_id, width, unnest(range(1, len(w) - width + 2)) as start,
         unnest(list_transform(range(1, len(w) - width + 2), lambda i: array_to_string(w[i:i + width - 1], ' '))) as run
  from doc_words, widths where len(w) >= width),
found as (select doc_id, start, width, item_id from doc_windows join item_windows using (run)),
hit as (select doc_id, count(distinct word) as n_hit from (select doc_id, unnest(range(start, start + width)) as word from found) group by doc_id),
held as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
         from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id)
select d.doc_id, coalesce(len(w), 0) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words d left join hit using (doc_id) left join held using (doc_id)"""


# ---- 11: spelling variants ---------------------------------------------------
@query
def op11_trie_frontier(spark: SparkSession, table: Callable[[str], DataFrame]) -> DataFrame:
    """Words of the corpus, the more frequent spelling one edit away, and where such spellings end."""
    return spelling_variants.spelling_variants(table("documents"))


# SQL has no crc32: it is folded over the bytes with a table made by its rule. Words one edit apart agree
# without one character, or one of them is the other without one.
ORACLE_SQL["op11_trie_frontier"] = r"""
with recursive crc_table as (
  select list(entry order by b) as entries
  from (select b, list_reduce(list_transform(range(9), lambda i: case when i = 0 then b else 0 end),
                              lambda c, i: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) as entry
        from (select unnest(range(256)) as b))),
runs as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) as run from documents)
  group by all),
said as (select run, n, coalesce(doc_id::varchar, '') || ':' || run as said, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as digits from runs where length(run) >= 5),
hashed as (
  select run, n,
         xor(list_reduce([4294967295::bigint] || list_transform(range(1, len(digits) + 1, 2), lambda i: ('0x' || substr(digits, i, 2))::bigint),
                         lambda c, byte: xor(c // 256, entries[xor(c % 256, byte) + 1])), 4294967295::bigint) as h
  from said, crc_table),
words as (
  select word, sum(n)::bigint as n
  from (select n, case when h % 97 = 0 then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end as word from hashed)
  where length(word) >= 5 group by word having sum(n) >= 3),
cuts as (select word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as place from words)),
pairs as (
  select a.word, b.word as near, b.n as near_n from cuts a join cuts b on a.rest = b.rest and a.place = b.place and a.word <> b.word
  union select a.word, b.word, b.n from cuts a join words b on a.rest = b.word
  union select b.word, a.word, a.n from cuts a join words b on a.rest = b.word),
best as (select word, count(*) as n_near, max(near_n) as best_n, min(near) filter (near_n = top) as near
         from (select *, max(near_n) over (partition by word) as top from pairs) group by word),
forms as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when best_n >= 2 * w.n then near end as form, case when best_n >= 2 * w.n then best_n end as form_n
          from words w left join best b using (word)),
chains as (select word, word as root from forms union all select c.word, f.form from chains c join forms f on f.word = c.root where f.form is not null),
ends as (select c.word, c.root from chains c join forms f on f.word = c.root where f.form is null)
select word, form, root, n, n_near, form_n from forms join ends using (word)"""


# ---- 12: SentencePiece -------------------------------------------------------
@query
def op12_piece_agenda(spark: SparkSession, table: Callable[[str], DataFrame]) -> DataFrame:
    """Digests of every document's ids and of what they decode to."""
    encoded = piece_agenda.encode_documents(table("documents"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


# ---- 13: alignment of two vocabularies ---------------------------------------
@query
def op13_space_anchors(spark: SparkSession, table: Callable[[str], DataFrame]) -> DataFrame:
    """Groups and links of every document's tokens in two vocabularies, weighed by the links of the corpus."""
    aligned = token_alignment.aligned_documents(table("documents"))
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256))
    aligned = aligned.withColumns({"groups_sha256": digest, "row": F.monotonically_increasing_id()}).drop("groups")
    weighed = token_alignment.with_pair_counts(written(aligned, "aligned"))
    return weighed.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
