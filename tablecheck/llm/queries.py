"""One query per operator over the given tables, and the SQL where it can express the query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path
from . import ann, chat, decontamination, html, langid, lexical, lm, minhash, packing, quality, repair, simhash, simple8b

QUERIES = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def remainder(n: int):
    """The row's fold: crc32 of its id as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(remainder(3) != 1))
    found = langid.language_column(model, F.col("text"))
    return docs.select("doc_id", (remainder(3) == 1).alias("held_out"), found.alias("found")).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score", "found.accepted"
    )


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.filter(remainder(4) != 2))
    return docs.select(
        "doc_id", (remainder(4) == 2).alias("held_out"), quality.score_column(model, F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= quality.ACCEPT).cast("int"))


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file; the files are not part of this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = "</s>[INST] ok [/INST]"
    more = spark.sql(
        f"select * from values (-7L, 0L, 'user', '{odd}'), (-7L, 1L, 'assistant', '{odd}') as t(conv_id, turn, role, text)"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    path = scratch_path(spark, "chats")
    chat.format_conversations(turns).write.parquet(path)
    return chat.digests(spark.read.parquet(path))


ORACLE["op3_chat_formatting"] = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked as (
  select *, lag(role) over (partition by conv_id order by turn, role, text) is not distinct from role as goes_on,
         length(regexp_replace(text, '([<\[|\\])', '\1\\', 'g')) as chars,
         length(regexp_replace(role, '([<\[|\\])', '\1\\', 'g')) as role_chars
  from turns
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(chars + case when goes_on then 8 else 18 + role_chars end) as bigint) as formatted_chars
from marked group by conv_id
"""


@query
def op10_approximate_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


@query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op1_simple8b_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ids")
    simple8b.write_ids(table(spark, sf_dir, "documents"), path, tokenizer("byte_bpe_50k.json"))
    return simple8b.digests(spark, path)


@query
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    train = docs.filter(remainder(10) != 0)
    counts = lm.count_words(train)
    scored = lm.score(docs, lm.fit(train, counts), counts)
    return scored.withColumn("held_out", remainder(10) == 0)


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    return repair.repair_digests(repair.damaged(turns, F.crc32(name.cast("binary")) % 20))


# DuckDB has no crc32, so it is spelled out bit by bit. The cheapest edits are found row by row: for each state the
# least (cost, edits) of all ways to it, which is exact because equal costs never make one of two edit texts begin the other.
ORACLE["op13_conversation_repair"] = r"""
with recursive keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as name
  from conversations
), marked as (
  select *, xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(name, ''), lambda x: ord(x)::ubigint)),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), list_transform(range(8), lambda b: b::ubigint)),
             lambda c, b: case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end)), 4294967295::ubigint) % 20 as mark
  from keyed
), damaged as (
  select conv_id, turn, case when mark = 4 then 'user' else role end as role,
         case mark when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(case when mark = 3 then [0, 1] else [0] end) as copy
  from marked where mark <> 0
), solid as (
  select *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as s,
         row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
         row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as again
  from damaged
), faulty as (
  select conv_id, turn, role, text, i, left(role, 1) as sign,
         lag(left(role, 1)) over (partition by conv_id order by i) as before,
         case when s = '' then 'blank' when again then 'duplicate' when right(s, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault
  from solid
), counted as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
         count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (before is not null and before || sign not in ('su', 'ua', 'au')) as illegal
  from faulty group by conv_id
), inserted(state, cost, edits, next) as (values (0, 2, 'I', 3), (1, 2, 'I', 3), (2, 2, 'I', 3), (3, 2, 'I', 2),
                                                 (0, 0, '', 0), (1, 0, '', 1), (2, 0, '', 2), (3, 0, '', 3)
), walk(conv_id, i, state, best) as (
  select conv_id, cast(0 as bigint), 0, {'cost': 0, 'audit': ''} from counted
  union all
  select w.conv_id, w.i + 1, e.next, min({'cost': w.best.cost + p.cost + e.cost, 'audit': w.best.audit || p.edits || e.edit})
  from walk w join faulty f on f.conv_id is not distinct from w.conv_id and f.i = w.i + 1
  join inserted p on p.state = w.state
  join lateral (
    select 'D' as edit, 3 as cost, p.next as next
    union all
    select 'K', case when f.fault = 'truncated' then 1 else 0 end, case f.sign when 's' then 1 when 'u' then 3 else 2 end
    where f.fault not in ('blank', 'duplicate')
      and ((f.sign = 's' and p.next = 0) or (f.sign = 'u' and p.next < 3) or (f.sign = 'a' and p.next = 3))
    union all
    select 'R', case when f.fault = 'truncated' then 3 else 2 end, case when p.next = 3 then 2 else 3 end
    where f.fault not in ('blank', 'duplicate')
  ) e on true
  group by w.conv_id, w.i + 1, e.next
), found as (
  select c.conv_id, min({'cost': w.best.cost + p.cost, 'audit': w.best.audit || p.edits}) as best
  from counted c join walk w on w.conv_id is not distinct from c.conv_id and w.i = c.n
  join inserted p on p.state = w.state
  where p.next in (0, 2) group by c.conv_id
), replay(conv_id, rest, i, state, lines) as (
  select conv_id, best.audit, cast(0 as bigint), 0, cast([] as varchar[]) from found
  union all
  select r.conv_id, substr(r.rest, 2), r.i + case when left(r.rest, 1) = 'I' then 0 else 1 end,
         case left(r.rest, 1) when 'D' then r.state
              when 'K' then case f.sign when 's' then 1 when 'u' then 3 else 2 end
              else case when r.state = 3 then 2 else 3 end end,
         case left(r.rest, 1) when 'D' then r.lines when 'K' then list_append(r.lines, f.role || ':' || f.text)
              else list_append(r.lines, case when r.state = 3 then 'assistant' else 'user' end || ':'
                                        || case when left(r.rest, 1) = 'R' then f.text else '' end) end
  from replay r left join faulty f on f.conv_id is not distinct from r.conv_id and f.i = r.i + 1
  where r.rest <> ''
), whole as (select conv_id, array_to_string(lines, chr(10)) as text from replay where rest = '')
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(coalesce(best.cost, 0) as bigint) as cost,
       coalesce(best.audit, '') as audit, sha256(coalesce(w.text, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counted c on c.conv_id is not distinct from o.conv_id
left join found f on f.conv_id is not distinct from o.conv_id
left join whole w on w.conv_id is not distinct from o.conv_id
"""


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op12_lexical_search"] = r"""
with found as (
  select doc_id, row_number() over () as r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents
), total as (
  select count(*) as docs, sum(len(terms)) as length from found where len(terms) > 0
), posting as (
  select r, any_value(doc_id) as doc_id, any_value(len(terms)) as n, term, count(*) as tf
  from (select r, doc_id, terms, unnest(terms) as term from found) group by r, term
), wanted as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
), weighted as (
  select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1))) as bigint) as w
  from posting, total where term in (select term from wanted) group by term, docs
), scored as (
  select item_id, r, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + cast((90 * n * docs) // length as bigint))))) as bigint) as score
  from wanted join weighted using (term) join posting using (term), total group by item_id, r, doc_id
), ranked as (
  select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id, r) as integer) as rank, doc_id, score
  from scored where score > 0
)
select * from ranked where rank <= 10
"""


@query
def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))
