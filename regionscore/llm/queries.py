"""Registered queries of the corpus operators, each over its whole table, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionscore.landing import land
from regionscore.llm import alignment, audit, bpe, chat, decontaminate, embeddings, fingerprints, jaccard, langid, licenses, lm, mixing, warc
from regionscore.llm.common import crc_rest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
RANKS = "byte_bpe_multi_50k.tiktoken"


def register(sql: str | None = None):
    """Register a function under its own name, with the SQL it must equal if SQL can say it."""
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


@register()
def op1_lm_score(spark, sf):
    """Log-bilinear and unigram scores of all documents; rows whose crc32(doc_id) mod 7 is 2 are held out of the training."""
    held_out = crc_rest("doc_id", 7) == 2
    scored = lm.score(table(spark, sf, "documents"), learn_from=~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _escaped(text: str) -> str:
    """Characters of a text with its escapes, in SQL."""
    control = " + ".join(f"(length({text}) - length(replace({text}, '{c.decode()}', ''))) // {len(c)}" for c in chat.CONTROL)
    return rf"length({text}) + length({text}) - length(replace({text}, '\', '')) + {control}"


@register(f"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::BIGINT as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum({_escaped('text')} + length(role) + 13)::BIGINT as formatted_chars
from c group by conv_id""")
def op2_chat_format(spark, sf):
    """All conversations, and one of control strings alone, formatted, written, and read back as digests."""
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.digests(land(chat.format_turns(rows)))


@register()
def op3_language_id(spark, sf):
    """Languages of all documents; rows whose crc32(doc_id) mod 5 is 0 are held out of the training."""
    docs = table(spark, sf, "documents")
    held_out = crc_rest("doc_id", 5) == 0
    model = langid.fit(docs, learn=~held_out)
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@register()
def op4_fingerprints(spark, sf):
    """Fingerprints of all documents and of their edits, and how alike they are."""
    return fingerprints.edited_fingerprints(table(spark, sf, "documents"))


#: Sources belong to three domains by their number; others are one more.
_DOMAIN = "case try_cast(regexp_extract(source, '([0-9]+)$', 1) as int) % 3 when 0 then 'web' when 1 then 'books' when 2 then 'forums' else 'other' end"
MIX_LEVELS = ["domain", "lang", "source"]
MIX_WEIGHTS = ["case domain when 'web' then 5 when 'books' then 3 when 'forums' then 2 else 1 end", "case lang when 'en' then 4 when 'es' then 1 else 2 end", "1"]
MIX_PART, MIX_EPOCHS, MIX_SEED = (3, 4), 2, 17


def with_domain(docs: DataFrame) -> DataFrame:
    return docs.withColumn("domain", F.expr(_DOMAIN))


def _level_sql(k: int) -> str:
    """Budgets of the nodes of level k from those of the level above, as common table expressions."""
    name, parent = MIX_LEVELS[k], MIX_LEVELS[:k]
    up = ", ".join(parent)
    by = f"partition by {up}" if parent else ""
    keys = ", ".join([*parent, name])
    b = f"join b{k - 1} p using ({up})" if parent else "cross join (select least((select sum(tokens) from leaves) * {0} // {1}, (select sum(cap) from leaves)) as budget) p".format(*MIX_PART)
    return f"""
n{k} as (select {keys}, cap, w, p.budget::HUGEINT as b from (select {keys}, sum(cap)::HUGEINT as cap, max(w{k})::HUGEINT as w from leaves group by {keys}) {b} where w > 0 and cap > 0),
f{k} as (select *, cap * sum(w) over (o rows between current row and unbounded following)
  <= (b - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0)) * w as isfull from n{k}
  window o as ({by} order by cap::DOUBLE / w::DOUBLE, {name})),
l{k} as (select *, b - coalesce(sum(cap) filter (isfull) over ({by}), 0) as lft, sum(w) filter (not isfull) over ({by}) as opn from f{k}),
s{k} as (select *, case when not isfull then w * lft // opn end as share, case when not isfull then w * lft % opn end as rest from l{k}),
b{k} as (select {keys}, case when isfull then cap else share + case when row_number() over ({by} order by isfull, rest desc nulls last, {name}) <= lft - coalesce(sum(share) over ({by}), 0)
  then 1 else 0 end end as budget from s{k})"""


@register(f"""
with docs as (select doc_id, {_DOMAIN} as domain, coalesce(lang, '') as lang, coalesce(source, '') as source, len({_WORDS}) as n_tokens from documents),
leaves as (select *, tokens * {MIX_EPOCHS} as cap, {', '.join(f'{w} as w{k}' for k, w in enumerate(MIX_WEIGHTS))}
  from (select domain, lang, source, sum(n_tokens)::HUGEINT as tokens from docs group by all)),{','.join(_level_sql(k) for k in range(3))},
plan as (select domain, lang, source, budget // tokens as whole, budget % tokens as part from leaves join b2 using (domain, lang, source) where tokens > 0 and budget > 0),
placed as (select d.*, whole, part, ('0x' || substr(md5('{MIX_SEED}:' || whole || ':' || doc_id), 1, 15))::BIGINT as h from docs d join plan using (domain, lang, source)),
cum as (select *, sum(n_tokens) over (partition by domain, lang, source order by h, doc_id rows unbounded preceding) - n_tokens as before from placed)
select doc_id, domain, lang, source, n_tokens::BIGINT as n_tokens, e::BIGINT as epoch, n_tokens::BIGINT as taken_tokens from placed, unnest(range(whole::BIGINT)) u(e)
union all
select doc_id, domain, lang, source, n_tokens::BIGINT, whole::BIGINT, least(n_tokens, part - before)::BIGINT from cum where before < part""")
def op5_mixing(spark, sf):
    """Three quarters of all words, dealt to domains, languages and sources by weight, each source up to twice."""
    docs = with_domain(table(spark, sf, "documents"))
    rows = land(docs.select("doc_id", *[F.coalesce(c, F.lit("")).alias(c) for c in MIX_LEVELS], mixing.word_count(F.col("text")).alias("n_tokens"), F.xxhash64("text").alias("tie")))
    planned = mixing.plan(rows, MIX_LEVELS, [F.expr(w) for w in MIX_WEIGHTS], MIX_PART, MIX_EPOCHS, MIX_SEED)
    taken = mixing.select(rows, planned, MIX_LEVELS, MIX_SEED)
    return taken.select("doc_id", *MIX_LEVELS, "n_tokens", "epoch", "taken_tokens")


@register()
def op6_license_scan(spark, sf):
    """Licences that all documents name or hold."""
    found = licenses.scan(table(spark, sf, "documents"))
    return found.select("doc_id", "license", "score", F.size("spans").alias("n_spans"), F.to_json("spans").alias("spans"))


@register(f"""
with recursive w as (select doc_id, {_WORDS} as ws from documents),
s as (select doc_id, unnest(list_distinct(case when len(ws) >= 5 then list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
  when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end)) as sh from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as i from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * i >= 80 * (x.n + y.n - i)),
e as (select a, b from l union all select b, a from l),
r as (select a as node, a as seen from e union select r.node, e.b from r join e on r.seen = e.a),
c as (select node, least(node, min(seen)) as component_id from r group by node)
select d.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(c.component_id, d.doc_id) as component_id
from documents d left join n using (doc_id) left join c on c.node = d.doc_id""")
def op7_ngram_jaccard(spark, sf):
    """Components of all documents whose sets of five-word shingles are similar to 80 of 100."""
    return jaccard.groups(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


@register(f"""
with p as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
f as (select payload_digest, max(page_id) as first from p where payload_bytes >= {warc.LEAST_SHARED} group by 1)
select page_id, payload_bytes, payload_digest, case when first is null or first = page_id then 'response' else 'revisit' end as record_type,
  case when first <> page_id then first end as refers_to, true as valid
from p left join f on f.payload_digest = p.payload_digest and payload_bytes >= {warc.LEAST_SHARED}""".replace("select page_id, payload_bytes, payload_digest,", "select page_id, payload_bytes, p.payload_digest as payload_digest,"))
def op8_warc(spark, sf):
    """All pages written as WARC archives and read back, equal payloads as revisits."""
    archives = land(warc.write(table(spark, sf, "pages")))
    records = warc.read(archives, payloads=False).filter(F.col("record_type").isin("response", "revisit"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "valid")


@register()
def op9_embedding_near_dedup(spark, sf):
    """Links and components of all vectors of equal labels with a cosine of 0.93 or more."""
    return embeddings.near(table(spark, sf, "embeddings"), 0.93)


@register()
def op10_byte_bpe(spark, sf):
    """Token ids of all documents and their decoding, as digests."""
    ranks, pattern = bpe.public_vocabulary(RANKS)
    return bpe.round_trip(table(spark, sf, "documents"), ranks, pattern)


_ITEM_WORDS = _WORDS.replace(r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@register(f"""
with d as (select row_number() over () as row, doc_id, {_ITEM_WORDS} as ws from documents),
i as (select coalesce(item_id::VARCHAR, '') as id, {_ITEM_WORDS} as ws from benchmark),
n as (select id, unnest(case when len(ws) >= {decontaminate.WINDOW} then list_transform(range(1, len(ws) - {decontaminate.WINDOW - 2}), lambda k: array_to_string(ws[k:k + {decontaminate.WINDOW - 1}], ' '))
    when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as win, least(len(ws), {decontaminate.WINDOW}) as size from i),
s as (select distinct size from n),
p as (select row, unnest(range(1, len(ws) - size + 2)) as k, size, ws from d, s where len(ws) >= size),
q as (select row, k, size, array_to_string(ws[k:k + size - 1], ' ') as win from p),
f as (select distinct row, k, size, id from q join n using (win, size)),
h as (select row, count(distinct k + j) as n_hit from f, unnest(range(size)) u(j) group by row),
t as (select row, count(distinct id) as n_items, string_agg(distinct id, ',' order by id) as ids from f group by row)
select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join h using (row) left join t using (row)""")
def op11_decontaminate(spark, sf):
    """Words of all documents that stand in a window of a benchmark item, and the items."""
    return decontaminate.report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@register(f"""
with recursive d as (select doc_id, coalesce(text, '') as text, coalesce(lang, '') as part from documents),
w as (select *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as words from d),
first as (select text, min(doc_id) as least from d group by text),
good as (select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic from labels group by doc_id),
m as (select part, (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
    + 4 * (100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 3 * length(text))::INT
    + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > least, false)::INT as mask, coalesce(good, false) as good, coalesce(toxic, false) as toxic
  from w join first using (text) left join good using (doc_id)),
o as (select '' as filter_order union all select filter_order || l from o, unnest(['A', 'B', 'C', 'D', 'E']) u(l) where position(l in filter_order) = 0),
s as (select filter_order, step, substr(filter_order, step, 1) as letter, (1 << (ascii(substr(filter_order, step, 1)) - 65)) as bit,
    list_sum([1 << (ascii(x) - 65) for x in string_split(substr(filter_order, 1, step - 1), '') if x <> '']) as before
  from o, unnest(range(1, 6)) u(step) where length(filter_order) = 5),
c as (select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from m group by all),
r as (select part, filter_order, step, letter, coalesce(sum(n) filter (mask & (coalesce(before, 0)::INT | bit) = 0), 0) as kept,
    coalesce(sum(n) filter (mask & bit <> 0 and mask & coalesce(before, 0)::INT = 0), 0) as removed,
    coalesce(sum(n) filter (mask & bit <> 0 and mask & coalesce(before, 0)::INT <> 0), 0) as redundant, coalesce(sum(n) filter (mask = bit), 0) as unique_fails,
    coalesce(sum(good) filter (mask & bit <> 0 and mask & coalesce(before, 0)::INT = 0), 0) as good_lost,
    coalesce(sum(toxic) filter (mask & bit <> 0 and mask & coalesce(before, 0)::INT = 0), 0) as toxic_lost
  from c, s group by part, filter_order, step, letter)
select part, filter_order, step::INT as step, kept::BIGINT as kept, removed::BIGINT as removed, redundant::BIGINT as redundant, unique_fails::BIGINT as unique_fails,
  good_lost::BIGINT as good_lost, toxic_lost::BIGINT as toxic_lost, (sum(removed) over (partition by part, letter))::BIGINT as shapley from r""")
def op12_filter_audit(spark, sf):
    """What each of five filters keeps and removes in all their orders, by language."""
    return audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


ALIGNED_FILES = "byte_bpe_50k.json", "piece_bpe_32k.model"


@register()
def op13_token_alignment(spark, sf):
    """Groups and links of two tokenizers' tokens in all documents, and how common the linked ids are."""
    return alignment.measure(table(spark, sf, "documents"), *alignment.public_files(*ALIGNED_FILES))
