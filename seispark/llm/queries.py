"""The registered corpus queries and their DuckDB twins."""

from pyspark.sql import functions as F

from seispark.llm import concat, decontaminate, language, licenses, line_dedup, packing, quality, ranked, repair, sharding, simhash, surrogates, topk
from seispark.llm.text import NULL_ID

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def own_id(name="_id"):
    return F.when(F.col(name) != NULL_ID, F.col(name)).alias("doc_id")


LINES = """
with parts as (select doc_id, string_split(coalesce(text, ''), chr(10)) as p from documents),
lines as (select doc_id, unnest(p) as line, unnest(range(len(p))) as pos from parts),
keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
shared as (select k, min(doc_id) as first from keyed where length(k) >= 10 group by k having count(distinct doc_id) >= 2),
marked as (select keyed.*, coalesce(keyed.doc_id > shared.first, false) as lost from keyed left join shared using (k))
select doc_id, count(*) as n_lines, count(*) filter (lost) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not lost), '')) as kept_sha256
from marked group by doc_id"""


@query("op1_line_dedup", LINES)
def op1(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = line_dedup.drop_repeated_lines(docs)
    return out.select("_row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


#: Bytes of text in a shard of these tables.
SHARD_BYTES = 1 << 20

SHARDS = f"""
with hashed as (select doc_id, ('0x' || substr(md5(cast(doc_id as varchar)), 1, 15))::bigint as h,
  cast(coalesce(strlen(text), 0) as bigint) as n_bytes from documents),
nodes as (select cast(d as integer) as depth, h >> (60 - d)::int as prefix, cast(sum(n_bytes) as bigint) as shard_bytes
  from hashed, range(41) r(d) group by 1, 2),
leaf as (select n.* from nodes n left join nodes p on p.depth = n.depth - 1 and p.prefix = n.prefix >> 1
  where n.shard_bytes <= {SHARD_BYTES} and (p.depth is null or p.shard_bytes > {SHARD_BYTES}))
select doc_id, case when depth = 0 then '' else lpad(bin(prefix), depth, '0') end as shard, depth, n_bytes, shard_bytes
from hashed join leaf on h >> (60 - depth) = prefix"""


@query("op8_extendible_shards", SHARDS)
def op8(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return sharding.shard(docs, SHARD_BYTES).select(own_id(), "shard", "depth", "n_bytes", "shard_bytes")


@query("op4_simhash_near_dedup")
def op4(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select(own_id(), F.lower(F.hex("_fp")).alias("fingerprint"), simhash.public_id("component").alias("component_id"))


@query("op2_quality_classifier")
def op2(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, folder, "labels"))
    return quality.score(docs, model)


@query("op9_language_mixture")
def op9(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return language.predict(docs, language.train(docs))


NEAREST = """
with whole as (select vec_id, row_number() over () as r, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select q.r as own, q.vec_id as query_id, c.vec_id, c.r, cast(list_dot_product(q.v, c.v) as bigint) as score
  from whole q join whole c on c.r <> q.r and len(c.v) = len(q.v) where q.vec_id % 50 = 0),
ranked as (select *, cast(row_number() over (partition by own order by score desc, vec_id, r) as integer) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5"""


@query("op3_threshold_top_k", NEAREST)
def op3(spark, folder):
    return topk.top_k(table(spark, folder, "embeddings"), lambda vec_id: vec_id % 50 == 0)


TEMPLATE_ROWS = ",\n  ".join(f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(licenses.TEMPLATES))
LICENSES = f"""
with templates(template, license, text) as (values {TEMPLATE_ROWS}),
lines as (select doc_id, string_split(coalesce(text, ''), chr(10)) as p, text from documents),
units as (select doc_id, unnest(p) as unit, unnest(range(len(p))) as n, false as whole from lines
  union all select doc_id, text, -1, true from lines where len(p) > 1),
uwords as (select doc_id, n, whole, list_filter(string_split(regexp_replace(lower(unit), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '') as w from units),
upairs as (select doc_id, n, whole, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as b from uwords where len(w) between 2 and 2000),
twords as (select template, license, list_filter(string_split(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '') as w from templates),
tpairs as (select template, license, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as b from twords),
uflat as (select doc_id, n, whole, len(b) as size, unnest(b) as pair from upairs),
tflat as (select template, license, len(b) as tsize, unnest(b) as pair from tpairs),
hits as (select doc_id, n, whole, template, license, 2.0e0 * count(*) / (size + tsize) as score from uflat join tflat using (pair)
  group by doc_id, n, whole, template, license, size, tsize),
best as (select doc_id, n, whole, license, score from hits where score >= 0.9
  qualify row_number() over (partition by doc_id, n, whole order by score desc, template) = 1)
select doc_id, license, max(score) as score, cast(count(*) filter (not whole) as bigint) as n_lines, bool_or(whole) as whole_text
from best group by doc_id, license"""


@query("op5_license_scan", LICENSES)
def op5(spark, folder):
    found = licenses.scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(own_id(), "license", "score", "n_lines", "whole_text")


@query("op7_best_fit_packing")
def op7(spark, folder):
    return packing.pack(table(spark, folder, "documents").select("doc_id", "text"))


@query("op6_benchmark_decontamination")
def op6(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, folder, "benchmark"))
    return found.select(own_id(), "item_id", "score", "question_overlap", "answer_overlap")


#: Key of the surrogates; a user passes a secret one.
KEY = "example key"


@query("op10_surrogates")
def op10(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = surrogates.replace_personal_data(docs, KEY)
    return found.select("_row.doc_id", F.col("replaced").alias("text"), "n_entities")


def damaged(rows):
    """Conversations with faults put in by the hash of conversation and turn; a null is one space."""
    ident, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    own = rows.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], (F.crc32(F.concat(ident, F.lit(":"), turn).cast("binary")) % 20).alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return own.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


REPAIR = """
with recursive bits as materialized (select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
  lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) as t),
hashed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, xor(4294967295, list_reduce(list_prepend(4294967295,
  list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ascii(x)::bigint)),
  lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 20 as fault from conversations, bits),
damaged as (select conv_id, turn, case when fault = 4 then 'user' else role end as role,
  case when fault = 1 then '' when fault = 2 then translate(text, '.!?', '') else text end as text
  from hashed, lateral (select unnest(range(case when fault = 3 then 2 else 1 end))) c where fault <> 0),
ordered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare from damaged),
faulty as (select *, left(role, 1) as initial, bare = '' as is_blank, bare <> '' and row_number() over (partition by conv_id, role, text order by i) > 1 as is_copy,
  bare <> '' and right(bare, 1) not in ('.', '!', '?') as is_cut from ordered),
counted as (select conv_id, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, count(*) filter (is_blank) as blank, count(*) filter (is_copy) as duplicate,
  count(*) filter (is_cut and not is_copy) as truncated, count(*) as n from faulty group by conv_id),
pairs as (select conv_id, count(*) filter (p is not null and p || initial not in ('su', 'ua', 'au')) as illegal
  from (select *, lag(initial) over (partition by conv_id order by i) as p from faulty) group by conv_id),
inserts(q, q2, times) as (values (0, 0, 0), (1, 1, 0), (2, 2, 0), (3, 3, 0), (0, 2, 1), (1, 2, 1), (2, 3, 1), (3, 2, 1), (0, 3, 2), (1, 3, 2), (2, 2, 2), (3, 3, 2)),
added as (select q, q2, times, case times when 0 then '' when 1 then case q2 when 2 then 'user:' || chr(10) else 'assistant:' || chr(10) end
  else case q2 when 2 then 'assistant:' || chr(10) || 'user:' || chr(10) else 'user:' || chr(10) || 'assistant:' || chr(10) end end as lines from inserts),
moves as (select f.conv_id, f.i, q2 as before, e.letter, e.cost + case when e.letter <> 'D' and is_cut then 1 else 0 end as cost,
  case e.letter when 'D' then q2 when 'R' then case when q2 = 2 then 3 else 2 end else case initial when 's' then 1 when 'u' then 2 else 3 end end as after,
  case e.letter when 'D' then '' when 'R' then case when q2 = 2 then 'assistant:' else 'user:' end || text || chr(10) else role || ':' || text || chr(10) end as line
  from faulty f, (values ('K', 0), ('R', 2), ('D', 3)) e(letter, cost), (values (0), (1), (2), (3)) s(q2)
  where e.letter = 'D' or not (is_blank or is_copy) and (e.letter = 'R' or initial = 's' and q2 = 0 or initial = 'u' and q2 in (0, 1, 3) or initial = 'a' and q2 = 2)),
ways as (select conv_id, 0::bigint as i, 0 as q, {'cost': 0, 'audit': '', 'lines': ''} as best from counted
  union all
  select w.conv_id, m.i, m.after, min({'cost': w.best.cost + 2 * a.times + m.cost, 'audit': w.best.audit || repeat('I', a.times) || m.letter, 'lines': w.best.lines || a.lines || m.line})
  from ways w join added a on a.q = w.q join moves m on m.conv_id is not distinct from w.conv_id and m.i = w.i + 1 and m.before = a.q2 group by w.conv_id, m.i, m.after),
goals as (select w.conv_id, min({'cost': w.best.cost + 2 * a.times, 'audit': w.best.audit || repeat('I', a.times), 'lines': w.best.lines || a.lines}) as best
  from ways w join counted c on c.conv_id is not distinct from w.conv_id and c.n = w.i join added a on a.q = w.q and a.q2 in (0, 3) group by w.conv_id)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, coalesce(best.cost, 0)::bigint as cost, coalesce(best.audit, '') as audit, sha256(coalesce(best.lines[:-2], '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join counted c on c.conv_id is not distinct from o.conv_id
left join pairs p on p.conv_id is not distinct from o.conv_id left join goals g on g.conv_id is not distinct from o.conv_id"""


@query("op11_structure_repair", REPAIR)
def op11(spark, folder):
    rows = table(spark, folder, "conversations")
    found = repair.Repair(damaged(rows))
    every = rows.select(F.coalesce(F.col("conv_id").cast("long"), F.lit(NULL_ID)).alias("_conv")).distinct()
    both = every.join(found.summary(), "_conv", "left").join(found.digests(), "_conv", "left")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    hashed = F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    return both.select(own_id("_conv").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), hashed)


RANKED = """
with words as (select doc_id, row_number() over () as r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as t from documents),
docs as (select doc_id, r, len(t) as n from words where len(t) > 0),
stats as (select count(*) as nn, cast(sum(n) as bigint) as ll from docs),
queries as (select item_id, term, count(*) as qtf from (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from benchmark) group by all),
tfs as (select r, term, count(*) as tf from (select r, unnest(t) as term from words) where term in (select term from queries) group by all),
dfs as (select term, cast(floor(1000 * ln((2.0e0 * nn + 2) / (2 * count(*) + 1))) as bigint) as w from tfs, stats group by term, nn),
scored as (select item_id, r, cast(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // ll)))) as bigint) as score
  from queries join dfs using (term) join tfs using (term) join docs using (r), stats group by item_id, r)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id, r) as integer) as rank, doc_id, score
from scored join docs using (r) where score > 0 qualify rank <= 10"""


@query("op12_hybrid_ranked_search", RANKED)
def op12(spark, folder):
    return ranked.top_documents(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))


@query("op13_concatenate_and_cut")
def op13(spark, folder):
    import public_tokenizers

    found = concat.pack(table(spark, folder, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
