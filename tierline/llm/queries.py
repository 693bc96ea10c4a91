"""The queries over these operators, with their SQL where there is one.

Each takes a session and a directory of Parquet tables and applies its operator to a whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import (
    collocations, decontaminate, jaccard, kneser_ney, language, mixing, packing, pagetext, runs, spotsigs, token_counts, topk, warc,
)
from tierline.llm.common import shared_dir

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file; executors have it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(_table(spark, sf_dir, "documents"))


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprints(_table(spark, sf_dir, "documents"), reach=8)


def op4_pagetext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.extract(_table(spark, sf_dir, "pages"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return pieces.drop("ids")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    path = shared_dir(spark, "warc")
    warc.write_archive(pages, path)
    records = warc.read_archive(spark, path, whole=False)
    kind = pages.schema["page_id"].dataType
    return records.select(
        F.col("page").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(_table(spark, sf_dir, "documents"))


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.perplexity(_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_topk": op1_topk,
    "op2_language": op2_language,
    "op3_spotsigs": op3_spotsigs,
    "op4_pagetext": op4_pagetext,
    "op5_packing": op5_packing,
    "op6_token_counts": op6_token_counts,
    "op7_mixing": op7_mixing,
    "op8_warc": op8_warc,
    "op9_jaccard": op9_jaccard,
    "op10_kneser_ney": op10_kneser_ney,
    "op11_collocations": op11_collocations,
    "op12_decontaminate": op12_decontaminate,
    "op13_runs": op13_runs,
}

ORACLES: dict[str, str] = {
    "op9_jaccard": r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as ws from documents),
s as (select doc_id, case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) end as set from w),
x as (select doc_id, len(set) as n, unnest(set) as g from s),
l as (select a.doc_id as a, b.doc_id as b from x a join x b on a.g = b.g and a.doc_id <> b.doc_id and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r as (select a as root, a as node from l union select r.root, l.b from r join l on r.node = l.a)
select s.doc_id, cast(len(set) as bigint) as n_shingles, least(s.doc_id, coalesce(m.low, s.doc_id)) as component_id
from s left join (select root, min(node) as low from r group by root) m on m.root = s.doc_id
""",
    "op1_topk": """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as double)) as e from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
s as (select q.vec_id as query_id, c.vec_id as vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e)),
r as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s)
select * from r where rank <= 10
""",
    "op7_mixing": mixing.ORACLE,
    "op11_collocations": r"""
with t as (select doc_id, coalesce(lang, 'und') as lang,
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as ps from documents),
p as (select lang, regexp_extract_all(unnest(ps), '[^\x20\x09]+') as ws from t),
w as (select lang, unnest(flatten(list_transform([1, 2, 3, 4], lambda k: list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])))) as g from p),
f as (select lang, g, len(g) as k, count(*) as f from w group by lang, g),
n as (select lang, sum(f) as n from f where k = 1 group by lang),
c as (select lang, g, k, f as a from f where k > 1 and f >= 30),
cut as (select lang, g, a, unnest(range(1, k)) as pos from c),
s as (select cut.lang, cut.g, a, pos, l.f as l, r.f as r, (2000000::hugeint * a) // (l.f + r.f) as score from cut
  join f l on l.lang = cut.lang and l.g = cut.g[1:pos] join f r on r.lang = cut.lang and r.g = cut.g[pos + 1:]),
b as (select *, row_number() over (partition by lang, g order by score, pos) as o from s),
long as (select lang, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2), lambda i: g[i:i + m - 1])))) as g, a from c where k > 2),
top as (select lang, g, max(a) as longest from long group by lang, g),
o as (select b.lang, array_to_string(b.g, ' ') as phrase, a, l, r, score from b left join top on top.lang = b.lang and top.g = b.g
  where o = 1 and (longest is null or 100 * longest::hugeint < 80 * a::hugeint)),
x as (select o.*, n.n, row_number() over (partition by o.lang order by score desc, a desc, phrase) as rank from o join n on n.lang = o.lang)
select lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r, cast(n as bigint) as n,
  cast(score as bigint) as score from x where rank <= 2000
""",
    "op12_decontaminate": r"""
with d as (select doc_id, row_number() over () as row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
i as (select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
v as (select distinct item, unnest(case when len(ws) = 0 then [] when len(ws) < 10 then [ws]
    else list_transform(range(1, len(ws) - 8), lambda a: ws[a:a + 9]) end) as g from i),
k as (select distinct len(g) as k from v),
u as (select row, unnest(range(1, len(ws) - k + 2)) as pos, k, ws from d, k where len(ws) >= k),
h as (select u.row, u.pos, u.k, v.item from u join v on v.g = u.ws[u.pos:u.pos + u.k - 1]),
s as (select distinct row, unnest(range(pos, pos + k)) as pos from h),
c as (select row, count(*) as n from s group by row),
m as (select row, count(*) as n, string_agg(item, ',' order by item) as items from (select distinct row, item from h where item is not null) group by row)
select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(c.n, 0) as bigint) as n_hit, cast(coalesce(m.n, 0) as bigint) as n_items,
  sha256(coalesce(m.items, '')) as items_sha256, coalesce(c.n, 0) > 0 as contaminated
from d left join c on c.row = d.row left join m on m.row = d.row
""",
    "op8_warc": """
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as n, sha256(coalesce(html, '')) as d from pages),
f as (select *, min(page_id) over (partition by d) as first_id from p)
select page_id, cast(n as bigint) as payload_bytes, d as payload_digest,
  case when n < 100 or page_id = first_id then 'response' else 'revisit' end as record_type,
  case when n < 100 or page_id = first_id then null else first_id end as refers_to from f
""",
}
