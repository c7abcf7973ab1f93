"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordlog import workspace
from ordlog.llm import (
    decontamination,
    fill_in_middle,
    inner_products,
    language,
    licenses,
    mixing,
    ngram_join,
    packing,
    quality,
    token_counts,
    token_files,
    toxicity,
    vector_codes,
)
from ordlog.llm.shared import small_batches, table

QUERIES = {}
SQL = {}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def query(run):
    @wraps(run)
    def prepared(spark: SparkSession, folder: str) -> DataFrame:
        small_batches(spark)
        return run(spark, folder)

    QUERIES[run.__name__] = prepared
    return prepared


@query
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    # documents have no URL: their source is the host, the language the path below it
    return quality.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.report(table(spark, folder, "documents"))


@query
def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.report(table(spark, folder, "documents"))


SQL["op3_source_mix"] = r"""
with sized as (
  select row_number() over () as row, doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size
  from documents
), named as (
  select *, md5('mix-1:' || coalesce(cast(doc_id as varchar), '') || ':' || size) as name,
    row_number() over (partition by source, doc_id, size) - 1 as nth
  from sized
), placed as (
  select * exclude (name, nth), case when nth = 0 then name else md5(name || ':' || nth) end as place from named
), sums as (
  select source, cast(sum(size) as bigint) as source_size,
    row_number() over (order by source nulls last) - 1 as sid
  from sized group by source
), sources as (
  select *, cast([3, 1, 2][sid % 3 + 1] as bigint) as weight from sums
), dried as (
  select *, cast(sum(source_size) over () as bigint) as total,
    coalesce(sum(source_size) over by_need, 0) as dry_words,
    sum(weight) over () - coalesce(sum(weight) over by_need, 0) as weights
  from sources
  window by_need as (order by source_size / weight, sid rows between unbounded preceding and 1 preceding)
), level as (
  select cast(3 * total - 4 * dry_words as bigint) as share, cast(weights as bigint) as weights, total
  from dried where 4 * source_size * weights > weight * (3 * total - 4 * dry_words)
  order by source_size / weight, sid limit 1
), aimed as (
  select sid, source, weight, source_size, total,
    least(cast(weight * share as double) / cast(2 * weights as double), cast(2 * source_size as double)) as target
  from sources, level
), ended as (
  select row, doc_id, size, place, sid, weight, source_size, target, total,
    sum(size) over (partition by sid order by place rows unbounded preceding) as done
  from placed join aimed on placed.source is not distinct from aimed.source
), copies as (
  select *, cast(done + source_size * pass as double) / weight as finish
  from ended, (values (0), (1)) as passes(pass)
), taken as (
  select *, 2 * sum(size) over (order by finish, sid, pass, place rows unbounded preceding) <= 3 * total as fits
  from copies
)
select doc_id, any_value(size) as size, any_value(source_size) as source_size, any_value(target) as target,
  cast(sum(case when fits then size else 0 end) as bigint) as taken
from taken group by row, doc_id
"""


@query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.report(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.report(table(spark, folder, "documents"))


def _values(rows: list[tuple[str, str]]) -> str:
    return ", ".join("('" + "', '".join(x.replace("'", "''") for x in row) + "')" for row in rows)


SQL["op5_license_scan"] = f"""
with docs as (select doc_id, coalesce(text, '') as text, {_ALNUM} as ws from documents),
phrases as (
  select string_split(text, ' ') as p, label from (values {_values([*licenses.PHRASES.items()])}) v(text, label)
), places as (
  select doc_id, i - 1 as place, label from docs, phrases, unnest(range(1, len(ws) - len(p) + 2)) u(i)
  where ws[i] = p[1] and list_slice(ws, i, i + len(p) - 1) = p
), base as (
  select doc_id, count(*) as n_base, min(place) as first_word, max(place) as last_word, list(distinct label) as labels
  from places group by doc_id
), templates as (
  select row_number() over () as t, label, list_distinct({_ALNUM}) as need
  from (values {_values(licenses.TEMPLATES)}) v(label, text)
), lines as (
  select doc_id, line, {_ALNUM} as ws
  from (select doc_id, generate_subscripts(l, 1) as line, unnest(l) as text
    from (select doc_id, string_split(text, chr(10)) as l from docs))
), blocks as (
  select doc_id, list_distinct(list_concat(ws, list_concat(case when next <> [] then next else [] end,
    case when next <> [] and third <> [] then third else [] end))) as have
  from (select *, lead(ws, 1, []) over by_line as next, lead(ws, 2, []) over by_line as third from lines
    window by_line as (partition by doc_id order by line))
  where ws <> []
), matched as (
  select doc_id, list(distinct label) as labels, max(share) as share from (
    select doc_id, label, len(list_intersect(have, need)) / len(need) as share, len(list_intersect(have, need)) as n, need
    from blocks, templates)
  where n >= greatest(1, ceil({licenses.THRESHOLD} * len(need) - 1e-9)) group by doc_id
)
select doc_id, len(ws) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(matched.labels, [])))), ',') as labels,
  case when n_base > 0 then 1.0 else coalesce(share, 0.0) end::double as score
from docs left join base using (doc_id) left join matched using (doc_id)
"""


@query
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL["op6_decontamination"] = f"""
with items as (select cast(item_id as varchar) as item, {_ALNUM} as ws from benchmark),
windows as (
  select item, 10 as n, array_to_string(list_slice(ws, i, i + 9), ' ') as w
  from items, unnest(range(1, len(ws) - 8)) u(i) where len(ws) >= 10
  union
  select item, len(ws), array_to_string(ws, ' ') from items where len(ws) between 1 and 9
), docs as (select doc_id, {_ALNUM} as ws from documents),
runs as (
  select doc_id, i, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') as w
  from docs, (select distinct n from windows) sizes, unnest(range(1, len(ws) - n + 2)) u(i)
), hits as (select doc_id, i, n, item from runs join windows using (n, w)),
words as (
  select doc_id, count(distinct place) as n_hit from hits, unnest(range(i, i + n)) u(place) group by doc_id
), found as (
  select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as names
  from hits group by doc_id
)
select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join words using (doc_id) left join found using (doc_id)
"""


@query
def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    # of this vocabulary: lower case, white space dropped
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return token_files.report(table(spark, folder, "documents"), tokenizer, spaced=True, special=True)


@query
def op8_inner_products(spark: SparkSession, folder: str) -> DataFrame:
    return inner_products.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


SQL["op8_inner_products"] = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
  from vectors q join vectors c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank,
  vec_id, score
from scored qualify rank <= 20
"""


@query
def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.report(table(spark, folder, "documents"))


SQL["op9_ngram_join"] = f"""
with recursive docs as (select doc_id, {_SPACED} as ws from documents),
shingles as (
  select distinct doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') as s
  from docs, unnest(range(1, len(ws) - 3)) u(i) where len(ws) >= 5
  union all
  select doc_id, array_to_string(ws, ' ') from docs where len(ws) between 1 and 4
), sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select x.doc_id as a, y.doc_id as b, count(*) as n
  from shingles x join shingles y on x.s = y.s and x.doc_id < y.doc_id group by all
), pairs as (
  select a, b from common join sizes p on p.doc_id = a join sizes q on q.doc_id = b
  where 100 * common.n >= 75 * (p.n + q.n - common.n)
), links as (select a, b from pairs union all select b, a from pairs),
reached as (
  select doc_id, doc_id as other from docs
  union
  select reached.doc_id, links.b from reached join links on links.a = reached.other
)
select doc_id, coalesce(n, 0) as n_shingles, min(other) as component_id
from reached left join sizes using (doc_id) group by all
"""


@query
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, folder, "documents")
    return token_counts.maintained(docs, workspace.fresh(spark, "rollup"), tokenizer, "word_bpe_49k")


@query
def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.report(table(spark, folder, "documents"), tokenizer, spaced=True, special=True)


@query
def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.report(table(spark, folder, "embeddings"))


def _rounds(n: int) -> str:
    """Assignments and averages one after the other, as tables assigned_0, book_1, ..."""
    steps = []
    for r in range(n + 1):
        steps.append(f"""
assigned_{r} as materialized (
  select vec_id, label, parts.p, parts.x, cast(min((list_dot_product(parts.x, parts.x)
    - 2 * list_dot_product(parts.x, book_{r}.x) + list_dot_product(book_{r}.x, book_{r}.x)) * 16 + e) as bigint) as found
  from parts join book_{r} on parts.p = book_{r}.p group by all
)""")
        if r < n:
            steps.append(f"""
moved_{r} as (
  select p, e, list(v order by place) as x from (
    select p, e, place, floor(sum(v) / count(*)) as v
    from (select p, found % 16 as e, generate_subscripts(x, 1) as place, unnest(x) as v from assigned_{r}) group by all
  ) group by all
), book_{r + 1} as materialized (
  select * from moved_{r} union all select p, e, x from book_{r} anti join moved_{r} using (p, e)
)""")
    return ",".join(steps)


SQL["op12_vector_codes"] = f"""
with vectors as (
  select vec_id, label, list_transform(embedding, lambda x: floor(4096 * cast(x as double))) as v,
    row_number() over (order by vec_id) - 1 as nth
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as materialized (
  select vec_id, label, nth, p, v[p * len(v) // 8 + 1 : (p + 1) * len(v) // 8] as x from vectors, range(8) parts(p)
), book_0 as materialized (select p, nth as e, x from parts where nth < 16),{_rounds(6)},
coded as (
  select vec_id, label, string_agg(printf('%02x', found % 16), '' order by p) as code,
    cast(sum(found // 16) as bigint) as error
  from assigned_6 group by all
), entries as (
  select sha256(string_agg(array_to_string(list_transform(x, lambda v: cast(v as bigint)), ','), ',' order by p, e))
    as codebooks_sha256
  from book_6
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from coded, entries
"""


@query
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_in_middle.report(table(spark, folder, "documents"))


SQL["op13_fill_in_middle"] = """
with units as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
    sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h
  from documents
), drawn as (
  select *, len(u) as n, list_transform(range(4), lambda k: cast('0x' || h[8 * k + 1 : 8 * k + 8] as bigint)) as d
  from units
), placed as (
  select *, least(d[1] % (n + 1), d[2] % (n + 1)) as a, greatest(d[1] % (n + 1), d[2] % (n + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or d[3] % 100 >= 90
      then 'plain' when d[4] % 100 < 20 then 'spm' else 'psm' end as form
  from drawn
), pieces as (
  select *, array_to_string(u[1:a], '') as pre, array_to_string(u[a + 1 : b], '') as mid, array_to_string(u[b + 1 :], '') as suf
  from placed
)
select doc_id, n, form, case when form <> 'plain' then length(pre) end as prefix_chars,
  case when form <> 'plain' then length(mid) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
    else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
  sha256(text) as restored_sha256
from pieces
"""
