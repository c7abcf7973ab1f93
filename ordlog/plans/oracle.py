"""What each named query must return, as plain SQL over the same tables."""

from __future__ import annotations

from ordlog.schema import ADDRESS_CHARS, CONTINENTS, LETTERS
from ordlog.sources import synth

_RECORDS = f"""records as (
  select try_cast(c_custkey as int) id, c_name as name,
         concat(c_nationkey, ' ', c_mktsegment) address, r_name continent
  from customer join nation on c_nationkey = n_nationkey
                join region on n_regionkey = r_regionkey)"""

_SUPPLIERS = """suppliers as (
  select try_cast(s_suppkey as int) id, s_name as name,
         concat(s_nationkey, ' ', n_name) address, r_name continent
  from supplier join nation on s_nationkey = n_nationkey
                join region on n_regionkey = r_regionkey)"""

_ORDERS_REC = """orders_rec as (
  select try_cast(o_orderkey as int) id, concat('Order#', o_custkey) as name,
         concat(o_orderstatus, ' ', o_orderpriority) address, r_name continent
  from orders join customer on o_custkey = c_custkey
              join nation on c_nationkey = n_nationkey
              join region on n_regionkey = r_regionkey)"""

_LINES = f"""{_RECORDS}, lines as (
  select concat(id, ',', name, ',', address, ',', continent) as value from records
  union all select concat(doc_id, ',', lang, ',', source, ',', text) from documents
  union all select concat('+00', n_nationkey, ',', n_name, ',,') from nation
  union all select concat(doc_id, ',', quality, ',', toxic) from labels
  union all select concat('x', r_regionkey, ',', r_name, ',a,b') from region
  union all select concat(2147483648 + s_suppkey, ',', s_name, ',a,b') from supplier
  union all select concat(' ', n_nationkey, ',', n_name, ',a,b ') from nation
  union all select '' from region)"""

_FILE = """numbered as (
  select row_number() over (order by value) as number, value from (
    select concat(id, ',', name, ',', address, ',', continent) as value from orders_rec
    union all select concat(o_orderkey, ',', o_orderstatus) from orders))"""

_LOG = """log as (
  select 'events' topic, cast(user_id % 3 as int) as "partition",
         row_number() over (partition by user_id % 3 order by event_id) - 1 as "offset",
         concat(event_id, ',', event_type, ',', props) as value, value as amount
  from events)"""

_LINE = "concat(id, ',', name, ',', address, ',', continent)"


def _group(n: int, source: str = "value") -> str:
    return rf"regexp_extract({source}, '(?s)\A([+-]?[0-9]+),([^,]*),([^,]*),(.*)\z', {n})"


def _parsed(source: str) -> str:
    return f"""parsed as (
  select value, try_cast({_group(1)} as int) id, {_group(2)} as name, {_group(3)} address,
         {_group(4)} continent
  from {source})"""


_TRIMMED = r"""trimmed as (
  select regexp_replace(value, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') as value from lines)"""


# --- generated records: the same arithmetic, spelled out ----------------------------

_WHOLE = 1 << 64


def _times(x: str, factor: int) -> str:
    """A product modulo 2^64: the low half of x exactly, of the high half what is not lost."""
    low, high = f"cast({x} & 4294967295 as hugeint)", f"cast({x} >> 32 as hugeint)"
    return f"cast(({low} * {factor} + {high} * {factor % (1 << 32)} % 4294967296 * 4294967296) % {_WHOLE} as ubigint)"


def _plus(x: str, more: str) -> str:
    return f"cast((cast({x} as hugeint) + {more}) % {_WHOLE} as ubigint)"


def _rounds(name: str, source: str) -> str:
    """Tables that mix the column z of a source; the last has it as name."""
    (s0, f0), (s1, f1) = synth.MIX
    return f"""{name}_a as (select * replace ({_times(f"xor(z, z >> {s0})", f0)} as z) from {source}),
    {name}_b as (select * replace ({_times(f"xor(z, z >> {s1})", f1)} as z) from {name}_a),
    {name} as (select * replace (xor(z, z >> {synth.LAST_SHIFT}) as z) from {name}_b)"""


def _synth(ids: str, seed: int = 42) -> str:
    names = ", ".join(f"'{c}'" for c in CONTINENTS)
    counter = _times("cast(rid as ubigint)", synth.GAMMA)
    step = _times("cast(k + 1 as ubigint)", synth.GAMMA)
    piece = lambda i: f"cast((w[{i // 4 + 1}] >> {i % 4 * 16}) & 65535 as bigint)"
    choice = lambda i, n: f"({piece(i)} * {n} // 65536)"
    text = lambda chars, first, n: " || ".join(f"substr('{chars}', 1 + {choice(first + i, len(chars))}, 1)" for i in range(n))
    return f"""drawn as (select rid, {_plus(counter, str(synth.seed_word(seed)))} as z from ({ids})),
    {_rounds("state", "drawn")},
    stepped as (select rid, k, {_plus("z", step)} as z from state, range({synth.WORDS}) steps(k)),
    {_rounds("word", "stepped")},
    whole as (select rid, list(z order by k) as w from word group by rid),
    synth as (
  select rid as row_id,
         cast((cast({piece(synth.ID)} + {piece(synth.ID + 1)} * 65536 as hugeint) * 2147483647) // 4294967296 as int) as id,
         left({text(LETTERS, synth.NAME, 15)}, 10 + {choice(synth.NAME_SIZE, 6)}) as name,
         {choice(synth.DIGIT, 10)} || ' ' || left({text(ADDRESS_CHARS, synth.ADDRESS, 18)}, 13 + {choice(synth.ADDRESS_SIZE, 6)}) as address,
         ([{names}])[1 + {choice(synth.CONTINENT, 6)}] as continent
  from whole)"""


_SYNTH = _synth("select o_orderkey as rid from orders")


# --- rule reports -------------------------------------------------------------------


def _rules(source: str, domain: tuple[str, ...], row_count: str | None = None) -> str:
    """``source`` has value and, where the line parsed, the fields."""
    each = {
        "id_range": "id >= 0 and id < 2147483647",
        "name_length": "length(name) between 10 and 15",
        "name_letters": "regexp_full_match(name, '[a-zA-Z]+')",
        "address_length": "length(address) between 15 and 20",
        "address_chars": "regexp_full_match(address, '[a-zA-Z0-9 ]+')",
        "continent_valid": "continent in (" + ", ".join(f"'{d}'" for d in domain) + ")",
    }
    some = {
        "address_some_digit": r"regexp_matches(address, '\p{Nd}')",
        "address_some_letter": r"regexp_matches(address, '\p{L}')",
        "address_some_space": "contains(address, ' ')",
    } | {f"continent_present:{d}": f"continent = '{d}'" for d in domain}
    parts = [f"select 'parses' as rule, count(*) checked, count(*) - count(id) violations from {source}"]
    parts += [
        f"select '{r}', count(id), count(*) filter (id is not null and not ({c})) from {source}"
        for r, c in each.items()
    ]
    parts += [
        f"select '{r}', count(id), case when count(*) filter (id is not null and ({c})) = 0 then 1 else 0 end from {source}"
        for r, c in some.items()
    ]
    if row_count:
        parts.append(f"select 'row_count', count(*), abs(count(*) - ({row_count})) from {source}")
    union = " union all ".join(parts)
    return f"select rule, checked, violations, violations = 0 as passed from ({union})"


# --- order --------------------------------------------------------------------------


def _sorted(source: str, key: str) -> str:
    rest = ", ".join(c for c in ("id", "name", "address", "continent") if c != key)
    return f"""select row_number() over (order by {key}, {rest}) - 1 as "offset", id, name, address, continent
  from {source}"""


def _topics(source: str = "records") -> str:
    return " union all ".join(
        f"""select '{k}' as topic, 0 as "partition", "offset", cast(null as varchar) as key, {_LINE} as value
            from ({_sorted(source, k)})"""
        for k in ("id", "name", "continent")
    )


_BUCKETS = """select o.*, b.bucket, b.bucket_first, b.bucket_last,
    row_number() over (order by continent, id, name, address) - 1 as "offset"
  from orders_rec o join (
    select continent as k, row_number() over (order by continent) - 1 bucket,
           cast(sum(n) over (order by continent) - n as bigint) bucket_first,
           cast(sum(n) over (order by continent) - 1 as bigint) bucket_last
    from (select continent, count(*) n from orders_rec group by 1)) b on o.continent = b.k"""

_VIOLATIONS = """select topic, "partition", "offset", before, key from (
    select topic, "partition", "offset", amount as key,
           lag(amount) over (partition by "partition" order by "offset") before from log)
  where before > key"""

_VERDICTS = " union all ".join(
    f"""select '{k}' as topic, 1::bigint as partitions, count(*) as "rows", 0::bigint as violations,
        true as gapless, 'PASS' as verdict from records"""
    for k in ("id", "name", "continent")
)


def _probe(keys: tuple[str, ...], source: str) -> str:
    parts = [
        f"""select '{k}' as key, count(*) as sampled, count(distinct {k}) as distinct_keys,
            case when count(distinct {k}) < 10 then 'LOW' else 'HIGH' end as verdict from {source}"""
        for k in keys
    ]
    return " union all ".join(parts)


_KEPT = "select value from trimmed where value <> ''"

SQL = {
    "synth_records": f"with {_SYNTH} select * from synth",
    "synth_rule_report": f"with {_SYNTH} "
    + _rules("synth", CONTINENTS, row_count="select count(*) from orders"),
    "records_rule_report": f"with {_LINES}, {_parsed('lines')} "
    + _rules("parsed", ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")),
    "serialize_lines": f"with {_RECORDS} select {_LINE} as value from records",
    "text_roundtrip": f"with {_RECORDS} select * from records",
    "parse_lines": f"with {_LINES}, {_parsed('lines')} "
    "select id, name, address, continent from parsed where id is not null",
    "quarantine_lines": f"""with {_LINES}, {_parsed('lines')}
        select value, case when value = '' then 'empty'
               when length(value) - length(replace(value, ',', '')) < 3 then 'too_few_fields'
               else 'bad_id' end as reason
        from parsed where id is null""",
    "quarantine_counts": f"""with {_LINES}, {_parsed('lines')}, bad as (
        select case when value = '' then 'empty'
               when length(value) - length(replace(value, ',', '')) < 3 then 'too_few_fields'
               else 'bad_id' end as reason
        from parsed where id is null)
        select reason, count(*) as "rows" from bad group by reason""",
    "normalize_lines": f"with {_LINES}, {_TRIMMED}, {_parsed('trimmed')} "
    "select id, name, address, continent from parsed where id is not null",
    "project_fields": rf"""with {_LINES}
        select value,
               coalesce(try_cast(regexp_extract(split_part(value, ',', 1),
                 '\A[ \t\n]*([+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?)', 1) as double), 0) as number,
               split_part(value, ',', 2) as second,
               regexp_extract(value, '(?s)\A[^,]*,[^,]*,[^,]*,(.*)\z', 1) as fourth
        from lines""",
    "project_keys": f"""with {_LINES}, {_parsed('lines')}
        select cast(id as varchar) id_key, name as name_key, continent as continent_key
        from parsed where id is not null""",
    "sort_by_id": f"with {_RECORDS} {_sorted('records', 'id')}",
    "sort_by_name": f"with {_RECORDS} {_sorted('records', 'name')}",
    "sort_by_continent": f"with {_RECORDS} {_sorted('records', 'continent')}",
    "sort_custom": """select row_number() over (order by nullif(o_orderstatus, 'P') desc nulls last,
               substr(o_orderpriority, 3), abs(o_totalprice - 100000), o_orderkey) - 1 as "offset",
               o_orderkey, o_orderstatus, o_orderpriority, o_totalprice from orders""",
    "sort_lineitem_shipdate": """select row_number() over (order by l_shipdate, l_orderkey, l_linenumber,
               l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 as "offset",
               l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
        from lineitem""",
    "bucket_counts": 'select o_orderpriority, count(*) as "rows" from orders group by 1',
    "bucket_ordered": f"with {_ORDERS_REC} {_BUCKETS}",
    "bucket_order_check": f"""with {_ORDERS_REC}
        select 'continent' as topic, 0 as "partition", count(*) as "rows", 0::bigint as violations, true as gapless
        from orders_rec""",
    "merge_sorted": f"""with {_RECORDS}, {_SUPPLIERS},
        merged as (select * from records union all select * from suppliers) {_sorted('merged', 'name')}""",
    "merge_overlapping": f"""with {_RECORDS}, {_SUPPLIERS},
        merged as (select * from records union all select * from suppliers) {_sorted('merged', 'id')}""",
    "head_sorted": f"""with {_ORDERS_REC} select * from ({_sorted('orders_rec', 'name')}) where "offset" < 1000""",
    "first_in_order": f"""with {_ORDERS_REC}
        select id, name, address, continent from ({_sorted('orders_rec', 'name')}) where "offset" < 1000""",
    "cardinality_probe": f"with {_ORDERS_REC} " + _probe(("id", "name", "continent"), "orders_rec"),
    "cardinality_of_head": f"""with {_ORDERS_REC}, head as (
        select * from ({_sorted('orders_rec', 'id')}) where "offset" < 1000) """
    + _probe(("id", "name", "continent"), "head"),
    "sort_documents_by_lang": """select row_number() over (order by lang nulls first, text nulls first, doc_id) - 1 as "offset",
               lang, doc_id from documents""",
    "bucket_grouped": f"""with {_ORDERS_REC}, placed as ({_BUCKETS})
        select continent, bucket, bucket_first, bucket_last, count(distinct "offset") as places,
               min("offset") as first_place, max("offset") as last_place, count(*) as "rows"
        from placed group by all""",
    "recorded_counts": f"""with {_RECORDS}
        select topic, cast(count(*) as bigint) as "rows"
        from records, (values ('source'), ('id'), ('name'), ('continent')) t(topic) group by topic""",
    "order_check_damaged": f"""with {_RECORDS}, by_name as ({_sorted('records', 'name')}),
        by_id as ({_sorted('records', 'id')}),
        wrong as (
          select 'id' as topic, lag(id) over (order by "offset") > id as bad from by_name
          union all
          select 'continent', lag(continent) over (order by "offset") > continent from by_id
          union all
          select 'name', false from by_name where "offset" % 10 <> 3)
        select topic, 1::bigint as partitions, count(*) as "rows",
               count(*) filter (bad) as violations, topic <> 'name' or count(*) < 4 as gapless,
               case when count(*) filter (bad) > 0 or topic = 'name' and count(*) > 3 then 'FAIL' else 'PASS' end as verdict
        from wrong group by topic""",
    "run_quarantine": f"""with {_RECORDS}
        select concat(',', name, ',', address, ',', continent) as value, 'bad_id' as reason
        from records where id % 7 = 0""",
    "cardinality_approx": "select key, sampled, verdict from ("
    + _probe(("l_returnflag", "l_linenumber", "l_suppkey", "l_orderkey"), "lineitem")
    + ")",
    "topic_cardinality": f"""with {_LINES}, {_ORDERS_REC}, {_TRIMMED}, {_parsed('trimmed')}, every as (
          select id, name, continent from orders_rec union all select id, name, continent from parsed where id is not null)
        select k as key, n as sampled, case when d < 10 then 'LOW' else 'HIGH' end as verdict from (
          select count(*) as n, count(distinct id) as i, count(distinct name) as m, count(distinct continent) as c from every),
        lateral (values ('id', i), ('name', m), ('continent', c)) v(k, d)""",
    "head_lines": f"""with {_ORDERS_REC}, {_FILE}
        select number, value from (
          select *, row_number() over (order by number) as nth from numbered
          where length(value) - length(replace(value, ',', '')) >= 3) where nth <= 1000""",
    "line_numbers": f"with {_ORDERS_REC}, {_FILE} select number, value from numbered",
    "lost_rows": f"""with {_RECORDS}, ordered as ({_sorted('records', 'name')}), changed as (
          select *, 1 as more from ordered where "offset" % 100 = 3
          union all select *, -1 from ordered where "offset" % 250 = 0)
        select id, name, address, continent, cast(sum(more) as bigint) as surplus
        from changed group by all having sum(more) <> 0""",
    "stream_progress": f"""with {_RECORDS}, {_ORDERS_REC}
        select cast(0 as bigint) as batch, cast(0 as bigint) as log_offset, true as committed, count(*) as "rows" from orders_rec
        union all select 1, 1, true, count(*) from records""",
    "publish_consume": f"with {_LINES}, {_TRIMMED} {_KEPT}",
    "published_offsets": f"""with {_LINES}, {_ORDERS_REC}
        select 'source' as topic, 3::bigint as partitions,
               (select count(*) from lines) + (select count(*) from orders_rec) as "rows",
               0::bigint as violations, true as gapless""",
    "ordered_topics": f"with {_RECORDS} {_topics()}",
    "preview_topics": f"""with {_RECORDS} select * from ({_topics()}) where "offset" < 5""",
    "head_sample": f"""with {_ORDERS_REC} select * from ({_sorted('orders_rec', 'name')}) where "offset" < 1000""",
    "topic_counts": f"""with {_RECORDS}
        select topic, count(*) as "rows", count(*) as recorded
        from records, (values ('source'), ('id'), ('name'), ('continent')) t(topic) group by topic""",
    "log_end_offsets": f"""with {_LOG} select topic, cast(sum(span) as bigint) as expected from (
        select topic, max("offset") + 1 - min("offset") span from log group by topic, "partition") group by topic""",
    "log_progress": f"""with {_LOG}, p as (
        select topic, "partition", max("offset") + 1 end_offset,
               least(max("offset") + 1, 3000) as position from log group by topic, "partition")
        select *, end_offset - position as lag, position >= end_offset as complete from p""",
    "event_log_rows": f"""with {_LOG} select topic, "partition", "offset", value from log""",
    "order_check_sorted": f"with {_RECORDS} {_VERDICTS}",
    "order_check_unsorted": f"""with {_LOG}, v as ({_VIOLATIONS})
        select topic, "partition", count(*) as "rows",
               (select count(*) from v where v."partition" = log."partition") as violations, true as gapless
        from log group by topic, "partition" """,
    "first_violations": f"""with {_LOG}, v as ({_VIOLATIONS})
        select * from (select *, cast(row_number() over (partition by "partition" order by "offset") as int) as nth from v)
        where nth <= 3""",
    "fingerprint_match": f"""with {_RECORDS}
        select 'sorted' as "case", count(*) as left_rows, count(*) as right_rows, true as equal from records
        union all
        select 'without ASIA', count(*), count(*) filter (continent <> 'ASIA'), false from records""",
    "multiset_diff": """select key, cast(sum(n) as bigint) as surplus from (
          select o_custkey as key, 1 as n from orders union all select c_custkey, -1 from customer)
        group by key having sum(n) <> 0""",
    "observed_domain": f"with {_RECORDS} select distinct continent from records",
    "domain_equality": f"""with {_LINES}, {_parsed('lines')},
        seen as (select distinct continent as value from parsed where id is not null)
        select value, 'unexpected' as status from seen where value not in (select r_name from region)
        union all
        select r_name, 'missing' from region where r_name not in (select value from seen)""",
    "stream_consume": f"with {_LINES}, {_TRIMMED} {_KEPT}",
    "stream_resume": f"""with {_RECORDS}, {_ORDERS_REC},
        n as (select (select count(*) from orders_rec) o, (select count(*) from records) r)
        select 0 as step, o as rows_read, o as rows_held, true as complete from n
        union all select 1, r, o + r, true from n
        union all select 2, 0, o + r, true from n""",
    "run_summary": f"""with {_RECORDS}
        select step, stage, n as "rows", 0::bigint as lost, true as matches_source
        from (select count(*) n from records),
             (values (0, 'generated'), (1, 'source'), (2, 'consumed'), (3, 'id'), (4, 'name'), (5, 'continent'))
               s(step, stage)""",
    "run_report": """select t as topic, 1::bigint as partitions, n as "rows", 0::bigint as violations, true as gapless,
               true as same_rows, 'PASS' as verdict
        from (select count(*) n from orders), (values ('id'), ('name'), ('continent')) s(t)""",
}
