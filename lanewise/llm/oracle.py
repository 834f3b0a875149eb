"""DuckDB statements for the queries that SQL can express."""

ORACLE: dict[str, str] = {}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_ESCAPED = "replace({0}, '\\', '\\\\')"
for _control in ("[INST]", "[/INST]", "<s>", "</s>"):
    _ESCAPED = f"replace({_ESCAPED}, '{_control}', '{_control[0]}\\{_control[1:]}')"

ORACLE["op1_chat_format"] = f"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all
  select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked as (
  select *, lag(role) over w is distinct from role as opens,
    lead(role) over w is distinct from role as closes
  from rows window w as (partition by conv_id order by turn nulls first, role, text)
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text))
    as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text)
    filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length({_ESCAPED.format("text")})
    + case when opens then 13 + length({_ESCAPED.format("role")}) else 3 end
    + case when closes then 4 else 0 end) as bigint) as formatted_chars,
  cast(count_if(opens) as bigint) as n_blocks
from marked group by conv_id
"""

ORACLE["op2_top_k"] = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, e.vec_id,
    cast(list_sum(list_transform(list_zip(q.v, e.v), lambda p: p[1] * p[2])) as bigint) as score
  from vectors q join vectors e on q.vec_id <> e.vec_id
  where q.vec_id % 100 = 0
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 10
"""

ORACLE["op3_substring_dedup"] = f"""
with docs as (select doc_id, {_WORDS} as w from documents),
windows as (
  select doc_id, w, unnest(range(1, len(w) - 11)) as place from docs where len(w) >= 13
), keyed as (
  select doc_id, place, array_to_string(w[place:place + 12], ' ') as gram from windows
), first as (select gram, min(doc_id) as source from keyed group by gram),
hits as (
  select k.doc_id, k.place from keyed k join first f using (gram) where f.source < k.doc_id
), covered as (
  select distinct doc_id, unnest(range(place, place + 13)) as place from hits
), words as (
  select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as place from docs
), kept as (
  select w.doc_id, string_agg(word, ' ' order by w.place) as kept, count(*) as n_kept
  from words w left join covered c on w.doc_id = c.doc_id and w.place = c.place
  where c.place is null group by w.doc_id
)
select d.doc_id, cast(len(d.w) as bigint) as n_words,
  cast(len(d.w) - coalesce(k.n_kept, 0) as bigint) as n_removed,
  sha256(coalesce(k.kept, '')) as kept_sha256
from docs d left join kept k on d.doc_id = k.doc_id
"""

ORACLE["op9_host_rules"] = rf"""
with docs as (
  select doc_id, source, coalesce(text, '') as text, {_WORDS} as w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents
), windows as (
  select doc_id, unnest(range(1, len(w) - 3)) as place, w from docs where len(w) >= 5
), keyed as (
  select doc_id, place, array_to_string(w[place:place + 4], ' ') as gram from windows
), repeated as (
  select doc_id, place from keyed
  qualify count(*) over (partition by doc_id, gram) > 1
), covered as (
  select doc_id, count(distinct p) as n from (
    select doc_id, unnest(range(place, place + 5)) as p from repeated) group by doc_id
), measured as (
  select d.doc_id, d.source,
    cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
    cast(len(w) as bigint) as n_words,
    cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    cast(coalesce(c.n, 0) as bigint) as n_repeat_words
  from docs d left join covered c on d.doc_id = c.doc_id
), judged as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from measured
), hosts as (
  select source, count(*) as n, count_if(base_failed) as f from judged group by source
), prior as (
  select avg(f / n) as m, var_pop(f / n) as v, avg(n) as docs from hosts
), weighted as (
  select m, case when v > 0 then greatest(1, m * (1 - m) / v - 1) else docs end as weight from prior
), bad as (
  select source, (f + m * weight) / (n + weight) > 0.5 as bad from hosts, weighted
)
select j.doc_id, word_chars, n_words, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not b.bad as kept
from judged j join bad b on j.source is not distinct from b.source
"""

ORACLE["op10_warc"] = """
with payloads as (
  select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as digits from pages
), first as (select payload, min(page_id) as response from payloads group by payload)
select p.page_id, cast(strlen(p.payload) as bigint) as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    cast((cast('0x' || substr(digits, cast(5 * (i // 4) + 1 as bigint), 5) as integer)
      >> cast(15 - 5 * (i % 4) as integer)) & 31 as bigint) + 1, 1)), '') as payload_digest,
  case when p.page_id = f.response then 'response' else 'revisit' end as record_type,
  case when p.page_id <> f.response then f.response end as refers_to
from payloads p join first f on p.payload = f.payload
"""

_BLANK = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"

ORACLE["op13_line_dedup"] = f"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
  from documents
), keyed as (
  select *, translate(trim(line, {_BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    as key
  from lines
), first as (
  select key, min(doc_id) as holder from keyed where length(key) >= 10 group by key
), marked as (
  select doc_id, line, place, coalesce(holder < doc_id, false) as drops
  from keyed left join first using (key)
)
select doc_id, count(*) as n_lines, cast(count_if(drops) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (not drops), '')) as kept_sha256
from marked group by doc_id
"""
