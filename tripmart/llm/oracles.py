"""SQL (DuckDB) for those queries of this subpackage that it can express."""

from __future__ import annotations

from tripmart.llm.license_scan import TEMPLATES
from tripmart.llm.quality_rules import BOILERPLATE

_W = r"[^\x20\x09-\x0D]+"

_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP10 = rf"""
with docs as (
  select doc_id, coalesce(text, '') as body,
    regexp_extract_all(coalesce(text, ''), '{_W}') as ws
  from documents
),
starts as (
  select doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 1))) as i from docs
),
windows as (
  select doc_id, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] as w from starts where i + 2 <= len(ws)
),
twice as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, w) as c from windows) where c > 1
),
covered as (
  select doc_id, count(distinct i + k) as n_repeat_words from twice, (values (0), (1), (2)) as t(k) group by doc_id
),
cut as (
  select doc_id, unnest(string_split(body, chr(10))) as line from docs
),
counted as (
  select doc_id, line, len(regexp_extract_all(line, '{_W}')) as n,
    length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) as symbols,
    length(line) - length(replace(line, '!', '')) as shouts
  from cut
),
judged as (
  select doc_id, line, n,
    n > 0 and (100 * symbols > 40 * n or (100 * shouts > 40 * n and n > 1)
      or (n < 3 and not regexp_matches(line, '[.!?:;,"'')\]][\x20\x09-\x0D]*$'))
      or (n <= 12 and regexp_matches(line, '(?i){"|".join(BOILERPLATE)}'))) as fails
  from counted
),
by_doc as (
  select doc_id, cast(count(*) filter (n > 0) - count(distinct line) filter (n > 0) as bigint) as n_dup_lines,
    cast(coalesce(sum(n) filter (fails), 0) as bigint) as lost_words
  from judged group by doc_id
),
figures as (
  select d.doc_id, cast(len(ws) as bigint) as n_words,
    cast(length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
    cast(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    n_dup_lines, cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words, lost_words
  from docs d join by_doc using (doc_id) left join covered using (doc_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 100 * lost_words <= 40 * n_words as kept,
  lost_words
from figures
"""

OP2 = rf"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_W}') as ws from documents),
windows as (
  select doc_id, i, array_to_string(ws[i : i + 12], ' ') as w
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 11, 1))) as i from d)
),
later as (
  select doc_id, i from (select doc_id, i, min(doc_id) over (partition by w) as first from windows) where first < doc_id
),
covered as (select distinct doc_id, i + k as i from (select doc_id, i, unnest(range(0, 13)) as k from later)),
words as (
  select doc_id, i, ws[i] as word from (select doc_id, ws, unnest(range(1, len(ws) + 1)) as i from d)
),
kept as (
  select w.doc_id as doc_id, count(*) as n_kept, string_agg(word, ' ' order by w.i) as body
  from words w left join covered c on w.doc_id = c.doc_id and w.i = c.i where c.i is null group by w.doc_id
)
select doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - coalesce(n_kept, 0) as bigint) as n_removed,
  sha256(coalesce(body, '')) as kept_sha256
from d left join kept using (doc_id)
"""

OP3 = rf"""
with d as (select doc_id, regexp_extract_all({_FOLD}, '{_TERM}') as ws from documents),
b as (select cast(item_id as varchar) as item, regexp_extract_all({_FOLD}, '{_TERM}') as ws from benchmark),
sized as (select item, ws, least(len(ws), 13) as size from b where len(ws) > 0),
needles as (
  select distinct item, size, array_to_string(ws[i : i + size - 1], ' ') as w
  from (select item, ws, size, unnest(range(1, len(ws) - size + 2)) as i from sized)
),
sizes as (select distinct size from needles),
hay as (
  select doc_id, i, size, array_to_string(ws[i : i + size - 1], ' ') as w
  from (select doc_id, ws, size, unnest(range(1, greatest(len(ws) - size + 2, 1))) as i from d, sizes)
),
found as (select doc_id, i, h.size as size, item from hay h join needles n on h.w = n.w and h.size = n.size),
hit as (
  select doc_id, count(distinct i + k) as n_hit
  from (select doc_id, i, unnest(range(0, size)) as k from found) group by doc_id
),
which as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, item from found) group by doc_id
)
select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from d left join hit using (doc_id) left join which using (doc_id)
"""

_TEMPLATES = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())

OP6 = rf"""
with paragraphs as (
  select doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '\n[\x20\t\r]*\n')) as p from documents
),
lines as (select doc_id, unnest(string_split(p, chr(10))) as p from paragraphs),
sentences as (select doc_id, unnest(regexp_split_to_array(p, '[.!?][\x20\t]+')) as p from lines),
passages as (
  select distinct doc_id, p as text from (select * from paragraphs union all select * from lines union all select * from sentences)
),
numbered as (select doc_id, row_number() over () as k, regexp_extract_all({_FOLD}, '{_TERM}') as ws from passages),
mine as (
  select distinct doc_id, k, ws[i] || ' ' || ws[i + 1] as b
  from (select doc_id, k, ws, unnest(range(1, greatest(len(ws), 1))) as i from numbered)
),
templates as (select name, regexp_extract_all({_FOLD}, '{_TERM}') as ws from (values {_TEMPLATES}) as t(name, text)),
theirs as (
  select distinct name, ws[i] || ' ' || ws[i + 1] as b from (select name, ws, unnest(range(1, len(ws))) as i from templates)
),
sizes as (select doc_id, k, count(*) as n from mine group by doc_id, k),
template_sizes as (select name, count(*) as n from theirs group by name),
common as (select doc_id, k, name, count(*) as c from mine join theirs using (b) group by doc_id, k, name),
dice as (
  select c.doc_id as doc_id, c.name as name, max(2.0::double * c / (s.n + t.n)) as d
  from common c join sizes s on s.k = c.k join template_sizes t on t.name = c.name group by c.doc_id, c.name
),
best as (
  select doc_id, string_agg(name, ',' order by name) as licences, count(*) as n,
    arg_min(name, (-d, name)) as best, max(d) as best_dice
  from dice where d >= 0.8 group by doc_id
)
select d.doc_id as doc_id, coalesce(licences, '') as licences, cast(coalesce(n, 0) as bigint) as n_licences, best,
  coalesce(best_dice, 0.0::double) as best_dice
from documents d left join best on best.doc_id = d.doc_id
"""

OP8 = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
marked as (
  select *, length(text) + len(regexp_extract_all(text,
    '\[\\*/?INST\]|<\\*/?s>|<\\*</?SYS>>|<\\*/SYS>>|<\\*role=|<\\*/role>'))
    + case role when 'user' then 13 when 'assistant' then 7 when 'system' then 15 end as chars
  from turns
)
select cast(conv_id as bigint) as conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(chars) as bigint) as formatted_chars
from marked group by conv_id
"""

OP9 = rf"""
with recursive d as (select doc_id, regexp_extract_all({_FOLD}, '{_W}') as ws from documents),
shingles as (
  select distinct doc_id, array_to_string(ws[i : i + 3], ' ') as s
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) as i from d where len(ws) > 0)
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as c
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by a.doc_id, b.doc_id
),
links as (
  select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y
  where 100 * c >= 85 * (p.n + q.n - c)
),
sides as (select x, y from links union all select y, x from links),
reach as (
  select doc_id as x, doc_id as y from d
  union
  select r.x as x, b.y as y from reach r join sides b on r.y = b.x
)
select d.doc_id as doc_id, cast(coalesce(any_value(n), 0) as bigint) as n_shingles, min(reach.y) as component_id
from d left join sizes on sizes.doc_id = d.doc_id join reach on reach.x = d.doc_id group by d.doc_id
"""

OP12 = """
with cut as (
  select doc_id, coalesce(text, '') as body,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as us,
    sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h
  from documents
),
drawn as (
  select *, len(us) as n,
    cast('0x' || h[1:8] as bigint) % (len(us) + 1) as x, cast('0x' || h[9:16] as bigint) % (len(us) + 1) as y,
    case when body = '' or contains(body, '<P>') or contains(body, '<S>') or contains(body, '<M>')
        or cast('0x' || h[17:24] as bigint) % 100 >= 90 then 'plain'
      when cast('0x' || h[25:32] as bigint) % 100 < 20 then 'spm' else 'psm' end as form
  from cut
),
parted as (
  select *, array_to_string(us[1 : least(x, y)], '') as p, array_to_string(us[least(x, y) + 1 : greatest(x, y)], '') as m,
    array_to_string(us[greatest(x, y) + 1 : n], '') as s
  from drawn
)
select doc_id, cast(n as bigint) as n, form,
  cast(case when form <> 'plain' then length(p) end as bigint) as prefix_chars,
  cast(case when form <> 'plain' then length(m) end as bigint) as middle_chars,
  sha256(case form when 'plain' then body when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(body) as restored_sha256
from parted
"""


def _op11(rounds: int = 4) -> str:
    """Codebooks and assignments round by round: ``b`` has components (part, entry, place), ``a`` the nearest entries."""

    def assigned(k: int) -> str:
        return f"""
a{k} as (
  select i, p, arg_min(e, (d, e)) as e, min(d) as d from (
    select x.i as i, x.p as p, b.e as e, cast(sum((x.v - b.v) * (x.v - b.v)) as bigint) as d
    from parts x join b{k} b on b.p = x.p and b.place = x.place group by x.i, x.p, b.e
  ) group by i, p
)"""

    steps = []
    for k in range(rounds):
        steps.append(assigned(k))
        steps.append(f"""
b{k + 1} as (
  select o.p as p, o.e as e, o.place as place,
    cast(case when m.n is null then o.v else (m.s - ((m.s % m.n) + m.n) % m.n) / m.n end as bigint) as v
  from b{k} o left join (
    select x.p as p, a.e as e, x.place as place, cast(sum(x.v) as bigint) as s, count(*) as n
    from parts x join a{k} a on a.i = x.i and a.p = x.p group by x.p, a.e, x.place
  ) m on m.p = o.p and m.e = o.e and m.place = o.place
)""")
    return f"""
with kept as (
  select *, row_number() over (order by vec_id, embedding) - 1 as i, len(embedding) // 4 as width
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
components as (
  select i, width, unnest(range(0, len(embedding))) as j, unnest(embedding) as x from kept
),
parts as (
  select i, j // width as p, j % width as place, cast(floor(1024 * cast(x as double)) as bigint) as v from components
),
b0 as (select p, i as e, place, v from parts where i < 256),{",".join(steps)},{assigned(rounds)},
coded as (
  select i, string_agg(format('{{:02x}}', e), '' order by p) as code, cast(sum(d) as bigint) as error
  from a{rounds} group by i
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
  (select sha256(string_agg(cast(v as varchar), ',' order by p, e, place)) from b{rounds}) as codebooks_sha256
from kept join coded on coded.i = kept.i
"""


OP11 = _op11()

ORACLES: dict[str, str] = {
    "op2_substring_dedup": OP2,
    "op3_decontamination": OP3,
    "op6_license_scan": OP6,
    "op8_chat_tree": OP8,
    "op9_ngram_join": OP9,
    "op10_quality_rules": OP10,
    "op11_vector_codes": OP11,
    "op12_fill_in_middle": OP12,
}
