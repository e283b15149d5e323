"""The operators' results as DuckDB SQL, where SQL can express them; the other queries are held against plain Python in the tests."""

from __future__ import annotations

from retailgold.llm.mixing import BLOCK, PERIOD

_GAP = r"[^\x20\x09-\x0D]+"

# links(a, b): smallest id that each id reaches
_REACH = """sym as (select a, b from links union select b, a from links),
reach(id, other) as (select a, b from sym union select r.id, s.b from reach r join sym s on r.other = s.a)"""

OP2 = f"""with recursive v as (select vec_id, label, cast(embedding as double[]) as e from embeddings where label is not null),
links as (select x.vec_id as a, y.vec_id as b from v x join v y on x.label = y.label and x.vec_id < y.vec_id
    and list_cosine_similarity(x.e, y.e) >= 0.93),
{_REACH}
select e.vec_id, (select count(*) from sym s where s.a = e.vec_id) as n_links,
    least(e.vec_id, coalesce((select min(other) from reach r where r.id = e.vec_id), e.vec_id)) as component_id,
    e.vec_id <= coalesce((select min(other) from reach r where r.id = e.vec_id), e.vec_id) as kept
from embeddings e"""

_SHA = "sha1(encode(coalesce(html, '')))"
_BASE32 = f"""array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((cast('0x' || substr({_SHA}, 1 + 10 * (i // 8), 10) as bigint)
        >> cast(35 - 5 * (i % 8) as integer)) & 31), 1)), '')"""
OP6 = f"""with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, {_BASE32} as payload_digest from pages),
l as (select payload_digest, max(page_id) as last from p group by payload_digest)
select page_id, payload_bytes, payload_digest, case when page_id = last then 'response' else 'revisit' end as record_type,
    case when page_id <> last then last end as refers_to from p join l using (payload_digest)"""

# one slot of the period after the other: the released block with the earliest deadline, of equal ones the first source
OP7 = f"""with recursive sizes as (select source, count(*) as n, sqrt(count(*)) as w from documents group by source),
wanted as (select source, w * {PERIOD} / sum(w) over () as x from sizes),
floors as (select source, greatest(1, cast(floor(x) as bigint)) as f, x - greatest(1, floor(x)) as rest from wanted),
share as (select source, f + case when row_number() over (order by rest desc, source) <= {PERIOD} - sum(f) over () then 1 else 0 end as a
    from floors),
listed as (select list(source order by source) as names, list(a order by source) as a from share),
slots(slot, chosen, done) as (
    select -1, 0, list_transform(a, lambda x: 0) from listed
    union all
    select slot + 1, pick, list_transform(done, lambda d, i: d + case when i = pick then 1 else 0 end)
    from (select slot, done, a, list_position(due, list_min(due)) as pick from (
        select s.slot, s.done, a, list_transform(done, lambda d, i: case when d < a[i] and d * {PERIOD} // a[i] <= s.slot + 1
            then ((d + 1) * {PERIOD} + a[i] - 1) // a[i] else 1000000 end) as due
        from slots s, listed where s.slot < {PERIOD} - 1) q) p
),
plan as (select names[chosen] as source, a[chosen] as share, done[chosen] - 1 as turn, slot from slots, listed where slot >= 0),
ranked as (select doc_id, source, row_number() over (partition by source order by md5(cast(doc_id as varchar)), doc_id) - 1 as r from documents),
blocks as (select *, r // {BLOCK} as block from ranked),
placed as (select b.doc_id, b.source, s.a as share, b.block, b.r, b.block // s.a as period, b.block % s.a as turn from blocks b join share s using (source))
select doc_id, p.source, p.share, block, period * {PERIOD} + p.turn * {PERIOD} // p.share as release,
    period * {PERIOD} + ((p.turn + 1) * {PERIOD} + p.share - 1) // p.share as deadline, period * {PERIOD} + l.slot as slot,
    (period * {PERIOD} + l.slot) * {BLOCK} + r % {BLOCK} as position
from placed p join plan l on l.source = p.source and l.turn = p.turn"""

OP8 = r"""with docs as (select doc_id, text, case when coalesce(text, '') = '' then [] else string_split(text, chr(10)) end as ls from documents),
lines as (select doc_id, unnest(ls) as s, unnest(range(1, len(ls) + 1)) as i from docs),
sized as (select *, len(regexp_extract_all(s, '""" + _GAP + r"""')) as w from lines),
summed as (select *, sum(w) over (partition by doc_id order by i) as c from sized),
runs as (
    select x.doc_id, x.i as a, min(y.i) as b from summed x join summed y on x.doc_id = y.doc_id and y.i >= x.i and y.c - x.c + x.w >= 50 group by all
    union
    select y.doc_id, max(x.i), y.i from summed x join summed y on x.doc_id = y.doc_id and y.i >= x.i and y.c - x.c + x.w >= 50 group by y.doc_id, y.i
),
said as (select r.doc_id, a, b, array_to_string(ls[a:b], chr(10)) as run from runs r join docs using (doc_id)),
later as (select doc_id, a, b from (select *, min(row(doc_id, a)) over (partition by run) as earliest from said) q where row(doc_id, a) > earliest),
gone as (select distinct l.doc_id, l.i from lines l join later r on l.doc_id = r.doc_id and l.i between r.a and r.b),
kept as (select l.doc_id, string_agg(l.s, chr(10) order by l.i) as text from lines l anti join gone g on l.doc_id = g.doc_id and l.i = g.i group by l.doc_id)
select d.doc_id, cast(len(ls) as integer) as n_lines, cast(coalesce(n, 0) as integer) as n_deleted,
    case when n is null then d.text else coalesce(k.text, '') end as text
from docs d left join (select doc_id, count(*) as n from gone group by doc_id) g using (doc_id) left join kept k using (doc_id)"""

OP10 = f"""with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_GAP}') as ws from documents),
s as (select doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as set from w),
t as (select doc_id, len(set) as n, unnest(set) as token from s),
pairs as (select x.doc_id as a, y.doc_id as b, x.n + y.n as total, count(*) as common from t x join t y on x.token = y.token and x.doc_id < y.doc_id
    group by x.doc_id, y.doc_id, x.n + y.n),
links as (select a, b from pairs where 100 * common >= 75 * (total - common)),
{_REACH}
select doc_id, len(set) as n_shingles, least(doc_id, coalesce((select min(other) from reach r where r.id = s.doc_id), doc_id)) as component_id from s"""


OP11 = r"""with docs as (select row_number() over () as doc, coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
cut as (select lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') as ws from docs),
sizes as (select lang, sum(len(ws)) as n from cut group by lang),
said as (select lang, k, ws[i:i + k - 1] as p from (select lang, ws, k, unnest(range(1, len(ws) - k + 2)) as i from cut, (select unnest(range(1, 6)) as k))),
f as (select lang, k, p, count(*) as a from said group by lang, k, p having count(*) >= 100),
longer as (select lang, unnest([p[1:k - 1], p[2:k]]) as p, a from f where k > 2),
kept as (select * from f where k > 1 and not exists (select 1 from longer x where x.lang = f.lang and x.p = f.p and x.a >= f.a)),
cuts as (select lang, k, p, a, unnest(range(1, k)) as c from kept),
priced as (select cuts.lang, cuts.p, cuts.a, c, x.a as l, y.a as r, n, 1000 * cast(cuts.a as hugeint) * n // (cast(x.a as hugeint) * y.a) as score
    from cuts join f x on x.lang = cuts.lang and x.p = cuts.p[1:c] join f y on y.lang = cuts.lang and y.p = cuts.p[c + 1:] join sizes on sizes.lang = cuts.lang),
worst as (select *, row_number() over (partition by lang, p order by score, c) as place from priced),
ranked as (select lang, array_to_string(p, ' ') as phrase, a, l, r, n, score,
    row_number() over (partition by lang order by score desc, a desc, encode(array_to_string(p, ' '))) as rank from worst where place = 1)
select lang, rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score from ranked where rank <= 2000"""

# states of the role pattern: 0 nothing yet, 1 after the system turn, 2 after a user's, 3 after an assistant's
OP12 = r"""with recursive crc(tab) as (select list_transform(range(256), lambda i:
    list_reduce(list_concat([i], range(8)), lambda x, y: case when x % 2 = 1 then xor(x >> 1, 3988292384) else x >> 1 end))),
named as (select *, coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as name from conversations),
lots as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, xor(list_reduce(list_concat([4294967295],
    list_transform(range(1, len(name) + 1), lambda i: cast(ascii(substr(name, i, 1)) as bigint))),
    lambda x, b: xor(x >> 8, tab[1 + (xor(x, b) & 255)])), 4294967295) % 20 as lot from named, crc),
damaged as (select conv_id, turn, case when lot = 4 then 'user' else role end as role, case lot when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case when lot = 3 then 2 else 1 end)) as copy from lots where lot <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as i from damaged),
bare as (select *, regexp_replace(text, '[\x20\x09-\x0D]+$', '') as said, row_number() over (partition by conv_id, role, text order by i) as time,
    substr(lag(role) over (partition by conv_id order by i), 1, 1) || substr(role, 1, 1) as pair from placed),
turns as (select *, case when said = '' then 'blank' when time > 1 then 'duplicate' when right(said, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault from bare),
-- turns put before a row: letters, cost, lines, states
put(q, letters, c, lines, q1) as (values (0, '', 0, '', 0), (1, '', 0, '', 1), (2, '', 0, '', 2), (3, '', 0, '', 3), (0, 'I', 2, 'user:' || chr(10), 2),
    (1, 'I', 2, 'user:' || chr(10), 2), (3, 'I', 2, 'user:' || chr(10), 2), (2, 'I', 2, 'assistant:' || chr(10), 3),
    (0, 'II', 4, 'user:' || chr(10) || 'assistant:' || chr(10), 3), (1, 'II', 4, 'user:' || chr(10) || 'assistant:' || chr(10), 3)),
-- edits of a row: state, initial (* any), letter, cost, state
edit(q, initial, letter, c, q1) as (values (0, '*', 'D', 3, 0), (1, '*', 'D', 3, 1), (2, '*', 'D', 3, 2), (3, '*', 'D', 3, 3), (0, 's', 'K', 0, 1), (0, 'u', 'K', 0, 2),
    (1, 'u', 'K', 0, 2), (3, 'u', 'K', 0, 2), (2, 'a', 'K', 0, 3), (0, '*', 'R', 2, 2), (1, '*', 'R', 2, 2), (2, '*', 'R', 2, 3), (3, '*', 'R', 2, 2)),
walk(conv_id, i, q, best) as (
    select distinct conv_id, cast(0 as bigint), 0, {'c': 0, 'a': '', 't': ''} from conversations
    union all
    select w.conv_id, t.i, e.q1, min({'c': w.best.c + p.c + e.c + case when t.fault = 'truncated' and e.letter <> 'D' then 1 else 0 end, 'a': w.best.a || p.letters || e.letter,
        't': w.best.t || p.lines || case e.letter when 'D' then '' when 'K' then t.role || ':' || t.text || chr(10)
            else case when p.q1 = 2 then 'assistant' else 'user' end || ':' || t.text || chr(10) end})
    from walk w join turns t on t.conv_id is not distinct from w.conv_id and t.i = w.i + 1 join put p on p.q = w.q join edit e on e.q = p.q1
        and (e.initial = '*' or e.initial = substr(t.role, 1, 1)) and (e.letter = 'D' or t.fault not in ('blank', 'duplicate'))
    group by w.conv_id, t.i, e.q1
),
ends as (select w.conv_id, min({'c': w.best.c + p.c, 'a': w.best.a || p.letters, 't': w.best.t || p.lines}) as best from walk w join put p on p.q = w.q and p.q1 in (0, 3)
    where w.i = (select count(*) from turns t where t.conv_id is not distinct from w.conv_id) group by w.conv_id),
counted as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
    count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
    from turns group by conv_id)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
    cast(best.c as bigint) as cost, best.a as audit, sha256(left(best.t, greatest(len(best.t) - 1, 0))) as repaired_sha256
from ends e left join counted c on c.conv_id is not distinct from e.conv_id"""

_CONTROL = r"([<\[])(\\*)(/?s>|/?INST\]|/?ROLE\]|SAYS\])"
OP13 = rf"""with said as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, t, case t when 0 then 'user' else 'assistant' end, '</s>[INST] ok [/INST]' from range(2) r(t)),
escaped as (select *, len(regexp_replace(text, '{_CONTROL}', '\1\\\2\3', 'g')) as chars, len(regexp_replace(role, '{_CONTROL}', '\1\\\2\3', 'g')) as role_chars from said)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, md5(text))) as turns_sha256,
    coalesce(sum(len(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, role, md5(text)) filter (role = 'assistant'), '')) as loss_sha256,
    sum(chars + case role when 'user' then 15 when 'assistant' then 9 else 23 + role_chars end)::bigint as formatted_chars
from escaped group by conv_id"""


def llm_oracles() -> dict[str, str]:
    return {
        "op2_caps": OP2, "op6_warc": OP6, "op7_mixing": OP7, "op8_lines": OP8, "op10_ngram_join": OP10,
        "op11_collocations": OP11, "op12_structure": OP12, "op13_chat": OP13,
    }
