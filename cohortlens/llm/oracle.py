"""DuckDB SQL for the queries that SQL can express, over the driver's views."""

from __future__ import annotations

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP8 = f"""
with lines as (
    select doc_id, list_position, line,
           translate(trim(line, {_WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from (
        select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as list_position
        from documents)),
holders as (
    select key, max(doc_id) as last_doc from lines where length(key) >= 20
    group by key having count(distinct doc_id) >= 3),
marked as (
    select l.*, h.last_doc is not null and h.last_doc <> l.doc_id as gone from lines l left join holders h using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by list_position) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""

_NAMES = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
#: kind, pattern, counted group, least characters
_KINDS = (
    ("assign", f"({_NAMES})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("pem", "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", 0, 1),
    ("host", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
)
_FOUND = " union all ".join(
    f"""
    select doc_id, '{kind}' as kind, {place} as place, gap_ends + hit_ends - length(hit) as start_at, gap_ends + hit_ends as end_at, {int(place < 3)} as base
    from (
        select doc_id, hit, counted,
               sum(length(gap)) over (partition by doc_id order by i) as gap_ends,
               sum(length(hit)) over (partition by doc_id order by i) as hit_ends
        from (
            select doc_id, unnest(hits) as hit, unnest(groups) as counted, unnest(gaps[:len(hits)]) as gap, generate_subscripts(hits, 1) as i
            from (
                select doc_id, regexp_extract_all(text, '{pattern}') as hits, regexp_extract_all(text, '{pattern}', {group}) as groups,
                       string_split_regex(text, '{pattern}') as gaps
                from documents where regexp_matches(text, '{pattern}'))))
    where length(counted) >= {least}"""
    for place, (kind, pattern, group, least) in enumerate(_KINDS)
)
_OP4 = f"""
with found as ({_FOUND}),
told as (select *, kind || ':' || cast(start_at as bigint) || ':' || cast(end_at as bigint) as span from found),
per_doc as (
    select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
           string_agg(span, ',' order by start_at, place) filter (base = 1) as base_spans, string_agg(span, ',' order by start_at, place) as spans
    from told group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base_spans, '')) as base_sha256, coalesce(spans, '') as spans
from documents d left join per_doc p using (doc_id)
"""

_CONTROL = r"<\\*(?:\|im_(?:start|body|sep|end)\|>|/?s>)|\[\\*/?INST\]"
_OP7 = rf"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
steps as (
    select *, lag(role) over (partition by conv_id order by turn, role, text) is distinct from role as opens,
           length(text) + len(regexp_extract_all(text, '{_CONTROL}')) as chars
    from turns)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(chars + if(opens, length(role) + len(regexp_extract_all(role, '{_CONTROL}')) + length('<|im_start|><|im_body|><|im_end|>') + 1, length('<|im_sep|>'))) as bigint) as formatted_chars
from steps group by conv_id
"""

_OP9 = """
with usable as (
    select distinct vec_id as vec, list_transform(embedding, lambda x: cast(floor(cast(x as double) * 256) as bigint)) as v
    from embeddings
    where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
terms as (select vec, unnest(v) as x, generate_subscripts(v, 1) as term from usable),
scores as (
    select q.vec as query_id, c.vec as vec_id, cast(sum(q.x * c.x) as bigint) as score
    from terms q join terms c on q.term = c.term and q.vec <> c.vec
    where q.vec % 50 = 0 group by all)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from scores qualify rank <= 5
"""


def _level(upper: str, keys: str, children: str) -> str:
    """Water-filling of one level: children (keys, capacity, weight,
    parent_budget). The first child in the order of capacity per weight that
    can't take its share sets the price of what is left."""
    part = f"partition by {upper}" if upper else ""
    same = " and ".join(f"r.{k} is not distinct from o.{k}" for k in upper.split(", ")) if upper else "true"
    return f"""
    select {', '.join('r.' + k for k in keys.split(', '))}, capacity,
           cast(if(o.left_over is null or r.nth < o.nth, capacity, greatest(o.left_over, 0) * weight // o.weight_left) as bigint) as budget
    from (
        select *, row_number() over ({part} order by capacity / weight, {keys}) as nth from {children}) r
    left join (
        select {upper + ', ' if upper else ''} min(nth) as nth, arg_min(left_over, nth) as left_over, arg_min(weight_left, nth) as weight_left
        from (
            select *, row_number() over ({part} order by capacity / weight, {keys}) as nth,
                   cast(parent_budget - coalesce(sum(capacity) over ({part} order by capacity / weight, {keys} rows between unbounded preceding and 1 preceding), 0) as hugeint) as left_over,
                   cast(sum(weight) over ({part}) - coalesce(sum(weight) over ({part} order by capacity / weight, {keys} rows between unbounded preceding and 1 preceding), 0) as hugeint) as weight_left
            from {children})
        where capacity * weight_left > greatest(left_over, 0) * weight
        {'group by ' + upper if upper else 'having count(*) > 0'}) o on {same}"""


_OP3 = f"""
with docs as (
    select doc_id, 'domain' || (cast(coalesce(nullif(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1), ''), '0') as integer) % 4) as domain,
           lang, source, cast(len({_WORDS}) as bigint) as n_tokens
    from documents),
leaves as (select domain, lang, source, cast(sum(n_tokens) as bigint) as tokens from docs group by all),
c1 as (
    select domain, cast(sum(tokens) * 2 as hugeint) as capacity, cast(1 as hugeint) as weight, (select cast(sum(tokens) as hugeint) from leaves) as parent_budget
    from leaves group by domain),
b1 as ({_level("", "domain", "c1")}),
c2 as (
    select l.domain, l.lang, cast(sum(tokens) * 2 as hugeint) as capacity,
           cast(case l.lang when 'en' then 4 when 'de' then 2 when 'fr' then 2 when 'es' then 2 else 1 end as hugeint) as weight, any_value(b.budget) as parent_budget
    from leaves l join b1 b on l.domain is not distinct from b.domain group by l.domain, l.lang),
b2 as ({_level("domain", "domain, lang", "c2")}),
c3 as (
    select l.domain, l.lang, l.source, cast(l.tokens * 2 as hugeint) as capacity, cast(1 as hugeint) as weight, b.budget as parent_budget
    from leaves l join b2 b on l.domain is not distinct from b.domain and l.lang is not distinct from b.lang),
b3 as ({_level("domain, lang", "domain, lang, source", "c3")}),
plan as (
    select domain, lang, source, cast(if(capacity > 0, budget // (capacity // 2), 0) as bigint) as epochs,
           cast(if(capacity > 0, budget % (capacity // 2), 0) as bigint) as rest
    from b3),
ordered as (
    select d.*, p.epochs, p.rest, sum(n_tokens) over (partition by d.domain, d.lang, d.source
        order by md5('7:' || p.epochs || ':' || coalesce(cast(doc_id as varchar), '')) range between unbounded preceding and current row) as upto
    from docs d join plan p on d.domain is not distinct from p.domain and d.lang is not distinct from p.lang and d.source is not distinct from p.source),
taken as (select *, epochs + if(rest > 0 and upto <= rest, 1, 0) as times from ordered)
select doc_id, domain, lang, source, n_tokens, unnest(range(0, cast(times as bigint))) as epoch from taken
"""

# Backward over each conversation's turns: per state (0 start, 1 system, 2 user, 3 assistant) the least (cost, audit,
# repaired lines) of what follows.
def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _step(cost: str, initial: str, line: str, then: str) -> str:
    return f"{{'c': {cost} + {then}.c, 'a': '{initial}' || {then}.a, 't': {line} || {then}.t}}"


def _before_turn(state: int) -> str:
    insert = "user" if state != 2 else "assistant"
    to = {0: 2, 1: 2, 2: 3, 3: 2}[state]
    none = "{'c': 1000000, 'a': '', 't': cast([] as varchar[])}"
    keeps = {0: (("s", 1), ("u", 2)), 1: (("u", 2),), 2: (("a", 3),), 3: (("u", 2),)}[state]
    kept = " ".join(f"when initial = '{role}' then {_step('late', 'K', '[line]', f's{k}')}" for role, k in keeps)
    return _least(
        _step("3", "D", "cast([] as varchar[])", f"s{state}"),
        f"case when gone then {none} {kept} else {none} end",
        f"case when gone then {none} else {_step('2 + late', 'R', f"['{insert}:' || text]", f's{to}')} end",
    )


_EMPTY = "cast([] as varchar[])"
_OP11 = f"""
with recursive hashed as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
           xor(list_reduce(
               list_prepend(cast(4294967295 as bigint),
                            list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''), lambda c: cast(ascii(c) as bigint))),
               lambda crc, b: xor(crc >> 8, list_reduce(cast([xor(crc, b) & 255, 0, 0, 0, 0, 0, 0, 0, 0] as bigint[]),
                                                        lambda x, k: if((x & 1) = 1, xor(x >> 1, cast(3988292384 as bigint)), x >> 1)))),
               cast(4294967295 as bigint)) % 20 as kind
    from conversations),
damaged as (
    select conv_id, turn, if(kind = 4, 'user', role) as role,
           case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
           unnest(range(0, if(kind = 3, 2, 1))) as copy
    from hashed where kind <> 0),
placed as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as place,
           count(*) over (partition by conv_id) as n from damaged),
judged as (
    select *, substr(role, 1, 1) as initial, role || ':' || text as line,
           not regexp_matches(text, '[^\x20\x09-\x0D]') as blank,
           row_number() over (partition by conv_id, role, text order by place) > 1 as again,
           not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') as open_end,
           lag(substr(role, 1, 1)) over (partition by conv_id order by place) as initial_before
    from placed),
turns as (
    select *, blank or again as gone, cast(open_end and not blank and not again as integer) as late from judged),
least_cost as (
    select conv_id, n as place, {{'c': 0, 'a': '', 't': {_EMPTY}}} as s0, {{'c': 4, 'a': 'II', 't': ['user:', 'assistant:']}} as s1,
           {{'c': 2, 'a': 'I', 't': ['assistant:']}} as s2, {{'c': 0, 'a': '', 't': {_EMPTY}}} as s3
    from (select distinct conv_id, n from placed)
    union all
    select conv_id, place, {_least('b0', _step('2', 'I', "['user:']", 'u'))}, {_least('b1', _step('2', 'I', "['user:']", 'u'))}, u, a
    from (
        select *, {_least('b2', _step('2', 'I', "['assistant:']", 'b3'))} as u, {_least('b3', _step('2', 'I', "['user:']", 'b2'))} as a
        from (
            select l.conv_id, l.place - 1 as place, {', '.join(f'{_before_turn(s)} as b{s}' for s in range(4))}
            from least_cost l join turns t on l.conv_id is not distinct from t.conv_id and l.place = t.place))),
repaired as (select conv_id, s0 from least_cost where place = 0),
counted as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
           count(*) filter (again and not blank) as duplicate, sum(late) as truncated,
           count(*) filter (place > 1 and initial_before || initial not in ('su', 'ua', 'au')) as illegal
    from turns group by conv_id)
select o.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       cast(coalesce(truncated, 0) as bigint) as truncated, coalesce(illegal, 0) as illegal, cast(coalesce(s0.c, 0) as bigint) as cost,
       coalesce(s0.a, '') as audit, sha256(coalesce(array_to_string(s0.t, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join repaired r on o.conv_id is not distinct from r.conv_id left join counted c on o.conv_id is not distinct from c.conv_id
"""

_OP12 = """
with pieces as (
    select row_number() over () as id, lang, piece
    from (
        select coalesce(lang, 'und') as lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
        from documents)),
words as (
    select id, lang, unnest(list) as w, generate_subscripts(list, 1) as i
    from (select id, lang, regexp_extract_all(piece, '[^\x20\x09]+') as list from pieces)),
runs as (
    select lang, w as w1, lead(w) over p as w2, lead(w, 2) over p as w3 from words window p as (partition by id order by i)),
f1 as (select lang, w1 as phrase, cast(count(*) as hugeint) as f from runs group by all),
f2 as (select lang, w1, w2, cast(count(*) as hugeint) as f from runs where w2 is not null group by all),
f3 as (select lang, w1, w2, w3, cast(count(*) as hugeint) as f from runs where w3 is not null group by all having count(*) >= 10),
phrases as (select lang, phrase, f from f1 union all select lang, w1 || ' ' || w2, f from f2),
candidates as (
    select lang, w1 || ' ' || w2 as phrase, f as a, unnest([1]) as k, w1 as head, w2 as rest from f2 where f >= 10
    union all select lang, w1 || ' ' || w2 || ' ' || w3, f, 1, w1, w2 || ' ' || w3 from f3
    union all select lang, w1 || ' ' || w2 || ' ' || w3, f, 2, w1 || ' ' || w2, w3 from f3),
scored as (
    select c.lang, c.phrase, a, k, h.f as l, r.f as r, (a * a * 1000000) // (h.f * r.f) as score
    from candidates c join phrases h on h.lang = c.lang and h.phrase = head join phrases r on r.lang = c.lang and r.phrase = rest),
cut as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (
    select lang, phrase, max(f) as longer
    from (select lang, w1 || ' ' || w2 as phrase, f from f3 union all select lang, w2 || ' ' || w3, f from f3) group by all),
kept as (
    select c.* from cut c left join inside i on i.lang = c.lang and i.phrase = c.phrase where longer is null or 100 * longer < 50 * a),
totals as (select lang, count(*) as n from words group by lang)
select k.lang, row_number() over (partition by k.lang order by score desc, a desc, phrase) as rank, phrase,
       cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r, n, cast(score as bigint) as score
from kept k join totals t on t.lang = k.lang qualify rank <= 2000
"""

ORACLE_SQL = {
    "op3_mixture": _OP3,
    "op4_secrets": _OP4,
    "op7_chat": _OP7,
    "op8_line_dedup": _OP8,
    "op9_exact_top_k": _OP9,
    "op11_conversation_repair": _OP11,
    "op12_collocations": _OP12,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
