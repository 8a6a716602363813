"""DuckDB SQL for the rows of those training-data queries that SQL can express, written from their contracts."""

from __future__ import annotations

from .quality import PART, RANKS, REACH, RULES, SHRINK

_WORDS = r"list_filter(regexp_split_to_array({t}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _fence(q: str, unit: int) -> str:
    """The threshold over a list of quantiles q, the median first; `words` is the median count of words."""
    reach = lambda i: f"({q}[{i}] + {REACH} * greatest({q}[{i}] - {q}[1], {float(unit)} / greatest(words, 1.0)))"
    n = len(RANKS)
    at = f"list_min(list_filter(range(2, {n}), lambda i: {q}[i + 1] > {reach('i')}))"
    return f"coalesce(greatest({reach(at)}, {q}[{at}] + {PART} * ({q}[{at} + 1] - {q}[{at}])), {reach(n)})"


def quality_sql() -> str:
    """op2: the counts by lists and windows; the verdict by exact quantiles in place of sketches."""
    up, down = str(RANKS), str([round(1 - r, 2) for r in RANKS])
    sides = [(r, "hi", 1, unit) for r, (_, unit) in RULES.items()] + [(r, "lo", -1, unit) for r, (side, unit) in RULES.items() if side == "both"]
    quantiles = ", ".join(f"list_transform(quantile_disc({r}, {up if sign > 0 else down}), lambda x: x * {sign}) as q_{end}_{r}" for r, end, sign, _ in sides)
    fences = ", ".join(f"{_fence(f'q_{end}_{r}', unit)} * {sign} as {end}_{r}" for r, end, sign, unit in sides)
    level = lambda by: f"select {by}{', ' if by else ''}n, {fences} from (select {by}{', ' if by else ''}count(*) as n, quantile_disc(n_words, 0.5)::double as words, {quantiles} from good{f' group by {by}' if by else ''})"
    drawn = lambda e: f"g.{e} * g.n / (g.n + {SHRINK}.0) + (l.{e} * l.n / (l.n + {SHRINK}.0) + a.{e} * (1 - l.n / (l.n + {SHRINK}.0))) * (1 - g.n / (g.n + {SHRINK}.0))"
    ends = [f"{end}_{r}" for r, end, *_ in sides]
    inside = " and ".join(f"m.{r} {'<=' if end == 'hi' else '>='} t.{end}_{r}" for r, end, *_ in sides)
    return rf"""with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t, lang, source from documents),
 w as (select *, {_WORDS.format(t='t')} as w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from d),
 g as (select r, unnest(range(1, len(w) - 1)) as i, w from w where len(w) > 2), c as (select r, i, count(*) over (partition by r, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) as n from g),
 again as (select r, count(distinct p) as n_repeat_words from (select r, unnest([i, i + 1, i + 2]) as p from c where n > 1) group by r),
 counts as (select r, doc_id, lang, source, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
  (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words from w left join again using (r)),
 m as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, n_symbols / greatest(n_words, 1)::double as symbol_ratio, n_dup_lines * 5 / greatest(n_words, 1)::double as dup_line_ratio, n_repeat_words / greatest(n_words, 1)::double as repeat_ratio, word_chars / greatest(n_words, 1)::double as mean_word from counts),
 good as (select * from m where not base_failed), a as ({level('')}), l as ({level('lang')}), s as ({level('lang, source')}),
 t as (select g.lang, g.source, {', '.join(f'{drawn(e)} as {e}' for e in ends)} from s g join l on l.lang is not distinct from g.lang cross join a)
 select m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and coalesce({inside}, true) as kept from m left join t on t.lang is not distinct from m.lang and t.source is not distinct from m.source"""


def chat_sql() -> str:
    """op3: digests of what was said, and the length of the formatted text from its parts."""
    escaped = r"length(regexp_replace({x}, '<(\\*)\|', '<\\\1|', 'g'))"
    return rf"""with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
 select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars, sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length('<|im_start|>') + {escaped.format(x='role')} + 1 + {escaped.format(x='text')} + length('<|im_end|>') + 1)::bigint as formatted_chars from c group by conv_id"""


#: Components of edges (u, v), both ways: the least id that a row reaches.
_REACH = "reach(u, v) as (select u, v from edges union select r.u, e.v from reach r join edges e on r.v = e.u)"


def vectors_sql() -> str:
    """op4: all pairs of a label."""
    return f"""with recursive x as (select vec_id, label, embedding::double[] as e from embeddings), ok as (select * from x where label is not null and e is not null and len(e) > 0 and len(list_filter(e, lambda v: v is null or not isfinite(v))) = 0 and len(list_filter(e, lambda v: v <> 0)) > 0),
 edges as (select a.vec_id as u, b.vec_id as v from ok a join ok b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.93), {_REACH}
 select vec_id, (select count(*) from edges where u = vec_id) as n_links, least(vec_id, coalesce((select min(v) from reach where u = vec_id), vec_id)) as component_id, vec_id = least(vec_id, coalesce((select min(v) from reach where u = vec_id), vec_id)) as kept from x"""


def jaccard_sql() -> str:
    """op6: distinct 4-word shingles, counts of those in common."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""with recursive w as (select doc_id, {_WORDS.format(t=low)} as w from documents),
 s as (select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) end) as g from w),
 n as (select doc_id, count(*) as n from s group by doc_id), met as (select a.doc_id as u, b.doc_id as v, count(*) as k from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
 edges as (select u, v from met join n a on a.doc_id = u join n b on b.doc_id = v where 100 * k >= 85 * (a.n + b.n - k)), {_REACH}, least_of as (select u, min(v) as v from reach group by u)
 select w.doc_id, coalesce(n, 0) as n_shingles, least(w.doc_id, coalesce(v, w.doc_id)) as component_id from w left join n using (doc_id) left join least_of on u = w.doc_id"""


def _crc_table() -> list[int]:
    """The table of CRC-32 by bytes, from its polynomial."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


#: CRC-32 of the bytes of a string x, with the table as a column `crc`.
_CRC = "xor(list_reduce(list_transform(range(1, len(hex(encode({x}))), 2), lambda i: ('0x' || substr(hex(encode({x})), i, 2))::bigint), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint)"
_CRC_TABLE = f"t as (select {_crc_table()}::bigint[] as crc)"


def repair_sql() -> str:
    """op11: row by row, the least (cost, audit, turns) that ends in each of four states: nothing yet, after s, after u, after a."""
    last = r"right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1)"
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    full = {"u": "user", "a": "assistant"}
    ways: dict[int, list[str]] = {q: [] for q in range(4)}
    for q in range(4):
        for ins in ("", "u", "a"):
            if ins and (q, ins) not in step:
                continue
            at, i, paid, said = (step[q, ins], "I", 2, f", '{full[ins]}:'") if ins else (q, "", 0, "")
            path = lambda cost, letter, turn, when, q=q, i=i, paid=paid, said=said: f"case when s{q} is not null and {when} then {{'c': s{q}.c + {paid} + {cost}, 'a': s{q}.a || '{i}{letter}', 'o': s{q}.o || [{', '.join(x for x in (said[2:], turn) if x)}]::varchar[]}} end"
            ways[at].append(path("3", "D", "", "true"))
            ok = "fault in ('-', 't')"
            late = "(fault = 't')::int"
            for r in "sua":
                if (at, r) in step:
                    ways[step[at, r]].append(path(late, "K", "role || ':' || text", f"{ok} and left(role, 1) = '{r}'"))
            for x in "ua":
                if (at, x) in step:
                    ways[step[at, x]].append(path(f"2 + {late}", "R", f"'{full[x]}:' || text", ok))
    kind = "struct(c bigint, a varchar, o varchar[])"
    moves = ", ".join(f"list_min(list_filter([{', '.join(ways[q])}]::{kind}[], lambda x: x is not null))" for q in range(4))
    ends = "list_min(list_filter([s0, s3, case when s2 is not null then {'c': s2.c + 2, 'a': s2.a || 'I', 'o': s2.o || ['assistant:']} end], lambda x: x is not null))"
    key = "coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')"
    return rf"""with recursive {_CRC_TABLE}, h as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {_CRC.format(x=key)} % 20 as how from conversations, t),
 d as (select conv_id, turn, case when how = 4 then 'user' else role end as role, case how when 1 then '' when 2 then translate(text, '.!?', '') else text end as text, unnest(case when how = 3 then [0, 1] else [0] end) as again from h where how <> 0),
 p as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos from d),
 f as (select *, case when not regexp_matches(text, '[^ 	-
]') then 'b' when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'd' when {last} not in ('.', '!', '?') then 't' else '-' end as fault,
  coalesce(left(lag(role) over (partition by conv_id order by pos), 1) || left(role, 1) not in ('su', 'ua', 'au'), false) as illegal from p),
 m as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated, count(*) filter (illegal) as illegal from f group by 1),
 r as (select conv_id, 0::bigint as pos, {{'c': 0, 'a': '', 'o': []}}::{kind} as s0, null::{kind} as s1, null::{kind} as s2, null::{kind} as s3 from (select distinct conv_id from conversations)
  union all select f.conv_id, f.pos, {moves} from r join f on f.conv_id is not distinct from r.conv_id and f.pos = r.pos + 1),
 e as (select conv_id, {ends} as x from (select conv_id, arg_max({{'s0': s0, 's2': s2, 's3': s3}}, pos) as s from r group by 1), lateral (select s.s0 as s0, s.s2 as s2, s.s3 as s3))
 select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, x.c as cost, x.a as audit, sha256(array_to_string(x.o, chr(10))) as repaired_sha256
 from e left join m on m.conv_id is not distinct from e.conv_id"""


def spelling_sql() -> str:
    """op12: words with equal remainders after a deletion; substitutions by the same place, insertions by the whole shorter word."""
    run = "translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""with recursive {_CRC_TABLE}, o as (select doc_id, {run} as run from documents), g as (select doc_id, run, count(*) as k from o where length(run) >= 7 group by all),
 h as (select run, k, {_CRC.format(x="(coalesce(doc_id::varchar, '') || ':' || run)")} as h from g, t), w as (select case when h % 31 = 0 then left(run, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end as word, k from h),
 v as (select word, sum(k)::bigint as n from w where length(word) >= 7 group by 1 having sum(k) >= 2), c as (select word, i, left(word, i - 1) || substr(word, i + 1) as cut from (select word, unnest(range(1, length(word) + 1)) as i from v)),
 p as (select a.word, b.word as near from c a join c b on a.i = b.i and a.cut = b.cut and a.word <> b.word union select c.word, v.word from c join v on v.word = c.cut union select v.word, c.word from c join v on v.word = c.cut),
 q as (select p.word, count(*) as n_near, min({{'less': -b.n, 'form': near}}) as f from p join v b on b.word = near group by 1),
 f as (select v.word, v.n, coalesce(n_near, 0) as n_near, case when -f.less >= 10 * v.n then f.form end as form, case when -f.less >= 10 * v.n then -f.less end as form_n from v left join q using (word)),
 r as (select word, word as root, 0 as i from f union all select r.word, f.form, i + 1 from r join f on f.word = r.root where f.form is not null)
 select f.word, form, e.root, n, n_near, form_n from f join (select word, arg_max(root, i) as root from r group by 1) e using (word)"""


def warc_sql() -> str:
    """op13: payloads compared by their digests."""
    return """with p as (select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
 f as (select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first from p)
 select page_id, payload_bytes, payload_digest, case when first <> page_id then 'revisit' else 'response' end as record_type, case when first <> page_id then first end as refers_to from f"""


ORACLE_SQL = {"op2_quality": quality_sql(), "op3_chat_format": chat_sql(), "op4_near_duplicates": vectors_sql(), "op6_jaccard_join": jaccard_sql(), "op11_conversation_repair": repair_sql(), "op12_spelling_variants": spelling_sql(), "op13_warc": warc_sql()}
