"""DuckDB SQL for the queries of this subpackage that SQL can express.

Written from the results' definitions, by brute force: pairs are compared one by one and windows
counted as texts, where the operators use bounds, filters and hashes.  Sharding (op1), mixing
(op7), SentencePiece (op8), toxicity (op9), the class model (op11) and the pipeline have no SQL;
their tests do the same in Python.
"""

from __future__ import annotations

from rollcall.llm.quality import LETTERS, LISTED, MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE, MIN_CHARS, MIN_COMMON, MIN_WORDS, OTHER, REPEATED_PERCENT, WINDOW
from rollcall.llm.substring_dedup import WINDOW as REPEAT

WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _components(nodes: str, links: str, id_: str) -> str:
    """Recursive CTEs: the smallest id that each node reaches over ``links(a, b)``, both ways."""
    return f"""reach as (select {id_} as a, {id_} as b from {nodes}
  union select r.a, l.b from reach r join {links} l on r.b = l.a),
comp as (select a as {id_}, min(b) as component_id from reach group by a)"""


def _listed() -> str:
    lists = " ".join(f"when '{name}' then ['" + "', '".join(words) + "']" for name, words in LISTED.items())
    return f"case key {lists} end"


def _distance(p: str, q: str) -> str:
    def entropy(x: str) -> str:
        return f"-list_sum(list_transform({x}, lambda v: case when v > 0 then v * log2(v) else 0 end))"

    share = "list_transform({0}, lambda v: v / nullif(list_sum({0}), 0))".format
    middle = f"list_transform(list_zip({share(p)}, {share(q)}), lambda z: (z[1] + z[2]) / 2)"
    return f"sqrt(greatest(0.0, {entropy(middle)} - ({entropy(share(p))} + {entropy(share(q))}) / 2))"


def _crc32(text: str, table: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of ``text`` (code points below 2048), by a table of 256 steps."""
    byte = ("flatten(list_transform(string_split({0}, ''), lambda x: case when unicode(x) < 128 then [unicode(x)::bigint]"
            " else [192 + (unicode(x) >> 6)::bigint, 128 + (unicode(x) & 63)::bigint] end))").format(text)
    return f"xor(list_reduce(list_concat([4294967295::bigint], {byte}), lambda c, b: xor(c >> 8, {table}[xor(c & 255, b) + 1])), 4294967295::bigint)"


CRC_TABLE = ("select list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], "
             "lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crc")

BASE32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"

ORACLE: dict[str, str] = {
    "op2_quotation_linking": """select conv_id, turn, role, case when turn > 0 then turn - 1 end as parent_turn,
  cast(0 as bigint) as root_turn, turn as reply_depth, md5(text) as content_md5 from conversations""",

    "op3_substring_dedup": f"""with d as (select row_number() over () as r, doc_id, {WORDS.format('text')} as w from documents),
win as (select r, i, md5(array_to_string(w[i:i + {REPEAT - 1}], ' ')) as h
  from (select r, w, unnest(range(1, len(w) - {REPEAT - 2})) as i from d where len(w) >= {REPEAT}) x),
twice as (select r, i from win where h in (select h from win group by h having count(*) > 1)),
gone as (select distinct r, unnest(range(i, i + {REPEAT})) as i from twice),
each as (select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from d),
kept as (select e.r, count(*) as n, string_agg(word, ' ' order by e.i) as t
  from each e left join gone g on e.r = g.r and e.i = g.i where g.i is null group by e.r)
select doc_id, len(w) as n_words, len(w) - coalesce(k.n, 0) as n_removed, sha256(coalesce(k.t, '')) as kept_sha256
from d left join kept k on d.r = k.r""",

    "op4_quality_rules": f"""with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t, {WORDS.format('text')} as w,
  case when lang in ({", ".join(f"'{x}'" for x in LISTED if x != OTHER)}) then lang else '{OTHER}' end as key from documents),
win as (select r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') as h
  from (select r, w, unnest(range(1, len(w) - {WINDOW - 2})) as i from d where len(w) >= {WINDOW}) x),
many as (select r, h from win group by r, h having count(*) > 1),
rep as (select r, count(*) as n from (select distinct win.r, unnest(range(i, i + {WINDOW})) as i
  from win join many on win.r = many.r and win.h = many.h) x group by r),
lines as (select r, count(*) - count(distinct line) as n from (select r, unnest(string_split(t, chr(10))) as line from d) x
  where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by r),
f as (select d.r, doc_id, key, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols, coalesce(lines.n, 0) as n_dup_lines, coalesce(rep.n, 0) as n_repeat_words,
  len(regexp_extract_all(t, '[.,;:!?]')) as c1, len(regexp_extract_all(t, '[0-9]')) as c2, len(regexp_extract_all(t, '\\p{{Lu}}')) as c3,
  list_transform(w, lambda x: coalesce(list_position({_listed()}, lower(rtrim(x, '.,;:!?'))), 0)) as places
  from d left join rep on d.r = rep.r left join lines on d.r = lines.r),
g as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEATED_PERCENT} * n_words as base_failed,
  [n_symbols, c1, c2, c3, greatest(word_chars - n_symbols - c1 - c2 - c3, 0)] as chars,
  list_transform(range({len(LETTERS)}), lambda k: len(list_filter(places, lambda p: p = case when k = {len(LETTERS) - 1} then 0 else k + 1 end))) as common from f),
ref as (select key, [{", ".join(f"sum(chars[{i + 1}])" for i in range(5))}] as rc,
  [{", ".join(f"sum(common[{i + 1}])" for i in range(len(LETTERS)))}] as rw from g where not base_failed group by key),
j as (select g.*, case when word_chars >= {MIN_CHARS} then {_distance('chars', 'rc')} end as dc,
  case when n_words >= {MIN_COMMON} then {_distance('common', 'rw')} end as dw from g left join ref on g.key = ref.key)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
  cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
  not base_failed and not coalesce(dc > {MAX_CHAR_DISTANCE[0]} + {MAX_CHAR_DISTANCE[1]} / sqrt(n_words), false)
    and not coalesce(dw > {MAX_WORD_DISTANCE[0]} + {MAX_WORD_DISTANCE[1]} / sqrt(n_words), false) as kept from j""",

    "op5_warc": f"""with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
b as (select *, cast(cast(unhex(h) as bit) as varchar) as bits, min(page_id) over (partition by h) as first from p)
select page_id, cast(strlen(html) as bigint) as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr({BASE32}, 1 + {" + ".join(f"{1 << (4 - k)} * cast(substr(bits, cast(5 * i + {k + 1} as bigint), 1) as integer)" for k in range(5))}, 1)), '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to from b""",

    "op6_embedding_near_dedup": f"""with recursive v as (select vec_id, cast(embedding as double[]) as e from embeddings),
links as (select x.vec_id as a, y.vec_id as b from v x join v y on x.vec_id <> y.vec_id and list_cosine_similarity(x.e, y.e) >= 0.9),
{_components('v', 'links', 'vec_id')}
select v.vec_id, (select count(*) from links where a = v.vec_id) as n_links, component_id, v.vec_id = component_id as kept
from v join comp on v.vec_id = comp.vec_id""",

    "op10_ngram_jaccard_join": f"""with recursive d as (select doc_id, {WORDS.format(LOWER.format('text'))} as w from documents),
s as (select doc_id, case when len(w) >= 3 then list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))
  when len(w) > 0 then [array_to_string(w, ' ')] else [] end as g from d),
e as (select doc_id, len(g) as n, unnest(g) as h from s),
links as (select x.doc_id as a, y.doc_id as b from e x join e y on x.h = y.h and x.doc_id <> y.doc_id
  group by x.doc_id, y.doc_id, x.n, y.n having 100 * count(*) >= 90 * (x.n + y.n - count(*))),
{_components('d', 'links', 'doc_id')}
select s.doc_id, cast(len(g) as bigint) as n_shingles, component_id from s join comp on s.doc_id = comp.doc_id""",

    "op12_spelling_variants": f"""with recursive t as ({CRC_TABLE}),
run as (select coalesce(cast(doc_id as varchar), '') as id, {LOWER.format("unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+'))")} as run from documents),
hashed as (select run, {_crc32("(id || ':' || run)", "crc")} as h from run, t where length(run) >= 7),
made as (select case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word from hashed),
w as materialized (select word, count(*) as n from made where length(word) >= 7 group by word having count(*) >= 2),
cut as materialized (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from w) x),
pairs as (select a.word as a, b.word as b, b.n from cut a join cut b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select w.word, c.word, c.n from w join cut c on w.word = c.rest
  union select c.word, w.word, w.n from w join cut c on w.word = c.rest),
near as (select a as word, count(*) as n_near, min({{'less': -n, 'other': b}}) as best from pairs group by a),
formed as materialized (select w.word, w.n, coalesce(n_near, 0) as n_near, case when -best.less >= 10 * w.n then best.other end as form,
  case when -best.less >= 10 * w.n then -best.less end as form_n from w left join near on w.word = near.word),
walk as (select word, word as at from formed union all select walk.word, f.form from walk join formed f on f.word = walk.at where f.form is not null),
root as (select walk.word, walk.at as root from walk join formed f on f.word = walk.at where f.form is null)
select formed.word, form, root, n, n_near, form_n from formed join root on formed.word = root.word""",

    "op13_conversation_repair": f"""with recursive t as ({CRC_TABLE}),
src as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  {_crc32("(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '))", "crc")} % 20 as fault from conversations, t),
rows_ as (select conv_id, turn, case when fault = 4 then 'user' else role end as role,
  case when fault = 1 then '' when fault = 2 then translate(text, '.!?', '') else text end as text,
  unnest(case when fault = 3 then [1, 2] else [1] end) as copy from src where fault <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i from rows_),
marked as materialized (select *, left(role, 1) as ini, lag(left(role, 1)) over (partition by conv_id order by i) as ini0,
  regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) as last,
  row_number() over (partition by conv_id, role, text order by i) as nth from placed),
fault as materialized (select *, case when last = '' then 'b' when nth > 1 then 'd' when last not in ('.', '!', '?') then 't' else 'k' end as f from marked),
ins(q, k, q1) as (values (0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 0, 3), (0, 1, 2), (1, 1, 2), (2, 1, 3), (3, 1, 2), (0, 2, 3), (1, 2, 3), (2, 2, 2), (3, 2, 3)),
st as (select conv_id, 0::bigint as i, 0 as q, {{'cost': 0::bigint, 'audit': ''}} as best from (select distinct conv_id from conversations) c
  union all
  select conv_id, i, q, min({{'cost': cost, 'audit': audit}}) from (
    select s.conv_id, r.i, o.l, s.best.cost + 3 * ins.k + case o.l when 'D' then 4 when 'R' then 3 else 0 end + case when f = 't' and o.l <> 'D' then 3 else 0 end as cost,
      s.best.audit || repeat('I', ins.k) || o.l as audit,
      case o.l when 'D' then q1 when 'R' then case when q1 = 2 then 3 else 2 end
        else case when ini = 's' and q1 = 0 then 1 when ini = 'u' and q1 <> 2 then 2 when ini = 'a' and q1 = 2 then 3 end end as q
    from st s join fault r on r.conv_id is not distinct from s.conv_id and r.i = s.i + 1 join ins on ins.q = s.q, (values ('K'), ('R'), ('D')) o(l)
    where o.l = 'D' or f in ('t', 'k')) x where q is not null group by conv_id, i, q),
size as (select c.conv_id, coalesce(n, 0) as n, blank, duplicate, truncated, illegal, gaps from (select distinct conv_id from conversations) c left join (
  select conv_id, count(*) as n, count(*) filter (f = 'b') as blank, count(*) filter (f = 'd') as duplicate, count(*) filter (f = 't') as truncated,
    count(*) filter (i > 1 and coalesce(ini0 || ini, '') not in ('su', 'ua', 'au')) as illegal,
    coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps from fault group by conv_id) y on y.conv_id is not distinct from c.conv_id),
done as (select z.conv_id, min({{'cost': best.cost + case q when 1 then 6 when 2 then 3 else 0 end, 'audit': best.audit || case q when 1 then 'II' when 2 then 'I' else '' end}}) as best
  from size z join st on st.conv_id is not distinct from z.conv_id and st.i = z.n group by z.conv_id),
letters as (select conv_id, j, substr(best.audit, j, 1) as l from (select conv_id, best, unnest(range(1, length(best.audit) + 1)) as j from done) x),
used as (select *, sum((l <> 'I')::int) over (partition by conv_id order by j) as i, sum((l <> 'D')::int) over (partition by conv_id order by j) as o from letters),
made as (select u.conv_id, u.j, u.o, u.l, r.role, case when u.l = 'I' then '' else r.text end as text,
  max((u.o = 1 and u.l = 'K' and r.ini = 's')::int) over (partition by u.conv_id) as s
  from used u left join fault r on r.conv_id is not distinct from u.conv_id and r.i = u.i where u.l <> 'D'),
told as (select conv_id, string_agg(case when l = 'K' then role when (o - s) % 2 = 1 then 'user' else 'assistant' end || ':' || text, chr(10) order by j) as t from made group by conv_id)
select z.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, cast(best.cost as bigint) as cost, best.audit as audit, sha256(coalesce(t, '')) as repaired_sha256
from size z join done d on d.conv_id is not distinct from z.conv_id left join told on told.conv_id is not distinct from z.conv_id""",
}
