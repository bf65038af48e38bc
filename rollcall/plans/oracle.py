"""DuckDB SQL equal to each driver query (same column names and types).

The SQL is written independently of the Spark plans (windows where Spark
uses aggregates, NOT IN / EXISTS where Spark uses anti / semi joins), so an
agreement checks the operators rather than restating them.
"""

from __future__ import annotations

from rollcall.operators.audience import CUTOFF_DAYS, WELCOME_TEMPLATE
from rollcall.plans.standins import (
    INTERACTION_CUTOFF, POST_EPOCH, POST_STEP, POSTS_AS_OF, PROTECTED_SEGMENT, REPEATED_HOUR, SKIPPED_HOUR, SPLIT_TS)

PPL = ("select c_custkey as pk, c_name as username, "
       "case when c_custkey % 7 = 0 then null else c_mktsegment end as full_name from customer")


def _replay(snaps: str) -> str:
    """Periods of the snapshot CTE ``snaps`` (snap_date, pk, username, full_name), one row per snapshot and pk."""
    return f"""
cal as (select snap_date, row_number() over (order by snap_date) as n,
               lead(snap_date) over (order by snap_date) as next_date
        from (select distinct snap_date from {snaps}) d),
m as (select s.pk, s.username, s.full_name, c.snap_date, c.n, c.next_date,
             c.n - row_number() over (partition by s.pk order by c.n) as island
      from {snaps} s join cal c on s.snap_date = c.snap_date),
per as (select pk, island, min(snap_date) as data_entrada,
               case when count(*) = count(next_date) then max(next_date) end as data_saida,
               max(snap_date) as data_update
        from m group by pk, island),
hist as (select per.pk, m.username, m.full_name, per.data_entrada, per.data_saida,
                per.data_update, cast(null as integer) as welcome
         from per join m on per.pk = m.pk and per.island = m.island and per.data_update = m.snap_date)"""


SNAPS = """snaps as (select * exclude (rn) from (
  select cast(ts as date) as snap_date, user_id as pk,
    'user' || cast(user_id - user_id % 2 as varchar) || '.' || cast(day(ts) % 3 as varchar) as username,
    case when event_type = 'signup' then null else event_type || ' ' || cast(user_id % 5 as varchar) end as full_name,
    row_number() over (partition by cast(ts as date), user_id order by event_id) as rn
  from events) e where rn = 1)"""
HIST_ALL = f"with {SNAPS}, {_replay('snaps')}"
HIST_PREV = (f"with {SNAPS}, last as (select max(snap_date) as d from snaps), "
             f"prev as (select * from snaps where snap_date < (select d from last)), "
             f"t as (select pk, username, full_name from snaps where snap_date = (select d from last)), "
             f"{_replay('prev')}")
CAND = """cand as (select username, convites, pk from (
  select username, coalesce(full_name, username) as convites, pk,
         row_number() over (partition by username order by data_entrada desc, pk desc) as rn
  from {hist} where welcome is null and data_saida is null) x where rn = 1)"""

CAPTION = r"""case doc_id % 4
  when 0 then text
  when 1 then text || chr(10) || '.' || chr(10) || '#' || source || '. #' || lang || ',' || chr(10) || '#x'
  when 2 then text || chr(10) || ' ... ' || chr(10) || '#Repost @' || source || '.a'
  else text || chr(10) || '.' || chr(10) || '#' || source || '. #' || lang || ',' || chr(10) || '#x'
       || chr(10) || ' ... ' || chr(10) || '#Repost @' || source || '.a' end"""

RESULTS = f"""r as (select strftime(e.ts, '%Y-%m-%d') as run_id, e.event_id as seq, p.username,
       case when e.event_type = 'signup' then null else e.event_type <> 'error' end as status
     from events e left join ({PPL}) p on e.user_id = p.pk),
cut as (select run_id, min(seq) as c from r where status = false group by run_id),
acc as (select r.* from r left join cut on r.run_id = cut.run_id where cut.c is null or r.seq < cut.c)"""

NO_INTERACTION = f"""with ppl as ({PPL}),
f as (select * from ppl where pk in (select user_id from events)),
likes as (select cast(user_id as varchar) as follower_pk from events
          where event_type = 'click' and ts >= timestamp '{INTERACTION_CUTOFF}'),
comments as (select user_id as follower_pk from events
             where event_type = 'view' and ts >= timestamp '{INTERACTION_CUTOFF}'),
no_like as (select * from f where pk not in (select cast(follower_pk as bigint) from likes))
select pk, username, full_name from no_like
where pk not in (select follower_pk from comments)"""

POSTS_SINCE = (f"select o_orderkey from orders where o_orderdate >= "
               f"timestamp '{POSTS_AS_OF}' - interval {CUTOFF_DAYS} day")

LAST_PER_KEY = """select event_id, ts, user_id, event_type, value, props from (
  select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as rn
  from events {where}) x where rn = 1"""

TS_SRC = "to_timestamp(1704067200 + conv_id * 86400 + turn * 3600)"


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


POSTS_SQL = f"""with c as (select *, to_timestamp({POST_EPOCH} + doc_id * {POST_STEP}) as moment, {CAPTION} as caption from documents),
k as (select *, string_split_regex(caption, '\\n ?\\.+ ?\\n') as k from c),
sel as (select *, k[1] as caption_text,
   list_filter(k[2:], lambda x: position('#' in x) > 0 and position('#repost' in lower(x)) = 0)[-1] as h,
   list_filter(k[2:], lambda x: position('#repost' in lower(x)) > 0)[-1] as r from k)
select cast(doc_id as varchar) as post_id, 1 as media_type,
  timezone('America/Sao_Paulo', moment) as criado_em_post,
  cast(isodow(timezone('UTC', moment)) - 1 as integer) as dia_semana_post,
  doc_id % 13 as comment_count, n_chars as like_count, caption_text,
  coalesce(regexp_replace(translate(h, '.,' || chr(10), ''), '^\\s+|\\s+$', '', 'g'), '') as hashtags,
  case when doc_id % 5 <> 0 then n_chars * 3 end as view_count,
  coalesce(regexp_replace(replace(translate(r, '.,' || chr(10), ''), '#Repost ', ''), '^\\s+|\\s+$', '', 'g'), '') as repost
from sel"""

LIKES_SQL = """select cast(l_orderkey as varchar) as post_pk, l_suppkey as follower_pk,
  l_returnflag = 'R' as is_private, l_linestatus as stories from lineitem"""

COMMENTS_SQL = f"""select cast(conv_id as varchar) as post_pk, turn as comment_pk, text, conv_id as follower_pk,
  role = 'assistant' as is_private, timezone('America/Sao_Paulo', {TS_SRC}) as created_at,
  cast(isodow(timezone('UTC', {TS_SRC})) - 1 as integer) as dia_semana, role as content_type, 'Active' as status,
  turn % 2 = 0 as has_liked_comment, cast(length(text) as bigint) as like_count from conversations"""

ORACLE: dict[str, str] = {
    "q01_flatten_users": """select doc_id as pk, source as username,
        translate(text, '''"', '  ') as full_name from documents""",

    "q02_caption_parse": POSTS_SQL,

    "q03_flatten_likes": f"""select cast(l_orderkey as varchar) as post_pk, l_suppkey as follower_pk,
        l_returnflag = 'R' as is_private, l_linestatus as stories
        from lineitem where l_orderkey in ({POSTS_SINCE})""",

    "q04_flatten_comments": f"""select cast(conv_id as varchar) as post_pk, turn as comment_pk, text,
        conv_id as follower_pk, role = 'assistant' as is_private,
        timezone('America/Sao_Paulo', {TS_SRC}) as created_at,
        cast(isodow(timezone('UTC', {TS_SRC})) - 1 as integer) as dia_semana,
        role as content_type, 'Active' as status, turn % 2 = 0 as has_liked_comment,
        cast(length(text) as bigint) as like_count
        from conversations where conv_id in (select o_orderkey from orders)""",

    "q05_csv_round_trip": "select * from orders",

    "q06_snapshot_catalog": """with st as (select strftime(min(ts), '%Y-%m-%d %H%M%S') as stamp
                          from events group by cast(ts as date)),
names as (select 'df_followers_' || stamp || '.csv' as arquivo from st
          union all select 'df_followings_' || stamp || '.csv' from st
          union all select regexp_extract(url, '[^/]*$', 0) from pages)
select arquivo, strptime(substr(arquivo, 14, 17), '%Y-%m-%d %H%M%S') as snap_ts,
       cast(substr(arquivo, 14, 4) || '-' || substr(arquivo, 19, 2) || '-' || substr(arquivo, 22, 2) as date) as snap_date
from names where arquivo like '%df_followers%'""",

    "q07_page_inventory": """select regexp_extract(url, '^(.*)/([^/]*)$', 1) as pasta,
        regexp_extract(url, '^(.*)/([^/]*)$', 2) as arquivo,
        cast(strlen(html) as double) / 1048576 as tamanho from pages""",

    "q09_replace_table": f"with ppl as ({PPL}) select * from ppl where pk in (select user_id from events)",

    "q10_upsert_last_wins": LAST_PER_KEY.format(where=""),

    "q11_upsert_replace_row": f"""with t as ({LAST_PER_KEY.format(where=f"where ts < timestamp '{SPLIT_TS}'")}),
b as ({LAST_PER_KEY.format(where=f"where ts >= timestamp '{SPLIT_TS}'")})
select * from t where not exists (select 1 from b where b.user_id = t.user_id and b.event_type = t.event_type)
union all
select event_id, ts, user_id, event_type, value, cast(null as varchar) as props from b""",

    "q12_insert_ignore": f"""with e as (select e.user_id as pk, p.username, e.ts as follow_time, e.event_id
           from events e left join ({PPL}) p on e.user_id = p.pk)
select pk, username, follow_time, cast(null as integer) as welcome from (
  select *, row_number() over (partition by pk order by follow_time, event_id) as rn from e) x
where rn = 1""",

    "q13_apply_snapshot": f"""{HIST_PREV},
o as (select * from hist where data_saida is null)
select * from hist where data_saida is not null
union all
select coalesce(o.pk, t.pk) as pk,
  case when t.pk is not null then t.username else o.username end as username,
  case when t.pk is not null then t.full_name else o.full_name end as full_name,
  case when o.pk is not null then o.data_entrada else (select d from last) end as data_entrada,
  case when t.pk is not null then null else (select d from last) end as data_saida,
  case when t.pk is not null then (select d from last) else o.data_update end as data_update,
  o.welcome as welcome
from o full outer join t on o.pk = t.pk""",

    "q14_welcome_candidates": f"{HIST_ALL}, {CAND.format(hist='hist')} select username, convites from cand",

    "q15_replay_history": f"{HIST_ALL} select * from hist",

    "q16_mark_welcomed": f"""with {RESULTS}
select p.pk, p.username, case when a.username is not null then 1 end as welcome
from ({PPL}) p left join (select distinct username from acc where username is not null) a
  on p.username = a.username""",

    "q17_no_interaction": NO_INTERACTION,

    "q18_posts_since": f"""select cast(o_orderkey as varchar) as post_id, o_orderdate as criado_em_post
        from orders where o_orderdate >= timestamp '{POSTS_AS_OF}' - interval {CUTOFF_DAYS} day""",

    "q19_present_in": f"""{HIST_PREV}
select * from hist h where data_saida is null and exists (select 1 from t where t.pk = h.pk)""",

    "q20_exclude_protected": f"""select * from ({NO_INTERACTION}) q
where username not in (select c_name from customer where c_mktsegment = '{PROTECTED_SEGMENT}')""",

    "q21_counts": f"""{HIST_ALL}
select 'customer' as metric, cast(count(*) as double) as value from customer
union all select 'orders', cast(count(*) as double) from orders
union all select 'lineitem', cast(count(*) as double) from lineitem
union all select 'events', cast(count(*) as double) from events
union all select 'unwelcomed', cast(count(*) as double) from hist where welcome is null
union all select 'posts_to_process', cast(count(*) as double) from ({POSTS_SINCE}) p
union all select 'estimated_minutes', count(*) * 2.5 / 60.0 from ({POSTS_SINCE}) p""",

    "q22_preview": """(select 'head' as part, o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey limit 10)
union all
(select 'tail' as part, o_orderkey, o_custkey, o_totalprice from orders order by o_orderkey desc limit 10)""",

    "q23_last_per_name": """select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from (
  select *, row_number() over (partition by p_name order by p_partkey desc) as rn from part) x where rn = 1""",

    "q24_accepted_prefix": f"with {RESULTS} select run_id, seq, username, status from acc",

    "q25_local_time": """select event_id, timezone('America/Sao_Paulo', timezone('UTC', ts)) as ts_local,
        cast(isodow(ts) - 1 as integer) as weekday from events""",

    "q27_key_violations": "select p_name, count(*) as n from part group by p_name having count(*) > 1",

    "q26_outbox": f"""{HIST_ALL}, {CAND.format(hist='hist')}
select username, replace({_sql_text(WELCOME_TEMPLATE)}, '{{}}', convites) as message from cand""",

    "q28_page_inventory_csv": """select nullif(regexp_extract(url, '^(.*)/([^/]*)$', 1), '') as pasta,
        nullif(regexp_extract(url, '^(.*)/([^/]*)$', 2), '') as arquivo,
        cast(strlen(html) as double) / 1048576 as tamanho from pages""",

    "q32_page_count": "select count(*) as files from pages",

    "q34_id_rejects": f"""with e as (select event_type, case when event_id % 50 = 0 then cast(user_id as varchar) || '.0'
    when event_id % 77 = 0 then 'x' || cast(user_id as varchar) else cast(user_id as varchar) end as id
  from events where event_type in ('click', 'view')),
f as (select pk, case when pk % 40 = 3 then '#' || cast(pk as varchar) else cast(pk as varchar) end as id from ({PPL}) p),
r as (select 'inactive' as kind, id from f where id not like '#%'
        and id not in (select id from e where regexp_full_match(id, '[0-9]+'))
      union all select 'following', id from f where id like '#%'
      union all select event_type, id from e where not regexp_full_match(id, '[0-9]+'))
select kind, id, count(*) as n from r group by kind, id""",

    "q35_no_interaction_chain": f"""with posts as (select o_orderkey from orders
  where timezone('America/Sao_Paulo', timezone('UTC', cast(o_orderdate as timestamp)))
        >= timestamp '{POSTS_AS_OF}' - interval {CUTOFF_DAYS} day)
select * from ({PPL}) p
where not exists (select 1 from lineitem l where l.l_suppkey = p.pk and l.l_orderkey in (select o_orderkey from posts))
  and not exists (select 1 from conversations c where c.conv_id = p.pk and c.conv_id in (select o_orderkey from posts))
  and username not in (select c_name from customer where c_mktsegment = '{PROTECTED_SEGMENT}')""",

    "q36_welcome_loop": f"""{HIST_ALL}, {CAND.format(hist='hist')},
cut as (select pk % 7 as run, min(pk) as c from cand where pk % 50 = 0 group by 1),
acc as (select cand.pk from cand left join cut on cand.pk % 7 = cut.run where cut.c is null or cand.pk < cut.c),
hist2 as (select * replace (case when data_saida is null and pk in (select pk from acc) then 1 end as welcome) from hist),
cand2 as (select username, convites, pk from (
  select username, coalesce(full_name, username) as convites, pk,
         row_number() over (partition by username order by data_entrada desc, pk desc) as rn
  from hist2 where welcome is null and data_saida is null) x where rn = 1)
select * from cand2""",

    "q37_zoned_local_time": f"""with z as (select event_id, make_timestamptz(cast((case when event_id % 2 = 0 then {REPEATED_HOUR}
    else {SKIPPED_HOUR} end + event_id % 600 * 60) * 1000000 + event_id % 1000 as bigint)) as moment from events)
select event_id, timezone('UTC', moment) as utc, timezone('America/Sao_Paulo', moment) as local,
  cast(isodow(timezone('UTC', moment)) - 1 as integer) as weekday from z""",

    "q38_upsert_posts": f"""with p as ({POSTS_SQL}) select * replace (
  case when cast(post_id as bigint) % 3 = 0 then like_count + 1 else like_count end as like_count,
  case when cast(post_id as bigint) % 3 = 0 then null else view_count end as view_count) from p""",

    "q39_upsert_likes": f"""with l as ({LIKES_SQL}),
one as (select * exclude (rn) from (select *, row_number() over (partition by post_pk, follower_pk
  order by is_private desc, stories desc) as rn from l) x where rn = 1)
select post_pk, follower_pk, case when post_pk in (select cast(o_orderkey as varchar) from ({POSTS_SINCE}) s)
  then true else is_private end as is_private,
  case when post_pk in (select cast(o_orderkey as varchar) from ({POSTS_SINCE}) s)
  then (select max(l.stories) from l where l.post_pk = one.post_pk and l.follower_pk = one.follower_pk) else stories end as stories
from one""",

    "q40_upsert_comments": f"""select * exclude (rn) from (select *, row_number() over (partition by comment_pk
  order by created_at desc, post_pk desc) as rn from ({COMMENTS_SQL}) c) x where rn = 1""",
}

ORACLE["q29_raw_dump"] = ORACLE["q02_caption_parse"]
ORACLE["q30_snapshot_files_stream"] = ORACLE["q15_replay_history"]
ORACLE["q33_daily_apply_store"] = ORACLE["q15_replay_history"]
ORACLE["q41_late_snapshots"] = ORACLE["q15_replay_history"]
ORACLE["q42_split_csv"] = "select doc_id, nullif(text, '') as text, lang, source, n_chars from documents"
ORACLE["q43_stored_posts"] = ORACLE["q38_upsert_posts"]
ORACLE["q44_stored_likes"] = ORACLE["q39_upsert_likes"]
ORACLE["q45_stored_comments"] = ORACLE["q40_upsert_comments"]
ORACLE["q46_load_tables"] = f"""{HIST_ALL}, ppl as ({PPL})
select 'followers' as table_name, count(*) as n, count(distinct (pk, data_entrada)) as n_keys, 0 as refused from hist
union all select 'new_followers', count(distinct user_id), count(distinct user_id), 1 from events
union all select 'followings', count(*), count(distinct pk), 1 from ppl where pk in (select user_id from events)
union all select 'posts', count(*), count(distinct doc_id), 1 from documents
union all select 'likes', count(distinct (l_orderkey, l_suppkey)), count(distinct (l_orderkey, l_suppkey)), 0 from lineitem
union all select 'comments', count(distinct turn), count(distinct turn), 0 from conversations
union all select 'invites', count(*), count(distinct username), 1 from ppl"""
ORACLE["q47_raw_variant"] = f"""select cast(doc_id as varchar) as post_id, case when doc_id % 2 = 0 then n_chars end as extra_n,
  case when doc_id % 2 = 0 then length({CAPTION}) end as extra_chars, true as unchanged,
  case when doc_id % 5 <> 0 then n_chars * 3 end as view_count, n_chars as like_count,
  cast(isodow(timezone('UTC', to_timestamp({POST_EPOCH} + doc_id * {POST_STEP}))) - 1 as integer) as dia_semana_post from documents"""
ORACLE["q48_inventory_order"] = """select row_number() over (order by regexp_extract(url, '^(.*)/([^/]*)$', 1), regexp_extract(url, '^(.*)/([^/]*)$', 2)) - 1 as position,
  nullif(regexp_extract(url, '^(.*)/([^/]*)$', 1), '') as pasta, nullif(regexp_extract(url, '^(.*)/([^/]*)$', 2), '') as arquivo from pages"""
ORACLE["q49_checked_ids"] = """select event_type as kind, count(*) filter (event_id % 50 <> 0 and event_id % 77 <> 0) as n_good,
  count(distinct user_id) filter (event_id % 50 <> 0 and event_id % 77 <> 0) as ids,
  count(*) filter (event_id % 50 = 0 or event_id % 77 = 0) as rejected,
  count(distinct case when event_id % 50 = 0 then user_id::varchar || '.0' else 'x' || user_id::varchar end) filter (event_id % 50 = 0 or event_id % 77 = 0) as rejected_ids
  from events where event_type in ('click', 'view') group by event_type"""
