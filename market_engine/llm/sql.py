"""DuckDB counterparts of the registered queries, written against the raw tables."""

from __future__ import annotations

from market_engine.llm.quality_rules import STOP_WORDS

_STOP = ", ".join("'" + w + "'" for w in sorted({w for words in STOP_WORDS.values() for w in words.split()}))

OP4 = rf"""
with w as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls
  from documents),
grams as (
  select doc_id, i, list_slice(ws, i, i + 7) as g
  from w, unnest(range(1, greatest(len(ws) - 6, 1))) as r(i)),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as c from grams) where c > 1),
rep as (
  select doc_id, count(distinct i + k)::bigint as n from twice, unnest(range(0, 8)) as r(k) group by doc_id),
m as (
  select w.doc_id, len(ws)::bigint as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
    len(list_filter(ws, lambda x: x in ({_STOP})))::bigint as n_stop,
    len(ls)::bigint as n_lines, (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
    coalesce(rep.n, 0)::bigint as n_repeat_words
  from w left join rep using (doc_id)),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed
    and not (n_words >= 20 and (word_chars / n_words < 2 or word_chars / n_words > 12))
    and not (word_chars > 0 and n_symbols / word_chars > 0.2)
    and not (n_words >= 50 and n_stop / n_words < 0.01)
    and not (n_lines > 0 and n_dup_lines / n_lines > 0.5) as kept
from b"""


def _level(groups: str, n: str, k: str, mean: str) -> str:
    """Moment estimate of a prior's pages, as ``url_reputation._strength``."""
    return f"""
  select greatest(2.0, least(1000.0, case when rho > 0 then (1 - rho) / rho else 1000.0 end)) as m from (
    select case when v > 0 and free > 0 then (s - v * (g - 1)) / (v * free) end as rho from (
      select s, g, k / n * (1 - k / n) as v, n - n2 / n - (g - 1) as free from (
        select sum({n} * ({k} / {n} - {mean}) * ({k} / {n} - {mean})) as s, sum({n})::double as n, sum({n} * {n})::double as n2,
          count(*)::double as g, sum({k})::double as k from {groups} where {n} > 0)))"""


OP2 = rf"""
with lab as (
  select doc_id, max(case when coalesce(quality, 1) = 0 or coalesce(toxic, 0) = 1 then 1 else 0 end) as bad
  from labels where doc_id is not null group by doc_id),
p as (
  select page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path from pages),
h as (
  select host, array_to_string(string_split(host, '.')[-2:], '.') as domain, string_split(host, '.')[-1] as suffix,
    count(bad)::double as n, coalesce(sum(bad), 0)::double as k
  from p left join lab on p.page_id = lab.doc_id group by host),
d as (select domain, suffix, sum(n) as dn, sum(k) as dk from h group by domain, suffix),
s as (select suffix, sum(dn) as sn, sum(dk) as sk from d group by suffix),
s0 as (select s.*, (select case when sum(sn) > 0 then sum(sk) / sum(sn) else 0.0 end from s) as rate from s),
sm as ({_level("s0", "sn", "sk", "rate")}),
s1 as (select suffix, (sk + m * rate) / (sn + m) as s_mean from s0, sm),
d0 as (select * from d join s1 using (suffix)),
dm as ({_level("d0", "dn", "dk", "s_mean")}),
d1 as (select domain, suffix, (dk + m * s_mean) / (dn + m) as d_mean from d0, dm),
h0 as (select * from h join d1 using (domain, suffix)),
hm as ({_level("h0", "n", "k", "d_mean")}),
post as (select host, m * d_mean + k as a, m * (1 - d_mean) + n - k as b from h0, hm),
rep as (select host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) as low from post),
rules(rule, ruled, rhost, rpath) as (values ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
  ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')),
best as (
  select page_id, host, path, arg_max(rule, length(rule)) as rule, arg_max(ruled, length(rule)) as ruled
  from (select distinct page_id, host, path from p) x, rules
  where (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by all)
select p.page_id, p.host, p.path, best.rule,
  coalesce(best.ruled, case when rep.low > 0.5 then 'block' else 'allow' end) as verdict
from p left join best on p.page_id is not distinct from best.page_id and p.host = best.host and p.path = best.path
left join rep on p.host = rep.host"""

OP10 = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
l as (
  select *, 12 + 1 + 11 + length(replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&#10;'))
      + length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|')) as chars,
    row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
    count(*) over (partition by conv_id) as n
  from c),
cum as (select *, sum(chars) over (partition by conv_id order by i) as upto from l)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
  length(coalesce(string_agg(case when role = 'assistant' then text end, '' order by i), ''))::bigint as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by i), '')) as loss_sha256,
  sum(case when role = 'assistant' or i = n then upto else 0 end)::bigint as formatted_chars
from cum group by conv_id"""


def _digest(*parts: str) -> str:
    """``rendezvous.key_digest``: 52 leading bits of an md5."""
    return "('0x' || substr(md5(" + " || ':' || ".join(parts) + "), 1, 13))::bigint"


_KEY = "coalesce(doc_id::varchar, '')"
OP5 = rf"""
with crc as (
  select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as t),
d as (
  select doc_id, octet_length(encode(coalesce(text, '')))::bigint + 8 as size,
    xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
      lambda x: ('0x' || x)::bigint), lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]), 4294967295::bigint)) as text_crc32
  from documents, crc),
s as (
  select *, list_transform(range(25), lambda j: {_digest(_KEY, "j::varchar")}) as h from d),
a as (
  select doc_id, size, text_crc32, list_position(h[:24], list_max(h[:24])) - 1 as shard, h[25] > list_max(h[:24]) as moves,
    {_digest(_KEY, "text_crc32::varchar")} as rank
  from s)
select doc_id, size, text_crc32, 'key' as law, shard::int as shard,
  row_number() over (partition by shard order by rank, doc_id, size, text_crc32) - 1 as slot,
  case when moves then 24 else shard end::int as grown_shard
from a"""


_WORDS6 = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP6 = rf"""
with d as (select doc_id, {_WORDS6} as ws from documents),
b as (select item_id, ws, least(10, len(ws)) as size from (select item_id, {_WORDS6} as ws from benchmark) x where len(ws) > 0),
bw as (
  select distinct item_id, size, array_to_string(list_slice(ws, s, s + size - 1), ' ') as win
  from b, unnest(range(1, len(ws) - size + 2)) as r(s)),
sizes as (select distinct size from bw),
dw as (
  select doc_id, size, s, array_to_string(list_slice(ws, s, s + size - 1), ' ') as win
  from d, sizes, unnest(range(1, greatest(len(ws) - size + 2, 1))) as r(s)),
hit as (select doc_id, s, dw.size, item_id from dw join bw on dw.size = bw.size and dw.win = bw.win),
words as (select doc_id, count(distinct s + k)::bigint as n_hit from hit, unnest(range(0, size)) as r(k) group by doc_id),
items as (
  select doc_id, count(*)::bigint as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids
  from (select distinct doc_id, item_id from hit) group by doc_id)
select d.doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from d left join words using (doc_id) left join items using (doc_id)"""


OP1 = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
w as (
  select doc_id, s, md5(array_to_string(list_slice(ws, s, s + 49), ' ')) as win
  from d, unnest(range(1, greatest(len(ws) - 48, 1))) as r(s)),
rep as (select doc_id, s from (select doc_id, s, min(doc_id) over (partition by win) as o from w) x where o < doc_id),
gone as (select doc_id, list(distinct s + k) as g, count(distinct s + k)::bigint as n from rep, unnest(range(0, 50)) as r(k) group by doc_id),
kept as (
  select d.doc_id, string_agg(ws[i], ' ' order by i) as t
  from d left join gone using (doc_id), unnest(range(1, len(ws) + 1)) as r(i)
  where not coalesce(list_contains(g, i), false) group by d.doc_id)
select d.doc_id, len(ws)::bigint as n_words, coalesce(gone.n, 0)::bigint as n_removed, sha256(coalesce(kept.t, '')) as kept_sha256
from d left join gone using (doc_id) left join kept using (doc_id)"""


OP7 = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as ws from documents),
sh as (
  select distinct doc_id, array_to_string(list_slice(ws, s, s + 2), ' ') as g
  from d, unnest(range(1, greatest(len(ws) - 2, least(len(ws), 1)) + 1)) as r(s)),
n as (select doc_id, count(*) as n from sh group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from sh a join sh b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 90 * (x.n + y.n - c)),
reach(a, b) as (select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) as component_id
from d left join n using (doc_id) left join (select a, min(b) as b from reach group by a) m on m.a = d.doc_id"""


OP13 = r"""
with crc as (
  select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as t),
own as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
    partition by conv_id order by turn nulls first,
      sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, ''))) as i
  from conversations where conv_id is not null),
conv as (
  select conv_id, xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(conv_id::varchar)), '..'),
      lambda x: ('0x' || x)::bigint), lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)]), 4294967295::bigint)) % 6 as h
  from (select distinct conv_id from own) x, crc),
grown as (
  select conv.conv_id, 0 as late, i, role, text from conv join own on own.conv_id = conv.conv_id - conv.conv_id % 100 where i <= h
  union all select conv.conv_id, 1, i, role, text from conv join own on own.conv_id = conv.conv_id where i > h),
turns as (select conv_id, row_number() over w as d, length(text) as size, string_agg(
    length(role)::varchar || ':' || length(text)::varchar || ':' || role || text, '') over w as p
  from grown window w as (partition by conv_id order by late, i rows unbounded preceding)),
m as (select conv_id, d, size, p from turns union all select conv_id, 0, 0, '' from conv),
node as (select d, p, min(conv_id) as c, count(*) as n, max(size) as size from m group by d, p),
mm as (select m.conv_id, m.d, node.c from m join node on m.d = node.d and m.p = node.p),
above as (select node.d, node.c, mm.c as parent from node join mm on mm.conv_id = node.c and mm.d = node.d - 1),
kids as (select d - 1 as d, parent as c, count(*) as n_children from above group by all),
full_node as (
  select node.*, above.parent, coalesce(n_children, 0) as n_children from node
  left join above using (d, c) left join kids using (d, c)),
sums as (
  select mm.d, mm.c, sum(case when n_children = 0 then 1 else 0 end)::bigint as n_leaves, sum((n - 1) * size)::bigint as saved
  from full_node f join mm on mm.conv_id = f.c and mm.d <= f.d group by mm.d, mm.c),
last_turn as (select conv_id, max(d) as d from m group by conv_id),
ends as (
  select mm.d, mm.c, string_agg(conv_id::varchar, ',' order by conv_id) as ids from mm join last_turn using (conv_id, d) group by mm.d, mm.c)
select f.c as conv_id, f.d::bigint as depth, f.parent as parent_conv_id, f.n::bigint as n_convs, f.n_children::bigint as n_children,
  n_leaves, saved as saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
from full_node f join sums using (d, c) left join ends using (d, c)"""


_TERMS11 = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11 = rf"""
with d as (select doc_id, ts, len(ts)::bigint as n from (select doc_id, {_TERMS11} as ts from documents) x where len(ts) > 0),
c as (select count(*)::bigint as docs, sum(n)::bigint as total from d),
tf as (select doc_id, term, count(*)::bigint as tf from (select doc_id, unnest(ts) as term from d) x group by doc_id, term),
w as (select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w from tf, c group by term, docs),
q as (select distinct item_id, unnest({_TERMS11}) as term from benchmark),
s as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::bigint as score
  from q join w using (term) join tf using (term) join d using (doc_id), c group by item_id, doc_id),
r as (select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score from s where score > 0)
select * from r where rank <= 10"""
