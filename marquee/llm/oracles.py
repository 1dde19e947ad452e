"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from marquee.llm.urlfilter import PATTERN_RULES

_PATTERNS = " or ".join(f"regexp_matches(rest, '{r.regex()}')" for r in PATTERN_RULES)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

COLLOCATIONS = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(regexp_split_to_array(translate(text, '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents where text is not null),
worded as (
  select lang, list_filter(string_split(replace(piece, chr(9), ' '), ' '), lambda x: x <> '') as w from pieces),
placed as (
  select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from worded, (values (1), (2), (3), (4)) as lengths(k)),
phrases as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as f from placed group by all),
sizes as (select lang, sum(f)::bigint as n from phrases where k = 1 group by lang),
candidates as (select lang, k, phrase, f, string_split(phrase, ' ') as w from phrases where k > 1 and f >= 30),
cuts as (select *, unnest(range(1, k)) as j from candidates),
scored as (
  select c.lang, c.phrase, c.f as a, x.f as l, y.f as r, c.j, 2000000::hugeint * c.f // (x.f::hugeint + y.f) as score
  from cuts c join phrases x on x.lang = c.lang and x.phrase = array_to_string(c.w[:c.j], ' ')
              join phrases y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.j + 1:], ' ')),
best as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, j) = 1),
parts as (
  select lang, k, f, m, i, array_to_string(w[i:i + m - 1], ' ') as phrase
  from (select *, unnest(range(1, k - m + 2)) as i from (select *, unnest(range(2, k)) as m from candidates))),
around as (
  select lang, phrase, max(f) as f, count(*) filter (m = k - 1 and i = 2) as n_left, count(*) filter (m = k - 1 and i = 1) as n_right
  from parts group by lang, phrase),
kept as (
  select b.*, coalesce(n_left, 0) as n_left, coalesce(n_right, 0) as n_right
  from best b left join around o on o.lang = b.lang and o.phrase = b.phrase
  where o.f is null or 100::hugeint * o.f < 80::hugeint * b.a)
select k.lang, row_number() over (partition by k.lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n,
       score::bigint as score, n_left, n_right
from kept k join sizes s on s.lang = k.lang
qualify rank <= 2000
"""

ORACLES = {
    "op13_collocations": COLLOCATIONS,
    # Host rules by string functions; a rule fits its host and that host's subdomains.
    "op9_url_filter": f"""
with cut as (
  select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as tail from pages),
parts as (
  select page_id, translate(tail, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as rest,
         translate(regexp_extract(tail, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) as path from cut),
rules(verdict, rhost, rpath) as (
  values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits as (
  select page_id, arg_max(rhost || rpath, length(rhost || rpath)) as rule, arg_max(verdict, length(rhost || rpath)) as verdict
  from parts, rules
  where (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by page_id)
select page_id, host, path, rule,
       coalesce(fits.verdict, case when {_PATTERNS} then 'block' else 'allow' end) as verdict
from parts left join fits using (page_id)""",
}
