"""DuckDB oracles: for each registered query, plain SQL over the same parquet
tables (views ``documents``, ``orders``, ``part`` ...). Written independently
of the Spark code: bindings, then the operator's rule in SQL.

DuckDB's regex is RE2: no look-around, ASCII ``\\s``/``\\w``, and
``regexp_replace`` replaces the first match unless given ``'g'``.
"""

from __future__ import annotations

# Python's str.strip() white space (as far as Java's Unicode \s goes).
WS = r"[\t\n\x{0B}\f\r \x{85}\p{Z}]"


def trim_ws(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


W = r"\p{L}\p{N}_"
POLISH_RE = (
    "[ąćęłńśźż]"
    f"|(^|[^{W}])(programista|starszy|specjalista|kierownik|analityk|architekt|konsultant|serwisant"
    "|doradca|praktykant|praca|zdalna|hybrydowa|stacjonarna|zespołu|asystent|ekspert|referent"
    f"|koordynator)($|[^{W}])"
    f"|(^|[^{W}])ds\\.[{W}]"
)


def is_polish(x: str) -> str:
    return f"regexp_matches(lower({x}), '{POLISH_RE}')"


OFFERS = """offers as (
  select 2 * (1099511627776 - (ascii(coalesce(lang, '')) * 65536 + ascii(substring(coalesce(lang, ''), 2, 1))))
      + coalesce(cast(substring(source, 4) as int), 0) % 2 as group_idx,
    lang as group_title, cast(substring(source, 4) as int) as url_idx, doc_id as pos,
    concat('https://x.example/o/', cast((doc_id * 7919) % 800 as varchar)) as full_url,
    case doc_id % 10 when 0 then concat(text, ' programista')
      when 1 then concat('ds. ', text)
      when 2 then concat('Kraków ', text)
      when 3 then concat('inżynier ', text)
      else text end as title,
    lang as company, '' as tags
  from documents)"""

SHEETS = """sheets as (
  select case when o_orderkey % 23 = 0 then 'Trash' else o_orderpriority end as sheet,
    o_orderkey as pos,
    case when o_orderkey % 4 = 1 then concat('=HYPERLINK("https://h.example/', cast(o_orderkey as varchar),
      '?q=1","Order ', cast(o_custkey as varchar), '")')
      else concat('Order ', cast(o_custkey as varchar)) end as title,
    o_orderstatus as company, '' as tags,
    case o_orderkey % 9 when 0 then 'DISCARD' when 1 then ' out ' when 2 then 'CVSENT' when 3 then 'saved'
      when 4 then 'about' when 5 then '' when 6 then null when 7 then 'save, cvsent' else 'NEW' end as status,
    case o_orderkey % 4 when 0 then concat('https://r.example/', cast(o_custkey as varchar), '?ref=x')
      when 1 then '' when 2 then concat(' https://r.example/', cast(o_custkey as varchar), ' ')
      else 'http no link' end as link
  from orders)"""

RAW = SHEETS + """,
raw0 as (
  select sheet, pos,
    case sheet when '2-HIGH' then ['Title','Salary','Company','Location','Tags','Age','Status','Full URL']
      when '3-MEDIUM' then ['Company','Title','Tags','Link','Status','Link']
      when '4-NOT SPECIFIED' then ['Title','Company','Tags','Link']
      when '5-LOW' then ['Name','Company','Tags','Status','Link']
      else ['Title','Company','Tags','Status','Link'] end as header,
    case sheet when '2-HIGH' then [title, '10 EUR', company, 'Krakow', tags, '3d left', coalesce(status, ''), link]
      when '3-MEDIUM' then [company, title, tags, link, coalesce(status, ''), '']
      when '4-NOT SPECIFIED' then [title, company, tags, link]
      else [title, company, tags, coalesce(status, ''), link] end as cells
  from sheets),
raw as (select sheet, pos, header, case when pos % 13 = 0 then cells[1:2] else cells end as cells from raw0)"""

AGES = """ages as (
  select event_id, case event_id % 6 when 0 then 'New'
    when 1 then concat(cast(event_id % 31 as varchar), 'd left')
    when 2 then 'Unknown' when 3 then '1w ago' when 4 then 'time left' else null end as posted_age
  from events)"""


def known_urls_from(cells_cte: str) -> str:
    """D1 over a CTE of (sheet, cell)."""
    t = trim_ws("cell")
    return f"""select distinct sheet, unnest(case when contains(cell, 'HYPERLINK')
      then list_filter(string_split(cell, '"'), lambda p: contains(p, 'http'))
      else [split_part({t}, '?', 1)] end) as url
    from {cells_cte}
    where contains(cell, 'http') and (contains(cell, 'HYPERLINK') or contains(cell, '://'))"""


def by_header(raw_cte: str) -> str:
    """S6 over a CTE of (sheet, pos, header, cells): first equal header."""
    def get(name):
        return (f"coalesce(case when list_position(header, '{name}') is null then '' "
                f"else cells[list_position(header, '{name}')] end, '')")
    return (f"select sheet, pos, {get('Title')} as title, {get('Company')} as company, "
            f"{get('Tags')} as tags, {get('Link')} as link from {raw_cte}")


RUN = OFFERS + f""",
marked as (select *, {is_polish('title')} as is_polish from offers),
ledger as (select group_title as sheet, pos,
  case when pos % 2 = 0 then concat('=HYPERLINK("https://h.example/', pos, '?q=1","Offer ', pos, '")') else title end as title,
  company, tags, 'NEW' as status, case when pos % 2 = 0 then '' else full_url end as link
  from marked where pos % 11 = 0 and not is_polish),
feed as (select * from marked where pos % 11 <> 0 and not is_polish),
cands as (select * exclude (rn) from (
  select *, row_number() over (partition by group_idx, url_idx order by pos) as rn from feed)
  where rn <= case when group_title = 'en' then 50 else 30 end),
lcells as (select sheet, unnest([title, company, tags, status, link]) as cell from ledger),
kurls as ({known_urls_from('lcells')}),
krecs as (select {trim_ws('title')} as title, {trim_ws('company')} as company, {trim_ws('tags')} as tags from ledger),
after_url as (select * from cands c where not exists (select 1 from kurls k where k.url = c.full_url)),
fresh as (select * from after_url c where not exists (
  select 1 from krecs k where k.title = c.title and k.company = c.company and k.tags = c.tags))"""


def ordered_fold(src: str, order: str, out: str) -> str:
    """D5 as the plain loop: a recursive CTE over the rank carrying the seen
    URLs and contents; defines CTE ``{out}`` with the kept rows of ``src``."""
    return f"""ranked_{out} as (select row_number() over (order by {order}) as rk_,
    full_url as u_, concat(title, chr(31), company, chr(31), tags) as c_, * from {src}),
fold_{out} as (
  select 0::bigint as rk_, []::varchar[] as su, []::varchar[] as sc, false as keep
  union all
  select r.rk_,
    case when list_contains(f.su, r.u_) or list_contains(f.sc, r.c_) then f.su else list_append(f.su, r.u_) end,
    case when list_contains(f.su, r.u_) or list_contains(f.sc, r.c_) then f.sc else list_append(f.sc, r.c_) end,
    not (list_contains(f.su, r.u_) or list_contains(f.sc, r.c_))
  from fold_{out} f join ranked_{out} r on r.rk_ = f.rk_ + 1),
{out} as (select r.* exclude (rk_, u_, c_) from ranked_{out} r join fold_{out} f using (rk_) where f.keep)"""


def _groups_summary() -> str:
    return "with recursive " + RUN + ",\n" + ordered_fold("fresh", "group_idx, url_idx, pos", "kept") + """,
grp as (select distinct group_idx, group_title from offers),
summary as (
  select g.group_idx, g.group_title,
    cast(coalesce((select count(*) from kept k where k.group_idx = g.group_idx), 0) as bigint) as new_offers,
    cast(coalesce((select count(*) from cands c where c.group_idx = g.group_idx), 0) as bigint) as total_candidates
  from grp g)
"""


ORACLES: dict[str, str] = {}

ORACLES["polish_filter"] = f"with {OFFERS} select pos, group_title, title from offers where not {is_polish('title')}"

ORACLES["recent_filter"] = f"""with {AGES}, a as (
  select *, lower(coalesce(posted_age, '')) as s, regexp_extract(lower(coalesce(posted_age, '')), '([0-9]+)d', 1) as d
  from ages)
select event_id, posted_age from a
where case when contains(s, 'new') then true
  when contains(s, 'left') and d <> '' then 30 - cast(d as hugeint) <= 10 else true end"""

ORACLES["topn_per_url"] = f"with {RUN} select group_idx, group_title, url_idx, pos from cands"

ORACLES["dedup_url"] = f"""with {RUN} select group_title, url_idx, pos, full_url from feed c
where not exists (select 1 from kurls k where k.url = c.full_url)"""

ORACLES["dedup_content"] = f"""with {RUN} select group_title, url_idx, pos, title from feed c
where not exists (select 1 from krecs k where k.title = c.title and k.company = c.company and k.tags = c.tags)"""

ORACLES["dedup_ordered"] = "with recursive d as (select doc_id, concat('https://x.example/o/', " \
    "cast((doc_id * 7919) % 800 as varchar)) as full_url, text as title, " \
    "lang as company, '' as tags from documents),\n" + ordered_fold("d", "doc_id", "kept") + \
    "\nselect doc_id, full_url from kept"

ORACLES["full_run_summary"] = _groups_summary() + \
    "select group_idx, group_title, new_offers, total_candidates, total_candidates - new_offers as skipped from summary"

ORACLES["run_total"] = _groups_summary() + """select cast(coalesce(sum(new_offers), 0) as bigint) as total_new,
  cast(coalesce(sum(total_candidates), 0) as bigint) as total_candidates, cast(count(*) as bigint) as groups
from summary"""

ORACLES["url_counts"] = f"""with {OFFERS} select group_idx, group_title, url_idx, cast(count(*) as bigint) as raw_count,
  cast(count(*) filter (where {is_polish('title')}) as bigint) as polish_dropped
from offers group by group_idx, group_title, url_idx"""

ORACLES["known_urls"] = f"""with {SHEETS},
cells as (select sheet, unnest([title, company, tags, status, link]) as cell from sheets),
u as ({known_urls_from('cells')})
select distinct url from u"""

ORACLES["known_urls_raw"] = f"""with {RAW},
cells as (select sheet, unnest(cells) as cell from raw),
u as ({known_urls_from('cells')})
select distinct url from u"""

ORACLES["known_records"] = f"""with {RAW}, h as ({by_header('raw')})
select {trim_ws('title')} as title, {trim_ws('company')} as company, {trim_ws('tags')} as tags,
  {trim_ws('link')} as link from h"""

ORACLES["known_url_counts"] = f"""with {SHEETS},
cells as (select sheet, unnest([title, company, tags, status, link]) as cell from sheets),
u as ({known_urls_from('cells')})
select sheet, cast(count(*) as bigint) as n_urls from u group by sheet
union all
select '*' as sheet, cast(count(distinct url) as bigint) as n_urls from u"""

ORACLES["known_record_count"] = f"with {SHEETS} select cast(count(*) as bigint) as n_records from sheets"


# --------------------------------------------------------------------------
# Ledger

def norm_status(x: str) -> str:
    return f"upper({trim_ws(x)})"


def bucket(x: str) -> str:
    s = f"coalesce({norm_status(x)}, '')"
    return (f"(case when contains({s}, 'CVSENT') then 0 when contains({s}, 'SAVE') then 1 "
            f"when contains({s}, 'OUT') then 3 else 2 end)")


DISCARDS = SHEETS + f""",
flag as (select *, sheet <> 'Trash' and coalesce({norm_status('status')} in ('DISCARD', 'OUT'), false) as mv
  from sheets),
kept as (select * exclude (mv) from flag where not mv),
moved as (select * exclude (mv) from flag where mv),
after as (
  select * from kept
  union all
  select 'Trash' as sheet,
    (select coalesce(max(pos), 0) from kept where sheet = 'Trash') + row_number() over (order by sheet, pos) as pos,
    title, company, tags, status, link
  from moved),
targets as (select sheet from moved union select 'Trash'),
organized as (
  select sheet, row_number() over (partition by sheet order by {bucket('status')}, pos) as pos,
    title, company, tags, status, link
  from after where sheet in (select sheet from targets)
  union all
  select * from after where sheet not in (select sheet from targets))"""

ORACLES["ledger_scan"] = f"with {SHEETS} select * from sheets"

ORACLES["ledger_by_header"] = f"with {RAW} {by_header('raw')}"

ORACLES["discard_keep"] = f"with {DISCARDS} select sheet, pos, title, status from kept"

ORACLES["discard_moved"] = f"with {DISCARDS} select sheet, pos, title, status from moved"

ORACLES["trash_after"] = f"with {DISCARDS} select pos, title, status, link from after where sheet = 'Trash'"

ORACLES["status_bucket"] = f"with {SHEETS} select sheet, pos, status, cast({bucket('status')} as int) as bucket from sheets"

ORACLES["status_order"] = f"""with {SHEETS} select sheet,
  row_number() over (partition by sheet order by {bucket('status')}, pos) as pos, title, status, link from sheets"""

ORACLES["organize_only"] = f"with {DISCARDS} select sheet, pos, title, company, status, link from organized"

ORACLES["bucket_ranges"] = f"""with {DISCARDS}, b as (select *, {bucket('status')} as bucket from organized)
select sheet, cast(bucket as int) as bucket, cast(min(pos) + 1 as bigint) as first_row,
  cast(max(pos) + 1 as bigint) as last_row, cast(count(*) as bigint) as n_rows,
  (['green', 'yellow', 'white', 'red'])[bucket + 1] as label
from b group by sheet, bucket"""

ORACLES["ledger_counts"] = f"with {DISCARDS} select sheet, cast(count(*) as bigint) as n_moved from moved group by sheet"


def _last(name: str) -> str:
    # 1-based index of the last equal header, 0 when absent
    return (f"coalesce(len(header) + 1 - list_position(list_reverse(header), '{name}'), 0)")


def _get(name: str) -> str:
    i = _last(name)
    return f"(case when {i} > 0 then coalesce(cells[{i}], '') else '' end)"


ORACLES["migrate_rows"] = f"""with {RAW},
t as (select *, case when {_last('Title')} = 0 and len(cells) > 0 then cells[1] else {_get('Title')} end as title_raw
  from raw),
p as (select *, string_split(title_raw, '"') as pieces,
  contains(title_raw, '=HYPERLINK') and len(string_split(title_raw, '"')) >= 4 as is_f from t),
m as (select sheet, pos,
  case when is_f then pieces[4] else title_raw end as title,
  {_get('Company')} as company, {_get('Tags')} as tags, {_get('Status')} as status,
  case when is_f then pieces[2] else {_get('Link')} end as link0,
  {_get('Full URL')} as full_url from p)
select sheet, pos, title, company, tags, status, case when link0 = '' then full_url else link0 end as link from m"""

# L10 for a canonical row, where ``mig`` holds: the formula's pieces
MIGRATED = """case when mig then string_split(title, '"')[4] else title end as title, status,
    case when mig then string_split(title, '"')[2] else link end as link,"""

_RUN_KEPT = "with recursive " + RUN + ",\n" + ordered_fold("fresh", "group_idx, url_idx, pos", "kept")

ORACLES["to_ledger_row"] = _RUN_KEPT + """
select group_title as sheet, title, coalesce(company, '') as company, coalesce(tags, '') as tags,
  'NEW' as status, coalesce(full_url, '') as link from kept"""

ORACLES["ledger_prepend"] = _RUN_KEPT + f""",
both_ as (
  select group_title as sheet, title, 'NEW' as status, full_url as link, 0 as is_old, -group_idx as later, url_idx, pos from kept
  union all
  select sheet, {MIGRATED} 1 as is_old, null as later, null as url_idx, pos from (
    select *, contains(title, '=HYPERLINK') and len(string_split(title, '"')) >= 4
      and sheet in (select group_title from kept) as mig from ledger))
select sheet, row_number() over (partition by sheet order by {bucket('status')}, is_old, later, url_idx, pos) as pos,
  title, status, link from both_"""

ORACLES["ledger_append"] = _RUN_KEPT + """
select sheet, pos, title, status, link from ledger
union all
select k.group_title as sheet,
  coalesce((select max(l.pos) from ledger l where l.sheet = k.group_title), 0)
    + row_number() over (partition by k.group_title order by k.group_idx, k.url_idx, k.pos) as pos,
  k.title, 'NEW' as status, k.full_url as link
from kept k"""

ORACLES["prepend_guard"] = _RUN_KEPT + """,
grp as (select distinct group_title as sheet from offers)
select g.sheet,
  cast((select count(*) from kept k where k.group_title = g.sheet) as bigint) as added,
  cast(case when (select count(*) from kept k where k.group_title = g.sheet) > 0
    then (select count(*) from ledger l where l.sheet = g.sheet) else 0 end as bigint) as migrated
from grp g"""

ORACLES["ledger_sheets"] = f"""with {SHEETS},
wanted as (select regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) as sheet from pages union select 'Trash'),
present as (select distinct sheet from sheets)
select coalesce(w.sheet, p.sheet) as sheet, p.sheet is null as created
from wanted w full join present p on w.sheet = p.sheet"""


# --------------------------------------------------------------------------
# URLs, watchlist

URLS = """urls as (
  select page_id, case page_id % 5
    when 0 then concat('https://justjoin.it/job-offers/krakow?keyword=', lang, '+', num, '&sort=newest&orderBy=DESC')
    when 1 then concat('https://www.justjoin.it/job-offers/all-locations/', lang,
      '?experience-level=junior&keyword=&orderBy=DESC')
    when 2 then concat('https://nofluffjobs.com/pl/', lang, '?lang=en&criteria=seniority%3D', num, '&sort=newest')
    when 3 then concat('https://theprotocol.it/filtry/', lang, ';p/krakow;wp?kw=', num)
    else url end as url
  from (select page_id, url, regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) as lang,
    regexp_extract(url, '^https?://[^/]+/[^/?#]+/([^/?#.]*)', 1) as num from pages))"""

WATCH = """watch as (
  select (dense_rank() over (order by lang) - 1) * 1000000000000 + page_id // 100 as group_idx, lang as group_title,
    page_id as url_idx, url, page_id
  from (select page_id, url, regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) as lang from pages)),
readback as (
  select (dense_rank() over (order by group_idx // 50) - 1) * 1000000000000
      + dense_rank() over (partition by group_idx // 50 order by group_idx) - 1 as rb_group,
    row_number() over (partition by group_idx order by page_id) - 1 as rb_url, *
  from watch)"""


def qv(url: str, key: str) -> str:
    """parse_qs(urlparse(url).query).get(key, [''])[0]"""
    q = f"regexp_extract({url}, '^[^?#]*\\?([^#]*)', 1)"
    pairs = f"list_filter(string_split({q}, '&'), lambda p: contains(p, '='))"
    hits = (f"list_filter({pairs}, lambda p: url_decode(replace(split_part(p, '=', 1), '+', ' ')) = '{key}' "
            f"and regexp_replace(p, '^[^=]*=', '') <> '')")
    return f"coalesce(url_decode(replace(regexp_replace(({hits})[1], '^[^=]*=', ''), '+', ' ')), '')"


def derive_title_sql(url: str) -> str:
    netloc = f"regexp_extract({url}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"
    path = f"regexp_replace(regexp_extract({url}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), ';[^/]*$', '')"
    segs = f"string_split({path}, '/')"
    domain = f"split_part(replace({netloc}, 'www.', ''), '.', 1)"
    kw_a, exp_a, crit, kw_c = qv(url, "keyword"), qv(url, "experience-level"), qv(url, "criteria"), qv(url, "kw")
    empty = "[]::varchar[]"
    part_a = (f"list_concat(list_concat(case when list_contains({segs}, 'krakow') then ['krakow'] "
              f"when len({segs}) > 2 then [{segs}[-1]] else {empty} end, "
              f"case when {kw_a} <> '' then ['kw-' || {kw_a}] else {empty} end), "
              f"case when {exp_a} <> '' then ['exp-' || {exp_a}] else {empty} end)")
    part_b = (f"list_concat(list_filter({segs}, lambda s: s <> '' and s not in ('pl', 'job')), "
              f"case when {crit} = '' then {empty} when len(string_split({crit}, '=')) > 1 "
              f"then [string_split({crit}, '=')[2]] else [{crit}] end)")
    part_c = (f"list_concat(list_filter(list_transform(list_filter({segs}, lambda s: s not in ('', 'filtry')), "
              f"lambda s: split_part(s, ';', 1)), lambda s: s <> ''), "
              f"case when {kw_c} <> '' then ['kw-' || {kw_c}] else {empty} end)")
    rest = (f"case when contains({url}, 'justjoin.it') then {part_a} "
            f"when contains({url}, 'nofluffjobs.com') then {part_b} "
            f"when contains({url}, 'theprotocol.it') then {part_c} "
            f"else [replace({path}, '/', '-')] end")
    parts = f"list_filter(list_transform(list_concat([{domain}], {rest}), lambda p: {trim_ws('lower(p)')}), lambda p: p <> '')"
    return (f"substring(regexp_replace(array_to_string(list_filter({parts}, lambda x, i: list_position({parts}, x) = i), '-'), "
            f"'[^{W}\\-]', '', 'g'), 1, 100)")


ORACLES["route_source"] = f"""with {URLS} select page_id, url,
  case when contains(url, 'nofluffjobs.com') then 'B' when contains(url, 'theprotocol.it') then 'C' else 'A' end as source,
  case when contains(url, 'nofluffjobs.com') then 50 when contains(url, 'theprotocol.it') then 30 else 50 end as row_limit
from urls"""

ORACLES["derive_title"] = f"with {URLS} select page_id, url, {derive_title_sql('url')} as title from urls"

ORACLES["url_param"] = f"""with {URLS} select page_id, {qv('url', 'keyword')} as keyword,
  {qv('url', 'experience-level')} as experience_level, {qv('url', 'criteria')} as criteria, {qv('url', 'kw')} as kw,
  {qv('url', 'page')} as page, {qv('url', 'ref')} as ref from urls"""

ORACLES["group_title"] = f"""with {URLS}, {WATCH},
g as (select w.group_idx, case when w.group_idx % 2 = 0 then null else w.group_title end as group_title,
  w.page_id, u.url from watch w join urls u using (page_id)),
f as (select group_idx, max(group_title) as t, arg_min(url, page_id) as first_url from g group by group_idx)
select group_idx, coalesce(t, {derive_title_sql('first_url')}) as sheet_title from f"""

ORACLES["watchlist_json"] = f"""with {WATCH} select cast(rb_group as bigint) as group_idx, group_title,
  cast(rb_url as bigint) as url_idx, url from readback"""

ORACLES["watchlist_sections"] = f"""with {WATCH} select cast(rb_group as bigint) as group_idx,
  case when group_idx % 50 = 0 then null else group_title end as group_title, cast(rb_url as bigint) as url_idx, url
from readback"""

ORACLES["watchlist_fallback"] = ORACLES["watchlist_sections"]

ORACLES["watch_pages"] = """select cast(page_id as bigint) as url_idx, page_id,
  cast(length(html) as bigint) as html_chars,
  cast((dense_rank() over (order by regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1)) - 1) * 1000000000000
    + page_id // 100 as bigint) as group_idx
from pages"""


# --------------------------------------------------------------------------
# Extraction: pages, and cards rendered from `part`

def strip_sql(x: str) -> str:
    for tag in ("script", "style", "noscript"):
        end = f"</{tag}\\s*>" + ("" if tag == "noscript" else "|\\z")
        x = f"regexp_replace({x}, '(?is)(<!--.*?-->)|<{tag}\\b[^>]*>.*?(?:{end})', '\\1', 'g')"
    return x


def page_key_sql(url: str) -> str:
    return (f"substring(regexp_replace(regexp_replace({url}, 'https?://', '', 'g'), '[^{W}\\-. ]', '_', 'g'), "
            f"1, 100)")


ORACLES["page_strip"] = f"""select page_id, cast(length({strip_sql('html')}) as bigint) as clean_chars,
  md5({strip_sql('html')}) as clean_md5 from pages"""

ORACLES["newline_squeeze"] = """select doc_id,
  cast(length(regexp_replace(text, '\\n{3,}', chr(10) || chr(10), 'g')) as bigint) as n_chars,
  md5(regexp_replace(text, '\\n{3,}', chr(10) || chr(10), 'g')) as text_md5 from documents"""

ORACLES["page_key"] = f"select page_id, {page_key_sql('url')} as page_key from pages"

ORACLES["page_export"] = f"""select page_id, {page_key_sql('url')} as page_key,
  cast(length({strip_sql('html')}) as bigint) as clean_chars, md5({strip_sql('html')}) as clean_md5 from pages"""

ORACLES["page_files"] = f"""with fetched as (select page_id, url, html from pages
  union all select page_id + 1000000000000, regexp_replace(url, '^https:', 'http:'), html || '<p>later</p>' from pages where page_id % 2 = 0),
keyed as (select page_id, {page_key_sql('url')} as page_key, coalesce({strip_sql('html')}, '') as clean from fetched)
select page_key, cast(length(clean) as bigint) as clean_chars, md5(clean) as clean_md5 from keyed where page_key <> ''
qualify row_number() over (partition by page_key order by page_id desc) = 1"""


def _unescape(x: str) -> str:
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        x = f"replace({x}, '{ent}', '{ch}')"
    return x


_H1 = f"regexp_extract({strip_sql('html')}, '(?is)<h1[^>]*>(.*?)</h1>', 1)"
_H1_TEXT = _unescape(f"regexp_replace({_H1}, '<[^>]*>', '', 'g')")
ORACLES["page_markdown"] = f"""select page_id,
  replace(replace(trim(regexp_replace({_H1_TEXT}, '[\\t\\r\\n ]+', ' ', 'g')), '*', '\\*'), '_', '\\_') as h1,
  cast(len(regexp_extract_all({strip_sql('html')}, '<a\\s[^>]*href="[^"]+"[^>]*>\\s*[^<\\s]')) as bigint) as n_links
from pages"""

_SLUG = "lower(replace(p_name, ' ', '-')) || '-' || cast(p_partkey as varchar)"
_MD_TAGS = ("concat_ws(', ', 'Spark', case when p_partkey % 2 = 0 then 'Spark' end, "
            "'t' || cast(p_partkey % 7 as varchar), 'u' || cast(p_partkey % 3 as varchar))")
_MD_AGE = "case when p_partkey % 5 = 0 then 'New' else cast(p_partkey % 31 as varchar) || 'd left' end"


def _html_tags(cap: str | None) -> str:
    n = "1 + 3 * (p_partkey % 3)"
    n = f"least({n}, {cap})" if cap else n
    return f"array_to_string(list_transform(range({n}), lambda i: 'T' || cast((p_partkey + i) % 11 as varchar)), ', ')"


_B_HREF = "'/pl/job/' || " + _SLUG
_C_HREF = "'/szczegoly/praca/' || lower(replace(p_name, ' ', '-')) || ',oferta,' || cast(p_partkey as varchar)"

ORACLES["md_cards"] = f"""select {_SLUG} as link_slug, p_name as title,
  'https://justjoin.it/job-offer/' || {_SLUG} as full_url from part"""

ORACLES["card_fields"] = f"""select {_SLUG} as link_slug, cast(p_size as varchar) || ' EUR/h' as salary,
  p_brand as company, p_type as location from part"""

ORACLES["card_lines"] = f"select {_SLUG} as link_slug, {_MD_AGE} as posted_age from part"

ORACLES["card_tags"] = f"select {_SLUG} as link_slug, {_MD_TAGS} as tags from part"

_B_ROWS = f"""select 'B' as source, {_SLUG} as link_slug, p_name || ' & co' as title,
  case when p_partkey % 5 = 0 then 'Unknown' else p_brand end as company, {_html_tags('5')} as tags,
  null::varchar as salary, null::varchar as location, null::varchar as posted_age,
  'https://nofluffjobs.com' || {_B_HREF} as full_url
from part where p_partkey % 7 <> 0"""

_C_ROWS = f"""select 'C' as source, null::varchar as link_slug, p_name as title,
  case when p_partkey % 5 = 0 then 'Unknown' else p_brand end as company, {_html_tags(None)} as tags,
  null::varchar as salary, null::varchar as location, null::varchar as posted_age,
  case when p_partkey % 7 = 0 then 'Unknown' else 'https://theprotocol.it' || {_C_HREF} end as full_url
from part"""

_A_ROWS = f"""select 'A' as source, {_SLUG} as link_slug, p_name as title, p_brand as company, {_MD_TAGS} as tags,
  cast(p_size as varchar) || ' EUR/h' as salary, p_type as location, {_MD_AGE} as posted_age,
  'https://justjoin.it/job-offer/' || {_SLUG} as full_url
from part"""

ORACLES["html_cards_class"] = f"select link_slug, title, company, tags, full_url from ({_B_ROWS})"

ORACLES["lateral_cards"] = ORACLES["html_cards_class"]

ORACLES["html_cards_attr"] = f"select title, company, tags, full_url from ({_C_ROWS})"

ORACLES["unify_listings"] = f"({_A_ROWS}) union all ({_B_ROWS}) union all ({_C_ROWS})"

ORACLES["link_normalize"] = f"select source, link_slug, full_url from (({_A_ROWS}) union all ({_B_ROWS}) union all ({_C_ROWS}))"

# upper() as in Python and Java: the sharp s becomes "SS"
_UP = "upper(replace(text, 'ß', 'ss'))"
ORACLES["title_badge"] = f"""select doc_id, {_UP} as raw_title,
  {trim_ws(f"replace({_UP}, 'NEW', '')")} as title from documents"""

ORACLES["extract_rejects"] = """select page_id, url, 'page' as kind, 'ValueError: page has no content' as error
from pages where page_id % 10 = 0"""

ORACLES["page_rejects"] = """select s.source, page_id, url, 'ValueError: page has no content' as error
from pages, (select unnest(['A', 'B', 'C']) as source) s where page_id % 10 = 0"""

_BRAND = "lower(regexp_replace(p_brand, '[^A-Za-z0-9]+', '-', 'g'))"
_PAGE_POS = "row_number() over (partition by p_brand, p_partkey // 256 order by p_partkey)"

ORACLES["card_rejects"] = f"""select concat('https://nofluffjobs.com/pl/', {_BRAND}, '?page=', p_partkey // 256) as url, pos,
  'ValueError: card without a link' as error
from (select *, {_PAGE_POS} - 1 as pos from part) where p_partkey % 7 = 0"""

# two groups a brand, against the alphabet
_GROUP = f"2 * dense_rank() over (order by {_BRAND} desc)"

_PAGES_RUN = "with recursive " + SHEETS + f""",
all_rows as (
  select {_GROUP} as group_idx, {_BRAND} as group_title, p_partkey // 256 as url_idx, {_PAGE_POS} as pos, 50 as lim,
    a.title, a.company, a.tags, a.full_url
  from ({_A_ROWS.replace("select 'A' as source,", "select p_partkey, 'A' as source,")}) a join part using (p_partkey)
  union all
  select {_GROUP}, {_BRAND}, 1 * 1000000000000 + p_partkey // 256, {_PAGE_POS}, 50, b.title, b.company, b.tags, b.full_url
  from ({_B_ROWS.replace("select 'B' as source,", "select p_partkey, 'B' as source,")}) b join part using (p_partkey)
  union all
  select {_GROUP} + 1, {_BRAND}, 2 * 1000000000000 + p_partkey // 256, {_PAGE_POS}, 30, c.title, c.company, c.tags, c.full_url
  from ({_C_ROWS.replace("select 'C' as source,", "select p_partkey, 'C' as source,")}) c join part using (p_partkey)),
feed as (select * from all_rows where full_url is not null and not {is_polish('title')}),
cands as (select * exclude (rn) from (
  select *, row_number() over (partition by group_idx, url_idx order by pos) as rn from feed) where rn <= lim),
flag as (select *, sheet <> 'Trash' and coalesce({norm_status('status')} in ('DISCARD', 'OUT'), false) as mv
  from sheets),
lcells as (select sheet, unnest([title, company, tags, status, link]) as cell from sheets),
kurls as ({known_urls_from('lcells')}),
krecs as (select {trim_ws('title')} as title, {trim_ws('company')} as company, {trim_ws('tags')} as tags from sheets),
fresh as (select * from cands c where not exists (select 1 from kurls k where k.url = c.full_url)
  and not exists (select 1 from krecs k where k.title = c.title and k.company = c.company and k.tags = c.tags)),
""" + ordered_fold("fresh", "group_idx, url_idx, pos", "kept") + f""",
grp as (select distinct group_idx, group_title from all_rows)
"""
ORACLES["full_run_pages"] = _PAGES_RUN + """select g.group_idx, g.group_title,
  cast((select count(*) from kept k where k.group_idx = g.group_idx) as bigint) as new_offers,
  cast((select count(*) from cands c where c.group_idx = g.group_idx) as bigint) as total_candidates,
  cast((select count(*) from cands c where c.group_idx = g.group_idx)
    - (select count(*) from kept k where k.group_idx = g.group_idx) as bigint) as skipped
from grp g"""

ORACLES["registry_listings"] = _PAGES_RUN + """select case lim when 30 then 'C' when 50 then if(full_url like '%justjoin%', 'A', 'B') end as source,
  title, full_url, lim as row_limit from all_rows"""

ORACLES["incremental_run"] = "with recursive " + OFFERS.replace(
    "else text end as title,", "else text end as title0,") + f""",
o2 as (select * exclude (title0), {trim_ws('title0')} as title from offers),
marked as (select *, {is_polish('title')} as is_polish from o2),
ledger as (select group_title as sheet, pos, title, company, tags, 'NEW' as status, full_url as link
  from marked where pos % 11 = 0 and not is_polish),
cands as (select * from marked where pos % 11 <> 0 and not is_polish),
lcells as (select sheet, unnest([title, company, tags, status, link]) as cell from ledger),
kurls as ({known_urls_from('lcells')}),
krecs as (select {trim_ws('title')} as title, {trim_ws('company')} as company, {trim_ws('tags')} as tags from ledger),
fresh as (select * from cands c where not exists (select 1 from kurls k where k.url = c.full_url)
  and not exists (select 1 from krecs k where k.title = c.title and k.company = c.company and k.tags = c.tags)),
""" + ordered_fold("fresh", "group_idx, url_idx, pos", "kept") + """
select group_title, pos, full_url, title from kept"""

ORACLES["ledger_rewrite"] = ORACLES["organize_only"]

ORACLES["run_summary"] = ORACLES["full_run_summary"]

ORACLES["full_run_ledger"] = _PAGES_RUN + f""",
old_rows as (
  select case when mv then 'Trash' else sheet end as sheet, pos as pos0, title, company, tags, status, link,
    1 as is_new_flag, null::bigint as g, null::bigint as u, null::bigint as p,
    case when mv then 1 else 0 end as moved, case when mv then sheet else '' end as src
  from flag),
new_rows as (
  select group_title as sheet, null::bigint as pos0, title, company, tags, 'NEW' as status, full_url as link,
    0 as is_new_flag, -group_idx as g, url_idx as u, pos as p, null::int as moved, null::varchar as src
  from kept),
both_ as (select * from old_rows union all select * from new_rows),
targets as (select group_title as sheet from grp union select sheet from flag where mv union select 'Trash')
select sheet, row_number() over (partition by sheet order by {bucket('status')}, is_new_flag, g, u, p, moved, src, pos0)
  as pos, title, company, status, link
from both_ where sheet in (select sheet from targets)
union all
select sheet, pos0 as pos, title, company, status, link from both_ where sheet not in (select sheet from targets)"""


# Whole runs over raw ledgers: rows keep header and cells


def _named(header: str) -> str:
    """(name, occ, at) of each column of a header."""
    return (f"list_transform(range(1, len({header}) + 1), lambda i: "
            f"{{'name': {header}[i], 'occ': len(list_filter({header}[1:i], lambda y: y = {header}[i])), 'place': i}})")


def raw_rewrite(raw: str, watched: str, new: str | None) -> str:
    """CTEs of the rewrite of ``raw`` (sheet, pos, header, cells); ``new``: a CTE (sheet, cells, g, u, p) of new rows."""
    fed_tables = f"select distinct sheet from {new}" if new else "select null::varchar as sheet where false"
    new_rows = f"""
  union all
  select sheet, null::bigint as pos0, ['Title', 'Company', 'Tags', 'Status', 'Link'] as header, cells, true as inside, 0 as old_, g, u, p, 0 as before, null::int as mv, null::varchar as src, null::bigint as op
  from {new}""" if new else ""
    status = "case when list_position(header, 'Status') > 0 then cells[list_position(header, 'Status')] end"
    return f"""
rflag as (select *, {status} as st, sheet <> 'Trash' and coalesce({norm_status(status)} in ('DISCARD', 'OUT'), false) as mv from {raw}),
rlost as (select distinct sheet from rflag where mv),
rfed as ({fed_tables}),
rtargets as (select sheet from rlost union select sheet from rfed union select 'Trash' union {watched}),
rown as (select coalesce((select header from rflag where sheet = 'Trash' order by pos limit 1), ['Title', 'Company', 'Tags', 'Status', 'Link']) as header),
rcols as (select unnest({_named('header')}) as c, null::varchar as sheet from rown
  union all select unnest({_named('header')}) as c, sheet from (select distinct sheet, header from rflag where mv)),
rtrash as (select list({{'name': name, 'occ': occ}} order by sheet nulls first, place) as cols from (
  select c.name as name, c.occ as occ, min((coalesce(sheet, ''), c.place)) as k, min(coalesce(sheet, '')) as sheet, arg_min(c.place, (coalesce(sheet, ''), c.place)) as place
  from rcols group by 1, 2)),
rtitle as (select *, sheet in (select sheet from rfed) and not mv as fed,
  case when {_last('Title')} = 0 and len(cells) > 0 then cells[1] else {_get('Title')} end as title_raw from rflag),
rform as (select *, contains(title_raw, '=HYPERLINK') and len(string_split(title_raw, '"')) >= 4 as is_f from rtitle),
rcanon as (select *, [case when is_f then string_split(title_raw, '"')[4] else title_raw end, {_get('Company')}, {_get('Tags')}, {_get('Status')},
  case when (case when is_f then string_split(title_raw, '"')[2] else {_get('Link')} end) = '' then {_get('Full URL')}
    else (case when is_f then string_split(title_raw, '"')[2] else {_get('Link')} end) end] as canon, {_named('header')} as own from rform),
rrows as (
  select case when mv then 'Trash' else sheet end as sheet, pos as pos0,
    case when mv or sheet = 'Trash' then list_transform(t.cols, lambda w: w.name) when fed then ['Title', 'Company', 'Tags', 'Status', 'Link'] else header end as header,
    case when mv then list_transform(t.cols, lambda w: coalesce(cells[list_filter(own, lambda c: c.name = w.name and c.occ = w.occ)[1].place], ''))
      when fed then canon else cells end as cells,
    mv or sheet in (select sheet from rtargets) as inside, 1 as old_, null::bigint as g, null::bigint as u, null::bigint as p,
    case when not mv and sheet in (select sheet from rlost) then {bucket('st')} else 0 end as before,
    case when mv then 1 else 0 end as mv, case when mv then sheet else '' end as src, pos as op
  from rcanon, rtrash t{new_rows}),
rdone as (select *, inside and coalesce(list_position(header, 'Status'), 0) > 0 as sorts, {status} as st2 from rrows)
select sheet, case when sorts then row_number() over (partition by sheet, sorts order by {bucket('st2')}, old_, g, u, p, before, mv, src, op) else pos0 end as pos,
  to_json(list_transform(header, lambda x: coalesce(x, '')))::varchar as header, to_json(list_transform(cells, lambda x: coalesce(x, '')))::varchar as cells
from rdone"""


ORACLES["organize_raw"] = f"""with {RAW},
rawl as (select sheet, pos,
  case when sheet = '1-URGENT' then list_concat(['Status', 'Note'], header) else header end as header,
  case when sheet = '1-URGENT' then list_concat([case pos % 5 when 0 then 'Out' when 1 then 'x-save' else '' end, concat('note ', pos)], cells) else cells end as cells
  from raw),
{raw_rewrite('rawl', "select regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) from pages", None)}"""

ORACLES["full_run_raw"] = _RUN_KEPT + f""",
named as (select * replace (case pos % 7 when 0 then 'archive' when 1 then 'old' else sheet end as sheet),
  case pos % 5 when 0 then 'DISCARD' when 1 then 'CVSENT' when 2 then ' out ' when 3 then 'about' else 'NEW' end as made,
  case pos % 3 when 0 then 'Saved' else 'NEW' end as again from ledger),
rawl as (select sheet, pos,
  case sheet when 'archive' then ['Link', 'Tags', 'Company', 'Title', 'Kept'] when 'old' then ['Title', 'Owner', 'Company', 'Tags', 'Link', 'Status', 'Owner']
    when 'en' then ['Title', 'Salary', 'Company', 'Location', 'Tags', 'Age', 'Status', 'Full URL']
    when 'de' then ['Status', 'Title', 'Company', 'Tags', 'Link', 'Status'] when 'fr' then ['Title', 'Company', 'Tags', 'Link']
    else ['Title', 'Company', 'Tags', 'Status', 'Link'] end as header,
  case when sheet = 'archive' then [link, tags, company, title, 'yes'] when sheet = 'old' then [title, 'a', company, tags, link, made, 'b']
    when sheet = 'en' then [title, '10 EUR', company, 'Krakow', tags, '3d left', made, link] when sheet = 'de' then [made, title, company, tags, link, again]
    when sheet = 'fr' then [title, company, tags, link] when pos % 6 = 0 and link = '' then [title, company, tags]
    else [title, company, tags, made, link] end as cells from named),
rnew as (select group_title as sheet, [title, coalesce(company, ''), coalesce(tags, ''), 'NEW', full_url] as cells, -group_idx as g, url_idx as u, pos as p from kept),
{raw_rewrite('rawl', "select distinct group_title from offers", 'rnew')}"""
