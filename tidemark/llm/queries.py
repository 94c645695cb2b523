"""The operators as named queries over the tables, with SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (decontaminate, exact, licenses, minhash, mixing, pii, repair, sharding, tokens, toxicity, trie, urls,
                          warc)
from tidemark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op1_license_scan")
def op1_license_scan(spark, sf):
    return licenses.scan(table(spark, sf, "documents"))


@query("op2_edit_aware_token_counts")
def op2_edit_aware_token_counts(spark, sf):
    """Counts of every document, then of the document after three edits: its first word goes, its middle is replaced by
    the language's name, its end gets the source's name."""
    docs = table(spark, sf, "documents")
    length = F.length(F.coalesce("text", F.lit("")))

    def edit(at, deleted, inserted):
        return F.struct(at.cast("long").alias("at"), deleted.cast("long").alias("deleted"), inserted.alias("inserted"))

    edits = F.array(edit(F.lit(0), F.length(F.substring_index(F.coalesce("text", F.lit("")), " ", 1)), F.lit("")),
                    edit(length / 2, F.lit(7), F.concat(F.lit(" "), "lang")),
                    edit(length, F.lit(0), F.concat(F.lit("\n"), "source")))
    return tokens.count_before_and_after(docs.withColumn("edits", edits))


@query("op3_minmax_near_dedup", f"""
with recursive words as (
  select doc_id, regexp_extract_all({LOWERED}, '[^\\x20\\x09-\\x0D]+') as w from documents),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
  from words),
classes as (select s, min(doc_id) as c, len(s) as n from sets where len(s) > 0 group by s),
shingles as (select c, n, md5(unnest(s)) as g from classes),
common as (select g from shingles group by g having count(*) > 1),
several as (select c, n, g from shingles semi join common using (g)),
shared as (
  select x.c as a, y.c as b, any_value(x.n + y.n) as words, count(*) as n
  from several x join several y on x.g = y.g and x.c < y.c and 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n) group by x.c, y.c),
links as (select a, b from shared where 100 * n >= 85 * (words - n)),
both_ways as (select a, b from links union all select b, a from links),
reach as (
  select c as start, c as node from classes
  union select start, b from reach join both_ways on node = a),
least_ids as (select start, min(node) as least_id from reach group by start)
select doc_id, len(sets.s) as n_shingles, coalesce(least_id, doc_id) as component_id, doc_id = coalesce(least_id, doc_id) as kept
from sets left join classes on classes.s = sets.s left join least_ids on start = c""")
def op3_minmax_near_dedup(spark, sf):
    return minhash.near_duplicates(table(spark, sf, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


@query("op4_heavy_hitter_exact_dedup", f"""
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = max(doc_id) over same as kept, sha256(t) as text_sha256
from (select doc_id, {LOWERED} as t from documents)
window same as (partition by t)""")
def op4_heavy_hitter_exact_dedup(spark, sf):
    return exact.exact_dedup(table(spark, sf, "documents"))


@query("op5_suffix_array_decontamination", f"""
with item_words as (
  select item_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (
  select distinct item_id, unnest(case when len(w) = 0 then [] when len(w) < 10 then [w]
    else list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) end) as g
  from item_words),
doc_words as (
  select doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
lengths as (select distinct len(g) as k from windows),
spots as (
  select doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') as g
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from doc_words, lengths)),
found as (
  select doc_id, item_id, i, k
  from spots join (select item_id, len(g) as k, array_to_string(g, ' ') as g from windows) using (g, k)),
hits as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + k)) as p from found) group by 1),
named as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from found) group by 1)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join hits using (doc_id) left join named using (doc_id)""")
def op5_suffix_array_decontamination(spark, sf):
    return decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op6_budget_mixing")
def op6_budget_mixing(spark, sf):
    return mixing.mix(table(spark, sf, "documents"))


@query("op7_flow_resharding")
def op7_flow_resharding(spark, sf):
    return sharding.reshard(table(spark, sf, "documents"))


@query("op9_clause_grammar_toxicity")
def op9_clause_grammar_toxicity(spark, sf):
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op8_semi_markov_pii")
def op8_semi_markov_pii(spark, sf):
    return pii.personal_data(table(spark, sf, "documents"))


# A record identifier of the parts joined by line ends.
def _identifier(parts: str) -> str:
    h = f"sha256({parts})"
    return "'<urn:uuid:' || " + " || '-' || ".join(
        f"substring({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + " || '>'"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


NAMES_SQL = "map {" + ", ".join(f"{_quoted(n)}: {_quoted(c)}" for n, c in warc.NAMES.items()) + "}"
WINDOWS_SQL = "map {" + ", ".join(f"{n}: {_quoted(c)}" for n, c in warc.WINDOWS.items()) + "}"


def _characters_sql(text: str) -> str:
    name = f"regexp_extract(p, '{warc.REFERENCE}', 1)"
    number = f"(case when lower({name}[2:2]) = 'x' then cast('0x' || {name}[3:] as int) else cast({name}[2:] as int) end)"
    char = (f"case when {name} = '' then null when {name}[1:1] <> '#' then {NAMES_SQL}[{name}] "
            f"when {number} = 0 or {number} between 55296 and 57343 or {number} > 1114111 then '{warc.UNKNOWN}' "
            f"when {number} between 128 and 159 then {WINDOWS_SQL}[{number}] when {number} in {warc.SPACES} then ' ' else chr({number}) end")
    return (f"(string_split({text}, '&')[1] || array_to_string(list_transform(string_split({text}, '&')[2:], "
            f"lambda p: coalesce(({char}) || p[length({name}) + 2:], '&' || p)), ''))")


def _plain_sql(html: str) -> str:
    hidden = "|".join(f"<{name}(?:\\s[^>]*)?>.*?</{name}\\s*>" for name in warc.HIDDEN)
    out = f"regexp_replace({html}, '(?is)<!--.*?-->|{hidden}', '', 'g')"
    out = f"regexp_replace({out}, '[\r\n]+', ' ', 'g')"
    out = f"regexp_replace({out}, '(?i)</?(?:{'|'.join(warc.BREAKS)})(?:\\s[^>]*)?/?>', chr(10), 'g')"
    return f"regexp_replace({out}, '<[A-Za-z/!?][^>]*>', '', 'g')"


def _folded_sql(text: str) -> str:
    out = f"regexp_replace({text}, '[ \t\r\f\x0B]+', ' ', 'g')"
    return f"trim(trim(regexp_replace({out}, ' ?\n[ \n]*', chr(10), 'g'), chr(10)))"


TITLE_SQL = "regexp_replace(regexp_extract(html, '(?is)<title[^>]*>([^<]*)</title', 1), '[ \t\r\f\x0B]+', ' ', 'g')"


@query("op10_warc_derivatives", f"""
with captured as (
  select page_id, url, coalesce(html, '') as html,
    {_identifier("'response' || chr(10) || cast(page_id as varchar) || chr(10) || coalesce(url, '') || chr(10) || coalesce(html, '')")} as refers_to,
    'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
      || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) as http
  from pages),
bare as (
  select *, {_plain_sql("html")} as bare, {TITLE_SQL} as bare_title,
    list_transform(regexp_extract_all(html, {_quoted(warc.LINK)}, 1), lambda x: regexp_replace(x, '^["'']|["'']$', '', 'g')) as raw_links
  from captured),
plain as (
  select *, {_folded_sql(_characters_sql("bare"))} as plain, trim({_characters_sql("bare_title")}) as title,
    list_transform(raw_links, lambda x: {_characters_sql("x")}) as links
  from bare),
linked as (
  select *, coalesce((select string_agg('outlink: ' || l || chr(13) || chr(10), '' order by first) from (
      select l, min(i) as first from (select unnest(links) as l, generate_subscripts(links, 1) as i) group by l)), '') as out
  from plain),
records as (
  select *, 'metadata' as warc_type, 'application/warc-fields' as content_type,
    'source-record-id: ' || refers_to || chr(13) || chr(10) || http || 'title: ' || regexp_replace(title, '[\r\n]+', ' ', 'g')
      || chr(13) || chr(10) || 'text-length: ' || strlen(plain) || chr(13) || chr(10) || out as block from linked
  union all
  select *, 'conversion', 'text/plain; charset=utf-8', plain from linked)
select page_id, warc_type, {_identifier("warc_type || chr(10) || refers_to")} as record_id, refers_to, url as target_uri,
  '2024-01-01T00:00:00Z' as date, content_type, 'sha256:' || sha256(html) as payload_digest,
  'sha256:' || sha256(block) as block_digest, strlen(block) as content_length, block
from records""")
def op10_warc_derivatives(spark, sf):
    return warc.derivatives(warc.responses(table(spark, sf, "pages")))


def _crc32_sql(text: str) -> str:
    """crc32 of an ASCII text: each byte is mixed in and followed by eight single-bit steps."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [cast(ascii(c) as bigint), -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (f"xor(list_reduce(list_prepend(cast(4294967295 as bigint), {steps}), lambda a, x: case when x >= 0 then xor(a, x) "
            "else xor(a >> 1, 3988292384 * (a & 1)) end), 4294967295)")


@query("op11_prefix_trie", f"""
with turns as (
  select conv_id as c, turn, sha256(length(role) || ':' || role || text)[1:32] as id,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words
  from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)),
own as (select *, row_number() over (partition by c order by turn nulls first, id) as pos from turns),
convs as (select c, c - c % 20 as base, {_crc32_sql("cast(c as varchar)")} % 4 as h from (select distinct c from own)),
parts as (
  select v.c, pos, id, words from convs v join own o on o.c = v.base and pos <= h
  union all select v.c, pos, id, words from convs v join own o on o.c = v.c and pos > h),
placed as (select *, row_number() over (partition by c order by pos) as depth from parts),
prefixes as (
  select c, depth, words, md5(string_agg(id, '') over (partition by c order by depth)) as p from placed
  union all select c, 0, 0, '' from convs),
nodes as (select depth, p, min(c) as conv_id, count(*) as n_convs, any_value(words) as words from prefixes group by depth, p),
ends as (
  select depth, p, string_agg(cast(c as varchar), ',' order by c) as ids
  from (select *, max(depth) over (partition by c) as last from prefixes) where depth = last group by depth, p),
above as (
  select n.depth, n.p, a.depth as d, a.p as q from nodes n join prefixes a on a.c = n.conv_id and a.depth <= n.depth),
children as (select d as depth, q as p, count(*) as n_children from above where depth = d + 1 group by d, q),
own_values as (
  select depth, p, case when n_children is null then 1 else 0 end as leaf, (n_convs - 1) * words as saved
  from nodes left join children using (depth, p)),
sums as (
  select d as depth, q as p, cast(sum(leaf) as bigint) as n_leaves, cast(sum(saved) as bigint) as saved_tokens
  from above join own_values using (depth, p) group by d, q)
select n.conv_id, n.depth, parent.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children, n_leaves, saved_tokens,
  sha256(coalesce(ids, '')) as ends_sha256
from nodes n join sums using (depth, p) left join children using (depth, p) left join ends using (depth, p)
  left join above on above.depth = n.depth and above.p = n.p and above.d = n.depth - 1
  left join nodes parent on parent.depth = above.d and parent.p = above.q""")
def op11_prefix_trie(spark, sf):
    return trie.prefix_trie(trie.rebuilt(table(spark, sf, "conversations")))


URL_RULES = [("org", "/", urls.ALLOW), ("example.org", "/es/", urls.BLOCK), ("example.org", "/en/1", urls.BLOCK),
             ("com", "/fr/", urls.ALLOW), ("com", "/de/", urls.BLOCK)]


@query("op12_bloom_url_filter", f"""
with rules(host, path, verdict) as (values {", ".join(map(str, URL_RULES))}),
urls as (
  select row_number() over () as id, page_id,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) as path
  from pages),
fits as (
  select id, max_by(r, length(r.host) + length(r.path)) as r
  from urls u join rules r on (u.host = r.host or suffix(u.host, '.' || r.host)) and prefix(u.path, r.path) group by id)
select page_id, host, path, r.host || r.path as rule, coalesce(r.verdict, 'allow') as verdict from urls left join fits using (id)""")
def op12_bloom_url_filter(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return urls.judged(pages, urls.rule_table(spark, URL_RULES)).select(
        F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


# A repair in SQL is a text: eight digits of cost, then the audit; the least text is the cheapest repair.
def _edit_sql(rest: str, cost: int | str, letter: str) -> str:
    return f"(lpad(cast(cast({rest}[1:8] as int) + {cost} as varchar), 8, '0') || '{letter}' || {rest}[9:])"


def _row_sql(state: int, steps: dict[str, int], made: int) -> str:
    """The best text of a state in front of a row, without inserts."""
    kept = " ".join(f"when '{initial}' then {_edit_sql(f'v{to}', 'late', 'K')}" for initial, to in steps.items())
    return (f"least({_edit_sql(f'v{state}', 3, 'D')}, case when must then '9' else least("
            f"{_edit_sql(f'v{made}', '2 + late', 'R')}, case initial {kept} else '9' end) end) as b{state}")


AUTOMATON = [({"s": 1, "u": 2}, 2), ({"u": 2}, 2), ({"a": 3}, 3), ({"u": 2}, 2)]


@query("op13_bigint_repair", f"""
with recursive known as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {_crc32_sql("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')")} % 20 as kind
  from conversations),
hurt as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from known, unnest(case when kind = 3 then [0, 1] else [0] end) where kind <> 0),
placed as (
  select *, role[1:1] as initial, row_number() over (
    partition by conv_id order by turn nulls first, role, md5(length(role) || ':' || role || text)) as i from hurt),
judged as (
  select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
    when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
    when regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) not in ('.', '!', '?') then 'truncated' end as fault,
    lag(initial) over (partition by conv_id order by i) || initial as pair
  from placed),
rows as (
  select *, coalesce(fault in ('blank', 'duplicate'), false) as must, case when fault = 'truncated' then 1 else 0 end as late
  from judged),
counts as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
  from rows group by conv_id),
best as (
  select conv_id, n + 1 as i, '00000000' as v0, '00000004II' as v1, '00000002I' as v2, '00000000' as v3 from counts
  union all
  select conv_id, i, least(b0, {_edit_sql("w2", 2, "I")}), least(b1, {_edit_sql("w2", 2, "I")}), w2, w3
  from (select *, least(b2, {_edit_sql("b3", 2, "I")}) as w2, least(b3, {_edit_sql("b2", 2, "I")}) as w3
    from (select rows.conv_id, rows.i, {", ".join(_row_sql(s, *a) for s, a in enumerate(AUTOMATON))}
      from best join rows on rows.conv_id is not distinct from best.conv_id and rows.i = best.i - 1))),
chosen as (select conv_id, cast(v0[1:8] as bigint) as cost, v0[9:] as audit from best where i = 1),
replay as (
  select conv_id, audit, 0 as k, 0 as i, 0 as state, null::varchar as piece from chosen
  union all
  select conv_id, audit, k, i, case when letter = 'D' then state
      when letter = 'K' and initial = 's' then 1 when state in (0, 1, 3) then 2 else 3 end,
    case letter when 'D' then null when 'K' then role || ':' || text
      else case when state = 2 then 'assistant:' else 'user:' end || case letter when 'R' then text else '' end end
  from (select r.conv_id, r.audit, r.k + 1 as k, r.i + (case when r.audit[r.k + 1] = 'I' then 0 else 1 end) as i, r.state,
      r.audit[r.k + 1] as letter from replay r where r.k < length(r.audit)) as e
    left join (select conv_id as c, i as place, initial, role, text from rows) on c is not distinct from conv_id and place = i),
written as (select conv_id, string_agg(piece, chr(10) order by k) as repaired from replay group by conv_id)
select ids.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost, coalesce(audit, '') as audit,
  sha256(coalesce(repaired, '')) as repaired_sha256
from (select distinct conv_id from conversations) ids left join counts on counts.conv_id is not distinct from ids.conv_id
  left join chosen on chosen.conv_id is not distinct from ids.conv_id
  left join written on written.conv_id is not distinct from ids.conv_id""")
def op13_bigint_repair(spark, sf):
    return repair.repaired(repair.damaged(table(spark, sf, "conversations")))
