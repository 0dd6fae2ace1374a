"""SQL twins (DuckDB) of the queries that SQL can express on whole tables."""

from __future__ import annotations

import re

from . import license_scan, quality_rules

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: All pairs that share a shingle, their exact similarity, and the components of the links.
JACCARD_JOIN = f"""
with recursive d as (select doc_id, {_WORDS} as w from documents
), s as (select distinct doc_id, array_to_string(list_slice(w, i, i + n - 1), ' ') as g from (select doc_id, w, least(5, len(w)) as n, unnest(range(1, len(w) - least(5, len(w)) + 2)) as i from d where len(w) > 0)
), size as (select doc_id, count(*) as n from s group by doc_id
), pair as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all
), link as (select a, b, c = x.n and c = y.n as same from pair join size x on a = x.doc_id join size y on b = y.doc_id where c >= 0.8 * (x.n + y.n - c) - 1e-9
), reach(node, label) as (select doc_id, doc_id from d union select b, label from reach join link on a = node
), class as (select node, min(label) as class_id from reach group by node
), rep as (select doc_id, least(doc_id, coalesce(min(b), doc_id)) as rep_id, 1 + count(b) as n_copies from d left join link on a = doc_id and same group by doc_id
), other as (select a, count(distinct case when not same then rep_id end) as n_links, count(*) as n_docs from link join rep on b = doc_id group by a)
select rep.doc_id as doc_id, class_id, rep_id, n_copies, coalesce(n_links, 0) as n_links, coalesce(n_docs, 0) as n_linked_docs from rep join class on node = rep.doc_id left join other on a = rep.doc_id
"""


def _license_scan() -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    words = lambda text: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.lower())
    need = lambda label, text: [i + 1 for i in license_scan._named(words(text), words(license_scan.NAMES.get(label, "")), license_scan.K)]
    templates = ", ".join(f"({i}, {quote(label)}, {quote(text)}, {need(label, text)}::bigint[])" for i, (label, text) in enumerate(license_scan.TEMPLATES))
    phrases = ", ".join(f"({quote(p)}, {quote(label)}, {len(p.split())})" for p, label in license_scan.PHRASES.items())
    k, gap, cover, dense = license_scan.K, license_scan.MAX_GAP, license_scan.MIN_COVER, license_scan.MIN_DENSE
    return f"""
with d as (select row_number() over () as r, doc_id, {_WORDS} as w from documents
), phrase(p, label, n) as (values {phrases}
), base as (select r, i, label from (select r, w, n, p, label, unnest(range(1, len(w) - n + 2)) as i from d, phrase where len(w) >= n) where array_to_string(list_slice(w, i, i + n - 1), ' ') = p
), based as (select r, count(*) as n_base, min(i) - 1 as first_word, max(i) - 1 as last_word, list(distinct label) as labels from base group by r
), template(t, label, text, need) as (values {templates}
), tw as (select t, label, need, {_WORDS} as w from template
), tg as (select t, label, need, len(w) as n, i as t_at, array_to_string(list_slice(w, i, i + {k - 1}), ' ') as g from (select t, label, need, w, unnest(range(1, len(w) - {k - 2})) as i from tw)
), dg as (select r, i as pos, array_to_string(list_slice(w, i, i + {k - 1}), ' ') as g from (select r, w, unnest(range(1, len(w) - {k - 2})) as i from d)
), hit as (select r, t, label, need, n, pos, t_at, pos - t_at as diagonal from dg join tg using (g)
), diag as (select r, t, diagonal, coalesce(diagonal - lag(diagonal) over (partition by r, t order by diagonal) > {gap}, true) as new from (select distinct r, t, diagonal from hit)
), span as (select r, t, diagonal, sum(cast(new as int)) over (partition by r, t order by diagonal rows unbounded preceding) as s from diag
), whole as (select r, t, s, any_value(label) as label, any_value(need) as need, list(distinct t_at) as t_ats, any_value(n) as n, list_distinct(flatten(list(range(pos, pos + {k})))) as ws, list_distinct(flatten(list(range(t_at, t_at + {k})))) as ts from hit join span using (r, t, diagonal) group by r, t, s
), good as (select r, label, len(ts) / cast(n as double) as cover from whole where list_has_all(t_ats, need) and len(ts) / cast(n as double) >= {cover} and len(ws) >= {dense} * (list_max(ws) - list_min(ws) + 1)
), method as (select r, list(distinct label) as labels, max(cover) as best from good group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word, array_to_string(list_sort(coalesce(based.labels, [])), ',') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(based.labels, []), coalesce(method.labels, [])))), ',') as labels, case when n_base > 0 then 1.0::double else least(coalesce(best, 0), 1.0::double) end as score
from d left join based using (r) left join method using (r)
"""


LICENSE_SCAN = _license_scan()

def _quality_rules() -> str:
    q = quality_rules
    value = {  # numerator and denominator of each rule
        "symbols": ("n_symbols", "3 * n_words"), "capitals": ("upper_", "letters"), "bare_words": ("bare", "n_words"), "stutter": ("again", "n_words"), "shouting": ("bangs", "2 * n_words"), "repeated_lines": ("n_dup_lines", "n_lines"),
    }
    cells = " union all ".join(f"select r, doc_id, lang, {k} as k, '{rule}' as rule, cast(ceil(least(1, cast({value[rule][0]} as double) / greatest({value[rule][1]}, 1)) * 50) as integer) as cell from m" for k, rule in enumerate(q.RULES))
    without = lambda chars: f"length(t) - length(regexp_replace(t, '{chars}', '', 'g'))"
    alpha, level = f"cast({q.ALPHA / len(q.RULES)!r} as double)", f"(cast({q.DELTA!r} as double) / ({len(q.RULES)} * strata))"
    return rf"""
with d as (select row_number() over () as r, doc_id, lang, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), line as (select r, unnest(string_split(t, chr(10))) as x from d), lines as (select r, count(*) as n_lines, count(*) - count(distinct x) as n_dup_lines from line where regexp_matches(x, '[^\x20\x09-\x0D]') group by r
), win as (select r, i, array_to_string(list_slice(w, i, i + 7), ' ') as g from (select r, w, unnest(range(1, len(w) - 6)) as i from d)
), twice as (select r, i from (select *, count(*) over (partition by r, g) as c from win) where c > 1
), repeats as (select r, count(distinct p) as n_repeat_words from (select r, unnest(range(i, i + 8)) as p from twice) group by r
), m as (select r, doc_id, lang, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars, cast({without("[#*$%&|<>]")} as bigint) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_lines, 0) as n_lines,
  {without("[A-Z]")} as upper_, {without("[A-Za-z]")} as letters, {without("!")} as bangs, len(list_filter(w, lambda x: not regexp_matches(x, '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]'))) as bare, len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) as again from d left join lines using (r) left join repeats using (r)
), cell as ({cells}
), held as (select c.*, quality from cell c join (select doc_id, min(quality) as quality from labels where doc_id is not null and quality is not null group by doc_id) using (doc_id)
), strata as (select count(*) as strata from (select distinct lang from held)
), hist as (select lang, rule, cell, sum(case when quality = 1 then 1 else 0 end) as good, sum(case when quality = 1 then 0 else 1 end) as bad from held group by all
), step as (select lang, rule, i, sum(good) as n, sum(case when cell > 50 - i then good else 0 end) as a, sum(case when cell > 50 - i then bad else 0 end) as b from hist, (select unnest(range(0, 51)) as i) group by lang, rule, i
), tail as (select *, case when a >= n then 1 else least(1, list_sum(list_transform(range(0, cast(a as bigint) + 1), lambda j: exp(lgamma(n + 1.0::double) + n * ln(1 - {alpha}) - lgamma(j + 1.0::double) - lgamma(n - j + 1.0::double) + j * (ln({alpha}) - ln(1 - {alpha})))))) end as tail from step
), sure as (select *, min(case when n > 0 and cast(a as double) / n <= {alpha} and tail <= {level} then 1 else 0 end) over (partition by lang, rule order by i) as ok from tail, strata
), chosen as (select lang, rule, 50 - arg_min(i, (-(b - {q.GOOD_WEIGHT!r} * a), i)) as cut from sure where ok = 1 group by lang, rule
), out_ as (select r, string_agg(rule, ',' order by k) as rejected_by from cell join chosen using (rule) where cell.lang is not distinct from chosen.lang and cell > cut group by r)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed, not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and rejected_by is null as kept, coalesce(rejected_by, '') as rejected_by from m left join out_ using (r)
"""


QUALITY_RULES = _quality_rules()

_B32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((v[{i + 1}] >> {s}) & 31 as bigint) + 1, 1)" for i in range(8) for s in (15, 10, 5, 0))
#: Digests as base32 of SHA-1: eight groups of 20 bits, four letters each.
WARC = f"""
with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as x from pages
), b as (select *, list_transform(range(0, 8), lambda i: cast('0x' || substr(x, 5 * i + 1, 5) as bigint)) as v, max(page_id) over (partition by x) as top from p)
select page_id, payload_bytes, {_B32} as payload_digest, case when page_id = top then 'response' else 'revisit' end as record_type, case when page_id <> top then top end as refers_to from b
"""
