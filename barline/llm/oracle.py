"""The queries that SQL can express, for DuckDB."""

from __future__ import annotations

# Fixed values, stated anew so that a wrong one in an operator does not agree with itself: lines' least code points and documents, words of
# a benchmark window, documents of a ranking, and the kinds of secrets with their patterns, the group that is the secret and
# its least length. The first three kinds are the base.
LINE_CODE_POINTS, LINE_DOCUMENTS = 1, 10
BENCHMARK_WORDS = 10
RANKED = 50
SECRETS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("github", r"gh[pousr]_[A-Za-z0-9]{20,}", 0, 0),
    ("google", r"AIza[A-Za-z0-9_-]{30,}", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+", 0, 0),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
)
BASE_KINDS = 3
# License phrases and notices by label; the share of a notice's words a block must hold, and its reach in notices.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "cc-by-4.0": "Licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "mit": "Released under the MIT License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "public-domain": "This work is dedicated to the public domain",
}
SHARE, REACH = 0.9, 2

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP2 = f"""
with lines as (
    select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents),
placed as (
    select doc_id, unnest(parts) as line, unnest(range(len(parts))) as pos from lines),
keyed as (
    select doc_id, pos, line, {_LOWER.format(f"trim(line, {_BLANKS})")} as key from placed),
repeated as (
    select key from keyed where length(key) >= {LINE_CODE_POINTS}
    group by key having count(distinct doc_id) >= {LINE_DOCUMENTS})
select doc_id, count(*) as n_lines, count(repeated.key) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where repeated.key is null), '')) as kept_sha256
from keyed left join repeated using (key) group by doc_id
"""

_WORDS = f"regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

def _values(rows: dict[str, str]) -> str:
    return ", ".join(f"('{a}', '{b}')" for a, b in rows.items())


OP5 = f"""
with notices as (
    select label, {_WORDS.replace("text", "notice")} as words from (values {_values(NOTICES)}) as given(label, notice)),
tokens as (select distinct label, unnest(words) as word from notices),
needs as (
    select label, {REACH} * any_value(len(words)) as reach, count(*) as size, ceil({SHARE} * count(*) - 1e-9) as need
    from tokens join notices using (label) group by label),
phrases as (
    select phrase, base, string_split(phrase, ' ')[1] as word, len(string_split(phrase, ' ')) as size
    from (values {_values(PHRASES)}) as given(phrase, base)),
texts as (select row_number() over () as row, doc_id, case when text is null then [] else {_WORDS} end as words from documents),
placed as (select row, unnest(words) as word, unnest(range(len(words))) as pos from texts),
based as (
    select row, pos, base from placed join phrases using (word) join texts using (row)
    where array_to_string(list_slice(words, pos + 1, pos + size), ' ') = phrase),
found as (
    select row, count(*) as n_base, min(pos) as first_word, max(pos) as last_word,
           string_agg(distinct base, ',' order by base) as base_labels
    from based group by row),
marks as (select row, label, word, pos from placed join tokens using (word)),
held as (select row, label from marks join needs using (label) group by row, label, need having count(distinct word) >= need),
runs as (
    select a.row, a.label, a.pos, count(distinct b.word) as words
    from held join marks a using (row, label) join marks b using (row, label) join needs using (label)
    where b.pos <= a.pos and b.pos > a.pos - reach group by a.row, a.label, a.pos),
met as (
    select row, label, cast(max(words) as double) / size as share
    from runs join needs using (label) group by row, label, size, need having max(words) >= need),
named as (
    select row, string_agg(distinct label, ',' order by label) as labels
    from (select row, label from met union select row, base from based) group by row),
scored as (select row, max(share) as share from met group by row)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
       coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
       case when n_base > 0 then 1.0 else coalesce(share, 0) end as score
from texts left join found using (row) left join named using (row) left join scored using (row)
"""

OP8 = f"""
with items as (
    select distinct cast(item_id as varchar) as item, {_WORDS} as words from benchmark
    where text is not null and item_id is not null),
windows as (
    select item, least(len(words), {BENCHMARK_WORDS}) as size,
           unnest(range(1, greatest(len(words) - {BENCHMARK_WORDS} + 1, 1) + 1)) as pos, words
    from items where len(words) > 0),
patterns as (
    select distinct item, size, array_to_string(list_slice(words, pos, pos + size - 1), ' ') as pattern from windows),
texts as (
    select doc_id, case when text is null then [] else {_WORDS} end as words from documents),
sizes as (select distinct size from patterns),
places as (
    select doc_id, size, unnest(range(1, len(words) - size + 2)) as pos, words from texts, sizes where len(words) >= size),
found as (
    select doc_id, size, pos, array_to_string(list_slice(words, pos, pos + size - 1), ' ') as pattern from places),
hits as (select found.doc_id, found.size, found.pos, item from found join patterns using (size, pattern)),
covered as (
    select doc_id, count(distinct word) as n_hit
    from (select doc_id, unnest(range(pos, pos + size)) as word from hits) group by doc_id),
matched as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names
    from (select distinct doc_id, item from hits) group by doc_id)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from texts left join covered using (doc_id) left join matched using (doc_id)
"""


def _op9() -> str:
    parts = []
    for rank, (kind, pattern, group, least) in enumerate(SECRETS):
        pattern = pattern.replace("'", "''")
        parts.append(
            f"""select doc_id, {rank} as rank, '{kind}' as kind,
                  unnest(regexp_extract_all(body, '{pattern}', 0)) as match,
                  unnest(regexp_extract_all(body, '{pattern}', {group})) as value,
                  unnest(list_slice(string_split_regex(body, '{pattern}'), 1, -2)) as gap,
                  unnest(range(len(regexp_extract_all(body, '{pattern}', 0)))) as number, {least} as least
                from texts where regexp_matches(body, '{pattern}')"""
        )
    return f"""
with texts as (select doc_id, coalesce(text, '') as body from documents),
found as ({" union all ".join(parts)}),
ends as (
    select *, sum(length(gap) + length(match)) over (partition by doc_id, rank order by number) as stop from found),
spans as (
    select doc_id, rank, kind, stop - length(match) as start, stop from ends where length(value) >= least),
named as (
    select *, kind || ':' || cast(start as bigint) || ':' || cast(stop as bigint) as span from spans),
grouped as (
    select doc_id, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access,
           count(*) filter (where kind = 'hex') as n_hex,
           string_agg(span, ',' order by start, rank) filter (where rank < {BASE_KINDS}) as base,
           string_agg(span, ',' order by start, rank) as spans
    from named group by doc_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from texts left join grouped using (doc_id)
"""


OP10 = f"""
with recursive words as (
    select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') as words from documents),
places as (
    select doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as pos from words where len(words) > 0),
shingles as (
    select distinct doc_id, array_to_string(list_slice(words, pos, pos + 4), ' ') as shingle from places),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as common
    from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2),
links as (
    select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * common >= 85 * (x.n + y.n - common)),
edges as (select a, b from links union select b, a from links),
reached as (
    select a as doc_id, a as component from edges
    union
    select edges.b, reached.component from reached join edges on edges.a = reached.doc_id
    where reached.component < edges.b),
lowest as (select doc_id, min(component) as component from reached group by doc_id)
select doc_id, coalesce(n, 0) as n_shingles, least(doc_id, coalesce(component, doc_id)) as component_id,
       doc_id = least(doc_id, coalesce(component, doc_id)) as kept
from words left join sizes using (doc_id) left join lowest using (doc_id)
"""


OP11 = f"""
with texts as (
    select row_number() over () as row, doc_id,
           regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
    from documents where text is not null and doc_id is not null),
sized as (select row, doc_id, terms, len(terms) as n from texts where len(terms) > 0),
corpus as (select count(*) as documents, cast(sum(n) as bigint) as total from sized),
held as (select row, term, count(*) as tf from (select row, unnest(terms) as term from sized) group by row, term),
weights as (
    select term, cast(floor(1000 * ln((2 * documents + 2) / (2 * count(*) + 1))) as bigint) as w
    from held, corpus group by term, documents),
asked as (
    select number, item_id, unnest(list_distinct(
             regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) as term
    from (select row_number() over () as number, * from (select distinct item_id, text from benchmark where text is not null))),
scored as (
    select number, item_id, doc_id, row,
           cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * documents) // total)))) as bigint) as score
    from asked join held using (term) join weights using (term) join sized using (row), corpus
    group by number, item_id, doc_id, row),
ranked as (
    select item_id, doc_id, score, row_number() over (partition by number order by score desc, doc_id) as rank
    from scored where score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from ranked where rank <= {RANKED}
"""


# For pages whose main text is an article element, as in the tables. Character references: those of XML, with or without the semicolon.
_BLOCK = "</?(?:p|h[1-6]|div|ul|ol|li|blockquote|pre|section|table|tr|td|th)(?:\\s[^>]*)?>"
_BLANK = "[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"


def _decoded(text: str) -> str:
    for name, character in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("#x27", "''"), ("#39", "''"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', '{character}', 'g')"
    return text


OP13 = f"""
with articles as (
    select row_number() over () as row, page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*?)</article>', 1) as body
    from pages),
parts as (
    select row, unnest(string_split_regex(body, '{_BLOCK}')) as part, unnest(range(len(string_split_regex(body, '{_BLOCK}')))) as pos
    from articles),
blocks as (
    select row, pos, trim(regexp_replace({_decoded("regexp_replace(regexp_replace(part, '<br */?>', ' ', 'g'), '<[^>]*>', '', 'g')")},
           '{_BLANK}', ' ', 'g')) as block
    from parts),
texts as (select row, string_agg(block, chr(10) || chr(10) order by pos) as text from blocks where block <> '' group by row)
select page_id, url, coalesce(text, '') as text, length(coalesce(text, '')) as n_chars
from articles left join texts using (row)
"""


def oracle_sql() -> dict[str, str]:
    """The toxicity, quality, packing, token and language queries train, tokenize or compare floats: no SQL."""
    return {
        "op2_line_dedup": OP2,
        "op5_license_scan": OP5,
        "op8_decontamination": OP8,
        "op9_secrets": _op9(),
        "op10_near_dedup": OP10,
        "op11_lexical_search": OP11,
        "op13_html_text": OP13,
    }
