"""The operators applied to whole tables, by query name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from storelens.llm import (
    collocations,
    cotraining,
    decontamination,
    licenses,
    main_text,
    ngram_join,
    packing,
    quality,
    repeats,
    simhash,
    token_files,
    toxicity,
    turn_repair,
)
from storelens.llm.frames import read_table
from storelens.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(read_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(read_table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.digest(main_text.extract(read_table(spark, sf_dir, "pages"), ["page_id", "url"]))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.digest(ngram_join.similar_documents(read_table(spark, sf_dir, "documents")))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontamination.digest(decontamination.find_contamination(docs, benchmark, ["doc_id"]))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(read_table(spark, sf_dir, "documents"), ["doc_id"]))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.digest(licenses.scan_licenses(docs))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), path)
    return token_files.digest(token_files.read_token_files(spark, path))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    return turn_repair.digest(turn_repair.repair(turn_repair.damage(conversations)), conversations)


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read_table(spark, sf_dir, "documents"))


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.similar_documents(read_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_toxicity,
        op3_best_fit_packing,
        op4_html_extraction,
        op5_ngram_jaccard,
        op6_benchmark_decontamination,
        op7_quality_classifier,
        op8_suffix_dedup,
        op9_license_scans,
        op10_token_files,
        op11_conversation_repair,
        op12_phrase_collocations,
        op13_simhash_dedup,
    )
}

LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM_WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6 = f"""
with doc as (select doc_id, {ALNUM_WORDS.format("text")} as w from documents),
item as (select item_id, {ALNUM_WORDS.format("text")} as w, least(13, len(w)) as m from benchmark),
spot as (select item_id, w, m, unnest(range(1, len(w) - m + 2)) as i from item where m > 0),
pattern as (select distinct item_id, m, array_to_string(w[i:i + m - 1], ' ') as g from spot),
place as (
    select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i
    from doc, (select distinct m from pattern) where len(w) >= m),
gram as (select doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') as g from place),
found as (select doc_id, item_id, m, i from gram join pattern using (m, g)),
hit as (
    select doc_id, count(distinct p) as n_hit
    from (select doc_id, unnest(range(i, i + m)) as p from found) group by doc_id),
hit_item as (
    select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
    from (select distinct doc_id, cast(item_id as varchar) as item_id from found) group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc left join hit using (doc_id) left join hit_item using (doc_id)
"""

OP1 = r"""
with doc as (
    select doc_id, coalesce(text, '') as t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
    from documents),
place as (select doc_id, unnest(range(1, len(w) - 6)) as i, w from doc where len(w) > 7),
gram as (select doc_id, i, array_to_string(w[i:i + 7], ' ') as g from place),
twice as (select doc_id, i from gram qualify count(*) over (partition by doc_id, g) > 1),
covered as (
    select doc_id, count(distinct p) as n
    from (select doc_id, unnest(range(i, i + 8)) as p from twice) group by doc_id),
measured as (
    select doc_id, len(w) as n_words,
           length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
           length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
           len(l) - len(list_distinct(l)) as n_dup_lines, len(l) as n_lines,
           coalesce(n, 0) as n_repeat_words,
           length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as n_capitals,
           len(list_filter(list_zip(w[:-2], w[2:]), lambda x: x[1] = x[2])) as n_stutters
    from doc left join covered using (doc_id)),
judged as (
    select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 5 * n_symbols > n_words or 10 * n_capitals > 4 * word_chars
            or 10 * n_stutters > 4 * n_words or word_chars > 20 * n_words
            or 10 * n_dup_lines > 6 * n_lines) as kept
from judged
"""

SPACE_WORDS = rf"regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+')"

OP5 = f"""
with recursive doc as (select doc_id, {SPACE_WORDS.format("text")} as w from documents),
gram as (
    select distinct doc_id, array_to_string(w[i:i + 3], ' ') as g
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as i from doc where len(w) > 0)),
size as (select doc_id, count(*) as n from gram group by doc_id),
pair as (
    select a.doc_id as a, b.doc_id as b, count(*) as k
    from gram a join gram b on a.g = b.g and a.doc_id < b.doc_id group by all),
link as (
    select a, b from pair join size x on x.doc_id = a join size y on y.doc_id = b
    where 100 * k >= 85 * (x.n + y.n - k)),
edge as (select a, b from link union all select b, a from link),
reach(node, root) as (
    select doc_id, doc_id from size union select edge.b, reach.root from reach join edge on edge.a = reach.node)
select doc.doc_id, coalesce(any_value(n), 0) as n_shingles,
       coalesce(min(root), doc.doc_id) as component_id
from doc left join size on size.doc_id = doc.doc_id left join reach on reach.node = doc.doc_id
group by doc.doc_id
"""

# The notices by themselves, so that the SQL does not read the list that it judges.
NOTICES = """
    ('apache-2.0', 'Licensed under the Apache License, Version 2.0'),
    ('apache-2.0', 'You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ('boost-1.0', 'Distributed under the Boost Software License, Version 1.0'),
    ('bsd', 'Redistribution and use in source and binary forms, with or without modification, are permitted'),
    ('bsd', 'Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer'),
    ('bsd', 'Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution'),
    ('bsd-3-clause', 'Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission'),
    ('cc-by-nc', 'Licensed under CC BY-NC 4.0'),
    ('cc-by-sa', 'Licensed under CC BY-SA 4.0'),
    ('cc0', 'To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work'),
    ('epl-2.0', 'This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0'),
    ('gpl-3.0', 'This work is licensed under the GNU General Public License, version 3'),
    ('gpl-notice', 'This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation'),
    ('isc', 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies'),
    ('mit', 'Released under the MIT License'),
    ('mit', 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software'),
    ('mit', 'The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software'),
    ('mpl-2.0', 'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0'),
    ('unlicense', 'This is free and unencumbered software released into the public domain'),
    ('zlib', 'This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software')
"""
OP9 = f"""
with doc as (
    select doc_id, text, {ALNUM_WORDS.format("text")} as w from documents),
template as (
    select label, len(n) as size, list_distinct(n) as t
    from (select label, {ALNUM_WORDS.format("notice")} as n from (values {NOTICES}) v(label, notice))),
line as (
    select doc_id, i, {ALNUM_WORDS.format("line")} as w
    from (select doc_id, unnest(lines) as line, unnest(range(1, len(lines) + 1)) as i
          from (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents))),
parted as (
    select *, count(*) filter (len(w) = 0) over (partition by doc_id order by i) as paragraph from line),
ending as (
    select *, sum(len(w)) over (partition by doc_id, paragraph order by i) as last from parted where len(w) > 0),
paragraph as (
    select doc_id, paragraph, flatten(list(w order by i)) as words from ending group by doc_id, paragraph),
-- lines, and the last words of a line with the first ones behind it in its paragraph
block as (
    select doc_id, list_distinct(w) as b from ending
    union all
    select doc_id, list_distinct(words[last - least(len(w), longest) + 1 : last + longest])
    from ending join paragraph using (doc_id, paragraph), (select max(size) as longest from template)
    where last < len(words)),
meeting as (
    select doc_id, label, len(list_intersect(b, t)) / len(t) as share
    from block, template where len(b) >= 0.9 * len(t) and 10 * len(list_intersect(b, t)) >= 9 * len(t)),
found as (select doc_id, list(distinct label) as ls, max(share) as share from meeting group by doc_id),
base as (
    select doc_id, len(w) as n_words,
           list_filter(range(1, len(w) + 1), lambda i: w[i] = 'cc' and w[i + 1] = 'by') as cc,
           list_filter(range(1, len(w) + 1), lambda i:
               w[i] = 'general' and w[i + 1] = 'public' and w[i + 2] = 'license') as gpl,
           list_filter(range(1, len(w) + 1), lambda i:
               w[i] = 'all' and w[i + 1] = 'rights' and w[i + 2] = 'reserved') as reserved
    from doc),
labelled as (
    select *, list_concat(cc, gpl, reserved) as places,
           list_concat(
               case when len(cc) > 0 then ['cc-by'] else [] end,
               case when len(gpl) > 0 then ['gpl'] else [] end,
               case when len(reserved) > 0 then ['reserved'] else [] end) as own
    from base)
select doc_id, n_words, len(places) as n_base, list_min(places) - 1 as first_word,
       list_max(places) - 1 as last_word, array_to_string(own, ',') as base_labels,
       array_to_string(list_sort(list_distinct(list_concat(own, coalesce(ls, [])))), ',') as labels,
       cast(greatest(case when len(places) > 0 then 1 else 0 end, coalesce(share, 0)) as double) as score
from labelled left join found using (doc_id)
"""


def _after(state: str, cost: str, edit: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}'}}"


def _least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


def _kept(initial: str) -> str:
    return f"case when not forced and initial = '{initial}' then open else 1000000 end"


# costs and audits read from the front: s0 nothing, s1 a system turn, s2 a user turn last, s3 an assistant turn last
REROLED = "case when forced then 1000000 else 2 + open end"
BEHIND_ROW = {
    "e0": _after("s0", "3", "D"),
    "e1": _least(_after("s1", "3", "D"), _after("s0", _kept("s"), "K")),
    "e2": _least(
        _after("s2", "3", "D"),
        *(_after(s, REROLED, "R") for s in ("s0", "s1", "s3")),
        *(_after(s, _kept("u"), "K") for s in ("s0", "s1", "s3")),
    ),
    "e3": _least(_after("s3", "3", "D"), _after("s2", REROLED, "R"), _after("s2", _kept("a"), "K")),
}
USER_INSERTED = _least("e2", *(_after(s, "2", "I") for s in ("e0", "e1", "e3")))

OP11 = rf"""
with recursive spaced as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
           coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as id
    from conversations),
coded as (
    select *, xor(list_reduce(
        list_prepend(4294967295::bigint, list_transform(string_split(id, ''), lambda c: ord(c)::bigint)),
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda x, y: case when x % 2 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295) % 20 as code
    from spaced),
damaged as (
    select coalesce('=' || conv_id, '') as conv, turn, case when code = 4 then 'user' else role end as role,
           case when code = 1 then '' when code = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
           unnest(case when code = 3 then [0, 1] else [0] end) as copy
    from coded where code <> 0),
placed as (
    select *, row_number() over (partition by conv order by turn nulls first, role, md5(text), copy) as i from damaged),
faulty as (
    select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
        when row_number() over (partition by conv, role, text order by i) > 1 then 'duplicate'
        when regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) not in ('.', '!', '?') then 'truncated'
        end as fault
    from placed),
line as (
    select *, left(role, 1) as initial, coalesce(fault in ('blank', 'duplicate'), false) as forced,
           case when fault = 'truncated' then 1 else 0 end as open,
           lag(left(role, 1)) over (partition by conv order by i) as before
    from faulty),
told as (
    select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
           count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
           count(*) filter (fault = 'truncated') as truncated,
           count(*) filter (before || initial not in ('su', 'ua', 'au')) as illegal, max(i) as n
    from line group by conv),
path as (
    select conv, 0::bigint as i, {{'c': 0, 'a': ''}} as s0, {{'c': 1000000, 'a': ''}} as s1,
           {{'c': 2, 'a': 'I'}} as s2, {{'c': 4, 'a': 'II'}} as s3
    from told
    union all
    select conv, i, e0, e1, f2, {_least("e3", _after("f2", "2", "I"))}
    from (select *, {USER_INSERTED} as f2
          from (select path.conv, line.i, {", ".join(f"{v} as {k}" for k, v in BEHIND_ROW.items())}
                from path join line on line.conv = path.conv and line.i = path.i + 1))),
best as (select conv, {_least("s0", "s3")} as b from path join told using (conv) where path.i = told.n),
edit as (select conv, p, b.a[p] as edit from (select *, unnest(range(1, len(b.a) + 1)) as p from best)),
counted as (
    select *, count(*) filter (edit <> 'I') over upto as i, count(*) filter (edit <> 'D') over upto as e
    from edit window upto as (partition by conv order by p rows unbounded preceding)),
repaired as (
    select counted.conv, p, edit, e, role, text,
           max(case when e = 1 and edit = 'K' and initial = 's' then 1 else 0 end) over (partition by counted.conv) as opens
    from counted left join line on line.conv = counted.conv and line.i = counted.i and edit <> 'I'
    where edit <> 'D'),
hashed as (
    select conv, sha256(string_agg(
        case when edit = 'K' then role when (e - opens) % 2 = 1 then 'user' else 'assistant' end || ':' || coalesce(text, ''),
        chr(10) order by p)) as hash
    from repaired group by conv)
select conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(b.c, 0)::bigint as cost,
       coalesce(b.a, '') as audit, coalesce(hash, sha256('')) as repaired_sha256
from (select distinct conv_id, coalesce('=' || conv_id, '') as conv from conversations)
left join told using (conv) left join best using (conv) left join hashed using (conv)
"""

OP12 = r"""
with word as (
    select coalesce(lang, 'und') as lang, unnest(range(1, len(w) + 1)) as i, w
    from (
        select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
        from (
            select lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) as piece
            from documents))),
total as (select lang, count(*) as n from word group by lang),
gram as (
    select lang, m, array_to_string(w[i:i + m - 1], ' ') as g, count(*) as a
    from word, (select unnest(range(1, 6)) as m) where i + m - 1 <= len(w)
    group by all having count(*) >= 100),
candidate as (select lang, g, m, a, string_split(g, ' ') as w from gram where m > 1),
cut as (
    select lang, g, m, a, array_to_string(w[:k], ' ') as x, array_to_string(w[k + 1:], ' ') as y, k
    from (select *, unnest(range(1, m)) as k from candidate)),
scored as (
    select cut.lang, cut.g, cut.m, cut.a, k, x.a as l, y.a as r, n,
           (1000::hugeint * cut.a * n) // (x.a::hugeint * y.a) as score
    from cut join gram x on x.lang = cut.lang and x.g = cut.x
    join gram y on y.lang = cut.lang and y.g = cut.y join total on total.lang = cut.lang),
lowest as (
    select * from scored qualify row_number() over (partition by lang, g order by score, k) = 1),
inside as (
    select distinct lang, array_to_string(w[s:e], ' ') as g, a
    from (select lang, w, a, m, s, unnest(range(s + 1, m + 1)) as e
          from (select lang, w, a, m, unnest(range(1, m)) as s from candidate))
    where e - s + 1 < m),
ranked as (
    select lang, row_number() over (partition by lang order by score desc, a desc, g) as rank,
           g as phrase, a, l, r, n, score
    from lowest where not exists (
        select 1 from inside where inside.lang = lowest.lang and inside.g = lowest.g and inside.a >= lowest.a))
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked where rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": OP1,
    "op5_ngram_jaccard": OP5,
    "op6_benchmark_decontamination": OP6,
    "op9_license_scans": OP9,
    "op11_conversation_repair": OP11,
    "op12_phrase_collocations": OP12,
}
