"""DuckDB SQL for the duplicate searches over words: every pair that shares a shingle, and
every window, written out."""

from tidemark.llm.source_audit import LOWER, UPPER

#: For minhash_dedup.link_documents() with its defaults over documents.
LINK_TEXTS_SQL = f"""
with recursive w as (
    select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from documents
), s as materialized (
    select doc_id, unnest(list_distinct(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
                                             else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end)) as sh from w
), n as (
    select doc_id, count(*) as n from s group by doc_id
), p as (
    select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.sh = b.sh where a.doc_id <> b.doc_id group by a.doc_id, b.doc_id
), l as materialized (
    select p.a, p.b from p join n x on p.a = x.doc_id join n y on p.b = y.doc_id where 100 * p.c >= 75 * (x.n + y.n - p.c)
), reach(doc_id, other) as (
    select doc_id, doc_id from documents
    union
    select r.doc_id, l.b from reach r join l on r.other = l.a
), c as (
    select doc_id, min(other) as component_id from reach group by doc_id
)
select c.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c.component_id, c.doc_id = c.component_id as kept from c left join n on c.doc_id = n.doc_id
"""

#: For substring_dedup.strip_repeated() without texts over documents.
STRIP_SQL = """
with w as (
    select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from documents
), places as (
    select doc_id, ws, unnest(range(1, len(ws) - 18)) as i from w where len(ws) >= 20
), windows as (
    select doc_id, i, row_number() over (partition by array_to_string(ws[i:i + 19], ' ') order by doc_id, i) as nth from places
), gone as (
    select distinct doc_id, i + k as at from windows, unnest(range(0, 20)) as r(k) where nth > 1
), words as (
    select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as at from w
), kept as (
    select x.doc_id, string_agg(x.word, ' ' order by x.at) as text from words x
    where not exists (select 1 from gone g where g.doc_id = x.doc_id and g.at = x.at) group by x.doc_id
), removed as (
    select doc_id, count(*) as n from gone group by doc_id
)
select w.doc_id, len(w.ws)::bigint as n_words, coalesce(r.n, 0)::bigint as n_removed, sha256(coalesce(k.text, '')) as kept_sha256
from w left join removed r on w.doc_id = r.doc_id left join kept k on w.doc_id = k.doc_id
"""
