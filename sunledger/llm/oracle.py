"""Expected results of the corpus queries that SQL can express, for DuckDB over the driver's views."""

from __future__ import annotations

#: Words of the benchmark query, and words of the near-duplicate query.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED = r"[^\x20\x09-\x0D]+"


def _words(pattern: str) -> str:
    return f"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{pattern}')"


ORACLE: dict[str, str] = {
    "op8_decontamination": f"""
with doc as (select doc_id, {_words(WORD)} w from documents),
item as (select cast(item_id as varchar) item_id, {_words(WORD)} w from benchmark),
windows as (select distinct item_id, least(len(w), 10) n, array_to_string(w[k:k + 9], ' ') win
  from item, lateral (select unnest(generate_series(1, greatest(len(w) - 9, 1))) k) where len(w) > 0),
sizes as (select distinct n from windows),
places as (select doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') win from doc, sizes, lateral (select unnest(generate_series(1, len(w) - n + 1)) k)),
hits as (select p.doc_id, p.k, p.n, x.item_id from places p join windows x on x.n = p.n and x.win = p.win),
words_hit as (select doc_id, count(distinct i) n_hit from hits, lateral (select unnest(generate_series(k, k + n - 1)) i) group by 1),
items as (select doc_id, count(distinct item_id) n_items, string_agg(distinct item_id, ',' order by item_id) ids from hits group by 1)
select d.doc_id, cast(coalesce(len(w), 0) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit, cast(coalesce(n_items, 0) as bigint) n_items, sha256(coalesce(ids, '')) items_sha256,
  coalesce(n_hit, 0) > 0 contaminated
from doc d left join words_hit using (doc_id) left join items using (doc_id)""",
    "op9_near_dedup": f"""
with recursive doc as (select doc_id, {_words(SPACED)} w from documents),
shingles as (select distinct doc_id, array_to_string(w[k:k + 4], ' ') s from doc, lateral (select unnest(generate_series(1, greatest(len(w) - 4, 1))) k) where len(w) > 0),
sizes as (select doc_id, count(*) n from shingles group by 1),
shared as (select a.doc_id x, b.doc_id y, count(*) common from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (select x, y from shared join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * common >= 75 * (a.n + b.n - common)),
ways as (select x, y from links union all select y, x from links),
reach as (select doc_id, doc_id low from doc union select w.y, r.low from reach r join ways w on w.x = r.doc_id where r.low < w.y),
least_id as (select doc_id, min(low) component_id from reach group by 1)
select d.doc_id, coalesce(n, 0) n_shingles, component_id, d.doc_id = component_id kept from doc d join least_id using (doc_id) left join sizes using (doc_id)""",
    "op11_substring_dedup": rf"""
with doc as (select doc_id, coalesce(regexp_extract_all(text, '{SPACED}'), []) w from documents),
starts as (select doc_id, k, array_to_string(w[k:k + 12], ' ') win from doc, lateral (select unnest(generate_series(1, len(w) - 12)) k)),
firsts as (select win, min(doc_id) first_doc from starts group by 1),
later as (select doc_id, k from starts join firsts using (win) where doc_id > first_doc),
gone as (select distinct doc_id, i from later, lateral (select unnest(generate_series(k, k + 12)) i)),
word as (select doc_id, unnest(generate_series(1, len(w))) i, unnest(w) x from doc),
kept as (select doc_id, string_agg(x, ' ' order by i) t, count(*) n from word anti join gone using (doc_id, i) group by 1)
select d.doc_id, cast(len(w) as bigint) n_words, cast(len(w) - coalesce(n, 0) as bigint) n_removed, sha256(coalesce(t, '')) kept_sha256 from doc d left join kept using (doc_id)""",
    "op13_ranked_search": f"""
with doc as (select doc_id, {_words(WORD)} w from documents),
asked as (select distinct item_id, unnest({_words(WORD)}) term from benchmark),
tf as (select doc_id, term, count(*) tf from (select doc_id, unnest(w) term from doc) group by 1, 2),
total as (select count(*) n_docs, cast(sum(len(w)) as bigint) n_terms from doc where len(w) > 0),
lengths as (select doc_id, 100 - 50 + (50 * len(w) * n_docs) // n_terms m from doc, total where len(w) > 0),
weights as (select term, cast(floor(1000 * ln(cast(2 * max(n_docs) + 2 as double) / (2 * count(*) + 1))) as bigint) weight from tf, total group by 1),
scores as (select item_id, doc_id, cast(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) score
  from asked join weights using (term) join tf using (term) join lengths using (doc_id) group by 1, 2)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
from scores where score > 0 qualify row_number() over (partition by item_id order by score desc, doc_id) <= 50""",
}
