"""Query of the Jaccard join and its check SQL (its reachability is feasible on the small tables)."""

from __future__ import annotations

from delinq.llm.common import table
from delinq.llm.jaccard_groups import cluster
from delinq.llm.registry import register

SQL = r"""
with recursive words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
shingle as materialized (select distinct doc_id, hash(s) as s from (select doc_id,
  unnest(case when len(w) >= 5 then list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))
  when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from words)),
size as materialized (select doc_id, count(*) as n from shingle group by doc_id),
pair as materialized (select a.doc_id as a, b.doc_id as b, count(*) as n from shingle a join shingle b on a.s = b.s and a.doc_id <> b.doc_id
  group by 1, 2),
linked as materialized (select a, b from pair join size x on x.doc_id = a join size y on y.doc_id = b
  where 100 * pair.n >= 75 * (x.n + y.n - pair.n)),
reach as (select doc_id as a, doc_id as b from size union select reach.a, linked.b from reach join linked on linked.a = reach.b)
select doc_id, coalesce(size.n, 0) as n_shingles, coalesce(c, doc_id) as component_id
from documents left join size using (doc_id) left join (select a as doc_id, min(b) as c from reach group by a) using (doc_id)
"""


@register("op6_jaccard_groups", SQL)
def op6(spark, sf_dir):
    return cluster(table(spark, sf_dir, "documents").select("doc_id", "text"))
