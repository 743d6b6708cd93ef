"""Query of the filter audit and its check SQL, which walks every order step by step."""

from __future__ import annotations

from delinq.llm.common import table
from delinq.llm.filter_audit import audit, failures
from delinq.llm.registry import register

SQL = r"""
with base as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
failed as materialized (select part, case when len(w) < 50 then 'A' else '' end
  || case when 100 * len(list_distinct(w)) < 65 * len(w) then 'B' else '' end
  || case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) then 'C' else '' end
  || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
  || case when min(doc_id) over (partition by t) < doc_id then 'E' else '' end as f,
  coalesce(l.quality = 1, false)::int as good, coalesce(l.toxic = 1, false)::int as toxic
  from base left join labels l using (doc_id)),
cell as materialized (select part, f, count(*) as n, sum(good) as good, sum(toxic) as toxic from failed group by 1, 2),
letter as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
ordering as (select a.x || b.x || c.x || d.x || e.x as o from letter a join letter b on b.x <> a.x
  join letter c on c.x not in (a.x, b.x) join letter d on d.x not in (a.x, b.x, c.x) join letter e on e.x not in (a.x, b.x, c.x, d.x)),
walk as (select part, o as filter_order, s::int as step, o[s:s] as x, n, good, toxic, f,
  contains(f, o[s:s]) as hit, length(translate(f, o[1:s - 1], '')) < length(f) as gone
  from cell cross join ordering cross join (select unnest([1, 2, 3, 4, 5]) as s)),
stepped as (select part, filter_order, step, x,
  coalesce(sum(n) filter (where not hit and not gone), 0)::bigint as kept,
  coalesce(sum(n) filter (where hit and not gone), 0)::bigint as removed,
  coalesce(sum(n) filter (where hit and gone), 0)::bigint as redundant,
  coalesce(sum(n) filter (where f = x), 0)::bigint as unique_fails,
  coalesce(sum(good) filter (where hit and not gone), 0)::bigint as good_lost,
  coalesce(sum(toxic) filter (where hit and not gone), 0)::bigint as toxic_lost from walk group by 1, 2, 3, 4)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, x))::bigint as shapley from stepped
"""


@register("op12_filter_audit", SQL)
def op12(spark, sf_dir):
    return audit(failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
