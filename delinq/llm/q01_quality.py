"""Query of the quality rules and its check SQL."""

from __future__ import annotations

from delinq.llm import quality_lines
from delinq.llm.common import table
from delinq.llm.registry import register

_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"

SQL = rf"""
with docs as (select doc_id, coalesce(text, '') as text, coalesce('=' || source, '') as host from documents),
words as (select doc_id, text, host, regexp_extract_all(text, '{_WORD}') as w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as lines from docs),
windows as (select doc_id, i, count(*) over (partition by doc_id, list_slice(w, i, i + 7)) as n
  from (select doc_id, w, unnest(generate_series(1, len(w) - 7)) as i from words where len(w) >= 8)),
covered as (select doc_id, sum(least(8, i - before)) as n_repeat_words
  from (select doc_id, i, coalesce(lag(i) over (partition by doc_id order by i), -100) as before from windows where n > 1)
  group by doc_id),
line as (select doc_id, host, line_no, text as doc_key, len(regexp_extract_all(x, '{_WORD}')) as n,
  lower(trim(regexp_replace(regexp_replace(x, '{_SPACE}', ' ', 'g'), '[0-9]+', '0', 'g'))) as norm
  from (select doc_id, text, host, lines, unnest(lines) as x, unnest(range(len(lines))) as line_no from words)),
hosts as (select host, count(distinct text) as host_docs from docs group by host),
frequent as (select host, norm from line group by host, norm having count(distinct doc_key) > 10),
over_limit as (select host, norm from line join frequent using (host, norm) join hosts using (host)
  group by host, norm, host_docs having count(distinct doc_key) > host_docs * 0.005::double),
lost as (select doc_id, sum(n) as removed_words from line join over_limit using (host, norm) group by doc_id)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_words,
  not base_failed and removed_words <= 0.5 * n_words as kept
from (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed
  from (select doc_id, len(w) as n_words, len(array_to_string(w, '')) as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines,
    cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words, cast(coalesce(removed_words, 0) as bigint) as removed_words
    from words left join covered using (doc_id) left join lost using (doc_id)))
"""


@register("op1_quality_lines", SQL)
def op1(spark, sf_dir):
    return quality_lines.assess(table(spark, sf_dir, "documents"))
