"""Query of the chat format and its check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from delinq.llm.chat_grammar import format_conversations, loss_text, parse
from delinq.llm.common import table
from delinq.llm.registry import register

SQL = r"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from
  (select conv_id, turn, role, text from conversations
   union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
shaped as (select *, case role when 'system' then ' <</SYS>>' when 'user' then ' [/INST]' when 'assistant' then ' </s>'
  else ' [/ROLE]' end as closing, case role when 'system' then 17 when 'user' then 15 when 'assistant' then 11
  else 22 + length(role) end as marks,
  length(text) + 3 * length(regexp_extract_all(text, '</?s(?::[12])?>|<</?SYS>>'))
  + 4 * length(regexp_extract_all(text, '\[/?INST\]|\[ANS\]|\[/?ROLE\]|\[SAYS\]')) as escaped from t)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text)) as loss_sha256,
  cast(case when bool_or(strpos(text || closing, closing) <= length(text)) then 5 + sum(escaped + marks)
    else 3 + sum(length(text) + marks) end as bigint) as formatted_chars
from shaped group by conv_id
"""


@register("op2_chat_grammar", SQL)
def op2(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    collides = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    out = format_conversations(said.unionByName(collides))
    turns = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = out.select(
        "conv_id",
        parse(F.col("formatted")).alias("_turns"),
        loss_text(F.col("formatted"), F.col("loss_mask")).alias("_loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    return read.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(F.array_join(turns, ""), "UTF-8"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("_loss", "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
