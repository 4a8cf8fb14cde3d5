"""Query of operator 13 and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lorry.llm import fim
from lorry.session import stage


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents stored as frames, cut between lines and put in fill-in-middle order."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    stored = stage(fim.store(docs), "frames")
    return fim.digests(fim.transform(fim.choose(stored)))


SQL = r"""
with d as (select doc_id, coalesce(text, '') as text, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
u as (select *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') as units,
             cast('0x' || h[1:8] as bigint) as h1, cast('0x' || h[9:16] as bigint) as h2, cast('0x' || h[17:24] as bigint) as h3,
             cast('0x' || h[25:32] as bigint) as h4 from d),
c as (select *, cast(len(units) as bigint) as n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) as lo,
             greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) as hi,
             case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 100 then 'plain'
                  when h4 % 100 < 50 then 'spm' else 'psm' end as form from u),
p as (select doc_id, text, n, form, array_to_string(units[1:lo], '') as a, array_to_string(units[lo + 1:hi], '') as m,
             array_to_string(units[hi + 1:n], '') as z from c)
select doc_id, n, form, case when form <> 'plain' then cast(length(a) as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || a || '<S>' || z || '<M>' || m
                        else '<S>' || z || '<P>' || a || '<M>' || m end) as output_sha256,
       sha256(text) as restored_sha256
from p
"""
