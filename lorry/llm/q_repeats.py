"""Query of operator 8 and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorry.llm import repeats


def op8_run_length_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the byte strings that smaller documents have."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return repeats.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
with d as materialized (select doc_id, hex(encode(coalesce(text, ''))) as hx from documents),
w as materialized (select doc_id, unnest(range(0, len(hx) // 2 - 49)) as p, hx from d),
g as materialized (select doc_id, p, substr(hx, 2 * p + 1, 100) as s from w),
f as materialized (select s, min(doc_id) as first from g group by s),
m as materialized (select g.doc_id, g.p from g join f using (s) where f.first < g.doc_id),
n as (select *, case when p - lag(p) over (partition by doc_id order by p) <= 50 then 0 else 1 end as cut from m),
r as (select *, sum(cut) over (partition by doc_id order by p) as run from n),
x as materialized (select doc_id, run, min(p) as lo, max(p) + 50 as hi from r group by all),
y as (select doc_id, lo, hi, coalesce(lag(hi) over (partition by doc_id order by lo), 0) as before from x),
k as (select d.doc_id, string_agg(substr(hx, 2 * before + 1, 2 * (lo - before)), '' order by lo) || substr(any_value(hx), 2 * max(hi) + 1) as kept,
             sum(hi - lo) as removed, count(*) as spans from d join y using (doc_id) group by d.doc_id)
select d.doc_id, cast(len(hx) // 2 as bigint) as n_bytes, cast(coalesce(k.removed, 0) as bigint) as n_removed,
       coalesce(k.spans, 0) as n_spans, sha256(unhex(coalesce(k.kept, hx))) as kept_sha256
from d left join k using (doc_id)
"""
