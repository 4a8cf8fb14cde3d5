"""Query of operator 12 and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorry.llm import recompress


def op12_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the windows of 50 words that smaller documents have."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return recompress.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
with d as materialized (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
p as (select doc_id, w, unnest(range(1, len(w) - 48)) as pos from d),
g as materialized (select doc_id, pos, sha256(array_to_string(w[pos:pos + 49], ' ')) as s from p),
f as materialized (select s, min(doc_id) as first from g group by s having min(doc_id) < max(doc_id)),
m as materialized (select distinct g.doc_id, unnest(range(g.pos, g.pos + 50)) as k from g join f using (s) where f.first < g.doc_id),
r as (select doc_id, list(k) as gone from m group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(gone), 0) as bigint) as n_removed,
       sha256(case when gone is null then array_to_string(w, ' ')
                   else array_to_string(list_filter(w, lambda x, i: not list_contains(gone, i)), ' ') end) as kept_sha256
from d left join r using (doc_id)
"""
