"""Query of operator 5 and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorry.llm import minhash


def op5_minhash_tensored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the component of near-duplicates they belong to."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return minhash.near_duplicates(docs).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


SQL = r"""
with recursive w as materialized (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as ws from documents),
s as materialized (
  select doc_id, case when len(ws) = 0 then cast([] as varchar[]) when len(ws) < 5 then [md5(array_to_string(ws, ' '))]
    else list_sort(list_distinct(list_transform(range(1, len(ws) - 3), lambda i: md5(array_to_string(ws[i:i+4], ' '))))) end as sh from w),
c as materialized (select sh, min(doc_id) as rep, len(sh) as n from s where len(sh) > 0 group by sh),
x as materialized (select rep, n, unnest(sh) as h from c),
i as materialized (
  select a.rep as a, b.rep as b, a.n as na, b.n as nb, count(*) as k from x a join x b on a.h = b.h and a.rep < b.rep
   and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) group by all),
l as materialized (select a, b from i where 100 * k >= 85 * (na + nb - k)),
e as materialized (select a, b from l union select b, a from l),
r(id, root) as (select rep, rep from c union select e.b, r.root from r join e on e.a = r.id),
m as (select id, min(root) as root from r group by id)
select s.doc_id, cast(len(s.sh) as bigint) as n_shingles, coalesce(m.root, s.doc_id) as component_id,
       s.doc_id is not distinct from coalesce(m.root, s.doc_id) as kept
from s left join c on len(s.sh) > 0 and s.sh = c.sh left join m on m.id = c.rep
"""
