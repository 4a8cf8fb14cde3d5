"""Query of operator 11 and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lorry.llm import interaction


def op11_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters over all documents, in all 120 orders, for every language."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return interaction.audit(interaction.text_masks(docs, labels), "ABCDE")


SQL = r"""
with f(x) as (select unnest(['A', 'B', 'C', 'D', 'E'])),
o as (select a.x || b.x || c.x || d.x || e.x as filter_order from f a, f b, f c, f d, f e
      where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
t as materialized (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
least_id as (select text, min(doc_id) as lo from t group by text),
m as (select part, len(w) < 200 as a, 100 * len(list_distinct(w)) < 50 * len(w) as b,
             100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) as c, regexp_matches(text, '[#$%&*|]') as d,
             coalesce(t.doc_id > lo, false) as e, coalesce(quality = 1, false) as good, coalesce(toxic = 1, false) as bad
      from t join least_id using (text) left join (select doc_id, max(quality) as quality, max(toxic) as toxic from labels group by doc_id) l on l.doc_id = t.doc_id),
g as materialized (select part, case when a then 'A' else '' end || case when b then 'B' else '' end || case when c then 'C' else '' end
             || case when d then 'D' else '' end || case when e then 'E' else '' end as fails, count(*) as n, count(*) filter (good) as good,
             count(*) filter (bad) as bad from m group by all),
s as materialized (select part, fails, n, good, bad, filter_order,
             (select coalesce(min(strpos(filter_order, y)), 6) from (select unnest(string_split(fails, '')) as y) where y <> '') as gone from g, o),
k as (select filter_order, unnest(range(1, 6)) as step from o),
r as (select s.part, k.filter_order, k.step, sum(case when gone > k.step then n else 0 end) as kept, sum(case when gone = k.step then n else 0 end) as removed,
             sum(case when gone < k.step and contains(fails, k.filter_order[k.step]) then n else 0 end) as redundant,
             sum(case when fails = k.filter_order[k.step] then n else 0 end) as unique_fails,
             sum(case when gone = k.step then good else 0 end) as good_lost, sum(case when gone = k.step then bad else 0 end) as toxic_lost
      from k join s using (filter_order) group by all)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed, cast(redundant as bigint) as redundant,
       cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, filter_order[step]) as bigint) as shapley
from r
"""
