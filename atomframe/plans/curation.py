"""Queries on choosing, indexing and splitting frames: orders by customer are the frames of a system."""

from __future__ import annotations

from pyspark.sql import functions as F

from atomframe.functions import expressions as X
from atomframe.operators import index, select
from atomframe.session import table


def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


def frame_index(spark, sf_dir):
    return index.global_index(orders(spark, sf_dir).select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"])


INDEX_SQL = "select o_custkey, o_orderkey, row_number() over (order by o_custkey, o_orderkey) - 1 as frame_index from orders"


def first_n_per_group(spark, sf_dir):
    return index.first_per_group(orders(spark, sf_dir).select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"], 3)


FIRST_SQL = "select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderkey) <= 3"


def even_sample(spark, sf_dir):
    return index.even_sample(orders(spark, sf_dir).select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"], 4)


EVEN_SQL = """
with o as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey) - 1 as i, count(*) over (partition by o_custkey) as n from orders)
select o_custkey, o_orderkey from o where n <= 4 or i in (0, (n - 1) // 3, 2 * (n - 1) // 3, n - 1)
"""


def train_test_split(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", "lang", "doc_id")
    return index.train_test_split(d, ["source", "lang"], "doc_id", ratio=0.1, seed=7)


SPLIT_BODY = """
with d as (select source, lang, doc_id, md5('7/' || source || '/' || lang || '/' || doc_id) as k from documents),
r as (select *, row_number() over (partition by source, lang order by k, doc_id) - 1 as i, count(*) over (partition by source, lang) as n from d),
s as (select source, lang, doc_id, case when i < case when n <= 1 then 0 else least(greatest(round_even(n * 0.1, 0), 1), n - 1) end then 'test' else 'train' end as role from r)
"""
SPLIT_SQL = SPLIT_BODY + "select * from s"


def split_summary(spark, sf_dir):
    return index.split_summary(train_test_split(spark, sf_dir), "source")


SPLIT_SUMMARY_SQL = SPLIT_BODY + """
select source, grouping(source)::int as is_total, count(*) as frames_total, count(*) filter (role = 'train') as frames_train, count(*) filter (role = 'test') as frames_test
from s group by rollup (source)
"""


def exclusion_antijoin(spark, sf_dir):
    """Orders of an order with a return, or of a customer whose name ends in 7, are already selected."""
    o = orders(spark, sf_dir).select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' and l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"), F.lit(None).cast("long").alias("o_custkey"))
    c = table(spark, sf_dir, "customer").where("c_custkey % 10 = 7").select(F.lit(None).cast("long").alias("o_orderkey"), F.col("c_custkey").alias("o_custkey"))
    both = li.unionByName(c)
    s = both.select(F.col("o_orderkey").cast("string").alias("task_key"), F.col("o_custkey").cast("string").alias("source_path"))
    t = o.select("o_orderkey", F.col("o_orderkey").cast("string").alias("task_key"), F.col("o_custkey").cast("string").alias("source_path"))
    return select.excluded(t, s, "task_key", "source_path").select("o_orderkey", "reason")


EXCLUSION_SQL = """
select o_orderkey, case when o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R' and l_quantity > 45) then 'matched_task_key'
  when o_custkey % 10 = 7 then 'matched_source_path' end as reason from orders
"""


def selection_funnel(spark, sf_dir):
    rows = exclusion_antijoin(spark, sf_dir).select(F.when(F.col("reason") == "matched_task_key", F.col("reason")).alias("a"), F.when(F.col("reason") == "matched_source_path", F.col("reason")).alias("b"))
    return select.funnel(rows, "a", "b", most=5000)


FUNNEL_SQL = f"""
with r as ({EXCLUSION_SQL})
select count(*) as discovered, count(*) filter (reason is null or reason <> 'matched_task_key') as after_campaign, count(*) filter (reason is null) as after_list,
  least(count(*) filter (reason is null), 5000) as selected from r
"""


def _runs(spark, sf_dir):
    return orders(spark, sf_dir).where("o_orderkey % 3 <> 0").select((F.col("o_orderkey") % 2000).alias("k"), "o_orderkey", F.concat(F.lit("run/"), "o_orderkey").alias("path"), F.col("o_orderstatus").alias("status"))


def record_overlay(spark, sf_dir):
    """The last run record of a key, overlaid by pool records (events): their path wins, pool-only rows are planned."""
    runs = select.last_wins(_runs(spark, sf_dir), ["k"], ["o_orderkey"])
    pool = select.last_wins(table(spark, sf_dir, "events").where("event_type = 'click'").select((F.col("event_id") % 2500).alias("k"), "event_id", F.concat(F.lit("pool/"), "event_id").alias("path")), ["k"], ["event_id"])
    return select.overlay(runs, pool, ["k"], "path", "status")


OVERLAY_SQL = """
with r as (select o_orderkey % 2000 as k, arg_max('run/' || o_orderkey, o_orderkey) as path, arg_max(o_orderstatus, o_orderkey) as status from orders where o_orderkey % 3 <> 0 group by 1),
p as (select event_id % 2500 as k, arg_max('pool/' || event_id, event_id) as path from events where event_type = 'click' group by 1)
select coalesce(r.k, p.k) as k, coalesce(p.path, r.path) as path, coalesce(r.status, 'planned') as status from r full join p on r.k = p.k
"""


def new_candidates(spark, sf_dir):
    """Customers overridden by live orders, without those that have an urgent order."""
    o = orders(spark, sf_dir)
    manifest = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.lit("manifest").alias("origin"))
    live = o.where("o_orderpriority = '5-LOW'").select(F.col("o_custkey").alias("k"), F.lit("live").alias("origin")).distinct()
    campaign = o.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("k"))
    return select.new_candidates(manifest, live, campaign, ["k"])


CANDIDATES_SQL = """
select k, case when bool_or(origin = 'live') then 'live' else 'manifest' end as origin
from (select c_custkey as k, 'manifest' as origin from customer union all select o_custkey, 'live' from orders where o_orderpriority = '5-LOW')
where k not in (select o_custkey from orders where o_orderpriority = '1-URGENT') group by k
"""


def stride_selection(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return select.stride_by_name(c, "c_name", 7)


STRIDE_SQL = "select c_custkey, c_name from customer where (cast(regexp_extract(c_name, '([0-9]+)$', 1) as bigint) - 1) % 7 = 0"


def frame_selection(spark, sf_dir):
    placed = index.numbered_within(orders(spark, sf_dir).select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"], "i")
    return select.select_frames(placed, "o_custkey", "i", stride=3, start=1, most=2)


FRAMES_SQL = """
with o as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey) - 1 as i, count(*) over (partition by o_custkey) as n from orders)
select o_custkey, o_orderkey, i from (select * from o where (i >= 1 and (i - 1) % 3 = 0) or (n = 1 and i = 0)) qualify row_number() over (partition by o_custkey order by i) <= 2
"""


def natural_sort_topn(spark, sf_dir):
    names = table(spark, sf_dir, "supplier").select(F.concat(F.lit("system_"), F.col("s_suppkey")).alias("system"), F.when(F.col("s_suppkey") % 9 != 0, F.concat(F.lit("frame_"), F.col("s_suppkey") * 7 % 50)).otherwise("none").alias("frame"))
    return select.natural_top(names, "system", "frame", 20)


NATURAL_SQL = """
with s as (select 'system_' || s_suppkey as system, case when s_suppkey % 9 <> 0 then 'frame_' || (s_suppkey * 7 % 50) else 'none' end as frame, s_suppkey from supplier)
select system, frame from s order by s_suppkey, frame limit 20
"""


def union_of_sources(spark, sf_dir):
    """Keys of three lists, each once, from the first list that has it."""
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("k")).agg(F.lit("lineitem").alias("origin"))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.lit("part").alias("origin"))
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("k"), F.lit("events").alias("origin")).distinct()
    return select.union_distinct(events, li, part, on=["k"])


UNION_SQL = """
select k, case min(o) when 0 then 'events' when 1 then 'lineitem' else 'part' end as origin
from (select user_id as k, 0 as o from events union all select l_partkey, 1 from lineitem union all select p_partkey, 2 from part) group by k
"""


def capped_examples(spark, sf_dir):
    return select.capped_examples(orders(spark, sf_dir), ["o_orderstatus", "o_orderpriority"], ["o_orderkey"], "o_orderkey", 5)


EXAMPLES_SQL = """
select o_orderstatus, o_orderpriority, list(o_orderkey order by o_orderkey) as examples
from (select * from orders qualify row_number() over (partition by o_orderstatus, o_orderpriority order by o_orderkey) <= 5) group by 1, 2
"""


def member_names(spark, sf_dir):
    return select.member_names(table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey"), "s_nationkey", ["s_suppkey"])


MEMBERS_SQL = "select s_nationkey, s_suppkey, 'task_' || lpad(cast(row_number() over (partition by s_nationkey order by s_suppkey) as varchar), 3, '0') as member from supplier"


def task_keys_from_paths(spark, sf_dir):
    """Task keys of paths made from page addresses, with their slugs."""
    p = table(spark, sf_dir, "pages").select("page_id", "url", F.concat(F.lit("/data/"), F.when(F.col("page_id") % 4 != 0, F.concat(F.lit("system_"), F.col("page_id") % 9, F.lit("/frame_"), F.col("page_id"))).otherwise("loose"), F.lit("/POSCAR")).alias("path"))
    return p.select("page_id", X.task_key("path").alias("task_key"), X.slug("url").alias("slug"))


KEYS_SQL = r"""
select page_id, case when page_id % 4 <> 0 then 'system_' || (page_id % 9) || '/frame_' || page_id else '' end as task_key,
  trim(regexp_replace(lower(url), '[^a-z0-9]+', '_', 'g'), '_') as slug from pages
"""

QUERIES = {f.__name__: f for f in (frame_index, first_n_per_group, even_sample, train_test_split, split_summary, exclusion_antijoin, selection_funnel, record_overlay, new_candidates, stride_selection, frame_selection, natural_sort_topn, union_of_sources, capped_examples, member_names, task_keys_from_paths)}
ORACLES = dict(zip(QUERIES, (INDEX_SQL, FIRST_SQL, EVEN_SQL, SPLIT_SQL, SPLIT_SUMMARY_SQL, EXCLUSION_SQL, FUNNEL_SQL, OVERLAY_SQL, CANDIDATES_SQL, STRIDE_SQL, FRAMES_SQL, NATURAL_SQL, UNION_SQL, EXAMPLES_SQL, MEMBERS_SQL, KEYS_SQL), strict=True))
