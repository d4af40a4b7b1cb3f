"""The engine's operators applied to the driver's tables, each beside an equivalent DuckDB query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimloom.functions import text as tx
from claimloom.functions import values as vl
from claimloom.operators import relational as rel
from claimloom.operators.scans import scan

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function under its own name, with its oracle."""

    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def cents(x) -> F.Column:
    return F.col(x).cast("decimal(18,2)") if isinstance(x, str) else x.cast("decimal(18,2)")


# --- identity and text -----------------------------------------------------------------------------------


@query(r"""select doc_id, 'clm_' || substr(sha256(source || chr(10) || trim(regexp_replace(nfc_normalize(text), '\s+', ' ', 'g'))), 1, 16) as claim_id from documents""")
def q01_doc_identity(spark, sf):
    return t(spark, sf, "documents").select("doc_id", tx.claim_id("source", "text").alias("claim_id"))


@query(r"""with n as (select doc_id, trim(regexp_replace(regexp_replace(lower(trim(regexp_replace(nfc_normalize(text), '\s+', ' ', 'g'))), '[\p{P}\p{S}]+', ' ', 'g'), '\s+', ' ', 'g')) as v from documents)
select doc_id, length(v)::int as n_chars, md5(v) as digest from n""")
def q02_doc_normalize(spark, sf):
    return t(spark, sf, "documents").select("doc_id", tx.normalize_claim("text").alias("v")).select("doc_id", F.length("v").alias("n_chars"), F.md5("v").alias("digest"))


#: Marker words by language: (contested, hedging).
LEXICON = {"en": (["from", "not"], ["with", "for"]), "fr": (["pas", "qui"], ["pour", "sur"]), "de": (["nicht", "dem"], ["mit", "von"]), "es": (["del", "por"], ["para", "con"])}


def _marker_oracle() -> str:
    count = lambda i: "case lang " + " ".join(f"when '{k}' then len(regexp_extract_all(text, '(?i)\\b(?:{'|'.join(v[i])})\\b'))" for k, v in LEXICON.items()) + " else 0 end"
    return f"""select doc_id, {count(0)}::int as n_contested, {count(1)}::int as n_hedges,
        case when n_contested > 0 then 'contested' when n_hedges > 0 then 'qualified' else 'unqualified' end as wording from documents"""


@query(_marker_oracle())
def q03_marker_basis(spark, sf):
    count = lambda i: vl.ladder([(F.col("lang") == k, F.size(tx.markers("text", v[i]))) for k, v in LEXICON.items()], 0)
    rows = t(spark, sf, "documents").select("doc_id", count(0).alias("n_contested"), count(1).alias("n_hedges"))
    return rows.withColumn("wording", vl.ladder([(F.col("n_contested") > 0, "contested"), (F.col("n_hedges") > 0, "qualified")], "unqualified"))


# --- scores, ladders, caps -------------------------------------------------------------------------------

_SCORES = "select c.c_custkey, coalesce(least(100, 5 * floor(sum(o_totalprice::decimal(18,2))::double / 300000)), 0)::int as score from customer c left join orders o on o.o_custkey = c.c_custkey group by 1"


def _customer_scores(spark, sf):
    spent = t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(cents("o_totalprice")).cast("double").alias("spent"))
    return t(spark, sf, "customer").select("c_custkey").join(spent, "c_custkey", "left").select("c_custkey", F.coalesce(F.least(F.lit(100), 5 * F.floor(F.col("spent") / 300000)), F.lit(0)).cast("int").alias("score"))


@query(f"""with s as ({_SCORES}), l as (select case when score >= 85 then 'high_trust' when score >= 70 then 'moderate_trust' when score >= 50 then 'low_trust' else 'critical_or_unreliable' end as label from s)
select v.label, (select count(*) from l where l.label = v.label) as n from (values ('high_trust'), ('moderate_trust'), ('low_trust'), ('critical_or_unreliable')) v(label)""")
def q04_label_bands(spark, sf):
    labelled = _customer_scores(spark, sf).select(vl.band_label(F.col("score")).alias("label"))
    return rel.zero_filled_counts(labelled, "label", vl.LABELS)


@query("""select c_mktsegment, round(avg(c_acctbal), 4) as mean, min(c_acctbal) as low, max(c_acctbal) as high, count(*) filter (c_acctbal < 0) as n_capped from customer group by 1""")
def q05_summary_stats(spark, sf):
    return t(spark, sf, "customer").groupBy("c_mktsegment").agg(F.round(F.avg("c_acctbal"), 4).alias("mean"), F.min("c_acctbal").alias("low"), F.max("c_acctbal").alias("high"), F.count_if(F.col("c_acctbal") < 0).alias("n_capped"))


_ORDER_FACTS = """select o_orderkey, o_orderstatus, o_orderpriority, count(l_orderkey) as n_lines, count(*) filter (l_returnflag = 'R') as n_returned,
    count(distinct l_suppkey) as n_suppliers, coalesce(max(l_discount), 0) as max_discount from orders left join lineitem on l_orderkey = o_orderkey group by 1, 2, 3"""


def _order_facts(spark, sf):
    lines = t(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n_lines"), F.count_if(F.col("l_returnflag") == "R").alias("n_returned"), F.count_distinct("l_suppkey").alias("n_suppliers"), F.max("l_discount").alias("max_discount"))
    return t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").fillna(0, ["n_lines", "n_returned", "n_suppliers", "max_discount"])


@query(f"""with f as ({_ORDER_FACTS}) select o_orderkey,
    case when n_lines = 0 then 0 when n_returned = n_lines then 1 when n_returned > 0 then 2 when n_suppliers < 2 then 3 else 4 end as score,
    case when n_lines = 0 then 'R0_NO_SUPPORT' when n_returned = n_lines then 'R1_ALL_RETURNED' when n_returned > 0 then 'R2_SOME_RETURNED' when n_suppliers < 2 then 'R3_SINGLE_GROUP' else 'R4_CONVERGENT' end as rule_id from f""")
def q06_rule_ladder(spark, sf):
    facts = _order_facts(spark, sf)
    rule = lambda score, rule_id: F.struct(F.lit(score).alias("score"), F.lit(rule_id).alias("rule_id"))
    chosen = vl.ladder(
        [(F.col("n_lines") == 0, rule(0, "R0_NO_SUPPORT")), (F.col("n_returned") == F.col("n_lines"), rule(1, "R1_ALL_RETURNED")), (F.col("n_returned") > 0, rule(2, "R2_SOME_RETURNED")), (F.col("n_suppliers") < 2, rule(3, "R3_SINGLE_GROUP"))],
        rule(4, "R4_CONVERGENT"),
    )
    return facts.select("o_orderkey", chosen.alias("r")).select("o_orderkey", "r.*")


CAPS = ["no_lines", "returned_lines", "deep_discount", "urgent_open"]


@query(f"""with f as ({_ORDER_FACTS}), r as (select o_orderkey, concat_ws(',', case when n_lines = 0 then 'no_lines' end, case when n_returned > 0 then 'returned_lines' end,
    case when max_discount >= 0.1 then 'deep_discount' end, case when o_orderpriority = '1-URGENT' and o_orderstatus = 'O' then 'urgent_open' end) as reasons, least(100, 20 * n_lines) as raw from f)
select o_orderkey, reasons, raw::int as raw_score, (case when reasons <> '' then least(raw, 60) else raw end)::int as score from r""")
def q07_cap_reasons(spark, sf):
    hit = [F.col("n_lines") == 0, F.col("n_returned") > 0, F.col("max_discount") >= 0.1, (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")]
    found = F.array_compact(F.array(*[F.when(c, name) for c, name in zip(reversed(hit), reversed(CAPS))]))
    rows = _order_facts(spark, sf).select("o_orderkey", F.array_join(vl.chosen_in_order(found, CAPS), ",").alias("reasons"), F.least(F.lit(100), 20 * F.col("n_lines")).cast("int").alias("raw_score"))
    return rows.withColumn("score", F.when(F.col("reasons") != "", F.least("raw_score", F.lit(60))).otherwise(F.col("raw_score")))


# --- predicates over groups ------------------------------------------------------------------------------


@query("select distinct l_orderkey as o_orderkey from lineitem where l_returnflag = 'R'")
def q08_exists_filter(spark, sf):
    """An existential over an order's lines is the distinct keys of the lines that meet it; the filter reaches the scan."""
    return t(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()


@query("select l_orderkey as o_orderkey, count(*) as n_lines from lineitem group by 1 having bool_and(l_discount <= 0.05)")
def q09_atom_coverage(spark, sf):
    return t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_lines"), F.bool_and(F.col("l_discount") <= 0.05).alias("all_hold")).where("all_hold").drop("all_hold")


@query("""with g as (select l_orderkey, count(distinct s_nationkey) as n_groups from lineitem join supplier on s_suppkey = l_suppkey group by 1)
select l_partkey as p_partkey, min(n_groups) as least_groups, max(n_groups) as most_groups from lineitem join g using (l_orderkey) group by 1""")
def q10_independence(spark, sf):
    lines = t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    groups = lines.join(t(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).groupBy("l_orderkey").agg(F.count_distinct("s_nationkey").alias("n_groups"))
    return lines.join(groups, "l_orderkey").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min("n_groups").alias("least_groups"), F.max("n_groups").alias("most_groups"))


_MEMBERS = "select distinct l_orderkey, s_suppkey, s_nationkey from lineitem join supplier on s_suppkey = l_suppkey"


def _order_suppliers(spark, sf):
    lines = t(spark, sf, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("s_suppkey"))
    lines = lines.repartition(rel.parts_for(lines.count()), "l_orderkey")  # rows are told apart in tasks of a size
    return lines.join(t(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey").select("l_orderkey", "s_suppkey", "s_nationkey").distinct()


@query(f"""with m as ({_MEMBERS}) select a.s_suppkey as left_id, b.s_suppkey as right_id, count(*) as n_orders from m a join m b on a.l_orderkey = b.l_orderkey and a.s_suppkey < b.s_suppkey and a.s_nationkey <> b.s_nationkey group by 1, 2""")
def q11_shared_author_pairs(spark, sf):
    return rel.co_members(_order_suppliers(spark, sf), "l_orderkey", "s_suppkey", "n_orders", differ="s_nationkey")


@query("select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey)")
def q12_missing_edges(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey").join(t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("""select 'documents without label' as relation, count(*) as n_dangling from documents where doc_id not in (select doc_id from labels)
union all select 'labels without document', count(*) from labels where doc_id not in (select doc_id from documents)
union all select 'lines without order', count(*) from lineitem where l_orderkey not in (select o_orderkey from orders)""")
def q13_fk_dangling(spark, sf):
    docs, labels, lines, orders = (t(spark, sf, x) for x in ("documents", "labels", "lineitem", "orders"))
    checks = [("documents without label", docs, "doc_id", labels, "doc_id"), ("labels without document", labels, "doc_id", docs, "doc_id"), ("lines without order", lines, "l_orderkey", orders, "o_orderkey")]
    return rel.dangling(checks)


# --- stored against derived, versions --------------------------------------------------------------------


@query("""with s as (select l_orderkey, sum((l_extendedprice * (1 - l_discount) * (1 + l_tax))::decimal(18,4)) as total from lineitem group by 1),
c as (select case when total is null then 'missing' when abs(total - o_totalprice::decimal(18,4)) < 0.01 then 'match' else 'mismatch' end as status from orders left join s on l_orderkey = o_orderkey)
select v.status, (select count(*) from c where c.status = v.status) as n from (values ('match'), ('mismatch'), ('missing')) v(status)""")
def q14_derived_artifact_diff(spark, sf):
    total = t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum((F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).cast("decimal(18,4)")).alias("total"))
    near = F.abs(F.col("total") - F.col("o_totalprice").cast("decimal(18,4)")) < 0.01
    status = vl.ladder([(F.col("total").isNull(), "missing"), (near, "match")], "mismatch")
    return rel.zero_filled_counts(t(spark, sf, "orders").join(total, "o_orderkey", "left").select(status.alias("status")), "status", ["match", "mismatch", "missing"])


_VERSIONS = """with a as (select o_orderkey as id, o_orderstatus as s, o_totalprice::decimal(18,2) as p from orders where o_orderkey % 5 <> 0),
b as (select o_orderkey as id, case when o_orderkey % 11 = 0 then 'X' else o_orderstatus end as s, (o_totalprice + case when o_orderkey % 3 = 0 then 1 else 0 end)::decimal(18,2) as p from orders where o_orderkey % 7 <> 0)"""


def _versions(spark, sf):
    orders = t(spark, sf, "orders")
    key = F.col("o_orderkey")
    before = orders.where(key % 5 != 0).select(key.alias("id"), F.col("o_orderstatus").alias("s"), cents("o_totalprice").alias("p"))
    after = orders.where(key % 7 != 0).select(key.alias("id"), F.when(key % 11 == 0, "X").otherwise(F.col("o_orderstatus")).alias("s"), cents(F.col("o_totalprice") + F.when(key % 3 == 0, 1).otherwise(0)).alias("p"))
    return before, after


@query(_VERSIONS + """, d as (select case when a.id is null then 'added' when b.id is null then 'removed' when a.s = b.s and a.p = b.p then 'unchanged' else 'modified' end as status,
    a.id is not null and b.id is not null and a.p <> b.p as price_changed, a.id is not null and b.id is not null and a.s <> b.s as status_changed from a full join b on a.id = b.id)
select v.status, count(d.status) as n, count(*) filter (d.price_changed) as n_price, count(*) filter (d.status_changed) as n_status from (values ('added'), ('removed'), ('modified'), ('unchanged')) v(status) left join d on d.status = v.status group by 1""")
def q15_version_diff(spark, sf):
    compared = rel.version_diff(*_versions(spark, sf), key="id", fields=["s", "p"])
    counts = compared.groupBy("status").agg(F.count("*").alias("n"), F.count_if("p_changed").alias("n_price"), F.count_if("s_changed").alias("n_status"))
    return rel.fill_dimension(counts, "status", ["added", "removed", "modified", "unchanged"], ["n", "n_price", "n_status"])


@query("""with b as (select o_custkey, p_brand, min(o_orderdate) < timestamp '2023-01-01' as early, max(o_orderdate) >= timestamp '2023-01-01' as late from orders join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey group by 1, 2)
select o_custkey, coalesce(string_agg(p_brand, ',' order by p_brand) filter (late and not early), '') as added, coalesce(string_agg(p_brand, ',' order by p_brand) filter (early and not late), '') as removed from b group by 1""")
def q16_set_diff(spark, sf):
    orders = t(spark, sf, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderdate") >= F.lit("2023-01-01").cast("timestamp")).alias("late"))
    bought = t(spark, sf, "lineitem").select("l_orderkey", "l_partkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t(spark, sf, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    sets = bought.groupBy("o_custkey").agg(F.collect_set(F.when(~F.col("late"), F.col("p_brand"))).alias("before"), F.collect_set(F.when(F.col("late"), F.col("p_brand"))).alias("after"))
    return sets.select("o_custkey", tx.set_diff("before", "after").alias("d")).select("o_custkey", F.array_join("d.added", ",").alias("added"), F.array_join("d.removed", ",").alias("removed"))


@query(_VERSIONS + """, m as (select a.id, case when b.id is null then 'orphaned' when a.s = b.s then 'current' when b.s = 'X' then 'remapped' else 'conflict' end as status from a left join b on a.id = b.id
union all select b.id, 'added' from b where b.id not in (select id from a)) select status, count(*) as n, min(id) as first_id, max(id) as last_id from m group by 1""")
def q17_anchor_status(spark, sf):
    before, after = _versions(spark, sf)
    joined = before.select("id", F.col("s").alias("old")).join(after.select("id", F.col("s").alias("new")), "id", "full")
    status = vl.ladder([(F.col("old").isNull(), "added"), (F.col("new").isNull(), "orphaned"), (F.col("old") == F.col("new"), "current"), (F.col("new") == "X", "remapped")], "conflict")
    return joined.select("id", status.alias("status")).groupBy("status").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


# --- matching --------------------------------------------------------------------------------------------


@query("""select o_orderkey, string_agg(distinct l_partkey::varchar, ',' order by l_partkey::varchar) as affected, count(distinct l_partkey) as n_affected from orders join lineitem on l_orderkey = o_orderkey
where o_orderpriority = '1-URGENT' and l_partkey in (select p_partkey from part where p_size >= 25) group by 1""")
def q18_radar_equi(spark, sf):
    """Urgent orders with those of their parts that are watched, the large ones; lines meet the watch list before any are gathered."""
    watched = t(spark, sf, "part").where("p_size >= 25").select(F.col("p_partkey").alias("l_partkey"))
    lines = t(spark, sf, "lineitem").select("l_orderkey", "l_partkey").join(watched, "l_partkey", "left_semi")
    urgent = t(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey")
    hits = lines.join(urgent, F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", "l_partkey")
    return hits.groupBy("o_orderkey").agg(F.array_join(F.array_sort(F.collect_set(F.col("l_partkey").cast("string"))), ",").alias("affected"), F.count_distinct("l_partkey").alias("n_affected"))


_RADAR_SQL = r"trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g'))"


@query(f"""with b as (select item_id, list_filter(string_split({_RADAR_SQL}, ' '), lambda x: length(x) > 2) as tokens from benchmark), d as (select doc_id, {_RADAR_SQL} as hay from documents)
select item_id, count(*) as n_docs, min(doc_id) as first_doc from b join d on len(tokens) > 0 and len(list_filter(tokens, lambda x: not contains(hay, x))) = 0 group by 1""")
def q19_radar_topic(spark, sf):
    """Benchmark items as topic queries on all documents."""
    queries = t(spark, sf, "benchmark").select("item_id", tx.topic_tokens("text").alias("tokens"))
    hay = t(spark, sf, "documents").select("doc_id", tx.radar_text("text").alias("hay"))
    return rel.topic_hits(hay, "doc_id", queries, ["item_id"]).groupBy("item_id").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))


@query("""select user_id, 'radar_' || substr(sha256('events' || chr(10) || user_id::varchar || chr(10) || string_agg(distinct event_type, ',' order by event_type)), 1, 16) as proposal_id, string_agg(distinct event_type, ',' order by event_type) as reasons from events group by 1""")
def q20_proposal_ids(spark, sf):
    rows = t(spark, sf, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("reasons"))
    identity = F.concat_ws("\n", F.lit("events"), F.col("user_id").cast("string"), "reasons")
    return rows.select("user_id", F.concat(F.lit("radar_"), F.substring(F.sha2(identity, 256), 1, 16)).alias("proposal_id"), "reasons")


#: Themes in the order of their declaration: (theme, rank, themes it depends on).
THEMES = [("purchase", 0, ["signup", "refund"]), ("error", 1, ["view"]), ("signup", 2, []), ("click", 3, ["view", "signup"]), ("refund", 4, ["purchase"])]


@query("""with th(theme, ord) as (values ('purchase', 0), ('error', 1), ('signup', 2), ('click', 3), ('refund', 4))
select theme, ord, count(*) as n_proposals, count(distinct user_id) as n_claims, bool_or(value > 99) as approval_required, min(event_id) as first_event from events join th on theme = event_type group by 1, 2""")
def q21_theme_rollup(spark, sf):
    themes = rel.small(spark.createDataFrame([(a, b) for a, b, _ in THEMES], "theme string, ord int"))
    return t(spark, sf, "events").join(themes, F.col("event_type") == F.col("theme")).groupBy("theme", "ord").agg(F.count("*").alias("n_proposals"), F.count_distinct("user_id").alias("n_claims"), F.bool_or(F.col("value") > 99).alias("approval_required"), F.min("event_id").alias("first_event"))


@query("""with th(theme, dep) as (values ('purchase', 'signup'), ('purchase', 'refund'), ('error', 'view'), ('click', 'view'), ('click', 'signup'), ('refund', 'purchase')), p as (select distinct event_type from events)
select theme, string_agg(dep, ',' order by dep) as depends_on from th where theme in (from p) and dep in (from p) group by 1""")
def q22_dependency_semi(spark, sf):
    edges = spark.createDataFrame([(a, d) for a, _, ds in THEMES for d in ds], "theme string, dep string")
    present = t(spark, sf, "events").select("event_type").distinct()
    kept = edges.join(present.withColumnRenamed("event_type", "theme"), "theme", "left_semi").join(present.withColumnRenamed("event_type", "dep"), "dep", "left_semi")
    return kept.groupBy("theme").agg(F.array_join(F.array_sort(F.collect_list("dep")), ",").alias("depends_on"))


# --- order within groups ---------------------------------------------------------------------------------


@query("""with w as (select *, ts < lag(ts) over (partition by user_id order by event_id) as early from events)
select user_id, count(*) filter (early) as n_violations, arg_min(event_type, event_id) as first_type, arg_max(event_type, event_id) as last_type from w group by 1""")
def q23_event_chronology(spark, sf):
    w = Window.partitionBy("user_id").orderBy("event_id")
    rows = t(spark, sf, "events").withColumn("early", F.col("ts") < F.lag("ts").over(w))
    return rows.groupBy("user_id").agg(F.count_if("early").alias("n_violations"), F.min_by("event_type", "event_id").alias("first_type"), F.max_by("event_type", "event_id").alias("last_type"))


@query("""select user_id from events group by 1 having min(ts) filter (event_type = 'purchase') >= min(ts) filter (event_type = 'signup')""")
def q24_accepted(spark, sf):
    first = lambda kind: F.min(F.when(F.col("event_type") == kind, F.col("ts")))
    return t(spark, sf, "events").groupBy("user_id").agg(first("purchase").alias("bought"), first("signup").alias("joined")).where("bought >= joined").select("user_id")


@query("""with n as (select event_id, event_type, row_number() over (partition by user_id, event_type order by event_id) as k from events) select event_id, event_type || case when k > 1 then '-' || k else '' end as token from n""")
def q25_occurrence_no(spark, sf):
    n = F.row_number().over(Window.partitionBy("user_id", "event_type").orderBy("event_id"))
    return t(spark, sf, "events").withColumn("k", n).select("event_id", F.concat("event_type", F.when(F.col("k") > 1, F.concat(F.lit("-"), F.col("k").cast("string"))).otherwise("")).alias("token"))


@query("""with f as (select user_id, event_type, min(event_id) as first_at from events group by 1, 2) select user_id, event_type, dense_rank() over (partition by user_id order by first_at)::int as number from f""")
def q26_first_appearance(spark, sf):
    first = t(spark, sf, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("first_at"))
    return first.select("user_id", "event_type", F.dense_rank().over(Window.partitionBy("user_id").orderBy("first_at")).alias("number"))


@query("select user_id, event_type, min(event_id) as event_id from events where user_id is not null group by 1, 2")
def q27_keep_first(spark, sf):
    return rel.keep_first(t(spark, sf, "events"), ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id")


@query("select md5(text) as digest, count(*) as n, count(distinct source) as n_sources, min(doc_id) as first_doc from documents group by text having count(*) > 1")
def q28_duplicates(spark, sf):
    return rel.duplicates(t(spark, sf, "documents").withColumn("digest", F.md5("text")), ["digest"], F.count_distinct("source").alias("n_sources"), F.min("doc_id").alias("first_doc"))


# --- roll-ups and gates ----------------------------------------------------------------------------------


@query("""with l as (select doc_id, count(*) as n, sum(toxic) as toxic from labels group by 1), c as (select conv_id as doc_id, count(*) as turns from conversations group by 1)
select source, count(*) as n_docs, coalesce(sum(l.n), 0)::bigint as n_labels, coalesce(sum(l.toxic), 0)::bigint as n_toxic, coalesce(sum(turns), 0)::bigint as n_turns, coalesce(nullif(count(distinct text), 0), count(*)) as n_unique from documents left join l using (doc_id) left join c using (doc_id) group by 1""")
def q29_section_rollup(spark, sf):
    labels = t(spark, sf, "labels").groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic"))
    turns = t(spark, sf, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.count("*").alias("turns"))
    docs = t(spark, sf, "documents").select("doc_id", "source", F.xxhash64("text").alias("h")).join(labels, "doc_id", "left").join(turns, "doc_id", "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return docs.groupBy("source").agg(F.count("*").alias("n_docs"), total("n").alias("n_labels"), total("toxic").alias("n_toxic"), total("turns").alias("n_turns"), F.coalesce(F.nullif(F.count_distinct("h"), F.lit(0)), F.count("*")).alias("n_unique"))


@query("""with d as (select source, l.doc_id is not null as has, l.quality from documents left join (select distinct doc_id, quality from labels) l using (doc_id)),
r as (select coalesce(source, 'overall') as grain, round(avg(has::int), 4) as labelled, round(avg(case when has then (quality = 1)::int end), 4) as good from d group by rollup (source))
select grain, labelled, good, labelled >= 0.3 and coalesce(good, 0) >= 0.8 as passed from r""")
def q30_rate_gates(spark, sf):
    labels = t(spark, sf, "labels").select("doc_id", "quality").distinct().withColumn("has", F.lit(1))
    rows = t(spark, sf, "documents").select("doc_id", "source").join(labels, "doc_id", "left")
    rates = rows.rollup("source").agg(F.round(F.avg(F.coalesce("has", F.lit(0))), 4).alias("labelled"), F.round(F.avg(F.when(F.col("has") == 1, (F.col("quality") == 1).cast("int"))), 4).alias("good"))
    return rates.select(F.coalesce("source", F.lit("overall")).alias("grain"), "labelled", "good", ((F.col("labelled") >= 0.3) & (F.coalesce("good", F.lit(0.0)) >= 0.8)).alias("passed"))


@query("with n as (select source, count(*) as n from documents group by 1) select min(n) as low, max(n) as high, max(n) - min(n) <= 10 as uniform from n")
def q31_uniformity(spark, sf):
    n = t(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return n.agg(F.min("n").alias("low"), F.max("n").alias("high"), (F.max("n") - F.min("n") <= 10).alias("uniform"))


@query("select source, count(*) as n, sum(quality)::bigint as kept, round(avg(quality), 4) as share, avg(quality) >= 0.75 as passed from documents join labels using (doc_id) group by 1")
def q32_retention(spark, sf):
    rows = t(spark, sf, "documents").select("doc_id", "source").join(t(spark, sf, "labels"), "doc_id")
    return rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("quality").cast("bigint").alias("kept"), F.round(F.avg("quality"), 4).alias("share"), (F.avg("quality") >= 0.75).alias("passed"))


@query("""with f as (select *, count(*) over () as n_total from part where contains(lower(p_name), '1') or contains(lower(p_brand), '3') or contains(lower(p_type), 'x')) select p_partkey, p_name, n_total from f order by p_partkey limit 200""")
def q33_search_topk(spark, sf):
    """The explorer's first 200 hits with the number of all hits; the limit is the feature."""
    hit = F.contains(F.lower("p_name"), F.lit("1")) | F.contains(F.lower("p_brand"), F.lit("3")) | F.contains(F.lower("p_type"), F.lit("x"))
    found = t(spark, sf, "part").where(hit)
    total = found.agg(F.count("*").alias("n_total"))
    return found.orderBy("p_partkey").limit(200).select("p_partkey", "p_name").crossJoin(total)


# --- documents as lines, links, quotes -------------------------------------------------------------------


@query("""select doc_id, item_id, strpos(d.text, b.text)::int as place from documents d join benchmark b on contains(d.text, b.text) and not contains(substr(d.text, strpos(d.text, b.text) + 1), b.text)""")
def q34_quote_anchor(spark, sf):
    quotes = t(spark, sf, "benchmark").select("item_id", F.col("text").alias("quote"))
    found = rel.quote_hits(t(spark, sf, "documents").select("doc_id", "text"), "doc_id", quotes, "item_id").withColumn("place", F.expr("locate(quote, text)"))
    return found.where("locate(quote, text, place + 1) = 0").select("doc_id", "item_id", "place")


@query(r"""with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as ord from documents)
select doc_id, row_number() over (partition by doc_id order by ord)::int as paragraph_index, md5(trim(line)) as digest from l where trim(line) <> ''""")
def q35_paragraphs(spark, sf):
    lines = F.filter(F.transform(F.split("text", "\n"), lambda v: F.trim(v)), lambda x: x != "")
    return t(spark, sf, "documents").select("doc_id", F.posexplode(lines).alias("i", "line")).select("doc_id", (F.col("i") + 1).alias("paragraph_index"), F.md5("line").alias("digest"))


@query("""with l as (select page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) as href from pages) select href, count(*) as n, count(distinct page_id) as n_pages from l group by 1""")
def q36_link_extract(spark, sf):
    links = t(spark, sf, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("href"))
    return links.groupBy("href").agg(F.count("*").alias("n"), F.count_distinct("page_id").alias("n_pages"))


@query("""select page_id, regexp_matches(url, '^https://[^/@]+(/|$)') as safe from pages""")
def q37_safe_https(spark, sf):
    return t(spark, sf, "pages").select("page_id", tx.safe_https("url").alias("safe"))


@query(r"""with p as (select distinct regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1) as path from pages), l as (select distinct regexp_extract(href, '^(?:[a-z]+://[^/]+)?(/[^?#]*)', 1) as path from (select unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) as href from pages))
select 'link without page' as side, path from l where path not in (select path from p) union all select 'page without link', path from p where path not in (select path from l)""")
def q38_orphan_links(spark, sf):
    pages = t(spark, sf, "pages")
    paths = pages.select(F.regexp_extract("url", r"^[a-z]+://[^/]+(/[^?#]*)", 1).alias("path")).distinct()
    links = pages.select(F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("href")).select(F.regexp_extract("href", r"^(?:[a-z]+://[^/]+)?(/[^?#]*)", 1).alias("path")).distinct()
    return rel.both_ways(links, paths, ["path"], "link without page", "page without link")


@query()
def q39_jaccard(spark, sf):
    """Similar pairs among the documents of one language and source; tests/ compares it with all pairs."""
    return rel.block_jaccard(t(spark, sf, "documents").select("doc_id", "lang", "source", tx.word_set("text").alias("words")), ["lang", "source"], "doc_id", "words", 0.85)


@query(f"""with m as ({_MEMBERS}), e as (select a.s_suppkey as left_id, b.s_suppkey as right_id, count(*) as weight from m a join m b on a.l_orderkey = b.l_orderkey and a.s_suppkey < b.s_suppkey group by 1, 2)
select count(*) as n_links, sum(weight)::bigint as total, max(weight) as strongest, arg_max(left_id, weight * 1000000000000 + left_id * 1000000 + right_id) as left_id, arg_max(right_id, weight * 1000000000000 + left_id * 1000000 + right_id) as right_id from e""")
def q40_network_edges(spark, sf):
    edges = rel.co_members(_order_suppliers(spark, sf), "l_orderkey", "s_suppkey", "weight")
    last = F.struct("weight", "left_id", "right_id")
    return edges.agg(F.count("*").alias("n_links"), F.sum("weight").cast("bigint").alias("total"), F.max("weight").alias("strongest"), F.max_by("left_id", last).alias("left_id"), F.max_by("right_id", last).alias("right_id"))


@query("""with m as (select distinct s_nationkey as g, l_partkey as m from lineitem join supplier on s_suppkey = l_suppkey), r as (select distinct c_nationkey as g, c_mktsegment as r from customer),
sm as (select a.g as left_id, b.g as right_id, count(*) as shared from m a join m b on a.m = b.m and a.g < b.g group by 1, 2), sr as (select a.g as left_id, b.g as right_id, count(*) as roles from r a join r b on a.r = b.r and a.g < b.g group by 1, 2)
select left_id, right_id, (3 * coalesce(shared, 0) + coalesce(roles, 0))::bigint as weight from sm full join sr using (left_id, right_id)""")
def q41_group_links(spark, sf):
    members = t(spark, sf, "lineitem").join(t(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("s_nationkey").alias("g"), "l_partkey").distinct()
    roles = t(spark, sf, "customer").select(F.col("c_nationkey").alias("g"), "c_mktsegment").distinct()
    return rel.group_links(members, "l_partkey", roles, "c_mktsegment", "g")


_LEVELS = ["MACHINERY", "BUILDING", "AUTOMOBILE", "FURNITURE", "HOUSEHOLD"]


@query("""select c_custkey, row_number() over (partition by c_nationkey order by case c_mktsegment when 'MACHINERY' then 0 when 'BUILDING' then 1 when 'AUTOMOBILE' then 2 when 'FURNITURE' then 3 when 'HOUSEHOLD' then 4 else 9 end, split_part(c_name, '#', 2) , c_custkey)::int as place from customer""")
def q42_rank_sort(spark, sf):
    level = vl.ladder([(F.col("c_mktsegment") == x, i) for i, x in enumerate(_LEVELS)], 9)
    number = F.split_part("c_name", F.lit("#"), F.lit(2))
    return rel.places(t(spark, sf, "customer"), ["c_nationkey"], [level, F.substring(number, 1, 6)], [level, number, "c_custkey"], "place").select("c_custkey", "place")


@query("""with g as (select epoch(min(ts)) as low, epoch(max(ts)) as high from events), u as (select user_id, epoch(min(ts)) as a, epoch(max(ts)) as b from events group by 1)
select user_id, round(100 * (a - low) / (high - low), 3) as left_percent, round(100 * (b - a) / (high - low), 3) as width_percent from u, g""")
def q43_timeline(spark, sf):
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    events = t(spark, sf, "events").withColumn("s", seconds)
    users = events.groupBy("user_id").agg(F.min("s").alias("a"), F.max("s").alias("b"))
    whole = users.agg(F.min("a").alias("low"), F.max("b").alias("high"))
    span = F.col("high") - F.col("low")
    return users.crossJoin(F.broadcast(whole)).select("user_id", F.round(100 * (F.col("a") - F.col("low")) / span, 3).alias("left_percent"), F.round(100 * (F.col("b") - F.col("a")) / span, 3).alias("width_percent"))


@query("""with f as (select user_id, min(date_trunc('day', ts))::date as day from events group by 1), n as (select day, count(*) as fresh from f group by 1), d as (select date_trunc('day', ts)::date as day, count(distinct user_id) as active from events group by 1),
r as (select day::varchar as day, coalesce(fresh, 0) as fresh, active, sum(coalesce(fresh, 0)) over (order by day)::bigint as seen, coalesce(fresh, 0) / active as rate from d left join n using (day))
select day, fresh, seen, round(rate, 4) as rate, rate < 0.05 and coalesce(lag(rate) over (order by day) < 0.05, false) and seen >= 10 as saturated from r""")
def q44_saturation(spark, sf):
    return rel.saturation(t(spark, sf, "events").select(F.to_date("ts").alias("pass"), F.col("user_id").alias("item")), 0.05, 10).select(F.col("pass").cast("string").alias("day"), "fresh", "seen", F.round("rate", 4).alias("rate"), "saturated")


@query("""with n as (select user_id, event_id, ((row_number() over (partition by user_id order by event_id) - 1) // 18)::int + 1 as batch from events) select user_id, batch, count(*) as n, min(event_id) as first_event from n group by 1, 2""")
def q45_batches(spark, sf):
    rows = rel.batches(t(spark, sf, "events"), ["user_id"], "event_id", 18)
    return rows.groupBy("user_id", "batch").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("""select conv_id, turn, count(*) over w as n_context, (sum(length(text)) over w)::bigint as context_chars, lag(role) over o as before_role, lead(role) over o as after_role from conversations
window w as (partition by conv_id order by turn rows between 2 preceding and 2 following), o as (partition by conv_id order by turn)""")
def q46_context_window(spark, sf):
    o = Window.partitionBy("conv_id").orderBy("turn")
    w = o.rowsBetween(-2, 2)
    return t(spark, sf, "conversations").select("conv_id", "turn", F.count("*").over(w).alias("n_context"), F.sum(F.length("text")).over(w).alias("context_chars"), F.lag("role").over(o).alias("before_role"), F.lead("role").over(o).alias("after_role"))


@query("""with v as (select distinct (p_size % 12) || '.' || (p_partkey % 13) || '.' || (p_size % 3) as version, p_size % 12 as a, p_partkey % 13 as b, p_size % 3 as c from part)
select version, row_number() over (order by a, b, c)::int as numeric_rank, row_number() over (order by version)::int as text_rank from v""")
def q47_semver_order(spark, sf):
    """The distinct versions are few (12 x 13 x 3 at most), so ranking them in one task is bounded."""
    version = F.concat_ws(".", (F.col("p_size") % 12).cast("string"), (F.col("p_partkey") % 13).cast("string"), (F.col("p_size") % 3).cast("string"))
    rows = t(spark, sf, "part").select(version.alias("version")).distinct()
    return rows.select("version", F.row_number().over(Window.orderBy(tx.semver_key("version"))).alias("numeric_rank"), F.row_number().over(Window.orderBy("version")).alias("text_rank"))


@query("""select event_type, count(*) as n, count(json_extract(props, '$.k')) as n_k, sum(coalesce(json_extract_string(props, '$.k')::bigint, -1))::bigint as total, count(json_extract(props, '$.missing')) as n_missing from events group by 1""")
def q48_json_fields(spark, sf):
    k = F.get_json_object("props", "$.k")
    return t(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count(k).alias("n_k"), F.sum(F.coalesce(k.cast("bigint"), F.lit(-1))).alias("total"), F.count(F.get_json_object("props", "$.missing")).alias("n_missing"))


@query("""select 'discount range' as check_name, count(*) as n from lineitem where not (l_discount between 0 and 0.08)
union all select 'quantity positive', count(*) from lineitem where not (l_quantity > 0) union all select 'status domain', count(*) from orders where o_orderstatus not in ('F', 'O')
union all select 'text present', count(*) from documents where text is null or trim(text) = '' union all select 'url pattern', count(*) from pages where not regexp_matches(url, '^https://')""")
def q49_bound_checks(spark, sf):
    from claimloom.plans.checks import Check, failures

    lines, orders, docs, pages = (t(spark, sf, x) for x in ("lineitem", "orders", "documents", "pages"))
    return failures([
        Check("discount range", lines, F.col("l_discount").between(0, 0.08)), Check("quantity positive", lines, F.col("l_quantity") > 0), Check("status domain", orders, F.col("o_orderstatus").isin("F", "O")),
        Check("text present", docs, F.trim(F.coalesce("text", F.lit(""))) != ""), Check("url pattern", pages, F.col("url").rlike("^https://")),
    ])


@query()
def q50_digest_index(spark, sf):
    """Sizes and digests of every table's stored files, as the release index lists them."""
    from claimloom.sources.files import digest_index

    return digest_index(spark, [f"{sf}/{x}.parquet" for x in TABLES])


@query("""select c_custkey, '{"@id":"urn:customer:' || c_custkey || '","@type":"Claim","name":"' || c_name || '","supports":[' || coalesce(string_agg('"urn:order:' || o_orderkey || '"', ',' order by o_orderkey), '') || ']}' as node from customer left join orders on o_custkey = c_custkey group by c_custkey, c_name""")
def q51_jsonld(spark, sf):
    claimed = t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: F.concat(F.lit("urn:order:"), k.cast("string"))).alias("supports"))
    rows = t(spark, sf, "customer").join(claimed, "c_custkey", "left")
    node = F.struct(F.concat(F.lit("urn:customer:"), F.col("c_custkey").cast("string")).alias("@id"), F.lit("Claim").alias("@type"), F.col("c_name").alias("name"), F.coalesce("supports", F.array().cast("array<string>")).alias("supports"))
    return rows.select("c_custkey", F.to_json(node).alias("node"))


# --- intervals, masks, running places, samples, expansion ------------------------------------------------


@query("""with s as (select l_orderkey as g, l_linenumber as id, (l_partkey % 97)::int as a, (l_partkey % 97 + l_quantity)::int as b from lineitem)
select x.g, x.id as left_id, y.id as right_id, greatest(x.a, y.a) as clip_start, least(x.b, y.b) as clip_end from s x join s y on x.g = y.g and x.id < y.id and x.a < y.b and x.b > y.a""")
def q52_interval_overlap(spark, sf):
    """Overlapping spans of an order's lines."""
    spans = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("g"), F.col("l_linenumber").alias("id"), (F.col("l_partkey") % 97).cast("int").alias("start"), (F.col("l_partkey") % 97 + F.col("l_quantity")).cast("int").alias("end"))
    return rel.overlaps(spans, ["g"], "id")


@query("""with r as (select source, doc_id, row_number() over (partition by source order by md5(doc_id::varchar), doc_id) as k, count(*) over (partition by source) as n from documents) select source, doc_id from r where k <= greatest(5, ceil(0.1 * n))""")
def q53_repeatable_sample(spark, sf):
    """A sampling operator: a tenth of each group, five rows at least, the same ones each time."""
    return rel.repeatable_sample(t(spark, sf, "documents").select("source", "doc_id"), ["source"], F.md5(F.col("doc_id").cast("string")), "doc_id", 0.1, 5)


@query("""with e as (select user_id, event_id, sum(length(event_type)) over (partition by user_id order by event_id) - length(event_type) as start_at, length(event_type) as n from events) select event_id, start_at::bigint as start_at, (start_at + n)::bigint as end_at from e""")
def q54_running_offset(spark, sf):
    return rel.running_places(t(spark, sf, "events"), ["user_id"], "event_id", F.length("event_type")).select("event_id", "start_at", "end_at")


@query("""with w as (select *, last_value(case when event_type = 'signup' then event_id end ignore nulls) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding) as anchor,
    last_value(case when event_type = 'error' then event_id end ignore nulls) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding) as barrier from events)
select event_id, case when barrier is null or anchor > barrier then anchor end as anchor from w where event_type = 'purchase'""")
def q55_nearest_before(spark, sf):
    rows = rel.nearest_before(t(spark, sf, "events"), ["user_id"], "event_id", F.col("event_type") == "signup", F.col("event_type") == "error")
    return rows.where("event_type = 'purchase'").select("event_id", "anchor")


@query("""with d as (select event_id, user_id, event_type, sum(case event_type when 'signup' then 1 when 'error' then -1 else 0 end) over (partition by user_id order by event_id) as depth from events) select depth::bigint as depth, count(*) as n, min(event_id) as first_event from d group by 1""")
def q56_depth_mask(spark, sf):
    step = vl.ladder([(F.col("event_type") == "signup", 1), (F.col("event_type") == "error", -1)], 0)
    rows = scan(t(spark, sf, "events"), ["user_id"], ["event_id"], {"depth": ("sum", step.cast("bigint"))})
    return rows.groupBy("depth").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"))


@query("""with recursive e as (select distinct a.l_suppkey as u, b.l_suppkey as v from lineitem a join lineitem b on a.l_orderkey = b.l_orderkey and a.l_suppkey <> b.l_suppkey),
r(node, round) as (select s_suppkey, 0 from supplier where s_suppkey <= 3 union select v, round + 1 from r join e on u = node where round < 2) select node, min(round)::int as round from r group by 1""")
def q57_snowball(spark, sf):
    """Two rounds of expansion along shared orders, from three seeds."""
    lines = t(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    seeds = t(spark, sf, "supplier").where("s_suppkey <= 3").select(F.col("s_suppkey").alias("node"))
    return rel.snowball(seeds, rel.through(lines, "l_orderkey", "l_suppkey"), 2)


@query("""with v as (select o_custkey, o_orderkey, count(*) filter (l_returnflag <> 'N') as n from orders join lineitem on l_orderkey = o_orderkey group by 1, 2) select o_custkey, o_orderkey from (select *, lag(n) over (partition by o_custkey order by o_orderkey) as before from v) where n < before""")
def q58_shrinking_versions(spark, sf):
    sizes = t(spark, sf, "orders").select("o_orderkey", "o_custkey").join(t(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey", "o_orderkey").agg(F.count_if(F.col("l_returnflag") != "N").alias("n"))
    before = F.lag("n").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return sizes.withColumn("before", before).where("n < before").select("o_custkey", "o_orderkey")


@query("""select distinct c_nationkey as nationkey from customer where c_nationkey in (select s_nationkey from supplier) order by 1""")
def q59_shared_actors(spark, sf):
    return t(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey")).intersect(t(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey")))


@query("""with l as (select doc_id, source from documents), k as (select source, doc_id, row_number() over (partition by source order by doc_id) as n from l) select doc_id, source || case when count(*) over (partition by source) > 1 and n <= 26 then chr((96 + n)::int) else '' end as cite_key from k""")
def q60_key_suffixes(spark, sf):
    """Keys told apart by letters in order; the 27th and later ones keep the bare key. Only the first 26 of a source are ranked, each task's own before any are moved."""
    rows = t(spark, sf, "documents").select("doc_id", "source")
    first = rows.withColumn("n", F.row_number().over(Window.partitionBy("source").orderBy("doc_id"))).where("n <= 26").select(F.col("source").alias("_source"), F.col("doc_id").alias("_doc"), "n")
    many = rows.groupBy("source").agg(F.count("*").alias("of")).where("of > 1").select(F.col("source").alias("_many"))
    lettered = first.join(many, F.col("_source").eqNullSafe(F.col("_many")))
    told = rows.join(rel.small(lettered), F.col("source").eqNullSafe(F.col("_source")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    return told.select("doc_id", F.concat("source", F.when(F.col("n").isNotNull(), F.char(F.lit(96) + F.col("n"))).otherwise("")).alias("cite_key"))
