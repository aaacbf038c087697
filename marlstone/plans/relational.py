"""Queries of the relational operators over the star-schema tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates, hashing, json_paths, text
from ..operators import history, rules, selection, summaries, versioning
from ..operators.components import components
from ..session import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name with its SQL."""

    def put(build):
        QUERIES[build.__name__] = build
        if sql:
            ORACLE[build.__name__] = sql
        return build

    return put


def _orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders")


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events")


def _money(column: str):
    return F.sum(F.col(column).cast("decimal(18,4)")).cast("double")


@query("""SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate::date AS order_day FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 AND o_orderstatus <> 'P'""")
def latest_by_rank(spark, d):
    """R-1: each customer's latest order; a latest order of status P is a tombstone."""
    rows = _orders(spark, d).select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    out = versioning.latest_by(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") == "P")
    return out.select("o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("order_day"))


@query("""WITH l AS (SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM l)""")
def latest_children(spark, d):
    """R-2: line items of each customer's latest order only."""
    parents = _orders(spark, d).select("o_custkey", F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return versioning.latest_children(parents, lines, ["o_custkey"], "l_orderkey", ["o_orderdate", "l_orderkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY 1")
def first_observation(spark, d):
    """R-3: the first event of each user."""
    return versioning.first_by(_events(spark, d), ["user_id"], ["event_id"], ["event_id", "event_type"])


@query("""SELECT e.event_id, e.user_id, p.event_id AS previous_event_id, p.event_type AS previous_event_type
FROM (SELECT *, epoch_us(ts) AS t FROM events) e ASOF LEFT JOIN (SELECT user_id, epoch_us(ts) AS t, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY ALL) p
ON e.user_id = p.user_id AND e.t > p.t""")
def asof_prev_event(spark, d):
    """J-7: the event before, by strictly smaller time."""
    rows = _events(spark, d).select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    return history.previous_as_of(rows, ["user_id"], F.col("t"), ["event_id", "event_type"]).select("event_id", "user_id", "previous_event_id", "previous_event_type")


_CHANGES = """WITH x AS (SELECT event_id, user_id, event_type, value, lag(event_id) OVER w AS pid, lag(event_type) OVER w AS pt, lag(value) OVER w AS pv FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
c AS (SELECT event_id, user_id, concat_ws(',', CASE WHEN pid IS NOT NULL AND event_type IS DISTINCT FROM pt THEN 'EVENT_TYPE_CHANGED' END, CASE WHEN pid IS NOT NULL AND value IS DISTINCT FROM pv THEN 'VALUE_CHANGED' END) AS change_types FROM x)"""
_TRACKED = {"event_type": "EVENT_TYPE_CHANGED", "value": "VALUE_CHANGED"}


def _changed(spark, d):
    rows = history.with_changes(_events(spark, d).select("event_id", "user_id", "event_type", "value"), ["user_id"], ["event_id"], _TRACKED)
    return rows.select("event_id", "user_id", F.array_join(F.transform("changes", lambda c: c["change_type"]), ",").alias("change_types"))


@query(_CHANGES + " SELECT event_id, user_id, change_types, true AS has_more FROM c WHERE (event_id, user_id) > (100, 0) ORDER BY event_id, user_id LIMIT 500")
def change_feed_page(spark, d):
    """B-26: a page of the change feed behind a cursor; the limit is the page."""
    return history.feed_page(_changed(spark, d), ["event_id", "user_id"], (100, 0), 500)


@query(_CHANGES + " SELECT * FROM c WHERE change_types <> ''")
def timeline_lag_diff(spark, d):
    """A-3: what changed between consecutive events of a user."""
    return _changed(spark, d).where("change_types <> ''")


def _sides(spark, d):
    rows = _orders(spark, d).select("o_custkey", F.unix_date(F.col("o_orderdate").cast("date")).alias("rank"), "o_orderstatus", "o_orderkey")
    middle = rows.agg(F.percentile("rank", 0.5).cast("int")).first()[0] or 0
    return rows.where(F.col("rank") < middle), rows.where(F.col("rank") >= middle)


_SIDES = """WITH r AS (SELECT o_custkey, o_orderdate::date - DATE '1970-01-01' AS rank, o_orderstatus, o_orderkey FROM orders), m AS (SELECT quantile_cont(rank, 0.5)::double AS q FROM r), cut AS (SELECT floor(q)::int AS c FROM m)"""


@query(_SIDES + " SELECT o_custkey, rank, o_orderstatus, arg_min(o_orderkey, (rank, o_orderkey)) OVER (PARTITION BY o_custkey) AS first_order FROM r QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY rank DESC, CASE WHEN rank >= (SELECT c FROM cut) THEN 1 ELSE 0 END DESC, o_orderkey DESC, o_orderstatus DESC) = 1")
def rank_guarded_merge(spark, d):
    """W-2: later orders upserted over earlier ones by rank, the first order kept."""
    old, new = _sides(spark, d)
    latest = versioning.latest_by(old.unionByName(new), ["o_custkey"], ["rank", "o_orderkey"])
    current = versioning.latest_by(old, ["o_custkey"], ["rank", "o_orderkey"])
    incoming = versioning.latest_by(new, ["o_custkey"], ["rank", "o_orderkey"])
    merged = versioning.rank_guarded_merge(current, incoming, ["o_custkey"], "rank")
    first = versioning.first_by(old.unionByName(new), ["o_custkey"], ["rank", "o_orderkey"], ["o_orderkey"]).withColumnRenamed("o_orderkey", "first_order")
    return merged.join(latest.select("o_custkey"), "o_custkey").join(first, "o_custkey").select("o_custkey", "rank", "o_orderstatus", "first_order")


@query("""SELECT c_custkey, c_nationkey, 2 AS rank, 1 AS is_deleted FROM customer c WHERE c_mktsegment <> 'BUILDING' AND c_nationkey IN (SELECT c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def snapshot_tombstones(spark, d):
    """B-23: customers that the newer snapshot of their nation omits."""
    rows = table(spark, d, "customer").select("c_custkey", "c_nationkey", F.lit(1).alias("rank"), F.lit(0).alias("is_deleted"), "c_mktsegment")
    newer = rows.where("c_mktsegment = 'BUILDING'").withColumn("rank", F.lit(2))
    return versioning.snapshot_tombstones(rows, newer, ["c_nationkey"], ["c_custkey"], "rank").drop("c_mktsegment")


@query("""WITH i AS (SELECT * FROM customer WHERE c_acctbal >= 5000) SELECT c_custkey, c_nationkey, c_mktsegment FROM customer c
WHERE EXISTS (SELECT 1 FROM i WHERE i.c_nationkey = c.c_nationkey AND i.c_mktsegment = c.c_mktsegment) AND c.c_custkey NOT IN (SELECT c_custkey FROM i)""")
def role_closure(spark, d):
    """B-4: members of touched scopes that the newer delivery does not name."""
    rows = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    return versioning.role_closure(rows, rows.where("c_acctbal >= 5000"), ["c_nationkey", "c_mktsegment"], ["c_custkey"]).drop("c_acctbal")


@query("""WITH n AS (SELECT p_partkey, p_brand, p_size, CASE WHEN p_size > 25 THEN 'Brand#X' ELSE p_brand END AS nb, CASE WHEN p_partkey < 500 THEN p_size + 1 ELSE p_size END AS ns FROM part)
SELECT p_partkey, 'BRAND_CHANGED' AS event_type, p_brand AS old_value, nb AS new_value FROM n WHERE nb IS DISTINCT FROM p_brand
UNION ALL SELECT p_partkey, 'SIZE_CHANGED', p_size::varchar, ns::varchar FROM n WHERE ns IS DISTINCT FROM p_size""")
def true_delta_events(spark, d):
    """B-1: events of the attributes that differ between two versions of a part."""
    old = table(spark, d, "part").select("p_partkey", "p_brand", "p_size", F.lit(1).alias("rank"))
    new = old.select("p_partkey", F.when(F.col("p_size") > 25, "Brand#X").otherwise(F.col("p_brand")).alias("p_brand"), F.when(F.col("p_partkey") < 500, F.col("p_size") + 1).otherwise(F.col("p_size")).alias("p_size"), F.lit(2).alias("rank"))
    return versioning.true_delta_events(old, new, ["p_partkey"], "rank", {"p_brand": "BRAND_CHANGED", "p_size": "SIZE_CHANGED"})


@query("""SELECT l_partkey, l_suppkey, arg_max(l_returnflag, (p, line)) AS l_returnflag, max(p) AS precedence FROM (SELECT *, CASE l_returnflag WHEN 'R' THEN 30 WHEN 'A' THEN 20 ELSE 10 END AS p, l_orderkey * 10 + l_linenumber AS line FROM lineitem) GROUP BY 1, 2""")
def strongest_signal(spark, d):
    """R-8: of each part and supplier the line of the strongest flag, then the last line."""
    rows = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"))
    precedence = F.when(F.col("l_returnflag") == "R", 30).when(F.col("l_returnflag") == "A", 20).otherwise(10)
    return summaries.strongest_signal(rows, ["l_partkey", "l_suppkey"], precedence, "line", ["l_returnflag"])


@query("""SELECT l_orderkey, count(*) AS items, count(*) FILTER (l_returnflag = 'R') AS returned, count(*) FILTER (l_returnflag = 'A') AS accepted, array_to_string(list_sort(list(DISTINCT l_linestatus)), ',') AS statuses,
CASE WHEN count(*) FILTER (l_returnflag = 'R') = count(*) THEN 'ALL_RETURNED' WHEN count(*) FILTER (l_returnflag = 'R') > 0 THEN 'PARTIAL' WHEN count(*) FILTER (l_returnflag = 'A') > 0 THEN 'RISK' ELSE 'COMPLETE' END AS scope_status FROM lineitem GROUP BY 1""")
def scope_rollup(spark, d):
    """R-5, R-9, R-10: counters, sorted distinct statuses and a ladder per order."""
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("items"), F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.count_if(F.col("l_returnflag") == "A").alias("accepted"), F.array_join(F.array_sort(F.collect_set("l_linestatus")), ",").alias("statuses")
    )
    return rows.withColumn("scope_status", rules.ladder([(F.col("returned") == F.col("items"), "ALL_RETURNED"), (F.col("returned") > 0, "PARTIAL"), (F.col("accepted") > 0, "RISK")], "COMPLETE"))


@query("SELECT l_orderkey, sha256(string_agg(h, '|' ORDER BY h)) AS row_hash FROM (SELECT l_orderkey, sha256(l_linenumber || '|' || l_partkey || '|' || l_suppkey) AS h FROM lineitem) GROUP BY 1")
def multiset_hash(spark, d):
    """R-26: an order-free hash of each order's lines."""
    line = hashing.sha256_parts(F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(hashing.multiset_hash(line).alias("row_hash"))


@query("""WITH h AS (SELECT c_custkey, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || ('CUSTOMER|' || c_custkey)::blob) AS h FROM customer)
SELECT c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab89ab89ab89ab', strpos('0123456789abcdef', substr(h, 17, 1)), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS case_id FROM h""")
def uuid5_keys(spark, d):
    """M-2: name-based UUIDs of customers; tested against the standard library too."""
    return table(spark, d, "customer").select("c_custkey", hashing.uuid5("6ba7b811-9dad-11d1-80b4-00c04fd430c8", F.concat(F.lit("CUSTOMER|"), F.col("c_custkey").cast("string"))).alias("case_id"))


@query("""SELECT l_partkey, arg_max(l_shipdate::date::varchar, (l_orderkey * 10 + l_linenumber, l_shipdate::date::varchar)) FILTER (l_returnflag <> 'N') AS last_ship, arg_max(l_suppkey, (l_orderkey * 10 + l_linenumber, l_suppkey)) FILTER (l_suppkey % 3 <> 0) AS last_supplier FROM lineitem GROUP BY 1""")
def argmax_skip_nulls(spark, d):
    """R-4: the last known values; nulls do not hide earlier ones."""
    rows = table(spark, d, "lineitem").select(
        "l_partkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"), F.when(F.col("l_returnflag") != "N", F.col("l_shipdate").cast("date").cast("string")).alias("last_ship"), F.when(F.col("l_suppkey") % 3 != 0, F.col("l_suppkey")).alias("last_supplier")
    )
    return rows.groupBy("l_partkey").agg(*summaries.latest_known(["last_ship", "last_supplier"], "line"))


@query("""SELECT CASE WHEN grouping(c_mktsegment) = 1 THEN 'ALL' ELSE c_mktsegment END AS segment, count(*) AS customers, count(*) FILTER (c_acctbal < 0) AS in_debt, count(DISTINCT c_nationkey) FILTER (c_acctbal >= 0) AS nations FROM customer GROUP BY GROUPING SETS ((), (c_mktsegment))""")
def grouping_sets_directory(spark, d):
    """R-19: totals and segments in one pass of grouping sets."""
    rows = table(spark, d, "customer").groupingSets([[], ["c_mktsegment"]], "c_mktsegment").agg(
        F.grouping("c_mktsegment").alias("g"), F.count("*").alias("customers"), F.count_if(F.col("c_acctbal") < 0).alias("in_debt"), F.count_distinct(F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey"))).alias("nations")
    )
    return rows.select(F.when(F.col("g") == 1, "ALL").otherwise(F.col("c_mktsegment")).alias("segment"), "customers", "in_debt", "nations")


@query("""SELECT o_custkey, count(*) FILTER (o_orderstatus = 'O') AS open_orders, bool_or(o_totalprice > 200000) AS any_large, array_to_string(list_sort(list(DISTINCT o_orderpriority)), '|') AS priorities, CASE WHEN min(o_orderstatus) = max(o_orderstatus) THEN max(o_orderstatus) END AS only_status FROM orders GROUP BY 1""")
def filter_aggs(spark, d):
    """R-20: filtered counts, any, sorted distinct lists, the value if there is only one."""
    return _orders(spark, d).groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "O").alias("open_orders"), F.bool_or(F.col("o_totalprice") > 200000).alias("any_large"), F.array_join(F.array_sort(F.collect_set("o_orderpriority")), "|").alias("priorities"), summaries.only_value(F.col("o_orderstatus")).alias("only_status")
    )


@query("SELECT count(DISTINCT l_partkey) AS parts, count(DISTINCT (l_partkey, l_suppkey)) AS pairs, count(*) - count(DISTINCT (l_partkey, l_suppkey)) AS repeated FROM lineitem")
def count_distinct(spark, d):
    """R-16: exact distinct keys and pairs."""
    rows = table(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"))
    return rows.agg(F.count_distinct("l_partkey").alias("parts"), F.count("*").alias("pairs"), (F.sum("n") - F.count("*")).alias("repeated"))


@query("SELECT l_partkey, l_suppkey, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def having_dups(spark, d):
    """R-18: keys that repeat."""
    return summaries.duplicates(table(spark, d, "lineitem"), ["l_partkey", "l_suppkey"])


@query("""WITH k AS (SELECT user_id, count(*) AS n, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1)
SELECT count(*) AS users, sum(n)::bigint AS events, count(*) FILTER (kinds > 1) AS mixed_users, coalesce(sum(n) FILTER (kinds = 1), 0)::bigint AS single_events FROM k""")
def two_level_agg(spark, d):
    """R-17: users, then a summary of the users."""
    users = _events(spark, d).groupBy("user_id").agg(F.count("*").alias("n"), F.count_distinct("event_type").alias("kinds"))
    return users.agg(F.count("*").alias("users"), F.sum("n").alias("events"), F.count_if(F.col("kinds") > 1).alias("mixed_users"), F.coalesce(F.sum(F.when(F.col("kinds") == 1, F.col("n"))), F.lit(0)).alias("single_events"))


@query("""SELECT flag, count(*) AS rows FROM (SELECT unnest(list_filter([CASE WHEN l_shipdate < o_orderdate THEN 'SHIPPED_BEFORE_ORDER' END, CASE WHEN l_shipdate > o_orderdate + INTERVAL 90 DAY THEN 'SHIPPED_LATE' END, CASE WHEN l_discount > 0.05 THEN 'HIGH_DISCOUNT' END], lambda x: x IS NOT NULL)) AS flag FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY 1""")
def explode_flags(spark, d):
    """P-13, R-15: date sanity flags of lines, unnested and counted."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate", "l_discount").join(_orders(spark, d).select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    return summaries.flag_counts(
        rows, {"SHIPPED_BEFORE_ORDER": F.col("l_shipdate") < F.col("o_orderdate"), "SHIPPED_LATE": F.col("l_shipdate") > F.col("o_orderdate") + F.expr("interval 90 days"), "HIGH_DISCOUNT": F.col("l_discount") > 0.05}
    )


@query("""SELECT 'order_without_lines' AS issue, count(*) AS rows FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT 'customer_without_orders', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT 'line_without_part', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)""")
def semi_anti_integrity(spark, d):
    """J-2, P-5: rows whose partner is missing."""
    lines = table(spark, d, "lineitem")
    parts = [
        ("order_without_lines", summaries.integrity(_orders(spark, d).select("o_orderkey"), lines.select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])),
        ("customer_without_orders", summaries.integrity(table(spark, d, "customer").select("c_custkey"), _orders(spark, d).select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])),
        ("line_without_part", summaries.integrity(lines.select("l_partkey"), table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey")), ["l_partkey"])),
    ]
    out = None
    for name, rows in parts:
        one = rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("issue"), "rows")
        out = one if out is None else out.unionAll(one)
    return out


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_partkey, l_suppkey) IN (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 49)""")
def tuple_semi_join(spark, d):
    """P-4, J-4: rows whose pair of keys stands in a subquery."""
    lines = table(spark, d, "lineitem")
    return lines.join(lines.where("l_returnflag = 'R' and l_quantity >= 49").select("l_partkey", "l_suppkey"), ["l_partkey", "l_suppkey"], "left_semi").select("l_orderkey", "l_linenumber")


@query("""SELECT party_key, role, nation, n FROM (SELECT 'C' || c_custkey AS party_key, 'CUSTOMER' AS role, n_name AS nation, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'S' || s_suppkey, 'SUPPLIER', n_name, (SELECT count(*) FROM lineitem WHERE l_suppkey = s_suppkey) FROM supplier JOIN nation ON s_nationkey = n_nationkey)""")
def party_union(spark, d):
    """R-6, U-1: parties of two kinds with their role, nation and activity."""
    nation = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    bought = _orders(spark, d).groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    sold = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("k")).agg(F.count("*").alias("n"))

    def side(rows, key, nat, role, mark, activity):
        named = rows.join(nation, F.col(nat) == F.col("n_nationkey")).join(activity, F.col(key) == F.col("k"), "left")
        return named.select(F.concat(F.lit(mark), F.col(key).cast("string")).alias("party_key"), F.lit(role).alias("role"), "nation", F.coalesce("n", F.lit(0)).alias("n"))

    return side(table(spark, d, "customer"), "c_custkey", "c_nationkey", "CUSTOMER", "C", bought).unionAll(side(table(spark, d, "supplier"), "s_suppkey", "s_nationkey", "SUPPLIER", "S", sold))


@query("SELECT c_custkey, c_name, (SELECT count(*) FROM customer WHERE c_mktsegment = 'MACHINERY') AS total FROM customer WHERE c_mktsegment = 'MACHINERY' ORDER BY c_acctbal DESC, c_custkey LIMIT 50 OFFSET 10")
def page_total_over(spark, d):
    """A-1, L-5: a page with the number of all rows; the limit is the page."""
    rows = table(spark, d, "customer").where("c_mktsegment = 'MACHINERY'")
    return selection.page_with_total(rows, [F.desc("c_acctbal"), F.asc("c_custkey")], 50, 10).select("c_custkey", "c_name", "total")


@query("SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_orderpriority FROM orders ORDER BY o_custkey, o_totalprice DESC, o_orderkey")
def distinct_on(spark, d):
    """A-2: each customer's dearest order."""
    return selection.first_per_group(_orders(spark, d), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderpriority")


@query("""WITH l AS (SELECT o_custkey, 0 AS lane_no, 'urgent' AS lane FROM orders WHERE o_orderpriority = '1-URGENT' UNION ALL SELECT o_custkey, 1, 'large' FROM orders WHERE o_totalprice > 300000 UNION ALL SELECT c_custkey, 2, 'debt' FROM customer WHERE c_acctbal < 0)
SELECT o_custkey, min(lane_no) AS lane_no, arg_min(lane, lane_no) AS lane FROM l GROUP BY 1""")
def lane_merge(spark, d):
    """U-6: candidates of ordered lanes, the first lane wins."""
    orders = _orders(spark, d)
    debt = table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return selection.merge_lanes([("urgent", orders.where("o_orderpriority = '1-URGENT'")), ("large", orders.where("o_totalprice > 300000")), ("debt", debt)], "o_custkey")


@query("""SELECT o_orderkey, (CASE WHEN o_orderpriority = '1-URGENT' THEN 1000 ELSE 0 END + CASE WHEN o_orderstatus = 'O' THEN 300 ELSE 0 END + CASE WHEN o_totalprice > 250000 THEN 50 ELSE 0 END) AS score,
concat_ws(',', CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' END, CASE WHEN o_orderstatus = 'O' THEN 'open' END, CASE WHEN o_totalprice > 250000 THEN 'large' END) AS reasons FROM orders ORDER BY 2 DESC, 1 LIMIT 200""")
def priority_topk(spark, d):
    """L-6: the 200 orders of the highest additive score, a top-k report."""
    parts = [("urgent", F.col("o_orderpriority") == "1-URGENT", F.lit(1000)), ("open", F.col("o_orderstatus") == "O", F.lit(300)), ("large", F.col("o_totalprice") > 250000, F.lit(50))]
    best = selection.top_k(selection.scored(_orders(spark, d), parts), [F.desc("score"), F.asc("o_orderkey")], 200)
    return best.select("o_orderkey", "score", F.array_join("reasons", ",").alias("reasons"))


@query("SELECT (c_custkey % 52)::int AS bucket, count(*) AS customers, min(c_custkey) AS first_key FROM customer GROUP BY 1")
def bucket_backfill(spark, d):
    """P-10, T-9: rolling buckets of whole-number keys."""
    return table(spark, d, "customer").groupBy(F.pmod("c_custkey", F.lit(52)).cast("int").alias("bucket")).agg(F.count("*").alias("customers"), F.min("c_custkey").alias("first_key"))


@query("""WITH p AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY 1, 2), t AS (SELECT c_nationkey, sum(n)::bigint AS total, max(n) AS n, arg_min(c_mktsegment, (-n, c_mktsegment)) AS c_mktsegment FROM p GROUP BY 1)
SELECT c_nationkey, c_mktsegment, n, total, n / total AS dominance FROM t WHERE total >= 3 AND n / total >= 0.22""")
def dominance_model(spark, d):
    """R-30: nations with a dominant segment."""
    return summaries.dominant_value(table(spark, d, "customer"), "c_nationkey", "c_mktsegment", 3, 0.22)


_W = "CASE event_type WHEN 'purchase' THEN 0.6 WHEN 'click' THEN 0.3 ELSE 0.1 END"


@query(f"""WITH e AS (SELECT user_id, event_type, (event_id % 3)::varchar AS candidate, {_W} AS w FROM events), k AS (SELECT user_id, candidate, event_type, max(w) AS w FROM e GROUP BY ALL),
s AS (SELECT user_id, candidate, round(1 - exp(sum(ln(1 - w))), 4) AS score FROM k GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, candidate) AS place FROM s),
t AS (SELECT user_id, max(candidate) FILTER (place = 1) AS candidate, max(score) FILTER (place = 1) AS confidence, coalesce(max(score) FILTER (place = 2), 0) AS runner_up FROM r GROUP BY 1)
SELECT user_id, candidate, confidence, runner_up, CASE WHEN confidence >= 0.7 AND round(confidence - runner_up, 4) >= 0.15 THEN 'ACCEPTED' WHEN runner_up >= 0.5 AND round(confidence - runner_up, 4) < 0.15 THEN 'CONFLICT' ELSE 'INSUFFICIENT' END AS decision FROM t""")
def noisy_or(spark, d):
    """R-31, B-56: evidence combined per candidate and decided."""
    weight = F.when(F.col("event_type") == "purchase", 0.6).when(F.col("event_type") == "click", 0.3).otherwise(0.1)
    rows = _events(spark, d).select("user_id", "event_type", (F.col("event_id") % 3).cast("string").alias("candidate"), weight.alias("w"))
    return summaries.decide_evidence(rows, "user_id", "candidate", "event_type", "w", 0.7, 0.15, 0.5)


@query("""WITH RECURSIVE e AS (SELECT DISTINCT a.l_suppkey AS u, b.l_suppkey AS v FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey WHERE a.l_quantity >= 48 AND b.l_quantity >= 48),
r(node, root) AS (SELECT u, u FROM e UNION SELECT e.v, r.root FROM r JOIN e ON e.u = r.node) SELECT node, min(root) AS component FROM r GROUP BY 1""")
def entity_components(spark, d):
    """B-54: suppliers joined by an order of large lines, named by the smallest."""
    large = table(spark, d, "lineitem").where("l_quantity >= 48").select("l_orderkey", "l_suppkey")
    edges = large.join(large.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("anchor")), "l_orderkey").select(F.col("l_suppkey").alias("a"), F.col("anchor").alias("b"))
    return components(edges)


@query("""WITH n AS (SELECT text, lower(regexp_replace(trim(text), '[ \\t\\n\\r]+', ' ', 'g')) AS k, doc_id FROM documents WHERE trim(text) <> '')
SELECT doc_id, min(doc_id) OVER (PARTITION BY k) AS duplicate_of FROM n QUALIFY count(*) OVER (PARTITION BY k) > 1""")
def exact_duplicates(spark, d):
    """B-54: documents of one normalised text, each with the smallest id of its class."""
    key = F.lower(F.regexp_replace(F.trim("text"), r"[ \t\n\r]+", " "))
    rows = table(spark, d, "documents").where(F.trim("text") != "").select("doc_id", F.sha2(key, 256).alias("k"))
    classes = rows.groupBy("k").agg(F.min("doc_id").alias("duplicate_of"), F.count("*").alias("n")).where("n > 1")
    return rows.join(classes, "k").select("doc_id", "duplicate_of")


@query("""WITH a AS (SELECT l_orderkey AS k, list_sort(list(DISTINCT l_returnflag)) AS s FROM lineitem GROUP BY 1), b AS (SELECT l_orderkey AS k, list_sort(list(DISTINCT l_returnflag)) AS s FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1)
SELECT o_orderkey, CASE WHEN a.k IS NULL AND b.k IS NULL THEN 'NOT_COMPARABLE' WHEN b.k IS NULL THEN 'RIGHT_MISSING' WHEN a.s = b.s THEN 'SET_MATCH' ELSE 'SET_DIFFER' END AS evidence FROM orders LEFT JOIN a ON o_orderkey = a.k LEFT JOIN b ON o_orderkey = b.k""")
def name_set_compare(spark, d):
    """B-41, U-5: equality of two sets of names per subject."""
    lines = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    left = lines.groupBy("o_orderkey").agg(F.array_sort(F.collect_set("l_returnflag")).alias("a"), F.array_sort(F.collect_set(F.when(F.col("l_linenumber") <= 2, F.col("l_returnflag")))).alias("b"))
    rows = _orders(spark, d).select("o_orderkey").join(left, "o_orderkey", "left")
    return rows.select("o_orderkey", rules.ladder([(F.col("a").isNull(), "NOT_COMPARABLE"), (F.size("b") == 0, "RIGHT_MISSING"), (F.col("a") == F.col("b"), "SET_MATCH")], "SET_DIFFER").alias("evidence"))


@query("""SELECT user_id, count(DISTINCT event_type) AS versions, arg_min(event_type, event_id) AS first_type, arg_max(event_type, event_id) AS last_type FROM events GROUP BY 1 HAVING count(DISTINCT event_type) > 1 AND count(*) FILTER (event_type = 'error') = 0""")
def owner_change_gap(spark, d):
    """B-42, R-23: users of several event types and no evidence of an error."""
    rows = _events(spark, d).groupBy("user_id").agg(F.count_distinct("event_type").alias("versions"), F.min_by("event_type", "event_id").alias("first_type"), F.max_by("event_type", "event_id").alias("last_type"), F.count_if(F.col("event_type") == "error").alias("errors"))
    return rows.where("versions > 1 and errors = 0").drop("errors")


@query("""SELECT o_orderkey, term, due::varchar AS due, CASE WHEN DATE '2026-06-30' < (due - INTERVAL 12 MONTH)::date THEN 'FUTURE' WHEN DATE '2026-06-30' <= due THEN 'OPEN_REGULAR' WHEN DATE '2026-06-30' <= (due + INTERVAL 6 MONTH)::date THEN 'OPEN_GRACE' ELSE 'PAST_DEADLINE' END AS state
FROM (SELECT o_orderkey, t.term::int AS term, (o_orderdate::date + to_months((t.term * 18)::int))::date AS due FROM orders, (SELECT unnest(range(1, 5)) AS term) t)""")
def deadline_schedule(spark, d):
    """B-29: terms from a start date with window states as of a day."""
    rows = _orders(spark, d).select("o_orderkey", F.col("o_orderdate").cast("date").alias("start"))
    return rules.schedule(rows, "start", 18, 4, F.lit("2026-06-30").cast("date")).select("o_orderkey", F.col("term").cast("int"), F.col("due").cast("string"), "state")


@query("""SELECT urgency, count(*) AS orders FROM (SELECT CASE WHEN n < 0 THEN 'PAST' WHEN n <= 7 THEN 'WEEK' WHEN n <= 30 THEN 'MONTH' WHEN n <= 90 THEN 'QUARTER' ELSE 'LATER' END AS urgency FROM (SELECT datediff('day', (SELECT max(o_orderdate)::date - 365 FROM orders), o_orderdate::date) AS n FROM orders)) GROUP BY 1""")
def urgency_buckets(spark, d):
    """B-31: day differences in buckets."""
    rows = _orders(spark, d).select(F.col("o_orderdate").cast("date").alias("day"))
    n = F.datediff("day", rows.agg(F.date_sub(F.max("day"), 365)).scalar())
    urgency = rules.ladder([(n < 0, "PAST"), (n <= 7, "WEEK"), (n <= 30, "MONTH"), (n <= 90, "QUARTER")], "LATER")
    return rows.select(urgency.alias("urgency")).groupBy("urgency").agg(F.count("*").alias("orders"))


@query("""WITH u AS (SELECT user_id, arg_max(event_type, event_id) AS st, list(DISTINCT event_type) AS ev FROM events GROUP BY 1)
SELECT user_id, CASE WHEN st = 'purchase' AND list_contains(ev, 'error') THEN 'UNKNOWN' WHEN st = 'purchase' THEN 'BUYER' WHEN list_contains(ev, 'error') THEN 'TROUBLED' WHEN list_contains(ev, 'view') AND list_contains(ev, 'click') THEN 'VISITOR' ELSE 'NONE' END AS label FROM u""")
def rule_interpretation(spark, d):
    """B-27: rules by priority over a status and a set of events; a tie of labels is unknown."""
    users = _events(spark, d).groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("st"), F.collect_set("event_type").alias("ev"))
    made = spark.createDataFrame(
        [("r1", 10, ["purchase"], [], [], "BUYER", 0.9), ("r2", 10, [], ["error"], [], "TROUBLED", 0.8), ("r3", 5, [], [], ["view", "click"], "VISITOR", 0.5)],
        "rule_id string, priority int, status_codes array<string>, any_events array<string>, all_events array<string>, label string, confidence double",
    )
    return rules.interpret(users, made, "user_id", "st", "ev").select("user_id", "label")


@query(r"""SELECT doc_id, regexp_replace(lower(coalesce(source, '')), '[^a-z0-9]+', '', 'g') AS source_key, CASE WHEN lower(trim(regexp_replace(coalesce(lang, ''), '[ \t\n\r]+', ' ', 'g'))) IN ('null', 'none', 'nan', 'n/a', 'na', '-', '--') THEN '' ELSE trim(regexp_replace(coalesce(lang, ''), '[ \t\n\r]+', ' ', 'g')) END AS lang_clean FROM documents""")
def text_normalise(spark, d):
    """F-1, F-3: cleaned and matching forms of short fields."""
    return table(spark, d, "documents").select("doc_id", text.match_text(F.col("source")).alias("source_key"), text.clean_text(F.regexp_replace("lang", "　", " ")).alias("lang_clean"))


ORACLE["text_normalise"] = ORACLE["text_normalise"].replace("coalesce(lang, '')", "replace(coalesce(lang, ''), '　', ' ')")


@query("SELECT event_id, CAST(props->>'k' AS bigint) AS k FROM events")
def json_pointer(spark, d):
    """C-7, S-27: a field of a JSON column by pointer."""
    return _events(spark, d).select("event_id", json_paths.json_pointer(F.col("props"), "/k").cast("bigint").alias("k"))


@query("SELECT o_orderkey, o_orderdate::date::varchar AS day, last_day(o_orderdate::date)::varchar AS month_end, isodow(o_orderdate) >= 6 AS weekend, epoch_ms(o_orderdate) AS millis FROM orders")
def date_functions(spark, d):
    """D-1 to D-8: dates read from text, month ends, weekends, milliseconds."""
    day = dates.digits_date(F.date_format("o_orderdate", "yyyy/MM/dd"))
    return _orders(spark, d).select("o_orderkey", day.cast("string").alias("day"), F.last_day(day).cast("string").alias("month_end"), dates.is_weekend(day).alias("weekend"), dates.epoch_millis(F.col("o_orderdate")).alias("millis"))


@query("""SELECT 'orders' AS table_name, count(*) AS rows, count(DISTINCT o_orderkey) AS keys, count(*) FILTER (o_custkey IS NULL) AS null_refs FROM orders UNION ALL SELECT 'events', count(*), count(DISTINCT event_id), count(*) FILTER (user_id IS NULL) FROM events
UNION ALL SELECT 'documents', count(*), count(DISTINCT doc_id), count(*) FILTER (text IS NULL) FROM documents""")
def audit_metrics(spark, d):
    """Q-1, Q-6, R-29: rows, distinct keys and missing references by table."""
    out = None
    for name, key, ref in (("orders", "o_orderkey", "o_custkey"), ("events", "event_id", "user_id"), ("documents", "doc_id", "text")):
        one = table(spark, d, name).agg(F.count("*").alias("rows"), F.count_distinct(key).alias("keys"), F.count_if(F.col(ref).isNull()).alias("null_refs")).select(F.lit(name).alias("table_name"), "rows", "keys", "null_refs")
        out = one if out is None else out.unionAll(one)
    return out


@query("""WITH k AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1), s AS (SELECT l_orderkey, n, coalesce(sum(n) OVER (ORDER BY l_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM k)
SELECT floor(pos / 1000)::bigint AS range_no, min(l_orderkey) AS lower, max(l_orderkey) AS upper, sum(n)::bigint AS rows FROM s GROUP BY 1""")
def range_planner(spark, d):
    """A-8: contiguous key ranges of about 1,000 rows; no key is split."""
    return selection.key_ranges(table(spark, d, "lineitem").select("l_orderkey"), "l_orderkey", 1000)


@query("""SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderstatus = 'P' THEN 'NOT_ACCEPTED' END, CASE WHEN o_totalprice < 50000 THEN 'BELOW_COVERAGE' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'STALE' END) AS reasons, NOT (o_orderstatus = 'P' OR o_totalprice < 50000 OR o_orderpriority = '5-LOW') AS trusted FROM orders""")
def data_trust(spark, d):
    """Q-10: named reasons against trust."""
    why = rules.reasons({"NOT_ACCEPTED": F.col("o_orderstatus") == "P", "BELOW_COVERAGE": F.col("o_totalprice") < 50000, "STALE": F.col("o_orderpriority") == "5-LOW"})
    return _orders(spark, d).select("o_orderkey", F.array_join(why, ",").alias("reasons"), (F.size(why) == 0).alias("trusted"))


@query("SELECT count(*) AS rows, sum(o_orderkey)::double AS key_sum FROM orders")
def fingerprint(spark, d):
    """R-27: count and order-free checksum of a table."""
    return _orders(spark, d).agg(F.count("*").alias("rows"), hashing.fingerprint(F.col("o_orderkey")).cast("double").alias("key_sum"))


@query("""WITH s AS (SELECT user_id, floor(event_id / 500)::bigint AS package, list_sort(list(DISTINCT event_type)) AS i FROM events GROUP BY 1, 2), l AS (SELECT *, lag(i) OVER (PARTITION BY user_id ORDER BY package) AS b FROM s)
SELECT user_id, package, array_to_string(list_sort(list_filter(i, lambda x: NOT list_contains(b, x))), ',') AS added, array_to_string(list_sort(list_filter(b, lambda x: NOT list_contains(i, x))), ',') AS removed FROM l WHERE b IS NOT NULL""")
def snapshot_set_diff(spark, d):
    """A-5, B-44: items that came and went between a subject's snapshots."""
    rows = _events(spark, d).select("user_id", F.floor(F.col("event_id") / 500).cast("bigint").alias("package"), "event_type")
    out = history.set_differences(rows, ["user_id"], ["package"], "event_type")
    return out.select("user_id", "package", F.array_join(F.array_sort("added"), ",").alias("added"), F.array_join(F.array_sort("removed"), ",").alias("removed"))


@query("""WITH x AS (SELECT DISTINCT o_orderpriority AS p, o_custkey % 20 AS b, o_orderdate::date AS day FROM orders), l AS (SELECT *, lead(day) OVER (PARTITION BY p, b ORDER BY day) AS nx FROM x)
SELECT p, b, (day + 1)::varchar AS gap_from, (nx - 1)::varchar AS gap_to, (nx - day - 1)::int AS days FROM l WHERE nx - day > 1""")
def calendar_gaps(spark, d):
    """A-6: days without an order."""
    rows = _orders(spark, d).select(F.col("o_orderpriority").alias("p"), (F.col("o_custkey") % 20).alias("b"), F.col("o_orderdate").cast("date").alias("day"))
    return history.calendar_gaps(rows, ["p", "b"], "day").select("p", "b", F.col("gap_from").cast("string"), F.col("gap_to").cast("string"), F.col("days").cast("int"))


@query("""SELECT user_id, record, count(*) AS events, min(event_id) AS first_event FROM (SELECT user_id, event_id, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id)::bigint AS record FROM events) GROUP BY 1, 2""")
def islands(spark, d):
    """A-7: records that begin at a marked row."""
    rows = history.islands(_events(spark, d).select("user_id", "event_id", "event_type"), ["user_id"], "event_id", F.col("event_type") == "purchase")
    return rows.groupBy("user_id", "record").agg(F.count("*").alias("events"), F.min("event_id").alias("first_event"))


@query("""SELECT c_nationkey, array_to_string(list_slice(list_sort(list(c_custkey)), 1, 5), ',') AS examples, string_agg(DISTINCT c_mktsegment, '+' ORDER BY c_mktsegment) AS segments, round(sum(c_acctbal::decimal(18,4))::double, 2) AS balance FROM customer GROUP BY 1""")
def bounded_examples(spark, d):
    """R-14, R-22: the first examples, joined names and sums per group."""
    customers = table(spark, d, "customer")
    sums = customers.groupBy("c_nationkey").agg(F.array_join(F.array_sort(F.collect_set("c_mktsegment")), "+").alias("segments"), F.round(_money("c_acctbal"), 2).alias("balance"))
    rows = sums.join(summaries.bounded_examples(customers, ["c_nationkey"], "c_custkey", 5), "c_nationkey", "left")
    return rows.select("c_nationkey", F.array_join(F.transform("examples", lambda x: x.cast("string")), ",").alias("examples"), "segments", "balance")


@query("SELECT c_custkey, array_to_string(list(n_name ORDER BY n_nationkey), '|') AS names FROM customer JOIN nation ON n_regionkey = c_custkey % 5 GROUP BY 1")
def ordered_names(spark, d):
    """R-21, R-24: values of a group in the order of their position."""
    nation = table(spark, d, "nation").select("n_nationkey", "n_regionkey", "n_name")
    rows = table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 5).alias("n_regionkey")).join(nation, "n_regionkey")
    return rows.groupBy("c_custkey").agg(F.array_join(summaries.ordered_values(F.col("n_nationkey"), F.col("n_name")), "|").alias("names"))


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 5")
def top_frequencies(spark, d):
    """R-28: the most frequent combinations, a top-k report."""
    return selection.top_k(_orders(spark, d).groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n")), [F.desc("n"), F.asc("o_orderpriority"), F.asc("o_orderstatus")], 5)


@query("""SELECT c.c_custkey, coalesce(s.st, n.n_name, r.r_name, 'NONE') AS resolved FROM customer c LEFT JOIN (SELECT o_custkey, CASE WHEN min(o_orderpriority) = max(o_orderpriority) THEN max(o_orderpriority) END AS st FROM orders GROUP BY 1) s ON s.o_custkey = c.c_custkey
LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 2 = 0) n ON n.n_nationkey = c.c_nationkey LEFT JOIN nation m ON m.n_nationkey = c.c_nationkey LEFT JOIN region r ON r.r_regionkey = m.n_regionkey""")
def precedence_join(spark, d):
    """J-15: a value by precedence of several sources."""
    single = _orders(spark, d).groupBy(F.col("o_custkey").alias("c_custkey")).agg(summaries.only_value(F.col("o_orderpriority")).alias("st"))
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").select(F.col("n_nationkey").alias("c_nationkey"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).alias("even"), "r_name")
    rows = table(spark, d, "customer").select("c_custkey", "c_nationkey").join(single, "c_custkey", "left").join(nation, "c_nationkey", "left")
    return rows.select("c_custkey", F.coalesce("st", "even", "r_name", F.lit("NONE")).alias("resolved"))


@query("SELECT l_orderkey, l_linenumber, o_orderstatus, p_brand, s_name FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND p_size BETWEEN 10 AND 20")
def case_composite(spark, d):
    """B-34, J-3: one row per line with its order, part and supplier."""
    lines = table(spark, d, "lineitem").where(F.col("l_shipdate") >= F.expr("timestamp_ntz'1998-01-01'")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    part = table(spark, d, "part").where(F.col("p_size").between(10, 20)).select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    supplier = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    orders = _orders(spark, d).select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    return lines.join(part, "l_partkey").join(supplier, "l_suppkey").join(orders, "l_orderkey").select("l_orderkey", "l_linenumber", "o_orderstatus", "p_brand", "s_name")


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity::decimal(18,4))::double, 2) AS sum_qty, round(sum(l_extendedprice::decimal(18,4))::double, 2) AS sum_price, count(*) AS rows FROM lineitem GROUP BY 1, 2")
def pricing_summary(spark, d):
    """R-13: publish metrics of a table."""
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.round(_money("l_quantity"), 2).alias("sum_qty"), F.round(_money("l_extendedprice"), 2).alias("sum_price"), F.count("*").alias("rows"))


@query("SELECT c_nationkey, c_mktsegment, list_contains(g, c_mktsegment) AS known FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer), (SELECT list(DISTINCT c_mktsegment) AS g FROM customer WHERE c_acctbal > 9000)")
def distinct_membership(spark, d):
    """U-3, C-8: distinct pairs and membership in a set."""
    rows = table(spark, d, "customer")
    known = rows.where("c_acctbal > 9000").select("c_mktsegment", F.lit(True).alias("k")).distinct()
    return rows.select("c_nationkey", "c_mktsegment").distinct().join(known, "c_mktsegment", "left").select("c_nationkey", "c_mktsegment", F.coalesce("k", F.lit(False)).alias("known"))


@query("""SELECT n.n_name, l.o_orderkey FROM nation n, LATERAL (SELECT o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey = n.n_nationkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 3) l""")
def lateral_top(spark, d):
    """J-11: the three dearest orders of each nation."""
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = _orders(spark, d).join(table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    best = rows.withColumn("n", F.row_number().over(W.partitionBy("c_nationkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))).where("n <= 3")
    return best.join(nation, "c_nationkey").select("n_name", "o_orderkey")


@query("SELECT doc_id, coalesce(length(text), 0) AS chars, contains(coalesce(text, ''), chr(65533)) AS broken FROM documents WHERE text ILIKE '%priority%' OR text IS NULL")
def text_filter(spark, d):
    """P-7, P-8, F-17: case-free search and broken characters."""
    rows = table(spark, d, "documents").where(F.col("text").ilike("%priority%") | F.col("text").isNull())
    return rows.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("chars"), F.coalesce(text.has_replacement_character(F.col("text")), F.lit(False)).alias("broken"))
