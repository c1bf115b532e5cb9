"""Queries of the generic operators: expressions, joins, aggregations, windows, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverloom.catalog.registry import register
from coverloom.catalog.star import RUN_TS, Star
from coverloom.functions.exprs import (
    as_ntz, below, blank_to_null, cents, col, differs, digest, key, least_strict, number, open_end, unless, valid_date, ymd,
)
from coverloom.functions import schemas as S
from coverloom.operators import aggregates as A
from coverloom.operators import joins as J
from coverloom.operators.ordered import along, append_nodupkey, global_dense_rank, latest_per_key
from coverloom.plans import scd2

_P = "lpad(CAST({} AS VARCHAR), {}, '0')"
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
_LINE_ORDER = ", ".join(LINE_ORDER)


# ------------------------------------------------------------------ expressions

@register("key_build", f"SELECT o_orderkey, {_P.format('o_custkey', 2)} || {_P.format('o_orderkey', 5)} AS k FROM orders")
def key_build(t: Star):
    return t.orders.select("o_orderkey", key(("o_custkey", 2), ("o_orderkey", 5)).alias("k"))


@register("ymd_date", """SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN y >= 1 THEN CAST(try_strptime(lpad(CAST(y AS VARCHAR), 4, '0') || lpad(CAST(m AS VARCHAR), 2, '0')
  || lpad(CAST(d AS VARCHAR), 2, '0'), '%Y%m%d') AS DATE) END AS day FROM (SELECT *, l_partkey % 30 + CASE WHEN l_partkey % 7 = 0 THEN 0 ELSE 1990 END AS y,
  l_suppkey % 14 AS m, CAST(l_quantity AS INTEGER) % 33 AS d FROM lineitem)""")
def ymd_date(t: Star):
    rows = t.lines.select("l_orderkey", "l_partkey", "l_linenumber", (col("l_partkey") % 30 + F.when(col("l_partkey") % 7 == 0, 0).otherwise(1990)).cast("int").alias("y"),
                          (col("l_suppkey") % 14).cast("int").alias("m"), (col("l_quantity").cast("int") % 33).alias("d"))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", ymd("y", "m", "d").alias("day"))


@register("event_day", "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_tax > 0 THEN CAST(l_shipdate AS DATE) END AS day FROM lineitem")
def event_day(t: Star):
    digits = F.when(col("l_tax") > 0, F.date_format("d", "yyyyMMdd")).otherwise("00000000")
    return t.lines.select("l_orderkey", "l_linenumber", "l_partkey", valid_date(digits).alias("day"))


@register("strict_least", """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' AND o_orderpriority <> '1-URGENT' THEN least(CAST(o_orderdate AS DATE),
  DATE '1998-01-01') END AS first_day FROM orders""")
def strict_least(t: Star):
    a = F.when(col("o_orderstatus") != "P", F.col("d"))
    b = F.when(col("o_orderpriority") != "1-URGENT", F.lit("1998-01-01").cast("date"))
    return t.orders.select("o_orderkey", least_strict(a, b).alias("first_day"))


@register("digest_md5", """SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR) || coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, '') || o_orderpriority) AS digest,
  md5(CAST(o_orderkey AS VARCHAR) || chr(31) || coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, '') || chr(31) || o_orderpriority) AS separated FROM orders""")
def digest_md5(t: Star):
    cols = ["o_orderkey", F.when(col("o_orderstatus") != "P", col("o_orderstatus")), "o_orderpriority"]
    return t.orders.select("o_orderkey", digest(cols).alias("digest"), digest(cols, scd2.SEPARATOR).alias("separated"))


@register("safe_number", """SELECT o_orderkey, CAST(TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'P' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS DECIMAL(38,0)) AS DECIMAL(38,0)) AS n,
  CASE WHEN o_orderpriority <> '2-HIGH' THEN o_orderpriority END AS filled FROM orders""")
def safe_number(t: Star):
    text = F.when(col("o_orderstatus") == "P", F.concat(F.lit("P"), col("o_custkey").cast("string"))).otherwise(col("o_custkey").cast("string"))
    return t.orders.select("o_orderkey", number(text).alias("n"),
                           blank_to_null(F.when(col("o_orderpriority") == "2-HIGH", "").otherwise(col("o_orderpriority"))).alias("filled"))


@register("valid_from", """SELECT l_orderkey, l_partkey, l_linenumber, CAST(coalesce(CASE WHEN l_suppkey % 3 <> 0 THEN l_shipdate + to_seconds(l_linenumber) END, TIMESTAMP '2026-07-01 12:00:00') AS VARCHAR) AS since
  FROM lineitem""")
def valid_from(t: Star):
    changed = F.when(col("l_suppkey") % 3 != 0, as_ntz(F.col("d")))
    return t.lines.select("l_orderkey", "l_partkey", "l_linenumber", scd2.valid_from("l_linenumber", changed, RUN_TS).alias("since"))


@register("typed_projection", """SELECT 'Db2' AS source, CAST(l_orderkey AS BIGINT) AS order_no, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) / 100 AS DECIMAL(18,5)) AS amount,
  CAST(NULL AS DATE) AS closed_on, l_returnflag AS flag FROM lineitem""")
def typed_projection(t: Star):
    contract = S.schema("source:string order_no:long amount:decimal(18,5) closed_on:date flag:string")
    rows = t.lines.select(col("l_orderkey").alias("order_no"), cents(col("l_extendedprice").cast("decimal(18,2)")).alias("amount"), col("l_returnflag").alias("flag"))
    return S.shape(rows, contract, source=F.lit("Db2"))


@register("null_safe_filter", """SELECT 'sas' AS mode, count(*) AS n FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS s, CASE WHEN o_custkey % 3 <> 0 THEN o_custkey % 5 END AS p FROM orders)
    WHERE coalesce(s, '') <> 'F' AND coalesce(p, -1) < 3 AND NOT coalesce(s = 'O' AND p IN (0, 1), FALSE)
  UNION ALL SELECT 'sql', count(*) FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS s, CASE WHEN o_custkey % 3 <> 0 THEN o_custkey % 5 END AS p FROM orders)
    WHERE s <> 'F' AND p < 3 AND NOT (s = 'O' AND p IN (0, 1))""")
def null_safe_filter(t: Star):
    rows = t.orders.select(F.when(col("o_orderstatus") != "P", col("o_orderstatus")).alias("s"), F.when(col("o_custkey") % 3 != 0, col("o_custkey") % 5).alias("p"))
    count = lambda m: rows.filter(differs("s", "F", m) & below("p", 3, m) & unless((col("s") == "O") & col("p").isin(0, 1), m)).agg(
        F.lit(m).alias("mode"), F.count(F.lit(1)).alias("n"))
    return count("sas").unionByName(count("sql"))


# ------------------------------------------------------------------ joins

@register("left_lookup", "SELECT o_orderkey, c_mktsegment AS segment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey")
def left_lookup(t: Star):
    return J.lookup(t.orders, t.table("customer").filter(col("c_acctbal") > 0), ["o_custkey"], ["c_custkey"], {"segment": "c_mktsegment"}).select("o_orderkey", "segment")


@register("composite_left", """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, m.n FROM lineitem l LEFT JOIN (SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R'
  GROUP BY ALL) m ON m.l_orderkey = l.l_orderkey AND m.l_suppkey = l.l_suppkey""")
def composite_left(t: Star):
    counts = t.lines.filter(col("l_returnflag") == "R").groupBy("l_orderkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return J.lookup(t.lines, counts, ["l_orderkey", "l_suppkey"], ["l_orderkey", "l_suppkey"], {"n": "n"}).select("l_orderkey", "l_linenumber", "l_partkey", "n")


@register("inner_join", "SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey WHERE s_acctbal > 1000")
def inner_join(t: Star):
    rows = t.table("supplier").filter(col("s_acctbal") > 1000).join(t.table("nation"), col("s_nationkey") == col("n_nationkey"))
    return rows.join(t.table("region"), col("n_regionkey") == col("r_regionkey")).select("s_suppkey", "n_name", "r_name")


@register("right_keep_on_pred", "SELECT o_orderkey, c_name FROM customer RIGHT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F'")
def right_keep_on_pred(t: Star):
    return J.lookup(t.orders, t.table("customer"), ["o_custkey"], ["c_custkey"], {"c_name": "c_name"}, only=col("o_orderstatus") == "F").select("o_orderkey", "c_name")


@register("full_as_left", """SELECT o_orderkey, l_partkey FROM orders FULL JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') ON o_orderkey = l_orderkey
  WHERE o_orderkey IS NOT NULL AND o_orderstatus <> 'P'""")
def full_as_left(t: Star):
    returned = t.lines.filter(col("l_returnflag") == "R")
    return J.lookup(t.orders.filter(col("o_orderstatus") != "P"), returned, ["o_orderkey"], ["l_orderkey"], {"l_partkey": "l_partkey"}).select("o_orderkey", "l_partkey")


@register("anti_null", "SELECT o_orderkey, o_custkey FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON l_orderkey = o_orderkey WHERE l_orderkey IS NULL")
def anti_null(t: Star):
    return J.absent(t.orders, t.lines, ["o_orderkey"], ["l_orderkey"]).select("o_orderkey", "o_custkey")


@register("anti_not_exists", """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem a WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_returnflag = 'R'
  AND a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber AND a.l_linestatus = b.l_linestatus)""")
def anti_not_exists(t: Star):
    keys = ["l_orderkey", "l_linenumber", "l_linestatus"]
    return J.absent(t.lines, t.lines.filter(col("l_returnflag") == "R"), keys).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


_LISTED = "(SELECT CASE WHEN s_acctbal > {} THEN s_suppkey END AS id FROM supplier)"


@register("exclude_in_subquery", """SELECT l_orderkey, l_suppkey, l_linenumber FROM (SELECT *, CASE WHEN l_tax > 0.01 THEN l_suppkey END AS sk FROM lineitem)
  WHERE NOT (l_linenumber = 2 AND coalesce(sk IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000), FALSE))""")
def exclude_in_subquery(t: Star):
    rows = t.lines.withColumn("sk", F.when(col("l_tax") > 0.01, col("l_suppkey")))
    listed = t.table("supplier").select(F.when(col("s_acctbal") > 5000, col("s_suppkey")).alias("id"))
    return J.drop_listed(rows, col("l_linenumber") == 2, "sk", listed, "id").select("l_orderkey", "l_suppkey", "l_linenumber")


@register("exclude_null_aware", f"""SELECT l_orderkey, l_suppkey, l_linenumber FROM (SELECT *, CASE WHEN l_tax > 0.01 THEN l_suppkey END AS sk FROM lineitem)
  WHERE NOT (l_linenumber = 2 AND sk IN {_LISTED.format(5000)})""")
def exclude_null_aware(t: Star):
    rows = t.lines.withColumn("sk", F.when(col("l_tax") > 0.01, col("l_suppkey")))
    listed = t.table("supplier").select(F.when(col("s_acctbal") > 5000, col("s_suppkey")).alias("id"))
    return J.drop_listed(rows, col("l_linenumber") == 2, "sk", listed, "id", null_aware=True).select("l_orderkey", "l_suppkey", "l_linenumber")


@register("semi_distinct", "SELECT l_orderkey, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus = 'P')")
def semi_distinct(t: Star):
    return J.present(t.lines, t.orders.filter(col("o_orderstatus") == "P"), ["l_orderkey"], ["o_orderkey"]).select("l_orderkey", "l_partkey")


@register("exist_flag", "SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45) THEN '1' ELSE '0' END AS big FROM orders")
def exist_flag(t: Star):
    return J.flagged(t.orders, t.lines.filter(col("l_quantity") > 45), ["o_orderkey"], ["l_orderkey"], "big").select("o_orderkey", "big")


@register("stats_cross", "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders WHERE CAST(o_totalprice AS DECIMAL(18,2)) > (SELECT max(CAST(o_totalprice AS DECIMAL(18,2))) / 2 FROM orders)")
def stats_cross(t: Star):
    rows = t.orders.select("o_orderkey", col("o_totalprice").cast("decimal(18,2)").alias("price"))
    stats = rows.agg((F.max("price") / 2).alias("limit"))
    return J.with_stats(rows, stats).filter(col("price") > col("limit")).drop("limit")


@register("valid_now", """SELECT c_custkey, n_nationkey + 1500 AS rk FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""")
def valid_now(t: Star):
    dim = J.valid_now(t.structures(), RUN_TS)
    rows = t.table("customer").withColumn("agency", F.concat(F.lit("A"), col("c_nationkey").cast("string")))
    return J.lookup(rows, dim, ["agency"], ["AGENCY_INT_ID"], {"rk": "BSN_STRUCTURE_RK"}).select("c_custkey", col("rk").cast("int").alias("rk"))


@register("latest_dim", "SELECT s_suppkey, CAST(n_nationkey + 400 AS BIGINT) AS category FROM supplier LEFT JOIN nation ON n_nationkey + 1 = s_suppkey % 30")
def latest_dim(t: Star):
    dim = J.latest_version(t.category_dimension(), "PRODUCT_CATEGORY_CD", "PRODUCT_CATEGORY_RK")
    rows = t.table("supplier").withColumn("code", F.lpad((col("s_suppkey") % 30).cast("string"), 2, "0"))
    return J.lookup(rows, dim, ["code"], ["PRODUCT_CATEGORY_CD"], {"category": "PRODUCT_CATEGORY_RK"}).select("s_suppkey", "category")


@register("self_join_subset", """SELECT a.o_orderkey, coalesce(b.o_orderstatus, 'none') AS newest FROM orders a LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') b
  ON a.o_custkey = b.o_custkey AND a.o_orderkey = b.o_orderkey""")
def self_join_subset(t: Star):
    urgent = t.orders.filter(col("o_orderpriority") == "1-URGENT")
    rows = J.lookup(t.orders, urgent, ["o_custkey", "o_orderkey"], ["o_custkey", "o_orderkey"], {"_s": "o_orderstatus"})
    return rows.select("o_orderkey", F.coalesce("_s", F.lit("none")).alias("newest"))


@register("fallback_chain", """SELECT l_orderkey, l_partkey, l_linenumber, coalesce(p.p_name, s.s_name, 'none') AS name FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 30) p ON p_partkey = l_partkey
  LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON s_suppkey = l_suppkey""")
def fallback_chain(t: Star):
    rows = J.lookup(t.lines, t.table("part").filter(col("p_size") > 30), ["l_partkey"], ["p_partkey"], {"_p": "p_name"})
    rows = J.lookup(rows, t.table("supplier").filter(col("s_acctbal") > 0), ["l_suppkey"], ["s_suppkey"], {"_s": "s_name"})
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", F.coalesce("_p", "_s", F.lit("none")).alias("name"))


@register("multiply_back", "SELECT o_orderkey, o_orderstatus, l_linenumber, l_returnflag FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def multiply_back(t: Star):
    return t.orders.join(t.lines, col("o_orderkey") == col("l_orderkey")).select("o_orderkey", "o_orderstatus", "l_linenumber", "l_returnflag")


# ------------------------------------------------------------------ aggregations

@register("max_version", "SELECT l_orderkey, l_suppkey, max(l_linenumber) AS version FROM lineitem WHERE l_quantity < 40 GROUP BY 1, 2")
def max_version(t: Star):
    return t.lines.filter(col("l_quantity") < 40).groupBy("l_orderkey", "l_suppkey").agg(F.max("l_linenumber").alias("version"))


@register("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_suppkey FROM lineitem")
def distinct_rows(t: Star):
    return t.lines.select("l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey").distinct()


@register("cond_distinct", """SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_orderkey END) AS f_orders,
  count(CASE WHEN l_quantity > 40 THEN 1 END) AS big, CAST(sum(CASE WHEN l_tax > 0.05 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(38,2)) AS taxed FROM lineitem GROUP BY 1""")
def cond_distinct(t: Star):
    price = col("l_extendedprice").cast("decimal(18,2)")
    return t.lines.groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"), A.distinct_where(col("l_linestatus") == "F", "l_orderkey").alias("f_orders"),
        A.count_where(col("l_quantity") > 40).alias("big"), F.sum(F.when(col("l_tax") > 0.05, price).otherwise(0)).cast("decimal(38,2)").alias("taxed"))


@register("share_of_total", """SELECT p_brand, total, round(CAST(total AS DOUBLE) / sum(CAST(total AS DOUBLE)) OVER () * 100, 1) AS "PCT" FROM (
  SELECT p_brand, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)""")
def share_of_total(t: Star):
    rows = t.lines.join(t.table("part"), col("l_partkey") == col("p_partkey")).groupBy("p_brand").agg(
        F.sum(col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total"))
    return A.share_of_total(rows, "total")


_PROFILED = ["o_orderkey", "o_custkey", "o_orderstatus", "late"]


@register("column_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count({c}) AS non_null, count(DISTINCT {c}) AS distinct_values FROM q" for c in _PROFILED).join(
    ["WITH q AS (SELECT *, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS late FROM orders) ", ""]))
def column_profile(t: Star):
    return A.column_profile(t.orders.withColumn("late", F.when(col("o_orderstatus") == "P", col("o_orderpriority"))).select(*_PROFILED))


# ------------------------------------------------------------------ windows

@register("dedup_latest", """SELECT l_orderkey, l_suppkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber DESC, l_partkey, l_shipdate,
  l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_latest(t: Star):
    order = [col("l_linenumber").desc(), col("l_partkey").asc(), col("l_shipdate").asc(), col("l_extendedprice").asc()]
    return latest_per_key(t.lines, ["l_orderkey", "l_suppkey"], order).select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey")


@register("append_nodupkey", """SELECT k, v, src FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY v DESC, src) AS rn FROM (
  SELECT o_custkey AS k, CAST(o_orderkey AS BIGINT) AS v, 'orders' AS src FROM orders UNION ALL SELECT l_suppkey, l_orderkey, 'lines' FROM lineitem)) WHERE rn = 1""")
def append_nodup(t: Star):
    a = t.orders.select(col("o_custkey").alias("k"), col("o_orderkey").alias("v"), F.lit("orders").alias("src"))
    b = t.lines.select(col("l_suppkey").alias("k"), col("l_orderkey").alias("v"), F.lit("lines").alias("src"))
    return append_nodupkey([a, b], ["k"], [col("v").desc(), col("src").asc()])


@register("seq_offset", f"SELECT l_orderkey, l_partkey, l_linenumber, 299 + row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS pos FROM lineitem")
def seq_offset(t: Star):
    return along(t.lines, ["l_orderkey"], LINE_ORDER, rank="rn").select("l_orderkey", "l_partkey", "l_linenumber", (col("rn") + 299).alias("pos"))


@register("prev_status", f"SELECT l_orderkey, l_partkey, l_linenumber, coalesce(lag(l_returnflag) OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}), '') AS before FROM lineitem")
def prev_status(t: Star):
    rows = along(t.lines, ["l_orderkey"], LINE_ORDER, prev=("p", ["l_returnflag"]))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", F.coalesce(F.col("p.l_returnflag"), F.lit("")).alias("before"))


@register("lead_validity", """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS VARCHAR) AS since, CAST(coalesce(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
  - INTERVAL 1 SECOND, TIMESTAMP '5999-01-01 00:00:00') AS VARCHAR) AS until FROM orders""")
def lead_validity(t: Star):
    rows = along(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], next=("n", ["o_orderdate"]))
    until = F.coalesce(F.col("n.o_orderdate") - F.expr("interval 1 second"), open_end())
    return rows.select("o_orderkey", "o_custkey", col("o_orderdate").alias("since"), until.alias("until"))


@register("first_last", f"""SELECT l_orderkey, l_partkey, l_linenumber, row_number() OVER w = 1 AS is_first, lead(1) OVER w IS NULL AS is_last FROM lineitem
  WINDOW w AS (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER})""")
def first_last(t: Star):
    rows = along(t.lines, ["l_orderkey"], LINE_ORDER, prev=("p", ["l_partkey"]), next=("n", ["l_partkey"]))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", F.col("p").isNull().alias("is_first"), F.col("n").isNull().alias("is_last"))


@register("retain_max", "SELECT l_orderkey, l_partkey, l_linenumber, max(CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) END) OVER (PARTITION BY l_orderkey) AS returned FROM lineitem")
def retain_max(t: Star):
    rows = along(t.lines, ["l_orderkey"], ["l_linenumber"], whole={"returned": F.when(col("l_returnflag") == "R", F.col("d"))})
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "returned")


def _flag_sql(zero: bool) -> str:
    n = "coalesce(n, 0)" if zero else "n"
    return f"""SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_returnflag = 'R' AND {n} = 0 THEN '1' ELSE '0' END AS flag FROM (SELECT *, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)
  OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n FROM lineitem)"""


def _flag(t: Star, zero: bool):
    hit = col("l_returnflag") == "R"
    rows = along(t.lines, ["l_orderkey"], LINE_ORDER, earlier=("n", hit))
    n = F.coalesce("n", F.lit(0)) if zero else F.col("n")
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", F.when(hit & (n == 0), "1").otherwise("0").alias("flag"))


@register("first_flag_zero", _flag_sql(True))
def first_flag_zero(t: Star):
    return _flag(t, True)


@register("first_flag_null", _flag_sql(False))
def first_flag_null(t: Star):
    return _flag(t, False)


_RANKED = "CASE WHEN l_suppkey % 7 <> 0 THEN l_suppkey END"


@register("global_dense_rank", f"""SELECT l_orderkey, l_partkey, l_linenumber, dense_rank() OVER (ORDER BY sk NULLS LAST, l_returnflag NULLS LAST, l_linenumber NULLS LAST) AS rk
  FROM (SELECT *, {_RANKED} AS sk FROM lineitem)""")
def dense_rank(t: Star):
    rows = t.lines.select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", F.when(col("l_suppkey") % 7 != 0, col("l_suppkey")).alias("sk"))
    return global_dense_rank(rows, ["sk", "l_returnflag", "l_linenumber"], "rk").select("l_orderkey", "l_partkey", "l_linenumber", "rk")


# ------------------------------------------------------------------ sorts and sets

@register("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def topk(t: Star):
    return t.orders.orderBy(col("o_totalprice").desc(), "o_orderkey").limit(50).select("o_orderkey", "o_totalprice")


@register("union_fill", """SELECT o_orderkey AS k, o_orderstatus AS s, CAST(NULL AS DOUBLE) AS price FROM orders UNION ALL SELECT l_orderkey, NULL, l_extendedprice FROM lineitem""")
def union_fill(t: Star):
    a = t.orders.select(col("o_orderkey").alias("k"), col("o_orderstatus").alias("s"))
    b = t.lines.select(col("l_orderkey").alias("k"), col("l_extendedprice").alias("price"))
    return a.unionByName(b, allowMissingColumns=True)


@register("union_distinct", "SELECT o_custkey AS k FROM orders UNION SELECT l_suppkey FROM lineitem UNION SELECT c_custkey FROM customer")
def union_distinct(t: Star):
    names = [(t.orders, "o_custkey"), (t.lines, "l_suppkey"), (t.table("customer"), "c_custkey")]
    parts = [df.select(col(c).alias("k")) for df, c in names]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


_COUNTED = ["customer", "lineitem", "nation", "orders", "part", "region", "supplier"]


@register("table_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in _COUNTED))
def table_counts(t: Star):
    return A.table_counts({n: t.table(n) for n in _COUNTED})


@register("distribution", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def distribution(t: Star):
    return t.table("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@register("user_sequence", """SELECT event_id, user_id, coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id), '') AS before, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos
  FROM events""")
def user_sequence(t: Star):
    rows = along(t.table("events"), ["user_id"], ["ts", "event_id"], prev=("p", ["event_type"]), rank="pos")
    return rows.select("event_id", "user_id", F.coalesce(F.col("p.event_type"), F.lit("")).alias("before"), "pos")
