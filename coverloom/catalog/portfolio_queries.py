"""Portfolio, metric-layer, data-quality and governance queries over exposure-shaped line items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coverloom.catalog.registry import register
from coverloom.catalog.star import Star
from coverloom.catalog.star_sql import OPEN, with_
from coverloom.functions.exprs import col
from coverloom.plans import governance, metrics, portfolio, quality

X = with_(f"""
x AS (SELECT l_orderkey AS pk, l_linenumber AS ver, l_partkey % 6 + 910 AS cov, l_linestatus AS ordr,
    CASE WHEN l_suppkey % 50 <> 7 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CASE WHEN l_partkey % 500 = 0 THEN 60 ELSE 1 END AS DECIMAL(38,2)) END AS amt,
    CAST(CAST(l_quantity * 100 AS DECIMAL(18,2)) AS DECIMAL(38,2)) AS cash, l_returnflag AS status, CASE WHEN l_linestatus = 'F' THEN 'V' ELSE 'T' END AS renew,
    CAST(CAST(l_shipdate AS DATE) + INTERVAL 252 MONTH AS DATE) AS eff, CASE WHEN l_returnflag = 'R' THEN CAST(CAST(l_shipdate AS DATE) + INTERVAL 264 MONTH AS DATE) END AS term,
    CASE WHEN l_linestatus = 'F' THEN CAST(CAST(l_shipdate AS DATE) + 90 AS TIMESTAMP) ELSE {OPEN} END AS vt FROM lineitem),
cv AS (SELECT r_regionkey + 910 AS rk, left(r_name, 2) AS kind, r_name AS name FROM region)""")


def _coverage(t: Star) -> DataFrame:
    """Current generation of the coverage dimension."""
    return t.coverage_dimension().filter(col("COVERAGE_RK") >= 910)


def _tables(t: Star) -> dict[str, DataFrame]:
    policy = t.orders.select(col("o_orderkey").alias("POLICY_RK"), col("o_orderpriority").alias("POLICY_NO"), col("o_orderstatus").alias("POLICY_STATUS_CD"))
    return {"LIFE_UNIT_OF_EXPOSURE": t.exposures(), "COVERAGE": _coverage(t), "INSURANCE_POLICY": policy}


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Sums of doubles depend on the order of addition; both engines are compared after rounding."""
    return df.withColumns({c: F.round(col(c), n) for c, n in digits.items()})


@register("kpis", X + """ SELECT count(*) AS TOTAL_EXPOSURES, count(DISTINCT pk) AS TOTAL_POLICIES, round(sum(CAST(amt AS DOUBLE)), 2) AS TOTAL_PREMIUM,
  round(avg(CAST(amt AS DOUBLE)), 4) AS AVG_PREMIUM, round(sum(CAST(cash AS DOUBLE)), 2) AS TOTAL_CASH_VALUE, count(DISTINCT CASE WHEN term IS NOT NULL THEN pk END) AS TERMINATED_POLICIES,
  round(CAST(count(DISTINCT CASE WHEN term IS NOT NULL THEN pk END) AS DOUBLE) / nullif(count(DISTINCT pk), 0) * 100, 6) AS LAPSE_RATE_PCT FROM x""")
def kpis(t: Star):
    return _rounded(portfolio.kpis(t.exposures()), TOTAL_PREMIUM=2, AVG_PREMIUM=4, TOTAL_CASH_VALUE=2, LAPSE_RATE_PCT=6)


# Edges for the given prices; the labels stay.
_EDGES = [(0, "0 - Sem premio"), (10_000, "1 - Ate 10K"), (50_000, "2 - 10K-50K"), (100_000, "3 - 50K-100K"), (500_000, "4 - 100K-500K"), (1_000_000, "5 - 500K-1M")]


@register("bands", X + """ SELECT CASE WHEN amt <= 0 THEN '0 - Sem premio' WHEN amt <= 10000 THEN '1 - Ate 10K' WHEN amt <= 50000 THEN '2 - 10K-50K' WHEN amt <= 100000 THEN '3 - 50K-100K'
  WHEN amt <= 500000 THEN '4 - 100K-500K' WHEN amt <= 1000000 THEN '5 - 500K-1M' ELSE '6 - >1M' END AS PREMIUM_BAND, count(DISTINCT pk) AS NUM_POLICIES,
  round(sum(CAST(amt AS DOUBLE)), 2) AS TOTAL_PREMIUM FROM x WHERE amt IS NOT NULL GROUP BY 1""")
def bands(t: Star):
    return _rounded(portfolio.premium_bands(t.exposures(), _EDGES), TOTAL_PREMIUM=2)


@register("bands_shipped", X + """ SELECT CASE WHEN amt <= 0 THEN '0 - Sem premio' WHEN amt <= 1000000 THEN '1 - Ate 10K' WHEN amt <= 5000000 THEN '2 - 10K-50K' ELSE '3 - 50K-100K' END AS PREMIUM_BAND,
  count(DISTINCT pk) AS NUM_POLICIES, round(sum(CAST(amt AS DOUBLE)), 2) AS TOTAL_PREMIUM FROM x WHERE amt IS NOT NULL GROUP BY 1""")
def bands_shipped(t: Star):
    return _rounded(portfolio.premium_bands(t.exposures()), TOTAL_PREMIUM=2)


@register("monthly", X + """ SELECT CAST(date_trunc('month', eff) AS DATE) AS MONTH, count(DISTINCT pk) AS NEW_POLICIES, round(sum(CAST(amt AS DOUBLE)), 2) AS PREMIUM,
  count(DISTINCT CASE WHEN term IS NOT NULL THEN pk END) AS TERMINATED FROM x WHERE eff >= DATE '2020-01-01' AND eff < DATE '2026-07-01' GROUP BY 1""")
def monthly(t: Star):
    return _rounded(portfolio.monthly_trend(t.exposures(), "2020-01-01", "2026-07-01"), PREMIUM=2)


_CONC = """, c AS (SELECT kind AS COVERAGE_TYPE_CD, name AS COVERAGE_NAME, count(DISTINCT pk) AS NUM_POLICIES, sum(amt) AS total, sum(cash) AS cash, avg(CAST(amt AS DOUBLE)) AS a
  FROM x JOIN cv ON cov = rk GROUP BY 1, 2)"""


@register("concentration", X + _CONC + """ SELECT COVERAGE_TYPE_CD, COVERAGE_NAME, NUM_POLICIES, round(CAST(total AS DOUBLE), 2) AS TOTAL_PREMIUM, round(CAST(cash AS DOUBLE), 2) AS TOTAL_CASH_VALUE,
  round(a, 4) AS AVG_PREMIUM, round(CAST(total AS DOUBLE) / (SELECT CAST(sum(total) AS DOUBLE) FROM c) * 100, 1) AS PCT FROM c""")
def concentration(t: Star):
    return _rounded(portfolio.concentration(t.exposures(), _coverage(t)), TOTAL_PREMIUM=2, TOTAL_CASH_VALUE=2, AVG_PREMIUM=4)


@register("concentration_alert", X + _CONC + """ SELECT COVERAGE_TYPE_CD, NUM_POLICIES FROM c WHERE total = (SELECT max(total) FROM c)
  AND round(CAST(total AS DOUBLE) / (SELECT CAST(sum(total) AS DOUBLE) FROM c) * 100, 1) > 10""")
def concentration_alert(t: Star):
    return portfolio.concentration_alert(portfolio.concentration(t.exposures(), _coverage(t)), 10.0).select("COVERAGE_TYPE_CD", "NUM_POLICIES")


_OUT = """, s AS (SELECT avg(CAST(amt AS DOUBLE)) AS a, stddev_samp(CAST(amt AS DOUBLE)) AS d FROM x WHERE amt > 0),
o AS (SELECT pk AS POLICY_RK, status AS STATUS, CAST(amt AS DOUBLE) AS PREMIUM, CAST(cash AS DOUBLE) AS CASH_VALUE, eff AS EFFECTIVE_DT, term AS TERMINATION_DT,
  round((CAST(amt AS DOUBLE) - a) / nullif(d, 0), 2) AS Z_SCORE FROM x, s WHERE CAST(amt AS DOUBLE) > a + 4 * d ORDER BY amt DESC, pk, eff, cash LIMIT 50)"""


@register("outliers", X + _OUT + " SELECT * FROM o")
def outliers(t: Star):
    return portfolio.outliers(t.exposures())


@register("leaders", X + _OUT + " SELECT POLICY_RK, STATUS, PREMIUM, Z_SCORE FROM (SELECT * FROM o ORDER BY PREMIUM DESC, POLICY_RK, EFFECTIVE_DT, CASH_VALUE LIMIT 10)")
def leaders(t: Star):
    return portfolio.leaders(portfolio.outliers(t.exposures()))


@register("by_year", X + """ SELECT CAST(year(term) AS INTEGER) AS TERMINATION_YEAR, count(DISTINCT pk) AS TERMINATED_POLICIES, round(sum(CAST(amt AS DOUBLE)), 2) AS LOST_PREMIUM
  FROM x WHERE year(term) BETWEEN 2015 AND 2026 GROUP BY 1""")
def by_year(t: Star):
    return _rounded(portfolio.terminations_by_year(t.exposures(), 2015, 2026), LOST_PREMIUM=2)


@register("status_dist", X + " SELECT status AS STATUS_CODE, count(DISTINCT pk) AS NUM_POLICIES, round(sum(CAST(amt AS DOUBLE)), 2) AS TOTAL_PREMIUM FROM x GROUP BY 1")
def status_dist(t: Star):
    return _rounded(portfolio.status_distribution(t.exposures()), TOTAL_PREMIUM=2)


@register("kpis_current", X + " SELECT count(*) AS TOTAL_EXPOSURES, count(DISTINCT pk) AS TOTAL_POLICIES FROM x WHERE CAST(vt AS DATE) = DATE '5999-01-01'")
def kpis_current(t: Star):
    return portfolio.kpis(t.exposures(), current_only=True).select("TOTAL_EXPOSURES", "TOTAL_POLICIES")


@register("metric_layer", X + """ SELECT o_orderstatus AS POLICY_STATUS_CD, kind AS COVERAGE_TYPE_CD, status AS X_POLICY_STATUS_CD, sum(amt) AS TOTAL_PREMIUM, sum(cash) AS TOTAL_CASH_VALUE,
  count(DISTINCT pk) AS NUM_POLICIES, count(*) AS NUM_EXPOSURES, count(DISTINCT CASE WHEN term IS NOT NULL THEN pk END) AS TERMINATED_POLICIES,
  sum(CASE WHEN term IS NOT NULL THEN amt ELSE 0 END) AS LOST_PREMIUM FROM x JOIN cv ON cov = rk LEFT JOIN orders ON o_orderkey = pk GROUP BY 1, 2, 3""")
def metric_layer(t: Star):
    return metrics.EXPOSURES.query(_tables(t), ["total premium", "TOTAL_CASH_VALUE", "NUM_POLICIES", "NUM_EXPOSURES", "TERMINATED_POLICIES", "LOST_PREMIUM"],
                                   ["POLICY_STATUS_CD", "coverage type", "X_POLICY_STATUS_CD"])


@register("vq1", X + " SELECT status AS X_POLICY_STATUS_CD, count(DISTINCT pk) AS NUM_POLICIES, sum(amt) AS TOTAL_PREMIUM FROM x GROUP BY 1")
def vq1(t: Star):
    return metrics.premium_by_status(_tables(t))


@register("vq2", X + " SELECT CAST(date_trunc('month', eff) AS DATE) AS MONTH, count(DISTINCT pk) AS NEW_POLICIES, sum(amt) AS PREMIUM FROM x WHERE eff IS NOT NULL GROUP BY 1")
def vq2(t: Star):
    return metrics.monthly_evolution(_tables(t))


@register("vq3", X + """ SELECT status AS X_POLICY_STATUS_CD, kind AS COVERAGE_TYPE_CD, count(*) AS EXPOSURE_COUNT, sum(amt) AS TOTAL_PREMIUM, sum(cash) AS TOTAL_CASH_VALUE
  FROM x JOIN cv ON cov = rk GROUP BY 1, 2""")
def vq3(t: Star):
    return metrics.premium_by_status_coverage(_tables(t))


@register("vq4", X + " SELECT count(DISTINCT pk) AS TERMINATED_POLICIES, sum(amt) AS LOST_PREMIUM FROM x WHERE term IS NOT NULL")
def vq4(t: Star):
    return metrics.terminated_policies(_tables(t))


@register("vq5", X + " SELECT renew AS RENEWABLE_IND, count(DISTINCT pk) AS NUM_POLICIES, round(CAST(sum(amt) AS DOUBLE) / count(amt), 4) AS AVG_PREMIUM FROM x GROUP BY 1")
def vq5(t: Star):
    return metrics.avg_premium_renewable(_tables(t)).withColumn("AVG_PREMIUM", F.round(col("AVG_PREMIUM").cast("double"), 4))


@register("dq_outlier", X + """ SELECT count(*) AS ANOMALIES FROM x WHERE vt >= TIMESTAMP '5999-01-01 00:00:00'
  AND CAST(amt AS DOUBLE) > (SELECT avg(CAST(amt AS DOUBLE)) + 3 * stddev_samp(CAST(amt AS DOUBLE)) FROM x)""")
def dq_outlier(t: Star):
    return quality.premium_anomalies(t.exposures())


@register("dq_rate", X + " SELECT round(CAST(count(CASE WHEN status = 'R' THEN 1 END) AS DOUBLE) / nullif(count(*), 0) * 100, 6) AS LAPSE_RATE FROM x WHERE vt >= TIMESTAMP '5999-01-01 00:00:00'")
def dq_rate(t: Star):
    return _rounded(quality.lapse_rate(t.exposures(), col("X_POLICY_STATUS_CD") == "R"), LAPSE_RATE=6)


@register("dq_alerts", X + """ SELECT 'PREMIUM_ANOMALY' AS ALERT_TYPE, round(CAST(count(*) AS DOUBLE), 4) AS RECORD_COUNT FROM x WHERE vt >= TIMESTAMP '5999-01-01 00:00:00'
  AND CAST(amt AS DOUBLE) > (SELECT avg(CAST(amt AS DOUBLE)) + 3 * stddev_samp(CAST(amt AS DOUBLE)) FROM x) HAVING count(*) > 0
UNION ALL SELECT 'PERSISTENCY_ALERT', round(CAST(count(CASE WHEN status = 'R' THEN 1 END) AS DOUBLE) / nullif(count(*), 0) * 100, 4) FROM x WHERE vt >= TIMESTAMP '5999-01-01 00:00:00'
  HAVING CAST(count(CASE WHEN status = 'R' THEN 1 END) AS DOUBLE) / nullif(count(*), 0) * 100 > 5""")
def dq_alerts(t: Star):
    table, ts = t.exposures(), "2026-07-01 12:00:00"
    both = quality.anomaly_alert(table, ts).unionByName(quality.lapse_alert(table, col("X_POLICY_STATUS_CD") == "R", ts))
    return _rounded(both.select("ALERT_TYPE", "RECORD_COUNT"), RECORD_COUNT=4)


def _reconciled(t: Star, **other) -> quality.Reconciliation:
    """The table against a copy in which one status has other amounts; ``other`` columns are added to the copy, or dropped if None."""
    ours = t.exposures().select("UOE_RK", "POLICY_RK", "X_POLICY_VERSION", "X_POLICY_STATUS_CD", "ANNUAL_PREMIUM_AMT", "VALID_TO_DTTM")
    changed = F.when(col("X_POLICY_STATUS_CD") == "A", col("ANNUAL_PREMIUM_AMT") + 1).otherwise(col("ANNUAL_PREMIUM_AMT"))
    theirs = ours.withColumn("ANNUAL_PREMIUM_AMT", changed.cast("decimal(38,2)"))
    for name, value in other.items():
        theirs = theirs.drop(name) if value is None else theirs.withColumn(name, value)
    return quality.reconcile(ours, theirs, ["POLICY_RK", "X_POLICY_VERSION"], ["ANNUAL_PREMIUM_AMT"], "X_POLICY_STATUS_CD")


_PAIR = """, a AS (SELECT pk, CAST(ver AS DECIMAL(38,0)) AS ver, status, amt, vt >= TIMESTAMP '5999-01-01 00:00:00' AS op FROM x),
b AS (SELECT pk, ver, status, CAST(CASE WHEN status = 'A' THEN amt + 1 ELSE amt END AS DECIMAL(38,2)) AS amt, op FROM a)"""


@register("reconcile", X + _PAIR + """ SELECT POLICY_RK, X_POLICY_VERSION, X_POLICY_STATUS_CD, ANNUAL_PREMIUM_AMT, IS_OPEN, CAST(sum(n) AS BIGINT) AS surplus FROM (
  SELECT pk AS POLICY_RK, ver AS X_POLICY_VERSION, status AS X_POLICY_STATUS_CD, amt AS ANNUAL_PREMIUM_AMT, op AS IS_OPEN, 1 AS n FROM a
  UNION ALL SELECT pk, ver, status, amt, op, -1 FROM b) GROUP BY ALL HAVING sum(n) <> 0""")
def reconcile(t: Star):
    return _reconciled(t).differences


@register("reconcile_totals", X + _PAIR + """ SELECT 'ours' AS side, count(*) AS row_count, count(DISTINCT (pk, ver)) AS distinct_keys, sum(amt) AS "sum_ANNUAL_PREMIUM_AMT" FROM a
  UNION ALL SELECT 'theirs', count(*), count(DISTINCT (pk, ver)), sum(amt) FROM b""")
def reconcile_totals(t: Star):
    return _reconciled(t).totals


@register("reconcile_status", X + _PAIR + """ SELECT 'ours' AS side, status AS X_POLICY_STATUS_CD, count(*) AS n FROM a GROUP BY ALL
  UNION ALL SELECT 'theirs', status, count(*) FROM b GROUP BY ALL""")
def reconcile_status(t: Star):
    return _reconciled(t).distribution


_PROFILE = {"POLICY_RK": "pk", "X_POLICY_VERSION": "ver", "X_POLICY_STATUS_CD": "status", "ANNUAL_PREMIUM_AMT": "amt", "IS_OPEN": "op"}


@register("reconcile_profile", X + _PAIR + " " + " UNION ALL ".join(
    [f"""SELECT '{name}' AS column_name, {"NULL" if name == "IS_OPEN" else "'both'"} AS found_in, '{side}' AS side, count(*) AS row_count, count({c}) AS non_null,
  count(DISTINCT {c}) AS distinct_values FROM {table}""" for name, c in _PROFILE.items() for side, table in (("ours", "a"), ("theirs", "b"))]
    + [f"SELECT '{name}', '{found}', NULL, NULL, NULL, NULL" for name, found in (("UOE_RK", "ours"), ("VALID_TO_DTTM", "both"), ("LOAD_NO", "theirs"))]))
def reconcile_profile(t: Star):
    """Column sets of both sides, where the copy lacks one column and has another, and the profile of what both have."""
    r = _reconciled(t, UOE_RK=None, LOAD_NO=F.lit(1))
    return r.columns.join(r.profile, "column_name", "full").select("column_name", "found_in", "side", "row_count", "non_null", "distinct_values")


@register("mask_pii", "SELECT c_custkey, '***MASKED***' AS c_name, c_mktsegment FROM customer")
def mask_pii(t: Star):
    return governance.mask_columns(t.table("customer").select("c_custkey", "c_name", "c_mktsegment"), {"c_name": "NAME"}, "ANALYST")


@register("mask_privileged", "SELECT c_custkey, c_name FROM customer")
def mask_privileged(t: Star):
    return governance.mask_columns(t.table("customer").select("c_custkey", "c_name"), {"c_name": "NAME"}, "DATA_ENGINEER")
