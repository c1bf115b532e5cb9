"""Oracle side of the test views: the same rules as plain SQL common table expressions.

The oracle is written for a second engine and built with UNIONs and correlated steps where the
library uses one pass, so that both sides agree only if the semantics agree.
"""

from __future__ import annotations

RUN_TS = "TIMESTAMP '2026-07-01 12:00:00'"
OPEN = "TIMESTAMP '5999-01-01 00:00:00'"


def cls(k: str) -> str:
    return f"(CASE WHEN {k} % 13 = 12 THEN 21 ELSE {k} % 13 + 1 END)"


def pad(x: str, n: int) -> str:
    return f"lpad(CAST({x} AS VARCHAR), {n}, '0')"


def id9(k: str) -> str:
    return f"({pad(f'(({k}) // 100000) % 100', 2)} || {pad(f'(({k}) // 10000000) % 100', 2)} || {pad(f'({k}) % 100000', 5)})"


def pol(c: str, n: str) -> str:
    return f"({pad(cls(c), 2)} || {pad(n, 8)})"


def amount(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,5))"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


PRICE = "CAST(o_totalprice AS DECIMAL(18,2))"

RECEIPT = f"""
ord AS (SELECT *, o_orderkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders),
li AS (SELECT *, CAST(l_shipdate AS DATE) AS d FROM lineitem),
raw_receipt AS (
  SELECT {id9('k')} AS id, {pol('o_custkey', 'o_custkey')} AS policy, {pol('o_custkey', '(o_custkey + 1)')} AS proposal,
    [0, 1, 2, 3, 5, 9][k % 6 + 1] AS st, [0, 1, 2, NULL][(k // 6) % 4 + 1] AS prev,
    [5, 9, 6, 1, NULL, 2, 2, 2][(k // 24) % 8 + 1] AS sub,
    ['F', 'K', 'H', 'A', NULL, 'X', 'X', 'X', 'X', 'X'][(k // 7) % 10 + 1] AS mark, *
  FROM ord),
receipt AS (
  SELECT id, policy, proposal, st, prev, sub, mark, k,
    CASE WHEN st = 5 THEN d + 40 END AS paid, d + 5 AS valued, CASE WHEN k % 17 <> 0 THEN d + 3 END AS emitted, d AS created,
    CASE WHEN k % 11 <> 0 THEN d + 10 END AS done, d AS p_from, d + 365 AS p_to, CASE WHEN st = 9 THEN d + 60 END AS cancelled, d + 20 AS moved,
    CASE WHEN st = 9 THEN k % 7 END AS cancel_reason,
    {amount(PRICE)} AS gross,
    {amount(f"{PRICE} - 5.00 + CASE WHEN mark = 'K' AND sub = 9 THEN 2.50 ELSE 0.00 END")} AS net,
    {amount(f"{PRICE} - CASE WHEN {cls('o_custkey')} BETWEEN 5 AND 12 THEN 0.00 ELSE 7.00 END")} AS pure,
    {amount("k % 5")} AS inem, k % 4 AS method,
    CASE WHEN mark = 'H' THEN '1' ELSE '0' END AS reinvested, CASE WHEN k % 9 = 0 THEN '' ELSE 'A' || CAST(o_custkey % 40 AS VARCHAR) END AS agency,
    CASE WHEN k % 5 = 0 THEN '1' ELSE '0' END AS participation,
    CASE WHEN st IN (5, 9) THEN 'Y' ELSE 'N' END AS is_closed,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 0
         WHEN {cls('o_custkey')} BETWEEN 5 AND 12 THEN {PRICE} / 100 + 0.3
         WHEN k % 5 <> 0 THEN {PRICE} / 100 - (k % 5) / 10 ELSE 0 END AS charge_raw,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END AS has_fee, o_totalprice
  FROM raw_receipt WHERE NOT coalesce(mark = 'F' AND sub IN (5, 9), FALSE)),
ev AS (
  SELECT {id9('l_orderkey')} AS id, d AS day,
    CASE WHEN l_linenumber = 7 THEN '03' WHEN l_returnflag = 'R' THEN '33' WHEN l_returnflag = 'A' THEN '30' ELSE '02' END AS code
  FROM li WHERE l_linestatus = 'F' OR l_quantity < 25),
mv AS (
  SELECT {id9('l_orderkey')} AS id, CASE WHEN l_linenumber = 1 THEN '0000' ELSE lpad(CAST(l_linenumber AS VARCHAR), 4, '0') END AS code,
    CASE WHEN l_linenumber <> 3 THEN d + 2 END AS left_on, CASE WHEN l_linenumber <> 5 THEN d + 4 END AS came_on
  FROM li WHERE l_linestatus <> 'O')"""

# Fees are exact hundredths of whole cents: price in tens of cents.
OBSERVED = """
fee AS (SELECT id AS fid, k, CAST(charge AS DECIMAL(18,5)) AS charge, CAST(f16 AS DECIMAL(18,5)) AS sub_fee, CAST(f17 AS DECIMAL(18,5)) AS mgmt FROM (
  SELECT id, k,
    CASE WHEN has_fee = 0 THEN 0.00 WHEN CAST(left(policy, 2) AS INT) BETWEEN 5 AND 12 THEN (cents + 30) * 0.01
         WHEN k % 5 <> 0 THEN (cents - (k % 5) * 10) * 0.01 ELSE 0.00 END AS charge,
    CASE WHEN has_fee = 0 THEN 0.00 ELSE (cents + 30) * 0.01 END AS f16, CASE WHEN has_fee = 0 THEN 0.00 ELSE (cents + 70) * 0.01 END AS f17
  FROM (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(14,0)) AS cents FROM receipt))),
own_rows AS (
  SELECT id, 0 AS s, created AS dt, 0 AS pos FROM receipt WHERE st >= 0
  UNION ALL SELECT id, 1, emitted, 1 FROM receipt WHERE st >= 1 AND NOT (st IN (5, 9) AND coalesce(prev, -1) < 1)
  UNION ALL SELECT id, 2, done, 100 FROM receipt WHERE st >= 2 AND NOT (st IN (5, 9) AND coalesce(prev, -1) < 2)
  UNION ALL SELECT id, 3, moved, 300 FROM receipt WHERE st = 3 AND prev = 1
  UNION ALL SELECT id, 5, paid, 500 FROM receipt WHERE st = 5
  UNION ALL SELECT id, 9, cancelled, 900 FROM receipt WHERE st = 9),
late_rows AS (SELECT id, 2 AS s, day AS dt, 100 AS pos FROM ev WHERE code = '02' AND id IN (SELECT id FROM receipt WHERE st = 1)),
ev_rows AS (SELECT id, day, CASE code WHEN '30' THEN 0 WHEN '33' THEN 9 ELSE 2 END AS s, CASE code WHEN '30' THEN 0 WHEN '33' THEN 900 ELSE 200 END AS pos
  FROM ev WHERE code <> '03'),
merged AS (
  SELECT a.id, a.s, coalesce(b.day, a.dt) AS dt, CAST(NULL AS VARCHAR) AS reason, coalesce(b.pos, a.pos) AS pos
  FROM (SELECT * FROM own_rows UNION ALL SELECT * FROM late_rows) a LEFT JOIN ev_rows b ON a.id = b.id AND a.s = b.s),
mv_rows AS (SELECT id, s, dt, reason, CAST(299 + row_number() OVER (PARTITION BY id ORDER BY dt, s, reason) AS INTEGER) AS pos FROM (
  SELECT id, 2 AS s, left_on AS dt, CAST(NULL AS VARCHAR) AS reason FROM mv WHERE left_on IS NOT NULL
  UNION ALL SELECT id, 3, came_on, code FROM mv WHERE code <> '0000')),
observed AS (
  SELECT id, s, dt, reason, pos FROM merged WHERE s <> 2 OR id NOT IN (SELECT id FROM mv_rows)
  UNION ALL SELECT id, s, dt, reason, pos FROM mv_rows)"""

STATES = f"""
multiplied AS (
  SELECT r.*, o.s, o.dt, o.reason, o.pos, f.charge, f.sub_fee, f.mgmt, e2.day AS e2, e3.id IS NOT NULL AS has3, cb.id IS NOT NULL AS charged,
    p.prod
  FROM receipt r JOIN observed o ON r.id = o.id LEFT JOIN fee f ON f.fid = r.id AND f.k = r.k
  LEFT JOIN (SELECT id, day FROM ev WHERE code = '02') e2 ON e2.id = r.id
  LEFT JOIN (SELECT DISTINCT id FROM ev WHERE code = '03') e3 ON e3.id = r.id
  LEFT JOIN (SELECT id FROM receipt WHERE mark = 'A') cb ON cb.id = r.id
  LEFT JOIN (SELECT {pol('c_custkey', 'c_custkey')} AS policy, {pad(cls('c_custkey'), 2)} || {pad(f"CASE WHEN {cls('c_custkey')} = 8 THEN 50 ELSE c_custkey % 60 END", 2)} AS prod
             FROM customer WHERE c_custkey <> 0) p ON p.policy = r.policy),
windowed AS (
  SELECT *, coalesce(CAST(lag(s) OVER w AS VARCHAR), '') AS before,
    max(CASE WHEN s = 0 THEN dt END) OVER (PARTITION BY id) AS row0, max(CASE WHEN s = 1 THEN dt END) OVER (PARTITION BY id) AS row1
  FROM multiplied WINDOW w AS (PARTITION BY id ORDER BY pos, s, dt, reason, e2, prod, policy, gross)),
states AS (
  SELECT w.id AS POLICY_TRANS_ID, w.policy AS POLICY_NO, w.proposal AS PROPOSAL_NO, '' AS ORIGINAL_POLICY_TRANS_ID,
    CASE WHEN s = 2 AND coalesce(e2, created) IS NOT NULL THEN coalesce(e2, created) ELSE dt END AS X_MOV_DT, valued AS X_VALUE_DT,
    row0 AS X_CREATION_DT, CASE s WHEN 0 THEN NULL WHEN 1 THEN dt ELSE row1 END AS X_EMISSION_DT,
    CASE WHEN s NOT IN (2, 5, 9) THEN NULL
         WHEN s = 9 AND prod = '0850' AND before = '1' THEN created
         WHEN s = 9 AND before NOT IN ('2', '3') AND NOT has3 THEN NULL
         ELSE coalesce(e2, created) END AS X_PROCESSED_DT,
    CASE WHEN s = 2 THEN dt END AS X_EXIT_DT, CASE WHEN s = 3 THEN dt END AS X_RETURNED_DT, CASE WHEN s = 5 THEN dt END AS TRANS_DT,
    CASE WHEN s = 9 THEN cancelled END AS X_CANCEL_DT, p_from AS X_PERIOD_FROM_DT, p_to AS X_PERIOD_TO_DT,
    CAST(sub AS VARCHAR) AS TRANS_SUB_TYPE_CD, CAST(s AS VARCHAR) AS X_TRANS_STATUS_CD, CAST(cancel_reason AS VARCHAR) AS X_CANCEL_REASON_CD,
    before AS X_TRANS_PREVIOUS_STATUS_CD, gross AS TRANS_GROSS_AMT, net AS TRANS_NET_AMT, pure AS X_TRANS_PURE_AMT, inem AS X_INEM_AMT,
    CAST(method AS VARCHAR) AS PAYMENT_METHOD_CD, charge AS X_SUBS_CHARGE_AMT, sub_fee AS X_SUBS_FEE_AMT, mgmt AS X_MANAGEMENT_FEE_AMT,
    reinvested AS X_REINVESTMENT_FLG, CASE WHEN s = 3 THEN reason END AS X_RET_REASON_CD, is_closed AS X_IS_CLOSED_FLG, agency AS AGENCY_INT_ID,
    CASE WHEN charged THEN '0' ELSE '1' END AS X_CHARGEBACK_FLG, coalesce(pf.participation, '0') AS X_RESULT_PARTICIPATION_FLG
  FROM windowed w LEFT JOIN (SELECT id, policy, participation FROM receipt WHERE sub = 9) pf ON pf.id = w.id AND pf.policy = w.policy)"""

_ORDER = ("X_TRANS_STATUS_CD, X_MOV_DT, X_EXIT_DT, X_RET_REASON_CD, X_PROCESSED_DT, TRANS_DT, X_CANCEL_DT, X_TRANS_PREVIOUS_STATUS_CD, "
          "POLICY_NO, TRANS_GROSS_AMT, X_EMPLOYEE_EXT_ID")

STAFFED = f"""
rx AS (SELECT * FROM (SELECT {id9('k')} AS id,
    CASE k % 7 WHEN 0 THEN '00000000' WHEN 1 THEN '99999999' WHEN 2 THEN '        ' WHEN 3 THEN 'E123' ELSE 'E' || {pad('k % 50', 7)} END AS v
  FROM ord WHERE o_orderpriority <> '5-LOW') WHERE length(v) = 8 AND v NOT IN ('00000000', '99999999')),
staff AS (SELECT proposal, emp FROM (
  SELECT {pol('o_custkey', '(o_custkey + 1)')} AS proposal, coalesce(s.emp, '') AS emp,
    row_number() OVER (PARTITION BY o_custkey ORDER BY d DESC, coalesce(s.emp, '')) AS rn
  FROM ord LEFT JOIN (SELECT s_suppkey, 'S' || {pad('s_suppkey', 7)} AS emp FROM supplier WHERE s_acctbal >= 2000) s ON s.s_suppkey = k % 150
  WHERE o_orderstatus <> 'P') WHERE rn = 1),
employed AS (
  SELECT t.*, CASE WHEN trim(coalesce(rx.v, '')) = '' THEN staff.emp ELSE rx.v END AS X_EMPLOYEE_EXT_ID
  FROM states t LEFT JOIN rx ON rx.id = t.POLICY_TRANS_ID AND t.TRANS_SUB_TYPE_CD = '5' LEFT JOIN staff ON staff.proposal = t.PROPOSAL_NO),
staffed AS (
  SELECT * EXCLUDE (PROPOSAL_NO, n), CASE WHEN X_PROCESSED_DT IS NOT NULL AND coalesce(n, 0) = 0 THEN '1' ELSE '0' END AS X_PROCESSED_FLG,
    CASE WHEN POLICY_TRANS_ID IN (SELECT {id9('k')} FROM ord WHERE o_orderpriority = '3-MEDIUM') THEN '1' ELSE '0' END AS X_POLICY_TRANS_MANUAL_FLG
  FROM (SELECT *, sum(CASE WHEN X_PROCESSED_DT IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY POLICY_TRANS_ID ORDER BY {_ORDER}
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n FROM employed))"""

FINAL = f"""
added AS (
  SELECT * FROM staffed
  UNION ALL SELECT * REPLACE (X_PROCESSED_DT AS X_MOV_DT, '2' AS X_TRANS_STATUS_CD) FROM staffed
    WHERE X_TRANS_STATUS_CD = '5' AND X_TRANS_PREVIOUS_STATUS_CD IN ('0', '1')
  UNION ALL SELECT * REPLACE (X_PROCESSED_DT AS X_MOV_DT, '2' AS X_TRANS_STATUS_CD, CAST(NULL AS DATE) AS X_CANCEL_DT) FROM staffed
    WHERE X_TRANS_STATUS_CD = '9' AND X_TRANS_PREVIOUS_STATUS_CD <> '2' AND X_PROCESSED_FLG = '1'),
reflagged AS (
  SELECT * EXCLUDE (n) REPLACE (CASE WHEN X_PROCESSED_DT IS NOT NULL AND n = 0 THEN '1' ELSE '0' END AS X_PROCESSED_FLG)
  FROM (SELECT *, sum(CASE WHEN X_PROCESSED_DT IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY POLICY_TRANS_ID ORDER BY {_ORDER}
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n FROM added)),
links AS (SELECT {id9('(k + 6)')} AS orig, s.TRANS_DT AS reg FROM ord
  LEFT JOIN staffed s ON s.POLICY_TRANS_ID = {id9('k')} AND s.X_TRANS_STATUS_CD = '5' WHERE o_orderstatus <> 'F'),
regular AS (
  SELECT r.*, CASE WHEN left(POLICY_NO, 2) = '21' AND TRANS_SUB_TYPE_CD = '9' THEN TRANS_DT ELSE l.reg END AS X_REGULARIZATION_DT
  FROM reflagged r LEFT JOIN links l ON l.orig = r.POLICY_TRANS_ID AND r.X_TRANS_STATUS_CD = '5' WHERE TRANS_SUB_TYPE_CD <> '6'),
withdrawn AS (SELECT {pol('c_custkey', 'c_custkey')} AS policy FROM customer WHERE {cls('c_custkey')} = 21 AND c_mktsegment = 'MACHINERY' AND c_custkey % 2 = 0),
fixes AS (
  SELECT u.POLICY_TRANS_ID AS id, u.POLICY_NO AS policy, p.TRANS_GROSS_AMT AS g, p.TRANS_NET_AMT AS n FROM regular u JOIN regular p ON u.POLICY_NO = p.POLICY_NO
  WHERE u.POLICY_NO IN (SELECT policy FROM withdrawn) AND u.TRANS_SUB_TYPE_CD = '9' AND u.TRANS_DT IS NOT NULL
    AND p.X_TRANS_STATUS_CD = '5' AND p.TRANS_SUB_TYPE_CD <> '9' AND p.TRANS_GROSS_AMT <> 0),
final_states AS (
  SELECT r.* REPLACE (coalesce(f.g, TRANS_GROSS_AMT) AS TRANS_GROSS_AMT, coalesce(f.n, TRANS_NET_AMT) AS TRANS_NET_AMT)
  FROM regular r LEFT JOIN fixes f ON f.id = r.POLICY_TRANS_ID AND f.policy = r.POLICY_NO)"""

SPLIT = f"""
resolved AS (
  SELECT s.*, c_custkey * 2 + 1 AS POLICY_RK, sup.s_suppkey + 107000 AS X_EMPLOYEE_RK,
    CAST(coalesce(n.n_nationkey + 1500, c_nationkey + 500) AS BIGINT) AS X_BSN_STRUCTURE_RK
  FROM final_states s LEFT JOIN customer ON {pol('c_custkey', 'c_custkey')} = s.POLICY_NO
  LEFT JOIN supplier sup ON 'S' || {pad('sup.s_suppkey', 7)} = s.X_EMPLOYEE_EXT_ID
  LEFT JOIN nation n ON 'A' || CAST(n.n_nationkey AS VARCHAR) = s.AGENCY_INT_ID)"""



def changed(sql: str, *pairs: tuple[str, str]) -> str:
    """The SQL with other rules in place of given ones, each of which must occur."""
    for old, new in pairs:
        if old not in sql:
            raise ValueError(f"not in the SQL: {old}")
        sql = sql.replace(old, new)
    return sql


#: The first stage under three-valued logic: unknown conditions drop rows and leave rules untaken.
STATES_SQL = with_(
    changed(RECEIPT, ("NOT coalesce(mark = 'F' AND sub IN (5, 9), FALSE)", "NOT (mark = 'F' AND sub IN (5, 9))")),
    changed(OBSERVED, ("coalesce(prev, -1) < 1", "prev < 1"), ("coalesce(prev, -1) < 2", "prev < 2")),
    changed(STATES, ("before NOT IN ('2', '3') AND NOT has3 THEN NULL", "before NOT IN ('2', '3') AND NOT has3 AND NOT (prod = '0850' AND before = '1') THEN NULL")))
#: The last stage with the source system's longer receipt keys.
TO_FINAL_SHIPPED = with_(RECEIPT, OBSERVED, STATES, STAFFED, changed(FINAL, ("l.orig = r.POLICY_TRANS_ID", "'21' || l.orig = r.POLICY_TRANS_ID")))
TO_STATES = with_(RECEIPT, OBSERVED, STATES)
TO_STAFFED = with_(RECEIPT, OBSERVED, STATES, STAFFED)
TO_FINAL = with_(RECEIPT, OBSERVED, STATES, STAFFED, FINAL)
TO_SPLIT = with_(RECEIPT, OBSERVED, STATES, STAFFED, FINAL, SPLIT)
