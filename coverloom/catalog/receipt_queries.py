"""Queries of the transactions path."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from coverloom.catalog import star_sql as Q
from coverloom.catalog.registry import register
from coverloom.catalog.star import RUN_TS, Star
from coverloom.functions import schemas as S
from coverloom.functions.exprs import col
from coverloom.plans import receipts as R
from coverloom.plans import splitter
from coverloom.session import clustered, handed_on, scratch_dir, scratch_scope
from coverloom.sources.keyed import KeyTable

_STATES = ", ".join(f.name for f in S.RECEIPT_STATES)
_STAFFED = ", ".join(f.name for f in S.STAFFED_STATES)
_FINAL = ", ".join(f.name for f in S.FINAL_STATES)
_LOADED = [f.name for f in S.FINAL_STATES if f.name not in ("POLICY_NO", "X_EMPLOYEE_EXT_ID", "AGENCY_INT_ID")]
_KEYS = ["POLICY_RK", "X_EMPLOYEE_RK", "X_BSN_STRUCTURE_RK"]


def states(t: Star):
    return R.stage_states(t.recibo(), t.mopec1(), t.evento(), t.moviml(), t.customer_policies())


def stored_states(t: Star):
    with scratch_scope(t.spark):
        stored = clustered(states(t), "receipt-states", R.ID, lying=True)[0]
        handed_on()
    return stored


def staffed(t: Star):
    return R.stage_staffed(stored_states(t), t.reci0x(), t.entvin(), t.entrel(), t.apolpa(), t.recpro())


def final(t: Star, with_mod: bool = False):
    return R.stage_final(stored_staffed(t), t.recrel(), t.customer_policies(), with_mod=with_mod)


def stored_staffed(t: Star):
    with scratch_scope(t.spark):
        stored = clustered(staffed(t), "staffed-states", R.ID, lying=True)[0]
        handed_on()
    return stored


def resolved(t: Star):
    stored = stored_staffed(t)
    rows = R.stage_final(stored, t.recrel(), t.customer_policies(), with_mod=False)
    return splitter.resolve(rows, t.employees(), t.structures(), t.customer_dimension(), RUN_TS, stored)


@register("receipt_extract", Q.with_(Q.RECEIPT) + """
SELECT id AS POLICY_TRANS_ID, policy AS POLICY_NO, proposal AS PROPOSAL_NO, paid AS TRANS_DT, emitted AS X_EMISSION_DT, done AS X_PROCESSED_DT,
  sub AS TRANS_SUB_TYPE_CD, st AS X_TRANS_STATUS_CD, prev AS X_TRANS_PREVIOUS_STATUS_CD, gross AS TRANS_GROSS_AMT, net AS TRANS_NET_AMT,
  pure AS X_TRANS_PURE_AMT, inem AS X_INEM_AMT, agency AS AGENCY_INT_ID, participation AS X_RESULT_PARTICIPATION_FLG FROM receipt""")
def receipt_extract(t: Star):
    return R.receipts(t.recibo()).select(
        "POLICY_TRANS_ID", "POLICY_NO", "PROPOSAL_NO", "TRANS_DT", "X_EMISSION_DT", "X_PROCESSED_DT", "TRANS_SUB_TYPE_CD", "X_TRANS_STATUS_CD",
        "X_TRANS_PREVIOUS_STATUS_CD", "TRANS_GROSS_AMT", "TRANS_NET_AMT", "X_TRANS_PURE_AMT", "X_INEM_AMT", "AGENCY_INT_ID",
        "X_RESULT_PARTICIPATION_FLG")


@register("fee_enrichment", Q.with_(Q.RECEIPT, Q.OBSERVED) + """
SELECT id AS POLICY_TRANS_ID, is_closed AS X_IS_CLOSED_FLG, charge AS X_SUBS_CHARGE_AMT, sub_fee AS X_SUBS_FEE_AMT, mgmt AS X_MANAGEMENT_FEE_AMT
FROM receipt r JOIN fee f ON f.fid = r.id AND f.k = r.k""")
def fee_enrichment(t: Star):
    return R.enrich(R.receipts(t.recibo()), R.fees(t.mopec1())).select(
        "POLICY_TRANS_ID", "X_IS_CLOSED_FLG", "X_SUBS_CHARGE_AMT", "X_SUBS_FEE_AMT", "X_MANAGEMENT_FEE_AMT")


@register("row_explosion", Q.with_(Q.RECEIPT, Q.OBSERVED) + "SELECT id AS POLICY_TRANS_ID, s AS STATUS_CD, dt AS OBS_DT, pos AS POS FROM own_rows")
def row_explosion(t: Star):
    return R.receipt_rows(R.receipts(t.recibo())).drop("REASON_CD")


@register("late_processed", Q.with_(Q.RECEIPT, Q.OBSERVED) + "SELECT id AS POLICY_TRANS_ID, s AS STATUS_CD, dt AS OBS_DT, pos AS POS FROM late_rows")
def late_processed(t: Star):
    return R.late_processed_rows(R.receipts(t.recibo()), R.events(t.evento())).drop("REASON_CD")


@register("event_recode", Q.with_(Q.RECEIPT, Q.OBSERVED) + "SELECT id AS POLICY_TRANS_ID, s AS STATUS_CD, day AS OBS_DT, pos AS POS FROM ev_rows")
def event_recode(t: Star):
    return R.event_rows(R.events(t.evento())).drop("REASON_CD")


@register("prefer_event_merge", Q.with_(Q.RECEIPT, Q.OBSERVED) + "SELECT id AS POLICY_TRANS_ID, s AS STATUS_CD, dt AS OBS_DT, reason AS REASON_CD, pos AS POS FROM merged")
def prefer_event_merge(t: Star):
    base, ev = R.receipts(t.recibo()), R.events(t.evento())
    rows = R.receipt_rows(base).unionByName(R.late_processed_rows(base, ev))
    return R.prefer_events(rows, R.event_rows(ev))


@register("movement_seq", Q.with_(Q.RECEIPT, Q.OBSERVED) + "SELECT id AS POLICY_TRANS_ID, s AS STATUS_CD, dt AS OBS_DT, reason AS REASON_CD, pos AS POS FROM mv_rows")
def movement_seq(t: Star):
    return R.movement_rows(R.movements(t.moviml()))


@register("override_merge", Q.with_(Q.RECEIPT, Q.OBSERVED) + "SELECT id AS POLICY_TRANS_ID, s AS STATUS_CD, dt AS OBS_DT, reason AS REASON_CD, pos AS POS FROM observed")
def override_merge(t: Star):
    return R.history(R.receipts(t.recibo()), R.events(t.evento()), R.movements(t.moviml()))


@register("status_dates", Q.TO_STATES + f" SELECT {_STATES} FROM states")
def status_dates(t: Star):
    return states(t)


@register("status_dates_sql", Q.STATES_SQL + f" SELECT {_STATES} FROM states")
def status_dates_sql(t: Star):
    """The whole first stage as the source system's SQL reads it: three-valued logic, NOT IN over movements."""
    return R.stage_states(t.recibo(), t.mopec1(), t.evento(), t.moviml(), t.customer_policies(), missing="sql", null_aware=True)


@register("status_dates_loaded", Q.TO_STATES + f" SELECT {_STATES} FROM states WHERE POLICY_TRANS_ID NOT IN (SELECT id FROM receipt WHERE st IN (5, 9))")
def status_dates_loaded(t: Star):
    """The whole first stage of a later run: the history's keys hold all closed receipts."""
    loaded = KeyTable(f"{scratch_dir(t.spark)}/coverloom-keys/{uuid.uuid4().hex}", "POLICY_TRANS_ID string", "POLICY_TRANS_ID", 16)
    loaded.add(R.receipts(t.stored("recibo")).filter(col("X_TRANS_STATUS_CD").isin(5, 9)))
    return R.stage_states(t.stored("recibo"), t.mopec1(), t.stored("evento"), t.moviml(), t.customer_policies(), loaded.read(t.spark))


@register("employee_flags", Q.TO_STAFFED + f" SELECT {_STAFFED} FROM staffed")
def employee_flags(t: Star):
    return staffed(t)


@register("policy_employee", Q.with_(Q.RECEIPT, Q.OBSERVED, Q.STATES, Q.STAFFED) + " SELECT proposal AS PROPOSAL_NO, emp AS X_EMPLOYEE_EXT_ID FROM staff")
def policy_employee(t: Star):
    return R.policy_employee(t.apolpa(), t.entvin(), t.entrel())


@register("synthetic_status2", Q.TO_FINAL + f" SELECT {_STAFFED} FROM added")
def synthetic_status2(t: Star):
    return R.with_synthetic(staffed(t)).select(*[f.name for f in S.STAFFED_STATES])


@register("regularise", Q.TO_FINAL + """ SELECT POLICY_TRANS_ID, X_TRANS_STATUS_CD, X_REGULARIZATION_DT, X_PROCESSED_FLG, count(*) AS n FROM regular
GROUP BY ALL""")
def regularise(t: Star):
    return _regularised(final(t))


@register("regularise_shipped", Q.TO_FINAL + """ SELECT POLICY_TRANS_ID, X_TRANS_STATUS_CD,
  CASE WHEN left(POLICY_NO, 2) = '21' AND TRANS_SUB_TYPE_CD = '9' THEN TRANS_DT ELSE l.reg END AS X_REGULARIZATION_DT, X_PROCESSED_FLG, count(*) AS n
FROM reflagged r LEFT JOIN links l ON '21' || l.orig = r.POLICY_TRANS_ID AND r.X_TRANS_STATUS_CD = '5' WHERE TRANS_SUB_TYPE_CD <> '6' GROUP BY ALL""")
def regularise_shipped(t: Star):
    """The source system's longer keys, the default of the stage."""
    return _regularised(final(t, with_mod=True))


def _regularised(rows):
    return rows.groupBy("POLICY_TRANS_ID", "X_TRANS_STATUS_CD", "X_REGULARIZATION_DT", "X_PROCESSED_FLG").agg(F.count(F.lit(1)).alias("n"))


@register("amount_correction", Q.TO_FINAL + f" SELECT {_FINAL} FROM final_states")
def amount_correction(t: Star):
    return final(t)


@register("amount_correction_shipped", Q.TO_FINAL_SHIPPED + f" SELECT {_FINAL} FROM final_states")
def amount_correction_shipped(t: Star):
    """The whole last stage with the source system's longer keys, its default."""
    return final(t, with_mod=True)


@register("splitter_current", Q.TO_SPLIT + f" SELECT {', '.join(_LOADED + _KEYS)} FROM resolved WHERE X_IS_CLOSED_FLG = 'N'")
def splitter_current(t: Star):
    return splitter.current(resolved(t)).select(*_LOADED, *_KEYS)


@register("splitter_hist", Q.TO_SPLIT + f" SELECT {', '.join(_LOADED + _KEYS)} FROM resolved WHERE X_IS_CLOSED_FLG = 'Y'")
def splitter_hist(t: Star):
    return splitter.closed(resolved(t)).select(*_LOADED, *_KEYS)


@register("skip_loaded", Q.with_(Q.RECEIPT) + " SELECT id AS POLICY_TRANS_ID, st AS X_TRANS_STATUS_CD FROM receipt WHERE st NOT IN (5, 9)")
def skip_loaded(t: Star):
    """Incremental step: a history holding all closed receipts leaves the open ones. Receipts and loaded keys are bucketed alike, so neither moves."""
    base, folder = R.receipts(t.recibo()), f"{scratch_dir(t.spark)}/coverloom-keys/{uuid.uuid4().hex}"
    given = KeyTable(f"{folder}/receipts", "POLICY_TRANS_ID string, X_TRANS_STATUS_CD int", "POLICY_TRANS_ID", 16)
    loaded = KeyTable(f"{folder}/loaded", "POLICY_TRANS_ID string", "POLICY_TRANS_ID", 16)
    given.add(base)
    loaded.add(base.filter(col("X_TRANS_STATUS_CD").isin(5, 9)))
    return R.without_loaded(given.read(t.spark), loaded.read(t.spark))
