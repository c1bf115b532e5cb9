from datetime import date
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from coverloom.catalog import receipt_queries as RQ
from coverloom.catalog.star import RUN_TS
from coverloom.functions import schemas as S
from coverloom.operators.aggregates import difference
from coverloom.plans import daily, splitter
from coverloom.plans import receipts as R
from coverloom.session import scratch_dir

DATES = {"CRI": 1, "EMI": 2, "DEV": 3, "UST": 4, "COB": 5, "ANU": 6}


def receipt(seq, status, before=None, sub=2, mark="X", day=10, **more):
    """A receipt whose dates are the given day of month 1..6 of 2020, by kind."""
    parts = {}
    for stem, month in DATES.items():
        parts.update({f"RCA{stem}": 2020, f"RCM{stem}": month, f"RCD{stem}": day})
    return {"RCNANO": 20, "RCNMES": 1, "RCNSEQ": seq, "RC$MOD": 1, "RC$APL": seq, "RCNAPO": seq, "RCSITU": status, "RCSTAN": before, "RCESPC": sub,
            "RCSTA3": mark, "RCPRTO": 1000, "RCPRSR": 900, "RCENV2": 50, "RCVAL2": 800, "RCENP1": 100, "RCTCOB": 1, "RC$AG2": " . ", "RCSTA9": 1, **parts, **more}


def rid(seq):
    return f"2001{seq:05d}"


@pytest.mark.parametrize("status, before, expected", [
    (0, None, [0]), (1, 0, [0, 1]), (2, 1, [0, 1, 2]), (3, 1, [0, 1, 2, 3]), (3, 2, [0, 1, 2]),
    (5, 0, [0, 5]), (5, 1, [0, 1, 5]), (5, 2, [0, 1, 2, 5]), (9, 0, [0, 9]), (9, 1, [0, 1, 9]), (9, 2, [0, 1, 2, 9])])
def test_explosion(frame, status, before, expected):
    out = R.receipt_rows(R.receipts(frame(S.EXTRACTS["RECIBO"], receipt(1, status, before))))
    got = {r["STATUS_CD"]: (r["OBS_DT"], r["POS"]) for r in out.collect()}
    assert sorted(got) == expected
    assert got[0] == (date(2020, 1, 10), 0)
    for s, month, pos in [(1, 2, 1), (2, 3, 100), (3, 4, 300), (5, 5, 500), (9, 6, 900)]:
        if s in got:
            assert got[s] == (date(2020, month, 10), pos)


@pytest.mark.parametrize("status", [5, 9])
def test_missing_previous_status(frame, status):
    base = R.receipts(frame(S.EXTRACTS["RECIBO"], receipt(1, status, None)))
    assert [r[0] for r in rows(R.receipt_rows(base, "sas"), "STATUS_CD")] == [0, status]
    assert [r[0] for r in rows(R.receipt_rows(base, "sql"), "STATUS_CD")] == [0, status]
    open_ = R.receipts(frame(S.EXTRACTS["RECIBO"], receipt(1, 2, None)))
    assert [r[0] for r in rows(R.receipt_rows(open_, "sql"), "STATUS_CD")] == [0, 1, 2]


def test_reversed_receipts_leave(frame):
    data = frame(S.EXTRACTS["RECIBO"], receipt(1, 1, sub=5, mark="F"), receipt(2, 1, sub=2, mark="F"), receipt(3, 1, sub=5, mark=None), receipt(4, 1, sub=9, mark="X"))
    assert [r[0] for r in rows(R.receipts(data, "sas"), "RCNSEQ")] == [2, 3, 4]
    assert [r[0] for r in rows(R.receipts(data, "sql"), "RCNSEQ")] == [2, 4]


def test_amounts_by_class(frame):
    data = frame(S.EXTRACTS["RECIBO"], receipt(1, 1, **{"RC$MOD": 5}), receipt(2, 1, **{"RC$MOD": 4}), receipt(3, 1, sub=9, mark="K"))
    got = {r["RCNSEQ"]: (float(r["TRANS_GROSS_AMT"]), float(r["TRANS_NET_AMT"]), float(r["X_TRANS_PURE_AMT"])) for r in R.receipts(data).collect()}
    assert got == {1: (10.0, 9.0, 10.0), 2: (10.0, 9.0, 8.0), 3: (10.0, 9.5, 8.0)}


def test_fees(frame):
    base = dict(EDVL01=500, EDVL16=30, EDVL17=70, EDNANO=20, EDNMES=1)
    data = frame(S.EXTRACTS["MOPEC1"], dict(base, EDCMOD=5, EDVL07=9, EDNSEQ=1, EDCEVE="05"), dict(base, EDCMOD=4, EDVL07=100, EDNSEQ=2, EDCEVE="05"),
                 dict(base, EDCMOD=4, EDVL07=0, EDNSEQ=3, EDCEVE="05"), dict(base, EDCMOD=4, EDVL07=0, EDNSEQ=4, EDCEVE="04"))
    assert [(r["EDNSEQ"], float(r["X_SUBS_CHARGE_AMT"])) for r in R.fees(data).orderBy("EDNSEQ").collect()] == [(1, 0.3), (2, 4.0), (3, 0.0)]


def event(seq, code, day, doc="R"):
    return {"EOREFD": rid(seq), "EODEVE": day, "EO$EVE": code, "EOTDOC": doc}


def movement(seq, code, left=None, came=None, doc="R"):
    m = {"MLNANO": 20, "MLNMES": 1, "MLNSEQ": seq, "MLSITC": code, "MLTDOC": doc}
    for stem, d in (("SAI", left), ("ENT", came)):
        if d:
            m.update({f"MLA{stem}": d.year, f"MLM{stem}": d.month, f"MLD{stem}": d.day})
    return m


def run_states(frame, recibo, evento=(), moviml=(), apol00=(), **kw):
    return R.stage_states(frame(S.EXTRACTS["RECIBO"], *recibo), frame(S.EXTRACTS["MOPEC1"]), frame(S.EXTRACTS["EVENTO"], *evento),
                          frame(S.EXTRACTS["MOVIML"], *moviml), frame(S.EXTRACTS["APOL00"], *apol00), **kw)


def test_movements_number_and_override(frame):
    mv = [movement(1, "0000", date(2020, 7, 1)), movement(1, "0012", date(2020, 7, 3), date(2020, 7, 2)), movement(1, "0013", None, None), movement(1, "0099", date(2020, 1, 1), doc="E")]
    out = rows(R.movement_rows(R.movements(frame(S.EXTRACTS["MOVIML"], *mv))), "POS", "STATUS_CD", "OBS_DT", "REASON_CD")
    assert out == [(300, 2, date(2020, 7, 1), None), (301, 3, date(2020, 7, 2), "0012"), (302, 2, date(2020, 7, 3), None), (303, 3, None, "0013")]
    full = run_states(frame, [receipt(1, 2, 1), receipt(2, 2, 1)], moviml=mv)
    assert [r[0] for r in rows(full.filter(F.col("POLICY_TRANS_ID") == rid(1)), "X_TRANS_STATUS_CD")] == ["0", "1", "2", "2", "3", "3"]
    assert [r[0] for r in rows(full.filter(F.col("POLICY_TRANS_ID") == rid(2)), "X_TRANS_STATUS_CD")] == ["0", "1", "2"]


def test_events_win_and_fan_out(frame):
    ev = [event(1, "30", 20200111), event(2, "02", 20200301), event(2, "02", 20200302), event(1, "33", 20200105, doc="X")]
    out = run_states(frame, [receipt(1, 1, 0), receipt(2, 1, 0)], evento=ev)
    first = out.filter(F.col("POLICY_TRANS_ID") == rid(1))
    assert rows(first, "X_TRANS_STATUS_CD", "X_MOV_DT") == [("0", date(2020, 1, 11)), ("1", date(2020, 2, 10))]
    second = out.filter(F.col("POLICY_TRANS_ID") == rid(2))
    # Two events 02 give 2 x 2 late rows, and each of the six rows meets both events once more.
    assert second.count() == 12
    assert {r[0] for r in rows(second.filter(F.col("X_TRANS_STATUS_CD") == "2"), "X_MOV_DT")} == {date(2020, 3, 1), date(2020, 3, 2)}


@pytest.mark.parametrize("before, event03, product, expected", [
    (2, False, 1, date(2020, 1, 10)), (1, False, 1, None), (0, False, 1, None), (1, True, 1, date(2020, 1, 10)), (1, False, 50, date(2020, 1, 10))])
def test_processed_date_of_cancelled(frame, before, event03, product, expected):
    """Only after processing, or with event 03, or for product 0850 straight after emission."""
    mod = 8 if product == 50 else 1
    policy = {"A0$MOD": mod, "A0$APL": 1, "A0NVER": product}
    out = run_states(frame, [receipt(1, 9, before, **{"RC$MOD": mod})], evento=[event(1, "03", 20200401)] if event03 else [], apol00=[policy])
    last = out.filter(F.col("X_TRANS_STATUS_CD") == "9").first()
    assert last["X_PROCESSED_DT"] == expected
    assert last["X_TRANS_PREVIOUS_STATUS_CD"] == str(before) and last["X_CANCEL_DT"] == date(2020, 6, 10)


def test_flags(frame):
    out = run_states(frame, [receipt(1, 1, mark="A"), receipt(2, 5, 2, sub=9, RCSTA9=24), receipt(3, 0, mark="H")])
    got = {r["POLICY_TRANS_ID"]: r for r in out.filter(F.col("X_TRANS_STATUS_CD") == "0").collect()}
    assert [got[rid(i)]["X_CHARGEBACK_FLG"] for i in (1, 2, 3)] == ["0", "1", "1"]  # the flag is 0 where found
    assert [got[rid(i)]["X_RESULT_PARTICIPATION_FLG"] for i in (1, 2, 3)] == ["0", "1", "0"]
    assert [got[rid(i)]["X_IS_CLOSED_FLG"] for i in (1, 2, 3)] == ["N", "Y", "N"]
    assert got[rid(3)]["X_REINVESTMENT_FLG"] == "1" and got[rid(1)]["AGENCY_INT_ID"] == "" and got[rid(1)]["ORIGINAL_POLICY_TRANS_ID"] == ""


def test_employee(frame):
    rx = [dict(RXNANO=20, RXNMES=1, RXNSEQ=i, **{"RX$VAL": 881, "RXVALOR": v}) for i, v in [(1, "E0000001"), (2, "00000000"), (3, "E123"), (4, "        "), (5, "E0000005")]]
    assert [r[0] for r in rows(R.receipt_employee(frame(S.EXTRACTS["RECI0X"], *rx)), "EMPLOYEE")] == ["        ", "E0000001", "E0000005"]
    persons = [{"AL$MOD": 1, "ALNAPO": 4, "ALDTIN": 20200101, "AL$ENT": 7, "AL$PAP": "FUN"}, {"AL$MOD": 1, "ALNAPO": 4, "ALDTIN": 20210101, "AL$ENT": 8, "AL$PAP": "FUN"},
               {"AL$MOD": 1, "ALNAPO": 5, "ALDTIN": 20210101, "AL$ENT": 9, "AL$PAP": "FUN"}, {"AL$MOD": 1, "ALNAPO": 6, "ALDTIN": 20210101, "AL$ENT": 7, "AL$PAP": "TOM"}]
    links = [{"EVVALO": f"S000000{i}-x", "EV_REL": i, "EV_INF": 900} for i in (7, 8)]
    rel = [{"ER_REL": i, "ER_COD": i, "ERSTEN": "F", "ERTENT": "B", "ERTIPO": "ENT"} for i in (7, 8)]
    entvin, entrel, apolpa = frame(S.EXTRACTS["ENTVIN"], *links), frame(S.EXTRACTS["ENTREL"], *rel), frame(S.EXTRACTS["APOLPA"], *persons)
    assert rows(R.policy_employee(apolpa, entvin, entrel)) == [("0100000004", "S0000008"), ("0100000005", "")]
    states = frame(S.RECEIPT_STATES, *[{"POLICY_TRANS_ID": rid(i), "PROPOSAL_NO": f"01{i:08d}", "TRANS_SUB_TYPE_CD": sub}
                                       for i, sub in [(1, "5"), (4, "5"), (5, "2"), (6, "5")]])
    out = R.with_employee(states, frame(S.EXTRACTS["RECI0X"], *rx), entvin, entrel, apolpa)
    assert rows(out, "POLICY_TRANS_ID", "X_EMPLOYEE_EXT_ID") == [(rid(1), "E0000001"), (rid(4), "S0000008"), (rid(5), ""), (rid(6), None)]


def staffed(frame, *given):
    return frame(S.STAFFED_STATES, *[{"POLICY_NO": "0100000001", "TRANS_SUB_TYPE_CD": "2", "X_PROCESSED_FLG": "0", **g} for g in given])


D = date(2020, 1, 1)


def test_first_processed_variants(frame):
    data = staffed(frame, {"POLICY_TRANS_ID": "a", "X_TRANS_STATUS_CD": "0", "X_PROCESSED_DT": D}, {"POLICY_TRANS_ID": "a", "X_TRANS_STATUS_CD": "1", "X_PROCESSED_DT": D},
                   {"POLICY_TRANS_ID": "b", "X_TRANS_STATUS_CD": "0"}, {"POLICY_TRANS_ID": "b", "X_TRANS_STATUS_CD": "1", "X_PROCESSED_DT": D},
                   {"POLICY_TRANS_ID": "c", "X_TRANS_STATUS_CD": "0"})
    flags = lambda zero: [r[2] for r in rows(R.first_processed(data, ["X_TRANS_STATUS_CD"], zero), "POLICY_TRANS_ID", "X_TRANS_STATUS_CD", "X_PROCESSED_FLG")]
    assert flags(True) == ["1", "0", "0", "1", "0"]
    assert flags(False) == ["0", "0", "0", "1", "0"]  # the first row of a receipt never gets it


def test_synthetic_rows(frame):
    cases = [("5", "0", "0", True), ("5", "1", "0", True), ("5", "2", "0", False), ("9", "1", "1", True), ("9", "1", "0", False), ("9", "2", "1", False), ("1", "0", "1", False)]
    data = staffed(frame, *[{"POLICY_TRANS_ID": str(i), "X_TRANS_STATUS_CD": s, "X_TRANS_PREVIOUS_STATUS_CD": b, "X_PROCESSED_FLG": f, "X_PROCESSED_DT": D,
                             "X_MOV_DT": date(2020, 2, 2), "X_CANCEL_DT": date(2020, 3, 3)} for i, (s, b, f, _) in enumerate(cases)])
    out = R.with_synthetic(data)
    added = {r["POLICY_TRANS_ID"]: r for r in out.filter(F.col("X_MOV_DT") == F.lit(D)).collect()}
    assert sorted(added) == [str(i) for i, c in enumerate(cases) if c[3]] and out.count() == len(cases) + len(added)
    assert all(r["X_TRANS_STATUS_CD"] == "2" for r in added.values())
    assert added["0"]["X_CANCEL_DT"] == date(2020, 3, 3) and added["3"]["X_CANCEL_DT"] is None


def test_regularisation(frame):
    data = staffed(frame, {"POLICY_TRANS_ID": "200100001", "X_TRANS_STATUS_CD": "5", "TRANS_DT": D}, {"POLICY_TRANS_ID": "200100002", "X_TRANS_STATUS_CD": "5"},
                   {"POLICY_TRANS_ID": "200100003", "X_TRANS_STATUS_CD": "5", "TRANS_SUB_TYPE_CD": "6"}, {"POLICY_TRANS_ID": "200100004", "X_TRANS_STATUS_CD": "5", "TRANS_SUB_TYPE_CD": None},
                   {"POLICY_TRANS_ID": "200100005", "POLICY_NO": "2100000001", "TRANS_SUB_TYPE_CD": "9", "X_TRANS_STATUS_CD": "1", "TRANS_DT": D})
    rel = frame(S.EXTRACTS["RECREL"], {"RL$MOD": 21, "RLESPC": 6, "RLNANO": 20, "RLNMES": 1, "RLNSEQ": 1, "RLRANO": 20, "RLRMES": 1, "RLRSEQ": 2})
    out = lambda mod: rows(R.regularise(data, R.regularisations(rel, data, mod)), "POLICY_TRANS_ID", "X_REGULARIZATION_DT")
    assert out(False) == [("200100001", None), ("200100002", D), ("200100005", D)]
    # The longer keys of the source system match nothing.
    assert out(True) == [("200100001", None), ("200100002", None), ("200100005", D)]


def test_withdrawal_correction(frame):
    p = lambda n: f"21{n:08d}"
    one = lambda i, n, **kw: {"POLICY_TRANS_ID": str(i), "POLICY_NO": p(n), "TRANS_GROSS_AMT": i, "TRANS_NET_AMT": i, **kw}
    last, first = {"TRANS_SUB_TYPE_CD": "9", "TRANS_DT": D, "X_TRANS_STATUS_CD": "1"}, {"TRANS_SUB_TYPE_CD": "2", "X_TRANS_STATUS_CD": "5"}
    data = staffed(frame, one(1, 1, **first), one(2, 1, **last), one(3, 2, **last), one(4, 3, **first), one(5, 3, **first), one(6, 3, **last), one(7, 4, **first), one(8, 4, **last))
    policies = frame(S.EXTRACTS["APOL00"], *[{"A0$MOD": 21, "A0$APL": n, "A0SITU": 3, "A0RAZA": " 3"} for n in (1, 2, 3)], {"A0$MOD": 21, "A0$APL": 4, "A0SITU": 3, "A0RAZA": None})
    got = sorted((int(r["POLICY_TRANS_ID"]), int(r["TRANS_GROSS_AMT"])) for r in R.correct_withdrawals(data, policies).collect())
    assert got == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 4), (6, 5), (7, 7), (8, 8)]


def test_splitter_is_disjoint_and_complete(star):
    rows_ = RQ.resolved(star)
    total, closed_, open_ = rows_.count(), splitter.closed(rows_).count(), splitter.current(rows_).count()
    assert closed_ + open_ == total and closed_ > 0 and open_ > 0
    assert [f.name for f in rows_.schema] == [f.name for f in S.TRANSACTIONS]


def test_small_hot_limit_changes_nothing(star):
    args = (star.stored("recibo"), star.mopec1(), star.stored("evento"), star.moviml(), star.customer_policies())
    assert difference(R.stage_states(*args), R.stage_states(*args, hot_rows=6)).count() == 0


def dimensions(star):
    return daily.Dimensions(policy=star.customer_dimension(), proposal=star.proposal_dimension(), coverage=star.coverage_dimension(), category=star.category_dimension(),
                            employee=star.employees(), structure=star.structures())


def test_second_run_loads_no_closed_receipt_twice(star, tmp_path):
    x = {"RECIBO": star.stored("recibo"), "MOPEC1": star.mopec1(), "EVENTO": star.stored("evento"), "MOVIML": star.moviml(), "APOL00": star.customer_policies(), "RECI0X": star.reci0x(),
         "ENTVIN": star.entvin(), "ENTREL": star.entrel(), "APOLPA": star.apolpa(), "RECPRO": star.recpro(), "RECREL": star.recrel()}
    out = str(tmp_path)
    scratch = Path(scratch_dir(star.spark).removeprefix("file:")) / "coverloom-stages"
    before = set(scratch.iterdir())
    daily.run_transactions(x, dimensions(star), out, RUN_TS)
    assert set(scratch.iterdir()) == before  # scratch tables of the run are gone
    read = lambda name: star.spark.read.parquet(f"{out}/{name}")
    history, current = read("X_LIFE_POLICY_TRANS_HIST").count(), read("LIFE_POLICY_TRANS").count()
    assert history > 0 and current > 0
    daily.run_transactions(x, dimensions(star), out, RUN_TS)
    assert read("X_LIFE_POLICY_TRANS_HIST").count() == history
    assert read("LIFE_POLICY_TRANS").count() == current


def test_absent_product_under_either_reading(spark):
    rows_ = spark.sql("""SELECT 'r' AS POLICY_TRANS_ID, pos AS POS, status AS STATUS_CD, date(day) AS OBS_DT, '' AS REASON_CD, date'2026-05-05' AS EVENT_02_DT, string(prod) AS PROD_ID,
      'p' AS POLICY_NO, 1 AS TRANS_GROSS_AMT, boolean(null) AS HAS_03, boolean(null) AS CHARGED, date'2026-03-03' AS X_CANCEL_DT, date'2026-01-01' AS X_CREATION_DT
      FROM VALUES (1, 0, '2026-01-01', null), (2, 1, '2026-01-02', null), (3, 9, '2026-01-03', null) AS t(pos, status, day, prod)""")
    found = {m: R.adjust(rows_, missing=m).filter("STATUS_CD = 9").first()["X_PROCESSED_DT"] for m in ("sas", "sql")}
    assert found["sas"] is None and str(found["sql"]) == "2026-05-05"
    other = R.adjust(rows_.withColumn("PROD_ID", F.lit("0850")), missing="sql").filter("STATUS_CD = 9").first()["X_PROCESSED_DT"]
    assert str(other) == "2026-01-01"
