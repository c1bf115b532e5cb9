"""Transactions path: receipts, events and movements to one row per lifecycle status.

Three stages. Observations stay narrow (key, status, date, reason, order) until all merging is
done; the wide receipt row is shuffled by receipt key once, before it is multiplied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverloom.functions import schemas as S
from coverloom.functions.exprs import (
    RISK_PRODUCTS, SAS, below, blank_to_null, cents, col, dot_to_blank, key, padded, text, triple,
    unless, valid_date,
)
from coverloom.operators import joins as J
from coverloom.operators.explode import observe
from coverloom.operators.ordered import HOT_ROWS, NEVER, along, hot_limit, latest_per_key
from coverloom.session import clustered, materialise

ID = "POLICY_TRANS_ID"
OBSERVATION = [ID, "STATUS_CD", "OBS_DT", "REASON_CD", "POS"]
# Status codes and the places of their rows in a receipt's life.
CREATED, EMITTED, PROCESSED, RETURNED, COLLECTED, CANCELLED = 0, 1, 2, 3, 5, 9
RECEIPT_POS = {CREATED: 0, EMITTED: 1, PROCESSED: 100, RETURNED: 300, COLLECTED: 500, CANCELLED: 900}
EVENT_STATUS = {"30": (CREATED, 0), "33": (CANCELLED, 900), "02": (PROCESSED, 200)}
MOVEMENT_POS = 299
_FEES = ["X_SUBS_CHARGE_AMT", "X_SUBS_FEE_AMT", "X_MANAGEMENT_FEE_AMT"]


def _none(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


# ------------------------------------------------------------------ extracts

def fees(mopec1: DataFrame) -> DataFrame:
    """Fees from the event-05 rows; the charge depends on the product class."""
    risk = padded("EDCMOD", 2).isin(*RISK_PRODUCTS)
    charge = (F.when(risk, cents("EDVL16"))
              .when(~risk & (col("EDVL07") != 0), cents(col("EDVL01") - col("EDVL07")))
              .otherwise(F.lit(0).cast(S.AMOUNT)))
    return mopec1.filter(col("EDCEVE") == "05").select(
        "EDNANO", "EDNMES", "EDNSEQ", charge.alias("X_SUBS_CHARGE_AMT"),
        cents("EDVL16").alias("X_SUBS_FEE_AMT"), cents("EDVL17").alias("X_MANAGEMENT_FEE_AMT"))


def receipts(recibo: DataFrame, missing: str = SAS) -> DataFrame:
    """Typed receipts without the reversed sub-types."""
    reversed_ = (col("RCSTA3") == "F") & col("RCESPC").isin(5, 9)
    risk = padded("RC$MOD", 2).isin(*RISK_PRODUCTS)
    net = F.when((col("RCSTA3") == "K") & (col("RCESPC") == 9), cents("RCPRSR") + cents("RCENV2"))
    day = {"TRANS_DT": "COB", "X_VALUE_DT": "FR2", "X_EMISSION_DT": "EMI", "X_CREATION_DT": "CRI",
           "X_PROCESSED_DT": "DEV", "X_PERIOD_FROM_DT": "PDE", "X_PERIOD_TO_DT": "PDA",
           "X_CANCEL_DT": "ANU", "MOV_DT": "UST", "X_RETURNED_DT": "DVL"}
    return recibo.filter(unless(reversed_, missing)).select(
        key(("RCNANO", 2), ("RCNMES", 2), ("RCNSEQ", 5)).alias(ID),
        key(("RC$MOD", 2), ("RC$APL", 8)).alias("POLICY_NO"),
        key(("RC$MOD", 2), ("RCNAPO", 8)).alias("PROPOSAL_NO"),
        *[triple("RC", stem).alias(name) for name, stem in day.items()],
        col("RCESPC").alias("TRANS_SUB_TYPE_CD"),
        col("RCSITU").alias("X_TRANS_STATUS_CD"),
        col("RCRANU").alias("X_CANCEL_REASON_CD"),
        col("RCSTAN").alias("X_TRANS_PREVIOUS_STATUS_CD"),
        cents("RCPRTO").alias("TRANS_GROSS_AMT"),
        net.otherwise(cents("RCPRSR")).cast(S.AMOUNT).alias("TRANS_NET_AMT"),
        F.when(~risk, cents("RCVAL2")).otherwise(cents("RCPRTO")).alias("X_TRANS_PURE_AMT"),
        cents("RCENP1").alias("X_INEM_AMT"),
        col("RCTCOB").alias("PAYMENT_METHOD_CD"),
        "RCNANO", "RCNMES", "RCNSEQ",
        F.when(col("RCSTA3") == "H", 1).otherwise(0).alias("X_REINVESTMENT_FLG"),
        dot_to_blank("RC$AG2").alias("AGENCY_INT_ID"),
        col("RCSTA3").alias("X_CHARGEBACK_CD"),
        F.when(col("RCSTA9") == 24, "1").otherwise("0").alias("X_RESULT_PARTICIPATION_FLG"))


def without_loaded(receipts_: DataFrame, history: DataFrame | None) -> DataFrame:
    """Receipts that the closed history does not hold yet."""
    return receipts_ if history is None else J.absent(receipts_, history, [ID])


def enrich(receipts_: DataFrame, fees_: DataFrame) -> DataFrame:
    """Fees, closed flag; fan-out kept."""
    # The receipt key follows from the three parts; with it, receipts that are dealt by it stay where they are.
    fees_ = fees_.withColumn("_id", key(("EDNANO", 2), ("EDNMES", 2), ("EDNSEQ", 5)))
    out = J.lookup(receipts_, fees_, [ID, "RCNANO", "RCNMES", "RCNSEQ"], ["_id", "EDNANO", "EDNMES", "EDNSEQ"], {n: n for n in _FEES})
    closed = F.when(col("X_TRANS_STATUS_CD").isin(COLLECTED, CANCELLED), "Y").otherwise("N")
    return out.withColumns({
        **{n: F.coalesce(col(n), F.lit(0)).cast(S.AMOUNT) for n in _FEES},
        "X_IS_CLOSED_FLG": closed, "ORIGINAL_POLICY_TRANS_ID": F.lit("")})


def events(evento: DataFrame) -> DataFrame:
    return evento.filter(col("EOTDOC").isin("R", "E")).select(
        col("EOREFD").alias(ID), valid_date(padded("EODEVE", 8)).alias("EVENT_DT"),
        col("EO$EVE").alias("EVENT_STATUS_CD"))


def movements(moviml: DataFrame) -> DataFrame:
    return moviml.filter(col("MLTDOC") != "E").select(
        key(("MLNANO", 2), ("MLNMES", 2), ("MLNSEQ", 5)).alias(ID), col("MLSITC").alias("CODE"),
        triple("ML", "SAI").alias("EXIT_DT"), triple("ML", "ENT").alias("ENTRY_DT"))


def products(apol00: DataFrame) -> DataFrame:
    return apol00.filter(col("A0$APL") != 0).select(
        key(("A0$MOD", 2), ("A0$APL", 8)).alias("POLICY_NO"),
        key(("A0$MOD", 2), ("A0NVER", 2)).alias("PROD_ID"))


# ------------------------------------------------------------------ observations

def receipt_rows(receipts_: DataFrame, missing: str = SAS) -> DataFrame:
    """Lifecycle explosion: one scan yields every status a receipt has passed."""
    now, before = col("X_TRANS_STATUS_CD"), "X_TRANS_PREVIOUS_STATUS_CD"

    def passed(status: int) -> Column:
        ended_early = now.isin(COLLECTED, CANCELLED) & below(before, status, missing)
        return (now >= status) & ~ended_early

    stages = [
        (CREATED, now >= CREATED, "X_CREATION_DT"),
        (EMITTED, passed(EMITTED), "X_EMISSION_DT"),
        (PROCESSED, passed(PROCESSED), "X_PROCESSED_DT"),
        (RETURNED, (now == RETURNED) & (col(before) == EMITTED), "MOV_DT"),
        (COLLECTED, now == COLLECTED, "TRANS_DT"),
        (CANCELLED, now == CANCELLED, "X_CANCEL_DT"),
    ]
    return observe(receipts_, [ID], [
        (guard, {"STATUS_CD": F.lit(status), "OBS_DT": col(day), "REASON_CD": _none(),
                 "POS": F.lit(RECEIPT_POS[status])})
        for status, guard, day in stages])


def late_processed_rows(receipts_: DataFrame, events_: DataFrame) -> DataFrame:
    """Status 2 from event 02 for receipts that stand at status 1."""
    emitted = receipts_.filter(col("X_TRANS_STATUS_CD") == EMITTED)
    return J.present(events_.filter(col("EVENT_STATUS_CD") == "02"), emitted, [ID]).select(
        ID, F.lit(PROCESSED).alias("STATUS_CD"), col("EVENT_DT").alias("OBS_DT"),
        _none().alias("REASON_CD"), F.lit(RECEIPT_POS[PROCESSED]).alias("POS"))


def event_rows(events_: DataFrame) -> DataFrame:
    """Events recoded to receipt statuses."""
    code = col("EVENT_STATUS_CD")
    status = position = None
    for event, (to, pos) in EVENT_STATUS.items():
        status = F.when(code == event, to) if status is None else status.when(code == event, to)
        position = F.when(code == event, pos) if position is None else position.when(code == event, pos)
    return events_.filter(code.isin(*EVENT_STATUS)).select(
        ID, status.alias("STATUS_CD"), col("EVENT_DT").alias("OBS_DT"), _none().alias("REASON_CD"),
        position.alias("POS"))


def prefer_events(rows: DataFrame, event_rows_: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Event values win where the receipt has an event of the same status; duplicates fan out."""
    take = ["OBS_DT", "REASON_CD", "POS"]
    out = J.lookup_spread(rows, event_rows_, [ID, "STATUS_CD"], take, "E_", hot_rows)
    return out.select(ID, "STATUS_CD", *[F.coalesce(f"E_{c}", c).alias(c) for c in take])


def movement_rows(movements_: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Exit (status 2) and entry (status 3) rows, numbered per receipt by date and status."""
    code = col("CODE")
    rows = observe(movements_, [ID], [
        (col("EXIT_DT").isNotNull(),
         {"STATUS_CD": F.lit(PROCESSED), "OBS_DT": col("EXIT_DT"), "REASON_CD": _none()}),
        (code != "0000",
         {"STATUS_CD": F.lit(RETURNED), "OBS_DT": col("ENTRY_DT"), "REASON_CD": F.substring(code, 1, 4)}),
    ])
    # A movement yields at most two rows, so counting movements is enough to find hot receipts.
    probe = movements_.select(ID, F.coalesce("EXIT_DT", "ENTRY_DT").alias("OBS_DT"))
    limit = HOT_ROWS if hot_rows is None else hot_rows
    ranked = along(rows, [ID], ["OBS_DT", "STATUS_CD", "REASON_CD"], rank="_rank", hot_rows=limit if limit >= NEVER else limit // 2, probe=probe)
    return ranked.select(ID, "STATUS_CD", "OBS_DT", "REASON_CD",
                         (col("_rank") + MOVEMENT_POS).cast("int").alias("POS"))


def override(rows: DataFrame, movement_rows_: DataFrame, null_aware: bool = False) -> DataFrame:
    """Movements replace the status-2 rows of their receipt."""
    kept = J.drop_listed(rows, col("STATUS_CD") == PROCESSED, ID, movement_rows_, ID, null_aware)
    return kept.select(*OBSERVATION).unionByName(movement_rows_.select(*OBSERVATION))


def history(receipts_: DataFrame, events_: DataFrame, movements_: DataFrame, missing: str = SAS,
            null_aware: bool = False, hot_rows: int | None = None) -> DataFrame:
    """All observations of all receipts."""
    own = receipt_rows(receipts_, missing).unionByName(late_processed_rows(receipts_, events_))
    merged = prefer_events(own, event_rows(events_), hot_rows)
    return override(merged, movement_rows(movements_, hot_rows), null_aware)


# ------------------------------------------------------------------ stage 1

def adjust(rows: DataFrame, hot_rows: int | None = None, probe: DataFrame | None = None, missing: str = SAS) -> DataFrame:
    """Status-dependent dates. Input: multiplied rows with EVENT_02_DT, HAS_03, CHARGED, PROD_ID; fees, where given, break ties.

    With ``missing="sql"`` an absent product leaves the rule for cancelled receipts unknown, and the general date applies.
    """
    status = col("STATUS_CD")
    rows = along(
        rows, [ID],
        ["POS", "STATUS_CD", "OBS_DT", "REASON_CD", "EVENT_02_DT", "PROD_ID", "POLICY_NO", "TRANS_GROSS_AMT",
         *[c for c in _FEES if c in rows.columns]],
        prev=("_before", ["STATUS_CD"]),
        whole={"_created": F.when(status == CREATED, col("OBS_DT")),
               "_emitted": F.when(status == EMITTED, col("OBS_DT"))},
        hot_rows=hot_rows, probe=probe)
    before = F.col("_before.STATUS_CD")
    came = F.coalesce(F.col("EVENT_02_DT"), F.col("X_CREATION_DT"))
    special = (col("PROD_ID") == "0850") & F.coalesce(before == EMITTED, F.lit(False))
    skipped = ~F.coalesce(before.isin(PROCESSED, RETURNED), F.lit(False)) & col("HAS_03").isNull() & unless(special, missing)
    processed = (F.when(~status.isin(PROCESSED, COLLECTED, CANCELLED), _none("date"))
                 .when((status == CANCELLED) & skipped, _none("date"))
                 .when((status == CANCELLED) & special, col("X_CREATION_DT"))
                 .otherwise(came))
    only = lambda s, c: F.when(status == s, col(c))
    return rows.withColumns({
        "X_MOV_DT": F.when((status == PROCESSED) & came.isNotNull(), came).otherwise(col("OBS_DT")),
        "X_EMISSION_DT": F.when(status == CREATED, _none("date")).when(status == EMITTED, col("OBS_DT"))
        .otherwise(F.col("_emitted")),
        "X_PROCESSED_DT": processed,
        "X_CREATION_DT": F.col("_created"),
        "X_EXIT_DT": only(PROCESSED, "OBS_DT"),
        "X_RETURNED_DT": only(RETURNED, "OBS_DT"),
        "TRANS_DT": only(COLLECTED, "OBS_DT"),
        "X_CANCEL_DT": only(CANCELLED, "X_CANCEL_DT"),
        "X_RET_REASON_CD": only(RETURNED, "REASON_CD"),
        "X_TRANS_STATUS_CD": text("STATUS_CD"),
        "X_TRANS_PREVIOUS_STATUS_CD": F.coalesce(before.cast("string"), F.lit("")),
        "X_CHARGEBACK_FLG": F.when(col("CHARGED").isNotNull(), "0").otherwise("1"),
    }).drop("_before", "_created", "_emitted")


def stage_states(recibo: DataFrame, mopec1: DataFrame, evento: DataFrame, moviml: DataFrame,
                 apol00: DataFrame, loaded: DataFrame | None = None, *, missing: str = SAS,
                 null_aware: bool = False, hot_rows: int | None = None) -> DataFrame:
    """First stage: one row per lifecycle status of every receipt that is not yet in the history."""
    given_receipts, given_events, mv = receipts(recibo, missing), events(evento).filter(col("EVENT_STATUS_CD").isin("03", *EVENT_STATUS)), movements(moviml)
    # One count finds hot receipts for both merges, another for the join and the window after it.
    ids = given_receipts.select(ID).unionByName(given_events.select(ID)).unionByName(mv.select(ID))
    given = hot_limit(ids, [ID], HOT_ROWS // 2 if hot_rows is None else hot_rows // 2)
    # Stored, as several branches read them: extracts and history are read once, and dates are parsed once. Without hot receipts they are dealt by
    # receipt once, here, and no later step exchanges them or the rows made from them.
    store = lambda df, name: clustered(df.repartition(col(ID)), name, ID, lying=True) if given >= NEVER else (materialise(df, name),) * 2
    bases, evs = store(without_loaded(given_receipts, loaded), "receipts"), store(given_events, "events")
    base, ev = bases[0], evs[0]
    merged = history(base, ev, mv, missing, null_aware, given if given >= NEVER else hot_rows)
    # Five narrow columns, read by the check for hot receipts and by the join.
    lying = clustered(merged, "observations", ID, lying=True) if given >= NEVER else (materialise(merged, "observations"),) * 2
    limit = hot_limit(lying[1], [ID], hot_rows)
    observed, base, ev = (x[0] if limit >= NEVER else x[1] for x in (lying, bases, evs))
    info = enrich(base.filter(col(ID).isNotNull()), fees(mopec1))
    # The product is attached before the receipt is multiplied: same rows, a narrower shuffle.
    product = lambda df: J.lookup(df, products(apol00), ["POLICY_NO"], ["POLICY_NO"], {"PROD_ID": "PROD_ID"})
    info = J.per_group(info, base.filter(col(ID).isNotNull()), ID, ["POLICY_NO"], product)
    # What depends on the receipt alone is attached before the receipt is multiplied.
    marks = ev.filter(col("EVENT_STATUS_CD") == "03").select(ID).distinct().withColumn("HAS_03", F.lit(True))
    charged = base.filter(col("X_CHARGEBACK_CD") == "A").select(ID).withColumn("CHARGED", F.lit(True))
    wide = info.drop("X_CHARGEBACK_CD", "X_RESULT_PARTICIPATION_FLG")
    wide = J.lookup(wide, marks, [ID], [ID], {"HAS_03": "HAS_03"})
    wide = J.lookup(wide, charged, [ID], [ID], {"CHARGED": "CHARGED"})
    wide = J.lookup(wide, ev.filter(col("EVENT_STATUS_CD") == "02"), [ID], [ID], {"EVENT_02_DT": "EVENT_DT"})
    rows = J.join_spread(observed, wide, [ID], limit)
    rows = adjust(rows, limit, observed, missing)
    shared = base.filter(col("TRANS_SUB_TYPE_CD") == 9)
    rows = J.lookup(rows, shared, [ID, "POLICY_NO"], [ID, "POLICY_NO"], {"_shared": "X_RESULT_PARTICIPATION_FLG"})
    rows = rows.withColumn("X_RESULT_PARTICIPATION_FLG", F.coalesce("_shared", F.lit("0")))
    return S.shape(rows, S.RECEIPT_STATES)


# ------------------------------------------------------------------ stage 2

def receipt_employee(reci0x: DataFrame) -> DataFrame:
    value = col("RXVALOR")
    usable = (F.length(value) == 8) & ~F.trim(value).isin("00000000", "99999999")
    return reci0x.filter((col("RX$VAL") == 881) & usable).select(
        key(("RXNANO", 2), ("RXNMES", 2), ("RXNSEQ", 5)).alias(ID), value.alias("EMPLOYEE"))


def policy_employee(apolpa: DataFrame, entvin: DataFrame, entrel: DataFrame) -> DataFrame:
    """Latest employee person per proposal, through entity relation and entity link."""
    links = entvin.filter(col("EV_INF") == 900).select("EV_REL", F.substring("EVVALO", 1, 8).alias("X_EMPLOYEE_EXT_ID"))
    relations = entrel.filter((col("ERSTEN") == "F") & (col("ERTENT") == "B") & (col("ERTIPO") == "ENT"))
    named = links.join(relations, col("EV_REL") == col("ER_REL"))
    staff = apolpa.filter(col("AL$PAP") == "FUN").join(named, col("AL$ENT") == col("ER_COD"), "left")
    staff = staff.withColumn("X_EMPLOYEE_EXT_ID", F.coalesce("X_EMPLOYEE_EXT_ID", F.lit("")))
    newest = latest_per_key(staff, ["AL$MOD", "ALNAPO"], [col("ALDTIN").desc_nulls_first(), col("X_EMPLOYEE_EXT_ID").asc()])
    return newest.select(key(("AL$MOD", 2), ("ALNAPO", 8)).alias("PROPOSAL_NO"), "X_EMPLOYEE_EXT_ID")


def with_employee(states: DataFrame, reci0x: DataFrame, entvin: DataFrame, entrel: DataFrame,
                  apolpa: DataFrame) -> DataFrame:
    """Receipt-level employee for sub-type 5, else the employee of the policy."""
    named = lambda df: J.lookup(df, policy_employee(apolpa, entvin, entrel), ["PROPOSAL_NO"], ["PROPOSAL_NO"], {"_policy": "X_EMPLOYEE_EXT_ID"})
    out = J.per_group(states, states, ID, ["PROPOSAL_NO"], named)
    out = J.lookup(out, receipt_employee(reci0x), [ID], [ID], {"_receipt": "EMPLOYEE"},
                   only=col("TRANS_SUB_TYPE_CD") == "5")
    own = blank_to_null(F.trim("_receipt"))
    return out.withColumn("X_EMPLOYEE_EXT_ID", F.when(own.isNull(), F.col("_policy")).otherwise(F.col("_receipt"))).drop("_policy", "_receipt")


#: Sort order that separates all rows which differ in any visible date or code.
_TIES = ["X_RET_REASON_CD", "X_PROCESSED_DT", "TRANS_DT", "X_CANCEL_DT", "X_TRANS_PREVIOUS_STATUS_CD",
         "POLICY_NO", "TRANS_GROSS_AMT", *_FEES]


def first_processed(rows: DataFrame, order: list[str], empty_frame_is_zero: bool,
                    hot_rows: int | None = None, probe: DataFrame | None = None) -> DataFrame:
    """Flag the first row of a receipt that has a processed date.

    With ``empty_frame_is_zero=False`` the very first row of a receipt never gets the flag.
    """
    done = col("X_PROCESSED_DT").isNotNull()
    rows = along(rows, [ID], order, earlier=("_earlier", done), hot_rows=hot_rows, probe=probe)
    count = F.col("_earlier")
    none = (F.coalesce(count, F.lit(0)) if empty_frame_is_zero else count) == 0
    return rows.withColumn("X_PROCESSED_FLG", F.when(done & none, "1").otherwise("0")).drop("_earlier")


def manual_flag(rows: DataFrame, recpro: DataFrame) -> DataFrame:
    manual = recpro.filter(col("RPSITU") == 5).select(padded("RPNREC", 9).alias(ID))
    return J.flagged(rows, manual, [ID], [ID], "X_POLICY_TRANS_MANUAL_FLG")


def stage_staffed(states: DataFrame, reci0x: DataFrame, entvin: DataFrame, entrel: DataFrame,
                  apolpa: DataFrame, recpro: DataFrame, *, hot_rows: int | None = None) -> DataFrame:
    """Second stage: employee, first-processed flag, manual flag.

    ``states`` should be a stored table; its keys are also counted.
    """
    rows = with_employee(states, reci0x, entvin, entrel, apolpa)
    order = ["X_TRANS_STATUS_CD", "X_MOV_DT", "X_EXIT_DT", *_TIES, "X_EMPLOYEE_EXT_ID"]
    rows = first_processed(rows, order, True, hot_rows, probe=states)
    return S.shape(manual_flag(rows, recpro), S.STAFFED_STATES)


# ------------------------------------------------------------------ stage 3

def with_synthetic(rows: DataFrame) -> DataFrame:
    """Extra status-2 rows for receipts collected or cancelled without one, in one pass."""
    status, before = col("X_TRANS_STATUS_CD"), col("X_TRANS_PREVIOUS_STATUS_CD")
    collected = (status == "5") & before.isin("0", "1")
    cancelled = (status == "9") & (before != "2") & (col("X_PROCESSED_FLG") == "1")
    kinds = F.array(F.lit("own"), F.when(collected, "collected"), F.when(cancelled, "cancelled"))
    rows = rows.withColumn("_kind", F.explode(kinds)).filter(F.col("_kind").isNotNull())
    own = F.col("_kind") == "own"
    return rows.withColumns({
        "X_MOV_DT": F.when(own, col("X_MOV_DT")).otherwise(col("X_PROCESSED_DT")),
        "X_TRANS_STATUS_CD": F.when(own, status).otherwise("2"),
        "X_CANCEL_DT": F.when(F.col("_kind") != "cancelled", col("X_CANCEL_DT")),
    }).drop("_kind")


def regularisations(recrel: DataFrame, staffed: DataFrame, with_mod: bool = True) -> DataFrame:
    """Original receipt key with the collection date of its related receipt.

    ``with_mod=True`` puts the product class before both keys, as the source system does; such
    keys are longer than receipt keys and match none of them.
    """
    mod = [("RL$MOD", 2)] if with_mod else []
    links = recrel.filter((col("RL$MOD") == 21) & (col("RLESPC") == 6)).select(
        key(*mod, ("RLNANO", 2), ("RLNMES", 2), ("RLNSEQ", 5)).alias("RELATED_ID"),
        key(*mod, ("RLRANO", 2), ("RLRMES", 2), ("RLRSEQ", 5)).alias("ORIGINAL_ID"))
    paid = staffed.filter(col("X_TRANS_STATUS_CD") == "5")
    return J.lookup(links, paid, ["RELATED_ID"], [ID], {"X_REGULARIZATION_DT": "TRANS_DT"})


def regularise(rows: DataFrame, links: DataFrame | None) -> DataFrame:
    """Regularisation date; sub-type 6 and unknown sub-types leave. ``links=None``: no receipt is linked."""
    rows = rows.filter(col("TRANS_SUB_TYPE_CD") != "6")
    if links is None:
        rows = rows.withColumn("_linked", _none("date"))
    else:
        rows = J.lookup(rows, links, [ID], ["ORIGINAL_ID"], {"_linked": "X_REGULARIZATION_DT"}, only=col("X_TRANS_STATUS_CD") == "5")
    own = (F.substring("POLICY_NO", 1, 2) == "21") & (col("TRANS_SUB_TYPE_CD") == "9")
    return rows.withColumn("X_REGULARIZATION_DT", F.when(own, col("TRANS_DT")).otherwise(F.col("_linked"))).drop("_linked")


def withdrawn_policies(apol00: DataFrame) -> DataFrame:
    reason = F.concat(text("A0SITU"), F.trim(F.coalesce(col("A0RAZA"), F.lit(""))))
    return (apol00.filter((col("A0$MOD") == 21) & (reason == "33"))
            .select(key(("A0$MOD", 2), ("A0$APL", 8)).alias("POLICY_NO"), text("A0SITU").alias("STATUS"))
            .distinct().select("POLICY_NO"))


def correct_withdrawals(rows: DataFrame, apol00: DataFrame, staffed: DataFrame | None = None, hot_rows: int | None = None) -> DataFrame:
    """Last receipts of withdrawn policies take the amounts of the first collected receipt.

    The receipts are found in ``staffed`` where it is given, the stored table that ``rows`` come from: the steps between add synthetic
    rows, which need no exchange, and leave these columns alone. So the wide steps are computed once.
    """
    source = (rows if staffed is None else with_synthetic(staffed)).filter(col("TRANS_SUB_TYPE_CD") != "6")
    # Withdrawn policies are all of class 21, so other rows leave before the join.
    mine = source.filter(F.substring("POLICY_NO", 1, 2) == "21").select(
        "POLICY_NO", ID, "TRANS_SUB_TYPE_CD", "TRANS_DT", "X_TRANS_STATUS_CD", "TRANS_GROSS_AMT", "TRANS_NET_AMT")
    mine = materialise(mine.join(withdrawn_policies(apol00), "POLICY_NO"), "withdrawn-receipts")
    last = mine.filter((col("TRANS_SUB_TYPE_CD") == "9") & col("TRANS_DT").isNotNull()).select("POLICY_NO", ID)
    first = mine.filter((col("X_TRANS_STATUS_CD") == "5") & (col("TRANS_SUB_TYPE_CD") != "9") & (col("TRANS_GROSS_AMT") != 0))
    first = first.select("POLICY_NO", col("TRANS_GROSS_AMT").alias("GROSS"), col("TRANS_NET_AMT").alias("NET"))
    # A policy's receipts of both kinds meet in pairs, so a policy with many is spread.
    fixes = J.join_spread(last, first, ["POLICY_NO"], hot_rows)
    out = J.lookup(rows, fixes, [ID, "POLICY_NO"], [ID, "POLICY_NO"], {"_gross": "GROSS", "_net": "NET"})
    return out.withColumns({"TRANS_GROSS_AMT": F.coalesce("_gross", "TRANS_GROSS_AMT"),
                            "TRANS_NET_AMT": F.coalesce("_net", "TRANS_NET_AMT")}).drop("_gross", "_net")


def stage_final(staffed: DataFrame, recrel: DataFrame, apol00: DataFrame, *, with_mod: bool = True,
                hot_rows: int | None = None) -> DataFrame:
    """Third stage: synthetic rows, second flag, regularisation, amount correction.

    ``staffed`` should be a stored table; it is read several times.
    """
    rows = with_synthetic(staffed)
    order = ["X_TRANS_STATUS_CD", "X_MOV_DT", "X_EXIT_DT", *_TIES, "X_EMPLOYEE_EXT_ID"]
    rows = first_processed(rows, order, False, hot_rows, probe=staffed)
    # Keys with the product class are longer than receipt keys: no join, the date is NULL.
    rows = regularise(rows, None if with_mod else regularisations(recrel, staffed, False))
    return S.shape(correct_withdrawals(rows, apol00, staffed, hot_rows), S.FINAL_STATES)
