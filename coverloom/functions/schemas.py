"""Column contracts of the extracts, the stages and the loaded tables (fixed values).

A contract is written as ``"name:type name:type"``. Dates of the extracts come as three integer
columns; ``dates("RC", "COB FR2")`` stands for RCACOB, RCMCOB, RCDCOB, RCAFR2, ...
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverloom.functions.exprs import col


def dates(prefix: str, stems: str) -> str:
    return " ".join(f"{prefix}{p}{s}:int" for s in stems.split() for p in "AMD")


def typed(names: str, kind: str) -> str:
    return " ".join(f"{n}:{kind}" for n in names.split())


_KINDS: dict[str, T.DataType] = {
    "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "string": T.StringType(),
    "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(),
}


def _kind(name: str) -> T.DataType:
    if name.startswith("decimal"):
        return T.DecimalType(*[int(n) for n in name[len("decimal("):-1].split(",")])
    return _KINDS[name]


def schema(*parts: str) -> T.StructType:
    fields = [item.rsplit(":", 1) for part in parts for item in part.split()]
    return T.StructType([T.StructField(n, _kind(k)) for n, k in fields])


MONEY = "decimal(14,0)"
RATE = "decimal(7,4)"

#: Columns the transformations read, by extract.
EXTRACTS: dict[str, T.StructType] = {
    "RECIBO": schema(
        "RCNANO:int RCNMES:int RCNSEQ:int RC$MOD:int RC$APL:long RCNAPO:long",
        dates("RC", "COB FR2 EMI CRI DEV PDE PDA ANU UST DVL"),
        typed("RCESPC RCSITU RCRANU RCSTAN", "int"),
        typed("RCPRTO RCPRSR RCENV2 RCVAL2 RCENP1", MONEY),
        "RCTCOB:int RC$AG2:string RCSTA3:string RCSTA9:int",
    ),
    "MOPEC1": schema("EDCMOD:int", typed("EDVL01 EDVL07 EDVL16 EDVL17", "decimal(15,0)"),
                     "EDNANO:int EDNMES:int EDNSEQ:int EDCEVE:string"),
    "EVENTO": schema("EOREFD:string EODEVE:int EO$EVE:string EOSTSO:string EOTDOC:string"),
    "MOVIML": schema("MLNANO:int MLNMES:int MLNSEQ:int MLSITC:string", dates("ML", "SAI ENT"),
                     "MLTDOC:string"),
    "APOL00": schema("A0$MOD:int A0$APL:long A0NAPO:long A0NVER:int A0ACTA:int A0INF4:string",
                     typed("A0PRSC A0CTOT", MONEY), f"A0INDX:{RATE} A0DURC:string A0SITU:int",
                     "A0RAZA:string A0HINI:int", dates("A0", "INI FIM SIT EFE PMB")),
    "ACTA00": schema("A0$MOD:int A0$APL:long A0NAPO:long A0ACTA:int A0INF4:string",
                     typed("A0PRST A0CTOT", MONEY), f"A0INDX:{RATE} A0DURC:string A0SITU:int",
                     dates("A0", "INI SIT EFE")),
    "APOL03": schema("A3$MOD:int A3NAPO:long A3NORD:int A3$CMP:int", typed("A3PREM A3CAPT", MONEY),
                     f"A3SITU:int A3INDX:{RATE} A3DURC:string", dates("A3", "INI SIT FIM")),
    "ACTA03": schema(f"A3$MOD:int A3NAPO:long A3NORD:int A3$CMP:int A3ACTA:int A3INDX:{RATE}",
                     "A3DURC:string"),
    "RECI0X": schema("RXNANO:int RXNMES:int RXNSEQ:int RX$VAL:int RXVALOR:string"),
    "ENTVIN": schema("EVVALO:string EV_REL:long EV_INF:int"),
    "ENTREL": schema("ER_REL:long ER_COD:long ERSTEN:string ERTENT:string ERTIPO:string"),
    "APOLPA": schema("AL$MOD:int ALNAPO:long ALDTIN:int AL$ENT:long AL$PAP:string"),
    "RECPRO": schema("RPNREC:long RPSITU:int"),
    "RECREL": schema("RL$MOD:int", typed("RLNANO RLNMES RLNSEQ RLRANO RLRMES RLRSEQ RLESPC", "int")),
    # Extracted but read by no transformation.
    "ACTA0P": schema(typed("AP$COB AP$CON APSEQS", "int"), dates("AP", "SAI"),
                     typed("APSEQE APMOVE", "int"), dates("AP", "ENT"),
                     typed("APSITU APTIPO APINDI", "string"), "APVALO:decimal(15,2) APDURA:int",
                     "AP$MOD:int AP$APL:long APNVER:int APFALT:int APMALT:int APDALT:int APUSER:string"),
    "APOL0PH": schema("PH$MOD:int PH$APL:long PHNVER:int", dates("PH", "INI FIM"), "PHSTAT:string",
                      dates("PH", "ALT"), "PHUSER:string"),
    "APOL0P": schema("PP$MOD:int PP$APL:long PPNVER:int", dates("PP", "SAI"), "PPSITU:string",
                     dates("PP", "INC"), f"PPINDX:{RATE} PPFREC:string PPFPAG:string PPNPAG:int",
                     dates("PP", "ALT"), "PPUSER:string"),
}

AMOUNT = "decimal(18,5)"
_DAYS = ("X_MOV_DT X_VALUE_DT X_CREATION_DT X_EMISSION_DT X_PROCESSED_DT X_EXIT_DT X_RETURNED_DT "
         "TRANS_DT X_CANCEL_DT X_PERIOD_FROM_DT X_PERIOD_TO_DT")
_CODES = "TRANS_SUB_TYPE_CD X_TRANS_STATUS_CD X_CANCEL_REASON_CD X_TRANS_PREVIOUS_STATUS_CD"
_GROSS = "TRANS_GROSS_AMT TRANS_NET_AMT X_TRANS_PURE_AMT X_INEM_AMT"
_FEES = "X_SUBS_CHARGE_AMT X_SUBS_FEE_AMT X_MANAGEMENT_FEE_AMT"

#: First transactions stage: one row per lifecycle status of a receipt.
RECEIPT_STATES = schema(
    typed("POLICY_TRANS_ID POLICY_NO PROPOSAL_NO ORIGINAL_POLICY_TRANS_ID", "string"),
    typed(_DAYS, "date"), typed(_CODES, "string"), typed(_GROSS, AMOUNT), "PAYMENT_METHOD_CD:string",
    typed(_FEES, AMOUNT),
    typed("X_REINVESTMENT_FLG X_RET_REASON_CD X_IS_CLOSED_FLG AGENCY_INT_ID X_CHARGEBACK_FLG "
          "X_RESULT_PARTICIPATION_FLG", "string"),
)

_STAFFED_DAYS = ("X_MOV_DT TRANS_DT X_VALUE_DT X_EMISSION_DT X_CREATION_DT X_PROCESSED_DT "
                 "X_PERIOD_FROM_DT X_PERIOD_TO_DT X_CANCEL_DT X_EXIT_DT X_RETURNED_DT")
_STAFFED_TAIL = [
    typed(_CODES, "string"), typed(_GROSS, AMOUNT), "PAYMENT_METHOD_CD:string", typed(_FEES, AMOUNT),
    typed("X_REINVESTMENT_FLG X_RET_REASON_CD X_IS_CLOSED_FLG X_EMPLOYEE_EXT_ID AGENCY_INT_ID "
          "X_PROCESSED_FLG X_CHARGEBACK_FLG X_RESULT_PARTICIPATION_FLG X_POLICY_TRANS_MANUAL_FLG",
          "string"),
]
_STAFFED_KEYS = typed("POLICY_TRANS_ID POLICY_NO ORIGINAL_POLICY_TRANS_ID", "string")

#: Second stage adds employee and flags, the third the regularisation date.
STAFFED_STATES = schema(_STAFFED_KEYS, typed(_STAFFED_DAYS, "date"), *_STAFFED_TAIL)
FINAL_STATES = schema(_STAFFED_KEYS, typed(_STAFFED_DAYS, "date"), "X_REGULARIZATION_DT:date",
                      *_STAFFED_TAIL)

#: Loaded transactions, the same for the open table and the closed history.
TRANSACTIONS = schema(
    "POLICY_TRANS_ID:string SOURCE_SYSTEM_CD:string POLICY_RK:long ORIGINAL_POLICY_TRANS_ID:string",
    typed("X_MOV_DT TRANS_DT X_VALUE_DT X_EMISSION_DT X_CREATION_DT X_PROCESSED_DT "
          "X_REGULARIZATION_DT", "date"),
    "TRANS_TYPE_CD:string TRANS_SUB_TYPE_CD:string REVERSAL_IND:string",
    typed("TRANS_FEE TRANS_GROSS_AMT TRANS_NET_AMT X_TRANS_PURE_AMT", AMOUNT),
    "TRANS_CURRENCY_CD:string REFERENCE_NO:string PAYMENT_METHOD_CD:string TOTAL_UNITS:decimal(38,0)",
    typed("UNIT_VALUE FEDERAL_TAX_WITHHELD JURISDICTION_TAX_WITHHELD LOCAL_TAX_WITHHELD "
          "SERVICES_TAX_WITHHELD ANNUITY_CONTRIBUTION_AMT", AMOUNT),
    "SUB_ACCOUNT_RK:decimal(38,0) USER_CD:string PAYEE_RK:decimal(38,0)",
    typed("X_TRANS_PREVIOUS_STATUS_CD X_CANCEL_REASON_CD", "string"), "X_CANCEL_DT:date",
    "X_TRANS_STATUS_CD:string X_PERIOD_FROM_DT:date X_PERIOD_TO_DT:date",
    typed("X_INEM_AMT " + _FEES, AMOUNT), "X_EXIT_DT:date X_RETURNED_DT:date",
    typed("X_REINVESTMENT_FLG X_RET_REASON_CD X_IS_CLOSED_FLG", "string"),
    "X_EMPLOYEE_RK:long X_BSN_STRUCTURE_RK:long X_PROCESSED_FLG:string PROCESSED_DTTM:timestamp_ntz",
    typed("X_CHARGEBACK_FLG X_RESULT_PARTICIPATION_FLG X_POLICY_TRANS_MANUAL_FLG", "string"),
)

#: First exposure stage: coverages of policies.
COVERAGES = schema(
    typed("POLICY_NO PROPOSAL_NO X_COVERAGE_CD X_ORDER_CD", "string"), "POLICY_VERSION:decimal(38,0)",
    typed("ANNUAL_PREMIUM_AMT CASH_VALUE", "decimal(38,2)"), "X_INDEXATION_RT:decimal(38,6)",
    "RENEWABLE_IND:string ADMISSION_DT:date X_ORDER_STATUS:string EFFECTIVE_DT:date",
    "TERMINATION_DT:date CHANGE_EFFECTIVE_FROM_DTTM:timestamp_ntz",
    "CHANGE_EFFECTIVE_TO_DTTM:timestamp_ntz POLICY_STATUS_CD:string EXPIRATION_DT:date",
)

#: Declared inputs of the second exposure stage.
CHANGED_IMAGES = schema(
    typed("POLICY_NO PROPOSAL_NO", "string"), "POLICY_VERSION:decimal(38,0)",
    typed("X_COVERAGE_CD X_ORDER_CD POLICY_STATUS_CD", "string"),
    typed("ANNUAL_PREMIUM_AMT CASH_VALUE", "decimal(38,2)"), "X_INDEXATION_RT:decimal(38,6)",
    typed("EFFECTIVE_DT EXPIRATION_DT TERMINATION_DT", "date"),
    "RENEWABLE_IND:string CHANGE_EFFECTIVE_FROM_DTTM:timestamp_ntz",
)
GROUP_IMAGES = schema(
    typed("POLICY_NO PROPOSAL_NO", "string"), "POLICY_VERSION:decimal(38,0)",
    typed("POLICY_STATUS_CD X_ORDER_CD", "string"), "ADMISSION_DT:date X_ORDER_STATUS:string",
    "X_ORDER_STATUS_DT:date X_COVERAGE_CD:string",
    typed("ANNUAL_PREMIUM_AMT CASH_VALUE", "decimal(38,2)"),
    "EXPIRATION_DT:date TERMINATION_DT:date X_INDEXATION_RT:decimal(38,6) EFFECTIVE_DT:date",
    "RENEWABLE_IND:string",
)

#: Second exposure stage: versioned images.
IMAGES = schema(
    typed("POLICY_NO PROPOSAL_NO", "string"), "POLICY_VERSION:decimal(38,0)",
    typed("X_COVERAGE_CD X_ORDER_CD POLICY_STATUS_CD", "string"),
    typed("ANNUAL_PREMIUM_AMT CASH_VALUE", "decimal(38,2)"), "X_INDEXATION_RT:decimal(38,6)",
    typed("ADMISSION_DT EFFECTIVE_DT EXPIRATION_DT TERMINATION_DT", "date"), "RENEWABLE_IND:string",
    "CHANGE_EFFECTIVE_FROM_DTTM:timestamp_ntz CHANGE_EFFECTIVE_TO_DTTM:timestamp_ntz",
    "X_ORDER_STATUS:string X_ORDER_STATUS_DT:date",
)

#: Loaded exposure table (type-2 history).
EXPOSURE = schema(
    "UOE_RK:long VALID_FROM_DTTM:timestamp_ntz POLICY_RK:long X_POLICY_PROPOSAL_RK:long",
    "X_POLICY_VERSION:decimal(38,0) X_ORDER_CD:string INSURED_RK:decimal(12,0) COVERAGE_RIDER_RK:long",
    "EQUIVALENT_AGE:decimal(3,0)",
    typed("LIFE_HAZARD_CD LIFE_COVERAGE_STATUS_CD PURPOSE_CD", "string"),
    typed("X_ADMISSION_DT EFFECTIVE_DT EXPIRATION_DT", "date"),
    "RENEWABLE_IND:string X_ORDER_STATUS:string X_ORDER_STATUS_DT:date GUAR_INT_RT:decimal(9,4)",
    "PAYMENT_MODE_CD:string CASH_VALUE:decimal(38,2)",
    typed("SURRENDER_CHARGE_AMT CURR_AMT VALUE_PER_UNIT", AMOUNT), "NO_OF_UNITS:decimal(9,0)",
    typed("BASE_PREMIUM_AMT MODAL_PREMIUM_AMT", AMOUNT),
    "ANNUAL_PREMIUM_AMT:decimal(38,2) X_INDEXATION_RT:decimal(38,6)",
    typed("GDB_PREMIUM_AMT COMMISSION_AMT", AMOUNT), "TERMINATION_DT:date",
    f"TEMP_EXTRA_PREMIUM_AMT:{AMOUNT} TEMP_EXTRA_START_DT:date TEMP_EXTRA_END_DT:date",
    f"PERM_EXTRA_PREMIUM_AMT:{AMOUNT} PERM_EXTRA_START_DT:date ISSUED_AS_APPLIED_IND:string",
    f"PREMIUM_PER_UNIT:{AMOUNT} RESERVE_METHOD_CD:string RESERVE_AMT:{AMOUNT}",
    "RESERVE_INTEREST_RT:decimal(9,4)",
    typed("BENEFIT_PERIOD_CD BENEFIT_MODE_CD WAITING_PERIOD_CD", "string"),
    "BENEFIT_AMT_REVISION_NEXT_DT:date JOINT_BENEFIT_PAYOUT_CD:string LAST_VALUATION_DT:date",
    f"LIVES_TYPE_CD:string PREMIUM_TERMINATION_DT:date BENEFIT_AMT:{AMOUNT}",
    f"BONUS_PAID_UP_TO_DT:date BONUS_AMT:{AMOUNT} MATURITY_BENEFIT_AMT:{AMOUNT}",
    "PREMIUM_PAID_UP_TO_DT:date RETURN_OF_PREM_BENEFIT_FLG:string RETURN_OF_PREM_RT:decimal(9,4)",
    "X_POLICY_STATUS_CD:string X_POLICY_TERMINATION_DT:date SALARY_PCT:decimal(9,4)",
    typed("SOLVENCY2_LEVEL_1_SEGMENT_CD SOLVENCY2_LEVEL_2_SEGMENT_CD", "string"), "LOB_RK:long",
    typed("CHANGE_EFFECTIVE_FROM_DTTM CHANGE_EFFECTIVE_TO_DTTM", "timestamp_ntz"),
    "JOINT_LIFE_INSURED_RK:decimal(12,0) VALID_TO_DTTM:timestamp_ntz PROCESSED_DTTM:timestamp_ntz",
    "DIGEST_VALUE:string",
)

#: Columns outside the change digest: surrogate and natural key, validity, load stamp, the digest.
UNDIGESTED = ("UOE_RK VALID_FROM_DTTM POLICY_RK X_POLICY_PROPOSAL_RK X_ORDER_CD COVERAGE_RIDER_RK "
              "VALID_TO_DTTM PROCESSED_DTTM DIGEST_VALUE").split()

MONITOR_LOG = schema("LOG_ID:string CHECK_TYPE:string STATUS:string METRIC_VALUE:double "
                     "THRESHOLD_VALUE:double AI_SUMMARY:string DETAILS:string CREATED_AT:timestamp_ntz")
ALERTS = schema("ALERT_ID:string ALERT_TYPE:string ALERT_MSG:string RECORD_COUNT:double "
                "CREATED_AT:timestamp_ntz")


def shape(df: DataFrame, contract: T.StructType, **constants: Column) -> DataFrame:
    """Project ``df`` onto a contract: fixed order and types, constants, typed NULLs for the rest."""
    out = []
    for field in contract.fields:
        if field.name in constants:
            value = constants[field.name]
        elif field.name in df.columns:
            value = col(field.name)
        else:
            value = F.lit(None)
        out.append(value.cast(field.dataType).alias(field.name))
    return df.select(*out)
