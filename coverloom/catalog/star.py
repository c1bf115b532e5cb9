"""Extract-shaped views of the star-schema test tables.

Pure projections: every extract is derived row by row from one whole table, so the library's own
stages can run on given data. The oracle repeats the same rules in SQL (``star_sql``).
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverloom.functions import schemas as S
from coverloom.functions.exprs import as_ntz, col, key, open_end, padded
from coverloom.session import materialise

RUN_TS = "2026-07-01 12:00:00"
TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")


def _hundredths(c: str | Column) -> tuple[Column, Column]:
    """Whether a double is the one nearest to a number with two decimals, and its hundredths. Where it is not, the text of the double decides."""
    x = col(c)
    n = F.rint(x * 100)
    return (F.abs(x) < 1e10) & (n / 100 == x), n.cast("long")


def _decimal(c: str | Column, kind: str) -> Column:
    """``cast`` of a double to a decimal of two places or more; numbers with two decimals need no text."""
    plain, n = _hundredths(c)
    return F.when(plain, (n.cast("decimal(12,0)") * F.lit(Decimal("0.01"))).cast(kind)).otherwise(col(c).cast(kind))


def _cents(c: str, by: int = 100) -> Column:
    if by % 100:
        return (_decimal(c, "decimal(18,2)") * by).cast("decimal(14,0)")
    plain, n = _hundredths(c)
    return F.when(plain, (n * (by // 100)).cast("decimal(14,0)")).otherwise((col(c).cast("decimal(18,2)") * by).cast("decimal(14,0)"))


def _class(c: str) -> Column:
    """Product class 1..12, and 21 for one remainder."""
    n = F.pmod(col(c), F.lit(13)) + 1
    return F.when(n == 13, 21).otherwise(n).cast("int")


def _div(c: str, n: int) -> Column:
    return F.floor(col(c) / n).cast("long")


def _mod(c: str | Column, n: int) -> Column:
    return F.pmod(col(c), F.lit(n)).cast("int")


def _parts(prefix: str, stem: str, day: Column) -> dict[str, Column]:
    return {f"{prefix}A{stem}": F.year(day), f"{prefix}M{stem}": F.month(day), f"{prefix}D{stem}": F.dayofmonth(day)}


def _yyyymmdd(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def receipt_number(k: str) -> dict[str, Column]:
    """Year, month and sequence parts; unique for 10^9 orders."""
    return {"ano": _mod(_div(k, 100_000), 100), "mes": _mod(_div(k, 10_000_000), 100), "seq": _mod(k, 100_000)}


class Star:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._stored: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """A fact table; one too small to be split by its files is spread over the cores."""
        df, cores = self.table(name), self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

    def stored(self, name: str) -> DataFrame:
        """An extract as the load would leave it: typed and written once, read by many steps."""
        if name not in self._stored:
            self._stored[name] = materialise(getattr(self, name)(), name)
        return self._stored[name]

    @cached_property
    def orders(self) -> DataFrame:
        return self.spread("orders").withColumn("d", col("o_orderdate").cast("date"))

    @cached_property
    def lines(self) -> DataFrame:
        return self.spread("lineitem").withColumn("d", col("l_shipdate").cast("date"))

    # -------------------------------------------------------------- transactions path

    def recibo(self) -> DataFrame:
        d, k = F.col("d"), "o_orderkey"
        n = receipt_number(k)
        status = F.element_at(F.array(*[F.lit(s) for s in (0, 1, 2, 3, 5, 9)]), _mod(k, 6) + 1)
        before = F.element_at(F.array(F.lit(0), F.lit(1), F.lit(2), F.lit(None).cast("int")), _mod(_div(k, 6), 4) + 1)
        kind = F.element_at(F.array(*[F.lit(v).cast("int") for v in (5, 9, 6, 1, None, 2, 2, 2)]), _mod(_div(k, 24), 8) + 1)
        mark = F.element_at(F.array(*[F.lit(v).cast("string") for v in ("F", "K", "H", "A", None, "X", "X", "X", "X", "X")]),
                            _mod(_div(k, 7), 10) + 1)
        emitted = F.when(_mod(k, 17) != 0, F.date_add(d, 3))  # else 31 February
        days = {
            **_parts("RC", "COB", F.when(status == 5, F.date_add(d, 40))), **_parts("RC", "FR2", F.date_add(d, 5)),
            "RCAEMI": F.year(d), "RCMEMI": F.coalesce(F.month(emitted), F.lit(2)), "RCDEMI": F.coalesce(F.dayofmonth(emitted), F.lit(31)),
            **_parts("RC", "CRI", d), **_parts("RC", "DEV", F.when(_mod(k, 11) != 0, F.date_add(d, 10))),
            **_parts("RC", "PDE", d), **_parts("RC", "PDA", F.date_add(d, 365)),
            **_parts("RC", "ANU", F.when(status == 9, F.date_add(d, 60))), **_parts("RC", "UST", F.date_add(d, 20)),
            **_parts("RC", "DVL", F.date_add(d, 21))}
        days["RCAEMI"] = F.coalesce(F.year(emitted), F.year(d))
        gross = _cents("o_totalprice")
        return S.shape(self.orders, S.EXTRACTS["RECIBO"], **{
            "RCNANO": n["ano"], "RCNMES": n["mes"], "RCNSEQ": n["seq"], "RC$MOD": _class("o_custkey"), "RC$APL": col("o_custkey"),
            "RCNAPO": col("o_custkey") + 1, **days, "RCESPC": kind, "RCSITU": status,
            "RCRANU": F.when(status == 9, _mod(k, 7)), "RCSTAN": before, "RCPRTO": gross, "RCPRSR": gross - 500,
            "RCENV2": F.lit(250), "RCVAL2": gross - 700, "RCENP1": _mod(k, 5) * 100, "RCTCOB": _mod(k, 4),
            "RC$AG2": F.when(_mod(k, 9) == 0, " . ").otherwise(F.concat(F.lit(" A"), _mod("o_custkey", 40).cast("string"), F.lit(" "))),
            "RCSTA3": mark, "RCSTA9": F.when(_mod(k, 5) == 0, 24).otherwise(1)})

    def mopec1(self) -> DataFrame:
        n, gross = receipt_number("o_orderkey"), _cents("o_totalprice", 1)
        return S.shape(self.orders, S.EXTRACTS["MOPEC1"], EDCMOD=_class("o_custkey"), EDVL01=gross,
                       EDVL07=_mod("o_orderkey", 5) * 10, EDVL16=gross + 30, EDVL17=gross + 70, EDNANO=n["ano"], EDNMES=n["mes"],
                       EDNSEQ=n["seq"], EDCEVE=F.when(col("o_orderpriority") == "1-URGENT", "04").otherwise("05"))

    def evento(self) -> DataFrame:
        n = receipt_number("l_orderkey")
        code = (F.when(col("l_linenumber") == 7, "03").when(col("l_returnflag") == "R", "33")
                .when(col("l_returnflag") == "A", "30").otherwise("02"))
        doc = F.when(col("l_linestatus") == "F", "R").when(col("l_quantity") < 25, "E").otherwise("X")
        return S.shape(self.lines, S.EXTRACTS["EVENTO"], **{
            "EOREFD": key((n["ano"], 2), (n["mes"], 2), (n["seq"], 5)), "EODEVE": _yyyymmdd(F.col("d")), "EO$EVE": code, "EOTDOC": doc})

    def moviml(self) -> DataFrame:
        n, d = receipt_number("l_orderkey"), F.col("d")
        return S.shape(self.lines, S.EXTRACTS["MOVIML"], MLNANO=n["ano"], MLNMES=n["mes"], MLNSEQ=n["seq"],
                       MLSITC=F.when(col("l_linenumber") == 1, "0000").otherwise(padded("l_linenumber", 4)),
                       **_parts("ML", "SAI", F.when(col("l_linenumber") != 3, F.date_add(d, 2))),
                       **_parts("ML", "ENT", F.when(col("l_linenumber") != 5, F.date_add(d, 4))),
                       MLTDOC=F.when(col("l_linestatus") == "O", "E").otherwise("R"))

    def customer_policies(self) -> DataFrame:
        c = "c_custkey"
        return S.shape(self.table("customer"), S.EXTRACTS["APOL00"], **{
            "A0$MOD": _class(c), "A0$APL": col(c), "A0NAPO": col(c) + 1, "A0NVER": F.when(_class(c) == 8, 50).otherwise(_mod(c, 60)),
            "A0ACTA": F.lit(0), "A0SITU": F.when(col("c_mktsegment") == "MACHINERY", 3).otherwise(1),
            "A0RAZA": F.when(_mod(c, 2) == 0, " 3")})

    def reci0x(self) -> DataFrame:
        n, k = receipt_number("o_orderkey"), "o_orderkey"
        value = (F.when(_mod(k, 7) == 0, "00000000").when(_mod(k, 7) == 1, "99999999").when(_mod(k, 7) == 2, "        ")
                 .when(_mod(k, 7) == 3, "E123").otherwise(F.concat(F.lit("E"), padded(_mod(k, 50), 7))))
        return S.shape(self.orders, S.EXTRACTS["RECI0X"], **{
            "RXNANO": n["ano"], "RXNMES": n["mes"], "RXNSEQ": n["seq"],
            "RX$VAL": F.when(col("o_orderpriority") == "5-LOW", 880).otherwise(881), "RXVALOR": value})

    def apolpa(self) -> DataFrame:
        return S.shape(self.orders, S.EXTRACTS["APOLPA"], **{
            "AL$MOD": _class("o_custkey"), "ALNAPO": col("o_custkey") + 1, "ALDTIN": _yyyymmdd(F.col("d")), "AL$ENT": _mod("o_orderkey", 150),
            "AL$PAP": F.when(col("o_orderstatus") == "P", "TOM").otherwise("FUN")})

    def entrel(self) -> DataFrame:
        return S.shape(self.table("supplier"), S.EXTRACTS["ENTREL"], ER_REL=col("s_suppkey") + 1000, ER_COD=col("s_suppkey"),
                       ERSTEN=F.lit("F"), ERTENT=F.lit("B"), ERTIPO=F.when(col("s_acctbal") < 2000, "XXX").otherwise("ENT"))

    def entvin(self) -> DataFrame:
        return S.shape(self.table("supplier"), S.EXTRACTS["ENTVIN"], EV_REL=col("s_suppkey") + 1000, EV_INF=F.lit(900),
                       EVVALO=F.concat(F.lit("S"), padded("s_suppkey", 7), F.lit("-rest")))

    def recpro(self) -> DataFrame:
        n = receipt_number("o_orderkey")
        number = key((n["ano"], 2), (n["mes"], 2), (n["seq"], 5)).cast("long")
        return S.shape(self.orders, S.EXTRACTS["RECPRO"], RPNREC=number, RPSITU=F.when(col("o_orderpriority") == "3-MEDIUM", 5).otherwise(1))

    def recrel(self) -> DataFrame:
        """Each receipt related to the receipt six keys later."""
        later = self.orders.withColumn("later", col("o_orderkey") + 6)
        n, r = receipt_number("o_orderkey"), receipt_number("later")
        return S.shape(later, S.EXTRACTS["RECREL"], **{
            "RL$MOD": F.when(col("o_orderstatus") == "F", 20).otherwise(21), "RLNANO": n["ano"], "RLNMES": n["mes"], "RLNSEQ": n["seq"],
            "RLRANO": r["ano"], "RLRMES": r["mes"], "RLRSEQ": r["seq"], "RLESPC": F.lit(6)})

    def _generations(self, df: DataFrame) -> DataFrame:
        """Two validity generations: closed until 2000, and open."""
        spans = F.array(*[F.struct(F.lit(g).alias("generation"), F.lit(a).cast("timestamp_ntz").alias("VALID_FROM_DTTM"),
                                   F.lit(b).cast("timestamp_ntz").alias("VALID_TO_DTTM"))
                          for g, a, b in [(0, "1990-01-01", "1999-12-31"), (1, "2000-01-01", "5999-01-01")]])
        return df.select("*", F.inline(spans))

    def structures(self) -> DataFrame:
        rows = self._generations(self.table("nation"))
        return rows.select(F.concat(F.lit("A"), col("n_nationkey").cast("string")).alias("AGENCY_INT_ID"),
                           (col("n_nationkey") + 500 + 1000 * col("generation")).cast("long").alias("BSN_STRUCTURE_RK"),
                           "VALID_FROM_DTTM", "VALID_TO_DTTM")

    def employees(self) -> DataFrame:
        rows = self._generations(self.table("supplier"))
        return rows.select(F.concat(F.lit("S"), padded("s_suppkey", 7)).alias("X_EMPLOYEE_EXT_ID"),
                           (col("s_suppkey") + 7000 + 100_000 * col("generation")).alias("EMPLOYEE_RK"), "VALID_FROM_DTTM", "VALID_TO_DTTM")

    def customer_dimension(self) -> DataFrame:
        rows = self._generations(self.table("customer"))
        return rows.select(key((_class("c_custkey"), 2), ("c_custkey", 8)).alias("POLICY_NO"),
                           (col("c_custkey") * 2 + col("generation")).alias("POLICY_RK"),
                           (col("c_nationkey") + 500).cast("long").alias("X_BSN_STRUCTURE_RK"), "VALID_FROM_DTTM", "VALID_TO_DTTM")

    # -------------------------------------------------------------- exposure path

    def order_policies(self) -> DataFrame:
        d, k = F.col("d"), "o_orderkey"
        end = F.add_months(d, 60)
        flag = F.when(col("o_orderpriority") == "1-URGENT", "S").when(col("o_orderpriority") != "2-HIGH", "N")
        return S.shape(self.orders, S.EXTRACTS["APOL00"], **{
            "A0$MOD": _class(k), "A0$APL": col(k), "A0NAPO": col(k) + 1, "A0NVER": F.lit(1), "A0ACTA": _mod(_div(k, 13), 4),
            "A0INF4": flag, "A0PRSC": _cents("o_totalprice", 10), "A0CTOT": _cents("o_totalprice", 100),
            "A0INDX": _mod(k, 100).cast("decimal(7,4)") * F.lit(0.01).cast("decimal(3,2)"), "A0DURC": F.when(_mod(k, 2) == 0, "V").otherwise("T"),
            "A0SITU": F.when(col("o_orderstatus") == "F", 3).when(col("o_orderstatus") == "O", 1), "A0HINI": _mod(k, 24),
            **_parts("A0", "INI", d), **_parts("A0", "FIM", end), **_parts("A0", "SIT", F.date_add(d, 100)), **_parts("A0", "EFE", F.date_add(d, 30)),
            **_parts("A0", "PMB", F.when(_mod(k, 19) != 0, F.date_add(d, _mod(k, 21) - 10)))})

    def acta00(self) -> DataFrame:
        d, k = F.col("d"), "l_orderkey"
        return S.shape(self.lines, S.EXTRACTS["ACTA00"], **{
            "A0$MOD": _class(k), "A0$APL": col(k), "A0NAPO": col(k) + 1, "A0ACTA": col("l_linenumber") - 1,
            "A0INF4": F.when((col("l_returnflag") == "R") & (col("l_linestatus") == "O"), "S").when(col("l_returnflag") != "A", "N"),
            "A0PRST": _cents("l_extendedprice"), "A0CTOT": _cents("l_quantity", 10_000), "A0INDX": _decimal("l_discount", "decimal(7,4)"),
            "A0DURC": col("l_returnflag"), "A0SITU": _mod("l_linenumber", 4), **_parts("A0", "INI", d), **_parts("A0", "SIT", F.date_add(d, 1)),
            **_parts("A0", "EFE", F.when(col("l_tax") > 0, F.date_add(d, 2)))})

    def _cover(self) -> Column:
        n = _mod("l_partkey", 5)
        return F.when(n == 4, 90).otherwise(n)

    def apol03(self) -> DataFrame:
        d, k = F.col("d"), "l_orderkey"
        return S.shape(self.lines, S.EXTRACTS["APOL03"], **{
            "A3$MOD": _class(k), "A3NAPO": col(k) + 1, "A3NORD": _mod("l_suppkey", 2), "A3$CMP": self._cover(),
            "A3PREM": F.when(col("l_tax") > 0.01, _cents("l_extendedprice")), "A3CAPT": F.when(col("l_tax") > 0.01, _cents("l_quantity", 10_000)),
            "A3SITU": _mod("l_linenumber", 4), "A3INDX": _decimal("l_tax", "decimal(7,4)"), "A3DURC": col("l_linestatus"),
            **_parts("A3", "INI", d), **_parts("A3", "SIT", F.date_add(d, 3)), **_parts("A3", "FIM", F.add_months(d, 60))})

    def acta03(self) -> DataFrame:
        k = "l_orderkey"
        return S.shape(self.lines, S.EXTRACTS["ACTA03"], **{
            "A3$MOD": _class(k), "A3NAPO": col(k) + 1, "A3NORD": _mod("l_suppkey", 2), "A3$CMP": _mod(col("l_partkey") + 1, 5),
            "A3ACTA": col("l_linenumber") - 1, "A3INDX": _decimal(col("l_tax") + col("l_discount"), "decimal(7,4)"), "A3DURC": col("l_returnflag")})

    def changed_images(self) -> DataFrame:
        d, k = F.col("d"), "l_orderkey"
        return S.shape(self.lines, S.CHANGED_IMAGES, POLICY_NO=key((_class(k), 2), (k, 8)), PROPOSAL_NO=key((_class(k), 2), (col(k) + 1, 8)),
                       POLICY_VERSION=col("l_linenumber") - 1, X_COVERAGE_CD=self._cover().cast("string"), X_ORDER_CD=F.lit("0"),
                       POLICY_STATUS_CD=F.when(col("l_returnflag") == "R", "").when(col("l_returnflag") == "A", "1").otherwise("2"),
                       ANNUAL_PREMIUM_AMT=F.when(col("l_discount") > 0.01, _decimal("l_extendedprice", "decimal(18,2)")),
                       CASH_VALUE=F.when(col("l_discount") > 0.01, _decimal(col("l_quantity") * 100, "decimal(18,2)")),
                       X_INDEXATION_RT=_decimal("l_discount", "decimal(7,4)"), EFFECTIVE_DT=d, EXPIRATION_DT=F.add_months(d, 60),
                       TERMINATION_DT=F.when(col("l_linestatus") == "O", F.date_add(d, 1000)), RENEWABLE_IND=col("l_returnflag"),
                       CHANGE_EFFECTIVE_FROM_DTTM=F.when(_mod("l_suppkey", 10) != 0, as_ntz(d)))

    def group_images(self) -> DataFrame:
        d, k = F.col("d"), "o_orderkey"
        return S.shape(self.orders, S.GROUP_IMAGES, POLICY_NO=key((F.lit(8), 2), (k, 8)), PROPOSAL_NO=key((F.lit(8), 2), (col(k) + 1, 8)),
                       POLICY_VERSION=_mod(k, 3) + 1, POLICY_STATUS_CD=F.concat(F.lit(" "), col("o_orderstatus")), X_ORDER_CD=F.lit("1"),
                       ADMISSION_DT=d, X_ORDER_STATUS=col("o_orderstatus"), X_ORDER_STATUS_DT=F.date_add(d, 1), X_COVERAGE_CD=_mod(k, 6).cast("string"),
                       ANNUAL_PREMIUM_AMT=_decimal("o_totalprice", "decimal(18,2)"), CASH_VALUE=_decimal("o_totalprice", "decimal(18,2)"),
                       EXPIRATION_DT=F.add_months(d, 12), X_INDEXATION_RT=F.lit(0), EFFECTIVE_DT=d, RENEWABLE_IND=F.lit("V"))

    def policy_versions(self) -> DataFrame:
        d, k = F.col("d"), "o_orderkey"
        return self.orders.select(key((F.lit(8), 2), (k, 8)).alias("POLICY_NO"), _mod(_div(k, 2), 3).cast("decimal(38,0)").alias("POLICY_VERSION"),
                                  as_ntz(F.date_add(d, 7)).alias("CHANGE_EFFECTIVE_FROM_DTTM"), open_end().alias("CHANGE_EFFECTIVE_TO_DTTM"))

    def policy_dimension(self) -> DataFrame:
        rows = self._generations(self.orders)
        return rows.select(key((_class("o_orderkey"), 2), ("o_orderkey", 8)).alias("POLICY_NO"),
                           (col("o_orderkey") * 2 + col("generation")).alias("POLICY_RK"), "VALID_TO_DTTM")

    def proposal_dimension(self) -> DataFrame:
        rows = self._generations(self.orders)
        return rows.select(key((_class("o_orderkey"), 2), (col("o_orderkey") + 1, 8)).alias("PROPOSAL_NO"),
                           (col("o_orderkey") * 2 + col("generation") + 5).alias("X_POLICY_PROPOSAL_RK"), "VALID_TO_DTTM")

    def coverage_dimension(self) -> DataFrame:
        rows = self._generations(self.table("region"))
        return rows.select(col("r_regionkey").cast("string").alias("COVERAGE_CD"),
                           (col("r_regionkey") + 900 + 10 * col("generation")).cast("long").alias("COVERAGE_RK"), "VALID_TO_DTTM",
                           F.substring("r_name", 1, 2).alias("COVERAGE_TYPE_CD"), col("r_name").alias("X_COVERAGE_SHORT_DESC"))

    def category_dimension(self) -> DataFrame:
        rows = self._generations(self.table("nation"))
        return rows.select(padded(col("n_nationkey") + 1, 2).alias("PRODUCT_CATEGORY_CD"),
                           (col("n_nationkey") + 300 + 100 * col("generation")).cast("long").alias("PRODUCT_CATEGORY_RK"), "VALID_TO_DTTM")

    # -------------------------------------------------------------- a loaded exposure table

    def exposures(self) -> DataFrame:
        """Line items in the layout of the loaded exposure table; few premiums are extreme."""
        d = F.col("d")
        factor = F.when(_mod("l_partkey", 500) == 0, 60).otherwise(1)
        return S.shape(self.lines, S.EXPOSURE, UOE_RK=col("l_orderkey"), POLICY_RK=col("l_orderkey"), X_POLICY_VERSION=col("l_linenumber"),
                       COVERAGE_RIDER_RK=(_mod("l_partkey", 6) + 910).cast("long"), X_ORDER_CD=col("l_linestatus"),
                       ANNUAL_PREMIUM_AMT=F.when(_mod("l_suppkey", 50) != 7, _decimal("l_extendedprice", "decimal(18,2)") * factor),
                       CASH_VALUE=_decimal(col("l_quantity") * 100, "decimal(18,2)"), X_POLICY_STATUS_CD=col("l_returnflag"),
                       RENEWABLE_IND=F.when(col("l_linestatus") == "F", "V").otherwise("T"), EFFECTIVE_DT=F.add_months(d, 252),
                       X_POLICY_TERMINATION_DT=F.when(col("l_returnflag") == "R", F.add_months(d, 264)),
                       VALID_FROM_DTTM=as_ntz(d), VALID_TO_DTTM=F.when(col("l_linestatus") == "F", as_ntz(F.date_add(d, 90))).otherwise(open_end()))
