"""Metric layer: named metrics over chosen dimensions, joined along declared relationships."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverloom.functions.exprs import col


@dataclass(frozen=True)
class Relationship:
    left_column: str
    right_table: str
    right_column: str
    how: str


#: Column of the first aggregation that holds the counted key.
KEY = "_counted"


@dataclass(frozen=True)
class Metric:
    """``parts`` are aggregates per dimensions, and per counted key too if a metric is ``keyed``; ``value`` combines them.

    Several distinct counts at once would make Spark expand every row; rows of one key each need none.
    """

    parts: Callable[[], dict[str, Column]]
    value: Callable[[], Column]
    keyed: bool = False


@dataclass(frozen=True)
class Model:
    """Facts with metrics, dimensions by owner table, the joins that reach other tables, and the key that metrics count."""

    metrics: dict[str, Metric]
    dimensions: dict[str, list[str]]
    relationships: list[Relationship]
    fact: str
    counted: str
    synonyms: dict[str, str] = field(default_factory=dict)

    def name(self, word: str) -> str:
        return self.synonyms.get(word.lower(), word)

    def owner(self, dimension: str) -> str:
        for table in [self.fact, *[t for t in self.dimensions if t != self.fact]]:
            if dimension in self.dimensions[table]:
                return table
        raise KeyError(f"unknown dimension {dimension}")

    def query(self, tables: dict[str, DataFrame], metrics: list[str], by: list[str | tuple[str, Column]] = (),
              where: Column | None = None) -> DataFrame:
        """``by`` holds dimension names, or ``(name, expression)`` for a derived one."""
        rows = tables[self.fact]
        if where is not None:
            rows = rows.filter(where)
        dims = [d if isinstance(d, tuple) else (self.name(d), None) for d in by]
        for table in sorted({self.owner(n) for n, e in dims if e is None} - {self.fact}):
            rel = next((r for r in self.relationships if r.right_table == table), None)
            if rel is None:
                raise KeyError(f"no relationship leads to {table}")
            wanted = [n for n, e in dims if e is None and self.owner(n) == table]
            side = tables[table].select(col(rel.right_column).alias("_k"), *[col(n) for n in wanted])
            rows = rows.join(side, col(rel.left_column) == F.col("_k"), rel.how).drop("_k")
        columns = [(col(n) if e is None else e).alias(n) for n, e in dims]
        chosen = {self.name(m): self.metrics[self.name(m)] for m in metrics}
        key = [col(self.counted).alias(KEY)] if any(m.keyed for m in chosen.values()) else []
        parts = {"_rows": F.count(F.lit(1))}
        for m in chosen.values():
            parts |= m.parts()
        per = rows.groupBy(*columns, *key).agg(*[c.alias(n) for n, c in parts.items()])
        return per.groupBy(*[col(n) for n, _ in dims]).agg(*[m.value().alias(n) for n, m in chosen.items()])


def words_of(lines: str) -> dict[str, str]:
    """``NAME: word, word`` lines as {word: NAME}."""
    return {word.strip(): name.strip() for name, words in (line.split(":") for line in lines.strip().splitlines()) for word in words.split(",")}


def _ended() -> Column:
    return col("X_POLICY_TERMINATION_DT").isNotNull()


# Metric, dimension and relationship names of the insurance model.
EXPOSURES = Model(
    fact="LIFE_UNIT_OF_EXPOSURE",
    counted="POLICY_RK",
    metrics={
        "TOTAL_PREMIUM": Metric(lambda: {"_premium": F.sum("ANNUAL_PREMIUM_AMT")}, lambda: F.sum("_premium")),
        "TOTAL_CASH_VALUE": Metric(lambda: {"_cash": F.sum("CASH_VALUE")}, lambda: F.sum("_cash")),
        "NUM_POLICIES": Metric(dict, lambda: F.count(KEY), keyed=True),
        "AVG_PREMIUM": Metric(lambda: {"_premium": F.sum("ANNUAL_PREMIUM_AMT"), "_priced": F.count("ANNUAL_PREMIUM_AMT")},
                              lambda: F.sum("_premium") / F.nullif(F.sum("_priced"), F.lit(0))),
        "NUM_EXPOSURES": Metric(dict, lambda: F.coalesce(F.sum("_rows"), F.lit(0))),
        "TERMINATED_POLICIES": Metric(lambda: {"_ended": F.max(_ended())}, lambda: F.count(F.when(F.col("_ended"), F.col(KEY))), keyed=True),
        "LOST_PREMIUM": Metric(lambda: {"_lost": F.sum(F.when(_ended(), col("ANNUAL_PREMIUM_AMT")).otherwise(0))}, lambda: F.sum("_lost")),
    },
    dimensions={
        "LIFE_UNIT_OF_EXPOSURE": ("UOE_RK POLICY_RK X_POLICY_PROPOSAL_RK X_POLICY_VERSION X_ORDER_CD COVERAGE_RIDER_RK "
                                  "X_POLICY_STATUS_CD RENEWABLE_IND X_ORDER_STATUS LOB_RK VALID_FROM_DTTM X_ADMISSION_DT "
                                  "EFFECTIVE_DT EXPIRATION_DT X_ORDER_STATUS_DT X_POLICY_TERMINATION_DT "
                                  "CHANGE_EFFECTIVE_FROM_DTTM CHANGE_EFFECTIVE_TO_DTTM VALID_TO_DTTM PROCESSED_DTTM").split(),
        "INSURANCE_POLICY": ("POLICY_NO X_POLICY_NO_EXT ORIGINAL_POLICY_NO X_SEQ_NO X_PRODUCT_CATEGORY_CD POLICY_VERSION "
                             "POLICY_STATUS_CD STATUS_DT STATUS_REASON_CD EFFECTIVE_FROM_DTTM EFFECTIVE_TO_DTTM").split(),
        "COVERAGE": "COVERAGE_RK COVERAGE_CD X_COVERAGE_SHORT_DESC COVERAGE_TYPE_CD COVERAGE_DESC".split(),
    },
    relationships=[Relationship("COVERAGE_RIDER_RK", "COVERAGE", "COVERAGE_RK", "inner"),
                   Relationship("POLICY_RK", "INSURANCE_POLICY", "POLICY_RK", "left")],
    synonyms=words_of("""
        POLICY_RK: policy key, policy identifier
        X_POLICY_STATUS_CD: policy status, status, estado da apolice
        RENEWABLE_IND: renewable, renovavel
        LOB_RK: line of business, ramo
        X_ADMISSION_DT: admission date, issue date, data de admissao
        EFFECTIVE_DT: effective date, start date, data de inicio
        EXPIRATION_DT: expiration date, end date, data de vencimento
        X_POLICY_TERMINATION_DT: termination date, cancellation date, data de cancelamento
        TOTAL_PREMIUM: total premium, prima total
        TOTAL_CASH_VALUE: total cash value, valor total
        NUM_POLICIES: policy count, numero de apolices
        AVG_PREMIUM: average premium, prima media
        NUM_EXPOSURES: exposure count, numero de exposicoes
        TERMINATED_POLICIES: cancelled policies, apolices canceladas
        LOST_PREMIUM: lost premium, prima perdida
        POLICY_NO: policy number, numero da apolice
        X_PRODUCT_CATEGORY_CD: product category, categoria de produto
        POLICY_STATUS_CD: estado
        STATUS_REASON_CD: status reason, motivo
        COVERAGE_CD: coverage code, codigo de cobertura
        X_COVERAGE_SHORT_DESC: coverage name, nome da cobertura
        COVERAGE_TYPE_CD: coverage type, tipo de cobertura"""),
)


def premium_by_status(tables: dict[str, DataFrame]) -> DataFrame:
    return EXPOSURES.query(tables, ["NUM_POLICIES", "TOTAL_PREMIUM"], ["X_POLICY_STATUS_CD"])


def monthly_evolution(tables: dict[str, DataFrame]) -> DataFrame:
    out = EXPOSURES.query(tables, ["NUM_POLICIES", "TOTAL_PREMIUM"], [("MONTH", F.trunc("EFFECTIVE_DT", "MM"))],
                          where=col("EFFECTIVE_DT").isNotNull())
    return out.withColumnsRenamed({"NUM_POLICIES": "NEW_POLICIES", "TOTAL_PREMIUM": "PREMIUM"}).orderBy("MONTH")


def premium_by_status_coverage(tables: dict[str, DataFrame]) -> DataFrame:
    out = EXPOSURES.query(tables, ["NUM_EXPOSURES", "TOTAL_PREMIUM", "TOTAL_CASH_VALUE"],
                          ["X_POLICY_STATUS_CD", "COVERAGE_TYPE_CD"])
    return out.withColumnRenamed("NUM_EXPOSURES", "EXPOSURE_COUNT")


def terminated_policies(tables: dict[str, DataFrame]) -> DataFrame:
    out = EXPOSURES.query(tables, ["NUM_POLICIES", "TOTAL_PREMIUM"], where=_ended())
    return out.withColumnsRenamed({"NUM_POLICIES": "TERMINATED_POLICIES", "TOTAL_PREMIUM": "LOST_PREMIUM"})


def avg_premium_renewable(tables: dict[str, DataFrame]) -> DataFrame:
    return EXPOSURES.query(tables, ["NUM_POLICIES", "AVG_PREMIUM"], ["RENEWABLE_IND"])
