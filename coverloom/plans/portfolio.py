"""Portfolio questions over the loaded exposure table. Columns of the table are upper case."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverloom.functions.exprs import col, is_open, percent
from coverloom.operators.aggregates import share_of_total
from coverloom.operators.joins import with_stats

# Upper band edges (inclusive) and labels.
BANDS = [(0, "0 - Sem premio"), (1_000_000, "1 - Ate 10K"), (5_000_000, "2 - 10K-50K"),
         (10_000_000, "3 - 50K-100K"), (50_000_000, "4 - 100K-500K"), (100_000_000, "5 - 500K-1M")]
TOP_BAND = "6 - >1M"


def premium(name: str = "ANNUAL_PREMIUM_AMT") -> Column:
    """Amounts are summed as double so that wide decimals cannot overflow."""
    return col(name).cast("double")


def ended() -> Column:
    return col("X_POLICY_TERMINATION_DT").isNotNull()


def scope(table: DataFrame, current_only: bool = False) -> DataFrame:
    """All versions by default; ``current_only`` keeps the open ones."""
    return table.filter(is_open("VALID_TO_DTTM")) if current_only else table


def per_policy(rows: DataFrame, *by: Column, **sums: Column) -> DataFrame:
    """One row per ``by`` and policy with sums and ``_ended``, whether any row is ended.

    Two distinct counts at once would make Spark expand every row; counting these rows needs none.
    """
    return rows.groupBy(*by, "POLICY_RK").agg(*[c.alias(n) for n, c in sums.items()], F.max(ended()).alias("_ended"))


def kpis(table: DataFrame, current_only: bool = False) -> DataFrame:
    per = per_policy(scope(table, current_only), _rows=F.count(F.lit(1)), _premium=F.sum(premium()), _priced=F.count("ANNUAL_PREMIUM_AMT"),
                     _cash=F.sum(premium("CASH_VALUE")))
    policies, terminated = F.count("POLICY_RK"), F.count(F.when(F.col("_ended"), col("POLICY_RK")))
    return per.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("TOTAL_EXPOSURES"), policies.alias("TOTAL_POLICIES"),
        F.sum("_premium").alias("TOTAL_PREMIUM"), (F.sum("_premium") / F.nullif(F.sum("_priced"), F.lit(0))).alias("AVG_PREMIUM"),
        F.sum("_cash").alias("TOTAL_CASH_VALUE"), terminated.alias("TERMINATED_POLICIES"),
        percent(terminated, policies).alias("LAPSE_RATE_PCT"))


def band(amount: Column, bands: list[tuple[float, str]] = BANDS, top: str = TOP_BAND) -> Column:
    out = None
    for edge, label in bands:
        out = F.when(amount <= edge, label) if out is None else out.when(amount <= edge, label)
    return out.otherwise(top)


def premium_bands(table: DataFrame, bands: list[tuple[float, str]] = BANDS, top: str = TOP_BAND,
                  current_only: bool = False) -> DataFrame:
    rows = scope(table, current_only).filter(col("ANNUAL_PREMIUM_AMT").isNotNull())
    return (rows.groupBy(band(col("ANNUAL_PREMIUM_AMT"), bands, top).alias("PREMIUM_BAND"))
            .agg(F.count_distinct("POLICY_RK").alias("NUM_POLICIES"), F.sum(premium()).alias("TOTAL_PREMIUM"))
            .orderBy("PREMIUM_BAND"))


def monthly_trend(table: DataFrame, start: str, end: str, current_only: bool = False) -> DataFrame:
    """Months from ``start`` up to, without, ``end``."""
    day = col("EFFECTIVE_DT")
    rows = scope(table, current_only).filter((day >= F.lit(start).cast("date")) & (day < F.lit(end).cast("date")))
    per = per_policy(rows, F.trunc("EFFECTIVE_DT", "MM").alias("MONTH"), _premium=F.sum(premium()))
    return (per.groupBy("MONTH").agg(F.count("POLICY_RK").alias("NEW_POLICIES"), F.sum("_premium").alias("PREMIUM"),
                                     F.count(F.when(F.col("_ended"), col("POLICY_RK"))).alias("TERMINATED"))
            .orderBy("MONTH"))


def concentration(table: DataFrame, coverage: DataFrame, current_only: bool = False) -> DataFrame:
    """Premium per coverage and its share of the total."""
    dim = coverage.select(col("COVERAGE_RK").alias("COVERAGE_RIDER_RK"), "COVERAGE_TYPE_CD",
                          col("X_COVERAGE_SHORT_DESC").alias("COVERAGE_NAME"))
    rows = scope(table, current_only).join(dim, "COVERAGE_RIDER_RK")
    per = rows.groupBy("COVERAGE_TYPE_CD", "COVERAGE_NAME").agg(
        F.count_distinct("POLICY_RK").alias("NUM_POLICIES"), F.sum(premium()).alias("TOTAL_PREMIUM"),
        F.sum(premium("CASH_VALUE")).alias("TOTAL_CASH_VALUE"), F.avg(premium()).alias("AVG_PREMIUM"))
    return share_of_total(per, "TOTAL_PREMIUM").orderBy(col("TOTAL_PREMIUM").desc_nulls_first(), "COVERAGE_TYPE_CD", "COVERAGE_NAME")


def concentration_alert(shares: DataFrame, threshold: float = 50.0) -> DataFrame:
    """The leading coverage when its share exceeds the threshold."""
    return shares.orderBy(col("TOTAL_PREMIUM").desc_nulls_first()).limit(1).filter(col("PCT") > threshold)


def outliers(table: DataFrame, sigmas: float = 4, top: int = 50, current_only: bool = False) -> DataFrame:
    """Highest premiums beyond mean + sigmas deviations of the positive premiums."""
    rows = scope(table, current_only)
    stats = rows.filter(col("ANNUAL_PREMIUM_AMT") > 0).agg(
        F.avg(premium()).alias("_avg"), F.stddev_samp(premium()).alias("_std"))
    far = with_stats(rows, stats).filter(premium() > F.col("_avg") + sigmas * F.col("_std"))
    z = F.round((premium() - F.col("_avg")) / F.nullif(F.col("_std"), F.lit(0.0)), 2)
    return far.select("POLICY_RK", col("X_POLICY_STATUS_CD").alias("STATUS"), premium().alias("PREMIUM"),
                      premium("CASH_VALUE").alias("CASH_VALUE"), "EFFECTIVE_DT",
                      col("X_POLICY_TERMINATION_DT").alias("TERMINATION_DT"), z.alias("Z_SCORE")
                      ).orderBy(col("PREMIUM").desc(), "POLICY_RK", "EFFECTIVE_DT", "CASH_VALUE").limit(top)


def leaders(outliers_: DataFrame, n: int = 10) -> DataFrame:
    """First rows of the outlier report, in its order."""
    return (outliers_.orderBy(col("PREMIUM").desc(), "POLICY_RK", "EFFECTIVE_DT", "CASH_VALUE").limit(n)
            .select("POLICY_RK", "STATUS", "PREMIUM", "Z_SCORE"))


def terminations_by_year(table: DataFrame, first: int, last: int, current_only: bool = False) -> DataFrame:
    day = col("X_POLICY_TERMINATION_DT")
    # A date range instead of a test on year(): it reaches the scan.
    rows = scope(table, current_only).filter(day.between(F.lit(f"{first}-01-01").cast("date"), F.lit(f"{last}-12-31").cast("date")))
    return (rows.groupBy(F.year(day).alias("TERMINATION_YEAR"))
            .agg(F.count_distinct("POLICY_RK").alias("TERMINATED_POLICIES"), F.sum(premium()).alias("LOST_PREMIUM"))
            .orderBy("TERMINATION_YEAR"))


def status_distribution(table: DataFrame, current_only: bool = False) -> DataFrame:
    return (scope(table, current_only).groupBy(col("X_POLICY_STATUS_CD").alias("STATUS_CODE"))
            .agg(F.count_distinct("POLICY_RK").alias("NUM_POLICIES"), F.sum(premium()).alias("TOTAL_PREMIUM"))
            .orderBy(col("NUM_POLICIES").desc(), "STATUS_CODE"))
