"""Data-quality checks, alerts, run summary and reconciliation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coverloom.functions.exprs import col, is_open, percent, text
from coverloom.operators.aggregates import column_profile, count_where, difference_by_digest
from coverloom.operators.joins import with_stats
from coverloom.sources.tables import alert_row, monitor_row

# Columns that legitimately differ between two runs.
UNCOMPARED = ("PROCESSED_DTTM", "VALID_FROM_DTTM", "UOE_RK", "VALID_TO_DTTM")


def premium_anomalies(table: DataFrame, sigmas: float = 3) -> DataFrame:
    """Current rows above mean + sigmas deviations; the statistics cover all rows."""
    amount = col("ANNUAL_PREMIUM_AMT").cast("double")
    stats = table.agg((F.avg(amount) + sigmas * F.stddev_samp(amount)).alias("_limit"))
    far = with_stats(table.filter(is_open("VALID_TO_DTTM")), stats).filter(amount > F.col("_limit"))
    return far.agg(F.count(F.lit(1)).alias("ANOMALIES"))


def anomaly_alert(table: DataFrame, run_ts: str, sigmas: float = 3) -> DataFrame:
    found = premium_anomalies(table, sigmas).filter(col("ANOMALIES") > 0)
    message = F.concat(text("ANOMALIES"), F.lit(" registos com premios anomalos detectados no portfolio"))
    return alert_row(found, "PREMIUM_ANOMALY", "ANOMALIES", message, run_ts)


def lapse_rate(table: DataFrame, lapsed: Column) -> DataFrame:
    """Share of lapsed rows among the current ones, in percent."""
    return table.filter(is_open("VALID_TO_DTTM")).agg(
        percent(count_where(lapsed), F.count(F.lit(1))).alias("LAPSE_RATE"))


def lapse_alert(table: DataFrame, lapsed: Column, run_ts: str, threshold: float = 5.0) -> DataFrame:
    found = lapse_rate(table, lapsed).filter(col("LAPSE_RATE") > threshold)
    message = F.concat(F.lit("taxa de cancelamento "), text(F.round("LAPSE_RATE", 2)),
                       F.lit(f"%, acima do limiar de {threshold:g}%"))
    return alert_row(found, "PERSISTENCY_ALERT", "LAPSE_RATE", message, run_ts)


def run_summary(exposures: DataFrame, transactions: DataFrame, run_ts: str) -> DataFrame:
    counts = with_stats(exposures.agg(F.count(F.lit(1)).alias("uoe_rows")),
                        transactions.agg(F.count(F.lit(1)).alias("lpt_rows")))
    details = counts.select(F.lit(run_ts).alias("completed_at"), "uoe_rows", "lpt_rows")
    return monitor_row(exposures.sparkSession, "PIPELINE_RUN", "COMPLETE", details, run_ts)


@dataclass(frozen=True)
class Reconciliation:
    missing_columns: list[str]
    extra_columns: list[str]
    columns: DataFrame
    totals: DataFrame
    distribution: DataFrame
    profile: DataFrame
    differences: DataFrame


def totals(df: DataFrame, keys: list[str], amounts: list[str]) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.count_distinct(F.struct(*[col(k) for k in keys])).alias("distinct_keys"),
                  *[F.sum(a).alias(f"sum_{a}") for a in amounts])


def compared(df: DataFrame, excluded: tuple[str, ...] = UNCOMPARED) -> DataFrame:
    """Without the excluded columns; a validity end counts as open or closed only."""
    if "VALID_TO_DTTM" in df.columns and "VALID_TO_DTTM" in excluded:
        df = df.withColumn("IS_OPEN", is_open("VALID_TO_DTTM"))
    return df.drop(*excluded)


def column_sets(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(column_name, found_in): every column of either side, and whether both have it."""
    names = {c: "ours" for c in ours.columns} | {c: "both" if c in ours.columns else "theirs" for c in theirs.columns}
    return ours.sparkSession.createDataFrame(sorted(names.items()), "column_name string, found_in string")


def reconcile(ours: DataFrame, theirs: DataFrame, keys: list[str], amounts: list[str], status: str,
              excluded: tuple[str, ...] = UNCOMPARED) -> Reconciliation:
    """Column sets, counts, sums, status distribution, column profile, and the differing rows."""
    shared = [c for c in ours.columns if c in theirs.columns]
    a, b = compared(ours.select(*shared), excluded), compared(theirs.select(*shared), excluded)
    side = lambda f: f(a).withColumn("side", F.lit("ours")).unionByName(f(b).withColumn("side", F.lit("theirs")))
    return Reconciliation(
        missing_columns=sorted(set(theirs.columns) - set(ours.columns)),
        extra_columns=sorted(set(ours.columns) - set(theirs.columns)),
        columns=column_sets(ours, theirs),
        totals=side(lambda df: totals(df, keys, amounts)),
        distribution=side(lambda df: df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))),
        profile=side(column_profile),
        differences=difference_by_digest(a, b))
