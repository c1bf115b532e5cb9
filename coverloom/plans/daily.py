"""The daily run: stages in order, each stored once and read back by the next."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coverloom.functions import schemas as S
from coverloom.functions.exprs import SAS, is_open
from coverloom.plans import exposure, quality, receipts, scd2, splitter
from coverloom.session import scratch_scope
from coverloom.sources import extracts, tables
from coverloom.sources.keyed import KeyTable
from coverloom.sources.tables import run_name
from coverloom.streaming import ingest

#: Partition column of the transactions history: the run that loaded the rows.
LOADED_IN = "LOADED_IN"
_HISTORY = T.StructType([*S.TRANSACTIONS.fields, T.StructField(LOADED_IN, T.StringType())])


@dataclass(frozen=True)
class Dimensions:
    """Lookup tables, all with VALID_FROM_DTTM and VALID_TO_DTTM."""

    policy: DataFrame
    proposal: DataFrame
    coverage: DataFrame
    category: DataFrame
    employee: DataFrame
    structure: DataFrame


def _store(df: DataFrame, path: str) -> DataFrame:
    tables.replace(df, path)
    return tables.read(df.sparkSession, path, df.schema)


def run_transactions(x: dict[str, DataFrame], dims: Dimensions, out: str, run_ts: str,
                     missing: str = SAS, hot_rows: int | None = None) -> None:
    """Transactions path. Closed rows go to the history, in a folder of this run; the next run skips their receipts.

    A run repeated with its ``run_ts`` replaces its folder. What is loaded is looked up in a key-only table beside the history.
    """
    spark = x["RECIBO"].sparkSession
    history, keys, this_run = f"{out}/X_LIFE_POLICY_TRANS_HIST", loaded_keys(out), run_name(run_ts)
    loaded = _loaded_before(spark, history, keys, this_run)
    with scratch_scope(spark):
        states = _store(receipts.stage_states(x["RECIBO"], x["MOPEC1"], x["EVENTO"], x["MOVIML"], x["APOL00"], loaded,
                                              missing=missing, hot_rows=hot_rows), f"{out}/stage/receipt_states")
        staffed = _store(receipts.stage_staffed(states, x["RECI0X"], x["ENTVIN"], x["ENTREL"], x["APOLPA"], x["RECPRO"],
                                                hot_rows=hot_rows), f"{out}/stage/staffed_states")
        final = _store(receipts.stage_final(staffed, x["RECREL"], x["APOL00"], hot_rows=hot_rows), f"{out}/stage/final_states")
    # Each half reads and resolves only its own rows: the open/closed filter reaches the scan.
    rows = splitter.resolve(final, dims.employee, dims.structure, dims.policy, run_ts)
    tables.replace(splitter.current(rows), f"{out}/LIFE_POLICY_TRANS")
    # Last, so that a run that failed before can be repeated.
    tables.replace(S.shape(splitter.closed(rows), S.TRANSACTIONS), f"{history}/{LOADED_IN}={this_run}")
    _add_keys(spark, history, keys, F.lit(this_run))


def loaded_keys(out: str) -> KeyTable:
    """Receipts of the history and the run that loaded each, bucketed by receipt."""
    return KeyTable(f"{out}/X_LIFE_POLICY_TRANS_KEYS", f"{receipts.ID} string, {LOADED_IN} string", receipts.ID)


def _add_keys(spark: SparkSession, history: str, keys: KeyTable, runs: Column) -> None:
    keys.add(tables.read(spark, history, _HISTORY).filter(F.col(LOADED_IN) == runs).select(receipts.ID, LOADED_IN).distinct())


def _loaded_before(spark: SparkSession, history: str, keys: KeyTable, this_run: str) -> DataFrame | None:
    """Keys of all other runs; None before the first. Keys of a run that stopped before it stored them are added from the history."""
    if not tables.exists(spark, history):
        return None
    runs = lambda df: {r[0] for r in df.select(LOADED_IN).distinct().collect()}  # noqa: E731  one per run
    for run in sorted(runs(tables.read(spark, history, _HISTORY)) - runs(keys.read(spark)) - {this_run}):
        _add_keys(spark, history, keys, F.lit(run))
    return keys.read(spark).filter(F.col(LOADED_IN) != this_run)


def run_exposures(x: dict[str, DataFrame], changed: DataFrame, group: DataFrame, policy_versions: DataFrame,
                  dims: Dimensions, out: str, run_ts: str, missing: str = SAS, hot_rows: int | None = None, stepwise: bool = False) -> None:
    """Exposure path, then the type-2 table: rebuilt, or taken a step further (``stepwise``).

    A step compares the open rows of the rebuilt images with the table's open rows by digest and leaves its closed history alone; without a
    table it creates one.
    """
    with scratch_scope(x["APOL00"].sparkSession):
        covers = _store(exposure.stage_coverages(x["APOL00"], x["ACTA00"], x["APOL03"], x["ACTA03"], missing=missing),
                        f"{out}/stage/coverages")
        images = _store(exposure.stage_images(x["APOL00"], x["APOL03"], covers, changed, group, policy_versions,
                                              missing=missing, hot_rows=hot_rows), f"{out}/stage/images")
        loaded = _store(scd2.full_load(images, dims.policy, dims.proposal, dims.coverage, dims.category, run_ts, dedup=False, hot_rows=hot_rows),
                        f"{out}/stage/exposures")
        removed = _store(scd2.pk_removed(loaded), f"{out}/LIFE_UNIT_OF_EXPOSURE_REMOVED")
        spark, path = loaded.sparkSession, f"{out}/LIFE_UNIT_OF_EXPOSURE"
        if stepwise:
            table = _store(scd2.pk_dedup(loaded), f"{out}/stage/exposures_kept")
            if tables.exists(spark, path):
                scd2.step(path, table.filter(is_open("VALID_TO_DTTM")), run_ts)
            else:
                scd2.create(table, path, run_ts)
        else:
            table = _store(scd2.pk_dedup(loaded), path)
    log = tables.monitor_row(spark, "DEDUP", "COMPLETE", scd2.dedup_audit(table, removed), run_ts)
    tables.append_once(log, f"{out}/PIPELINE_MONITOR_LOG", S.MONITOR_LOG, "CHECK_TYPE", run_ts)


def check_quality(spark: SparkSession, out: str, lapsed: Column, run_ts: str) -> None:
    """Alerts about the loaded exposures, appended to the alert table; none where nothing is found."""
    table = tables.read(spark, f"{out}/LIFE_UNIT_OF_EXPOSURE", S.EXPOSURE)
    alerts = quality.anomaly_alert(table, run_ts).unionByName(quality.lapse_alert(table, lapsed, run_ts))
    tables.append_once(alerts, f"{out}/DATA_QUALITY_ALERTS", S.ALERTS, "ALERT_TYPE", run_ts)


def finish(spark: SparkSession, out: str, run_ts: str) -> None:
    """Completion marker with the output counts."""
    marker = quality.run_summary(tables.read(spark, f"{out}/LIFE_UNIT_OF_EXPOSURE"),
                                 tables.read(spark, f"{out}/LIFE_POLICY_TRANS"), run_ts)
    tables.append_once(marker, f"{out}/PIPELINE_MONITOR_LOG", S.MONITOR_LOG, "CHECK_TYPE", run_ts)


def run(spark: SparkSession, landing: str, changed: DataFrame, group: DataFrame, policy_versions: DataFrame, dims: Dimensions, out: str, run_ts: str,
        lapsed: Column, missing: str = SAS, hot_rows: int | None = None, multi_line: bool = True, new_files: bool = False, stepwise: bool = False) -> None:
    """One day from ``landing/<TABLE>/`` to the tables: extracts, both paths side by side, alerts, completion marker.

    All files of the landing folders are loaded, or (``new_files``) those that no earlier run has taken, as deliveries that replace the extract; one
    without new files stays as it is. The marker comes last, so it stands only for a run that was completed; a failed run is repeated
    as a whole, with the same ``run_ts``.
    """
    if new_files:
        ingest.ingest_all(spark, landing, f"{out}/extracts", f"{out}/checkpoints", run_ts, multi_line)
        x = {t: ingest.present(spark, f"{out}/extracts", t) for t in S.EXTRACTS}
    else:
        extracts.load_all(spark, landing, f"{out}/extracts", run_ts, multi_line)
        x = {t: tables.read(spark, f"{out}/extracts/{t}") for t in S.EXTRACTS}
    extracts.at_same_time([partial(run_transactions, x, dims, out, run_ts, missing, hot_rows),
                           partial(run_exposures, x, changed, group, policy_versions, dims, out, run_ts, missing, hot_rows, stepwise)])
    check_quality(spark, out, lapsed, run_ts)
    finish(spark, out, run_ts)
