"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The jobs of the daily run are timed one by one over stored inputs, as the published numbers are;
the other entries are registered queries, run from the given tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

from coverloom import catalog
from coverloom.catalog.star import RUN_TS, Star
from coverloom.plans import exposure, receipts, scd2, splitter
from coverloom.session import get_spark, materialise, tune

QUERIES = ["kpis", "bands", "monthly", "concentration", "outliers", "by_year", "status_dist", "metric_layer", "dq_outlier", "reconcile",
           "column_profile", "row_explosion", "movement_seq", "override_merge", "version_shift", "global_dense_rank", "scd2_incremental",
           "dedup_latest", "exclude_in_subquery", "first_flag_zero"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = tune(get_spark("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"}))
    spark.sparkContext.setLogLevel("ERROR")
    t = Star(spark, sf_dir)
    times: dict[str, float] = {}
    rows: dict[str, int] = {}

    def job(name, build):
        start = time.time()
        out = materialise(build(), name)
        times[name] = round(time.time() - start, 3)
        rows[name] = out.count()
        print(f"{name}: {times[name]} s, {rows[name]} rows", file=sys.stderr, flush=True)
        return out

    def query(name):
        start = time.time()
        catalog.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"{name}: {times[name]} s", file=sys.stderr, flush=True)

    query("kpis")  # warm-up, timed again below
    for name in "recibo mopec1 evento moviml reci0x apolpa recpro recrel order_policies acta00 apol03 acta03 changed_images group_images".split():
        t.stored(name)
    states = job("lpt_001", lambda: receipts.stage_states(
        t.stored("recibo"), t.stored("mopec1"), t.stored("evento"), t.stored("moviml"), t.customer_policies()))
    staffed = job("lpt_002", lambda: receipts.stage_staffed(
        states, t.stored("reci0x"), t.entvin(), t.entrel(), t.stored("apolpa"), t.stored("recpro")))
    final = job("lpt_003", lambda: receipts.stage_final(staffed, t.stored("recrel"), t.customer_policies(), with_mod=False))
    resolved = splitter.resolve(final, t.employees(), t.structures(), t.customer_dimension(), RUN_TS)
    job("load_lpt_history", lambda: splitter.closed(resolved))
    job("load_lpt_current", lambda: splitter.current(resolved))
    covers = job("uoe_003", lambda: exposure.stage_coverages(t.stored("order_policies"), t.stored("acta00"), t.stored("apol03"), t.stored("acta03")))
    images = job("uoe_005", lambda: exposure.stage_images(
        t.stored("order_policies"), t.stored("apol03"), covers, t.stored("changed_images"), t.stored("group_images"), t.policy_versions()))
    job("load_uoe", lambda: scd2.full_load(images, t.policy_dimension(), t.proposal_dimension(), t.coverage_dimension(), t.category_dimension(), RUN_TS))
    for name in QUERIES:
        query(name)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "rows": rows, "sf": sf_dir}))


if __name__ == "__main__":
    main()
