from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from coverloom.catalog.portfolio_queries import _coverage, _reconciled, _tables
from coverloom.catalog.star import RUN_TS
from coverloom.functions import schemas as S
from coverloom.operators.aggregates import column_profile, difference, difference_by_digest
from coverloom.plans import daily, governance, metrics, portfolio, quality
from coverloom.session import materialise
from coverloom.sources import tables


def table(frame, *given):
    return frame(S.EXPOSURE, *given)


def test_empty_table(frame):
    empty = table(frame)
    k = portfolio.kpis(empty).first()
    assert k["TOTAL_EXPOSURES"] == 0 and k["LAPSE_RATE_PCT"] is None
    assert portfolio.outliers(empty).count() == 0 and quality.premium_anomalies(empty).first()[0] == 0
    assert quality.anomaly_alert(empty, RUN_TS).count() == 0 and quality.lapse_alert(empty, F.lit(True), RUN_TS).count() == 0


def test_constant_premium_has_no_outliers(frame):
    same = table(frame, *[{"POLICY_RK": i, "ANNUAL_PREMIUM_AMT": 5} for i in range(5)])
    assert portfolio.outliers(same).count() == 0


def test_one_extreme_value(frame):
    data = table(frame, *[{"POLICY_RK": i, "ANNUAL_PREMIUM_AMT": 10 + i % 3} for i in range(60)], {"POLICY_RK": 99, "ANNUAL_PREMIUM_AMT": 100000}, {"POLICY_RK": 98})
    assert [r["POLICY_RK"] for r in portfolio.outliers(data).collect()] == [99]


def test_bands_take_their_upper_edge(frame):
    data = table(frame, *[{"POLICY_RK": i, "ANNUAL_PREMIUM_AMT": v} for i, v in enumerate([-1, 0, 1, 1_000_000, 1_000_001, 100_000_000, 100_000_001, None])])
    got = {r["PREMIUM_BAND"]: r["NUM_POLICIES"] for r in portfolio.premium_bands(data).collect()}
    assert got == {"0 - Sem premio": 2, "1 - Ate 10K": 2, "2 - 10K-50K": 1, "5 - 500K-1M": 1, "6 - >1M": 1}


def test_year_filter_reaches_the_scan(star, tmp_path):
    path = str(tmp_path / "exposures")
    star.exposures().write.parquet(path)
    plan = portfolio.terminations_by_year(star.spark.read.parquet(path), 2015, 2026)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(X_POLICY_TERMINATION_DT,2015-01-01)" in plan
    assert "CASH_VALUE" not in plan.split("ReadSchema")[1]


def test_alert_thresholds(star):
    shares = portfolio.concentration(star.exposures(), _coverage(star))
    assert portfolio.concentration_alert(shares).count() == 0 and portfolio.concentration_alert(shares, 10).count() == 1
    lapsed = F.col("X_POLICY_STATUS_CD") == "R"
    alert = quality.lapse_alert(star.exposures(), lapsed, RUN_TS).first()
    assert alert["ALERT_TYPE"] == "PERSISTENCY_ALERT" and "acima do limiar de 5%" in alert["ALERT_MSG"]
    assert quality.lapse_alert(star.exposures(), lapsed, RUN_TS, threshold=99).count() == 0


def test_metric_layer_joins_only_what_is_asked(star):
    tables = _tables(star)
    plain = metrics.EXPOSURES.query(tables, ["policy count"], ["status"])
    assert "Join" not in plain._jdf.queryExecution().optimizedPlan().toString()
    left = metrics.EXPOSURES.query(tables, ["NUM_EXPOSURES"], ["POLICY_STATUS_CD"])
    assert left.agg(F.sum("NUM_EXPOSURES")).first()[0] == star.exposures().count()  # left join keeps all
    inner = metrics.EXPOSURES.query(tables, ["NUM_EXPOSURES"], ["coverage type"])
    assert inner.agg(F.sum("NUM_EXPOSURES")).first()[0] < star.exposures().count()
    with pytest.raises(KeyError):
        metrics.EXPOSURES.query(tables, ["NUM_EXPOSURES"], ["REGION_ID"])
    with pytest.raises(KeyError):
        metrics.EXPOSURES.query(tables, ["NUM_EXPOSURES"], ["NO_SUCH"])


def test_metrics_expand_no_rows(star, frame):
    tables = _tables(star)
    several = metrics.EXPOSURES.query(tables, ["NUM_POLICIES", "TERMINATED_POLICIES", "AVG_PREMIUM"], ["POLICY_RK", "status"])
    assert "Expand" not in several._jdf.queryExecution().optimizedPlan().toString() and several.columns[:2] == ["POLICY_RK", "X_POLICY_STATUS_CD"]
    given = {"LIFE_UNIT_OF_EXPOSURE": table(frame, {"POLICY_RK": 1, "ANNUAL_PREMIUM_AMT": 5}, {"POLICY_RK": 1, "X_POLICY_TERMINATION_DT": date(2020, 1, 1)},
                                            {"ANNUAL_PREMIUM_AMT": 4, "X_POLICY_TERMINATION_DT": date(2020, 1, 1)}, {"POLICY_RK": 2})}
    asked = ["NUM_POLICIES", "TERMINATED_POLICIES", "NUM_EXPOSURES", "TOTAL_PREMIUM", "AVG_PREMIUM", "LOST_PREMIUM"]
    assert tuple(map(float, metrics.EXPOSURES.query(given, asked).first())) == (2, 1, 4, 9, 4.5, 4)
    assert tuple(metrics.EXPOSURES.query(given, asked, where=F.lit(False)).first()) == (0, 0, 0, None, None, None)


def test_reconciliation(star):
    r = _reconciled(star)
    assert r.missing_columns == [] and r.extra_columns == []
    changed = star.exposures().filter((F.col("X_POLICY_STATUS_CD") == "A") & F.col("ANNUAL_PREMIUM_AMT").isNotNull())
    assert r.differences.filter("surplus > 0").agg(F.sum("surplus")).first()[0] <= changed.count()
    assert r.differences.filter("surplus > 0").count() > 0
    assert r.totals.select("row_count").distinct().count() == 1
    same = quality.reconcile(star.exposures(), star.exposures(), ["POLICY_RK"], ["CASH_VALUE"], "X_POLICY_STATUS_CD")
    assert same.differences.count() == 0
    assert {c for r in same.profile.collect() for c in [r["column_name"]]} >= {"IS_OPEN", "POLICY_RK"}


def test_equal_tables_exchange_digests_only(star, spark):
    table = materialise(star.exposures(), "exposures")
    plain = lambda a, b: sorted(map(str, difference(a, b).collect()))
    assert difference_by_digest(table, table.repartition(3)).count() == 0
    other = table.filter("POLICY_RK % 50 <> 0").unionByName(table.filter("POLICY_RK % 50 = 7")).withColumn("CASH_VALUE", F.when(F.col("POLICY_RK") % 50 == 9, F.lit(None)).otherwise(F.col("CASH_VALUE")))
    for buckets in (1, 7, 1 << 16):
        assert sorted(map(str, difference_by_digest(table, other, buckets).collect())) == plain(table, other)
    odd = spark.sql("SELECT * FROM VALUES (0.0D, 'a'), (-0.0D, 'a'), (double('nan'), null), (null, null) AS t(x, y)")
    assert difference_by_digest(odd, odd.withColumn("x", -F.col("x"))).count() == 0
    assert difference_by_digest(odd.limit(0), odd).agg(F.sum("surplus")).first()[0] == -4


def test_profile_of_all_columns(star):
    table = star.exposures()
    rows_ = table.collect()
    got = {r.column_name: r for r in column_profile(table, width=5).collect()}
    assert set(got) == set(table.columns)
    for c in table.columns:
        values = [r[c] for r in rows_]
        given = {v for v in values if v is not None}
        assert (got[c].row_count, got[c].non_null, got[c].distinct_values) == (len(values), sum(v is not None for v in values), len(given)), c
    empty = column_profile(table.limit(0))
    assert {(r.row_count, r.distinct_values) for r in empty.collect()} == {(0, 0)} and empty.count() == len(table.columns)


def test_masking(spark):
    df = spark.createDataFrame([(1, "Ana", "x"), (2, None, "y")], "id int, name string, other string")
    masked = governance.mask_columns(df, {"name": "NAME"}, "ANALYST")
    assert rows(masked) == [(1, governance.MASK, "x"), (2, governance.MASK, "y")]
    assert rows(governance.mask_columns(df, {"name": "NAME"}, "DATA_ENGINEER")) == rows(df)
    with pytest.raises(ValueError):
        governance.mask_columns(df, {"name": "SHOE_SIZE"}, "ANALYST")
    with pytest.raises(ValueError, match="only text"):
        governance.mask_columns(df.withColumn("n", F.lit(1)), {"n": "NAME"}, "ANALYST")


def test_every_synonym_names_a_part_of_the_model():
    model = metrics.EXPOSURES
    known = {*model.metrics, *(d for names in model.dimensions.values() for d in names)}
    assert set(model.synonyms.values()) <= known and model.name("Apolices Canceladas") == "TERMINATED_POLICIES"


def test_exposure_run_and_completion_marker(star, tmp_path):
    out = str(tmp_path)
    x = {"APOL00": star.stored("order_policies"), "ACTA00": star.stored("acta00"), "APOL03": star.stored("apol03"), "ACTA03": star.acta03()}
    dims = daily.Dimensions(policy=star.policy_dimension(), proposal=star.proposal_dimension(), coverage=star.coverage_dimension(), category=star.category_dimension(),
                            employee=star.employees(), structure=star.structures())
    daily.run_exposures(x, star.stored("changed_images"), star.group_images(), star.policy_versions(), dims, out, RUN_TS)
    star.spark.range(3).write.parquet(f"{out}/LIFE_POLICY_TRANS")
    daily.check_quality(star.spark, out, F.col("X_POLICY_STATUS_CD") == "R", RUN_TS)
    daily.check_quality(star.spark, out, F.col("X_POLICY_STATUS_CD") == "R", RUN_TS)
    alerts = tables.read(star.spark, f"{out}/DATA_QUALITY_ALERTS")
    assert alerts.columns == S.ALERTS.fieldNames() and alerts.count() == alerts.select("ALERT_TYPE").distinct().count()  # a repeated run adds none
    daily.finish(star.spark, out, RUN_TS)
    log = star.spark.read.parquet(f"{out}/PIPELINE_MONITOR_LOG")
    marker = log.filter("CHECK_TYPE = 'PIPELINE_RUN'").first()
    removed = star.spark.read.parquet(f"{out}/LIFE_UNIT_OF_EXPOSURE_REMOVED").count()
    assert f'"removed":{removed},' in log.filter("CHECK_TYPE = 'DEDUP'").first()["DETAILS"]
    n = star.spark.read.parquet(f"{out}/LIFE_UNIT_OF_EXPOSURE").count()
    assert marker["STATUS"] == "COMPLETE" and f'"uoe_rows":{n},"lpt_rows":3' in marker["DETAILS"]


@pytest.mark.parametrize("new_files", [False, True])
def test_two_days_from_landing_to_tables(star, tmp_path, new_files):
    """The second day is run twice; with ``new_files`` it gets its extracts from the ledger and takes the exposures a step further."""
    spark, out, landing = star.spark, str(tmp_path / "out"), tmp_path / "landing"
    given = {"RECIBO": star.stored("recibo"), "MOPEC1": star.mopec1(), "EVENTO": star.stored("evento"), "MOVIML": star.moviml(), "APOL00": star.stored("order_policies"),
             "RECI0X": star.reci0x(), "ENTVIN": star.entvin(), "ENTREL": star.entrel(), "APOLPA": star.apolpa(), "RECPRO": star.recpro(), "RECREL": star.recrel(),
             "ACTA00": star.stored("acta00"), "APOL03": star.stored("apol03"), "ACTA03": star.acta03()}
    for name, schema in S.EXTRACTS.items():
        df = given.get(name, spark.createDataFrame([], schema))
        df.coalesce(1).write.options(header=True, encoding="ISO-8859-1", escape='"').csv(f"{landing}/{name}")
        if name not in given:
            (landing / name / "empty.csv").write_text(",".join(schema.fieldNames()) + "\n")
    policy = star.policy_dimension().withColumns({"VALID_FROM_DTTM": F.lit("1990-01-01").cast("timestamp_ntz"), "X_BSN_STRUCTURE_RK": F.lit(7).cast("long")})
    dims = daily.Dimensions(policy=policy, proposal=star.proposal_dimension(), coverage=star.coverage_dimension(), category=star.category_dimension(),
                            employee=star.employees(), structure=star.structures())
    counts = []
    for day in (RUN_TS, "2026-07-02 12:00:00", "2026-07-02 12:00:00"):
        daily.run(spark, str(landing), star.stored("changed_images"), star.group_images(), star.policy_versions(), dims, out, day,
                  F.col("X_POLICY_STATUS_CD") == "R", new_files=new_files, stepwise=new_files)
        counts.append({n: spark.read.parquet(f"{out}/{n}").count() for n in ("X_LIFE_POLICY_TRANS_HIST", "LIFE_POLICY_TRANS", "LIFE_UNIT_OF_EXPOSURE", "PIPELINE_MONITOR_LOG")})
    log, *later = [c.pop("PIPELINE_MONITOR_LOG") for c in counts]
    assert counts[0] == counts[1] == counts[2] and min(counts[0].values()) > 0 and later == [2 * log, 2 * log]  # closed receipts are loaded once
    for name, df in given.items():
        assert spark.read.parquet(f"{out}/extracts/{name}").count() == df.count() and spark.read.parquet(f"{out}/extracts/_rejected/{name}").isEmpty()
    keys = daily.loaded_keys(out).read(spark)
    assert keys.select("POLICY_TRANS_ID").distinct().count() == spark.read.parquet(f"{out}/X_LIFE_POLICY_TRANS_HIST").select("POLICY_TRANS_ID").distinct().count()
