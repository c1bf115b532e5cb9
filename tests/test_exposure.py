from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from coverloom.catalog import exposure_queries as XQ
from coverloom.catalog.star import RUN_TS
from coverloom.functions import schemas as S
from coverloom.functions.exprs import text, triple
from coverloom.operators.aggregates import difference
from coverloom.plans import exposure as E
from coverloom.plans import scd2
from coverloom.session import materialise
from coverloom.sources import tables

OPEN = datetime(5999, 1, 1)


def ymd(prefix, stem, d):
    return {f"{prefix}A{stem}": d.year, f"{prefix}M{stem}": d.month, f"{prefix}D{stem}": d.day}


def test_amendment_fallbacks(frame):
    cover = lambda napo, nord, cmp: {"A3$MOD": 1, "A3NAPO": napo, "A3NORD": nord, "A3$CMP": cmp}
    apol03 = frame(S.EXTRACTS["APOL03"], cover(1, 1, 1), cover(1, 1, 2), cover(1, 2, 1), cover(2, 1, 1), cover(1, 1, 80), {"A3$MOD": 8, "A3NAPO": 1, "A3NORD": 1, "A3$CMP": 1})
    acta03 = frame(S.EXTRACTS["ACTA03"], dict(cover(1, 1, 1), A3ACTA=3), dict(cover(1, 1, 1), A3ACTA=2), dict(cover(1, 1, 99), A3ACTA=5))
    acta00 = frame(S.EXTRACTS["ACTA00"], {"A0$MOD": 1, "A0NAPO": 1, "A0ACTA": 7})
    assert rows(E.cover_rows(apol03, acta03, acta00), "NAPO", "NORD", "CMP", "ACTA") == [(1, 1, 1, 3), (1, 1, 2, 5), (1, 2, 1, 7), (2, 1, 1, 0)]


def test_union_needs_no_branch_for_matched_coverages(star):
    """Adding the coverages with an own amendment once more leaves the distinct union unchanged."""
    apol03, acta03, acta00 = star.stored("apol03"), star.acta03(), star.stored("acta00")
    own = acta03.filter((F.col("A3$CMP") < 80) & (F.col("A3$MOD") != 8)).groupBy(*[F.col(f"`{c}`") for c in E.COVER]).agg(F.max("A3ACTA").alias("ACTA"))
    matched = apol03.join(own, E.COVER).select(
        F.col("A3$MOD").alias("MOD"), F.col("A3NAPO").alias("NAPO"), F.col("A3$CMP").alias("CMP"), F.col("A3NORD").alias("NORD"), "ACTA", F.col("A3PREM").alias("PREM"),
        F.col("A3CAPT").alias("CAPT"), triple("A3", "INI").alias("ADMISSION_DT"), F.col("A3SITU").alias("SITU"), triple("A3", "SIT").alias("SIT_DT"))
    covers, bases = E.cover_rows(apol03, acta03, acta00), E.base_rows(acta00)
    assert matched.count() > 0
    assert difference(E.cover_union(covers, bases), E.cover_union(covers.unionByName(matched), bases)).count() == 0


def test_base_rows_missing_flag(frame):
    acta00 = frame(S.EXTRACTS["ACTA00"], *[{"A0$MOD": 1, "A0$APL": n, "A0NAPO": n, "A0ACTA": 1, "A0INF4": f} for n, f in [(1, None), (2, "S"), (3, "N")]],
                   {"A0$MOD": 1, "A0$APL": 0, "A0NAPO": 4, "A0ACTA": 1, "A0INF4": "N"})
    assert [r[0] for r in rows(E.base_rows(acta00, "sas"), "NAPO")] == [1, 3]
    assert [r[0] for r in rows(E.base_rows(acta00, "sql"), "NAPO")] == [3]


def image(version, **kw):
    return {"POLICY_NO": "0100000001", "PROPOSAL_NO": "0100000001", "POLICY_VERSION": version, "X_COVERAGE_CD": "0", "X_ORDER_CD": "0", **kw}


def images(frame, *given):
    df = frame(S.CHANGED_IMAGES, *given)
    return df.withColumns({"ADMISSION_DT": F.col("EFFECTIVE_DT"), "CHANGE_EFFECTIVE_TO_DTTM": F.lit(None).cast("timestamp_ntz")})


def test_versions_take_the_values_of_the_next(frame):
    day = lambda n: datetime(2020, n, 1)
    data = images(frame, *[image(v, ANNUAL_PREMIUM_AMT=100 + v, POLICY_STATUS_CD=str(v), RENEWABLE_IND="V", EFFECTIVE_DT=date(2020, v + 1, 5), CHANGE_EFFECTIVE_FROM_DTTM=day(v + 1))
                           for v in (0, 1, 2)])
    out = E.chain_intervals(E.shift_versions(data))
    got = [tuple(r) for r in out.orderBy("POLICY_VERSION").select("ANNUAL_PREMIUM_AMT", "POLICY_STATUS_CD", "RENEWABLE_IND", "EFFECTIVE_DT", "CHANGE_EFFECTIVE_FROM_DTTM",
                                                                  "CHANGE_EFFECTIVE_TO_DTTM").collect()]
    assert got == [(Decimal("101.00"), "1", "V", date(2020, 2, 5), None, day(2)), (Decimal("102.00"), "2", "V", date(2020, 3, 5), day(2), day(3)),
                   (None, "", "", None, day(3), OPEN)]


def test_group_policies_keep_their_effective_date(frame):
    data = images(frame, *[dict(image(v, EFFECTIVE_DT=date(2020, v + 1, 5)), POLICY_NO="0800000001") for v in (0, 1)])
    assert [r[0] for r in rows(E.shift_versions(data), "EFFECTIVE_DT")] == [date(2020, 1, 5), date(2020, 2, 5)]


def test_single_version_is_emptied_and_open(frame):
    out = E.chain_intervals(E.shift_versions(images(frame, image(0, ANNUAL_PREMIUM_AMT=5, CHANGE_EFFECTIVE_FROM_DTTM=datetime(2020, 1, 1)))))
    r = out.first()
    assert r["ANNUAL_PREMIUM_AMT"] is None and r["CHANGE_EFFECTIVE_FROM_DTTM"] is None and r["CHANGE_EFFECTIVE_TO_DTTM"] == OPEN


def chained(frame, *given):
    df = images(frame, *given)
    return df.withColumn("CHANGE_EFFECTIVE_TO_DTTM", F.lit(OPEN).cast("timestamp_ntz"))


def test_fill_covers(frame):
    current = {"A3$MOD": 1, "A3NAPO": 1, "A3NORD": 0, "A3$CMP": 3, "A3PREM": 500, "A3CAPT": 700, "A3SITU": 1, "A3DURC": "T", **ymd("A3", "INI", date(2019, 1, 1))}
    data = chained(frame, dict(image(1, POLICY_STATUS_CD="", RENEWABLE_IND=""), X_COVERAGE_CD="3"), dict(image(1), X_COVERAGE_CD="4"), image(1))
    got = {r["X_COVERAGE_CD"]: r for r in E.fill_covers(data, frame(S.EXTRACTS["APOL03"], current)).collect()}
    assert sorted(got) == ["0", "3"]  # the open complementary coverage without amounts leaves
    assert (got["3"]["ANNUAL_PREMIUM_AMT"], got["3"]["CASH_VALUE"], got["3"]["POLICY_STATUS_CD"], got["3"]["EFFECTIVE_DT"]) == (Decimal("5.00"), Decimal("7.00"), "1", date(2019, 1, 1))
    assert got["3"]["RENEWABLE_IND"] == ""  # an empty text is not filled


def policy(situ=1, **kw):
    return {"A0$MOD": 1, "A0$APL": 1, "A0NAPO": 1, "A0ACTA": 0, "A0SITU": situ, "A0PRSC": 900, "A0CTOT": 800, **ymd("A0", "INI", date(2019, 5, 1)), **ymd("A0", "FIM", date(2024, 5, 1)),
            **ymd("A0", "SIT", date(2021, 3, 3)), **ymd("A0", "PMB", date(2019, 4, 1)), **kw}


def test_fill_base_and_dates(frame):
    apol = frame(S.EXTRACTS["APOL00"], policy())
    out = E.fill_change_from(E.fill_base(chained(frame, image(1)), apol), apol).first()
    assert (out["ANNUAL_PREMIUM_AMT"], out["CASH_VALUE"], out["POLICY_STATUS_CD"]) == (Decimal("9.00"), Decimal("8.00"), "1")
    assert out["CHANGE_EFFECTIVE_FROM_DTTM"] == datetime(2019, 4, 1) and out["TERMINATION_DT"] == date(2024, 5, 1)


def test_change_from_needs_both_dates(frame):
    broken = policy(situ=3, A0APMB=0, A0MPMB=0, A0DPMB=0)
    out = E.fill_change_from(chained(frame, image(1)), frame(S.EXTRACTS["APOL00"], broken)).first()
    assert out["CHANGE_EFFECTIVE_FROM_DTTM"] is None and out["TERMINATION_DT"] == date(2021, 3, 3)


def test_cancelled_policies_close_their_open_images(frame):
    data = chained(frame, image(1, POLICY_STATUS_CD="1"), image(2, POLICY_STATUS_CD="1")).withColumn(
        "CHANGE_EFFECTIVE_TO_DTTM", F.when(F.col("POLICY_VERSION") == 1, F.lit(datetime(2020, 1, 1)).cast("timestamp_ntz")).otherwise(F.col("CHANGE_EFFECTIVE_TO_DTTM")))
    closed = lambda situ: rows(E.close_cancelled(data, frame(S.EXTRACTS["APOL00"], policy(situ))), "POLICY_VERSION", "CHANGE_EFFECTIVE_TO_DTTM", "X_ORDER_STATUS", "X_ORDER_STATUS_DT")
    assert closed(3) == [(1, datetime(2020, 1, 1), "1", None), (2, datetime(2021, 3, 3), "3", date(2021, 3, 3))]
    assert closed(1) == [(1, datetime(2020, 1, 1), "1", None), (2, OPEN, "1", None)]


def test_small_hot_limit_changes_nothing(star):
    covers = E.stage_coverages(star.stored("order_policies"), star.stored("acta00"), star.stored("apol03"), star.acta03())
    args = (star.stored("order_policies"), star.stored("apol03"), covers, star.stored("changed_images"), star.group_images(), star.policy_versions())
    assert difference(E.stage_images(*args), E.stage_images(*args, hot_rows=4)).count() == 0


def test_validity_never_overlaps_and_one_row_is_open(star):
    table = XQ.loaded(star, dedup=False)
    order = ["VALID_FROM_DTTM", "VALID_TO_DTTM"]
    per = table.groupBy("UOE_RK").agg(F.sum(F.when(F.col("VALID_TO_DTTM") == F.lit(OPEN).cast("timestamp_ntz"), 1).otherwise(0)).alias("open"),
                                      F.sort_array(F.collect_list(F.struct(*order))).alias("spans"))
    assert per.filter(F.col("open") != 1).count() == 0
    gaps = F.filter(F.col("spans"), lambda s, i: (i > 0) & (s["VALID_FROM_DTTM"] < F.element_at(F.col("spans"), i)["VALID_TO_DTTM"]))
    assert per.filter(F.size(gaps) > 0).count() == 0
    ranks = table.agg(F.min("UOE_RK"), F.max("UOE_RK"), F.count_distinct("UOE_RK")).first()
    assert ranks[0] == 1 and ranks[1] == ranks[2]
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in S.EXPOSURE]


def test_pk_dedup_keeps_the_newest_change(frame):
    key = {"POLICY_RK": 1, "X_POLICY_PROPOSAL_RK": None, "X_ORDER_CD": "3", "COVERAGE_RIDER_RK": 2, "X_POLICY_VERSION": 1}
    table = frame(S.EXPOSURE, *[dict(key, CHANGE_EFFECTIVE_FROM_DTTM=datetime(2020, m, 1), UOE_RK=m) for m in (1, 2)], dict(key, X_POLICY_VERSION=2, UOE_RK=9))
    assert [r[0] for r in rows(scd2.pk_dedup(table), "UOE_RK")] == [2, 9]


def test_digest_changes_iff_a_digested_column_changes(star):
    table = star.exposures().limit(20)
    base = scd2.with_digest(table, scd2.SEPARATOR)
    moved = scd2.with_digest(table.withColumn("VALID_FROM_DTTM", F.lit(None).cast("timestamp_ntz")), scd2.SEPARATOR)
    changed = scd2.with_digest(table.withColumn("CASH_VALUE", F.col("CASH_VALUE") + 1), scd2.SEPARATOR)
    of = lambda df: sorted(r[0] for r in df.select("DIGEST_VALUE").collect())
    assert of(base) == of(moved)
    assert not set(of(base)) & set(of(changed))


def test_incremental_is_idempotent(star):
    old, new = XQ._order_table(star, False), XQ._order_table(star, True)
    once = scd2.incremental(old, new, RUN_TS)
    twice = scd2.incremental(once, new, "2026-08-01 00:00:00")
    assert difference(once, twice).count() == 0
    assert once.filter(text("UOE_RK").isNull()).count() == 0
    assert once.groupBy(*scd2.NATURAL_KEY).agg(F.count_distinct("UOE_RK").alias("n")).filter("n > 1").count() == 0


def test_stored_step_changes_nothing_the_second_time(star, tmp_path):
    path = str(tmp_path / "exposures")
    history = XQ._order_table(star, False).withColumn("VALID_TO_DTTM", F.lit("2020-01-01").cast("timestamp_ntz"))
    scd2.create(XQ._order_table(star, False).unionByName(history).withColumn("DIGEST_VALUE", F.lit("other separator")), path, "2026-06-01 00:00:00")
    files = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "exposures").rglob("*.parquet") if "CLOSED_IN=open" not in str(f)}
    oldest = files()
    new = XQ._order_table(star, True)
    scd2.step(path, new, RUN_TS)
    assert oldest.items() < files().items()  # closed history stays, rows closed now are added
    read = lambda: scd2.read(star.spark, path).drop(scd2.CLOSED_IN)
    tables.replace(read(), str(tmp_path / "once"))
    once = tables.read(star.spark, str(tmp_path / "once"))
    assert once.filter("VALID_TO_DTTM = TIMESTAMP_NTZ '2020-01-01'").count() == history.count()
    closed = files()
    scd2.step(path, new, "2026-08-01 00:00:00")
    assert difference(once, read()).count() == 0
    assert files() == closed and {p.name for p in (tmp_path / "exposures").iterdir() if p.is_dir()} == {"CLOSED_IN=20260601000000", "CLOSED_IN=20260701120000", "CLOSED_IN=open"}
    with pytest.raises(ValueError, match="incoming rows repeat"):
        scd2.step(path, new.unionByName(new), RUN_TS)
    assert difference(once, read()).count() == 0


def test_a_step_that_stopped_is_repeated(star, tmp_path, monkeypatch):
    """Stopped after the closed rows were stored, a repeated step leaves the same table as one that ran through."""
    new, whole, broken = XQ._order_table(star, True), str(tmp_path / "whole"), str(tmp_path / "broken")
    for path in (whole, broken):
        scd2.create(XQ._order_table(star, False), path, "2026-06-01 00:00:00")
    scd2.step(whole, new, RUN_TS)
    replace = tables.replace

    def stop(df, path, *partitions):
        if path.endswith("=open"):
            raise OSError("stopped")
        replace(df, path, *partitions)

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(tables, "replace", stop)
        scd2.step(broken, new, RUN_TS)
    scd2.step(broken, new, RUN_TS)
    assert difference(scd2.read(star.spark, whole), scd2.read(star.spark, broken)).count() == 0


def test_a_step_exchanges_each_side_once(star):
    olds, news = XQ._order_table(star, False), XQ._order_table(star, True)
    plan = scd2.stepped(materialise(olds, "olds"), materialise(news, "news"), RUN_TS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_removed_rows_are_the_rest(star):
    table = XQ.loaded(star, dedup=False)
    kept, removed = scd2.pk_dedup(table), scd2.pk_removed(table)
    audit = scd2.dedup_audit(kept, removed).first()
    assert audit["rows"] == kept.count() and audit["rows"] + audit["removed"] == table.count() and audit["removed"] >= audit["removed_without_coverage"] > 0


def test_a_step_stores_its_rows_once(star, tmp_path, monkeypatch):
    path, names = str(tmp_path / "exposures"), []
    monkeypatch.setattr(scd2, "materialise", lambda df, name: names.append(name) or materialise(df, name))
    scd2.create(XQ._order_table(star, False), path, "2026-06-01 00:00:00")
    assert names == []
    scd2.step(path, XQ._order_table(star, True), RUN_TS)
    assert names == ["stepped", "top"]


def test_loaded_images_leave_only_the_tables_that_are_read(star):
    from pathlib import Path

    from coverloom.session import scratch_dir

    stages = Path(scratch_dir(star.spark).removeprefix("file:")) / "coverloom-stages"
    there = lambda: {p.name for p in stages.iterdir()} if stages.exists() else set()
    before = there()
    rows_ = XQ.loaded(star, dedup=True)
    kinds = {n.replace("_", "-").rsplit("-", 1)[0] for n in there() - before}
    assert "resolved-images" in kinds and not kinds & {"apol00", "acta00", "apol03", "acta03", "coverages", "changed", "appended", "filled-images"}
    assert rows_.count() > 0
