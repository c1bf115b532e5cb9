from datetime import datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from coverloom.functions import schemas as S
from coverloom.operators.joins import absent
from coverloom.sources import extracts, tables
from coverloom.sources.keyed import KeyTable
from coverloom.streaming import ingest as ingest_module
from coverloom.streaming.ingest import ingest, present

SCHEMA = S.schema("A$ID:int NAME:string AMOUNT:decimal(14,0) CODE:string")
TS = "2026-07-01 12:00:00"
HEADER = "A$ID,NAME,AMOUNT,CODE\n"
BODY = [
    '1,"José, ""o"" é",100,AB',
    '2,"two\nlines",.,',       # line break inside quotes, missing number, missing text
    "3,.,7",                   # short row
    "4,x,8,CD,extra,more",     # long row
    "5,y,abc,EF",              # no number
    "6,z,**,GH",               # overflow mark
    "7,w,*******,IJ",
]


@pytest.fixture
def folder(tmp_path):
    place = tmp_path / "landing"
    place.mkdir()
    (place / "a.csv").write_bytes((HEADER + "\n".join(BODY) + "\n").encode("latin-1"))
    return place


def test_tolerant_load(spark, folder):
    parts = extracts.load(spark, "OTHER", str(folder), TS, SCHEMA)
    got = rows(parts.good.drop("PROCESSED_DTTM"))
    assert got == [(1, 'José, "o" é', Decimal(100), "AB"), (2, "two\nlines", None, None), (3, None, Decimal(7), None), (4, "x", Decimal(8), "CD")]
    bad = parts.rejected.orderBy("raw").collect()
    assert len(bad) == 3 and all(r["columns"] == ["AMOUNT"] and r["table_name"] == "OTHER" for r in bad)
    assert '"AMOUNT":"abc"' in bad[0]["raw"]


def test_columns_go_by_name(spark, tmp_path):
    place = tmp_path / "landing"
    place.mkdir()
    (place / "a.csv").write_bytes(b"EXTRA,code,AMOUNT,A$ID,NAME\n9,AB,100,1,x\n9,CD,7\n")
    (place / "b.csv").write_bytes(b"A$ID,NAME\n5,lost\n6,lost\n")
    (place / "c.csv").write_bytes(b"")
    (place / "_hidden.csv").write_bytes(b"no")
    parts = extracts.load(spark, "OTHER", str(place), TS, SCHEMA)
    assert rows(parts.good.drop("PROCESSED_DTTM")) == [(None, None, Decimal(7), "CD"), (1, "x", Decimal(100), "AB")]
    bad = parts.rejected.collect()
    assert len(bad) == 1 and bad[0]["columns"] == ["AMOUNT", "CODE"] and "b.csv" in bad[0]["raw"]


def test_many_files_of_several_layouts(spark, tmp_path, monkeypatch):
    """One scan for all layouts; the driver opens no file."""
    place = tmp_path / "landing"
    place.mkdir()
    orders = ["A$ID,NAME,AMOUNT,CODE", "code,amount,name,a$id", "x,NAME,y,CODE,A$ID,AMOUNT,z", "A$ID,NAME,AMOUNT"]
    for i in range(400):
        names = orders[i % 4].split(",")
        value = {"A$ID": i, "NAME": f"né{i}", "AMOUNT": i * 2, "CODE": "C"}
        line = ",".join(str(value.get(n.upper(), "q")) for n in names)
        (place / f"f{i}.csv").write_bytes((orders[i % 4] + "\r\n" + (line + "\r\n") * (i % 3)).encode("latin-1"))
    found = extracts.layouts(spark, str(place), SCHEMA)
    assert found.count() == 400 and found.select("at", "absent").distinct().count() == 4
    assert [r.at for r in found.filter("width = 7").limit(1).collect()] == [[5, 2, 6, 4]]
    parts = extracts.load(spark, "OTHER", str(place), TS, SCHEMA)
    want = sorted((i, f"né{i}", Decimal(2 * i), "C") for i in range(400) if i % 4 != 3 for _ in range(i % 3))
    assert sorted(map(tuple, parts.good.drop("PROCESSED_DTTM").collect())) == want
    assert parts.rejected.count() == 100 and {tuple(r["columns"]) for r in parts.rejected.collect()} == {("CODE",)}
    one = parts.good._jdf.queryExecution().executedPlan().toString()
    assert one.count("FileScan csv") == 1


def test_headers_of_one_layout_need_no_lookup(spark, folder):
    (folder / "b.csv").write_bytes((HEADER + "9,n,1,Z\n").encode("latin-1"))
    plan = extracts.load(spark, "OTHER", str(folder), TS, SCHEMA).good._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert extracts.load(spark, "OTHER", [str(folder / "b.csv")], TS, SCHEMA).good.count() == 1


def test_an_extract_is_swapped_in_whole(spark, folder, tmp_path, monkeypatch):
    good, rejected = str(tmp_path / "good"), str(tmp_path / "rejected")
    extracts.store(spark, "EVENTO", str(folder), good, rejected, TS, SCHEMA)
    assert tables.read(spark, good).count() == 4 and tables.read(spark, rejected).count() == 3
    (folder / "b.csv").write_bytes((HEADER + "9,n,1,Z\n").encode("latin-1"))
    monkeypatch.setattr(extracts, "parted", lambda judged, schema: extracts.Loaded(judged.select(F.raise_error(F.lit("lost")).cast("int").alias("A$ID")), judged.select("_failing")))
    with pytest.raises(Exception, match="lost"):
        extracts.store(spark, "EVENTO", str(folder), good, rejected, TS, SCHEMA)
    monkeypatch.undo()
    assert tables.read(spark, good).count() == 4
    extracts.store(spark, "EVENTO", str(folder), good, rejected, TS, SCHEMA)
    assert tables.read(spark, good).count() == 5


def test_key_tables_are_joined_where_they_lie(spark, tmp_path):
    loaded = KeyTable(str(tmp_path / "loaded"), "k string, run string", "k", 4)
    for run in ("a", "b"):
        loaded.add(spark.range(100).selectExpr("string(id) AS k", f"'{run}' AS run"))
    given = KeyTable(str(tmp_path / "given"), "k string, v long", "k", 4)
    given.add(spark.range(300).selectExpr("string(id) AS k", "id AS v"))
    both = absent(given.read(spark), loaded.read(spark), ["k"])
    one = absent(spark.range(300).selectExpr("string(id) AS k", "id AS v").repartition(3), loaded.read(spark), ["k"])
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(both.select("*")) and plan(one).count("Exchange hashpartitioning") == 1
        assert both.count() == one.count() == 200 and both.filter("v < 100").isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert KeyTable(str(tmp_path / "new"), "k string", "k", 4).read(spark).isEmpty()


def test_replace_may_read_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(spark.range(3), path)
    tables.replace(tables.read(spark, path).selectExpr("id + 1 AS id"), path)
    assert rows(tables.read(spark, path)) == [(1,), (2,), (3,)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_overflow_marks_are_missing_only_in_receipts(spark, folder):
    parts = extracts.load(spark, "RECIBO", str(folder), TS, SCHEMA)
    assert [r[0] for r in rows(parts.good, "A$ID")] == [1, 2, 3, 4, 6, 7]
    assert parts.rejected.count() == 1
    assert parts.good.filter(F.col("`A$ID`") > 5).agg(F.count("AMOUNT")).first()[0] == 0


def test_load_stamp(spark, folder):
    stamp = lambda t: extracts.load(spark, t, str(folder), TS, SCHEMA).good
    assert stamp("EVENTO").select("PROCESSED_DTTM").first()[0] == datetime(2026, 7, 1, 12)
    assert stamp("RECIBO").select("PROCESSED_DTTM").first()[0] is None
    assert "PROCESSED_DTTM" not in stamp("ACTA0P").columns


def test_load_all(spark, tmp_path):
    for name, schema in S.EXTRACTS.items():
        place = tmp_path / "in" / name
        place.mkdir(parents=True)
        text = ",".join(schema.fieldNames()) + "\n" + ",".join("1" for _ in schema) + "\n"
        (place / "f.csv").write_text(text)
    extracts.load_all(spark, str(tmp_path / "in"), str(tmp_path / "out"), TS)
    for name, schema in S.EXTRACTS.items():
        got = tables.read(spark, str(tmp_path / "out" / name))
        assert got.count() == 1 and got.columns[: len(schema)] == schema.fieldNames()
        assert [got.schema[f.name].dataType for f in schema] == [f.dataType for f in schema]


def test_ingest_takes_each_file_once(spark, folder, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    run = lambda: ingest(spark, "EVENTO", str(folder), out, checkpoint, TS, SCHEMA)
    run()
    first = spark.read.parquet(f"{out}/EVENTO")
    assert sorted(r[0] for r in first.select("`A$ID`").collect()) == [1, 2, 3, 4]
    assert spark.read.parquet(f"{out}/_rejected/EVENTO").count() == 3
    run()
    assert spark.read.parquet(f"{out}/EVENTO").count() == 4
    (folder / "b.csv").write_bytes((HEADER + "9,new,1,Z\n").encode("latin-1"))
    run()
    assert spark.read.parquet(f"{out}/EVENTO").count() == 5


def test_the_ledger_tells_the_present_extract(spark, folder, tmp_path, monkeypatch):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    run = lambda day, mode="replace": ingest(spark, "EVENTO", str(folder), out, checkpoint, f"2026-07-0{day} 02:00:00", SCHEMA, files_per_batch=1, mode=mode)
    ids = lambda: sorted(r[0] for r in present(spark, out, "EVENTO").select("`A$ID`").collect())
    run(1)
    assert ids() == [1, 2, 3, 4]
    run(2)  # no new file
    assert ids() == [1, 2, 3, 4]
    for n in (11, 12, 13):
        (folder / f"f{n}.csv").write_bytes((HEADER + f"{n},new,1,Z\n").encode("latin-1"))
    taken, store = [], extracts.store

    def stop(*args):
        if taken:
            raise OSError("stopped")
        taken.append(store(*args))

    monkeypatch.setattr(ingest_module, "store", stop)
    with pytest.raises(Exception, match="stopped"):
        run(3)
    monkeypatch.undo()
    assert ids() == [1, 2, 3, 4]  # one of three batches is stored, the delivery isn't complete
    run(3)
    assert ids() == [11, 12, 13]
    (folder / "more.csv").write_bytes((HEADER + "14,new,1,Z\n").encode("latin-1"))
    run(4, "append")
    assert ids() == [11, 12, 13, 14]
    (folder / "last.csv").write_bytes((HEADER + "15,new,1,Z\n").encode("latin-1"))
    run(5)
    assert ids() == [15] and spark.read.parquet(f"{out}/EVENTO").count() == 9


def test_a_run_logs_once(spark, tmp_path):
    path = str(tmp_path / "log")
    row = lambda kind, ts: tables.monitor_row(spark, kind, "OK", spark.sql("SELECT 1 AS n"), ts)
    for kind, ts in [("A", TS), ("A", TS), ("B", TS), ("A", "2026-07-02 12:00:00"), ("B", TS)]:
        tables.append_once(row(kind, ts), path, S.MONITOR_LOG, "CHECK_TYPE", ts)
    assert sorted((r.CHECK_TYPE, r.CREATED_AT.day) for r in tables.read(spark, path).collect()) == [("A", 1), ("A", 2), ("B", 1)]


def test_append_is_by_name(spark, tmp_path):
    contract, path = S.schema("a:int b:string c:date"), str(tmp_path / "t")
    tables.append(spark.sql("SELECT 'x' AS b, 1 AS a"), path, contract)
    tables.append(spark.sql("SELECT 2 AS a, 'y' AS b"), path, contract)
    assert rows(tables.read(spark, path)) == [(1, "x", None), (2, "y", None)]
    tables.replace(spark.sql("SELECT 3 AS a"), path)
    assert rows(tables.read(spark, path)) == [(3,)]


def test_log_and_alert_rows(spark):
    log = tables.monitor_row(spark, "CHECK", "OK", spark.sql("SELECT 1 AS n, 'a' AS t"), TS).first()
    assert log["DETAILS"] == '{"n":1,"t":"a"}' and log["CREATED_AT"] == datetime(2026, 7, 1, 12) and log["LOG_ID"]
    none = tables.alert_row(spark.sql("SELECT 1 AS n WHERE false"), "K", "n", F.lit("m"), TS)
    assert none.count() == 0 and none.columns == S.ALERTS.fieldNames()
