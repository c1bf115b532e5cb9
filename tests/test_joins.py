import pytest
from pyspark.sql import functions as F

from coverloom.operators import joins as J
from coverloom.operators.aggregates import difference


@pytest.fixture(scope="module")
def left(spark):
    return spark.createDataFrame([(1, 2), (2, 2), (None, 2), (3, 1), (None, 1)], "id int, s int")


def ids(df):
    return sorted(((r["id"] is not None, r["id"]), r["s"]) for r in df.collect())


def test_drop_listed(left, spark):
    listed = spark.createDataFrame([(1,), (None,)], "x int")
    assert ids(J.drop_listed(left, F.col("s") == 2, "id", listed, "x")) == [((False, None), 1), ((False, None), 2), ((True, 2), 2), ((True, 3), 1)]


def test_drop_listed_null_aware(left, spark):
    with_null = spark.createDataFrame([(1,), (None,)], "x int")
    assert ids(J.drop_listed(left, F.col("s") == 2, "id", with_null, "x", True)) == [((False, None), 1), ((True, 3), 1)]
    no_null = spark.createDataFrame([(1,)], "x int")
    assert ids(J.drop_listed(left, F.col("s") == 2, "id", no_null, "x", True)) == [((False, None), 1), ((True, 2), 2), ((True, 3), 1)]
    nothing = spark.createDataFrame([], "x int")
    assert len(ids(J.drop_listed(left, F.col("s") == 2, "id", nothing, "x", True))) == 5


def test_drop_listed_is_an_anti_join(left, spark):
    plan = J.drop_listed(left, F.col("s") == 2, "id", left.select(F.col("id").alias("x")), "x")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan


def test_lookup_keeps_fan_out_and_unmatched(left, spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "k int, v string")
    out = J.lookup(left, dim, ["id"], ["k"], {"v": "v"}, only=F.col("s") == 2)
    assert sorted((r["id"] or 0, r["v"] or "") for r in out.collect()) == [(0, ""), (0, ""), (1, "a"), (1, "b"), (2, ""), (3, "")]


def test_flag_and_presence(left, spark):
    other = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert sorted((r["id"] or 0, r["f"]) for r in J.flagged(left, other, ["id"], ["k"], "f").collect()) == [
        (0, "0"), (0, "0"), (1, "1"), (2, "0"), (3, "0")]
    assert J.flagged(left, other, ["id"], ["k"], "f", distinct=False).count() == 6
    assert [r["id"] for r in J.present(left, other, ["id"], ["k"]).collect()] == [1]
    assert J.absent(left, other, ["id"], ["k"]).count() == 4


def test_dimension_versions(spark):
    dim = spark.sql("""SELECT * FROM VALUES ('a', 1, timestamp_ntz'2000-01-01', timestamp_ntz'2010-01-01'), ('a', 2, timestamp_ntz'2010-01-02', timestamp_ntz'5999-01-01'),
      ('b', 3, timestamp_ntz'2000-01-01', timestamp_ntz'2010-01-01'), ('c', 4, timestamp_ntz'2090-01-01', timestamp_ntz'5999-01-01')
      AS t(code, rk, VALID_FROM_DTTM, VALID_TO_DTTM)""")
    assert [r["rk"] for r in J.valid_now(dim, "2026-07-01 00:00:00").collect()] == [2]
    assert sorted(tuple(r) for r in J.latest_version(dim, "code", "rk").collect()) == [("a", 2), ("b", 3), ("c", 4)]


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows under one key, some under NULL, and single ones."""
    return spark.range(400).select(
        F.when(F.col("id") < 200, 1).when(F.col("id") < 230, F.lit(None)).otherwise(F.col("id")).cast("int").alias("k"), F.col("id").alias("v"))


@pytest.mark.parametrize("hot_rows", [10, 10**6])
def test_join_spread_equals_join(skewed, spark, hot_rows):
    small = spark.createDataFrame([(1, "a"), (1, "b"), (250, "c"), (None, "n")], "k int, t string")
    spread = J.join_spread(skewed, small, ["k"], hot_rows)
    assert ("_salt" in spread._jdf.queryExecution().optimizedPlan().toString()) == (hot_rows == 10)
    assert difference(spread.select("k", "v", "t"), skewed.join(small, "k").select("k", "v", "t")).count() == 0
    assert spread.count() == 401


@pytest.mark.parametrize("hot_rows", [10, 10**6])
def test_lookup_spread_equals_left_join(skewed, spark, hot_rows):
    few = spark.createDataFrame([(1, "a"), (9999, "b"), (None, "n")], "k int, t string")
    spread = J.lookup_spread(few, skewed, ["k"], ["v"], "S_", hot_rows)
    plain = few.join(skewed.withColumnRenamed("v", "S_v"), "k", "left")
    assert difference(spread.select("k", "t", "S_v"), plain.select("k", "t", "S_v")).count() == 0
    assert spread.count() == 202


def test_per_group_equals_the_plain_lookup_and_moves_narrow_rows_only(spark):
    from coverloom.session import clustered

    dim = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 9)], "code string, v int")
    add = lambda df: J.lookup(df, dim, ["code"], ["code"], {"v": "v"})
    for ids in (("x", "x", "y", "z"), ("x", None, None, "z")):
        df = spark.createDataFrame(list(zip(ids, ("a", "b", None, "c"), range(4), strict=True)), "id string, code string, wide int")
        stored, files = clustered(df, "wide-rows", "id")
        for source in (stored, files):
            got = J.per_group(source, source, "id", ["code"], add)
            assert sorted(map(str, got.select("id", "code", "wide", "v").collect())) == sorted(map(str, add(df).select("id", "code", "wide", "v").collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).selectExpr("cast(id % 20 as string) id", "'a' code", "cast(id as int) wide")
        stored, _ = clustered(df, "wide-rows", "id")
        plan = J.per_group(stored, stored, "id", ["code"], add)._jdf.queryExecution().executedPlan().toString()
        moved = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
        assert moved and all("wide#" not in line for line in moved)
        assert "hashpartitioning(id" not in "".join(moved)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_shuffle_partitions_follow_the_input(spark, tmp_path):
    from coverloom import session

    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        (tmp_path / "t").write_bytes(bytes(10))
        session.size_shuffles(spark, str(tmp_path / "t"), str(tmp_path / "none"))
        assert session.shuffle_partitions(spark) == 4
        with open(tmp_path / "t", "wb") as f:
            f.truncate(20 * session.INPUT_BYTES)
        session.size_shuffles(spark, str(tmp_path / "t"))
        assert session.shuffle_partitions(spark) == 20
    finally:
        spark.conf.unset(name)


def test_stored_rows_leave_no_shuffles_and_open_files_are_no_limit(spark):
    import time

    from coverloom import session

    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {x for x in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in x}
    before, former = files(), spark.conf.get(session.DROP_SHUFFLES)
    df = spark.range(1000).selectExpr("id % 200 id", "id v")
    stored = session.materialise(df.repartition(7, "id"), "shuffled")
    name, old = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    spark.conf.set(name, "40")
    try:
        table, plain = session.clustered(df.repartition(2), "many-buckets", "id", lying=True)  # 40 buckets in each task: more than it keeps open
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(session.DROP_SHUFFLES) == former and spark.conf.get(session.OPEN_FILES) == "0"
    for rows in (stored, table, plain):
        assert difference(rows, df).count() == 0
    assert table.groupBy("id").count().filter("count <> 5").count() == 0


def test_buckets_are_written_without_a_sort_by_their_key(spark):
    """Spark uses no order within a bucket of several files, and sorting by a text key took more time than the rest of the write."""
    from coverloom.session import clustered

    df = spark.range(500).select((F.col("id") % 50).cast("string").alias("k"), F.col("id").alias("n"))
    for lying in (False, True):
        table, files = clustered(df.repartition(2, "k"), "unsorted-rows", "k", lying=lying)
        name = next(t.name for t in spark.catalog.listTables() if t.name.startswith("unsorted_rows"))
        said = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        assert said["Bucket Columns"] == "[`k`]" and said.get("Sort Columns", "[]") == "[]"
        assert sorted(map(tuple, table.collect())) == sorted(map(tuple, files.collect())) == sorted(map(tuple, df.collect()))
        assert "Exchange" not in table.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
        spark.sql(f"DROP TABLE {name}")
