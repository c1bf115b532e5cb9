import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from coverloom.operators.aggregates import column_profile, difference, share_of_total
from coverloom.operators.ordered import NEVER, Asc, along, append_nodupkey, global_dense_rank, hot_groups, hot_limit, latest_per_key

ORDER = [Asc("d"), "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_orderkey", "l_linenumber", "l_discount", "l_tax"]


@pytest.fixture(scope="module")
def lines(star):
    """A third of the rows in one group, a third in the NULL group, the rest in small ones; some NULL order values."""
    g = F.when(F.col("l_orderkey") % 3 == 0, F.lit(None).cast("long")).when(F.col("l_orderkey") % 3 == 1, 1).otherwise(F.col("l_orderkey"))
    return star.lines.withColumn("g", g).withColumn("d", F.when(F.col("l_suppkey") != 3, F.col("d")))


@pytest.mark.parametrize("hot_rows", [7, 50, 900])
@pytest.mark.parametrize("nulls_first", [False, True])
def test_sliced_equals_plain(lines, hot_rows, nulls_first):
    order = [Asc("d", nulls_first), *ORDER[1:]]
    kw = dict(prev=("p", ["l_extendedprice", "d"]), next=("n", ["l_extendedprice"]), rank="r", earlier=("e", F.col("l_returnflag") == "R"),
              whole={"m": F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice"))})
    plain, sliced = along(lines, ["g"], order, hot_rows=NEVER, **kw), along(lines, ["g"], order, hot_rows=hot_rows, **kw)
    assert plain.columns == sliced.columns
    assert difference(plain, sliced).count() == 0
    assert sliced.count() == lines.count()


def test_sliced_plan_partitions_by_slice(lines):
    plan = along(lines, ["g"], ORDER, rank="r", hot_rows=50)._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in plan
    plain = along(lines, ["g"], ORDER, rank="r", hot_rows=10**9)._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" not in plain


def test_probe_with_fewer_order_columns(lines):
    full = along(lines, ["g"], ORDER, rank="r", hot_rows=NEVER)
    sliced = along(lines, ["g"], ORDER, rank="r", hot_rows=50, probe=lines.select("g", "d"))
    assert difference(full, sliced).count() == 0


def test_ungrouped_rank(lines):
    ranked = along(lines, [], ORDER, rank="r", hot_rows=300)
    n = lines.count()
    assert ranked.agg(F.min("r"), F.max("r"), F.count_distinct("r")).first() == (1, n, n)


def test_many_equal_positions_stay_in_one_slice(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), F.when(F.col("id") < 3000, 5).otherwise(F.col("id")).alias("o"))
    out = along(df, ["k"], ["o"], rank="r", hot_rows=100)
    assert out.agg(F.min("r"), F.max("r"), F.count_distinct("r")).first() == (1, 4000, 4000)
    assert out.filter(F.col("o") == 5).agg(F.min("r"), F.max("r")).first() == (1, 3000)


def test_hot_groups(lines):
    assert {r["g"] for r in hot_groups(lines, ["g"], 500).collect()} == {None, 1}
    assert hot_groups(lines, ["g"], 10**6) is None
    assert hot_limit(lines, ["g"], 10**6) == NEVER and hot_limit(lines, ["g"], 500) == 500


def test_suspects_of_the_sketch_are_counted_exactly(spark):
    """More keys than the sketch holds, a few frequent ones, some just at the limit; too many rows for the sketch are counted at once."""
    df = spark.range(300_000).select(F.when(F.col("id") < 60, "null").when(F.col("id") < 100, "at the limit").when(F.col("id") < 141, "above").when(
        F.col("id") < 30_000, "third").otherwise(F.col("id").cast("string")).alias("k")).select(F.nullif("k", F.lit("null")).alias("k"))
    assert {(r.k, r._size) for r in hot_groups(df, ["k"], 40).collect()} == {(None, 60), ("above", 41), ("third", 29_859)}
    assert {r.k for r in hot_groups(df, ["k"], 20).collect()} == {None, "at the limit", "above", "third"}  # 7 n / 65536 > 20: by key
    assert hot_groups(df, ["k"], 30_000) is None and hot_groups(df.limit(0), ["k"], 5) is None


def test_dense_rank_equals_builtin(lines):
    keys = ["g", "l_linenumber", "l_returnflag"]
    rows = lines.select(*keys)
    ours = global_dense_rank(rows, keys, "rk", hot_rows=100)
    w = Window.orderBy(*[F.col(k).asc_nulls_last() for k in keys])
    assert difference(ours, rows.withColumn("rk", F.dense_rank().over(w).cast("long"))).count() == 0


def test_latest_is_cut_before_the_shuffle(lines):
    out = latest_per_key(lines, ["g"], [F.col("d").desc(), F.col("l_partkey").asc()])
    assert out.count() == lines.select("g").distinct().count()
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_append_nodupkey(spark):
    a = spark.createDataFrame([(1, 10), (2, 5)], "k int, v int")
    b = spark.createDataFrame([(1, 20), (3, 1)], "k int, v int")
    assert sorted(append_nodupkey([a, b], ["k"], [F.col("v").desc()]).collect()) == [(1, 20), (2, 5), (3, 1)]


def test_difference_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    assert sorted(difference(a, b).collect()) == [(1, 1), (2, 1), (3, -1)]


def test_profile_and_share(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "b")], "n int, t string")
    assert sorted(column_profile(df).collect()) == [("n", 4, 3, 2), ("t", 4, 3, 2)]
    shares = share_of_total(spark.createDataFrame([("x", 1.0), ("y", 2.0)], "k string, v double"), "v")
    assert sorted(r["PCT"] for r in shares.collect()) == [33.3, 66.7]
    zero = share_of_total(spark.createDataFrame([("x", 0.0)], "k string, v double"), "v")
    assert zero.first()["PCT"] is None


def test_dense_rank_compares_no_key_with_cut_points(spark, monkeypatch):
    """The distinct keys are sorted in ranges; cutting them into slices compared each with up to 128 points, in interpreted code."""
    from coverloom.operators import ordered

    def never(*_):
        raise AssertionError("keys are compared with cut points")

    monkeypatch.setattr(ordered, "_with_slices", never)
    df = spark.range(40_000).select((F.col("id") % 997).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 83).alias("b"))
    ours = global_dense_rank(df, ["a", "b"], "rk", hot_rows=1000)
    w = Window.orderBy(F.col("a").asc_nulls_last(), F.col("b").asc_nulls_last())
    assert difference(ours, df.withColumn("rk", F.dense_rank().over(w).cast("long"))).count() == 0
    assert global_dense_rank(df.limit(0), ["a", "b"], "rk").count() == 0
