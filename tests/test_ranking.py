import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from skyroute.operators.aggregate import popularity
from skyroute.operators.ranking import number_rows, rank_with_ties, top_k, top_k_by
from tests.conftest import rows

# Our own counts shaped like the tail of a real popularity table: a tie pair
# that shares rank 341 then continues at 343, and a four-way tie at the end.
TAIL = [("A01", 90), ("A02", 80), ("A03", 80), ("A04", 70), ("A05", 12), ("A06", 12),
        ("A07", 11), ("A08", 3), ("A09", 3), ("A10", 3), ("A11", 3)]
EXPECTED_RANKS = [1, 2, 2, 4, 5, 5, 7, 8, 8, 8, 8]


def test_rank_with_ties_golden(spark):
    df = spark.createDataFrame(TAIL, "airport string, count long")
    got = rows(rank_with_ties(df, "count"), "airport", "rank")
    assert [r for _, r in got] == EXPECTED_RANKS


def test_rank_with_ties_matches_window_rank(spark):
    rnd = random.Random(7)
    data = [(f"k{i}", rnd.choice([0, 1, 2, 3, 5, 8, 13, 1000, 10**6, 10**9 + 7, rnd.randint(0, 10**7)]))
            for i in range(3000)]
    df = spark.createDataFrame(data, "k string, n long")
    ours = rows(rank_with_ties(df, "n"), "k", "n", "rank")
    ref = rows(df.withColumn("rank", F.rank().over(Window.orderBy(F.desc("n")))), "k", "n", "rank")
    assert ours == ref
    asc = rows(rank_with_ties(df, "n", descending=False), "k", "rank")
    ref_asc = rows(df.withColumn("rank", F.rank().over(Window.orderBy("n"))), "k", "rank")
    assert asc == ref_asc


def test_popularity_counts_both_columns(spark):
    df = spark.createDataFrame([("ORD", "LAX"), ("ORD", "JFK"), ("LAX", "ORD")], "origin string, dest string")
    assert rows(popularity(df)) == [("JFK", 1), ("LAX", 2), ("ORD", 3)]


def test_top_k_ties_break_on_key(spark):
    df = spark.createDataFrame([("B", 5), ("A", 5), ("C", 7), ("D", 1)], "airport string, count long")
    got = rows(top_k(df, [("count", "desc"), "airport"], 3))
    assert got == [("A", 5, 2), ("B", 5, 3), ("C", 7, 1)]


def test_top_k_by_group(spark):
    data = [("X", c, float(d)) for c, d in [(1, 3), (2, 1), (3, 1), (4, 0)]] + [("Y", 9, 2.0)]
    df = spark.createDataFrame(data, "origin string, carrier long, delay double")
    got = rows(top_k_by(df, "origin", ["delay", "carrier"], 2), "origin", "carrier", "rank")
    assert got == [("X", 2, 2), ("X", 4, 1), ("Y", 9, 1)]


def test_rank_with_ties_negative_and_fractional(spark):
    rnd = random.Random(9)
    data = [(f"k{i}", rnd.choice([-1e6, -3.5, -1.0, -0.5, 0.0, 0.25, 1.0, 7.75, None,
                                  float(rnd.randint(-1000, 1000))])) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, v double")
    for desc in (True, False):
        ours = rows(rank_with_ties(df, "v", descending=desc), "k", "rank")
        order = F.col("v").desc_nulls_last() if desc else F.col("v").asc_nulls_last()
        ref = rows(df.withColumn("rank", F.rank().over(Window.orderBy(order))), "k", "rank")
        assert ours == ref


def test_rank_with_ties_in_sparks_order(spark):
    nan, inf = float("nan"), float("inf")
    data = [(f"k{i}", v) for i, v in enumerate([-3.0, 1.0, inf, nan, None, -inf, 0.0, -0.0, nan, None, 1.0])]
    df = spark.createDataFrame(data, "k string, v double")
    for desc in (True, False):
        order = F.col("v").desc_nulls_last() if desc else F.col("v").asc_nulls_last()
        ref = rows(df.withColumn("rank", F.rank().over(Window.orderBy(order))), "k", "rank")
        assert rows(rank_with_ties(df, "v", descending=desc), "k", "rank") == ref
    asc = dict(rows(rank_with_ties(df.where("k < 'k5' and k <> 'k10'"), "v", descending=False), "k", "rank"))
    assert asc == {"k0": 1, "k1": 2, "k2": 3, "k3": 4, "k4": 5}


def test_ranks_of_crowded_values_are_spread_over_tasks(spark):
    """A million distinct means between 5 and 6: range partitions by depth, not by magnitude."""
    from skyroute.operators.ranking import _in_order
    df = spark.range(1_000_000).select((5 + F.col("id") / 1_000_000).alias("v"))
    stored, part = _in_order(df, [F.col("v").asc_nulls_last()], None)
    sizes = [r["count"] for r in stored.groupBy(part.alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 1_000_000 / 8
    ranked = rank_with_ties(df, "v", descending=False)
    assert ranked.where("rank <> round((v - 5) * 1000000) + 1").isEmpty() and ranked.count() == 1_000_000


def test_row_numbers_of_a_total_order(spark):
    rnd = random.Random(3)
    data = [(i, rnd.choice([None, 1.0, 2.0, float("nan"), -4.0]), rnd.choice("ab")) for i in range(2000)]
    df = spark.createDataFrame(data, "id long, v double, s string").repartition(5)
    order = [F.col("v").desc_nulls_last(), F.col("s"), F.col("id")]
    ref = df.withColumn("row_number", F.row_number().over(Window.orderBy(*order)))
    assert rows(number_rows(df, order), "id", "s", "row_number") == rows(ref, "id", "s", "row_number")
    assert number_rows(df.limit(0), ["id"]).collect() == []
