"""Physical plan shape checks (the scale-relevant properties)."""

from skyroute.plans import catalog
from skyroute.sources.tables import lookup, publish
from skyroute.plans import fixture as fx
from skyroute.plans import questions as q
from tests.conftest import SF_SMALL
from tests.explain_util import explain




def test_top_k_by_group_limits_before_shuffle(spark):
    text = explain(catalog.top_carriers_by_origin(spark, SF_SMALL))
    limits = [ln for ln in text.splitlines() if "WindowGroupLimit" in ln]
    assert any("Partial" in ln for ln in limits) or len(limits) >= 2, limits
    assert "NestedLoopJoin" not in text


def test_global_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in explain(catalog.top_airports(spark, SF_SMALL))


def test_two_leg_join_on_both_keys(spark):
    df = catalog.two_leg_best(spark, SF_SMALL)
    text = explain(df)
    join_lines = [ln for ln in text.splitlines() if ln.startswith("Left keys") or ln.startswith("Right keys")]
    assert any("_y1" in ln and "flight_date1" in ln for ln in join_lines), join_lines
    assert any("_y2" in ln and "date_sub" in ln for ln in join_lines), join_lines
    # both sides of the join come from one exchange: the flights are reduced once
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_name_lookup_is_broadcast(spark):
    text = explain(catalog.top_airlines(spark, SF_SMALL))
    assert "BroadcastHashJoin LeftOuter" in text


def test_scan_prunes_columns_and_partitions(spark):
    text = explain(q.weekday_delay(fx.flights(spark, SF_SMALL), 2000))
    schema = [ln for ln in text.splitlines() if ln.startswith("ReadSchema")]
    assert schema and all("origin" not in ln and "airline_id" not in ln for ln in schema), schema
    assert any("arr_delay" in ln for ln in schema)
    parts = [ln for ln in text.splitlines() if ln.startswith("PartitionFilters")]
    assert any("year" in ln and "2000" in ln for ln in parts), parts
    assert "PushedFilters" in text


def test_point_lookup_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "carriersbyairport")
    publish(q.top_carriers_by_origin(fx.flights(spark, SF_SMALL)), path, "origin")
    text = explain(lookup(spark, path, origin="NATION_7"))
    assert "PartitionFilters: [isnotnull(origin" in text and "NATION_7" in text


def test_line_items_are_shuffled_once_for_the_join_with_orders(spark, tmp_path):
    """One file for many cores: its rows are dealt by the order, so the join that follows does not send them again."""
    day = "to_date('2000-03-01') + cast(id % 9 as int)"
    made = {"lineitem": ["id % 40 l_orderkey", "id l_partkey", "id % 3 l_suppkey", "id % 7 l_linenumber",
                         "cast(id % 50 as double) l_quantity", f"{day} l_shipdate"],
            "orders": ["id o_orderkey", "id % 10 o_custkey"], "customer": ["id c_custkey", "id % 25 c_nationkey"],
            "nation": ["id n_nationkey", "concat('N', id) n_name"]}
    for name, columns in made.items():
        spark.range(25 if name == "nation" else 200).selectExpr(*columns).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = fx.raw_flights(spark, str(tmp_path))
        text = explain(df)
        assert "RoundRobin" not in text and text.count("hashpartitioning(l_orderkey") == 1
        assert df.count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
