import pytest

from tests.oracle import difference
from turnwright.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", ["j8_best_overlap", "j9_first_overlap"])
def test_an_interval_without_length_overlaps_those_around_it(spark, tmp_path, name):
    # from, to, in hours: an interval around, one that ends where the item is, one that begins there, and an item with length
    rows = [(1, "view", 0, 5.0), (2, "view", 0, 2.0), (3, "view", 2, 4.0), (4, "purchase", 1, 3.0), (5, "click", 2, 0.0), (6, "error", 1, 1.0), (7, "click", 30, 0.0), (8, "view", 30, 0.0), (9, "purchase", 2, 0.0), (10, "error", 1, 2.5)]
    events = spark.createDataFrame([(k, 1, kind, f"2024-01-02 {at // 10}{at % 10}:00:00" if at < 24 else "2024-01-03 06:00:00", v) for k, kind, at, v in rows], "event_id long, user_id long, event_type string, ts string, value double")
    events.selectExpr("event_id", "user_id", "event_type", "cast(ts as timestamp_ntz) AS ts", "value", "'' AS props").coalesce(1).write.parquet(str(tmp_path / "events"))
    next((tmp_path / "events").glob("*.parquet")).rename(tmp_path / "events.parquet")
    assert difference(spark, _events(tmp_path), QUERIES[name], SQL[name], str(tmp_path)) is None
    got = {r.event_id: r.b_pos for r in QUERIES[name](spark, str(tmp_path)).collect()}
    assert got[5] == 1 and got[7] is None


def _events(path):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{path}/events.parquet'")
    return con


@pytest.fixture
def shop(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "c_custkey long, c_name string").write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame([(10, 1, "P"), (11, 2, "F")], "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


def test_anti_join_reads_all_orders(spark, shop):
    assert [tuple(r) for r in QUERIES["j19_anti_join"](spark, shop).collect()] == [(3, "c")]
    assert "o_orderstatus" not in SQL["j19_anti_join"]


def test_difference_reads_all_orders(spark, shop):
    assert [r.k for r in QUERIES["u5_difference"](spark, shop).collect()] == [3]
    assert "o_orderstatus" not in SQL["u5_difference"]
