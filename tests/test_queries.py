"""Every registered query against its SQL twin, at the smallest scale factor."""

from types import SimpleNamespace

import pytest

import __spark_entry__ as contract
from quotelens import schemas
from quotelens.operators import drivers, rates, vehicles
from quotelens.sources import files
from verification import compare, mapping, registry, scratch

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with compare.duck(SF) as made:
        yield made


@pytest.mark.parametrize("name", registry.QUERIES)
def test_query(spark, connection, name):
    assert compare.compare(spark, connection, name, SF) is None


def test_contract(spark):
    own = set(registry.QUERIES)
    assert own <= set(contract.queries()) and own <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    report = contract.entry(spark)
    assert report.count() > 0 and {"State", "CompanyName", "AvgPremium", "BridgeRate"} <= set(report.columns)


class Conf(dict):
    set = dict.__setitem__


def test_shared_folder_is_taken_from_the_session():
    named = SimpleNamespace(conf=Conf({"spark.checkpoint.dir": "hdfs:///shared"}))
    assert scratch.scratch_root(named) == "hdfs:///shared"
    unnamed = SimpleNamespace(conf=Conf())
    assert scratch.scratch_root(unnamed) == unnamed.conf["spark.checkpoint.dir"]


def test_fixture_leaves_the_views_of_the_session(spark):
    spark.range(3).createOrReplaceTempView("orders")
    mapping.mapped_facts(spark, "/root/testdata/sf0.001", "rate")
    assert spark.table("orders").count() == 3


def test_stored_facts_are_written_as_they_are_asked_for(spark, monkeypatch):
    monkeypatch.setattr(scratch, "_facts", {})
    root = scratch.stored_facts(spark, SF, "rate")
    assert files.names(spark, root) == ["rate"]
    assert scratch.stored_facts(spark, SF, "rate", "car") == root and files.names(spark, root) == ["car", "rate"]
    assert scratch.stored_facts(spark, SF) == root and files.names(spark, root) == sorted(schemas.FACTS)


def test_vehicles_are_shuffled_once(spark):
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    held = {name: spark.conf.get(name) for name in off}
    try:
        for name, value in off.items():
            spark.conf.set(name, value)
        car = mapping.mapped_facts(spark, SF, "car")["car"]
        plan = vehicles.vehicle_totals(car)._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in held.items():
            spark.conf.set(name, value)
    # Lineitem, orders, customer and the join of the last two.
    assert plan.count("Exchange hashpartitioning") == 4


def test_orders_of_the_joins_give_the_same_rows(spark):
    keys = [(1, 5), (1, 5), (2, None), (3, 6), (None, 5)]
    spark.createDataFrame(keys, "o_orderkey long, o_custkey long").createOrReplaceTempView("join_o")
    spark.createDataFrame([(5,), (5,), (6,), (None,)], "c_custkey long").createOrReplaceTempView("join_c")
    spark.createDataFrame([(1, 7), (2, 8), (3, 9), (3, 9), (4, 1), (None, 2)], "l_orderkey long, n long").createOrReplaceTempView("join_l")

    def rows(joins):
        for table in mapping.SOURCE_TABLES:
            joins = joins.replace(f" {table} ", f" join_{table[0]} ").replace(f"({table} ", f"(join_{table[0]} ")
        return sorted(map(tuple, spark.sql(f"SELECT l_orderkey, n, o_custkey, c_custkey {joins}").collect()))

    assert mapping.JOINS in mapping.FACTS_SQL
    assert rows(mapping.JOINS) == rows(mapping.NARROW_FIRST) and len(rows(mapping.JOINS)) == 6


@pytest.mark.parametrize("many", [mapping.MANY_LINES, 10])
def test_facts_derived_with_less_carried_are_those_of_the_text(spark, tmp_path, monkeypatch, many):
    """Repeated rows, nulls and lines without an order, whether Spark or the fixture chooses the partitions."""
    monkeypatch.setattr(mapping, "MANY_LINES", many)
    lines = [
        (o, p, s, n, price, flag, status, 30.0 if n == 5 else 20.0)
        for o in (1, 2, 3, 4, 23, 99, None) for n, p, s, price, flag, status in (
            (1, 25, 200, 1234.56, "R", "F"), (1, 25, 200, 1234.56, "R", "F"), (2, None, None, None, None, None),
            (5, 40, 171, 99.99, "A", "O"), (7, 361, 343, 5000.0, "N", "O"), (None, 3, 9, 10.0, "A", "F"))
    ]
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string, l_linestatus string, l_quantity double"
    tables = {
        "lineitem": (lines, columns),
        "orders": ([(1, 50), (1, 50), (2, 51), (2, 54), (3, 52), (4, None), (23, 51), (None, 51)], "o_orderkey long, o_custkey long"),
        "customer": (
            [(50, 0, "A"), (50, 3, "B"), (51, None, None), (52, 2, "C"), (52, 2, "C"), (54, 4, "D"), (None, 1, "E")],
            "c_custkey long, c_nationkey int, c_mktsegment string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        spark.read.parquet(f"{tmp_path}/{name}.parquet").createOrReplaceTempView(f"written_{name}")
    text = mapping.FACTS_SQL
    for name in mapping.SOURCE_TABLES:
        text = text.replace(f"FROM {name} ", f"FROM written_{name} ").replace(f"JOIN {name} ", f"JOIN written_{name} ")
    for name, rows in mapping.mapped_facts(spark, str(tmp_path)).items():
        written = spark.sql(f"{text} SELECT * FROM fx_{name}")
        assert rows.schema == written.schema
        assert sorted(map(str, rows.collect())) == sorted(map(str, written.collect())) and rows.count() > 0, name


def test_drivers_are_shuffled_before_they_are_widened(spark):
    """Lines and orders by the order, orders and customers for their join; neither the distinct nor the totals shuffle again."""
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    held = {name: spark.conf.get(name) for name in off}
    try:
        for name, value in off.items():
            spark.conf.set(name, value)
        driver = mapping.mapped_facts(spark, SF, "driver")["driver"]
        plan = drivers.driver_totals(driver)._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in held.items():
            spark.conf.set(name, value)
    assert plan.count("Exchange hashpartitioning") == 4


def test_tasks_of_drivers_have_a_bound(spark, monkeypatch):
    """Adaptive execution leaves the partitions of a large table as the number of its lines asks for."""
    monkeypatch.setattr(mapping, "MANY_LINES", 1000)
    monkeypatch.setattr(mapping, "TASK_LINES", 500)
    driver = mapping.mapped_facts(spark, SF, "driver")["driver"]
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert driver.rdd.getNumPartitions() == lines // 500 > 8


def test_tasks_of_quotes_spread_by_policy_have_a_bound(spark, monkeypatch):
    """Beside vehicles, as the stored cube reads them; what a task sorts would spill, had adaptive execution gathered them."""
    plain = mapping.mapped_facts(spark, SF, "rate")["rate"]
    monkeypatch.setattr(mapping, "MANY_LINES", 1000)
    monkeypatch.setattr(mapping, "TASK_LINES", 500)
    spread = mapping.mapped_facts(spark, SF, "rate", "car", by_policy=True)["rate"]
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert spread.rdd.getNumPartitions() == lines // 500 > 8
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))


def test_a_query_of_the_monthly_cube_folds_nothing_for_the_store(spark, monkeypatch):
    monkeypatch.setattr(scratch, "_stores", {})
    assert scratch.cube_store(spark, SF, folded=False).snapshot().states == {}
    store = scratch.cube_store(spark, SF)
    assert store is scratch.cube_store(spark, SF, folded=False)
    snapshot = store.snapshot()
    assert {s: set(m) for s, m in snapshot.states.items()} == {s: set(m) for s, m in snapshot.monthly.items()} != {}


def test_a_store_of_earlier_months_is_folded_without_the_later_ones(spark, monkeypatch):
    monkeypatch.setattr(scratch, "_stores", {})
    earlier = "YYYYMM < 202503"
    alone = scratch.folded_months(spark, SF, earlier)
    store = scratch.cube_store(spark, SF, folded=False)
    assert store.snapshot().states == {} and alone.count() > 0
    assert {m for months in scratch._folded[store.root, earlier].values() for m in months} == {"202501", "202502"}
    merged = registry.QUERIES["merge_folded"](spark, SF).collect()
    assert store.snapshot().states == {}
    whole = scratch.cube_store(spark, SF).states().where(earlier)
    assert sorted(map(str, alone.collect())) == sorted(map(str, whole.collect()))
    assert sorted(map(str, scratch.folded_months(spark, SF, earlier).collect())) == sorted(map(str, whole.collect()))
    assert sorted(map(str, registry.QUERIES["merge_folded"](spark, SF).collect())) == sorted(map(str, merged))


def test_quotes_spread_by_policy_are_cleaned_without_a_further_shuffle(spark):
    """Customers are broadcast here, so nothing else spreads the quotes by policy."""
    held = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plain, spread = (
            mapping.mapped_facts(spark, SF, "rate", by_policy=b)["rate"] for b in (False, True))
        plans = [rates.clean_rates(r, mapping.CONFIG)._jdf.queryExecution().executedPlan().toString() for r in (plain, spread)]
        assert "BroadcastHashJoin" in plans[1]
        assert [p.count("Exchange hashpartitioning") for p in plans] == [2, 1]
        assert plain.exceptAll(spread).isEmpty() and spread.exceptAll(plain).isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", held)
