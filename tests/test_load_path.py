"""Building a query runs no Spark job; tables by name; drift found from a footer; buckets join without an exchange."""

from decimal import Decimal

import pytest
from conftest import DINER_MENU
from pyspark.sql import functions as F

from casebook.operators import delivery, ingredients
from casebook.plans.catalogue import QUERIES
from casebook.plans.inspect import physical_plan
from casebook.sources import catalogue_tables, footers
from casebook.sources import driver_tables as T
from casebook.sources.files import from_rows, read_table

SF = "/root/testdata/sf0.001"
#: These write their sorted rows once, when called (``ranking.with_positions``).
EAGER = {"l1_spend_sorted", "p6_pizzas_sorted", "r6_speed_sorted"}


def test_building_a_query_runs_no_job(spark):
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    ran = {}
    for name in sorted(set(QUERIES) - EAGER):
        sc.setJobGroup(f"build {name}", name)
        QUERIES[name](spark, SF)
        if jobs := list(tracker.getJobIdsForGroup(f"build {name}")):
            ran[name] = jobs
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert ran == {}
    assert len(QUERIES) - len(EAGER) >= 68


@pytest.mark.parametrize("table", ["orders", "lineitem", "part", "events", "documents", "conversations"])
def test_footer_names_and_types_are_those_of_spark(spark, table):
    path = f"{SF}/{table}.parquet"
    assert footers.columns(spark, path, "parquet") == dict(spark.read.parquet(path).dtypes)


def test_every_primitive_type_is_read_from_the_footer(spark, tmp_path):
    df = spark.sql("""SELECT true AS b, 1Y AS t, 2S AS s, 3 AS i, 4L AS l, 1.5F AS f, 2.5D AS d, 'x' AS c, X'01' AS y,
        CAST(1.25 AS DECIMAL(5,2)) AS m, CAST(7 AS DECIMAL(20,0)) AS w, DATE'2020-01-02' AS day,
        TIMESTAMP'2020-01-02 03:04:05' AS ts, TIMESTAMP_NTZ'2020-01-02 03:04:05' AS ntz""")
    for fmt in ("parquet", "orc"):
        df.write.format(fmt).save(str(tmp_path / fmt))
        got, want = footers.columns(spark, str(tmp_path / fmt), fmt), dict(df.dtypes)
        if fmt == "orc":  # the format has one kind of timestamp for both
            got, want = ({k: v for k, v in x.items() if k not in ("ts", "ntz")} for x in (got, want))
        assert got == want, fmt


def test_partition_columns_and_empty_folders(spark, tmp_path):
    T.plans(spark).withColumn("year", F.lit(2020)).write.partitionBy("year").parquet(str(tmp_path / "plans"))
    assert footers.columns(spark, str(tmp_path / "plans"), "parquet")["year"] == "partition"
    (tmp_path / "none").mkdir()
    assert footers.columns(spark, str(tmp_path / "none"), "parquet") is None
    assert read_table(spark, "menu", str(tmp_path / "none")).collect() == []


def _menu(spark, path):
    menu = from_rows(spark, "menu", [(i, n, Decimal(p)) for i, n, p in DINER_MENU])
    menu.write.mode("overwrite").parquet(path)
    return menu


def test_tables_by_name(spark, tmp_path):
    menu = _menu(spark, str(tmp_path / "it's menu"))
    catalogue_tables.register(spark, "menu", str(tmp_path / "it's menu"), table="cb_menu")
    try:
        got = catalogue_tables.table(spark, "menu", entry="cb_menu")
        assert got.dtypes == menu.dtypes
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, menu.collect()))
        assert spark.sql("SELECT count(*) FROM cb_menu WHERE price > 10").first()[0] == 2
        # files that no longer hold the declared columns are found before any task runs
        menu.drop("price").write.mode("overwrite").parquet(str(tmp_path / "it's menu"))
        with pytest.raises(ValueError, match="price .*missing"):
            catalogue_tables.table(spark, "menu", entry="cb_menu")
        with pytest.raises(ValueError, match="price .*missing"):
            catalogue_tables.register(spark, "menu", str(tmp_path / "it's menu"), table="cb_menu2")
    finally:
        spark.sql("DROP TABLE IF EXISTS cb_menu")
    spark.sql(f"CREATE TABLE cb_other (product_id INT, product_name STRING) USING parquet LOCATION '{tmp_path}/other'")
    try:
        with pytest.raises(ValueError, match="product_id bigint, not int"):
            catalogue_tables.table(spark, "menu", entry="cb_other")
    finally:
        spark.sql("DROP TABLE cb_other")


def test_registered_partitions_are_pruned(spark, tmp_path):
    rows = spark.range(100).selectExpr("id AS order_id", "CAST(id % 4 AS INT) AS day")
    rows.write.partitionBy("day").parquet(str(tmp_path / "facts"))
    catalogue_tables.register(spark, "facts", str(tmp_path / "facts"), schema=rows.schema, partition_by=["day"], table="cb_facts")
    try:
        got = catalogue_tables.table(spark, "facts", rows.schema, "cb_facts")
        assert got.where("day = 2").count() == 25
        assert "PartitionFilters: [isnotnull(day" in physical_plan(got.where("day = 2"))
    finally:
        spark.sql("DROP TABLE cb_facts")


QUESTIONS = {
    "p4": lambda co, ro, names: delivery.delivered_by_type(co, ro, names),
    "p6": lambda co, ro, names: delivery.pizzas_per_order(co, ro),
    "p7": lambda co, ro, names: delivery.change_profile(co, ro),
    "r6": lambda co, ro, names: delivery.delivery_speed(co, ro),
    "x7": lambda co, ro, names: ingredients.revenue(co, ro, extra_price=1),
}


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    co = delivery.clean_customer_orders(T.customer_orders_raw(spark, SF))
    ro = delivery.clean_runner_orders(T.runner_orders_raw(spark, SF))
    base = tmp_path_factory.mktemp("warehouse")
    spark.sql(f"CREATE DATABASE cb_buckets LOCATION '{base}'")
    catalogue_tables.save_bucketed(co, "cb_buckets.co", "order_id", 4)
    catalogue_tables.save_bucketed(ro, "cb_buckets.ro", "order_id", 4)
    yield (co, ro), (spark.table("cb_buckets.co"), spark.table("cb_buckets.ro"))
    spark.sql("DROP DATABASE cb_buckets CASCADE")
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _below_join(plan):
    """The lines of a formatted plan tree under its outermost join of the facts."""
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line or "ShuffledHashJoin" in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" +-:*"))
    out = []
    for line in lines[at + 1:]:
        if not line.strip() or len(line) - len(line.lstrip(" +-:*")) <= depth:
            break
        out.append(line)
    return "\n".join(out)


@pytest.mark.parametrize("name", ["p6", "p7", "r6", "p4"])
def test_bucketed_facts_join_without_an_exchange(spark, bucketed, name):
    plain, stored = bucketed
    names = T.pizza_names(spark)
    want, got = (QUESTIONS[name](co, ro, names) for co, ro in (plain, stored))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    tree = got._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in tree.split("\n") if "SortMergeJoin" in line]
    assert joins
    below = _below_join(tree[tree.index(joins[-1]):])
    assert "Scan parquet" in below and "Exchange" not in below
    plain_tree = want._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plain_tree[plain_tree.index("SortMergeJoin"):]
