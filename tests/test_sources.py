"""File sources with declared schemas, and the generated tables."""

import pytest
from conftest import DINER_MENU

from casebook.sources import driver_tables as T
from casebook.sources.files import from_rows, read_table, write_table


def test_round_trip_parquet_and_csv(spark, tmp_path):
    from decimal import Decimal

    menu = from_rows(spark, "menu", [(i, n, Decimal(p)) for i, n, p in DINER_MENU])
    write_table(menu, str(tmp_path / "menu"))
    back = read_table(spark, "menu", str(tmp_path / "menu"))
    assert back.schema == menu.schema
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, menu.collect()))
    menu.write.option("header", "true").csv(str(tmp_path / "menu_csv"))
    csv = read_table(spark, "menu", str(tmp_path / "menu_csv"), fmt="csv")
    assert sorted(map(tuple, csv.collect())) == sorted(map(tuple, menu.collect()))


def test_unknown_table_is_an_error(spark):
    with pytest.raises(KeyError):
        from_rows(spark, "nope", [])


def test_files_that_land_later_are_read(spark, tmp_path):
    import shutil

    for name in ("orders", "lineitem"):
        (tmp_path / f"{name}.parquet").mkdir()
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", tmp_path / f"{name}.parquet" / "a.parquet")
    n = T.subs_log(spark, str(tmp_path)).count()
    shutil.copy("/root/testdata/sf0.001/orders.parquet", tmp_path / "orders.parquet" / "b.parquet")
    assert T.subs_log(spark, str(tmp_path)).count() == 2 * n


def test_drifting_columns_fail(spark, tmp_path):
    menu = spark.createDataFrame([(1, "sushi")], "product_id long, product_name string")
    menu.write.parquet(str(tmp_path / "no_price"))
    with pytest.raises(ValueError, match="price .*missing"):
        read_table(spark, "menu", str(tmp_path / "no_price"))
    menu.selectExpr("cast(product_id as string) product_id", "product_name", "cast(1 as decimal(12,2)) price").write.parquet(
        str(tmp_path / "retyped"))
    with pytest.raises(ValueError, match="product_id bigint, not string"):
        read_table(spark, "menu", str(tmp_path / "retyped"))
    (tmp_path / "menu.csv").write_text("price,product_id,product_name\n10,1,sushi\n")
    with pytest.raises(Exception):
        read_table(spark, "menu", str(tmp_path / "menu.csv"), fmt="csv").collect()
    (tmp_path / "bad.csv").write_text("product_id,product_name,price\none,sushi,10\n")
    with pytest.raises(Exception):
        read_table(spark, "menu", str(tmp_path / "bad.csv"), fmt="csv").collect()


def test_declared_schema_prunes_columns(spark):
    plan = T.sales(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan


def test_cluster_defaults_fill_only_unset(spark):
    from casebook.session import CLUSTER_DEFAULTS, configure_for_cluster

    before = spark.conf.get("spark.sql.shuffle.partitions")
    configure_for_cluster(spark)
    try:
        # set explicitly by the test session, so kept
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") in ("256m", str(256 * 1024 * 1024))
    finally:
        for key in CLUSTER_DEFAULTS:
            if key != "spark.sql.shuffle.partitions":
                spark.conf.unset(key)


def test_command_line_run(spark, tmp_path):
    from casebook.__main__ import main

    out = str(tmp_path / "out")
    assert main(["run", "s10_days_histogram", "/root/testdata/sf0.001", out]) == 0
    assert spark.read.parquet(out).count() > 0
    assert main(["run", "no_such_query", "/root/testdata/sf0.001", out]) == 2
