"""Cleaned tables published as whole versions, and the ratings sink that a day can be loaded into again."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from casebook.operators import delivery, ingredients
from casebook.sources import driver_tables as T
from casebook.sources import published

SF = "/root/testdata/sf0.001"


def _tables(spark):
    return T.customer_orders_raw(spark, SF), T.runner_orders_raw(spark, SF)


def test_a_reader_between_two_cleanings_sees_a_whole_version(spark, tmp_path):
    co, ro = _tables(spark)
    base = str(tmp_path / "clean")
    assert published.publish_clean_tables(co, ro, base) == {"updated_customer_orders": 1, "updated_runner_orders": 1}
    place = f"{base}/updated_customer_orders"
    schema = delivery.clean_customer_orders(co).schema
    reader = published.read(spark, place, schema)  # planned on version 1 ...
    n = reader.count()
    assert n == co.count()
    published.publish_clean_tables(co.where("order_id % 2 = 0"), ro, base)
    assert reader.count() == n  # ... and still whole after version 2
    second = published.read(spark, place, schema)
    assert second.count() == co.where("order_id % 2 = 0").count() < n
    published.publish_clean_tables(co.where("order_id % 3 = 0"), ro, base)
    assert published.versions(spark, place) == [2, 3]  # version 1 is dropped, files and mark
    assert not (tmp_path / "clean/updated_customer_orders/v-00000001").exists()
    assert second.count() == co.where("order_id % 2 = 0").count()
    assert published.read(spark, place, schema, version=2).count() == second.count()
    with pytest.raises(ValueError, match="no published version 1"):
        published.read(spark, place, schema, version=1)


def test_questions_on_published_tables_equal_those_on_raw_ones(spark, tmp_path):
    co, ro = _tables(spark)
    published.publish_clean_tables(co, ro, str(tmp_path))
    clean_co, clean_ro = delivery.clean_customer_orders(co), delivery.clean_runner_orders(ro)
    kept_co = published.read(spark, str(tmp_path / "updated_customer_orders"), clean_co.schema)
    kept_ro = published.read(spark, str(tmp_path / "updated_runner_orders"), clean_ro.schema)
    for question in (delivery.change_profile, delivery.pizzas_per_order, delivery.delivery_speed):
        assert sorted(map(tuple, question(kept_co, kept_ro).collect()), key=str) == \
            sorted(map(tuple, question(clean_co, clean_ro).collect()), key=str)


def test_a_writer_that_dies_publishes_nothing(spark, tmp_path):
    place = str(tmp_path / "t")
    good = spark.range(10)
    published.publish(good, place)
    bad = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        published.publish(bad, place)
    assert published.versions(spark, place) == [1]
    assert published.read(spark, place, good.schema).count() == 10
    assert published.publish(spark.range(3), place) > 1  # its number is free of the dead writer's
    assert published.read(spark, place, good.schema).count() == 3


def test_two_writers_of_one_version(spark, tmp_path):
    place = str(tmp_path / "t")
    published.publish(spark.range(1), place)
    (tmp_path / "t" / "_LATEST-00000002").touch()  # the other was faster
    (tmp_path / "t" / "_LATEST-00000002").unlink()
    original = published.versions
    try:
        published.versions = lambda *a: [1]
        published.publish(spark.range(2), place)
        (tmp_path / "t" / "_LATEST-00000003").touch()
        with pytest.raises(published.ConcurrentPublication):
            published.publish(spark.range(3), place)
    finally:
        published.versions = original


def test_unpublished_place_and_drift(spark, tmp_path):
    with pytest.raises(ValueError, match="no published version"):
        published.read(spark, str(tmp_path / "none"), spark.range(1).schema)
    published.publish(spark.range(1).selectExpr("cast(id AS string) AS id"), str(tmp_path / "t"))
    with pytest.raises(ValueError, match="id bigint, not string"):
        published.read(spark, str(tmp_path / "t"), spark.range(1).schema)


# ------------------------------------------------------------------ ratings
def _ratings(spark, rows):
    return spark.createDataFrame([(o, o % 3, r, dt.date(2021, 1, d)) for o, r, d in rows],
                                 "order_id long, runner_id long, rating int, rating_day date")


def _read(spark, path):
    return sorted((r.order_id, r.rating, r.rating_day.day) for r in spark.read.parquet(path).collect())


def test_a_day_loaded_twice_adds_nothing_and_other_days_stay(spark, tmp_path):
    path = str(tmp_path / "ratings")
    ingredients.load_ratings(_ratings(spark, [(1, 5, 1), (2, 4, 1), (3, 3, 2)]), path)
    ingredients.load_ratings(_ratings(spark, [(1, 5, 1), (2, 4, 1)]), path)
    assert _read(spark, path) == [(1, 5, 1), (2, 4, 1), (3, 3, 2)]
    ingredients.load_ratings(_ratings(spark, [(2, 1, 1)]), path)  # a correction replaces the day
    assert _read(spark, path) == [(2, 1, 1), (3, 3, 2)]
    ingredients.load_ratings(_ratings(spark, []), path)
    assert _read(spark, path) == [(2, 1, 1), (3, 3, 2)]


def test_a_load_that_fails_leaves_every_day_as_it_was(spark, tmp_path):
    path = str(tmp_path / "ratings")
    ingredients.load_ratings(_ratings(spark, [(1, 5, 1), (3, 3, 2)]), path)
    failing = _ratings(spark, [(7, 1, 1), (8, 1, 3)]).withColumn(
        "rating", F.when(F.col("order_id") == 8, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("rating")))
    with pytest.raises(Exception, match="lost"):
        ingredients.load_ratings(failing, path)
    assert _read(spark, path) == [(1, 5, 1), (3, 3, 2)]
    ingredients.load_ratings(_ratings(spark, [(7, 1, 1), (8, 2, 3)]), path)  # the load, run again
    assert _read(spark, path) == [(3, 3, 2), (7, 1, 1), (8, 2, 3)]


def test_daily_ratings_of_the_deliveries(spark, tmp_path):
    ro = delivery.typed_runner_orders(delivery.clean_runner_orders(T.runner_orders_raw(spark, SF)))
    daily = ingredients.daily_ratings(ro, F.col("pickup_time"))
    path = str(tmp_path / "ratings")
    ingredients.load_ratings(daily, path)
    ingredients.load_ratings(daily, path)
    back = spark.read.parquet(path)
    assert back.count() == ingredients.ratings(ro).count()
    assert sorted(map(tuple, back.select("order_id", "runner_id", "rating").collect())) == \
        sorted(map(tuple, ingredients.ratings(ro).collect()))
    dayless = ingredients.daily_ratings(ro, F.lit(None).cast("date"))
    with pytest.raises(Exception, match="without a day"):
        dayless.collect()
