"""Ingredients, pricing and ratings of the delivery case study (its parts C-E).

The reference asks these questions without answering them in SQL, so the
rules are ours and stated on each function.  Inputs are the cleaned
``customer_orders`` (exclusions / extras are comma-separated topping ids or
NULL), the cleaned typed ``runner_orders``, and the small dimensions
``pizza_names(pizza_id, pizza_name)``, ``pizza_recipes(pizza_id, toppings)``
and ``pizza_toppings(topping_id, topping_name)``.

Lists inside a text cell are parsed with ``split`` and exploded.  Per-pizza
labels are built once per distinct (pizza, exclusions, extras) combination
and joined to the pizza rows, so the pizza rows are never exploded; totals are
pre-aggregated per pizza type or topping before they are combined.

Nothing is dropped in silence: a listed topping id that is no number or is not in
``pizza_toppings`` raises (``on_unknown='raise'``); ``'skip'`` leaves it out, and
``unknown_toppings`` counts such ids.  A delivered pizza without a price raises.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from casebook.functions.expr import minutes_between, round_ratio, scaled, strict_cast
from casebook.operators.delivery import sum_over_delivered


ON_UNKNOWN = ("raise", "skip")


def _lenient(on_unknown: str) -> bool:
    if on_unknown not in ON_UNKNOWN:
        raise ValueError(f"on_unknown must be one of {ON_UNKNOWN}")
    return on_unknown == "skip"


def topping_ids(text: str | Column, on_unknown: str = "raise") -> Column:
    """``'1, 5'`` -> ``[1, 5]`` (NULL stays NULL; blanks around ids ignored).
    An entry that is no number raises, or is NULL with ``on_unknown='skip'``."""
    c = F.col(text) if isinstance(text, str) else text
    skip = _lenient(on_unknown)
    return F.transform(F.split(c, ","), lambda x: strict_cast(F.trim(x), IntegerType(), lenient=skip))


def _exploded(df: DataFrame, list_col: str, keep: Sequence[str], on_unknown: str = "raise") -> DataFrame:
    """One row per (row, listed topping id) with its position in the list."""
    return df.select(*keep, F.posexplode(topping_ids(list_col, on_unknown)).alias("_pos", "topping_id"))


def _named(items: DataFrame, toppings: DataFrame, on_unknown: str) -> DataFrame:
    """``items`` with ``topping_name``; ids without one raise or drop out."""
    if _lenient(on_unknown):
        return items.join(toppings, on="topping_id")
    name = F.coalesce(F.col("topping_name"), F.raise_error(
        F.concat(F.lit("unknown topping "), F.coalesce(F.col("topping_id").cast("string"), F.lit("NULL")))).cast("string"))
    return items.join(toppings, on="topping_id", how="left").withColumn("topping_name", name)


def unknown_toppings(co: DataFrame, toppings: DataFrame, columns: Sequence[str] = ("exclusions", "extras")) -> DataFrame:
    """(column, entry, times): listed entries that are no known topping id."""
    found = []
    for column in columns:
        texts = co.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        entries = texts.select("_n", F.explode(F.split(column, ",")).alias("entry"))
        entries = entries.withColumn("topping_id", F.trim("entry").try_cast("int"))
        found.append(entries.join(toppings, on="topping_id", how="left_anti").groupBy("entry").agg(
            F.sum("_n").cast("bigint").alias("times")).select(F.lit(column).alias("column"), "entry", "times"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def recipe_items(recipes: DataFrame, on_unknown: str = "raise") -> DataFrame:
    """``pizza_recipes`` as (pizza_id, topping_id)."""
    return _exploded(recipes, "toppings", ["pizza_id"], on_unknown).select("pizza_id", "topping_id")


# X1 -------------------------------------------------------------------------
def standard_ingredients(names: DataFrame, recipes: DataFrame, toppings: DataFrame,
                         on_unknown: str = "raise") -> DataFrame:
    """Each pizza's standard toppings, alphabetical, comma-separated."""
    items = _named(recipe_items(recipes, on_unknown), toppings, on_unknown)
    lists = items.groupBy("pizza_id").agg(
        F.array_join(F.array_sort(F.collect_list("topping_name")), ", ").alias("standard_ingredients")
    )
    return names.join(lists, on="pizza_id").select("pizza_id", "pizza_name", "standard_ingredients")


# X2 / X3 ----------------------------------------------------------------------
def topping_frequency(co: DataFrame, toppings: DataFrame, column: str = "extras",
                      top: int | None = None, on_unknown: str = "raise") -> DataFrame:
    """How often each topping is listed in ``column`` (``'extras'`` or
    ``'exclusions'``) over all ordered pizzas; ``top`` keeps the most common
    (ties broken by topping id).

    The pizza rows are first counted per distinct list text (partial on the
    map side; a menu has few such texts), and only those texts are split."""
    texts = co.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    counts = _exploded(texts, column, ["_n"], on_unknown).groupBy("topping_id").agg(
        F.sum("_n").cast("bigint").alias("times"))
    named = _named(counts, toppings, on_unknown).select("topping_id", "topping_name", "times")
    if top is None:
        return named
    return named.orderBy(F.desc("times"), F.asc("topping_id")).limit(top)


# X4 / X5 ----------------------------------------------------------------------
# A label depends only on (pizza_id, exclusions, extras).  Labels are built for
# the distinct combinations (a partial-aggregated ``distinct``: as many rows as
# the menu's combinatorics, not as pizzas) and joined back null-safe.  AQE sees
# the labels' bytes at their exchange and broadcasts them when they are small;
# else it sort-merges and splits the hot "no change" combination.
COMBO = ("pizza_id", "exclusions", "extras")


def _combos(co: DataFrame) -> DataFrame:
    return co.select(*COMBO).distinct()


def _attach(co: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Left-join per-combination ``labels`` onto the pizza rows (NULL-safe keys)."""
    lab = labels.select(*[F.col(c).alias(f"_k_{c}") for c in COMBO], F.col(label))
    cond = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in COMBO]
    return co.join(lab, on=cond, how="left").drop(*[f"_k_{c}" for c in COMBO])


def _item_label(name: Column, exc: Column, ext: Column) -> Column:
    return F.when(name.isNotNull(), F.concat_ws(
        " - ", name,
        F.when(exc.isNotNull(), F.concat(F.lit("Exclude "), exc)),
        F.when(ext.isNotNull(), F.concat(F.lit("Extra "), ext)),
    ))


def _left_by_combo(left: DataFrame, right: DataFrame) -> DataFrame:
    # combinations are few: a plain null-safe join among them
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in COMBO], *[c for c in right.columns if c not in COMBO])
    cond = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in COMBO]
    return left.join(r, on=cond, how="left").drop(*[f"_r_{c}" for c in COMBO])


def order_item_labels(co: DataFrame, names: DataFrame, toppings: DataFrame,
                      on_unknown: str = "raise") -> DataFrame:
    """``'Meatlovers - Exclude Cheese, Bacon - Extra Mushrooms, Peppers'`` for
    every pizza row; names keep the order of the ids in the cell."""
    combos = _combos(co)
    empty = F.array().cast("array<int>")
    listed = combos.select(
        *COMBO,
        F.explode(F.concat(
            F.transform(F.coalesce(topping_ids("exclusions", on_unknown), empty), lambda x, i: F.struct(
                F.lit(0).alias("kind"), i.alias("pos"), x.alias("topping_id"))),
            F.transform(F.coalesce(topping_ids("extras", on_unknown), empty), lambda x, i: F.struct(
                F.lit(1).alias("kind"), i.alias("pos"), x.alias("topping_id"))),
        )).alias("_i"),
    ).select(*COMBO, "_i.*")
    parts = _named(listed, toppings, on_unknown).groupBy(*COMBO).agg(
        F.array_sort(F.collect_list(F.struct("kind", "pos", "topping_name"))).alias("_l")
    )

    def names_of(kind: int) -> Column:
        picked = F.filter(F.col("_l"), lambda x: x["kind"] == kind)
        return F.when(F.size(picked) > 0, F.array_join(F.transform(picked, lambda x: x["topping_name"]), ", "))

    # a combination without any known topping has no row in ``parts``
    labelled = _left_by_combo(combos.join(names, on="pizza_id", how="left"), parts)
    labels = labelled.select(*COMBO, _item_label(F.col("pizza_name"), names_of(0), names_of(1)).alias("order_item"))
    return _attach(co, labels, "order_item")


def _used_toppings(recipe: Column, on_unknown: str) -> Column:
    """Recipe ids minus the row's exclusions, then the row's extras."""
    empty = F.array().cast("array<int>")
    kept = F.array_except(F.coalesce(recipe, empty), F.coalesce(topping_ids("exclusions", on_unknown), empty))
    return F.concat(kept, F.coalesce(topping_ids("extras", on_unknown), empty))


def _recipes_by_pizza(recipes: DataFrame, on_unknown: str) -> DataFrame:
    return recipe_items(recipes, on_unknown).groupBy("pizza_id").agg(F.collect_list("topping_id").alias("_recipe"))


def _ingredient_counts(combos: DataFrame, recipes: DataFrame, on_unknown: str) -> DataFrame:
    """(combination, topping, quantity): recipe toppings not excluded count 1,
    every listed extra counts 1 more."""
    items = combos.join(_recipes_by_pizza(recipes, on_unknown), on="pizza_id", how="left").select(
        *COMBO, F.explode(_used_toppings(F.col("_recipe"), on_unknown)).alias("topping_id")
    )
    return items.groupBy(*COMBO, "topping_id").agg(F.count(F.lit(1)).alias("qty"))


def ingredient_lists(co: DataFrame, names: DataFrame, recipes: DataFrame, toppings: DataFrame,
                     on_unknown: str = "raise") -> DataFrame:
    """``'Meatlovers: 2xBacon, Beef, ..., Salami'`` for every pizza row:
    alphabetical, ``Nx`` in front of an ingredient used N > 1 times."""
    combos = _combos(co)
    counts = _named(_ingredient_counts(combos, recipes, on_unknown), toppings, on_unknown)
    item = F.when(F.col("qty") > 1, F.concat(F.col("qty").cast("string"), F.lit("x"), F.col("topping_name"))).otherwise(
        F.col("topping_name")
    )
    lists = counts.groupBy(*COMBO).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct(F.col("topping_name"), item.alias("i")))), lambda s: s["i"]),
            ", ",
        ).alias("_items")
    )
    labelled = _left_by_combo(combos.join(names, on="pizza_id", how="left"), lists)
    name = F.col("pizza_name")
    labels = labelled.select(
        *COMBO,
        F.when(name.isNotNull(), F.concat(name, F.lit(": "), F.coalesce(F.col("_items"), F.lit("")))).alias("ingredients"),
    )
    return _attach(co, labels, "ingredients")


def delivered_pizzas(co: DataFrame, ro: DataFrame) -> DataFrame:
    """Pizza rows of orders without a cancellation."""
    return co.join(ro.where(F.col("cancellation").isNull()).select("order_id"), on="order_id")


def ingredient_totals(co: DataFrame, ro: DataFrame, recipes: DataFrame, toppings: DataFrame,
                      on_unknown: str = "raise") -> DataFrame:
    """Quantity of each ingredient over delivered pizzas - the sum of every
    delivered pizza's ``ingredient_lists`` quantities.

    Delivered pizzas are counted per distinct (pizza, exclusions, extras)
    combination in one pass behind the join, and the recipe, exclusion and
    extra arithmetic runs on those few combinations, weighted by their counts:
    the pizza rows are never exploded or regrouped.
    """
    combos = sum_over_delivered(co, ro, list(COMBO), {"_n": F.count(F.lit(1))})
    items = combos.join(_recipes_by_pizza(recipes, on_unknown), on="pizza_id", how="left").select(
        "_n", F.explode(_used_toppings(F.col("_recipe"), on_unknown)).alias("topping_id")
    )
    total = items.groupBy("topping_id").agg(F.sum("_n").cast("bigint").alias("quantity"))
    return _named(total, toppings, on_unknown).select("topping_id", "topping_name", "quantity")


# X7 / X10 -------------------------------------------------------------------
# The prices the reference's questions give (Meatlovers $12,
# Vegetarian $10, $1 per extra, runner paid $0.30 per km).
PIZZA_PRICES = [(1, Decimal("12.00")), (2, Decimal("10.00"))]
EXTRA_PRICE = Decimal("1")
RUNNER_RATE_PER_KM = Decimal("0.30")


def pizza_prices(spark: SparkSession) -> DataFrame:
    """The price table (pizza_id, price); add a row for a new pizza."""
    return spark.createDataFrame(PIZZA_PRICES, "pizza_id int, price decimal(12,2)")


def _priced_total(co: DataFrame, ro: DataFrame, prices: DataFrame | None, extra_price: Decimal | None = None) -> DataFrame:
    """One row, ``_r``: delivered pizzas at their prices, plus listed extras.

    Pizzas (and extras) are counted per pizza id first, so prices join one row
    per type; a delivered pizza without a price raises."""
    n_extras = F.when(F.col("extras").isNull(), F.lit(0)).otherwise(F.size(F.split("extras", ",")))
    extras = F.sum(n_extras) if extra_price is not None else F.lit(0)
    per_type = sum_over_delivered(co, ro, ["pizza_id"], {"_n": F.count(F.lit(1)), "_e": extras})
    prices = pizza_prices(co.sparkSession) if prices is None else prices
    prices = prices.select(F.col("pizza_id").alias("_p"), "price")
    price = F.coalesce(F.col("price"), F.raise_error(F.concat(
        F.lit("no price for pizza "), F.coalesce(F.col("pizza_id").cast("string"), F.lit("NULL")))).cast("decimal(12,2)"))
    amount = price * F.col("_n") + F.col("_e") * F.lit(extra_price or Decimal(0))
    return per_type.join(prices, F.col("pizza_id") == F.col("_p"), "left").agg(F.sum(amount).alias("_r"))


def revenue(co: DataFrame, ro: DataFrame, prices: DataFrame | None = None,
            extra_price: Decimal | None = None) -> DataFrame:
    """Revenue from delivered pizzas at the ``prices`` table (default
    ``pizza_prices``); with ``extra_price``, each listed extra adds that much."""
    return _priced_total(co, ro, prices, extra_price).select(F.col("_r").cast("decimal(18,2)").alias("revenue"))


def net_after_runner_pay(co: DataFrame, ro_typed: DataFrame, prices: DataFrame | None = None,
                         rate_per_km: Decimal = RUNNER_RATE_PER_KM) -> DataFrame:
    """Revenue of delivered pizzas minus ``rate_per_km`` per km travelled.

    Distance is paid once per delivered order, so it is summed over orders
    (not over the order's pizza rows) before being combined with revenue."""
    delivered = ro_typed.where(F.col("cancellation").isNull())
    rev = _priced_total(co, ro_typed, prices).select(F.col("_r").alias("_rev"))
    km = delivered.agg(F.sum("distance").alias("_km"))
    # both sides are one row; the scalar subquery keeps this a projection
    pay = (km.select(F.coalesce(F.col("_km"), F.lit(0)) * F.lit(rate_per_km))).scalar()
    return rev.select(
        F.col("_rev").cast("decimal(18,2)").alias("revenue"),
        pay.cast("decimal(18,2)").alias("runner_pay"),
        (F.coalesce(F.col("_rev"), F.lit(0)) - pay).cast("decimal(18,2)").alias("net"),
    )


# X8 / X9 --------------------------------------------------------------------
def ratings(ro: DataFrame, rule: Column | None = None) -> DataFrame:
    """A ratings table: one rating 1-5 per successful order.

    ``rule`` is any integer expression over runner_orders' columns; the
    default is a fixed arithmetic of the ids, so the table is reproducible.
    A rating outside 1-5 fails the job (``raise_error``) rather than being
    dropped or clipped.
    """
    rule = (F.col("order_id") * 7 + F.col("runner_id")) % 5 + 1 if rule is None else rule
    r = rule.cast("int")
    checked = F.when(r.between(1, 5), r).otherwise(F.raise_error(F.lit("rating outside 1-5")))
    return ro.where(F.col("cancellation").isNull()).select("order_id", "runner_id", checked.cast("int").alias("rating"))


def write_ratings(ratings_df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet sink for the ratings table."""
    ratings_df.write.mode(mode).parquet(path)


#: The sink's partition column: the day a rating belongs to.
RATING_DAY = "rating_day"


def daily_ratings(ro: DataFrame, day: Column, rule: Column | None = None) -> DataFrame:
    """``ratings`` with the day each belongs to, by any date expression over runner_orders' columns."""
    days = ro.where(F.col("cancellation").isNull()).select("order_id", day.cast("date").alias(RATING_DAY))
    unknown = F.raise_error(F.lit("a rating without a day"))
    dated = days.withColumn(RATING_DAY, F.coalesce(F.col(RATING_DAY), unknown.cast("date")))
    return ratings(ro, rule).join(dated, on="order_id")


def load_ratings(daily: DataFrame, path: str) -> None:
    """Replace, in the sink at ``path``, the days that ``daily`` holds; other days stay.

    A day is a folder, written aside and swapped in when the job commits, so loading a day
    again adds nothing, and a load that fails leaves every day as it was.  Rows are dealt by
    day and order before the write, so a day with most rows is written by many tasks
    and a day with few by few files.
    """
    dealt = daily.select("order_id", "runner_id", "rating", RATING_DAY).hint("rebalance", RATING_DAY)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RATING_DAY).parquet(path)


def delivery_facts(co: DataFrame, ro_typed: DataFrame, ratings_df: DataFrame, factor: int = 60) -> DataFrame:
    """One row per successful delivery: customer, order, runner, rating,
    order and pickup times, minutes to pickup, duration, speed, pizzas.

    Pizzas are counted per (order, customer, order time) before joining, so
    the joins carry one row per order."""
    per_order = co.groupBy("order_id", "customer_id", "order_time").agg(F.count(F.lit(1)).alias("total_pizzas"))
    done = ro_typed.where(F.col("cancellation").isNull())
    rows = per_order.join(done, on="order_id").join(ratings_df.select("order_id", "rating"), on="order_id", how="left")
    return rows.select(
        "customer_id", "order_id", "runner_id", "rating", "order_time", "pickup_time",
        minutes_between("order_time", "pickup_time", "total").alias("minutes_to_pickup"),
        F.col("duration").alias("duration"),
        round_ratio(scaled("distance") * factor, scaled("duration"), 2).alias("avg_speed"),
        "total_pizzas",
    )


# X11 ------------------------------------------------------------------------
def add_pizza(names: DataFrame, recipes: DataFrame, toppings: DataFrame, pizza_id: int,
              pizza_name: str) -> tuple[DataFrame, DataFrame]:
    """A new pizza with every topping appended to the pizza dimensions."""
    spark = names.sparkSession
    new_name = spark.createDataFrame([(pizza_id, pizza_name)], names.schema)
    all_toppings = toppings.agg(
        F.array_join(F.array_sort(F.collect_list("topping_id")).cast("array<string>"), ", ").alias("toppings")
    ).select(F.lit(pizza_id).cast("int").alias("pizza_id"), "toppings")
    return names.unionByName(new_name), recipes.unionByName(all_toppings)
