"""The logical tables of ``casebook.sources.driver_tables`` as DuckDB CTEs.

The oracle SQL of every driver query starts from these, written separately
from the Spark code so the comparison checks two independent spellings.
"""

from __future__ import annotations

CTE = {
    "sales": """
        SELECT o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS order_date,
               l.l_partkey AS product_id
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "menu": """
        SELECT p_partkey AS product_id, p_type AS product_name,
               CAST(p_retailprice AS DECIMAL(12,2)) AS price
        FROM part""",
    "members": """
        SELECT o_custkey AS customer_id, MIN(CAST(o_orderdate AS DATE)) AS join_date
        FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey""",
    "co_raw": """
        SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
               CAST(l.l_partkey % 2 + 1 AS INTEGER) AS pizza_id,
               CASE WHEN l.l_returnflag = 'N' THEN 'null'
                    WHEN l.l_returnflag = 'A' THEN CASE WHEN l.l_linenumber % 2 = 0 THEN '' END
                    WHEN l.l_linenumber % 3 = 0 THEN '2, 6' ELSE '4' END AS exclusions,
               CASE l.l_linenumber % 4 WHEN 0 THEN NULL WHEN 1 THEN 'null' WHEN 2 THEN ''
                    ELSE '1, 5' END AS extras,
               o.o_orderdate + to_minutes(o.o_orderkey % 1440) AS order_time,
               l.l_linenumber AS line_no
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "ro_raw": """
        SELECT o_orderkey AS order_id, (o_orderkey // 30) % 100 AS runner_id,
               CASE WHEN o_orderstatus = 'F' THEN 'null'
                    ELSE strftime(o_orderdate + to_minutes(o_orderkey % 1440 + 5 + o_orderkey % 90),
                                  '%Y-%m-%d %H:%M:%S') END AS pickup_time,
               CASE WHEN o_orderstatus = 'F' THEN 'null'
                    WHEN o_orderkey % 5 = 0 THEN 'null'
                    WHEN o_orderkey % 5 = 1 THEN ''
                    WHEN o_orderkey % 5 = 2 THEN CAST(5 + o_orderkey % 37 AS VARCHAR) || '.5km'
                    WHEN o_orderkey % 5 = 3 THEN CAST(5 + o_orderkey % 37 AS VARCHAR) || '.4 km'
                    ELSE CAST(5 + o_orderkey % 37 AS VARCHAR) END AS distance,
               CASE WHEN o_orderstatus = 'F' THEN 'null'
                    WHEN o_orderkey % 6 = 0 THEN CAST(10 + o_orderkey % 31 AS VARCHAR) || 'mins'
                    WHEN o_orderkey % 6 = 1 THEN CAST(10 + o_orderkey % 31 AS VARCHAR) || ' mins'
                    WHEN o_orderkey % 6 = 2 THEN CAST(10 + o_orderkey % 31 AS VARCHAR) || ' minute'
                    WHEN o_orderkey % 6 = 3 THEN CAST(10 + o_orderkey % 31 AS VARCHAR) || ' minutes'
                    WHEN o_orderkey % 6 = 4 THEN CAST(10 + o_orderkey % 31 AS VARCHAR)
                    ELSE 'null' END AS duration,
               CASE WHEN o_orderstatus = 'F' THEN
                         CASE WHEN o_orderkey % 2 = 0 THEN 'Restaurant Cancellation'
                              ELSE 'Customer Cancellation' END
                    WHEN o_orderkey % 4 = 0 THEN 'NaN'
                    WHEN o_orderkey % 4 = 1 THEN ''
                    WHEN o_orderkey % 4 = 2 THEN 'null' END AS cancellation
        FROM orders""",
    "runners": """
        SELECT o_custkey AS runner_id, MIN(CAST(o_orderdate AS DATE)) AS registration_date
        FROM orders GROUP BY o_custkey""",
    "pizza_names": """
        SELECT * FROM (VALUES (1, 'Meatlovers'), (2, 'Vegetarian')) t(pizza_id, pizza_name)""",
    "pizza_recipes": """
        SELECT * FROM (VALUES (1, '1, 2, 3, 4, 5, 6, 8, 10'), (2, '4, 6, 7, 9, 11, 12')) t(pizza_id, toppings)""",
    "pizza_toppings": """
        SELECT * FROM (VALUES (1, 'Bacon'), (2, 'BBQ Sauce'), (3, 'Beef'), (4, 'Cheese'), (5, 'Chicken'),
                              (6, 'Mushrooms'), (7, 'Onions'), (8, 'Pepperoni'), (9, 'Peppers'), (10, 'Salami'),
                              (11, 'Tomatoes'), (12, 'Tomato Sauce')) t(topping_id, topping_name)""",
    # one row per (pizza row, listed id, position) for extras / exclusions and recipes
    "extra_items": """
        SELECT order_id, line_no, pizza_id, pos, CAST(trim(x) AS INTEGER) AS topping_id FROM (
          SELECT order_id, line_no, pizza_id, unnest(string_split(extras, ',')) AS x,
                 generate_subscripts(string_split(extras, ','), 1) AS pos
          FROM co WHERE extras IS NOT NULL) u""",
    "exclusion_items": """
        SELECT order_id, line_no, pizza_id, pos, CAST(trim(x) AS INTEGER) AS topping_id FROM (
          SELECT order_id, line_no, pizza_id, unnest(string_split(exclusions, ',')) AS x,
                 generate_subscripts(string_split(exclusions, ','), 1) AS pos
          FROM co WHERE exclusions IS NOT NULL) u""",
    "recipe_items": """
        SELECT pizza_id, CAST(trim(x) AS INTEGER) AS topping_id FROM (
          SELECT pizza_id, unnest(string_split(toppings, ',')) AS x FROM pizza_recipes) u""",
    "delivered": """
        SELECT co.* FROM co JOIN ro ON co.order_id = ro.order_id WHERE ro.cancellation IS NULL""",
    "plans": """
        SELECT * FROM (VALUES (0, 'trial', CAST(0 AS DECIMAL(5,2))),
                              (1, 'basic monthly', CAST(9.90 AS DECIMAL(5,2))),
                              (2, 'pro monthly', CAST(19.90 AS DECIMAL(5,2))),
                              (3, 'pro annual', CAST(199 AS DECIMAL(5,2))),
                              (4, 'churn', CAST(NULL AS DECIMAL(5,2)))) t(plan_id, plan_name, price)""",
    "subs_log": """
        SELECT o_custkey AS customer_id,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS plan_id,
               CAST(o_orderdate AS DATE) AS start_date, o_orderkey AS tiebreak
        FROM orders""",
    "subs": """
        SELECT customer_id, plan_id, MIN(start_date) AS start_date
        FROM subs_log GROUP BY customer_id, plan_id""",
    # cleaned delivery tables, by the cleaning rules: sentinels are NULL (fixed
    # values, per column), a unit is the letters at the end of a measure
    "co": """
        SELECT * REPLACE (nullif(nullif(exclusions, 'null'), '') AS exclusions,
                          nullif(nullif(extras, 'null'), '') AS extras)
        FROM co_raw""",
    "ro": """
        SELECT * REPLACE (
          nullif(pickup_time, 'null') AS pickup_time,
          regexp_replace(nullif(nullif(distance, 'null'), ''), '[a-z]+$', '') AS distance,
          regexp_replace(nullif(nullif(duration, 'null'), ''), '[a-z]+$', '') AS duration,
          nullif(nullif(nullif(cancellation, 'null'), ''), 'NaN') AS cancellation)
        FROM ro_raw""",
    "rot": """
        SELECT * REPLACE (pickup_time::TIMESTAMP AS pickup_time,
                          distance::DECIMAL(38,10) AS distance, duration::DECIMAL(38,10) AS duration)
        FROM ro""",
    # minutes from order to pickup: the minute field of the interval, and all of them
    "waits": """
        SELECT order_id, customer_id, runner_id, order_time,
               datediff('minute', order_time, pickup_time) AS total_minutes,
               datediff('minute', order_time, pickup_time) % 60 AS field_minutes
        FROM co JOIN rot USING (order_id) WHERE pickup_time IS NOT NULL""",
}

# which CTEs each CTE reads
DEPENDS = {
    "subs": ["subs_log"],
    "co": ["co_raw"],
    "ro": ["ro_raw"],
    "rot": ["ro"],
    "waits": ["co", "rot"],
    "extra_items": ["co"],
    "exclusion_items": ["co"],
    "recipe_items": ["pizza_recipes"],
    "delivered": ["co", "ro"],
}


def with_tables(*names: str) -> str:
    """A ``WITH`` clause defining ``names`` and everything they read, in order."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        for dep in DEPENDS.get(n, []):
            visit(dep)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n].strip()})" for n in ordered) + "\n"
