"""Loading the case-study tables from files or literal rows, schema declared.

A user's own ``sales``, ``subscriptions``, ``runner_orders``... are read with
the schema of ``casebook.schemas``.  A file whose columns drift fails instead of
producing a wrong answer later: the columns and types that self-describing
files (Parquet, ORC) carry are compared with the declared ones, CSV headers must
match them, and a malformed CSV or JSON value fails the job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from casebook import schemas
from casebook.sources import footers

SCHEMAS: dict[str, StructType] = {
    "sales": schemas.SALES,
    "menu": schemas.MENU,
    "members": schemas.MEMBERS,
    "customer_orders": schemas.CUSTOMER_ORDERS,
    "runner_orders": schemas.RUNNER_ORDERS,
    "runners": schemas.RUNNERS,
    "pizza_names": schemas.PIZZA_NAMES,
    "pizza_recipes": schemas.PIZZA_RECIPES,
    "pizza_toppings": schemas.PIZZA_TOPPINGS,
    "plans": schemas.PLANS,
    "subscriptions": schemas.SUBSCRIPTIONS,
}


def check_drift(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> None:
    """Raise if Parquet or ORC files at ``path`` lack a declared column or hold it with another type.

    One footer is read, by the driver and without a Spark job; a later file that differs in type
    fails in its task.  A folder without files has nothing to compare.
    """
    found = footers.columns(spark, path, fmt)
    if found is None:
        return
    wrong = []
    for f in schema.fields:
        kind, declared = found.get(f.name, "missing"), f.dataType.simpleString()
        # a file does not tell ORC's two timestamps apart as Spark's catalogue does
        same = kind in (declared, "nested", "partition") or fmt == "orc" and {kind, declared} == {"timestamp", "timestamp_ntz"}
        if not same:
            wrong.append(f"{f.name} {declared}, not {kind}")
    if wrong:
        raise ValueError(f"{path}: declared " + "; ".join(wrong))


def load(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **options) -> DataFrame:
    """Files at ``path`` with the declared ``schema``; drift raises.

    Parquet and ORC: every declared column must be there with its type (extra
    columns are not read), see ``check_drift``.  CSV: the header must hold the declared
    names in order.  CSV and JSON: malformed records fail.  No Spark job runs.
    """
    reader = spark.read.options(**options).schema(schema)
    if fmt in ("parquet", "orc"):
        check_drift(spark, path, schema, fmt)
        return reader.format(fmt).load(path)
    reader = reader.option("mode", options.get("mode", "FAILFAST"))
    if fmt == "csv":
        reader = reader.option("header", options.get("header", "true")).option("enforceSchema", "false")
    return reader.format(fmt).load(path)


def read_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Read logical table ``name`` from ``path`` (``parquet``, ``csv``, ``json``, ``orc``)."""
    return load(spark, path, SCHEMAS[name], fmt, **options)


def from_rows(spark: SparkSession, name: str, rows: Iterable[tuple]) -> DataFrame:
    """``INSERT ... VALUES`` as a DataFrame with the table's declared schema."""
    return spark.createDataFrame(list(rows), SCHEMAS[name])


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Parquet sink; partition a fact by a date column (e.g. a month key) so
    date filters prune whole directories."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
