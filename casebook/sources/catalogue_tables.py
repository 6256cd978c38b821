"""Logical tables by name: files registered in Spark's catalogue with their declared schema.

``spark.table("sales")`` and Spark SQL then read the files wherever they lie.  The catalogue
holds the declared columns, so nothing is inferred and no job runs; ``table`` compares
the catalogue's columns, and one file's footer, with the declaration each time.

Facts that meet on one key can be stored bucketed by it (``save_bucketed``): both sides
hash the key into the same number of files, so a join or a grouping on the key needs
no exchange, in this job and every later one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from casebook.sources.files import SCHEMAS, check_drift


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _columns(schema: StructType) -> str:
    return ", ".join(f"{_quoted_column(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def _quoted_column(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def register(spark: SparkSession, name: str, path: str, fmt: str = "parquet", schema: StructType | None = None,
             partition_by: Sequence[str] = (), table: str | None = None) -> None:
    """Catalogue entry ``table`` (default: ``name``) over the files at ``path``; an entry of that name is replaced.

    ``schema`` is by default the declared one of the logical table ``name``.  The files
    are not touched, neither now nor when the entry is dropped.  Drift raises.  The
    ``key=value`` folders of ``partition_by`` that exist now are entered; register again for later ones.
    """
    schema = SCHEMAS[name] if schema is None else schema
    if fmt in ("parquet", "orc"):
        check_drift(spark, path, schema, fmt)
    entry = _quoted(table or name)
    spark.sql(f"DROP TABLE IF EXISTS {entry}")
    parted = f"PARTITIONED BY ({', '.join(map(_quoted_column, partition_by))}) " if partition_by else ""
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {entry} ({_columns(schema)}) USING {fmt} {parted}LOCATION '{place}'")
    if partition_by:
        spark.sql(f"ALTER TABLE {entry} RECOVER PARTITIONS")


def table(spark: SparkSession, name: str, schema: StructType | None = None, entry: str | None = None) -> DataFrame:
    """The catalogue table ``entry`` (default: ``name``) in the declared column order.

    Raises where the catalogue's columns or types differ from the declaration, or where
    the files no longer hold them.
    """
    schema = SCHEMAS[name] if schema is None else schema
    df = spark.table(_quoted(entry or name))
    known = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f"{f.name} {f.dataType.simpleString()}, not " + (known[f.name].simpleString() if f.name in known else "missing")
             for f in schema.fields if known.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"{entry or name}: declared " + "; ".join(wrong))
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {_quoted(entry or name)}").collect()}
    fmt = about.get("Provider", "").lower()
    if fmt in ("parquet", "orc") and about.get("Location"):
        check_drift(spark, about["Location"], schema, fmt)
    return df.select(*[_quoted_column(f.name) for f in schema.fields])


def save_bucketed(df: DataFrame, entry: str, key: str, buckets: int, fmt: str = "parquet") -> None:
    """Write ``df`` to the warehouse as table ``entry``, bucketed and sorted by ``key``; an old one is replaced.

    Tables that are to be joined on ``key`` take the same type of key and number of buckets.  Rows are dealt to
    the buckets before the write, so each bucket is one file.  A key with many rows makes its bucket large:
    choose the number by the largest bucket that a task may read.
    """
    if buckets < 1:
        raise ValueError("at least one bucket")
    df.repartition(buckets, key).write.mode("overwrite").format(fmt).bucketBy(buckets, key).sortBy(key).saveAsTable(entry)
