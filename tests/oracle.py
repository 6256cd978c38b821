"""Run a driver query in Spark and its oracle SQL in DuckDB; compare results.

Comparison is order-insensitive on rows, with columns sorted by name, values
compared as Python objects (``Decimal`` scale included), and the column types
reported so a type drift shows up even when values agree.
"""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v))
    if isinstance(v, float):
        return ("f", round(v, 9))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if v is None:
        return ("null", "")
    return (type(v).__name__, v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    out = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return names, out


_DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DATE": "date",
                  "TIMESTAMP": "timestamp_ntz", "DOUBLE": "double", "BOOLEAN": "boolean"}


def duck_type(t: str) -> str:
    t = str(t)
    if t.startswith("DECIMAL"):
        return t.lower().replace(" ", "")
    return _DUCK_TO_SPARK.get(t, t)


def compare(spark, con, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    s_names, s_vals = _canon(s_cols, s_rows)
    d_names, d_vals = _canon(d_cols, d_rows)
    report = {
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "names_match": s_names == d_names,
        "values_match": s_vals == d_vals,
        "spark_types": dict(sdf.dtypes),
        "oracle_types": dict(zip(d_cols, [duck_type(t) for t in rel.types])),
    }
    report["types_match"] = report["spark_types"] == report["oracle_types"]
    if not report["values_match"]:
        s_set, d_set = set(s_vals), set(d_vals)
        report["only_spark"] = sorted(s_set - d_set)[:5]
        report["only_oracle"] = sorted(d_set - s_set)[:5]
    return report
