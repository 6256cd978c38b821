"""Run driver queries from the command line.

    python -m casebook list
    python -m casebook show <query> <tables_dir> [rows]
    python -m casebook run  <query> <tables_dir> <output_dir>

Under ``spark-submit`` the cluster's session is used; run directly, a local
session is started.  ``run`` writes the whole result as Parquet (nothing is
collected); ``show`` prints the first rows.
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from casebook.plans.catalogue import QUERIES
from casebook.session import configure, configure_for_cluster


def _configured(spark: SparkSession) -> SparkSession:
    local = spark.sparkContext.master.startswith("local")
    return configure(spark) if local else configure_for_cluster(spark)


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return _configured(active)
    from pyspark import SparkConf

    builder = SparkSession.builder.appName("casebook")
    if not SparkConf().contains("spark.master"):  # not launched by spark-submit
        builder = builder.master("local[*]").config("spark.ui.enabled", "false")
    return _configured(builder.getOrCreate())


def main(argv: list[str]) -> int:
    if not argv or argv[0] == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    cmd, name, tables = argv[0], argv[1], argv[2]
    if name not in QUERIES:
        print(f"unknown query {name!r}; see `python -m casebook list`", file=sys.stderr)
        return 2
    df = QUERIES[name](_session(), tables)
    if cmd == "show":
        df.show(int(argv[3]) if len(argv) > 3 else 20, truncate=False)
    elif cmd == "run":
        df.write.mode("overwrite").parquet(argv[3])
    else:
        print(__doc__, file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
