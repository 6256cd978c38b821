"""A count-style report over files arriving in two batches equals the batch answer."""

import os

from conftest import CO_ROWS, TS, rows

from casebook import schemas
from casebook.operators import delivery as P
from casebook.streaming.reports import run_report


def test_hourly_report_over_arriving_files(spark, tmp_path):
    src = str(tmp_path / "co")
    data = [(*r[:5], TS(r[5])) for r in CO_ROWS]
    first, second = data[:6], data[6:]
    spark.createDataFrame(first, schemas.CUSTOMER_ORDERS).write.parquet(os.path.join(src, "part1"))

    def report():
        return run_report(
            spark, os.path.join(src, "*"), schemas.CUSTOMER_ORDERS, P.orders_by_hour,
            "hourly", str(tmp_path / "sink"), checkpoint=str(tmp_path / "ckpt"),
        )

    after_first = rows(report())
    assert after_first == rows(P.orders_by_hour(spark.createDataFrame(first, schemas.CUSTOMER_ORDERS)))

    spark.createDataFrame(second, schemas.CUSTOMER_ORDERS).write.parquet(os.path.join(src, "part2"))
    after_second = rows(report())   # restarts from the checkpoint, reads only the new files
    assert after_second == rows(P.orders_by_hour(spark.createDataFrame(data, schemas.CUSTOMER_ORDERS)))
