"""Running reports over a fact table that arrives as files.

The reference has no streaming; what carries over is that its count-style
reports are plain grouped aggregates, and Structured Streaming plans those
incrementally: the same operator function applied to a streaming DataFrame
keeps its per-key state in the state store and emits the updated totals each
micro-batch.  Nothing here is a new operator - only the wiring of
``readStream`` -> operator -> ``writeStream`` with a checkpoint on the
cluster's shared checkpoint folder.

Operators that stream as they are (one aggregation, no sort, limit, window
or distinct count): ``pizza_count``, ``delivered_per_runner``,
``ordered_by_customer_type``, ``orders_by_hour``, ``orders_by_weekday``,
``success_rate``, ``signups_per_week``, ``spend_per_customer`` (the menu is
a static side of a stream-static join), ``points``, ``starts_by_month``,
``starts_after_year``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from casebook.session import checkpoint_dir


def read_fact_stream(spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int | None = None
                     ) -> DataFrame:
    """New Parquet files under ``path`` as a stream (schema declared, never inferred)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def start_report(report: DataFrame, name: str, sink_path: str, checkpoint: str | None = None,
                 available_now: bool = True) -> StreamingQuery:
    """Keep the complete, current result of a streaming aggregate at ``sink_path``.

    Each micro-batch rewrites the report table (``foreachBatch`` with an
    overwrite); a reader that meets a running overwrite may find no file and has
    to read again.  The checkpoint defaults to ``<spark checkpoint dir>/streams/<name>``, the shared folder the
    cluster names; state survives executor loss and restarts.
    """
    spark = report.sparkSession
    if checkpoint is None:
        base = checkpoint_dir(spark)
        if base is None:
            raise ValueError("no spark.checkpoint.dir on this cluster: pass checkpoint= a shared folder")
        checkpoint = os.path.join(base, "streams", name)

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(sink_path)

    writer = (
        report.writeStream.queryName(name)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(publish)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_report(spark: SparkSession, source: str, schema: StructType, operator: Callable[[DataFrame], DataFrame],
               name: str, sink_path: str, checkpoint: str | None = None) -> DataFrame:
    """Process all files now under ``source`` with ``operator`` and return the report."""
    q = start_report(operator(read_fact_stream(spark, source, schema)), name, sink_path, checkpoint)
    q.awaitTermination()
    return spark.read.parquet(sink_path)
