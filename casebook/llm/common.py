"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.session import checkpoint_dir

#: The white space of the word rule ``[^\x20\x09-\x0D]+``.
BLANKS = " \t\n\x0b\f\r"

#: Largest side, in measured bytes, that an operator asks Spark to broadcast.
MAX_BROADCAST_BYTES = 32 << 20


#: The folder this package is imported from.
HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Whole texts are long, so Arrow batches are bounded by bytes, where the session sets no bound.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def prepare_workers() -> None:
    """Bound the batches sent to Python workers, and let them find this package.

    Workers know PYTHONPATH and shipped files, not the driver's ``sys.path``.  On a
    cluster ship the package (``--py-files``); a folder that is not there is harmless.
    """
    spark = SparkSession.active()
    key, value = BATCH_BYTES
    if key not in spark.conf.getAll:
        spark.conf.set(key, value)
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if HOME not in known:
        environment["PYTHONPATH"] = os.pathsep.join([HOME, *filter(None, known)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialised(df: DataFrame) -> DataFrame:
    """``df`` written once to the session's shared checkpoint folder.

    Lineage is cut, so an executor lost later costs a re-read of that folder
    and not a recomputation.  Spark removes the files with the DataFrame where the cluster sets
    ``spark.cleaner.referenceTracking.cleanCheckpoints``, as ``local_session`` does; elsewhere they
    stay until the folder is emptied.
    """
    if checkpoint_dir(df.sparkSession) is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return df.checkpoint()


def scratch_table(spark: SparkSession) -> str:
    """A new path under the session's shared checkpoint folder."""
    base = checkpoint_dir(spark)
    if base is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/casebook-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table that ``scratch_table`` named, once nothing reads it any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session that hold for the jobs inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def shuffles_given_back(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the job that wrote them ends (its result is in the checkpoint folder)."""
    with settings(spark, {CLEANUP: "true"}):
        yield


def small_side(df: DataFrame, bytes_per_row: Column | int,
               limit: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when its measured bytes stay under ``limit``.

    ``df`` must be cheap to read twice (materialised).  Beyond the limit the
    join is left to Spark: sort-merge, hot keys split by AQE.
    """
    size = df.agg(F.sum(bytes_per_row if isinstance(bytes_per_row, Column)
                        else F.lit(bytes_per_row)).cast("long")).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def quoted(name: str) -> str:
    """A column name as ``F.col`` reads it, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


#: Numbers whose sums ``prefix_sums`` looks up together.
SUM_BLOCK = 256


def prefix_sums(df: DataFrame, values: str, out: str) -> DataFrame:
    """``df`` with the array<long> ``out``: for every number of the array ``values``, the sum of those before it.

    Column by column, as an array that a lambda computes itself is computed once per element.
    """
    blocks, before = f"{out}_blocks", f"{out}_before"
    add = lambda numbers: F.aggregate(numbers, F.lit(0).cast("long"), lambda total, x: total + x)
    df = df.withColumn(blocks, F.transform(
        F.sequence(F.lit(0), F.floor(F.size(values) / SUM_BLOCK).cast("int")),
        lambda b: F.slice(values, b * SUM_BLOCK + 1, SUM_BLOCK)))
    df = df.withColumn(before, F.transform(blocks, lambda block: add(block)))
    # starts of the blocks, and of what lies in each
    df = df.withColumn(before, F.transform(before, lambda _, b: add(F.slice(before, 1, b))))
    return df.withColumn(out, F.flatten(F.transform(blocks, lambda block, b: F.transform(
        block, lambda _, k: F.get(F.col(before), b) + add(F.slice(block, 1, k)))))).drop(blocks, before)
