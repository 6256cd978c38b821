"""Query results published as whole versions: a reader sees all of one version or all of another.

The reference cleans its tables once into temporary tables, dropped and made again at will,
and asks all its questions of those.  Here a cleaned table is a folder of versions:

    <place>/v-00000007/part-...      the files of version 7
    <place>/_LATEST-00000007         empty; a version counts once its mark is there

``publish`` writes the next version's folder and then creates its mark, which a file system does
at once or not at all, and fails if the mark exists: of two writers of one version the second
is told.  ``read`` takes the highest mark.  A writer that dies before its mark leaves a folder that
no reader sees; its number is not used again.  Old versions go after the new mark is there,
except the ``keep`` newest, so a job that has begun on the one before can end.

Everything goes through the session's Hadoop file system, so a place is any path that
all executors share.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from casebook.operators.delivery import clean_customer_orders, clean_runner_orders
from casebook.sources.files import load

_MARK, _FOLDER = re.compile(r"_LATEST-(\d+)$"), re.compile(r"v-(\d+)$")


class ConcurrentPublication(RuntimeError):
    """Another writer has published the same version."""


def _fs(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _numbers(spark: SparkSession, place: str, what: re.Pattern) -> list[int]:
    fs, path = _fs(spark, place)
    if not fs.exists(path):
        return []
    return sorted(int(m[1]) for s in fs.listStatus(path) if (m := what.fullmatch(str(s.getPath().getName()))))


def versions(spark: SparkSession, place: str) -> list[int]:
    """The published versions that are still there, oldest first."""
    return _numbers(spark, place, _MARK)


def folder(place: str, version: int) -> str:
    return f"{place.rstrip('/')}/v-{version:08d}"


def publish(df: DataFrame, place: str, keep: int = 2) -> int:
    """Write ``df`` as the next version of ``place`` and return its number; the ``keep`` newest stay."""
    if keep < 1:
        raise ValueError("at least the new version is kept")
    spark = df.sparkSession
    version = max([0, *versions(spark, place), *_numbers(spark, place, _FOLDER)]) + 1
    df.write.mode("errorifexists").parquet(folder(place, version))
    fs, mark = _fs(spark, f"{place.rstrip('/')}/_LATEST-{version:08d}")
    try:
        fs.create(mark, False).close()
    except Py4JJavaError as error:
        raise ConcurrentPublication(f"{place}: version {version} is already there") from error
    drop_old(spark, place, keep)
    return version


def drop_old(spark: SparkSession, place: str, keep: int) -> list[int]:
    """Drop all published versions but the ``keep`` newest: the mark first, then the files."""
    old = versions(spark, place)[:-keep]
    for version in old:
        for name in (f"{place.rstrip('/')}/_LATEST-{version:08d}", folder(place, version)):
            fs, path = _fs(spark, name)
            fs.delete(path, True)
    return old


def read(spark: SparkSession, place: str, schema: StructType, version: int | None = None) -> DataFrame:
    """The latest published version (or the one asked for), with the declared ``schema``."""
    known = versions(spark, place)
    if not known or version is not None and version not in known:
        raise ValueError(f"{place}: no published version" + (f" {version}" if version is not None else ""))
    return load(spark, folder(place, known[-1] if version is None else version), schema)


CLEANINGS: Mapping[str, Callable[[DataFrame], DataFrame]] = {
    "updated_customer_orders": clean_customer_orders,
    "updated_runner_orders": clean_runner_orders,
}


def publish_clean_tables(customer_orders: DataFrame, runner_orders: DataFrame, base: str, keep: int = 2) -> dict[str, int]:
    """The two cleaned delivery tables, each written once as its next version below ``base``."""
    raw = dict(zip(CLEANINGS, (customer_orders, runner_orders), strict=True))
    return {name: publish(clean(raw[name]), f"{base.rstrip('/')}/{name}", keep) for name, clean in CLEANINGS.items()}
