"""Columns and types that Parquet and ORC files carry, read from one footer by the driver.

``spark.read.parquet(path).schema`` starts a Spark job to read footers.  Here the file
formats' own readers open one footer through the session's Hadoop configuration, so
any path Spark can read will do, no job runs, and only some kilobytes are read.
"""

from __future__ import annotations

import re

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

# Spark's type for a Parquet primitive without, and with, a logical annotation.
PLAIN = {"BOOLEAN": "boolean", "INT32": "int", "INT64": "bigint", "FLOAT": "float", "DOUBLE": "double",
         "BINARY": "binary", "FIXED_LEN_BYTE_ARRAY": "binary", "INT96": "timestamp"}
ANNOTATED = [
    (r"STRING|ENUM|JSON", "string"), (r"DATE", "date"),
    (r"TIMESTAMP\((?:MICROS|MILLIS),true\)", "timestamp"), (r"TIMESTAMP\((?:MICROS|MILLIS),false\)", "timestamp_ntz"),
    (r"DECIMAL\((\d+),(\d+)\)", r"decimal(\1,\2)"),
    (r"INTEGER\(8,true\)", "tinyint"), (r"INTEGER\(16,true\)", "smallint"), (r"INTEGER\(32,true\)", "int"),
    (r"INTEGER\(64,true\)", "bigint"), (r"INTEGER\(8,false\)", "smallint"), (r"INTEGER\(16,false\)", "int"),
    (r"INTEGER\(32,false\)", "bigint"), (r"INTEGER\(64,false\)", "decimal(20,0)"),
]


def data_file(spark: SparkSession, path: str) -> tuple[JavaObject, dict[str, str]] | None:
    """One data file at or below ``path``, with the partition columns (``key=value`` folders) above it.

    The first in name order; names with ``_`` or ``.`` in front are not data.  None if there is no file.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def below(status: JavaObject, keys: dict[str, str]) -> tuple[JavaObject, dict[str, str]] | None:
        if status.isFile():
            return (status.getPath(), keys) if status.getLen() else None
        for child in sorted(fs.listStatus(status.getPath()), key=lambda s: s.getPath().getName()):
            name = child.getPath().getName()
            if name.startswith("_") and "=" not in name or name.startswith("."):
                continue
            key, mark, value = name.partition("=")
            if found := below(child, {**keys, key: value} if mark and child.isDirectory() else keys):
                return found
        return None

    return below(fs.getFileStatus(root), {})


def _parquet(spark: SparkSession, file: JavaObject) -> dict[str, str]:
    parquet = spark._jvm.org.apache.parquet.hadoop
    reader = parquet.ParquetFileReader.open(
        parquet.util.HadoopInputFile.fromPath(file, spark._jsc.hadoopConfiguration()))
    try:
        fields = list(reader.getFooter().getFileMetaData().getSchema().getFields())
    finally:
        reader.close()
    return {f.getName(): _parquet_type(f) for f in fields}


def _parquet_type(field: JavaObject) -> str:
    if not field.isPrimitive():
        return "nested"
    note = field.getLogicalTypeAnnotation()
    if note is None:
        return PLAIN[str(field.asPrimitiveType().getPrimitiveTypeName())]
    text = str(note.toString())
    for pattern, kind in ANNOTATED:
        if m := re.fullmatch(pattern, text):
            return m.expand(kind)
    return text.lower()


def _orc(spark: SparkSession, file: JavaObject) -> dict[str, str]:
    orc = spark._jvm.org.apache.orc.OrcFile
    reader = orc.createReader(file, orc.readerOptions(spark._jsc.hadoopConfiguration()))
    try:
        schema = reader.getSchema()
        kinds = {"timestamp": "timestamp_ntz", "timestamp with local time zone": "timestamp"}
        return {name: kinds.get(str(child.toString()), str(child.toString()))
                for name, child in zip(schema.getFieldNames(), schema.getChildren(), strict=True)}
    finally:
        reader.close()


def columns(spark: SparkSession, path: str, fmt: str) -> dict[str, str] | None:
    """Name to type (as ``DataType.simpleString``) of the files at ``path``; None where there is no file yet.

    Nested columns are ``nested``; a partition column has the type ``partition``.
    """
    found = data_file(spark, path)
    if found is None:
        return None
    file, keys = found
    return {**(_parquet if fmt == "parquet" else _orc)(spark, file), **dict.fromkeys(keys, "partition")}
