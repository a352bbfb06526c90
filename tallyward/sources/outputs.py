"""Outputs that are replaced as a whole: a reader sees the old rows or the new ones.

An output folder holds versions, each a parquet folder of its own, and one small
file that names the current one. A new version is written aside, and the file is
replaced by one rename, which the storage does at once. A driver that is lost
before leaves the old version current; what it had written is removed by the next
replacement. The version that was current before stays for those who still read
it; older ones are deleted.

A catalog table is replaced in the same way: its rows lie in a version's folder,
and the catalog is told the new location in one call.
"""

from __future__ import annotations

import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

from tallyward.sources.staging import delete_path

CURRENT = "CURRENT"
VERSION = "version-"


def write_output(df: DataFrame, target: str, *, table: bool = False) -> None:
    """Replace a plain parquet folder, or a catalog table kept in one, in place."""
    writer = df.write.mode("overwrite").format("parquet")
    if table:
        writer.saveAsTable(target)
    else:
        writer.save(target)


def replace_output(df: DataFrame, target: str) -> str:
    """Make the rows the current version of ``target``; returns the version's folder.

    ``df`` may read the output that it replaces.
    """
    spark = df.sparkSession
    before = _current(spark, target)
    version = f"{VERSION}{uuid.uuid4().hex}"
    df.write.parquet(f"{target}/{version}")
    _point(spark, target, version)
    _delete_versions(spark, target, keep={version, before})
    return f"{target}/{version}"


def read_output(spark: SparkSession, target: str) -> DataFrame:
    """The current version; what is read is settled now, not when rows are asked for."""
    version = _current(spark, target)
    if version is None:
        raise FileNotFoundError(f"{target} has no current version")
    return spark.read.parquet(f"{target}/{version}")


def replace_table(df: DataFrame, table: str, folder: str) -> None:
    """Make the rows those of a catalog table whose versions lie in ``folder``."""
    spark = df.sparkSession
    before = _current(spark, folder)
    version = f"{VERSION}{uuid.uuid4().hex}"
    path = f"{folder}/{version}"
    df.write.parquet(path)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=path, source="parquet")
    _point(spark, folder, version)
    _delete_versions(spark, folder, keep={version, before})


def _files(spark: SparkSession, folder: str) -> tuple[JavaObject, JavaObject]:
    """The folder as a path, and the file context of its storage."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    qualified = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path)
    return qualified, hadoop.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration())


def _current(spark: SparkSession, target: str) -> str | None:
    folder, files = _files(spark, target)
    pointer = spark._jvm.org.apache.hadoop.fs.Path(folder, CURRENT)
    if not files.util().exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def _point(spark: SparkSession, target: str, version: str) -> None:
    """Name the current version: written aside, then renamed over the old name."""
    folder, files = _files(spark, target)
    hadoop = spark._jvm.org.apache.hadoop.fs
    aside = hadoop.Path(folder, f"_{CURRENT}-{version}")
    stream = aside.getFileSystem(spark._jsc.hadoopConfiguration()).create(aside, True)
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    options = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(aside, hadoop.Path(folder, CURRENT), options)


def _delete_versions(spark: SparkSession, target: str, keep: set[str | None]) -> None:
    """Delete the versions of an output but for those kept, among them what a lost driver left."""
    folder, files = _files(spark, target)
    for entry in files.util().listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith(VERSION) and name not in keep:
            delete_path(spark, entry.getPath().toString())
