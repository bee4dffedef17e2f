"""Files of the warehouse through Hadoop's FileSystem.

Every existence check, listing and deletion of warehouse paths goes through
here, so ``/x``, ``file:/x``, ``file:///x``, ``hdfs:/x`` and object-store paths
behave alike. Only a path that does not exist counts as "no table"; any other
storage error is raised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _at(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def statuses(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, modification time) of a file, or of the files of a folder."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, as a marker."""
    fs, p = _at(spark, path)
    fs.create(p, True).close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; False if it does."""
    fs, p = _at(spark, path)
    try:
        out = fs.create(p, False)
    except Exception:
        if fs.exists(p):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, p = _at(spark, path)
    got = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(got)).decode()
    finally:
        got.close()


def read_parquet(spark: SparkSession, path: str, schema: T.StructType,
                 partitions: list[T.StructField] = ()) -> DataFrame | None:
    """A parquet table with its declared schema and partition columns (nothing
    is inferred), or None if the path does not exist."""
    if not exists(spark, path):
        return None
    whole = T.StructType([*schema.fields, *partitions])
    return spark.read.schema(whole).option("basePath", path).parquet(path)
