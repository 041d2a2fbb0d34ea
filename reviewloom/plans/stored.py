"""What queries of one session share: tables built once from given tables, and again when these change."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from ..session import shared_dir

_BUILT: dict[tuple, str] = {}


def state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files below ``path``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files, found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(where, True), []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


def stored(spark: SparkSession, sf_dir: str, name: str, tables: list[str], build: Callable[[str], object]) -> str:
    """A folder that ``build`` (folder) filled from the ``tables`` as they are now."""
    key = (spark.sparkContext.applicationId, sf_dir, name, *(state(spark, f"{sf_dir}/{t}.parquet") for t in tables))
    if key not in _BUILT:
        path = shared_dir(spark, name)
        build(path)
        _BUILT[key] = path
    return _BUILT[key]
