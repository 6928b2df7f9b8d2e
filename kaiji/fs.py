"""File-system helpers: the Hadoop file system on the driver, pyarrow's in tasks."""

from __future__ import annotations

import pyarrow.fs as pafs
from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return bool(fs.exists(p))


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, sorted; none if it doesn't exist."""
    fs, p = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def _arrow(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def files(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the data files under ``path`` in order, without hidden ones and markers; none if it doesn't exist."""
    fs, at = _arrow(path)
    found = fs.get_file_info(pafs.FileSelector(at, recursive=True, allow_not_found=True))
    prefix = path.rstrip("/").removesuffix(at.rstrip("/"))
    return sorted((prefix + f.path, f.size) for f in found if f.type == pafs.FileType.File and not f.base_name.startswith(("_", ".")))


def open_input(path: str):
    """A binary input stream for a task; ``path`` may have a scheme."""
    fs, at = _arrow(path)
    return fs.open_input_stream(at)


def open_output(path: str):
    """A binary output stream for a task; ``path`` may have a scheme."""
    fs, at = _arrow(path)
    fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(at)
