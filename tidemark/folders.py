"""Folders of a store, listed and removed through the file system that Spark uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in ``path``; none if it does not exist. Files are not opened."""
    root = _path(spark, path)
    system = _file_system(spark, root)
    if not system.exists(root):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(root) if s.isDirectory())


def numbered_folders(spark: SparkSession, path: str, key: str, *, complete: bool = False) -> list[int]:
    """The numbers N of the folders ``key=N`` in ``path``; ``complete`` asks for a finished write."""
    found = [n.removeprefix(f"{key}=") for n in folder_names(spark, path) if n.startswith(f"{key}=")]
    numbers = [int(n) for n in found if n.isdigit()]
    if complete:
        root = _path(spark, path)
        system = _file_system(spark, root)
        numbers = [n for n in numbers if system.exists(_path(spark, f"{path}/{key}={n}/_SUCCESS"))]
    return sorted(numbers)


def delete_folder(spark: SparkSession, path: str) -> bool:
    target = _path(spark, path)
    return _file_system(spark, target).delete(target, True)
