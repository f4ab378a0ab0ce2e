"""Folder operations on whatever file system the cluster uses."""

from __future__ import annotations

from datetime import UTC, datetime
from typing import NamedTuple

from pyspark.sql import SparkSession


class Entry(NamedTuple):
    name: str
    modified: datetime


def _moment(milliseconds: int) -> datetime:
    return datetime.fromtimestamp(milliseconds / 1000, UTC).replace(tzinfo=None)


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self._conf), where

    def exists(self, path: str) -> bool:
        system, where = self._at(path)
        return system.exists(where)

    def delete(self, path: str) -> None:
        system, where = self._at(path)
        system.delete(where, True)

    def modified(self, path: str) -> datetime:
        """When a file, or a folder's list of files, changed last."""
        system, where = self._at(path)
        return _moment(system.getFileStatus(where).getModificationTime())

    def list(self, path: str) -> list[Entry]:
        system, where = self._at(path)
        if not system.exists(where):
            return []
        return [
            Entry(s.getPath().getName(), _moment(s.getModificationTime()))
            for s in system.listStatus(where)
        ]
