"""Path operations on whatever file system a path names, through Spark's own Hadoop client."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


class Storage:
    """Existence, listing, renaming and deleting of paths; only driver-side metadata calls."""

    def __init__(self, spark: SparkSession):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    def _resolve(self, location: str):
        path = self._path(location)
        return path.getFileSystem(self._conf), path

    def exists(self, location: str) -> bool:
        fs, path = self._resolve(location)
        return fs.exists(path)

    def matching(self, pattern: str) -> list[str]:
        """Paths matching a glob, sorted by name; data below a matched folder is not listed."""
        fs, path = self._resolve(pattern)
        return sorted(status.getPath().toString() for status in fs.globStatus(path) or [])

    def _visible_files(self, location: str) -> Iterator[str]:
        fs, path = self._resolve(location)
        files = fs.listFiles(path, True)
        while files.hasNext():
            file = files.next().getPath()
            if not file.getName().startswith(("_", ".")):
                yield file.toString()

    def has_data(self, location: str) -> bool:
        """Whether there is a file below a path; stops at the first that is not hidden."""
        return next(self._visible_files(location), None) is not None

    def data_files(self, location: str) -> list[str]:
        """Files below a path, or the file itself, without hidden ones; sorted by name.

        Every file costs the driver some calls: for the parts of a month, not for a table.
        """
        return sorted(self._visible_files(location))

    def make_folder(self, location: str) -> None:
        fs, path = self._resolve(location)
        fs.mkdirs(path)

    def rename(self, source: str, target: str) -> None:
        fs, path = self._resolve(source)
        if not fs.rename(path, self._path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def delete(self, location: str) -> None:
        fs, path = self._resolve(location)
        fs.delete(path, True)
