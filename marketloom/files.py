"""The few file-system calls that Spark's Python API lacks, on whatever store a path names."""

from __future__ import annotations

import uuid
from threading import Lock

from pyspark.sql import SparkSession

#: Stores without an atomic rename (local folders) need this within the process.
_LOCK = Lock()


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway

    def path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def store(self, hpath):
        return hpath.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        p = self.path(path)
        return self.store(p).exists(p)

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none if it isn't there."""
        p = self.path(folder)
        fs = self.store(p)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def size(self, path: str) -> int:
        p = self.path(path)
        fs = self.store(p)
        return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0

    def read(self, path: str) -> str | None:
        """Text of a small file; None if it isn't there."""
        p = self.path(path)
        fs = self.store(p)
        if not fs.exists(p):
            return None
        try:
            stream = fs.open(p)
        except Exception:
            if fs.exists(p):
                raise
            return None  # deleted in between
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create_new(self, path: str, text: str) -> bool:
        """Create a file with its whole text, unless there is one already: then False.

        The text is written beside it and renamed without overwriting, so that of several writers
        exactly one succeeds and no reader sees half of the text.
        """
        target = self.path(path)
        fs = self.store(target)
        side = self.path(f"{path.rsplit('/', 1)[0]}/.new-{uuid.uuid4().hex}")
        stream = fs.create(side, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        options = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), self._conf)
        with _LOCK:
            try:
                context.rename(fs.makeQualified(side), fs.makeQualified(target), options)
                return True
            except Exception:
                fs.delete(side, False)
                if fs.exists(target):
                    return False
                raise

    def delete(self, path: str) -> None:
        p = self.path(path)
        self.store(p).delete(p, True)
