"""Folders of a store that Spark reaches, and the one that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only a local master may do without, and gets one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own:
        made = tempfile.mkdtemp(prefix="tidemill-engine-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _own[context.applicationId] = f"file://{made}"
    return _own[context.applicationId]


def written(frame: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """A frame that reads what was written once, and the folder, which the caller may delete."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path), path


class Files:
    """The few file operations that a table needs, on any store that Spark can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._fs = self._at(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def full(self, path: str) -> str:
        """The path with its scheme and authority, as catalogues keep it."""
        return self._fs.makeQualified(self._at(path)).toString()

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._at(path))

    def names(self, path: str) -> list[str]:
        return [f.getPath().getName() for f in self._fs.listStatus(self._at(path))] if self.exists(path) else []

    def size(self, path: str) -> int:
        return self._fs.getContentSummary(self._at(path)).getLength() if self.exists(path) else 0

    def read(self, path: str) -> str:
        stream = self._fs.open(self._at(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Writes a file as a whole unless there is one of that name; whether it did. Readers never see a part of it."""
        target = self._at(path)
        aside = self._at(f"{path}.{uuid.uuid4().hex}")
        stream = self._fs.create(aside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            if self._fs.exists(target):
                return False
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.toUri().getScheme() else self._fs.getUri(), self._conf)
            none = self._jvm.java.lang.reflect.Array.newInstance(self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
            context.rename(self._fs.makeQualified(aside), self._fs.makeQualified(target), none)
            return True
        except Exception as error:
            if self._fs.exists(target) and "AlreadyExists" in str(error):
                return False
            raise
        finally:
            if self._fs.exists(aside):
                self._fs.delete(aside, False)

    def delete(self, path: str) -> None:
        self._fs.delete(self._at(path), True)
