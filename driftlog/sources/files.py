"""File sources: raw log lines (S1), whole batch files, gzip or plain (S3), spool replay (S4).

Spark picks up whole files (a directory of rotated files, or new files in a
stream), not bytes appended to an open file. Codecs come from the file
extension (``.gz``), so a compressed batch and a plain one read the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlog.operators.decode import MAX_BODY_BYTES, REJECTED


class Folder:
    """Small files (manifests, commit records) under a path of any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._root = path.rstrip("/")
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._root}/{name}" if name else self._root)

    def names(self, name: str) -> list[str]:
        """Names of the entries of a folder, without hidden ones; none if it is not there."""
        if not self.exists(name):
            return []
        found = [s.getPath().getName() for s in self._fs.listStatus(self._path(name))]
        return [n for n in found if not n.startswith((".", "_"))]

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str = "") -> None:
        """A new file: written under a hidden name, then renamed, so that it is never seen half written."""
        folder, _, leaf = name.rpartition("/")
        if self.exists(name):
            raise FileExistsError(f"{self._root}/{name}")
        hidden = f"{folder}/.{leaf}"
        stream = self._fs.create(self._path(hidden), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self._fs.rename(self._path(hidden), self._path(name)):
            raise OSError(f"could not create {self._root}/{name}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line: ``source_file`` and ``line`` (files are read whole, never cut)."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("source_file"),
                                        F.col("value").alias("line"))


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int = 100) -> DataFrame:
    """New files of a folder as a stream of lines (rotate-by-file is the contract)."""
    return (spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(path)
            .select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("line")))


def read_batch_files(spark: SparkSession, path: str, max_bytes: int | None = MAX_BODY_BYTES) -> DataFrame:
    """One row per file: ``source_file``, ``value`` = its whole (inflated) text, and ``rejected`` = why
    it is not to be decoded, or NULL. Feed to ``decode_batches``: an invalid file, one above
    ``max_bytes`` and one that cannot be inflated become dead letters that keep all of it (the last
    one's bytes in base64) instead of failing the job."""
    text = spark.read.option("wholetext", "true").option("ignoreCorruptFiles", "true").text(path)
    text = text.select(F.col("_metadata.file_path").alias("source_file"), "value")
    long = F.lit(False) if max_bytes is None else F.octet_length("value") > max_bytes
    read = text.withColumn(REJECTED, F.when(long, F.lit(f"body of more than {max_bytes} bytes")))
    files = spark.read.format("binaryFile").load(path).where("length > 0").withColumn("source_file", F.col("_metadata.file_path"))
    # the names alone are compared; no file's bytes go through a shuffle
    names = files.select("source_file").join(text.select("source_file"), "source_file", "left_anti")
    damaged = files.select("source_file", "content").join(F.broadcast(names), "source_file", "left_semi")
    return read.unionByName(damaged.select(
        "source_file", F.base64("content").alias("value"), F.lit("file cannot be read (payload: its bytes in base64)").alias(REJECTED)))


def read_spool(spark: SparkSession, path: str) -> DataFrame:
    """``read_batch_files`` without a limit: a spool of failed batches is replayed whole."""
    return read_batch_files(spark, path, max_bytes=None)
