"""Spark-side helpers of the llm operators."""

from __future__ import annotations

import os
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlog.session import ensure_checkpoint_dir, ship_package

#: Words as every operator counts them, for Spark's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready(spark: SparkSession) -> SparkSession:
    """A session whose Python workers can import this package and whose checkpoints have a folder."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder, for files that executors write and others read."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: an eager checkpoint in the shared folder, which outlives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Held:
    """Broadcast variables that are given back, in the driver and the executors, once what uses them is cut."""

    def __init__(self, spark: SparkSession):
        self.spark, self.all = spark, []

    def broadcast(self, value):
        self.all.append(self.spark.sparkContext.broadcast(value))
        return self.all[-1]

    def release(self) -> None:
        for b in self.all:
            b.destroy()
        self.all = []


class Shared:
    """An array as a broadcast of its own, which the workers of an executor map from the file that Spark keeps there.

    Spark pickles it into a file for each executor. A large bytearray is in there as it is, after a short header;
    where the file is not found or not of that form (encrypted, say), the value is loaded as of any broadcast.
    """

    #: Lead bytes, after which the array of a large bytearray is aligned in the file.
    LEAD = 5

    def __init__(self, spark: SparkSession, array: np.ndarray):
        self.kind, self.bytes = array.dtype.str, array.nbytes
        held = bytearray(self.LEAD + self.bytes)
        held[self.LEAD :] = memoryview(np.ascontiguousarray(array)).cast("B") if self.bytes else b""
        self.held = spark.sparkContext.broadcast(held)

    def array(self) -> np.ndarray:
        if "_array" not in self.__dict__:
            self._array = self._mapped()
            if self._array is None:
                self._array = np.frombuffer(self.held.value, np.uint8)[self.LEAD :].view(self.kind)
        return self._array

    def _mapped(self) -> np.ndarray | None:
        path, size = getattr(self.held, "_path", None), self.LEAD + self.bytes
        if not path or not self.bytes or not os.path.exists(path):
            return None
        with open(path, "rb") as f:
            head = f.read(64)
        at = head.find(b"\x96" + size.to_bytes(8, "little"))  # pickle's BYTEARRAY8 and the length
        start = at + 9 + self.LEAD
        if at < 0 or start % 8 or start + self.bytes > os.path.getsize(path):
            return None
        return np.memmap(path, self.kind, "r", start, (self.bytes // np.dtype(self.kind).itemsize,))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_array"}

    def destroy(self) -> None:
        self.held.destroy()


class Scratch:
    """Intermediate tables as Parquet in the shared folder (smaller there than checkpoints), removed together."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def table(self, df: DataFrame, what: str) -> DataFrame:
        path = shared_path(self.spark, what)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, but_last: int = 0) -> None:
        """Delete the tables, but the last ones; frames that read them must be cut before."""
        gone = max(0, len(self.paths) - but_last)
        for path in self.paths[:gone]:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
        self.paths = self.paths[gone:]


def doc_mod(doc_id, modulus: int):
    """crc32 of the id's decimal text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def broadcast_rows(df: DataFrame, rows: int) -> DataFrame:
    """Mark a frame that holds at most ``rows`` rows by construction (a limit) for broadcast."""
    return F.broadcast(df.limit(rows))
