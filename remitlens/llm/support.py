"""Shared helpers: intermediate tables in the shared folder, shipping the code, word spans as arrays."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task turns into arrays at once.  One longer text is a slice of its own.
SLICE_BYTES = 1 << 19

BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of an Arrow batch that a write sends to Python.
BATCH_BYTES = 2 << 20

#: The code points that separate words in every contract: space and tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a folder of its own only where a local session sets none."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
    return spark.sparkContext.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession):
    """Writes inside send Arrow batches of ``BATCH_BYTES`` to Python; the session's own limit comes back afterwards.

    Spark's 64 MB of text are held twice in the JVM, as a buffer doubles, and again in the worker, for each task.
    """
    before = spark.conf.get(BATCH_LIMIT)
    spark.conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(BATCH_LIMIT, before)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: later steps never recompute what stands before."""
    path = scratch(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote to the shared folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once a session, so that workers can import it from any folder."""
    if getattr(spark.sparkContext, "_llm_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), "llm_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for name in ("__init__.py",):
            z.write(os.path.join(top, name), f"{os.path.basename(top)}/{name}")
        for name in sorted(os.listdir(os.path.join(top, "llm"))):
            if name.endswith(".py"):
                z.write(os.path.join(top, "llm", name), f"{os.path.basename(top)}/llm/{name}")
    spark.sparkContext.addPyFile(target)
    spark.sparkContext._llm_shipped = True


def beside_text(docs: DataFrame, carry: list[str]) -> tuple[DataFrame, int, int]:
    """The columns ``carry`` of ``docs`` and its text, where the text stands, and where ``carry`` begins.  A text that is carried goes once."""
    if "text" in carry:
        return docs.select(*carry), carry.index("text"), 0
    return docs.select(F.col("text").alias("_text"), *carry), 0, 1


def slices(column: pa.Array, limit: int = SLICE_BYTES):
    """Yield (first row, end row) of ``column`` so that each slice holds about ``limit`` bytes of text."""
    n = len(column)
    offsets = text_offsets(column)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(n, max(end, first + 1))
        yield first, end
        first = end


def text_offsets(column: pa.Array) -> np.ndarray:
    """Byte offsets of the texts of a string column (nulls are empty)."""
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], width, len(column) + 1, column.offset * np.dtype(width).itemsize)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column with a line feed after each text, and where each text starts.

    ``starts`` has one entry more than there are texts.  Null texts are empty.
    """
    import pyarrow.compute as pc

    if column.null_count:
        column = pc.fill_null(column, "")
    joined = pc.binary_join_element_wise(column.cast(pa.large_string()), pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
    offsets = text_offsets(joined)
    data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    blank = np.zeros(256, bool)
    blank[list(BLANKS.encode())] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return blank, lower


IS_BLANK, LOWER_ASCII = _tables()

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _grown(kind: str, base: int, n: int) -> np.ndarray:
    """Powers of ``base`` modulo 2**64, kept between calls."""
    known = _powers[kind]
    if len(known) < n:
        known = np.full(max(n, SLICE_BYTES + 4096), base, np.uint64)
        known[0] = 1
        known = _powers[kind] = np.multiply.accumulate(known)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xCA5A826395121157)
    return x ^ (x >> np.uint64(32))


class Hasher:
    """Rolling hash: after one pass over ``data`` any span's 64-bit hash costs two look-ups."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * _grown("up", _ODD, n), out=self.sums[1:])
        self.down = _grown("down", _INVERSE, n + 1)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(raw + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``data``, which must end in a blank."""
    inside = ~IS_BLANK[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edges = np.concatenate([[0], edges])
    return edges[0::2], edges[1::2]
