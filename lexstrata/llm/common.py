"""What the operators share: shared-folder tables, byte slices of Arrow columns, word positions and hashes.

Everything that looks at text works on UTF-8 bytes in numpy, a slice of a few MB at a time, so a worker's memory
is bounded by the slice (or by one document, where that is longer) and not by the Arrow batch or the partition.
"""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of text that are looked at together.
SLICE_BYTES = 1 << 20

WORD_RE = r"[^\x20\x09-\x0D]+"

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: A random 64-bit value for each byte; the seed is part of the hash's definition.
BYTE64 = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)


# -- shared folder ----------------------------------------------------------------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: spark.checkpoint.dir where it is set; else, where driver and executors are one process
    (tests), a new one. On a cluster an unset folder is an error: executors would each write to a disk of their own."""
    set_to = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if set_to:
        return set_to.rstrip("/")
    jsc = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jsc.isDefined():
        return jsc.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="lexstrata-")
    spark.sparkContext.setCheckpointDir(own)
    return own


class Tables:
    """Intermediate tables of one run, as Parquet in the shared folder: they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.n = 0

    def put(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Writes df and returns the table that was written."""
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{name}"
        with freed(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._lexstrata_path = path
        return out

    def drop(self, *dfs: DataFrame) -> None:
        """Deletes tables that nothing reads any more."""
        for df in dfs:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(df._lexstrata_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def freed(spark: SparkSession):
    """Actions in here leave no shuffle files behind: Spark removes an action's when it has ended, and not when the driver happens
    to collect its garbage. For actions whose shuffles nothing after them reads."""
    was = spark.conf.get(FREE, "false")
    spark.conf.set(FREE, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE, was)


def send(spark: SparkSession, model) -> Broadcast:
    """A broadcast of an object of this library's classes. They travel with their code: executors that have no copy of the package can
    read it by received(), which a broadcast of the object itself would not allow."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def received(sent: Broadcast):
    return pickle.loads(sent.value)


def unused_prefix(df: DataFrame) -> str:
    """A prefix that no column of df begins with, for columns that come and go."""
    p = "_t_"
    while any(c.startswith(p) for c in df.columns):
        p = f"_{p}"
    return p


def fold(column: str, k: int):
    """crc32 of the id as text, modulo k."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % k


# -- byte slices ------------------------------------------------------------------------------------------------


def as_bytes(column: pa.Array) -> list[bytes]:
    """A string or binary column as bytes; null is empty."""
    if not pa.types.is_binary(column.type):
        column = column.cast(pa.binary())
    return [b"" if x is None else x for x in column.to_pylist()]


class Slice:
    """Documents lo..hi of a batch, joined by newlines: data (uint8), and each document's start and end in it."""

    def __init__(self, texts: list[bytes], lo: int, hi: int):
        self.lo, self.hi, self.n = lo, hi, hi - lo
        self.raw = b"\n".join(texts[lo:hi]) + b"\n"
        self.data = np.frombuffer(self.raw, np.uint8)
        lengths = np.fromiter(map(len, texts[lo:hi]), np.int64, self.n)
        self.end = np.cumsum(lengths + 1) - 1
        self.start = self.end - lengths

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.end, at, "left")


def slices(texts: list[bytes], most: int = SLICE_BYTES) -> Iterator[Slice]:
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield Slice(texts, lo, i)
            lo, size = i, 0
        size += len(t) + 1
    if lo < len(texts):
        yield Slice(texts, lo, len(texts))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True."""
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if len(mask) and mask[0]:
        edge = np.concatenate(([0], edge))
    if len(edge) % 2:
        edge = np.append(edge, len(mask))
    return edge[0::2], edge[1::2]


def words(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word (maximal run without ASCII whitespace), and its document in the slice."""
    start, end = runs(~SPACE[s.data])
    return start, end, s.doc_of(start)


def per_doc(docs: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Counts, or integer sums of weights, by document."""
    if weights is None:
        return np.bincount(docs, minlength=n).astype(np.int64)
    return np.bincount(docs, weights=weights, minlength=n).round().astype(np.int64)


# -- hashes -----------------------------------------------------------------------------------------------------


def powers(n: int, base: int = BASE) -> np.ndarray:
    out = np.full(n + 1, np.uint64(base))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all of them."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class SpanHash:
    """64-bit hashes of any spans of a byte array: differences of a running sum, moved to the same power."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sum = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE64[data] * powers(n)[:n], out=self.sum[1:], dtype=np.uint64)
        self.inverse = powers(n, BASE_INV)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sum[end] - self.sum[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def chained(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive values, at the run's first place; k - 1 fewer than there are values."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = mixed(out * np.uint64(BASE) + hashes[i : i + n])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)
