"""What the training-data operators share: scratch tables, Arrow batches in bounded slices, word hashing."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker turns into arrays at once.
SLICE_BYTES = 1 << 20

#: Bytes of one Arrow batch on its way to a Python worker; rows that carry whole texts or shingle sets make Spark's own bound of 10,000 rows too many.
ARROW_BYTES = 2 << 20

#: Maps A-Z to a-z and every other ASCII character that isn't a letter or digit to a blank.
ALNUM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def bounded(spark: SparkSession) -> None:
    """Has the session cut Arrow batches by bytes, whatever their rows hold."""
    now = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    if not now.isdigit() or int(now) > ARROW_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


class Scratch:
    """Tables written to the shared folder that spark.checkpoint.dir names, so that a lost executor costs no more than the tasks it ran.

    Where the setting is absent (tests on one machine) a folder of this process is used.
    """

    def __init__(self, spark: SparkSession):
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not base:
            if not re.match(r"local($|\[)", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = "file://" + os.path.join(tempfile.gettempdir(), f"lucerna-{os.getpid()}")
        bounded(spark)
        self.spark, self.root, self.paths, self.made = spark, f"{base.rstrip('/')}/{uuid.uuid4().hex}", {}, 0

    def table(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{name}-{self.made}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def bucketed(self, df: DataFrame, name: str, n: int, column: str) -> DataFrame:
        """A table whose rows stay in n buckets of the column, so that joins by it move only the other side."""
        path, known = f"{self.root}/{name}", f"{name}_{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").option("path", path).bucketBy(n, column).saveAsTable(known)
        return self.spark.table(known)

    def drop(self, *tables: DataFrame) -> None:
        """Deletes tables that no later plan reads."""
        for t in tables:
            _, path = self.paths.pop(id(t), (None, None))
            if path:
                p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


#: Ids that are sent to every executor at most (8 bytes each, some 16 MB as a hash table); more are joined by an exchange.
BROADCAST_IDS = 500_000


def having(rows: DataFrame, keys: DataFrame, scratch: Scratch, without: bool = False) -> DataFrame:
    """Rows whose doc_id is (or isn't, which null never is) among the distinct keys.  The keys are counted before they are broadcast."""
    keys = scratch.table(keys.select("doc_id"), "keys")
    side = F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys
    return rows.join(side, "doc_id", "left_anti" if without else "left_semi")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id as long and text as string, whatever else the table holds; a null text is empty."""
    bounded(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def remainder(column: str = "doc_id", n: int = 4):
    """crc32 of the id as text, modulo n; null where the id is null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def slices(batches, column: str = "text", limit: int = SLICE_BYTES, rows: int = 1 << 15):
    """Record batches cut so that each holds about limit bytes of the column (one row at least) and at most so many rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = min(start + rows, max(start + 1, int(np.searchsorted(ends, base + limit, "right"))))
            yield batch.slice(start, stop - start)
            start = stop


def raw(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()]


def ids(batch: pa.RecordBatch, column: str = "doc_id") -> pa.Array:
    return batch.column(batch.schema.get_field_index(column))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits with avalanche (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def hashed(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def split_all(docs: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Blank-separated words of all documents in one list, and where each document's words begin (one more entry than documents)."""
    words, starts = [], [0]
    for d in docs:
        words += d.split()
        starts.append(len(words))
    return words, np.array(starts, np.int64)


def shingles(h: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of k consecutive word hashes; of the whole sequence where it is shorter; none without words."""
    n = len(h)
    if not n:
        return h
    k = min(k, n)
    acc = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        acc = mix(acc + h[j : n - k + 1 + j] + np.uint64(0x9E3779B97F4A7C15 * (j + 1) & 0xFFFFFFFFFFFFFFFF))
    return np.unique(acc + np.uint64(k))


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


KEPT_POWERS = 1 << 18
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n (base odd).  Short ones are kept, as a worker lives for many tasks."""

    def made(size: int):
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            yield np.cumprod(x, dtype=np.uint64)

    if n > KEPT_POWERS:
        return tuple(made(n))
    if base not in _POWERS:
        _POWERS[base] = tuple(made(KEPT_POWERS))
    p, q = _POWERS[base]
    return p[:n], q[:n]


def window_hashes(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """A polynomial hash of every `width` consecutive 64-bit values."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.uint64)
    p, inverse = powers(base, n)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * p, dtype=np.uint64)])
    return mix((total[width:] - total[:-width]) * inverse[: n - width + 1])


def range_minima(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min(values[a:b]) for each pair, all with a < b (doubling tables)."""
    out, level = np.zeros(len(a), values.dtype), np.frexp((b - a).astype(np.float64))[1] - 1
    table = values
    for j in range(int(level.max(initial=-1)) + 1):
        own = np.flatnonzero(level == j)
        out[own] = np.minimum(table[a[own]], table[b[own] - (1 << j)])
        table = np.minimum(table[: len(table) - (1 << j)], table[1 << j :])
    return out


def spans_of(places: np.ndarray, width: int) -> list[tuple[int, int]]:
    """The maximal runs covered by windows of the width that start at the places."""
    if not len(places):
        return []
    x = np.unique(places)
    cut = np.flatnonzero(np.diff(x) > width)
    return list(zip(x[np.concatenate([[0], cut + 1])].tolist(), (x[np.concatenate([cut, [len(x) - 1]])] + width).tolist()))
