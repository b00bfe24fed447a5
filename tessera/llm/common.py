"""Helpers shared by the corpus operators.

Words are maximal runs of bytes other than space and 0x09-0x0D, which is
exactly how ``bytes.split()`` cuts a UTF-8 text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_path

#: ASCII upper to lower case, for ``bytes.translate``.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Text handed to one vectorised step, in bytes: bounds a worker's memory.
BLOCK_BYTES = 2 << 20


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage and fixes a result that several jobs read, in a place
    every executor reaches, so it survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files go when the job that wrote them has ended, not
    when the driver happens to collect its garbage. Only for steps whose
    results are stored or collected."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A given table, with only ``columns``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def crc_of_id(doc_id: str = "doc_id") -> Column:
    """crc32 of the id written as text."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def numbered(docs: DataFrame, name: str = "row_id") -> DataFrame:
    """Adds a number to each row of a scan of stored files. Another scan of
    the same files gives the same numbers: splits are planned from the files
    alone, and a task repeated elsewhere reads its split in the same order."""
    return docs.withColumn(name, F.monotonically_increasing_id())


def free_name(columns: list[str], base: str) -> str:
    """``base``, with underscores after it until no column has that name,
    case ignored."""
    taken = {c.casefold() for c in columns}
    while base.casefold() in taken:
        base += "_"
    return base


def text_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of a text; a null text counts as empty."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]],
              schema: str) -> DataFrame:
    """``mapInArrow`` for functions that yield dicts of columns."""
    target = T.StructType.fromDDL(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)

    def run(batches):
        for columns in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, (pa.Array, pa.ChunkedArray)) and c.type == f.type
                 else pa.array(c, type=f.type)
                 for f, c in ((f, columns[f.name]) for f in arrow)], schema=arrow)

    return df.mapInArrow(run, target)


def slices(batch: pa.RecordBatch, column: str, block: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that ``column`` (binary) holds about ``block`` bytes a
    slice; a longer value is a slice of its own."""
    sizes = np.cumsum([0 if v is None else v for v in
                       pc.binary_length(batch.column(column)).to_pylist()] or [0])
    start = 0
    while start < batch.num_rows:
        done = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, done + block, side="right")))
        yield batch.slice(start, end - start)
        start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser: a bijection that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class SpanHash:
    """64-bit hashes of byte spans, the same on every machine.

    A polynomial over random 64-bit images of the bytes; one running sum over
    a buffer gives the hash of any span by subtraction."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self) -> None:
        self.images = np.random.default_rng(20240501).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 1 << 16)
            inverse = pow(self.BASE, -1, 2**64)
            for name, base in (("powers", self.BASE), ("inverses", inverse)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of ``data[starts[i]:ends[i]]``."""
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.images[data] * self.powers[:len(data)], out=sums[1:])
        return mix64((sums[ends] - sums[starts]) * self.inverses[starts]
                     + (ends - starts).astype(np.uint64))


class KeyTable:
    """An open-addressing table from int64 keys to their position in ``keys``
    (vectorised linear probing); keys must be distinct."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.ascontiguousarray(keys, dtype=np.int64)
        bits = max(4, int(4 * max(1, len(keys)) - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.slot_key = np.zeros(1 << bits, np.int64)
        self.slot = np.full(1 << bits, -1, np.int32)
        left, at = np.arange(len(self.keys)), self._home(self.keys)
        while len(left):
            free = self.slot[at] < 0
            self.slot[at[free]] = left[free]
            won = self.slot[at] == left
            self.slot_key[at[won]] = self.keys[left[won]]
            left, at = left[~won], (at[~won] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Positions of ``keys``, -1 where a key is absent."""
        keys = np.ascontiguousarray(keys, dtype=np.int64)
        at = self._home(keys)
        found = self.slot[at]
        todo = np.flatnonzero((self.slot_key[at] != keys) & (found >= 0))
        at = at[todo]
        while len(todo):
            at = (at + 1) & self.mask
            found[todo] = self.slot[at]
            on = (self.slot_key[at] != keys[todo]) & (found[todo] >= 0)
            todo, at = todo[on], at[on]
        return found


def byte_grams(data: np.ndarray, order: int) -> np.ndarray:
    """Big-endian integers of the ``order`` bytes that end at each position
    from ``order - 1`` on (``order`` at most 7)."""
    n = len(data) - order + 1
    out = np.zeros(max(0, n), np.int64)
    for i in range(order if n > 0 else 0):
        out <<= 8
        out |= data[i:i + n]
    return out
