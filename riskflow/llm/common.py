"""Stored steps in the shared folder, and byte-level helpers for the texts of an Arrow batch."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Bytes of text that a Python task works on at once; a longer text is a slice of its own.
SLICE_BYTES = 4_000_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def work_dir(spark: SparkSession) -> str:
    """The application's folder below spark.checkpoint.dir.

    The setting is read from the session. Where it is unset, a local session gets a temporary folder of its own; on a
    cluster that is an error, as executors do not share the driver's disk.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="riskflow-")
        spark.conf.set(CHECKPOINT_DIR, base)
    return f"{base.rstrip('/')}/work-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step as Parquet into the work folder and read it back: the lineage is cut, columns can be pruned."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clean(spark: SparkSession) -> None:
    """Delete all steps that this application stored. Call it when no result that reads them is needed any more."""
    discard(spark, work_dir(spark))


class PlainNames:
    """`df` with columns _c0, _c1, ...: columns of any name may be in a table, so that none clashes with a step's own."""

    def __init__(self, docs: DataFrame) -> None:
        self.own = {name: f"_c{i}" for i, name in enumerate(docs.columns)}
        self.df = docs.toDF(*self.own.values())

    def __getitem__(self, name: str) -> str:
        return self.own[name]

    def restored(self, df: DataFrame, *more: str) -> DataFrame:
        """The table's columns under their names, and `more` columns of `df`."""
        return df.select(*[F.col(b).alias(a) for a, b in self.own.items()], *more)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application."""
    if spark.sparkContext.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    folder = tempfile.mkdtemp(prefix="riskflow-package-")  # the driver's own; executors fetch the file from the driver
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "riskflow_package.zip")
    with zipfile.ZipFile(path, "w") as file:
        for at, _, names in os.walk(os.path.join(root, "riskflow")):
            for name in names:
                if name.endswith(".py"):
                    file.write(os.path.join(at, name), os.path.relpath(os.path.join(at, name), root))
    spark.sparkContext.addPyFile(path)
    _shipped.add(spark.sparkContext.applicationId)


Batches = Iterator[pa.RecordBatch]


def map_batches(df: DataFrame, function: Callable[[Batches], Batches], schema: str | StructType) -> DataFrame:
    """mapInArrow, with this package at hand in the Python workers. Spark keeps these, so each task gives back what it freed."""
    ship(df.sparkSession)

    def run(batches: Batches) -> Batches:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
                trim(0)

    return df.mapInArrow(run, schema)


def text_slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about `most` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for low, high in zip(edges, edges[1:], strict=False):
        if high > low:
            yield batch.slice(low, high - low)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts (null: none) and where each text begins and ends in them."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    if offsets is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def _table(seed: int, size: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, size, dtype=np.uint64)


def byte_class(excluded: list[tuple[int, int]]) -> np.ndarray:
    """Which of the 256 bytes belong to words: all but the given ranges."""
    known = np.ones(256, bool)
    for low, high in excluded:
        known[low : high + 1] = False
    return known


# Words [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (the latter after lower-casing A-Z).
NOT_SPACE = byte_class([(0x09, 0x0D), (0x20, 0x20)])
ALPHANUMERIC = byte_class([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])

_BYTE_VALUES = _table(1, 256)
_BYTE_VALUES[65:91] = _BYTE_VALUES[97:123]  # A-Z count as a-z
_place_values = _table(2, 1 << 12) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_spans(data: np.ndarray, ends: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in `data`, and the index of each text's first word (one more entry than texts)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(ends), np.int64)
    inside = known[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = ends[(ends > 0) & (ends < len(data))]  # no word goes on in the next text
    first[edges] |= inside[edges]
    last[edges - 1] |= inside[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, ends)


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, known: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, with A-Z as a-z: a sum over its bytes, each weighted by its place."""
    global _place_values
    if not len(starts):
        return np.zeros(0, np.uint64)
    longest = int((stops - starts).max())
    if longest > len(_place_values):
        _place_values = _table(2, 1 << longest.bit_length()) | np.uint64(1)
    place = np.zeros(len(data), np.int32)
    place[starts] = np.diff(starts, prepend=0)
    np.cumsum(place, out=place)
    place = np.arange(len(data), dtype=np.int32) - place
    values = np.where(known, _BYTE_VALUES, np.uint64(0))[data]
    # Bytes between words have the value 0, so their place does not matter.
    values *= _place_values[np.minimum(place, longest, out=place).clip(0)] if longest < len(_place_values) else _place_values[place.clip(0, longest - 1)]
    return mix(np.add.reduceat(values, starts) + (stops - starts).astype(np.uint64))
