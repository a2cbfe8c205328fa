"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from wardflow.session import owned_dir
from wardflow.sources.tables import read_table

# Characters that separate words in every operator here: space, \t \n \v \f \r.
# bytes.split() without an argument splits on exactly this set.
BLANKS = " \t\n\x0b\x0c\r"

# Rows of an Arrow batch handled at a time in Python, so that only a slice of
# the batch exists as Python objects.
SLICE_ROWS = 2048


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table (doc_id, text, lang, source, n_chars)."""
    return read_table(spark, sf_dir, "documents")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_wardflow_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="wardflow-ship-")  # the driver serves the file while the context lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    copy = os.path.join(folder, "src", os.path.basename(package))
    shutil.copytree(package, copy, ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(folder, "wardflow_package"), "zip", os.path.dirname(copy)))
    sc._wardflow_shipped = True


_HELD: dict = {}
try:  # only glibc keeps freed memory and can be told to return it
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim
except (OSError, AttributeError):
    _LIBC = None


def worker_cache(name, make: Callable):
    """What a Python worker keeps between tasks: the cache of one operator at a time.

    Workers outlive stages; the cache of another operator takes the place of
    the last one's, so that memory doesn't add up over a pipeline.
    """
    if name not in _HELD:
        drop_worker_cache()
        _HELD[name] = make()
    return _HELD[name]


def drop_worker_cache() -> None:
    """For operators that keep nothing between tasks but need the memory; what is freed goes back to the system."""
    _HELD.clear()
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


class _WordHashes(dict):
    """Hashes by word, filled in as words are asked for."""

    def __missing__(self, word) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def word_hashes(words: list) -> np.ndarray:
    """64-bit hashes of words (all bytes or all strings), remembered per worker."""
    known = worker_cache("word hashes", _WordHashes)
    if len(known) > 200_000:
        known.clear()
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Intermediate tables of one operator call in the shared folder.

    ``save`` cuts lineage: the table is written under ``spark.checkpoint.dir``
    and read back, so later stages survive the loss of an executor.  The shuffle files
    of the write go with it; else they stay until the driver's JVM happens to collect garbage.  ``drop``
    deletes a table that nothing reads any more; the others go when the session ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = owned_dir(spark, f"llm-{name}")

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        conf, before = self.spark.conf, self.spark.conf.get(_FREE_SHUFFLES, None)
        conf.set(_FREE_SHUFFLES, "true")
        try:
            df.write.parquet(path)
        finally:
            conf.unset(_FREE_SHUFFLES) if before is None else conf.set(_FREE_SHUFFLES, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
            path.getFileSystem(conf).delete(path, True)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of at most ``rows`` rows."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def map_rows(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
             schema: str | StructType) -> DataFrame:
    """Map each slice of ``df`` in Python; ``make`` builds the function once per task."""
    def run(batches):
        step = make()
        for part in slices(batches):
            yield step(part)
    return df.mapInArrow(run, schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
