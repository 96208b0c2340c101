"""What the operators share: reading tables, the shared folder, bounded Arrow slices."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a Python task holds at once; a longer single document is a slice of its own.
SLICE_BYTES = 3 << 18
#: Rows and bytes of one Arrow batch between the JVM and Python.
BATCH_ROWS, BATCH_BYTES = 2_000, 4 << 20


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches and let the workers import this package wherever the driver was started."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:  # only where no cluster has named one, as in tests
        base = "file:///tmp/checkpoints/tessera"
    path = sc._jvm.org.apache.hadoop.fs.Path(base)  # a path without a scheme is in the cluster's default store
    base = str(path.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(path).toString())
    return f"{base.rstrip('/')}/tessera-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there and survives lost executors."""
    spark, path = df.sparkSession, f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, folder: str, *names: str) -> None:
    """Delete tables of the folder that nothing reads any more."""
    for name in names:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def freed(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now; it does so once its garbage collector has seen that nothing needs them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def held_out(doc_id: Column | str, modulus: int, remainder: int) -> Column:
    """crc32 of doc_id as text mod modulus is remainder; a null doc_id counts as the text ''."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % modulus) == remainder


def row_key(doc_id: str, text: str) -> Column:
    """Identifies a row's content: rows of equal id and text share it, and share every result."""
    return F.struct(F.col(doc_id), F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull()))


_resident: dict[tuple, Any] = {}


def resident(key: tuple, make: Callable[[], Any]) -> Any:
    """What an operator keeps in a worker from task to task, made where the worker holds none or another's."""
    if key not in _resident:
        release()
        _resident[key] = make()
    return _resident[key]


def release() -> None:
    """Give back the memory of what the worker keeps; a worker is used by one operator after another."""
    if _resident:
        for held in _resident.values():
            held.close()
        _resident.clear()
        gc.collect()
        trimmed()


def trimmed() -> None:
    """Give back to the system what the worker has freed; allocators keep it, and workers wait beside others that work."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES, keep: bool = False) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most limit bytes of text, or one row; keep: the operator has something resident."""
    if not keep:
        release()
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        begin, held = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if held and held + n > limit:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += n
        if begin < len(lengths):
            yield batch.slice(begin)
    if not keep:
        batch = None
        trimmed()


#: Pieces that arrays are cut into for sums over all tasks, and arrays that one task of a level adds up.
PIECES, FAN_IN = 16, 32


def array_sums(rows: DataFrame, kinds: list[type], combine: Callable[[list[np.ndarray]], list[np.ndarray]] = lambda x: x) -> list[np.ndarray]:
    """Sums of arrays that rows hold as bytes, a column each of kinds; summed piece by piece in a tree.

    combine maps a row's arrays, cut to a piece, to the arrays that are summed. A task of a level reads
    FAN_IN arrays' pieces at most, whatever the number of rows' partitions; the driver gets each sum
    once, in pieces.
    """

    def pieces(part: int, given: Iterator[tuple]) -> Iterator[tuple[tuple[int, int], list[np.ndarray]]]:
        release()
        for row in given:
            arrays = [np.frombuffer(x, k).reshape(PIECES, -1) for x, k in zip(row, kinds, strict=True)]
            for i in range(PIECES):
                yield (i, part), combine([a[i] for a in arrays])

    def add(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
        return [x + y for x, y in zip(a, b, strict=True)]

    left = rows.rdd
    n, left = left.getNumPartitions(), left.mapPartitionsWithIndex(pieces)
    while True:
        n = -(-n // FAN_IN)
        left = left.map(lambda x: ((x[0][0], x[0][1] // FAN_IN), x[1])).reduceByKey(add, PIECES * n)
        if n <= 1:
            break
    found = {i: v for (i, _), v in left.collect()}
    return [np.concatenate(x) for x in zip(*(found[i] for i in range(PIECES)), strict=True)] if found else []
