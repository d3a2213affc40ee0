"""Tables between jobs, in the folder that every executor shares."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset, below the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and read it back: cuts lineage, and a lost executor costs a re-read."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_file(folder: str, name: str, data: bytes) -> None:
    """In a task: write under the attempt's name, then rename; readers see whole files, whoever wrote them last."""
    store, path = pafs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    own = f"{path}/.{name}-{TaskContext.get().taskAttemptId()}"
    with store.open_output_stream(own) as out:
        out.write(data)
    store.move(own, f"{path}/{name}")


def read_file(folder: str, name: str) -> bytes:
    store, path = pafs.FileSystem.from_uri(folder)
    with store.open_input_stream(f"{path}/{name}") as f:
        return f.read()


def parts_for(spark: SparkSession, rows: int, per_part: int, least: int | None = None) -> int:
    """Partition count for so many rows; at least the session's shuffle partitions."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions")) if least is None else least
    return max(least, -(-rows // per_part))


def small_batches(spark: SparkSession, rows: int = 1_000, size: int = 8 << 20) -> None:
    """Arrow batches of few rows and bytes, as texts may be very long; smaller settings of the session stay."""
    for key, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{key}"
        now = int(str(spark.conf.get(key)).rstrip("b"))
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


# Numbers of the C library's options: blocks mapped on their own from this size, free space kept at the top; fixed values.
_MMAP_THRESHOLD, _TRIM_THRESHOLD = -3, -1
_MAPPED_BYTES = 1 << 20
_LIBRARY: list = []
#: Memos that operators keep in a worker from task to task; a worker outlives queries and stages.
MEMOS: list[dict] = []


def lean_memory() -> None:
    """In a worker: let Arrow allocate like everything else, so that what a batch used goes back to the system."""
    pa.set_memory_pool(pa.system_memory_pool())


def spare_memory(own: dict | None = None) -> None:
    """In a worker, where memory is shorter than time: like :func:`lean_memory`; large blocks are mapped on their own, and
    what earlier groups or tasks of this process freed goes back to the system, if the C library has calls for it.
    Memos of operators that ran here before go too, but for ``own``."""
    lean_memory()
    for memo in MEMOS:
        if memo is not own:
            memo.clear()
    if not _LIBRARY:
        _LIBRARY.append(ctypes.CDLL(None))
        if hasattr(_LIBRARY[0], "mallopt"):
            _LIBRARY[0].mallopt(_MMAP_THRESHOLD, _MAPPED_BYTES)
            _LIBRARY[0].mallopt(_TRIM_THRESHOLD, _MAPPED_BYTES)
    if hasattr(_LIBRARY[0], "malloc_trim"):
        _LIBRARY[0].malloc_trim(0)


def slices(batches: Iterable[pa.RecordBatch], column: int, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """In a worker: the same rows in slices of at most ``limit`` bytes of a text column; a longer text comes alone."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right"))
            stop = max(stop, at + 1)
            yield batch.slice(at, stop - at)
            at = stop
