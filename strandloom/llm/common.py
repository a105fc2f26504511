"""Helpers shared by the corpus operators: the shared work folder, staged tables and bounded text blocks."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.workers import importable
from strandloom.sources.files import Folder

#: Text handled at once inside a Python worker; bounds its memory whatever the Arrow batch holds.
BLOCK_BYTES = 1 << 20
_STAGED: list[str] = []


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Only where that setting is absent (tests on one machine) a temporary folder is made and kept for the session.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="strandloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def staged(df: DataFrame, name: str, slim: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back, which cuts its lineage and survives lost executors.

    A slim table, of a few numbers a row, is made by an eighth of the shuffle's tasks, as its partitions are small.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/strandloom/{name}-{uuid.uuid4().hex}"
    if slim:
        df = df.coalesce(max(2, shuffle_width(spark) // 8))
    df.write.parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release_staged(spark: SparkSession) -> int:
    """Delete the tables staged so far in this process, once nothing reads them any more. Returns how many there were."""
    paths, _STAGED[:] = list(_STAGED), []
    for path in paths:
        Folder(spark, path).delete()
    return len(paths)


def bounded(df: DataFrame) -> DataFrame:
    """df, with small Arrow batches in its session where it has left the default: texts are long, and a worker and its JVM hold whole batches."""
    importable(df.sparkSession)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if df.sparkSession.conf.get(key) == "10000":
        df.sparkSession.conf.set(key, "1000")
    return df


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def crc_of_id(column: str):
    """crc32 of an id's decimal text, which decides the folds."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def hash_share(column: str, seed: int):
    """A stable number in [0, 1) from an id."""
    return F.pmod(F.xxhash64(F.col(column), F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def give_back() -> None:
    """Return freed memory to the system where the C library can: a worker outlives its tasks and counts with its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def row_blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the given text or binary column holds about limit bytes in each (a longer row is alone).

    Memory that the last batches left free goes back to the system with the end of the batches.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        begin, held = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if held and held + n > limit:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += n
        yield batch.slice(begin)
        del batch
        pa.default_memory_pool().release_unused()
    give_back()


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices starts[i], starts[i]+1, ... counts[i] of them, for all i in turn."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total, dtype=np.int64)
