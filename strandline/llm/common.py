"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import ctypes
import gc
import string
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the query contracts.
SPACE = " \t\n\x0b\f\r"  # [\x20\x09-\x0D]
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_own_dir: str | None = None
_held: tuple[Any, Any] = (None, None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir). Where it is unset, a folder of this machine if
    driver and executors are one process, as in tests; on a cluster that would lose rows, so it is an error there."""
    global _own_dir
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    if _own_dir is None:
        _own_dir = "file://" + tempfile.mkdtemp(prefix="strandline-")
    return _own_dir


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written[path] = spark
    return path


_written: dict[str, SparkSession] = {}


def clean(spark: SparkSession, since: int = 0, but: tuple[str, ...] = ()) -> None:
    """Delete what cut() and new_path() wrote for this session, from the since-th path on; only when no frame that is
    still to be computed reads it. What is left is deleted when the driver ends."""
    for path in list(_written)[since:]:
        if path not in but and _written[path] is spark:
            delete(spark, path)


@atexit.register
def _clean_all() -> None:
    for spark in {id(s): s for s in _written.values()}.values():
        try:
            if not spark._jsc.sc().isStopped():
                clean(spark)
        except Exception:  # noqa: BLE001, PERF203 - the session may end before the process does
            return


def written() -> int:
    """How many paths were written so far, for clean()."""
    return len(_written)


def cut(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._strandline_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what cut() wrote for df; only for frames that no returned plan reads."""
    path = getattr(df, "_strandline_path", None)
    if path:
        delete(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that are no longer in use: it does so when the driver collects garbage,
    which by itself may come long after."""
    gc.collect()
    spark._jvm.System.gc()


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    _written.pop(path, None)


def column_of(column: str) -> Column:
    """The column of that name, whatever characters it has."""
    return F.col("`" + column.replace("`", "``") + "`")


def passed(columns: Iterable[str], new: Iterable[str]) -> dict[str, str]:
    """Name in the result of every column that passes through: its own, with as many underscores behind it as make it
    differ from the new columns and from the other ones (upper and lower case are the same to Spark)."""
    columns = list(columns)
    taken = {c.lower() for c in new}
    out = {}
    for c in columns:
        out[c] = c
        if c.lower() in taken:
            while out[c].lower() in taken | {x.lower() for x in columns}:
                out[c] += "_"
        taken.add(out[c].lower())
    return out


def held(key: Any, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task: that of one operator at a time, so that stages which run in the same
    workers never add up."""
    global _held
    if _held[0] != key:
        _held = (None, None)
        trim()
        _held = (key, make())
    return _held[1]


def trim() -> None:
    """Give memory that is free back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run as the function of a task that leaves no free memory behind in its worker."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        trim()

    return task


def slices(texts: pa.Array, rows: int, octets: int) -> Iterator[tuple[int, int]]:
    """(start, number) of pieces of a text or binary column of at most `rows` rows and about `octets` bytes, a row at least."""
    ends = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).cumsum(dtype="int64")
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, min(start + rows, int(ends.searchsorted(before + octets, "right"))))
        yield start, stop - start
        start = stop


def ascii_lower(x: Column) -> Column:
    """A-Z to a-z and nothing else. lower() agrees on ASCII text and is much faster there."""
    return F.when(F.length(x) == F.octet_length(x), F.lower(x)).otherwise(
        F.translate(x, string.ascii_uppercase, string.ascii_lowercase)
    )


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys in batches sorted by keys, each as one table. Holds one group and one batch at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
        rows = list(zip(*cols, strict=True))
        start = 0
        for i in range(n):
            if rows[i] != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, rows[i]
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
