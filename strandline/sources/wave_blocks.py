"""WAVE files by ranges of their samples: a long recording is many rows, dealt to many tasks.

Spark lists the files without reading them. Tasks read their headers, then ranges, each with some samples beyond its end, so
that whoever cuts frames needs no neighbouring row: `features.features_of_blocks` and `signal.energies_of_blocks` give what
the whole recording gives. Nothing is read twice but those few samples, and a lost task reads its ranges again.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import NativeFile
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.sources.shared import opened

BLOCK_SEC = 60
#: Blocks a task reads on average.
BLOCKS_A_TASK = 8
PCM, FLOAT, EXTENSIBLE = 1, 3, 0xFFFE


class Sound(NamedTuple):
    rate: int
    channels: int
    width: int
    data_at: int
    samples: int


def header(file: NativeFile, length: int) -> Sound | None:
    """What a WAVE file of 16-bit integers or 32-bit floats holds, and where; None for other files. Data that the file was
    cut short of do not count."""
    file.seek(0)
    head = file.read(12)
    if head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        return None
    at, form = 12, None
    while at + 8 <= length:
        file.seek(at)
        name, size = (lead := file.read(8))[:4], int.from_bytes(lead[4:], "little")
        if name == b"fmt ":
            fmt = file.read(min(size, 40))
            kind, channels, rate, bits = (int.from_bytes(fmt[a:b], "little") for a, b in ((0, 2), (2, 4), (4, 8), (14, 16)))
            form = (int.from_bytes(fmt[24:26], "little") if kind == EXTENSIBLE else kind, bits, channels, rate)
        if name == b"data":
            if form is None or form[:2] not in ((PCM, 16), (FLOAT, 32)) or not form[2]:
                return None
            width = form[1] // 8
            return Sound(form[3], form[2], width, at + 8, min(size, length - at - 8) // (width * form[2]))
        at += 8 + size + size % 2
    return None


def decode(data: bytes, width: int, channels: int) -> np.ndarray:
    """Samples in [-1, 1], the mean of the channels."""
    x = np.frombuffer(data, "<i2").astype(np.float32) / 32768 if width == 2 else np.frombuffer(data, "<f4")
    return x.reshape(-1, channels).mean(1) if channels > 1 else x


def _headers(files: DataFrame, rate: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, local = opened(path)
                with system.open_input_file(local) as file:
                    found = header(file, length)
                rows.append({"path": path} | (found._asdict() if found and found.rate == rate else {}))
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("path", pa.string()), *((n, pa.int64()) for n in ("channels", "width", "data_at", "samples"))]))

    return files.select("path", "length").mapInArrow(run, "path string, channels long, width long, data_at long, samples long")


def wav_blocks(spark: SparkSession, path: str, rate: int = 16000, block_sec: float = BLOCK_SEC, after: int = 0, blocks_a_task: int = BLOCKS_A_TASK) -> DataFrame:
    """rec (the file's path), first, count, total, pcm of the WAVE files at `rate` below path: a block's own samples are
    first to first + count of total; pcm holds them and, where the recording goes on, up to `after` more. Files of another
    rate or kind have one row with nulls; one without samples has one of an empty block. block_sec is a whole number of
    hundredths of a second, so frames every 10 ms start in step with blocks."""
    block = round(block_sec * 100) * (rate // 100)
    if block <= 0 or rate % 100 or after < 0:
        raise ValueError("blocks are whole hundredths of a second of a rate that is a multiple of 100")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    found = _headers(files, rate)
    blocks = found.agg(F.sum(F.greatest(F.ceil(F.col("samples") / block), F.lit(1)))).first()[0] or 1
    starts = F.when(F.col("samples") > 0, F.sequence(F.lit(0).cast("long"), F.col("samples") - 1, F.lit(block).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    ranges = found.withColumn("first", F.explode(starts)).withColumn("count", F.least(F.lit(block), F.col("samples") - F.col("first")))
    ranges = ranges.withColumn("first", F.when(F.col("samples").isNotNull(), F.col("first"))).withColumn("count", F.when(F.col("samples").isNotNull(), F.col("count")))
    ranges = ranges.select("path", "channels", "width", "data_at", "samples", "first", "count").repartition(ceil(blocks / blocks_a_task))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, channels, width, data_at, samples, first, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pcm = None
                if samples is not None:
                    system, local = opened(name)
                    with system.open_input_file(local) as file:
                        file.seek(data_at + first * width * channels)
                        pcm = decode(file.read((min(first + count + after, samples) - first) * width * channels), width, channels)
                lists = pa.array([None], pa.list_(pa.float32())) if pcm is None else pa.ListArray.from_arrays(pa.array([0, len(pcm)], pa.int32()), pa.array(pcm, pa.float32()))
                own = [pa.array([name]), *(pa.array([v], pa.int64()) for v in (first, count, samples))]
                yield pa.RecordBatch.from_arrays([*own, lists], names=["rec", "first", "count", "total", "pcm"])

    return ranges.mapInArrow(run, "rec string, first long, count long, total long, pcm array<float>")
