"""A sink of one file a recording: subtitles, records as JSON, or any text that is parts joined between a head and a tail.

Spark deals the parts to tasks by recording and sorts them; a task writes its recordings one after the other, part by part,
so it holds one part at a time. It writes into a folder of its own attempt, and only when every task has succeeded are the
files moved, each in one step, to their names. A job that fails, or an attempt whose executor is lost, leaves none.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from strandline.operators import cues as cue_tables
from strandline.sources.shared import opened

FORMAT = "strandline_files"


def file_name(rec: Any, suffix: str) -> str:
    """A name that keeps different recordings apart and that Spark's readers do not take for a hidden file."""
    name = quote(str(rec), safe=" ")
    return (f"%{ord(name[0]):02X}{name[1:]}" if name[:1] in ("_", ".") else name) + suffix


@dataclass
class Written(WriterCommitMessage):
    """All that goes to the driver of a task: the folder of the attempt that counts."""

    folder: str


class Writer(DataSourceWriter):
    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.url, self.overwrite = options["path"], overwrite
        self.suffix, self.head, self.between, self.tail = (options.get(k, "") for k in ("suffix", "head", "between", "tail"))
        self.job = f"_job-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Written:
        system, path = opened(self.url)
        folder = f"{path}/{self.job}/{uuid.uuid4().hex}"
        system.create_dir(folder, recursive=True)
        out, current, finished = None, None, set()
        try:
            for rec, part in ((r["rec"], r["part"]) for r in iterator):
                if rec is None or part is None:
                    raise ValueError("recordings and parts of files must not be null")
                if out is None or rec != current:
                    if out is not None:
                        out.write(self.tail.encode())
                        out.close()
                    name = file_name(rec, self.suffix)
                    if name in finished:
                        raise ValueError(f"the parts of {rec} do not follow one another")
                    finished.add(name)
                    out, current = system.open_output_stream(f"{folder}/{name}", compression=None), rec
                    out.write((self.head + part).encode())
                else:
                    out.write((self.between + part).encode())
            if out is not None:
                out.write(self.tail.encode())
        finally:
            if out is not None:
                out.close()
        return Written(folder)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Checks all names before the first file is moved. Moves are done here, as Spark's own committer does them."""
        system, path = opened(self.url)
        files = [f for m in messages if m is not None for f in system.get_file_info(fs.FileSelector(m.folder))]
        names = {f.base_name for f in files}
        there = set() if self.overwrite else {f.base_name for f in system.get_file_info(fs.FileSelector(path)) if f.is_file}
        wrong = "a recording was written by two tasks" if len(names) < len(files) else f"files exist: {sorted(names & there)[:5]}" if names & there else ""
        if not wrong:
            for f in files:
                system.move(f.path, f"{path}/{f.base_name}")
        self.clear(system, path)
        if wrong:
            raise ValueError(wrong)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self.clear(*opened(self.url))

    def clear(self, system: fs.FileSystem, path: str) -> None:
        if system.get_file_info(f"{path}/{self.job}").type == fs.FileType.Directory:
            system.delete_dir(f"{path}/{self.job}")


class RecordingFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(dict(self.options), overwrite)


def write_files(parts: DataFrame, path: str, order: str, suffix: str, head: str = "", between: str = "", tail: str = "", overwrite: bool = False) -> None:
    """One file a recording of parts (rec, part and the column that orders them), below `path`. Files that exist under the
    name of a recording written are an error, or replaced with overwrite; all other files stay. Recordings without a part
    get no file. `path` is any URL that pyarrow's file systems open, on storage that driver and executors share."""
    parts.sparkSession.dataSource.register(RecordingFiles)
    rows = parts.repartition("rec").sortWithinPartitions("rec", order).select("rec", F.col("part").cast("string").alias("part"))
    options = {"path": path, "suffix": suffix, "head": head, "between": between, "tail": tail}
    rows.write.format(FORMAT).mode("overwrite" if overwrite else "append").options(**options).save()


def write_srt(cues: DataFrame, path: str, keep_preamble: bool = True, overwrite: bool = False) -> None:
    """`<rec>.srt` of clamped cues (rec, position, word, start, end, is_repeat)."""
    blocks = cue_tables.srt_blocks(cues, keep_preamble).withColumnRenamed("block", "part")
    write_files(blocks, path, "index", ".srt", between="\n", overwrite=overwrite)


def write_json(cues: DataFrame, path: str, columns: list[str], overwrite: bool = False) -> None:
    """`<rec>.json`, a list of the records of cues (rec, position and the columns), infinite scores as null."""
    records = cue_tables.json_records(cues, columns).withColumnRenamed("json", "part")
    write_files(records, path, "position", ".json", head="[\n", between=",\n", tail="\n]\n", overwrite=overwrite)


def read_files(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """rec (the recording's name as text) and value of such files, for readers.parse_srt and readers.parse_records."""
    files = spark.read.option("pathGlobFilter", f"*{suffix}").text(path, wholetext=True)
    # a path holds the name quoted twice: by file_name and by Spark
    name = F.url_decode(F.replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), F.lit("+"), F.lit("%2B")))
    return files.select(F.url_decode(F.substring(name, F.lit(1), F.length(name) - len(suffix))).alias("rec"), "value")
