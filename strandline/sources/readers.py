"""Sources. Everything is read by Spark's readers, so any store that Spark knows will do."""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RECORD_SCHEMA = """
word string, text string, start double, start_sec double, start_time_sec double, end double, end_sec double, end_time_sec double,
aya int, ayah int, sura int, surah int, is_repeat boolean
"""
#: Recordings whose last time is over this are in milliseconds in the layout by verses.
MILLISECONDS_OVER = 1000


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """token, id of lines `token id`; the token may hold spaces, blank lines are skipped."""
    return parse_vocabulary(spark.read.text(path))


def parse_vocabulary(lines: DataFrame) -> DataFrame:
    rows = lines.filter(F.trim("value") != "")
    pattern = r"^(.*) (\d+)\s*$"
    return rows.select(F.regexp_extract("value", pattern, 1).alias("token"), F.regexp_extract("value", pattern, 2).try_cast("int").alias("id"))


def longest_token(vocabulary: DataFrame, blank: str = "<blank>") -> int:
    return vocabulary.filter(F.col("token") != blank).agg(F.max(F.length("token"))).first()[0] or 0


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """slug, name, surahs (map of surah to url) of any of the layouts: {verified: [...]}, a bare list, surahs as a list of
    {surah, mp3_url}, values as plain strings or structs."""
    text = spark.read.text(path, wholetext=True)
    head = F.ltrim("value")
    items = F.when(head.startswith("["), head).otherwise(F.get_json_object("value", "$.verified"))
    rows = text.select(F.explode(F.from_json(items, "array<string>")).alias("item"))
    surahs = F.get_json_object("item", "$.surahs")
    listed = F.from_json(surahs, "array<struct<surah:int,mp3_url:string>>")
    by_list = F.map_from_entries(F.transform(F.filter(listed, lambda x: x["mp3_url"].isNotNull()), lambda x: F.struct(x["surah"].cast("string"), x["mp3_url"])))
    plain = F.from_json(surahs, "map<string,string>")
    urls = F.transform_values(plain, lambda k, v: F.when(v.startswith("{"), F.get_json_object(v, "$.mp3_url")).otherwise(v))
    by_map = F.map_filter(urls, lambda k, v: v.isNotNull())
    return rows.select(
        F.get_json_object("item", "$.slug").alias("slug"),
        F.get_json_object("item", "$.name").alias("name"),
        F.when(F.ltrim(surahs).startswith("["), by_list).otherwise(by_map).alias("surahs"),
    )


def url_map(spark: SparkSession, path: str) -> DataFrame:
    """surah, url of a flat map."""
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("surah", "url"))
    return rows.select(F.col("surah").cast("int").alias("surah"), "url").filter("url IS NOT NULL")


def parse_srt(files: DataFrame) -> DataFrame:
    """rec, cue_no, start, end, word of files (rec, value): blocks parted by blank lines; those without a time line are skipped."""
    time = r"(\d+):(\d+):(\d+)[,.](\d+)\s*-->\s*(\d+):(\d+):(\d+)[,.](\d+)"
    blocks = files.select("rec", F.posexplode(F.split(F.regexp_replace(F.trim("value"), "\r\n?", "\n"), r"\n\s*\n")).alias("n", "block"))
    blocks = blocks.filter(F.col("block").rlike(time))

    def seconds(first: int):
        h, m, s, ms = (F.regexp_extract("block", time, first + k).cast("double") for k in range(4))
        return h * 3600 + m * 60 + s + ms / 1000

    lines = F.split("block", "\n")
    row = F.array_position(F.transform(lines, lambda x: x.rlike(time)), True)
    word = F.trim(F.array_join(F.slice(lines, row + 1, F.greatest(F.size(lines) - row.cast("int"), F.lit(0))), " "))
    got = blocks.select("rec", "n", seconds(1).alias("start"), seconds(5).alias("end"), word.alias("word"))
    return got.select("rec", (F.row_number().over(Window.partitionBy("rec").orderBy("n")) - 1).alias("cue_no"), "start", "end", "word")


def normalize_records(rows: DataFrame) -> DataFrame:
    """word, start, end, aya, sura, is_repeat of rows under any of their aliases; blank words go; a missing end is start + 0.5."""
    have = set(rows.columns)

    def first(*names: str, default=None):
        return F.coalesce(*[F.col(n) for n in names if n in have], F.lit(default))

    start = first("start_time_sec", "start_sec", "start", default=0.0)
    other = [c for c in rows.columns if c in ("rec", "cue_no")]
    out = rows.select(
        *other,
        F.trim(first("word", "text", default="")).alias("word"),
        start.alias("start"),
        F.coalesce(first("end_time_sec", "end_sec", "end"), start + 0.5).alias("end"),
        first("aya", "ayah").alias("aya"),
        first("sura", "surah").alias("sura"),
        first("is_repeat", default=False).alias("is_repeat"),
    )
    return out.filter(F.length("word") > 0)


def parse_records(files: DataFrame) -> DataFrame:
    """rec, cue_no and the fields of normalize_records of JSON files (rec, value) in three layouts: a list, {records} or
    {cues}, and {verses: [{words}]} with the rule that times over 1000 are milliseconds."""
    head = F.ltrim("value")
    flat = F.when(head.startswith("["), head).otherwise(F.coalesce(F.get_json_object("value", "$.records"), F.get_json_object("value", "$.cues")))
    item = f"array<struct<{', '.join(':'.join(f.split()) for f in RECORD_SCHEMA.replace(chr(10), ' ').split(',') if f.strip())}>>"
    verses = F.flatten(F.transform(F.from_json(F.get_json_object("value", "$.verses"), f"array<struct<words:{item}>>"), lambda v: v["words"]))
    rows = files.select("rec", flat.isNull().alias("by_verse"), F.posexplode(F.coalesce(F.from_json(flat, item), verses)).alias("cue_no", "r"))
    rows = rows.select("rec", "by_verse", "cue_no", "r.*")
    times = ["start", "start_sec", "start_time_sec", "end", "end_sec", "end_time_sec"]
    scale = F.when(F.col("by_verse") & (F.max(F.coalesce("end_time_sec", "end_sec", "end")).over(Window.partitionBy("rec")) > MILLISECONDS_OVER), 1000.0).otherwise(1.0)
    return normalize_records(rows.withColumn("scale", scale).withColumns({t: F.col(t) / F.col("scale") for t in times}))


def decode_wav(data: bytes) -> tuple[int, np.ndarray] | None:
    """Rate and mono samples in [-1, 1] of 16-bit integer or 32-bit float WAVE bytes; channels are averaged; else None."""
    try:
        with wave.open(io.BytesIO(data)) as w:
            if w.getsampwidth() != 2:
                return None
            x = np.frombuffer(w.readframes(w.getnframes()), "<i2").astype(np.float32) / 32768
            rate, channels = w.getframerate(), w.getnchannels()
    except (wave.Error, EOFError):
        at, size, form = 12, 0, None
        while at + 8 <= len(data) and data[:4] == b"RIFF":
            name, size = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
            if name == b"fmt ":
                form = (int.from_bytes(data[at + 8 : at + 10], "little"), int.from_bytes(data[at + 10 : at + 12], "little"), int.from_bytes(data[at + 12 : at + 16], "little"))
            if name == b"data":
                break
            at += 8 + size + size % 2
        if form is None or form[0] != 3:
            return None
        x = np.frombuffer(data[at + 8 : at + 8 + size // 4 * 4], "<f4")
        channels, rate = form[1], form[2]
    return rate, x.reshape(-1, channels).mean(1) if channels > 1 else x


def wav_files(spark: SparkSession, path: str, rate: int = 16000) -> DataFrame:
    """path, pcm of the WAVE files at `rate` below path; others have a null pcm: a decoder for them plugs in here."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [decode_wav(bytes(c)) for c in pdf["content"]]
            yield pd.DataFrame({"path": pdf["path"], "pcm": [g[1].tolist() if g and g[0] == rate else None for g in got]})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(run, "path string, pcm array<float>")
