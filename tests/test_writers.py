"""Files of recordings: round trips, names, failed and repeated jobs."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strandline.sources import readers, writers

CUES = "rec string, position int, word string, start double, end double, aya int, sura int, is_repeat boolean"


@pytest.fixture(scope="module")
def cues(spark):
    names = ["001", "a/b", "_c", ".d", "e f+g%20", "ü"]
    rows = [(n, k, f"w{k}", k * 1.5, k * 1.5 + 1, k % 3, 1, k % 2 == 1) for i, n in enumerate(names) for k in range(3 + 40 * i)]
    return spark.createDataFrame(rows, CUES).repartition(7, "word")


def seen(folder):
    return sorted(p.name for p in Path(folder).iterdir())


def test_srt_round_trip(spark, cues, tmp_path):
    where = tmp_path / "srt"
    writers.write_srt(cues, f"file://{where}")
    assert seen(where) == sorted(["001.srt", "a%2Fb.srt", "%5Fc.srt", "%2Ed.srt", "e f%2Bg%2520.srt", "%C3%BC.srt"])
    assert (where / "001.srt").read_text().startswith("1\n00:00:00,000 --> 00:00:01,000\nw0\n\n2\n00:00:01,500 --> 00:00:02,500\nw1 [repeat]\n")
    got = readers.parse_srt(writers.read_files(spark, f"file://{where}", ".srt"))
    want = cues.select("rec", F.col("position").alias("cue_no"), "start", "end", F.concat("word", F.when(F.col("is_repeat"), " [repeat]").otherwise("")).alias("word"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_json_round_trip(spark, cues, tmp_path):
    where = str(tmp_path / "json")
    columns = ["word", "start", "end", "aya", "sura", "is_repeat"]
    writers.write_json(cues, where, columns)
    got = readers.parse_records(writers.read_files(spark, where, ".json")).select("rec", "cue_no", *columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, cues.select("rec", "position", *columns).collect()))


def test_a_failed_task_leaves_no_file(spark, cues, tmp_path):
    where = tmp_path / "failed"
    bad = cues.withColumn("word", F.when((F.col("rec") == "ü") & (F.col("position") == 150), F.raise_error(F.lit("broken"))).otherwise(F.col("word")))
    with pytest.raises(Exception, match="broken"):
        writers.write_srt(bad, str(where))
    assert not where.exists() or seen(where) == []


def test_a_recording_without_a_name_is_an_error(spark, cues, tmp_path):
    where = tmp_path / "unnamed"
    with pytest.raises(Exception, match="must not be null"):
        writers.write_srt(cues.withColumn("rec", F.when(F.col("rec") != "001", F.col("rec"))), str(where))
    assert seen(where) == []


def test_files_that_exist(spark, cues, tmp_path):
    where = tmp_path / "twice"
    one, other = cues.filter("rec = '001'"), cues.filter("rec IN ('001', '_c')").withColumn("word", F.lit("new"))
    writers.write_srt(one, str(where))
    before = (where / "001.srt").read_text()
    with pytest.raises(Exception, match="files exist"):
        writers.write_srt(other, str(where))
    assert seen(where) == ["001.srt"] and (where / "001.srt").read_text() == before
    writers.write_srt(other, str(where), overwrite=True)
    assert seen(where) == ["%5Fc.srt", "001.srt"] and "new" in (where / "001.srt").read_text()


def test_a_recording_in_two_tasks_is_an_error(spark, cues, tmp_path):
    where = tmp_path / "split"
    spark.dataSource.register(writers.RecordingFiles)
    rows = cues.filter("rec = 'ü'").repartition(3).select("rec", F.col("word").alias("part"))
    with pytest.raises(Exception, match="two tasks"):
        rows.write.format(writers.FORMAT).mode("append").options(path=str(where), suffix=".txt").save()
    assert seen(where) == []


def test_no_recordings(spark, cues, tmp_path):
    writers.write_json(cues.filter("false"), str(tmp_path / "none"), ["word"])
    assert seen(tmp_path / "none") == []
