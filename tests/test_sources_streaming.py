"""Readers on small files, streaming forms against their batch results."""

import io
import json
import wave

import numpy as np
from pyspark.sql import functions as F

from strandline.operators import catalog, search
from strandline.sources import readers
from strandline.streaming import chunks


def test_vocabulary(spark, tmp_path):
    (tmp_path / "v.txt").write_text("<blank> 2\n\na b 0\nc 1\n", encoding="utf-8")
    got = readers.vocabulary(spark, str(tmp_path / "v.txt"))
    assert sorted(map(tuple, got.collect())) == [("<blank>", 2), ("a b", 0), ("c", 1)]
    assert readers.longest_token(got) == 3


def test_catalog_layouts(spark, tmp_path):
    items = [
        {"slug": "p", "name": "P", "surahs": {"1": "u1", "2": {"mp3_url": "u2"}, "3": {"mp3_url": None}}},
        {"slug": "q", "name": "Q", "surahs": [{"surah": 4, "mp3_url": "u4"}, {"surah": 5}]},
        {"slug": "r", "name": "R", "surahs": {}},
    ]
    for name, doc in (("a.json", {"verified": items}), ("b.json", items)):
        (tmp_path / name).write_text(json.dumps(doc, indent=1))
        got = catalog.explode_catalog(readers.catalog(spark, str(tmp_path / name)))
        assert sorted((r["slug"], r["surah"], r["url"]) for r in got.collect()) == [("p", 1, "u1"), ("p", 2, "u2"), ("q", 4, "u4")]
    (tmp_path / "c.json").write_text('{"1": "x", "2": null}')
    assert [tuple(r) for r in readers.url_map(spark, str(tmp_path / "c.json")).collect()] == [(1, "x")]


def test_srt(spark):
    text = "1\n00:00:01,000 --> 00:00:02,500\nx\n\nno time here\n\n3\n00:00:03.250 --> 00:00:04,000\ny z\n"
    got = readers.parse_srt(spark.createDataFrame([("a", text)], "rec string, value string")).orderBy("cue_no").collect()
    assert [(r["cue_no"], r["start"], r["end"], r["word"]) for r in got] == [(0, 1.0, 2.5, "x"), (1, 3.25, 4.0, "y z")]


def test_record_layouts(spark):
    docs = [
        ("list", [{"word": "a", "start_time_sec": 1.0, "end_time_sec": 2.0, "ayah": 3}, {"text": " ", "start": 2.0}]),
        ("cues", {"cues": [{"text": "b", "start": 1.5}]}),
        ("verses", {"verses": [{"words": [{"word": "c", "start": 1000, "end": 2000}]}, {"words": [{"word": "d", "start": 2000, "end": 2500}]}]}),
    ]
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in docs], "rec string, value string")
    got = {(r["rec"], r["word"]): (r["start"], r["end"], r["aya"]) for r in readers.parse_records(df).collect()}
    assert got == {("list", "a"): (1.0, 2.0, 3), ("cues", "b"): (1.5, 2.0, None), ("verses", "c"): (1.0, 2.0, None), ("verses", "d"): (2.0, 2.5, None)}


def test_wav(spark, tmp_path):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(16000)
        w.writeframes(np.array([[16384, 0], [-16384, -16384]], "<i2").tobytes())
    (tmp_path / "a.wav").write_bytes(out.getvalue())
    (tmp_path / "b.wav").write_bytes(b"RIFFxxxxnothing")
    got = {r["path"].rsplit("/", 1)[1]: r["pcm"] for r in readers.wav_files(spark, str(tmp_path)).collect()}
    assert got == {"a.wav": [0.25, -0.5], "b.wav": None}


def test_advance_equals_batch():
    rng = np.random.default_rng(0)
    feats = rng.normal(size=(200, 3))
    step = chunks.mean_model(4)
    whole, *_ = chunks.advance(feats, 0, None, step, 61, 48, True)
    held, done, cache, got = np.zeros((0, 3)), 0, None, []
    for k in range(0, 200, 37):
        out, held, done, cache = chunks.advance(np.concatenate([held, feats[k : k + 37]]), done, cache, step, 61, 48, k + 37 >= 200)
        got += out
    assert np.allclose(np.concatenate(whole), np.concatenate(got)) and len(got) == 1 + -(-(200 - 61) // 48)


def test_stream_collapse(spark, tmp_path):
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 3, 60)
    for k in range(3):
        rows = [(1, t, int(ids[t])) for t in range(20 * k, 20 * k + 20)]
        spark.createDataFrame(rows, "rec long, t long, id long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("rec long, t long, id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = chunks.stream_collapse(stream, 0).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
    out.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    got = [r["id"] for r in spark.read.parquet(str(tmp_path / "out")).orderBy("t").collect()]
    assert got == search.collapse_ids(ids, 0)


def test_find_files(spark):
    files = spark.createDataFrame([(f"d/{f}", f) for f in ("001.opus", "001.mp3", "2.wav", "003_x.mp3", "3x.mp3")], "path string, file string")
    wanted = spark.createDataFrame([(k,) for k in (1, 2, 3, 4)], "surah int")
    got = dict(catalog.find_files(files, wanted).collect())
    assert got == {1: "d/001.mp3", 2: "d/2.wav", 3: "d/003_x.mp3", 4: None}


def test_markdown(spark):
    metrics = spark.createDataFrame([("a", True, 7200.0, 100.0, 5, 1), ("b", False, 0.0, 0.0, 0, 0)], "k string, ok boolean, audio double, wall double, n_words long, n_repeats long")
    text = catalog.markdown(catalog.report(metrics, "k").collect())
    assert "| a | 1 | 0 | 2.00 | 5 | 1 | 72.0x |" in text and text.strip().splitlines()[-1].startswith("| total |")
    assert metrics.select(F.count("*")).first()[0] == 2
