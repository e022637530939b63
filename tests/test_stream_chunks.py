"""Chunk framing as a running stream: restarted from its checkpoint, ended by a row or by a time without frames."""

import time

import numpy as np
import pytest

from strandline.streaming import chunks

SCHEMA = "rec string, t long, feat array<double>, last boolean"


def model(window, cache):
    """Means of pieces, and how many windows came before: the cache has to survive a restart."""
    seen = cache or 0
    return np.array([[*p.mean(0), seen] for p in np.array_split(window, 4)]), seen + 1


def whole(feats, window=12, hop=8):
    out, *_ = chunks.advance(feats, 0, None, model, window, hop, True)
    return np.concatenate(out)


@pytest.fixture
def parts(spark, tmp_path):
    rng = np.random.default_rng(3)
    recs = {"a": rng.normal(size=(50, 3)), "b": rng.normal(size=(5, 3)), "c": rng.normal(size=(12, 3))}

    def write(lo, hi, last=True):
        rows = [(r, t, x[t].tolist(), last and t == len(x) - 1) for r, x in recs.items() for t in range(lo, min(hi, len(x)))]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    return recs, write


def start(spark, tmp_path, idle_ms=None, **trigger):
    chunks.state_in_rocksdb(spark)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = chunks.frame_chunks(stream, model, 12, 8, idle_ms).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
    return out.outputMode("append").trigger(**trigger).start()


def result(spark, tmp_path):
    got = {}
    for r in spark.read.parquet(str(tmp_path / "out")).orderBy("rec", "chunk", "row").collect():
        got.setdefault(r["rec"], []).append(r["out"])
    return {r: np.array(x) for r, x in got.items()}


def same(got, recs):
    assert set(got) == set(recs)
    for r, x in recs.items():
        np.testing.assert_allclose(got[r], whole(x))


def test_restarted_stream_equals_batch(spark, tmp_path, parts):
    recs, write = parts
    for lo, hi in ((0, 17), (17, 30), (30, 60)):
        write(lo, hi)
        start(spark, tmp_path, availableNow=True).awaitTermination()  # a new query each time, from the checkpoint
    same(result(spark, tmp_path), recs)
    rows = [(r, t, x[t].tolist(), t == len(x) - 1) for r, x in recs.items() for t in range(len(x))]
    batch = chunks.frame_chunks(spark.createDataFrame(rows, SCHEMA), model, 12, 8).collect()
    assert len(batch) == sum(map(len, result(spark, tmp_path).values()))


def test_ends_after_a_time_without_frames(spark, tmp_path, parts):
    recs, write = parts
    write(0, 60, last=False)
    query = start(spark, tmp_path, idle_ms=1500, processingTime="500 milliseconds")
    try:
        until = time.time() + 60
        while time.time() < until:
            query.processAllAvailable()
            if (tmp_path / "out").exists() and len(got := result(spark, tmp_path)) == 3 and all(len(got[r]) == len(whole(x)) for r, x in recs.items()):
                break
            time.sleep(1)
    finally:
        query.stop()
    same(result(spark, tmp_path), recs)


def test_a_gap_is_an_error(spark, parts):
    recs, _ = parts
    rows = [("a", t, recs["a"][t].tolist(), False) for t in (0, 1, 3)]
    chunks.state_in_rocksdb(spark)
    with pytest.raises(Exception, match="is the next one"):
        chunks.frame_chunks(spark.createDataFrame(rows, SCHEMA), model, 12, 8).collect()
