"""Frame and cue operators on the listed small fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.functions import arrays, scalars
from strandline.operators import cues, frames, signal


def ids(spark, values, rec="a"):
    return spark.createDataFrame([(rec, t, v) for t, v in enumerate(values)], "rec string, t long, id long")


@pytest.mark.parametrize("values, want", [([1, 1, 2, 2, 2], [1, 2]), ([1, 0, 1], [1, 1]), ([1, 2], [1, 2]), ([1, 0, 0], [1]), ([0, 0], [])])
def test_collapse(spark, values, want):
    assert [r["id"] for r in frames.collapse(ids(spark, values), 0).orderBy("t").collect()] == want


@pytest.mark.parametrize("values, want", [([5, 5, 0, 7, 7, 7], [1, 1, 2, 3, 3, 3]), ([5, 0, 7], [1, 2, 3]), ([5, 0, 5], [1, 2, 3]), ([0, 0, 5], [0, 0, 1]), ([5, 0, 0], [1, 2, 2])])
def test_label_states(spark, values, want):
    assert [r["state"] for r in frames.label_states(ids(spark, values), 0).orderBy("t").collect()] == want


def test_state_spans_non_monotone(spark):
    path = ids(spark, [0, 1, 1, 0, 2, 0]).withColumnRenamed("id", "state")
    states = spark.createDataFrame([("a", k) for k in range(4)], "rec string, state long")
    got = frames.state_spans(path, states).orderBy("state").collect()
    assert [r["first_seen"] for r in got] == [0, 1, 4, -1] and [r["last_seen"] for r in got] == [5, 2, 4, -1]


def test_clamp_and_srt(spark):
    rows = [("a", 0, "x", 0.0, 0.02, False, 0), ("a", 1, "y", 0.1, 0.5, True, 1), ("a", 2, "z", 0.4, 0.3, False, 1)]
    df = spark.createDataFrame(rows, "rec string, cue_no long, word string, start double, end double, is_repeat boolean, aya int")
    got = cues.clamp(df).orderBy("position")
    assert [round(r["end"], 3) for r in got.collect()] == [0.1, 0.4, 0.55]
    blocks = [r["block"] for r in cues.srt_blocks(got, keep_preamble=False).orderBy("index").collect()]
    assert blocks == ["1\n00:00:00,100 --> 00:00:00,400\ny [repeat]\n", "2\n00:00:00,400 --> 00:00:00,550\nz\n"]


def test_json_infinities(spark):
    df = spark.createDataFrame([("a", 0, "x", float("-inf"), float("nan"))], "rec string, position int, word string, u double, v double")
    assert cues.json_records(df, ["word", "u", "v"]).first()["json"] == '{"word":"x","u":null,"v":null}'


def test_splice_sorts(spark):
    schema = "rec string, cue_no long, start_frame long, end_frame long, is_repeat boolean"
    own = spark.createDataFrame([("a", 0, 0, 3, False), ("a", 1, 4, 30, False)], schema)
    fixes = spark.createDataFrame([("a", 1, 20, 30, True, 1), ("a", 1, 4, 10, False, 1)], schema + ", replaces long")
    got = cues.splice(own, fixes).orderBy("cue_no").collect()
    assert [(r["start_frame"], r["is_repeat"]) for r in got] == [(0, False), (4, False), (20, True)]


def test_scalars(spark):
    df = spark.createDataFrame([("67-71", 3.0005, "أَإِة  ى"), (" 67, 68 ,69 ", -1.0, ""), ("5-5", 3661.0, " x ")], "spec string, s double, text string")
    got = df.select(scalars.number_list(F.col("spec")).alias("n"), scalars.srt_time(F.col("s")).alias("t"), scalars.normalize_text(F.col("text")).alias("x")).collect()
    assert [r["n"] for r in got] == [[67, 68, 69, 70, 71], [67, 68, 69], [5]]
    assert [r["t"] for r in got] == ["00:00:03,000", "00:00:00,000", "01:01:01,000"]
    assert [r["x"] for r in got] == ["ااه ي", "", "x"]
    with pytest.raises(Exception, match="reversed range"):
        df.select(scalars.number_list(F.lit("71-67"))).collect()
    assert df.select(scalars.number_list(F.lit("71-67"), strict=False).alias("n")).first()["n"] == []


def test_edit_ratio_bound(spark):
    df = spark.createDataFrame([("abcd", "ab"), ("", ""), ("kitten", "sitting")], "a string, b string")
    got = df.select(arrays.edit_ratio(F.col("a"), F.col("b")).alias("r"), arrays.bounded_edit_ratio(F.col("a"), F.col("b"), 0.6).alias("q")).collect()
    assert [round(r["r"], 4) for r in got] == [0.5, 1.0, 0.5714] and [round(r["q"], 4) for r in got] == [0.5, 1.0, 0.5714]


def tone(seconds, rate=16000):
    return np.sin(2 * np.pi * 200 * np.arange(int(seconds * rate)) / rate)


def test_silence_positions(spark):
    quiet = np.zeros(16000)
    x = np.concatenate([tone(1), quiet, tone(1), quiet, tone(1)])
    long = np.concatenate([tone(5), quiet[:8000], tone(5)])
    pcm = spark.createDataFrame([("a", x.tolist()), ("b", [0.0] * 160), ("c", long.tolist())], "rec string, pcm array<float>")
    got = [tuple(r) for r in signal.silence_positions(pcm, target_sec=5.0).collect()]
    own = [p / 16000 for r, p in got if r == "a"]
    assert own and all(0.9 <= p <= 2.1 or 2.9 <= p <= 4.1 for p in own)
    assert [round(p / 16000, 1) for r, p in got if r == "c"] == [5.0] and not any(r == "b" for r, _ in got)
    assert signal.silence_positions(pcm, target_sec=5.0, most=1).filter("rec = 'a'").count() == 1
    with pytest.raises(ValueError):
        signal.silence_positions(pcm, rate=8000)


def test_frame_rms():
    x = np.random.default_rng(0).normal(size=4321)
    starts = range(0, len(x) - 399, 160)
    assert np.allclose(signal.frame_rms(x), [np.sqrt((x[s : s + 400] ** 2).mean() + 1e-12) for s in starts])
    blocks = [min(s // 400, len(x) // 400 - 1) * 400 for s in starts]
    assert np.allclose(signal.frame_rms(x, approximate=True), [np.sqrt((x[b : b + 400] ** 2).mean() + 1e-12) for b in blocks])
    assert len(signal.frame_rms(x[:399])) == 0 and len(signal.frame_rms(x[:400], True)) == 1


def test_biquad():
    x = np.random.default_rng(1).normal(size=1000)
    for b, a in signal.K_WEIGHTING[48000]:
        want, s1, s2 = [], 0.0, 0.0
        for v in x:
            y = b[0] * v + s1
            s1, s2 = b[1] * v - a[1] * y + s2, b[2] * v - a[2] * y
            want.append(y)
        assert np.allclose(signal.biquad(x, b, a), want) and len(signal.biquad(x[:0], b, a)) == 0


def test_spaced():
    at, frames = np.array([0, 10, 12, 40]), np.array([5, 9, 8, 7])
    assert signal.spaced(at, frames, 2, 5).tolist() == [10, 40] and signal.spaced(at, frames, 4, 5).tolist() == [0, 10, 12, 40]
    assert signal.spaced(at, np.array([9, 9, 9, 9]), 3, 11).tolist() == [0, 12, 40]


def test_gated_loudness_silence(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 0.1), ("b", 1e-9)], "rec string, energy double")
    got = dict(signal.gated_loudness(df).collect())
    assert got["a"] == -70.0 and abs(got["b"] - (-0.691 - 10)) < 1e-6


def test_block_energies(spark):
    df = spark.createDataFrame([("a", tone(1).tolist()), ("b", [0.5] * 100)], "rec string, pcm array<float>")
    got = signal.block_energies(df).groupBy("rec").count().collect()
    assert {r["rec"]: r["count"] for r in got} == {"a": 7, "b": 1}
