"""Log-mel features: counts, bins of tones, blocks."""

import numpy as np

from strandline.operators import features


def test_counts():
    assert features.frame_count(0, 0.0) == 0 and features.frame_count(400, 0.0) == 1 and features.frame_count(560, 0.0) == 2
    assert features.log_mel(np.zeros(16000)).shape == (features.frame_count(16000), 80)


def test_tones_peak_in_their_bin():
    weights = features.mel_weights()
    for hz in (300, 1000, 3000):
        got = features.log_mel(np.sin(2 * np.pi * hz * np.arange(16000) / 16000), 0.0)
        want = int(weights[round(hz * 512 / 16000)].argmax())
        assert abs(int(np.bincount(got.argmax(1)).argmax()) - want) <= 1


def test_features_of_recordings(spark):
    df = spark.createDataFrame([("a", [0.1] * 800), ("b", [])], "rec string, pcm array<float>")
    got = features.features(df, tail_sec=0.0).collect()
    assert [(r["rec"], r["t"], len(r["feat"])) for r in sorted(got, key=lambda r: r["t"])] == [("a", 0, 80), ("a", 1, 80), ("a", 2, 80)]


def test_blocks_change_nothing(monkeypatch):
    x = np.random.default_rng(0).normal(size=16000)
    whole = features.log_mel(x)
    monkeypatch.setattr(features, "BLOCK", 7)
    assert np.array_equal(features.log_mel(x), whole)
