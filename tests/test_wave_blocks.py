"""WAVE files by ranges against whole files; frames of blocks against frames of whole recordings."""

import io
import struct
import wave

import numpy as np
import pytest

from strandline.operators import features, signal
from strandline.sources import readers, wave_blocks


def pcm16(x, channels=1, rate=16000):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.asarray(x) * 20000).astype("<i2").tobytes())
    return out.getvalue()


def float32(x, channels=2):
    data = np.asarray(x, "<f4").tobytes()
    fmt = struct.pack("<HHIIHH", 3, channels, 16000, 16000 * 4 * channels, 4 * channels, 32)
    note = b"odd"  # a chunk of odd length, padded, before the data
    body = b"WAVEfmt " + struct.pack("<I", 16) + fmt + b"LIST" + struct.pack("<I", 3) + note + b"\0" + b"data" + struct.pack("<I", len(data)) + data
    return b"RIFF" + struct.pack("<I", len(body)) + body


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    where = tmp_path_factory.mktemp("waves")
    rng = np.random.default_rng(5)
    sounds = {n: rng.normal(0, 0.2, k).clip(-1, 1) for n, k in [("long 1", 16000 * 7 + 123), ("exact", 16000 * 2), ("short", 300), ("near", 16000 * 2 + 100), ("none", 0)]}
    for name, x in sounds.items():
        (where / f"{name}.wav").write_bytes(pcm16(x))
    (where / "stereo.wav").write_bytes(pcm16(rng.normal(0, 0.2, 2 * 20001).clip(-1, 1), 2))
    (where / "float.wav").write_bytes(float32(rng.normal(0, 0.2, 2 * 17000)))
    (where / "cut short.wav").write_bytes(pcm16(sounds["long 1"])[:50001])
    (where / "slow.wav").write_bytes(pcm16(sounds["short"], rate=8000))
    (where / "other.wav").write_bytes(b"RIFFxxxxnothing")
    return where


def whole(folder):
    got = {}
    for p in folder.iterdir():
        data = p.read_bytes()
        found = readers.decode_wav(data[: len(data) - (len(data) - 44) % 2] if p.name == "cut short.wav" else data)
        if found and found[0] == 16000:
            got[p.name] = np.asarray(found[1])
    return got


def by_name(rows):
    got = {}
    for r in sorted(rows, key=lambda r: (r["rec"], r[1] or 0)):
        got.setdefault(r["rec"].rsplit("/", 1)[1], []).append(r)
    return got


@pytest.mark.parametrize("after", [0, 240, 40000])
def test_blocks_are_the_file(spark, folder, after):
    got = by_name(wave_blocks.wav_blocks(spark, str(folder), block_sec=1, after=after).collect())
    want = whole(folder)
    assert {n for n, rows in got.items() if rows[0]["pcm"] is None} == {"slow.wav", "other.wav"} and set(want) == set(got) - {"slow.wav", "other.wav"}
    for name, x in want.items():
        assert [r["first"] for r in got[name]] == list(range(0, max(len(x), 1), 16000))
        for r in got[name]:
            assert r["total"] == len(x) and r["count"] == min(16000, len(x) - r["first"])
            assert np.array_equal(np.asarray(r["pcm"], np.float32), x[r["first"] : r["first"] + r["count"] + after].astype(np.float32))


def test_a_long_recording_is_many_tasks(spark, folder):
    df = wave_blocks.wav_blocks(spark, str(folder / "long 1.wav"), block_sec=1, blocks_a_task=2)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 8


@pytest.mark.parametrize("tail", [0.0, 0.3])
def test_features_of_blocks(spark, folder, tail):
    blocks = wave_blocks.wav_blocks(spark, str(folder), block_sec=1, after=features.AFTER)
    got = by_name(features.features_of_blocks(blocks, tail).collect())
    for name, x in whole(folder).items():
        want = features.log_mel(x.astype(np.float32), tail)
        rows = got.get(name, [])
        assert [r["t"] for r in rows] == list(range(len(want)))
        assert not len(want) or np.allclose([r["feat"] for r in rows], want, atol=1e-4)
    assert not {"slow.wav", "other.wav"} & set(got)


def test_features_need_samples_beyond_a_block(spark, folder):
    with pytest.raises(Exception, match="beyond their end"):
        features.features_of_blocks(wave_blocks.wav_blocks(spark, str(folder), block_sec=1)).collect()


def test_energies_of_blocks(spark, folder):
    blocks = wave_blocks.wav_blocks(spark, str(folder), block_sec=1, after=signal.FRAME)
    got = by_name(signal.energies_of_blocks(blocks).collect())
    for name, x in whole(folder).items():
        want = signal.frame_rms(x.astype(np.float32))
        rows = got.get(name, [])
        assert [r["t"] for r in rows] == list(range(len(want)))
        assert np.allclose([r["energy"] for r in rows], want, rtol=1e-9, atol=0)
