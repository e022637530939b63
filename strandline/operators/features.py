"""Log-mel filterbank features of 16 kHz sound: 25 ms frames every 10 ms, Povey window, 80 bins, no dither.

Public Kaldi definitions: the mean of a frame is removed, then pre-emphasis 0.97, the window, a 512-point power spectrum,
triangular bins evenly spaced in mel from 20 Hz to half the rate, and the logarithm.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

RATE, LENGTH, SHIFT, BINS, FFT = 16000, 400, 160, 80, 512
TAIL_SEC = 0.3
#: Frames worked on at once: bounds the memory of a long recording.
BLOCK = 2000
#: Samples that the last frame starting in a block reads beyond it.
AFTER = LENGTH - SHIFT


def frame_count(samples: int, tail_sec: float = TAIL_SEC) -> int:
    total = samples + int(RATE * tail_sec)
    return 0 if total < LENGTH else (total - LENGTH) // SHIFT + 1


@lru_cache(1)
def mel_weights() -> np.ndarray:
    """FFT bins x mel bins."""

    def mel(f: np.ndarray | float) -> np.ndarray:
        return 1127.0 * np.log1p(np.asarray(f) / 700.0)

    edges = np.linspace(mel(20.0), mel(RATE / 2), BINS + 2)
    points = mel(np.arange(FFT // 2) * RATE / FFT)[:, None]
    left, centre, right = edges[:-2], edges[1:-1], edges[2:]
    return np.maximum(0.0, np.minimum((points - left) / (centre - left), (right - points) / (right - centre)))


def log_mel(samples: np.ndarray, tail_sec: float = TAIL_SEC) -> np.ndarray:
    """frames x BINS of one recording; `tail_sec` of silence is added at its end."""
    x = np.concatenate([np.asarray(samples, np.float64), np.zeros(int(RATE * tail_sec))])
    count = frame_count(len(samples), tail_sec)
    window = (0.5 - 0.5 * np.cos(2 * np.pi * np.arange(LENGTH) / (LENGTH - 1))) ** 0.85
    out = np.empty((count, BINS), np.float32)
    for start in range(0, count, BLOCK):
        at = np.arange(start, min(start + BLOCK, count))[:, None] * SHIFT + np.arange(LENGTH)
        frames = x[at] * 1.0
        frames -= frames.mean(1, keepdims=True)
        frames -= 0.97 * np.concatenate([frames[:, :1], frames[:, :-1]], axis=1)
        power = np.abs(np.fft.rfft(frames * window, FFT)[:, : FFT // 2]) ** 2
        out[start : start + BLOCK] = np.log(np.maximum(power @ mel_weights(), np.finfo(np.float32).eps))
    return out


def features(pcm: DataFrame, tail_sec: float = TAIL_SEC) -> DataFrame:
    """rec, t, feat of recordings (rec, pcm); a block of frames at a time leaves the task."""
    rec = pcm.schema["rec"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, x in zip(pdf["rec"], pdf["pcm"], strict=True):
                got = log_mel(np.asarray(x if x is not None else []), tail_sec)
                for start in range(0, len(got), BLOCK):
                    own = got[start : start + BLOCK]
                    yield pd.DataFrame({"rec": [name] * len(own), "t": np.arange(start, start + len(own)), "feat": list(own)})

    return pcm.select("rec", "pcm").mapInPandas(run, f"rec {rec}, t long, feat array<float>")


def features_of_blocks(blocks: DataFrame, tail_sec: float = TAIL_SEC) -> DataFrame:
    """rec, t, feat of recordings in blocks (rec, first, count, total, pcm with AFTER more samples or what there is), as
    features() gives of whole ones. A frame belongs to the block that it starts in, one in the tail to the last block."""
    rec = blocks.schema["rec"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, first, count, total, x in pdf.dropna(subset=["pcm"]).itertuples(index=False):
                first, count, total = int(first), int(count), int(total)
                end = total + int(RATE * tail_sec)
                want = end if first + count == total else min(first + count + AFTER, end)
                if first % SHIFT or first + count < total and count % SHIFT or len(x) < min(want, total) - first:
                    raise ValueError(f"{name}: blocks start at multiples of {SHIFT} and hold {AFTER} samples beyond their end")
                held = np.asarray(x, np.float64)[: want - first]
                got = log_mel(np.concatenate([held, np.zeros(want - first - len(held))]), 0.0)
                for start in range(0, len(got), BLOCK):
                    own = got[start : start + BLOCK]
                    yield pd.DataFrame({"rec": [name] * len(own), "t": np.arange(first // SHIFT + start, first // SHIFT + start + len(own)), "feat": list(own)})

    return blocks.select("rec", "first", "count", "total", "pcm").mapInPandas(run, f"rec {rec}, t long, feat array<float>")
