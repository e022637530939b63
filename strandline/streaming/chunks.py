"""Chunk framing and collapse of frames that arrive over time, with state per recording.

`frame_chunks` gives a model sliding windows of `window` frames every `hop` and carries what the next window needs. A row
whose `last` is set ends its recording and flushes the padded last window; so does, where it is asked for, a time without
new frames. `stream_collapse` carries the last symbol. The model itself is a function of (window, cache) -> (outputs,
cache), as acoustic models with carried caches are.

State is typed and lives in RocksDB (call `state_in_rocksdb` once a session): frames that still belong to a window are a
list, appended to while no window is complete and replaced by the less than `window` that are left when one was; how far a
recording is, is a value. Only the model's own cache is bytes. All of it is checkpointed, so a stream that ends with its
executors goes on where it was.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, StructType

Step = Callable[[np.ndarray, Any], tuple[np.ndarray, Any]]


def state_in_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def mean_model(per_chunk: int = 12) -> Step:
    """Stand-in for an acoustic model: means of equal pieces of a window, its cache the number of windows seen."""

    def step(window: np.ndarray, cache: Any) -> tuple[np.ndarray, Any]:
        return np.array([p.mean(0) for p in np.array_split(window, per_chunk)]), (cache or 0) + 1

    return step


def advance(held: np.ndarray, done: int, cache: Any, step: Step, window: int, hop: int, flush: bool) -> tuple[list[np.ndarray], np.ndarray, int, Any]:
    """Outputs of the windows that are complete in `held` (the frames from window `done` on), and the new state."""
    out = []
    while len(held) >= window or flush and len(held) and (done == 0 or len(held) > window - hop):
        piece = held[:window]
        if len(piece) < window:
            piece = np.concatenate([piece, np.zeros((window - len(piece), held.shape[1]))])
        result, cache = step(piece, cache)
        if out and len(result) != len(out[-1]):
            raise ValueError("a model must give the same number of frames for every window")
        out.append(result)
        held, done = held[hop:], done + 1
    return out, held, done, cache


class Framing(StatefulProcessor):
    """The state of one recording: `held` frames, `place` (frames and windows so far), the model's `cache`."""

    def __init__(self, step: Step, window: int, hop: int, idle_ms: int | None) -> None:
        self.step, self.window, self.hop, self.idle_ms = step, window, hop, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "feat array<double>")
        self.place = handle.getValueState("place", "next_t long, windows long")
        self.cache = handle.getValueState("cache", StructType().add("bytes", BinaryType()))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("t")
        next_t, windows = self.place.get() if self.place.exists() else (0, 0)
        t = new["t"].to_numpy()
        if not np.array_equal(t, np.arange(next_t, next_t + len(t))):
            raise ValueError(f"recording {key[0]}: frames {t[0]} to {t[-1]} came where {next_t} is the next one")
        next_t += len(t)
        ended = bool(new["last"].any())
        if not ended and next_t - windows * self.hop < self.window:
            self.held.appendList([(f.tolist(),) for f in new["feat"]])
            self.place.update((next_t, windows))
        else:
            yield from self.run(key, [np.asarray(f, float) for f in new["feat"]], next_t, windows, ended)
        self.wait(timerValues, ended)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        if self.place.exists():
            yield from self.run(key, [], *self.place.get(), True)

    def wait(self, timer: Any, ended: bool) -> None:
        """One timer a recording, anew from the last frames on."""
        if self.idle_ms is None:
            return
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if not ended:
            self.handle.registerTimer(timer.getCurrentProcessingTimeInMs() + self.idle_ms)

    def run(self, key: Any, new: list[np.ndarray], next_t: int, windows: int, ended: bool) -> Iterator[pd.DataFrame]:
        frames = [np.asarray(f[0], float) for f in self.held.get()] + new
        cache = pickle.loads(self.cache.get()[0]) if self.cache.exists() else None
        held = np.stack(frames) if frames else np.zeros((0, 1))
        out, held, after, cache = advance(held, windows, cache, self.step, self.window, self.hop, ended)
        if ended:
            for state in (self.held, self.place, self.cache):
                state.clear()
        else:
            self.held.clear()
            if len(held):
                self.held.put([(f.tolist(),) for f in held])
            self.place.update((next_t, after))
            self.cache.update((pickle.dumps(cache),))
        rows = [(key[0], windows + c, r, v.tolist()) for c, piece in enumerate(out) for r, v in enumerate(piece)]
        yield pd.DataFrame(rows, columns=["rec", "chunk", "row", "out"])


def frame_chunks(frames: DataFrame, step: Step, window: int = 61, hop: int = 48, idle_ms: int | None = None) -> DataFrame:
    """rec, chunk, row, out of a stream (or a table) of rec, t, feat, last. A recording's frames come in order from 0, none
    left out, in as many batches as they like; others are an error. After idle_ms of processing time without a frame a
    recording ends as if its last one had come."""
    rec = frames.schema["rec"].dataType.simpleString()
    return frames.groupBy("rec").transformWithStateInPandas(
        statefulProcessor=Framing(step, window, hop, idle_ms), outputStructType=f"rec {rec}, chunk long, row long, out array<double>", outputMode="Append", timeMode="None" if idle_ms is None else "ProcessingTime"
    )


def stream_collapse(ids: DataFrame, blank: int) -> DataFrame:
    """rec, t, id where a symbol begins, of a stream of rec, t, id whose batches come in frame order."""

    def handle(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = state.get[0] if state.exists else blank
        new = pd.concat(list(parts)).sort_values("t")
        x = new["id"].to_numpy()
        begins = (x != blank) & (x != np.concatenate([[before], x[:-1]]))
        state.update((int(x[-1]),))
        yield pd.DataFrame({"rec": key[0], "t": new["t"].to_numpy()[begins], "id": x[begins]})

    return ids.groupBy("rec").applyInPandasWithState(handle, "rec long, t long, id long", "before long", "append", GroupStateTimeout.NoTimeout)
