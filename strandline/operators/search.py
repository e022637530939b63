"""Dynamic programming and search: exact constrained alignment, repeat detection, split points.

Kernels are numpy functions of one recording; `align` and `detect_repeats` apply them per recording as grouped Arrow
functions, so recordings run in parallel and a failing one becomes a row with an error instead of ending the job.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

NEG = -np.inf
DIRECT_CELLS = 100_000_000


def states_of(ids: list[int], blank: int) -> np.ndarray:
    out = np.full(2 * len(ids) + 1, blank, np.int64)
    out[1::2] = ids
    return out


def skips(states: np.ndarray) -> np.ndarray:
    """Label states that may be reached from two states before: those that differ from the label before."""
    out = np.zeros(len(states), bool)
    out[3::2] = states[3::2] != states[1:-2:2]
    return out


def _first_row(lp: np.ndarray, states: np.ndarray) -> np.ndarray:
    row = np.full(len(states), NEG)
    row[:2] = lp[0, states[:2]]
    return row


def _candidates(row: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What staying, advancing by one and skipping to each state would score."""
    advance = np.concatenate([[NEG], row[:-1]])
    jump = np.full(len(row), NEG)
    jump[2:] = np.where(skip[2:], row[:-2], NEG)
    return row, advance, jump


def _next_row(row: np.ndarray, emit: np.ndarray, skip: np.ndarray) -> np.ndarray:
    return np.maximum.reduce(_candidates(row, skip)) + emit


def _end_state(row: np.ndarray) -> int | None:
    last = len(row) - 1
    if last and row[last - 1] > row[last]:
        last -= 1
    return last if np.isfinite(row[last]) else None


def _trace(rows: np.ndarray, skip: np.ndarray, path: np.ndarray, margin: np.ndarray, start: int, state: int) -> int:
    """Walk back from `state` at frame start + len(rows) - 1 to frame start; rows are the scores of those frames."""
    for k in range(len(rows) - 1, 0, -1):
        path[start + k] = state
        above = rows[k - 1]
        moves = [above[state], above[state - 1] if state >= 1 else NEG, above[state - 2] if state >= 2 and skip[state] else NEG]
        step = int(np.argmax(moves))  # stay, then advance, then skip among equals
        second = max(m for j, m in enumerate(moves) if j != step)
        margin[start + k] = moves[step] - second if np.isfinite(second) else np.inf
        state -= step
    path[start] = state
    return state


def viterbi(lp: np.ndarray, ids: list[int], blank: int, direct_cells: int = DIRECT_CELLS) -> tuple[np.ndarray, np.ndarray] | None:
    """(state, margin) of each frame on the best path through all labels, or None if they don't fit.

    Up to direct_cells scores are kept whole; beyond, only every sqrt(T)-th row, and the rows between two of those are
    computed again on the way back: the same result in O(sqrt(T)) rows of memory.
    """
    frames = len(lp)
    states = states_of(ids, blank)
    skip = skips(states)
    repeats = sum(a == b for a, b in zip(ids[1:], ids[:-1], strict=True))
    if not frames or frames < len(ids) + repeats:
        return None
    path, margin = np.zeros(frames, np.int64), np.full(frames, np.inf)
    every = frames if frames * len(states) <= direct_cells else max(2, int(np.sqrt(frames)))
    row = _first_row(lp, states)
    marks = [row]
    for t in range(1, frames):
        if every == frames:
            break
        row = _next_row(row, lp[t, states], skip)
        if t % every == 0:
            marks.append(row)
    end: int | None = None if every == frames else _end_state(row)
    if every != frames and end is None:
        return None
    stop = frames
    for start in reversed(range(0, frames, every)):
        rows = [marks[start // every]]
        # the frame after this stretch belongs to it too: its step leads out of the stretch's last frame
        for t in range(start + 1, min(stop + (stop < frames), frames)):
            rows.append(_next_row(rows[-1], lp[t, states], skip))
        if end is None:
            end = _end_state(rows[-1])
            if end is None:
                return None
        end = _trace(np.array(rows), skip, path, margin, start, end)
        stop = start
    margin[0] = np.inf
    return path, margin


def path_means(lp: np.ndarray, states: np.ndarray, path: np.ndarray, start: int, end: int) -> float:
    if end < start or start < 0:
        return NEG
    t = np.arange(start, end + 1)
    return float(lp[t, states[path[t]]].mean())


def packed_path(lp: np.ndarray, ids: list[int], blank: int, dtype: type = np.float64, rows: int = 64) -> np.ndarray | None:
    """The states of viterbi()'s best path from one pass forward that keeps nothing but the moves: two bits a cell, a quarter
    of a byte where scores take eight. Scores are rows of dtype. Margins need the scores, so there are none."""
    frames, states = len(lp), states_of(ids, blank)
    skip = skips(states)
    if not frames or frames < len(ids) + sum(a == b for a, b in zip(ids[1:], ids[:-1], strict=True)):
        return None
    width = -(-len(states) // 4)
    moves, held = np.zeros((frames, width), np.uint8), np.zeros((rows, 4 * width), np.uint8)
    # two cells of nothing before the first state, so that advancing and skipping are slices of the row
    row, new, best = (np.full(len(states) + 2, NEG, dtype) for _ in range(3))
    row[2:] = _first_row(lp, states)
    barred = np.where(skip, 0, NEG).astype(dtype)
    jump, further = np.empty(len(states), dtype), np.empty(len(states), bool)
    for t in range(1, frames):
        own = held[t % rows, : len(states)]
        np.greater(row[1:-1], row[2:], out=own.view(bool))
        np.maximum(row[1:-1], row[2:], out=best[2:])
        np.add(row[:-2], barred, out=jump)
        np.greater(jump, best[2:], out=further)
        own[further] = 2
        np.maximum(best[2:], jump, out=best[2:])
        np.add(best[2:], lp[t].astype(dtype)[states], out=new[2:])
        row, new = new, row
        if t % rows == rows - 1 or t == frames - 1:
            first = t - t % rows
            quads = held[: t - first + 1].reshape(t - first + 1, width, 4)
            moves[first : t + 1] = quads[:, :, 0] | quads[:, :, 1] << 2 | quads[:, :, 2] << 4 | quads[:, :, 3] << 6
    state = _end_state(row[2:])
    if state is None:
        return None
    path = np.zeros(frames, np.int64)
    for t in range(frames - 1, -1, -1):
        path[t] = state
        state -= int(moves[t, state >> 2]) >> 2 * (state & 3) & 3 if t else 0
    return path


def split_points(silences: list[int], n_chunks: int, hop: int = 48, warmup: int = 4, most: int | None = None) -> list[int]:
    """Chunks to split at. A stretch of chunks with a silence at least `warmup` from both its ends is bisected at the one
    nearest to its middle (the earlier of two), and so are its parts; of all bisections those of the `most` widest stretches
    count, the earlier of equals first. A part is narrower than what it is a part of, so that never leaves out a stretch whose
    parts are bisected."""
    points = np.unique(np.asarray(silences, np.int64) // hop)
    stretches, found = [(0, n_chunks)], []
    while stretches:
        a, b = stretches.pop()
        lo, hi = np.searchsorted(points, [a + warmup, b - warmup + 1])
        if lo >= hi:
            continue
        cut = int(points[lo + np.argmin(np.abs(points[lo:hi] - (a + b) // 2))])
        found.append((a - b, a, cut))
        stretches += [(a, cut), (cut, b)]
    return sorted(cut for *_, cut in sorted(found)[:most])


def edit_distance(a: list[int], b: list[int]) -> int:
    """Levenshtein distance by rows; insertions along a row are a running minimum."""
    if not a or not b:
        return len(a) + len(b)
    b_arr, offset = np.asarray(b), np.arange(len(b) + 1)
    row = offset.copy()
    for k, x in enumerate(a, 1):
        new = np.minimum(row[1:] + 1, row[:-1] + (b_arr != x))
        row = np.minimum.accumulate(np.concatenate([[k], new]) - offset) + offset
    return int(row[-1])


def ratio(a: list[int], b: list[int]) -> float:
    return 1.0 if not a and not b else 1.0 - edit_distance(a, b) / max(len(a), len(b))


def collapse_ids(ids: np.ndarray, blank: int) -> list[int]:
    before = np.concatenate([[blank], ids[:-1]])
    return ids[(ids != blank) & (ids != before)].tolist()


@dataclass(frozen=True)
class RepeatParams:
    """Thresholds of repeat detection; the defaults are part of its meaning."""

    low: float = 0.15
    high: float = 3.0
    final_mult: float = 1.5
    confidence_margin: float = 1.0
    max_words: int | None = None
    least_frames: int = 3
    artifact_gap: int = 1
    artifact_margin: float = 0.5
    free_ratio: float = 0.5
    free_margin: float = -0.25
    pause_frames: int = 15
    pause_margin: float = 0.3
    bonus: float = 0.25
    lead: int = 2


@dataclass
class Cue:
    cue_no: int
    start: int
    end: int
    tokens: list[int]
    sura: int = 0
    aya: int = 0
    is_final: bool = False
    is_repeat: bool = False
    avg: float = field(default=NEG)
    margin: float = field(default=np.inf)
    spans: list[tuple[int, int]] = field(default_factory=list)  # of the word's tokens
    spliced: bool = False


def _score_window(lp: np.ndarray, greedy: np.ndarray, words: list[list[int]], start: int, stop: int, floor: float, p: RepeatParams, blank: int):
    """Token spans and means of the words of both copies of a phrase in frames start..stop, and the copies' score; None if it
    isn't said twice there."""
    phrase = [t for w in words for t in w]
    twice = phrase + phrase
    said = collapse_ids(greedy[start : stop + 1], blank)
    to_twice, to_once = ratio(said, twice), ratio(said, phrase)
    free = to_twice >= p.free_ratio and to_twice - to_once >= p.free_margin
    window = lp[start : stop + 1]
    path, states = packed_path(window, twice, blank, np.float32), states_of(twice, blank)
    if path is None:
        return None
    first, last = np.full(len(states), -1), np.full(len(states), -1)
    last[path] = np.arange(len(path))
    first[path[::-1]] = np.arange(len(path))[::-1]
    if (first[1::2] < 0).any():
        return None
    every = list(zip(first[1::2].tolist(), last[1::2].tolist(), strict=True))
    ends = np.cumsum([len(w) for w in words + words]).tolist()
    spans = [every[e - len(w) : e] for e, w in zip(ends, words + words, strict=True)]
    k = len(words)
    (s1, e1), (s2, e2) = (spans[0][0][0], spans[k - 1][-1][1]), (spans[k][0][0], spans[-1][-1][1])
    if not s2 > e1 or e1 - s1 < p.least_frames or e2 - s2 < p.least_frames:
        return None
    both = min(path_means(window, states, path, s1, e1), path_means(window, states, path, s2, e2))
    gap, margin = s2 - e1, both - floor
    if both < floor or gap <= p.artifact_gap and margin < p.artifact_margin or not free and gap <= p.pause_frames and margin < p.pause_margin:
        return None
    means = [path_means(window, states, path, own[0][0], own[-1][1]) for own in spans]
    return both + p.bonus * (k - 1), [([(s + start, e + start) for s, e in own], m) for own, m in zip(spans, means, strict=True)]


def find_repeats(cues: list[Cue], lp: np.ndarray, blank: int, p: RepeatParams = RepeatParams()) -> list[Cue]:  # noqa: B008
    """cues with the phrases said twice inside an anomalous word's time replaced by their two copies, the second a repeat."""
    durations = np.array([c.end - c.start for c in cues], float)
    median = float(np.median(durations)) if len(cues) else 0.0
    if median <= 0:
        return cues
    limits = np.array([p.high * (p.final_mult if c.is_final else 1.0) for c in cues])
    odd = (durations < p.low * median) | (durations > limits * median)
    plain = [c.avg for c, x in zip(cues, odd, strict=True) if not x]
    floor = (float(np.median(plain)) if plain else 0.0) - p.confidence_margin
    greedy = lp.argmax(1)
    used, fixes = set(), []
    run = 0
    for i, cue in enumerate(cues):
        run = run + 1 if i and (cue.aya, cue.sura) == (cues[i - 1].aya, cues[i - 1].sura) else 1
        if not cue.tokens or not odd[i]:
            continue
        k_max = min(run, p.max_words) if p.max_words and p.max_words > 0 else run
        stop = min(cues[i + 1].start - 1 if i + 1 < len(cues) else len(lp) - 1, len(lp) - 1)

        def opening(j: int) -> int:
            return max(0, cues[j - 1].end + 1 if j else cues[0].start - p.lead)

        if stop <= opening(i - k_max + 1):
            continue
        best = None
        for k in range(1, k_max + 1):
            j = i - k + 1
            if any(x in used for x in range(j, i)):
                break
            if stop <= opening(j):
                continue
            found = _score_window(lp, greedy, [c.tokens for c in cues[j : i + 1]], opening(j), stop, floor, p, blank)
            if found and (best is None or found[0] > best[0]):
                best = (*found, j)
        if best:
            _, spans, j = best
            used |= set(range(j, i + 1))
            own = cues[j : i + 1]
            for n, (c, (at, mean)) in enumerate(zip(own + own, spans, strict=True)):
                fixes.append(replace(c, start=at[0][0], end=at[-1][1], spans=at, avg=mean, margin=np.inf, is_repeat=n >= len(own), spliced=True))
    out = [c for k, c in enumerate(cues) if k not in used] + fixes
    return sorted(out, key=lambda c: (c.start, c.end))


Kernel = Callable[[np.ndarray, list[int], int], tuple[np.ndarray, np.ndarray] | None]


def _packed(lp: np.ndarray, ids: list[int], blank: int) -> tuple[np.ndarray, np.ndarray] | None:
    path = packed_path(lp, ids, blank)
    return None if path is None else (path, np.full(len(path), np.nan))


KERNELS: dict[str, Kernel] = {"direct": viterbi, "checkpointed": lambda lp, ids, blank: viterbi(lp, ids, blank, direct_cells=0), "packed": _packed}


def kernel(name: str) -> Kernel:
    if name not in KERNELS:
        raise ValueError(f"no kernel {name!r}; there are {', '.join(sorted(KERNELS))}")
    return KERNELS[name]


def matrix(frames: pd.DataFrame) -> np.ndarray:
    return np.stack(frames.sort_values("t")["lp"].to_list()).astype(float)


def align(scores: DataFrame, references: DataFrame, blank: int, engine: str = "direct") -> DataFrame:
    """rec, t, state, margin, error: best path of scores (rec, t, lp) through references (rec, ids array). A recording
    that can't be aligned is one row with an error; the others go on. The engine `packed` gives no margins (null);
    segments.align() takes a recording apart."""
    run = kernel(engine)
    rec = scores.schema["rec"].dataType.simpleString()

    def one(key: tuple, frames: pd.DataFrame, refs: pd.DataFrame) -> pd.DataFrame:
        columns = ["rec", "t", "state", "margin", "error"]
        try:
            if refs.empty or frames.empty:
                raise ValueError("no reference" if refs.empty else "no frames")
            lp, ref = matrix(frames), refs.iloc[0]
            got = run(lp, list(ref["ids"]), blank)
            if got is None:
                raise ValueError("the labels don't fit into the frames")
            return pd.DataFrame({"rec": key[0], "t": np.sort(frames["t"].to_numpy()), "state": got[0], "margin": pd.Series(got[1]).replace(np.nan, None), "error": None})[columns]
        except ValueError as e:
            return pd.DataFrame([[key[0], None, None, None, str(e)]], columns=columns)

    return scores.groupBy("rec").cogroup(references.groupBy("rec")).applyInPandas(one, f"rec {rec}, t long, state long, margin double, error string")


def word_cues(lp: np.ndarray, words: list[Cue], blank: int, run: Kernel) -> list[Cue]:
    """words with start, end, token spans, mean score and least margin by the best path; those with a token that the path
    left out are left out too."""
    ids = [t for w in words for t in w.tokens]
    got = run(lp, ids, blank)
    if got is None:
        raise ValueError("the labels don't fit into the frames")
    path, margin = got
    states = states_of(ids, blank)
    first, last = np.full(len(states), -1), np.full(len(states), -1)
    last[path] = np.arange(len(path))
    first[path[::-1]] = np.arange(len(path))[::-1]
    every = list(zip(first[1::2].tolist(), last[1::2].tolist(), strict=True))
    out = []
    for w, end in zip(words, np.cumsum([len(w.tokens) for w in words]).tolist(), strict=True):
        own = every[end - len(w.tokens) : end]
        if own and all(s >= 0 for s, _ in own):
            s, e = own[0][0], own[-1][1]
            out.append(replace(w, start=s, end=e, spans=own, avg=path_means(lp, states, path, s, e), margin=float(margin[s : e + 1].min()) if e >= s else np.inf))
    return out


def align_words(scores: DataFrame, slots: DataFrame, blank: int, engine: str = "direct", repeats: RepeatParams | None = None) -> DataFrame:
    """The words of recordings, aligned: rec, cue_no, word_no, start_frame, end_frame, token_frame_spans, is_repeat, spliced,
    avg_logprob, min_decision_margin, error. slots: rec, word_no, sura, aya, is_ayah_final, tokens.

    Alignment and, with `repeats`, the search for phrases said twice run over one copy of a recording's scores, so these
    are dealt out once. A recording that can't be aligned is one row with an error; the others go on.
    """
    run = kernel(engine)
    rec = scores.schema["rec"].dataType.simpleString()
    schema = f"rec {rec}, cue_no long, word_no long, start_frame long, end_frame long, token_frame_spans array<struct<start:bigint,end:bigint>>, is_repeat boolean, spliced boolean, avg_logprob double, min_decision_margin double, error string"
    columns = [f.split()[0] for f in "rec, cue_no, word_no, start_frame, end_frame, token_frame_spans, is_repeat, spliced, avg_logprob, min_decision_margin, error".split(", ")]

    def one(key: tuple, frames: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        try:
            if own.empty or frames.empty:
                raise ValueError("no reference" if own.empty else "no frames")
            lp = matrix(frames)
            words = [
                Cue(int(w.word_no), 0, 0, list(w.tokens), int(w.sura or 0), -1 if w.aya is None else int(w.aya), bool(w.is_ayah_final))
                for w in own.astype(object).where(own.notna(), None).sort_values("word_no").itertuples()
            ]
            got = word_cues(lp, words, blank, run)
            if repeats:
                got = find_repeats(got, lp.astype(np.float32).astype(float), blank, repeats)
            rows = [
                (key[0], k, c.cue_no, c.start, c.end, [{"start": s, "end": e} for s, e in c.spans], c.is_repeat, c.spliced, c.avg, c.margin, None)
                for k, c in enumerate(got)
            ]
            return pd.DataFrame(rows, columns=columns)
        except ValueError as e:
            return pd.DataFrame([[key[0], *[None] * 9, str(e)]], columns=columns)

    wanted = slots.select("rec", "word_no", "sura", "aya", "is_ayah_final", "tokens")
    return scores.groupBy("rec").cogroup(wanted.groupBy("rec")).applyInPandas(one, schema)


def split_chunks(silences: DataFrame, lengths: DataFrame, hop: int = 48, warmup: int = 4, most: int | None = None) -> DataFrame:
    """rec, chunk: split_points() of every recording; silences (rec, frame), lengths (rec, n_chunks)."""
    rec = lengths.schema["rec"].dataType.simpleString()

    def one(key: tuple, own: pd.DataFrame, n: pd.DataFrame) -> pd.DataFrame:
        got = split_points(own["frame"].tolist(), int(n["n_chunks"].iloc[0]), hop, warmup, most) if len(n) else []
        return pd.DataFrame([(key[0], c) for c in got], columns=["rec", "chunk"])

    return silences.groupBy("rec").cogroup(lengths.groupBy("rec")).applyInPandas(one, f"rec {rec}, chunk long")


def detect_repeats(cues: DataFrame, scores: DataFrame, blank: int, params: RepeatParams = RepeatParams()) -> DataFrame:  # noqa: B008
    """cues (rec, cue_no, start_frame, end_frame, tokens, sura, aya, is_ayah_final, avg_logprob) after find_repeats."""
    rec = cues.schema["rec"].dataType.simpleString()
    schema = f"rec {rec}, cue_no long, start_frame long, end_frame long, tokens array<long>, sura int, aya int, is_ayah_final boolean, is_repeat boolean, avg_logprob double"

    def one(key: tuple, own: pd.DataFrame, frames: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("cue_no")
        listed = [Cue(int(r.cue_no), int(r.start_frame), int(r.end_frame), list(r.tokens), int(r.sura), int(r.aya), bool(r.is_ayah_final), False, float(r.avg_logprob)) for r in own.itertuples()]
        lp = np.stack(frames.sort_values("t")["lp"].to_list()).astype(np.float32).astype(float) if len(frames) else np.zeros((0, 1))
        got = find_repeats(listed, lp, blank, params) if len(lp) else listed
        rows = [(key[0], c.cue_no, c.start, c.end, c.tokens, c.sura, c.aya, c.is_final, c.is_repeat, c.avg) for c in got]
        return pd.DataFrame(rows, columns=[p.split()[0] for p in schema.split(", ")])

    return cues.groupBy("rec").cogroup(scores.groupBy("rec")).applyInPandas(one, schema)
