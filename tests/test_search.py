"""Alignment, repeat search, splits and edit distance against brute force and the listed fixtures."""

import itertools

import numpy as np
import pandas as pd
import pytest

from strandline.operators import search


def biased(seed, ids, blank=0, symbols=12, per_state=3, drop=()):
    rng = np.random.default_rng(seed)
    states = search.states_of(ids, blank)
    rows = []
    for k, s in enumerate(states):
        if k in drop:
            continue
        for _ in range(per_state):
            row = rng.uniform(-8, -2, symbols)
            row[s] = rng.uniform(-0.5, -0.05)
            rows.append(row)
    return np.array(rows)


def brute(lp, ids, blank):
    """Best score over all monotone paths."""
    states, skip = search.states_of(ids, blank), search.skips(search.states_of(ids, blank))
    best = {s: lp[0, states[s]] for s in (0, 1) if s < len(states)}
    for t in range(1, len(lp)):
        new = {}
        for s, v in best.items():
            for d in (0, 1, 2):
                n = s + d
                if n < len(states) and (d < 2 or skip[n]):
                    new[n] = max(new.get(n, -np.inf), v + lp[t, states[n]])
        best = new
    return max(best.get(len(states) - 1, -np.inf), best.get(len(states) - 2, -np.inf))


def test_states():
    assert search.states_of([5, 7, 5], 0).tolist() == [0, 5, 0, 7, 0, 5, 0]
    assert search.states_of([], 9).tolist() == [9]


@pytest.mark.parametrize("seed", range(6))
def test_direct_checkpointed_and_brute_force(seed):
    rng = np.random.default_rng(seed)
    ids = rng.integers(1, 12, rng.integers(1, 9)).tolist()
    lp = biased(seed, ids)
    path, margin = search.viterbi(lp, ids, 0)
    path2, margin2 = search.viterbi(lp, ids, 0, direct_cells=0)
    assert path.tolist() == path2.tolist() and np.array_equal(margin, margin2)
    states = search.states_of(ids, 0)
    assert np.isclose(lp[np.arange(len(lp)), states[path]].sum(), brute(lp, ids, 0))
    assert np.isinf(margin[0])


def test_forced_skip_and_too_short():
    lp = biased(1, [3, 4, 5], drop={2})
    path, _ = search.viterbi(lp, [3, 4, 5], 0)
    assert 2 not in path
    assert search.viterbi(np.zeros((3, 6)), [1, 2, 3, 4, 5], 0) is None
    assert search.viterbi(np.zeros((2, 6)), [1, 1], 0) is None
    path, _ = search.viterbi(np.zeros((4, 6)), [], 0)
    assert path.tolist() == [0, 0, 0, 0]


def test_edit_distance_random():
    rng = np.random.default_rng(0)

    def slow(a, b):
        d = np.zeros((len(a) + 1, len(b) + 1), int)
        d[:, 0], d[0, :] = range(len(a) + 1), range(len(b) + 1)
        for i, j in itertools.product(range(len(a)), range(len(b))):
            d[i + 1, j + 1] = min(d[i, j + 1] + 1, d[i + 1, j] + 1, d[i, j] + (a[i] != b[j]))
        return d[-1, -1]

    for _ in range(100):
        a, b = (rng.integers(0, 5, rng.integers(0, 15)).tolist() for _ in range(2))
        assert search.edit_distance(a, b) == slow(a, b)
    assert search.ratio([], []) == 1.0


def test_collapse():
    for ids, want in (([1, 1, 2, 2, 2], [1, 2]), ([1, 0, 1], [1, 1]), ([1, 0, 0], [1]), ([0, 0], []), ([1, 2], [1, 2])):
        assert search.collapse_ids(np.array(ids), 0) == want


def test_split_points():
    assert search.split_points([3000 * 48, 2900 * 48], 10_000, warmup=50) == [2900, 3000]
    got = search.split_points([k * 480 for k in (2, 4, 5, 6, 8)], 100, most=2)
    assert len(got) == 2 and got == sorted(got)
    assert search.split_points([], 100) == [] and search.split_points([480], 8) == []


def test_split_points_equal_repeated_bisection_of_the_widest():
    def slow(silences, n, warmup, most):
        points, bounds, out = {s // 48 for s in silences}, [0, n], []
        while most is None or len(out) < most:
            fits = [(a - b, a, b) for a, b in itertools.pairwise(bounds) if any(a + warmup <= c <= b - warmup for c in points)]
            if not fits:
                break
            _, a, b = min(fits)
            out.append(min((c for c in points if a + warmup <= c <= b - warmup), key=lambda c: (abs(c - (a + b) // 2), c)))
            bounds = sorted([0, n, *out])
        return sorted(out)

    rng = np.random.default_rng(7)
    for _ in range(400):
        n = int(rng.integers(1, 80))
        silences, warmup = rng.integers(0, n * 48, rng.integers(0, 30)).tolist(), int(rng.integers(1, 8))
        most = [None, 0, 1, 2, 5][rng.integers(0, 5)]
        assert search.split_points(silences, n, 48, warmup, most) == slow(silences, n, warmup, most)


def words_said_twice(pause):
    """Seven words, the last four said again inside the last one's time."""
    words = [[1, 2], [3, 4], [5, 6], [7, 8], [9, 10], [2, 11], [4, 1]]
    said = words[:6] + words[2:6] + [words[6]] if not pause else words[:6] + [None] + words[2:6] + [words[6]]
    rng = np.random.default_rng(4)
    rows, spans = [], []
    for w in said:
        start = len(rows)
        for s in [0] * 20 if w is None else [0, 0, *[t for t in w for _ in range(5)]]:
            row = rng.uniform(-40, -30, 12)
            row[s] = -0.1
            rows.append(row)
        spans.append((start + 2, len(rows) - 1))
    return words, np.array(rows), spans


@pytest.mark.parametrize("pause", [False, True])
def test_repeats_found(pause):
    words, lp, spans = words_said_twice(pause)
    cues = [search.Cue(k, s, e, words[k], 2, 255) for k, (s, e) in enumerate(spans[:6])]
    again = spans[6 + pause : 10 + pause]
    cues[5].end = again[-1][1]
    cues.append(search.Cue(6, *spans[-1], words[6], 2, 255))
    for c in cues:
        c.avg = -0.1
    got = search.find_repeats(cues, lp, 0)
    repeats = [c for c in got if c.is_repeat]
    assert [c.cue_no for c in repeats] == [2, 3, 4, 5]
    for c, (s, e) in zip(repeats, again, strict=True):
        assert abs(c.start - s) <= 3 and abs(c.end - e) <= 3
    assert [(c.start, c.end) for c in got] == sorted((c.start, c.end) for c in got)


def test_no_repeats_in_plain_recording():
    words, lp, spans = words_said_twice(False)
    cues = [search.Cue(k, s, e, words[k], 2, 255, avg=-0.1) for k, (s, e) in enumerate(spans[:6])]
    assert search.find_repeats(cues, lp[: spans[5][1] + 1], 0) == cues


@pytest.mark.parametrize("dtype", [np.float64, np.float32])
def test_packed_path_is_the_best_path(dtype):
    """Scores of few different values: ties at most cells; some impossible ones, so that skips are forced."""
    rng = np.random.default_rng(0)
    for _ in range(300):
        ids = rng.integers(1, 4, rng.integers(0, 8)).tolist()
        lp = rng.integers(-3, 1, (rng.integers(1, 40), 4)).astype(float)
        if rng.random() < 0.3:
            lp[rng.random(lp.shape) < 0.2] = -np.inf
        want, got = search.viterbi(lp, ids, 0), search.packed_path(lp, ids, 0, dtype, rows=int(rng.integers(1, 9)))
        assert (want is None) == (got is None) and (want is None or want[0].tolist() == got.tolist())


def test_packed_path_of_a_long_recording():
    ids = [1, 2, 3, 4] * 300
    lp = biased(6, ids, per_state=2)
    assert search.packed_path(lp, ids, 0).tolist() == search.viterbi(lp, ids, 0)[0].tolist()


def test_align_isolates_errors(spark):
    lp = biased(3, [1, 2])
    rows = [("a", t, r.tolist()) for t, r in enumerate(lp)] + [("b", 0, lp[0].tolist())]
    scores = spark.createDataFrame(rows, "rec string, t long, lp array<double>")
    refs = spark.createDataFrame([("a", [1, 2]), ("b", [1, 2, 3]), ("c", [1])], "rec string, ids array<int>")
    got = search.align(scores, refs, 0).toPandas()
    assert set(got[got.error.notna()].rec) == {"b", "c"}
    assert len(got[got.rec == "a"]) == len(lp)
    with pytest.raises(ValueError):
        search.kernel("gpu")
    assert isinstance(got, pd.DataFrame)
