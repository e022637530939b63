"""Alignment by segments against the alignment of each piece, and of the whole where a recording can't be cut."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import search, segments
from tests.test_search import biased

PARAMS = segments.SegmentParams(per_frame=4, least=20, slack=3)


def cuts_by_hand(lp, ids, word_ends, silences, p):
    """Silences in order; one counts if it is far enough on in time and labels."""
    frames, labels = len(lp), len(ids)
    best = lp.argmax(1)
    said = np.cumsum([x != 0 and (k == 0 or x != best[k - 1]) for k, x in enumerate(best)])
    marks = sorted({s // p.per_frame for s in silences if 0 < s // p.per_frame < frames})
    out = [(0, 0)]
    for t in marks if len(marks) > 1 and said[-1] and np.isfinite(lp).all() else []:
        share = int(said[t] * (labels / said[-1]))
        at = min(word_ends, key=lambda e: abs(e - share))
        if t - out[-1][0] >= p.least and frames - t >= p.least and out[-1][1] < at < labels and t - out[-1][0] >= at - out[-1][1] + p.slack:
            out.append((t, at))
    out.append((frames, labels))
    pieces = [(*a, *b) for a, b in zip(out, out[1:], strict=False)]
    repeats = [sum(x == y for x, y in zip(ids[a:b], ids[a + 1 : b], strict=False)) for _, a, _, b in pieces]
    if any(t1 - t0 < b - a + r for (t0, a, t1, b), r in zip(pieces, repeats, strict=True)):
        return [(0, 0, frames, labels)]
    return pieces


def recordings():
    ids = [1, 2, 3, 4] * 40
    lp = biased(2, ids, per_state=2)
    twice = [5, 5, 6, 6] * 20
    odd = biased(3, twice, per_state=2)
    holed = lp.copy()
    holed[7, 9] = -np.inf
    ends = list(range(4, 161, 4))
    return {
        "cut": (lp, ids, ends, [4 * k for k in (90, 91, 230, 400, 640)]),
        "none": (lp, ids, ends, []),
        "one": (lp, ids, ends, [4 * 200]),
        "repeats": (odd, twice, list(range(2, 81, 2)), [4 * k for k in range(10, 300, 15)]),
        "holed": (holed, ids, ends, [4 * k for k in (90, 230, 400)]),
        "blank": (np.tile([0.0, *[-9.0] * 11], (200, 1)), [1, 2], [2], [4 * 60, 4 * 120]),
    }


@pytest.fixture(scope="module")
def tables(spark):
    recs = recordings()
    scores = spark.createDataFrame([(r, t, x.tolist()) for r, (lp, *_) in recs.items() for t, x in enumerate(lp)], "rec string, t long, lp array<double>").repartition(3)
    refs = spark.createDataFrame([(r, ids, ends) for r, (_, ids, ends, _) in recs.items()], "rec string, ids array<int>, word_ends array<int>")
    silences = spark.createDataFrame([(r, s) for r, (*_, sil) in recs.items() for s in sil], "rec string, frame long")
    return scores, refs, silences


def test_cuts(tables):
    got = {}
    for r in segments.cuts(*tables, 0, PARAMS).orderBy("rec", "segment").collect():
        got.setdefault(r["rec"], []).append((r["t0"], r["l0"], r["t1"], r["l1"]))
    want = {r: cuts_by_hand(*x, PARAMS) for r, x in recordings().items()}
    assert got == want
    assert len(got["cut"]) > 2 and all(len(got[r]) == 1 for r in ("none", "one", "holed", "blank"))


def test_pieces_are_aligned_and_stitched(tables):
    rows = segments.align(*tables, 0, PARAMS).collect()
    assert not [r for r in rows if r["error"]]
    for rec, (lp, ids, ends, silences) in recordings().items():
        own = sorted((r["t"], r["state"], r["margin"]) for r in rows if r["rec"] == rec)
        path, margin = [], []
        for t0, a, t1, b in cuts_by_hand(lp, ids, ends, silences, PARAMS):
            p, m = search.viterbi(lp[t0:t1], ids[a:b], 0)
            path += (p + 2 * a).tolist()
            margin += m.tolist()
        assert [t for t, *_ in own] == list(range(len(lp))) and [s for _, s, _ in own] == path
        assert [m for *_, m in own] == margin
        if rec == "cut":
            assert (np.array(path) == search.viterbi(lp, ids, 0)[0]).mean() > 0.97


def test_one_recording_is_many_groups(tables):
    """Frames are dealt by recording and piece: no task has to hold a whole recording's scores."""
    scores, refs, silences = tables
    plan = segments.align(scores, refs, silences, 0, PARAMS)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan
    got = segments.dealt(scores, segments.cuts(scores, refs, silences, 0, PARAMS), PARAMS.least)
    assert got.groupBy("rec").agg(F.count("*").alias("n")).orderBy("rec").collect() == scores.groupBy("rec").agg(F.count("*").alias("n")).orderBy("rec").collect()


def test_errors_are_rows(spark, tables):
    scores, refs, silences = tables
    more = refs.filter("rec = 'none'").unionByName(spark.createDataFrame([("one", list(range(1, 12)) * 90, [11])], refs.schema))
    got = segments.align(scores.filter("rec in ('none', 'one', 'cut')"), more, silences, 0, PARAMS).filter("error is not null").select("rec", "error").collect()
    assert {tuple(r) for r in got} == {("one", "the labels don't fit into the frames"), ("cut", "no reference")}
