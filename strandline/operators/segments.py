"""Alignment by segments: a recording cut at silences into pieces that are aligned as tasks of their own.

An approximation of the alignment of the whole, for recordings whose trellis is too large for one task. Everything but the
search inside a piece is relational: the silences become candidates with a place in the labels, a fold over a recording's
candidates (some thousands at most) keeps those that go on in time and labels, and the cuts are a table that frames are
dealt by. A recording that can't be cut, or a piece of which would not fit, is one piece.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.arrays import argmax
from strandline.operators import search


@dataclass(frozen=True)
class SegmentParams:
    """per_frame: feature frames of a score frame; least: frames of a piece; slack: frames that a piece has more than labels."""

    per_frame: int = 4
    least: int = 200
    slack: int = 10


def greedy_counts(scores: DataFrame, blank: int) -> DataFrame:
    """rec, t, said: how many symbols the best scores alone say up to frame t, and whether all scores are finite (sound)."""
    by_time = Window.partitionBy("rec").orderBy("t")
    best = scores.select("rec", "t", argmax(F.col("lp")).alias("best"), F.forall("lp", lambda x: F.abs(x) < F.lit(float("inf"))).alias("sound"))
    begins = (F.col("best") != blank) & ~F.col("best").eqNullSafe(F.lag("best").over(by_time))
    best = best.withColumn("begins", begins.cast("long"))
    return best.select("rec", "t", F.sum("begins").over(by_time).alias("said"), "sound")


def candidates(said: DataFrame, references: DataFrame, silences: DataFrame, per_frame: int = 4) -> DataFrame:
    """rec, t, at: the frames of silences, each with the word's end nearest to the same share of the labels as the best scores
    say of all symbols up to it; of equally near ones the first. said: greedy_counts(); references: rec, ids, word_ends;
    silences: rec, frame in feature frames."""
    totals = said.groupBy("rec").agg(F.max("said").alias("total"), F.count("*").alias("frames"), F.bool_and("sound").alias("sound"))
    t = F.floor(F.col("frame") / per_frame).cast("long")
    at = silences.select("rec", t.alias("t")).filter("t > 0").distinct().join(said.select("rec", "t", "said"), ["rec", "t"])
    at = at.join(totals, "rec").filter("sound AND total > 0").join(references.select("rec", F.size("ids").alias("labels"), "word_ends"), "rec")
    share = F.floor(F.col("said") * (F.col("labels") / F.col("total")))
    nearest = F.array_min(F.transform("word_ends", lambda e, i: F.struct(F.abs(e - share).alias("off"), i.alias("i"), e.cast("long").alias("end"))))
    return at.filter(F.size("word_ends") > 0).select("rec", "t", nearest["end"].alias("at"))


def _accepted(marks: Column, frames: Column, labels: Column, p: SegmentParams) -> Column:
    """Of the marks (t, at) in order those that lie far enough from the last accepted one and from the end, and later in the
    labels than it."""

    def step(kept: Column, m: Column) -> Column:
        last = F.element_at(kept, -1)
        far = (m["t"] - last["t"] >= p.least) & (frames - m["t"] >= p.least)
        later = (m["at"] > last["at"]) & (m["at"] < labels) & (m["t"] - last["t"] >= m["at"] - last["at"] + p.slack)
        return F.when(far & later, F.concat(kept, F.array(m))).otherwise(kept)

    return F.aggregate(marks, F.array(F.struct(F.lit(0).cast("long").alias("t"), F.lit(0).cast("long").alias("at"))), step)


def cuts(scores: DataFrame, references: DataFrame, silences: DataFrame, blank: int, params: SegmentParams = SegmentParams()) -> DataFrame:  # noqa: B008
    """rec, segment, t0, t1, l0, l1: the pieces of every recording with a reference, frames t0 to t1 with labels l0 to l1."""
    said = greedy_counts(scores, blank)
    found = candidates(said, references, silences, params.per_frame)
    marks = found.groupBy("rec").agg(F.array_sort(F.collect_list(F.struct("t", "at"))).alias("marks"))
    marks = marks.filter(F.size("marks") > 1)
    lengths = scores.groupBy("rec").agg(F.count("*").alias("frames"))
    rows = lengths.join(references.select("rec", "ids"), "rec").join(marks, "rec", "left")
    n = F.size("ids").cast("long")
    none = F.array().cast("array<struct<t:bigint,at:bigint>>")
    kept = _accepted(F.coalesce("marks", none), F.col("frames"), n, params)
    rows = rows.select("rec", "ids", "frames", F.concat(kept, F.array(F.struct(F.col("frames").alias("t"), n.alias("at")))).alias("ends"))

    def piece(i: Column) -> Column:
        a, b = F.get("ends", i), F.get("ends", i + 1)
        return F.struct(i.alias("segment"), a["t"].alias("t0"), b["t"].alias("t1"), a["at"].alias("l0"), b["at"].alias("l1"))

    pieces = F.transform(F.sequence(F.lit(0), F.size("ends") - 2), piece)
    # a path through labels that repeat needs a blank frame between them
    again = F.transform("ids", lambda x, i: (i > 0) & (x == F.get("ids", i - 1)))
    rows = rows.select("rec", "frames", n.alias("labels"), pieces.alias("pieces"), again.alias("again"))

    def fits(p: Column) -> Column:
        inside = F.filter(F.slice("again", (p["l0"] + 2).cast("int"), F.greatest(p["l1"] - p["l0"] - 1, F.lit(0)).cast("int")), lambda x: x)
        return p["t1"] - p["t0"] >= p["l1"] - p["l0"] + F.size(inside)

    whole = F.array(F.struct(F.lit(0).alias("segment"), F.lit(0).cast("long").alias("t0"), F.col("frames").alias("t1"), F.lit(0).cast("long").alias("l0"), F.col("labels").alias("l1")))
    return rows.select("rec", F.inline(F.when(F.forall("pieces", fits), F.col("pieces")).otherwise(whole)))


def dealt(scores: DataFrame, pieces: DataFrame, block: int) -> DataFrame:
    """rec, segment, t, lp: the frames of every piece. Frames and pieces meet by blocks of `block` frames, of which a piece of
    as many frames touches two at most more than it fills, so a long recording is spread over tasks from here on."""
    own = pieces.select("rec", "segment", "t0", "t1", F.explode(F.sequence(F.floor(F.col("t0") / block), F.floor((F.col("t1") - 1) / block))).alias("block"))
    frames = scores.select("rec", "t", "lp", F.floor(F.col("t") / block).alias("block"))
    met = frames.join(own.hint("merge"), ["rec", "block"]).filter("t >= t0 AND t < t1")
    return met.select("rec", "segment", "t", "lp")


def align(scores: DataFrame, references: DataFrame, silences: DataFrame, blank: int, params: SegmentParams = SegmentParams(), engine: str = "direct") -> DataFrame:  # noqa: B008
    """rec, segment, t, state, margin, error of scores (rec, t, lp), references (rec, ids, word_ends) and silences (rec, frame).

    States count through the whole reference; a piece's first frame has an infinite margin. A piece is a group of its own; a
    recording that doesn't fit is one row with an error, and so is one without a reference.
    """
    run = search.kernel(engine)
    rec = scores.schema["rec"].dataType.simpleString()
    pieces = cuts(scores, references, silences, blank, params)
    labels = pieces.join(references.select("rec", "ids"), "rec")
    # both sides of the grouping come from the same pieces: the columns of one are named anew
    labels = labels.select(*[F.col(c).alias(c) for c in ("rec", "segment", "l0")], F.slice("ids", (F.col("l0") + 1).cast("int"), (F.col("l1") - F.col("l0")).cast("int")).alias("ids"))
    columns = ["rec", "segment", "t", "state", "margin", "error"]

    def one(key: tuple, frames: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        got = None if frames.empty or own.empty else run(search.matrix(frames), list(own["ids"].iloc[0]), blank)
        if got is None:
            return pd.DataFrame([[key[0], key[1], None, None, None, "the labels don't fit into the frames"]], columns=columns)
        states = got[0] + 2 * int(own["l0"].iloc[0])
        return pd.DataFrame({"rec": key[0], "segment": key[1], "t": np.sort(frames["t"].to_numpy()), "state": states, "margin": got[1], "error": None})[columns]

    frames = dealt(scores, pieces, params.least)
    out = frames.groupBy("rec", "segment").cogroup(labels.groupBy("rec", "segment")).applyInPandas(one, f"rec {rec}, segment int, t long, state long, margin double, error string")
    lost = scores.select("rec").distinct().join(references.select("rec"), "rec", "left_anti")
    none = F.lit(None)
    return out.unionByName(lost.select("rec", none.cast("int").alias("segment"), none.cast("long").alias("t"), none.cast("long").alias("state"), none.cast("double").alias("margin"), F.lit("no reference").alias("error")))
