"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target over its size is the expected number of times that each of its documents is taken: a whole part, which
is certain, and a fraction. The fractions go through the flight phase: moves in the null space of the balancing
constraints (documents and words of the source) until each is 0 or 1. Flights run in blocks of about BLOCK documents of
one source, so a source with a third of all rows is many blocks; a block ends with at most two fractions open. Those meet
in blocks again, round by round, until a source has one block. Its flight leaves out RESERVE documents; the landing tries
all 0/1 values of those and the last two fractions and takes the nearest to the targets. Draws are seeded by source and block and rows are ordered by key, so reruns agree.

Defined results: null and empty text have size 0; a source of size 0 has target 0 and its documents are not taken; rows
that repeat a doc_id are one unit (its size their sum, its source the first) and share the decision; rows of null doc_id
are one unit as well; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import WORD_PATTERN, cut

BLOCK = 128
RESERVE = 10
SEED = 7
WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, source_size, target for rows (source, size): weights by code point order (null last), water-filled under the caps.

    One row a source; the two ordered sums below run over those rows alone.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int")))
    per = per.withColumn("limit", F.col("source_size") * F.lit(cap)).withColumn("ratio", F.col("limit") / F.col("w"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    per = per.withColumn("level", (F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    # the first source, by ratio, that the level reached without filling it fixes the level of all that follow
    level = F.first(F.when(F.col("level") < F.col("ratio"), F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    target = F.when(level.isNull(), F.col("limit")).otherwise(F.least(level * F.col("w"), F.col("limit")))
    return per.select("source", "source_size", target.alias("target"))


def flight(pi: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Moves pi until at most two entries are fractions; keeps sum(pi) and sum(pi * size), and each entry in expectation."""
    p = pi.astype(float).tolist()
    z = size.astype(float).tolist()
    eps = 1e-9
    held: list[int] = []
    for i in range(len(p)):
        if not eps < p[i] < 1 - eps:
            p[i] = float(round(p[i]))
            continue
        held.append(i)
        while len(held) == 3 or len(held) == 2 and z[held[0]] == z[held[1]]:
            if len(held) == 2:
                u = [1.0, -1.0]
            else:
                a, b, c = (z[k] for k in held)
                u = [b - c, c - a, a - b]
                if not any(u):
                    u = [1.0, -1.0, 0.0]
                top = max(map(abs, u))
                u = [x / top for x in u]
            up = min((1 - p[k]) / x if x > 0 else p[k] / -x for k, x in zip(held, u, strict=True) if x)
            down = min(p[k] / x if x > 0 else (1 - p[k]) / -x for k, x in zip(held, u, strict=True) if x)
            step = up if rng.random() * (up + down) < down else -down
            for k, x in zip(held, u, strict=True):
                p[k] += step * x
                if p[k] < eps or p[k] > 1 - eps:
                    p[k] = float(round(p[k]))
            held = [k for k in held if 0.0 < p[k] < 1.0]
    return np.array(p)


def landing(pi: np.ndarray, size: np.ndarray) -> np.ndarray:
    """0/1 values for at most RESERVE + 2 fractions: documents within one of what they stand for, then the words nearest."""
    open_ = np.flatnonzero((pi > 0) & (pi < 1))
    out = pi.copy()
    choices = np.arange(1 << len(open_))[:, None] >> np.arange(len(open_)) & 1
    docs_off = np.abs(choices.sum(1) - pi[open_].sum())
    words_off = np.abs(choices @ size[open_] - (pi[open_] * size[open_]).sum())
    out[open_] = choices[np.lexsort((np.arange(len(choices)), docs_off, words_off.round(6), docs_off > 1))[0]]
    return out


def finish(pi: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The last block of a source: a flight that leaves out RESERVE documents of all sizes, then the landing of what is open."""
    out = pi.copy()
    kept = np.unique(np.linspace(len(pi) // 5, len(pi) - 1, RESERVE).astype(int))
    flown = np.setdiff1d(np.arange(len(pi)), kept)
    out[flown] = flight(pi[flown], size[flown], rng)
    return landing(out, size)


def _round(units: DataFrame, blocks: Column, last: bool, seed: int) -> DataFrame:
    """One round of flights over (unit, source, size, pi) in blocks of a source."""

    def fly(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        # large documents first: the fractions left open at the end are then of small ones
        pdf = pdf.sort_values(["size", "order", "unit"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        rng = np.random.default_rng([seed, int(pdf["source_hash"].iloc[0]) & 0xFFFFFFFF, int(key[1])])
        size = pdf["size"].to_numpy()
        pdf["pi"] = (finish if last else flight)(pdf["pi"].to_numpy(), size, rng)
        return pdf[["unit", "source", "size", "pi"]]

    dealt = units.withColumn("order", F.xxhash64(F.lit(seed), "unit")).withColumn("source_hash", F.xxhash64(F.coalesce("source", F.lit("\0"))))
    dealt = dealt.withColumn("block", F.pmod("order", blocks).cast("int"))
    return dealt.groupBy("source", "block").applyInPandas(
        lambda key, pdf: fly(key, pdf), "unit long, source string, size long, pi double"
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """doc_id, source, size, source_size, target, copies (0, 1 or 2), taken (= copies * size): a row for each of docs."""
    rows = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    targets = cut(source_targets(rows, weights, share, cap), "mix-targets")
    units = rows.groupBy(F.col("doc_id").alias("unit")).agg(F.min("source").alias("source"), F.sum("size").alias("size"))
    same_source = F.col("t.source").eqNullSafe(F.col("u.source"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = units.alias("u").join(targets.alias("t"), same_source).select("unit", "u.source", "size", rate.alias("rate"))
    units = units.withColumn("base", F.floor(F.col("rate") + 1e-12).cast("int"))
    units = cut(units.withColumn("pi", F.greatest(F.col("rate") - F.col("base"), F.lit(0.0))), "mix-units")
    is_open = (F.col("pi") > 1e-9) & (F.col("pi") < 1 - 1e-9)
    open_units = units.filter(is_open).select("unit", "source", "size", "pi")
    done = None
    step = 0
    while True:
        counts = cut(open_units.groupBy("source").agg(F.count("*").alias("n")), "mix-counts")
        most = counts.agg(F.max("n")).first()[0] or 0
        last = most <= block
        blocks = counts.select(F.col("source").alias("s"), F.ceil(F.col("n") / block).cast("long").alias("blocks"))
        dealt = open_units.join(blocks, F.col("source").eqNullSafe(F.col("s"))).drop("s")
        flown = cut(_round(dealt, F.col("blocks"), last, seed + step), "mix-flight")
        closed = flown.filter(~is_open)
        done = closed if done is None else done.unionByName(closed)
        if last:
            break
        open_units = flown.filter(is_open)
        step += 1
    fixed = done.select(F.col("unit").alias("done_unit"), F.round("pi").cast("int").alias("extra"))
    decided = units.join(fixed, F.col("unit").eqNullSafe(F.col("done_unit")), "left")
    decided = decided.select("unit", (F.col("base") + F.coalesce("extra", F.lit(0))).alias("copies"))
    out = rows.join(decided, F.col("doc_id").eqNullSafe(F.col("unit"))).alias("u")
    out = out.join(targets.alias("t"), same_source)
    return out.select("doc_id", "u.source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))
