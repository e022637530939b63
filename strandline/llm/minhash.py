"""MinHash near-duplicates from bottom-k sketches of one hash function.

A document is the set of its hashed word shingles; its sketch are the SKETCH smallest hashes. Lists inverted by retained
values bring documents together: a list's key is RUN retained values that follow one another, so a frequent shingle with a
small hash does not make a list of half the corpus. Going up the sketch of two sets' union, each value is in both with the
probability of their similarity s, and two documents meet in a list if RUN in a row are: of SKETCH = 64 values at s = 0.8,
no 4 in a row are with a probability of 6e-7, and less above. Sets of fewer values than a sketch are whole in it, and of u
values of which at least four fifths are shared 4 in a row are for every u above 15; up to there keys of two values are added,
and two in a row always are.

Of documents that meet, the sketch of their union gives an estimate: the share of its values that both hold. Pairs below
LIKELY are left (at s = 0.8 a pair falls below 1/2 with a probability of 6e-7); those above are compared exactly, on the full
sets made again from the texts. Equal sets are one node from the start. What meets is compared with the least of a list
first, and components are never compared inside themselves: ngram_join.linked() does that, and its notes on skew hold.

Defined results: words are parted by [\\x20\\x09-\\x0D] and A-Z lower-cased; fewer words than a shingle are one shingle; null,
empty and blank texts have the empty set and link with nothing; rows that repeat a doc_id are one document with the texts of
all of them, each row having its own n_shingles; null doc_ids link with nothing; texts are read whole; an empty table gives
no rows; other columns are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import ngram_join
from strandline.llm.common import cut, slices, tidy

SHINGLE, PERCENT = 5, 80
SKETCH, RUN = 64, 4
LIKELY = 0.5
#: Sketches of fewer values have keys of two values as well.
SMALL = 16
ROWS, OCTETS = 512, 4 << 20
#: Texts in which keys are counted, and in how many of them a key is called hot.
SAMPLE, HOT = 2048, 24

_TURN = np.uint64(0x9E3779B97F4A7C15)


def sketch(tokens: np.ndarray, k: int = SKETCH) -> np.ndarray:
    """The k smallest of the sorted distinct hashes."""
    return tokens[:k].copy()


def _runs(values: np.ndarray, run: int) -> np.ndarray:
    out = np.full(len(values) - run + 1, np.uint64(run))
    for j in range(run):
        out = ngram_join.mix(out * _TURN + values[j : len(values) - run + 1 + j])
    return out


def keys(values: np.ndarray, run: int = RUN) -> np.ndarray:
    """The lists that a sketch is in."""
    if not len(values):
        return np.zeros(0, np.int64)
    out = [_runs(values, min(run, len(values)))]
    if 2 < len(values) < SMALL:
        out.append(_runs(values, 2))
    return (np.unique(np.concatenate(out)) | np.uint64(1)).view(np.int64)


def estimates(a: np.ndarray, b: np.ndarray, k: int = SKETCH) -> np.ndarray:
    """Estimated similarity of the rows of two matrices of sketches, filled up with the largest number."""
    end = np.uint64(0xFFFFFFFFFFFFFFFF)
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    real = both != end
    twice = np.zeros(both.shape, bool)
    twice[:, 1:] = (both[:, 1:] == both[:, :-1]) & real[:, 1:]
    place = np.cumsum(real & ~twice, axis=1)
    union = np.minimum(place[:, -1], k)
    shared = (twice & (place <= k)).sum(1)
    return np.where(union > 0, shared / np.maximum(union, 1), 1.0)


def _matrix(sketches: list[np.ndarray]) -> np.ndarray:
    out = np.full((len(sketches), SKETCH), np.uint64(0xFFFFFFFFFFFFFFFF))
    for row, s in zip(out, sketches, strict=True):
        row[: len(s)] = s
    return out


def near_pairs(a: np.ndarray, a_parts: list[np.ndarray], b: np.ndarray, b_parts: list[np.ndarray], percent: int) -> np.ndarray:
    if not len(a):
        return np.zeros(0, bool)
    return estimates(_matrix(a_parts), _matrix(b_parts)) >= LIKELY * percent / PERCENT


def near_lists(sizes: np.ndarray, parts: list[np.ndarray], percent: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """near_pairs() of all left with all right, where sizes and the number of shared values allow it."""
    shared = ngram_join.counted([parts[k] for k in left], [parts[k] for k in right])
    held = np.array([len(p) for p in parts])
    a, b = sizes[left][:, None], sizes[right][None, :]
    likely = LIKELY * percent / PERCENT
    # of u values of the union's sketch at least likely * u are shared, and u is at least the larger sketch
    out = (shared >= likely * np.maximum(held[left][:, None], held[right][None, :])) & (np.minimum(a, b) * 100 >= percent * np.maximum(a, b))
    x, y = np.nonzero(out)
    for start in range(0, len(x), 1 << 16):
        i, j = x[start : start + (1 << 16)], y[start : start + (1 << 16)]
        out[i, j] = near_pairs(sizes[left[i]], [parts[k] for k in left[i]], sizes[right[j]], [parts[k] for k in right[j]], percent)
    return out


SKETCHES = ngram_join.Filter(near_pairs, near_lists, np.uint64)


def sketched(docs: DataFrame, size: int, hot: list[int]) -> DataFrame:
    """doc_id, node (128-bit fingerprint of the shingle set), n, parts (its sketch), sigs, hots (lists that are hot)."""
    heated = np.array(hot, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lists(arrays: list[np.ndarray]) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(np.concatenate(arrays), pa.int64()))

        for batch in batches:
            for start, n in slices(batch.column(1), ROWS, OCTETS):
                part = batch.slice(start, n)
                nodes, sizes, parts, sigs, hots = [], [], [], [], []
                for t in part.column(1).to_pylist():
                    tokens = ngram_join.shingle_set(t, size)
                    own = keys(sketch(tokens))
                    is_hot = np.isin(own & ~np.int64(1), heated)
                    nodes.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                    sizes.append(len(tokens))
                    parts.append(sketch(tokens).tobytes())
                    sigs.append(own[~is_hot])
                    hots.append(own[is_hot])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(parts, pa.binary()), lists(sigs), lists(hots)],
                    names=["doc_id", "node", "n", "parts", "sigs", "hots"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(tidy(run), "doc_id long, node binary, n long, parts binary, sigs array<long>, hots array<long>")


def hot_lists(docs: DataFrame, size: int, sample: int = SAMPLE) -> list[int]:
    """Keys of at least HOT of about `sample` different texts: at most sample x SKETCH / HOT numbers. They are only dealt out
    differently; all texts are in all their lists."""
    texts = docs.select("text").filter("text IS NOT NULL").withColumn("h", F.xxhash64("text"))
    times = max(1, docs.count() // sample)
    few = texts.filter(F.pmod(F.xxhash64("h"), F.lit(times)) == 0).groupBy("h").agg(F.first("text").alias("text"))
    signed = sketched(few.select(F.col("h").alias("doc_id"), "text"), size, []).dropDuplicates(["node"])
    counts = signed.select(F.explode("sigs").alias("s")).groupBy(F.col("s").bitwiseAND(-2).alias("sig")).count().filter(F.col("count") >= HOT)
    return sorted(r["sig"] for r in counts.collect())


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, sample: int = SAMPLE, looks: int = ngram_join.LOOKS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links of percent and more): a row for each of docs."""
    if percent < PERCENT:
        raise ValueError(f"the sketches are made for similarities of {PERCENT} % and more")
    sets = cut(sketched(docs, size, hot_lists(docs, size, sample)), "sets")
    return ngram_join.linked(docs, sets, percent, size, SKETCHES, looks)
