"""N-gram Jaccard self-join by universe partition and pigeonhole.

A document is the set of its hashed word shingles. Two sets of sizes a and b with the wanted similarity differ in at most
H = (a + b)(100 - p) / (100 + p) elements. Sizes fall into bands so that partners lie in one band or the next. A band cuts
the hash universe into segments, each with a threshold: 0 (the sets' subsets there must be equal) or 1 (they may differ by
one element, found through one-deletion neighbourhoods). If the thresholds plus one sum to H + 1 over the segments, two
similar sets must agree in one of them. How many segments of either kind a band gets is chosen by cost, measured on a
sample of at most SAMPLE sets: signatures a set writes, and looks at other sets that share one, at the size of the whole
table. Only that choice comes from the sample; every set is indexed, and any choice finds all links. With the costs timed on
the test tables, equal segments alone are cheapest nearly everywhere: at 90 % and three words in 74 of 75 bands of sf0.1 and
all 78 of check_l, at 80 % and five words in all 39 and all 41; making and moving the signatures of one-deletion
neighbourhoods costs more there than the looks that they save. They win where very many short texts share a passage. A
larger set that looks into the band below has a smaller H of its own there and skips (threshold -1) its shortest, least
selective segments.

Equal sets are one node from the start, whatever the number of copies. Signatures that the sample shows to be held by very
many sets are salted where nodes meet by signature. Then, in work linear in the nodes of a signature, every node is
compared exactly with the least node of each of its signatures (a pivot; its partners are dealt out in blocks), and the
links found make components. Only signatures whose nodes still lie in different components are looked at further: nodes of
the largest component of a signature meet the others, never one another, in blocks of about LOOKS; those whose sizes and
histograms over the hash universe cannot exclude the similarity are compared exactly, again across components only. So a
group of G near copies costs G, not G x G, whatever part of the rows it has; what stays quadratic are different texts
that share a signature without being linked, and those are looked at by size and histogram first.
Shingles are 64-bit hashes: within two sets of 10^4 shingles the chance of any collision is below 10^-11. Nodes meet by the
signatures of one of SLICES slices after the other, so the disk holds the shuffles of one; the signatures themselves are
deleted when all nodes have met.

Defined results: null text, or text without words, has the empty set and links with nothing; fewer words than a shingle
are one shingle; rows that repeat a doc_id are one document, linked with what any of them is linked with; a null doc_id is
linked with nothing and is in no component; an empty table gives an empty result; other columns are not touched.
"""

from __future__ import annotations

import hashlib
import logging
import time
from collections.abc import Callable, Iterator, Mapping
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import cut, discard, grouped, held, release, slices, tidy
from strandline.llm.graph import components

SHINGLE, PERCENT = 3, 90
#: Partners of a pivot in a block, and sets on a side of what is compared at once; nodes in a block of looks; elements of the
#: sets of a block that is compared exactly.
BLOCK = 128
LOOKS = 1024
ELEMENTS = 400_000
#: Words whose hashes a worker keeps; rows, and about as many bytes of text, that a task has in hand.
CACHE_WORDS = 120_000
ROWS, OCTETS = 512, 4 << 20
COLUMNS = 8192
#: Sets from which costs are measured; in how many of them a signature is called hot, and the parts it is then dealt into.
SAMPLE, HOT, SALTS = 2048, 24, 64
#: Parts of the signatures by which nodes meet one after another.
SLICES = 4
#: Seconds x 10^6 of Spark's tasks for moving and matching a signature; what making one and a look at another set's size and
#: histogram cost is measured with the sample.
MOVED = 1.4

log = logging.getLogger(__name__)

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = (x ^ x >> np.uint64(30)) * _M2
    x = (x ^ x >> np.uint64(27)) * _M3
    return x ^ x >> np.uint64(31)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out


def word_hashes() -> WordHashes:
    return held("ngram_join", WordHashes)


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; words are parted by [\\x20\\x09-\\x0D] and A-Z lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(word_hashes().__getitem__, words), np.uint64, len(words))
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(h.tobytes(), seed=len(words))], np.uint64)
    out = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        out = mix(out * _M1 + h[k : len(h) - size + 1 + k])
    return np.unique(out)


def largest_partner(a: int, percent: int) -> int:
    return a * 100 // percent


def largest_difference(a: int, b: int, percent: int) -> int:
    return (a + b) * (100 - percent) // (100 + percent)


@lru_cache(8)
def band_limits(percent: int, top: int = 1 << 32) -> np.ndarray:
    """Lower ends of the bands; a set's partners are in its band or a neighbouring one."""
    out = [1]
    while out[-1] < top:
        out.append(max(out[-1] + 1, largest_partner(out[-1] - 1, percent) + 1))
    return np.array(out, np.int64)


@lru_cache(1024)
def covered(band: int, percent: int) -> int:
    """The largest H of two partners of which the larger one is in the band."""
    limits = band_limits(percent)
    high = int(limits[band + 1]) - 1
    return largest_difference(high, largest_partner(high, percent), percent)


def choices(band: int, percent: int) -> list[int]:
    """Numbers of threshold-1 segments whose costs are compared: none, some shares, and as many as there can be."""
    h = covered(band, percent)
    return sorted({min((h + 1) // 2, round((h + 1) * share)) for share in (0, 0.125, 0.25, 0.5)})


def _segment_signatures(tokens: np.ndarray, band: int, percent: int, ones: int, own_h: int | None) -> np.ndarray:
    """Signatures in a band of which the first `ones` segments have threshold 1. The lowest bit says whether a signature is
    that of a whole segment (1) or of one less an element (0): the latter only match the former, not one another."""
    h = covered(band, percent)
    m = h + 1 - ones
    edges = np.arange(m + 1, dtype=np.uint64) * np.uint64((1 << 32) // m)
    edges[m] = np.uint64(1 << 32)
    at = np.searchsorted(tokens >> np.uint64(32), edges)
    mixed = mix(tokens ^ _M1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    whole = sums[at[1:]] - sums[at[:-1]]
    label = mix(np.arange(m, dtype=np.uint64) + np.uint64(band << 32))
    used = np.ones(m, bool)
    if own_h is not None and h > own_h:
        spare, length = h - own_h, np.diff(at)
        for s in np.argsort(length, kind="stable"):
            worth = 2 if s < ones else 1
            if worth <= spare:
                used[s] = False
                spare -= worth
            if not spare:
                break
    out = [mix(whole + label)[used] | np.uint64(1)]
    if ones:
        segment = np.repeat(np.arange(m), np.diff(at))
        close = (segment < ones) & used[segment]
        out.append(mix(whole[segment[close]] - mixed[close] + label[segment[close]]) & ~np.uint64(1))
    return np.concatenate(out)


def bands_of(n: int, percent: int) -> list[tuple[int, int | None]]:
    """The bands that a set of n elements signs in, with the H that it needs there if that is less than the band covers."""
    limits = band_limits(percent)
    band = int(np.searchsorted(limits, n, "right")) - 1
    out: list[tuple[int, int | None]] = [(band, None)]
    if band and largest_partner(int(limits[band]) - 1, percent) >= n:
        out.append((band - 1, largest_difference(int(limits[band]) - 1, n, percent)))
    return out


def signatures(tokens: np.ndarray, percent: int = PERCENT, ones: Mapping[int, int] | None = None) -> np.ndarray:
    """A set's signatures: in its own band, and in the band below if a partner can be there. ones: threshold-1 segments of
    the bands that have any."""
    if not len(tokens):
        return np.zeros(0, np.int64)
    ones = ones or {}
    out = [_segment_signatures(tokens, band, percent, ones.get(band, 0), own_h) for band, own_h in bands_of(len(tokens), percent)]
    return np.unique(np.concatenate(out)).view(np.int64)


def histogram(tokens: np.ndarray) -> np.ndarray:
    """How many elements fall into each of 2^k equal parts of the hash universe, about a quarter as many parts as elements.

    Two sets differ in at least as many elements as their histograms' counts differ in; a finer one folds onto a coarser.
    """
    bits = max(4, (len(tokens) // 2).bit_length() - 1)
    return np.minimum(np.bincount(tokens >> np.uint64(64 - bits), minlength=1 << bits), 255).astype(np.uint8)


def _fold(counts: np.ndarray, parts: int) -> np.ndarray:
    return counts.astype(np.int32).reshape(parts, -1).sum(1)


def possible(sizes: np.ndarray, counts: list[np.ndarray], percent: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which of the nodes left and right may have the wanted similarity, by size and by histogram; never a false no."""
    parts = min(map(len, counts))
    folded = np.array([_fold(c, parts) for c in counts])
    across, n = folded[right], sizes[right]
    out = np.zeros((len(left), len(right)), bool)
    for row, k in enumerate(left):  # a row at a time: only the answers are a matrix
        near = np.minimum(n, sizes[k]) * 100 >= percent * np.maximum(n, sizes[k])
        out[row] = near & (np.abs(across - folded[k]).sum(1) <= (sizes[k] + n) * (100 - percent) // (100 + percent))
    return out


def near_pairs(a: np.ndarray, a_parts: list[np.ndarray], b: np.ndarray, b_parts: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the pairs of nodes, of sizes a and b, may have the wanted similarity, by histogram; never a false no."""
    most = (a + b) * (100 - percent) // (100 + percent)
    out = np.zeros(len(a), bool)
    for k, (x, y) in enumerate(zip(a_parts, b_parts, strict=True)):
        parts = min(len(x), len(y))
        out[k] = np.abs(_fold(x, parts) - _fold(y, parts)).sum() <= most[k]
    return out


class Filter(NamedTuple):
    """What excludes pairs of nodes by their sizes and parts alone: of pairs in rows, and of two lists of nodes."""

    pairs: Callable[[np.ndarray, list[np.ndarray], np.ndarray, list[np.ndarray], int], np.ndarray]
    lists: Callable[[np.ndarray, list[np.ndarray], int, np.ndarray, np.ndarray], np.ndarray]
    unit: type = np.uint8


HISTOGRAMS = Filter(near_pairs, possible)


def counted(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """How many elements each of left shares with each of right (or of left), as a matrix."""
    sets = left + (right or [])
    sizes = np.array([len(s) for s in sets])
    tokens, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, row = tokens[order], row[order]
    new = np.r_[True, tokens[1:] != tokens[:-1]][: len(tokens)]
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1 if len(column) else new
    row, column = row[shared], np.cumsum(new & shared)[shared] - 1
    k = len(left)
    counts = np.zeros((k, len(right) if right else k), np.int64)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        lo, hi = np.searchsorted(column, [start, start + COLUMNS])
        x = np.zeros((len(sets), min(COLUMNS, int(column[hi - 1]) - start + 1)), np.float32)
        x[row[lo:hi], column[lo:hi] - start] = 1
        counts += (x[:k] @ (x[k:] if right else x).T).astype(np.int64)
    if not right:
        np.fill_diagonal(counts, sizes)
    return counts


def _links(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """Which of left and right (or of left among themselves) have the wanted similarity, as a matrix."""
    sizes = np.array([len(s) for s in left + (right or [])])
    counts = counted(left, right)
    k = len(left)
    a, b = sizes[:k, None], (sizes[k:] if right else sizes)[None, :]
    return counts * 100 >= percent * (a + b - counts)


def _forest(linked: np.ndarray, square: bool) -> list[tuple[int, int]]:
    """A spanning forest of the link matrix (rows with columns, or a square one's rows among themselves)."""
    out: list[tuple[int, int]] = []
    todo_rows, todo_columns = np.ones(linked.shape[0], bool), np.ones(linked.shape[1], bool)
    for root in range(linked.shape[0]):
        if not todo_rows[root]:
            continue
        todo_rows[root] = False
        if square:
            todo_columns[root] = False
        queue = [(root, True)]
        while queue:
            x, is_row = queue.pop()
            if is_row:
                reached = np.flatnonzero(linked[x] & todo_columns)
                out += [(x, int(y)) for y in reached]
            else:
                reached = np.flatnonzero(linked[:, x] & todo_rows)
                out += [(int(y), x) for y in reached]
            (todo_columns if is_row else todo_rows)[reached] = False
            if square:
                todo_rows[reached] = False
                queue += [(int(y), True) for y in reached]
            else:
                queue += [(int(y), not is_row) for y in reached]
    return out


def _look_seconds(sets: list[np.ndarray], percent: int) -> float | None:
    """How long a look at another set's size and histogram takes, of those of about equal size among the sets."""
    if len(sets) < 2:
        return None
    near = sorted(sets, key=len)[len(sets) // 4 : 3 * len(sets) // 4 + 1]
    sizes, parts, every = np.array([len(x) for x in near]), [histogram(x) for x in near], np.arange(len(near))
    began = time.perf_counter()
    possible(sizes, parts, percent, every, every)
    return (time.perf_counter() - began) / len(near) ** 2


def measured(docs: DataFrame, percent: int, size: int, sample: int = SAMPLE) -> tuple[dict[int, int], dict[int, dict[int, float]], list[int]]:
    """(threshold-1 segments by band, cost a set by band and choice, hot signatures), from about `sample` different texts.

    For every choice of a band: the signatures of a set, and the pairs that share one, counted once for all signatures of
    the same sets and carried on from the sample to all rows. Returned are a few numbers a band and less than
    sample x signatures / HOT hot signatures.
    """
    texts = docs.select("text").filter("text IS NOT NULL").withColumn("h", F.xxhash64("text"))
    rows = docs.count()
    times = max(1, rows // sample)
    few = texts.filter(F.pmod(F.xxhash64("h"), F.lit(times)) == 0).groupBy("h").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n in slices(batch.column(1), 64, OCTETS):
                out = []
                sets = [shingle_set(t, size) for t in batch.column(1).slice(start, n).to_pylist()]
                look = _look_seconds([x for x in sets if len(x)], percent)
                for tokens in sets:
                    node = int(np.bitwise_xor.reduce(tokens)) >> 1 if len(tokens) else 0
                    for band, own_h in bands_of(len(tokens), percent) if len(tokens) else []:
                        for k in choices(band, percent):
                            began = time.perf_counter()
                            sigs = np.unique(_segment_signatures(tokens, band, percent, k, own_h)).view(np.int64)
                            out.append((band, k, node, time.perf_counter() - began, look, sigs))
                if out:
                    bands, ks, nodes, spent, looked, sigs = zip(*out, strict=True)
                    ends = pa.array(np.cumsum([0, *map(len, sigs)]), pa.int32())
                    values = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sigs), pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(bands, pa.int32()), pa.array(ks, pa.int32()), pa.array(nodes, pa.int64()), pa.array(spent, pa.float64()), pa.array(looked, pa.float64()), values], names=["band", "ones", "node", "spent", "look", "sigs"])

    signed = cut(few.mapInArrow(tidy(run), "band int, ones int, node long, spent double, look double, sigs array<long>").dropDuplicates(["band", "ones", "node"]), "sample")
    counts = signed.groupBy("band", "ones").agg(F.count("*").alias("sets"), F.sum(F.size("sigs")).alias("sigs"), F.sum("spent").alias("spent")).collect()
    look = 1e6 * (signed.agg(F.percentile_approx("look", 0.5)).first()[0] or 0.0)
    each = signed.select("band", "ones", "node", F.explode("sigs").alias("s")).select("band", "ones", "node", F.col("s").bitwiseAND(-2).alias("sig"), F.col("s").bitwiseAND(1).alias("whole"))
    shared = each.groupBy("band", "ones", "sig").agg(F.count("*").alias("members"), F.bit_xor(F.xxhash64("node")).alias("who"), F.max("whole").alias("whole"))
    shared = shared.filter("members > 1 AND whole = 1").drop("whole")
    shared = cut(shared, "sample-shared")
    once = shared.select("band", "ones", "members", "who").distinct()
    looks = {(r["band"], r["ones"]): r["looks"] for r in once.groupBy("band", "ones").agg(F.sum(F.expr("members * (members - 1) / 2")).alias("looks")).collect()}
    costs: dict[int, dict[int, float]] = {}
    for r in counts:
        own = 1e6 * r["spent"] + MOVED * r["sigs"] + look * looks.get((r["band"], r["ones"]), 0.0) * times
        costs.setdefault(r["band"], {})[r["ones"]] = own / r["sets"]
    chosen = {band: min(own, key=lambda k: (own[k], k)) for band, own in costs.items()}
    hot = [r["sig"] for r in shared.filter(F.col("members") >= HOT).select("sig", "band", "ones").collect() if chosen[r["band"]] == r["ones"]]
    discard(signed)
    discard(shared)
    return {band: k for band, k in chosen.items() if k}, costs, sorted(set(hot))


def signed_sets(docs: DataFrame, percent: int, size: int, ones: Mapping[int, int], hot: list[int]) -> DataFrame:
    """doc_id, node (128-bit fingerprint of the shingle set), n, parts (its histogram), sigs, hots (signatures that are hot)."""
    heated = np.array(hot, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lists(arrays: list[np.ndarray]) -> pa.Array:
            ends = pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32())
            return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(arrays), pa.int64()))

        for batch in batches:
            for start, n in slices(batch.column(1), ROWS, OCTETS):
                part = batch.slice(start, n)
                nodes, sizes, parts, sigs, hots = [], [], [], [], []
                for t in part.column(1).to_pylist():
                    tokens = shingle_set(t, size)
                    nodes.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                    sizes.append(len(tokens))
                    parts.append(histogram(tokens).tobytes())
                    own = signatures(tokens, percent, ones)
                    is_hot = np.isin(own & ~np.int64(1), heated) if len(heated) else np.zeros(len(own), bool)
                    sigs.append(own[~is_hot])
                    hots.append(own[is_hot])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(parts, pa.binary()), lists(sigs), lists(hots)],
                    names=["doc_id", "node", "n", "parts", "sigs", "hots"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(tidy(run), "doc_id long, node binary, n long, parts binary, sigs array<long>, hots array<long>")


def slice_of(own: DataFrame, k: int, of: int) -> DataFrame:
    """own with those of its sigs and hots that are in the k-th of so many slices; the lowest bit has no part in that."""

    def kept(column: str) -> Column:
        return F.filter(column, lambda s: F.pmod(F.shiftright(s, 1), F.lit(of)) == k).alias(column)

    return own.select(*(kept(c) if c in ("sigs", "hots") else c for c in own.columns))


def shared_signatures(own: DataFrame) -> DataFrame:
    """sig, whole, rep of the signatures that several nodes have, one of them as a whole segment; own: rep, sigs, hots. Hot
    signatures are dealt by salt as well and all kept here."""
    salt = F.lit(1) + F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int")
    cold = F.transform("sigs", lambda s: F.struct(s.alias("sig"), F.lit(0).alias("salt")))
    hot = F.transform("hots", lambda s: F.struct(s.alias("sig"), salt.alias("salt")))
    entries = own.select("rep", F.explode(F.concat(cold, hot)).alias("e"))
    entries = entries.select("rep", F.col("e.sig").bitwiseAND(-2).alias("sig"), F.col("e.sig").bitwiseAND(1).cast("byte").alias("whole"), "e.salt")
    same = Window.partitionBy("sig", "salt")
    entries = entries.select("sig", "whole", "rep", "salt", F.min("rep").over(same).alias("least"), F.max("rep").over(same).alias("most"), F.max("whole").over(same).alias("any"))
    # rows that repeat a doc_id repeat its signatures; what follows needs each once
    return entries.filter("salt > 0 OR least <> most AND any = 1").select("sig", "whole", "rep").distinct()


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["u", "v"])


def pivot_links(pairs: DataFrame, seen: DataFrame, texts: DataFrame, percent: int, size: int, block: int = BLOCK, by: Filter = HISTOGRAMS) -> DataFrame:
    """Those of the pairs (u, v: node and pivot) that have the wanted similarity. Sizes and histograms are looked at first;
    then the partners of a pivot are dealt out in blocks, and the pivot's text goes to each of them."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            fits = np.minimum(a, b) * 100 >= percent * np.maximum(a, b)
            at = np.flatnonzero(fits)
            x, y = ([np.frombuffer(v.as_buffer(), by.unit) for v in batch.column(c).take(pa.array(at))] for c in (3, 5))
            fits[at] = by.pairs(a[at], x, b[at], y, percent)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(fits)), batch.column(1).filter(pa.array(fits))], names=["u", "v"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for group in grouped(batches, ["v", "block"]):
            reps, pivot = group.column("rep").to_pylist(), group.column("v")[0].as_py()
            sets = [shingle_set(t, size) for t in group.column("text").to_pylist()]
            of_pivot = [s for r, s in zip(reps, sets, strict=True) if r == pivot]
            for r, s in zip(reps, sets, strict=True):
                if r != pivot and any(alike(s, p, percent) for p in of_pivot):
                    found.append((r, pivot))
            if len(found) > 50_000:
                yield _pairs(found)
                found = []
        if found:
            yield _pairs(found)

    u, v = (seen.select(F.col("rep").alias(k), F.col("n").alias(f"n{k}"), F.col("parts").alias(f"parts{k}")) for k in "uv")
    met = pairs.join(u.hint("merge"), "u").join(v.hint("merge"), "v").select("u", "v", "nu", "partsu", "nv", "partsv")
    near = cut(met.mapInArrow(tidy(look), "u long, v long").distinct(), "near")
    many = near.groupBy("v").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = near.join(many, "v").select("v", F.col("u").alias("rep"), F.pmod(F.xxhash64("u"), F.col("blocks")).cast("int").alias("block"))
    dealt = dealt.unionByName(many.select("v", F.col("v").alias("rep"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = texts.join(dealt.hint("merge"), "rep").select("v", "block", "rep", "text")
    met = met.repartition(n, "v", "block").sortWithinPartitions("v", "block")
    links = cut(met.mapInArrow(tidy(verify), "u long, v long").distinct(), "pivot-links")
    discard(near)
    return links


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common * 100 >= percent * (len(a) + len(b) - common)


def with_main(rows: DataFrame, key: str, weight: Column | None = None) -> DataFrame:
    """Of rows (key, rep, label) those whose key has several labels, with is_main (the key's most frequent label, the least
    of equals), n_main and members: the weight (1 a row) of the main label's rows and of all."""
    per = rows.groupBy(key, "label").agg(F.count("*").alias("c"), F.sum(F.lit(1) if weight is None else weight).alias("w"))
    order = F.struct("c", -F.col("label"))
    per = per.groupBy(key).agg(F.max_by("label", order).alias("main"), F.max_by("w", order).alias("n_main"), F.sum("w").alias("members"), F.count("*").alias("labels"))
    per = cut(per.filter("labels > 1").drop("labels"), "mains")
    return rows.join(per.hint("merge"), key).withColumn("is_main", F.col("label") == F.col("main")).drop("main")


def in_blocks(rows: DataFrame, per_block: int) -> DataFrame:
    """rows with block, bi and bj. The main label's nodes are cut into blocks -1, -2 and so on of about per_block in weight,
    the others into blocks 0, 1 and so on. Every two blocks meet, other than two of the main label, whose nodes are linked
    already."""
    mains = F.ceil(F.col("n_main") / per_block).cast("int")
    others = F.ceil((F.col("members") - F.col("n_main")) / per_block).cast("int")
    place = F.xxhash64("rep")
    block = F.when(F.col("is_main"), -1 - F.pmod(place, mains)).otherwise(F.pmod(place, others)).cast("int")
    first = F.when(F.col("is_main"), 0).otherwise(-mains)
    met = rows.withColumn("block", block).withColumn("o", F.explode(F.sequence(first, others - 1)))
    return met.withColumn("bi", F.least("block", "o")).withColumn("bj", F.greatest("block", "o")).drop("o", "n_main", "members", "is_main")


def _apart(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return labels[left][:, None] != labels[right][None, :]


def candidates(shared: DataFrame, percent: int, looks: int = LOOKS, by: Filter = HISTOGRAMS) -> DataFrame:
    """Links (u, v) that span, for every signature, the nodes of different labels that may be similar; shared: sig, rep, n,
    parts, label and the columns of with_main()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[int, int]] = set()
        for group in grouped(batches, ["sig", "bi", "bj"]):
            if group.num_rows < 2:
                continue
            reps, sizes, block = group.column("rep").to_pylist(), group.column("n").to_numpy(), group.column("block").to_numpy()
            parts = [np.frombuffer(c, by.unit) for c in group.column("parts").to_pylist()]
            bi, bj = group.column("bi")[0].as_py(), group.column("bj")[0].as_py()
            left, right = np.flatnonzero(block == bi), np.flatnonzero(block == bj)
            near = by.lists(sizes, parts, percent, left, right) & _apart(group.column("label").to_numpy(), left, right)
            found.update((reps[left[x]], reps[right[y]]) for x, y in _forest(near, bi == bj))
            if len(found) > 50_000:
                yield _pairs(list(found))
                found = set()
        if found:
            yield _pairs(list(found))

    n = int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = in_blocks(shared, looks).repartition(n, "sig", "bi", "bj").sortWithinPartitions("sig", "bi", "bj", "rep")
    return dealt.select("sig", "rep", "n", "parts", "label", "block", "bi", "bj").mapInArrow(tidy(run), "u long, v long")


def _tiles(at: np.ndarray, tile: int) -> list[np.ndarray]:
    return [at[k : k + tile] for k in range(0, len(at), tile)]


def verified(placed: DataFrame, texts: DataFrame, percent: int, size: int, elements: int = ELEMENTS, tile: int = BLOCK) -> DataFrame:
    """Spanning links (u, v) of the true links between labels within candidate groups; placed: rep, label, grp and the
    columns of with_main() by elements; texts: rep, text.

    A block holds sets of about `elements` elements together, so a text of n shingles in a group of S shingles is moved about
    S / elements times, and a task has two blocks in hand; inside, sets are compared a tile with a tile.
    """

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int]] = []
        for group in grouped(batches, ["grp", "bi", "bj"]):
            reps, blocks, labels = group.column("rep").to_pylist(), group.column("block").to_numpy(), group.column("label").to_numpy()
            bi, bj = group.column("bi")[0].as_py(), group.column("bj")[0].as_py()
            left, right = np.flatnonzero(blocks == bi), np.flatnonzero(blocks == bj)
            if len(left) < (2 if bi == bj else 1) or not len(right):
                continue
            sets = [shingle_set(t, size) for t in group.column("text").to_pylist()]
            for i, x in enumerate(_tiles(left, tile)):
                for j, y in enumerate(_tiles(right, tile)):
                    same = bi == bj and i == j
                    if bi == bj and j < i or not (labels[x][:, None] != labels[y][None, :]).any():
                        continue
                    linked = _links([sets[k] for k in x], None if same else [sets[k] for k in y], percent) & _apart(labels, x, y)
                    found += [(reps[x[u]], reps[y[v]]) for u, v in _forest(linked, same)]
            if len(found) > 50_000:
                yield _pairs(found)
                found = []
        if found:
            yield _pairs(found)

    dealt = in_blocks(placed, elements).select("grp", "rep", "label", "block", "bi", "bj")
    met = texts.join(dealt.hint("merge"), "rep").select("grp", "rep", "label", "block", "bi", "bj", "text")
    n = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = met.repartition(n, "grp", "bi", "bj").sortWithinPartitions("grp", "bi", "bj")
    return met.mapInArrow(tidy(verify), "u long, v long")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows (rep, ...) with label: the component of rep, or rep itself."""
    own = labels.select(F.col("node").alias("rep"), "label")
    return rows.join(own.hint("merge"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))


def similar(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, looks: int = LOOKS, sample: int = SAMPLE, elements: int = ELEMENTS, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links): a row for each of docs."""
    ones, costs, hot = measured(docs, percent, size, sample)
    log.info("segments of threshold 1 by band: %s; costs a set: %s", ones, costs)
    sets = cut(signed_sets(docs, percent, size, ones, hot), "sets")
    return linked(docs, sets, percent, size, HISTOGRAMS, looks, elements, block)


def linked(docs: DataFrame, sets: DataFrame, percent: int, size: int, by: Filter, looks: int = LOOKS, elements: int = ELEMENTS, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id of documents (doc_id, text) by their signed sets (doc_id, node, n, parts, sigs, hots),
    which cut() wrote and which are deleted here: sets that share a signature are compared by what `by` can exclude, then
    exactly."""
    spark = docs.sparkSession
    rows = cut(sets.select("doc_id", "n", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("node")).alias("node")), "rows")
    known = rows.filter("node IS NOT NULL")
    reps = cut(known.groupBy("node").agg(F.min("doc_id").alias("rep")), "nodes")

    def owned(columns: DataFrame) -> DataFrame:
        return columns.filter("n > 0 AND doc_id IS NOT NULL").join(reps.hint("merge"), "node").filter("doc_id = rep")

    seen = cut(owned(sets.select("doc_id", "node", "n", "parts")).select("node", "rep", "n", "parts").dropDuplicates(["node", "rep"]).drop("node"), "seen")
    sliced = []
    for k in range(SLICES):
        own = owned(slice_of(sets.select("doc_id", "node", "n", "sigs", "hots"), k, SLICES))
        sliced.append(cut(shared_signatures(own.select("rep", "sigs", "hots")), "shared"))
        release(spark)
    discard(sets)
    shared = reduce(DataFrame.unionByName, sliced)
    # many signatures are shared by the same nodes: one of each such set is looked at
    marks = shared.groupBy("sig").agg(
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("rep")).alias("h1"), F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("h2"), F.min("rep").alias("least"), F.max("whole").alias("any")
    )
    firsts = marks.filter("size > 1 AND any = 1").groupBy("size", "h1", "h2").agg(F.min("sig").alias("sig"), F.min("least").alias("least")).select("sig", "least")
    once = cut(shared.select("sig", "rep").join(firsts.hint("merge"), "sig"), "once")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    pairs = once.filter("rep <> least").select(F.col("rep").alias("u"), F.col("least").alias("v")).distinct()
    # several texts of one doc_id are one document
    several = known.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("doc_id")
    same = known.select("doc_id", "node").join(several, "doc_id").join(reps, "node").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    links = cut(pivot_links(pairs, seen, texts, percent, size, block, by).unionByName(same), "links")
    near = cut(components(links), "labels")
    mixed = with_main(labelled(once.select("sig", "rep"), near), "sig")
    stars = cut(candidates(mixed.join(seen.hint("merge"), "rep"), percent, looks, by).distinct(), "candidates")
    for done in (*sliced, once, links):
        discard(done)
    release(spark)
    scratch = [seen, stars]
    roots = near
    if not stars.isEmpty():
        groups = components(stars)
        groups = groups.unionByName(groups.select(F.col("label").alias("node"), "label").distinct())
        placed = labelled(groups.select(F.col("node").alias("rep"), F.col("label").alias("grp")), near)
        placed = cut(placed.join(seen.groupBy("rep").agg(F.max("n").alias("n")).hint("merge"), "rep"), "placed")
        more = cut(verified(with_main(placed, "grp", F.col("n")), texts, percent, size, elements, block), "more-links")
        roots = cut(components(near.select(F.col("node").alias("u"), F.col("label").alias("v")).unionByName(more)), "roots")
        scratch += [near, placed, more]
    roots = roots.select(F.col("node").alias("rep"), "label")
    for done in scratch:
        discard(done)
    out = rows.join(reps, "node", "left").join(roots, "rep", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "rep", "doc_id").alias("component_id"))
