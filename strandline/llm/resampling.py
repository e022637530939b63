"""Importance resampling towards a target: documents drawn by how much more likely their words are in the target texts.

Features are all runs of 1 to ORDER consecutive words, joined by one space; a feature's bucket is the crc32 of its bytes
modulo BUCKETS. A task reads its texts into word tries: a node stands for a run of words, and holds how often it occurs and
the state of the crc32 after its bytes, which a child's is made from by its last word alone (a crc32 is linear: that of two
pieces is that of the first, moved on by as many bytes as the second has, xor that of the second). The nodes' counts give
totals by bucket, which are all that leaves a task. They are merged, BUCKETS rows whatever the corpus, and a bucket's gain
is 1000 times the logarithm of its share in the target over its share in the source, rounded down. For scoring, the tries
are grown again with the gains attached to the nodes, and a document's weight is the sum along its paths.

A trie is grown from about OCTETS bytes of texts and dropped before the next, so a task's memory does not grow with its
partition; totals add up however texts are dealt out. The draw adds noise of the Gumbel distribution, from the seed and the
doc_id, to the weights and takes the highest scores: sampling without replacement, the same in every run.

Defined results: A-Z are lower-cased, nothing else; words are what [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ finds in whole texts
of any length; null and empty texts and texts without words have no features and weight 0; repeated rows are separate
rows, each with its own rank; of equal scores the smaller doc_id goes first, null doc_ids last; an empty table gives no
rows; no target texts make all gains those of a target without features; other columns pass through, with underscores
behind the name of one that is called like a new column.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm.common import column_of, cut, passed, slices, tidy
from strandline.llm.fingerprints import key_ranges

BUCKETS, ORDER = 10_000, 3
PERCENT, LEAST_WORDS, SEED = 5, 20, 42
#: Rows, and about as many bytes of text, that a trie is grown from.
ROWS, OCTETS = 4096, 4 << 20
#: Bytes that a crc32 state is moved on by with tables; longer words are gone through byte by byte.
MOVES = 64
#: Rows of a range in which drawn documents are ranked.
RANGE_ROWS = 20_000

# Bytes of words as they are, A-Z as a-z, all others as a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _move_tables() -> np.ndarray:
    """[n, k, b]: a state of which byte k is b and the others are 0, moved on by n zero bytes."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, one >> 1 ^ np.uint32(0xEDB88320), one >> 1)  # the reversed polynomial of the crc32
    out = np.zeros((MOVES + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(1, MOVES + 1):
        out[n] = one[out[n - 1] & 255] ^ out[n - 1] >> 8
    return out


_TABLES = _move_tables()


class WordTrie:
    """The runs of 1 to `order` words of some texts, level by level: for every node its count and crc32, for every place of
    the texts the node of each level that begins there (-1: the text ends before)."""

    def __init__(self, texts: list[list[bytes]], order: int = ORDER) -> None:
        numbers: dict[bytes, int] = {}
        self.sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(self.sizes)
        self.starts = ends - self.sizes
        word = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, int(self.sizes.sum()))
        self.words = list(numbers)
        crc = np.fromiter((zlib.crc32(w) for w in self.words), np.uint32, len(self.words))
        self.spaced = np.fromiter((zlib.crc32(w, zlib.crc32(b" ")) for w in self.words), np.uint32, len(self.words))
        self.lengths = np.fromiter(map(len, self.words), np.int64, len(self.words)) + 1
        left = np.repeat(ends, self.sizes) - np.arange(len(word))  # words from a place to the end of its text
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        node = word
        for depth in range(1, order + 1):
            if depth > 1:
                fits = left >= depth
                parent, last = node[fits], word[np.flatnonzero(fits) + depth - 1]
                codes, keys = pd.factorize(parent * len(self.words) + last)
                crc = self.grown(crc[keys // len(self.words)], keys % len(self.words))
                node = np.full(len(word), -1, np.int64)
                node[fits] = codes
            self.levels.append((np.bincount(node[node >= 0], minlength=len(crc)), crc, node))

    def grown(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The crc32 of runs of words, from those of the runs without their last words (by number)."""
        n = np.minimum(self.lengths[word], MOVES)
        moved = _TABLES[n, 0, state & 255]
        for k in range(1, 4):
            moved ^= _TABLES[n, k, state >> np.uint32(8 * k) & 255]
        out = moved ^ self.spaced[word]
        for k in np.flatnonzero(self.lengths[word] > MOVES).tolist():
            out[k] = zlib.crc32(b" " + self.words[word[k]], int(state[k]))
        return out

    def totals(self, buckets: int) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        for count, crc, _ in self.levels:
            out += np.bincount(crc % np.uint32(buckets), count, buckets).astype(np.int64)
        return out

    def weights(self, gains: np.ndarray) -> np.ndarray:
        """For every text the sum of the gains of its features."""
        places = np.zeros(int(self.sizes.sum()), np.int64)
        for _, crc, node in self.levels:
            own = gains[crc % np.uint32(len(gains))]
            places += np.where(node >= 0, own[node], 0) if len(own) else 0
        sums = np.concatenate([[0], np.cumsum(places)])
        return sums[self.starts + self.sizes] - sums[self.starts]


def bucket_totals(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """bucket, n: how many features of all texts fall into each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(buckets, np.int64)
        for batch in batches:
            for start, n in slices(batch.column(0), ROWS, OCTETS):
                out += WordTrie([words_of(t) for t in batch.column(0).slice(start, n).to_pylist()], order).totals(buckets)
        held = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(out[held], pa.int64())], names=["bucket", "n"])

    counted = texts.select(column_of(text).cast("string")).mapInArrow(tidy(run), "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, gain for all buckets; source and target: bucket, n."""
    rows = source.sparkSession.range(0, buckets, 1, 1).withColumnRenamed("id", "bucket")
    s, t = (x.groupBy("bucket").agg(F.sum("n").alias(k)) for x, k in ((source, "s"), (target, "t")))
    all_s, all_t = ((x.agg(F.sum("n")).first()[0] or 0) + buckets for x in (source, target))
    rows = rows.join(s, "bucket", "left").join(t, "bucket", "left")
    own_s, own_t = (F.coalesce(c, F.lit(0)).cast("double") + 1 for c in ("s", "t"))
    return rows.select("bucket", F.floor(1000 * F.log(own_t * F.lit(float(all_s)) / (own_s * F.lit(float(all_t))))).alias("gain"))


def weigh(docs: DataFrame, gains: DataFrame, text: str = "text", order: int = ORDER, keep_text: bool = True) -> DataFrame:
    """docs (without the text, if that isn't wanted) with n_words, n_features and weight. gains: a row for every bucket; that
    many numbers go through the driver."""
    own = np.array([g for _, g in sorted((r["bucket"], r["gain"]) for r in gains.collect())], np.int64)
    new = ["n_words", "n_features", "weight"]
    names = {c: n for c, n in passed(docs.columns, new).items() if keep_text or c != text}
    # numbers for names on the way: Arrow functions take no names with dots
    rows = docs.select(*[column_of(c).alias(f"c{i}") for i, c in enumerate(names)], column_of(text).cast("string").alias("n_words"))
    schema = T.StructType([*rows.schema.fields[:-1], *[T.StructField(c, T.LongType()) for c in new]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n in slices(batch.column(batch.num_columns - 1), ROWS, OCTETS):
                part = batch.slice(start, n)
                trie = WordTrie([words_of(t) for t in part.column(part.num_columns - 1).to_pylist()], order)
                features = sum(np.maximum(trie.sizes - d, 0) for d in range(order))
                columns = [pa.array(x, pa.int64()) for x in (trie.sizes, features, trie.weights(own))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], names=schema.names)

    return rows.mapInArrow(tidy(run), schema).toDF(*names.values(), *new)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """1000 times a number of the Gumbel distribution, rounded down, that the seed and the doc_id determine."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(drawn, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def draw(weighed: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, per_range: int = RANGE_ROWS) -> DataFrame:
    """weighed (doc_id, n_words, weight, ...) with score and rank: 1, 2 and so on for the floor(percent * N / 100) highest
    scores of the N documents with at least least_words words, null elsewhere.

    Scores are cut into ranges of about per_range rows; a row's rank is the number of rows in the ranges above and its place
    in its own. Only ranges that the draw reaches are dealt out and sorted.
    """
    rows = cut(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn("_low", -F.col("score")), "weighed")
    able = rows.filter(F.col("n_words") >= least_words)
    wanted = able.count() * percent // 100
    none = F.lit(None).cast("long")
    if not wanted:
        return rows.drop("_low").withColumn("rank", none)
    place, _ = key_ranges(able, "_low", per_range)
    sizes = able.groupBy(place.alias("_place")).agg(F.count("*").alias("n"))
    above = F.sum("n").over(Window.orderBy("_place").rowsBetween(Window.unboundedPreceding, -1))
    # a row a range of per_range rows
    ahead = cut(sizes.select("_place", F.coalesce(above, F.lit(0)).alias("_ahead")), "ranges")
    last = ahead.filter(F.col("_ahead") < wanted).agg(F.max("_place")).first()[0]
    reached = (F.col("n_words") >= least_words) & (place <= last)
    inside = Window.partitionBy("_place").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    met = rows.filter(reached).withColumn("_place", place).join(ahead, "_place")
    rank = F.col("_ahead") + F.row_number().over(inside)
    met = met.withColumn("rank", rank).withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank"))).drop("_place", "_ahead")
    return met.unionByName(rows.filter(~reached).withColumn("rank", none)).drop("_low")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, keep_text: bool = True) -> DataFrame:
    """docs (doc_id, text, ...) with n_words, n_features, weight, score and rank, drawn towards the target's texts."""
    docs = docs.select(*[column_of(c).alias(n) for c, n in passed(docs.columns, ["n_words", "n_features", "weight", "score", "rank", "_low", "_place", "_ahead"]).items()])
    gains = cut(bucket_gains(cut(bucket_totals(docs), "source-totals"), cut(bucket_totals(target), "target-totals")), "gains")
    return draw(weigh(docs, gains, keep_text=keep_text), percent, least_words, seed)
