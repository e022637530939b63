"""Language identification with hyperdimensional profiles.

Every letter has a random vector of DIMENSIONS signs, drawn from a seed and its code point. An n-gram's vector binds its
letters' vectors, each rotated by its place, by elementwise product; a text's vector bundles (adds) those of its n-grams
over letters, runs of anything else counting as one space; a language's prototype bundles its training texts. A text
gets the language whose prototype has the largest cosine with its vector.

Training sums are additive: a task keeps n-gram counts per language, bounded by FLUSH, and returns one integer vector per
language; Spark adds them with partial aggregation. Prototypes are (number of languages) x DIMENSIONS integers, and more
than MAX_LANGUAGES languages are refused, so what goes to the tasks has a fixed bound.

Defined results: null text, or text without a letter, is `und` with score 0; so is every text if nothing was learned.
Equal cosines go to the language first in code-point order. Rows that repeat are each predicted. Rows of null language
never train. Other columns pass through, with underscores behind names that the result has itself.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm.common import column_of, held, passed, slices, tidy

DIMENSIONS, ORDER, SEED = 1024, 3, 20240501
MAX_LANGUAGES = 1000
FLUSH = 200_000
BANK_ROWS, BANK_LETTERS = 20_000, 4096
ROWS, GRAMS = 64, 4096
OCTETS = 1 << 22
UNKNOWN = "und"


@lru_cache(1)
def letter_table() -> np.ndarray:
    """By code point: itself if it is a letter, else a space."""
    out = np.full(0x110000, 32, np.uint32)
    points = [c for c in range(0x110000) if unicodedata.category(chr(c))[0] == "L"]
    out[points] = points
    return out


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the distinct n-grams of text and their counts; both empty if it has no letter."""
    codes = letter_table()[np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)]
    space = codes == 32
    codes = codes[~(space & np.r_[False, space[:-1]])].astype(np.uint64)
    if len(codes) < ORDER:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = codes[: len(codes) - ORDER + 1].copy()
    for k in range(1, ORDER):
        grams = grams << np.uint64(21) | codes[k : len(codes) - ORDER + 1 + k]
    return np.unique(grams, return_counts=True)


class VectorBank:
    """Vectors of n-grams, kept in a bounded table of signs, a byte each."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.table = np.zeros((BANK_ROWS, dimensions), np.int8)

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            if len(self.letters) >= BANK_LETTERS:
                self.letters.clear()
            self.letters[point] = (np.random.default_rng([self.seed, point]).integers(0, 2, self.dimensions) * 2 - 1).astype(np.int8)
        return self.letters[point]

    def bind(self, gram: int) -> np.ndarray:
        out = np.ones(self.dimensions, np.int8)
        for k in range(ORDER):
            point = gram >> 21 * (ORDER - 1 - k) & 0x1FFFFF
            out *= np.roll(self.letter(point), ORDER - 1 - k)
        return out

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        """One row for each of at most GRAMS distinct grams."""
        rows = self.rows
        listed = grams.tolist()
        missing = [g for g in listed if g not in rows]
        if len(rows) + len(missing) > BANK_ROWS:
            rows.clear()
            missing = listed
        for g in missing:
            self.table[len(rows)] = self.bind(g)
            rows[g] = len(rows)
        return self.table[[rows[g] for g in listed]].astype(np.float32)

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The integer bundle of one bag of n-grams."""
        out = np.zeros(self.dimensions)
        for k in range(0, len(grams), GRAMS):
            out += counts[k : k + GRAMS].astype(np.float64) @ self.vectors(grams[k : k + GRAMS])
        return np.rint(out).astype(np.int64)

    def bundles(self, bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The bundles of some texts, by one product of their count matrix with the n-grams' vectors."""
        every = np.unique(np.concatenate([g for g, _ in bags]))
        out = np.zeros((len(bags), self.dimensions))
        for k in range(0, len(every), GRAMS):
            own = every[k : k + GRAMS]
            matrix = np.zeros((len(bags), len(own)), np.float32)
            for row, (grams, counts) in enumerate(bags):
                lo, hi = np.searchsorted(grams, own[0]), np.searchsorted(grams, own[-1], "right")
                matrix[row, np.searchsorted(own, grams[lo:hi])] = counts[lo:hi]
            out += matrix @ self.vectors(own)
        return out


def bank() -> VectorBank:
    return held("language_id", VectorBank)


@dataclass
class Profiles:
    languages: list[str]
    prototypes: np.ndarray  # unit rows

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        bags = [ngrams(t) for t in texts]
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        full = [k for k, (g, _) in enumerate(bags) if len(g)]
        for at in range(0, len(full), ROWS):
            own = full[at : at + ROWS]
            vectors = bank().bundles([bags[k] for k in own])
            norm = np.linalg.norm(vectors, axis=1, keepdims=True)
            cosines = (vectors / np.where(norm > 0, norm, 1)) @ self.prototypes.T
            for k, best, row in zip(own, cosines.argmax(1), cosines, strict=True):
                names[k], scores[k] = self.languages[best], float(min(1.0, max(0.0, row[best])))
        return names, scores


def train(rows: DataFrame, text: str = "text", lang: str = "lang") -> Profiles:
    """Prototypes from all rows with text and language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        sums: dict[str, np.ndarray] = {}

        def flush() -> None:
            for name, bag in counts.items():
                grams = np.fromiter(bag, np.uint64, len(bag))
                sums[name] = sums.get(name, 0) + bank().bundle(grams, np.fromiter(bag.values(), np.int64, len(bag)))
            counts.clear()

        for batch in batches:
            for start, n in slices(batch.column(0), batch.num_rows, OCTETS):
                own: dict[str, list[str]] = {}
                for name, said in zip(batch.column(1).slice(start, n).to_pylist(), batch.column(0).slice(start, n).to_pylist(), strict=True):
                    own.setdefault(name, []).append(said)
                for name, said in own.items():
                    counts.setdefault(name, Counter()).update(dict(zip(*(x.tolist() for x in ngrams(" ".join(said))), strict=True)))
                if sum(map(len, counts.values())) > FLUSH:
                    flush()
        flush()
        for name, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * DIMENSIONS), pa.array(range(DIMENSIONS), pa.int32()), pa.array(total, pa.int64())], names=["lang", "d", "v"]
            )

    known = rows.select(column_of(text).alias("t"), column_of(lang).alias("l")).filter("t IS NOT NULL AND l IS NOT NULL")
    parts = known.mapInArrow(tidy(run), "lang string, d int, v long")
    summed = parts.groupBy("lang", "d").agg(F.sum(F.col("v").cast("double")).alias("v"))
    vectors = summed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("d", "v"))).alias("vs"))
    found = vectors.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not found:
        return Profiles([], np.zeros((0, DIMENSIONS)))
    found.sort(key=lambda r: r["lang"])
    matrix = np.array([[x["v"] for x in r["vs"]] for r in found], float)
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    return Profiles([r["lang"] for r in found], matrix / np.where(norm > 0, norm, 1))


def predict(docs: DataFrame, profiles: Profiles, pred: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """docs with the predicted language and its cosine added."""
    keep = passed(docs.columns, (pred, score))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for start, n in slices(texts, 4 * ROWS, OCTETS):
                names, scores = profiles.predict([t or "" for t in texts.slice(start, n).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(start, n).columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=[*keep.values(), pred, score],
                )

    schema = T.StructType(
        [T.StructField(keep[f.name], f.dataType) for f in docs.schema.fields] + [T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())]
    )
    last = docs.select(*[column_of(c).alias(n) for c, n in keep.items()], F.col("text").alias(next(iter(passed(["text"], [*keep.values()]).values()))))
    return last.mapInArrow(tidy(run), schema)


def held_out(doc_id: Column) -> Column:
    """crc32 of doc_id as text, mod 3, is 1; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1
