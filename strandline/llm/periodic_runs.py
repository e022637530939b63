"""Periodic runs of words: passages that say the same stretch of words again and again.

A run is a stretch of consecutive words with smallest period q and at least max(SHORTEST, TIMES * q) words that no
neighbouring word extends keeping the period. Runs are found by block matching. With b the largest power of two that is at
most q, a run holds a block of b words that starts at a multiple of b within its first b words, and the same block again q
words later: both lie in the run since it has 4 q words. So for every b the aligned blocks of a document are put into an
Aho-Corasick automaton whose keys are sequences of word numbers, the document is searched for them, and an occurrence at a
distance of b to 2 b - 1 words from its aligned block is a seed with that distance as its period. A seed is extended word by
word to both sides, in steps that double, so that what is compared is not much longer than the stretch found.

Before that, for every b, only stretches are kept in which each word comes again within 2 b - 1 words; elsewhere no seed of
this b can lie in a run. An automaton holds the blocks of one b of one document: as many nodes as the stretches have words.

Defined results: null, empty and blank texts have no runs and collapse to the empty text; words are equal or not as they
are (no folding of case); texts of any length are searched whole, periods up to a quarter of the words; rows that repeat a
doc_id are separate rows; null doc_ids pass; an empty table gives no rows; other columns pass through, with underscores
behind the name of one that is called like a new column.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm.common import WORD_PATTERN, column_of, passed, slices, tidy

SHORTEST, TIMES = 6, 4
#: Rows, and about as many bytes of text, that a task has in hand.
ROWS, OCTETS = 256, 4 << 20

_WORD = re.compile(WORD_PATTERN)


def numbered(words: list[str]) -> np.ndarray:
    """Words as numbers, equal words alike, in order of their first place."""
    numbers: dict[str, int] = {}
    return np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))


def gaps(ids: np.ndarray) -> np.ndarray:
    """How many words on each word comes again; the number of words where it doesn't."""
    order = np.argsort(ids, kind="stable")
    out = np.full(len(ids), len(ids), np.int64)
    same = ids[order[1:]] == ids[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def stretches(close: np.ndarray, least: int) -> list[tuple[int, int]]:
    """[start, end) of the stretches of true values of at least that length."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], close, [False]]).astype(np.int8)))
    return [(s, e) for s, e in edges.reshape(-1, 2).tolist() if e - s >= least]


def reach(ids: np.ndarray, at: int, q: int, step: int) -> int:
    """How many words from `at` on, forward (step 1) or backward (-1), equal the word q after them."""
    found, size = 0, 16
    room = len(ids) - q - at if step > 0 else at + 1
    while found < room:
        take = min(size, room - found)
        lo = at + found if step > 0 else at - found - take + 1
        differ = np.flatnonzero(ids[lo : lo + take] != ids[lo + q : lo + q + take])
        if len(differ):
            return found + int(differ[0] if step > 0 else take - 1 - differ[-1])
        found += take
        size *= 2
    return max(found, 0)


def seeds(ids: np.ndarray, block: int, start: int, end: int) -> Iterator[tuple[int, int]]:
    """(place of an aligned block, distance) of the occurrences of the aligned blocks of ids[start:end] that are block to
    2 block - 1 words after them; end is where a block's words have to end that come again."""
    first = -(-start // block) * block
    keys: dict[tuple[int, ...], int] = {}
    own: list[int] = []
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for at in range(first, end - block + 1, block):
        key = tuple(ids[at : at + block].tolist())
        if key not in keys:
            keys[key] = len(keys)
            automaton.add_word(key, keys[key])
        own.append(keys[key])
    if not own:
        return
    automaton.make_automaton()
    stop = min(len(ids), end + 2 * block - 1)
    for last, key in automaton.iter(tuple(ids[first:stop].tolist())):
        k = (last + 1 - 2 * block) // block  # the one aligned block that is block to 2 block - 1 words before
        if 0 <= k < len(own) and own[k] == key:
            yield first + k * block, last + 1 - block - k * block


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs, by start, then period."""
    n = len(ids)
    if n < SHORTEST:
        return []
    again = gaps(ids)
    found: dict[tuple[int, int], int] = {}
    block = 1
    while TIMES * block <= n:
        done: dict[int, int] = {}  # where the last stretch of a period ended
        within = np.zeros(n, np.int64)  # where the last of the runs with smaller periods that hold a word ends
        for lo, hi in found:
            within[lo] = max(within[lo], hi)
        within = np.maximum.accumulate(within)
        # the words of a run but its last q, all with their next place within q words; at least 3 q of them
        for start, end in stretches(again < 2 * block, max(SHORTEST - 1, (TIMES - 1) * block)):
            if within[start] >= min(n, end + 2 * block - 1):
                continue
            for at, q in seeds(ids, block, start, end):
                # a block and its copy inside a run of a smaller period lie a multiple of that apart: the same run again
                if at + block <= done.get(q, 0) or within[at] >= at + q + block:
                    continue
                lo, hi = at - reach(ids, at - 1, q, -1), at + reach(ids, at, q, 1) + q
                done[q] = hi - q
                if hi - lo >= max(SHORTEST, TIMES * q):
                    # a stretch has its smallest period's multiples as periods too
                    found[lo, hi] = min(q, found.get((lo, hi), q))
        block *= 2
    return sorted((lo, hi - lo, q) for (lo, hi), q in found.items())


def kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: those that no run holds after its first `period` words."""
    change = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with runs (array of start, length, period, by start, then period) and collapsed, the words that stay joined by
    one space."""
    names = passed(docs.columns, ["runs", "collapsed"])
    # numbers for names on the way: Arrow functions take no names with dots
    rows = docs.select(*[column_of(c).alias(f"c{i}") for i, c in enumerate(names)], column_of(text).cast("string").alias("collapsed"))
    run_type = T.ArrayType(T.StructType([T.StructField(k, T.LongType(), False) for k in ("start", "length", "period")]), False)
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("runs", run_type), T.StructField("collapsed", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))
        for batch in batches:
            for begin, size in slices(batch.column(batch.num_columns - 1), ROWS, OCTETS):
                part = batch.slice(begin, size)
                all_runs, left = [], []
                for t in part.column(part.num_columns - 1).to_pylist():
                    words = _WORD.findall(t or "")
                    runs = runs_of(numbered(words))
                    stay = kept(len(words), runs)
                    all_runs.append([{"start": s, "length": k, "period": q} for s, k, q in runs])
                    left.append(" ".join(w for w, s in zip(words, stay.tolist(), strict=True) if s) if runs else " ".join(words))
                columns = [*part.columns[:-1], pa.array(all_runs, arrow), pa.array(left, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(tidy(run), schema).toDF(*names.values(), "runs", "collapsed")


def longest(runs: str = "runs") -> F.Column:
    """The run of greatest length, of equals the one with the smallest start, then period; null without runs."""
    order = F.transform(runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period")))
    return F.array_min(order)
