"""Token-id output in ORC.

Documents are range-partitioned by doc_id (one shuffle, of text), encoded inside the sorted partitions and written as
one ORC file a partition: integer run-length encoding for the ids and the row index, a row index every INDEX_ROWS rows
and a Bloom filter on doc_id, so a reader of some documents skips stripes and row groups by metadata alone, and readers
of everything take stripes in parallel. `seq` numbers rows within a file and `part` files in ascending doc_id order, so
the global offset of a document is a prefix sum over parts (one row a file) plus one inside its part.

Defined results: null and empty text give the end id alone; rows of equal doc_id stand next to each other, in order of
their text; a null doc_id comes first; an empty table writes no rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandline.llm.common import cut, held, slices, tidy

INDEX_ROWS = 1000
#: Bytes of the cache, as estimated, in a worker, and what an entry costs besides its characters.
CACHE_BYTES, ENTRY = 144 << 20, 190
ROWS, OCTETS = 2048, 4 << 20
LINE_END = "\n"
#: White space other than space and line end, and runs of it: texts with any of these are encoded whole.
OTHER_SPACE = [*"\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000\0", *map(chr, range(0x2000, 0x200B)), "  ", " \n", "\n ", "\n\n"]
#: A comma or stop after a letter or digit begins a piece of its own; after anything else it may not.
INNER_STOP = re.compile(r"[,.](?<=[\W_].)")


class Numbers(dict):
    """Pieces with their numbers; one that is looked up for the first time gets the next number and is kept in `fresh`."""

    def __init__(self, known: dict[str, int]):
        super().__init__(known)
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = out = len(self)
        self.fresh.append(piece)
        return out


class WordCache:
    """Ids of texts by the tokenizers library. A byte-level pattern never joins text across the start of a space or line
    end that follows a word, nor across a comma or stop that follows a letter or digit; so what the library gives for
    each such piece alone is kept and put together. Arrow finds the different pieces of a batch, which are looked up once;
    new ones are encoded in few calls, one a line. When the cache is full, the pieces that most batches held stay, in at
    most half of it. That rule holds for the byte-level pattern alone: texts of other vocabularies are encoded whole."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        self.tokenizer = Tokenizer.from_file(path)
        self.byte_level = is_byte_level(json.loads(self.tokenizer.to_str()))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = OTHER_SPACE + self.special
        if self.byte_level:
            (self.line_end,) = self.tokenizer.encode(LINE_END, add_special_tokens=False).ids
        self.cache_bytes = cache_bytes
        self._reset()

    def _learn(self, pieces: list[str]) -> None:
        """Pieces without line ends, joined by those: a line end between two pieces is always a token of its own."""
        joined = [LINE_END.join(pieces[k : k + 1000]) for k in range(0, len(pieces), 1000)]
        ids, ends = [], []
        for got in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False):
            own = np.array(got.ids, "<u4")
            ends.append(np.append(np.flatnonzero(own == self.line_end), len(own)))
            ids.append(np.append(own, np.uint32(self.line_end)))
        shift = np.cumsum([len(self.ids), *map(len, ids[:-1])])
        ends = np.concatenate([e + k for e, k in zip(ends, shift, strict=True)])
        starts = np.append(len(self.ids), ends[:-1] + 1)
        self.starts, self.sizes = np.append(self.starts, starts), np.append(self.sizes, ends - starts)
        self.ids = np.concatenate([self.ids, *ids])
        self.calls = np.append(self.calls, np.zeros(len(pieces), np.int32))

    def _reset(self) -> None:
        """Nothing known but the empty piece and the line end, which _learn() can't take."""
        self.known, self.held_bytes = Numbers({"": 0, LINE_END: 1}), 0
        self.ids = np.array([self.line_end] if self.byte_level else [], "<u4")
        self.starts, self.sizes = np.array([0, 0]), np.array([0, 1])
        self.calls = np.zeros(2, np.int32)

    def _shrink(self) -> None:
        """Only the pieces of several batches stay known, those of most first, in at most half of the cache."""
        words = list(self.known)  # in the order of their numbers
        cost = 3 * np.fromiter(map(len, words), np.int64, len(words)) + ENTRY
        often = 2 + np.flatnonzero(self.calls[2:] > 1)
        often = often[np.argsort(-self.calls[often], kind="stable")]
        often = np.sort(often[np.cumsum(cost[often]) <= self.cache_bytes // 2])
        kept, sizes, calls = [words[k] for k in often], self.sizes[often], self.calls[often]
        ids, held_bytes = np.frombuffer(self._together(often), "<u4"), int(cost[often].sum())
        del words
        self.known.clear()
        self._reset()
        self.known.update(zip(kept, range(2, 2 + len(kept)), strict=True))
        self.starts, self.sizes = np.append(self.starts, len(self.ids) + np.cumsum(sizes) - sizes), np.append(self.sizes, sizes)
        self.ids, self.held_bytes = np.concatenate([self.ids, ids]), held_bytes
        self.calls = np.append(self.calls, calls // 2)  # what no batch holds any more gives way

    def _marked(self, text: str) -> str | None:
        """The pieces of text with \\0 between them, or None where it has to be encoded whole."""
        if not text:
            return ""
        if not self.byte_level:
            return None
        if text[0].isspace() or text[-1].isspace() or any(s in text for s in self.whole):
            return None
        cut = text.replace(" ", "\0 ").replace(LINE_END, "\0\n\0")
        if not INNER_STOP.search(text):
            cut = cut.replace(",", "\0,").replace(".", "\0.")
        return cut

    def _together(self, numbers: np.ndarray) -> bytes:
        """The ids of pieces by their numbers, one after another."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[numbers] - ends + sizes, sizes)
        return self.ids[at + np.arange(len(at))].tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.held_bytes > self.cache_bytes:
            self._shrink()
        marked = [self._marked(t) for t in texts]
        cut = pc.split_pattern(pa.array([m for m in marked if m is not None], pa.large_string()), "\0")
        pieces = cut.flatten().dictionary_encode()
        words = pieces.dictionary.to_pylist()
        numbers = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if fresh := self.known.fresh:
            self._learn(fresh)
            self.known.fresh = []
            self.held_bytes += 3 * sum(map(len, fresh)) + ENTRY * len(fresh)
        self.calls[numbers] += 1
        numbers, ends = numbers[pieces.indices.to_numpy()], iter(cut.offsets.to_numpy()[1:])
        hard = [t for t, m in zip(texts, marked, strict=True) if m is None]
        whole = iter(self.tokenizer.encode_batch_fast(hard, add_special_tokens=False) if hard else [])
        out, start = [], 0
        for m in marked:
            if m is None:
                out.append(np.array(next(whole).ids, "<u4").tobytes())
            else:
                out.append(self._together(numbers[start : (end := next(ends))]))
                start = end
        return out


def is_byte_level(spec: dict) -> bool:
    """Whether the file is a plain byte-level BPE with the usual pattern, with nothing before or behind it."""
    cut = spec["pre_tokenizer"] or {}
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
    return bool(plain and spec["model"]["type"] == "BPE" and spec["normalizer"] is None and not spec["model"].get("continuing_subword_prefix"))


def word_cache(path: str) -> WordCache:
    """The cache of a worker. Spark's tasks take the cores; the library's own threads would spin beside them."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return held(("token_files", path), lambda: WordCache(path))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, partitions: int | None = None) -> None:
    """Write doc_id, seq, part, ids of docs to ORC files under path."""
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_cache(tokenizer)
        seq = 0
        for batch in batches:
            for start, rows in slices(batch.column(1), ROWS, OCTETS):
                part = batch.slice(start, rows)
                ids = [x + end for x in cache.encode([t or "" for t in part.column(1).to_pylist()])]
                offsets = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.arange(seq, seq + part.num_rows, dtype=np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), values),
                    ],
                    names=["doc_id", "seq", "ids"],
                )
                seq += part.num_rows

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = ordered.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    ids = ordered.mapInArrow(tidy(run), "doc_id long, seq long, ids array<int>")
    (
        ids.select("doc_id", "seq", F.spark_partition_id().alias("part"), "ids")
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.row.index.stride", INDEX_ROWS)
        .option("orc.create.index", "true")
        .option("compression", "snappy")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, seq, part, ids; with doc_ids, stripes and row groups are pruned by statistics and Bloom filter."""
    df = spark.read.schema("doc_id long, seq long, part int, ids array<int>").orc(path)
    return df if doc_ids is None else df.filter(F.col("doc_id").isin(doc_ids))


def token_offsets(tokens: DataFrame) -> DataFrame:
    """Per row of read_tokens: doc_id, start (ids of all rows before it), n_tokens, ids_crc32."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values, offsets = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), lists.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            sizes = np.diff(offsets).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sizes), pa.array(crc, pa.int64())], names=["doc_id", "seq", "part", "n_tokens", "ids_crc32"]
            )

    rows = tokens.mapInArrow(tidy(digest), "doc_id long, seq long, part int, n_tokens long, ids_crc32 long")
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("*", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("before"))


def with_starts(rows: DataFrame) -> DataFrame:
    """Adds to the rows of token_offsets what the files before theirs hold: a prefix sum over one row a file."""
    rows = cut(rows, "offsets")  # read twice below; a few numbers a document
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    return rows.join(files, "part").select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
