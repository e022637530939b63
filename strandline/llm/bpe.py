"""BPE encoding and decoding with a pair occurrence index.

A batch of documents is cut into white-space-free chunks; chunks not met before are cut into words, and the distinct new
words of the batch lie behind one another in one symbol array. The index maps each merge rank that occurs to all the
positions of its pair. Active ranks come off a heap in ascending order; each is applied at all its positions at once, and
the lists of the pairs to the left and right of a merge are updated. A merge only makes pairs of later ranks (its symbol
did not exist before), so one ascending pass is the exact BPE result for every word. Results are kept per chunk in a
cache that is bounded by bytes; overflow empties it and costs time only.

Vocabularies are files in the format of the tokenizers library; their path is a parameter. Supported here: BPE with an
end-of-word suffix, byte-level symbols, a Split pattern, and the normalizers NFC, white space to one space, Lowercase; a
file with others is refused.

Defined results: null and empty text give no ids and the empty decoding; special tokens that stand in a text become
their ids, as in the library; rows that repeat are encoded each; other columns pass through, with underscores behind
names that the result has itself.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.llm.common import column_of, held, passed, slices, tidy

#: Bytes of the cache, as estimated, in a worker; rows, and about as many bytes of text, that are encoded together.
CACHE_BYTES = 48 << 20
ROWS, OCTETS = 2048, 1 << 20
#: What an entry costs besides its characters: two dictionaries' slots, three objects and a pair.
ENTRY = 420
#: Occurrences of a pair from which they are merged as arrays.
MANY = 24
#: White space to str.split() but not to the vocabulary's pattern.
ODD_SPACE = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    spare = iter(range(256, 512))
    return [out[b] if b in out else chr(next(spare)) for b in range(256)]


class PairIndexBpe:
    """Encodes texts; `decoded` and `ids` of a text come from the same cached chunks."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if spec["model"]["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path}: {spec['model']['type']} after {kinds} is not supported")
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in special.items()}
        self.special = special
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.shift = max(vocab.values()).bit_length()
        self.merges: dict[int, int] = {}  # pair -> rank
        self.pairs: list[tuple[int, int, int]] = []  # rank -> left, right, merged
        for rank, (left, right) in enumerate(model["merges"]):
            a, b = vocab[left], vocab[right]
            self.merges[a << self.shift | b] = rank
            self.pairs.append((a, b, vocab[left + right]))
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int32)
        self.final = np.array([vocab[s + self.suffix] for s in symbols], np.int32)
        keys = np.fromiter(self.merges, np.int64, len(self.merges))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.key_ranks = np.fromiter(self.merges.values(), np.int64, len(keys))[order]
        self.known_words: dict[str, tuple[bytes, str]] = {}
        (split,) = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.words = regex.compile(split["pattern"]["Regex"])
        self.chunks: dict[str, tuple[bytes, str]] = {}
        self.cache_bytes, self.held_bytes = cache_bytes, 0

    @staticmethod
    def normalize(text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # per character, so no final sigma
        return text.lower()

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair, or -1."""
        pair = left.astype(np.int64) << self.shift | right
        at = np.searchsorted(self.keys, pair)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == pair, self.key_ranks[at], -1)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word, by one ascending pass over the ranks that occur in any of them."""
        raw = [w.encode() for w in words]
        if not raw:
            return []
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(lengths)
        starts = ends - lengths
        n = int(ends[-1])
        octets = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.inner[octets]
        sym[ends - 1] = self.final[octets[ends - 1]]
        nxt, prv = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        nxt[ends - 1] = -1
        prv[starts] = -1

        index: dict[int, list[np.ndarray | int]] = {}  # rank -> positions of its pair: arrays and single ones
        active: list[int] = []

        def enter(positions: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            first = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
            for rank, own in zip(ranks[first].tolist(), np.split(positions, first[1:]), strict=True):
                if rank in index:
                    index[rank].append(own)
                else:
                    index[rank] = [own]
                    heapq.heappush(active, rank)

        pos = np.flatnonzero(nxt >= 0)
        found = self._ranks(sym[pos], sym[pos + 1])
        if (there := found >= 0).any():
            enter(pos[there], found[there])
        v_sym, v_nxt, v_prv = memoryview(sym), memoryview(nxt), memoryview(prv)
        merges, shift = self.merges, self.shift
        while active:
            rank = heapq.heappop(active)
            a, b, merged = self.pairs[rank]
            lists = index.pop(rank)
            count = sum(1 if isinstance(x, int) else len(x) for x in lists)
            if count > MANY and a != b:  # no two occurrences overlap: all at once
                p = np.concatenate([np.atleast_1d(x) for x in lists])
                q = nxt[p]
                ok = (sym[p] == a) & (q >= 0) & (sym[q] == b)
                p, q = p[ok], q[ok]
                if not len(p):
                    continue
                after = nxt[q]
                sym[p], sym[q], nxt[p] = merged, -1, after
                more = after >= 0
                prv[after[more]] = p[more]
                before = prv[p]
                left = before[before >= 0]
                changed = np.unique(np.concatenate([p[more], left]))
                found = self._ranks(sym[changed], sym[nxt[changed]])
                if (there := found >= 0).any():
                    enter(changed[there], found[there])
                continue
            positions = sorted({x for own in lists for x in ((own,) if isinstance(own, int) else own.tolist())})
            for p in positions:  # leftmost first where occurrences overlap
                q = v_nxt[p]
                if v_sym[p] != a or q < 0 or v_sym[q] != b:
                    continue
                after, before = v_nxt[q], v_prv[p]
                v_sym[p], v_sym[q], v_nxt[p] = merged, -1, after
                if after >= 0:
                    v_prv[after] = p
                    if (new := merges.get(merged << shift | v_sym[after])) is not None:
                        if new in index:
                            index[new].append(p)
                        else:
                            index[new] = [p]
                            heapq.heappush(active, new)
                if before >= 0 and (new := merges.get(v_sym[before] << shift | merged)) is not None:
                    if new in index:
                        index[new].append(before)
                    else:
                        index[new] = [before]
                        heapq.heappush(active, new)
        live = sym >= 0
        kept = sym[live].tolist()
        ends = np.cumsum(live)[ends - 1].tolist()
        return [kept[s:e] for s, e in zip([0, *ends[:-1]], ends, strict=True)]

    def _learn(self, fresh: list[str]) -> None:
        known, token = self.known_words, self.tokens
        find = self.words.findall
        cut = [find(c) for c in fresh]
        words = list({w for ws in cut for w in ws if w not in known})
        for w, got in zip(words, self.encode_words(words), strict=True):
            known[w] = (array("I", got).tobytes(), " ".join([token[i] for i in got]))
        chunks = self.chunks
        self.held_bytes += sum(ENTRY + 6 * len(c) for c in fresh)
        for chunk, ws in zip(fresh, cut, strict=True):
            if len(ws) == 1:
                chunks[chunk] = known[ws[0]]
            else:
                chunks[chunk] = (b"".join([known[w][0] for w in ws]), " ".join([known[w][1] for w in ws]))

    def _pieces(self, text: str) -> list[str]:
        text = self.normalize(text)
        return text.split() if not ODD_SPACE.search(text) else regex.split(r"[^\S\x1c-\x1f]+", text)

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """For each text its ids (little-endian unsigned 32-bit) and its decoding (tokens joined by one space)."""
        if self.held_bytes > self.cache_bytes:
            self.chunks.clear()
            self.known_words.clear()
            self.held_bytes = 0
        parts = []  # for each text: lists of chunks, and ids of special tokens
        for text in texts:
            if self.special_split is not None and "<" in text and self.special_split.search(text):
                parts.append([self.special[s] if s in self.special else self._pieces(s) for s in self.special_split.split(text)])
            else:
                parts.append([self._pieces(text)])
        known = self.chunks
        fresh = {c for text in parts for p in text if not isinstance(p, int) for c in p if c not in known}
        if fresh:
            self._learn(list(fresh))
        out = []
        for text in parts:
            ids, words = [], []
            for p in text:
                if isinstance(p, int):
                    ids.append(p.to_bytes(4, "little"))
                    words.append(self.tokens[p])
                else:
                    got = [known[c] for c in p]
                    ids += [x for x, _ in got]
                    words += [w for _, w in got if w]
            out.append((b"".join(ids), " ".join(words)))
        return out

    def decode(self, ids: list[int]) -> str:
        """As the library's decode(ids, skip_special_tokens=False) of a vocabulary without a decoder."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


def encoder(path: str) -> PairIndexBpe:
    """One encoder a Python worker: its cache serves the tasks that follow."""
    return held(("bpe", path), lambda: PairIndexBpe(path))


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """docs without `text`, with ids (binary: little-endian unsigned 32-bit), n_tokens and decoded added.

    One narrow pass; a task holds the vocabulary, the bounded chunk cache and ROWS rows. A lost task is run again.
    """
    keep = [f for f in docs.schema.fields if f.name != "text"]
    new = [("ids", T.BinaryType()), ("n_tokens", T.LongType()), ("decoded", T.StringType())]
    names = list(passed([f.name for f in keep], dict(new)).values())
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, keep, strict=True)] + [T.StructField(n, t) for n, t in new])
    renamed = docs.select(*[column_of(f.name).alias(n) for n, f in zip(names, keep, strict=True)], F.col("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for start, n in slices(texts, ROWS, OCTETS):
                got = bpe.encode([t or "" for t in texts.slice(start, n).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.slice(start, n).columns[:-1],
                        pa.array([i for i, _ in got], pa.binary()),
                        pa.array([len(i) // 4 for i, _ in got], pa.int64()),
                        pa.array([d for _, d in got], pa.string()),
                    ],
                    names=[*names, *dict(new)],
                )

    return renamed.mapInArrow(tidy(run), schema)
