"""Greedy longest-match tokens of texts by a trie of the vocabulary, as a table function or as lists."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Node = dict[str, Any]

#: Under this key a node holds the id of the token that ends there; no character is longer than one.
END = "id"


def trie(vocabulary: Mapping[str, int]) -> Node:
    root: Node = {}
    for token, number in vocabulary.items():
        node = root
        for c in token:
            node = node.setdefault(c, {})
        if node is not root:
            node[END] = number
    return root


def longest_matches(root: Node, text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, id) of the tokens from the start of text on, each the longest that begins where the one before ends. What
    is read beyond a token's end is never more than the longest token. A part that no token begins is an error."""
    start, size = 0, len(text)
    while start < size:
        node, at, found = root, start, None
        while at < size and (node := node.get(text[at])) is not None:
            at += 1
            if END in node:
                found = at, node[END]
        if found is None:
            raise ValueError(f"no token matches at {start}: {text[start : start + 20]!r}")
        yield start, *found
        start = found[0]


def token_function(vocabulary: Mapping[str, int]):
    """A table function of a text: pos, start, token, id. For SQL: spark.udtf.register(name, token_function(vocabulary)). A
    null text has no tokens. The trie is built once for each task."""
    rows = dict(vocabulary)

    class LongestMatch:
        def __init__(self) -> None:
            self.root = trie(rows)

        def eval(self, text: str) -> Iterator[tuple[int, int, str, int]]:
            if text is None:
                return
            for pos, (start, end, number) in enumerate(longest_matches(self.root, text)):
                yield pos, start, text[start:end], number

    return F.udtf(LongestMatch, returnType="pos: int, start: int, token: string, id: int", useArrow=True)


def with_tokens(texts: DataFrame, vocabulary: Mapping[str, int], text: str = "text", name: str = "tokens") -> DataFrame:
    """texts with the tokens of each text (pos, start, token, id) in a list, null for a null text. Texts that a batch holds
    more than once are read once."""
    rows = dict(vocabulary)
    held: list[Node] = []
    kind = pa.list_(pa.struct([("pos", pa.int32()), ("start", pa.int32()), ("token", pa.string()), ("id", pa.int32())]))

    def read(column: pa.Array) -> pa.Array:
        if not held:
            held.append(trie(rows))
        different = column.dictionary_encode()
        lists = []
        for t in different.dictionary.to_pylist():
            lists.append([{"pos": pos, "start": start, "token": t[start:end], "id": number} for pos, (start, end, number) in enumerate(longest_matches(held[0], t))])
        return pa.array(lists, kind).take(different.indices)

    function = F.arrow_udf(read, "array<struct<pos:int,start:int,token:string,id:int>>")
    return texts.withColumn(name, function(F.col(text)))


def tokenize(texts: DataFrame, vocabulary: Mapping[str, int], text: str = "text") -> DataFrame:
    """The columns of texts but the text, with pos, start, token and id: a row for each token."""
    kept = [F.col(c) for c in texts.columns if c != text]
    return with_tokens(texts, vocabulary, text, "_tokens").select(*kept, F.inline("_tokens"))
