"""License scans: exact set-similarity join of text blocks with license templates.

A window is a stretch of a text of as many words as a template has, divided by THRESHOLD, wherever lines end; a template is a
known notice; all are sets of words. A window matches a template if it holds at least THRESHOLD of the template's words, or
all of them if the template has fewer than SHORT. Texts are cut into blocks of twice the widest window that overlap by half,
so each window lies in one. Words are ordered by their frequency in the corpus, rarest first. Of a template of t words that
needs o of them, at least one of the t - o + 1 rarest must be in the block (prefix filter); the block must hold o template
words at all (length filter); and where the first shared word stands must leave enough words after it on both sides
(positional filter). What passes is verified window by window.

Only template words matter for the overlap, so blocks are cut down to them in the one pass over the text, which splits it into
words once; templates are constants, which bounds the vocabulary, its frequency table and what is broadcast. Beside the templates, phrases are
found at every place where their words stand consecutively.

Defined results: null and empty text has no words, no places, no labels and score 0; a document has the labels of all its
windows and its score is the largest containment that reached the threshold (1 if a phrase was found); rows that repeat a
doc_id are each scanned; other columns pass through. Only DataFrame functions are used.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import ascii_lower, column_of, cut, passed

THRESHOLD, SHORT = 0.8, 8
NEW = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases of the contract and the label of each.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Public license notices and texts. One label a family: within a family the notices differ by a word or two.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"
        " including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"
        " subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    ),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    (
        "apache",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"
        " see the license for the specific language governing permissions and limitations under the license",
    ),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    (
        "gpl",
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"
        " see the gnu general public license for more details",
    ),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    (
        "bsd",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice"
        " this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    ),
    (
        "bsd",
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability"
        " and fitness for a particular purpose are disclaimed",
    ),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    (
        "boost",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software"
        " to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software",
    ),
    ("boost", "distributed under the boost software license version 1 0"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cc", "licensed under cc by 4 0"),
    ("cc", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related rights to this work"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
]


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), SEPARATORS), lambda w: w != "")


def template_words(text: str) -> list[str]:
    return sorted(set(re.findall(r"[0-9a-z]+", text)))


def phrase_places(tokens: Column) -> Column:
    """Start and label of every place of every phrase, by the phrase's last word."""
    last: dict[str, list[tuple[list[str], str]]] = {}
    for phrase, label in PHRASES.items():
        own = phrase.split()
        last.setdefault(own[-1], []).append((own, label))

    def at(w: Column, i: Column) -> Column:
        out = None
        for end, own in last.items():
            for parts, label in own:
                back = len(parts) - 1
                ok = (w == end) & (i >= back)
                for k, part in enumerate(parts[:-1]):
                    ok = ok & F.coalesce(F.get(tokens, i - (back - k)) == part, F.lit(False))
                found = F.struct((i - back).cast("long").alias("start"), F.lit(label).alias("label"))
                out = F.when(ok, found) if out is None else out.when(ok, found)
        return out

    return F.filter(F.transform(tokens, at), lambda x: x.isNotNull())


def scan(docs: DataFrame, threshold: float = THRESHOLD, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """docs without `text`, with n_words, n_base, first_word, last_word, base_labels, labels, score and
    spans (line number and label of every block that matches a template; a window has the line that it starts in)."""
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    sets = [template_words(t) for _, t in templates]
    vocabulary = sorted({w for s in sets for w in s})
    keep = [c for c in docs.columns if c != "text"]
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.struct(*[column_of(c).alias(f"c{i}") for i, c in enumerate(keep)]).alias("row"), F.monotonically_increasing_id().alias("uid"), text.alias("body"))
    # every word with its line, split once; lines are only told apart for the spans
    lined = F.flatten(F.transform(F.split("body", "\n"), lambda line, no: F.transform(words(line), lambda w: F.struct(no.alias("no"), w.alias("w")))))
    rows = rows.withColumn("lined", lined)
    ends = "|".join(sorted({p.split()[-1] for p in PHRASES}))
    has_end = ascii_lower(F.col("body")).rlike(ends)
    places = F.when(has_end, phrase_places(F.transform("lined", lambda x: x["w"]))).otherwise(F.array().cast("array<struct<start:bigint,label:string>>"))
    smallest = min(_needed(len(s), threshold) for s in sets)
    widths = [window_words(t, threshold) for _, t in templates]
    blocks = _blocks(F.col("lined"), max(widths), vocabulary, smallest)
    n_words = F.size("lined").cast("long").alias("n_words")
    rows = cut(rows.select("row", "uid", n_words, places.alias("places"), blocks.alias("blocks")), "licenses")

    each = rows.select("uid", F.explode("blocks").alias("b"))
    counts = dict(each.select(F.explode(F.array_distinct(F.transform("b", lambda x: x["w"]))).alias("w")).groupBy("w").count().collect())  # a row a template word
    rank = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    index = []
    for number, ((label, _), own) in enumerate(zip(templates, sets, strict=True)):
        ordered = sorted(own, key=rank.get)
        needed = _needed(len(ordered), threshold)
        for place, w in enumerate(ordered[: len(ordered) - needed + 1]):
            index.append((rank[w], number, label, place, len(ordered), needed, [rank[x] for x in ordered], widths[number]))
    index = spark.createDataFrame(index, "token int, template int, label string, place int, size int, needed int, ranks array<int>, width int")
    firsts = sorted({r for own in sets for r in sorted(rank[w] for w in own)[: len(own) - _needed(len(own), threshold) + 1]})
    each = each.select("uid", F.transform("b", lambda x: F.struct(x["no"].alias("no"), x["pos"].alias("pos"), _rank_of(x["w"], rank).alias("r"))).alias("b"))
    each = each.withColumn("ranks_b", F.array_sort(F.array_distinct(F.transform("b", lambda x: x["r"]))))
    probe = F.filter(F.transform("ranks_b", lambda r, i: F.struct(r.alias("token"), i.alias("place_b"))), lambda x: x["token"].isin(firsts))
    met = each.select("uid", "b", "ranks_b", F.explode(probe).alias("p")).select("uid", "b", "ranks_b", "p.token", "p.place_b").join(F.broadcast(index), "token")
    met = met.filter(
        (F.size("ranks_b") >= F.col("needed"))  # length
        & (F.least(F.size("ranks_b") - F.col("place_b"), F.col("size") - F.col("place")) + F.least("place_b", "place") >= F.col("needed"))  # position
    )
    shared = F.array_intersect("ranks_b", "ranks")
    # of the words that lead here from a block to a template, the first one they share stands for all
    met = met.filter((F.get(shared, F.lit(0)) == F.col("token")) & (F.size(shared) >= F.col("needed")))
    hits = _matching_windows(met)
    found = hits.groupBy("uid").agg(
        F.collect_set("label").alias("method_labels"), F.max("held").alias("held"), F.array_sort(F.collect_set(F.struct("no", "label"))).alias("spans")
    )
    out = rows.join(found, "uid", "left")
    starts = F.transform("places", lambda p: p["start"])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    every = F.array_sort(F.array_union(base, F.coalesce("method_labels", F.array().cast("array<string>"))))
    return out.select(
        *[F.col("row").getField(f"c{i}").alias(n) for i, n in enumerate(passed(keep, NEW).values())],
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("held", F.lit(0.0))).alias("score"),
        F.coalesce("spans", F.array().cast("array<struct<no:int,label:string>>")).alias("spans"),
    )


def _blocks(lined: Column, width: int, vocabulary: list[str], smallest: int) -> Column:
    """Template words (no: line, pos, w) of blocks of 2 width words, a block every width words, so that a window of at most
    width words lies in one of them whole. Only blocks with enough template words are kept."""

    def block(k: Column) -> Column:
        part = F.transform(F.slice(lined, k * width + 1, 2 * width), lambda x, i: F.struct(x["no"].alias("no"), i.alias("pos"), x["w"].alias("w")))
        return F.filter(part, lambda x: x["w"].isin(vocabulary))

    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(lined) / width).cast("int") - 2))
    return F.filter(F.transform(starts, block), lambda b: F.size(b) >= smallest)


def _matching_windows(met: DataFrame) -> DataFrame:
    """uid, no, label, held of blocks and templates that met (b: no, pos, r): the window that holds most of the template, of
    equals the first, if that is enough."""
    met = met.withColumn("b", F.filter("b", lambda x: F.array_contains("ranks", x["r"])))

    def window(start: Column) -> Column:
        inside = F.filter("b", lambda x: (x["pos"] >= start["pos"]) & (x["pos"] < start["pos"] + F.col("width")))
        held = F.size(F.array_distinct(F.transform(inside, lambda x: x["r"])))
        return F.struct(held.alias("held"), (-start["pos"]).alias("early"), start["no"].alias("no"))

    best = met.select("uid", "label", "size", "needed", F.array_max(F.transform("b", window)).alias("best"))
    return best.filter(F.col("best.held") >= F.col("needed")).select("uid", "best.no", "label", (F.col("best.held") / F.col("size")).alias("held"))


def window_words(template: str, threshold: float = THRESHOLD) -> int:
    """Words of the windows that are compared with a template."""
    return -int(-(len(re.findall(r"[0-9a-z]+", template)) / threshold - 1e-9) // 1)


def _needed(size: int, threshold: float) -> int:
    return size if size < SHORT else -int(-(threshold * size - 1e-9) // 1)


def _rank_of(word: Column, rank: dict[str, int]) -> Column:
    """The rank of a template word: its place in the literal list of words by rank."""
    return (F.array_position(F.lit(sorted(rank, key=rank.get)), word) - 1).cast("int")
