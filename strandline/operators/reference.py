"""Building references: text, its recited form and the mapping between them, to words, tokens and their places.

The recited form comes from outside (a phonetiser); here its mapping is checked and reshaped. All of it is relational but the
calls of a phonetiser, once for each different pair of words that meet at the end of a verse.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The names of the rules at each character of a text; a ValueError where it can't read the text.
Phonetiser = Callable[[str], list[list[str]]]

#: Consecutive places of a recording that are one row while they are scattered.
PLACES = 16


def word_offsets(text: Column, words: Column) -> Column:
    """(word, start, end) of the words in text, each searched for behind the one before; a word that is not there is an error."""
    empty = F.array().cast("array<struct<word:string,start:int,end:int>>")

    def step(acc: Column, w: Column) -> Column:
        at = F.call_function("locate", w, text, acc["at"] + 1) - 1
        start = F.when(at >= 0, at).otherwise(F.raise_error(F.concat(F.lit("not in the text: "), w)).cast("int"))
        span = F.struct(w.alias("word"), start.cast("int").alias("start"), (start + F.length(w)).cast("int").alias("end"))
        return F.struct((start + F.length(w)).cast("int").alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    first = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    return F.aggregate(words, first, step, lambda acc: acc["spans"])


def scatter(mapping: DataFrame, lengths: DataFrame) -> DataFrame:
    """rec, out_pos, text_pos of mapping (rec, text_pos, start, end: the output places of a character of the text); of
    characters that share a place the last one has it. A place below n (rec, n) that none has is an error.

    A row holds the PLACES places of a block; rows are dealt and joined by recording and block. The join is a merge join by
    hint: Spark's estimates leave out what explode adds, and it would broadcast all places of large tables.
    """
    start, end, n = (F.col(c).cast("bigint") for c in ("start", "end", "n"))
    first = F.col("block") * PLACES
    blocks = F.explode(F.sequence(F.floor(start / PLACES), F.floor((end - 1) / PLACES)))
    spans = mapping.filter(end > start).select("rec", "text_pos", "start", "end", blocks.alias("block"))
    spans = spans.select("rec", "block", "text_pos", (start - first).alias("lo"), (end - first).alias("hi"))
    own = spans.groupBy("rec", "block").agg(*[F.max(F.when((F.col("lo") <= k) & (F.col("hi") > k), F.col("text_pos"))).alias(f"at{k}") for k in range(PLACES)])
    every = lengths.filter(n > 0).select("rec", n.alias("n"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / PLACES))).alias("block"))
    held = F.slice(F.array(*[F.col(f"at{k}") for k in range(PLACES)]), 1, F.least(F.lit(PLACES), n - first).cast("int"))
    got = every.join(own.hint("merge"), ["rec", "block"], "left").select("rec", "block", F.posexplode(held).alias("k", "text_pos"))
    got = got.select("rec", (first + F.col("k")).alias("out_pos"), "text_pos")
    gap = F.raise_error(F.concat(F.lit("no character of the text for place "), F.col("out_pos").cast("string"))).cast("bigint")
    return got.select("rec", "out_pos", F.coalesce(F.col("text_pos").cast("bigint"), gap).alias("text_pos"))


def token_words(tokens: DataFrame, characters: DataFrame) -> DataFrame:
    """rec, pos, token, word_no, char_idx: a token (rec, pos, token, start) belongs to the word of its first character
    (characters: rec, out_pos, word_no); char_idx counts from the word's first character."""
    firsts = characters.withColumn("char_idx", F.col("out_pos") - F.min("out_pos").over(Window.partitionBy("rec", "word_no")))
    return tokens.join(firsts.withColumnRenamed("out_pos", "start"), ["rec", "start"], "left").select("rec", "pos", "token", "word_no", "char_idx")


def verse_ends(words: DataFrame) -> DataFrame:
    """rec, word_no, word, next_no, next: the last word of each verse with the first of the next one; words: rec, verse,
    word_no (ascending through the recording), word."""
    order = Window.partitionBy("rec").orderBy("word_no")
    met = words.select("rec", "word_no", "word", "verse", *[F.lead(c).over(order).alias(n) for c, n in (("word_no", "next_no"), ("word", "next"), ("verse", "later"))])
    return met.filter(F.col("next_no").isNotNull() & ~F.col("verse").eqNullSafe(F.col("later"))).drop("verse", "later")


def _changed(joint: list[list[str]], alone: list[list[str]]) -> list[dict]:
    """Places whose rules differ, with the names that only the joint reading has."""
    pairs = [(set(a), set(b)) for a, b in zip(joint, alone, strict=False)]
    return [{"char_idx": k, "rules": sorted(a - b)} for k, (a, b) in enumerate(pairs) if a != b]


def joint_rules(pairs: DataFrame, phonetise: Phonetiser) -> DataFrame:
    """word, next, own, following, error of different pairs (word, next): for either word the characters (char_idx, rules)
    whose rules are others if both are read on as one text, with the rules that this adds. Pairs that the phonetiser can't
    read have an error and no rules. Each word alone is read once a batch."""
    extra = "array<struct<char_idx:int,rules:array<string>>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            alone: dict[str, list[list[str]]] = {}
            rows = []
            for word, following in zip(batch["word"], batch["next"], strict=True):
                try:
                    for w in (word, following):
                        if w not in alone:
                            alone[w] = phonetise(w)
                    joint = phonetise(f"{word} {following}")
                    after = len(word) + 1
                    rows.append((word, following, _changed(joint[: len(word)], alone[word]), _changed(joint[after:], alone[following]), None))
                except ValueError as e:
                    rows.append((word, following, [], [], str(e)))
            yield pd.DataFrame(rows, columns=["word", "next", "own", "following", "error"])

    return pairs.select("word", "next").distinct().mapInPandas(run, f"word string, next string, own {extra}, following {extra}, error string")


def boundary_rules(words: DataFrame, phonetise: Phonetiser) -> DataFrame:
    """rec, word_no, char_idx, rules: what reading on over the ends of verses adds at the characters of the words beside them.
    Of a verse of one word, what the end behind it says goes before what the one ahead of it says."""
    ends = verse_ends(words)
    found = ends.join(joint_rules(ends, phonetise), ["word", "next"])
    sides = F.array(F.struct(F.col("word_no").alias("word_no"), F.lit(1).alias("side"), F.col("own").alias("extra")), F.struct(F.col("next_no").alias("word_no"), F.lit(0).alias("side"), F.col("following").alias("extra")))
    rows = found.select("rec", F.inline(sides)).select("rec", "word_no", "side", F.inline("extra"))
    return rows.groupBy("rec", "word_no", "char_idx").agg(F.max_by("rules", "side").alias("rules"))


def with_boundary_rules(slots: DataFrame, extra: DataFrame) -> DataFrame:
    """slots (rec, word_no, letters: an array of structs, ...) whose letters have boundary_rules, null where there are none."""
    lists = extra.groupBy("rec", "word_no").agg(F.map_from_entries(F.collect_list(F.struct("char_idx", "rules"))).alias("_extra"))

    def letter(x: Column, i: Column) -> Column:
        return x.withField("boundary_rules", F.try_element_at("_extra", i))

    return slots.join(lists, ["rec", "word_no"], "left").withColumn("letters", F.transform("letters", letter)).drop("_extra")


def verse_rows(words: DataFrame, tokens: DataFrame) -> DataFrame:
    """rec, verse, n_words, n_tokens, ids, words (structs word, text, letters, own: structs pos, char_idx): a row for each verse
    that has words, of the frames that combined() takes. Words and tokens are dealt once, by recording and verse."""
    said = words.select("rec", "verse", "word", F.struct("text", "letters").alias("said"))
    read = tokens.select("rec", "verse", "word", F.struct("pos", "char_idx", "id").alias("read"))
    dealt = said.unionByName(read, allowMissingColumns=True).repartition("rec", "verse")
    own = dealt.groupBy("rec", "verse", "word").agg(F.collect_list("said").alias("said"), F.array_sort(F.collect_list("read")).alias("own"))
    each = F.transform("said", lambda x: F.struct(F.col("word"), x["text"].alias("text"), x["letters"].alias("letters"), F.col("own")))
    rows = own.groupBy("rec", "verse").agg(F.flatten(F.collect_list(each)).alias("words"), F.array_sort(F.flatten(F.collect_list("own"))).alias("all"))
    return rows.select("rec", "verse", F.size("words").alias("n_words"), F.size("all").alias("n_tokens"), F.transform("all", lambda x: x["id"]).alias("ids"), "words")


def combined_verses(verses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(references, slots) as of combined(), of rows as of verse_rows(): numbered on in one shuffle of verses, by sums."""
    before = Window.partitionBy("rec").orderBy("verse").rowsBetween(Window.unboundedPreceding, -1)
    spoken = verses.filter(F.col("rec").isNotNull() & F.col("verse").isNotNull() & (F.col("n_words") > 0))
    placed = spoken.select("*", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{c}_before") for n, c in (("n_words", "words"), ("n_tokens", "tokens"))])
    read = placed.filter("n_tokens > 0").groupBy("rec").agg(F.array_sort(F.collect_list(F.struct("tokens_before", "ids"))).alias("all"))
    references = read.select("rec", F.flatten(F.transform("all", lambda x: x["ids"])).alias("ids"))
    slots = placed.select("rec", "verse", "n_words", "words_before", "tokens_before", F.explode("words").alias("x"))
    return references, slots.select(
        "rec",
        (F.col("words_before") + F.col("x.word")).alias("word_no"),
        F.col("x.text").alias("word"),
        "verse",
        (F.col("x.word") == F.col("n_words") - 1).alias("is_verse_final"),
        F.transform("x.own", lambda t: (F.col("tokens_before") + t["pos"]).cast("bigint")).alias("token_positions"),
        F.transform("x.own", lambda t: t["char_idx"].cast("int")).alias("token_char_idx"),
        F.col("x.letters").alias("letters"),
    )


def combined(words: DataFrame, tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(references, slots) of the verses of recordings, one after another. words: rec, verse, word (number in the verse),
    text, letters; tokens: rec, verse, pos (in the verse), id, word, char_idx (in the word).

    references: rec, ids. slots: rec, word_no, word, verse, is_verse_final, token_positions (into ids), token_char_idx,
    letters.
    """
    return combined_verses(verse_rows(words, tokens))
