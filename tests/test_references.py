"""The trie tokenizer, rules at the ends of verses, and the combined reference against loops; true peaks."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import reference, signal, tokens
from strandline.plans.queries import QUERIES, letter_rules


def greedy(vocabulary, text):
    out, at = [], 0
    while at < len(text):
        token = max((t for t in vocabulary if t and text.startswith(t, at)), key=len)
        out.append((at, token, vocabulary[token]))
        at += len(token)
    return out


def test_tokens_are_the_longest(spark):
    rng = random.Random(1)
    vocabulary = {t: k for k, t in enumerate(["a", "b", "c", "ab", "abc", "bca", "cc", "ccab", "\u0628\u0651", "\u0628", ""])}
    texts = ["".join(rng.choice(["a", "b", "c", "\u0628", "\u0628\u0651"]) for _ in range(rng.randint(0, 60))) for _ in range(50)] + [None, "", "abc" * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string").repartition(3)
    got = {}
    for r in tokens.tokenize(df, vocabulary).orderBy("k", "pos").collect():
        got.setdefault(r["k"], []).append((r["start"], r["token"], r["id"]))
    assert got == {k: greedy(vocabulary, t) for k, t in enumerate(texts) if t}


def test_tokens_of_sql_and_no_match(spark):
    spark.udtf.register("longest_tokens", tokens.token_function({"a": 1, "ab": 2}))
    assert [tuple(r) for r in spark.sql("SELECT * FROM longest_tokens('aab')").collect()] == [(0, 0, "a", 1), (1, 1, "ab", 2)]
    with pytest.raises(Exception, match="no token matches at 1"):
        spark.sql("SELECT * FROM longest_tokens('axb')").collect()


def verses(seed=3):
    rng = random.Random(seed)
    return {r: [["".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(rng.choice([1, 1, 2, 4]))] for _ in range(6)] for r in ("x", "y")}


def unreadable(text):
    if text.startswith("c"):
        raise ValueError("starts with c")
    return letter_rules(text)


@pytest.mark.parametrize("phonetise", [letter_rules, unreadable])
def test_boundary_rules(spark, phonetise):
    rows, want = [], {}
    for rec, own in verses().items():
        flat = [(v, w) for v, words in enumerate(own) for w in words]
        rows += [(rec, v, k, w, [(c, []) for c in w]) for k, (v, w) in enumerate(flat)]
        for k, ((v, a), (v2, b)) in enumerate(zip(flat, flat[1:], strict=False)):
            if v == v2:
                continue
            try:
                joint, left, right = phonetise(f"{a} {b}"), phonetise(a), phonetise(b)
            except ValueError:
                continue
            for at, got, alone in ((k, joint[: len(a)], left), (k + 1, joint[len(a) + 1 :], right)):
                for i, (x, y) in enumerate(zip(got, alone, strict=True)):
                    if set(x) != set(y):
                        want[rec, at, i] = sorted(set(x) - set(y))
    words = spark.createDataFrame(rows, "rec string, verse int, word_no long, word string, letters array<struct<char:string,rules:array<string>>>").repartition(4)
    extra = reference.boundary_rules(words, phonetise)
    assert {(r["rec"], r["word_no"], r["char_idx"]): r["rules"] for r in extra.collect()} == want and want
    slots = reference.with_boundary_rules(words, extra).collect()
    assert len(slots) == len(rows)
    for r in slots:
        assert [x["boundary_rules"] for x in r["letters"]] == [want.get((r["rec"], r["word_no"], i)) for i in range(len(r["word"]))]


def test_combined_reference(spark):
    words, found, ids, slots = [], [], {}, []
    for rec, own in verses(5).items():
        ids[rec], n = [], 0
        for v, texts in enumerate(own):
            first = len(ids[rec])
            for w, t in enumerate(texts):
                words.append((rec, v, w, t, [t]))
                places = [len(ids[rec]) + i for i in range(len(t))]
                found += [(rec, v, p - first, ord(c), w, i) for i, (p, c) in enumerate(zip(places, t, strict=True))]
                ids[rec] += [ord(c) for c in t]
                slots.append((rec, n, t, v, w == len(texts) - 1, places, list(range(len(t))), [t]))
                n += 1
    words = spark.createDataFrame(words, "rec string, verse int, word long, text string, letters array<string>").repartition(3)
    found = spark.createDataFrame(found, "rec string, verse int, pos long, id int, word long, char_idx int").repartition(5)
    references, got = reference.combined(words, found)
    assert {r["rec"]: r["ids"] for r in references.collect()} == ids
    assert sorted(map(tuple, got.collect())) == sorted(slots)
    silent = reference.combined(words, found.filter("id <> 97"))[1]
    assert silent.count() == len(slots) and silent.filter(F.size("token_positions") == 0).count() == sum(set(s[2]) == {"a"} for s in slots)


@pytest.mark.parametrize(("rate", "phase"), [(0.25, 0.25 * math.pi), (0.125, math.pi / 8), (0.4, 0.3)])
def test_true_peak_of_tones(rate, phase):
    n = np.arange(4001)
    x = np.sin(2 * math.pi * rate * n + phase) * np.hanning(4001) ** 0.1
    assert abs(20 * math.log10(signal.true_peak(x))) < 0.1
    assert {signal.true_peak(x, 4, b) for b in (1, 7, 100, 4001)} == {signal.true_peak(x)}


def test_true_peaks_of_recordings(spark):
    df = spark.createDataFrame([("a", [0.5]), ("b", []), ("c", [1.0, 1.0, -1.0, -1.0] * 50)], "rec string, pcm array<double>")
    got = {r["rec"]: r["true_peak_db"] for r in signal.true_peaks(df).collect()}
    assert abs(got["a"] - 20 * math.log10(0.5)) < 1e-9 and got["b"] == -120.0
    assert 2.9 < got["c"] < 4.0  # samples of a tone at its 45 degrees, as loud again by the root of 2 between them, more at the ends


def test_repeated_texts_and_nulls(spark):
    df = spark.range(0, 5000, 1, 1).selectExpr("id AS k", "IF(id % 50 = 1, NULL, repeat('ab', cast(id % 50 AS int))) AS text")
    got = tokens.tokenize(df, {"a": 1, "ab": 2}).groupBy("token", "id").count().collect()
    assert [tuple(r) for r in got] == [("ab", 2, 100 * (sum(range(50)) - 1))]
    assert tokens.with_tokens(df, {"ab": 2}).filter("tokens IS NULL").count() == 100


def test_combined_query_reads_and_deals_verses_once(spark, tmp_path):
    """One pass of the tokenizer and one shuffle, of verses; no join of characters, words and tokens."""
    rows = [(7, 3, "4-NOT SPECIFIED"), (7, 9, "5-LOW"), (8, 1, None), (8, 2, "1-URGENT"), (None, 4, "2-HIGH")]
    spark.createDataFrame(rows, "o_custkey long, o_orderkey long, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    got = QUERIES["ref_combined"](spark, str(tmp_path))
    want = [(7, 0, "4-not", 3, False, "0,1,2", "0,1,2"), (7, 1, "specified", 3, True, "4", "0"), (7, 2, "5-low", 9, True, "5,6,7", "0,1,2"), (8, 0, "1-urgent", 2, True, "0,1,2", "0,1,2")]
    assert sorted(map(tuple, got.collect())) == want
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and "UDTF" not in plan and plan.count("ArrowEvalPython") == 1
