"""The alignment plan with repeats, checks of labels and references, and table forms of the kernels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.functions import scalars
from strandline.operators import frames, reference, search
from strandline.plans.alignment import AlignParams, align
from tests.test_search import biased


def one_said_twice():
    """Seven words of a token; the fourth is long and said twice with hardly a pause, so the best path stretches it."""
    rng = np.random.default_rng(5)
    rows, spans = [], []
    for w, n in [(1, 4), (2, 4), (3, 4), (4, 8), (4, 8), (5, 4), (6, 4), (7, 4)]:
        spans.append((len(rows) + 2, len(rows) + 1 + n))
        for s in [0, 0] + [w] * n:
            row = rng.uniform(-40, -30, 9)
            row[s] = -0.1
            rows.append(row)
    return [[k] for k in range(1, 8)], np.array(rows), spans


def test_plan_splices_repeats(spark):
    """The records hold both copies of the word said twice, with its spans, means and times."""
    words, lp, spans = one_said_twice()
    scores = spark.createDataFrame([("r", t, row.tolist()) for t, row in enumerate(lp)] + [("bad", 0, lp[0].tolist())], "rec string, t long, lp array<double>")
    rows = [(r, k, f"w{k}", 2, 1 if k < 6 else 2, False, w) for r in ("r", "bad") for k, w in enumerate(words)]
    slots = spark.createDataFrame(rows, "rec string, word_no int, word string, sura int, aya int, is_ayah_final boolean, tokens array<long>")
    records, errors = align(scores, slots)
    got = [r.asDict(recursive=True) for r in records.orderBy("cue_no").collect()]
    assert [r["rec"] for r in errors.collect()] == ["bad"]
    assert [r["word"] for r in got] == [f"w{k}" for k in [0, 1, 2, 3, 3, 4, 5, 6]]
    assert [r["is_repeat"] for r in got] == [k == 4 for k in range(8)]
    for r, (s, e) in zip(got, spans, strict=True):  # where it was said
        assert (r["start_frame"], r["end_frame"]) == (s, e) and abs(r["start"] - s * 0.04) < 1e-9
        assert [(x["start"], x["end"]) for x in r["token_frame_spans"]] == [(s, e)]
    for r in got:
        assert np.isinf(r["min_decision_margin"]) == r["spliced"] and r["avg_logprob"] > -1 and not (r["spliced"] and r["min_decision_margin"] < 0)
    assert [r["spliced"] for r in got] == [k in (3, 4) for k in range(8)]
    plain = align(scores, slots, AlignParams(repeats=None))[0]
    assert plain.count() == 7 and plain.filter("is_repeat").count() == 0


def test_search_runs_once_in_the_plan(spark):
    words, lp, _ = one_said_twice()
    scores = spark.createDataFrame([("r", t, row.tolist()) for t, row in enumerate(lp)], "rec string, t long, lp array<double>")
    slots = spark.createDataFrame([("r", k, f"w{k}", 2, 1, False, w) for k, w in enumerate(words)], "rec string, word_no int, word string, sura int, aya int, is_ayah_final boolean, tokens array<long>")
    plan = align(scores, slots)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMapCoGroupsInPandas") == 1


def test_labels_out_of_order(spark):
    refs = spark.createDataFrame([("a", [3, 5])], "rec string, ids array<long>")
    good = spark.createDataFrame([("a", t, i) for t, i in enumerate([0, 3, 3, 0, 5])], "rec string, t long, id long")
    assert [r["state"] for r in frames.label_states(good, 0, refs).orderBy("t").collect()] == [0, 1, 1, 2, 3]
    for wrong in ([0, 5, 0, 3], [3, 0, 5, 0, 3]):
        rows = spark.createDataFrame([("a", t, i) for t, i in enumerate(wrong)], "rec string, t long, id long")
        with pytest.raises(Exception, match="out of order"):
            frames.label_states(rows, 0, refs).collect()


def test_references(spark):
    df = spark.createDataFrame([("ab a abc", ["ab", "a", "abc"])], "text string, words array<string>")
    spans = df.select(reference.word_offsets(F.col("text"), F.col("words")).alias("s")).first()["s"]
    assert [(w["word"], w["start"], w["end"]) for w in spans] == [("ab", 0, 2), ("a", 3, 4), ("abc", 5, 8)]
    with pytest.raises(Exception, match="not in the text"):
        df.select(reference.word_offsets(F.lit("ab"), F.array(F.lit("ab"), F.lit("b")))).collect()
    lengths = spark.createDataFrame([("r", 4)], "rec string, n int")
    mapping = spark.createDataFrame([("r", 0, 0, 2), ("r", 1, 2, 2), ("r", 2, 2, 4)], "rec string, text_pos int, start int, end int")
    assert [r["text_pos"] for r in reference.scatter(mapping, lengths).orderBy("out_pos").collect()] == [0, 0, 2, 2]
    with pytest.raises(Exception, match="no character"):
        reference.scatter(mapping.filter("text_pos < 2"), lengths).collect()
    chars = spark.createDataFrame([("r", 0, 7), ("r", 1, 7), ("r", 2, 8), ("r", 3, 8)], "rec string, out_pos long, word_no int")
    tokens = spark.createDataFrame([("r", 0, 11, 0), ("r", 1, 12, 1), ("r", 2, 13, 3)], "rec string, pos int, token int, start long")
    got = reference.token_words(tokens, chars).orderBy("pos").collect()
    assert [(r["token"], r["word_no"], r["char_idx"]) for r in got] == [(11, 7, 0), (12, 7, 1), (13, 8, 1)]


def test_scatter_broadcasts_nothing(spark):
    """Estimates leave out what explode adds: both sides look small here, and all places would go through the driver."""
    orders = spark.range(100).select(F.col("id").alias("rec"), F.lit(400).alias("n"))
    mapping = orders.select("rec", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("text_pos")).select("rec", "text_pos", F.col("text_pos").alias("start"), (F.col("text_pos") + 1).alias("end"))
    got = reference.scatter(mapping, orders)
    assert got.filter("out_pos = text_pos").count() == 40000
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_scatter_same_as_a_loop(spark):
    rng = np.random.default_rng(5)
    spans, lengths, want = [], [("none", None), ("zero", 0), ("twice", 3), ("twice", 3)], [("twice", p, 0) for p in range(3)] * 2
    spans += [("twice", 0, -20, 40), ("twice", 9, 3, 3), ("twice", 9, 5, 2), ("twice", 9, None, 2), ("twice", 9, 0, None), ("twice", 9, -9, -2), ("alone", 0, 0, 5)]
    for rec, n in (("one", 1), ("edge", 16), ("over", 17), ("long", 500)):
        cuts = [0, *sorted(rng.integers(0, n + 1, 9).tolist()), n]
        own = [(rec, k, a, b) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
        own += [(rec, int(rng.integers(0, 30)), a, a + int(rng.integers(0, 70))) for a in rng.integers(-40, n, 20).tolist()]
        place = {p: max(k for _, k, a, b in own if a <= p < b) for p in range(n)}
        spans, lengths, want = spans + own, [*lengths, (rec, n)], want + [(rec, p, k) for p, k in place.items()]
    for whole in ("int", "long"):
        mapping = spark.createDataFrame(spans, f"rec string, text_pos {whole}, start {whole}, end {whole}")
        got = reference.scatter(mapping, spark.createDataFrame(lengths, f"rec string, n {whole}"))
        assert got.dtypes == [("rec", "string"), ("out_pos", "bigint"), ("text_pos", "bigint")]
        assert sorted(map(tuple, got.collect())) == sorted(want)
        for gap in (mapping.filter("rec <> 'edge'"), mapping.withColumn("text_pos", F.expr("if(rec = 'one', null, text_pos)"))):
            with pytest.raises(Exception, match="no character"):
                reference.scatter(gap, spark.createDataFrame(lengths, f"rec string, n {whole}")).collect()


def test_tables_of_kernels(spark):
    silences = spark.createDataFrame([("a", k * 480) for k in (2, 4, 5, 6, 8)] + [("b", 480)], "rec string, frame long")
    lengths = spark.createDataFrame([("a", 100), ("b", 8), ("c", 50)], "rec string, n_chunks long")
    got = [r["chunk"] for r in search.split_chunks(silences, lengths, most=2).orderBy("chunk").collect()]
    assert got == search.split_points([k * 480 for k in (2, 4, 5, 6, 8)], 100, most=2)


def test_nfc(spark):
    df = spark.createDataFrame([("e\u0301 x",), ("abc",), (None,)], "t string")
    assert [r["n"] for r in df.select(scalars.nfc(F.col("t")).alias("n")).collect()] == ["\u00e9 x", "abc", None]
