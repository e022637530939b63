"""The training-data operators on small fixtures with nulls, empty and very long texts, repeats, ties, empty tables and
clashing columns, against brute force."""

import base64
import hashlib
import io
import os
import random
import re
import struct
import textwrap
import time
import wave
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandline.llm import bpe, common, fingerprints, graph, html_text, language_id, licenses, line_dedup, media, mixing, ngram_join, token_files
from strandline.llm.common import new_path

os.environ["TOKENIZERS_PARALLELISM"] = "false"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD_FILE, BYTE_FILE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))

WORDS = [a + b for a in "ka lo mi nu pe ra si to".split() for b in "ba de fi go hu".split()]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [sentence(rng, rng.randint(1, 60)) for _ in range(30)]
    long = sentence(rng, 30_000)
    shared = "This very line is shared by many"
    odd = [None, "", "\n", " \t ", "...", "a", "Hello\n\nhello ", "naïve Ünïcode ÀB 日本語", "tab\there\r\nand\x0bthere", "<|endoftext|> x", "it's, I'll.,a"]
    near = [b.replace(" ", " xx ", 1) for b in base[:5]] + [long + " end", long + " fin"]
    lined = [f"{shared}\nown line number {k} of this\n{shared.upper()}  \nshort" for k in range(4)]
    return [*base, *odd, *near, *lined, base[0], base[0], long]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k * 3, t, ["en", "xx", None][k % 3], ["b", "a", None, "ä"][k % 4], len(t or "")) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


# line dedup


def brute_lines(rows):
    key = lambda line: lower(line.strip(" \t\n\x0b\f\r"))
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or min(holders[key(x)]) == i]
        out[i] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


@pytest.mark.parametrize("batches, fanout", [(1, 2), (4, 2), (7, 3)])
def test_line_dedup(docs, texts, batches, fanout):
    got = by_id(line_dedup.dedup_lines(docs, batches=batches, fanout=fanout))
    want = brute_lines([(k * 3, t) for k, t in enumerate(texts)])
    assert {i: (r["text"], r["n_lines"], r["n_dropped"]) for i, r in got.items()} == want


def test_line_dedup_edges(spark, empty):
    assert line_dedup.dedup_lines(empty).count() == 0
    line = "a line that is long enough"
    rows = [(None, line, 1), (None, line, 2), (1, f"{line}\n{line}", 3), (1, line, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, h1 int")  # a column named like an inner one
    got = {r["h1"]: (r["text"], r["n_dropped"]) for r in line_dedup.dedup_lines(df).collect()}
    assert got == {1: ("", 1), 2: ("", 1), 3: (f"{line}\n{line}", 0), 4: (line, 0)}


def test_line_runs_compact(spark):
    runs = line_dedup.LineRuns(spark, fanout=2, buckets=2)
    for b in range(4):
        lines = spark.createDataFrame([(k, 0, b * 10 + k) for k in range(b, b + 3)], "h1 long, h2 long, doc long")
        dropped = sorted(r["doc"] for r in runs.add(lines).collect())
        assert dropped == ([] if b == 0 else [b * 10 + b, b * 10 + b + 1])
    assert [len(x) for x in runs.levels] == [0, 0, 1] and runs.runs()[0].count() == 6
    runs.close()


# main text


def test_main_text_of_layouts():
    model = html_text.default_model()
    pages = html_text.labelled_pages(60, seed=77)
    exact = sum(html_text.extract(p, model) == t for p, t in pages)
    assert exact >= 58, exact


#: Pages written by hand, none of them made by the generator that the model is trained on: body, main text.
PAGES = [
    ("<article><h1>T one</h1><p>Some text is here, and more.</p><pre><code>x = 1</code></pre><h3>Third level</h3><p>End of it.</p></article>", "T one\nSome text is here, and more.\nx = 1\nThird level\nEnd of it."),
    ("<div id=main><h2>Heading two</h2><p>Body text, a few words.</p><h4>Four</h4><p>More.</p></div>", "Heading two\nBody text, a few words.\nFour\nMore."),
    ("<article><h1>T</h1><ul><li>One<ul><li>Inner</li></ul></li><li>Two</li></ul><table><tr><th>A</th><td>B</td></tr></table></article>", "T\nOne\nInner\nTwo\nA\nB"),
    ("<article><h1>T</h1><figure><img src=x><figcaption>A picture.</figcaption></figure><dl><dt>Term</dt><dd>What it means.</dd></dl></article>", "T\nA picture.\nTerm\nWhat it means."),
    ("<main><h1>On rivers</h1><section><h2>Sources</h2><p>Water <em>comes</em> from the <a href=/hills>hills</a>, mostly.</p></section><blockquote>All flows.</blockquote></main><section id=comments><h3>2 comments</h3><p>So true.</p></section>", "On rivers\nSources\nWater comes from the hills, mostly.\nAll flows."),
    ("<div class=wrapper><header><h2>My site</h2><p>All about it.</p></header><article><h1>News</h1><p>It rained today.</p></article><aside><h3>Related</h3><ul><li><a href=1>Sun</a></li></ul></aside></div>", "News\nIt rained today."),
    ("<article><h1>Offer</h1><div class=ad>Buy now, cheap.</div><p>The text goes on.</p><form><label>Mail</label><input><button>Send</button></form><p>And ends.</p></article>", "Offer\nThe text goes on.\nAnd ends."),
]


def test_main_text_of_pages_by_hand():
    for body, want in PAGES:
        page = f"<html><head><title>x</title></head><body><nav><ul><li><a href=/>Home</a></li><li><a href=/b>About</a></li></ul></nav>{body}<footer>&copy; me, 2020</footer></body></html>"
        assert html_text.extract(page) == want, body


def test_parse_is_linear():
    """Ends without a beginning, and blocks within very deep inline markup, cost no search of what is open."""
    took = []
    for n in (5_000, 20_000):
        began = time.process_time()
        html_text.parse("<b>" * n + "</i><li>x<p>" * n)
        took.append(time.process_time() - began)
    assert took[1] < 12 * took[0] + 0.5


def test_main_text_fixture(spark):
    page = (
        "<html><head><title>T</title><script>var a='<p>';</script></head><body><nav><a href='/'>Home</a></nav><div class=ad>Buy it now.</div>"
        "<article><h1>A &amp; B</h1><p>First  part,\n of it.<br>More <b>bold</b>&nbsp;text. It goes on and on, as texts do.<p>Second &#233; &unknown; part is here, too.</article>"
        "<div class='comments'><p>Nice post!</p></div><footer>&copy; me</footer>"
    )
    rows = [(1, "u", page, 7), (2, "u", None, 7), (3, "u", "", 7), (4, "u", page[: page.index("Second") + 13], 7), (1, "u", page, 7)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = [(r["page_id"], r["text"]) for r in html_text.main_text(df).orderBy("page_id").collect()]
    first = "A & B\nFirst part, of it. More bold text. It goes on and on, as texts do.\nSecond é &unknown; part is here, too."
    assert got[0][1] == got[1][1] == first
    assert got[2][1] == got[3][1] == "" and got[4][1].endswith("Second é")
    assert html_text.main_text(df.limit(0)).count() == 0


def test_marginals_equal_enumeration():
    nodes, _ = html_text.parse("<div><p>one, two.</p><ul><li><a href=x>l</a></ul></div>")
    model = html_text.default_model()
    p = [model.potential(html_text.feature_key(n)) for n in nodes]
    total, own = 0.0, np.zeros(len(nodes))
    for m in range(1 << len(nodes)):
        s = [m >> k & 1 for k in range(len(nodes))]
        w = model.root[s[0]] * np.prod([p[k][s[k]] for k in range(len(nodes))]) * np.prod([model.edge[s[n.parent], s[k]] for k, n in enumerate(nodes) if k])
        total += w
        own += w * np.array(s)
    assert np.allclose(model.marginals(nodes), own / total)


# n-gram join


def brute_join(rows, percent, size):
    sets = {}
    for i, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", lower(t or "")) if x]
        sets.setdefault(i, []).append(frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else []))
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            if any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[i] for b in sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("percent, size", [(90, 3), (80, 5), (50, 1)])
def test_ngram_join(spark, percent, size):
    rng = random.Random(percent)
    base = [sentence(rng, rng.choice([2, 5, 12, 30, 80, 300])).split() for _ in range(25)]
    rows = []
    for b in base:
        for _ in range(rng.randint(1, 6)):
            w = list(b)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                at = rng.randrange(len(w) + 1)
                w[at : at + rng.randint(0, 1)] = rng.sample(WORDS, rng.randint(0, 2))
            rows.append(" ".join(w))
    rows = [(k, t) for k, t in enumerate([*rows, None, "", "  ", "one", "ONE"])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar(df, percent, size, block=4).collect()}
    assert got == brute_join(rows, percent, size)


def test_ngram_join_edges(spark, docs, texts, empty):
    assert ngram_join.similar(empty).count() == 0
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar(docs).collect()}
    want = brute_join([(k * 3, t) for k, t in enumerate(texts)], 90, 3)
    assert {i: c for i, (_, c) in got.items()} == want
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "x y z w"), (9, "X y z w")]
    out = ngram_join.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in out) == [(-1, -1), (5, 5), (5, 5), (9, 5)]
    rows = [(3, "a b c d"), (5, "a b c d"), (5, "x y z w"), (9, "X y z w"), (11, "k l m n")]
    out = ngram_join.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in out) == [(3, 3), (5, 3), (5, 3), (9, 3), (11, 11)]


@pytest.mark.parametrize("every", [1, 3])
def test_ngram_join_of_repeated_rows(spark, every):
    rng = random.Random(4)
    rows = []
    for _ in range(12):
        w = sentence(rng, 60).split()
        rows += [" ".join(w), " ".join([*w[:30], "other", *w[31:]]), " ".join([*w, "more"])]
    rows = list(enumerate(rows))
    rows += [r for r in rows if r[0] % every == 0]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar(df, 90, 3).collect()}
    assert got == brute_join(rows, 90, 3)


def test_signatures_meet_in_slices_and_go(spark, monkeypatch):
    """Nodes meet by a part of the signatures at a time, what that shuffled is released before the next part, and when all
    have met no signature stays on the disk."""
    rng = random.Random(15)
    rows = []
    for _ in range(20):
        w = sentence(rng, 60).split()
        rows += [" ".join(w), " ".join([*w[:30], "other", *w[31:]])]
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets = ngram_join.signed_sets(df, 90, 3, {}, [])
    every = {tuple(r) for r in ngram_join.shared_signatures(sets.select(F.col("doc_id").alias("rep"), "sigs", "hots")).collect()}
    met = [ngram_join.shared_signatures(ngram_join.slice_of(sets, k, 3).select(F.col("doc_id").alias("rep"), "sigs", "hots")).collect() for k in range(3)]
    assert every and {tuple(r) for part in met for r in part} == every and sum(map(len, met)) == len(every)
    assert max(map(len, met)) < len(every)
    told, cut, release, since = [], ngram_join.cut, ngram_join.release, set(common._written)
    monkeypatch.setattr(ngram_join, "cut", lambda df, name: told.append(name) or cut(df, name))
    monkeypatch.setattr(ngram_join, "release", lambda session: told.append("release") or release(session))
    out = ngram_join.similar(df, 90, 3)
    at = [k for k, name in enumerate(told) if name == "shared"]
    assert len(at) == ngram_join.SLICES > 1 and all(told[k + 1] == "release" for k in at)
    left = [spark.read.parquet(path).columns for path in common._written if path not in since]
    assert left and not any("sigs" in columns for columns in left)
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == brute_join(rows, 90, 3)


def test_blocks_of_a_hot_key_meet(spark):
    rows = [(7, k, 5 if k < 200 else k) for k in range(300)]  # 200 of one label, 100 others
    rows = ngram_join.with_main(spark.createDataFrame(rows, "sig long, rep long, label long"), "sig")
    met = defaultdict(list)
    for r in ngram_join.in_blocks(rows, 32).collect():
        met[r["bi"], r["bj"]].append(r["rep"])
    # 7 blocks of the main label meet the 4 others, those meet one another; never two of the main label
    assert len(met) == 7 * 4 + 10 and max(map(len, met.values())) <= 128 and not any(x < 0 and y < 0 for x, y in met)
    assert len({(a, b) for group in met.values() for a in group for b in group if max(a, b) >= 200 and a != b}) == 300 * 299 - 200 * 199
    one = spark.createDataFrame([(7, k, 5) for k in range(9)], "sig long, rep long, label long")
    assert ngram_join.with_main(one, "sig").count() == 0


def test_ngram_join_of_hot_groups(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(3):
        base = sentence(rng, 60).split()
        for _ in range(40):
            w = list(base)
            w[rng.randrange(50, 60)] = rng.choice(WORDS)
            rows.append(" ".join(w))
    passage = sentence(rng, 50)
    rows += [f"{passage} {sentence(rng, 12)}" for _ in range(40)]  # share signatures, are not alike
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar(df, 90, 3, block=8, looks=4).collect()}
    assert got == brute_join(rows, 90, 3)
    assert ngram_join.measured(df, 90, 3, sample=200)[2]  # some of these signatures are hot


@pytest.mark.parametrize("n", [1, 65])
def test_sample_of_a_batch_with_one_text(spark, n):
    """Costs are measured where a piece of a batch has a single set, so that no look can be timed there (the 65th text)."""
    rng = random.Random(8)
    rows = [(k, sentence(rng, 30)) for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    _, costs, _ = ngram_join.measured(df, 80, 5)
    assert costs and all(c > 0 for own in costs.values() for c in own.values())


def test_many_near_copies_are_linear(spark):
    """20,000 different near copies of one text: the components are right and no pair within the group is looked at twice."""
    rng = random.Random(12)
    base = sentence(rng, 120).split()
    rows = []
    for k in range(20_000):
        w = list(base)
        w[rng.randrange(120)] = f"x{k}"
        rows.append((k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = ngram_join.similar(df, 90, 3).groupBy("component_id").count().collect()
    assert [tuple(r) for r in got] == [(0, 20_000)]


@pytest.mark.parametrize("crowd, ones_win", [(2500, True), (10, False)])
def test_allocation_follows_measured_costs(spark, crowd, ones_win):
    """Short texts of which very many hold one passage: equal segments meet too often there, so the measured costs choose
    one-deletion neighbourhoods; with few such texts equal segments win. Either way all links are found."""
    rng = random.Random(3)
    passage = sentence(rng, 13)
    rows = [f"{passage} {rng.choice(WORDS)}{k}" for k in range(crowd)]
    rows += [f"{r} more" for r in rows[: crowd // 10]]
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ones, costs, _ = ngram_join.measured(df, 90, 3)
    assert bool(ones) == ones_win, costs
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar(df, 90, 3).collect()}
    assert got == {k: k if k < crowd else k - crowd for k, _ in rows}


def test_pigeonhole_has_no_misses():
    rng = np.random.default_rng(3)
    by = {"equal": set(), "deletion": set()}
    for percent in (50, 80, 90):
        bands = range(len(ngram_join.band_limits(percent)) - 1)
        some = {b: ngram_join.choices(b, percent)[len(ngram_join.choices(b, percent)) // 2] for b in bands}
        most = {b: ngram_join.choices(b, percent)[-1] for b in bands}
        for n in [1, 2, 5, 9, 10, 17, 40, 100, 333, 1000]:
            for _ in range(12):
                a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1))
                more = len(a) * (100 - percent) // percent if rng.random() < 0.5 else 0
                b = np.union1d(a, rng.integers(0, 2**63, more).astype(np.uint64) * np.uint64(2)) if more else rng.permutation(a)[: -(-len(a) * percent // 100)]
                b = np.sort(b)
                assert len(np.intersect1d(a, b)) * 100 >= percent * len(np.union1d(a, b))
                for ones in ({}, some, most):
                    x, y = ngram_join.signatures(a, percent, ones), ngram_join.signatures(b, percent, ones)
                    met = np.intersect1d(x | 1, y | 1)
                    assert (np.isin(met, x) | np.isin(met, y)).any(), (percent, n, len(b))  # a whole segment on one side at least
                by["deletion" if most[ngram_join.bands_of(len(a), percent)[0][0]] else "equal"].add(percent)
    assert by["deletion"] == {50, 80, 90}


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (4, 6), (9, 9), (None, 3), (7, 8), (3, 1)] + [(100 + k, 101 + k) for k in range(40)]
    got = dict(graph.components(spark.createDataFrame(links, "u long, v long")).collect())
    assert got == {2: 1, 3: 1, 5: 4, 6: 4, 8: 7} | {101 + k: 100 for k in range(40)}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


# licenses


def test_licenses(spark, docs, texts, empty):
    rows = [
        (1, "x\nReleased under the MIT License.\ny", 0),
        (2, "the Apache License, the GENERAL public license; mit  license", 0),
        (3, "general public", 0),
        (4, None, 0),
        (5, "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published", 0),
        (6, "nothing of the kind " * 3000, 0),
        (1, "x\nReleased under the MIT License.\ny", 0),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels int")
    got = [tuple(r) for r in licenses.scan(df.select("doc_id", "text")).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score").orderBy("doc_id").collect()]
    assert got[0] == got[1] == (1, 7, 1, 4, 4, "mit", "mit", 1.0)
    assert got[2] == (2, 9, 3, 1, 7, "apache,gpl,mit", "apache,gpl,mit", 1.0)
    assert got[3] == (3, 2, 0, None, None, "", "", 0.0) and got[4] == (4, 0, 0, None, None, "", "", 0.0)
    assert got[5][5:] == ("gpl", "gpl", 1.0) and got[6][2:] == (0, None, None, "", "", 0.0)
    assert licenses.scan(empty).count() == 0
    spans = by_id(licenses.scan(df.filter("doc_id = 1").select("doc_id", "text")))[1]["spans"]
    assert [(s["no"], s["label"]) for s in spans] == [(1, "mit")]
    clash = {"labels": "labels_", "score": "score_", "row": "row", "uid": "uid", "words": "words", "a.b": "a.b", "spans_": "spans_", "spans": "spans__"}
    named = df.drop("labels").select("*", *[F.lit(k).alias(k) for k in clash])
    one = licenses.scan(named).filter("doc_id = 2").first().asDict()
    assert one["labels"] == "apache,gpl,mit" and all(one[new] == old for old, new in clash.items())


def test_licenses_wrapped(spark):
    rng = random.Random(12)
    label, rows = {}, []
    for k, (own, template) in enumerate(licenses.TEMPLATES):
        for shift in range(3):
            lines = textwrap.wrap(("filler " * (9 * shift) + template).strip(), 72 - 10 * shift)
            body = "\n * ".join([sentence(rng, 40 + 7 * k), *lines, sentence(rng, 50)])
            label[len(rows)] = own
            rows.append((len(rows), body))
    scattered = licenses.TEMPLATES[6][1].split()
    rows.append((len(rows), "\n".join(f"{w} " + "filler " * 9 for w in scattered)))
    got = by_id(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    for i, own in label.items():
        assert own in got[i]["labels"].split(",") and got[i]["score"] == 1.0, rows[i]
    assert got[len(rows) - 1]["labels"] == "" and got[len(rows) - 1]["spans"] == []


# language ID


def test_language_id(spark, docs, empty):
    rng = random.Random(1)
    make = {"aa": lambda: "".join(rng.choice("abcde ") for _ in range(200)), "zz": lambda: "".join(rng.choice("vwxyz ") for _ in range(200))}
    rows = [(k, make["aa" if k % 2 else "zz"](), "aa" if k % 2 else "zz") for k in range(60)]
    train = spark.createDataFrame([*rows[:40], (99, None, "aa"), (98, "x", None)], "doc_id long, text string, lang string")
    profiles = language_id.train(train)
    test = spark.createDataFrame([*rows[40:], (200, None, "q"), (201, " 12 ..", "q"), (202, "a" * 300_000, "q")], "doc_id long, text string, lang string")
    got = by_id(language_id.predict(test, profiles))
    assert all(got[k]["lang_pred"] == want for k, _, want in rows[40:])
    assert [(got[k]["lang_pred"], got[k]["lang_score"]) for k in (200, 201)] == [("und", 0.0)] * 2 and got[202]["lang_pred"] == "aa"
    none = language_id.train(empty)
    assert none.languages == [] and set(r["lang_pred"] for r in language_id.predict(test, none).collect()) == {"und"}
    assert language_id.predict(empty, profiles).count() == 0
    ids = test.select("doc_id", language_id.held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in ids)


# fingerprints


def test_fingerprints(spark, docs, texts, empty):
    def shingles(t, size=5):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t or "") if x]
        return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()

    rows = fingerprints.with_next(docs, per_range=7).collect()
    listed = [(k * 3, t or "") for k, t in enumerate(texts)]
    follow = {i: listed[(k + 1) % len(listed)][1] for k, (i, _) in enumerate(listed)}
    assert {r["doc_id"]: r["next_text"] for r in rows} == follow
    a, b = F.col("sketch"), F.col("next_sketch")
    got = fingerprints.with_next(docs).select("doc_id", "text", "next_text", fingerprints.resemblance(a, b).alias("j"), fingerprints.distinct_shingles(a).alias("n"), fingerprints.containment(a, b).alias("c"), fingerprints.fingerprint(a).alias("f")).collect()
    prints = {}
    for r in got:
        x, y = shingles(r["text"]), shingles(r["next_text"])
        assert abs(r["j"] - (len(x & y) / len(x | y) if x | y else 1)) < 0.15
        assert abs(r["n"] - len(x)) <= 0.3 * len(x) and 0 <= r["c"] <= 1
        assert prints.setdefault(r["text"], r["f"]) == r["f"] and len(base64.b64decode(r["f"])) % 8 == 0
    assert fingerprints.with_next(empty).count() == 0
    one = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    assert fingerprints.with_next(one).first()["next_text"] == "a b"


@pytest.mark.parametrize("first_level", [1024, 40, 1])
def test_next_row_in_many_ranges(spark, first_level, monkeypatch):
    ranges = fingerprints.key_ranges
    monkeypatch.setattr(fingerprints, "key_ranges", lambda rows, key, per_range: ranges(rows, key, per_range, first_level))
    ids = [k * k * (-1) ** k for k in range(1500)] + [2**50, 2**50 + 1, -(2**50), 7, 7, None, None]
    rows = [(i, f"{i} {k}") for k, i in enumerate(ids)]
    got = fingerprints.with_next(spark.createDataFrame(rows, "doc_id long, text string"), per_range=3).collect()
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert {(r["doc_id"], r["text"], r["next_text"]) for r in got} == {(*r, rows[(k + 1) % len(rows)][1]) for k, r in enumerate(rows)}
    assert len(got) == len(rows)


def test_fingerprints_merge(spark):
    rng = random.Random(2)
    words = sentence(rng, 900).split()
    parts = [(1, " ".join(words[:500])), (1, " ".join(words[496:]))]
    df = spark.createDataFrame(parts, "k int, text string").select("k", fingerprints.sketch(F.col("text")).alias("s"))
    whole = spark.createDataFrame([(" ".join(words),)], "text string").select(fingerprints.sketch(F.col("text")).alias("s")).first()["s"]
    assert fingerprints.merge_groups(df, ["k"], "s").first()["s"] == whole


# BPE and token files

HARD = ["", "  ", "<|endoftext|> hi", "ΑΣ ΑΣ.", "İstanbul ﬁ ½ Ⅷ 12a_b", "a\x1cb\x85c", "it's we'LL 'S", "é é", "日本語 🙂🙂", "aaa aaaa aaaaaaa", "x​y", ",a", "a.,b", "x ,y", "..a", "a b.\nc", "1,000.5 é,", "a\x00b", " lead", "a\n\nb"]


def test_bpe(spark, texts, empty):
    library = Tokenizer.from_file(WORD_FILE)
    every = [*texts, *HARD]
    df = spark.createDataFrame(list(enumerate(every)), "ids int, text string").repartition(3)
    for r in bpe.encode(df, WORD_FILE).collect():
        want = library.encode(every[r["ids_"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n_tokens"] == len(want), every[r["ids_"]]
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)
    own = bpe.encoder(WORD_FILE)
    assert own.decode(library.encode("a b", add_special_tokens=False).ids) == "a</w> b</w>"
    assert bpe.encode(empty, WORD_FILE).count() == 0


def test_bpe_small_cache_and_many():
    library = Tokenizer.from_file(WORD_FILE)
    own = bpe.PairIndexBpe(WORD_FILE, cache_bytes=10)
    rng = random.Random(9)
    batch = ["".join(rng.choice("aabcdeé") for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    for _ in range(2):
        assert [np.frombuffer(i, "<u4").tolist() for i, _ in own.encode(batch)] == [library.encode(t, add_special_tokens=False).ids for t in batch]


def test_token_files(spark, texts, empty):
    library = Tokenizer.from_file(BYTE_FILE)
    every = [*texts, *HARD]
    df = spark.createDataFrame([(k * 2, t) for k, t in enumerate(every)], "doc_id long, text string").repartition(3)
    path = new_path(spark, "test-tokens")
    token_files.write_tokens(df, path, BYTE_FILE, partitions=4)
    rows = {r["doc_id"]: r for r in token_files.with_starts(token_files.token_offsets(token_files.read_tokens(spark, path))).collect()}
    start = 0
    for k, t in enumerate(every):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        assert tuple(rows[k * 2])[1:] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), t
        start += len(ids)
    some = token_files.read_tokens(spark, path, [4, 8])
    assert some.count() == 2 and "PushedFilters: [In(doc_id" in some._jdf.queryExecution().toString()
    path = new_path(spark, "test-tokens")
    token_files.write_tokens(empty, path, BYTE_FILE)
    assert token_files.read_tokens(spark, path).count() == 0


# media


def test_media(spark, docs, texts, empty):
    got = by_id(media.inspect(media.store(docs, "text", "doc_id"), "doc_id"))
    for k, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b" " * (-len(raw) % 192 if raw else 192)
        r = got[k * 3]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert r["tail_crc32"] == zlib.crc32(payload[-16:]) and r["media_type"] == "audio/wav" and r["n_carved"] == 0
        with wave.open(io.BytesIO(media.wav(payload))) as w:
            assert w.readframes(w.getnframes()) == payload
    assert media.inspect(media.store(empty, "text", "doc_id"), "doc_id").count() == 0


def test_sniffing():
    def chunk(name, body):
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\0")) + chunk(b"IEND", b"")
    sound = media.wav(b"RIFF BM \xff\xd8\xff GIF89a" * 8)
    gif = b"GIF89a\x01\0\x01\0\x80\0\0\0\0\0\xff\xff\xff,\0\0\0\0\x01\0\x01\0\0\x02\x02D\x01\0;"
    bmp = b"BM" + struct.pack("<IIIIiiHHIIIIII", 58, 0, 54, 40, 1, 1, 1, 24, 0, 4, 0, 0, 0, 0) + b"\0\0\0\0"
    data = b"xx" + png + b"RIFFfake" + gif + sound + bmp + png[:-3]
    assert [(f.kind, f.length) for f in media.sniff(data)] == [("image/png", len(png)), ("image/gif", len(gif)), ("audio/wav", len(sound)), ("image/bmp", len(bmp))]
    broken = png[:20] + b"\x07" + png[21:]
    assert media.sniff(broken) == [] and media.sniff(b"") == []
    assert media.corrected_type("text/plain", media.sniff(png)) == "image/png" and media.corrected_type(None, []) is None


# mixing


def test_mixing(spark, empty):
    rng = random.Random(3)
    rows = [(k, sentence(rng, rng.randint(0, 80)) or None, rng.choice(["a", "a", "a", "b", "c", None])) for k in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got, again = by_id(mixing.mix(df)), by_id(mixing.mix(df.repartition(7)))
    assert {i: r["taken"] for i, r in got.items()} == {i: r["taken"] for i, r in again.items()}
    size = {k: len((t or "").split()) for k, t, _ in rows}
    total = defaultdict(int)
    for k, _, s in rows:
        total[s] += size[k]
    order = sorted(total, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    capped = {}
    while True:
        rest = [s for s in order if s not in capped]
        level = (1.5 * sum(total.values()) - sum(capped.values())) / sum(weight[s] for s in rest)
        over = [s for s in rest if level * weight[s] > 2 * total[s]]
        if not over:
            break
        capped |= {s: 2.0 * total[s] for s in over}
    taken = defaultdict(int)
    for k, _, s in rows:
        r = got[k]
        want = capped.get(s, level * weight[s])
        assert r["size"] == size[k] and r["source_size"] == total[s] and abs(r["target"] - want) < 1e-6 * want
        assert r["copies"] in (0, 1, 2) and r["taken"] == r["copies"] * r["size"]
        taken[s] += r["taken"]
        total_want = want
        capped.setdefault("", 0)
    for s in order:
        want = next(got[k]["target"] for k, _, x in rows if x == s)
        assert abs(taken[s] - want) <= 0.01 * want + 2
    assert total_want > 0 and mixing.mix(empty).count() == 0


def test_mixing_edges(spark):
    rows = [(1, "a b", "s"), (1, "c", "s"), (None, "x y z", None), (None, None, None), (2, "", "t")]
    got = [tuple(r) for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).select("doc_id", "size", "target", "copies").collect()]
    assert len(got) == 5 and len({c for d, _, _, c in got if d == 1}) == 1
    assert all(t == 0 and c == 0 for d, _, t, c in got if d == 2)


def test_flight_keeps_totals():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 500, 300)
    pi = rng.random(300)
    out = mixing.flight(pi, size, rng)
    assert np.isclose(out.sum(), pi.sum()) and np.isclose((out * size).sum(), (pi * size).sum(), rtol=1e-6)
    assert ((out > 0) & (out < 1)).sum() <= 2
    mean = np.mean([mixing.flight(np.full(30, 0.3), size[:30], np.random.default_rng(k)) for k in range(800)], axis=0)
    assert abs(mean - 0.3).max() < 0.08


def test_token_cache_looks_pieces_up_once(monkeypatch):
    """Ids of pieces lie in one array by number; whatever was kept before, they are the library's."""
    rng = random.Random(5)
    texts = [sentence(rng, 40) for _ in range(30)] + ["", "one, two.", "a\nb", " led", "a  b", "x.y", "\u00e9t\u00e9, oui", "one, two."]
    library = token_files.Tokenizer.from_file(BYTE_FILE)
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for octets in (1, 1 << 20):
        cache = token_files.WordCache(BYTE_FILE, octets)
        assert [x for k in range(0, len(texts), 7) for x in cache.encode(texts[k : k + 7])] == want
        assert len(cache.known) == len(cache.starts) == len(cache.sizes) and not cache.known.fresh
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    token_files.word_cache(BYTE_FILE)
    assert token_files.os.environ["TOKENIZERS_PARALLELISM"] == "false"


def test_full_token_cache_keeps_what_is_frequent(monkeypatch):
    """A full cache forgets pieces of single batches and keeps those that come again, which the library sees once; the ids
    stay those of the library."""
    rng = random.Random(16)
    cache, library = token_files.WordCache(BYTE_FILE, 60 * token_files.ENTRY), token_files.Tokenizer.from_file(BYTE_FILE)
    learned, learn = [], cache._learn
    monkeypatch.setattr(cache, "_learn", lambda pieces: learned.extend(pieces) or learn(pieces))
    for k in range(30):
        texts = [f"all of the same words, {rng.choice(WORDS)} x{k}y{j} é{k}.\nand so on" for j in range(12)] + ["", "two  spaces"]
        want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert cache.encode(texts) == want
        assert len(cache.known) == len(cache.starts) == len(cache.sizes)
    assert learned.count(" same") == 1 and learned.count(" x3y4") == 1 and len(cache.known) < 200
