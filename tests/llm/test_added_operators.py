"""Periodic runs, near duplicates by sketches and importance resampling against slow versions; the queries' SQL in DuckDB."""

import hashlib
import math
import random
import time
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

from strandline.llm import fingerprints, licenses, minhash, periodic_runs, queries, resampling

from .test_operators import WORDS, brute_join, by_id, lower, sentence

DIR = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not Path(DIR).exists(), reason="no test tables here")


# periodic runs


def brute_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            lo = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - lo >= max(6, 4 * q):
                found.setdefault((lo, i + q), q)
    return sorted((lo, hi - lo, q) for (lo, hi), q in found.items())


def brute_kept(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + k for s, k, q in runs)]


def repetitive(rng):
    out = []
    for _ in range(rng.randint(1, 6)):
        piece = [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(1, 9))]
        out += piece * rng.randint(1, 7) + piece[: rng.randint(0, len(piece))]
        if rng.random() < 0.3:
            out[rng.randrange(len(out))] = "z"
    return out


def test_runs_equal_brute_force():
    rng = random.Random(11)
    cases = [[rng.choice("ab") for _ in range(rng.randint(0, 60))] for _ in range(300)] + [repetitive(rng) for _ in range(700)]
    cases += [["a"] * n for n in range(9)] + [list("ab") * 3, list("aab") * 4, list("aabaab") * 4]
    for words in cases:
        runs = periodic_runs.runs_of(periodic_runs.numbered(words))
        assert runs == brute_runs(words), words
        stay = periodic_runs.kept(len(words), runs)
        assert [w for w, s in zip(words, stay, strict=True) if s] == brute_kept(words, runs)


def test_runs_of_long_texts():
    rng = random.Random(2)
    piece = [rng.choice(WORDS) for _ in range(20_000)]
    start = time.time()
    assert periodic_runs.runs_of(periodic_runs.numbered(["x", *piece * 5, "y"])) == [(1, 100_000, 20_000)]
    assert periodic_runs.runs_of(periodic_runs.numbered(["a"] * 300_000)) == [(0, 300_000, 1)]
    assert periodic_runs.runs_of(periodic_runs.numbered(["a", "b"] * 150_000)) == [(0, 300_000, 2)]
    assert time.time() - start < 60


def test_find_runs_edges(spark):
    loop = "x " + "a b c " * 5 + "y"
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, loop), (4, loop), (5, "one\x0btwo\rthree"), (None, "a A a A a A a A"), (6, "a " * 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'r' AS runs", "'c' AS collapsed", "7 AS `a.b`")
    got = periodic_runs.find_runs(df).collect()
    assert set(got[0].asDict()) == {"doc_id", "text", "runs_", "collapsed_", "a.b", "runs", "collapsed"}
    assert len(got) == len(rows) and all((r["runs_"], r["collapsed_"], r["a.b"]) == ("r", "c", 7) for r in got)
    found = sorted(((r["doc_id"] or 0, [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got), key=repr)
    four = (4, [(1, 15, 3)], "x a b c y")
    assert found == sorted([(1, [], ""), (2, [], ""), (3, [], ""), four, four, (5, [], "one two three"), (0, [(0, 8, 2)], "a A"), (6, [(0, 6, 1)], "a")], key=repr)
    assert periodic_runs.find_runs(df.limit(0)).count() == 0


# near duplicates by sketches


def brute_components(rows, percent, size):
    return brute_join(rows, percent, size)


@pytest.mark.parametrize("percent, size", [(80, 2), (80, 5), (90, 3)])
def test_near_duplicates(spark, percent, size):
    rng = random.Random(percent + size)
    rows = []
    for n in [1, 2, 3, 6, 9, 14, 18, 25, 40, 66, 90, 150, 400] * 2:
        base = sentence(rng, n).split()
        for _ in range(rng.randint(1, 6)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, max(1, n // 20)])):
                at = rng.randrange(len(w) + 1)
                w[at : at + rng.randint(0, 1)] = rng.sample(WORDS, rng.randint(0, 2))
            rows.append(" ".join(w))
    rows = [(k, t) for k, t in enumerate([*rows, None, "", "  ", "one", "ONE", "Two words", "two\tWORDS"])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = by_id(minhash.near_duplicates(df, percent, size))
    assert {i: r["component_id"] for i, r in got.items()} == brute_components(rows, percent, size)
    for i, t in rows:
        w = lower(t or "").split()
        assert got[i]["n_shingles"] == (len({tuple(w[k : k + size]) for k in range(len(w) - size + 1)}) if len(w) >= size else min(len(w), 1))


def test_near_duplicates_edges(spark):
    rows = [(None, "a b c d"), (3, "a b c d"), (5, "a b c d"), (5, "x y z w"), (9, "X y z w"), (11, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'n' AS node", "1 AS n_shingles", "2 AS component_id")
    out = minhash.near_duplicates(df).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in out) == [(-1, -1), (3, 3), (5, 3), (5, 3), (9, 3), (11, 11)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        minhash.near_duplicates(df, percent=70)


def test_estimates_come_near_the_similarity():
    rng = np.random.default_rng(3)
    for shared in (600, 1200, 1800):
        both, a, b = (np.unique(rng.integers(0, 2**63, n, np.uint64)) for n in (shared, 2000 - shared, 2000 - shared))
        x, y = (minhash._matrix([minhash.sketch(np.sort(np.concatenate([both, own])))]) for own in (a, b))
        assert abs(minhash.estimates(x, y)[0] - shared / (4000 - shared)) < 0.2


# importance resampling


def brute_resampling(docs, target, percent, least, buckets=10_000):
    word = lambda t: [w for w in "".join(c if c.isalnum() or ord(c) > 127 else " " for c in lower(t or "")).split(" ") if w]
    runs = lambda w: [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    own = [(i, word(t)) for i, t in docs]
    s, t = Counter(bucket(f) for _, w in own for f in runs(w)), Counter(bucket(f) for x in target for f in runs(word(x)))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
    out = []
    for i, w in own:
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in runs(w))
        out.append([i, len(runs(w)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


@pytest.mark.parametrize("percent, least", [(5, 20), (60, 1)])
def test_resampling(spark, percent, least):
    rng = random.Random(13)
    texts = [sentence(rng, rng.randint(1, 90)) for _ in range(150)] + [None, "", "...", "Ünï-ÀB don't 日本語 X", "w" * 300 + " y z " + "v" * 200, sentence(rng, 20_000)]
    docs, target = list(enumerate(texts)), [sentence(rng, 30) for _ in range(20)] + [None]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    to = spark.createDataFrame([(t,) for t in target], "text string")
    out = resampling.resample(df, to, percent, least).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted(map(tuple, out.collect()), key=repr) == brute_resampling(docs, target, percent, least)


def test_draw_over_many_ranges_with_ties(spark):
    rows = [(k, 30, (k * 7919) % 11 * 5000) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, n_words long, weight long")
    few, many = (sorted(map(tuple, resampling.draw(df, 40, 20, per_range=n).select("doc_id", "score", "rank").collect())) for n in (10**6, 9))
    assert few == many and sorted(r for *_, r in many if r) == list(range(1, 161))
    order = [i for _, i in sorted((-s, i) for i, s, _ in many)]
    assert [i for _, i in sorted((r, i) for i, _, r in many if r)] == order[:160]


def test_resampling_edges(spark):
    rows = [(1, "a b c " * 10, "r"), (1, "a b c " * 10, "r"), (None, "d e " * 15, None), (2, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, rank string").selectExpr("*", "7 AS `a.b`")
    nothing = df.limit(0)
    got = resampling.resample(df, nothing.select("text"), percent=100).collect()
    assert len(got) == 4 and sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3]
    assert {r["rank_"] for r in got} == {"r", None, "x"} and {r["a.b"] for r in got} == {7}
    assert [(r["n_features"], r["weight"], r["rank"]) for r in got if r["doc_id"] == 2] == [(0, 0, None)]
    assert resampling.resample(nothing, df.select("text")).count() == 0


# licenses


def test_scattered_words_are_no_license(spark):
    rng = random.Random(8)
    one_line = [" ".join(x for w in t.split() for x in [w, *rng.sample(WORDS, 6)]) for _, t in licenses.TEMPLATES if len(t.split()) > 8]
    rows = list(enumerate(["we licensed 4 songs by bach under tree 0 times", *one_line]))
    got = by_id(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {(r["labels"], r["score"]) for r in got.values()} == {("", 0.0)}


# the queries


@tables
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for p in Path(DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    want = con.sql(queries.SQL[name])
    df = queries.QUERIES[name](spark, DIR)
    columns = sorted(want.columns)
    assert sorted(df.columns) == columns
    tidied = lambda rows, names: sorted((tuple(round(v, 9) if isinstance(v, float) else v for _, v in sorted(zip(names, r, strict=True))) for r in rows), key=repr)
    assert tidied(map(tuple, df.collect()), df.columns) == tidied(want.fetchall(), want.columns)


@tables
def test_looped_texts(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    looped = 0
    for r in queries.looped(docs).collect():
        h, words = zlib.crc32(str(r["doc_id"]).encode()), (texts[r["doc_id"]] or "").split()
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert r["text"].split() == [words[i if i < a else a + (i - a) % p] for i in range(n)]
            looped += 1
    assert looped > 5


@tables
def test_edited_fingerprints(spark):
    docs = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{DIR}/documents.parquet").collect())
    following = [t for _, t in docs[1:] + docs[:1]]
    edited = {i: t[: len(t) - len(t) // 4] + n[: len(t) // 4] for (i, t), n in zip(docs, following, strict=True)}
    got = by_id(queries.op6_fingerprints(spark, DIR))
    rows = spark.createDataFrame([(i, t, edited[i]) for i, t in docs], "doc_id long, text string, edited string")
    own, other = fingerprints.sketch(rows["text"]), fingerprints.sketch(rows["edited"])
    fresh = by_id(rows.select("doc_id", fingerprints.fingerprint(own).alias("a"), fingerprints.fingerprint(other).alias("b"), fingerprints.resemblance(own, other).alias("near")))
    shingles = lambda t: {tuple(t.split()[k : k + 5]) for k in range(max(len(t.split()) - 4, 0))} or {tuple(t.split())}
    for (i, t), n in zip(docs, following, strict=True):
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited[i].encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"], r["near_edited"]) == (fresh[i]["a"], fresh[i]["b"], fresh[i]["near"])
        for near, x in ((r["near_edited"], edited[i]), (r["near_next"], n)):
            exact = len(shingles(t) & shingles(x)) / len(shingles(t) | shingles(x))
            assert abs(near - exact) < (0.2 if len(shingles(t) | shingles(x)) > 128 else 1e-9)
