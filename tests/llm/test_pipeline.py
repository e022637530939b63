"""The pipeline's stages, each on what the one before kept, against brute force."""

import random
from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.test_operators import SCHEMA, brute_join, brute_lines, sentence


def corpus():
    rng = random.Random(8)
    rows = []
    for k in range(60):
        lines = [sentence(rng, rng.randint(3, 25)) for _ in range(rng.randint(1, 4))]
        if k % 7 == 0:
            lines.append("The same line in many documents")
        rows.append("\n".join(lines))
    rows += [rows[3], rows[5] + " more", None, "", "123 456", "…"]
    return [(k, t, ["aa", "bb", None][k % 3], f"s{k % 3}", len(t or "")) for k, t in enumerate(rows)]


def test_stages(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if name != "bpe":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept[name] = docs.collect()
    texts = {r["doc_id"]: r["text"] for r in kept["language_id"]}
    assert set(texts) == {i for i, t, *_ in rows if t and any(c.isalpha() for c in t)}
    assert all(r["lang"] for r in kept["language_id"])
    lines = brute_lines(sorted(texts.items()))
    assert {r["doc_id"]: r["text"] for r in kept["line_dedup"]} == {i: t for i, (t, _, _) in lines.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in kept["line_dedup"])
    groups = brute_join([(i, t) for i, (t, _, _) in sorted(lines.items())], 80, 5)
    assert sorted(r["doc_id"] for r in kept["ngram_join"]) == sorted(i for i, c in groups.items() if i == c)
    size = {r["doc_id"]: len(r["text"].split()) for r in kept["ngram_join"]}
    taken = defaultdict(int)
    for r in kept["mixing"]:
        taken[r["doc_id"]] += 1
    assert set(taken) <= set(size) and max(taken.values()) <= 2
    total = sum(size[i] * n for i, n in taken.items())
    assert abs(total - 1.5 * sum(size.values())) <= 0.05 * total
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = {r["doc_id"]: r["text"] for r in kept["mixing"]}
    assert len(kept["bpe"]) == len(kept["mixing"])
    for r in kept["bpe"]:
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode(text[r["doc_id"]], add_special_tokens=False).ids


def test_run_equals_stages(spark, tmp_path):
    spark.createDataFrame(corpus(), SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    a, b = (sorted((r["doc_id"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) for _ in range(2))
    assert a == b and a


def test_language_stage_without_languages(spark, tmp_path):
    rows = [(i, t, None, s, n) for i, t, _, s, n in corpus()]
    out = corpus_pipeline.identify_language(spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in out) == [i for i, t, *_ in rows if t and any(c.isalpha() for c in t)]
    assert {r["lang"] for r in out} == {"und"}
