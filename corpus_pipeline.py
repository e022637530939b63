"""The corpus pipeline: each stage applies one operator of strandline.llm to all that the stage before it kept.

documents -> language ID (rejected: no letters) -> line dedup -> n-gram Jaccard join (one document of each group stays)
-> mixing to target weights -> BPE. run() writes nothing but what the operators write to the shared folder; a runner that
writes each stage as Parquet and reads it again gets the same rows.

Defined results, of every stage: an empty table gives an empty one; null text counts as empty (the first stage rejects it);
null lang or source is a value of its own where it matters; columns beside those of documents, whatever their names, are
not used and not returned; rows that repeat a doc_id are one document to the n-gram join and to mixing and stay or go
together, and are separate rows elsewhere; of documents that tie, the smallest doc_id stays; nothing is cut by length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import bpe, language_id, line_dedup, mixing, ngram_join
from strandline.llm.common import clean, cut, discard, written
from strandline.llm.queries import WORD_VOCABULARY, vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that are no language: null text or no letter. The others get the predicted language where theirs is null."""
    held_out = language_id.held_out(F.col("doc_id"))
    profiles = language_id.train(docs.filter(~held_out))
    found = language_id.predict(docs.select(*COLUMNS), profiles)
    kept = found.filter((F.col("lang_pred") != language_id.UNKNOWN) | F.col("text").rlike(r"\p{L}"))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; every document stays, with the text that is left."""
    return line_dedup.dedup_lines(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 the one with the smallest doc_id stays."""
    groups = ngram_join.similar(docs.select("doc_id", "text"), percent=80, size=5)
    losers = groups.filter(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct()
    return docs.join(losers.hint("merge"), "doc_id", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice."""
    copies = mixing.mix(docs).groupBy("doc_id").agg(F.first("copies").alias("copies"))
    copies = cut(copies.filter("copies > 0").withColumnRenamed("doc_id", "unit"), "copies")
    taken = docs.select(*COLUMNS).join(copies.hint("merge"), F.col("doc_id").eqNullSafe(F.col("unit")))
    return taken.select(*COLUMNS, F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids_sha256, decoded_sha256 and ids (binary: little-endian unsigned 32-bit) of every document."""
    out = bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary(WORD_VOCABULARY))
    return out.select(
        "doc_id", "lang", "source", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "ids"
    )


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", one_of_each_group),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Language profiles, the cube method and BPE are not expressible in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage wrote goes as soon as its result is written, so the disk holds two stages at most."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        since, before = written(), docs
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
        clean(spark, since, but=(docs._strandline_path,))
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
