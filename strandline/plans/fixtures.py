"""The driver's tables seen as the engine's inputs, in Spark and as SQL common table expressions of the same names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.functions.arrays import argmax

BLANK = 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rec, t, lp: embeddings as score vectors, a label's vectors in order of vec_id its frames."""
    t = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    return table(spark, sf_dir, "embeddings").select(F.col("label").alias("rec"), t.cast("long").alias("t"), F.col("embedding").alias("lp"))


def symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rec, t, id: the first maximum of each frame, folded to four symbols so that there are runs."""
    return scores(spark, sf_dir).select("rec", "t", (argmax(F.col("lp")) % 4).cast("long").alias("id"))


def cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rec, cue_no, word, start, end, aya, sura, is_repeat, n: a user's events in order as aligned words."""
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', cast(ts as timestamp_ntz))")
    start = micros / F.lit(1e6)
    number = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("rec"),
        number.cast("long").alias("cue_no"),
        F.col("event_type").alias("word"),
        start.alias("start"),
        (start + F.col("value")).alias("end"),
        (F.col("event_id") % 7).alias("aya"),
        F.lit(1).alias("sura"),
        (F.col("event_id") % 4 == 1).alias("is_repeat"),
        F.col("value").alias("value"),
    )


def energies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rec, t, energy: suppliers' line quantities by order and line as frame energies."""
    order = Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_tax", "l_discount")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("rec"), (F.row_number().over(order) - 1).cast("long").alias("t"), F.col("l_quantity").alias("energy")
    )


SCORES = """
scores AS (SELECT label AS rec, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS BIGINT) AS t, embedding AS lp FROM embeddings),
greedy AS (SELECT rec, t, lp, list_position(lp, list_max(lp)) - 1 AS best FROM scores),
symbols AS (SELECT rec, t, CAST(best % 4 AS BIGINT) AS id FROM greedy)"""
CUES = """
cues AS (SELECT user_id AS rec, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS cue_no, event_type AS word,
  (epoch_us(ts) - 1704067200000000) / 1e6 AS start, (epoch_us(ts) - 1704067200000000) / 1e6 + value AS "end", event_id % 7 AS aya, 1 AS sura,
  event_id % 4 = 1 AS is_repeat, value FROM events)"""
ENERGIES = """
energies AS (SELECT l_suppkey AS rec, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_tax, l_discount) - 1 AS BIGINT) AS t,
  l_quantity AS energy FROM lineitem)"""
