"""Line deduplication over levelled sorted runs of line hashes.

A run is a table (h1, h2, doc) sorted and bucketed by the 128-bit hash of a line's key; it says which document holds
the key first. Batches come in ascending document order. A batch reduces its lines to one row a key (partial
aggregation, so a line that a third of all documents share is a few rows a task), merge-anti-joins every run, and what
is left becomes a run of level 0. `fanout` runs of one level are merged into one of the next, so a batch meets
O(log batches) runs. Runs keep their bucketing: an anti-join reads them without an exchange.

Defined results:
* null and empty text: one empty line, which is too short to be dropped;
* rows that repeat a doc_id are the same document: its lines never drop one another;
* a null doc_id sorts after all others, and all such rows count as one document;
* an empty table gives an empty result; columns of the input pass through, whatever their names: one that is called
  like a new column (n_lines, n_dropped) comes back with underscores behind its name.
Only DataFrame functions are used.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import SPACE, ascii_lower, column_of, cut, delete, discard, passed, shared_dir

MIN_KEY_CHARS = 10
#: Rows of a batch, at most, and batches, at least; runs of a level that are merged into one of the next.
BATCH_ROWS, LEAST_BATCHES, FANOUT = 200_000_000, 4, 4
LAST = 2**63 - 1


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def key_hashes(key: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes: 128 bits, so that 10^12 lines have no collision to speak of."""
    return F.xxhash64(key), F.xxhash64(F.lit(1), key)


class LineRuns:
    """The levels of sorted runs. `add` takes the lines of one batch and returns those to drop."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            df.repartition(self.buckets, "h1", "h2")
            .write.bucketBy(self.buckets, "h1", "h2")
            .sortBy("h1", "h2")
            .option("path", f"{shared_dir(self.spark)}/{name}")
            .saveAsTable(name)
        )
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, lines: DataFrame) -> DataFrame:
        """lines (h1, h2, doc, ...) of a batch, whose documents come after all earlier ones -> those to drop, without hashes."""
        firsts = lines.groupBy("h1", "h2").agg(F.min("doc").alias("doc"))
        for run in self.runs():
            firsts = firsts.join(run.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        name = self._write(firsts)
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(name)
        dropped = lines.join(self.spark.table(name).hint("merge"), ["h1", "h2", "doc"], "left_anti")
        dropped = cut(dropped.drop("h1", "h2"), "line-drops")
        self._compact()
        return dropped

    def _compact(self) -> None:
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fanout:
                old, self.levels[level] = self.levels[level], []
                merged = self.spark.table(old[0])
                for name in old[1:]:
                    merged = merged.unionByName(self.spark.table(name))
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._write(merged))
                self._drop(old)
            level += 1

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")
            delete(self.spark, f"{shared_dir(self.spark)}/{name}")

    def close(self) -> None:
        for level in self.levels:
            self._drop(level)
        self.levels = []


def dedup_lines(
    docs: DataFrame, batches: int | None = None, fanout: int = FANOUT, min_chars: int = MIN_KEY_CHARS, buckets: int | None = None
) -> DataFrame:
    """docs with `text` replaced by the lines kept, and `n_lines` (before) and `n_dropped` added.

    batches: slices of the documents by ascending doc_id, of about equal counts; by default as many as keep one at
    BATCH_ROWS rows, and 4 at least.
    """
    spark = docs.sparkSession
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    body = F.coalesce("text", F.lit(""))
    # rows of one doc_id with the same text lose the same lines, so a row is known by these two and needs no number
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[column_of(c) for c in others]).alias("row"), doc.alias("doc"), F.xxhash64(body).alias("body"), body.alias("text"))
    if batches is None:
        batches = max(LEAST_BATCHES, -(-docs.count() // BATCH_ROWS))
    cuts = docs.agg(F.percentile_approx(doc, [(i + 1) / batches for i in range(batches - 1)], 1000)).first()[0] if batches > 1 else []
    cuts = sorted(set(cuts or []))
    lines = rows.select("doc", "body", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.select("doc", "body", "pos", line_key(F.col("line")).alias("key")).filter(F.length("key") >= min_chars)
    h1, h2 = key_hashes(F.col("key"))
    lines = cut(lines.select(h1.alias("h1"), h2.alias("h2"), "doc", "body", "pos", batch_of("doc", cuts).alias("batch")), "lines", "batch")
    runs = LineRuns(spark, fanout, buckets)
    parts = []
    try:
        for b in range(len(cuts) + 1):
            parts.append(runs.add(lines.filter(F.col("batch") == b).drop("batch")))
    finally:
        runs.close()
        discard(lines)
    drops = reduce(DataFrame.unionByName, parts)
    gone = drops.groupBy("doc", "body").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    joined = rows.join(gone.hint("merge"), ["doc", "body"], "left").withColumn("every", F.split("text", "\n"))
    names = passed(others, ["text", "n_lines", "n_dropped"])
    kept = F.when(F.col("gone").isNull(), F.col("every")).otherwise(without(F.col("every"), F.col("gone")))
    return joined.withColumn("kept", kept).select(
        *[F.col("row").getField(c).alias(n) for c, n in names.items()],
        F.array_join("kept", "\n").alias("text"),
        F.size("every").cast("long").alias("n_lines"),
        (F.size("every") - F.size("kept")).cast("long").alias("n_dropped"),
    )


def without(array: Column, places: Column) -> Column:
    """array without its elements at the ascending places: what lies between two places, in one pass."""

    def between(k: Column) -> Column:
        after = F.when(k == 0, F.lit(-1)).otherwise(F.get(places, k - 1))
        upto = F.coalesce(F.get(places, k), F.size(array))
        return F.slice(array, after + 2, upto - after - 1)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(places)), between))


def batch_of(column: str, cuts: list[int]) -> Column:
    out = F.lit(0)
    for c in cuts:
        out = out + (F.col(column) > c).cast("int")
    return out
