"""Catalog, resume and report operators of a campaign over collections of recordings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The file name extensions of audio, in order of preference.
EXTENSIONS = [".mp3", ".opus", ".wav", ".m4a", ".ogg", ".flac", ".aac", ".wma"]


def explode_catalog(catalog: DataFrame) -> DataFrame:
    """slug, name, surah, url of slug, name, surahs (map); entries without a url are left out."""
    rows = catalog.select("slug", "name", F.explode("surahs").alias("surah", "entry"))
    entry = F.col("entry.mp3_url") if "struct" in dict(rows.dtypes)["entry"] else F.col("entry")
    return rows.select("slug", "name", F.col("surah").cast("int").alias("surah"), entry.alias("url")).filter("url IS NOT NULL")


def choose(catalog: DataFrame, everything: bool = False, indexes: list[int] = (), slugs: list[str] = ()) -> DataFrame:
    """Rows (idx, slug, name) that are asked for by index, slug or name (any case), once each; the first if nothing is asked for."""
    if everything:
        return catalog
    wanted = [s.strip().lower() for s in slugs if s.strip()]
    if not wanted and not indexes:
        return catalog.filter("idx = 0")
    return catalog.filter(F.col("idx").isin(list(indexes)) | F.lower("slug").isin(wanted) | F.lower("name").isin(wanted))


def complete(rows: DataFrame, key: str, item: str, wanted: int) -> DataFrame:
    """key, n_items of the keys with `wanted` different items; repeated items count once."""
    return rows.groupBy(key).agg(F.count_distinct(item).alias("n_items")).filter(F.col("n_items") == wanted)


def finished(files: DataFrame, least: dict[str, int]) -> DataFrame:
    """Keys (slug, surah) of files (slug, surah, kind, length) that have every kind at more than its least length."""
    ok = reduce(lambda a, b: a | b, [(F.col("kind") == k) & (F.col("length") > n) for k, n in least.items()])
    return files.filter(ok).groupBy("slug", "surah").agg(F.count_distinct("kind").alias("kinds")).filter(F.col("kinds") == len(least)).drop("kinds")


def remaining(targets: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return targets.join(done.select(*keys), keys, "left_anti")


def downloaded(targets: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    return targets.join(files.select(*keys), keys, "left_semi")


def find_files(files: DataFrame, surahs: DataFrame) -> DataFrame:
    """surah, path: for each the file (path, file name) that suits best: padded name by extension order, plain name, then a
    name that goes on with _ or - after the padded number (the first by name)."""
    stem, ext = F.regexp_extract("file", r"^(.*)(\.[^.]*)$", 1), F.regexp_extract("file", r"^(.*)(\.[^.]*)$", 2)
    order = F.array_position(F.lit(EXTENSIONS), ext)
    number = F.regexp_extract("file", r"^(\d+)", 1)
    rows = files.filter(number != "").withColumn("surah", number.cast("int"))
    padded = F.format_string("%03d", "surah")
    rank = (
        F.when((stem == padded) & (order > 0), order)
        .when((stem == F.col("surah").cast("string")) & (order > 0), 100 + order)
        .when(F.col("file").startswith(F.concat(padded, F.lit("_"))) | F.col("file").startswith(F.concat(padded, F.lit("-"))), 1000)
    )
    best = rows.withColumn("rank", rank).filter("rank IS NOT NULL").groupBy("surah").agg(F.min_by("path", F.struct("rank", "file")).alias("path"))
    return surahs.join(best, "surah", "left")


def chunked(rows: DataFrame, size: int, order: list[Column | str], group: list[str]) -> DataFrame:
    """rows with chunk_no: pieces of `size` rows in the order given, within each group. At least one group column is asked
    for: without one all rows would be numbered by one task."""
    if not group:
        raise ValueError("chunks are numbered within groups; name the columns of a group")
    window = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("chunk_no", F.floor((F.row_number().over(window) - 1) / size).cast("int"))


def run_metrics(cues: DataFrame, runs: DataFrame) -> DataFrame:
    """rec, n_words, n_repeats, audio, wall, rtf of runs (rec, audio, wall); rtf = wall / max(audio, 0.001)."""
    counts = cues.groupBy("rec").agg(F.count("*").alias("n_words"), F.count_if(F.col("is_repeat")).alias("n_repeats"))
    got = runs.join(counts, "rec", "left").na.fill(0, ["n_words", "n_repeats"])
    return got.withColumn("rtf", F.col("wall") / F.greatest(F.col("audio"), F.lit(0.001)))


def report(metrics: DataFrame, key: str) -> DataFrame:
    """Totals per key and over all (key null, is_total 1) in one pass: succeeded, failed, hours, words, repeats, rtf, speedup."""
    sums = metrics.rollup(key).agg(
        F.grouping(key).cast("int").alias("is_total"),
        F.count_if(F.col("ok")).alias("succeeded"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.sum("audio").alias("audio_sec"),
        F.sum("wall").alias("wall_sec"),
        F.sum("n_words").alias("n_words"),
        F.sum("n_repeats").alias("n_repeats"),
    )
    rtf = F.when(F.col("audio_sec") > 0, F.col("wall_sec") / F.col("audio_sec")).otherwise(0.0)
    return sums.withColumn("rtf", rtf).withColumn("speedup", F.when(F.col("rtf") > 0, 1 / F.col("rtf")).otherwise(0.0))


def status(n_wanted: Column, n_done: Column, n_ok: Column, n_failed: Column, n_files: Column) -> Column:
    """already_completed, failed_download, ok, partial or failed."""
    return (
        F.when(n_done >= n_wanted, "already_completed")
        .when(n_files == 0, "failed_download")
        .when(n_failed == 0, "ok")
        .when(n_ok > 0, "partial")
        .otherwise("failed")
    )


def error_rate(rows: DataFrame, key: str) -> DataFrame:
    """Micro-averaged error rate of rows (key, hypothesis, reference) per key and over all, with the share of exact matches."""
    marked = rows.withColumn("errors", F.levenshtein("hypothesis", "reference")).withColumn("length", F.length("reference"))
    sums = marked.rollup(key).agg(
        F.grouping(key).cast("int").alias("is_total"),
        F.count("*").alias("n"),
        F.sum("errors").alias("errors"),
        F.sum("length").alias("length"),
        F.avg((F.col("errors") == 0).cast("double")).alias("exact"),
    )
    return sums.withColumn("rate", F.when(F.col("length") > 0, F.col("errors") / F.col("length")).otherwise(0.0))


def markdown(report_rows: list) -> str:
    """A report (one row a collection, a bounded table) as a Markdown table."""
    head = "| collection | succeeded | failed | hours | words | repeats | speedup |\n|-|-|-|-|-|-|-|\n"
    line = "| {} | {} | {} | {:.2f} | {} | {} | {:.1f}x |\n"
    rows = sorted(report_rows, key=lambda r: (r["is_total"], str(r[0])))
    return head + "".join(
        line.format("total" if r["is_total"] else r[0], r["succeeded"], r["failed"], (r["audio_sec"] or 0) / 3600, r["n_words"], r["n_repeats"], r["speedup"]) for r in rows
    )
