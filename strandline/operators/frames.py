"""Operators on frame sequences (rec, t, ...): collapse, runs, spans, prefix counts, chunks.

All of them deal rows by recording and order by frame; a window's partition is one recording.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.arrays import argmax, top_k, top_two


def _by_time(rec: str = "rec", t: str = "t"):
    return Window.partitionBy(rec).orderBy(t)


def greedy(scores: DataFrame) -> DataFrame:
    """rec, t, id (first maximum) and margin (largest less second) of rec, t, lp."""
    two = top_two(F.col("lp"))
    return scores.select("rec", "t", argmax(F.col("lp")).alias("id"), (F.get(two, 0) - F.get(two, 1)).alias("margin"))


def decision_margin(scores: DataFrame) -> DataFrame:
    """margin of the chosen symbol `id` of rec, t, lp, id: to the second if it is the largest, else to the largest;
    infinite at frame 0."""
    two, chosen = top_two(F.col("lp")), F.get("lp", F.col("id").cast("int"))
    own = F.when(F.abs(chosen - F.get(two, 0)) <= 1e-6, F.get(two, 0) - F.get(two, 1)).otherwise(chosen - F.get(two, 0))
    return scores.select("rec", "t", "id", F.when(F.col("t") == 0, F.lit(float("inf"))).otherwise(own).alias("margin"))


def collapse(ids: DataFrame, blank: int) -> DataFrame:
    """Frames where a symbol begins: not blank and not that of the frame before."""
    before = F.lag("id", 1, blank).over(_by_time())
    return ids.withColumn("before", before).filter((F.col("id") != blank) & (F.col("id") != F.col("before"))).drop("before")


def prefix_counts(ids: DataFrame, blank: int) -> DataFrame:
    """ids with n_tokens: how many symbols have begun by each frame."""
    before = F.lag("id", 1, blank).over(_by_time())
    begins = ((F.col("id") != blank) & (F.col("id") != before)).cast("long")
    return ids.withColumn("begins", begins).withColumn("n_tokens", F.sum("begins").over(_by_time())).drop("begins")


def label_states(labels: DataFrame, blank: int, references: DataFrame | None = None) -> DataFrame:
    """State of each frame of a label sequence: blanks 2c and labels 2(c - 1) + 1 after c labels have begun. With references
    (rec, ids) a label that is not the next one of its recording, or one too many, is an error."""
    counted = prefix_counts(labels, blank)
    if references is not None:
        wrong = (F.col("id") != blank) & ~F.col("id").eqNullSafe(F.get("ids", (F.col("n_tokens") - 1).cast("int")))
        told = F.raise_error(F.concat(F.lit("label out of order at frame "), F.col("t").cast("string"))).cast("long")
        counted = counted.join(references.select("rec", "ids"), "rec", "left").withColumn("n_tokens", F.when(wrong, told).otherwise(F.col("n_tokens"))).drop("ids")
    return counted.withColumn("state", F.when(F.col("id") == blank, 2 * F.col("n_tokens")).otherwise(2 * F.col("n_tokens") - 1)).drop("n_tokens")


def runs(ids: DataFrame, columns: dict[str, Column] | None = None) -> DataFrame:
    """rec, run_no, id, first, last, frames of maximal runs of equal ids (and aggregates of them)."""
    order = _by_time()
    new = F.coalesce(F.col("id") != F.lag("id").over(order), F.lit(True)).cast("long")
    marked = ids.withColumn("new", new).withColumn("run_no", F.sum("new").over(order) - 1)
    more = [c.alias(name) for name, c in (columns or {}).items()]
    return marked.groupBy("rec", "run_no", "id").agg(F.min("t").alias("first"), F.max("t").alias("last"), F.count("*").alias("frames"), *more)


def run_confidence(probabilities: DataFrame, blank: int, k: int = 3, frame_sec: float = 0.04) -> DataFrame:
    """Runs of one non-blank argmax of rec, t, p: confidence (mean probability), margin (less the best other mean, rounded
    first), peak values, times (exclusive end) and the next k by mean. Means are folded in frame order."""
    ids = probabilities.select("rec", "t", "p", argmax(F.col("p")).alias("id"))
    frames = {"ps": F.array_sort(F.collect_list(F.struct("t", "p")))}
    own = runs(ids, frames).filter(F.col("id") != blank)
    n = F.size("ps")
    width = F.size(F.get("ps", 0)["p"])
    mean = F.transform(
        F.sequence(F.lit(0), width - 1), lambda i: F.aggregate(F.col("ps"), F.lit(0.0), lambda acc, f: acc + F.get(f["p"], i)) / n
    )
    own = own.withColumn("mean", mean)
    of_unit = F.transform("ps", lambda f: F.get(f["p"], F.col("id")))
    own = own.withColumn("confidence", F.get("mean", F.col("id"))).withColumn("of_unit", of_unit)
    alternatives = F.transform(
        top_k(F.col("mean"), k, F.col("id")), lambda a: F.struct(a["index"].alias("id"), F.round(a["value"], 4).alias("p"))
    )
    own = own.withColumn("alternatives", alternatives).withColumn("peak", F.get("ps", argmax(F.col("of_unit")))["p"])
    two = top_two(F.col("peak"))
    return own.select(
        "rec",
        "run_no",
        "id",
        F.round("confidence", 4).alias("confidence"),
        F.round(F.col("confidence") - F.coalesce(F.get("alternatives", 0)["p"], F.lit(0.0)), 4).alias("margin"),
        F.round(F.array_max("of_unit"), 4).alias("confidence_peak"),
        F.round(F.get(two, 0) - F.get(two, 1), 4).alias("margin_peak"),
        F.round(F.col("first") * frame_sec, 3).alias("start"),
        F.round((F.col("last") + 1) * frame_sec, 3).alias("end"),
        "frames",
        "alternatives",
    )


def state_spans(path: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """rec, state, first_seen, last_seen; with states (rec, state) also those never seen, as -1."""
    seen = path.groupBy("rec", "state").agg(F.min("t").alias("first_seen"), F.max("t").alias("last_seen"))
    if states is None:
        return seen
    return states.join(seen, ["rec", "state"], "left").na.fill(-1, ["first_seen", "last_seen"])


def token_spans(spans: DataFrame, tokens: DataFrame) -> DataFrame:
    """rec, word_no, start_frame, end_frame, spans: of tokens (rec, word_no, pos); a word with a token whose state
    2 pos + 1 was never seen is left out."""
    seen = spans.filter(F.col("first_seen") >= 0)
    got = tokens.withColumn("state", 2 * F.col("pos") + 1).join(seen, ["rec", "state"], "left")
    words = got.groupBy("rec", "word_no").agg(
        F.count("*").alias("n_tokens"),
        F.count("first_seen").alias("n_seen"),
        F.min("first_seen").alias("start_frame"),
        F.max("last_seen").alias("end_frame"),
        F.array_sort(F.collect_list(F.struct("pos", F.col("first_seen").alias("start"), F.col("last_seen").alias("end")))).alias("spans"),
    )
    words = words.filter(F.col("n_tokens") == F.col("n_seen"))
    return words.select("rec", "word_no", "start_frame", "end_frame", F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("token_frame_spans"))


def path_scores(scores: DataFrame, path: DataFrame, states: DataFrame) -> DataFrame:
    """rec, t, lp of the symbol on the path: scores (rec, t, lp) by path (rec, t, state) and states (rec, state, symbol)."""
    on_path = path.join(states, ["rec", "state"])
    return scores.join(on_path, ["rec", "t"]).select("rec", "t", F.get("lp", F.col("symbol").cast("int")).alias("lp"))


def prefix_sums(values: DataFrame, column: str) -> DataFrame:
    """values with total: the sum of column up to and with each frame."""
    return values.withColumn("total", F.sum(column).over(_by_time()))


def chunks(lengths: DataFrame, window: int = 61, hop: int = 48) -> DataFrame:
    """rec, chunk, first_frame, last_frame, padding of the sliding windows over rec, n_frames; the last is padded."""
    n = F.when(F.col("n_frames") <= window, 1).otherwise(1 + F.ceil((F.col("n_frames") - window) / hop)).cast("int")
    rows = lengths.select("rec", "n_frames", F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk"))
    first = F.col("chunk") * hop
    last = F.least(first + window, F.col("n_frames")) - 1
    return rows.select("rec", "chunk", first.alias("first_frame"), last.alias("last_frame"), (first + window - 1 - last).alias("padding"))


def segments(lengths: DataFrame, splits: DataFrame, warmup: int = 4, window: int = 61, hop: int = 48) -> DataFrame:
    """rec, segment, first_chunk, end_chunk, first_row, end_row, skip: pieces between splits (rec, chunk), each read from
    `warmup` chunks earlier, whose outputs (skip chunks of them) are thrown away."""
    order = Window.partitionBy("rec").orderBy("chunk")
    ends = splits.select("rec", "chunk").unionByName(lengths.select("rec", F.lit(0).alias("chunk"))).distinct()
    total = F.when(F.col("n_frames") <= window, 1).otherwise(1 + F.ceil((F.col("n_frames") - window) / hop)).cast("int")
    rows = ends.join(lengths, "rec").withColumn("end_chunk", F.coalesce(F.lead("chunk").over(order), total))
    start = F.greatest(F.lit(0), F.col("chunk") - warmup)
    return rows.select(
        "rec",
        (F.row_number().over(order) - 1).alias("segment"),
        F.col("chunk").alias("first_chunk"),
        "end_chunk",
        (start * hop).alias("first_row"),
        F.least((F.col("end_chunk") - 1) * hop + window, F.col("n_frames")).alias("end_row"),
        (F.col("chunk") - start).alias("skip"),
    )


def stitch(outputs: DataFrame, pieces: DataFrame, per_chunk: int = 12) -> DataFrame:
    """rec, t of the outputs (rec, segment, row) that stay: warm-up rows go, the others take their place in the recording."""
    local = F.col("row") - F.col("skip") * per_chunk
    kept = outputs.join(pieces, ["rec", "segment"]).filter((local >= 0) & (local < (F.col("end_chunk") - F.col("first_chunk")) * per_chunk))
    return kept.select("rec", "segment", "row", (F.col("first_chunk") * per_chunk + local).alias("t"))


def has_preamble(ids: DataFrame, vocabulary: DataFrame, blank: int, signatures: list[str], most: int = 250, least: int = 30) -> DataFrame:
    """rec, preamble: whether the collapsed text of the first frames (rec, t, id) holds one of the signatures."""
    early = ids.filter(F.col("t") < most)
    lengths = early.groupBy("rec").agg(F.count("*").alias("n"))
    begun = collapse(early, blank).join(F.broadcast(vocabulary), "id", "left")  # a vocabulary has a few hundred rows
    text = begun.groupBy("rec").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("t", F.coalesce("token", F.lit("")).alias("token")))), lambda x: x["token"]), "").alias("text"))
    found = F.lit(False)
    for s in signatures:
        found = found | F.col("text").contains(s)
    return lengths.join(text, "rec", "left").select("rec", ((F.col("n") >= least) & F.coalesce(found, F.lit(False))).alias("preamble"))
