"""Operators on aligned words (cues): rec, cue_no and their fields. Windows are per recording, ordered by ordinal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.scalars import finite, srt_time

MIN_WORD_SEC = 0.15
INF = float("inf")


def _ordered(*columns: str):
    return Window.partitionBy("rec").orderBy(*columns)


def clamp(cues: DataFrame, shortest: float = MIN_WORD_SEC) -> DataFrame:
    """end lifted to start + shortest, then held back to the next start (never before its own start), in order of start;
    equal starts keep their ordinal order."""
    order = _ordered("start", "cue_no")
    lifted = F.greatest(F.col("end"), F.col("start") + shortest)
    following = F.lead("start").over(order)
    held = F.greatest(F.when(following.isNotNull(), F.least(lifted, following)).otherwise(lifted), F.col("start"))
    return cues.withColumn("position", F.row_number().over(order) - 1).withColumn("end", held)


def strip_preamble(cues: DataFrame) -> DataFrame:
    """Cues of verse 0 go; a null verse counts as 1. After clamp, so that those cues still bound their neighbours."""
    return cues.filter(F.coalesce("aya", F.lit(1)) != 0)


def reference_without_preamble(slots: DataFrame) -> DataFrame:
    """Word slots (rec, word_no, aya, token_positions) without verse 0, positions shifted so that the first token is 0."""
    kept = slots.filter(F.coalesce("aya", F.lit(1)) != 0)
    first = kept.groupBy("rec").agg(F.min(F.array_min("token_positions")).alias("first"))
    return kept.join(first, "rec").withColumn("token_positions", F.transform("token_positions", lambda p: p - F.col("first"))).drop("first")


def whole_words(slots: DataFrame, frames: DataFrame) -> DataFrame:
    """Slots whose last token lies within the first max(10, n_frames / 6) tokens, at most all of them (rec, n_frames, n_tokens)."""
    most = F.least(F.col("n_tokens"), F.greatest(F.lit(10), F.floor(F.col("n_frames") / 6)))
    return slots.join(frames, "rec").filter(F.element_at("token_positions", -1) < most).drop("n_frames", "n_tokens")


def span_means(cues: DataFrame, frame_scores: DataFrame) -> DataFrame:
    """cues with avg_logprob: the mean of lp over start_frame..end_frame by prefix sums; -inf for an empty span."""
    order = Window.partitionBy("rec").orderBy("t")
    sums = frame_scores.select("rec", "t", F.sum("lp").over(order).alias("total"))
    upper = sums.select("rec", F.col("t").alias("end_frame"), F.col("total").alias("upto"))
    lower = sums.select("rec", (F.col("t") + 1).alias("start_frame"), F.col("total").alias("before"))
    got = cues.join(upper, ["rec", "end_frame"], "left").join(lower, ["rec", "start_frame"], "left")
    n = F.col("end_frame") - F.col("start_frame") + 1
    mean = F.when(n > 0, (F.col("upto") - F.coalesce("before", F.lit(0.0))) / n)
    return got.withColumn("avg_logprob", F.coalesce(mean, F.lit(-INF))).drop("upto", "before")


def span_margins(cues: DataFrame, margins: DataFrame) -> DataFrame:
    """cues with min_decision_margin over start_frame..end_frame; +inf for an empty span."""
    frames = cues.select("rec", "cue_no", F.explode(F.when(F.col("end_frame") >= F.col("start_frame"), F.sequence("start_frame", "end_frame"))).alias("t"))
    least = frames.join(margins, ["rec", "t"]).groupBy("rec", "cue_no").agg(F.min("margin").alias("min_decision_margin"))
    return cues.join(least, ["rec", "cue_no"], "left").na.fill(INF, ["min_decision_margin"])


def span_scores(cues: DataFrame, frames: DataFrame) -> DataFrame:
    """cues (rec, cue_no, start_frame, end_frame) whose spans do not overlap, with avg_logprob (the mean of lp) and
    min_decision_margin (the least margin) of the frames (rec, t, lp, margin) in each; -inf and +inf without any.

    One ordered pass of a recording gives every frame its cue, and one aggregate of the same dealing its numbers.
    """
    none = F.lit(None)
    marks = cues.select("rec", F.col("start_frame").alias("at"), F.lit(0).alias("kind"), "cue_no", "end_frame", none.cast("double").alias("lp"), none.cast("double").alias("margin"))
    rows = frames.select("rec", F.col("t").alias("at"), F.lit(1).alias("kind"), none.cast("long").alias("cue_no"), none.cast("long").alias("end_frame"), F.col("lp").cast("double").alias("lp"), F.col("margin").cast("double").alias("margin"))
    order = Window.partitionBy("rec").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    own = F.last(F.when(F.col("kind") == 0, F.struct("cue_no", "end_frame")), ignorenulls=True).over(order)
    held = marks.unionByName(rows).withColumn("own", own)
    of = held.select("rec", F.col("own.cue_no").alias("cue_no"), F.when(F.col("at") <= F.col("own.end_frame"), F.struct("lp", "margin")).alias("x"))
    got = of.filter("cue_no IS NOT NULL").groupBy("rec", "cue_no").agg(F.avg("x.lp").alias("avg_logprob"), F.min("x.margin").alias("min_decision_margin"))
    return cues.join(got, ["rec", "cue_no"], "left").na.fill(-INF, ["avg_logprob"]).na.fill(INF, ["min_decision_margin"])


def flag_low_confidence(cues: DataFrame, logprob_margin: float = 1.0, margin_floor: float = 0.5, spliced: Column | None = None) -> DataFrame:
    """cues with low_confidence: mean score below the recording's median (finite, not spliced) less logprob_margin, or a
    decision margin below margin_floor."""
    spliced = F.lit(False) if spliced is None else spliced
    usable = finite(F.col("avg_logprob")).isNotNull() & ~spliced
    base = F.median(F.when(usable, F.col("avg_logprob"))).over(Window.partitionBy("rec"))
    got = cues.withColumn("base", base)
    low = (F.col("avg_logprob") < F.coalesce("base", F.lit(0.0)) - logprob_margin) | (F.col("min_decision_margin") < margin_floor)
    return got.withColumn("low_confidence", low).drop("base")


def anomalous(duration: Column, median: Column, is_final: Column, low: float = 0.15, high: float = 3.0, final_mult: float = 1.5) -> Column:
    """Far shorter or longer than the median; the last word of a verse may be longer."""
    return (duration < low * median) | (duration > high * F.when(is_final, final_mult).otherwise(1.0) * median)


def flag_anomalies(cues: DataFrame, **ratios: float) -> DataFrame:
    """cues with duration, median and is_anomalous; recordings whose median is not positive have no anomalies."""
    timed = cues.withColumn("duration", F.col("end_frame") - F.col("start_frame"))
    medians = timed.groupBy("rec").agg(F.median("duration").alias("median"))
    flag = (F.col("median") > 0) & anomalous(F.col("duration"), F.col("median"), F.col("is_ayah_final"), **ratios)
    return timed.join(medians, "rec").withColumn("is_anomalous", flag)


def ayah_final(slots: DataFrame) -> DataFrame:
    """slots with is_ayah_final: the last word of each verse."""
    order = Window.partitionBy("rec", "sura", "aya").orderBy("word_no")
    return slots.withColumn("is_ayah_final", F.lead("word_no").over(order).isNull())


def words_back_in_verse(cues: DataFrame) -> DataFrame:
    """cues with words_back: how many consecutive cues of the same verse end at each, itself included."""
    order = _ordered("cue_no")
    changed = ~(F.col("aya").eqNullSafe(F.lag("aya").over(order)) & F.col("sura").eqNullSafe(F.lag("sura").over(order)))
    island = F.sum(F.coalesce(changed, F.lit(True)).cast("int")).over(order)
    marked = cues.withColumn("island", island)
    return marked.withColumn("words_back", F.row_number().over(Window.partitionBy("rec", "island").orderBy("cue_no"))).drop("island")


def repeat_sites(cues: DataFrame) -> DataFrame:
    """rec, site, aya, phrase, n_words, start, end, duration of maximal runs of repeated cues."""
    order = _ordered("cue_no")
    new = (F.col("is_repeat") & ~F.coalesce(F.lag("is_repeat").over(order), F.lit(False))).cast("int")
    marked = cues.withColumn("site", F.sum(new).over(order) - 1).filter("is_repeat")
    words = F.array_sort(F.collect_list(F.struct("cue_no", "word")))
    sites = marked.groupBy("rec", "site").agg(
        F.min_by("aya", "cue_no").alias("aya"),
        F.array_join(F.transform(words, lambda w: w["word"]), " ").alias("phrase"),
        F.count("*").alias("n_words"),
        F.min_by("start", "cue_no").alias("start"),
        F.max_by("end", "cue_no").alias("end"),
    )
    return sites.withColumn("duration", F.col("end") - F.col("start"))


def display_mapping(cues: DataFrame, back: int = 30) -> DataFrame:
    """cues with slot: a word's place among the words said once; for a repeat the nearest earlier slot with the same word
    and verse, at most `back` before, else the slot before it. The join's key holds the place in steps of `back`: a repeat
    meets words of its own step and of the one before, at most 2 x back of them, however frequent its word is."""
    order = _ordered("cue_no")
    counted = cues.withColumn("cursor", F.sum((~F.col("is_repeat")).cast("long")).over(order))
    found = F.col("cursor") - 1
    canonical = counted.filter(~F.col("is_repeat")).select("rec", "word", "aya", found.alias("found"), F.floor(found / back).alias("step"))
    step = F.floor((F.col("cursor") - 1) / back)
    repeats = counted.filter("is_repeat").withColumn("step", F.explode(F.array(step, step - 1)))
    near = (
        repeats.join(canonical, ["rec", "word", "aya", "step"])
        .filter((F.col("found") < F.col("cursor")) & (F.col("found") >= F.col("cursor") - back))
        .groupBy("rec", "cue_no")
        .agg(F.max("found").alias("found"))
    )
    mapped = counted.join(near, ["rec", "cue_no"], "left")
    slot = F.when(~F.col("is_repeat"), F.col("cursor") - 1).otherwise(F.coalesce("found", F.greatest(F.lit(0), F.col("cursor") - 1)))
    return mapped.withColumn("slot", slot).drop("cursor", "found")


def slot_starts(mapped: DataFrame) -> DataFrame:
    """rec, slot, start: when each display slot is first reached, in cue order."""
    return mapped.groupBy("rec", "slot").agg(F.min_by("start", "cue_no").alias("start"))


def words_at(cues: DataFrame, times: DataFrame) -> DataFrame:
    """times (rec, time) with cue_no of the word that holds it (start <= time < end), or -1.

    As-of by a union and one ordered pass: the last start at or before each time, then a look at its end; no range join.
    """
    marks = cues.select("rec", F.col("start").alias("at"), F.lit(0).alias("kind"), "cue_no", "end").unionByName(
        times.select("rec", F.col("time").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("cue_no"), F.lit(None).cast("double").alias("end"))
    )
    order = Window.partitionBy("rec").orderBy("at", "kind", "cue_no").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("kind") == 0, F.struct("cue_no", "end")), ignorenulls=True).over(order)
    got = marks.withColumn("held", last).filter("kind = 1")
    return got.select("rec", F.col("at").alias("time"), F.when(F.col("at") < F.col("held.end"), F.col("held.cue_no")).otherwise(-1).alias("cue_no"))


def repeat_jumps(sites: DataFrame, times: DataFrame, ahead: float = 0.5, behind: float = 1.0, lead: float = 5.0) -> DataFrame:
    """times (rec, time) with next_seek and prev_seek: the next repeat after time + ahead and the last before time - behind,
    wrapping around, each `lead` seconds early. Sites of a recording are few; they travel as one sorted array."""
    starts = sites.groupBy("rec").agg(F.array_sort(F.collect_list("start")).alias("starts"))
    got = times.join(starts, "rec", "left")
    after = F.filter("starts", lambda s: s > F.col("time") + ahead)
    before = F.filter("starts", lambda s: s < F.col("time") - behind)
    nxt = F.coalesce(F.get(after, 0), F.get("starts", 0))
    prv = F.coalesce(F.get(before, F.size(before) - 1), F.get("starts", F.size("starts") - 1))
    return got.select("rec", "time", F.greatest(F.lit(0.0), nxt - lead).alias("next_seek"), F.greatest(F.lit(0.0), prv - lead).alias("prev_seek"))


def monotone_violations(cues: DataFrame) -> DataFrame:
    """rec, n_cues, n_unique, n_violations: cues that start before the one before them has ended."""
    order = _ordered("cue_no")
    marked = cues.withColumn("early", (F.lag("end").over(order) > F.col("start")).cast("int"))
    return marked.groupBy("rec").agg(
        F.count("*").alias("n_cues"), F.sum((~F.col("is_repeat")).cast("int")).alias("n_unique"), F.coalesce(F.sum("early"), F.lit(0)).alias("n_violations")
    )


def splice(cues: DataFrame, fixes: DataFrame) -> DataFrame:
    """cues without those that fixes replace (consumed: rec, cue_no) and with the fixes' own; in order of (start, end)."""
    kept = cues.join(fixes.select("rec", F.col("replaces").alias("cue_no")).distinct(), ["rec", "cue_no"], "left_anti")
    both = kept.unionByName(fixes.drop("replaces"), allowMissingColumns=True)
    return both.withColumn("cue_no", F.row_number().over(_ordered("start_frame", "end_frame", "cue_no")) - 1)


def records(cues: DataFrame, seconds_per_frame: float = 0.04) -> DataFrame:
    """start and end in seconds of start_frame and end_frame, clamped."""
    timed = cues.withColumn("start", F.col("start_frame") * seconds_per_frame).withColumn("end", F.col("end_frame") * seconds_per_frame)
    return clamp(timed)


def srt_blocks(cues: DataFrame, keep_preamble: bool = True) -> DataFrame:
    """rec, index, block: numbered subtitle blocks of clamped cues (rec, position, word, start, end, is_repeat)."""
    rows = cues if keep_preamble else strip_preamble(cues)
    index = F.row_number().over(_ordered("position"))
    word = F.concat("word", F.when(F.col("is_repeat"), " [repeat]").otherwise(""))
    block = F.concat(index.cast("string"), F.lit("\n"), srt_time(F.col("start")), F.lit(" --> "), srt_time(F.col("end")), F.lit("\n"), word, F.lit("\n"))
    return rows.select("rec", index.alias("index"), block.alias("block"))


def json_records(cues: DataFrame, columns: list[str]) -> DataFrame:
    """rec, position, json of each record; infinite scores become null and null fields stay."""
    safe = [finite(F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in cues.select(*columns).dtypes]
    return cues.select("rec", "position", F.to_json(F.struct(*safe), {"ignoreNullFields": "false"}).alias("json"))


def assign_words(spans: DataFrame, positions: DataFrame) -> DataFrame:
    """positions (rec, pos) with the word whose span (rec, word_no, span_start, span_end) holds it, null between words.

    Spans do not overlap, so the last start at or before a position decides: one ordered pass a recording.
    """
    marks = spans.select("rec", F.col("span_start").alias("at"), F.lit(0).alias("kind"), "word_no", "span_end").unionByName(
        positions.select("rec", F.col("pos").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("int").alias("word_no"), F.lit(None).cast("int").alias("span_end"))
    )
    order = Window.partitionBy("rec").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("kind") == 0, F.struct("word_no", "span_end")), ignorenulls=True).over(order)
    got = marks.withColumn("held", last).filter("kind = 1")
    return got.select("rec", F.col("at").alias("pos"), F.when(F.col("at") < F.col("held.span_end"), F.col("held.word_no")).alias("word_no"))


def nearest_boundary(targets: DataFrame, column: str = "target", ends: str = "ends") -> DataFrame:
    """targets with boundary: the element of the array `ends` nearest to the target, the first among equals."""
    near = F.array_min(F.transform(ends, lambda e, i: F.struct(F.abs(e - F.col(column)).alias("off"), i.alias("i"), e.alias("end"))))
    return targets.withColumn("boundary", near["end"])


def lookup_misses(rows: DataFrame, table: DataFrame, key: str, group: str) -> DataFrame:
    """group, n, misses: rows whose key is not in the table (one row a key)."""
    got = rows.join(table.select(key).distinct().withColumn("hit", F.lit(1)), key, "left")
    return got.groupBy(group).agg(F.count("*").alias("n"), F.count_if(F.col("hit").isNull()).alias("misses"))


def longest_runs(runs: DataFrame, most: int) -> DataFrame:
    """The `most` longest runs (rec, run_no, frames) of a recording, earlier ones first among equals."""
    order = Window.partitionBy("rec").orderBy(F.col("frames").desc(), "run_no")
    return runs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def output_frames(silences: DataFrame, lengths: DataFrame, per_frame: int = 4) -> DataFrame:
    """rec, frame: distinct output frames of silences (rec, feature_frame) strictly inside a recording (rec, n_frames)."""
    rows = silences.select("rec", F.floor(F.col("feature_frame") / per_frame).alias("frame")).distinct()
    return rows.join(lengths, "rec").filter((F.col("frame") > 0) & (F.col("frame") < F.col("n_frames"))).select("rec", "frame")
