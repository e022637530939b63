"""The alignment plan: scores and word slots to word-level records, recording by recording."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators import cues, search


@dataclass(frozen=True)
class AlignParams:
    """Parameters of the plan; the defaults are part of its meaning. repeats: None for no search."""

    blank: int = 0
    seconds_per_frame: float = 0.04
    shortest_word: float = 0.15
    logprob_margin: float = 1.0
    margin_floor: float = 0.5
    engine: str = "direct"
    repeats: search.RepeatParams | None = search.RepeatParams()


def align(scores: DataFrame, slots: DataFrame, params: AlignParams = AlignParams()) -> tuple[DataFrame, DataFrame]:  # noqa: B008
    """(records, errors) of scores (rec, t, lp) and slots (rec, word_no, word, sura, aya, is_ayah_final, tokens).

    One grouped function aligns a recording, searches it for repeats and splices those in: each keeps its word, has the
    spans and the mean of its own copy and an infinite margin. All that follows are windows over the same dealing by
    recording, so the scores are moved and searched once for the records (and once more if the errors are asked for).
    """
    got = search.align_words(scores, slots, params.blank, params.engine, params.repeats)
    errors = got.filter("error IS NOT NULL").select("rec", "error")
    named = slots.select("rec", "word_no", "word", "sura", "aya", "is_ayah_final", "tokens")
    records = got.filter("error IS NULL").drop("error").join(named, ["rec", "word_no"])
    records = cues.flag_low_confidence(records, params.logprob_margin, params.margin_floor, F.col("spliced"))
    timed = records.withColumn("start", F.col("start_frame") * params.seconds_per_frame).withColumn("end", F.col("end_frame") * params.seconds_per_frame)
    return cues.clamp(timed, params.shortest_word), errors
