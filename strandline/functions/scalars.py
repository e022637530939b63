"""Scalar column functions: times, text, specs, keys and safe numbers. All of them stay in generated code."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Digit and letter foldings of the transcript text.
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
DIACRITICS = "[ؐ-ًؚ-ٰٟۖ-ۭـ]"
FOLD_FROM, FOLD_TO = "أإآٱىؤئة", "اااايويه"


def srt_time(seconds: Column) -> Column:
    """HH:MM:SS,mmm of max(0, milliseconds rounded half to even)."""
    ms = F.greatest(F.lit(0), F.bround(seconds * 1000).cast("long"))
    hour, minute, second = ms / 3_600_000, ms / 60_000 % 60, ms / 1000 % 60
    return F.format_string("%02d:%02d:%02d,%03d", *[F.floor(x).cast("long") for x in (hour, minute, second)], ms % 1000)


def clock(seconds: Column) -> Column:
    """1h 02m 03s, or 02m 03s below an hour."""
    s = F.floor(seconds).cast("long")
    h, m = F.floor(s / 3600), F.floor(s / 60) % 60
    return F.when(h > 0, F.format_string("%dh %02dm %02ds", h, m, s % 60)).otherwise(F.format_string("%02dm %02ds", m, s % 60))


def minutes(seconds: Column) -> Column:
    """m:ss."""
    s = F.floor(seconds).cast("long")
    return F.format_string("%d:%02d", F.floor(s / 60), s % 60)


def arabic_digits(x: Column) -> Column:
    return F.translate(x.cast("string"), "0123456789", ARABIC_DIGITS)


def normalize_text(x: Column) -> Column:
    """Diacritics removed, letter variants folded, white space collapsed."""
    x = F.translate(F.regexp_replace(x, DIACRITICS, ""), FOLD_FROM, FOLD_TO)
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def nfc(x: Column) -> Column:
    """Composed form (NFC). Spark has no function for it: Arrow batches, and only for text beyond ASCII worth calling."""

    @F.pandas_udf("string")
    def compose(s: pd.Series) -> pd.Series:
        return s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))

    return compose(x)


def finite(x: Column) -> Column:
    """x, or null where it is infinite or not a number: what JSON can hold."""
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), None).otherwise(x)


def number_list(spec: Column, strict: bool = True) -> Column:
    """`a-b` (inclusive) or a comma list as an array; a reversed range is an error, or empty if not strict."""
    a, b = (F.trim(F.split(spec, "-")[k]).cast("int") for k in (0, 1))
    reverse = F.raise_error(F.concat(F.lit("reversed range: "), spec)) if strict else F.array().cast("array<int>")
    ranged = F.when(a <= b, F.sequence(a, b)).otherwise(reverse)
    items = F.filter(F.transform(F.split(spec, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(spec.contains("-") & ~spec.contains(","), ranged).otherwise(F.transform(items, lambda x: x.cast("int")))


def cache_key(path: Column, size: Column, mtime: Column) -> Column:
    """Key of a decoded file: any change of path, size or time is another key."""
    return F.sha2(F.concat_ws("_", path, size.cast("string"), mtime.cast("string")), 256)


def preamble_choice(choice: Column) -> Column:
    """`auto`, `yes` or `no` in any of their spellings; anything else is an error."""
    c = F.lower(F.trim(choice))
    wrong = F.raise_error(F.concat(F.lit("neither auto, yes nor no: "), choice)).cast("string")
    return (
        F.when(c.isin("auto", "default", "none"), "auto").when(c.isin("yes", "true", "1", "y"), "yes").when(c.isin("no", "false", "0", "n"), "no").otherwise(wrong)
    )


def output_format(choice: Column, path: Column) -> Column:
    """The format asked for, or for `auto` the one of the file's extension (both if it has none of them)."""
    lower = F.lower(path)
    return F.when(choice != "auto", choice).when(lower.endswith(".srt"), "srt").when(lower.endswith(".json"), "json").otherwise("both")


def timeline(start: Column, duration: Column, total: Column) -> Column:
    """left and width in percent, width at least 0.3."""
    return F.struct((start / total * 100).alias("left"), F.greatest(F.lit(0.3), duration / total * 100).alias("width"))
