"""Array column functions: score vectors, label sequences, edit distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_softmax(x: Column) -> Column:
    """Elements less the logarithm of the sum of their exponentials, shifted by the maximum for safety."""

    def shifted(top: Column) -> Column:
        total = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + F.exp(v.cast("double") - top))
        return F.get(F.transform(F.array(F.ln(total)), lambda norm: F.transform(x, lambda v: v.cast("double") - top - norm)), 0)

    return F.get(F.transform(F.array(F.array_max(x).cast("double")), shifted), 0)


def argmax(x: Column) -> Column:
    """Index of the first maximum."""
    return (F.array_position(x, F.array_max(x)) - 1).cast("int")


def top_two(x: Column) -> Column:
    """The largest and second largest elements."""
    return F.slice(F.sort_array(x, asc=False), 1, 2)


def top_k(x: Column, k: int, exclude: Column | None = None) -> Column:
    """(index, value) of the k largest elements but `exclude`, the largest first, lower indexes first among equals."""
    pairs = F.transform(x, lambda v, i: F.struct((-v).alias("order"), i.alias("index"), v.alias("value")))
    if exclude is not None:
        pairs = F.filter(pairs, lambda p: p["index"] != exclude)
    return F.transform(F.slice(F.array_sort(pairs), 1, k), lambda p: F.struct(p["index"].alias("index"), p["value"].alias("value")))


def interleave(ids: Column, blank: int) -> Column:
    """blank, id, blank, id, ..., blank: the states of an alignment."""
    return F.concat(F.flatten(F.transform(ids, lambda x: F.array(F.lit(blank), x))), F.array(F.lit(blank)))


def skip_mask(states: Column) -> Column:
    """For each state whether it may be reached from two before it: label states that differ from the label before."""
    return F.transform(states, lambda x, i: (i % 2 == 1) & (i >= 2) & (x != F.coalesce(F.get(states, i - 2), F.lit(-1))))


def collapse_units(units: Column) -> Column:
    """Runs of equal elements become one."""
    return F.filter(F.transform(units, lambda x, i: F.when((i == 0) | ~x.eqNullSafe(F.get(units, i - 1)), x)), lambda x: x.isNotNull())


def edit_ratio(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length of two strings with one character a token; two empty ones are equal."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longer)


def bounded_edit_ratio(a: Column, b: Column, least: float) -> Column:
    """edit_ratio, but where the lengths alone keep it below `least` only their ratio: the costly part is left out."""
    shorter, longer = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    return F.when((longer > 0) & (shorter / longer < least), shorter / longer).otherwise(edit_ratio(a, b))


def joint_only(joint: Column, alone: Column) -> Column:
    """Names in joint but not in alone, sorted, where the two sets differ; else null."""
    a, b = F.array_sort(F.array_distinct(joint)), F.array_sort(F.array_distinct(alone))
    return F.when(a != b, F.array_sort(F.array_except(joint, alone)))


def letter_cells(letters: Column, cells: Column) -> Column:
    """letters (structs) with start, end and phonemes of the cells (char, phoneme, start, end; in token order) of their index."""

    def build(letter: Column, i: Column) -> Column:
        own = F.filter(cells, lambda c: c["char"] == i)
        return F.struct(
            letter.alias("letter"),
            F.get(own, 0)["start"].alias("start"),
            F.get(own, F.size(own) - 1)["end"].alias("end"),
            F.transform(own, lambda c: F.struct(c["phoneme"].alias("phoneme"), c["start"].alias("start"), c["end"].alias("end"))).alias("phonemes"),
        )

    return F.transform(letters, build)
