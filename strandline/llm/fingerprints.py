"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the SKETCH smallest distinct 64-bit hashes of a text's shingles, ascending. Sketches merge (the smallest of
the union), so parts of a document can be sketched apart, and a merged sketch is that of the whole as long as parts
overlap by a shingle less one word. From two sketches come estimates of resemblance and containment, and from one the
number of distinct shingles; below SKETCH shingles all of them are exact.

Defined results: null and empty text, or text without words, has the empty sketch; fewer words than a shingle are one
shingle; equal texts have equal sketches; two empty sketches have resemblance 1, an empty one and another 0.
Only DataFrame functions are used; a word is hashed once and a shingle is a hash of its words' hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import cut

SKETCH, SHINGLE = 128, 5
RANGE_ROWS = 500
STRIDE, LAST = 32, 2**62


def sketch(text: Column, k: int = SKETCH, size: int = SHINGLE) -> Column:
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return _sketch_of(F.transform(words, lambda w: F.xxhash64(w)), k, size)


def _sketch_of(hashes: Column, k: int, size: int) -> Column:
    def shingles(h: Column) -> Column:
        whole = F.transform(F.slice(h, 1, F.size(h) - size + 1), lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, size)]))
        short = F.when(F.size(h) > 0, F.array(F.xxhash64(F.size(h), F.array_join(F.transform(h, lambda x: F.hex(x)), " ")))).otherwise(
            F.array().cast("array<bigint>")
        )
        return F.slice(F.array_sort(F.array_distinct(F.when(F.size(h) >= size, whole).otherwise(short))), 1, k)

    # bound once: a lambda over a one-element array, else every use of h would split the text again
    return F.get(F.transform(F.array(hashes), shingles), 0)


def merge(a: Column, b: Column, k: int = SKETCH) -> Column:
    """The sketch of the union of what a and b are sketches of."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def merge_groups(df: DataFrame, keys: list[str], column: str, k: int = SKETCH) -> DataFrame:
    """One sketch a key from those of its parts: hashes are made distinct before they meet, the k least of each remain."""
    rows = df.select(*keys, F.explode(column).alias("h")).distinct()
    least = Window.partitionBy(*keys).orderBy("h")
    kept = rows.withColumn("r", F.row_number().over(least)).filter(F.col("r") <= k)
    return kept.groupBy(*keys).agg(F.array_sort(F.collect_list("h")).alias(column))


def resemblance(a: Column, b: Column, k: int = SKETCH) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that both hold."""
    both = F.size(F.array_intersect(merge(a, b, k), F.array_intersect(a, b)))
    union = F.size(merge(a, b, k))
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def distinct_shingles(a: Column, k: int = SKETCH) -> Column:
    """Estimated number of distinct shingles."""
    share = (F.element_at(a, k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = SKETCH) -> Column:
    """Estimated share of a's shingles that b holds too."""
    j = resemblance(a, b, k)
    na = distinct_shingles(a, k)
    shared = j / (1 + j) * (na + distinct_shingles(b, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / na))


def fingerprint(a: Column) -> Column:
    """A sketch as text: base64 of its hashes, eight bytes each."""
    return F.base64(F.unhex(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")))


def key_ranges(rows: DataFrame, key: str, per_range: int = RANGE_ROWS, first_level: int = 1024) -> tuple[Column, int]:
    """The column that deals rows into ascending ranges of the key, of about per_range rows, and how many ranges make a
    cell; nulls make the last range, LAST.

    Cells are at most first_level + 1, between quantiles; ranges are equal widths within a cell. So what is asked for and
    compared has a fixed size, and what follows a range is found within its cell or is the first of a later cell.
    """
    count, low, high = rows.agg(F.count("*"), F.min(key), F.max(key)).first()
    if low is None:
        return F.lit(0).cast("long"), 1
    ranges = max(1, -(-count // per_range))
    wanted = min(ranges, first_level)
    cuts = [low]
    if wanted > 1:
        cuts += rows.agg(F.percentile_approx(key, [i / wanted for i in range(1, wanted)], 10 * wanted)).first()[0]
    cuts = sorted(set(cuts))
    ends = [*cuts[1:], high + 1]
    parts = -(-ranges // len(cuts))
    widths = [max(1, -(-(e - c) // parts)) for c, e in zip(cuts, ends, strict=True)]

    def inside(at: Column) -> Column:
        step = ((F.col(key) - F.element_at(F.lit(cuts), at)) / F.element_at(F.lit(widths), at)).cast("long")
        return at.cast("long") * parts + F.least(step, F.lit(parts - 1))

    at = _reached(F.lit(cuts), F.lit(cuts[::STRIDE]), F.col(key))
    place = F.get(F.transform(F.array(at), inside), 0)
    return F.when(F.col(key).isNull(), F.lit(LAST)).otherwise(place), parts


def _reached(cuts: Column, coarse: Column, x: Column) -> Column:
    """How many of the ascending cuts are at most x: first among every STRIDE-th, then among the STRIDE from there on."""
    group = F.size(F.filter(coarse, lambda c: c <= x)) - 1
    return F.get(
        F.transform(F.array(group), lambda g: g * STRIDE + F.size(F.filter(F.slice(cuts, g * STRIDE + 1, STRIDE), lambda c: c <= x))), 0
    )


def with_next(docs: DataFrame, k: int = SKETCH, size: int = SHINGLE, per_range: int = RANGE_ROWS) -> DataFrame:
    """doc_id, text, sketch, next_text, next_sketch: the next row by ascending doc_id, after the last the first.

    A window finds the next row inside a range of keys; the last row of a range takes the first of the range that follows,
    from a table of one row a range. Equal keys follow one another by text; null keys come last. A single row is its own next.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    place, per_cell = key_ranges(rows, "doc_id", per_range)
    rows = rows.withColumn("place", place)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text")
    firsts = cut(rows.groupBy("place").agg(F.min_by("text", order).alias("first_text")), "firsts")
    cell = F.when(F.col("place") == LAST, F.col("place")).otherwise(F.floor(F.col("place") / per_cell))
    # the range that follows one is in its cell, or the first of the next cell; cells are few, whatever the size
    places = firsts.select("place", cell.alias("cell"))
    cells = places.groupBy("cell").agg(F.min("place").alias("first"))
    turn = F.lead("first", 1).over(Window.orderBy("cell"))
    cells = cells.select("cell", F.coalesce(turn, F.min("first").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("later"))
    inner = places.select("cell", "place", F.lead("place").over(Window.partitionBy("cell").orderBy("place")).alias("inner"))
    nexts = inner.join(cells, "cell").select("place", F.coalesce("inner", "later").alias("follower"))
    nexts = nexts.join(firsts.withColumnRenamed("place", "follower"), "follower")
    nexts = cut(nexts.select("place", "first_text", sketch(F.col("first_text"), k, size).alias("first_sketch")), "nexts")
    inside = Window.partitionBy("place").orderBy(F.col("doc_id").asc_nulls_last(), "text")
    rows = rows.select("place", "doc_id", "text", sketch(F.col("text"), k, size).alias("sketch"))
    rows = rows.withColumn("lead", F.lead(F.struct("text", "sketch")).over(inside)).join(nexts, "place")
    return rows.select(
        "doc_id",
        "text",
        "sketch",
        F.coalesce("lead.text", "first_text").alias("next_text"),
        F.coalesce("lead.sketch", "first_sketch").alias("next_sketch"),
    )
